"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the whole dialogue is rendered with that
speaker as assistant and all others as named users; the system turns stay system.
A mask says which characters are to be learned: the assistant's contents with the
end mark.

A participant is a role as it stands in the table. Its name in a header is the role
with other characters than letters, digits, _ and - as _; if several roles of a
conversation give one name, the unchanged one keeps it and the others get .2, .3 ...

One row holds one participant's rendering. Only where a conversation has more than
``part_bytes`` of text, which no dialogue has, its rendering is laid over several
rows, so that no task holds a conversation whatever its size: a row ends with the turn that reaches
that many, so the largest cell has them and one turn more; the rows' texts,
joined by a newline in the order of ``part``, are the rendering. ``start`` is a
row's place in it, and masks count from the rendering's first character. Places are
found by ranges of the rows' order, not by turn numbers.

Defined cases: a null text is an empty turn, a null role speaks as ``unknown``.
Turns are ordered by number, ties by role and text; a null number comes first;
repeated rows are turns of their own. A conversation of system turns alone has no
participant and no sample. Null conv_ids are one conversation. Marks that occur in a
text are broken up with a zero-width space, so a text can't forge a turn. Other
columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, hot_join, live_cuts, table, tidy

START, END = "<|start|>", "<|end|>"
#: Bytes of a conversation's turns in one row; a turn counts with TURN_BYTES more for its header and end.
PART_BYTES, TURN_BYTES = 64 << 20, 64
#: Turns whose masks are put together before these are.
SLICE = 256
TURN = ["turn", "role", "body"]


def safe(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<​|"))


def name_of(role: Column) -> Column:
    """A role as a name in a header: runs of other characters than letters, digits, _ and - become one _."""
    return F.coalesce(F.regexp_replace(role, "[^A-Za-z0-9_-]+", "_"), F.lit("unknown"))


def candidate(role: Column) -> Column:
    """A role with its name; sorted, the role that is its own name comes first of those with one name."""
    name = name_of(role)
    return F.struct(name.alias("name"), (~name.eqNullSafe(role)).alias("changed"), role.alias("role"))


def named(candidates: Column) -> Column:
    """An array of distinct candidates with unique names, in the order of the names."""
    roles = F.sort_array(candidates)
    first = lambda c: F.array_position(F.transform(roles, lambda x: x["name"]), c["name"])

    def one(c: Column, i: Column) -> Column:
        k = i.cast("long") + 2 - first(c)
        return F.named_struct(F.lit("role"), c["role"], F.lit("name"), F.when(k > 1, F.concat(c["name"], F.lit("."), k.cast("string"))).otherwise(c["name"]))

    return F.transform(roles, one)


def weight() -> Column:
    return F.octet_length("body").cast("long") + TURN_BYTES


def place(rows: DataFrame) -> DataFrame:
    """The rows with ``at``, the bytes of the conversation's turns before them, without bringing a conversation into one task.

    Rows are dealt by range of their whole order; before a row are the conversation's
    rows of its range, and all of those in the ranges before. Only
    the first conversation of a range has rows in ranges before.
    """
    numbered = cut(rows.withColumn("tie", F.monotonically_increasing_id()))  # written, so that a task that runs again deals rows alike
    ranged = cut(numbered.repartitionByRange("conv_id", *TURN, "tie").withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy("conv_id", "range").agg(F.sum(weight()).alias("n"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("conv_id").alias("_conv"), F.col("range").alias("_range"), F.sum("n").over(earlier.partitionBy("conv_id").orderBy("range")).alias("before")).where("before is not null")
    inside = ranged.withColumn("at", F.coalesce(F.sum(weight()).over(earlier.partitionBy("conv_id", "range").orderBy(*TURN, "tie")), F.lit(0)))
    out = inside.join(F.broadcast(before), inside["conv_id"].eqNullSafe(before["_conv"]) & (inside["range"] == before["_range"]), "left")
    return out.select(*rows.columns, (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"))


def rotate(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", system: str = "system", part_bytes: int = PART_BYTES) -> DataFrame:
    """Per conversation, part and participant: participant (its name), role, n_turns, n_masked, start, text and mask (start and end of learned characters)."""
    since = live_cuts()
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), safe(F.col(text_col)).alias("body"))
    speaks = ~F.col("role").eqNullSafe(system)
    long = cut(rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(weight()).alias("n_bytes")).where(F.col("n_bytes") > part_bytes))
    split = not long.isEmpty()
    total = rows.count() if split else 0
    marked = hot_join(rows, long.select("conv_id", "n"), ["conv_id"], "n", total, "left") if split else rows
    short = marked.where("n is null").drop("n") if split else rows
    turn = F.struct(*TURN)
    whole = short.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    own = F.filter("turns", lambda t: ~t["role"].eqNullSafe(system))
    whole = whole.select("conv_id", F.lit(0).cast("long").alias("part"), "turns", named(F.array_distinct(F.transform(own, lambda t: candidate(t["role"])))).alias("speakers"))
    if split:
        placed = cut(place(marked.where("n is not null").drop("n")).withColumn("part", F.floor(F.col("at") / part_bytes).cast("long")))
        # a turn larger than a part leaves numbers out
        numbers = placed.select("conv_id", "part").distinct()
        dense = numbers.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), (F.row_number().over(Window.partitionBy("conv_id").orderBy("part")) - 1).cast("long").alias("number"))
        parts = placed.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        parts = parts.join(dense, parts["conv_id"].eqNullSafe(dense["_conv"]) & (parts["part"] == dense["_part"])).select("conv_id", F.col("number").alias("part"), "turns")
        roles = placed.groupBy("conv_id").agg(F.collect_set(F.when(speaks, candidate(F.col("role")))).alias("roles"))
        sized = numbers.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("n_parts")).join(roles, F.col("_conv").eqNullSafe(F.col("conv_id"))).select("conv_id", "n_parts", named(F.col("roles")).alias("speakers"))
        parts = hot_join(parts, sized, ["conv_id"], "n_parts", numbers.count())
        tidy(turns.sparkSession, [*since, marked.cut_path], placed, parts)
        whole = whole.unionByName(parts.select("conv_id", "part", "turns", "speakers"))
    else:
        tidy(turns.sparkSession, since)

    def spoken(t: Column) -> Column:
        name = F.element_at(F.filter("speakers", lambda s: s["role"].eqNullSafe(t["role"])), 1)["name"]
        return F.named_struct(F.lit("name"), F.when(t["role"].eqNullSafe(system), F.lit(None)).otherwise(name), F.lit("body"), F.concat(t["body"], F.lit(END)))

    each = whole.select("conv_id", "part", F.transform("turns", spoken).alias("turns"), F.explode("speakers").alias("speaker"))

    def head(t: Column) -> Column:
        who = F.when(t["name"].isNull(), F.lit("system")).when(t["name"] == F.col("speaker.name"), F.lit("assistant")).otherwise(F.concat(F.lit("user name="), t["name"]))
        return F.concat(F.lit(START), who, F.lit("\n"))

    laid = each.select("conv_id", "part", "speaker", F.transform("turns", lambda t: F.struct(head(t).alias("head"), t["body"].alias("body"), t["name"].eqNullSafe(F.col("speaker.name")).alias("own"))).alias("parts"))
    # offsets are running sums of the lengths of what stands before; an array grows by copying, so masks are put together in slices
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc: Column, p: Column) -> Column:
        a = acc["at"] + F.length(p["head"])
        b = a + F.length(p["body"])
        own = F.array(F.struct(a.alias("start"), b.alias("end")))
        return F.struct((b + 1).alias("at"), F.when(p["own"], F.concat(acc["mask"], own)).otherwise(acc["mask"]).alias("mask"))

    def add(acc: Column, of: Column) -> Column:
        one = F.aggregate(of, F.struct(acc["at"].alias("at"), none.alias("mask")), step)
        return F.element_at(F.transform(F.array(one), lambda r: F.struct(r["at"].alias("at"), F.concat(acc["masks"], F.array(r["mask"])).alias("masks"))), 1)

    slices = F.transform(F.sequence(F.lit(1), F.size("parts"), F.lit(SLICE)), lambda i: F.slice("parts", i, SLICE))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<struct<start:bigint,end:bigint>>>").alias("masks"))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"])), "\n")
    out = laid.select("conv_id", "part", "speaker", F.size("parts").cast("long").alias("n_turns"), text.alias("text"), F.aggregate(slices, start, add, lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["masks"]).alias("mask"))).alias("s"))
    begin = F.lit(0).cast("long")
    if split:  # a row's start is the length of the parts before, with their newlines
        before = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("begin", F.coalesce(F.sum("s.at").over(before), F.lit(0)))
        begin = F.col("begin")
    mask = F.transform("s.mask", lambda m: F.struct((m["start"] + begin).alias("start"), (m["end"] + begin).alias("end")))
    masked = F.aggregate("s.mask", F.lit(0).cast("long"), lambda n, m: n + m["end"] - m["start"])
    return out.select(F.col("conv_id").alias(conv_col), "part", F.col("speaker.name").alias("participant"), F.col("speaker.role").alias("role"), "n_turns", masked.alias("n_masked"), begin.alias("start"), "text", mask.alias("mask"))


def op1_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations; the mask as text, start-end pairs joined by commas."""
    pairs = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return rotate(table(spark, sf_dir, "conversations")).withColumn("mask", pairs)


OP1_SQL = """
with t as (
  select conv_id, turn, role, coalesce(regexp_replace(role, '[^A-Za-z0-9_-]+', '_', 'g'), 'unknown') as clean, replace(coalesce(text, ''), '<|', '<' || chr(8203) || '|') as body
  from conversations),
n as (
  select conv_id, role, clean || case when k > 1 then '.' || k else '' end as name
  from (select conv_id, role, clean, row_number() over (partition by conv_id, clean order by clean is distinct from role, role nulls first) as k from (select distinct conv_id, role, clean from t where role is distinct from 'system'))),
r as (
  select p.conv_id, p.name as participant, p.role as own_role, t.turn, t.role, t.body, t.role is not distinct from p.role as own,
         row_number() over (partition by p.conv_id, p.name order by t.turn nulls first, t.role nulls first, t.body) as k,
         '<|start|>' || case when t.role is not distinct from p.role then 'assistant' when t.role = 'system' then 'system' else 'user name=' || n.name end || chr(10) as head
  from n p join t on p.conv_id is not distinct from t.conv_id left join n on t.conv_id is not distinct from n.conv_id and t.role is not distinct from n.role),
b as (
  select *, coalesce(sum(strlen(body) + 64) over (partition by conv_id, participant order by k rows between unbounded preceding and 1 preceding), 0) // 67108864 as part, coalesce(sum(length(head) + length(body) + 8) over (partition by conv_id, participant order by k rows between unbounded preceding and 1 preceding), 0) as z from r),
o as (select * replace (dense_rank() over (partition by conv_id, participant order by part) - 1 as part) from b)
select conv_id, part, participant, own_role as role, count(*) as n_turns, cast(sum(case when own then length(body) + 7 else 0 end) as bigint) as n_masked, cast(min(z) as bigint) as start,
       string_agg(head || body || '<|end|>', chr(10) order by k) as text,
       coalesce(string_agg(case when own then cast(z + length(head) as bigint) || '-' || cast(z + length(head) + length(body) + 7 as bigint) end, ',' order by k), '') as mask
from o group by conv_id, part, participant, own_role
"""
