"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Each source gets a target T in words (``water_fill``), and each of its documents a
number of expected copies

    e = min(cap, lambda * preference),    sum of e * size = T,

with one lambda per source. The preference is a share in (0, 1]; by default that of
distinct words among the document's words, so repetitive text is taken less often.
floor(e) copies are certain. The rest pi = e - floor(e) is the document's inclusion
probability in a sample without replacement: with U uniform on (0, 1), documents are
ranked by

    q = (U / (1 - U)) / (pi / (1 - pi))

and the first n are drawn, n = sum of pi (Pareto order sampling, Rosen, 1997).

Words, not documents, are to meet the target, and sizes differ by orders of
magnitude. So a source is ranked by size class (four to an octave), and every
class has a fixed sample size that is set before anything is drawn: its sum of pi,
rounded up with the probability of the fraction, after the words that rounding left
in the classes of longer texts have been passed on to it. Its expectation is the sum of
pi, and what a source takes differs from its target by little more than the spread
of sizes inside a class.

No group grows with a source: ranks are dealt into bins, coarse bins are counted, then
the bins of the coarse one in which the sample ends, and only the documents of the one
bin in which it ends are ordered (one in ``BINS`` of the class). Sums are of integers, so reruns agree.

Defined cases: a null text has no words; such documents are never taken, and a
source without words has the target 0. A null source is a source of its own, the
last. Every row is a document of its own, repeated rows included. U is a digest of
the id (without one, of the text) and ``seed``; ties are ordered by id and size. A
null preference counts as the least one. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, hot_join, live_cuts, table, tidy

#: Bins of the ranking per source and size class, and how many of them are a coarse one.
BINS, FINE = 16384, 128
#: Preferences are taken in steps of one in so many.
STEPS = 1024
#: Probabilities are added up in units of one in so many.
UNITS = 1 << 30
WORD = r"[^\x20\x09-\x0D]+"


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) that depends only on the key and the seed."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def cycling_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Adds weight: 1, 2, .. cycle, repeating, over the sources by code point, null last.

    Sources are dealt by range of their names, so a table of many isn't ordered in one task.
    """
    ranged = cut(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy(F.col("range").alias("_range")).agg(F.count("*").alias("n"))  # a row per partition
    before = sizes.select("_range", F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    at = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = ranged.withColumn("at", at).join(F.broadcast(before), F.col("range") == F.col("_range"))
    return ranked.select(*sources.columns, ((F.col("at") + F.col("before")) % cycle + 1).cast("long").alias("weight"))


def water_fill(sources: DataFrame, cap: int = 3) -> DataFrame:
    """Adds target to rows of (source, source_size, weight): shares by weight of all sizes, at most cap * source_size.

    What capped sources leave is shared by weight among the others, again and again
    until none is above its cap. Each step adds up the table's sources anew.
    """
    level, capped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("weight") > (F.col("source_size") * cap).cast("double")
        own = F.sum(F.when(over, F.col("source_size") * cap).otherwise(0))
        total, held, weights, n = sources.agg(F.sum("source_size"), own, F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.count_if(over)).first()
        if n == capped or not weights:
            break
        level, capped = float(total - held) / float(weights), n
    return sources.withColumn("target", F.least((F.col("source_size") * cap).cast("double"), F.lit(level) * F.col("weight")))


def _plan(sized: DataFrame, weights, cap: int) -> DataFrame:
    """Per source: n_docs, source_size, target and rate, the lambda of its preferences.

    With the preferences in falling order, the rate that follows from capping the
    first k rises while documents are above the cap and then falls, so the rate
    sought is the largest.
    """
    sources = cut(water_fill(cut(weights(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")))), cap))
    steps = sized.groupBy(F.col("source").alias("_source"), "step").agg(F.sum("size").alias("words"))  # STEPS rows a source at most
    joined = steps.join(sources.select("source", "target"), F.col("_source").eqNullSafe(F.col("source")))
    w = Window.partitionBy("_source").orderBy(F.desc("step"))
    before = F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * cap
    rest = F.sum(F.col("words") * F.col("step")).over(w.rowsBetween(0, Window.unboundedFollowing))
    rates = joined.select("_source", F.try_divide(F.col("target") - before, rest.cast("double")).alias("r")).groupBy("_source").agg(F.coalesce(F.max("r"), F.lit(0.0)).alias("rate"))
    return sources.join(rates, F.col("source").eqNullSafe(F.col("_source"))).select("source", "source_size", "n_docs", "target", "rate")


def size_class(size: Column) -> Column:
    """Four classes to an octave, from the leading bits of the size."""
    four = size * 4
    bits = F.length(F.bin(four))
    return (bits * 4 + F.call_function("shiftright", four, bits - 3) % 4).cast("int")


def _quotas(state: DataFrame, seed: str) -> DataFrame:
    """(source, class, quota): how many documents of each size class are drawn, from long texts to short ones."""
    share = F.sum(F.col("units").cast("decimal(20,0)")).cast("double") / UNITS
    words = F.sum(F.col("units").cast("decimal(20,0)") * F.col("size")).cast("double") / UNITS
    sums = state.where("units > 0").groupBy("source", "class").agg(share.alias("share"), words.alias("words"), F.count("*").alias("most"))
    one = F.struct("class", "share", "words", "most", uniform(F.concat_ws("/", F.coalesce("source", F.lit("")), F.col("class").cast("string")), seed).alias("u"))
    along = sums.groupBy("source").agg(F.sort_array(F.collect_list(one), asc=False).alias("classes"))  # a few classes a source
    start = F.struct(F.lit(0.0).alias("left"), F.array().cast("array<struct<class:int,quota:bigint,most:bigint>>").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        mean = c["words"] / c["share"]
        n = F.greatest(F.lit(0), F.least(c["most"], F.floor(c["share"] + acc["left"] / mean + c["u"])))
        own = F.array(F.struct(c["class"].alias("class"), n.cast("long").alias("quota"), c["most"].alias("most")))
        return F.struct((acc["left"] + c["words"] - n * mean).alias("left"), F.concat(acc["out"], own).alias("out"))

    return along.select("source", F.explode(F.aggregate("classes", start, step)["out"]).alias("q")).select("source", "q.class", "q.quota", "q.most")


def _ends(bins: DataFrame) -> DataFrame:
    """(source, class, last_bin, need, most) from rows of (source, class, bin, n, quota, most): the bin in which the first quota documents end, and how many of it they take."""
    upto = bins.withColumn("upto", F.sum("n").over(Window.partitionBy("source", "class").orderBy("bin")))
    return upto.where("upto - n < quota and upto >= quota").select("source", "class", F.col("bin").alias("last_bin"), (F.col("quota") - F.col("upto") + F.col("n")).cast("long").alias("need"), "most")


def pareto_mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", preference: Column | None = None, cap: int = 3, seed: str = "mix", weights=cycling_weights) -> DataFrame:
    """Per document row: id, source, size, source_size, target, expected (copies), copies and taken (copies * size).

    ``weights`` adds the column weight to a frame of (source, source_size, n_docs).
    """
    since = live_cuts()
    ws = F.coalesce(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))
    size = F.size("ws").cast("long")
    step = F.expr(f"({STEPS} * size(array_distinct(ws)) + size - 1) div size") if preference is None else F.coalesce(F.ceil(F.col("prefer") * STEPS), F.lit(1))
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), uniform(key, seed).alias("u"), ws.alias("ws"), (F.lit(1.0) if preference is None else preference.cast("double")).alias("prefer")).withColumn("size", size)
    sized = cut(rows.select("id", "source", "u", "size", F.when(F.col("size") > 0, F.greatest(F.lit(1), F.least(F.lit(STEPS), step))).otherwise(1).cast("int").alias("step")))
    total = sized.count()

    expected = F.least(F.lit(float(cap)), F.col("rate") * F.col("step"))
    planned = hot_join(sized, _plan(sized, weights, cap), ["source"], "n_docs", total).withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(0.0))
    planned = planned.withColumn("whole", F.floor(F.col("expected") + 1e-9).cast("long"))
    planned = planned.withColumn("units", F.greatest(F.lit(0), F.round((F.col("expected") - F.col("whole")) * UNITS).cast("long")))
    pi = F.col("units") / UNITS
    odds = pi / (1 - pi)
    # q / (1 + q) = U / (U + odds * (1 - U)) keeps the order of q and lies in (0, 1]
    planned = planned.withColumn("rank", F.col("u") / (F.col("u") + odds * (1 - F.col("u")))).withColumn("class", size_class(F.col("size")))
    state = cut(planned.select("id", "source", "size", "source_size", "target", "expected", "whole", "units", "class", "rank", F.floor(F.col("rank") * BINS).cast("int").alias("bin")))

    quotas = _quotas(state, seed).select(F.col("source").alias("_source"), F.col("class").alias("_class"), "quota", "most")
    drawable = state.where("units > 0")
    coarse = drawable.groupBy("source", "class", F.expr(f"bin div {FINE}").alias("bin")).agg(F.count("*").alias("n"))
    first = _ends(coarse.join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("class") == F.col("_class")))).withColumnRenamed("need", "quota")
    inside = hot_join(drawable.select("source", "class", "bin"), first.withColumnRenamed("last_bin", "_coarse"), ["source", "class"], "most", total).where(f"bin div {FINE} = _coarse")
    fine = inside.groupBy("source", "class", "bin").agg(F.count("*").alias("n"), F.first("quota").alias("quota"), F.first("most").alias("most"))
    ends = _ends(fine)
    at_end = hot_join(state, ends, ["source", "class"], "most", total, "left")
    tidy(docs.sparkSession, since, state, at_end)
    split = F.coalesce((F.col("units") > 0) & (F.col("bin") == F.col("last_bin")), F.lit(False))
    clear = at_end.where(~split).withColumn("drawn", F.coalesce((F.col("units") > 0) & (F.col("bin") < F.col("last_bin")), F.lit(False)))
    order = Window.partitionBy("source", "class").orderBy("rank", "id", "size")
    close = at_end.where(split).withColumn("drawn", F.row_number().over(order) <= F.col("need"))
    copies = F.col("whole") + F.col("drawn").cast("long")
    return clear.unionByName(close).select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "expected", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix(table(spark, sf_dir, "documents")).drop("expected")


OP9_SQL = rf"""
with recursive words as (
  select doc_id, source, coalesce(regexp_extract_all(text, '{WORD}'), []) as ws, coalesce(cast(doc_id as varchar), md5(coalesce(text, ''))) as id from documents),
sized as (
  select doc_id, source, cast(len(ws) as bigint) as size, case when len(ws) > 0 then (1024 * len(list_distinct(ws)) + len(ws) - 1) // len(ws) else 1 end as step,
         (cast(cast('0x' || substr(md5(id || ':mix'), 1, 13) as bigint) as double) + 0.5) / 4503599627370496.0 as u
  from words),
s as (
  select source, cast(sum(size) as bigint) as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from sized group by source),
l as (
  select *, cast(sum(source_size) over () - coalesce(sum(source_size * 3) over (order by source_size * 3 / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as double)
       / cast(sum(weight) over (order by source_size * 3 / weight, source nulls last rows between current row and unbounded following) as double) as level from s),
t as (select source, source_size, least(cast(source_size * 3 as double), max(level) over () * weight) as target from l),
st as (select source, step, sum(size) as words from sized group by source, step),
r as (
  select st.source, coalesce(max(case when rest > 0 then (target - before) / cast(rest as double) end), 0.0) as rate from (
    select *, coalesce(sum(words) over (partition by source order by step desc rows between unbounded preceding and 1 preceding), 0) * 3 as before,
           sum(words * step) over (partition by source order by step desc rows between current row and unbounded following) as rest from st) st
  join t on st.source is not distinct from t.source group by st.source),
e as (
  select sized.*, source_size, target, case when size > 0 then least(3.0::double, rate * step) else 0.0::double end as expected
  from sized join t on sized.source is not distinct from t.source join r on sized.source is not distinct from r.source),
p as (select *, cast(floor(expected + 1e-9::double) as bigint) as whole from e),
q as (
  select *, greatest(0, cast(round((expected - whole) * 1073741824::double) as bigint)) as units,
         length(bin(size * 4)) * 4 + ((size * 4) >> greatest(0, length(bin(size * 4)) - 3)) % 4 as class from p),
k as (select *, u / (u + (units / 1073741824::double) / (1 - units / 1073741824::double) * (1 - u)) as rank from q),
c as (
  select source, class, cast(sum(units) as double) / 1073741824::double as share, cast(sum(cast(units as hugeint) * size) as double) / 1073741824::double as words, count(*) as most,
         (cast(cast('0x' || substr(md5(coalesce(source, '') || '/' || class || ':mix'), 1, 13) as bigint) as double) + 0.5) / 4503599627370496.0 as v,
         row_number() over (partition by source order by class desc) as i
  from k where units > 0 group by source, class),
f as (
  select *, greatest(0, least(most, floor(share + 0.0::double / (words / share) + v))) as quota, 0.0::double as carried from c where i = 1
  union all
  select c.*, greatest(0, least(c.most, floor(c.share + (f.carried + f.words - f.quota * (f.words / f.share)) / (c.words / c.share) + c.v))) as quota, f.carried + f.words - f.quota * (f.words / f.share) as carried
  from f join c on c.source is not distinct from f.source and c.i = f.i + 1),
d as (select *, case when units > 0 then row_number() over (partition by source, class, units > 0 order by rank, doc_id nulls first, size) end as place from k)
select doc_id, d.source, size, source_size, target, whole + cast(coalesce(place <= quota, false) as bigint) as copies, (whole + cast(coalesce(place <= quota, false) as bigint)) * size as taken
from d left join f on d.source is not distinct from f.source and d.class = f.class
"""
