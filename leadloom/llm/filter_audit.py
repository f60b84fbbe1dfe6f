"""Filter interaction audit: what each filter removes in every order, from the Hart-Mas-Colell potential.

Filters that fail a document play a removal game: a coalition S of filters is worth

    v(S) = documents that at least one filter of S fails.

Its potential P, with P() = 0, is found recursively over the 2^n coalitions,

    P(S) = (v(S) + sum over i in S of P(S without i)) / |S|,

and the Shapley value of filter i is P(all) - P(all without i). The values are
multiplied by n!, so all of them are whole numbers, and the product is what the
filter removes summed over all n! orders. What one order's step removes is a
difference of coalitions, v(S with i) - v(S); the same holds for the good and the
toxic documents among them.

Documents are counted per part and set of failing filters (``audit`` takes such
cells, weighted), coalitions are sums of those counts: at most 4^n small rows a part,
whatever the number of documents. The orders multiply the result's rows alone.

Whether a text repeats one of a smaller id is found by its SHA-256: rows of one id
and text are added up, then those of one text, source and label, before the copies
of a text meet; of a text there are then at most four rows a source, however
often it is repeated. An id that holds many rows is split by adaptive execution's skew join, as
is the null id, which has no label.

Defined cases: a null text is an empty one. A null id is smaller than none and has no
smaller one, so it never fails the duplicate filter. Rows of one id and text are no
duplicates of each other; each counts. Several labels of one id: any that is 1
counts. A null source and an empty one are the same part, ''. An empty
table gives an empty result. Other columns of the documents play no part.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

WORD = r"[^\x20\x09-\x0D]+"
FILTERS = "ABCDE"


def base_failures(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides: short, repetitive, capitals, symbols."""
    ws = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": F.size(ws) < 50, "B": F.size(F.array_distinct(ws)) * 100 < F.size(ws) * 65, "C": capitals * 100 > F.length(text) * 5, "D": text.rlike(r"[#$%&*|]")}


def cells(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", good_col: str = "quality", toxic_col: str = "toxic", failures=base_failures) -> DataFrame:
    """(part, fails, good, toxic, n): documents by part, mask of failing filters and labels.

    The filters of ``failures``, by the order of their names, have the lowest bits; the next one is for
    texts identical to that of a smaller id.
    """
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    conditions = [c for _, c in sorted(failures(F.col("text")).items())]
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)), F.lit(0))
    rows = text.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("base")).groupBy("id", "part", "digest", "base").agg(F.count("*").alias("n"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(*(F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False)).alias(a) for c, a in ((good_col, "good"), (toxic_col, "toxic"))))
    marked = rows.join(marks, rows["id"] == marks["_id"], "left").select("id", "part", "digest", "base", "n", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")))
    known = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    copies = marked.groupBy("digest", "part", "base", "good", "toxic").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("free"), F.min(known).alias("first"))
    smallest = F.min("first.id").over(Window.partitionBy("digest"))  # at most four rows a part
    stay = F.col("free") + F.when(F.col("first.id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    split = copies.withColumn("smallest", smallest).select("part", "base", "good", "toxic", F.posexplode(F.array(stay, F.col("n") - stay)).alias("copy", "n"))
    return split.where("n > 0").groupBy("part", (F.col("base") + F.col("copy") * (1 << len(conditions))).alias("fails"), "good", "toxic").agg(F.sum("n").alias("n"))


def coalitions(counted: DataFrame, n_filters: int) -> DataFrame:
    """Per part: total, and as arrays by coalition (bit k for filter k) what it removes: v of all, good and toxic documents; alone: v by exact mask."""
    size = 1 << n_filters
    figures = F.array("n", *(F.when(F.col(c), F.col("n")).otherwise(0) for c in ("good", "toxic")))
    by_mask = counted.groupBy("part", "fails").agg(*(F.sum(figures[k]).alias(c) for k, c in enumerate(("n", "good", "toxic"))))
    hit = by_mask.select("part", "fails", "n", "good", "toxic", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("coalition"))
    meets = F.col("coalition").bitwiseAND(F.col("fails")) != 0
    sums = hit.groupBy("part", "coalition").agg(F.sum("n").alias("total"), *(F.sum(F.when(meets, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")))
    along = F.sort_array(F.collect_list(F.struct("coalition", "n", "good", "toxic")))  # 2^n of a part
    return sums.groupBy("part").agg(F.max("total").alias("total"), along.alias("v")).select("part", "total", *(F.expr(f"transform(v, x -> x.{c})").alias(f"v_{c}") for c in ("n", "good", "toxic")))


def potential(values: Column, n_filters: int) -> Column:
    """n! times the potential of every coalition, by recursion in the order of their masks: a coalition's parts have smaller ones."""
    bits = F.array(*(F.lit(1 << k) for k in range(n_filters)))

    def step(found: Column, s: Column) -> Column:
        smaller = F.aggregate(F.filter(bits, lambda b: b.bitwiseAND(s) != 0), F.lit(0).cast("long"), lambda acc, b: acc + F.get(found, s.bitwiseXOR(b)))
        return F.concat(found, F.array(F.call_function("div", values[s] * factorial(n_filters) + smaller, F.bit_count(s))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n_filters) - 1)), F.array(F.lit(0).cast("long")), step)


def orders(parts: DataFrame, filters: str) -> DataFrame:
    """Every part in each order of the filters: adds filter_order."""
    letters = F.array(*(F.lit(x) for x in filters))
    out = parts.withColumn("filter_order", F.lit(""))
    for _ in filters:
        rest = F.filter(letters, lambda x: ~F.contains(F.col("filter_order"), x))
        out = out.withColumn("next", F.explode(rest)).withColumn("filter_order", F.concat("filter_order", "next")).drop("next")
    return out


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The report on cells of (part, fails, good, toxic, n): a row per part, order of the filters (bit k for the k-th letter) and step."""
    n, whole = len(filters), (1 << len(filters)) - 1
    parts = coalitions(counted, n).withColumn("p", potential(F.col("v_n"), n))
    steps = orders(parts, filters).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))

    def mask(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(filters)), F.lit(0))

    steps = steps.withColumn("before", mask(F.expr("left(filter_order, step - 1)"))).withColumn("bit", mask(F.expr("substr(filter_order, step, 1)"))).withColumn("after", F.col("before") + F.col("bit"))
    rest = F.lit(whole).bitwiseXOR(F.col("bit"))

    def lost(c: str) -> Column:
        return F.get(F.col(c), F.col("after")) - F.get(F.col(c), F.col("before"))

    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.get("v_n", F.col("after"))).alias("kept"), lost("v_n").alias("removed"), (F.get("v_n", F.col("bit")) - lost("v_n")).alias("redundant"),
        (F.get("v_n", F.lit(whole)) - F.get("v_n", rest)).alias("unique_fails"), lost("v_good").alias("good_lost"), lost("v_toxic").alias("toxic_lost"), (F.get("p", F.lit(whole)) - F.get("p", rest)).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


#: Applies the filters in each order, document group by document group; the Shapley values are sums over the orders.
OP11_SQL = rf"""
with recursive t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
w as (select *, regexp_extract_all(text, '{WORD}') as ws, min(doc_id) over (partition by text) as smallest from t),
f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         case when len(ws) < 50 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 'B' else '' end
         || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) then 'C' else '' end
         || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end || case when doc_id > smallest then 'E' else '' end as fails
  from w left join l using (doc_id)),
c as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by part, fails),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (select x as filter_order from x union all select filter_order || x from o join x on not contains(filter_order, x)),
s as (select filter_order, cast(i as int) as step, filter_order[i] as x, filter_order[1:i] as upto, filter_order[1:i-1] as before from o, generate_series(1, 5) g(i) where length(filter_order) = 5),
r as (
  select part, filter_order, step, x,
         coalesce(sum(n) filter (translate(fails, upto, '') = fails), 0) as kept,
         coalesce(sum(n) filter (contains(fails, x) and translate(fails, before, '') = fails), 0) as removed,
         coalesce(sum(n) filter (contains(fails, x) and translate(fails, before, '') <> fails), 0) as redundant,
         coalesce(sum(n) filter (fails = x), 0) as unique_fails,
         coalesce(sum(good) filter (contains(fails, x) and translate(fails, before, '') = fails), 0) as good_lost,
         coalesce(sum(toxic) filter (contains(fails, x) and translate(fails, before, '') = fails), 0) as toxic_lost
  from c, s group by part, filter_order, step, x)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, x) as bigint) as shapley
from r
"""
