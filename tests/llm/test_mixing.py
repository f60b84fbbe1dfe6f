import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from leadloom.llm import mixing as X

from .. import oracle
from . import frames


def fill(sizes, weights, cap=3):
    """Targets by sharing the excess again and again."""
    total, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(target[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > cap * sizes[i]]
        if not over:
            return [share.get(i, t) for i, t in enumerate(target)]
        for i in over:
            target[i] = cap * sizes[i]
            open_.discard(i)
    return target


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 1000, 5, 0], [0, 0], [7], [1, 2, 4, 8, 16, 1000, 3]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", n, i % 3 + 1) for i, n in enumerate(sizes)]
    got = {r.source: r.target for r in X.water_fill(spark.createDataFrame(rows, "source string, source_size long, weight long")).collect()}
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(fill(sizes, [i % 3 + 1 for i in range(len(sizes))]))


def test_words_taken_come_near_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = X.pareto_mix(docs).cache()
    assert mixed.where("taken > 3 * size or taken < 0").count() == 0
    off = mixed.groupBy("source").agg(F.abs(F.sum("taken") / F.first("target") - 1).alias("off")).agg(F.max("off"), F.avg("off")).first()
    assert off[0] < 0.05 and off[1] < 0.01
    again = X.pareto_mix(docs.repartition(7))
    assert mixed.select("doc_id", "taken").exceptAll(again.select("doc_id", "taken")).count() == 0


def test_inclusion_follows_the_preference(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    plain = X.pareto_mix(docs).where("source = 'b'").agg(F.avg("copies"), F.first("target") / F.first("source_size")).first()
    assert plain[0] == pytest.approx(plain[1], abs=0.01)
    tilted = X.pareto_mix(docs, preference=F.when(F.col("doc_id") % 2 == 0, 0.9).otherwise(0.3)).where("source = 'b'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("copies").alias("c"), F.avg("expected").alias("e"))
    c = {r.odd: (r.c, r.e) for r in tilted.collect()}
    assert c[0][1] == pytest.approx(3 * c[1][1], rel=0.01)
    for copies, expected in c.values():
        assert copies == pytest.approx(expected, abs=0.035)  # three standard errors


def test_inclusion_frequencies_are_the_probabilities(spark):
    """300 sources hold the same sizes under other ids, so each is another draw of one sample."""
    kinds = [(n, max(1, int(n * share))) for n in (2, 5, 9, 14, 30, 70, 130, 310) for share in (0.3, 0.6, 1.0) for _ in range(3)]
    rows = [(1000 * s + k, " ".join(f"w{j % d}" for j in range(n)), f"s{s:03}") for s in range(300) for k, (n, d) in enumerate(kinds)]
    got = X.pareto_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    got["pi"] = got.expected - np.floor(got.expected + 1e-9)
    got["off"] = got.copies - got.expected
    assert (got.off.abs() < 1).all()
    long, diverse = got["size"] > 20, got.doc_id % 1000 % 9 >= 6
    for weight in range(3):
        for a in (long, ~long):
            for b in (diverse, ~diverse):
                part = got[a & b & (got.source.str[1:].astype(int) % 3 == weight)]
                assert abs(part.off.sum()) <= 3 * np.sqrt((part.pi * (1 - part.pi)).sum()) + 1e-9
    off = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (off.taken / off.target - 1).abs().max() < 0.05


def test_sample_sizes_are_fixed(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.sequence(F.lit(1), F.col("id") % 40 + 1)).alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    sums = X.pareto_mix(docs).groupBy("source").agg(F.sum("copies").alias("n"), F.sum("expected").alias("e")).collect()
    assert all(abs(r.n - r.e) < 25 for r in sums)


def test_many_sources_are_ranked_by_ranges(spark):
    names = spark.range(1000).select(F.format_string("n%04d", F.col("id")).alias("source")).union(spark.createDataFrame([(None,)], "source string"))
    got = {r.source: r.weight for r in X.cycling_weights(names.repartition(5)).collect()}
    assert got == {**{f"n{i:04}": i % 3 + 1 for i in range(1000)}, None: 1000 % 3 + 1}


def test_against_sql_on_awkward_tables(spark, tmp_path):
    rows = [(i % 90 if i % 11 else None, None if i % 13 == 0 else " ".join(f"w{j % (i % 7 + 1)}" for j in range(i % 37)), None if i % 10 == 0 else "ab"[i % 2]) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    oracle.assert_same(X.op9_pareto_mix(spark, str(tmp_path)), con, X.OP9_SQL)


def test_sources_without_words(spark):
    rows = [(1, None, "z"), (2, " ", "z"), (3, "a b c", "y"), (4, "", None)]
    got = X.pareto_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in got} == {1: (0, 0, 0.0, 0), 2: (0, 0, 0.0, 0), 3: (3, 3, 3.0, 3), 4: (0, 0, 0.0, 0)}
    none = X.pareto_mix(spark.createDataFrame(rows[:2], "doc_id long, text string, source string")).collect()
    assert {r.taken for r in none} == {0}


def test_awkward_rows(spark):
    got = X.pareto_mix(frames.awkward(spark)).collect()
    assert len(got) == 8 and {r.taken for r in got if r.size == 0} == {0}
    assert {r.source for r in got} == {None, "s", "t"}
    assert X.pareto_mix(frames.empty(spark)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = X.pareto_mix(frames.awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
