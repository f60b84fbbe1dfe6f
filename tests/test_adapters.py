"""The adapter search on recorded answers, results written by hand."""

import datetime as dt

from pyspark.sql import functions as F

from leadloom.operators import adapters as A

NOW = dt.datetime(2024, 3, 1)


def adapter(spark, name, answers, **own):
    rows = [(k, None if h is None else [(f"t{i}", f"https://{name}/{i}") for i in range(h)], NOW) for k, h in answers.items() if h is not None]
    return A.Adapter(name, A.recorded(spark.createDataFrame(rows, f"key string, hits {A.HITS}, asked_at timestamp")), **own)


def run(spark, keys, adapters, **own):
    queries = spark.createDataFrame([(k, f"query {k}") for k in keys], "key string, query string")
    results, log = A.search(queries, adapters, **own)
    return {r.key: r for r in results.collect()}, sorted((r.key, r.adapter, r.n_hits) for r in log.where("n_hits is not null").collect()), log.count()


def test_first_hit_in_order_of_cost(spark):
    cheap = adapter(spark, "cheap", {"a": 2, "b": 0})
    dear = adapter(spark, "dear", {"a": 1, "b": 3, "c": 0}, cost=5.0)
    off = adapter(spark, "off", {"a": 9}, available=False)
    got, log, calls = run(spark, "abcd", [dear, off, cheap])
    assert [(got[k].ok, got[k].adapter, len(got[k].hits), got[k].cost, got[k].tried, got[k].zero_results, got[k].reason) for k in "abcd"] == [
        (True, "cheap", 2, 0.0, ["cheap"], False, None), (True, "dear", 3, 5.0, ["cheap", "dear"], False, None), (True, None, 0, 5.0, ["cheap", "dear"], True, "zero_results"),
        (False, None, 0, 5.0, ["cheap", "dear"], False, "all_adapters_failed:cheap,dear"),
    ]
    assert log == [("a", "cheap", 2), ("b", "cheap", 0), ("b", "dear", 3), ("c", "dear", 0)] and calls == 7
    assert got["b"].hits[0].link == "https://dear/0"


def test_budget_and_nobody_there(spark):
    one, two = adapter(spark, "one", {"a": 0}, cost=1.0), adapter(spark, "two", {"a": 4}, cost=2.0)
    got, _, _ = run(spark, "a", [two, one], budget=2.5)
    assert (got["a"].tried, got["a"].cost, got["a"].reason) == (["one"], 1.0, "zero_results")
    got, _, _ = run(spark, "a", [two, one], budget=0.5)
    assert (got["a"].ok, got["a"].tried, got["a"].reason) == (False, [], "no_available_adapter")


def test_order_by_expected_cost(spark):
    a, b, c, d = (adapter(spark, n, {}, cost=x) for n, x in (("a", 1.0), ("b", 2.0), ("c", 0.0), ("d", 1.0)))
    assert [x.id for x in A.in_order([a, b, c, d], {"a": (4, 1), "b": (4, 0), "c": (1, 0)})] == ["c", "d", "a", "b"]
    log = spark.createDataFrame([("a", 1), ("a", 0), ("a", None), ("b", 3)], "adapter string, n_hits int")
    assert A.stats_of(log) == {"a": (3, 1), "b": (1, 1)}


def test_the_cached_adapter_comes_first(spark):
    log = spark.createDataFrame([("a", "dear", 3, NOW - dt.timedelta(minutes=5)), ("a", "cheap", 0, NOW), ("b", "dear", 1, NOW - dt.timedelta(minutes=50)), ("c", "gone", 1, NOW), ("d", "dear", 1, NOW), ("e", "dear", 2, NOW)], "key string, adapter string, n_hits int, at timestamp")
    cached = A.cached_adapters(log, F.lit(NOW))
    assert {(r.key, r.adapter) for r in cached.collect()} == {("a", "dear"), ("c", "gone"), ("d", "dear"), ("e", "dear")}
    cheap, dear = adapter(spark, "cheap", {"a": 1, "b": 1, "c": 1, "d": 1}), adapter(spark, "dear", {"a": 2, "d": 0}, cost=5.0)
    got, _, _ = run(spark, "abcde", [cheap, dear], cached=cached)
    seen = {k: (r.adapter, r.tried, r.cost, r.cache_hit) for k, r in got.items()}
    assert seen == {"a": ("dear", ["dear"], 5.0, True), "b": ("cheap", ["cheap"], 0.0, False), "c": ("cheap", ["cheap"], 0.0, False), "d": ("cheap", ["dear", "cheap"], 5.0, False), "e": (None, ["dear", "cheap"], 5.0, False)}
    assert got["e"].reason == "all_adapters_failed:dear,cheap"
