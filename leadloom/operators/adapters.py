"""Search adapters: a contract for sources that answer queries, and the search over them.

An adapter is a name, a cost of a call, whether it can be called, and a function from a table of queries (key, query)
to a table of answers (key, hits): an array of hits, empty if there are none; a key without an
answer is a failed call. So an adapter answers all its queries in one job: a table of recorded results,
a Python data source, or any other transform.

``search`` asks the adapters in the order of their expected cost of a hit. Each is asked only for the
queries that nobody has answered yet and that can pay for it, by an anti-join, so a call is made once for a query; the adapter that answered a key
the last time comes first for it, while that is no older than the TTL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import stage
from .keep import keep_first
from .outputs import RATE_FLOOR, RATE_PRIOR

HITS = "array<struct<title:string,link:string>>"


@dataclass(frozen=True)
class Adapter:
    id: str
    fetch: Callable[[DataFrame], DataFrame]
    cost: float = 0.0
    available: bool = True
    method: str = "api"


def recorded(answers: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A fetch function over recorded answers of (key, hits, asked_at): the latest answer of a key counts."""
    last = keep_first(answers, ["key"], [F.col("asked_at").desc_nulls_last()]).select(F.col("key").alias("_key"), "hits")
    return lambda queries: queries.join(last, F.col("key") == F.col("_key")).select("key", "hits")


def in_order(adapters: Sequence[Adapter], stats: dict[str, tuple[int, int]]) -> list[Adapter]:
    """By the expected cost of a hit. stats: attempts and hits by id; an untried adapter counts with a rate of 0.5, others with 0.05 at least, a free one costs nothing. Equal ones stay as listed."""

    def expected(a: Adapter) -> float:
        attempts, hits = stats.get(a.id, (0, 0))
        return 0.0 if a.cost <= 0 else a.cost / (max(hits / attempts, RATE_FLOOR) if attempts else RATE_PRIOR)

    return sorted(adapters, key=expected)


def stats_of(log: DataFrame) -> dict[str, tuple[int, int]]:
    """Attempts and hits by adapter of an attempt log (adapter, n_hits): a row per adapter."""
    rows = log.groupBy("adapter").agg(F.count("*").alias("n"), F.count_if(F.col("n_hits") > 0).alias("hits")).collect()
    return {r["adapter"]: (r["n"], r["hits"]) for r in rows}


def cached_adapters(log: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """(key, adapter) that last answered each key of a log (key, adapter, n_hits, at) with hits, if not longer ago than the TTL."""
    hits = log.where("n_hits > 0").groupBy("key").agg(F.max_by("adapter", F.struct("at", "adapter")).alias("adapter"), F.max("at").alias("at"))
    return hits.where(F.col("at") >= now - F.make_interval(mins=F.lit(minutes))).select("key", "adapter")


def search(queries: DataFrame, adapters: Sequence[Adapter], stats: dict[str, tuple[int, int]] | None = None, cached: DataFrame | None = None, budget: float = float("inf")) -> tuple[DataFrame, DataFrame]:
    """(results, attempts) for queries of (key, query), each key once.

    results: key, ok, adapter, hits, cost, tried (in order), zero_results, cache_hit and reason (null with
    hits; zero_results, no_available_adapter, or all_adapters_failed with those tried). attempts: key, adapter, n_hits (null for a failed call), cost. An adapter that isn't available or that the query can't pay for any more is left out.
    """
    spark: SparkSession = queries.sparkSession
    ordered = [a for a in in_order(adapters, stats or {}) if a.available]
    first = queries.sparkSession.createDataFrame([], f"_key {queries.schema['key'].dataType.simpleString()}, _cached string") if cached is None else cached.select(F.col("key").alias("_key"), F.col("adapter").alias("_cached"))
    known = F.when(F.col("_cached").isin(*(a.id for a in adapters)), F.col("_cached"))
    empty = F.array().cast("array<string>")
    state = queries.join(first, F.col("key") == F.col("_key"), "left").select("key", "query", known.alias("_cached"), F.lit(None).cast("string").alias("adapter"), F.lit(None).cast(HITS).alias("hits"), F.lit(0.0).alias("cost"), empty.alias("tried"), F.lit(False).alias("zero"), F.lit(False).alias("from_cache"))
    state = stage(state, "search")
    calls = [(a, True) for a in ordered] * (cached is not None) + [(a, False) for a in ordered]
    log = spark.createDataFrame([], f"key {queries.schema['key'].dataType.simpleString()}, adapter string, n_hits int, cost double")
    for a, from_cache in calls:
        mine = F.col("_cached").eqNullSafe(a.id)
        asked = F.col("adapter").isNull() & (F.col("cost") + a.cost <= budget) & (mine if from_cache else ~F.array_contains("tried", a.id))
        open_ = state.where(asked).select("key", "query")
        got = a.fetch(open_).select(F.col("key").alias("_key"), F.col("hits").cast(HITS).alias("_hits"), F.lit(True).alias("_answered"))
        joined = state.withColumn("_asked", asked).join(got, F.col("_asked") & (F.col("key") == F.col("_key")), "left")
        n = F.when(F.col("_answered"), F.size("_hits"))
        hit, zero = F.coalesce(n > 0, F.lit(False)), F.coalesce(n == 0, F.lit(False))
        state = stage(
            joined.select(
                "key", "query", "_cached", F.when(hit, a.id).otherwise(F.col("adapter")).alias("adapter"), F.when(hit, F.col("_hits")).otherwise(F.col("hits")).alias("hits"), (F.col("cost") + F.when(F.col("_asked"), a.cost).otherwise(0.0)).alias("cost"),
                F.when(F.col("_asked"), F.array_append("tried", F.lit(a.id))).otherwise(F.col("tried")).alias("tried"), (F.col("zero") | zero).alias("zero"), (F.col("from_cache") | (F.lit(from_cache) & (hit | zero))).alias("from_cache"), F.when(F.col("_asked"), F.coalesce(n, F.lit(-1))).alias("_n"),
            ),
            "search",
        )
        log = log.unionByName(state.where("_n is not null").select("key", F.lit(a.id).alias("adapter"), F.when(F.col("_n") >= 0, F.col("_n")).alias("n_hits"), F.lit(float(a.cost)).alias("cost")))
        state = state.drop("_n")
    found = F.col("adapter").isNotNull()
    # a cached adapter without hits is no cache hit once another one has answered
    by_cache = F.when(found, F.col("adapter").eqNullSafe(F.col("_cached")) & F.col("from_cache")).otherwise(F.col("from_cache"))
    reason = F.when(found, F.lit(None)).when(F.col("zero"), "zero_results").when(F.size("tried") == 0, "no_available_adapter").otherwise(F.concat(F.lit("all_adapters_failed:"), F.array_join("tried", ",")))
    results = state.select("key", (found | F.col("zero")).alias("ok"), "adapter", F.coalesce("hits", F.array().cast(HITS)).alias("hits"), "cost", "tried", (~found & F.col("zero")).alias("zero_results"), by_cache.alias("cache_hit"), reason.alias("reason"))
    return results, log
