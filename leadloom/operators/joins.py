"""Joins of the lead pipeline: positional, dictionary, TTL cache, incremental, theta with a small side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keep import keep_first


def positional(batches: DataFrame, results: DataFrame, how: str = "inner") -> DataFrame:
    """Row i of a batch with result i of the batch's result array; results(batch_id, results array<struct>)."""
    flat = results.select("batch_id", F.posexplode("results").alias("pos", "r")).where("r is not null")
    return batches.join(flat, ["batch_id", "pos"], how)


def with_cache(rows: DataFrame, cache: DataFrame, key: str, now: Column, ttl_days: int = 30) -> DataFrame:
    """Cached values of the key, if not older than the TTL; cache has one row per key with cached_at."""
    fresh = cache.where(F.col("cached_at") >= now - F.make_interval(days=F.lit(ttl_days)))
    return rows.join(fresh, key, "left")


def first_match(left: DataFrame, rules: DataFrame, condition: Column, key: list[str], order: list[Column]) -> DataFrame:
    """The first rule (by order) that holds for each row; rules is a dictionary table, so it is the small side."""
    return keep_first(left.join(rules, condition, "left"), key, order)


def incremental(mapping: DataFrame, parents: DataFrame, key: str = "company_id") -> tuple[DataFrame, DataFrame]:
    """(rows to write, skipped count): mapping rows whose company the parent job doesn't have yet."""
    seen = parents.select(key).distinct()
    return mapping.join(seen, key, "left_anti"), mapping.join(seen, key, "left_semi").agg(F.count("*").alias("incremental_skipped"))


def scoped_policies(jobs: DataFrame, policies: DataFrame) -> DataFrame:
    """Policies of a job; a null country or category of a policy stands for any.

    Every job is asked for in its four scopes, so both sides meet on equal keys,
    whatever their sizes.
    """
    any_, own = F.lit(None).cast("string"), jobs.columns
    scopes = F.array(*(F.struct(c.alias("country"), k.alias("category")) for c in (F.col("country"), any_) for k in (F.col("category"), any_)))
    asked = jobs.withColumn("_scope", F.explode(F.array_distinct(scopes)))
    hit = asked["_scope.country"].eqNullSafe(policies["p_country"]) & asked["_scope.category"].eqNullSafe(policies["p_category"])
    return asked.join(policies, hit).select(*own, *policies.columns)


def channel_weight(delta: Column, disabled: Column) -> Column:
    """1 + 3 * delta within 0 and 2; 0 where the channel is off."""
    return F.when(disabled, F.lit(0.0)).otherwise(F.least(F.lit(2.0), F.greatest(F.lit(0.0), 1 + 3 * delta)))


def tier_stop(counts: DataFrame, job: str, tier: str, n: str, threshold: int) -> DataFrame:
    """The tiers that are still collected: those before which fewer than threshold rows came in."""
    before = F.coalesce(F.sum(n).over(Window.partitionBy(job).orderBy(tier).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("rows_before", before).withColumn("runs", F.col("rows_before") < threshold)


def waterfall(attempts: DataFrame, key: str, order: list[Column], budget: float) -> DataFrame:
    """Attempts of a key in order until the first hit; unavailable ones are skipped, and those that would overspend.

    The cost counted is that of all available attempts before, and none after the
    one that reaches the budget is tried; ``seeds.adapter_search`` counts what was
    tried alone. Returns a row per key: hit, via, cost, tried.
    """
    live = attempts.where("available")
    w = Window.partitionBy(key).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    spent = live.withColumn("spent", F.coalesce(F.sum("cost").over(before), F.lit(0))).withColumn("hits_before", F.coalesce(F.max(F.col("contacts") > 0).over(before), F.lit(False)))
    tried = spent.where(~F.col("hits_before") & (F.col("spent") + F.col("cost") <= budget))
    hit = F.col("contacts") > 0
    return tried.groupBy(key).agg(F.max(hit).alias("hit"), F.max(F.when(hit, F.col("layer"))).alias("via"), F.sum("cost").alias("cost"), F.count("*").alias("tried"))
