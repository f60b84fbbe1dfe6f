"""Prefilter, noise split, top-N split, dedupe and funnel counts as DataFrame transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates, scores, texts
from ..functions.dialect import SPARK
from ..sources.stages import stage
from .keep import keep_first

MATCH_ORDER = "case lower(coalesce(industry_match, '')) when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 0 end"


def prefilter(signals: DataFrame, blocked_hosts: Sequence[str] = (), supplier: bool = False) -> DataFrame:
    """adds drop_reason; null rows go on to the costly steps."""
    return signals.selectExpr("*", f"{predicates.drop_reason(SPARK, list(blocked_hosts), supplier)} as drop_reason")


def block_hosts(signals: DataFrame, policy: DataFrame) -> DataFrame:
    """without the signals whose host stands in policy(host); a policy table of any size."""
    return signals.selectExpr("*", f"{texts.host(SPARK, 'link')} as _host").join(policy.select(F.col("host").alias("_host")).distinct(), "_host", "left_anti").drop("_host")


def scored(leads: DataFrame) -> DataFrame:
    """Adds noise (why a lead is dropped, or null) and score."""
    out = leads.selectExpr("*", f"{predicates.hard_noise(SPARK)} as noise", f"{predicates.relevance(SPARK, predicates.lead_text(), 'category')} as related")
    return out.selectExpr("*", f"{scores.pre_enrich_score(SPARK, scores.junk_penalty(SPARK, 'noise', 'related'))} as score").drop("related")


def top_split(leads: DataFrame, n: int, job: str = "job_id", least_score: int = 18, least_pool: int = 8) -> DataFrame:
    """Of each job's clean leads the best n go on, the rest is deferred.

    A job with n leads or fewer keeps all, unranked. Else only leads of least_score
    or more are in the pool, unless they are too few; weak leads come after the
    pool, so the split is disjoint. Adds part (top, overflow, kept), enrich_rank
    and, for overflow, confidence.

    Ranks are found without bringing a job into one task: leads are dealt by range
    of (job, order), ranked within their range, and the ranges before are added.
    """
    clean = stage(scored(leads).where("noise is null").selectExpr("*", f"{MATCH_ORDER} as _match"), "scored")
    counted = clean.groupBy(F.col(job).alias("_job")).agg(F.count("*").alias("_n"), F.count_if(F.col("score") >= least_score).alias("_eligible"))
    pooled = clean.join(counted, F.col(job).eqNullSafe(F.col("_job"))).withColumn("_pool", (F.col("_eligible") < min(least_pool, n)) | F.coalesce(F.col("score") >= least_score, F.lit(False)))
    keys = [(~F.col("_pool")).cast("int").alias("_k0"), (-F.col("score")).alias("_k1"), (-F.col("_match")).alias("_k2"), F.lower(F.coalesce("company_name", F.lit(""))).alias("_k3")]
    names = ["_k0", "_k1", "_k2", "_k3", "input_pos"]
    dealt = stage(pooled.select("*", *keys).repartitionByRange(job, *names).withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy(F.col(job).alias("_job2"), F.col("_range").alias("_range2")).agg(F.count("*").alias("_in"))  # a row per range and job in it
    before = sizes.withColumn("_before", F.coalesce(F.sum("_in").over(Window.partitionBy("_job2").orderBy("_range2").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(job, "_range").orderBy(*names))
    ranked = dealt.withColumn("_inside", inside).join(before, F.col(job).eqNullSafe(F.col("_job2")) & (F.col("_range") == F.col("_range2"))).withColumn("_rank", F.col("_inside") + F.col("_before"))
    size = F.when(F.col("_eligible") < min(least_pool, n), F.col("_n")).otherwise(F.col("_eligible"))
    top = F.col("_pool") & (F.col("_rank") <= n)
    rank = F.when(top | (size >= n), F.col("_rank")).otherwise(F.col("_rank") - size + n)
    small = F.col("_n") <= n
    out = ranked.withColumn("part", F.when(small, F.lit("kept")).when(top, F.lit("top")).otherwise(F.lit("overflow"))).withColumn("enrich_rank", F.when(~small, rank).cast("int"))
    return out.withColumn("confidence", F.when(F.col("part") == "overflow", F.expr(scores.overflow_confidence("score")))).select(*leads.columns, "noise", "score", "part", "enrich_rank", "confidence")


def dedupe(leads: DataFrame, country: str, strict: bool = False) -> DataFrame:
    """One lead per canonical name and job country: with an inference first, then with a contact, then the earliest.

    Leads without a name are dropped. The job's country goes into job_country,
    the lead's own stays beside it.
    """
    named = leads.where("coalesce(company_name, '') <> ''").selectExpr("*", f"{texts.canonical_name(SPARK, 'company_name', strict)} as name_canonical", f"upper('{country}') as job_country")
    order = [F.col("confidence_tier").isNotNull().desc(), F.expr(predicates.contact_filled()).desc(), F.col("input_pos")]
    return keep_first(named, ["name_canonical", "job_country"], order)


def reason_report(df: DataFrame, reason: str) -> DataFrame:
    """Rows per reason and in all (reason null, total true), with the share of all."""
    counts = df.withColumn("_r", F.coalesce(F.col(reason), F.lit("-"))).groupBy("_r").agg(F.count("*").alias("n"))
    both = counts.rollup("_r").agg(F.sum("n").alias("n"), F.grouping("_r").alias("g"))
    share = F.round(F.col("n") / F.max("n").over(Window.partitionBy()), 4)
    return both.select(F.col("_r").alias("reason"), (F.col("g") == 1).alias("total"), "n", share.alias("share"))
