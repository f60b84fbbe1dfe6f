"""What a job leaves behind: persons, funnel steps, notifications, adapters in order (K07, K10, K12, P41, A08, T07), and cleaned fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dialect import Spark

#: Steps in order, the stage that a step stands for, and an adapter's hit rate before it was tried and at least.
STEPS = ["step0", "step1", "step2", "step3", "step4", "step5"]
STAGES = {"step5": "persisting", "step4": "scoring", "step3": "parsing", "step2": "parsing", "step1": "fetching"}
RATE_PRIOR, RATE_FLOOR = 0.5, 0.05
NOT_FOUND = ["não encontrado", "not found", "no se encontró", "error"]


def persons(leads: DataFrame) -> DataFrame:
    """(lead_id, email, phone, linkedin, confidence, tier) of leads with any of the three. The profile is linkedin_url, else source_url; only one that names linkedin is a profile of the first tier. A missing score counts as 60."""
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    linkedin = F.coalesce(filled("linkedin_url"), filled("source_url"))
    points = F.coalesce(F.col("confidence_score").cast("double"), F.lit(60.0))
    rows = leads.select("lead_id", filled("primary_email").alias("email"), filled("primary_phone").alias("phone"), linkedin.alias("linkedin"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), points / 100)).alias("confidence"))
    tier = F.when(F.coalesce(F.contains("linkedin", F.lit("linkedin")), F.lit(False)), "primary_api").otherwise("fallback_search")
    return rows.where("email is not null or phone is not null or linkedin is not null").withColumn("tier", tier)


def step_order(step: Column) -> Column:
    """The place of a step; unknown ones come last."""
    at = F.array_position(F.array(*(F.lit(s) for s in STEPS)), step)
    return F.when(at > 0, at - 1).otherwise(99)


def funnel(last: DataFrame, key: str, step: str, value: str) -> DataFrame:
    """Per key its steps in order as an array of (step, value), and the stage that the furthest step stands for; last: one row per key and step."""
    one = F.struct(step_order(F.col(step)).cast("int").alias("at"), F.col(step).alias("step"), F.col(value).alias("value"))
    arrays = last.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: F.struct(x["step"].alias("step"), x["value"].alias("value"))).alias("steps"))
    held = lambda s: F.exists("steps", lambda x: x["step"] == s)
    stage = F.coalesce(*(F.when(held(s), F.lit(name)) for s, name in STAGES.items()))
    return arrays.withColumn("stage", stage)


def notifications(jobs: DataFrame) -> DataFrame:
    """One unread notice for each finished job of (job_id, requested_by, category, country, n_open) that somebody asked for."""
    done = jobs.where("n_open = 0 and coalesce(requested_by, '') <> ''")
    body = F.concat(F.lit("「"), F.coalesce("category", F.lit("")), F.lit(" / "), F.coalesce("country", F.lit("")), F.lit("」"))
    return done.select(F.col("requested_by").alias("recipient"), F.lit("discovery_complete").alias("type"), F.lit("AI找客任务已完成").alias("title"), body.alias("body"), F.lit("discovery_job").alias("biz_type"), F.col("job_id").alias("biz_id"), F.lit("unread").alias("status"), F.lit("in_app").alias("sent_via"))


def ordered_adapters(adapters: DataFrame, attempts: DataFrame, cached: DataFrame | None = None) -> DataFrame:
    """Adapters (adapter, cost) with attempts, hits, rate (null before any), expected cost of a hit, and their order.

    An untried adapter counts with a rate of 0.5, others with 0.05 at least; a free one expects 0. With
    ``cached`` (key, adapter) every key has its own order, its cached adapter first. Adapters are a dictionary, which the driver
    holds; attempts are added up before they meet it.
    """
    stats = attempts.groupBy(F.col("adapter").alias("_a")).agg(F.count("*").alias("attempts"), F.count_if("hit").alias("hits"))
    known = adapters.join(stats, F.col("adapter") == F.col("_a"), "left").drop("_a").na.fill(0, ["attempts", "hits"])
    rate = F.when(F.col("attempts") > 0, F.col("hits") / F.col("attempts"))
    used = F.when(rate.isNull(), RATE_PRIOR).otherwise(F.greatest(rate, F.lit(RATE_FLOOR)))
    known = known.withColumn("rate", rate).withColumn("expected", F.when(F.col("cost") <= 0, 0.0).otherwise(F.col("cost") / used))
    order = ["expected", "adapter"]
    if cached is None:
        return known.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    rows = known.select("adapter", "cost", "expected").collect()  # the dictionary
    each = [F.struct(F.lit(float(r["expected"])).alias("expected"), F.lit(r["adapter"]).alias("adapter"), F.lit(float(r["cost"])).alias("cost")) for r in sorted(rows, key=lambda r: (r["expected"], r["adapter"]))]
    per_key = cached.select("key", F.col("adapter").alias("_first"), F.array(*each).alias("_all"))
    mine = F.filter("_all", lambda a: a["adapter"].eqNullSafe(F.col("_first")))
    rest = F.filter("_all", lambda a: ~a["adapter"].eqNullSafe(F.col("_first")))
    return per_key.select("key", F.posexplode(F.concat(mine, rest)).alias("_i", "a")).select("key", F.col("a.adapter").alias("adapter"), F.col("a.expected").alias("expected"), (F.col("_i") + 1).cast("long").alias("rank"))


def looks_found(d: Spark, body: str, number: str) -> str:
    """the page holds the first eight characters of the number and none of the words for nothing found."""
    low = f"lower({body})"
    words = " or ".join(f"contains({low}, '{w}')" for w in NOT_FOUND)
    return f"(coalesce({body}, '') <> '' and coalesce({number}, '') <> '' and contains({low}, substr(lower({number}), 1, 8)) and not ({words}))"


def profile_list(d: Spark, urls: list[str], most: int = 3) -> str:
    """of some fields the http(s) URLs, trimmed, distinct whatever their case, cut to 500 characters, the first ``most`` of them."""
    plain = d.keep(d.each(d.drop_nulls(d.array(*urls)), "u", "trim(u)"), "u", d.rx("lower(u)", "^https?://"))
    if d.name == "spark":
        first = f"filter({plain}, (u, i) -> not exists(slice(xs, 1, i), w -> lower(w) = lower(u)))".replace(plain, "xs")
        return d.head(d.let(plain, "xs", f"transform({first}, u -> substr(u, 1, 500))"), most)
    return d.head(d.let(plain, "xs", "list_transform(list_filter(xs, lambda u, i: list_position(list_transform(xs, lambda w: lower(w)), lower(u)) = i), lambda u: substr(u, 1, 500))"), most)


def evidence_fields(d: Spark, **fields: str) -> dict[str, str]:
    """The evidence's texts trimmed and cut (reason to 200, extracted_industry to 80, source_text to 400 characters); blank ones are null."""
    caps = {"reason": 200, "extracted_industry": 80, "source_text": 400}
    return {k: f"case when coalesce(trim({x}), '') <> '' then substr(trim({x}), 1, {caps[k]}) end" for k, x in fields.items()}


def subcategories(docs: DataFrame, value: str = "value") -> DataFrame:
    """(industry, pos, category) of a taxonomy document per row: an array's entries, a text's words, else the industry's own name. Other documents give nothing."""
    root = F.try_parse_json(value)
    kind = lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    industries = F.try_variant_get(root, "$.industries", "variant").try_cast("map<string,variant>")
    rows = docs.select(F.explode(F.map_entries(industries)).alias("e")).select(F.col("e.key").alias("industry"), F.try_variant_get("e.value", "$.subcategories", "variant").alias("s"))
    listed = F.transform(F.coalesce(F.col("s").try_cast("array<variant>"), F.array().cast("array<variant>")), lambda x: x.cast("string"))
    words = F.filter(F.split(F.when(kind(F.col("s")) == "STRING", F.col("s").cast("string")), " "), lambda w: w != "")
    targets = F.when(kind(F.col("s")) == "STRING", words).when(F.size(listed) > 0, listed).otherwise(F.array("industry"))
    return rows.select("industry", F.posexplode(targets).alias("pos", "category"))


def name_drift(expected: Column, got: Column) -> Column:
    """Whether a result names another company than its row; a blank name tells nothing."""
    norm = lambda x: F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"\s+", " "))
    return (norm(expected) != "") & (norm(got) != "") & (norm(expected) != norm(got))


def inference_key(d: Spark, name: str, category: str, supplier: str) -> str:
    """Name, category and direction as the key of a cached inference."""
    squeezed = d.sub(f"trim(lower(coalesce({name}, '')))", r"\s+", " ")
    return f"{squeezed} || '|' || lower(substr(trim(coalesce({category}, '')), 1, 80)) || '|' || case when {supplier} then 'sup' else 'buy' end"


def with_inference(leads: DataFrame, cache: DataFrame, now: Column, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): leads of (key, ...) with the cached value of their key that isn't older than the TTL; the newest entry of a key counts, one without a value isn't any. Misses go on to inference."""
    entries = cache.where(F.col("value").isNotNull()).groupBy(F.col("key").alias("_key")).agg(F.max_by("value", "cached_at").alias("value"), F.max("cached_at").alias("cached_at"))
    fresh = entries.where(F.col("cached_at") >= now - F.make_interval(days=F.lit(days)))
    joined = leads.join(fresh, F.col("key") == F.col("_key"), "left").drop("_key")
    return joined.where("cached_at is not null"), joined.where("cached_at is null").drop("value", "cached_at")
