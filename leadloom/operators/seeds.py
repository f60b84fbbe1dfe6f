"""Seeds, job grids and adapter search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keep import keep_top


def seeds_by_category(jobs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Per job of (job_id, country, category) and category of the seeds in its country that holds the job's first word: n_seeds, first_seed.

    Seeds (seed_id, country, category) are counted per country and category first,
    and jobs meet these, so the rows between are as many as categories, not seeds.
    """
    known = seeds.groupBy(F.lower("country").alias("_cc"), F.lower("category").alias("seed_category")).agg(F.count("*").alias("n_seeds"), F.min("seed_id").alias("first_seed"))
    asked = jobs.select("job_id", F.lower("country").alias("_cc"), F.lower(F.split("category", " ")[0]).alias("_word"))
    return asked.join(known, "_cc").where("contains(seed_category, _word)").select("job_id", "seed_category", "n_seeds", "first_seed")


def pending_seeds(jobs: DataFrame, seeds: DataFrame, most: int = 50) -> DataFrame:
    """Per job (job_id, country, category) the pending seeds (seed_id, country, category, status) it takes.

    A seed without a country suits all, of the first ``most`` in the job's country
    those without a category or whose category holds the job's are taken. Only the
    first ``most`` of a country and of those without one can be among them, so no
    more seeds meet a job.
    """
    pending = seeds.where("status = 'pending'").withColumn("_at", F.coalesce(F.upper("country"), F.lit("*")))
    near = keep_top(pending, ["_at"], [F.col("seed_id")], most).select("_at", "seed_id", F.lower("category").alias("seed_category"))
    asked = jobs.select("job_id", F.lower("category").alias("_category"), F.explode(F.array_distinct(F.array(F.upper(F.coalesce("country", F.lit("*"))), F.lit("*")))).alias("_at"))
    first = keep_top(asked.join(near, "_at"), ["job_id"], [F.col("seed_id")], most)
    return first.where("coalesce(seed_category, '') = '' or contains(seed_category, _category)").select("job_id", "seed_id")


def consume(seeds: DataFrame, taken: DataFrame) -> DataFrame:
    """The seeds with status consumed and the first job that took them, where one did."""
    by = taken.groupBy("seed_id").agg(F.min("job_id").alias("consumed_by"))
    return seeds.join(by, "seed_id", "left").withColumn("status", F.when(F.col("consumed_by").isNotNull(), "consumed").otherwise(F.col("status")))


def inline_seeds(df: DataFrame, payload: str, key: str, most: int = 50) -> DataFrame:
    """(key, kind, pos, url): the non-blank entries of both URL arrays of a job's payload, up to ``most`` of each."""
    seeds = F.from_json(payload, "seeds struct<social_urls:array<string>,company_urls:array<string>>")["seeds"]
    parsed = df.select(key, seeds.alias("_s"))

    def side(kind: str) -> DataFrame:
        urls = F.slice(F.filter(F.col(f"_s.{kind}_urls"), lambda u: F.trim(u) != ""), 1, most)
        return parsed.select(key, F.lit(kind).alias("kind"), F.posexplode(urls).alias("pos", "url"))

    return side("social").unionByName(side("company"))


def job_grid(jobs: DataFrame, personas: DataFrame, cities: DataFrame, most: int = 3) -> DataFrame:
    """Per job up to ``most`` personas by up to ``most`` cities: its own, else (with deep) its country's largest, else none.

    jobs: job_id, country_name, deep, major (an array of cities); personas: job_id,
    persona, pos; cities: job_id, city, pos.
    """
    who = keep_top(personas.where("trim(persona) <> ''"), ["job_id"], [F.col("pos")], most).select("job_id", F.trim("persona").alias("persona"))
    own = keep_top(cities, ["job_id"], [F.col("pos")], most).groupBy("job_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "city"))), lambda x: x["city"]).alias("own"))
    none = F.array(F.lit(None).cast("string"))
    where = F.coalesce("own", F.when(F.col("deep") & (F.size("major") > 0), F.slice("major", 1, most)), none)
    placed = jobs.join(own, "job_id", "left").select("job_id", "country_name", F.explode(where).alias("city"))
    query = F.concat_ws(" ", "persona", F.concat(F.lit('"'), F.col("city"), F.lit('"')), "country_name")
    return placed.join(who, "job_id").select("job_id", "persona", "city", query.alias("query"))


def adapter_search(attempts: DataFrame, key: str, order: list[str], budget: float) -> DataFrame:
    """Per key the first adapter in order that hits: an unavailable one and one that would overspend are skipped, the cost is that of those tried.

    attempts: one row per key and adapter, with adapter, available, cost and hits
    (null: failed, 0: no result). Adapters are few, so a key's list is short.
    Adds ok, adapter_id, hits, cost, tried (in order, joined by commas) and reason.
    """
    one = F.struct(*dict.fromkeys([*order, "adapter", "cost", "hits"]))
    lists = attempts.where("available").groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("a"))
    start = F.struct(F.lit(0.0).alias("cost"), F.array().cast("array<string>").alias("tried"), F.lit(None).cast("string").alias("adapter_id"), F.lit(0).cast("long").alias("hits"), F.lit(False).alias("zero"))

    def step(acc: Column, x: Column) -> Column:
        cost = acc["cost"] + x["cost"]
        now = F.struct(
            cost.alias("cost"), F.concat(acc["tried"], F.array(x["adapter"])).alias("tried"), F.when(x["hits"] > 0, x["adapter"]).alias("adapter_id"),
            F.coalesce(F.greatest(x["hits"].cast("long"), F.lit(0)), F.lit(0)).alias("hits"), (acc["zero"] | F.coalesce(x["hits"] == 0, F.lit(False))).alias("zero"),
        )
        return F.when(acc["adapter_id"].isNotNull() | (cost > budget), acc).otherwise(now)

    done = lists.select(key, F.aggregate("a", start, step).alias("s"))
    every = attempts.select(key).distinct().join(done, key, "left")
    tried = F.array_join("s.tried", ",")
    reason = F.when(F.col("s.adapter_id").isNotNull(), F.lit(None)).when(F.coalesce("s.zero", F.lit(False)), "zero_results").when(F.coalesce(F.size("s.tried"), F.lit(0)) <= 0, "no_available_adapter").otherwise(F.concat(F.lit("all_adapters_failed:"), tried))
    ok = F.coalesce(F.col("s.adapter_id").isNotNull() | F.col("s.zero"), F.lit(False))
    return every.select(key, ok.alias("ok"), F.col("s.adapter_id").alias("adapter_id"), F.coalesce("s.hits", F.lit(0)).cast("long").alias("hits"), F.coalesce("s.cost", F.lit(0.0)).alias("cost"), F.coalesce(tried, F.lit("")).alias("tried"), reason.alias("reason"))


#: Layers of the contact waterfall, and what a call costs.
LAYERS = {"home": 0, "bfs": 0, "llm": 1, "vision": 5, "serper": 1}


def contact_waterfall(found: DataFrame, key: str, budget: str = "2") -> DataFrame:
    """Per key the layers in order; home and bfs always run, later ones only without a contact so far, vision only within the budget.

    found: one column per layer with the contacts it finds or would find; budget: a
    number or column. Adds via, cost and which layers ran.
    """
    has = lambda layer: F.col(layer) > 0
    a = found.withColumn("llm_ran", ~(has("home") | has("bfs")))
    left = F.col("llm_ran") & ~has("llm")
    spent = F.when(F.col("llm_ran"), LAYERS["llm"]).otherwise(0)
    a = a.withColumn("vision_ran", left & (spent + LAYERS["vision"] <= F.expr(budget)))
    a = a.withColumn("serper_ran", left & ~(F.col("vision_ran") & has("vision")))
    via = F.when(has("home"), "home").when(has("bfs"), "bfs").when(F.col("llm_ran") & has("llm"), "llm").when(F.col("vision_ran") & has("vision"), "vision").when(F.col("serper_ran") & has("serper"), "serper")
    cost = sum((F.col(f"{x}_ran").cast("int") * LAYERS[x] for x in ("llm", "vision", "serper")), F.lit(0))
    return a.select(key, via.alias("via"), cost.alias("cost"), "llm_ran", "vision_ran", "serper_ran")
