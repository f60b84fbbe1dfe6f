"""Job controls: JSON payloads read field by field, and policies as one control per job.

A payload is parsed once, as a VARIANT. Every field has a type test of its own, so a field of
another type gives its default and never a null row, and a payload that isn't JSON or no object gives all defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules

_EDGES = r"^[\s ﻿]+|[\s ﻿]+$"


def _kind(v: Column) -> Column:
    """STRING, BOOLEAN, OBJECT, ARRAY ...; null for a missing field."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _get(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "variant")


def _object(v: Column) -> Column:
    return F.when(_kind(v) == "OBJECT", v)


def _text(v: Column) -> Column:
    """The value where it is a text."""
    return F.when(_kind(v) == "STRING", v.cast("string"))


def _is(v: Column, value: bool) -> Column:
    return F.coalesce((_kind(v) == "BOOLEAN") & (v.cast("string") == str(value).lower()), F.lit(False))


def _truthy(v: Column) -> Column:
    """Whether a script would take the value for true: neither missing, null, false, zero nor an empty text."""
    kind, text = _kind(v), v.cast("string")
    number = kind.isin("BIGINT", "DOUBLE", "DECIMAL")
    return F.coalesce(F.when(kind == "STRING", text != "").when(kind == "BOOLEAN", text == "true").when(number, F.coalesce(text.cast("double") != 0, F.lit(True))).otherwise(~kind.isin("VOID")), F.lit(False))


def _items(v: Column) -> Column:
    """The elements of an array, none of anything else."""
    return F.coalesce(v.try_cast("array<variant>"), F.array().cast("array<variant>"))


def trimmed(x: Column) -> Column:
    return F.regexp_replace(x, _EDGES, "")


def _texts(v: Column, trim: bool = True) -> Column:
    """The texts among an array's elements, trimmed and without blank ones."""
    own = F.transform(F.filter(_items(v), lambda x: _kind(x) == "STRING"), lambda x: x.cast("string"))
    return F.filter(F.transform(own, trimmed) if trim else own, lambda x: x != "")


def _ids(v: Column) -> Column:
    """An array's texts and numbers as trimmed texts, distinct, in order; zero and empty ones go."""
    plain = F.filter(_items(v), lambda x: _truthy(x) & ~_kind(x).isin("OBJECT", "ARRAY"))
    return F.array_distinct(F.filter(F.transform(plain, lambda x: trimmed(x.cast("string"))), lambda x: x != ""))


def read_controls(jobs: DataFrame, payload: str) -> DataFrame:
    """Adds the structs matrix and hint (null where the payload has none), and convo, incremental and context.

    matrix: cities (10 at most), platforms (known ones, lower case), deep_all_cities (unless false), max_pages
    (1 to 5, else 2), include_social (unless false). hint: category_key (else other), industry_key, name_zh, name_en,
    place_type_blacklist (20 at most), hit. convo: negative_keywords (16 of 24 characters), icp_overrides (6 of 32).
    incremental: enabled, parent_job_id, blacklist. context: direction, negative_keywords in lower case, persona, agent_run_id.
    """
    p = _object(F.try_parse_json(payload))
    rows = jobs.withColumn("_p", p)
    rows = rows.withColumns({f"_{n}": _object(_get(F.col("_p"), f)) for n, f in (("matrix", "matrix"), ("hint", "industry_hint"), ("context", "icp_context"))})
    m, h, c = F.col("_matrix"), F.col("_hint"), F.col("_context")
    platforms = F.filter(F.transform(_items(_get(m, "platforms")), lambda x: F.lower(F.coalesce(_text(x), F.lit("")))), lambda x: x.isin(*rules.PLATFORMS, *rules.SUPPLIER_PLATFORMS))
    pages = F.regexp_extract(F.coalesce(_get(m, "max_pages_per_pillar").cast("string"), F.lit("")), r"^\s*([+-]?\d{1,9})", 1).try_cast("int")
    pages = F.when((pages.isNull()) | (pages == 0) | ~_kind(_get(m, "max_pages_per_pillar")).isin("STRING", "BIGINT", "DOUBLE", "DECIMAL"), 2).otherwise(pages)
    matrix = F.struct(
        F.slice(_texts(_get(m, "cities")), 1, 10).alias("cities"), platforms.alias("platforms"), (~_is(_get(m, "deep_search_all_cities"), False)).alias("deep_all_cities"),
        F.least(F.lit(5), F.greatest(F.lit(1), pages)).alias("max_pages"), (~_is(_get(m, "include_social_profiles"), False)).alias("include_social"),
    )
    hint = F.struct(
        F.coalesce(_text(_get(h, "category_key")), F.lit("other")).alias("category_key"), _text(_get(h, "industry_key")).alias("industry_key"), F.coalesce(_text(_get(h, "name_zh")), F.lit("")).alias("name_zh"),
        F.coalesce(_text(_get(h, "name_en")), F.lit("")).alias("name_en"), F.slice(_texts(_get(h, "place_type_blacklist"), trim=False), 1, 20).alias("place_type_blacklist"), _truthy(_get(h, "hit")).alias("hit"),
    )
    cut = lambda v, n, most: F.slice(F.transform(_texts(v), lambda x: F.substring(x, 1, n)), 1, most)
    root = F.col("_p")
    on = _is(_get(root, "incremental_mode"), True)
    empty = F.array().cast("array<string>")
    return rows.withColumns({
        "matrix": F.when(m.isNotNull(), matrix), "hint": F.when(h.isNotNull(), hint), "convo": F.struct(cut(_get(root, "negative_keywords"), 24, 16).alias("negative_keywords"), cut(_get(root, "icp_overrides"), 32, 6).alias("icp_overrides")),
        "incremental": F.struct(on.alias("enabled"), F.when(on, trimmed(_text(_get(root, "incremental_parent_job_id")))).alias("parent_job_id"), F.when(on, _ids(_get(root, "incremental_blacklist_company_ids"))).otherwise(empty).alias("blacklist")),
        "context": F.struct(
            F.when(F.coalesce(_text(_get(c, "direction")) == "find_suppliers", F.lit(False)), "find_suppliers").otherwise("find_buyers").alias("direction"), F.transform(_texts(_get(c, "negative_keywords")), F.lower).alias("negative_keywords"),
            trimmed(_text(_get(c, "persona"))).alias("persona"), _text(_get(c, "agent_run_id")).alias("agent_run_id"),
        ),
    }).drop("_p", "_matrix", "_hint", "_context")


def run_cities(matrix: Column, major: Column) -> Column:
    """The cities that a job runs over: its own, up to ten; else, unless it says no, up to five large ones of its country; without a matrix none."""
    own = F.when(F.size(matrix["cities"]) > 0, F.slice(matrix["cities"], 1, 10)).when(matrix["deep_all_cities"], F.slice(major, 1, 5))
    return F.coalesce(own, F.array().cast("array<string>"))


def policy_controls(jobs: DataFrame, policies: DataFrame) -> DataFrame:
    """One control per job of (job_id, country, category) from policies of (country, category, kind, delta, disabled, domains, keywords); null fields of a policy hold for all.

    Adds weights and deltas (maps by kind), the flags disable_linkedin, disable_lookalike, enforce_geo and
    enforce_recency, and the united domain_blacklist and keyword_suppress. Policies meet the distinct scopes,
    not the jobs, and a scope's are added up to one map before it meets its jobs.
    """
    scopes = jobs.select("country", "category").distinct()
    one = F.lower(F.coalesce("kind", F.lit("")))
    pol = policies.select(F.upper("country").alias("_country"), F.lower("category").alias("_category"), one.alias("kind"), F.coalesce(F.col("delta").cast("double"), F.lit(0.0)).alias("delta"), F.coalesce("disabled", F.lit(False)).alias("disabled"), "domains", "keywords")
    # the four ways in which a policy's scope can name a job's: each is an equality, null where it doesn't matter
    ways = F.array(*(F.struct(F.when(F.lit(c), F.upper("country")).alias("_c"), F.when(F.lit(k), F.lower("category")).alias("_k")) for c in (True, False) for k in (True, False)))
    asked = scopes.select("country", "category", F.explode(F.array_distinct(ways)).alias("w")).select("country", "category", "w.*")
    met = asked.join(pol, asked["_c"].eqNullSafe(pol["_country"]) & asked["_k"].eqNullSafe(pol["_category"]))
    by_kind = met.groupBy("country", "category", "kind").agg(F.round(F.sum("delta"), 9).alias("delta"), F.bool_or("disabled").alias("off"), F.array_distinct(F.flatten(F.collect_list("domains"))).alias("domains"), F.array_distinct(F.flatten(F.collect_list("keywords"))).alias("keywords"))
    weight = F.when(F.col("off"), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(2.0), F.round(1.0 + 3 * F.col("delta"), 9))))
    entries = lambda v: F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", v))))
    own = by_kind.groupBy(F.col("country").alias("_c"), F.col("category").alias("_k")).agg(
        entries(weight.alias("weight")).alias("weights"), entries("delta").alias("deltas"), entries("off").alias("_off"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("domains")))).alias("domain_blacklist"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("keywords")))).alias("keyword_suppress"),
    )
    joined = jobs.join(own, jobs["country"].eqNullSafe(own["_c"]) & jobs["category"].eqNullSafe(own["_k"]), "left").drop("_c", "_k")

    def flag(kind: str, least: float) -> Column:
        return F.coalesce(F.try_element_at("_off", F.lit(kind)), F.lit(False)) | (F.coalesce(F.try_element_at("deltas", F.lit(kind)), F.lit(0.0)) <= least)

    empty = F.array().cast("array<string>")
    flags = {"disable_linkedin": flag("entity", -0.05), "disable_lookalike": flag("generic", -0.08), "enforce_geo": flag("geo", -0.05), "enforce_recency": flag("staleness", -0.06)}
    return joined.withColumns(flags).withColumns({c: F.coalesce(c, empty) for c in ("domain_blacklist", "keyword_suppress")}).drop("_off")


def enabled_pillars(controls: DataFrame) -> DataFrame:
    """(job_id, pillar): what a job of (job_id, direction, platforms, weights, disable_linkedin, disable_lookalike) collects.

    A weight below 0.35 turns the pillars of its kind off, a flag its own, a list of platforms all that it could name and doesn't. For suppliers the two shared pillars stay and six of their own come.
    """
    weight = lambda kind: F.coalesce(F.try_element_at("weights", F.lit(kind)), F.lit(1.0))
    low = {k: weight(k) < rules.LOW_WEIGHT for k in ("generic", "geo", "contact")}
    chosen = F.size(F.coalesce("platforms", F.array().cast("array<string>"))) > 0

    def on(name: str) -> Column:
        out = F.lit(True)
        for kind, names in rules.PILLARS_BY_WEIGHT.items():
            if name in names:
                out = out & ~low[kind]
        if name == "p11_linkedin_decision":
            out = out & ~F.col("disable_linkedin")
        if name == "p9_lookalike":
            out = out & ~F.col("disable_lookalike")
        for platform, names in rules.PILLARS_BY_PLATFORM.items():
            if name in names:
                out = out & (~chosen | F.array_contains("platforms", platform))
        return out

    buyers = F.array_compact(F.array(*(F.when(on(p), p) for p in rules.BUYER_PILLARS)))
    shared = F.filter(buyers, lambda x: x.isin(*rules.SHARED_PILLARS))
    suppliers = F.concat(shared, F.array(*(F.lit(p) for p in rules.SUPPLIER_PILLARS)))
    return controls.select("job_id", F.explode(F.when(F.col("direction") == "find_suppliers", suppliers).otherwise(buyers)).alias("pillar"))


def apply_controls(signals: DataFrame, controls: DataFrame) -> DataFrame:
    """Signals of (job_id, title, snippet, link, ...) that their job's control lets through.

    Suppressed keywords longer than one character in title or snippet drop a signal, as does a host of
    the blacklist; enforced place needs the country's name or ending, enforced recency drops years long past. controls: job_id, country_name, country, year, the lists and flags.
    A job's control is one row; signals meet it by job.
    """
    c = controls.select(F.col("job_id").alias("_job"), "country_name", F.col("country").alias("_country"), "year", "domain_blacklist", "keyword_suppress", "enforce_geo", "enforce_recency")
    text = F.lower(F.concat_ws(" ", "title", "snippet"))
    host = F.regexp_replace(F.regexp_extract(F.lower(F.coalesce("link", F.lit(""))), r"^https?://([^/?#:]+)", 1), r"^www\.", "")
    suppressed = F.exists("keyword_suppress", lambda k: (F.length(k) > 1) & F.contains(text, F.lower(k)))
    listed = F.exists("domain_blacklist", lambda x: F.regexp_replace(F.lower(x), r"^www\.", "") == host)
    near = F.contains(F.lower(F.concat_ws(" ", "title", "snippet", "link")), F.lower("country_name")) | F.contains(F.lower(F.concat_ws(" ", "title", "snippet", "link")), F.concat(F.lit("."), F.lower("_country")))
    old = F.exists(F.array(*(F.col("year") - k for k in (3, 4, 5))), lambda y: F.contains(text, y.cast("string")))
    ok = ~suppressed & ~listed & (~F.col("enforce_geo") | F.coalesce(near, F.lit(False))) & (~F.col("enforce_recency") | ~old)
    return signals.join(c, F.col("job_id") == F.col("_job")).where(ok).select(*signals.columns)
