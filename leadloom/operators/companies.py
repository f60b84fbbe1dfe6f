"""Companies, places, edges and seeds as tables: keep-one, look-ups and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.dialect import SPARK
from . import keep


def one_per_place(rows: DataFrame) -> DataFrame:
    """The first row per place: by place id, else site, else title and city, in lower case; rows without site and phone are none.

    rows: place_id, domain, primary_phone, title, city, input_pos. Adds place_key.
    """
    key = F.lower(F.coalesce(F.expr("nullif(place_id, '')"), F.expr("nullif(domain, '')"), F.concat(F.coalesce("title", F.lit("")), F.coalesce("city", F.lit("")))))
    usable = rows.where(f"{texts.filled('domain')} or {texts.filled('primary_phone')}").withColumn("place_key", key)
    return keep.keep_first(usable, ["place_key"], [F.col("input_pos")])


def one_per_link(hits: DataFrame, order: list[Column]) -> DataFrame:
    """The first hit per link, case apart; hits without one are dropped."""
    return keep.keep_first(hits.where("link is not null"), [F.lower("link").alias("k")], order)


def purchase_edges(bought: DataFrame, company: str, category: str) -> DataFrame:
    """One edge per company and category slug."""
    edges = bought.selectExpr(f"{company} as from_id", f"{texts.slug(SPARK, category)} as to_id").where("to_id is not null").distinct()
    return edges.withColumn("edge_type", F.lit("PURCHASES")).withColumn("weight", F.lit(1))


def with_last_result(rows: DataFrame, results: DataFrame, key: str, order: list[Column], columns: list[str | Column]) -> DataFrame:
    """Rows with the columns of their key's last result; rows without one stay."""
    return rows.join(keep.keep_first(results, [key], order).select(key, *columns), key, "left")


def company_ids(rows: DataFrame, known: DataFrame, key: list[str], row_id: str) -> DataFrame:
    """Rows with company_id: that of the known (key, old_id), else the smallest row id of the key's new company."""
    new = rows.join(known, key, "left_anti").groupBy(*key).agg(F.min(row_id).alias("_new"))
    return rows.join(new, key, "left").join(known, key, "left").withColumn("company_id", F.coalesce("_new", "old_id")).drop("_new", "old_id")


def with_registry(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows (country, tax_id, confidence_score) with url, verified and score by their country's registry (country, lookup_url, boost)."""
    url = F.replace("lookup_url", F.lit("${id}"), F.coalesce("tax_id", F.lit("")))
    known, number = F.col("boost").isNotNull(), F.col("tax_id").isNotNull()
    boosted = F.least(F.lit(100), F.coalesce("confidence_score", F.lit(60)) + F.col("boost"))
    joined = rows.join(registry, "country", "left")
    return joined.withColumns({"url": F.when(number, url), "verified": known & number, "score": F.when(known, boosted)}).drop("lookup_url", "boost")


def best_sources(rows: DataFrame, sources: DataFrame, row_id: str, n: int = 4) -> DataFrame:
    """Per row (country) the n sources (id, countries, boost) of its country with the highest boost; sources meet rows by country."""
    each = sources.select("id", "boost", F.explode(F.array_distinct("countries")).alias("_cc"))
    first = keep.keep_top(each, ["_cc"], [F.col("boost").desc(), F.col("id")], n)
    return rows.select(row_id, F.upper("country").alias("_cc")).join(first, "_cc").drop("_cc")


def first_alias(rows: DataFrame, row_id: str, text: str, aliases: DataFrame) -> DataFrame:
    """(row_id, key) of the first word of the text that is an alias; aliases: one row per alias."""
    words = rows.select(row_id, F.posexplode(F.split(F.lower(text), " ")).alias("pos", "alias"))
    return words.join(aliases, "alias").groupBy(row_id).agg(F.min_by("key", "pos").alias("key"))


def with_segment(keyed: DataFrame, segments: DataFrame, other: str = "seg_other") -> DataFrame:
    """The segment and keyword of a key; without one, other and the key itself."""
    joined = keyed.join(segments, "key", "left")
    return joined.withColumns({"segment": F.coalesce("segment", F.lit(other)), "keyword": F.coalesce("keyword", "key")}).drop("key")


def seed_feedback(leads: DataFrame, known: DataFrame, least: int = 90) -> DataFrame:
    """Leads with enough points, a contact, a name and a domain that known(d) lacks; the first of each domain, in lower case as d."""
    contact = f"({texts.filled('primary_email')} or {texts.filled('primary_phone')})"
    hot = leads.where(f"confidence_score >= {least} and {texts.filled('company_name')} and {texts.filled('domain')} and {contact}").withColumn("d", F.lower("domain"))
    return keep.keep_first(hot.join(known, "d", "left_anti"), ["d"], [F.col("lead_id")])


def new_coefficients(ratios: DataFrame, have: DataFrame, defaults: DataFrame, key: list[str], group: str) -> DataFrame:
    """Exact and fallback coefficients of the keys that have lacks; ratios: key, ratio; defaults: group, group_ratio."""
    new = ratios.join(have, key, "left_anti").join(defaults, group)
    return new.select(*key, F.round(F.least(F.lit(0.95), F.round("ratio", 2) + 0.1), 6).alias("exact"), F.round(F.coalesce("group_ratio", F.lit(0.3)), 2).alias("fallback"))


def for_direction(rows: DataFrame, pillar: str, direction: str) -> DataFrame:
    """Rows of the pillars that run for their direction: the shared ones, and for suppliers theirs, else the others."""
    kind = F.when(F.col(pillar).rlike("Seed|VerifiedSource"), "shared").when(F.col(pillar).like("Pillar S %"), "supplier").otherwise("buyer")
    return rows.where(F.col(pillar).isNotNull()).where((kind == "shared") | ((kind == "supplier") == (F.col(direction) == "find_suppliers")))
