"""Category and industry keys of free texts by dictionary, and place names by code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.dialect import Spark, lit, lookup
from .keep import keep_first

OPENING, CLOSING = r"^[\s\x{3010}\[\x{FF3B}\]]+", r"[\s\x{3011}\]\x{FF3D}\[]+\z"


def plain(d: Spark, x: str) -> str:
    """A category text without brackets around it and without one country name in front."""
    bare = f"trim({d.sub(d.sub(f'coalesce({x}, {lit(str())})', OPENING), CLOSING)})"
    return f"trim({d.sub(bare, rules.COUNTRY_PREFIX_PATTERN)})"


def _resolve(rows: DataFrame, raw: str, dictionary: DataFrame, separators: str, least: int, skipped: str | None) -> DataFrame:
    """(_raw, _clean, _key) per distinct text: the key of the whole text, else of its first segment that has one; as written before lower case."""
    from ..functions.dialect import SPARK

    texts = rows.select(F.col(raw).alias("_raw")).distinct().withColumn("_clean", F.expr(plain(SPARK, "_raw")))
    parts = texts.select("_raw", F.posexplode(F.concat(F.array("_clean"), F.split("_clean", separators))).alias("_pos", "_part")).select("_raw", "_pos", F.trim("_part").alias("_part"))
    parts = parts.where((F.col("_part") != "") & ((F.col("_pos") == 0) | (F.length("_part") >= least)))
    tries = parts.select("_raw", "_pos", F.posexplode(F.array("_part", F.lower("_part"))).alias("_lower", "_alias"))
    hit = tries.join(dictionary.select(F.col("alias").alias("_alias"), F.col("key").alias("_key")), "_alias")
    hit = keep_first(hit, ["_raw", "_pos"], [F.col("_lower")])
    if skipped is not None:
        hit = hit.where((F.col("_pos") == 0) | (F.col("_key") != skipped))
    first = keep_first(hit, ["_raw"], [F.col("_pos")]).select(F.col("_raw").alias("_found"), "_key")
    return texts.join(first, F.col("_raw") == F.col("_found"), "left").drop("_found")


def category_keys(rows: DataFrame, raw: str, aliases: DataFrame, out: str = "category_key") -> DataFrame:
    """Adds the category key: by dictionary, else the text itself in lower case up to 24 characters, else other."""
    known = _resolve(rows, raw, aliases, "[；;、，,|]", 1, "other")
    key = F.when(F.col("_clean") == "", F.lit("other")).otherwise(F.coalesce("_key", F.when(F.length("_clean") <= 24, F.lower("_clean")), F.lit("other")))
    known = known.select("_raw", key.alias(out))
    return rows.join(known, F.col(raw).eqNullSafe(F.col("_raw")), "left").drop("_raw")


def industry_keys(rows: DataFrame, raw: str, names: DataFrame, out: str = "industry_key") -> DataFrame:
    """Adds the industry key by dictionary, segments split on white space too; null without one."""
    known = _resolve(rows, raw, names, r"[；;、，,|\s]", 2, None).select("_raw", F.col("_key").alias(out))
    return rows.join(known, F.col(raw).eqNullSafe(F.col("_raw")), "left").drop("_raw")


def place_blacklist(category: str) -> str:
    """The kinds of place that don't buy a category, joined by commas."""
    return lookup(category, {k: ",".join(v) for k, v in rules.PLACE_BLACKLISTS.items()}, lit(",".join(rules.PLACE_BLACKLIST_DEFAULT)))


def industry_hints(rows: DataFrame, raw: str, aliases: DataFrame, names: DataFrame) -> DataFrame:
    """Adds hint: both keys, the trimmed text as name, the places to leave out, and whether a dictionary knows the text."""
    keyed = industry_keys(category_keys(rows, raw, aliases, "_category"), raw, names, "_industry")
    hint = F.struct(
        F.col("_category").alias("category_key"), F.col("_industry").alias("industry_key"), F.trim(F.coalesce(raw, F.lit(""))).alias("name"),
        F.split(F.expr(place_blacklist("_category")), ",").alias("place_type_blacklist"), ((F.col("_category") != "other") | F.col("_industry").isNotNull()).alias("hit"),
    )
    return keyed.withColumn("hint", hint).drop("_category", "_industry")


def code(x: str) -> str:
    """The two-letter code that places are looked up by; us for none."""
    return f"coalesce(nullif(lower(substr(trim({x}), 1, 2)), ''), 'us')"


def country_name(x: str) -> str:
    return lookup(code(x), rules.COUNTRY_NAMES, f"upper({code(x)})")


def language(x: str) -> str:
    return lookup(code(x), rules.LANGUAGES, lit("English"))


def major_cities(x: str) -> str:
    """Up to five cities joined by commas; null where the country has none listed."""
    return lookup(f"upper({code(x)})", {k: ",".join(v) for k, v in rules.MAJOR_CITIES.items()})
