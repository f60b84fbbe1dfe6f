"""Dictionaries read from JSON documents into dimension tables.

Every loader takes a table of documents, one JSON text per row in ``value``, and
the columns ``by`` that name a document; ``documents`` reads files so. Of entries
with one key the first (or, where a later one overwrites it, the last) of a
document counts. A document that isn't of the expected shape gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keep import keep_first

By = Sequence[str]


def documents(spark: SparkSession, path: str) -> DataFrame:
    """The JSON files at a path, one row each, with the file's name."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def _text(x: Column) -> Column:
    return F.coalesce(F.trim(x), F.lit(""))


def aliases(docs: DataFrame, by: By = ()) -> DataFrame:
    """(alias, key) of [[alias, key], ...]; the first entry of an alias counts."""
    rows = docs.select(*by, F.posexplode(F.from_json("value", "array<array<string>>")).alias("n", "e")).select(*by, "n", F.get("e", F.lit(0)).alias("alias"), F.get("e", F.lit(1)).alias("key"))
    return keep_first(rows.where("alias <> '' and key <> ''"), [*by, "alias"], [F.col("n")]).select(*by, "alias", "key")


def industry_names(docs: DataFrame, by: By = ()) -> DataFrame:
    """(alias, key) of {"entries": [{industry_key, name_zh, name_en}]}; English names in lower case, the first entry of a name counts."""
    rows = docs.select(*by, F.posexplode(F.from_json("value", "entries array<struct<industry_key:string,name_zh:string,name_en:string>>")["entries"]).alias("n", "e"))
    names = F.array(F.struct(F.lit(0).alias("k"), _text(F.col("e.name_zh")).alias("alias")), F.struct(F.lit(1).alias("k"), F.lower(_text(F.col("e.name_en"))).alias("alias")))
    each = rows.select(*by, "n", _text(F.col("e.industry_key")).alias("key"), F.explode(names).alias("x")).select(*by, "n", "key", "x.k", "x.alias")
    return keep_first(each.where("alias <> '' and key <> ''"), [*by, "alias"], [F.col("n"), F.col("k")]).select(*by, "alias", "key")


def rule_keys(docs: DataFrame, by: By = ()) -> DataFrame:
    """The distinct keys of {"mappings": {rule: key}}."""
    rows = docs.select(*by, F.explode(F.from_json("value", "mappings map<string,string>")["mappings"]).alias("rule", "key"))
    return rows.select(*by, _text(F.col("key")).alias("key")).where("key <> ''").distinct()


def segments(docs: DataFrame, by: By = ()) -> DataFrame:
    """(segment_id, keywords, keywords_zh, map_types) of {"segments": [...]}; the last entry of an id counts."""
    rows = docs.select(*by, F.posexplode(F.from_json("value", "segments array<struct<segment_id:string,keywords:array<string>,keywords_zh:array<string>,mapTypes:array<string>>>")["segments"]).alias("n", "e"))
    rows = rows.select(*by, "n", "e.segment_id", "e.keywords", "e.keywords_zh", F.col("e.mapTypes").alias("map_types")).where("segment_id is not null")
    return keep_first(rows, [*by, "segment_id"], [F.col("n").desc()]).drop("n")


def category_segments(docs: DataFrame, by: By = ()) -> DataFrame:
    """(category, segment_id) of {"category_to_segment": {category: segment}}."""
    return docs.select(*by, F.explode(F.from_json("value", "category_to_segment map<string,string>")["category_to_segment"]).alias("category", "segment_id"))


def verified_sources(docs: DataFrame, by: By = ()) -> DataFrame:
    """One row per source of {"sources": {region: [...]}}, in the order of regions and lists."""
    kind = "sources map<string,array<struct<id:string,domain:string,countries:array<string>,type:string,source_confidence_boost:int,search_strategy:string>>>"
    regions = docs.select(*by, F.posexplode(F.from_json("value", kind)["sources"]).alias("region_pos", "region", "list"))
    return regions.select(*by, "region", "region_pos", F.posexplode("list").alias("pos", "s")).select(*by, "region", "region_pos", "pos", "s.*")


def tax_registry(docs: DataFrame, by: By = ()) -> DataFrame:
    """(country, id, lookup_url, boost) of {"tax_verify_databases": {"databases": [...]}}; the last entry of a country counts."""
    kind = "tax_verify_databases struct<databases:array<struct<country:string,id:string,lookup_url:string,confidence_boost_on_match:int>>>"
    rows = docs.select(*by, F.posexplode(F.from_json("value", kind)["tax_verify_databases"]["databases"]).alias("n", "e"))
    rows = rows.select(*by, "n", "e.country", "e.id", "e.lookup_url", F.col("e.confidence_boost_on_match").alias("boost")).where("country is not null")
    return keep_first(rows, [*by, "country"], [F.col("n").desc()]).drop("n")


def industries(docs: DataFrame, by: By = ()) -> DataFrame:
    """(n, name, word, detail) of {"industries": {name: {...}}}: the name's first word in lower case, the entry as JSON."""
    rows = docs.select(*by, F.posexplode(F.from_json("value", "industries map<string,string>")["industries"]).alias("n", "name", "detail"))
    return rows.withColumn("word", F.lower(F.substring_index("name", " ", 1)))
