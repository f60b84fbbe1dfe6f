"""Readers of input tables with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One schema per input table; drifting files are aligned to it.
SCHEMAS = {
    "organic_hits": "query_id bigint, page int, pos int, title string, snippet string, link string, pillar string, intent_signal string",
    "places": "query_id bigint, pos int, title string, address string, phone string, website string, place_id string, cid string, types array<string>",
    "pages": "page_id bigint, url string, html string",
    "extractions": "batch_id bigint, results array<struct<company_name:string,entity_type:string,industry_match:string>>",
    "inferences": "batch_id bigint, results array<struct<company_name:string,entity_role:string,confidence_tier:string,procurement_items:array<string>,intent_summary:string,purchase_cycle:string>>",
    "persons": "company_id bigint, persons array<struct<name:string,title:string,email:string,phone:string,linkedin:string,confidence:double>>",
}


def read(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at path under its declared schema; columns that are missing are null, others are left out."""
    return spark.read.schema(SCHEMAS[name]).format(fmt).load(path)


def align(df: DataFrame, name: str) -> DataFrame:
    """Any frame under a table's schema."""
    empty = df.sparkSession.createDataFrame([], SCHEMAS[name])
    return empty.unionByName(df.select(*(c for c in df.columns if c in empty.columns)), allowMissingColumns=True)


def places_with_fallback(native: DataFrame, fallback: DataFrame) -> DataFrame:
    """Native places, and of queries without any the fallback's; each with a map link by place or cid."""
    both = native.unionByName(fallback.join(native.select("query_id").distinct(), "query_id", "left_anti"), allowMissingColumns=True)
    by_place = F.concat(F.lit("https://www.google.com/maps/place/?q=place_id:"), F.col("place_id"))
    by_cid = F.concat(F.lit("https://maps.google.com/?cid="), F.col("cid"))
    return both.withColumn("maps_url", F.coalesce(by_place, by_cid))


def persons(df: DataFrame, most: int = 5) -> DataFrame:
    """Up to five persons per company with at least one way to reach them; confidence 0.5 by default, within 0 and 1."""
    rows = df.select("company_id", F.posexplode("persons").alias("pos", "p")).where(f"pos < {most} and (coalesce(p.email, '') <> '' or coalesce(p.phone, '') <> '' or coalesce(p.linkedin, '') <> '')")
    return rows.select("company_id", "pos", "p.name", "p.title", "p.email", "p.phone", "p.linkedin", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("p.confidence", F.lit(0.5)))).alias("confidence"))
