"""A corpus pipeline of five stages over the table documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and reread as the next one's docs. All but the last return the
columns of documents; the last returns a row per document with its words taken.

Defined cases, of every stage: a null or wordless text fails the base rules, so no such document comes past the
second stage (the first judges it like any other text); rows of one id are documents of their own until the third stage, which keeps one of
equal rows; null ids and sources are ids and sources like others; extra columns of any name go through the first four
stages as they are; an empty table gives an empty one.

A stage's working tables are deleted when the next stage of the thread begins: its
rows have been written by then.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm import decontaminate, line_rules, minhash_join, mixing, quality_fm
from leadloom.llm.common import fresh_path, live_cuts, remove, table

_LEFT = threading.local()


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Deletes the working tables of the stage before, and remembers its own."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, getattr(_LEFT, "paths", []))
        since = live_cuts()
        out = fn(spark, docs, sf_dir)
        _LEFT.paths = [x for x in live_cuts() if x not in since]
        return out

    return run_stage


@stage
def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_fm.keep_good(docs, quality_fm.train(docs, table(spark, sf_dir, "labels")))


@stage
def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't depleted, without their frequent lines.

    Copies count once here: the next stage keeps one of them, so they mustn't go because of one another.
    """
    return line_rules.clean(docs, copies_once=True)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_join.keep_one(docs)


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated, without the benchmark passages left in them."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words taken of each document."""
    return mixing.pareto_mix(docs)


STAGES = [("quality_classifier", classify), ("quality_rules", apply_rules), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("mixing", mix)]

#: The first stage is a fitted model, which SQL doesn't express; the tests check the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        remove(spark, [before] if before else [])
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
