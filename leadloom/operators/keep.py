"""Keep one row per key, first-wins and last-wins merges: the shapes behind W, J and K operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. Plans as a group limit before the shuffle, so hot keys send few rows."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")


def keep_top(df: DataFrame, key: Sequence[str | Column], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each key, with their rank."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("long"))


def merge_first_wins(target: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of new whose key target lacks, one per key, after target's own rows, which stay untouched."""
    fresh = keep_first(new, key, order).join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def merge_last_wins(target: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of new per key replaces target's."""
    last = keep_first(new, key, [c.desc() for c in order])
    return target.join(last.select(*key), list(key), "left_anti").unionByName(last, allowMissingColumns=True)


def merge_columns(left: DataFrame, right: DataFrame, key: Sequence[str], prefer_right: bool = True) -> DataFrame:
    """Rows of left with right's columns over them (or under, where left has a value)."""
    shared = [c for c in left.columns if c in right.columns and c not in key]
    r = right.select(*key, *(F.col(c).alias(f"_r_{c}") for c in right.columns if c not in key))
    joined = left.join(r, list(key), "left")
    pick = (lambda c: F.coalesce(F.col(f"_r_{c}"), F.col(c))) if prefer_right else (lambda c: F.coalesce(F.col(c), F.col(f"_r_{c}")))
    return joined.select(*key, *(pick(c).alias(c) if c in shared else F.col(c) for c in left.columns if c not in key), *(F.col(f"_r_{c}").alias(c) for c in right.columns if c not in left.columns))
