"""Pieces of query definitions: a query is a function (spark, sf_dir) -> DataFrame and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.dialect import DUCK, SPARK, Spark
from ..plans import derived

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(name)
        self.queries[name] = query
        if sql is not None:
            self.sql[name] = sql

    def projection(self, name: str, source: str, keys: Sequence[str], columns: Callable[[Spark], dict[str, str]], where: Callable[[Spark], str] | None = None) -> None:
        """A query that works out columns of a derived table, row by row."""

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = derived.build(spark, sf_dir, source)
            df = df.where(where(SPARK)) if where else df
            return df.selectExpr(*keys, *(f"{x} as {n}" for n, x in columns(SPARK).items()))

        duck = ", ".join([*keys, *(f"{x} as {n}" for n, x in columns(DUCK).items())])
        self.add(name, run, f"select {duck} from ({derived.sql(source)})" + (f" where {where(DUCK)}" if where else ""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(name: str) -> str:
    """A derived table as a subquery."""
    return f"({derived.sql(name)})"
