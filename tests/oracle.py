"""Comparison of a query's rows with those of its SQL."""

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, np.ndarray | list | tuple):
        return tuple(plain(x) for x in v)
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, bool | np.bool_):
        return bool(v)
    if isinstance(v, int | float | np.integer | np.floating):
        return None if v != v else round(float(v), 9)
    return v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False)), key=repr)


def assert_same(spark_df, con, sql):
    got, want = spark_df.toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = rows(got), rows(want)
    assert len(got) == len(want)
    assert got == want
