"""Stage tables: a step's rows written as Parquet in the shared folder and read again.

Stages made inside ``scope`` are deleted at its end. Frames read their stages when they are run, so their results
must be written or collected inside; without a scope stages stay, since nobody knows who still reads them.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors share; where it is unset, in local mode only, a folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


class _Open(threading.local):
    def __init__(self):
        self.scopes: list[list[str]] = []


_OPEN = _Open()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, by the file system that Spark itself uses."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the stages that this thread makes inside."""
    _OPEN.scopes.append([])
    try:
        yield
    finally:
        for path in _OPEN.scopes.pop():
            remove(spark, path)


def stage(df: DataFrame, name: str = "stage", keep: bool = False) -> DataFrame:
    """The same rows, computed once; later steps reread them, also after executors are lost. ``keep``: not deleted at the end of a scope."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if _OPEN.scopes and not keep:
        _OPEN.scopes[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
