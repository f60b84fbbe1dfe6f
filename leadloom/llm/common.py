"""Small helpers shared by the operators: tables, the shared folder, word splitting."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Maps UTF-8 bytes so that split() yields the words [0-9a-z and all of non-ASCII], A-Z in lower case.
WORD_BYTES = bytes(c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; a small one in few files is dealt to all cores, larger ones come as they are."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def words(raw: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and non-ASCII characters, from UTF-8 bytes.

    Working on bytes gives the same words as working on characters, because
    every byte of a non-ASCII character is 0x80 or above.
    """
    return raw.translate(WORD_BYTES).split()


#: Rows that a task works on at a time; Arrow batches may hold many more.
PIECE_ROWS = 256


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of bounded rows, so that what a task derives from them stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; where it is unset, in local mode only, a folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


class _Live(threading.local):
    def __init__(self):
        self.paths: list[str] = []


#: The folders that cut() has written in this thread and nobody has removed, in order.
_LIVE = _Live()


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder now, as Parquet, so that later steps reread them and don't compute them again."""
    spark = df.sparkSession
    path = fresh_path(spark, "cut")
    df.write.parquet(path)
    _LIVE.paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def live_cuts() -> list[str]:
    """The folders that cut() has written in this thread and that are still there."""
    return list(_LIVE.paths)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes folders, by the file systems that Spark itself uses."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in list(paths):
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
        if path in _LIVE.paths:
            _LIVE.paths.remove(path)


def tidy(spark: SparkSession, since: Iterable[str], *kept: DataFrame) -> None:
    """Deletes what cut() has written since then (a former live_cuts()), but for the tables that the kept frames read."""
    stay = {*since, *(df.cut_path for df in kept)}
    remove(spark, [x for x in live_cuts() if x not in stay])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


#: A key counts as hot when it has more than one in this many of all rows, so there are fewer hot keys than this.
HOT_SHARE = 1000


def hot_join(left: DataFrame, right: DataFrame, key: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """left joined with right, which has one row per key and, in ``weight``, how many of left's ``total`` rows have it.

    right is written first. If no key is hot, this is a plain join, in which Spark
    broadcasts right if its files are small. Else rows of hot keys are joined where
    they are, by broadcasting the hot keys, of which there are fewer than HOT_SHARE
    whatever the input; all others meet in a join in which no key has more than one
    in HOT_SHARE rows. Null keys match each other. how: inner or left; left's
    columns come first, then right's others. The result reads what was written of right (cut_path).
    """
    names = free_names(left, *(f"_k{i}" for i in range(len(key))))
    right = cut(right.select(*(F.col(k).alias(n) for k, n in zip(key, names, strict=True)), *(c for c in right.columns if c not in key)))
    hot, cold = right.where(F.col(weight) * HOT_SHARE > total), right.where(F.col(weight) * HOT_SHARE <= total)

    def same(a: DataFrame, b: DataFrame):
        out = F.lit(True)
        for k, n in zip(key, names, strict=True):
            out = out & a[k].eqNullSafe(b[n])
        return out

    if hot.isEmpty():
        out = left.join(right, same(left, right), how).drop(*names)
    else:
        there = left.join(F.broadcast(hot), same(left, hot)).drop(*names)
        keys = hot.select(*names)
        rest = left.join(F.broadcast(keys), same(left, keys), "left_anti")
        out = there.unionByName(rest.join(cold, same(rest, cold), how).drop(*names))
    out.cut_path = right.cut_path
    return out
