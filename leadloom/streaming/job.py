"""A streaming job's folder: progress, tables by batch and keyed states, so that a named job can be taken up again.

Below one folder of the shared directory lie Spark's checkpoint (``progress``), a
table per output with one folder a batch, and the states. A batch that is
repeated after a failure replaces its own folders; readers see the folders of committed
batches alone, so what an interrupted batch left is neither shown nor used.

A state is one row per key. Every batch writes the states that it changes; every
``EVERY`` batches all last states are written anew as a snapshot, and what it
replaces is deleted once a second snapshot stands. A snapshot is parted by a hash of the key, one part for
``PART_ROWS`` rows, so that a batch reads the parts of its own keys and not the
whole of a large state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keep import keep_first
from ..sources.stages import scope, shared_dir

EVERY = 8
PART_ROWS = 1 << 20


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def same_key(a: DataFrame, b: DataFrame, key: Sequence[str]):
    out = F.lit(True)
    for k in key:
        out = out & a[k].eqNullSafe(b["_" + k])
    return out


class Job:
    """``name`` fixes the folder: a job of that name goes on where the last run of it stopped. Without one it is a new job."""

    def __init__(self, spark: SparkSession, name: str | None = None):
        self.spark, self.base = spark, f"{shared_dir(spark)}/jobs/{name or uuid.uuid4().hex}"

    # -- folders ------------------------------------------------------------

    def _fs(self, path: str):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(conf), folder

    def _names(self, part: str) -> list[str]:
        fs, folder = self._fs(f"{self.base}/{part}")
        return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []

    def _remove(self, part: str) -> None:
        fs, folder = self._fs(f"{self.base}/{part}")
        fs.delete(folder, True)

    def committed(self) -> int:
        """The last batch that is done, -1 if none is."""
        return max((int(n) for n in self._names("progress/commits") if n.isdigit()), default=-1)

    # -- tables -------------------------------------------------------------

    def write(self, df: DataFrame, table: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.base}/{table}/batch={batch_id}")

    def read(self, table: str, schema: str, before: int | None = None, since: int = 0) -> DataFrame:
        """The rows of committed batches, or of those since one and before another, with the column batch."""
        end = self.committed() + 1 if before is None else before
        ids = [int(n[6:]) for n in self._names(table) if n.startswith("batch=") and since <= int(n[6:]) < end]
        if not ids:
            return self.spark.createDataFrame([], f"{schema}, batch long")
        return self.spark.read.schema(f"{schema}, batch long").option("basePath", f"{self.base}/{table}").parquet(*(f"{self.base}/{table}/batch={i}" for i in sorted(ids)))

    # -- states -------------------------------------------------------------

    def _snapshots(self, state: str) -> list[tuple[int, int]]:
        """(first batch that isn't in it, parts) of the finished snapshots, in order."""
        found = [n for n in self._names(f"{state}-snapshots") if n.startswith("upto=")]
        done = [n for n in found if "_SUCCESS" in self._names(f"{state}-snapshots/{n}")]
        return sorted(tuple(int(x) for x in n[5:].split("-")) for n in done)

    def _states(self, state: str, schema: str, key: Sequence[str], before: int, keys: DataFrame | None = None) -> DataFrame:
        own = [s for s in self._snapshots(state) if s[0] <= before]
        upto, parts = own[-1] if own else (0, 1)
        rows = self.read(state, schema, before, upto)
        if own:
            snapshot = self.spark.read.schema(f"{schema}, part int").parquet(f"{self.base}/{state}-snapshots/upto={upto}-{parts}")
            if keys is not None and parts > 1:
                hit = [r[0] for r in keys.select(self._part(key, parts, "_")).distinct().collect()]  # parts at most
                snapshot = snapshot.where(F.col("part").isin(hit))
            rows = rows.unionByName(snapshot.drop("part").withColumn("batch", F.lit(-1).cast("long")))
        if keys is not None:
            rows = rows.join(keys, same_key(rows, keys, key), "left_semi")
        return keep_first(rows, list(key), [F.col("batch").desc()]).drop("batch")

    @staticmethod
    def _part(key: Sequence[str], parts: int, before: str = ""):
        return F.pmod(F.xxhash64(*(before + k for k in key)), F.lit(parts)).cast("int").alias("part")

    def states_of(self, batch: DataFrame, state: str, schema: str, key: Sequence[str], batch_id: int) -> DataFrame:
        """The last states, before this batch, of the keys in it."""
        if batch_id == 0:
            return self.spark.createDataFrame([], schema)
        keys = batch.select(*(F.col(k).alias("_" + k) for k in key)).distinct()
        return self._states(state, schema, key, batch_id, keys)

    def states(self, state: str, schema: str, key: Sequence[str]) -> DataFrame:
        """The last states of all keys."""
        return self._states(state, schema, key, self.committed() + 1)

    def compact(self, state: str, schema: str, key: Sequence[str], batch_id: int) -> None:
        """Before a batch: a new snapshot, where the last one is ``EVERY`` batches old, and without what the one before the last replaces."""
        own = self._snapshots(state)
        if batch_id - (own[-1][0] if own else 0) < EVERY:
            return
        full = self._states(state, schema, key, batch_id)
        parts = 1
        n = full.count()
        while parts * PART_ROWS < n:
            parts *= 2
        full.select("*", self._part(key, parts)).repartition(parts, "part").write.mode("overwrite").partitionBy("part").parquet(f"{self.base}/{state}-snapshots/upto={batch_id}-{parts}")
        if own:
            for old, p in own[:-1]:
                self._remove(f"{state}-snapshots/upto={old}-{p}")
            for name in self._names(state):
                if name.startswith("batch=") and int(name[6:]) < own[-1][0]:
                    self._remove(f"{state}/{name}")

    # -- runs ---------------------------------------------------------------

    def drive(self, stream: DataFrame, put: Callable[[DataFrame, int], None], mode: str = "append", every: str | None = None) -> None:
        """Runs the stream over all that is there now; with ``every`` (an interval) for as long as it isn't stopped."""
        trigger = {"processingTime": every} if every else {"availableNow": True}
        def one(batch: DataFrame, batch_id: int) -> None:
            with scope(self.spark):  # what a batch stages goes when its tables are written
                put(batch, batch_id)

        query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{self.base}/progress").foreachBatch(one).trigger(**trigger).start()
        query.awaitTermination()
