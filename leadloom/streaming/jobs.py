"""Streaming jobs of the pipeline.

A job reads a table's folder as a stream, keeps its state per key, and writes to
tables of the shared folder (``job.Job``). A job with a ``name`` that is taken up again goes
on where it stopped, also in another session; without a name every call is a new job.
It runs over all that is there now; in production the trigger is an interval.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keep import keep_first, keep_top
from ..operators.words import without_words
from ..sources.stages import stage
from .job import Job, ddl, same_key


def source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over the Parquet files at a path (a file or a folder)."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path + "*")


def run(stream: DataFrame, mode: str, write: Callable[[DataFrame], DataFrame] | None = None, key: list[str] | None = None, name: str | None = None) -> DataFrame:
    """Runs the stream and returns the table it wrote; ``write`` changes a batch's rows before. With ``key`` a batch's rows are updates of the row per key."""
    job, columns = Job(stream.sparkSession, name), ddl(stream)

    def put(batch: DataFrame, batch_id: int) -> None:
        if key is not None:
            job.compact("table", columns, key, batch_id)
        job.write(batch if write is None else write(batch), "table", batch_id)

    job.drive(stream, put, mode)
    return job.states("table", columns, key) if key is not None else job.read("table", columns).drop("batch")


def sweep(stream: DataFrame, key: list[str], order: Callable[[], list], name: str | None = None) -> DataFrame:
    """One row per key over all batches, the first that came; of a batch's the first in order. What is there stays."""
    job, columns = Job(stream.sparkSession, name), ddl(stream)
    keys = ddl(stream.select(*key))

    def put(batch: DataFrame, batch_id: int) -> None:
        job.compact("keyed", keys, key, batch_id)
        first = keep_first(batch, key, order())
        if batch_id > 0:
            first = stage(first, "batch")
            known = job.states_of(first, "keyed", keys, key, batch_id).select(*(F.col(k).alias("_" + k) for k in key))
            first = first.join(known, same_key(first, known, key), "left_anti")
        job.write(first, "table", batch_id)
        job.write(job.read("table", columns, batch_id + 1, batch_id).select(*key), "keyed", batch_id)

    job.drive(stream, put)
    return job.read("table", columns).drop("batch")


def run_keyed(stream: DataFrame, out_schema: str, state_schema: str, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], name: str | None = None) -> DataFrame:
    """Runs the stream with one row of state per ``key`` and returns the table of all batches' rows.

    step takes a batch and its keys' last states and gives the batch's rows and the
    states that it changes.
    """
    job = Job(stream.sparkSession, name)

    def put(batch: DataFrame, batch_id: int) -> None:
        job.compact("keyed", state_schema, ["key"], batch_id)
        out, changed = step(batch, job.states_of(batch, "keyed", state_schema, ["key"], batch_id))
        job.write(changed, "keyed", batch_id)
        job.write(out, "table", batch_id)

    job.drive(stream, put)
    return job.read("table", out_schema).drop("batch")


RETRY_OUT = "key bigint, status string, retries int, attempts int"


def retry_step(batch: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attempts in order change a key's status until it is promoted or dropped; three at most count, and only they are grouped."""
    first = keep_top(batch, ["key"], [F.col("ts").asc_nulls_last(), F.col("attempt").asc_nulls_last()], 3)
    oks = first.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.coalesce("ok", F.lit(False)).alias("ok")))), lambda x: x["ok"]).alias("oks"))
    before = known.select(F.col("key").alias("_key"), "status", "retries", "attempts")
    new = F.struct(F.lit("pending").alias("status"), F.lit(0).alias("retries"), F.lit(0).alias("attempts"))
    state = F.when(F.col("status").isNull(), new).otherwise(F.struct("status", "retries", "attempts"))

    def step(acc, ok):
        retries = acc["retries"] + (~ok).cast("int")
        status = F.when(ok, F.lit("promoted")).when(retries >= 3, F.lit("dropped")).otherwise(F.lit("pending"))
        return F.when(acc["status"] != "pending", acc).otherwise(F.struct(status.alias("status"), retries.alias("retries"), (acc["attempts"] + 1).alias("attempts")))

    out = oks.join(before, oks["key"].eqNullSafe(before["_key"]), "left").select("key", F.aggregate("oks", state, step).alias("s")).select("key", "s.status", "s.retries", "s.attempts")
    return out, out


def retries(stream: DataFrame, name: str | None = None) -> DataFrame:
    """Status per key after all attempts; stream: key, ts, attempt, ok."""
    return run_keyed(stream, RETRY_OUT, RETRY_OUT, retry_step, name)


#: Messages for which a task is dead at once, by reason, and the most tries of others.
DEAD_NOW = {"no_contact": "(?i)no_contact", "unusable_domain": "(?i)unusable_domain|garbage.?host|no.?usable.?domain"}
MOST_TRIES = 3
TASK = "key bigint, status string, retries int, error string, ts timestamp_ntz"


def task_step(batch: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Y02, tasks of a queue: done ends one; a failure for which trying again is no use or the third one makes it failed for good, others leave it pending.

    Three attempts at most count of a key, and only they are grouped.
    """
    first = keep_top(batch, ["key"], [F.col("ts").asc_nulls_last(), F.col("attempt").asc_nulls_last()], MOST_TRIES)
    one = F.struct("rank", F.coalesce("ok", F.lit(False)).alias("ok"), F.substring("message", 1, 1000).alias("message"), "ts")
    tries = first.groupBy("key").agg(F.sort_array(F.collect_list(one)).alias("tries"))
    before = known.select(F.col("key").alias("_key"), "status", "retries", "error", "ts")
    state = "struct<status:string,retries:int,error:string,ts:timestamp_ntz>"
    start = F.struct(F.coalesce("status", F.lit("pending")).alias("status"), F.coalesce("retries", F.lit(0)).alias("retries"), "error", "ts").cast(state)

    def step(acc, x):
        hopeless = F.lit(False)
        for pattern in DEAD_NOW.values():
            hopeless = hopeless | F.coalesce(x["message"].rlike(pattern), F.lit(False))
        failed = F.struct(F.when(hopeless | (acc["retries"] + 1 >= MOST_TRIES), "failed").otherwise("pending").alias("status"), (acc["retries"] + 1).alias("retries"), x["message"].alias("error"), x["ts"].alias("ts")).cast(state)
        done = F.struct(F.lit("done").alias("status"), acc["retries"].alias("retries"), F.lit(None).cast("string").alias("error"), x["ts"].alias("ts")).cast(state)
        return F.when(acc["status"] != "pending", acc).when(x["ok"], done).otherwise(failed)

    out = tries.join(before, tries["key"].eqNullSafe(before["_key"]), "left").select("key", F.aggregate("tries", start, step).alias("s"), F.coalesce("status", F.lit("pending")).alias("was"))
    changed = stage(out.where("was = 'pending'").select("key", "s.*"), "tasks")
    return changed, changed


def dead_reason(error) -> F.Column:
    out = F.lit("max_retries")
    for reason, pattern in reversed(DEAD_NOW.items()):
        out = F.when(F.coalesce(error.rlike(pattern), F.lit(False)), reason).otherwise(out)
    return out


def task_queue(stream: DataFrame, name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The last status of every task, and the dead letters: (key, reason, error, ts) of those that failed for good. stream: key, ts, attempt, ok, message."""
    changes = run_keyed(stream, TASK, TASK, task_step, name).withColumn("order", F.struct(F.col("status") != "pending", "retries"))
    last = keep_first(changes, ["key"], [F.col("order").desc()]).drop("order")
    dead = changes.where("status = 'failed'").select("key", dead_reason(F.col("error")).alias("reason"), "error", "ts")
    return last, dead


def promotion_ok(lead_columns: str = "", least: int = 70) -> F.Column:
    """An attempt that promotes a queued company: a contact, a score of at least ``least`` (its own, else the queue's, else 50) and a grade that isn't unqualified."""
    score = F.coalesce(F.col(lead_columns + "confidence_score").cast("double"), F.col("score").cast("double"), F.lit(50.0))
    return F.coalesce(F.col("has_contact") & (score >= least) & (F.col("grade") != "unqualified"), F.lit(False))


CACHE_OUT = "attempt bigint, hit boolean"


def cache_step(days: int) -> Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    def step(batch: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
        """A fill is kept for the TTL, other events are hits as long as it lasts.

        Events are dealt by range of key and order, the known fill first, so a key
        may spread over many ranges; a range's look-ups before its first fill get
        the last fill of the ranges before.
        """
        order = ["old", "ts", "attempt"]
        events = batch.select("key", F.lit(1).alias("old"), "ts", "attempt", F.when(F.col("fill"), F.col("ts")).alias("filled"), (~F.coalesce("fill", F.lit(False))).alias("asked"))
        first = known.select("key", F.lit(0).alias("old"), F.col("last").alias("ts"), F.lit(None).cast(batch.schema["attempt"].dataType).alias("attempt"), F.col("last").alias("filled"), F.lit(False).alias("asked"))
        rows = stage(events.unionByName(first).repartitionByRange("key", *order).withColumn("range", F.spark_partition_id()), "cache")
        fills = rows.groupBy("key", "range").agg(F.max_by("filled", F.when(F.col("filled").isNotNull(), F.struct(*order))).alias("filled"))
        earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        carry = fills.select(F.col("key").alias("_key"), F.col("range").alias("_range"), F.last("filled", ignorenulls=True).over(earlier("key").orderBy("range")).alias("carried")).where("carried is not null")
        inside = rows.withColumn("last", F.last("filled", ignorenulls=True).over(earlier("key", "range").orderBy(*order)))
        placed = inside.join(F.broadcast(carry), inside["key"].eqNullSafe(carry["_key"]) & (inside["range"] == carry["_range"]), "left").where("asked")
        hit = F.col("ts") - F.coalesce("last", "carried") <= F.expr(f"interval {days} days")
        changed = fills.where("filled is not null").groupBy("key").agg(F.max_by("filled", "range").alias("last"))
        return placed.select("attempt", F.coalesce(hit, F.lit(False)).alias("hit")), changed

    return step


def ttl_cache(stream: DataFrame, days: int, name: str | None = None) -> DataFrame:
    """For each look-up whether the key's last fill was at most so many days old; stream: key, ts, attempt, fill."""
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    return run_keyed(stream, CACHE_OUT, f"key {kinds['key']}, last {kinds['ts']}", cache_step(days), name)


def without_negatives(stream: DataFrame, words: Callable[[SparkSession], DataFrame], name: str | None = None, **limits: int) -> DataFrame:
    """Rows whose text holds none of the words, which are read anew for every batch; words: one column, word; limits as of without_words."""
    return run(stream, "append", lambda batch: without_words(batch, "text", words(batch.sparkSession), **limits), name=name)


def latest(stream: DataFrame, key: list[str], order: str, value: str, name: str | None = None) -> DataFrame:
    """The last value per key; every batch writes the keys that changed."""
    updates = stream.groupBy(*key).agg(F.max_by(value, order).alias(value), F.count("*").alias("n"))
    return run(updates, "update", key=key, name=name)


def counts(stream: DataFrame, ts: str, width: str, *by: str, name: str | None = None) -> DataFrame:
    """Rows per window and key, whenever they come; every batch writes the windows that changed."""
    updates = stream.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")
    return run(updates, "update", key=["start", *by], name=name)


def _mark(job: Job, batch: DataFrame, ts: str, batch_id: int):
    """The latest time seen before this batch and after it; the one before is read from the batch before, so a repeated batch sees the same."""
    before = None if batch_id == 0 else job.read("mark", "seen timestamp", batch_id, batch_id - 1).first()["seen"]
    own = batch.agg(F.max(ts).alias("seen")).first()["seen"]
    after = max((x for x in (before, own) if x is not None), default=None)
    job.write(job.spark.createDataFrame([(after,)], "seen timestamp").coalesce(1), "mark", batch_id)
    return before, after


def _at(seen, delay: str) -> F.Column:
    return F.lit(seen).cast("timestamp") - F.expr(f"interval {delay}")


def closed_counts(stream: DataFrame, ts: str, width: str, delay: str, *by: str, name: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows per window and key, given once, when the window is over: its end is at least ``delay`` before the latest time seen.

    Gives the closed windows, the late rows, whose window was over before their batch began and which
    no count holds, and the windows still open. The three hold every row with a time once; rows without one are late.
    Open windows, of ``delay`` and ``width`` at most, are the state.
    """
    job, columns = Job(stream.sparkSession, name), ddl(stream)
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    out = ", ".join(["start timestamp", "end timestamp", *(f"`{c}` {kinds[c]}" for c in by), "n bigint"])

    def put(batch: DataFrame, batch_id: int) -> None:
        before, after = _mark(job, batch, ts, batch_id)
        rows = batch.withColumn("_w", F.window(F.col(ts).cast("timestamp"), width))  # drops rows without a time
        late = F.col("_w.end") <= _at(before, delay) if before is not None else F.lit(False)
        job.write(rows.where(late).select(*batch.columns).unionByName(batch.where(F.col(ts).isNull())), "late", batch_id)
        own = rows.where(~late).groupBy(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *by).agg(F.count("*").alias("n"))
        known = job.read("open", out, batch_id, batch_id - 1).drop("batch")
        summed = stage(own.unionByName(known).groupBy("start", "end", *by).agg(F.sum("n").alias("n")), "windows")
        over = F.col("end") <= _at(after, delay) if after is not None else F.lit(False)
        job.write(summed.where(over), "closed", batch_id)
        job.write(summed.where(~over), "open", batch_id)

    job.drive(stream, put)
    last = job.committed()
    return job.read("closed", out).drop("batch"), job.read("late", columns).drop("batch"), job.read("open", out, since=last).drop("batch")


def stale_claims(stream: DataFrame, key: str, ts: str, gap: str, delay: str = "0 seconds", name: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spans of activity per key that are over because nothing came for the gap.

    Time is the latest seen in any key's rows, less ``delay``; a span is released once its end is no later, so also when
    nothing more comes for its key. Gives the released spans, the spans still open (start, end, n) and the late rows: those
    whose own span was over before their batch began. Every row with a time is in one of them, as are late those without. Open spans, of keys active within the gap, are the state.
    """
    job, columns = Job(stream.sparkSession, name), ddl(stream)
    out = f"`{key}` {stream.schema[key].dataType.simpleString()}, start timestamp, end timestamp, n bigint"

    def put(batch: DataFrame, batch_id: int) -> None:
        before, after = _mark(job, batch, ts, batch_id)
        time = F.col(ts).cast("timestamp")
        late = F.col(ts).isNull() | (F.coalesce(time + F.expr(f"interval {gap}") <= _at(before, delay), F.lit(False)) if before is not None else F.lit(False))
        job.write(batch.where(late), "late", batch_id)
        # a batch's rows are added up to spans before they are shuffled, and these joined to the open ones
        own = batch.where(~late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
        spans = own.unionByName(job.read("open", out, batch_id, batch_id - 1).drop("batch"))
        along = Window.partitionBy(key).orderBy("start", "end")
        reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
        marked = spans.withColumn("_new", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int")).withColumn("_span", F.sum("_new").over(along))
        merged = stage(marked.groupBy(key, "_span").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("_span"), "spans")
        over = F.col("end") <= _at(after, delay) if after is not None else F.lit(False)
        job.write(merged.where(over), "released", batch_id)
        job.write(merged.where(~over), "open", batch_id)

    job.drive(stream, put)
    last = job.committed()
    return job.read("released", out).drop("batch"), job.read("open", out, since=last).drop("batch"), job.read("late", columns).drop("batch")
