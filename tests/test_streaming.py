"""Keyed streaming jobs over several batches, one key with most of the events."""

import datetime as dt
import os
import random
import subprocess
import sys

import duckdb
import pytest

from pyspark.sql import functions as F

from leadloom.queries.registry import REGISTRY
from leadloom.sources import stages
from leadloom.streaming import job, jobs

from . import oracle

DAY = dt.datetime(2024, 1, 1)


def batches(spark, tmp_path, kind, parts):
    """A stream of one file a batch, and its rows batch by batch."""
    folder = tmp_path / "in"
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, f"key bigint, ts timestamp_ntz, attempt bigint, {kind} boolean").coalesce(1).write.mode("append").parquet(str(folder))
    schema = spark.read.parquet(str(folder)).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def events(draw, n, start):
    return [(draw.choice([1, 1, 1, 2, 3]), DAY + dt.timedelta(hours=draw.randrange(200)), start + i, draw.random() < 0.2) for i in range(n)]


def test_retries_over_batches(spark, tmp_path):
    parts = [[(1, DAY, 1, False), (2, DAY, 2, True)], [(1, DAY, 3, False), (2, DAY, 4, False)], [(1, DAY, i, False) for i in range(5, 205)]]
    got = jobs.retries(batches(spark, tmp_path, "ok", parts)).collect()
    rows = sorted(tuple(r) for r in got if r.key == 1)
    assert rows == [(1, "dropped", 3, 3), (1, "pending", 1, 1), (1, "pending", 2, 2)]
    assert [tuple(r) for r in got if r.key == 2] == [(2, "promoted", 0, 1)] * 2


def test_cache_over_batches(spark, tmp_path):
    draw = random.Random(1)
    parts = [events(draw, 400, 1000 * i) for i in range(3)]
    got = {r.attempt: r.hit for r in jobs.ttl_cache(batches(spark, tmp_path, "fill", parts), 2).collect()}
    want, last = {}, {}
    for part in parts:
        for key, ts, attempt, fill in sorted(part, key=lambda r: (r[1], r[2])):
            if fill:
                last[key] = ts
            else:
                want[attempt] = key in last and ts - last[key] <= dt.timedelta(days=2)
    assert got == want


def test_no_task_gathers_a_key(spark):
    """The attempts are limited before the shuffle, and look-ups are ordered in ranges of a key, not per key."""
    rows = spark.range(1000).select((F.col("id") % 2).alias("key"), F.lit(DAY).cast("timestamp_ntz").alias("ts"), F.col("id").alias("attempt"), F.lit(False).alias("ok"))
    known = spark.createDataFrame([], jobs.RETRY_OUT)
    plan = jobs.retry_step(rows, known)[0]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Pandas" not in plan
    known = spark.createDataFrame([], "key bigint, last timestamp_ntz")
    out = jobs.cache_step(2)(rows.withColumnRenamed("ok", "fill"), known)[0]
    assert out.count() == 1000
    assert "Pandas" not in out._jdf.queryExecution().executedPlan().toString()


def files(spark, tmp_path, schema, parts):
    """A stream of one file a batch."""
    folder = tmp_path / "in"
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_sweep_over_batches(spark, tmp_path):
    parts = [[(k % 7, b * 100 + k) for k in range(b, b + 9)] for b in range(3)]
    got = sorted(tuple(r) for r in jobs.sweep(files(spark, tmp_path, "key bigint, n bigint", parts), ["key"], lambda: [F.col("n")]).collect())
    first = {}
    for part in parts:
        for key, n in sorted(part, key=lambda r: r[1]):
            first.setdefault(key, n)
    assert got == sorted(first.items())


RUN = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from leadloom.sources import stages
from leadloom.streaming import job, jobs
base, data, after = sys.argv[1:4]
job.shared_dir = lambda spark: base
job.EVERY = 2
write = job.Job.write
def die(self, df, table, batch_id):
    write(self, df, table, batch_id)
    if batch_id == int(after) and table == "keyed":
        os._exit(9)  # the batch has written some of its tables and isn't committed
job.Job.write = die
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
stream = spark.readStream.schema("key bigint, ts timestamp, n bigint").option("maxFilesPerTrigger", 1).parquet(data)
jobs.sweep(stream, ["key"], lambda: [F.col("n")], name="sweep")
"""


def test_a_killed_job_goes_on_in_another_session(spark, tmp_path, monkeypatch):
    """A process dies in the middle of batch 5; this one ends the job."""
    draw = random.Random(8)
    parts = [[(draw.randrange(60), DAY, 1000 * b + i) for i in range(12)] for b in range(9)]
    stream = files(spark, tmp_path, "key bigint, ts timestamp, n bigint", parts)
    script = tmp_path / "run.py"
    script.write_text(RUN)
    done = subprocess.run([sys.executable, str(script), f"file://{tmp_path}/shared", f"{tmp_path}/in", "5"], env={**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)}, capture_output=True)
    assert done.returncode == 9, done.stderr[-2000:]
    monkeypatch.setattr(job, "shared_dir", lambda spark: f"file://{tmp_path}/shared")
    monkeypatch.setattr(job, "EVERY", 2)
    halfway = job.Job(spark, "sweep")
    assert halfway.committed() == 4
    seen = {r.n for r in halfway.read("table", "key bigint, ts timestamp, n bigint").collect()}
    assert max(seen) < 5000  # what batch 5 has written isn't shown
    got = sorted((r.key, r.n) for r in jobs.sweep(stream, ["key"], lambda: [F.col("n")], name="sweep").collect())
    first = {}
    for part in parts:
        for key, _, n in sorted(part, key=lambda r: r[2]):
            first.setdefault(key, n)
    assert got == sorted(first.items())
    # states are compacted: the last two snapshots stay, and the batches that they don't hold
    assert [s[0] for s in halfway._snapshots("keyed")] == [6, 8] and min(int(n[6:]) for n in halfway._names("keyed") if n.startswith("batch=")) == 6
    again = jobs.sweep(stream, ["key"], lambda: [F.col("n")], name="sweep")
    assert sorted((r.key, r.n) for r in again.collect()) == got


def test_snapshots_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(job, "PART_ROWS", 5)
    monkeypatch.setattr(job, "EVERY", 1)
    parts = [[(k, b * 100 + k) for k in range(b * 7, b * 7 + 10)] for b in range(4)]
    rows = jobs.sweep(files(spark, tmp_path, "key bigint, n bigint", parts), ["key"], lambda: [F.col("n")]).collect()
    assert sorted(r.key for r in rows) == list(range(31)) and {r.n for r in rows if r.key in (7, 8, 9)} == {7, 8, 9}


def test_null_keys_are_one_key(spark, tmp_path):
    parts = [[(None, 1), (1, 2)], [(None, 3), (2, 4)]]
    got = {(r.key, r.n) for r in jobs.sweep(files(spark, tmp_path, "key bigint, n bigint", parts), ["key"], lambda: [F.col("n")]).collect()}
    assert got == {(None, 1), (1, 2), (2, 4)}


@pytest.mark.parametrize("order", [(5, 1, 2), (1, 2, 5), (2, 5, 1)])
def test_counts_lose_no_late_rows(spark, tmp_path, order):
    parts = [[(d, dt.datetime(2024, 1, d, h), h) for h in range(4)] for d in order]
    stream = files(spark, tmp_path, "key bigint, ts timestamp, n bigint", parts)
    assert {r.start.day: r.n for r in jobs.counts(stream, "ts", "1 day").collect()} == {1: 4, 2: 4, 5: 4}
    closed, late, open_ = jobs.closed_counts(stream, "ts", "1 day", "1 hour")
    over, missed, still = {r.start.day: r.n for r in closed.collect()}, [r.key for r in late.collect()], {r.start.day: r.n for r in open_.collect()}
    assert still == {5: 4} and sum(over.values()) + len(missed) == 8
    assert (over, missed) == {(5, 1, 2): ({}, [1] * 4 + [2] * 4), (1, 2, 5): ({1: 4, 2: 4}, []), (2, 5, 1): ({2: 4}, [1] * 4)}[order]


def test_closed_counts_and_null_times(spark, tmp_path):
    parts = [[(1, DAY, 1), (1, None, 2)], [(2, DAY + dt.timedelta(days=3), 3), (1, DAY, 4)], [(1, DAY, 5)]]
    closed, late, open_ = jobs.closed_counts(files(spark, tmp_path, "key bigint, ts timestamp, n bigint", parts), "ts", "1 day", "0 hours", "key")
    assert [(r.key, r.n) for r in closed.collect()] == [(1, 2)] and sorted(r.n for r in late.collect()) == [2, 5] and [(r.key, r.n) for r in open_.collect()] == [(2, 1)]


def test_claims_are_released_by_others_time(spark, tmp_path):
    """Key 1 is released by key 2's rows, without another row of its own; what is open is not stale; a late row is kept apart."""
    hour = dt.timedelta(hours=1)
    parts = [[(1, DAY, 1), (1, DAY + hour / 4, 2)], [(2, DAY + 3 * hour, 3)], [(1, DAY + hour / 2, 4), (2, DAY + 3.2 * hour, 5)], [(1, None, 6)]]
    released, open_, late = jobs.stale_claims(files(spark, tmp_path, "key bigint, ts timestamp, n bigint", parts), "key", "ts", "15 minutes")
    assert [(r.key, r.start, r.end, r.n) for r in released.collect()] == [(1, DAY, DAY + hour / 2, 2)]
    assert [(r.key, r.n) for r in open_.collect()] == [(2, 2)] and sorted(r.n for r in late.collect()) == [4, 6]


def test_the_claims_query_gives_every_span(spark, tmp_path):
    """Released and open spans and rows without a time, none left out: cases by hand, and the query's SQL; null is a key, a gap of exactly six hours is none."""
    us, hour = dt.timedelta(microseconds=1), dt.timedelta(hours=1)
    times = {1: [DAY, DAY, DAY + 6 * hour, DAY + 12 * hour + us], 2: [DAY + 24 * hour], 3: [DAY + 18 * hour], 4: [DAY + 18 * hour + us, None, None], None: [DAY + 3 * hour, DAY + 23 * hour, None], 5: [dt.datetime(1969, 12, 31, 23)]}
    rows = [(i, ts, key) for i, (key, ts) in enumerate((key, ts) for key, all_ in times.items() for ts in all_)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    text = lambda ts: ts and ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    span = lambda kind, key, a, b, n: (kind, key, text(a), text(b and b + 6 * hour), n)
    late = [span("late", key, None, None, 1) for key in (4, 4, None)]
    released = [span("released", 1, DAY, DAY + 6 * hour, 3), span("released", 1, times[1][3], times[1][3], 1), span("released", 3, times[3][0], times[3][0], 1), span("released", None, times[None][0], times[None][0], 1), span("released", 5, times[5][0], times[5][0], 1)]
    still = [span("open", 2, times[2][0], times[2][0], 1), span("open", 4, times[4][0], times[4][0], 1), span("open", None, times[None][1], times[None][1], 1)]
    df = REGISTRY.queries["y07_stale_claims"](spark, str(tmp_path))
    assert sorted(map(tuple, df.select("kind", "user_id", "start", "end", "n").collect()), key=repr) == sorted(late + released + still, key=repr)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    oracle.assert_same(df, con, REGISTRY.sql["y07_stale_claims"])


def test_the_claims_of_a_table_hold_all_its_events(spark):
    df = REGISTRY.queries["y07_stale_claims"](spark, "/root/testdata/sf0.001")
    by = {r.user_id: (r.n, r.last) for r in df.groupBy("user_id").agg(F.sum("n").alias("n"), F.max("end").alias("last")).collect()}
    every = spark.read.parquet("/root/testdata/sf0.001/events.parquet").groupBy("user_id").agg(F.count("*").alias("n"), F.date_format(F.max("ts") + F.expr("interval 6 hours"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last"))
    assert by == {r.user_id: (r.n, r.last) for r in every.collect()}
    assert {r.kind for r in df.select("kind").distinct().collect()} == {"released", "open"}


def test_task_queue(spark, tmp_path):
    at = lambda h: DAY + dt.timedelta(hours=h)
    bad = [(1, "timeout"), (1, "NO_CONTACT here"), (2, "garbage-host"), (3, "500"), (3, "500"), (3, "x" * 2000), (4, "no usable domain"), (5, None), (5, "")]
    rows = [(k, at(i), i, False, m) for i, (k, m) in enumerate(bad)] + [(5, at(20), 20, True, None), (1, at(21), 21, True, None), (6, at(1), 1, True, None), (7, at(2), 2, False, "retry")]
    for parts in ([rows], [rows[:4], rows[4:9], rows[9:]]):
        folder = tmp_path / str(len(parts))
        folder.mkdir()
        last, dead = jobs.task_queue(files(spark, folder, "key bigint, ts timestamp_ntz, attempt bigint, ok boolean, message string", parts))
        got = {r.key: (r.status, r.retries) for r in last.collect()}
        assert got == {1: ("failed", 2), 2: ("failed", 1), 3: ("failed", 3), 4: ("failed", 1), 5: ("done", 2), 6: ("done", 0), 7: ("pending", 1)}
        letters = {r.key: (r.reason, len(r.error), r.ts) for r in dead.collect()}
        assert letters == {1: ("no_contact", 15, at(1)), 2: ("unusable_domain", 12, at(2)), 3: ("max_retries", 1000, at(5)), 4: ("unusable_domain", 16, at(6))}


def test_promotion(spark):
    rows = spark.createDataFrame([(1, True, 80, None, "qualified"), (2, True, None, 69.0, "qualified"), (3, True, None, None, "premium"), (4, True, 90, 10.0, "unqualified"), (5, False, 90, 10.0, "premium"), (6, True, None, 70.0, "premium"), (7, None, 90, 1.0, "premium")], "k int, has_contact boolean, confidence_score int, score double, grade string")
    assert [r.k for r in rows.where(jobs.promotion_ok()).orderBy("k").collect()] == [1, 6]


def test_latest_stale_and_counts_over_batches(spark, tmp_path):
    draw, hour = random.Random(4), dt.timedelta(hours=1)
    rows = sorted((DAY + draw.randrange(900) * hour / 4, draw.randrange(4)) for _ in range(300))
    parts = [[(k, ts, n * 100 + i) for i, (ts, k) in enumerate(rows[n * 100 : n * 100 + 100])] for n in range(3)]
    every = [r for part in parts for r in part]
    stream = files(spark, tmp_path, "key bigint, ts timestamp, n bigint", parts)
    got = {r.key: (r.n_last, r.n) for r in jobs.latest(stream.withColumnRenamed("n", "n_last").withColumn("at", F.col("n_last")), ["key"], "at", "n_last").collect()}
    assert got == {k: (max(n for key, _, n in every if key == k), sum(key == k for key, _, _ in every)) for k in range(4)}
    spans = []
    for k in range(4):
        for ts in sorted(t for key, t, _ in every if key == k):
            if spans and spans[-1][0] == k and ts - spans[-1][2] <= 6 * hour:
                spans[-1][2:] = [ts, spans[-1][3] + 1]
            else:
                spans.append([k, ts, ts, 1])
    want = sorted((k, a, b + 6 * hour, n) for k, a, b, n in spans)
    released, open_, late = jobs.stale_claims(stream, "key", "ts", "6 hours")
    now = max(ts for _, ts, _ in every)
    row = lambda r: (r.key, r.start, r.end, r.n)
    assert sorted(map(row, released.collect())) == [w for w in want if w[2] <= now]
    assert sorted(map(row, open_.collect())) == [w for w in want if w[2] > now] and late.count() == 0
    days = {r.start.date(): r.n for r in jobs.counts(stream, "ts", "1 day").collect()}
    assert sum(days.values()) == 300 and len(days) == len({ts.date() for _, ts, _ in every})


def test_negatives_over_batches(spark, tmp_path):
    parts = [[(1, "Red bolt"), (2, None), (3, "ab")], [(4, "gear"), (5, "BOLT"), (6, "")]]
    words = lambda s: s.createDataFrame([("bolt",), ("ab",), ("",), ("zzz",)], "word string")
    stream = files(spark, tmp_path, "id bigint, text string", parts)
    for limits in ({}, {"few": 0}, {"few": 0, "most_chars": 3}):
        assert sorted(r.id for r in jobs.without_negatives(stream, words, **limits).collect()) == [2, 4, 6]


def test_stages_of_a_scope_are_deleted(spark):
    df = spark.range(5)
    with stages.scope(spark):
        kept, gone = stages.stage(df, "kept", keep=True), stages.stage(df, "gone")
        assert kept.count() == gone.count() == 5
    assert kept.count() == 5
    with pytest.raises(Exception, match="(?i)not exist|not found|FILE"):
        spark.read.parquet(gone.inputFiles()[0])
