"""Outputs and cleaned fields: results written by hand."""

import datetime as dt
import json

from pyspark.sql import functions as F

from leadloom.functions.dialect import SPARK
from leadloom.operators import outputs as O


def test_persons(spark):
    rows = [(1, "a@x.com", None, None, None, None), (2, None, None, "https://linkedin.com/in/x", "s", 250), (3, "", "", "", "", 5), (4, None, "+1", "", "https://facebook.com/x", -4), (5, None, None, None, "https://www.linkedin.com/company/y", 85)]
    df = spark.createDataFrame(rows, "lead_id int, primary_email string, primary_phone string, linkedin_url string, source_url string, confidence_score int")
    got = {r.lead_id: (r.linkedin, r.confidence, r.tier) for r in O.persons(df).collect()}
    assert got == {1: (None, 0.6, "fallback_search"), 2: ("https://linkedin.com/in/x", 1.0, "primary_api"), 4: ("https://facebook.com/x", 0.0, "fallback_search"), 5: ("https://www.linkedin.com/company/y", 0.85, "primary_api")}


def test_funnel_order_and_stage(spark):
    steps = {1: ["step2", "step0", "step1"], 2: ["other", "step5", "step1", "step4"], 3: ["step0"], 4: ["step4"], 5: ["step3", "zz", "aa"]}
    df = spark.createDataFrame([(k, s, i) for k, ss in steps.items() for i, s in enumerate(ss)], "job int, step string, n int")
    got = {r.job: ([s.step for s in r.steps], r.stage) for r in O.funnel(df, "job", "step", "n").collect()}
    assert got == {1: (["step0", "step1", "step2"], "parsing"), 2: (["step1", "step4", "step5", "other"], "persisting"), 3: (["step0"], None), 4: (["step4"], "scoring"), 5: (["step3", "aa", "zz"], "parsing")}


def test_notifications(spark):
    df = spark.createDataFrame([(1, "u", "flour", "SG", 0), (2, "u", "x", "y", 1), (3, None, "x", "y", 0), (4, "v", None, "DE", 0)], "job_id int, requested_by string, category string, country string, n_open int")
    got = {(r.biz_id, r.recipient, r.body, r.status) for r in O.notifications(df).collect()}
    assert got == {(1, "u", "「flour / SG」", "unread"), (4, "v", "「 / DE」", "unread")}


def test_adapters(spark):
    adapters = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 0.0), ("d", 1.0)], "adapter string, cost double")
    attempts = spark.createDataFrame([("a", True)] + [("a", False)] * 3 + [("b", False)] * 4 + [("c", False)], "adapter string, hit boolean")
    got = [(r.adapter, r.attempts, r.rate, r.expected) for r in O.ordered_adapters(adapters, attempts).orderBy("rank").collect()]
    assert got == [("c", 1, 0.0, 0.0), ("d", 0, None, 2.0), ("a", 4, 0.25, 4.0), ("b", 4, 0.0, 40.0)]
    cached = spark.createDataFrame([(1, "b"), (2, None), (3, "gone")], "key int, adapter string")
    orders = {k: [] for k in (1, 2, 3)}
    for r in O.ordered_adapters(adapters, attempts, cached).orderBy("key", "rank").collect():
        orders[r.key].append(r.adapter)
    assert orders == {1: ["b", "c", "d", "a"], 2: ["c", "d", "a", "b"], 3: ["c", "d", "a", "b"]}


def test_looks_found(spark):
    rows = [("CNPJ 12345678000199 ativa", "12.345", False), ("x AB123456789 y", "ab12345699", True), ("ab123456 Error", "ab123456", False), ("ab123456 No se encontró", "ab123456", False), (None, "1", False), ("abc", "", False), ("abc", None, False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "body string, id string")
    assert [r[0] for r in df.selectExpr(O.looks_found(SPARK, "body", "id")).collect()] == [w for _, _, w in rows]


def test_profile_list(spark):
    df = spark.createDataFrame([(" https://A.com/x ", "ftp://b", "HTTPS://a.com/X", "https://c.com/" + "y" * 600, "http://d.com"), (None, None, "", "x", " "), ("https://1", "https://2", "https://3", "https://4", None)], "a string, b string, c string, d string, e string")
    got = [r[0] for r in df.selectExpr(O.profile_list(SPARK, ["a", "b", "c", "d", "e"])).collect()]
    assert got == [["https://A.com/x", ("https://c.com/" + "y" * 600)[:500], "http://d.com"], [], ["https://1", "https://2", "https://3"]]


def test_evidence_fields(spark):
    fields = O.evidence_fields(SPARK, reason="a", extracted_industry="a", source_text="a")
    df = spark.createDataFrame([(" " + "x" * 500 + " ",), ("  ",), (None,)], "a string").selectExpr(*(f"{x} as {n}" for n, x in fields.items()))
    assert [tuple(None if v is None else len(v) for v in r) for r in df.collect()] == [(200, 80, 400), (None, None, None), (None, None, None)]


def test_subcategories(spark):
    doc = {"industries": {"Food": {"subcategories": ["Flour", "Oil"]}, "Toys": {"subcategories": "dolls  cars "}, "Steel": {"subcategories": []}, "Glass": {}, "Wood": {"subcategories": 5}}}
    df = spark.createDataFrame([(json.dumps(doc),), ("broken",), ('{"industries": []}',), (None,)], "value string")
    got = sorted((r.industry, r.pos, r.category) for r in O.subcategories(df).collect())
    assert got == [("Food", 0, "Flour"), ("Food", 1, "Oil"), ("Glass", 0, "Glass"), ("Steel", 0, "Steel"), ("Toys", 0, "dolls"), ("Toys", 1, "cars"), ("Wood", 0, "Wood")]


def test_name_drift(spark):
    rows = [("Acme  Ltd", "acme ltd ", False), ("Acme", "Acne", True), ("", "x", False), (None, "x", False), ("x", " ", False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "a string, b string")
    assert [bool(r[0]) for r in df.select(O.name_drift(F.col("a"), F.col("b"))).collect()] == [w for _, _, w in rows]


def test_inference_cache(spark):
    now = dt.datetime(2024, 2, 1)
    leads = spark.createDataFrame([(1, " ACME  Ltd ", "Flour", False), (2, "acme ltd", "flour ", True), (3, "Old", "flour", False), (4, "None", "flour", False)], "id int, name string, category string, supplier boolean").withColumn("key", F.expr(O.inference_key(SPARK, "name", "category", "supplier")))
    assert [r.key for r in leads.orderBy("id").collect()] == ["acme ltd|flour|buy", "acme ltd|flour|sup", "old|flour|buy", "none|flour|buy"]
    cache = spark.createDataFrame([("acme ltd|flour|buy", "v1", now - dt.timedelta(days=3)), ("acme ltd|flour|buy", "v0", now - dt.timedelta(days=9)), ("old|flour|buy", "v", now - dt.timedelta(days=31)), ("none|flour|buy", None, now)], "key string, value string, cached_at timestamp")
    hits, misses = O.with_inference(leads, cache, F.lit(now))
    assert [(r.id, r.value) for r in hits.collect()] == [(1, "v1")] and sorted(r.id for r in misses.collect()) == [2, 3, 4]
