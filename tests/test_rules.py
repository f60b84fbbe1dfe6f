"""Cases of single rules with the values they must give."""

import pytest
from pyspark.sql import functions as F

from leadloom.functions import emails, predicates, scores, texts
from leadloom.functions.dialect import SPARK as D
from leadloom.functions.register import column, register_sql
from leadloom.operators import gate, joins, keep, select
from leadloom.sources import tables


def values(spark, expr, xs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")
    return [r.v for r in df.selectExpr("i", f"{expr} as v").orderBy("i").collect()]


def test_canonical_names(spark):
    xs = ["Acme Ltd", "  Foo   Bar, Inc. ", "texas", "costco", "foo co., ltd", None, "LLC", "Müller GmbH"]
    assert values(spark, texts.canonical_name(D, "x"), xs) == ["acme", "foo bar", "tex", "cost", "foo co", "", "", "müller"]
    assert values(spark, texts.canonical_name(D, "x", strict=True), ["texas", "costco", "acme ltd"]) == ["texas", "costco", "acme"]


def test_hosts(spark):
    xs = ["https://www.Foo.com:8080/a?b", "foo.org/x", None, "", "a_b.com", "http://x.co.uk#y"]
    assert values(spark, texts.host(D, "x"), xs) == ["foo.com", "foo.org", "", "", "a_b.com", "x.co.uk"]


def test_link_to_home(spark):
    xs = ["https://a.com/files/x.pdf", "https://a.com/wp-content/y", "https://a.com/about", "not a url"]
    assert values(spark, texts.link_to_home(D, "x"), xs) == ["https://a.com", "https://a.com", "https://a.com/about", "not a url"]


def test_junk_domains(spark):
    xs = ["scribd.com", "https://www.reddit.com/r/x", "mattress.com", "北京市朝阳区", "nodot", None, "", "xn--" + "a" * 30 + ".com", "blog.wordpress.com"]
    assert values(spark, predicates.junk_domain(D, "x"), xs) == [True, True, False, True, True, False, False, True, True]


def test_junk_names(spark):
    xs = ["ab", "unknown", "12345", "***", None, "Acme", "公司名", "N/A"]
    assert values(spark, predicates.junk_name(D, "x"), xs) == [True, True, True, True, True, False, False, True]


def test_purchase_cycles(spark):
    xs = ["weekly", "Bi-Weekly", "bi-weekly order", "every month", "half year", "annually", "never", None, ""]
    assert values(spark, texts.purchase_cycle("x"), xs) == ["weekly", "monthly", "weekly", "monthly", "quarterly", "annual", None, None, None]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [("新加坡有没有白菜", "白菜"), ("SG 土豆", "土豆"), ("cabbage buyers in Singapore", "cabbage"), ("日本大米", "日本大米"), ("有没有日本大米", "日本大米"), ("护肤 买家", "护肤"), ("Singapore cabbage", "cabbage"), ("furniture importers", "furniture"), ("rice in Vietnam", "rice"), ("", "")],
)
def test_search_text_to_category(spark, raw, clean):
    assert values(spark, texts.plain_category(D, "x"), [raw]) == [clean]


@pytest.mark.parametrize(
    ("email", "domain", "reason"),
    [
        ("jane.doe@tdpbakery.com", "tdpbakery.com", "placeholder_email"), ("support@bebee.com", None, "aggregator_email"), ("x@sub.hmrc.gov.uk", None, "aggregator_email"), ("buyer@gmail.com", "acme.com", "free_email_no_verify"),
        ("buy@acme.com", "https://www.acme.com/x", "ok"), ("buy@other.com", "acme.com", "brand_mismatch"), ("press@acme.com", "acme.com", "pr_or_investor_only"), ("nonsense", "acme.com", "invalid_format"), ("a@mail.acme.co.uk", "shop.acme.co.uk", "ok"), (None, None, "invalid_format"),
    ],
)
def test_email_reasons(spark, email, domain, reason):
    df = spark.createDataFrame([(email, domain)], "e string, d string")
    assert df.selectExpr(f"{emails.email_reason(D, 'e', 'd')} as r").first().r == reason


def test_business_groups_by_category(spark):
    df = spark.createDataFrame([("Golden Bakery", "flour"), ("Golden Bakery", "mattress"), ("City Spa", "skincare"), ("City Spa", None), ("Grand Hotel", "mattress"), ("Acme", None)], "n string, c string")
    assert [r.b for r in df.selectExpr(f"{predicates.business_blacklisted(D, 'n', 'c')} as b").collect()] == [False, True, False, True, False, False]


def test_phone_and_calling_code(spark):
    assert values(spark, texts.clean_phone(D, "x"), ["tel: +65 (6123)-4567 ", None]) == ["+6561234567", ""]
    assert values(spark, texts.valid_phone(D, "x"), ["7777777", "123456", "1234567", "1" * 16]) == [False, False, True, False]
    assert values(spark, texts.phone_country(D, "x"), ["+6561234567", "+65 6123", "+1 415"]) == [None, "SG", "US"]
    assert values(spark, texts.phone_country(D, "x", longest=True), ["+6561234567", "+97150000"]) == ["SG", "AE"]


LEAD = "lead_id long, company_name string, domain string, primary_email string, primary_phone string, country string, snippet string, category string, intent_signal string, confidence_tier string, n_items int, tax_verified boolean, verified_source_id string, reason_codes string"


def lead(i, **own):
    base = {"company_name": "Furniture Wholesale Group", "domain": "fwg.com", "primary_email": "buy@fwg.com", "primary_phone": "+41 22 123 4567", "country": "CH", "snippet": None, "category": "mattress", "intent_signal": None, "confidence_tier": "High", "n_items": 2, "tax_verified": None, "verified_source_id": None, "reason_codes": None} | own
    return (i, *(base[c.split()[0]] for c in LEAD.split(", ")[1:]))


def test_gate(spark):
    cases = [
        ({}, None, "premium"), ({"company_name": ""}, "no_company_name", "unqualified"), ({"company_name": "ab"}, "junk_name", "unqualified"), ({"company_name": "Corner Cafe"}, "biz_type_blacklisted", "unqualified"),
        ({"domain": "facebook.com"}, "entity_type_social", "unqualified"), ({"domain": "foo.bbb.org"}, "entity_type_aggregator", "unqualified"), ({"company_name": "Import Association"}, "entity_type_aggregator", "unqualified"),
        ({"snippet": "the daily news"}, "entity_type_media", "unqualified"), ({"domain": "scribd.com"}, "junk_domain", "unqualified"), ({"snippet": "has permanently closed in 2024"}, "closed_business", "unqualified"),
        ({"country": "US", "domain": "x.de", "snippet": "a firm in germany"}, "country_mismatch", "unqualified"), ({"domain": None, "primary_phone": None, "primary_email": "jane.doe@x.com"}, "placeholder_email", "unqualified"),
        ({"domain": None, "primary_phone": None, "primary_email": None}, "no_contact", "unqualified"), ({"confidence_tier": "low"}, "confidence_low", "unqualified"), ({"n_items": 0}, "no_procurement_items", "unqualified"), ({"confidence_tier": "Medium"}, None, "qualified"),
        ({"confidence_tier": None, "intent_signal": "BOL_SIGNAL", "tax_verified": True}, None, "premium"),
    ]
    df = spark.createDataFrame([lead(i, **own) for i, (own, _, _) in enumerate(cases)], LEAD)
    got = [(r.reason, r.grade) for r in gate.evaluate(df, D).orderBy("lead_id").collect()]
    assert got == [(reason, grade) for _, reason, grade in cases]


def test_dedupe_keeps_the_richest_and_is_stable(spark):
    rows = [(1, "Acme Ltd", None, None, 0), (2, "ACME", "High", None, 1), (3, "acme inc.", "High", "a@acme.com", 2), (4, None, "High", None, 3), (5, "", None, None, 4), (6, "Beta", None, None, 5), (7, "beta llc", None, None, 6)]
    df = spark.createDataFrame(rows, "lead_id long, company_name string, confidence_tier string, primary_email string, input_pos long").withColumn("primary_phone", F.lit(None).cast("string")).withColumn("country", F.lit("US"))
    for parts in (1, 5):
        once = select.dedupe(df.repartition(parts), "SG")
        assert sorted(r.lead_id for r in once.collect()) == [3, 6]
    again = select.dedupe(once.drop("name_canonical", "job_country"), "SG")
    assert sorted(r.lead_id for r in again.collect()) == [3, 6]


def test_top_split_is_whole_and_disjoint(spark):
    from leadloom.plans import derived

    leads = derived.build(spark, "/root/testdata/sf0.001", "leads")
    clean = select.scored(leads).where("noise is null")
    for n in (3, 10, 1000):
        split = select.top_split(leads, n)
        assert split.count() == clean.count() == split.select("lead_id").distinct().count()
        assert all(r["count"] <= n for r in split.where("part = 'top'").groupBy("job_id").count().collect())


def test_merges(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 3), ("c", 4)], "k string, v int")
    first = keep.merge_first_wins(old, new, ["k"], [F.col("v")])
    assert sorted(map(tuple, first.collect())) == [("a", 1), ("b", 1), ("c", 3)]
    assert sorted(map(tuple, keep.merge_first_wins(first, new, ["k"], [F.col("v")]).collect())) == [("a", 1), ("b", 1), ("c", 3)]
    assert sorted(map(tuple, keep.merge_last_wins(old, new, ["k"], [F.col("v")]).collect())) == [("a", 1), ("b", 2), ("c", 4)]


def test_waterfall_stops_at_the_first_hit_and_within_the_budget(spark):
    rows = [("a", 1, "x", 1, 0, True), ("a", 2, "y", 1, 2, True), ("a", 3, "z", 1, 9, True), ("b", 1, "x", 5, 0, True), ("b", 2, "y", 5, 1, True), ("c", 1, "x", 1, 1, False)]
    df = spark.createDataFrame(rows, "key string, pos int, layer string, cost int, contacts int, available boolean")
    got = {r.key: (r.hit, r.via, r.cost, r.tried) for r in joins.waterfall(df, "key", [F.col("pos")], 6).collect()}
    assert got == {"a": (True, "y", 2, 2), "b": (False, None, 5, 1)}


def test_incremental_parts_add_up(spark):
    new = spark.createDataFrame([(i,) for i in range(10)], "company_id int")
    old = spark.createDataFrame([(i,) for i in (1, 3, 3, 99)], "company_id int")
    rows, skipped = joins.incremental(new, old)
    assert rows.count() + skipped.first()[0] == 10


def test_sources(spark):
    native = spark.createDataFrame([(1, 0, "A", "p1")], "query_id long, pos int, title string, place_id string").withColumn("cid", F.lit(None).cast("string"))
    other = spark.createDataFrame([(1, 0, "B", None, "7"), (2, 0, "C", None, "8")], "query_id long, pos int, title string, place_id string, cid string")
    got = {r.title: r.maps_url for r in tables.places_with_fallback(native, other).collect()}
    assert got == {"A": "https://www.google.com/maps/place/?q=place_id:p1", "C": "https://maps.google.com/?cid=8"}
    people = spark.createDataFrame([(1, [("n", "t", "e@x.com", None, None, 7.0), ("m", None, None, None, None, None), ("o", None, None, "1", None, None)])], tables.SCHEMAS["persons"])
    assert [(r.name, r.confidence) for r in tables.persons(people).orderBy("pos").collect()] == [("n", 1.0), ("o", 0.5)]
    assert tables.align(spark.createDataFrame([("u", 1)], "url string, extra int"), "pages").columns == ["page_id", "url", "html"]


def test_column_and_sql_functions_agree(spark):
    register_sql(spark)
    df = spark.createDataFrame([("https://www.Foo.com/x",), (None,)], "d string")
    df.createOrReplaceTempView("t_domains")
    assert [r[0] for r in df.select(column("lead_host", "d")).collect()] == [r[0] for r in spark.sql("select lead_host(d) from t_domains").collect()] == ["foo.com", ""]


def test_scores(spark):
    assert values(spark, scores.overflow_confidence("cast(x as double)"), ["0", "50", "100"]) == [15, 23, 45]
    assert values(spark, scores.coefficient("cast(x as double)"), ["0.5", None, "0.9"]) == [pytest.approx(0.6), pytest.approx(0.3), pytest.approx(0.95)]
