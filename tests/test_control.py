"""Job controls and policies: cases written by hand, wrong types among them."""

import json

from pyspark.sql import functions as F

from leadloom.operators import control as C


def read(spark, *payloads):
    texts = [p if isinstance(p, str) or p is None else json.dumps(p) for p in payloads]
    rows = C.read_controls(spark.createDataFrame(list(enumerate(texts)), "job_id int, payload string"), "payload").orderBy("job_id").collect()
    return [{c: (r[c].asDict() if r[c] is not None else None) for c in ("matrix", "hint", "convo", "incremental", "context")} for r in rows]


DEFAULTS = {"convo": {"negative_keywords": [], "icp_overrides": []}, "incremental": {"enabled": False, "parent_job_id": None, "blacklist": []}, "context": {"direction": "find_buyers", "negative_keywords": [], "persona": None, "agent_run_id": None}, "matrix": None, "hint": None}


def test_no_control_gives_defaults(spark):
    for got in read(spark, None, "", "not json {", [], 5, "[1, 2]", "null", {}, {"matrix": [], "industry_hint": "x", "icp_context": 3, "negative_keywords": "a", "incremental_mode": 1, "icp_overrides": {}}):
        assert got == DEFAULTS


def test_matrix(spark):
    got = read(
        spark,
        {"matrix": {}},
        {"matrix": {"cities": [" Berlin ", "", 5, None, " Köln"], "platforms": ["MAPS", "nowhere", 1688, "1688", None], "deep_search_all_cities": False, "max_pages_per_pillar": 9, "include_social_profiles": "false"}},
        {"matrix": {"cities": "Berlin", "platforms": {"maps": 1}, "deep_search_all_cities": 0, "max_pages_per_pillar": "4 pages", "include_social_profiles": False}},
        {"matrix": {"cities": [f"c{i}" for i in range(14)], "max_pages_per_pillar": -3}},
        {"matrix": {"max_pages_per_pillar": 0}}, {"matrix": {"max_pages_per_pillar": True}}, {"matrix": {"max_pages_per_pillar": 3.9}}, {"matrix": {"max_pages_per_pillar": [4]}},
    )
    pages = lambda n, **more: {"cities": [], "platforms": [], "deep_all_cities": True, "max_pages": n, "include_social": True, **more}
    assert [g["matrix"] for g in got] == [
        pages(2), pages(5, cities=["Berlin", "Köln"], platforms=["maps", "1688"], deep_all_cities=False), pages(4, include_social=False), pages(1, cities=[f"c{i}" for i in range(10)]), pages(2), pages(2), pages(3), pages(2),
    ]


def test_hint(spark):
    got = read(spark, {"industry_hint": {}}, {"industry_hint": {"category_key": "flour", "industry_key": "food", "name_zh": "面粉", "name_en": 5, "place_type_blacklist": ["bank", "", 3, " x "] + ["b"] * 30, "hit": "false"}}, *({"industry_hint": {"hit": h}} for h in (True, 0, 1, None, "", [], {}, -0.5)))
    assert got[0]["hint"] == {"category_key": "other", "industry_key": None, "name_zh": "", "name_en": "", "place_type_blacklist": [], "hit": False}
    assert got[1]["hint"] == {"category_key": "flour", "industry_key": "food", "name_zh": "面粉", "name_en": "", "place_type_blacklist": ["bank", " x "] + ["b"] * 18, "hit": True}
    assert [g["hint"]["hit"] for g in got[2:]] == [True, False, True, False, False, True, True, True]


def test_convo_incremental_context(spark):
    long = "k" * 40
    got = read(
        spark,
        {"negative_keywords": [" a ", "", 7, None, long] + ["n"] * 30, "icp_overrides": [long, " b"] + ["o"] * 9},
        {"incremental_mode": True, "incremental_parent_job_id": " j1 ", "incremental_blacklist_company_ids": ["a", " a ", 12, 0, None, "", False, True, {"x": 1}, [1], 1.5]},
        {"incremental_mode": "true", "incremental_parent_job_id": "j", "incremental_blacklist_company_ids": ["a"]}, {"incremental_mode": True, "incremental_parent_job_id": 5, "incremental_blacklist_company_ids": "a"},
        {"icp_context": {"direction": "find_suppliers", "negative_keywords": [" Bad ", 5, ""], "persona": " p ", "agent_run_id": " r "}}, {"icp_context": {"direction": "other", "negative_keywords": "x", "persona": 1, "agent_run_id": {}}},
    )
    assert got[0]["convo"] == {"negative_keywords": ["a", "k" * 24] + ["n"] * 14, "icp_overrides": ["k" * 32, "b", "o", "o", "o", "o"]}
    assert [g["incremental"] for g in got[1:4]] == [{"enabled": True, "parent_job_id": "j1", "blacklist": ["a", "12", "true", "1.5"]}, DEFAULTS["incremental"], {"enabled": True, "parent_job_id": None, "blacklist": []}]
    assert [g["context"] for g in got[4:]] == [{"direction": "find_suppliers", "negative_keywords": ["bad"], "persona": "p", "agent_run_id": " r "}, DEFAULTS["context"]]


def test_cities_of_a_run(spark):
    rows = C.read_controls(spark.createDataFrame([(1, '{"matrix": {"cities": ["X"]}}'), (2, '{"matrix": {}}'), (3, '{"matrix": {"deep_search_all_cities": false}}'), (4, "{}")], "job_id int, payload string"), "payload")
    major = F.array(*(F.lit(f"m{i}") for i in range(7)))
    assert [r[0] for r in rows.orderBy("job_id").select(C.run_cities(F.col("matrix"), major)).collect()] == [["X"], [f"m{i}" for i in range(5)], [], []]


POLICIES = [
    (None, None, "Entity", -0.05, None, ["a.com"], ["spam", "x"]), ("sg", None, "geo", -0.25, None, ["b.com", "a.com"], None), (None, "flour", "generic", -0.08, False, None, ["spam", "old"]), ("SG", "Flour", "contact", 0.9, None, None, None),
    ("DE", None, "geo", 0.1, True, None, None), (None, None, "staleness", -0.06, None, None, None), ("US", None, "generic", -0.5, None, None, None), ("US", None, "generic", 0.2, None, None, None),
]


def controls(spark):
    jobs = spark.createDataFrame([(1, "SG", "flour"), (2, "DE", "bread"), (3, "US", None), (4, None, "flour"), (5, "SG", "flour")], "job_id int, country string, category string")
    policies = spark.createDataFrame(POLICIES, "country string, category string, kind string, delta double, disabled boolean, domains array<string>, keywords array<string>")
    return C.policy_controls(jobs, policies)


def test_policies_as_one_control(spark):
    got = {r.job_id: r for r in controls(spark).collect()}
    assert got[1].weights == got[5].weights == {"entity": 0.85, "geo": 0.25, "generic": 0.76, "contact": 2.0, "staleness": 0.82}
    assert got[2].weights == {"entity": 0.85, "geo": 0.0, "staleness": 0.82} and got[3].weights["generic"] == 0.1
    flags = {k: (r.disable_linkedin, r.disable_lookalike, r.enforce_geo, r.enforce_recency) for k, r in got.items()}
    assert flags == {1: (True, True, True, True), 2: (True, False, True, True), 3: (True, True, False, True), 4: (True, True, False, True), 5: (True, True, True, True)}
    assert got[1].domain_blacklist == ["a.com", "b.com"] and got[1].keyword_suppress == ["old", "spam", "x"] and got[2].keyword_suppress == ["spam", "x"]
    none = C.policy_controls(spark.createDataFrame([(1, "SG", "x")], "job_id int, country string, category string"), spark.createDataFrame([], "country string, category string, kind string, delta double, disabled boolean, domains array<string>, keywords array<string>")).first()
    assert (none.weights, none.disable_linkedin, none.domain_blacklist) == (None, False, [])


def test_pillars(spark):
    base = controls(spark).withColumn("direction", F.when(F.col("job_id") == 5, "find_suppliers").otherwise("find_buyers")).withColumn("platforms", F.when(F.col("job_id") == 2, F.array(F.lit("x_public"))))
    got = {}
    for r in C.enabled_pillars(base).collect():
        got.setdefault(r.job_id, set()).add(r.pillar)
    assert got[5] == {"p0_seed", "p_pillar0_boolean", "s_made_in_china", "s_global_sources", "s_thomasnet", "s_alibaba", "s_factory_direct", "s_exporter"}
    assert "p1_maps_dist" not in got[1] and "p2_direct_importer" in got[1] and "p9_lookalike" not in got[1] and "p11_linkedin_decision" not in got[1] and "p_yellowpages" in got[1] and len(got[1]) == 23
    assert {p for p in got[2] if p.startswith(("p_", "p1"))} == {"p_pillar0_boolean", "p_procurement", "p_x_public", "p10_verified_sources"}
    assert "p2_direct_importer" not in got[3] and "p1_maps_dist" in got[3] and len(got[3]) == 28 - 16 - 1


def test_controls_on_signals(spark):
    c = controls(spark).where("job_id in (1, 2)").withColumns({"country_name": F.when(F.col("job_id") == 1, "Singapore").otherwise("Germany"), "year": F.lit(2024)})
    rows = [(1, 1, "Flour in Singapore", "", "https://c.com"), (2, 1, "Flour", "buyers", "https://c.com.sg/x"), (3, 1, "Flour", "here", "https://c.com"), (4, 1, "Singapore SPAM", "", None), (5, 1, "Singapore", "in 2020", None), (6, 1, "Singapore", None, "http://www.A.com/x"), (7, 2, "germany", "X", "https://b.com"), (8, 2, "germany 2018", "2022", None), (9, 3, "no control", "", None)]
    signals = spark.createDataFrame(rows, "id int, job_id int, title string, snippet string, link string")
    assert sorted(r.id for r in C.apply_controls(signals, c).collect()) == [1, 2, 7, 8]
