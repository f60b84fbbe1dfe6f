"""Dictionary files, category keys and seeds against small cases."""

import json

from leadloom.functions.dialect import SPARK
from leadloom.operators import seeds, taxonomy
from leadloom.sources import dictionaries as D


def load(spark, tmp_path, loader, content):
    path = tmp_path / "dictionary.json"
    path.write_text(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False), encoding="utf-8")
    return sorted(tuple(r) for r in loader(D.documents(spark, str(path))).collect())


def test_first_and_last_entries_win(spark, tmp_path):
    assert load(spark, tmp_path, D.aliases, [["a", "k1"], ["a", "k2"], ["b", ""], ["", "k"], ["c"], ["大蒜", "garlic"]]) == [("a", "k1"), ("大蒜", "garlic")]
    names = {"entries": [{"industry_key": "x", "name_zh": " 食品 ", "name_en": "Food"}, {"industry_key": "y", "name_en": "FOOD"}, {"industry_key": " ", "name_en": "none"}]}
    assert load(spark, tmp_path, D.industry_names, names) == [("food", "x"), ("食品", "x")]
    registry = {"tax_verify_databases": {"databases": [{"country": "br", "id": "1", "lookup_url": "u", "confidence_boost_on_match": 40}, {"country": "br", "id": "2"}]}}
    assert load(spark, tmp_path, D.tax_registry, registry) == [("br", "2", None, None)]
    assert load(spark, tmp_path, D.rule_keys, {"mappings": {"r1": "k", "r2": " k ", "r3": ""}}) == [("k",)]
    assert load(spark, tmp_path, D.category_segments, {"category_to_segment": {"a": "s", "b": "s"}}) == [("a", "s"), ("b", "s")]
    sources = {"sources": {"east": [{"id": "1", "countries": ["cz"]}, {"id": "2"}], "west": [{"id": "3"}]}}
    assert [r[:4] for r in load(spark, tmp_path, D.verified_sources, sources)] == [("east", 0, 0, "1"), ("east", 0, 1, "2"), ("west", 1, 0, "3")]
    assert [(r[0], r[1], r[3]) for r in load(spark, tmp_path, D.industries, {"industries": {"Big Mills": {"x": 1}, "Small": {}}})] == [(0, "Big Mills", "big"), (1, "Small", "small")]


def test_broken_dictionaries_give_no_rows(spark, tmp_path):
    for loader in (D.aliases, D.industry_names, D.rule_keys, D.segments, D.category_segments, D.verified_sources, D.tax_registry, D.industries):
        for content in ("", "{}", "[]", "not json", "null"):
            assert load(spark, tmp_path, loader, content) == []


def test_category_and_industry_keys(spark):
    aliases = spark.createDataFrame([("garlic", "garlic_key"), ("大蒜", "garlic"), ("misc", "other"), ("tea", "tea")], "alias string, key string")
    names = spark.createDataFrame([("food", "F"), ("auto parts", "A")], "alias string, key string")
    cases = {
        "GARLIC": ("garlic_key", None, True), "【新加坡 大蒜】": ("garlic", None, True), "[China garlic]": ("garlic_key", None, True), "misc": ("other", None, False), "misc, tea": ("tea", None, True),
        "Food": ("food", "F", True), "fresh food": ("fresh food", "F", True), "auto parts": ("auto parts", "A", True), "x" * 25: ("other", None, False), " ": ("other", None, False), None: ("other", None, False),
    }
    rows = spark.createDataFrame([(x,) for x in cases] * 2, "raw string")
    got = taxonomy.industry_hints(rows, "raw", aliases, names).collect()
    assert len(got) == 2 * len(cases)
    assert {r.raw: (r.hint.category_key, r.hint.industry_key, r.hint.hit) for r in got} == cases
    places = {r.raw: r.hint.place_type_blacklist for r in got}
    assert places["【新加坡 大蒜】"][-1] == "car_dealer" and places[" "] == ["bank", "lawyer", "accounting", "insurance_agency", "real_estate_agency"]


def test_places(spark):
    df = spark.createDataFrame([("de",), ("GB ",), (None,), ("xx",), ("sg",)], "c string")
    got = [tuple(r) for r in df.selectExpr(taxonomy.country_name("c"), taxonomy.language("c"), taxonomy.major_cities("c")).collect()]
    assert got[0] == ("Germany", "German", "Berlin,Hamburg,Munich,Frankfurt,Cologne") and got[1][0] == "United Kingdom" and got[2][0] == "United States"
    assert got[3] == ("XX", "English", None) and got[4][2] == "Singapore"
    assert SPARK.name == "spark"


def test_pending_seeds(spark):
    rows = [(i, "US" if i % 2 else None, ["flour", None, "other"][i % 3], "pending" if i % 5 else "consumed") for i in range(200)]
    jobs = [(1, "us", "flour"), (2, "SG", "flour")]
    got = seeds.pending_seeds(spark.createDataFrame(jobs, "job_id int, country string, category string"), spark.createDataFrame(rows, "seed_id int, country string, category string, status string"), most=20)
    want = []
    for job, country, category in jobs:
        near = [r for r in rows if r[3] == "pending" and (r[1] is None or r[1] == country.upper())][:20]
        want += [(job, r[0]) for r in near if not r[2] or category in r[2]]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_adapter_search(spark):
    rows = [
        ("hit", 1, "a", True, 1, None), ("hit", 2, "b", True, 5, 9), ("hit", 3, "c", True, 1, 2), ("zero", 1, "a", True, 1, 0), ("zero", 2, "b", True, 1, None),
        ("failed", 1, "a", True, 1, None), ("failed", 2, "b", True, 2, None), ("none", 1, "a", False, 1, 5),
    ]
    got = {r.q: (r.ok, r.adapter_id, r.hits, r.cost, r.tried, r.reason) for r in seeds.adapter_search(spark.createDataFrame(rows, "q string, pos int, adapter string, available boolean, cost int, hits int"), "q", ["pos"], 4).collect()}
    assert got == {
        "hit": (True, "c", 2, 2.0, "a,c", None), "zero": (True, None, 0, 2.0, "a,b", "zero_results"), "failed": (False, None, 0, 3.0, "a,b", "all_adapters_failed:a,b"), "none": (False, None, 0, 0.0, "", "no_available_adapter"),
    }


def test_contact_waterfall_budget(spark):
    rows = [(1, 0, 0, 0, 3, 1), (2, 0, 0, 1, 3, 1), (3, 0, 2, 0, 3, 1), (4, 0, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "k int, home int, bfs int, llm int, vision int, serper int")
    usual = {r.k: (r.via, r.cost, r.vision_ran) for r in seeds.contact_waterfall(df, "k").collect()}
    rich = {r.k: (r.via, r.cost, r.vision_ran) for r in seeds.contact_waterfall(df, "k", "6").collect()}
    assert usual == {1: ("serper", 2, False), 2: ("llm", 1, False), 3: ("bfs", 0, False), 4: (None, 2, False)}
    assert rich == {1: ("vision", 6, True), 2: ("llm", 1, False), 3: ("bfs", 0, False), 4: (None, 7, True)}
