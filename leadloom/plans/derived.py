"""Working tables derived from the given ones, as one SQL text per table that both engines run.

The given tables hold no company leads, so leads, raw signals, contact pages,
attempts and queue rows are built from them by key arithmetic. Everything grows
with its source table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..sources.stages import stage

_K = "cast(k as string)"


def _pick(key: str, *values: str) -> str:
    """The value at position key modulo their number."""
    return f"case cast({key} % {len(values)} as int) " + " ".join(f"when {i} then {v}" for i, v in enumerate(values)) + " end"


BASE = """
select s_suppkey as k, replace(s_name, '#', ' ') as base, s_nationkey as nk, s_acctbal as bal from {supplier}
union all
select c_custkey + 1000000 as k, replace(c_name, '#', ' ') as base, c_nationkey as nk, c_acctbal as bal from {customer}
"""

_COUNTRY = "case nk % 8 when 0 then 'US' when 1 then 'SG' when 2 then 'DE' when 3 then 'GB' when 4 then 'mx' when 5 then 'JP' when 6 then 'CH' else 'Brazil' end"
_SUFFIX = _pick("k", "' Ltd'", "' Inc.'", "' GmbH'", "', LLC'", "' Co., Ltd'", "''", "' S.A.'")
_GROUP = f"'Company ' || cast(k % 97 as string) || {_SUFFIX}"

LEADS = f"""
select k as lead_id, cast(k % 4 as int) as job_id, k as input_pos,
  {_pick("k", "'mattress'", "'flour'", "'skincare products'", "'汽车配件'")} as category,
  {_pick("k", "null", "''", "'ab'", "'unknown'", "'12345'", "base || ' Trade Association'", "'Grand Hotel ' || base", "base || ' Bakery'", "base || ' Freight Forwarder'", "'Daily News ' || base", "base || ' Mattress Manufacturing'", "'Costco'", "'Texas'", "'Pricing Institute ' || base", "'***'", *[_GROUP] * 14)} as company_name,
  {_pick("k", "null", "''", "'facebook.com'", "'foo.bbb.org'", f"'https://www.firm-' || {_K} || '.de/about?x=1'", f"'firm' || {_K} || '.com'", f"'firm' || {_K} || '.com.sg'", f"'http://shop' || {_K} || '.co.uk/files/a.pdf'", "'北京路12号'", "'nodot'", "'www.scribd.com/doc/1'", f"'org' || {_K} || '.org'", f"'WWW.Firm' || {_K} || '.COM:8080/x'")} as domain,
  {_pick("k", "null", f"'info@firm' || {_K} || '.com'", "'jane.doe@tdpbakery.com'", "'support@bebee.com'", f"'buyer{{}}@gmail.com'".replace("{}", ""), "'press@firm.com'", "'membership@club.org'", "'not an email'", f"'sales@shop' || {_K} || '.co.uk'", "'name@sub.hmrc.gov.uk'", f"'Buy.Er@Firm' || {_K} || '.com'")} as primary_email,
  {_pick("k", "null", "'+1 415 555 0100'", "'+6561234567'", "'+49 (0)30 123456'", "'12'", "'+44 20 7946 0000'", "'7777777'", "'tel: 0800-123-456 '", "''")} as primary_phone,
  {_pick("k", "null", "'Imports from China and sells in Singapore.'", "'This company has permanently closed in 2024'", "'A trade association of importers'", "'We manufacture quality goods since 1990'", "'Leading distributor in the United States'", "'Germany based wholesaler of food'", "'odm skincare lab'", "'car enthusiast portal with auto parts'", "'Membership directory of firms'", "'Top companies in Asia rankings'", "'Buys flour and bread in bulk'", "'RUC: 20123456789 importador'", "'cosmetic and skin care retail'", "'Market research firm'", "'usage report of the uk'", "'plain text'")} as snippet,
  {_pick("k", "null", "'[PDF] glossary'", "'Company home'", "'Trade fair 2024'", "'Add to cart now'")} as title,
  {_pick("k", "null", "'BOL_SIGNAL'", "'customs_signal'", "'PROCUREMENT_DECISION_MAKER'", "'B2B_BUYER'", "'MAP_VERIFIED'", "'OTHER'", "''")} as intent_signal,
  {_pick("k", "null", "'Pillar 0 Seed'", "'Pillar 10 VerifiedSource'", "'Pillar 7 Customs'", "'Pillar 11 LinkedIn'", "'Pillar 8 B2B'", "'Pillar 1 LBS'", "'Pillar S Factory'", "'Pillar Yellow'", "'organic'")} as pillar,
  {_pick("k", "'high'", "'medium'", "'low'", "'none'", "null", "'High'")} as industry_match,
  {_pick("k", "null", "'High'", "'Medium'", "'low'", "'High'")} as confidence_tier,
  {_pick("k", "null", "0", "1", "3")} as n_items,
  {_pick("k", "null", "'high'", "'medium'", "'low'", "'none'")} as target_match,
  {_pick("k", "null", "'IMPORT_HISTORY'", "'OTHER'")} as reason_codes,
  {_pick("k", "null", "'gmaps'", "null", "null", "null")} as gmaps_source,
  {_pick("k", "null", "null", "'VS1'", "null", "null", "null", "null")} as verified_source_id,
  {_pick("k", "null", "null", "25", "null", "null", "null", "null")} as verified_source_boost,
  {_pick("k", "null", "false", "true", "false", "false", "false")} as tax_verified,
  {_pick("k", "null", f"'ChIJ ' || {_K}", "null")} as place_id,
  {_pick("k", "null", "null", "'https://maps.google.com/?cid=1'", "null")} as maps_url,
  {_pick("k", "null", "'https://facebook.com/firm'", "null", "null", "null")} as social_url,
  {_pick("k", "null", f"'https://firm' || {_K} || '.com/contact'", "'https://importyeti.com/company/x'", f"'https://firm' || {_K} || '.com/a.PDF'")} as link,
  {_pick("k", "null", "null", "'https://evidence.org/x'")} as source_url,
  {_pick("k", "null", "'+65 6123 4567'", "null")} as phone,
  {_pick("k", "null", "95", "60", "30", "85")} as confidence_score,
  {_pick("k", "null", "'Wholesaler'", "'Manufacturer'", "'buyer'", "'Consultant'", "' '")} as entity_role,
  {_pick("k", "null", "'Weekly'", "'every month'", "'qtr'", "'bi-weekly order'", "'yearly'", "'now and then'", "''")} as purchase_cycle,
  {_pick("k", "null", "'Berlin'", "'Singapore'")} as city,
  {_COUNTRY} as country, bal
from ({BASE}) b
"""

#: The first line of a document is a signal's title, all of the rest its snippet.
_T = "case when instr(text, chr(10)) > 0 then substr(text, 1, instr(text, chr(10)) - 1) else text end"
_S = "case when instr(text, chr(10)) > 0 then substr(text, instr(text, chr(10)) + 1) else '' end"
SIGNALS = f"""
select doc_id as signal_id, cast(doc_id % 3 as int) as job_id, cast(doc_id % 5 as int) as page, doc_id as pos,
  {_pick("doc_id", "'mattress'", "'护肤'", "'汽车配件'", "null")} as category,
  {_pick("doc_id", _T, f"'Top 10 ' || {_T}", "'Best buyers of 2024'", "'Breaking news today'", "'Membership directory'", _T, "''", "'Firm ' || source || ' Ltd'", "'Odm skincare'", "'car enthusiast'", _T)} as title,
  {_pick("doc_id", _S, _S, "'how to import'", _S, _S, "'supplier from shenzhen'", "''", "'went bankrupt in 2020'", "'auto parts'", "'skincare oem'", "'Singapore buyer 2021'", _S, _S)} as snippet,
  {_pick("doc_id", f"'https://firm' || cast(doc_id % 211 as string) || '.com/page'", "null", "'https://www.alibaba.com/x'", "'https://www.straitstimes.com/a'", "'https://panjiva.com/buyer'", "'https://Shop.sg/x.pdf'", "'https://local.news/story'")} as link,
  source as pillar, lang,
  {_pick("doc_id", "'store'", "'cafe,food'", "null", "'warehouse,store'")} as place_types
from {{documents}}
"""

_P = "cast(page_id as string)"
CONTACT_PAGES = f"""
select page_id, url,
  html || {_pick("page_id", "''", f"'<a href=\"mailto:Info@firm' || {_P} || '.com?subject=x\">Mail</a>'", f"'<a href=\"tel:+65 6123-' || lpad({_P}, 4, '0') || '\">Call</a><a href=\"https://wa.me/6591234567\">WA</a>'", f"'<p>sales [at] shop' || {_P} || ' (dot) com</p><a href=\"/contact-us\">Contact us</a>'", f"'<a href=\"https://www.facebook.com/firm' || {_P} || '/\">fb</a><a href=\"https://t.me/firm' || {_P} || '\">tg</a><a href=\"https://linkedin.com/company/firm/\">in</a>'", "'<p>WeChat: firm_chat88 Phone +49 30 1234567</p>'", "'<p>me@gmail.com logo@2x.png noreply@firm.com</p>'")} as html
from {{pages}}
"""

#: Sites of four pages (home, contact, about, a page the home page names) and a profile each; a third of them without contacts, some without a home page.
_N = "cast(floor(page_id / 5) as bigint)"
_NS = f"cast({_N} as string)"
SITE_PAGES = f"""
select page_id,
  case when page_id % 5 = 4 then 'https://www.instagram.com/firm' || {_NS} || '/' else 'https://' || case when page_id % 2 = 0 then 'www.Firm' else 'firm' end || {_NS} || '.com' || {_pick("page_id % 5", f"case when {_N} % 7 = 3 then '/index.html' else '/' end", "'/contact'", "'/about'", "'/team/kontakt?x=1'")} end as url,
  html || case when page_id % 5 = 0 then '<a href="/team/kontakt?x=1#top">Kontakt</a><a href="https://firm' || {_NS} || '.com/contact">Us</a><a href="https://elsewhere.com/contact">They</a>' else '' end
  || case when {_N} % 3 = 1 and page_id % 5 < 4 then '' else {_pick("page_id", f"'<a href=\"mailto:Info@firm' || {_NS} || '.com\">m</a><a href=\"tel:+65 6123-' || lpad({_P}, 4, '0') || '\">Call</a>'", f"'<a href=\"mailto:sales' || {_P} || '@firm' || {_NS} || '.com\">m</a><p>buy@firm' || {_NS} || '.com, noreply@example.com</p><a href=\"https://t.me/firm' || {_NS} || '\">t</a>'", "'<a href=\"https://wa.me/6591234567\">WA</a><p>me@gmail.com</p>'", f"'<p>info@firm' || {_NS} || '.com and x@bbb.org</p>'", "''", f"'<a href=\"mailto:a' || {_P} || '@firm' || {_NS} || '.com\">m</a><p>b' || {_P} || '@brand.com Phone +49 30 1234567</p>'", "''")} end
  || case when page_id % 5 = 4 then '<a href="https://brand' || {_NS} || '.com/shop?a=1">shop</a><a href="https://www.facebook.com/firm">fb</a><a href="https://other.org/">o</a>' else '' end as html
from {{pages}}
"""

#: Results of the dearer layers, a row with a null type for a call without any.
RECORDED = """
select 'firm' || cast(event_id % 2003 as string) || '.com' as site,
  case event_id % 3 when 0 then 'llm_text' when 1 then 'vision' else 'serper' end as layer,
  case when event_id % 7 = 0 then 'email' when event_id % 7 = 1 then 'phone' when event_id % 7 = 2 then 'whatsapp' when event_id % 7 = 3 then 'email' end as type,
  case event_id % 7 when 0 then 'P' || cast(event_id % 5 as string) || '@Firm' || cast(event_id % 2003 as string) || '.com' when 1 then '+65 6123 ' || lpad(cast(event_id % 9999 as string), 4, '0') when 2 then '+6591234567' when 3 then 'not an address' end as value
from {events}
"""

ATTEMPTS = """
select event_id as attempt_id, user_id as key, ts, value,
  case event_type when 'view' then 'home' when 'click' then 'bfs' when 'signup' then 'llm' when 'purchase' then 'vision' else 'serper' end as layer,
  case event_type when 'view' then 0 when 'click' then 0 when 'signup' then 1 when 'purchase' then 5 else 1 end as cost,
  cast(event_id % 4 as int) as contacts, event_id % 11 <> 0 as available
from {events}
"""

QUEUE = """
select event_id as row_id, user_id as key, cast(user_id % 5 as int) as job_id, ts as created_at, value as score,
  case when event_type = 'error' then 'pending' when event_type = 'view' then 'done' else 'claimed' end as status,
  cast(event_id % 4 as int) as retry_count, event_type, event_type = 'purchase' as has_contact
from {events}
"""


def _json(name: str, key: str, *values: str) -> str:
    """SQL for one member of a JSON object, its value (JSON text, or '' for no member) by key arithmetic."""
    return _pick(key, *("''" if v == "" else "', \"" + name + "\": " + v + "'" for v in values))


_LETTERS = "abcdefghijklmnopqrstuvwxyz0123"
_MATRIX = '{"cities": [" Berlin ", "", 5, null, "Köln"], "platforms": ["MAPS", "nowhere", 1688, "x_public"], "deep_search_all_cities": false, "max_pages_per_pillar": 9}', '{"cities": "Berlin", "platforms": {"maps": 1}, "deep_search_all_cities": 0, "max_pages_per_pillar": "4 pages", "include_social_profiles": false}'
_PAGES = '{"max_pages_per_pillar": 0}', '{"max_pages_per_pillar": -2}', '{"max_pages_per_pillar": true}', '{"max_pages_per_pillar": 3.7, "include_social_profiles": "false"}', '{"cities": ["a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k"], "platforms": ["youtube_about", "1688"]}'
_HINTS = '{"category_key": "flour", "name_zh": "面粉", "place_type_blacklist": ["bank", "", 3, " y "], "hit": true}', '{"category_key": 5, "industry_key": "food", "hit": "no"}', '{"hit": 0}', '{"hit": []}', '{"hit": ""}', '{"hit": 2.5}'
_MEMBERS = [
    _json("matrix", "event_id % 11", "", "[]", "{}", *_MATRIX, *_PAGES), _json("industry_hint", "event_id % 9", "", '"x"', "{}", *_HINTS),
    _json("negative_keywords", "event_id % 5", "", f'[" a ", "", 7, null, "{_LETTERS}"]', "{}"), _json("icp_overrides", "event_id % 4", "", '"q"', '["o1", "o2", "o3", "o4", "o5", "o6", "o7"]'),
    _json("incremental_mode", "event_id % 6", "", "true", '"true"'), _json("incremental_parent_job_id", "event_id % 3", '" j1 "', "5"), _json("incremental_blacklist_company_ids", "event_id % 4", '["a", " a ", 12, 0, null, "", false, true]', '"a"'),
    _json("icp_context", "event_id % 7", "", '{"direction": "find_suppliers", "negative_keywords": [" Bad ", 5], "persona": " p "}', "3", '{"direction": "x", "agent_run_id": "r"}'),
]
#: Job payloads as JSON, with fields missing and of wrong types.
_PAYLOADS = ("select event_id as job_id, case when event_id % 23 = 1 then null when event_id % 23 = 2 then 'not json' when event_id % 23 = 3 then '[1, 2]' else '<\"k\": ' || cast(event_id as string) || " + " || ".join(f"coalesce({m}, '')" for m in _MEMBERS) + " || '>' end as payload from <events>")
PAYLOADS = _PAYLOADS.replace("{", "{{").replace("}", "}}").replace("<events>", "{events}").replace("<", "{{").replace(">", "}}")

TABLES = {"leads": LEADS, "signals": SIGNALS, "contact_pages": CONTACT_PAGES, "site_pages": SITE_PAGES, "recorded": RECORDED, "payloads": PAYLOADS, "attempts": ATTEMPTS, "queue": QUEUE}


#: Derived tables that this driver has written: (application, files of the tables they derive from, name) -> staged frame.
_STAGED: dict[tuple, DataFrame] = {}


def _state_of(df: DataFrame) -> tuple:
    """The files that a frame reads, with their sizes and times, by listing alone, so that a changed table isn't taken for the old one."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        out.append((name, status.getLen(), status.getModificationTime()))
    return tuple(out)


def spread(df: DataFrame) -> DataFrame:
    """A small table in few files, dealt to all cores before costly work on its rows; larger ones as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table over the Parquet tables in sf_dir.

    Leads are the table that most steps start from; they are written once as a
    stage, so that the steps' expressions read columns and not the rules that
    made them.
    """
    text = TABLES[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in sorted(set(re.findall(r"\{(\w+)\}", text)))}
    if name != "leads":
        return spark.sql(text, **{t: spread(df) for t, df in used.items()} if name in ("signals", "contact_pages", "site_pages") else used)
    key = (spark.sparkContext.applicationId, tuple(_state_of(df) for df in used.values()), name)
    if key not in _STAGED:
        for old in [k for k in _STAGED if k[0] != key[0]]:
            del _STAGED[old]  # of sessions that have ended
        _STAGED[key] = stage(spread(spark.sql(text, **used)), name, keep=True)
    return _STAGED[key]


def sql(name: str) -> str:
    """The same table as SQL over views named like the given tables."""
    return re.sub(r"\{(\w+)\}", r"\1", TABLES[name]).replace("{{", "{").replace("}}", "}")
