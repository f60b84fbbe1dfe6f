"""Queries of companies' sites and profiles over recorded pages: contact pages, layers, final contacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import emails, texts
from ..functions.dialect import DUCK, SPARK, in_list, lookup
from ..operators import crawl
from ..plans import derived
from ..sources.stages import stage
from .common import Registry, view
from .contacts import _FREE, _channels_sql, _contacts_sql
from .joins import leads

P, R, L = view("site_pages"), view("recorded"), view("leads")
#: Cost within which vision runs only where the text layer wasn't asked.
BUDGET = 5


def _pages(spark, d):
    return derived.build(spark, d, "site_pages")


def _sites(spark, d):
    """Hosts of leads and of the recorded pages."""
    hosts = leads(spark, d).selectExpr(f"{texts.host(SPARK, 'domain')} as site")
    own = _pages(spark, d).where("page_id % 5 < 4").selectExpr(f"{texts.host(SPARK, 'url')} as site")
    return hosts.unionByName(own).where("site <> ''").distinct()


def _layers(spark, d):
    pages = _pages(spark, d)
    return crawl.site_layers(_sites(spark, d), pages, derived.build(spark, d, "recorded"), BUDGET)


def j17_pages(spark, d):
    pages = _pages(spark, d)
    candidates = stage(crawl.candidate_pages(_sites(spark, d), pages), "candidates")
    return crawl.visited_pages(candidates, crawl.evidence(pages)).selectExpr("site", "cast(pos as bigint) as pos", "url", "page_id", *(f"cast({c} as bigint) as {c}" for t in crawl.CONTACTS for c in (f"new_{t}s", f"{t}s_before")))


def t12_log(spark, d):
    return _layers(spark, d)[1].selectExpr("site", "layer", "attempted", "contacts", "cast(cost as bigint) as cost", "reason")


def a06_rates(spark, d):
    return crawl.layer_rates(_layers(spark, d)[1]).selectExpr("layer", "attempted", "hit", "hit_rate", "cast(cost as bigint) as cost")


_SHOWN = ["via", "filled", *(f"primary_{t}" for t in crawl.CONTACTS), "array_join(emails, ',') as emails", "array_join(rejected, ',') as rejected", "array_join(transform(channels, c -> concat_ws('|', c.type, c.value, c.source, cast(round(c.confidence * 100) as int))), ',') as channels"]


def x23_contacts(spark, d):
    results, _ = _layers(spark, d)
    return crawl.final_contacts(results, _sites(spark, d).withColumn("host", F.col("site"))).selectExpr("site", *_SHOWN)


def _companies(spark, d):
    """Leads without a site, with the addresses of four profiles each, the last a repetition of the first."""
    many = (_pages(spark, d).agg(F.max("page_id")).first()[0] or 0) // 5 + 1
    urls = ["concat('https://instagram.com/firm', cast(lead_id * 3 % m as string))", "' https://www.Instagram.com/firm' || cast((lead_id * 3 + 1) % m as string) || '/'", "case when lead_id % 2 = 0 then 'ftp://x.com/a' else 'https://t.me/firm' end", "concat('https://instagram.com/Firm', cast(lead_id * 3 % m as string))", "'https://www.instagram.com/firm' || cast((lead_id * 3 + 2) % m as string) || '/'"]
    return leads(spark, d).where("coalesce(domain, '') = ''").withColumn("m", F.lit(many)).selectExpr("lead_id as company", f"posexplode(array({', '.join(urls)})) as (pos, url)")


def j25_profiles(spark, d):
    pages, companies = _pages(spark, d), _companies(spark, d)
    results = stage(crawl.profile_results(companies, pages), "profiles")
    hosts = companies.select(F.col("company").alias("site")).distinct().join(crawl.brand_hosts(results).select(F.col("site").alias("_site"), "host"), F.col("site") == F.col("_site"), "left").select("site", F.coalesce("host", F.lit("")).alias("host"))
    return crawl.final_contacts(results, hosts).selectExpr("site as lead_id", "host as brand_host", *_SHOWN[1:])


# ---- the same in SQL ------------------------------------------------------

_KEY = crawl.page_key(DUCK, "url")


def _evidence() -> str:
    d = DUCK
    confidence = lookup("source", {s: str(c) for s, c in rules.SOURCE_CONFIDENCE.items()})
    mine = f"select *, row_number() over (partition by page_id, type order by {_FREE}, priority desc, value) as rank from ({_contacts_sql(P)})"

    def links(expr: str, kind: str, k: int, confidence: float, where: str = "true") -> str:
        rows = f"select page_id, v, min(i) as i from (select page_id, unnest(xs) as v, generate_subscripts(xs, 1) as i from (select page_id, {expr} as xs from {P} where {where})) group by page_id, v"
        return f"select page_id, '{kind}' as type, v as value, 'href' as source, {confidence} as confidence, false as contact, {k} as k, -{confidence} as c, i - 1 as p from (select *, row_number() over (partition by page_id order by i) as n from ({rows})) where n <= 4"

    return f"""
    select page_id, type, value, case when type = 'whatsapp' or source in ('mailto_link', 'tel_link') then 'href' else 'regex' end as source, {confidence} as confidence, rank <= 8 as contact, case type when 'email' then 0 when 'phone' then 1 else 2 end as k, 0.0 as c, rank as p from ({mine})
    union all select page_id, type, value, source, confidence, false, 3, -confidence, pos as p from ({_channels_sql(P, ', pos')})
    union all {links(crawl.website_links(d), "website", 3, 0.6, in_list(texts.host(d, "url"), rules.CHANNEL_HOSTS))}
    union all {links(crawl.found_links(d), "contact_form", 4, 0.5)}"""


_SITES = f"select distinct site from (select {texts.host(DUCK, 'domain')} as site from {L} union all select {texts.host(DUCK, 'url')} from {P} where page_id % 5 < 4) where site <> ''"
_VISITS = f"""
e as materialized ({_evidence()}),
keyed as (select key, min(page_id) as page_id from (select page_id, {_KEY} as key from {P}) group by key),
sites as ({_SITES}),
homes as (select site, page_id from sites left join keyed on site || '/' = key),
links as (
  select site, link, min(i) as i from (
    select site, unnest(xs) as link, generate_subscripts(xs, 1) as i from (select site, {crawl.found_links(DUCK)} as xs from homes join {P} p on homes.page_id = p.page_id)
  ) group by site, link),
named as (select site, link, i from (select *, row_number() over (partition by site order by i) as n from links) where n <= 6),
usual as (select site, unnest({crawl.usual_links(DUCK, 'site')}) as link, generate_subscripts({crawl.usual_links(DUCK, 'site')}, 1) + 100000 as i from sites),
listed as (select site, link as url, row_number() over (partition by site order by i) as pos from (select site, link, min(i) as i from (select * from named union all select * from usual) group by site, link)),
cand as materialized (select site, 0 as pos, 'https://' || site || '/' as url, page_id from homes union all select site, pos, url, page_id from (select site, pos, url, {_KEY} as k from listed where pos <= 6) left join keyed on k = key),
c as materialized (select distinct site, pos, type, lower(value) as v from cand join e using (page_id) where contact),
known as (
  select cand.*, (select count(distinct v) from c where c.site = cand.site and c.pos < cand.pos and type = 'email') as emails_before, (select count(distinct v) from c where c.site = cand.site and c.pos < cand.pos and type = 'phone') as phones_before,
    (select count(distinct v) from c where c.site = cand.site and c.pos < cand.pos and type = 'whatsapp') as whatsapps_before, {', '.join(f"(select count(distinct v) from c where c.site = cand.site and c.pos <= cand.pos and type = '{t}') as {t}s_after" for t in crawl.CONTACTS)}
  from cand),
visits as materialized (select * from known where pos = 0 or emails_before < 3 or phones_before < 1)"""

J17 = f"with {_VISITS} select site, pos, url, page_id, emails_after - emails_before as new_emails, emails_before, phones_after - phones_before as new_phones, phones_before, whatsapps_after - whatsapps_before as new_whatsapps, whatsapps_before from visits"

_CLEAN = f"case when type = 'email' then lower(trim(value)) else {texts.clean_phone(DUCK, 'value')} end"
_LOG = f"""{_VISITS},
n as (
  select s.site, h.page_id is not null as home, (select count(*) from (select distinct type, v from c where c.site = s.site and pos = 0)) as n_home,
    (select count(*) from (select distinct type, v from c join visits x using (site, pos) where c.site = s.site)) as n_static,
    (select count(*) from c join visits x using (site, pos) where c.site = s.site and type <> 'whatsapp') as reach
  from sites s join homes h on s.site = h.site),
a as materialized (select distinct site, layer, type, v from (select site, layer, type, {_CLEAN} as v from {R}) where case type when 'email' then {texts.valid_email(DUCK, 'v')} when 'phone' then {texts.valid_phone(DUCK, 'v')} when 'whatsapp' then {texts.valid_phone(DUCK, 'v')} end and (layer <> 'serper' or type = 'email')),
g as (select site, layer, count(*) as n, count(*) filter (where type <> 'whatsapp') as r from a group by site, layer),
m as (
  select n.*, coalesce(l.n, 0) as ln, coalesce(l.r, 0) as lr, coalesce(v.n, 0) as vn, coalesce(v.r, 0) as vr, coalesce(s.n, 0) as sn, exists (select 1 from {R} q where q.site = n.site and q.layer = 'vision') as seen
  from n left join g l on n.site = l.site and l.layer = 'llm_text' left join g v on n.site = v.site and v.layer = 'vision' left join g s on n.site = s.site and s.layer = 'serper'),
o as (select *, reach = 0 and home as l_on, reach = 0 and not (home and lr > 0) as v_open from m),
w as (select *, v_open and seen and (case when l_on then 1 else 0 end) + 5 <= {BUDGET} as v_on from o),
log as materialized (
  select site, 'home' as layer, true as attempted, n_home as contacts, 0 as cost, case when not home then 'no_page' end as reason from w
  union all select site, 'bfs', true, n_static - n_home, 0, null from w
  union all select site, 'llm_text', true, ln, 1, null from w where l_on
  union all select site, 'vision', v_on, case when v_on then vn else 0 end, case when v_on then 5 else 0 end, case when (case when l_on then 1 else 0 end) + 5 > {BUDGET} then 'cost_budget_exceeded' when not seen then 'capability_missing' end from w where v_open
  union all select site, 'serper', true, sn, 1, null from w where v_open and not (v_on and vr > 0))"""

T12 = f"with {_LOG} select site, layer, attempted, contacts, cast(cost as bigint) as cost, reason from log"
A06 = f"with {_LOG} select layer, count(*) filter (attempted) as attempted, count(*) filter (contacts > 0) as hit, round(count(*) filter (contacts > 0) / nullif(count(*) filter (attempted), 0), 3) as hit_rate, cast(sum(cost) as bigint) as cost from log group by layer"

_REASON = emails.email_reason(DUCK, "v", "host")
_FINAL = f"""
f as (select site, type, lower(value) as v, arg_min(value, ord) as value, arg_min(source, ord) as source, arg_min(confidence, ord) as confidence, min(ord) as ord, min(ord) filter (contact) as cat, arg_min(layer, ord) filter (contact) as layer, arg_min(value, ord) filter (contact) as cvalue from (select *, (l, pos, k, c, p, value) as ord from r) group by site, type, lower(value)),
j as (select f.*, case when type = 'email' then {_REASON} end as reason from f join hosts using (site)),
k as (select *, reason is null or {emails.accepted('reason')} as stays from j),
z as (
  select site, arg_min(layer, cat) filter (cat is not null and type in ('email', 'phone')) as via, {', '.join(f"arg_min(cvalue, cat) filter (cat is not null and stays and type = '{t}') as primary_{t}" for t in crawl.CONTACTS)},
    string_agg(cvalue, ',' order by cat) filter (type = 'email' and stays and cat is not null) as emails, string_agg(v || '=' || reason, ',' order by v || '=' || reason) filter (type = 'email' and not stays and cat is not null) as rejected,
    string_agg(type || '|' || value || '|' || source || '|' || cast(round(confidence * 100) as int), ',' order by ord, type) filter (stays and (type <> 'email' or cat is not null)) as channels
  from k group by site)"""
_FINAL_COLUMNS = "coalesce(primary_email, primary_phone, primary_whatsapp) is not null as filled, primary_email, primary_phone, primary_whatsapp, coalesce(emails, '') as emails, coalesce(rejected, '') as rejected, coalesce(channels, '') as channels"
X23 = f"""with {_LOG},
r as (
  select site, case when pos = 0 then 'home' else 'bfs' end as layer, case when pos = 0 then 0 else 1 end as l, pos, k, cast(e.c as double) as c, p, type, value, source, cast(confidence as double) as confidence, contact from visits join e using (page_id)
  union all select a.site, layer, case layer when 'llm_text' then 2 when 'vision' then 3 else 4 end, 0, case type when 'email' then 0 when 'phone' then 1 else 2 end, 0.0, 0, type, v, case when type = 'whatsapp' then 'href' else 'regex' end, case when type = 'whatsapp' then 0.85 else 0.6 end, true from a semi join (select site, layer from log where attempted) q on a.site = q.site and a.layer = q.layer),
hosts as (select site, site as host from sites), {_FINAL}
select sites.site, coalesce(replace(via, 'llm_text', 'llm'), 'none') as via, {_FINAL_COLUMNS} from sites left join z using (site)"""

J25 = f"""with e as materialized ({_evidence()}),
keyed as (select key, min(page_id) as page_id from (select page_id, {_KEY} as key from {P}) group by key),
many as (select max(page_id) // 5 + 1 as m from {P}),
u as (
  select lead_id, i, trim(url) as url from (
    select lead_id, unnest([0, 1, 2, 3, 4]) as i, unnest(['https://instagram.com/firm' || (lead_id * 3 % m), ' https://www.Instagram.com/firm' || ((lead_id * 3 + 1) % m) || '/', case when lead_id % 2 = 0 then 'ftp://x.com/a' else 'https://t.me/firm' end, 'https://instagram.com/Firm' || (lead_id * 3 % m), 'https://www.instagram.com/firm' || ((lead_id * 3 + 2) % m) || '/']) as url
    from {L}, many where coalesce(domain, '') = '') where regexp_matches(lower(trim(url)), '^https?://')),
t as (select lead_id as site, pos, url, page_id from (select *, row_number() over (partition by lead_id order by i) as n, i as pos from (select lead_id, arg_min(url, i) as url, min(i) as i from u group by lead_id, lower(url))) left join keyed on {_KEY} = key where n <= 3),
r as (
  select site, 'profile' as layer, 0 as l, pos, k, cast(e.c as double) as c, p, type, value, source, cast(confidence as double) as confidence, contact from t join e using (page_id)
  union all select site, 'profile', 0, pos, -1, 0.0, 0, string_split(c, '|')[1], v, 'href', cast(string_split(c, '|')[2] as double), false from (select site, pos, {crawl.classify_link(DUCK, 'url')} as c, {crawl.clean_url(DUCK, 'url')} as v from t) where c is not null),
b as (select site, {texts.host(DUCK, 'value')} as host from (select site, arg_min(value, (pos, k, c, p, value)) as value from r where type = 'website' group by site)),
hosts as (select distinct lead_id as site, coalesce(host, '') as host from {L} left join b on lead_id = site where coalesce(domain, '') = ''), {_FINAL}
select hosts.site as lead_id, host as brand_host, {_FINAL_COLUMNS} from hosts left join z using (site)"""


def register(r: Registry) -> None:
    r.add("j17_contact_pages", j17_pages, J17)
    r.add("t12_contact_layers", t12_log, T12)
    r.add("a06_contact_layers", a06_rates, A06)
    r.add("x23_a15_site_contacts", x23_contacts, X23)
    r.add("j25_a15_profile_contacts", j25_profiles, J25)
