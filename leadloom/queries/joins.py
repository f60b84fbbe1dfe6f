"""Queries of keep-one-per-key, joins, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import texts
from ..functions.dialect import DUCK, SPARK
from ..operators import companies, joins, keep, outputs
from ..plans import derived
from .common import Registry, table, view

L, S = view("leads"), view("signals")


def _b(name):
    return lambda spark, d: derived.build(spark, d, name)


leads, signals, queue, attempts = _b("leads"), _b("signals"), _b("queue"), _b("attempts")


# W: one row per key ------------------------------------------------------


def w02_places(spark, d):
    return companies.one_per_place(leads(spark, d)).select("place_key", "lead_id")


W02 = f"select place_key, min_by(lead_id, input_pos) as lead_id from (select *, lower(coalesce(nullif(place_id, ''), nullif(domain, ''), coalesce(title, '') || coalesce(city, ''))) as place_key from {L} where coalesce(domain, '') <> '' or coalesce(primary_phone, '') <> '') group by place_key"


def w03_links(spark, d):
    return companies.one_per_link(signals(spark, d), [F.col("page"), F.col("pos")]).select(F.lower("link").alias("link"), "signal_id")


W03 = f"select lower(link) as link, arg_min(signal_id, (page, pos)) as signal_id from {S} where link is not null group by lower(link)"


def w07_edges(spark, d):
    bought = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return companies.purchase_edges(bought, "l_suppkey", "p_name")


W07 = f"select distinct l_suppkey as from_id, {texts.slug(DUCK, 'p_name')} as to_id, 'PURCHASES' as edge_type, 1 as weight from lineitem join part on l_partkey = p_partkey"


def w09_latest(spark, d):
    return attempts(spark, d).groupBy("key", "layer").agg(F.max_by(F.struct("contacts", "attempt_id"), F.struct("ts", "attempt_id")).alias("v")).select("key", "layer", "v.contacts", "v.attempt_id")


W09 = f"select key, layer, arg_max(contacts, (ts, attempt_id)) as contacts, arg_max(attempt_id, (ts, attempt_id)) as attempt_id from {view('attempts')} group by key, layer"


# dictionaries ------------------------------------------------------------

ALIASES = "(1, 'small', 'fasteners'), (2, 'red', 'tools'), (3, 'ring', 'jewellery'), (4, 'gizmo', 'electronics'), (5, 'ring', 'second')"
SEGMENTS = "('fasteners', 'seg_hardware', 'bolts'), ('tools', 'seg_hardware', 'wrenches'), ('electronics', 'seg_it', 'gadgets')"
SOURCES = "('customs_sg', 'SG,MY', 30), ('registry_us', 'US', 20), ('directory_de', 'DE,CH,AT', 25), ('portal_all', 'US,SG,DE,GB,JP,MX', 10), ('expo', 'JP,SG', 25), ('maps', 'SG,US,GB', 15)"
REGISTRY = "('mx', 'https://sat.example/${id}', 30), ('US', 'https://irs.example/${id}', 35), ('SG', 'https://acra.example/${id}', 40)"
INDUSTRIES = "(1, 'seed mills'), (2, 'customs brokers'), (3, 'pillar trade')"


def w10_s11_j09_alias(spark, d):
    """The key of the first text segment that is an alias; of equal aliases the first entry counts."""
    alias = keep.keep_first(spark.sql(f"select * from values {ALIASES} as t(n, alias, key)"), ["alias"], [F.col("n")])
    return companies.first_alias(table(spark, d, "part"), "p_partkey", "p_name", alias)


W10 = f"with a as (select alias, arg_min(key, n) as key from (values {ALIASES}) t(n, alias, key) group by alias), w as (select p_partkey, unnest(string_split(lower(p_name), ' ')) as alias, generate_subscripts(string_split(lower(p_name), ' '), 1) as pos from part) select p_partkey, arg_min(key, pos) as key from w join a using (alias) group by p_partkey"


def j08_segments(spark, d):
    """Key to segment to keyword, with the key itself where the dictionary has none."""
    seg = spark.sql(f"select * from values {SEGMENTS} as t(key, segment, keyword)")
    return companies.with_segment(w10_s11_j09_alias(spark, d), seg)


J08 = f"select p_partkey, coalesce(segment, 'seg_other') as segment, coalesce(keyword, a.key) as keyword from ({W10}) a left join (values {SEGMENTS}) t(key, segment, keyword) on a.key = t.key"


def j07_t05_sources(spark, d):
    """The four best sources for the country of each lead."""
    src = spark.sql(f"select id, split(countries, ',') as countries, boost from values {SOURCES} as t(id, countries, boost)")
    return companies.best_sources(leads(spark, d), src, "lead_id").select("lead_id", "id", "boost", "rank")


J07 = f"select lead_id, id, boost, rank from (select lead_id, id, boost, row_number() over (partition by lead_id order by boost desc, id) as rank from {L} l join (select id, string_split(countries, ',') as countries, boost from (values {SOURCES}) t(id, countries, boost)) s on list_contains(countries, upper(l.country))) where rank <= 4"


def j06_p34_x11_registry(spark, d):
    """Leads with their country's registry: the filled lookup URL, whether it could be looked up, and the boosted score."""
    reg = spark.sql(f"select * from values {REGISTRY} as t(country, lookup_url, boost)")
    rows = leads(spark, d).selectExpr("lead_id", "country", "confidence_score", f"{texts.tax_id(SPARK)} as tax_id")
    return companies.with_registry(rows, reg).select("lead_id", "url", "verified", "score")


J06 = f"select lead_id, case when tax_id is not null then replace(lookup_url, '${{id}}', tax_id) end as url, boost is not null and tax_id is not null as verified, case when boost is not null then least(100, coalesce(confidence_score, 60) + boost) end as score from (select lead_id, country, confidence_score, {texts.tax_id(DUCK)} as tax_id from {L}) l left join (values {REGISTRY}) r(country, lookup_url, boost) on l.country = r.country"


def j18_s13_knowledge(spark, d):
    """The first industry whose first word occurs in the lead's pillar."""
    known = spark.sql(f"select n, name, substring_index(name, ' ', 1) as word from values {INDUSTRIES} as t(n, name)")
    rows = leads(spark, d).select("lead_id", F.lower(F.coalesce("pillar", F.lit(""))).alias("p"))
    named = joins.first_match(rows.select("p").distinct(), known, F.expr("contains(p, word)"), ["p"], [F.col("n")])  # pillars are few, leads many
    return rows.join(named, "p").select("lead_id", "name")


J18 = f"select lead_id, arg_min(name, n) as name from (select lead_id, lower(coalesce(pillar, '')) as p from {L}) l left join (select n, name, string_split(name, ' ')[1] as word from (values {INDUSTRIES}) t(n, name)) k on contains(p, word) group by lead_id"



def j19_category_groups(spark, d):
    """The groups of buyers that each category lets through: one dictionary row per rule and group, matched by pattern."""
    rule = spark.createDataFrame([(SPARK.pattern(p)[2:-1], g) for p, gs in rules.CATEGORY_BUYERS for g in gs], "pattern string, grp string")
    cats = leads(spark, d).select(F.lower("category").alias("category")).distinct()
    return cats.join(rule, F.expr("category rlike pattern")).groupBy("category").agg(F.array_join(F.array_sort(F.collect_set("grp")), ",").alias("groups"))


J19 = f"select category, string_agg(distinct grp, ',' order by grp) as groups from (select distinct lower(category) as category from {L}) c join (values {', '.join(f'({chr(39)}{p}{chr(39)}, {chr(39)}{g}{chr(39)})' for p, gs in rules.CATEGORY_BUYERS for g in gs)}) r(pattern, grp) on regexp_matches(category, pattern) group by category"

POLICIES = "('US', 'flour', 'maps', 0.2, 10), (cast(null as string), 'mattress', 'maps', -0.5, 5), ('SG', cast(null as string), 'organic', 0.1, 3), (cast(null as string), cast(null as string), 'social', 0.9, 7)"


def j10_a09_policies(spark, d):
    """Policies that hold for each lead's country and category, summed per kind to a channel weight."""
    pol = spark.sql(f"select * from values {POLICIES} as t(p_country, p_category, kind, delta, samples)")
    jobs = leads(spark, d).select("country", "category").distinct()
    by_kind = joins.scoped_policies(jobs, pol).groupBy("country", "category", "kind").agg(F.sum(F.col("delta").cast("double")).alias("delta"), F.sum("samples").alias("samples"))
    return by_kind.select("country", "category", "kind", "samples", F.round(joins.channel_weight(F.col("delta"), F.col("kind") == "organic"), 6).alias("weight"))


J10 = f"select country, category, kind, cast(sum(samples) as bigint) as samples, round(case when kind = 'organic' then 0.0 else least(2.0, greatest(0.0, 1 + 3 * sum(cast(delta as double)))) end, 6) as weight from (select distinct country, category from {L}) j join (values {POLICIES}) p(p_country, p_category, kind, delta, samples) on (p_country is null or p_country = country) and (p_category is null or p_category = category) group by country, category, kind"


def j12_j13_t02_tasks(spark, d):
    """The grid of kinds and nations with its sweep state from the orders, and the task swept longest ago per nation."""
    grid = table(spark, d, "part").select("p_type").distinct().crossJoin(table(spark, d, "nation").select("n_nationkey"))
    state = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("p_type", F.expr("case o_orderstatus when 'O' then 'SMALL' when 'F' then 'LARGE' else 'PROMO' end")).groupBy("p_type", F.col("c_nationkey").alias("n_nationkey")).agg(F.max("o_orderdate").alias("last_swept"), F.count("*").alias("sweep_count"))
    tasks = grid.join(state, ["p_type", "n_nationkey"], "left").withColumn("last_swept", F.coalesce("last_swept", F.lit("1970-01-01").cast("timestamp_ntz"))).withColumn("sweep_count", F.coalesce("sweep_count", F.lit(0)) + 1)
    return keep.keep_first(tasks, ["n_nationkey"], [F.col("last_swept"), F.col("p_type")]).select("n_nationkey", "p_type", F.date_format("last_swept", "yyyy-MM-dd").alias("last_swept"), "sweep_count")


J12 = """
with g as (select distinct p_type, n_nationkey from part, nation),
s as (select case o_orderstatus when 'O' then 'SMALL' when 'F' then 'LARGE' else 'PROMO' end as p_type, c_nationkey as n_nationkey, max(o_orderdate) as last_swept, count(*) as sweep_count from orders join customer on o_custkey = c_custkey group by all)
select n_nationkey, p_type, strftime(last_swept, '%Y-%m-%d') as last_swept, sweep_count from (
  select g.n_nationkey, g.p_type, coalesce(last_swept, timestamp '1970-01-01') as last_swept, coalesce(sweep_count, 0) + 1 as sweep_count,
         row_number() over (partition by g.n_nationkey order by coalesce(last_swept, timestamp '1970-01-01'), g.p_type) as rn from g left join s on g.p_type = s.p_type and g.n_nationkey = s.n_nationkey) where rn = 1
"""


# positions, caches, increments ------------------------------------------


def j01_j02_positional(spark, d):
    """Each batch's rows with the results of its array by position: a null result leaves its row without, another name is only counted."""
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("batch_id"), (F.col("l_linenumber") - 1).alias("pos"), "l_partkey")
    name = F.concat(F.lit("Name  "), F.col("l_partkey").cast("string"))
    got = F.when(F.col("l_partkey") % 11 == 0, "other").when(F.col("l_partkey") % 13 == 0, "").otherwise(F.concat(F.lit(" name "), F.col("l_partkey").cast("string")))
    result = F.when(F.col("l_partkey") % 7 != 0, F.struct(got.alias("name"), (F.col("l_partkey") % 3 == 0).alias("company")))
    arrays = rows.groupBy("batch_id", "pos").agg(F.min("l_partkey").alias("l_partkey")).withColumn("r", result).groupBy("batch_id").agg(F.max("pos").alias("top"), F.map_from_entries(F.collect_list(F.struct("pos", "r"))).alias("m"))
    arrays = arrays.select("batch_id", F.transform(F.sequence(F.lit(0), "top"), lambda i: F.try_element_at("m", i)).alias("results"))
    return joins.positional(rows.withColumn("name", name), arrays, "left").groupBy("batch_id").agg(F.count("*").alias("n"), F.count("r").alias("with_result"), F.count_if(F.col("r.company")).alias("companies"), F.count_if(outputs.name_drift(F.col("name"), F.col("r.name"))).alias("drift"))


J01 = "with m as (select l_orderkey, l_linenumber, min(l_partkey) as p from lineitem group by all) select l_orderkey as batch_id, count(*) as n, count(*) filter (where p % 7 <> 0) as with_result, count(*) filter (where p % 7 <> 0 and p % 3 = 0) as companies, count(*) filter (where p % 7 <> 0 and (p % 11 = 0 or (p % 13 <> 0 and p <> l_partkey))) as drift from lineitem join m using (l_orderkey, l_linenumber) group by l_orderkey"


def j03_k02_last_result(spark, d):
    """Queue rows with the last enrichment result of their key (by time); rows without one stay."""
    order = [F.col("ts").desc(), F.col("attempt_id").desc()]
    rows = queue(spark, d).where("status = 'pending'").select("row_id", "key")
    return companies.with_last_result(rows, attempts(spark, d), "key", order, [F.col("layer").alias("via"), "contacts"]).select("row_id", "key", "via", "contacts")


J03 = f"select row_id, q.key, via, contacts from (select * from {view('queue')} where status = 'pending') q left join (select key, arg_max(layer, (ts, attempt_id)) as via, arg_max(contacts, (ts, attempt_id)) as contacts from {view('attempts')} group by key) a on q.key = a.key"


def j04_ids(spark, d):
    """Leads with the id of their company: the row inserted now, else the one there before."""
    rows = leads(spark, d).selectExpr("lead_id", f"{texts.name_key('company_name')} as name_key", f"{texts.country_code('country')} as cc").where("name_key <> ''")
    old = rows.where("lead_id % 3 = 0").groupBy("name_key", "cc").agg(F.min("lead_id").alias("old_id"))
    return companies.company_ids(rows.where("cc is not null"), old, ["name_key", "cc"], "lead_id").select("lead_id", "company_id")


J04 = f"with r as (select lead_id, {texts.name_key('company_name')} as nk, {texts.country_code('country')} as cc from {L} where {texts.name_key('company_name')} <> ''), g as (select nk, cc, min(lead_id) filter (where lead_id % 3 = 0) as old_id, min(lead_id) as first_id from r group by nk, cc) select lead_id, coalesce(old_id, first_id) as company_id from r join g on r.nk = g.nk and r.cc = g.cc"


def j05_y04_incremental(spark, d):
    """Companies of the second half of the orders that the first half hadn't, and the number skipped."""
    item = table(spark, d, "lineitem").select((F.col("l_partkey") * 100 + F.col("l_quantity").cast("long")).alias("company_id"), (F.col("l_orderkey") % 2 == 1).alias("fresh"))
    fresh, skipped = joins.incremental(item.where("fresh").select("company_id").distinct(), item.where("not fresh").select("company_id"))
    return fresh.agg(F.count("*").alias("written"), F.sum("company_id").alias("checksum")).crossJoin(skipped)


J05 = "with i as (select l_partkey * 100 + cast(l_quantity as bigint) as c, l_orderkey % 2 = 1 as fresh from lineitem), n as (select distinct c from i where fresh), o as (select distinct c from i where not fresh) select count(*) filter (where o.c is null) as written, cast(sum(n.c) filter (where o.c is null) as bigint) as checksum, count(o.c) as incremental_skipped from n left join o on n.c = o.c"


NOW = "timestamp_ntz '2024-02-05 00:00:00'"


def j15_j16_x27_cache(spark, d):
    """Queue rows with the contact cached for their key in the last 30 days; without one they are misses."""
    cache = attempts(spark, d).groupBy("key").agg(F.max("ts").alias("cached_at"), F.max_by("contacts", F.struct("ts", "attempt_id")).alias("contacts"))
    rows = queue(spark, d).where("status = 'pending'")
    out = joins.with_cache(rows, cache.withColumn("cached_at", F.expr("cached_at - make_interval(0, 0, 0, cast(key % 40 as int))")), "key", F.expr(NOW))
    return out.select("row_id", F.col("cached_at").isNotNull().alias("hit"), "contacts")


J15 = f"with c as (select key, max(ts) - to_days(cast(key % 40 as int)) as cached_at, arg_max(contacts, (ts, attempt_id)) as contacts from {view('attempts')} group by key) select row_id, cached_at is not null as hit, contacts from (select * from {view('queue')} where status = 'pending') q left join (select * from c where cached_at >= timestamp '2024-02-05' - interval 30 day) c on q.key = c.key"


def _inference_rows(spark, d):
    return leads(spark, d).selectExpr("lead_id", f"{outputs.inference_key(SPARK, 'company_name', 'category', 'job_id % 2 = 0')} as key", "entity_role", "bal")


def j16_inference(spark, d):
    """Leads with the inference cached under their name, category and direction in the last 30 days, and the misses."""
    rows = _inference_rows(spark, d)
    cache = rows.where("lead_id % 3 = 0").selectExpr("key", "case when lead_id % 5 > 0 then coalesce(entity_role, 'Service') || lead_id end as value", f"{NOW} - make_interval(0, 0, 0, cast(lead_id % 45 as int)) - make_interval(0, 0, 0, 0, 0, 0, lead_id / 10000000) as cached_at")
    hits, misses = outputs.with_inference(rows, cache, F.expr(NOW))
    return hits.select("lead_id", "key", "value").unionByName(misses.select("lead_id", "key", F.lit(None).cast("string").alias("value")))


_J16_KEY = outputs.inference_key(DUCK, "company_name", "category", "job_id % 2 = 0")
J16 = f"""
with r as (select lead_id, {_J16_KEY} as key, entity_role from {L}),
c as (select key, arg_max(coalesce(entity_role, 'Service') || lead_id, (-(lead_id % 45), -lead_id)) as value, min(lead_id % 45) as age, arg_max(lead_id, (-(lead_id % 45), -lead_id)) as newest from r where lead_id % 3 = 0 and lead_id % 5 > 0 group by key)
select r.lead_id, r.key, case when age < 30 or (age = 30 and newest < 0) then value end as value from r left join c on r.key = c.key"""


def j14_j23_merge(spark, d):
    """Details over rows: a value of the details wins, else the row's own stays."""
    rows = leads(spark, d).select("lead_id", "place_id", "domain", "primary_phone")
    details = leads(spark, d).where("lead_id % 3 = 1").select("lead_id", F.expr("case when lead_id % 2 = 0 then 'https://detail.com' end").alias("domain"), F.lit("+1").alias("primary_phone"))
    return keep.merge_columns(rows, details, ["lead_id"])


J14 = f"select lead_id, place_id, case when lead_id % 3 = 1 and lead_id % 2 = 0 then 'https://detail.com' else domain end as domain, case when lead_id % 3 = 1 then '+1' else primary_phone end as primary_phone from {L}"


def j20_k08_seeds(spark, d):
    """Hot leads fed back as seeds: 90 points or more, a contact, a name and a domain that isn't known yet; first of each domain."""
    known = leads(spark, d).where("lead_id % 4 = 0 and domain is not null").selectExpr("lower(domain) as d").distinct()
    return companies.seed_feedback(leads(spark, d), known).select(F.col("d").alias("domain"), "lead_id", "confidence_score")


J20 = f"select lower(domain) as domain, min(lead_id) as lead_id, 95 as confidence_score from {L} where confidence_score >= 90 and coalesce(company_name, '') <> '' and coalesce(domain, '') <> '' and (coalesce(primary_email, '') <> '' or coalesce(primary_phone, '') <> '') and lower(domain) not in (select lower(domain) from {L} where lead_id % 4 = 0 and domain is not null) group by lower(domain)"


def j21_j22_x10_u06_coefficients(spark, d):
    """Coefficients of (brand, type) that the dictionary lacks, with the type's and the global default behind them."""
    part, ratio = table(spark, d, "part"), F.count_if(F.col("p_size") > 25) / F.count("*")
    have = part.where("p_size < 10").select("p_brand", "p_type").distinct()
    return companies.new_coefficients(part.groupBy("p_brand", "p_type").agg(ratio.alias("ratio")), have, part.groupBy("p_type").agg(ratio.alias("group_ratio")), ["p_brand", "p_type"], "p_type")


J21 = "with n as (select p_brand, p_type, count(*) filter (where p_size > 25) / count(*) as ratio from part group by all), h as (select distinct p_brand, p_type from part where p_size < 10), t as (select p_type, count(*) filter (where p_size > 25) / count(*) as type_ratio from part group by all) select n.p_brand, n.p_type, round(least(0.95, round(ratio, 2) + 0.1), 6) as exact, round(type_ratio, 2) as fallback from n join t on n.p_type = t.p_type where not exists (select 1 from h where h.p_brand = n.p_brand and h.p_type = n.p_type)"


# T: sorts, limits, waterfalls -------------------------------------------


def t03_t04_t10_batches(spark, d):
    """Per job the first 150 pending rows below the retry limit, fewest retries first, then the oldest."""
    rows = queue(spark, d).where("status = 'pending' and (retry_count is null or retry_count < 3)")
    return keep.keep_top(rows, ["job_id"], [F.col("retry_count"), F.col("created_at"), F.col("row_id")], 150).select("job_id", "row_id", "rank")


T03 = f"select job_id, row_id, rank from (select *, row_number() over (partition by job_id order by retry_count, created_at, row_id) as rank from {view('queue')} where status = 'pending' and retry_count < 3) where rank <= 150"


def t06_t08_places(spark, d):
    """Per job the 50 places that are listed first: preferred kinds before others, else in input order."""
    rows = signals(spark, d).withColumn("preferred", F.arrays_overlap(F.split(F.coalesce("place_types", F.lit("")), ","), F.array(F.lit("warehouse"))))
    return keep.keep_top(rows, ["job_id"], [F.col("preferred").desc(), F.col("pos")], 50).select("job_id", "signal_id", "rank")


T06 = f"select job_id, signal_id, rank from (select *, row_number() over (partition by job_id order by list_contains(string_split(coalesce(place_types, ''), ','), 'warehouse') desc, pos) as rank from {S}) where rank <= 50"


def t09_tiers(spark, d):
    counts = signals(spark, d).groupBy("job_id", F.col("page").alias("tier")).agg(F.count("*").alias("n"))
    return joins.tier_stop(counts, "job_id", "tier", "n", 150)


T09 = f"select *, rows_before < 150 as runs from (select job_id, tier, n, cast(coalesce(sum(n) over (partition by job_id order by tier rows between unbounded preceding and 1 preceding), 0) as bigint) as rows_before from (select job_id, page as tier, count(*) as n from {S} group by job_id, page))"


def t11_waterfall(spark, d):
    return joins.waterfall(attempts(spark, d), "key", [F.col("ts"), F.col("attempt_id")], 12)


T11 = f"""
with s as (select *, coalesce(sum(cost) over w, 0) as spent, coalesce(bool_or(contacts > 0) over w, false) as hb from {view('attempts')} where available
           window w as (partition by key order by ts, attempt_id rows between unbounded preceding and 1 preceding))
select key, bool_or(contacts > 0) as hit, max(case when contacts > 0 then layer end) as via, cast(sum(cost) as bigint) as cost, count(*) as tried from s where not hb and spent + cost <= 12 group by key
"""


# U: sets -----------------------------------------------------------------


def u01_u02_p43_union(spark, d):
    """Outputs of different shape under one schema; what a part lacks is null."""
    a = leads(spark, d).where("lead_id % 2 = 0").select("lead_id", "company_name", "confidence_score")
    b = leads(spark, d).where("lead_id % 2 = 1").select("lead_id", "pillar")
    return a.unionByName(b, allowMissingColumns=True)


U01 = f"select lead_id, case when lead_id % 2 = 0 then company_name end as company_name, case when lead_id % 2 = 0 then confidence_score end as confidence_score, case when lead_id % 2 = 1 then pillar end as pillar from {L}"


def u04_u07_a12_sets(spark, d):
    """Per job the union of key words; new ones are appended if none is equal but for case."""
    part = table(spark, d, "part")
    own = part.groupBy("p_type").agg(F.array_sort(F.collect_set(F.when(F.col("p_size") < 25, F.lower("p_brand")))).alias("old"), F.array_sort(F.collect_set(F.when(F.col("p_size") >= 20, F.upper("p_brand")))).alias("new"))
    merged = F.concat("old", F.filter("new", lambda x: ~F.array_contains("old", F.lower(x))))
    return own.select("p_type", F.size("old").cast("long").alias("n_old"), F.array_join(merged, ",").alias("merged"))


U04 = "with o as (select p_type, list_sort(list_distinct(list(lower(p_brand)) filter (where p_size < 25))) as old, list_sort(list_distinct(list(upper(p_brand)) filter (where p_size >= 20))) as new from part group by p_type) select p_type, len(old) as n_old, array_to_string(list_concat(old, list_filter(new, lambda x: not list_contains(old, lower(x)))), ',') as merged from o"


def u08_f37_direction(spark, d):
    """Pillars that run for the direction of a job: for suppliers the shared two and the supplier pillars."""
    rows = leads(spark, d).withColumn("direction", F.expr("case when job_id % 2 = 0 then 'find_suppliers' else 'find_buyers' end"))
    return companies.for_direction(rows, "pillar", "direction").groupBy("direction", "pillar").agg(F.count("*").alias("n"))


U08 = f"select direction, pillar, count(*) as n from (select pillar, case when regexp_matches(pillar, 'Seed|VerifiedSource') then 'shared' when pillar like 'Pillar S %' then 'supplier' else 'buyer' end as kind, case when job_id % 2 = 0 then 'find_suppliers' else 'find_buyers' end as direction from {L} where pillar is not null) where kind = 'shared' or (kind = 'supplier') = (direction = 'find_suppliers') group by all"


def register(r: Registry) -> None:
    for name, fn, sql in [
        ("w02_place_dedupe", w02_places, W02), ("w03_s02_link_dedupe", w03_links, W03), ("w07_p12_edges", w07_edges, W07), ("w09_latest_step", w09_latest, W09), ("w10_s11_j09_p13_alias", w10_s11_j09_alias, W10),
        ("j08_s12_segments", j08_segments, J08), ("j07_t05_s09_sources", j07_t05_sources, J07), ("j06_s10_p34_x11_registry", j06_p34_x11_registry, J06), ("j18_s13_knowledge", j18_s13_knowledge, J18), ("j19_category_groups", j19_category_groups, J19),
        ("j10_a09_s14_policies", j10_a09_policies, J10), ("j12_j13_t02_s08_tasks", j12_j13_t02_tasks, J12), ("j01_j02_s17_s18_positional", j01_j02_positional, J01), ("j03_queue_results", j03_k02_last_result, J03),
        ("j04_company_ids", j04_ids, J04), ("j05_y04_incremental", j05_y04_incremental, J05), ("j15_j16_x27_cache", j15_j16_x27_cache, J15), ("j16_inference_cache", j16_inference, J16), ("j14_j23_details", j14_j23_merge, J14), ("j20_k08_seed_feedback", j20_k08_seeds, J20),
        ("j21_j22_u06_coefficients", j21_j22_x10_u06_coefficients, J21), ("t03_t04_t10_s15_batches", t03_t04_t10_batches, T03), ("t06_t08_places", t06_t08_places, T06), ("t09_tier_stop", t09_tiers, T09), ("t11_g01_waterfall", t11_waterfall, T11),
        ("u01_u02_p43_union", u01_u02_p43_union, U01), ("u04_u07_a12_keyword_sets", u04_u07_a12_sets, U04), ("u08_f37_direction", u08_f37_direction, U08),
    ]:
        r.add(name, fn, sql)


