"""Queries of dictionary loaders, category keys, places, seeds, adapters: their SQL is written apart from the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.dialect import SPARK
from ..operators import adapters, companies, contacts, keep, outputs, seeds, taxonomy
from ..plans import derived
from ..sources import dictionaries, tables
from ..sources.stages import shared_dir, stage
from .common import Registry, table, view
from .joins import attempts, leads

L, A = view("leads"), view("attempts")


# dictionaries: documents of a hundred parts each ---------------------------


def _documents(spark, d, entry, shape):
    """One JSON document per hundred parts: entry is a struct of a part, shape wraps their array, in the order of the parts."""
    rows = table(spark, d, "part").withColumn("doc_id", F.expr("p_partkey div 100")).select("doc_id", F.struct("p_partkey", entry.alias("e")).alias("r"))
    lists = rows.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["e"]).alias("es"))
    return lists.select("doc_id", F.to_json(shape("es")).alias("value"))


def s11_aliases(spark, d):
    docs = _documents(spark, d, F.array(F.substring_index(F.lower("p_name"), " ", 1), "p_type"), F.col)
    return dictionaries.aliases(docs, ["doc_id"])


S11 = "select p_partkey // 100 as doc_id, string_split(lower(p_name), ' ')[1] as alias, arg_min(p_type, p_partkey) as key from part group by all"


def s11_names(spark, d):
    entry = F.struct(F.col("p_brand").alias("industry_key"), F.concat(F.lit(" "), F.col("p_type")).alias("name_zh"), F.when(F.col("p_size") > 10, F.upper("p_name")).alias("name_en"))
    return dictionaries.industry_names(_documents(spark, d, entry, lambda es: F.struct(F.col(es).alias("entries"))), ["doc_id"])


S11_NAMES = "with e as (select p_partkey // 100 as doc_id, p_type as alias, p_brand, p_partkey * 2 as n from part union all select p_partkey // 100, lower(p_name), p_brand, p_partkey * 2 + 1 from part where p_size > 10) select doc_id, alias, arg_min(p_brand, n) as key from e group by doc_id, alias"


def s12_segments(spark, d):
    entry = F.struct(F.col("p_brand").alias("segment_id"), F.split("p_name", " ").alias("keywords"), F.array("p_type").alias("mapTypes"))
    docs = _documents(spark, d, entry, lambda es: F.struct(F.col(es).alias("segments")))
    return dictionaries.segments(docs, ["doc_id"]).select("doc_id", "segment_id", F.array_join("keywords", ",").alias("keywords"), "keywords_zh", F.array_join("map_types", ",").alias("map_types")).withColumn("keywords_zh", F.col("keywords_zh").isNull())


S12 = "select p_partkey // 100 as doc_id, p_brand as segment_id, arg_max(replace(p_name, ' ', ','), p_partkey) as keywords, true as keywords_zh, arg_max(p_type, p_partkey) as map_types from part group by all"


def s09_sources(spark, d):
    source = F.struct(F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("id"), F.lower("p_brand").alias("domain"), F.array(F.lower("p_name")).alias("countries"), F.col("p_size").cast("int").alias("source_confidence_boost"))
    rows = table(spark, d, "part").withColumn("doc_id", F.expr("p_partkey div 100")).groupBy("doc_id", "p_type").agg(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", source.alias("s")))), lambda r: r["s"]).alias("list"))
    docs = rows.groupBy("doc_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("p_type", "list")))).alias("sources")).select("doc_id", F.to_json(F.struct("sources")).alias("value"))
    return dictionaries.verified_sources(docs, ["doc_id"]).select("doc_id", "region", "pos", "id", "domain", F.array_join("countries", ",").alias("countries"), F.col("source_confidence_boost").alias("boost"))


S09 = "select p_partkey // 100 as doc_id, p_type as region, cast(row_number() over (partition by p_partkey // 100, p_type order by p_partkey) - 1 as int) as pos, 's' || p_partkey as id, lower(p_brand) as domain, lower(p_name) as countries, p_size as boost from part"


def s10_registry(spark, d):
    entry = F.struct(F.lower("p_type").alias("country"), F.concat(F.lit("db"), F.col("p_partkey").cast("string")).alias("id"), F.concat(F.lit("https://"), F.col("p_brand"), F.lit("/${id}")).alias("lookup_url"), F.col("p_size").cast("int").alias("confidence_boost_on_match"))
    docs = _documents(spark, d, entry, lambda es: F.struct(F.struct(F.col(es).alias("databases")).alias("tax_verify_databases")))
    return dictionaries.tax_registry(docs, ["doc_id"])


S10 = "select p_partkey // 100 as doc_id, lower(p_type) as country, 'db' || max(p_partkey) as id, arg_max('https://' || p_brand || '/${id}', p_partkey) as lookup_url, arg_max(p_size, p_partkey) as boost from part group by all"


def s13_industries(spark, d):
    entry = F.struct(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("key"), F.struct(F.col("p_brand").alias("name")).alias("value"))
    docs = _documents(spark, d, entry, lambda es: F.struct(F.map_from_entries(es).alias("industries")))
    return dictionaries.industries(docs, ["doc_id"]).select("doc_id", "n", "name", "word", F.get_json_object("detail", "$.name").alias("detail"))


S13 = "select p_partkey // 100 as doc_id, cast(row_number() over (partition by p_partkey // 100 order by p_partkey) - 1 as int) as n, p_name || ' ' || p_partkey as name, lower(string_split(p_name, ' ')[1]) as word, p_brand as detail from part"


# category and industry keys -------------------------------------------------

_RAW = "case cast(p_partkey % 8 as int) when 0 then p_name when 1 then '【Singapore ' || p_name || '】' when 2 then upper(substr(p_name, 1, instr(p_name, ' ') - 1)) when 3 then 'foo；' || substr(p_name, instr(p_name, ' ') + 1) when 4 then ' ' when 5 then null when 6 then '[China 的 ' || p_name || ', ' || p_type || ']' else 'a text that no dictionary knows ' || p_name end"


def _keyed(spark, d):
    part = table(spark, d, "part")
    aliases = part.groupBy(F.expr("case when p_partkey % 2 = 0 then substring_index(lower(p_name), ' ', 1) else lower(p_name) end").alias("alias")).agg(F.min("p_type").alias("key"))
    names = part.groupBy(F.substring_index(F.lower("p_name"), " ", -1).alias("alias")).agg(F.min("p_brand").alias("key"))
    return part.selectExpr("p_partkey", f"{_RAW} as raw"), aliases, names


def p14_industry(spark, d):
    rows, _, names = _keyed(spark, d)
    return taxonomy.industry_keys(rows, "raw", names).select("p_partkey", "industry_key")


def p15_hints(spark, d):
    rows, aliases, names = _keyed(spark, d)
    h = taxonomy.industry_hints(rows, "raw", aliases, names)
    return h.select("p_partkey", "hint.category_key", "hint.industry_key", "hint.name", F.array_join("hint.place_type_blacklist", ",").alias("places"), "hint.hit")


_P14 = f"""
  t as (select p_partkey, raw, trim(regexp_replace(trim(regexp_replace(regexp_replace(coalesce(raw, ''), '^[\\s【\\[［\\]]+', ''), '[\\s】\\]］\\[]+$', '')), '^(singapore|china)\\s*[的,，]?\\s*', '', 'i')) as clean from (select p_partkey, {_RAW} as raw from part)),
  a as (select case when p_partkey % 2 = 0 then string_split(lower(p_name), ' ')[1] else lower(p_name) end as alias, min(p_type) as key from part group by 1),
  n as (select string_split(lower(p_name), ' ')[-1] as alias, min(p_brand) as key from part group by 1),
  ns as (select p_partkey, i, trim(seg) as seg from (select p_partkey, unnest(regexp_split_to_array(clean, '[；;、，,|\\s]')) as seg, generate_subscripts(regexp_split_to_array(clean, '[；;、，,|\\s]'), 1) as i from t) union all select p_partkey, 0, clean from t),
  nk as (select p_partkey, arg_min(coalesce(n1.key, n2.key), i) as key from ns left join n n1 on n1.alias = seg left join n n2 on n2.alias = lower(seg) where seg <> '' and (i = 0 or length(seg) >= 2) and coalesce(n1.key, n2.key) is not null group by p_partkey)"""
P14 = f"with {_P14} select t.p_partkey, nk.key as industry_key from t left join nk using (p_partkey)"
P15 = f"""with {_P14},
  cs as (select p_partkey, i, trim(seg) as seg from (select p_partkey, unnest(regexp_split_to_array(clean, '[；;、，,|]')) as seg, generate_subscripts(regexp_split_to_array(clean, '[；;、，,|]'), 1) as i from t) union all select p_partkey, 0, clean from t),
  ck as (select p_partkey, arg_min(coalesce(n1.key, n2.key), i) as key from cs left join a n1 on n1.alias = seg left join a n2 on n2.alias = lower(seg) where seg <> '' and coalesce(n1.key, n2.key) is not null and (i = 0 or coalesce(n1.key, n2.key) <> 'other') group by p_partkey),
  f as (select t.p_partkey, raw, case when clean = '' then 'other' else coalesce(ck.key, case when length(clean) <= 24 then lower(clean) end, 'other') end as category_key, nk.key as industry_key from t left join ck using (p_partkey) left join nk using (p_partkey))
select p_partkey, category_key, industry_key, trim(coalesce(raw, '')) as name, 'bank,lawyer,accounting,insurance_agency,real_estate_agency' as places, category_key <> 'other' or industry_key is not null as hit from f"""


def p46_places(spark, d):
    rows = leads(spark, d).selectExpr("lead_id", "case when lead_id % 9 = 0 then null when lead_id % 9 = 1 then ' De' when lead_id % 9 = 2 then 'zz' else country end as c")
    return rows.selectExpr("lead_id", f"{taxonomy.country_name('c')} as country_name", f"{taxonomy.language('c')} as language", f"{taxonomy.major_cities('c')} as cities")


P46 = f"""
with c as (select lead_id, case when lead_id % 9 = 0 then 'us' when lead_id % 9 = 1 then 'de' when lead_id % 9 = 2 then 'zz' when country = 'Brazil' then 'br' else lower(country) end as c from {L}),
k(c, country_name, language, cities) as (values ('us', 'United States', 'English', 'New York,Los Angeles,Chicago,Houston,Phoenix'), ('sg', 'Singapore', 'English', 'Singapore'), ('de', 'Germany', 'German', 'Berlin,Hamburg,Munich,Frankfurt,Cologne'),
  ('gb', 'United Kingdom', 'English', 'London,Birmingham,Manchester,Leeds,Bristol'), ('mx', 'Mexico', 'Spanish', 'Mexico City,Guadalajara,Monterrey,Puebla,Tijuana'), ('jp', 'Japan', 'Japanese', 'Tokyo,Osaka,Nagoya,Sapporo,Fukuoka'),
  ('ch', 'Switzerland', 'German', null), ('br', 'Brazil', 'Portuguese', 'São Paulo,Rio de Janeiro,Belo Horizonte,Curitiba,Porto Alegre'), ('zz', 'ZZ', 'English', null))
select lead_id, country_name, language, cities from c join k using (c)"""


# jobs, seeds, grids ----------------------------------------------------------


def _jobs(spark, d):
    """One job per country and category of the leads."""
    return leads(spark, d).where("category is not null").groupBy("country", "category").agg(F.min("lead_id").alias("job_id"))


_JOBS = f"(select country, category, min(lead_id) as job_id from {L} where category is not null group by country, category)"
_SEEDS = "lead_id as seed_id, case when lead_id % 7 = 0 then null else country end as country, case when lead_id % 5 = 0 then null else category end as category, case when lead_id % 3 = 0 then 'consumed' else 'pending' end as status"


def j11_seeds(spark, d):
    """Every lead as a seed, met by every job of its country whose category word it holds."""
    return seeds.seeds_by_category(_jobs(spark, d), leads(spark, d).selectExpr("lead_id as seed_id", "country", "category"))


J11 = f"select j.job_id, lower(s.category) as seed_category, count(*) as n_seeds, min(s.lead_id) as first_seed from {_JOBS} j join {L} s on lower(j.country) = lower(s.country) and contains(lower(s.category), lower(string_split(j.category, ' ')[1])) group by j.job_id, lower(s.category)"


def s05_seeds(spark, d):
    jobs, rows = _jobs(spark, d), leads(spark, d).selectExpr(*_SEEDS.split(", "))
    return seeds.consume(rows, seeds.pending_seeds(jobs, rows)).select("seed_id", "status", "consumed_by")


S05 = f"""
with s as (select {_SEEDS} from {L}), j as (select job_id, country, lower(category) as category from {_JOBS}),
c as (select j.job_id, j.category as jc, s.seed_id, s.category, row_number() over (partition by j.job_id order by s.seed_id) as k from j join s on s.status = 'pending' and (s.country is null or upper(s.country) = upper(j.country))),
t as (select seed_id, min(job_id) as job_id from c where k <= 50 and (coalesce(category, '') = '' or contains(lower(category), jc)) group by seed_id)
select s.seed_id, case when t.job_id is not null then 'consumed' else status end as status, t.job_id as consumed_by from s left join t using (seed_id)"""


def s06_inline(spark, d):
    """Payloads of a hundred parts each: both arrays run over the limit of fifty, with blanks among them."""
    rows = table(spark, d, "part").withColumn("job_id", F.expr("p_partkey div 200"))
    url = F.expr("case when p_partkey % 3 = 0 then ' ' else concat('https://', p_brand, '/', p_partkey) end")
    lists = rows.groupBy("job_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", url.alias("u"), "p_type"))), lambda r: F.named_struct(F.lit("u"), r["u"], F.lit("m"), r["p_type"])).alias("r"))
    body = F.struct(F.struct(F.transform("r", lambda x: x["u"]).alias("social_urls"), F.transform(F.filter("r", lambda x: x["m"] != "ECONOMY"), lambda x: x["u"]).alias("company_urls")).alias("seeds"))
    return seeds.inline_seeds(lists.select("job_id", F.to_json(body).alias("payload")), "payload", "job_id")


S06 = """
with u as (select p_partkey // 200 as job_id, p_partkey, 'https://' || p_brand || '/' || p_partkey as url, p_type from part where p_partkey % 3 <> 0),
k as (select job_id, 'social' as kind, row_number() over (partition by job_id order by p_partkey) - 1 as pos, url from u union all select job_id, 'company', row_number() over (partition by job_id order by p_partkey) - 1, url from u where p_type <> 'ECONOMY')
select job_id, kind, cast(pos as int) as pos, url from k where pos < 50"""


def p39_grid(spark, d):
    """Jobs with own cities, jobs that fall back to their country's, and jobs without either."""
    rows = leads(spark, d)
    jobs = _jobs(spark, d).selectExpr("job_id", f"{taxonomy.country_name('country')} as country_name", "job_id % 3 = 0 as deep", f"split({taxonomy.major_cities('country')}, ',') as major")
    own = _jobs(spark, d).join(rows.select("country", "category", "entity_role", "city", "lead_id"), ["country", "category"])
    who = own.where("trim(entity_role) <> ''").groupBy("job_id", F.lower("entity_role").alias("persona")).agg(F.min("lead_id").alias("pos"))
    cities = own.where("city is not null and job_id % 2 = 0").groupBy("job_id", "city").agg(F.min("lead_id").alias("pos"))
    return seeds.job_grid(jobs, who, cities)


P39 = f"""
with j as (select job_id, country, category, case country when 'US' then 'United States' when 'SG' then 'Singapore' when 'DE' then 'Germany' when 'GB' then 'United Kingdom' when 'mx' then 'Mexico' when 'JP' then 'Japan' when 'CH' then 'Switzerland' else 'Brazil' end as country_name,
    case country when 'US' then ['New York', 'Los Angeles', 'Chicago'] when 'SG' then ['Singapore'] when 'DE' then ['Berlin', 'Hamburg', 'Munich'] when 'GB' then ['London', 'Birmingham', 'Manchester'] when 'mx' then ['Mexico City', 'Guadalajara', 'Monterrey'] when 'JP' then ['Tokyo', 'Osaka', 'Nagoya'] when 'CH' then null else ['São Paulo', 'Rio de Janeiro', 'Belo Horizonte'] end as major from {_JOBS}),
o as (select j.job_id, l.* from j join {L} l on j.country = l.country and j.category = l.category),
p as (select job_id, persona from (select job_id, lower(entity_role) as persona, row_number() over (partition by job_id order by min(lead_id)) as k from o where trim(coalesce(entity_role, '')) <> '' group by job_id, lower(entity_role)) where k <= 3),
c as (select job_id, city from (select job_id, city, row_number() over (partition by job_id order by min(lead_id)) as k from o where city is not null and job_id % 2 = 0 group by job_id, city) where k <= 3),
w as (select job_id, city from c union all select job_id, unnest(major) from j where job_id % 3 = 0 and major is not null and job_id not in (select job_id from c) union all select job_id, null from j where job_id not in (select job_id from c) and not (job_id % 3 = 0 and major is not null))
select w.job_id, trim(persona) as persona, w.city, trim(persona) || case when w.city is null then '' else ' "' || w.city || '"' end || ' ' || country_name as query from w join p on w.job_id = p.job_id join j on w.job_id = j.job_id"""


def y09_loop(spark, d):
    """Two runs over one seed table: hot leads of the first become seeds that the second finds by country."""
    rows = leads(spark, d).selectExpr("*", "lower(domain) as d")
    path = f"{shared_dir(spark)}/seeds-{uuid.uuid4().hex}"
    first = rows.where("lead_id % 4 = 0 and coalesce(d, '') <> ''").groupBy("d").agg(F.min("lead_id").alias("seed_id"), F.min_by("country", "lead_id").alias("country"))
    first.withColumn("run", F.lit(1)).write.parquet(path)
    table_ = spark.read.parquet(path)
    new = companies.seed_feedback(leads(spark, d), table_.select("d")).select("d", F.col("lead_id").alias("seed_id"), "country", F.lit(2).alias("run"))
    new.write.mode("append").parquet(path)
    again = spark.read.schema(table_.schema).parquet(path)
    return again.groupBy(F.upper("country").alias("country")).agg(F.count_if(F.col("run") == 1).alias("before"), F.count_if(F.col("run") == 2).alias("fed_back"), F.sum("seed_id").alias("checksum"))


Y09 = f"""
with r as (select *, lower(domain) as d from {L} where coalesce(domain, '') <> ''),
a as (select d, min(lead_id) as seed_id, arg_min(country, lead_id) as country, 1 as run from r where lead_id % 4 = 0 group by d),
b as (select d, min(lead_id) as seed_id, arg_min(country, lead_id) as country, 2 as run from r where confidence_score >= 90 and coalesce(company_name, '') <> '' and (coalesce(primary_email, '') <> '' or coalesce(primary_phone, '') <> '') and d not in (select d from a) group by d)
select upper(country) as country, count(*) filter (where run = 1) as before, count(*) filter (where run = 2) as fed_back, cast(sum(seed_id) as bigint) as checksum from (select * from a union all select * from b) group by upper(country)"""


# results of services, adapters ---------------------------------------------------


def s03_places(spark, d):
    """Queries of four leads each: native places where there are any, else those of the fallback."""
    rows = leads(spark, d).selectExpr("lead_id div 4 as query_id", "lead_id as pos", "company_name as title", "place_id", "case when lead_id % 2 = 0 then cast(lead_id as string) end as cid")
    return tables.places_with_fallback(rows.where("pos % 11 = 1"), rows.where("pos % 11 <> 1").drop("cid")).select("query_id", "pos", "title", "maps_url")


S03 = f"with r as (select lead_id // 4 as query_id, lead_id as pos, company_name as title, place_id, lead_id % 11 = 1 as native from {L}), q as (select distinct query_id from r where native) select query_id, pos, title, case when place_id is not null then 'https://www.google.com/maps/place/?q=place_id:' || place_id when native and pos % 2 = 0 then 'https://maps.google.com/?cid=' || pos end as maps_url from r where native or query_id not in (select query_id from q)"


def s19_persons(spark, d):
    """Up to five persons per order, from arrays of up to seven, with a way to reach them."""
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("k"), F.min("l_quantity").cast("double").alias("q"))
    person = F.struct(
        F.concat(F.lit("p"), F.col("k").cast("string")).alias("name"), F.lit(None).cast("string").alias("title"), F.when(F.col("k") % 3 == 0, F.concat(F.lit("p"), F.col("k").cast("string"), F.lit("@firm.com"))).alias("email"),
        F.when(F.col("k") % 5 == 0, F.lit("")).when(F.col("k") % 4 == 0, F.lit("+65 1")).alias("phone"), F.lit(None).cast("string").alias("linkedin"), F.when(F.col("l_linenumber") != 2, F.col("q") / 32 - 0.25).alias("confidence"),
    )
    lists = rows.groupBy(F.col("l_orderkey").alias("company_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", person.alias("p")))), lambda x: x["p"]).alias("persons"))
    return tables.persons(lists).select("company_id", "pos", "name", "email", "confidence")


S19 = """
with r as (select l_orderkey as company_id, l_linenumber, min(l_partkey) as k, cast(min(l_quantity) as double) as q from lineitem group by all), n as (select *, row_number() over (partition by company_id order by l_linenumber) - 1 as pos from r)
select company_id, cast(pos as int) as pos, 'p' || k as name, case when k % 3 = 0 then 'p' || k || '@firm.com' end as email, case when l_linenumber = 2 then 0.5 else least(1.0, greatest(0.0, q / 32 - 0.25)) end as confidence from n where pos < 5 and (k % 3 = 0 or (k % 4 = 0 and k % 5 <> 0))"""


def _adapters(spark, d):
    rows = keep.keep_first(attempts(spark, d), ["key", "layer"], [F.col("ts"), F.col("attempt_id")])
    return rows.selectExpr("key", "layer as adapter", "cost", "attempt_id as pos", "available", "case when attempt_id % 5 = 0 then null when attempt_id % 3 = 0 then contacts else 0 end as hits")


def g01_search(spark, d):
    return seeds.adapter_search(_adapters(spark, d), "key", ["cost", "pos"], 6)


G01 = f"""
with recursive f as (select key, layer, min(cost) as cost, arg_min(attempt_id, (ts, attempt_id)) as pos, arg_min(available, (ts, attempt_id)) as available, arg_min(contacts, (ts, attempt_id)) as contacts from {A} group by key, layer),
o as (select *, case when pos % 5 = 0 then null when pos % 3 = 0 then contacts else 0 end as hits, row_number() over (partition by key order by cost, pos) as i from f where available),
s as (
  select key, 0 as i, 0.0::double as cost, '' as tried, cast(null as varchar) as adapter_id, 0 as hits, false as zero from (select distinct key from f)
  union all
  select s.key, o.i, case when go then s.cost + o.cost else s.cost end, case when not go then s.tried when s.tried = '' then o.layer else s.tried || ',' || o.layer end, case when go and o.hits > 0 then o.layer else s.adapter_id end, case when go then coalesce(o.hits, 0) else s.hits end, s.zero or (go and coalesce(o.hits = 0, false))
  from s join o on s.key = o.key and o.i = s.i + 1, lateral (select s.adapter_id is null and s.cost + o.cost <= 6 as go)),
e as (select key, arg_max(cost, i) as cost, arg_max(tried, i) as tried, max(adapter_id) as adapter_id, arg_max(hits, i) as hits, bool_or(zero) as zero from s group by key)
select key, adapter_id is not null or zero as ok, adapter_id, cast(hits as bigint) as hits, cost, tried, case when adapter_id is not null then null when zero then 'zero_results' when tried = '' then 'no_available_adapter' else 'all_adapters_failed:' || tried end as reason from e"""


_LAYERS = {"home": 0, "bfs": 0, "llm": 1, "vision": 5, "serper": 1}


def g01_rounds(spark, d):
    """Every key asked of five adapters over recorded answers, in the order of what a hit of each has cost so far, within a budget of six."""
    rows = attempts(spark, d).selectExpr("key", "layer", "ts", "attempt_id", "case when attempt_id % 5 > 0 then case when attempt_id % 3 = 0 then contacts else 0 end end as n")
    first = stage(keep.keep_first(rows, ["key", "layer"], [F.col("ts"), F.col("attempt_id")]).where("n is not null"), "answers")
    hits = F.transform(F.expr("sequence(1, n)"), lambda i: F.struct(i.cast("string").alias("title"), F.lit("l").alias("link")))
    answers = first.select("key", "layer", F.when(F.col("n") > 0, hits).otherwise(F.array().cast(adapters.HITS)).alias("hits"), F.col("ts").alias("asked_at"))
    known = [adapters.Adapter(x, adapters.recorded(answers.where(F.col("layer") == x)), float(cost)) for x, cost in _LAYERS.items()]
    stats = adapters.stats_of(rows.select(F.col("layer").alias("adapter"), F.col("n").alias("n_hits")))
    queries = rows.select("key", F.lit("q").alias("query")).distinct()
    found, _ = adapters.search(queries, known, stats, budget=6)
    return found.select("key", "ok", "adapter", F.size("hits").cast("long").alias("n_hits"), "cost", F.array_join("tried", ",").alias("tried"), "zero_results", "reason")


_N = "case when attempt_id % 5 > 0 then case when attempt_id % 3 = 0 then contacts else 0 end end"
G01_ROUNDS = f"""
with recursive f as (select key, layer, arg_min({_N}, (ts, attempt_id)) as n0, min_by(struct_pack(n := {_N}), (ts, attempt_id)).n as hits from {A} group by key, layer),
e as (select layer, c as cost, i as place, case when c = 0 then 0.0 else c / greatest(coalesce(h, 0) / n, 0.05) end as expected from (values {', '.join(f"('{x}', {c}, {i})" for i, (x, c) in enumerate(_LAYERS.items()))}) t(layer, c, i) join (select layer, count(*) as n, count(*) filter (where {_N} > 0) as h from {A} group by layer) using (layer)),
o as (select k.key, e.layer, cost, hits, row_number() over (partition by k.key order by expected, place) as i from (select distinct key from {A}) k cross join e left join f on f.key = k.key and f.layer = e.layer),
s as (
  select key, cast(0 as bigint) as i, 0.0::double as cost, '' as tried, cast(null as varchar) as adapter, 0 as hits, false as zero from (select distinct key from {A})
  union all
  select s.key, o.i, case when go then s.cost + o.cost else s.cost end, case when not go then s.tried when s.tried = '' then o.layer else s.tried || ',' || o.layer end, case when go and o.hits > 0 then o.layer else s.adapter end, case when go then coalesce(o.hits, 0) else s.hits end, s.zero or (go and coalesce(o.hits = 0, false))
  from s join o on s.key = o.key and o.i = s.i + 1, lateral (select s.adapter is null and s.cost + o.cost <= 6 as go))
select key, adapter is not null or zero as ok, adapter, cast(case when adapter is not null then hits else 0 end as bigint) as n_hits, cost, tried, adapter is null and zero as zero_results,
  case when adapter is not null then null when zero then 'zero_results' when tried = '' then 'no_available_adapter' else 'all_adapters_failed:' || tried end as reason from s where i = 5"""


def t12_waterfall(spark, d):
    """The budget differs by key: two, the usual one, under which vision never runs, or ten."""
    got = attempts(spark, d).groupBy("key").pivot("layer", list(seeds.LAYERS)).agg(F.max(F.expr("case when attempt_id % 7 = 0 then contacts else 0 end"))).na.fill(0)
    return seeds.contact_waterfall(got, "key", "case when key % 2 = 0 then 2 else 10 end")


T12 = f"""
with g as (select key, {', '.join(f"coalesce(max(case when attempt_id % 7 = 0 then contacts else 0 end) filter (where layer = '{x}'), 0) as {x}" for x in ('home', 'bfs', 'llm', 'vision', 'serper'))} from {A} group by key),
k as (select *, case when home > 0 then 'home' when bfs > 0 then 'bfs' when llm > 0 then 'llm' end as early, key % 2 <> 0 as rich from g)
select key, case when early is not null then early when rich and vision > 0 then 'vision' when serper > 0 then 'serper' end as via,
  case when early in ('home', 'bfs') then 0 when early = 'llm' then 1 when not rich then 2 when vision > 0 then 6 else 7 end as cost,
  coalesce(early, '') not in ('home', 'bfs') as llm_ran, early is null and rich as vision_ran, early is null and not (rich and vision > 0) as serper_ran from k"""


def x28_confidence(spark, d):
    """Contacts per source with the confidence of its channel."""
    rows = contacts.page_contacts(derived.build(spark, d, "contact_pages"), SPARK)
    return rows.selectExpr("source", "priority", f"{contacts.source_confidence('source')} as confidence").groupBy("source", "priority", "confidence").agg(F.count("*").alias("n"))


def s08_taxonomy(spark, d):
    """A taxonomy document per brand: kinds of part with their sizes as an array, as a text or left out."""
    rows = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_set("p_size")).alias("sizes"))
    sizes = F.transform("sizes", lambda x: F.concat(F.lit("s"), x.cast("string")))
    n = F.size("sizes")
    value = F.when(n % 4 == 0, F.to_json(F.struct(sizes.alias("subcategories")))).when(n % 4 == 1, F.to_json(F.struct(F.array_join(sizes, "  ").alias("subcategories")))).when(n % 4 == 2, F.lit('{"subcategories": []}')).otherwise(F.lit('{"other": 1}'))
    docs = rows.groupBy("p_brand").agg(F.concat(F.lit('{"industries": {'), F.array_join(F.array_sort(F.collect_list(F.concat(F.lit('"'), "p_brand", F.lit("/"), "p_type", F.lit('": '), value))), ", "), F.lit("}}")).alias("value"))
    return outputs.subcategories(docs).select("industry", "pos", "category")


S08 = """
with r as (select p_brand || '/' || p_type as industry, list_sort(list_distinct(list(p_size))) as sizes from part group by p_brand, p_type),
t as (select industry, case when len(sizes) % 4 < 2 then list_transform(sizes, lambda x: 's' || x) else [industry] end as targets from r)
select industry, cast(generate_subscripts(targets, 1) - 1 as int) as pos, unnest(targets) as category from t"""


def register(r: Registry) -> None:
    from .contacts import _CONTACTS

    x28 = f"select source, case when source in ('mailto_link', 'tel_link') then 100 when source = 'whatsapp_link' then 90 when source = 'plain_regex' then 50 else 30 end as priority, case when source in ('mailto_link', 'tel_link') then 0.95 when source = 'whatsapp_link' then 0.9 when source = 'plain_regex' then 0.5 else 0.55 end::double as confidence, count(*) as n from ({_CONTACTS}) group by source"
    for name, fn, sql in [
        ("s09_source_flatten", s09_sources, S09), ("s10_tax_registry", s10_registry, S10), ("s11_alias_entries", s11_aliases, S11), ("s11_industry_names", s11_names, S11_NAMES), ("s12_segment_dictionary", s12_segments, S12), ("s13_industry_dictionary", s13_industries, S13),
        ("p14_industry_key", p14_industry, P14), ("p15_p13_industry_hint", p15_hints, P15), ("p46_place_names", p46_places, P46), ("j11_s04_seeds", j11_seeds, J11), ("s05_pending_seeds", s05_seeds, S05), ("s06_inline_seeds", s06_inline, S06), ("p39_job_grid", p39_grid, P39),
        ("s08_taxonomy_flatten", s08_taxonomy, S08), ("y09_seed_loop", y09_loop, Y09), ("s03_p29_places", s03_places, S03), ("s19_persons", s19_persons, S19), ("g01_adapter_search", g01_search, G01), ("g01_s16_adapter_rounds", g01_rounds, G01_ROUNDS), ("t12_contact_waterfall", t12_waterfall, T12), ("x28_confidence", x28_confidence, x28),
    ]:
        r.add(name, fn, sql)
