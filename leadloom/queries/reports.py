"""Queries of aggregates, sinks and the company row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import texts
from ..functions.dialect import DUCK, SPARK
from ..operators import company, gate, joins, keep, outputs, select
from ..plans import derived
from ..sources.stages import stage
from .common import Registry, table, view
from .joins import attempts, leads, queue, signals

L, S, Q, A = view("leads"), view("signals"), view("queue"), view("attempts")
_DUCK_GATE = gate.evaluate_sql(derived.sql("leads"), DUCK)
_COMPANY = ["lead_id", *company.base_columns(DUCK), *company.supplier_columns(), *company.commerce_columns(DUCK), "signals"]


def p21_company(spark, d):
    return company.company_rows(leads(spark, d)).select(*_COMPANY)


def p23_bundle(spark, d):
    rows = company.company_rows(leads(spark, d)).withColumn("b", company.contact_bundle())
    return rows.select("lead_id", "b.email", "b.phone", "b.website", "b.address", "b.maps_place_id")


P23 = f"select lead_id, nullif(trim(primary_email), '') as email, nullif(trim(primary_phone), '') as phone, {texts.domain_column(DUCK, 'domain')} as website, coalesce(nullif(trim(snippet), ''), nullif(trim(city), '')) as address, nullif(trim(place_id), '') as maps_place_id from {L}"


def a06_layers(spark, d):
    """Per layer: attempts, hits and hit rate; all layers are there, the rate of an untried one is null."""
    return attempts(spark, d).groupBy("layer").agg(F.count_if("available").alias("attempted"), F.count_if(F.col("available") & (F.col("contacts") > 1)).alias("hit"), F.round(F.try_divide(F.count_if(F.col("available") & (F.col("contacts") > 1)), F.count_if("available")), 3).alias("rate"))


A06 = f"select layer, count(*) filter (where available) as attempted, count(*) filter (where available and contacts > 1) as hit, round(count(*) filter (where available and contacts > 1) / nullif(count(*) filter (where available), 0), 3) as rate from {A} group by layer"


def a07_a11_totals(spark, d):
    """Per job: rows, rows filled, fill rate, hit rate in percent, cost and mean cost."""
    done = joins.waterfall(attempts(spark, d), "key", [F.col("ts"), F.col("attempt_id")], 12).withColumn("job_id", (F.col("key") % 5).cast("int"))
    n = F.count("*")
    return done.groupBy("job_id").agg(n.alias("n"), F.count_if("hit").alias("filled"), F.round(F.count_if("hit") / n, 3).alias("rate"), F.round(100 * F.count_if("hit") / n, 0).cast("int").alias("percent"), F.sum("cost").alias("cost"), F.round(F.sum("cost") / n, 2).alias("mean_cost"))


A07 = """
with s as (select *, coalesce(sum(cost) over w, 0) as spent, coalesce(bool_or(contacts > 0) over w, false) as hb from {A} where available window w as (partition by key order by ts, attempt_id rows between unbounded preceding and 1 preceding)),
k as (select key, bool_or(contacts > 0) as hit, sum(cost) as cost from s where not hb and spent + cost <= 12 group by key)
select cast(key % 5 as int) as job_id, count(*) as n, count(*) filter (where hit) as filled, round(count(*) filter (where hit) / count(*), 3) as rate, cast(round(100 * count(*) filter (where hit) / count(*), 0) as int) as percent, cast(sum(cost) as bigint) as cost, round(sum(cost) / count(*), 2) as mean_cost from k group by all
""".replace("{A}", A)


_ADAPTERS = "('home', 0), ('bfs', 0), ('llm', 1), ('vision', 5), ('serper', 1), ('untried', 2), ('spare', 9)"


def a08_t07_adapters(spark, d):
    """Adapters in order of their expected cost of a hit for every key, its cached one first."""
    known = spark.sql(f"select a as adapter, cast(c as double) as cost from values {_ADAPTERS} as t(a, c)")
    tries = attempts(spark, d).where("contacts > 0 or layer <> 'serper'").select(F.col("layer").alias("adapter"), (F.col("contacts") > 1).alias("hit"))
    cached = attempts(spark, d).groupBy("key").agg(F.max_by(F.expr("case when attempt_id % 3 > 0 then layer end"), F.struct("ts", "attempt_id")).alias("adapter"))
    return outputs.ordered_adapters(known, tries, cached).select("key", "adapter", F.round("expected", 6).alias("expected"), "rank")


A08 = f"""
with k as (select * from (values {_ADAPTERS}) t(adapter, cost)), s as (select layer, count(*) as n, count(*) filter (where contacts > 1) as h from {A} where contacts > 0 or layer <> 'serper' group by layer),
e as (select adapter, case when cost = 0 then 0.0 when n is null then cost / 0.5 else cost / greatest(h / n, 0.05) end::double as expected from k left join s on adapter = layer),
c as (select key, arg_max(case when attempt_id % 3 > 0 then layer end, (ts, attempt_id)) as x0, max_by(struct_pack(x := case when attempt_id % 3 > 0 then layer end), (ts, attempt_id)).x as x from {A} group by key)
select key, adapter, round(expected, 6) as expected, row_number() over (partition by key order by coalesce(adapter = x, false) desc, expected, adapter) as rank from c, e"""


def a01_a10_a14_funnel(spark, d):
    """Funnel rows per job: rows in, out and dropped of prefilter and gate."""
    pre = select.prefilter(signals(spark, d)).groupBy("job_id").agg(F.lit("prefilter").alias("step"), F.count("*").alias("n_in"), F.count_if(F.col("drop_reason").isNull()).alias("n_out"))
    gated = gate.evaluate(leads(spark, d), SPARK).groupBy("job_id").agg(F.lit("gate").alias("step"), F.count("*").alias("n_in"), F.count_if(F.col("reason").isNull()).alias("n_out"))
    return pre.unionByName(gated).withColumn("dropped", F.col("n_in") - F.col("n_out"))


def a01_pillars(spark, d):
    return leads(spark, d).groupBy(F.coalesce("pillar", F.lit("?")).alias("pillar")).agg(F.count("*").alias("n"), F.count_if(texts_filled("primary_email")).alias("with_email"))


def texts_filled(c):
    return F.coalesce(F.col(c), F.lit("")) != ""


def a15_w05_contacts(spark, d):
    """Per company the distinct contacts, and the best channel of each value: the first of those with the highest confidence."""
    rows = attempts(spark, d).where("contacts > 0").select("key", F.concat("layer", F.lit("@"), (F.col("attempt_id") % 3).cast("string")).alias("contact"), F.round(F.col("value"), 0).alias("confidence"), "attempt_id")
    best = keep.keep_first(rows, ["key", "contact"], [F.col("confidence").desc(), F.col("attempt_id")])
    return best.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("contact")), ",").alias("contacts"), F.sum("confidence").alias("confidence"), F.min("attempt_id").alias("first_seen"))


A15 = f"with b as (select key, layer || '@' || cast(attempt_id % 3 as string) as contact, round(value, 0) as confidence, attempt_id from {A} where contacts > 0), k as (select * from (select *, row_number() over (partition by key, contact order by confidence desc, attempt_id) as rn from b) where rn = 1) select key, string_agg(contact, ',' order by contact) as contacts, sum(confidence) as confidence, min(attempt_id) as first_seen from k group by key"


def a17_a18_taxonomy(spark, d):
    """Per kind the number of brands, and whether it is sparse (fewer than five below the size)."""
    return table(spark, d, "part").groupBy("p_type").agg(F.countDistinct("p_brand").alias("brands"), F.size(F.collect_set(F.when(F.col("p_size") == 50, F.col("p_brand")))).cast("long").alias("large")).withColumn("sparse", F.col("large") < 5)


A17 = "select p_type, count(distinct p_brand) as brands, count(distinct p_brand) filter (where p_size = 50) as large, count(distinct p_brand) filter (where p_size = 50) < 5 as sparse from part group by p_type"


def y02_outcome() -> F.Column:
    """Y02 for one attempt: promoted with a contact and 70 points or more, dropped at the retry limit, else tried again."""
    return F.when(F.col("has_contact") & (F.col("score") >= 70), "promoted").when(F.col("retry_count") + 1 >= 3, "dropped").otherwise("retried")


def a19_outcomes(spark, d):
    return queue(spark, d).groupBy("job_id", y02_outcome().alias("outcome")).agg(F.count("*").alias("n"))


A19 = f"select job_id, case when has_contact and score >= 70 then 'promoted' when retry_count + 1 >= 3 then 'dropped' else 'retried' end as outcome, count(*) as n from {Q} group by all"


# sinks --------------------------------------------------------------------


def k04_company_merge(spark, d):
    """The company table after a merge: rows that are there stay as they are; of new ones the first per key comes in."""
    rows = leads(spark, d).selectExpr("lead_id", f"{texts.name_key('company_name')} as name_canonical", f"{texts.actual_country(SPARK)} as country_l1", "confidence_score").where("name_canonical <> ''")
    old = keep.keep_first(rows.where("lead_id % 3 = 0"), ["name_canonical", "country_l1"], [F.col("lead_id")])
    return keep.merge_first_wins(old, rows.where("lead_id % 3 <> 0"), ["name_canonical", "country_l1"], [F.col("lead_id")])


K04 = f"select * exclude (rn) from (select *, row_number() over (partition by name_canonical, country_l1 order by lead_id % 3 <> 0, lead_id) as rn from (select lead_id, {texts.name_key('company_name')} as name_canonical, {texts.actual_country(DUCK)} as country_l1, confidence_score from {L}) where name_canonical <> '') where rn = 1"


def k06_job_mapping(spark, d):
    """Job to company with the last grade; unqualified ones are left out."""
    rows = gate.evaluate(leads(spark, d), SPARK).where("grade <> 'unqualified'").selectExpr("job_id", f"{texts.canonical_name(SPARK, 'company_name')} as company", "grade", "input_pos")
    rows = stage(rows, "graded")
    half = keep.keep_first(rows.where("input_pos % 2 = 0"), ["job_id", "company"], [F.col("input_pos").desc()])
    return keep.merge_last_wins(half, rows.where("input_pos % 2 = 1"), ["job_id", "company"], [F.col("input_pos")]).select("job_id", "company", "grade")


K06 = f"select job_id, company, grade from (select *, row_number() over (partition by job_id, company order by input_pos % 2 desc, input_pos desc) as rn from (select job_id, {texts.canonical_name(DUCK, 'company_name')} as company, grade, input_pos from ({_DUCK_GATE}) where grade <> 'unqualified')) where rn = 1"


def k07_persons(spark, d):
    """Person rows of leads with a mail, phone or profile."""
    rows = outputs.persons(leads(spark, d).withColumnRenamed("social_url", "linkedin_url"))
    return rows.select("lead_id", "email", "phone", "linkedin", F.round("confidence", 4).alias("confidence"), "tier")


K07 = f"""
with p as (select lead_id, nullif(primary_email, '') as email, nullif(primary_phone, '') as phone, coalesce(nullif(social_url, ''), nullif(source_url, '')) as linkedin, confidence_score as c from {L})
select lead_id, email, phone, linkedin, round(case when c is null then 0.6 when c > 100 then 1.0 when c < 0 then 0.0 else c / 100.0 end, 4)::double as confidence, case when linkedin like '%linkedin%' then 'primary_api' else 'fallback_search' end as tier
from p where coalesce(email, phone, linkedin) is not null"""


def k09_dead_letters(spark, d):
    """Rejected leads with reason and job, the lead itself as JSON."""
    rows = gate.evaluate(leads(spark, d), SPARK).where("reason is not null")
    return rows.select("reason", "job_id", "lead_id", F.to_json(F.struct("lead_id", "company_name")).alias("lead"))


K09 = f"select reason, job_id, lead_id, case when company_name is null then '{{\"lead_id\":' || cast(lead_id as string) || '}}' else '{{\"lead_id\":' || cast(lead_id as string) || ',\"company_name\":\"' || company_name || '\"}}' end as lead from ({_DUCK_GATE}) where reason is not null"


#: Of some keys few rows are of a step, so that they lack steps.
_STEP = "case when row_id % 50 >= key then 'other' else case event_type when 'view' then 'step1' when 'click' then 'step2' when 'signup' then 'step3' when 'purchase' then 'step5' else 'other' end end"


def k10_p41_funnel(spark, d):
    """The last value of each step of a key, steps in their order, and the stage of the furthest one."""
    rows = queue(spark, d).withColumn("step", F.expr(_STEP))
    last = keep.keep_first(rows, ["key", "step"], [F.col("created_at").desc(), F.col("row_id").desc()])
    return outputs.funnel(last, "key", "step", "retry_count").select("key", F.array_join(F.transform("steps", lambda x: F.concat_ws("=", x["step"], x["value"].cast("string"))), ",").alias("steps"), "stage")


K10 = f"""
with r as (select *, {_STEP} as step from {Q}),
l as (select * from (select *, row_number() over (partition by key, step order by created_at desc, row_id desc) as rn from r) where rn = 1)
select key, string_agg(step || '=' || cast(retry_count as string), ',' order by step = 'other', step) as steps,
  case when bool_or(step = 'step5') then 'persisting' when bool_or(step in ('step2', 'step3')) then 'parsing' when bool_or(step = 'step1') then 'fetching' end as stage from l group by key"""


_JOB = "key * 40 + row_id % 40"


def k12_notifications(spark, d):
    """A notice for each job that is done and that somebody asked for."""
    jobs = queue(spark, d).withColumn("job", F.expr(_JOB)).groupBy("job").agg(F.count_if(F.col("status") == "pending").alias("n_open"))
    named = jobs.selectExpr("job as job_id", "n_open", "case when job % 3 > 0 then concat('user', job % 7) end as requested_by", "concat('cat', job % 5) as category", "case when job % 4 > 0 then 'SG' end as country")
    return outputs.notifications(named)


K12 = f"""
select 'user' || job % 7 as recipient, 'discovery_complete' as type, 'AI找客任务已完成' as title, '「cat' || job % 5 || ' / ' || case when job % 4 > 0 then 'SG' else '' end || '」' as body, 'discovery_job' as biz_type, job as biz_id, 'unread' as status, 'in_app' as sent_via
from (select {_JOB} as job, count(*) filter (where status = 'pending') as n_open from {Q} group by all) where n_open = 0 and job % 3 > 0"""


def s06_s07_control(spark, d):
    """Job control read from JSON: key and defaults, clamped."""
    parsed = F.from_json("props", "k int, cap int")
    rows = table(spark, d, "events").select("event_id", parsed.alias("p"))
    return rows.select("event_id", F.least(F.lit(50), F.greatest(F.lit(1), F.coalesce("p.k", F.lit(10)))).alias("limit_n"), F.coalesce("p.cap", F.lit(150)).alias("cap"))


S07 = "select event_id, least(50, greatest(1, coalesce(cast(json_extract_string(props, '$.k') as int), 10))) as limit_n, coalesce(cast(json_extract_string(props, '$.cap') as int), 150) as cap from events"


def k01_u09_stages(spark, d):
    """The best stage at hand: enriched rows, else the top of the split, else intake."""
    rows = leads(spark, d)
    enriched = rows.where("confidence_tier is not null").select("lead_id", F.lit("enriched").alias("stage"))
    top = select.top_split(rows, 30).where("part <> 'overflow'").select("lead_id", F.lit("top").alias("stage"))
    best = enriched.unionByName(top.join(enriched, "lead_id", "left_anti"))
    return best.unionByName(rows.select("lead_id", F.lit("intake").alias("stage")).join(best, "lead_id", "left_anti")).groupBy("stage").agg(F.count("*").alias("n"))


def register(r: Registry) -> None:
    from .gates import _TOP_SQL

    r.add("p21_p22_p24_p25_company_rows", p21_company, f"select {', '.join(_COMPANY)} from ({company.company_rows_sql(derived.sql('leads'))})")
    r.add("p23_contact_bundle", p23_bundle, P23)
    from ..functions import predicates

    r.add("a01_pillar_counts", a01_pillars, f"select coalesce(pillar, '?') as pillar, count(*) as n, count(*) filter (where coalesce(primary_email, '') <> '') as with_email from {L} group by all")
    r.add(
        "a10_a14_funnel",
        a01_a10_a14_funnel,
        f"select job_id, 'prefilter' as step, count(*) as n_in, count(*) filter (where r is null) as n_out, count(r) as dropped from (select job_id, {predicates.drop_reason(DUCK)} as r from {S}) group by job_id union all select job_id, 'gate', count(*), count(*) filter (where reason is null), count(reason) from ({_DUCK_GATE}) group by job_id",
    )
    for name, fn, sql in [
        ("a06_layer_rates", a06_layers, A06), ("a07_a11_totals", a07_a11_totals, A07), ("a08_t07_adapters", a08_t07_adapters, A08), ("a15_w05_contacts", a15_w05_contacts, A15), ("a17_a18_taxonomy", a17_a18_taxonomy, A17), ("a19_y02_outcomes", a19_outcomes, A19),
        ("k04_k02_company_merge", k04_company_merge, K04), ("k06_job_mapping", k06_job_mapping, K06), ("k07_persons", k07_persons, K07), ("k09_dead_letters", k09_dead_letters, K09), ("k10_p41_y06_funnel", k10_p41_funnel, K10), ("k12_notifications", k12_notifications, K12),
        ("s06_s07_control", s06_s07_control, S07),
        ("u09_best_stage", k01_u09_stages, f"select stage, count(*) as n from (select case when l.confidence_tier is not null then 'enriched' when t.part <> 'overflow' then 'top' else 'intake' end as stage from {L} l left join ({_TOP_SQL}) t on l.lead_id = t.lead_id) group by stage"),
    ]:
        r.add(name, fn, sql)
