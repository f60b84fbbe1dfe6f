"""Queries of the prefilter, the noise and top-N split, dedupe, gate and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates, scores, texts
from ..functions.dialect import DUCK, SPARK
from ..operators import gate, select
from ..plans import derived
from .common import Registry, view

BLOCKED = ["firm7.com", "firm8.com"]
TOP_N = 30

_DUCK_GATE = gate.evaluate_sql(derived.sql("leads"), DUCK)
_DUCK_SUPPLIER = gate.evaluate_sql(derived.sql("leads"), DUCK, supplier=True)


def _gate(spark, sf_dir, supplier=False):
    return gate.evaluate(derived.build(spark, sf_dir, "leads"), SPARK, supplier)


def _supplier(spark, sf_dir):
    reason, grade = gate.supplier_verdict(SPARK, ["retail"])
    return _gate(spark, sf_dir, True).selectExpr("lead_id", f"{reason} as supplier_reason", f"{grade} as supplier_grade")




def _route_spark(spark, sf_dir):
    df = _gate(spark, sf_dir).selectExpr("*", "lead_id % 10 = 3 as deferred", f"{scores.boosted_score()} as boosted")
    df = df.selectExpr("*", f"{gate.routing_drop(SPARK, 'SG', ['wholesaler'])} as drop_code")
    return df.selectExpr("lead_id", "drop_code", f"case when drop_code is null then {gate.route(SPARK, 'boosted')} end as route", f"drop_code is null and {gate.needs_review()} as review", "boosted")


_ROUTE_SQL = f"""
select lead_id, drop_code, case when drop_code is null then {gate.route(DUCK, 'boosted')} end as route, drop_code is null and {gate.needs_review()} as review, boosted
from (select *, {gate.routing_drop(DUCK, 'SG', ['wholesaler'])} as drop_code from (select *, lead_id % 10 = 3 as deferred, {scores.boosted_score()} as boosted from ({_DUCK_GATE})))
"""

_SCORED_SQL = f"select *, {predicates.hard_noise(DUCK)} as noise, {scores.pre_enrich_score(DUCK)} as score from {view('leads')}"
_TOP_SQL = f"""
with c as (select *, {select.MATCH_ORDER} as m from ({_SCORED_SQL}) where noise is null),
n as (select *, count(*) over (partition by job_id) as n, count(*) filter (where score >= 18) over (partition by job_id) as e from c),
p as (select *, e < 8 or score >= 18 as pool from n),
r as (select *, row_number() over (partition by job_id order by pool desc, score desc, m desc, lower(coalesce(company_name, '')), input_pos) as k, count(*) filter (where pool) over (partition by job_id) as s from p)
select lead_id, job_id, score, case when n <= {TOP_N} then 'kept' when pool and k <= {TOP_N} then 'top' else 'overflow' end as part,
  cast(case when n <= {TOP_N} then null when (pool and k <= {TOP_N}) or s >= {TOP_N} then k else k - s + {TOP_N} end as int) as enrich_rank,
  case when n > {TOP_N} and not (pool and k <= {TOP_N}) then cast(least(45, greatest(15, floor(score * 0.45 + 0.5))) as int) end as confidence
from r
"""

_DEDUPE_SQL = f"""
select * exclude (rn) from (
  select *, row_number() over (partition by name_canonical order by confidence_tier is not null desc, (coalesce(primary_email, '') <> '' or coalesce(primary_phone, '') <> '') desc, input_pos) as rn
  from (select *, {texts.canonical_name(DUCK, 'company_name')} as name_canonical, 'SG' as job_country from {view('leads')} where coalesce(company_name, '') <> '')) where rn = 1
"""


def slice_report(spark, sf_dir):
    """The smallest whole path: leads, one per name, through the gate, counted by grade and reason."""
    kept = gate.evaluate(select.dedupe(derived.build(spark, sf_dir, "leads"), "SG"), SPARK)
    return kept.groupBy("grade", F.coalesce("reason", F.lit("-")).alias("reason")).agg(F.count("*").alias("n"))


def register(r: Registry) -> None:
    leads = lambda s, d: derived.build(s, d, "leads")
    signals = lambda s, d: derived.build(s, d, "signals")
    r.add("slice_dedupe_gate_counts", slice_report, f"select grade, coalesce(reason, '-') as reason, count(*) as n from ({gate.evaluate_sql(_DEDUPE_SQL, DUCK)}) group by grade, coalesce(reason, '-')")
    r.add("f29_f31_gate", lambda s, d: _gate(s, d).select("lead_id", "reason", "grade", "entity", "country_level", "n_signals"), f"select lead_id, reason, grade, entity, country_level, n_signals from ({_DUCK_GATE})")
    reason, grade = gate.supplier_verdict(DUCK, ["retail"])
    r.add("f30_supplier_gate", _supplier, f"select lead_id, {reason} as supplier_reason, {grade} as supplier_grade from ({_DUCK_SUPPLIER})")
    r.add("f26_f27_f28_f32_f33_x06_routing", _route_spark, _ROUTE_SQL)
    r.add("a05_reject_shares", lambda s, d: select.reason_report(_gate(s, d), "reason"), f"select r as reason, g = 1 as total, n, round(n / max(n) over (), 4) as share from (select r, grouping(r) as g, count(*) as n from (select coalesce(reason, '-') as r from ({_DUCK_GATE})) group by rollup (r))")
    r.add(
        "a02_grade_counts",
        lambda s, d: _gate(s, d).groupBy("job_id").pivot("grade", ["premium", "qualified", "unqualified"]).count().na.fill(0).join(leads(s, d).groupBy("job_id").agg(*(F.count_if(F.lower(F.coalesce("industry_match", F.lit("unset"))) == m).alias(f"icp_{m}") for m in ("high", "medium", "low", "none", "unset"))), "job_id"),
        f"select job_id, count(*) filter (where grade = 'premium') as premium, count(*) filter (where grade = 'qualified') as qualified, count(*) filter (where grade = 'unqualified') as unqualified, " + ", ".join(f"count(*) filter (where lower(coalesce(industry_match, 'unset')) = '{m}') as icp_{m}" for m in ("high", "medium", "low", "none", "unset")) + f" from ({_DUCK_GATE}) group by job_id",
    )
    r.add("f11_prefilter", lambda s, d: select.prefilter(signals(s, d), BLOCKED).select("signal_id", "drop_reason"), f"select signal_id, {predicates.drop_reason(DUCK, BLOCKED)} as drop_reason from {view('signals')}")
    r.add("f11_prefilter_supplier", lambda s, d: select.prefilter(signals(s, d), (), True).select("signal_id", "drop_reason"), f"select signal_id, {predicates.drop_reason(DUCK, [], True)} as drop_reason from {view('signals')}")
    r.add("a03_drop_counts", lambda s, d: select.prefilter(signals(s, d), BLOCKED).groupBy("job_id", F.coalesce("drop_reason", F.lit("kept")).alias("why")).agg(F.count("*").alias("n")), f"select job_id, coalesce({predicates.drop_reason(DUCK, BLOCKED)}, 'kept') as why, count(*) as n from {view('signals')} group by all")
    r.add("f14_host_policy", lambda s, d: select.block_hosts(signals(s, d), signals(s, d).where("signal_id % 5 = 0 and link is not null").selectExpr(f"{texts.host(SPARK, 'link')} as host")).select("signal_id", "link"), f"select signal_id, link from {view('signals')} where {texts.host(DUCK, 'link')} not in (select {texts.host(DUCK, 'link')} from {view('signals')} where signal_id % 5 = 0 and link is not null)")
    r.add("f18_a04_noise_report", lambda s, d: select.reason_report(select.scored(leads(s, d)), "noise"), f"select r as reason, g = 1 as total, n, round(n / max(n) over (), 4) as share from (select r, grouping(r) as g, count(*) as n from (select coalesce(noise, '-') as r from ({_SCORED_SQL})) group by rollup (r))")
    r.add("t01_w06_top_split", lambda s, d: select.top_split(leads(s, d), TOP_N).select("lead_id", "job_id", "score", "part", "enrich_rank", "confidence"), _TOP_SQL)
    r.add("w01_dedupe", lambda s, d: select.dedupe(leads(s, d), "SG").select("lead_id", "name_canonical", "job_country", "country"), f"select lead_id, name_canonical, job_country, country from ({_DEDUPE_SQL})")
    r.add(
        "p26_x09_overflow_leads",
        lambda s, d: select.top_split(leads(s, d), TOP_N).where("part = 'overflow'").select("lead_id", F.coalesce(F.col("country"), F.lit("SG")).alias("country"), F.coalesce("confidence_score", "confidence").alias("confidence_score"), F.lit(True).alias("enrich_deferred")),
        f"select t.lead_id, coalesce(l.country, 'SG') as country, coalesce(l.confidence_score, t.confidence) as confidence_score, true as enrich_deferred from ({_TOP_SQL}) t join {view('leads')} l on t.lead_id = l.lead_id where part = 'overflow'",
    )
