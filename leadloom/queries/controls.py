"""Queries of job controls and policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions.dialect import lit
from ..operators import control
from ..plans import derived
from .common import Registry, table, view
from .joins import leads

J, L = view("payloads"), view("leads")


def s07_controls(spark, d):
    """Every field of every job's control, by its type, with defaults and limits."""
    rows = control.read_controls(derived.build(spark, d, "payloads"), "payload")
    text = lambda c: F.array_join(c, "|")
    major = F.array(F.lit("m1"), F.lit("m2"))
    return rows.select(
        "job_id", text("matrix.cities").alias("cities"), text("matrix.platforms").alias("platforms"), "matrix.deep_all_cities", "matrix.max_pages", "matrix.include_social", text(control.run_cities(F.col("matrix"), major)).alias("run_cities"),
        "hint.category_key", "hint.industry_key", "hint.name_zh", text("hint.place_type_blacklist").alias("place_types"), "hint.hit", text("convo.negative_keywords").alias("negatives"), text("convo.icp_overrides").alias("overrides"),
        "incremental.enabled", "incremental.parent_job_id", text("incremental.blacklist").alias("blacklist"), "context.direction", text("context.negative_keywords").alias("context_negatives"), "context.persona", "context.agent_run_id",
    )


def _texts(x: str, trim: bool = True) -> str:
    """Texts of a JSON array as a list."""
    out = f"case when json_type({x}) = 'ARRAY' then list_transform(list_filter(cast({x} as json[]), lambda e: json_type(e) = 'VARCHAR'), lambda e: e->>'$') else [] end"
    return f"list_filter(list_transform({out}, lambda t: {'trim(t)' if trim else 't'}), lambda t: t <> '')"


def _text(x: str) -> str:
    return f"case when json_type({x}) = 'VARCHAR' then {x}->>'$' end"


_KNOWN = ", ".join(lit(x) for x in [*rules.PLATFORMS, *rules.SUPPLIER_PLATFORMS])
_DIGITS = r"regexp_extract(mp->>'$', '^\s*([+-]?\d+)', 1)"
_TRUTHY = "case json_type(hit) when 'VARCHAR' then hit->>'$' <> '' when 'BOOLEAN' then hit->>'$' = 'true' when 'NULL' then false when 'ARRAY' then true when 'OBJECT' then true else coalesce(cast(hit->>'$' as double) <> 0, false) end"
S07 = f"""
with o as (select job_id, case when json_type(j) = 'OBJECT' then j end as o from (select job_id, case when payload is not null and json_valid(payload) then cast(payload as json) end as j from {J})),
p as (
  select *, case when json_type(o->'matrix') = 'OBJECT' then o->'matrix' end as m, case when json_type(o->'industry_hint') = 'OBJECT' then o->'industry_hint' end as h, case when json_type(o->'icp_context') = 'OBJECT' then o->'icp_context' end as c,
    o->'incremental_blacklist_company_ids' as ids, coalesce(json_type(o->'incremental_mode') = 'BOOLEAN' and o->>'incremental_mode' = 'true', false) as enabled from o),
q as (select *, m->'max_pages_per_pillar' as mp, h->'hit' as hit, ({_texts("m->'cities'")})[1:10] as own, coalesce(not (json_type(m->'deep_search_all_cities') = 'BOOLEAN' and m->>'deep_search_all_cities' = 'false'), true) as deep from p)
select job_id, case when m is not null then array_to_string(own, '|') end as cities,
  case when m is not null then case when json_type(m->'platforms') = 'ARRAY' then array_to_string(list_filter(list_transform(cast(m->'platforms' as json[]), lambda e: case when json_type(e) = 'VARCHAR' then lower(e->>'$') else '' end), lambda x: x in ({_KNOWN})), '|') else '' end end as platforms,
  case when m is not null then deep end as deep_all_cities,
  case when m is not null then cast(least(5, greatest(1, case when json_type(mp) in ('BOOLEAN', 'NULL', 'ARRAY', 'OBJECT') or coalesce({_DIGITS}, '') in ('', '0') then 2 else cast({_DIGITS} as int) end)) as int) end as max_pages,
  case when m is not null then coalesce(not (json_type(m->'include_social_profiles') = 'BOOLEAN' and m->>'include_social_profiles' = 'false'), true) end as include_social,
  case when m is null then '' when len(own) > 0 then array_to_string(own, '|') when deep then 'm1|m2' else '' end as run_cities,
  case when h is not null then coalesce({_text("h->'category_key'")}, 'other') end as category_key, {_text("h->'industry_key'")} as industry_key, case when h is not null then coalesce({_text("h->'name_zh'")}, '') end as name_zh,
  case when h is not null then array_to_string(({_texts("h->'place_type_blacklist'", trim=False)})[1:20], '|') end as place_types, case when h is not null then coalesce({_TRUTHY}, false) end as hit,
  array_to_string(list_transform(({_texts("o->'negative_keywords'")})[1:16], lambda t: substr(t, 1, 24)), '|') as negatives, array_to_string(list_transform(({_texts("o->'icp_overrides'")})[1:6], lambda t: substr(t, 1, 32)), '|') as overrides,
  enabled, case when enabled then trim({_text("o->'incremental_parent_job_id'")}) end as parent_job_id,
  case when enabled and json_type(ids) = 'ARRAY' then case when len(cast(ids as json[])) > 0 then 'a|12|true' else '' end else '' end as blacklist,
  case when json_type(c->'direction') = 'VARCHAR' and c->>'direction' = 'find_suppliers' then 'find_suppliers' else 'find_buyers' end as direction, array_to_string(list_transform({_texts("c->'negative_keywords'")}, lambda t: lower(t)), '|') as context_negatives,
  trim({_text("c->'persona'")}) as persona, {_text("c->'agent_run_id'")} as agent_run_id
from q"""

#: Policies derived from the parts: scope by nation and kind of part, delta by size and price.
_POLICIES = """
select case p_partkey % 3 when 0 then null when 1 then 'sg' else 'DE' end as country, case p_partkey % 4 when 0 then null when 1 then 'Flour' else 'mattress' end as category,
  case p_partkey % 5 when 0 then 'Entity' when 1 then 'geo' when 2 then 'generic' when 3 then 'contact' else 'staleness' end as kind, (p_size - 26) / 1000.0 as delta, p_size = 50 and p_partkey % 7 = 0 as disabled,
  p_brand || '.com' as domain, lower(split_part(p_name, ' ', 1)) as keyword from {part}"""


def _policies(spark, d):
    rows = spark.sql(_POLICIES, part=table(spark, d, "part"))
    return rows.withColumn("domains", F.when(F.col("delta") < 0, F.array("domain"))).withColumn("keywords", F.array("keyword"))


def _controls(spark, d):
    jobs = leads(spark, d).select(F.col("lead_id").alias("job_id"), "country", "category")
    return control.policy_controls(jobs, _policies(spark, d))


_KINDS = ["contact", "entity", "generic", "geo", "staleness"]


def a09_controls(spark, d):
    weights = F.array_join(F.transform(F.array(*(F.lit(k) for k in _KINDS)), lambda k: F.concat_ws("=", k, F.round(F.coalesce(F.try_element_at("weights", k), F.lit(1.0)) * 10000).cast("long").cast("string"))), ",")
    return _controls(spark, d).select("job_id", weights.alias("weights"), "disable_linkedin", "disable_lookalike", "enforce_geo", "enforce_recency", F.array_join("domain_blacklist", ",").alias("domains"), F.array_join("keyword_suppress", ",").alias("keywords"))


_POL = f"pol as materialized ({_POLICIES.format(part='part')})"
_CONTROL = f"""{_POL},
sc as (select distinct country, category from {L}),
met as materialized (select sc.country, sc.category, lower(kind) as kind, cast(delta as double) as delta, disabled, domain, keyword from sc join pol on (pol.country is null or upper(pol.country) = upper(sc.country)) and (pol.category is null or lower(pol.category) = lower(sc.category))),
k as (select country, category, kind, round(sum(delta), 9) as delta, bool_or(disabled) as off from met group by all),
w as (select country, category, kind, delta, off, case when off then 0.0 else greatest(0.0, least(2.0, round(1.0 + 3 * delta, 9))) end as weight from k),
n as (
  select country, category, {', '.join(f"coalesce(max(weight) filter (where kind = '{x}'), 1.0) as w_{x}" for x in _KINDS)},
    coalesce(bool_or(off or delta <= -0.05) filter (where kind = 'entity'), false) as disable_linkedin, coalesce(bool_or(off or delta <= -0.08) filter (where kind = 'generic'), false) as disable_lookalike,
    coalesce(bool_or(off or delta <= -0.05) filter (where kind = 'geo'), false) as enforce_geo, coalesce(bool_or(off or delta <= -0.06) filter (where kind = 'staleness'), false) as enforce_recency from w group by country, category),
b as (select country, category, coalesce(string_agg(distinct domain, ',' order by domain) filter (where delta < 0), '') as domains, string_agg(distinct keyword, ',' order by keyword) as keywords from met group by all),
con as (select lead_id as job_id, l.country, l.category, n.* exclude (country, category), domains, keywords from {L} l left join n on l.country is not distinct from n.country and l.category is not distinct from n.category left join b on l.country is not distinct from b.country and l.category is not distinct from b.category)"""
_SHOWN = " || ',' || ".join(f"'{x}=' || cast(round(coalesce(w_{x}, 1.0) * 10000) as bigint)" for x in _KINDS)
A09 = f"with {_CONTROL} select job_id, {_SHOWN} as weights, coalesce(disable_linkedin, false) as disable_linkedin, coalesce(disable_lookalike, false) as disable_lookalike, coalesce(enforce_geo, false) as enforce_geo, coalesce(enforce_recency, false) as enforce_recency, coalesce(domains, '') as domains, coalesce(keywords, '') as keywords from con"

_DIRECTION = "case when job_id % 5 = 0 then 'find_suppliers' else 'find_buyers' end"


def f37_pillars(spark, d):
    """Pillars by how many jobs collect them."""
    listed = F.when(F.expr("job_id % 3 = 0"), F.array(F.lit("maps"), F.lit("x_public")))
    jobs = _controls(spark, d).withColumns({"direction": F.expr(_DIRECTION), "platforms": listed})
    return control.enabled_pillars(jobs).groupBy("pillar").agg(F.count("*").alias("n"), F.min("job_id").alias("first_job"))


def _f37() -> str:
    def on(p: str) -> str:
        parts = [f"coalesce(w_{kind}, 1.0) >= 0.35" for kind, names in rules.PILLARS_BY_WEIGHT.items() if p in names]
        parts += ["not coalesce(disable_linkedin, false)"] * (p == "p11_linkedin_decision") + ["not coalesce(disable_lookalike, false)"] * (p == "p9_lookalike")
        parts += [f"(job_id % 3 <> 0 or {str(platform in ('maps', 'x_public')).lower()})" for platform, names in rules.PILLARS_BY_PLATFORM.items() if p in names]
        parts += ["job_id % 5 <> 0"] * (p not in rules.SHARED_PILLARS)
        return " and ".join(parts) or "true"

    arms = [f"select '{p}' as pillar, job_id from con where {on(p)}" for p in rules.BUYER_PILLARS] + [f"select '{p}', job_id from con where job_id % 5 = 0" for p in rules.SUPPLIER_PILLARS]
    return f"with {_CONTROL} select pillar, count(*) as n, min(job_id) as first_job from ({' union all '.join(arms)}) group by pillar"


def register(r: Registry) -> None:
    r.add("s07_p43_job_controls", s07_controls, S07)
    r.add("a09_a12_policy_controls", a09_controls, A09)
    r.add("f37_u08_pillars", f37_pillars, _f37())
