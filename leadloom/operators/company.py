"""The company row: evidence, signals, commerce fields and channels of a graded lead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates, scores, texts
from ..functions.dialect import DUCK, SPARK, Spark, lit


def base_columns(d: Spark) -> dict[str, str]:
    """The scalar columns, with the lengths that the table allows."""
    url, kind = texts.evidence(d)
    score = f"least(100, greatest({scores.signal_count(d)} * 20, case when coalesce(tax_verified, false) then 40 else 0 end) + coalesce(verified_source_boost, 0))"
    return {
        "name_canonical": texts.name_key("company_name"),
        "country_l1": texts.actual_country(d),
        "city_l1": "substr(city, 1, 120)",
        "via": texts.discovered_via(d),
        "match_l1": "case when lower(industry_match) in ('high', 'medium', 'low', 'none') then lower(industry_match) end",
        "domain_l1": texts.domain_column(d, "domain"),
        "entity_l1": predicates.entity_type(d, False, "coalesce(snippet, '')"),
        "biz_type": texts.business_type("entity_role"),
        "cycle": texts.purchase_cycle("purchase_cycle"),
        "procurement_score": f"cast({score} as int)",
        "evidence_url": url,
        "evidence_kind": kind,
    }


def supplier_columns() -> dict[str, str]:
    """What the supplier direction overrides."""
    return {"biz_type_supplier": "case when biz_type is null or biz_type = 'unknown' then 'manufacturer' else biz_type end", "trade_role": lit("supplier")}


def commerce_columns(d: Spark) -> dict[str, str]:
    """P23 over the base columns: reachability, archetype, what can be sold, without debug texts as intent."""
    has = texts.filled
    where_ = f"({has('snippet')} or {has('city_l1')} or {has('place_id')})"
    points = [(has("domain_l1"), 30), (has("primary_email"), 20), (has("primary_phone"), 10), (where_, 20), ("procurement_score > 0", 10)]
    archetype = f"case when {d.rx('via', 'maps|yellowpages|places')} then 'local_entity' when procurement_score >= 40 then 'trade_intel' when {has('primary_email')} then 'contact_graph' when {has('primary_phone')} then 'local_entity' else 'contact_graph' end"
    some = d.drop_nulls(d.array(f"case when {has('primary_email')} then 'email_reveal' end", f"case when {has('primary_phone')} then 'phone_reveal' end", "case when procurement_score >= 35 then 'trade_bundle' end"))
    return {
        "contactability": "(" + " + ".join(f"case when {c} then {n} else 0 end" for c, n in points) + ")",
        "archetype": archetype,
        "skus": f"coalesce(nullif({d.join(some, ',')}, ''), 'preview_only')",
        "intent": f"case when {d.rx('lower(pillar)', r'^pillar\s*[0-9]')} then null else nullif(trim(pillar), '') end",
    }


def signal_array(d: Spark) -> str:
    """P25: the types of a lead's procurement signals in order: customs, decision maker, tax, verified source, one per item, intent."""
    s = "upper(coalesce(intent_signal, ''))"
    fixed = d.drop_nulls(
        d.array(
            f"case when {s} in ('BOL_SIGNAL', 'CUSTOMS_SIGNAL', 'IMPORT_RECORD') then 'customs_import:0.85' end",
            f"case when {s} = 'PROCUREMENT_DECISION_MAKER' then 'social:0.7' end",
            "case when coalesce(tax_verified, false) then 'customs_import:0.9' end",
            f"case when {texts.filled('verified_source_id')} then 'website_change:0.75' end",
        )
    )
    n = "coalesce(n_items, 0)"
    if d.name == "spark":
        items, concat = f"transform(case when {n} > 0 then sequence(1, {n}) else cast(array() as array<int>) end, i -> 'procurement_item')", "concat"
    else:
        items, concat = f"list_transform(range(1, {n} + 1), lambda i: 'procurement_item')", "list_concat"
    return d.join(f"{concat}({fixed}, {items})", "|")


def company_rows(leads: DataFrame) -> DataFrame:
    """One company row per lead."""
    out = leads
    for part in (base_columns(SPARK), supplier_columns(), commerce_columns(SPARK), {"signals": signal_array(SPARK)}):
        out = out.selectExpr("*", *(f"{x} as {n}" for n, x in part.items()))
    return out


def company_rows_sql(source: str) -> str:
    sql = source
    for part in (base_columns(DUCK), supplier_columns(), commerce_columns(DUCK), {"signals": signal_array(DUCK)}):
        sql = f"select *, {', '.join(f'{x} as {n}' for n, x in part.items())} from ({sql})"
    return sql


def contact_bundle() -> F.Column:
    """The contacts as one struct."""
    trim = lambda c: F.expr(f"nullif(trim({c}), '')")
    return F.struct(trim("primary_email").alias("email"), trim("primary_phone").alias("phone"), trim("domain_l1").alias("website"), F.coalesce(trim("snippet"), trim("city")).alias("address"), trim("place_id").alias("maps_place_id"))
