"""Queries of the remaining sources, sinks and guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import texts
from ..functions.dialect import DUCK, SPARK
from ..operators import contacts, keep, outputs
from ..operators.mapper import map_rows
from .common import Registry, table, view
from .joins import attempts, leads, queue

L, Q, A = view("leads"), view("queue"), view("attempts")


def k03_enqueue(spark, d):
    """Leads with a site but not both contacts, at most 150 per job, the highest confidence first."""
    rows = leads(spark, d).where(f"domain like 'http%' and not ({texts.filled('primary_email')} and {texts.filled('primary_phone')})")
    return keep.keep_top(rows, ["job_id"], [F.coalesce("confidence_score", F.lit(0)).desc(), F.col("lead_id")], 150).select("job_id", "lead_id", F.lit("pending").alias("status"), "rank")


K03 = f"select job_id, lead_id, 'pending' as status, rank from (select *, row_number() over (partition by job_id order by coalesce(confidence_score, 0) desc, lead_id) as rank from {L} where domain like 'http%' and not (coalesce(primary_email, '') <> '' and coalesce(primary_phone, '') <> '')) where rank <= 150"


def k05_edges(spark, d):
    """Edges that are there already stay, new ones come in once."""
    item = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("from_id"), (F.col("l_partkey") % 50).alias("to_id"), F.col("l_orderkey").alias("o"))
    old = item.where("o % 2 = 0").groupBy("from_id", "to_id").agg(F.min("o").alias("o"))
    return keep.merge_first_wins(old, item.where("o % 2 = 1"), ["from_id", "to_id"], [F.col("o")])


K05 = "select from_id, to_id, coalesce(min(o) filter (where o % 2 = 0), min(o)) as o from (select l_suppkey as from_id, l_partkey % 50 as to_id, l_orderkey as o from lineitem) group by from_id, to_id"


def k11_cache(spark, d):
    """The contact cache after a run: the last entry per key replaces the one there."""
    rows = attempts(spark, d).where("contacts > 0").select("key", "contacts", "attempt_id")
    old = keep.keep_first(rows.where("attempt_id % 2 = 0"), ["key"], [F.col("attempt_id").desc()])
    return keep.merge_last_wins(old, rows.where("attempt_id % 2 = 1"), ["key"], [F.col("attempt_id")])


K11 = f"select key, arg_max(contacts, (attempt_id % 2, attempt_id)) as contacts, arg_max(attempt_id, (attempt_id % 2, attempt_id)) as attempt_id from {A} where contacts > 0 group by key"


def f39_same_domain(spark, d):
    """Addresses of search texts on the lead's own host or below it, up to three."""
    text = "concat_ws(' ', coalesce(primary_email, ''), 'x@mail.firm5.com', coalesce(snippet, ''))"
    rows = leads(spark, d).selectExpr("lead_id", f"{texts.host(SPARK, 'domain')} as h", f"{contacts.emails_plain(SPARK, text)} as es")
    return rows.selectExpr("lead_id", "array_join(slice(filter(es, e -> substring_index(e, '@', -1) = h or substring_index(e, '@', -1) like '%.' || h), 1, 3), ',') as emails")


_F39_TEXT = "concat_ws(' ', coalesce(primary_email, ''), 'x@mail.firm5.com', coalesce(snippet, ''))"
F39 = f"select lead_id, array_to_string(list_filter(es, lambda e: regexp_extract(e, '@([^@]*)$', 1) = h or regexp_extract(e, '@([^@]*)$', 1) like '%.' || h)[1:3], ',') as emails from (select lead_id, {texts.host(DUCK, 'domain')} as h, {contacts.emails_plain(DUCK, _F39_TEXT)} as es from {L})"


def j25_profiles(spark, d):
    """Companies without a site: contacts of up to three pages each, the first other host counts as their own."""
    pages = table(spark, d, "pages").select("page_id", "url")
    many = pages.agg(F.max("page_id") + 1).first()[0]
    own = leads(spark, d).where("coalesce(domain, '') = ''").select("lead_id", F.explode(F.array(*((F.col("lead_id") * 3 + i) % many for i in range(3)))).alias("page_id"))
    rows = own.join(pages, "page_id").select("lead_id", "page_id", F.expr(texts.host(SPARK, "url")).alias("h"))
    return rows.groupBy("lead_id").agg(F.min_by("h", "page_id").alias("brand_host"), F.array_join(F.array_sort(F.collect_set("h")), ",").alias("hosts"))


J25 = f"with o as (select lead_id, unnest([(lead_id * 3) % m, (lead_id * 3 + 1) % m, (lead_id * 3 + 2) % m]) as page_id from {L}, (select max(page_id) + 1 as m from pages) where coalesce(domain, '') = ''), r as (select lead_id, o.page_id, {texts.host(DUCK, 'url')} as h from o join pages p on o.page_id = p.page_id) select lead_id, arg_min(h, page_id) as brand_host, string_agg(distinct h, ',' order by h) as hosts from r group by lead_id"


def x25_structs(spark, d):
    """The inference struct with guarded values and defaults, read back field by field."""
    s = F.struct(
        F.coalesce(F.expr("nullif(trim(entity_role), '')"), F.lit("Service")).alias("entity_role"),
        F.when(F.lower("target_match").isin("high", "medium", "low", "none"), F.lower("target_match")).alias("target_category_match"),
        F.slice(F.transform(F.sequence(F.lit(1), F.greatest(F.coalesce("n_items", F.lit(0)), F.lit(1))), lambda i: F.concat(F.lit("m"), i.cast("string"))), 1, 3).alias("materials"),
    )
    return leads(spark, d).select("lead_id", s.alias("ib")).select("lead_id", "ib.entity_role", "ib.target_category_match", F.array_join("ib.materials", ",").alias("materials"))


X25 = f"select lead_id, coalesce(nullif(trim(entity_role), ''), 'Service') as entity_role, lower(target_match) as target_category_match, array_to_string(list_transform(range(1, greatest(coalesce(n_items, 0), 1) + 1), lambda i: 'm' || i)[1:3], ',') as materials from {L}"


def g02_mapper(spark, d):
    """A row function that fails on some rows: the rows stay, with the error."""
    return map_rows(table(spark, d, "part").select("p_partkey", "p_size"), lambda r: 100 // int(r["p_size"] % 10), "value", "long").selectExpr("p_partkey", "value", "error is not null as failed")


G02 = "select p_partkey, case when p_size % 10 <> 0 then cast(100 // (p_size % 10) as bigint) end as value, p_size % 10 = 0 as failed from part"


def register(r: Registry) -> None:
    for name, fn, sql in [
        ("k03_f38_enqueue", k03_enqueue, K03), ("k05_edge_merge", k05_edges, K05), ("k11_cache_write", k11_cache, K11), ("f39_same_domain_emails", f39_same_domain, F39),
        ("j25_a15_profiles", j25_profiles, J25), ("x25_f35_inference_struct", x25_structs, X25), ("g02_row_mapper", g02_mapper, G02),
    ]:
        r.add(name, fn, sql)
    r.projection("p28_p44_f34_f36_guards", "leads", ["lead_id"], lambda d: {
        "supplier_link": "cast(null as string)", "supplier_source": "link",
        **outputs.evidence_fields(d, reason="snippet", extracted_industry="title", source_text="' ' || snippet || ' ' || company_name"),
        "looks_found": outputs.looks_found(d, "snippet", "case when lead_id % 3 = 0 then substr(upper(snippet), 5, 12) else cast(lead_id as string) end"),
        "profiles": d.join(outputs.profile_list(d, ["' ' || social_url || ' '", "link", "upper(social_url)", "source_url", "maps_url"]), " "),
    })
    r.projection("s01_a01_signal_source", "signals", ["signal_id"], lambda d: {"title": "nullif(trim(title), '')", "link_key": "lower(link)", "has_link": "link is not null"}, lambda d: "link is not null")

