"""Row-wise queries: normalisers, predicates and scores."""

from __future__ import annotations

from ..functions import emails, predicates, scores, texts
from ..functions.dialect import Spark, any_of, lit
from ..operators import gate
from .common import Registry

NEGATIVES = ["wholesaler", "retail"]


def _hosts(d: Spark) -> dict[str, str]:
    return {"host": texts.host(d, "domain"), "domain_column": texts.domain_column(d, "domain"), "lead_host": texts.host_of_lead(d), "link_home": texts.link_to_home(d, "link"), "evidence": texts.evidence_url(d, "source_url"), "usable": texts.usable_domain(d, "domain"), "registered": emails.registered_domain(d, texts.host(d, "domain"))}


def _names(d: Spark) -> dict[str, str]:
    return {"canonical": texts.canonical_name(d, "company_name"), "canonical_strict": texts.canonical_name(d, "company_name", strict=True), "name_key": texts.name_key("company_name"), "cache_key": texts.squeeze(d, "lower(trim(coalesce(company_name, '')))")}


def _countries(d: Spark) -> dict[str, str]:
    return {"code": texts.country_code("country"), "code_or_null": texts.country_code_or_null(d, "country"), "by_tld": texts.tld_country(d, "domain"), "by_phone": texts.phone_country(d, "primary_phone"), "by_phone_longest": texts.phone_country(d, "primary_phone", longest=True), "actual": texts.actual_country(d)}


def _labels(d: Spark) -> dict[str, str]:
    return {"slug": texts.slug(d, "category"), "business": texts.business_type("entity_role"), "via": texts.discovered_via(d), "cycle": texts.purchase_cycle("purchase_cycle"), "tax_id": texts.tax_id(d)}


def _phones(d: Spark) -> dict[str, str]:
    p = texts.clean_phone(d, "primary_phone")
    return {"phone": p, "phone_ok": texts.valid_phone(d, p), "email_ok": texts.valid_email(d, "primary_email"), "whatsapp": d.sub("coalesce(primary_phone, '')", r"[^\d+]")}


def _evidence(d: Spark) -> dict[str, str]:
    url, kind = texts.evidence(d)
    return {"evidence_url": url, "evidence_kind": kind}


def _email(d: Spark) -> dict[str, str]:
    reason = emails.email_reason(d, "primary_email", "domain")
    return {"email_host": emails.email_host(d, "coalesce(primary_email, '')"), "local": emails.email_local(d, "coalesce(primary_email, '')"), "reason": reason, "ok": emails.accepted(reason), "severity": emails.severity(reason)}


#: Search texts of all shapes around a category, for P16.
SEARCH_TEXTS = ["新加坡有没有{}", "SG {}", "{} buyers in Singapore", "{} 买家", "有没有{}", "Singapore {}", "日本{}", "{} importers", "{} in Vietnam", "…{}·", "US", "{}"]


def _search(d: Spark) -> dict[str, str]:
    word = "case when page_id % 2 = 0 then '白菜' else 'fresh Cabbage' end"
    parts = [s.split("{}") for s in SEARCH_TEXTS]
    raw = "case cast(page_id % 12 as int) " + " ".join(f"when {i} then {lit(p[0])}" + (f" || {word} || {lit(p[1])}" if len(p) > 1 else "") for i, p in enumerate(parts)) + " end"
    return {"raw": raw, "clean": texts.plain_category(d, f"({raw})")}


def _signal(d: Spark) -> dict[str, str]:
    link, source = texts.signal_link(d, "link")
    text = f"{texts.low('title')} || ' ' || {texts.low('snippet')}"
    years = any_of(f"contains({text}, '{2024 - k}')" for k in (3, 4, 5))
    return {
        "link_kept": link, "link_source": source, "news": predicates.news_domain(d, "link"), "suppressed": any_of(f"contains({text}, {lit(w)})" for w in ("bankrupt", "oem")),
        "in_geo": any_of([f"contains({text} || ' ' || {texts.low('link')}, 'singapore')", f"contains({texts.low('link')}, '.sg')"]), "outdated": years, "fast": predicates.fast_title(d), "kind": predicates.intake_entity_type(d),
        "places_ok": f"(place_types is null or not {d.rx('place_types', '(^|,)(cafe|food)(,|' + chr(92) + 'z)')})",
    }


def register(r: Registry) -> None:
    key = ["lead_id"]
    r.projection("p01_p06_hosts_links", "leads", key, _hosts)
    r.projection("p08_p09_x24_names", "leads", key, _names)
    r.projection("p10_p11_p45_countries", "leads", key, _countries)
    r.projection("p12_p18_p19_p20_p33_labels", "leads", key, _labels)
    r.projection("p32_f22_phones_emails", "leads", key, _phones)
    r.projection("p07_evidence", "leads", key, _evidence)
    r.projection("p16_p17_search_category", "contact_pages", ["page_id"], _search)
    r.projection("p27_f12_f13_f15_f16_f17_f25_signals", "signals", ["signal_id"], _signal)
    r.projection("f01_f02_f03_junk", "leads", key, lambda d: {"junk_domain": predicates.junk_domain(d, "domain"), "aggregator": predicates.aggregator_domain(d, "domain"), "junk_name": predicates.junk_name(d, "company_name")})
    r.projection("f04_f06_entity_type", "leads", key, lambda d: {"buyer_mode": predicates.entity_type(d, False, "coalesce(snippet, '')"), "supplier_mode": predicates.entity_type(d, True, "coalesce(snippet, '')"), "seller": predicates.seller_of_category(d, "company_name", "category"), "n_words": f"cast({d.size(predicates.category_words(d, 'category'))} as bigint)"})
    r.projection("f07_country_match", "leads", key, lambda d: {"level": predicates.country_match(d, "coalesce(snippet, '')")})
    r.projection("f08_business_blacklist", "leads", key, lambda d: {"by_category": predicates.business_blacklisted(d, "company_name", "category"), "always": predicates.business_blacklisted(d, "company_name", "''")})
    r.projection("f09_f10_closed_negative", "leads", key, lambda d: {"closed": predicates.closed_business(d, "snippet"), "negative": predicates.negative_hit(d, NEGATIVES)})
    r.projection("f19_f20_x05_relevance", "leads", key, lambda d: {"off": predicates.off_category(d, predicates.lead_text(), "category"), "mentions": predicates.mentions_category(d, predicates.lead_text(), "category"), "relevance": f"cast({predicates.relevance(d, predicates.lead_text(), 'category')} as double)"})
    r.projection("f23_p31_email_verdict", "leads", key, _email)
    r.projection("x01_x02_x03_x04_scores", "leads", key, lambda d: {"intent": scores.intent_points(), "pillar_pts": scores.pillar_points(d), "penalty": scores.junk_penalty(d), "score": scores.pre_enrich_score(d)})
    r.projection("x06_a13_a16_boosts", "leads", key, lambda d: {"signals": scores.signal_count(d), "dims": scores.boost_dimensions(), "boosted": scores.boosted_score(), "taxed": scores.tax_boost()})
    r.projection("x07_x08_x09_x10_confidence", "leads", key, lambda d: {"contact_score": scores.contact_score("phone", "case when lead_id % 2 = 0 then 'https://site.com' end", "lead_id % 3 = 0", "lead_id % 7 = 0"), "role_score": scores.role_score("entity_role"), "overflow": scores.overflow_confidence("cast(lead_id % 101 as double)"), "coefficient": f"cast({scores.coefficient('case when lead_id % 9 = 0 then null else cast(lead_id % 97 as double) / 100 end')} as double)"})
    r.projection("f21_f35_f38_guards", "leads", key, lambda d: {"usable": texts.usable_domain(d, "domain"), "match": "case when lower(industry_match) in ('high', 'medium', 'low', 'none') then lower(industry_match) end", "enqueue": f"(coalesce(domain, '') like 'http%' and not ({texts.filled('primary_email')} and {texts.filled('primary_phone')}))"})
    r.projection("g03_facts", "leads", key, lambda d: gate.facts(d))
