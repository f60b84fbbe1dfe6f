"""Points and scores."""

from __future__ import annotations

from .. import rules
from .dialect import Spark, any_of, cascade, lookup
from .predicates import hard_noise, lead_text, relevance
from .texts import filled, host, low, usable_domain


def intent_points() -> str:
    """6 for a signal that isn't known, 0 for none."""
    s = "upper(coalesce(intent_signal, ''))"
    return lookup(s, rules.INTENT_POINTS, f"case when {s} = '' then 0 else 6 end")


def pillar_points(d: Spark) -> str:
    """X02."""
    return cascade([(d.rx("lower(pillar)", p), str(n)) for p, n in rules.PILLAR_POINTS], "4")


def match_points() -> str:
    return lookup("lower(coalesce(industry_match, ''))", rules.MATCH_POINTS, "5")


def junk_penalty(d: Spark, noise: str | None = None, related: str | None = None) -> str:
    """X03. noise, related: columns with F18 and X05, if they are there already."""
    text, h, e = low(lead_text()), host(d, "coalesce(nullif(domain, ''), nullif(link, ''), source_url)"), "lower(trim(coalesce(primary_email, '')))"
    path = low("coalesce(nullif(link, ''), nullif(source_url, ''), domain)")
    name = "trim(coalesce(company_name, ''))"
    noise, related = noise or hard_noise(d), related or relevance(d, lead_text(), "category")
    short = f"{d.rx(f'lower({name})', r'^(sg|us|uk|jp|cn)\b')} and length({name}) < 12 and not {d.rx(f'lower({name})', r'\b(inc|ltd|llc|corp|co)\b')}"
    no_anchor = f"not {usable_domain(d, 'domain')} and not {any_of([filled('phone'), filled('primary_phone')])} and not {filled('place_id')}"
    terms = [
        (f"{noise} is not null", "80"), (d.rx(text, rules.JUNK_TITLE_PATTERN), "35"), (d.rx(text, rules.PLATFORM_TITLE_PATTERN), "40"),
        (any_of([d.rx(path, r"\.pdf([?#]|\z)"), d.rx(text, r"\[pdf\]")]), "25"), (d.rx(h, rules.JUNK_CONTENT_HOST_PATTERN), "40"), (d.rx(e, rules.NOISE_EMAIL_PATTERN), "45"),
        (f"length({name}) between 1 and 3", "25"), (short, "15"), (no_anchor, "12"), (d.rx(text, rules.OEM_PATTERN), f"case when {related} >= 0.5 then 8 else 22 end"), (d.rx(text, rules.SHELF_PATTERN), "20"),
    ]
    by_relevance = f"case when {related} >= 1 then -15 when {related} >= 0.5 then -8 when {related} < 0 then 25 else 0 end"
    return "(" + " + ".join([*(f"case when {c} then {v} else 0 end" for c, v in terms), by_relevance]) + ")"


def pre_enrich_score(d: Spark, penalty: str | None = None) -> str:
    """How much a lead is worth the costly steps, 0 to 100."""
    terms = [
        (usable_domain(d, "domain"), 12), (any_of([filled("phone"), filled("primary_phone")]), 10), (any_of([filled("place_id"), filled("maps_url")]), 6),
        (any_of([filled("source_url"), filled("link")]), 3), (filled("social_url"), 4),
    ]
    parts = [match_points(), intent_points(), pillar_points(d), "coalesce(verified_source_boost, 0)", *(f"case when {c} then {n} else 0 end" for c, n in terms)]
    return f"greatest(0, least(100, {' + '.join(f'({p})' for p in parts)} - {penalty or junk_penalty(d)}))"


def overflow_confidence(score: str) -> str:
    """45 percent of the score, rounded half up, within 15 to 45."""
    return f"cast(least(45, greatest(15, floor({score} * 0.45 + 0.5))) as int)"


def signal_count(d: Spark) -> str:
    """Procurement signals of a lead, at most 5."""
    s = "upper(coalesce(intent_signal, ''))"
    terms = [f"{s} in ('BOL_SIGNAL', 'CUSTOMS_SIGNAL', 'IMPORT_RECORD')", f"{s} = 'PROCUREMENT_DECISION_MAKER'", "coalesce(tax_verified, false)", filled("verified_source_id"), d.rx("upper(reason_codes)", "IMPORT|BOL|CUSTOMS")]
    return "least(5, " + " + ".join(f"case when {t} then 1 else 0 end" for t in terms) + ")"


def boost_dimensions() -> str:
    """In how many of four ways a lead is backed."""
    contact = any_of([filled("primary_email"), filled("primary_phone")])
    terms = [filled("verified_source_id"), "(coalesce(tax_verified, false) or coalesce(intent_signal, '') in ('BOL_SIGNAL', 'CUSTOMS_SIGNAL'))", "coalesce(intent_signal, '') = 'PROCUREMENT_DECISION_MAKER'", f"({contact} and coalesce(confidence_tier, '') = 'High')"]
    return "(" + " + ".join(f"case when {t} then 1 else 0 end" for t in terms) + ")"


def boosted_score() -> str:
    """The confidence with what verified sources and registries add; two dimensions or more add 20."""
    total = "(coalesce(verified_source_boost, 0) + case when coalesce(tax_verified, false) then 35 else 0 end)"
    return f"case when {boost_dimensions()} >= 2 then least(100, coalesce(confidence_score, 60) + {total} + 20) when {total} > 0 then least(100, coalesce(confidence_score, 60) + {total}) else confidence_score end"


def tax_boost(boost: str = "35") -> str:
    """X11."""
    return f"least(100, coalesce(confidence_score, 60) + {boost})"


def role_score(role: str) -> str:
    """A confirmed role adds to the confidence; 50 where there is none."""
    base = "coalesce(nullif(confidence_score, 0), 50)"
    return f"case {role} when 'Manufacturer' then {base} + 20 when 'Wholesaler' then {base} + 10 when 'Retailer' then {base} + 10 else confidence_score end"


def contact_score(map_phone: str, map_site: str, operational: str, later: str) -> str:
    """The confidence after contacts were looked up; map_*: what the map filled in, later: a later layer found a contact.

    With phone and site both there after the map, nothing more is added.
    """
    got_phone, got_site = f"({filled(map_phone)} and not {filled('primary_phone')})", f"({filled(map_site)} and not {filled('domain')})"
    base = f"(coalesce(nullif(confidence_score, 0), 50) + case when {got_phone} then 20 else 0 end + case when {got_site} then 15 else 0 end + case when {operational} then 10 else 0 end)"
    phone, site = any_of([filled("primary_phone"), filled(map_phone)]), any_of([filled("domain"), filled(map_site)])
    contact = any_of([filled("primary_email"), phone])
    mapped = any_of([filled(map_phone), filled(map_site)])
    more = f"case when contains(coalesce(pillar, ''), 'LBS') then 45 else 30 end"
    score = f"case when {mapped} and {phone} and {site} then {base} when {contact} then {base} + {more} else least({base}, 85) end"
    return f"least(100, least(100, {score}) + case when {later} then 25 else 0 end)"


def coefficient(ratio: str) -> str:
    """A known ratio to two digits and 0.1 more, at most 0.95; else 0.3."""
    return f"case when {ratio} is null then 0.3 else least(0.95, floor({ratio} * 100 + 0.5) / 100 + 0.1) end"
