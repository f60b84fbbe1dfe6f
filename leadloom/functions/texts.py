"""Normalisers of names, hosts, links, categories, phones: SQL expressions over column names."""

from __future__ import annotations

from .. import rules
from .dialect import Spark, any_of, cascade, in_list, lit, lookup


def blank(x: str) -> str:
    return f"(coalesce(trim({x}), '') = '')"


def filled(x: str) -> str:
    return f"(coalesce({x}, '') <> '')"


def low(x: str) -> str:
    return f"lower(coalesce({x}, ''))"


def squeeze(d: Spark, x: str) -> str:
    return f"trim({d.sub(x, r'\s+', ' ')})"


def host(d: Spark, x: str) -> str:
    """The host of a URL or bare text, lower case, without www. and port; empty for null."""
    return d.sub(d.sub(d.sub(f"lower(trim(coalesce({x}, '')))", r"^https?://"), r"[/?#:].*\z"), r"^www\.")


def host_of_lead(d: Spark) -> str:
    """The host of the first of domain, link, source_url that is filled."""
    return host(d, "coalesce(nullif(domain, ''), nullif(link, ''), source_url)")


def domain_column(d: Spark, x: str) -> str:
    """The host, null if there is none."""
    return f"nullif({host(d, x)}, '')"


def link_to_home(d: Spark, x: str) -> str:
    """A link to a document or into an asset folder becomes the site's origin; others stay."""
    s = f"trim({x})"
    path = d.extract(f"lower({s})", r"^https?://[^/?#]+(/[^?#]*)")
    bad = any_of([d.rx(path, r"\.(pdf|doc|docx|xls|xlsx|ppt|pptx|csv|zip|rar|gz|xml|json|txt|rss)\z"), d.rx(path, r"^/(wp-content|uploads|static|assets|cdn|files)/")])
    return f"case when {d.rx(s, r'^https?://[^/?#]+')} and {bad} then lower({d.extract(s, r'^(https?://[^/?#]+)')}) else {s} end"


def evidence_url(d: Spark, x: str) -> str:
    """An http(s) URL of at most 2000 characters, cut to 500; a bare host gets https://; else null."""
    s = f"trim({x})"
    full = f"case when {s} like 'http%' then {s} else 'https://' || {s} end"
    return f"case when {filled(s)} and length({s}) <= 2000 and {d.rx(full, r'^https?://[^\s/?#]+([/?#]|\z)')} then substr({full}, 1, 500) end"


def evidence(d: Spark) -> tuple[str, str]:
    """(url, kind) of the best place that shows a lead's source."""
    direct, maps = evidence_url(d, "coalesce(nullif(source_url, ''), link)"), evidence_url(d, "maps_url")
    social = evidence_url(d, "social_url")
    dom = domain_column(d, "domain")
    place = "'https://www.google.com/maps/place/?q=place_id:' || " + d.url_encode("trim(place_id)")
    by_name = any_of([d.rx("upper(intent_signal)", "MAP_|TRADING_COMPANY|PERSONA_VERIFIED"), d.rx("lower(pillar)", "pillar 1 lbs")]) + f" and not {blank('company_name')}"
    query = d.url_encode("trim(company_name) || case when coalesce(country, '') <> '' then ' ' || country else '' end")
    steps = [(f"{direct} is not null", direct, "source_page"), (f"{maps} is not null", maps, "maps_place"), (f"not {blank('place_id')}", place, "maps_place"), (f"{social} is not null", social, "social_profile"), (f"{dom} is not null", f"'https://' || {dom}", "company_home"), (by_name, f"'https://www.google.com/maps/search/?api=1&query=' || {query}", "maps_lookup")]
    return cascade([(c, u) for c, u, _ in steps], "null"), cascade([(c, lit(k)) for c, _, k in steps], "null")


def canonical_name(d: Spark, x: str, strict: bool = False) -> str:
    """Trimmed, lower case, one legal suffix off, white space squeezed. strict: the suffix must stand apart."""
    pattern = rules.LEGAL_SUFFIX_PATTERN.replace("]*(", "]+(", 1) if strict else rules.LEGAL_SUFFIX_PATTERN
    return squeeze(d, d.sub(f"lower(trim(coalesce({x}, '')))", pattern))


def name_key(x: str) -> str:
    """The key of the company table; it keeps legal suffixes."""
    return f"substr(lower(trim(coalesce({x}, ''))), 1, 500)"


def country_code(x: str) -> str:
    """P10: two letters in upper case, longer texts as they are."""
    return f"case when length(trim(coalesce({x}, ''))) = 2 then upper(trim({x})) else trim(coalesce({x}, '')) end"


def country_code_or_null(d: Spark, x: str) -> str:
    return f"case when {d.rx(f'trim({x})', r'^[A-Za-z]{2}\z')} then upper(trim({x})) end"


def tld_country(d: Spark, x: str) -> str:
    """Country of the host's top-level domain."""
    return lookup(d.extract(host(d, x), r"\.([a-z]+)\z"), rules.CCTLDS)


def phone_country(d: Spark, x: str, longest: bool = False) -> str:
    """Country of a +calling code. The code is taken greedily, up to three digits; longest: the longest known one counts."""
    digits = d.extract(f"trim({x})", r"^\+(\d{1,3})")
    if not longest:
        return lookup(digits, rules.CALLING_CODES)
    return "coalesce(" + ", ".join(lookup(f"substr({digits}, 1, {n})", rules.CALLING_CODES) for n in (3, 2, 1)) + ")"


def actual_country(d: Spark) -> str:
    """The country by domain, else by phone, else the one searched."""
    return f"coalesce({tld_country(d, 'domain')}, {phone_country(d, 'primary_phone')}, nullif({country_code('country')}, ''))"


def slug(d: Spark, x: str) -> str:
    """Category as a key of at most 32 letters, digits and _; 'other' and nothing are null."""
    s = d.sub(d.sub(f"lower(trim(coalesce({x}, '')))", "[^a-z0-9]+", "_"), r"^_+|_+\z")
    return f"case when {s} in ('', 'other') then null else substr({s}, 1, 32) end"


def plain_category(d: Spark, x: str) -> str:
    """A search text as a bare category: decoration, buyer words and places are taken off in this order."""
    raw = squeeze(d, d.sub(f"lower(trim(coalesce({x}, '')))", "[·•‧∙⋅．。…]+", " "))
    s = f"trim({d.sub(raw, r'\s+buyers?\s+(?:in|from|at|within|across|for)\s+.+\z')})"
    s = d.sub(s, r"\s*(买家|进口商|购买者|采购商|采购方|采购代理|批发商|经销商)\s*\z")
    s = f"trim({d.sub(s, r'\s+(buyer|importer|purchaser|wholesaler|distributor)s?\s*\z')})"
    s = f"trim({d.sub(s, rf'^(?:{rules.GEO_NAMES}|日本|japan|{rules.GEO_CODES})\s*(?:{rules.COLLOQUIAL})\s*')})"
    s = f"trim({d.sub(s, rf'^(?:{rules.COLLOQUIAL})\s*')})"
    s = f"trim({d.sub(s, rf'^(?:{rules.GEO_NAMES}|{rules.GEO_CODES})\s+(\S)', '$1')})"
    s = f"trim({d.sub(s, rf'^(?:{rules.GEO_CODES})([一-鿿])', '$1')})"
    s = f"trim({d.sub(s, r'\s+in\s+(singapore|japan|korea|china|usa|united\s+states|malaysia|thailand|vietnam|indonesia|india|taiwan)\s*\z')})"
    return f"coalesce(nullif({s}, ''), {raw})"


def business_type(x: str) -> str:
    """Role as a business type; blank is null, what is not known is 'unknown'."""
    r = f"lower(trim(coalesce({x}, '')))"
    return f"case when {r} = '' then null else {lookup(r, rules.ROLE_BUSINESS, lit('unknown'))} end"


def discovered_via(d: Spark) -> str:
    """P19."""
    return cascade([(filled("gmaps_source"), lit("maps")), *((d.rx("lower(pillar)", p), lit(v)) for p, v in rules.PILLAR_VIA), (filled("pillar"), lit("organic_search"))], "null")


def purchase_cycle(x: str) -> str:
    """P20: known words first, then week, month, quarter, year as they occur in that order."""
    s = f"lower(trim(coalesce({x}, '')))"
    has = lambda *ws: any_of(f"contains({s}, {lit(w)})" for w in ws)
    rest = cascade([(has("week"), lit("weekly")), (has("month", "fortnightly"), lit("monthly")), (has("quarter", "semi-annual", "half-year", "half year"), lit("quarterly")), (has("year", "annual"), lit("annual"))], "null")
    return f"coalesce({lookup(s, rules.CYCLES)}, {rest})"


def phone_digits(d: Spark, x: str) -> str:
    return d.sub(f"coalesce({x}, '')", r"\D")


def clean_phone(d: Spark, x: str) -> str:
    """Without blanks, brackets, dots and dashes, from the first + or digit to the last digit."""
    return d.sub(d.sub(f"coalesce({x}, '')", r"[\s\-().]"), r"^[^\d+]+|[^\d]+\z")


def valid_phone(d: Spark, x: str) -> str:
    """7 to 15 digits, not one digit over and over."""
    n = phone_digits(d, x)
    same = "|".join(rf"^{k}{{7,}}\z" for k in range(10))
    return f"(length({n}) between 7 and 15 and not {d.rx(n, same)})"


def valid_email(d: Spark, x: str) -> str:
    """F22."""
    e = low(x)
    return f"({e} <> '' and length({e}) <= 80 and not {any_of(f'contains({e}, {lit(b)})' for b in rules.EMAIL_BLOCKED)} and not {d.rx(e, r'\.(png|jpg|jpeg|gif|svg|webp|css|js|woff2?)\z')})"


def tax_id(d: Spark) -> str:
    """The tax number in snippet, title or domain, by country."""
    text = "lower(concat_ws(' ', coalesce(snippet, ''), coalesce(title, ''), coalesce(domain, '')))"
    out = []
    for country, (pattern, digits) in rules.TAX_ID_PATTERNS.items():
        found = d.extract(text, pattern)
        out.append((f"lower(country) = {lit(country)}", f"nullif({phone_digits(d, found) if digits else found}, '')"))
    return cascade(out, "null")


def usable_domain(d: Spark, x: str) -> str:
    """a host of 4 characters or more with a dot, and a letter or only digits and dots."""
    h = d.sub(d.sub(f"lower(trim(coalesce({x}, '')))", r"^https?://"), r"/.*\z")
    return f"(length({h}) >= 4 and contains({h}, '.') and ({d.rx(h, '[a-z]')} or {d.rx(h, r'^[0-9.]+\z')}))"


def signal_link(d: Spark, x: str) -> tuple[str, str]:
    """(link, source_url): a hit on an import directory is evidence, not the company's link."""
    h = host(d, x)
    hit = any_of([in_list(h, rules.SIGNAL_SOURCE_HOSTS), *(f"{h} like {lit('%.' + s)}" for s in rules.SIGNAL_SOURCE_HOSTS)])
    return f"case when {hit} then null else {x} end", f"case when {hit} then {x} end"
