"""Filters and classifiers of signals and leads."""

from __future__ import annotations

from .. import rules
from .dialect import Spark, any_of, cascade, in_list, lit
from .emails import email_local
from .texts import blank, filled, host, low, phone_country, phone_digits, tld_country


def junk_domain(d: Spark, x: str) -> str:
    """F01."""
    h = d.sub(d.sub(d.sub(f"lower(trim({x}))", r"^https?://"), r"/.*\z"), r":\d+\z")
    by_host = any_of([in_list("jh", rules.JUNK_HOSTS), d.rx("jh", rules.JUNK_HOST_PATTERN), d.rx("jh", r"(^|\.)xn--[^.]{27,}"), "not contains(jh, '.')"])
    return f"(not {blank(x)} and ({d.rx(x, '[一-鿿぀-ゟ゠-ヿ가-힯]')} or coalesce({d.let(h, 'jh', by_host)}, false)))"


def aggregator_domain(d: Spark, x: str) -> str:
    """a directory's host or one below it."""
    return d.let(host(d, x), "ah", any_of([in_list("ah", rules.AGGREGATOR_HOSTS), *(f"ah like {lit('%.' + a)}" for a in rules.AGGREGATOR_HOSTS)]))


def junk_name(d: Spark, x: str) -> str:
    """F03."""
    n = f"trim(coalesce({x}, ''))"
    return any_of([f"length({n}) < 3", in_list(f"lower({n})", rules.JUNK_NAMES), d.rx(n, r"^\d+\z"), d.rx(n, r"^[^0-9A-Za-z_一-鿿]+\z")])


def category_words(d: Spark, x: str) -> str:
    """runs of Chinese characters and other words of 3 characters or more that are no stop words."""
    stop = "|".join(rules.CATEGORY_STOP_WORDS)
    words = d.keep(d.split(low(x), r"[\s,，、·/\\-]+"), "w", f"length(w) >= 3 and not {d.rx('w', rf'^({stop})\z')}")
    chinese = d.extract_all(low(x), "[一-鿿]{2,}")
    return d.distinct(f"{'concat' if d.name == 'spark' else 'list_concat'}({chinese}, {words})")


def seller_of_category(d: Spark, name: str, category: str) -> str:
    """the name has a maker's word and at least two (or all) of the category's words."""
    hits = d.size(d.keep("ws", "w", f"contains({low(name)}, w)"))
    enough = d.let(category_words(d, category), "ws", f"{d.size('ws')} > 0 and {hits} >= least(2, {d.size('ws')})")
    return f"({d.rx(low(name), rules.SELLER_NAME_PATTERN)} and {enough})"


def entity_type(d: Spark, supplier: bool = False, snippet: str = "snippet_text") -> str:
    """what kind of entity a lead is, over company_name, domain, primary_email, category and the snippet."""
    name, snip, h = low("company_name"), low(snippet), host(d, "domain")
    text = f"{snip} || ' ' || {name}"
    maybe = f"{d.rx(name, rules.ASSOCIATION_MAYBE_PATTERN)} and ({h} like '%.org' or {in_list(email_local(d, 'primary_email'), rules.ASSOCIATION_LOCALS)})"
    sellers = [] if supplier else [(d.rx(snip, rules.SELLER_TEXT_PATTERN), lit("aggregator")), (seller_of_category(d, "company_name", "category"), lit("aggregator"))]
    either = lambda p: any_of([d.rx(name, p), d.rx(snip, p)])
    return cascade(
        [
            (any_of([f"{h} in ({', '.join(lit(v) for v in rules.SOCIAL_HOSTS)})", d.rx(text, rules.SOCIAL_TEXT_PATTERN)]), lit("social")),
            (aggregator_domain(d, "domain"), lit("aggregator")),
            (d.rx(name, rules.ASSOCIATION_NAME_PATTERN), lit("aggregator")),
            (d.rx(snip, rules.ASSOCIATION_TEXT_PATTERN), lit("aggregator")),
            (maybe, lit("aggregator")),
            *sellers,
            (either(rules.LOGISTICS_PATTERN), lit("aggregator")),
            (either(rules.INFO_SERVICE_PATTERN), lit("aggregator")),
            (d.rx(text, rules.NEWS_TEXT_PATTERN), lit("media")),
        ],
        lit("company"),
    )


def intake_entity_type(d: Spark) -> str:
    """the coarser kind of a raw signal, over title, snippet and link."""
    return cascade(
        [
            (d.rx(low("link"), rules.INTAKE_SOCIAL_PATTERN), lit("social")),
            (d.rx(low("link"), rules.INTAKE_AGGREGATOR_PATTERN), lit("aggregator")),
            (d.rx(f"{low('title')} || ' ' || {low('snippet')}", rules.INTAKE_NEWS_PATTERN), lit("media")),
        ],
        lit("company"),
    )


def country_match(d: Spark, snippet: str = "snippet_text") -> str:
    """whether text, domain and phone speak for the lead's country: high, medium or low."""
    text, target = low(snippet), "upper(coalesce(country, ''))"
    hinted = "concat(" + ", ".join(f"case when {any_of(f'contains({text}, {lit(h)})' for h in hints)} then '{iso} ' else '' end" for iso, hints in rules.COUNTRY_HINTS.items()) + ")"
    tld, phone = tld_country(d, "domain"), phone_country(d, "primary_phone")
    one = lambda c: f"case when {c} then 1 else 0 end"
    # h: the countries whose hints occur, as 'US SG '; v: 1 for the own one, 10 for another; s: votes for and against
    own = d.let(hinted, "h", f"{one(f'contains(h, {target})')} + 10 * {one(f'trim(replace(h, {target}, {lit(chr(32))})) <> {lit(chr(32).strip())}')}")
    votes = d.let(own, "v", f"concat(cast(v % 10 + {one(f'{tld} = {target}')} + {one(f'{phone} = {target}')} as string), cast(cast(floor(v / 10) as int) + {one(f'{tld} <> {target}')} + {one(f'{phone} <> {target}')} as string))")
    return f"case when length({target}) <> 2 then 'medium' else " + d.let(votes, "s", "case when substr(s, 2, 1) >= '2' then 'low' when substr(s, 1, 1) >= '2' and substr(s, 2, 1) = '0' then 'high' else 'medium' end") + " end"


def business_blacklisted(d: Spark, x: str, category: str) -> str:
    """a kind of business that doesn't buy, unless the category's buyers are of that kind."""
    cat = low(category)
    out = []
    for group, pattern in rules.BUSINESS_GROUPS.items():
        allowed = [d.rx(cat, p) for p, groups in rules.CATEGORY_BUYERS if group in groups]
        out.append(f"({d.rx(low(x), pattern)}" + (f" and not {any_of(allowed)}" if allowed else "") + ")")
    return any_of(out)


def closed_business(d: Spark, x: str) -> str:
    """F09."""
    return d.rx(low(x), rules.CLOSED_PATTERN)


def negative_hit(d: Spark, words: list[str]) -> str:
    """a negative word in the name or the description."""
    text = f"{low('company_name')} || ' ' || {low('snippet')}"
    return any_of(f"contains({text}, {lit(w.lower())})" for w in words if w) if any(words) else "false"


def mentions_category(d: Spark, text: str, category: str) -> str:
    """the text holds the category, one of its words, a run of its Chinese characters or two of them."""
    t, c = low(text), f"trim({low(category)})"
    pair = "concat(substr(r, i, 1), substr(r, i + 1, 1))"
    runs = d.extract_all(c, "[一-鿿]{2,}")
    words = d.extract_all(c, "[a-z0-9]{2,}")
    holds = lambda arr: f"{d.size(d.keep(arr, 'w', f'contains({t}, w)'))} > 0"
    if d.name == "spark":
        pairs = f"flatten(transform({runs}, r -> transform(sequence(1, length(r) - 1), i -> {pair})))"
    else:
        pairs = f"flatten(list_transform({runs}, lambda r: list_transform(range(1, length(r)), lambda i: {pair})))"
    return f"({c} <> '' and {t} <> '' and (contains({t}, {c}) or {holds(words)} or {holds(runs)} or {holds(pairs)}))"


def families(d: Spark, x: str, part: int) -> dict[str, str]:
    """per family of trades, whether its pattern of categories (0) or of leads (1) occurs."""
    return {f: d.rx(low(x), patterns[part]) for f, patterns in rules.FAMILIES.items()}


def off_category(d: Spark, text: str, category: str) -> str:
    """the lead's trade is known, the category's too, and they have nothing in common."""
    of, have = families(d, category, 0), families(d, text, 1)
    both = any_of(f"({of[f]} and {have[f]})" for f in of)
    return f"(not {blank(category)} and not {mentions_category(d, text, category)} and {any_of(of.values())} and {any_of(have.values())} and not {both})"


def relevance(d: Spark, text: str, category: str) -> str:
    """1 mentioned, 0.6 same trade, -0.5 another trade, 0 not known."""
    of, have = families(d, category, 0), families(d, text, 1)
    both = any_of(f"({of[f]} and {have[f]})" for f in of)
    known = f"{any_of(of.values())} and {any_of(have.values())}"
    return f"case when {blank(category)} then 0.0 when {mentions_category(d, text, category)} then 1.0 when {both} then 0.6 when {known} then -0.5 else 0.0 end"


def news_domain(d: Spark, x: str) -> str:
    """F12."""
    h = d.sub(d.sub(low(x), r"^https?://"), r"[/?#:].*\z")
    return any_of([in_list(h, rules.NEWS_HOSTS), d.rx(h, rules.NEWS_HOST_PATTERN)])


def drop_reason(d: Spark, blocked_hosts: list[str] = (), supplier: bool = False) -> str:
    """why a raw signal is dropped before any costly step, or null; the first rule that holds counts."""
    title, snippet, link = f"trim({low('title')})", f"trim({low('snippet')})", low("link")
    both = f"{title} || ' ' || {snippet}"
    rule = []
    if blocked_hosts:
        rule.append((in_list(host(d, "link"), blocked_hosts), lit("policy_domain")))
    rule += [
        (f"{title} = '' and {snippet} = ''", lit("no_signal")),
        (any_of([d.rx(title, rules.LISTICLE_PATTERN), d.rx(snippet, rules.LISTICLE_PATTERN)]), lit("listicle")),
        (d.rx(both, rules.DIRECTORY_PATTERN), lit("directory")),
        (off_category(d, both, "category"), lit("off_category")),
    ]
    if not supplier:
        rule.append((any_of(f"contains({link}, {lit(h)})" for h in rules.PLATFORM_HOSTS), lit("platform")))
    rule += [
        (any_of([news_domain(d, "link"), d.rx(title, rules.NEWS_TITLE_PATTERN)]), lit("news_media")),
        (d.rx(both, rules.CLOSED_STEM_PATTERN), lit("closed_biz")),
    ]
    if not supplier:
        rule.append((f"{d.rx(both, rules.CN_HINT_PATTERN)} and {d.rx(snippet, rules.CN_ROLE_PATTERN)}", lit("cn_supplier")))
    return cascade(rule, "null")


def lead_text() -> str:
    return "(coalesce(company_name, '') || ' ' || coalesce(snippet, '') || ' ' || coalesce(title, ''))"


def hard_noise(d: Spark) -> str:
    """why a lead is noise whatever is searched, or off its category; else null."""
    text, h, e = low(lead_text()), host(d, "coalesce(nullif(domain, ''), nullif(link, ''), source_url)"), "lower(trim(coalesce(primary_email, '')))"
    return cascade(
        [
            (d.rx(text, rules.HARD_NOISE_PATTERN), lit("directory_or_interview")),
            (f"{d.rx(text, r'\brankings?\b')} and {d.rx(text, r'\b(top|best|companies\s+in)\b')}", lit("rankings_list")),
            (f"{d.rx(h, rules.JUNK_CONTENT_HOST_PATTERN)} and {d.rx(f'{text} || {h}', 'directory|rankings?|interview|amcham|smartlocal|mothership')}", lit("junk_host_content")),
            (d.rx(e, rules.NOISE_EMAIL_PATTERN), lit("placeholder_email")),
            (off_category(d, lead_text(), "category"), lit("off_category")),
        ],
        "null",
    )


def fast_title(d: Spark) -> str:
    """the title is a company's name as it stands, so no extraction is needed."""
    t = "trim(coalesce(title, ''))"
    suffix = d.rx(f"lower({t})", r"\b(inc|ltd|llc|gmbh|corp|co\.|s\.?a\.?|srl|pty|limited|group|company|industries|international)\b")
    return f"(length({t}) between 4 and 100 and not {d.rx(f'lower({t})', r'^(what|how|why|where|when|top\s+\d+|best\s+\d+|\d+\s+(best|top|ways))')} and not {junk_name(d, 'title')} and {intake_entity_type(d)} = 'company' and ({d.rx(t, r'\S\s+\S')} or {suffix}))"


def real_domain(d: Spark) -> str:
    return f"(not {blank('domain')} and not {junk_domain(d, 'domain')})"


def has_phone(d: Spark) -> str:
    return f"(length({phone_digits(d, 'primary_phone')}) >= 6)"


def has_email() -> str:
    return "contains(coalesce(primary_email, ''), '@')"


def contact_filled() -> str:
    return any_of([filled("primary_email"), filled("primary_phone")])


def seed_source(d: Spark) -> str:
    """Leads of the user's own seeds or of a verified source pass gates that others don't."""
    return any_of([d.rx("lower(pillar)", "pillar 0|seed"), filled("verified_source_id")])
