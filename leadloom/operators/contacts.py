"""Contacts and channels of page tables.

Everything is regular expressions and array functions on the page's HTML, so
pages are handled row by row inside the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import texts
from ..functions.dialect import Spark, any_of, cascade, in_list, lit, lookup
from .keep import keep_first

#: A sign written out, as deobfuscate() reads it; inline tags may stand inside.
OBFUSCATED = r"(?i)[\[({](\s|<[^>]*>)*a(<[^>]*>)*t(\s|<[^>]*>)*[\])}]|艾(<[^>]*>)*特"
#: A local number; the same with its first digit looked for before its boundary, which is faster in Spark's engine.
LOCAL, LOCAL_SPARK = r"\b0\d{1,4}\)?[\s\-]?\d{3,4}[\s\-]?\d{3,5}\b", r"0(?<![A-Za-z0-9_]0)\d{1,4}\)?[\s\-]?\d{3,4}[\s\-]?\d{3,5}(?![A-Za-z0-9_])"
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"


def find_emails(d: Spark, x: str) -> str:
    """Everything of the shape of an address, in order. Spark's engine begins only where a run of its characters does, or behind the match before; the other one needs no such help."""
    run = "[a-zA-Z0-9._%+" + chr(92) + "-]"
    return d.extract_all(x, EMAIL.replace(f"{run}+@", rf"(?:\G|(?<!{run})){run}++@") if d.name == "spark" else EMAIL)


def emails_plain(d: Spark, x: str) -> str:
    """X14."""
    return d.distinct(d.each(find_emails(d, x), "e", "lower(e)"))


def deobfuscate(d: Spark, x: str) -> str:
    """[at], (dot) and the like back to signs, inline tags off."""
    s = d.sub(f"lower(coalesce({x}, ''))", r"</?(?:span|wbr|em|b|strong|i)[^>]*>")
    s = d.sub(s, r"\s*[\[({]\s*(?:at|@)\s*[\])}]\s*", "@")
    s = d.sub(s, r"\s*[\[({]\s*dot\s*[\])}]\s*", ".")
    for sign, by in (("艾特", "@"), ("点", ".")):  # few pages have them
        s = d.let(s, "si", f"case when contains(si, '{sign}') then {d.sub('si', rf'\s*{sign}\s*', by)} else si end")
    return s


def visible_text(d: Spark, x: str) -> str:
    """Without scripts, styles, comments and tags; six entities decoded; white space squeezed."""
    s = d.sub(f"coalesce({x}, '')", r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    s = d.sub(s, "<[^>]+>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", None), ("&amp;", "&")):
        s = f"replace({s}, '{name}', {'chr(39)' if char is None else lit(char)})"
    return texts.squeeze(d, s)


def phones_plain(d: Spark, x: str) -> str:
    """International and local numbers, cleaned and valid."""
    both = f"{'concat' if d.name == 'spark' else 'list_concat'}({d.extract_all(x, r'\+\d[\d\s\-().]{6,18}\d')}, {d.extract_all(x, LOCAL if d.name != 'spark' else LOCAL_SPARK)})"
    return d.distinct(d.keep(d.each(both, "p", texts.clean_phone(d, "p")), "p", texts.valid_phone(d, "p")))


def hrefs(d: Spark, x: str) -> str:
    return d.extract_all(x, r"href\s*=\s*[\x22\x27]([^\x22\x27]+)[\x22\x27]", 1)


def classify_link(d: Spark, x: str) -> str:
    """X18: 'type|confidence' of a link, or null."""
    h, path = texts.host(d, x), d.extract(f"lower({x})", r"^https?://[^/?#]+/+([^/?#]*)")
    free = f"seg <> '' and not {in_list('seg', rules.RESERVED_SEGMENTS)}"
    https = d.rx(f"lower({x})", "^https?://")
    rule = [
        *((d.rx(f"lower({x})", p), lit(c)) for p, c in rules.SCHEME_CHANNELS.items()),
        (f"not {https}", "null"),
        ("ho in ('t.me', 'telegram.me')", "case when seg in ('', 's', 'joinchat') or seg like '+%' then null else 'telegram|0.85' end"),
        ("ho = 'instagram.com'", f"case when {free} then 'instagram|0.75' end"),
        ("ho = 'linkedin.com'", "case when seg in ('in', 'company', 'pub') then 'linkedin|0.85' end"),
        ("ho in ('twitter.com', 'x.com')", f"case when {free} and {d.rx('seg', '^[a-z0-9_]{1,15}' + chr(92) + 'z')} then 'twitter|0.7' end"),
        ("ho in ('facebook.com', 'fb.com', 'fb.me', 'm.facebook.com')", f"case when {free} then 'facebook|0.7' end"),
        ("ho in ('youtube.com', 'youtu.be')", "case when seg like '@%' or seg in ('channel', 'c', 'user') then 'youtube|0.7' end"),
        ("ho = 'tiktok.com'", "case when seg like '@%' then 'tiktok|0.7' end"),
    ]
    return d.let(path, "seg", d.let(h, "ho", cascade(rule, lookup("ho", rules.HOST_CHANNELS))))


def clean_url(d: Spark, x: str) -> str:
    return f"substr({d.sub(d.sub(x, r'[?#].*' + chr(92) + 'z'), '/' + chr(92) + 'z')}, 1, 300)"


def profile_url(d: Spark, x: str) -> str:
    """A social profile as https://host/path, or null."""
    h, path = texts.host(d, x), f"coalesce(nullif({d.sub(d.extract(d.sub(x, '^[hH][tT][tT][pP][sS]?://'), '^[^/?#]+(/[^?#]*)'), r'/+' + chr(92) + 'z')}, ''), '/')"
    ok = f"{in_list('ho', rules.PROFILE_HOSTS)} and not {d.rx('lower(pa)', rules.PROFILE_BANNED_PATTERN)} and {d.rx('lower(pa)', rules.PROFILE_PATH_PATTERN)}"
    return d.let(path, "pa", d.let(h, "ho", f"case when {ok} then 'https://' || ho || pa end"))


def text_handles(d: Spark, x: str, kind: str) -> str:
    """Handles named in the text."""
    pattern = {"wechat": r"(?i)(?:微信号?|wechat|微信\s*id|wx)\s*[:：]?\s*([A-Za-z][A-Za-z0-9_\-]{5,29})", "line": r"(?i)line\s*(?:id)?\s*[:：]\s*([A-Za-z0-9_.\-]{3,30})"}[kind]
    return d.extract_all(x, pattern, 1)


def page_contacts(pages: DataFrame, d: Spark) -> DataFrame:
    """X16 as rows: (page_id, type, value, source) of every address, number and WhatsApp link on a page, one per value, best source first."""
    mail = d.extract_all("html", r"(?i)href\s*=\s*[\x22\x27]mailto:([^\x22\x27?]+)", 1)
    tel = d.extract_all("html", r"(?i)href\s*=\s*[\x22\x27]tel:([^\x22\x27]+)", 1)
    wa = d.extract_all("html", r"(?i)https?://(?:wa\.me|api\.whatsapp\.com/send)/?\?*(?:phone=)?(\+?\d[\d\s\-]{6,15})", 1)
    # an address needs a sign, so a page without one isn't searched for it; texts that several patterns read are columns of their own
    base = pages.selectExpr(
        "page_id", "html", f"{visible_text(d, 'html')} as text", "case when contains(html, '@') then html else '' end as signed",
        f"case when contains(html, '@') or {d.rx('html', OBFUSCATED)} then {deobfuscate(d, 'html')} else '' end as plain",
    )
    plain = d.each(find_emails(d, "signed"), "e", "lower(e)")
    hidden = find_emails(d, "plain")
    parts = [
        ("email", "mailto_link", d.each(mail, "e", "lower(trim(e))"), texts.valid_email(d, "v")), ("email", "deobfuscated", hidden, texts.valid_email(d, "v")), ("email", "plain_regex", plain, texts.valid_email(d, "v")),
        ("phone", "tel_link", d.each(tel, "e", texts.clean_phone(d, "e")), texts.valid_phone(d, "v")), ("phone", "plain_regex", phones_plain(d, "text"), texts.valid_phone(d, "v")),
        ("whatsapp", "whatsapp_link", d.each(wa, "e", texts.clean_phone(d, "e")), texts.valid_phone(d, "v")),
    ]
    structs = [f"transform(filter({arr}, v -> {ok}), v -> named_struct('type', '{kind}', 'value', v, 'source', '{source}'))" for kind, source, arr, ok in parts]
    rows = base.selectExpr("page_id", f"inline(concat({', '.join(structs)}))").withColumn("priority", F.expr(lookup("source", {s: str(p) for s, p in rules.SOURCE_PRIORITY.items()})).cast("int"))
    return keep_first(rows, ["page_id", "type", "value"], [F.col("priority").desc()])


def source_confidence(source: str) -> str:
    """The confidence of a contact by where it was found."""
    return f"cast({lookup(source, {s: str(c) for s, c in rules.SOURCE_CONFIDENCE.items()})} as double)"


def ranked_contacts(rows: DataFrame, most: int = 8) -> DataFrame:
    """Per page and type up to eight values: own mail hosts before free ones, then by source."""
    free = F.expr(f"cast({in_list(f'substring_index(value, {lit(chr(64))}, -1)', rules.FREE_EMAIL_LAST)} as int)")
    from pyspark.sql import Window

    w = Window.partitionBy("page_id", "type").orderBy(free, F.col("priority").desc(), "value")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def page_channels(pages: DataFrame, d: Spark, per_type: int = 4) -> DataFrame:
    """Channels of a page's links and handles: distinct by type and lower-cased value, up to four per type, the surest first."""
    from pyspark.sql import Window

    links = pages.selectExpr("page_id", f"posexplode({hrefs(d, 'html')}) as (pos, href)").selectExpr("page_id", "pos", f"{classify_link(d, 'href')} as c", f"{clean_url(d, 'href')} as value", "'href' as source").where("c is not null")
    handles = None
    for kind, confidence in (("wechat", 0.55), ("line", 0.5)):
        part = pages.selectExpr("page_id", f"posexplode({text_handles(d, d.sub('html', '<[^>]+>', ' '), kind)}) as (pos, value)").selectExpr("page_id", "pos + 100000 as pos", f"'{kind}|{confidence}' as c", "value", "'text' as source")
        handles = part if handles is None else handles.unionByName(part)
    rows = links.unionByName(handles).selectExpr("page_id", "pos", "substring_index(c, '|', 1) as type", "cast(substring_index(c, '|', -1) as double) as confidence", "value", "source")
    best = keep_first(rows, ["page_id", "type", F.lower("value")], [F.col("confidence").desc(), F.col("pos"), F.col("source")])
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("page_id", "type").orderBy(F.col("confidence").desc(), "pos", "source", "value"))).where(F.col("rank") <= per_type)


def contact_links(pages: DataFrame, d: Spark, most: int = 6) -> DataFrame:
    """Up to six pages of the same host that may hold contacts: links named so, then the usual paths."""
    site = d.extract("url", r"^(https?://[^/?#]+)")
    found = d.keep(hrefs(d, "html"), "h", f"{d.rx('lower(h)', rules.CONTACT_WORDS_PATTERN)} and not {d.rx('lower(h)', '^(#|mailto:|tel:)')} and ({d.rx('h', '^/')} or {texts.host(d, 'h')} = {texts.host(d, 'url')})")
    full = d.each(found, "h", f"case when {d.rx('h', '^/')} then site || h else h end")
    usual = d.array(*(f"site || '{p}'" for p in rules.CONTACT_PATHS))
    rows = pages.selectExpr("page_id", "url", "html", f"{site} as site")
    return rows.selectExpr("page_id", f"posexplode(slice(array_distinct(concat({full}, {usual})), 1, {most})) as (pos, link)")


def email_lists(d: Spark) -> dict[str, str]:
    """of an array of addresses, the accepted, and the rejected with their reasons."""
    from ..functions.emails import accepted, email_reason

    uniq = d.distinct(d.each("emails", "e", "lower(trim(e))"))
    return {"accepted": d.join(d.keep(uniq, "em", accepted(email_reason(d, "em", "domain"))), ","), "rejected": d.join(d.each(d.keep(uniq, "em", f"not {accepted(email_reason(d, 'em', 'domain'))}"), "em", f"em || ':' || {email_reason(d, 'em', 'domain')}"), ",")}


def build_channels(leads: DataFrame, d: Spark) -> DataFrame:
    """Channels of a lead's own fields and profile; per type and value the surest, in order of appearance."""
    whatsapp = d.sub("coalesce(phone, '')", r"[^\d+]")
    parts = [
        ("'email'", "trim(primary_email)", "'l1_field'", "0.9D", texts.filled("trim(primary_email)")), ("'phone'", "trim(primary_phone)", "'l1_field'", "0.85D", texts.filled("trim(primary_phone)")),
        ("'whatsapp'", whatsapp, "'l1_field'", "0.85D", texts.filled("phone")), (f"substring_index({classify_link(d, 'social_url')}, '|', 1)", clean_url(d, "social_url"), "'href'", f"cast(substring_index({classify_link(d, 'social_url')}, '|', -1) as double)", f"{classify_link(d, 'social_url')} is not null"),
    ]
    structs = [f"case when {ok} then named_struct('type', {t}, 'value', substr({v}, 1, 300), 'source', {s}, 'confidence', {c}) end" for t, v, s, c, ok in parts]
    rows = leads.selectExpr("lead_id", f"posexplode(array_compact(array({', '.join(structs)}))) as (pos, c)").selectExpr("lead_id", "pos", "c.*")
    return keep_first(rows, ["lead_id", "type", F.lower("value")], [F.col("confidence").desc(), F.col("pos")])


def final_contact(leads: DataFrame, d: Spark) -> DataFrame:
    """The contact that is kept: the address if it is accepted, the number, and whether there is any."""
    from ..functions.emails import accepted, email_reason

    mail = f"case when {accepted(email_reason(d, 'primary_email', 'domain'))} then primary_email end"
    return leads.selectExpr("lead_id", f"{mail} as email", "nullif(trim(primary_phone), '') as phone_kept").selectExpr("*", "email is not null or phone_kept is not null as contact_filled")


__all__ = ["any_of", "page_contacts", "ranked_contacts", "page_channels", "contact_links", "email_lists", "build_channels", "final_contact", "visible_text", "phones_plain", "emails_plain", "profile_url", "classify_link"]
