"""Queries of page contacts and channels."""

from __future__ import annotations


from .. import rules
from ..functions import texts
from ..functions.dialect import DUCK, SPARK, in_list, lookup
from ..operators import contacts
from ..plans import derived
from .common import Registry, view
from .joins import leads

P, L = view("contact_pages"), view("leads")


def pages(spark, d):
    return derived.build(spark, d, "contact_pages")


def _contacts_sql(P: str = P) -> str:
    d = DUCK
    mail, tel = d.extract_all("html", r"(?i)href\s*=\s*[\x22\x27]mailto:([^\x22\x27?]+)", 1), d.extract_all("html", r"(?i)href\s*=\s*[\x22\x27]tel:([^\x22\x27]+)", 1)
    wa = d.extract_all("html", r"(?i)https?://(?:wa\.me|api\.whatsapp\.com/send)/?\?*(?:phone=)?(\+?\d[\d\s\-]{6,15})", 1)
    arms = [
        ("email", "mailto_link", mail, "lower(trim(v))", texts.valid_email), ("email", "deobfuscated", d.extract_all(contacts.deobfuscate(d, "html"), contacts.EMAIL), "v", texts.valid_email), ("email", "plain_regex", d.extract_all("html", contacts.EMAIL), "lower(v)", texts.valid_email),
        ("phone", "tel_link", tel, texts.clean_phone(d, "v"), texts.valid_phone), ("phone", "plain_regex", contacts.phones_plain(d, contacts.visible_text(d, "html")), "v", texts.valid_phone), ("whatsapp", "whatsapp_link", wa, texts.clean_phone(d, "v"), texts.valid_phone),
    ]
    union = " union all ".join(f"select page_id, '{t}' as type, value, '{s}' as source from (select page_id, {x} as value from (select page_id, unnest({arr}) as v from {P})) where {ok(d, 'value')}" for t, s, arr, x, ok in arms)
    priority = lookup("source", {k: str(v) for k, v in rules.SOURCE_PRIORITY.items()})
    return f"select page_id, type, value, source, priority from (select *, row_number() over (partition by page_id, type, value order by priority desc) as rn from (select *, cast({priority} as int) as priority from ({union}))) where rn = 1"


_CONTACTS = _contacts_sql()
_FREE = in_list("regexp_extract(value, '@?([^@]*)$', 1)", rules.FREE_EMAIL_LAST)


def _channels_sql(P: str = P, more: str = "") -> str:
    d = DUCK
    links = f"select page_id, pos, {contacts.classify_link(d, 'href')} as c, {contacts.clean_url(d, 'href')} as value, 'href' as source from (select page_id, unnest({contacts.hrefs(d, 'html')}) as href, generate_subscripts({contacts.hrefs(d, 'html')}, 1) - 1 as pos from {P})"
    handles = " union all ".join(f"select page_id, generate_subscripts(hs, 1) + 99999 as pos, '{k}|{n}' as c, unnest(hs) as value, 'text' as source from (select page_id, {contacts.text_handles(d, d.sub('html', '<[^>]+>', ' '), k)} as hs from {P})" for k, n in (("wechat", 0.55), ("line", 0.5)))
    return f"""
    with r as (select page_id, pos, string_split(c, '|')[1] as type, cast(string_split(c, '|')[2] as double) as confidence, value, source from ({links} union all {handles}) where c is not null),
    b as (select *, row_number() over (partition by page_id, type, lower(value) order by confidence desc, pos, source) as rn from r),
    k as (select *, row_number() over (partition by page_id, type order by confidence desc, pos, source, value) as rank from b where rn = 1)
    select page_id, type, value, source, confidence, rank{more} from k where rank <= 4"""


def _links_sql() -> str:
    d = DUCK
    site = d.extract("url", r"^(https?://[^/?#]+)")
    found = d.keep(contacts.hrefs(d, "html"), "h", f"{d.rx('lower(h)', rules.CONTACT_WORDS_PATTERN)} and not {d.rx('lower(h)', '^(#|mailto:|tel:)')} and ({d.rx('h', '^/')} or {texts.host(d, 'h')} = {texts.host(d, 'url')})")
    full = d.each(found, "h", f"case when {d.rx('h', '^/')} then site || h else h end")
    usual = d.array(*(f"site || '{p}'" for p in rules.CONTACT_PATHS))
    allx = f"list_concat({full}, {usual})"
    return f"with r as (select page_id, url, html, {site} as site from {P}), x as (select page_id, unnest({allx}) as link, generate_subscripts({allx}, 1) as k from r), f as (select page_id, link, min(k) as k from x group by page_id, link), n as (select page_id, link, row_number() over (partition by page_id order by k) - 1 as pos from f) select page_id, pos, link from n where pos < 6"


def f24_lists(spark, d):
    rows = leads(spark, d).selectExpr("lead_id", "domain", "array_compact(array(primary_email, 'sales@firm5.com', 'x@bbb.org', 'A@Gmail.com')) as emails")
    return rows.selectExpr("lead_id", *(f"{x} as {n}" for n, x in contacts.email_lists(SPARK).items()))


F24 = f"select lead_id, {', '.join(f'{x} as {n}' for n, x in contacts.email_lists(DUCK).items())} from (select lead_id, domain, list_filter([primary_email, 'sales@firm5.com', 'x@bbb.org', 'A@Gmail.com'], lambda q: q is not null) as emails from {L})"


def x21_channels(spark, d):
    return contacts.build_channels(leads(spark, d), SPARK).select("lead_id", "type", "value", "source", "confidence")


def _x21_sql() -> str:
    d = DUCK
    c = contacts.classify_link(d, "social_url")
    arms = f"""select lead_id, 0 as pos, 'email' as type, trim(primary_email) as value, 'l1_field' as source, 0.9 as confidence from {L} where coalesce(trim(primary_email), '') <> ''
    union all select lead_id, 1, 'phone', trim(primary_phone), 'l1_field', 0.85 from {L} where coalesce(trim(primary_phone), '') <> ''
    union all select lead_id, 2, 'whatsapp', {d.sub("coalesce(phone, '')", '[^0-9+]')}, 'l1_field', 0.85 from {L} where coalesce(phone, '') <> ''
    union all select lead_id, 3, string_split({c}, '|')[1], {contacts.clean_url(d, 'social_url')}, 'href', cast(string_split({c}, '|')[2] as double) from {L} where {c} is not null"""
    return f"select lead_id, type, substr(value, 1, 300) as value, source, cast(confidence as double) as confidence from ({arms})"


def register(r: Registry) -> None:
    r.projection("x14_x15_text_contacts", "contact_pages", ["page_id"], lambda d: {"emails": d.join(contacts.emails_plain(d, "html"), ","), "hidden": d.join(contacts.emails_plain(d, contacts.deobfuscate(d, "html")), ","), "phones": d.join(contacts.phones_plain(d, contacts.visible_text(d, "html")), ",")})
    r.projection("p42_visible_text", "contact_pages", ["page_id"], lambda d: {"n": f"cast(length({contacts.visible_text(d, 'html')}) as bigint)", "digest": f"md5({contacts.visible_text(d, 'html')})"})
    r.projection("x18_p30_x22_links", "leads", ["lead_id"], lambda d: {"by_social": contacts.classify_link(d, "coalesce(social_url, '')"), "by_link": contacts.classify_link(d, "coalesce(link, '')"), "profile": contacts.profile_url(d, "coalesce(social_url, '')")})
    r.add("x16_x17_page_contacts", lambda s, d: contacts.page_contacts(pages(s, d), SPARK).select("page_id", "type", "value", "source"), f"select page_id, type, value, source from ({_CONTACTS})")
    r.add("w08_ranked_contacts", lambda s, d: contacts.ranked_contacts(contacts.page_contacts(pages(s, d), SPARK)).selectExpr("page_id", "type", "value", "cast(rank as bigint) as rank"), f"select page_id, type, value, rank from (select *, row_number() over (partition by page_id, type order by {_FREE}, priority desc, value) as rank from ({_CONTACTS})) where rank <= 8")
    r.add("x20_x19_w04_page_channels", lambda s, d: contacts.page_channels(pages(s, d), SPARK).selectExpr("page_id", "type", "value", "source", "confidence", "cast(rank as bigint) as rank"), _channels_sql())
    r.add("j17_u05_contact_links", lambda s, d: contacts.contact_links(pages(s, d), SPARK).selectExpr("page_id", "cast(pos as bigint) as pos", "link"), _links_sql())
    r.add("f24_email_lists", f24_lists, F24)
    r.add("x21_channels", x21_channels, _x21_sql())
    from ..functions.emails import accepted, email_reason

    ok = accepted(email_reason(DUCK, "primary_email", "domain"))
    r.add("x23_final_contact", lambda s, d: contacts.final_contact(leads(s, d), SPARK), f"select *, email is not null or phone_kept is not null as contact_filled from (select lead_id, case when {ok} then primary_email end as email, nullif(trim(primary_phone), '') as phone_kept from {L})")


