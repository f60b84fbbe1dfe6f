"""Contacts of companies from recorded pages: one hop to contact pages, profile pages, and the waterfall of dearer layers.

Pages are read where they lie: their HTML is never shuffled, only what was found on
them, one narrow row per contact or channel. Companies are worked on per site,
so many leads of one host cost one crawl, and a site has at most seven pages.

A page is known by its key: host without www., path and query, whatever the scheme; of several pages with one key the
smallest page_id counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import texts
from ..functions.dialect import SPARK, Spark, in_list
from ..functions.emails import accepted, email_reason
from ..sources.stages import stage
from .contacts import classify_link, clean_url, hrefs, page_channels, page_contacts, ranked_contacts, source_confidence
from .keep import keep_first

#: Contact pages asked per site, and contacts taken per page and type.
MOST_PAGES, MOST_CONTACTS = 6, 8
#: No further page is asked once so many addresses and numbers are known.
ENOUGH_EMAILS, ENOUGH_PHONES = 3, 1
#: What asking a layer costs, in order.
LAYER_COSTS = {"home": 0, "bfs": 0, "llm_text": 1, "vision": 5, "serper": 1}
CONTACTS = ("email", "phone", "whatsapp")


def page_key(d: Spark, x: str) -> str:
    """Host, path and query of a URL; the empty path is /."""
    rest = d.sub(d.sub(d.sub(f"trim(coalesce({x}, ''))", r"#.*\z"), "^[hH][tT][tT][pP][sS]?://"), r"^[^/?]*")
    return d.let(rest, "re", f"{texts.host(d, x)} || case when substr(re, 1, 1) = '/' then re else '/' || re end")


def found_links(d: Spark) -> str:
    """Of a page's links those on its own host whose address names contacts, absolute and without fragment, in order."""
    site = d.extract("url", r"^(https?://[^/?#]+)")
    ok = f"{d.rx('lower(h)', rules.CONTACT_WORDS_PATTERN)} and not {d.rx('lower(h)', '^(#|mailto:|tel:)')} and ({d.rx('h', '^/([^/]|' + chr(92) + 'z)')} or ({d.rx('lower(h)', '^https?://')} and {texts.host(d, 'h')} = {texts.host(d, 'url')}))"
    return d.each(d.keep(hrefs(d, "html"), "h", ok), "h", d.sub(f"case when {d.rx('h', '^/')} then {site} || h else h end", r"#.*\z"))


def usual_links(d: Spark, site: str) -> str:
    return d.array(*(f"'https://' || {site} || '{p}'" for p in rules.CONTACT_PATHS))


def website_links(d: Spark) -> str:
    """Links of a social profile that lead to another, not social, host."""
    other = f"{d.rx('lower(h)', '^https?://')} and not {in_list(texts.host(d, 'h'), rules.CHANNEL_HOSTS)}"
    return d.each(d.keep(hrefs(d, "html"), "h", other), "h", clean_url(d, "h"))


def evidence(pages: DataFrame) -> DataFrame:
    """(page_id, type, value, source, confidence, contact, place): what every page of (page_id, url, html) tells, in the order of its place.

    ``contact`` marks the addresses, numbers and WhatsApp numbers that count as contacts, up to
    eight of a type; all are channels.
    """
    d = SPARK
    own = ranked_contacts(page_contacts(pages, d), most=1 << 30)
    kind = F.when(F.col("type") == "email", 0).when(F.col("type") == "phone", 1).otherwise(2)
    by_link = F.when(F.col("type") == "whatsapp", "href").when(F.col("source").isin("mailto_link", "tel_link"), "href").otherwise("regex")
    contacts = own.select("page_id", "type", "value", by_link.alias("source"), F.expr(source_confidence("source")).alias("confidence"), (F.col("rank") <= MOST_CONTACTS).alias("contact"), F.struct(kind.alias("k"), F.lit(0.0).alias("c"), F.col("rank").cast("int").alias("p")).alias("place"))

    def others(df: DataFrame, k: int) -> DataFrame:
        return df.select("page_id", "type", "value", "source", "confidence", F.lit(False).alias("contact"), F.struct(F.lit(k).alias("k"), (-F.col("confidence")).alias("c"), F.col("pos").cast("int").alias("p")).alias("place"))

    def links(of: str, kind: str, confidence: float, k: int) -> DataFrame:
        rows = pages.selectExpr("page_id", f"posexplode(slice(array_distinct({of}), 1, 4)) as (pos, value)")
        return others(rows.selectExpr("page_id", "pos", f"'{kind}' as type", "value", "'href' as source", f"{confidence}D as confidence"), k)

    social = f"case when {in_list(texts.host(d, 'url'), rules.CHANNEL_HOSTS)} then {website_links(d)} else cast(array() as array<string>) end"
    return contacts.unionByName(others(page_channels(pages, d), 3)).unionByName(links(social, "website", 0.6, 3)).unionByName(links(found_links(d), "contact_form", 0.5, 4))


def candidate_pages(sites: DataFrame, pages: DataFrame) -> DataFrame:
    """(site, pos, url, page_id): the home page and up to six that may hold contacts, in order; page_id is null where there is no such page.

    These are the pages that the home page names, then the usual paths.
    """
    d = SPARK
    keyed = keep_first(pages.selectExpr("page_id", f"{page_key(d, 'url')} as key", f"slice(array_distinct({found_links(d)}), 1, {MOST_PAGES}) as found"), ["key"], [F.col("page_id")])
    asked = sites.select("site").distinct()
    homes = asked.join(keyed.select(F.col("key").alias("_key"), "page_id", "found"), F.concat("site", F.lit("/")) == F.col("_key"), "left")
    urls = f"slice(array_distinct(concat(coalesce(found, cast(array() as array<string>)), {usual_links(d, 'site')})), 1, {MOST_PAGES})"
    listed = homes.selectExpr("site", f"posexplode({urls}) as (pos, url)").selectExpr("site", "pos + 1 as pos", "url", f"{page_key(d, 'url')} as _key")
    subs = listed.join(keyed.select(F.col("key"), "page_id"), listed["_key"] == F.col("key"), "left").select("site", "pos", "url", "page_id")
    return homes.selectExpr("site", "0 as pos", "'https://' || site || '/' as url", "page_id").unionByName(subs)


def visited_pages(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """The candidates that are asked, with the addresses and numbers known before each: the first at which there are enough isn't, nor any behind it.

    A contact counts where it is first found; these firsts are counted per page, and the pages' counts run
    along a site's candidates, of which there are seven.
    """
    contacts = found.where("contact").select(F.col("page_id").alias("_page"), "type", F.lower("value").alias("value"))
    firsts = candidates.join(contacts, candidates["page_id"] == F.col("_page")).groupBy("site", "type", "value").agg(F.min("pos").alias("pos"))
    fresh = firsts.groupBy(F.col("site").alias("_site"), F.col("pos").alias("_pos")).agg(*(F.count_if(F.col("type") == t).alias(f"new_{t}s") for t in CONTACTS))
    rows = candidates.join(fresh, (F.col("site") == F.col("_site")) & (F.col("pos") == F.col("_pos")), "left").drop("_site", "_pos").na.fill(0, [f"new_{t}s" for t in CONTACTS])
    before = Window.partitionBy("site").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    known = rows.withColumns({f"{t}s_before": F.coalesce(F.sum(f"new_{t}s").over(before), F.lit(0)) for t in CONTACTS})
    return known.where(f"pos = 0 or not (emails_before >= {ENOUGH_EMAILS} and phones_before >= {ENOUGH_PHONES})")


def site_layers(sites: DataFrame, pages: DataFrame, recorded: DataFrame, budget: int = 2, found: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The waterfall per site over recorded layers. Gives what was found (site, layer, pos, type, value, source, confidence, contact, place) and a log (site, layer, attempted, contacts, cost, reason).

    The home page and the contact pages are always asked. recorded: (site, layer, type, value), the results of the layers
    llm_text, vision and serper, a row with a null type for a call without any. Of these
    each is asked only for the sites that have no address and no number so far: the text layer where there is a home page, vision
    within the budget and where it is recorded (else it isn't available), the search, which gives addresses alone, for all.
    """
    known = stage(evidence(pages), "evidence") if found is None else found
    candidates = stage(candidate_pages(sites, pages), "candidates")
    visits = stage(visited_pages(candidates, known), "visits")
    static = visits.select("site", "pos", F.col("page_id").alias("_page")).join(known, F.col("_page") == F.col("page_id")).select("site", F.when(F.col("pos") == 0, "home").otherwise("bfs").alias("layer"), "pos", "type", "value", "source", "confidence", "contact", "place")
    new = sum((F.col(f"new_{t}s") for t in CONTACTS), F.lit(0))
    has_page = F.max(F.when(F.col("pos") == 0, F.col("page_id").isNotNull())).alias("home")
    counted = visits.groupBy("site").agg(has_page, F.sum(F.when(F.col("pos") == 0, new).otherwise(0)).alias("n_home"), F.sum(F.when(F.col("pos") > 0, new).otherwise(0)).alias("n_bfs"), F.sum(F.col("new_emails") + F.col("new_phones")).alias("n"))
    counted = stage(counted.withColumn("spent", F.lit(0)), "counted")

    def entry(rows: DataFrame, layer: str, attempted: Column, contacts: Column, reason: Column) -> DataFrame:
        return rows.select("site", F.lit(layer).alias("layer"), attempted.alias("attempted"), contacts.cast("long").alias("contacts"), F.when(attempted, LAYER_COSTS[layer]).otherwise(0).alias("cost"), reason.alias("reason"))

    yes, none = F.lit(True), F.lit(None).cast("string")
    log = entry(counted, "home", yes, F.col("n_home"), F.when(~F.col("home"), "no_page")).unionByName(entry(counted, "bfs", yes, F.col("n_bfs"), none))
    results, left = static, counted.where("n = 0").select("site", "home", "spent")
    ok = {"email": texts.valid_email(SPARK, "value"), "phone": texts.valid_phone(SPARK, "value"), "whatsapp": texts.valid_phone(SPARK, "value")}
    clean = f"case when type = 'email' then lower(trim(value)) else {texts.clean_phone(SPARK, 'value')} end"
    for layer, cost in list(LAYER_COSTS.items())[2:]:
        cost_now = F.col("spent") + cost
        answers = recorded.where(F.col("layer") == layer).selectExpr("site as _site", "type", f"{clean} as value")
        answers = answers.where("type = 'email'") if layer == "serper" else answers
        valid = F.expr("case " + " ".join(f"when type = '{t}' then {x}" for t, x in ok.items()) + " end")
        asked = {"llm_text": F.col("home"), "vision": (cost_now <= budget) & F.col("available"), "serper": yes}[layer]
        why = {"llm_text": none, "vision": F.when(cost_now > budget, "cost_budget_exceeded").when(~F.col("available"), "capability_missing"), "serper": none}[layer]
        calls = recorded.where(F.col("layer") == layer).select(F.col("site").alias("_site")).distinct().withColumn("available", yes)
        known_calls = left.join(calls, left["site"] == calls["_site"], "left").drop("_site").withColumn("available", F.coalesce("available", F.lit(False))).withColumn("asked", asked).withColumn("why", why)
        got = known_calls.where("asked").join(answers, known_calls["site"] == F.col("_site")).where(valid).select("site", "type", "value").distinct()
        hits = got.groupBy(F.col("site").alias("_site")).agg(F.count("*").alias("contacts"), F.count_if(F.col("type") != "whatsapp").alias("reachable"))
        state = stage(known_calls.join(hits, known_calls["site"] == F.col("_site"), "left").drop("_site").na.fill(0, ["contacts", "reachable"]), layer)
        here = state if layer != "llm_text" else state.where("asked")  # without a home page the text layer isn't even skipped
        log = log.unionByName(entry(here, layer, F.col("asked"), F.col("contacts"), F.col("why")))
        place = F.struct(F.when(F.col("type") == "email", 0).when(F.col("type") == "phone", 1).otherwise(2).alias("k"), F.lit(0.0).alias("c"), F.lit(0).alias("p"))
        results = results.unionByName(got.select("site", F.lit(layer).alias("layer"), F.lit(0).alias("pos"), "type", "value", F.when(F.col("type") == "whatsapp", "href").otherwise("regex").alias("source"), F.when(F.col("type") == "whatsapp", 0.85).otherwise(0.6).alias("confidence"), yes.alias("contact"), place.alias("place")))
        left = state.where("reachable = 0").select("site", "home", F.when(F.col("asked"), F.col("spent") + cost).otherwise(F.col("spent")).alias("spent"))
    return results, log


def layer_rates(log: DataFrame) -> DataFrame:
    """Per layer how often it was asked and gave a new contact, the rate to three places (null where it wasn't asked), and its cost; profile pages aren't counted."""
    hit = F.count_if(F.col("contacts") > 0)
    asked = F.count_if("attempted")
    return log.where("layer <> 'profile'").groupBy("layer").agg(asked.alias("attempted"), hit.alias("hit"), F.round(F.try_divide(hit, asked), 3).alias("hit_rate"), F.sum("cost").alias("cost"))


def profile_visits(companies: DataFrame, pages: DataFrame, most: int = 3) -> DataFrame:
    """(company, pos, url, page_id): up to three different http(s) profile addresses of each row of (company, pos, url), with their pages."""
    urls = companies.selectExpr("company", "pos", "trim(url) as url").where(SPARK.rx("lower(url)", "^https?://"))
    one = keep_first(urls, ["company", F.lower("url")], [F.col("pos")]).withColumn("url", F.expr("substr(url, 1, 500)"))
    first = one.withColumn("_k", F.row_number().over(Window.partitionBy("company").orderBy("pos"))).where(F.col("_k") <= most).drop("_k")
    keyed = keep_first(pages.selectExpr("page_id", f"{page_key(SPARK, 'url')} as key"), ["key"], [F.col("page_id")])
    return first.withColumn("_key", F.expr(page_key(SPARK, "url"))).join(keyed, F.col("_key") == F.col("key"), "left").select("company", "pos", "url", "page_id")


def profile_results(companies: DataFrame, pages: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """What the profile pages of companies without a site tell, and the profiles themselves as channels; columns as of site_layers."""
    known = evidence(pages) if found is None else found
    visits = profile_visits(companies, pages)
    c = classify_link(SPARK, "url")
    selves = visits.where(f"{c} is not null").selectExpr("company as site", "'profile' as layer", "pos", f"substring_index({c}, '|', 1) as type", f"{clean_url(SPARK, 'url')} as value", "'href' as source", f"cast(substring_index({c}, '|', -1) as double) as confidence", "false as contact", "named_struct('k', -1, 'c', 0.0D, 'p', 0) as place")
    told = visits.select(F.col("company").alias("site"), "pos", F.col("page_id").alias("_page")).join(known, F.col("_page") == F.col("page_id")).select("site", F.lit("profile").alias("layer"), "pos", "type", "value", "source", "confidence", "contact", "place")
    return selves.unionByName(told)


def brand_hosts(results: DataFrame) -> DataFrame:
    """(site, host): the host of the first website among a company's channels."""
    sites = results.where("type = 'website'")
    return sites.groupBy("site").agg(F.min_by(F.expr(texts.host(SPARK, "value")), F.struct("pos", "place", "value")).alias("host"))


def final_contacts(results: DataFrame, hosts: DataFrame) -> DataFrame:
    """Per row of hosts (site, host) the contacts and channels that stay.

    Contacts are united over all layers and pages in their order, first come first, as are channels by type and value. Addresses that aren't a
    buyer's for the host go, as contacts and as channels. Adds via, the layer of
    the first address or number (else none), filled, the first of each type, emails, the rejected with their reasons, and channels.
    """
    order = F.struct(F.expr("case layer when 'home' then 0 when 'bfs' then 1 when 'llm_text' then 2 when 'vision' then 3 when 'serper' then 4 else 0 end").alias("l"), F.col("pos").alias("q"), F.col("place").alias("s"), F.col("value").alias("v"))
    rows = results.withColumn("at", order).join(hosts.select(F.col("site").alias("_site"), "host"), F.col("site") == F.col("_site")).drop("_site")
    one = rows.groupBy("site", "host", "type", F.lower("value").alias("key")).agg(F.min(F.struct("at", "value", "layer", "source", "confidence")).alias("first"), F.min(F.when(F.col("contact"), F.struct("at", "value", "layer"))).alias("contact"))
    mail = F.when(F.col("type") == "email", F.expr(email_reason(SPARK, "key", "host")))
    judged = one.withColumn("reason", mail).withColumn("stays", F.expr(f"reason is null or {accepted('reason')}"))
    is_channel = F.col("stays") & ((F.col("type") != "email") | F.col("contact").isNotNull())
    item = F.struct(F.col("first.at").alias("at"), "type", F.col("first.value").alias("value"), F.col("first.source").alias("source"), F.col("first.confidence").alias("confidence"))

    def first(kind: str) -> Column:
        return F.min(F.when((F.col("type") == kind) & F.col("stays"), F.col("contact")))["value"]

    reached = F.replace(F.min(F.when(F.col("type").isin("email", "phone"), F.col("contact")))["layer"], F.lit("llm_text"), F.lit("llm"))
    emails = F.when((F.col("type") == "email") & F.col("contact").isNotNull() & F.col("stays"), F.struct(F.col("contact.at").alias("at"), F.col("contact.value").alias("value")))
    refused = F.when((F.col("type") == "email") & F.col("contact").isNotNull() & ~F.col("stays"), F.concat_ws("=", "key", "reason"))
    out = judged.groupBy("site").agg(
        reached.alias("via"), *(first(t).alias(f"primary_{t}") for t in CONTACTS), F.transform(F.array_sort(F.collect_list(emails)), lambda x: x["value"]).alias("emails"), F.array_sort(F.collect_list(refused)).alias("rejected"),
        F.transform(F.array_sort(F.collect_list(F.when(is_channel, item))), lambda x: F.struct(x["type"].alias("type"), x["value"].alias("value"), x["source"].alias("source"), x["confidence"].alias("confidence"))).alias("channels"),
    )
    every = hosts.join(out.withColumnRenamed("site", "_site"), F.col("site") == F.col("_site"), "left").drop("_site")
    filled = F.greatest(*(F.col(f"primary_{t}").isNotNull() for t in CONTACTS))
    lists = {c: F.coalesce(F.col(c), F.array().cast(every.schema[c].dataType)) for c in ("emails", "rejected", "channels")}
    return every.withColumns({"via": F.coalesce("via", F.lit("none")), "filled": filled, **lists})
