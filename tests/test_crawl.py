"""Contact pages, layers and final contacts on pages written by hand."""

from leadloom.operators import crawl

PAGES = [
    (1, "https://a.com/", '<a href="/contact#x">c</a><a href="https://a.com/kontakt">k</a><a href="https://b.com/contact">b</a><p>one@a.com</p>'),
    (2, "http://www.a.com/contact", '<a href="mailto:Two@a.com">m</a><a href="tel:+65 6123-4567">t</a><p>one@a.com</p>'),
    (3, "https://a.com/kontakt", "<p>three@a.com x@bbb.org</p>"),
    (4, "https://a.com/about", "<p>four@a.com</p>"),
    (5, "https://a.com/about", "<p>never@a.com</p>"),
    (6, "https://b.com/", "<p>nothing here</p>"),
    (7, "https://b.com/about", '<a href="https://wa.me/6591234567">w</a>'),
    (8, "https://c.com/contact", "<p>hello@gmail.com</p>"),
    (9, "https://www.instagram.com/acme", '<a href="https://acme-furniture.com">site</a><a href="https://t.me/acmebuyer">t</a><a href="mailto:buyer@acme-furniture.com">e</a><a href="https://wa.me/8613800138000">w</a>'),
    (10, "https://t.me/acmebuyer", "<p>noreply@example.com other@shop.com</p>"),
]


def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def sites(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "site string")


def test_stop_rule(spark):
    """Home 1 address, /contact 2 and a number, /kontakt 3 more: enough before /contact/ of the usual paths, which a fetched page would be."""
    p = pages(spark)
    candidates = crawl.candidate_pages(sites(spark, "a.com"), p)
    asked = [r.url for r in candidates.orderBy("pos").collect()]
    assert asked == ["https://a.com/", "https://a.com/contact", "https://a.com/kontakt", "https://a.com/contact/", "https://a.com/contact-us", "https://a.com/contact-us/", "https://a.com/contact.html"]
    got = [(r.pos, r.page_id, r.new_emails, r.new_phones, r.emails_before, r.phones_before) for r in crawl.visited_pages(candidates, crawl.evidence(p)).orderBy("pos").collect()]
    assert got == [(0, 1, 1, 0, 0, 0), (1, 2, 1, 1, 1, 0), (2, 3, 2, 0, 2, 1)]
    none = crawl.visited_pages(crawl.candidate_pages(sites(spark, "nowhere.com"), p), crawl.evidence(p))
    assert none.count() == 7 and none.where("page_id is not null").count() == 0


RECORDED = [("b.com", "llm_text", None, None), ("b.com", "vision", "email", "v@b.com"), ("b.com", "serper", "email", "s@b.com"), ("c.com", "llm_text", "email", "never@c.com"), ("d.com", "vision", "phone", "12"), ("d.com", "serper", "phone", "+65 6123 4567"), ("d.com", "serper", "email", "S@d.com"), ("e.com", "serper", None, None)]


def layers(spark, budget):
    recorded = spark.createDataFrame(RECORDED, "site string, layer string, type string, value string")
    return crawl.site_layers(sites(spark, "a.com", "b.com", "c.com", "d.com", "e.com"), pages(spark), recorded, budget)


def log_of(log):
    out = {}
    for r in log.collect():
        out.setdefault(r.site, {})[r.layer] = (r.attempted, r.contacts, r.cost, r.reason)
    return out


def test_waterfall_within_the_usual_budget(spark):
    results, log = layers(spark, 2)
    got = log_of(log)
    assert got["a.com"] == {"home": (True, 1, 0, None), "bfs": (True, 4, 0, None)}
    # b.com has a WhatsApp number alone, so dearer layers are asked: text without result, no budget for vision, the search
    assert got["b.com"] == {"home": (True, 0, 0, None), "bfs": (True, 1, 0, None), "llm_text": (True, 0, 1, None), "vision": (False, 0, 0, "cost_budget_exceeded"), "serper": (True, 1, 1, None)}
    assert got["c.com"] == {"home": (True, 0, 0, "no_page"), "bfs": (True, 1, 0, None)}
    assert got["d.com"] == {"home": (True, 0, 0, "no_page"), "bfs": (True, 0, 0, None), "vision": (False, 0, 0, "cost_budget_exceeded"), "serper": (True, 1, 1, None)}
    rates = {r.layer: (r.attempted, r.hit, r.hit_rate, r.cost) for r in crawl.layer_rates(log).collect()}
    assert rates == {"home": (5, 1, 0.2, 0), "bfs": (5, 3, 0.6, 0), "llm_text": (1, 0, 0.0, 1), "vision": (0, 0, None, 0), "serper": (3, 2, 0.667, 3)}
    assert {(r.site, r.value) for r in results.where("layer = 'serper'").collect()} == {("b.com", "s@b.com"), ("d.com", "s@d.com")}


def test_waterfall_with_vision(spark):
    _, log = layers(spark, 7)
    got = log_of(log)
    assert got["b.com"]["vision"] == (True, 1, 5, None) and "serper" not in got["b.com"]
    assert got["d.com"]["vision"] == (True, 0, 5, None) and got["d.com"]["serper"] == (True, 1, 1, None)
    assert got["e.com"]["vision"] == (False, 0, 0, "capability_missing") and got["e.com"]["serper"] == (True, 0, 1, None)


def test_final_contacts(spark):
    results, _ = layers(spark, 2)
    hosts = sites(spark, "a.com", "b.com", "c.com", "e.com").selectExpr("site", "site as host")
    got = {r.site: r for r in crawl.final_contacts(results, hosts).collect()}
    a = got["a.com"]
    assert (a.via, a.primary_email, a.primary_phone, a.primary_whatsapp, a.filled) == ("home", "one@a.com", "+6561234567", None, True)
    assert a.emails == ["one@a.com", "two@a.com", "three@a.com"] and [x.split("=")[0] for x in a.rejected] == ["x@bbb.org"]
    assert [(c.type, c.value) for c in a.channels] == [("email", "one@a.com"), ("contact_form", "https://a.com/contact"), ("contact_form", "https://a.com/kontakt"), ("email", "two@a.com"), ("phone", "+6561234567"), ("email", "three@a.com")]
    assert (got["b.com"].via, got["b.com"].primary_email, got["b.com"].primary_whatsapp) == ("serper", "s@b.com", "6591234567")
    assert (got["c.com"].via, got["c.com"].primary_email, got["c.com"].filled) == ("bfs", "hello@gmail.com", True)  # a free address is taken
    assert (got["e.com"].via, got["e.com"].filled, got["e.com"].channels) == ("none", False, [])


def test_profiles(spark):
    companies = spark.createDataFrame([(1, 0, "https://instagram.com/acme"), (1, 1, "HTTPS://instagram.com/acme"), (1, 2, "ftp://x.com"), (1, 3, "https://t.me/acmebuyer"), (2, 0, None), (3, 0, "https://t.me/gone")], "company long, pos int, url string")
    results = crawl.profile_results(companies, pages(spark))
    assert {(r.site, r.host) for r in crawl.brand_hosts(results).collect()} == {(1, "acme-furniture.com")}
    hosts = spark.createDataFrame([(1, "acme-furniture.com"), (3, "")], "site long, host string")
    got = {r.site: r for r in crawl.final_contacts(results, hosts).collect()}
    assert (got[1].primary_email, got[1].primary_whatsapp) == ("buyer@acme-furniture.com", "8613800138000")
    assert {c.type for c in got[1].channels} == {"instagram", "telegram", "website", "email", "whatsapp"}
    assert [c.value for c in got[1].channels].count("https://t.me/acmebuyer") == 1
    assert not got[3].filled and [c.type for c in got[3].channels] == ["telegram"]
