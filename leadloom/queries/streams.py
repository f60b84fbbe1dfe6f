"""Queries that run streaming jobs to their end, the loose JSON parser and the SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import loose_json, register as functions
from ..operators import words
from ..plans import derived
from ..streaming import jobs
from .common import Registry, table, view


def _events(spark, d):
    return jobs.source(spark, f"{d}/events.parquet")


def y01_sweep(spark, d):
    return jobs.sweep(_events(spark, d).select("user_id", "event_type", "event_id"), ["user_id", "event_type"], lambda: [F.col("event_id")])


def y02_retries(spark, d):
    rows = _events(spark, d).select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("attempt"), ((F.col("event_type") == "purchase") & (F.col("value") >= 20)).alias("ok"))
    return jobs.retries(rows)


Y02 = """
with s as (select user_id as key, event_type = 'purchase' and value >= 20 as ok, row_number() over (partition by user_id order by ts, event_id) as k from events),
a as (select key, count(*) as n, min(k) filter (where ok) as p from s group by key)
select key, case when coalesce(p, 99) <= 3 then 'promoted' when n >= 3 then 'dropped' else 'pending' end as status, cast(case when coalesce(p, 99) <= 3 then p - 1 else least(n, 3) end as int) as retries, cast(case when coalesce(p, 99) <= 3 then p else least(n, 3) end as int) as attempts from a
"""


def y03_cache(spark, d):
    rows = _events(spark, d).select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("attempt"), (F.col("event_type") == "purchase").alias("fill"))
    return jobs.ttl_cache(rows, 2)


Y03 = "select event_id as attempt, coalesce(ts - last_fill <= interval 2 day, false) as hit from (select *, last_value(case when event_type = 'purchase' then ts end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as last_fill from events) where event_type <> 'purchase'"


def y05_negatives(spark, d):
    rows = jobs.source(spark, f"{d}/part.parquet").select("p_partkey", F.col("p_name").alias("text"))
    return jobs.without_negatives(rows, lambda s: table(s, d, "region").select(F.expr("case r_regionkey when 0 then 'bolt' when 1 then 'gizmo' end").alias("word")).where("word is not null"))


def y06_latest(spark, d):
    return jobs.latest(_events(spark, d), ["user_id", "event_type"], "event_id", "value")


def _timed(spark, d):
    return _events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))


def _text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def y07_stale(spark, d):
    """All spans of activity of all users: claims released because nothing came for six hours by the time of the last event, those still open, and late rows, which add up to all events."""
    released, open_, late = jobs.stale_claims(_timed(spark, d), "user_id", "ts", "6 hours")
    rows = lambda df, kind: df.select(F.lit(kind).alias("kind"), "user_id", _text("start").alias("start"), _text("end").alias("end"), "n")
    lost = late.select("user_id", F.col("ts").alias("start"), F.expr("ts + interval 6 hours").alias("end"), F.lit(1).cast("long").alias("n"))
    return rows(released, "released").unionByName(rows(open_, "open")).unionByName(rows(lost, "late"))


_SPANS = "with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 6 hour then 0 else 1 end as brk from events), s as (select *, sum(brk) over (partition by user_id order by ts rows unbounded preceding) as sid from g), w as (select user_id, min(ts) as a, max(ts) + interval 6 hour as z, count(*) as n from s group by user_id, sid)"
Y07 = f"{_SPANS} select case when z is null then 'late' when z <= (select max(ts) from events) then 'released' else 'open' end as kind, user_id, strftime(a, '%Y-%m-%d %H:%M:%S.%f') as start, strftime(z, '%Y-%m-%d %H:%M:%S.%f') as end, n from w"


def y08_counts(spark, d):
    return jobs.counts(_timed(spark, d), "ts", "1 day", "event_type").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def y08_closed(spark, d):
    """Days that are over, those still open, and late rows, which add up to all events."""
    closed, late, open_ = jobs.closed_counts(_timed(spark, d), "ts", "1 day", "1 hour", "event_type")
    rows = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")
    lost = late.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n")).select(F.lit("late").alias("kind"), "day", "event_type", "n")
    return rows(closed, "closed").unionByName(rows(open_, "open")).unionByName(lost)


Y08_CLOSED = "select case when day + interval 25 hour <= (select max(ts) from events) then 'closed' else 'open' end as kind, strftime(day, '%Y-%m-%d') as day, event_type, n from (select date_trunc('day', ts) as day, event_type, count(*) as n from events group by all)"


def y02_tasks(spark, d):
    """Attempts as tasks of a queue with their errors: the last status of each, with the reason of those that are dead."""
    message = F.expr("case cast(event_id % 6 as int) when 0 then 'no_contact found' when 1 then 'timeout' when 2 then 'Garbage host x' when 3 then 'no usable domain' else 'error 500' end")
    rows = _events(spark, d).select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("attempt"), (F.col("event_type") == "purchase").alias("ok"), message.alias("message"))
    last, dead = jobs.task_queue(rows)
    return last.select("key", "status", "retries", "error").join(dead.select(F.col("key").alias("_key"), "reason"), F.col("key") == F.col("_key"), "left").drop("_key")


Y02_TASKS = """
with recursive a as (
  select user_id as key, row_number() over (partition by user_id order by ts, event_id) as i, event_type = 'purchase' as ok,
    case event_id % 6 when 0 then 'no_contact found' when 1 then 'timeout' when 2 then 'Garbage host x' when 3 then 'no usable domain' else 'error 500' end as m from events),
s as (
  select key, cast(0 as bigint) as i, 'pending' as status, 0 as retries, cast(null as varchar) as error from (select distinct key from a)
  union all
  select s.key, a.i, case when ok then 'done' when m in ('no_contact found', 'Garbage host x', 'no usable domain') or retries = 2 then 'failed' else 'pending' end, retries + case when ok then 0 else 1 end, case when not ok then m end
  from s join a on a.key = s.key and a.i = s.i + 1 where status = 'pending'),
f as (select key, arg_max(status, i) as status, arg_max(retries, i) as retries, max(i) as n from s group by key)
select f.key, f.status, cast(f.retries as int) as retries, s.error, case when f.status = 'failed' then case when s.error = 'no_contact found' then 'no_contact' when s.error in ('Garbage host x', 'no usable domain') then 'unusable_domain' else 'max_retries' end end as reason
from f join s on f.key = s.key and f.n = s.i"""


def f10_word_lists(spark, d):
    """Whole signal texts against the longer words of the benchmark, as a suppression list of some thousand words."""
    listed = table(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).where("length(word) >= 6")
    rows = derived.build(spark, d, "signals").select("signal_id", F.concat_ws(" ", "title", "snippet").alias("text"))
    return words.with_words(rows, "text", listed).select("signal_id", F.size("hits").cast("long").alias("n_hits"), F.array_join("hits", ",").alias("hits"))


F10 = f"""
with w as (select distinct unnest(regexp_split_to_array(lower(text), '[^a-z]+')) as word from benchmark), l as (select word from w where length(word) >= 6),
s as (select signal_id, concat_ws(' ', title, snippet) as text, lower(concat_ws(' ', title, snippet)) as low from {view('signals')})
select signal_id, count(word) as n_hits, coalesce(string_agg(word, ',' order by word), '') as hits from s left join l on contains(low, word) group by signal_id, text"""


def x13_json(spark, d):
    """Event properties broken in several ways and read back."""
    broken = F.expr("case cast(event_id % 4 as int) when 0 then props when 1 then '```json' || chr(10) || props || chr(10) || '```' when 2 then 'Sure! ' || replace(props, '}', ',}') else replace(props, '}', '') end")
    return loose_json.parse(table(spark, d, "events").select("event_id", broken.alias("raw")), "raw", "k int").select("event_id", F.col("parsed.k").alias("k"))


def g03_sql(spark, d):
    functions.register_sql(spark)
    derived.build(spark, d, "leads").createOrReplaceTempView("leadloom_leads")
    return spark.sql("select lead_id, lead_host(domain) as host, canonical_name(company_name) as name, is_junk_domain(domain) as junk, purchase_cycle(purchase_cycle) as cycle from leadloom_leads")


def _g03() -> str:
    from ..functions import predicates, texts
    from ..functions.dialect import DUCK

    return f"select lead_id, {texts.host(DUCK, 'domain')} as host, {texts.canonical_name(DUCK, 'company_name')} as name, {predicates.junk_domain(DUCK, 'domain')} as junk, {texts.purchase_cycle('purchase_cycle')} as cycle from {view('leads')}"


def g05_udtf(spark, d):
    """Addresses and numbers linked on each page, by a SQL table function."""
    functions.register_sql(spark)
    derived.build(spark, d, "contact_pages").createOrReplaceTempView("leadloom_pages")
    return spark.sql("select page_id, kind, value from leadloom_pages, lateral page_contacts(html)")


G05 = f"select page_id, 'email' as kind, lower(trim(unnest(list_distinct(regexp_extract_all(html, '(?i)href\\s*=\\s*[\\x22\\x27]mailto:([^\\x22\\x27?]+)', 1))))) as value from {view('contact_pages')} union all select page_id, 'phone', lower(trim(unnest(list_distinct(regexp_extract_all(html, '(?i)href\\s*=\\s*[\\x22\\x27]tel:([^\\x22\\x27]+)', 1))))) from {view('contact_pages')}"


def g05_rows(spark, d):
    """Channels, candidate pages, signals and edges of pages and leads by SQL table functions: one row to many."""
    functions.register_sql(spark)
    derived.build(spark, d, "contact_pages").createOrReplaceTempView("leadloom_pages")
    derived.build(spark, d, "leads").createOrReplaceTempView("leadloom_leads")
    return spark.sql("""
      select 'channel' as kind, page_id as id, c.type || ' ' || c.value as value from leadloom_pages, lateral page_channels(html) c
      union all select 'page', page_id, c.link from leadloom_pages, lateral candidate_urls(url) c
      union all select 'signal', lead_id, s.type from leadloom_leads l, lateral signal_rows(l.intent_signal, l.tax_verified, l.reason_codes) s
      union all select 'edge', lead_id, e.to_id from leadloom_leads l, lateral category_edges(l.category || ',' || coalesce(l.snippet, '')) e""")


def _g05_rows() -> str:
    from ..functions import texts
    from ..functions.dialect import DUCK
    from ..operators import contacts

    d = DUCK
    leads_, pages_ = view("leads"), view("contact_pages")
    links = f"select page_id, {contacts.classify_link(d, 'h')} as c, {contacts.clean_url(d, 'h')} as v from (select page_id, unnest({contacts.hrefs(d, 'html')}) as h from {pages_})"
    paths = "['/contact', '/contact/', '/contact-us', '/contact-us/', '/contact.html', '/about', '/about-us', '/get-in-touch', '/reach-us', '/inquiry', '/zh/contact', '/en/contact']"
    return f"""
      select 'channel' as kind, page_id as id, string_split(c, '|')[1] || ' ' || v as value from ({links}) where c is not null
      union all select 'page', page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) || p from (select page_id, url, unnest({paths}) as p from {pages_}) where regexp_matches(url, '^https?://[^/?#]+')
      union all select 'signal', lead_id, t from (select lead_id, unnest([case when upper(intent_signal) in ('BOL_SIGNAL', 'CUSTOMS_SIGNAL', 'IMPORT_RECORD') then 'customs' end, case when upper(intent_signal) = 'PROCUREMENT_DECISION_MAKER' then 'decision_maker' end, case when tax_verified then 'tax_verified' end, case when regexp_matches(upper(reason_codes), 'IMPORT|BOL|CUSTOMS') then 'import_history' end]) as t from {leads_}) where t is not null
      union all select distinct 'edge', lead_id, {texts.slug(d, 'x')} from (select lead_id, unnest(string_split(category || ',' || coalesce(snippet, ''), ',')) as x from {leads_}) where {texts.slug(d, 'x')} is not null"""


def register(r: Registry) -> None:
    r.add("y01_y04_sweep", y01_sweep, "select user_id, event_type, min(event_id) as event_id from events group by user_id, event_type")
    r.add("y02_retry_state", y02_retries, Y02)
    r.add("y03_ttl_cache", y03_cache, Y03)
    r.add("y05_live_negatives", y05_negatives, "select p_partkey, p_name as text from part where not contains(lower(p_name), 'bolt') and not contains(lower(p_name), 'gizmo')")
    r.add("y06_latest_progress", y06_latest, "select user_id, event_type, arg_max(value, event_id) as value, count(*) as n from events group by user_id, event_type")
    r.add("y07_stale_claims", y07_stale, Y07)
    r.add("y08_sweep_counts", y08_counts, "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n from events group by all")
    r.add("y08_closed_windows", y08_closed, Y08_CLOSED)
    r.add("y02_k09_task_queue", y02_tasks, Y02_TASKS)
    r.add("f10_f13_j24_word_lists", f10_word_lists, F10)
    r.add("x13_g06_loose_json", x13_json, "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events")
    r.add("g03_sql_functions", g03_sql, _g03())
    r.add("g05_page_table_function", g05_udtf, G05)
    r.add("g05_one_to_many", g05_rows, _g05_rows())
