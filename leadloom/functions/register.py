"""The rules as Column functions for DataFrames and as SQL functions (G03), and a table function for pages."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import emails, predicates, texts
from .dialect import SPARK

#: name -> (type, expression over the argument x)
ONE_ARGUMENT = {
    "lead_host": ("string", texts.host(SPARK, "x")), "lead_domain": ("string", texts.domain_column(SPARK, "x")), "canonical_name": ("string", texts.canonical_name(SPARK, "x")), "category_slug": ("string", texts.slug(SPARK, "x")),
    "plain_category": ("string", texts.plain_category(SPARK, "x")), "business_type": ("string", texts.business_type("x")), "purchase_cycle": ("string", texts.purchase_cycle("x")), "clean_phone": ("string", texts.clean_phone(SPARK, "x")),
    "valid_phone": ("boolean", texts.valid_phone(SPARK, "x")), "valid_email": ("boolean", texts.valid_email(SPARK, "x")), "is_junk_domain": ("boolean", predicates.junk_domain(SPARK, "x")), "is_junk_name": ("boolean", predicates.junk_name(SPARK, "x")),
    "is_aggregator_domain": ("boolean", predicates.aggregator_domain(SPARK, "x")), "is_closed_business": ("boolean", predicates.closed_business(SPARK, "x")), "email_host": ("string", emails.email_host(SPARK, "x")),
}


#: Contacts that a page links, by kind.
LINKED = {"email": r"(?i)href\s*=\s*[\x22\x27]mailto:([^\x22\x27?]+)", "phone": r"(?i)href\s*=\s*[\x22\x27]tel:([^\x22\x27]+)"}


def _table_functions() -> dict[str, tuple[str, str, str]]:
    """name -> (arguments, columns, query): one row to many, inside the engine."""
    from .. import rules
    from ..operators import contacts

    paths = ", ".join(f"'{p}'" for p in rules.CONTACT_PATHS)
    linked = " union all ".join(f"select '{kind}' as kind, explode(transform(array_distinct({SPARK.extract_all('html', pattern, 1)}), v -> lower(trim(v)))) as value" for kind, pattern in LINKED.items())
    channel = f"select {contacts.classify_link(SPARK, 'h')} as c, {contacts.clean_url(SPARK, 'h')} as v from (select explode({contacts.hrefs(SPARK, 'html')}) as h)"
    return {
        "page_contacts": ("html string", "kind string, value string", f"select kind, value from ({linked})"),
        "page_channels": ("html string", "type string, confidence double, value string", f"select substring_index(c, '|', 1), cast(substring_index(c, '|', -1) as double), v from ({channel}) where c is not null"),
        "candidate_urls": ("url string", "link string", f"select regexp_extract(url, '^(https?://[^/?#]+)', 1) || p from (select explode(array({paths})) as p) where url rlike '^https?://[^/?#]+'"),
        "signal_rows": ("intent_signal string, tax_verified boolean, reason_codes string", "type string", "select t from (select explode(array(case when upper(intent_signal) in ('BOL_SIGNAL', 'CUSTOMS_SIGNAL', 'IMPORT_RECORD') then 'customs' end, case when upper(intent_signal) = 'PROCUREMENT_DECISION_MAKER' then 'decision_maker' end, case when tax_verified then 'tax_verified' end, case when upper(reason_codes) rlike 'IMPORT|BOL|CUSTOMS' then 'import_history' end)) as t) where t is not null"),
        "category_edges": ("items string", "to_id string", f"select distinct {texts.slug(SPARK, 'x')} from (select explode(split(items, ',')) as x) where {texts.slug(SPARK, 'x')} is not null"),
    }


def column(name: str, x: str) -> Column:
    """A rule as a Column over the column or expression x."""
    import re

    return F.expr(re.sub(r"\bx\b(?!')", x, ONE_ARGUMENT[name][1]))


def register_sql(spark: SparkSession) -> None:
    """Every rule as a temporary SQL function of its name."""
    for name, (kind, text) in ONE_ARGUMENT.items():
        spark.sql(f"create or replace temporary function {name}(x string) returns {kind} return {text}")
    for name, (arguments, columns, query) in _table_functions().items():
        spark.sql(f"create or replace temporary function {name}({arguments}) returns table({columns}) return {query}")
