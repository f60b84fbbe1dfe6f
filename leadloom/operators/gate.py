"""The quality gate: verdict, grade and routing of leads."""

from __future__ import annotations

import re

from ..functions import emails, predicates, scores, texts
from ..functions.dialect import Spark, any_of, cascade, in_list, lit


def snippet_text() -> str:
    """The texts of a lead that are read as its description."""
    return "coalesce(snippet, '')"


def facts(d: Spark, supplier: bool = False) -> dict[str, str]:
    """What the gate needs to know of a lead, one column each, so that no expression is worked out twice."""
    return {
        "is_junk_name": predicates.junk_name(d, "company_name"),
        "is_blacklisted": predicates.business_blacklisted(d, "company_name", "category"),
        "entity": predicates.entity_type(d, supplier, snippet_text()),
        "is_junk_domain": predicates.junk_domain(d, "domain"),
        "is_aggregator": predicates.aggregator_domain(d, "domain"),
        "is_closed": predicates.closed_business(d, snippet_text()),
        "country_level": predicates.country_match(d, snippet_text()),
        "email_reason": emails.email_reason(d, "primary_email", "domain"),
        "phone_ok": predicates.has_phone(d),
        "n_signals": scores.signal_count(d),
    }


def _contacts() -> tuple[str, str, str]:
    domain = "(coalesce(trim(domain), '') <> '' and not is_junk_domain)"
    email = f"({predicates.has_email()} and {emails.accepted('email_reason')})"
    return domain, email, any_of([domain, email, "phone_ok"])


def gate_reason() -> str:
    """F29, steps A to H over the facts: the reason of a rejection, or null."""
    domain, _, contact = _contacts()
    by_email = cascade([(in_list("email_reason", ["placeholder_email", "aggregator_email"]), "email_reason"), ("email_reason = 'brand_mismatch'", lit("email_brand_mismatch"))], lit("no_contact"))
    bad_email = f"{predicates.has_email()} and not {emails.accepted('email_reason')} and not {domain} and not phone_ok"
    return cascade(
        [
            ("coalesce(company_name, '') = ''", lit("no_company_name")),
            ("is_junk_name", lit("junk_name")),
            ("is_blacklisted", lit("biz_type_blacklisted")),
            ("entity <> 'company'", "'entity_type_' || entity"),
            ("is_junk_domain", lit("junk_domain")),
            ("is_closed", lit("closed_business")),
            ("country_level = 'low'", lit("country_mismatch")),
            (bad_email, by_email),
            (f"not {contact}", lit("no_contact")),
            ("lower(coalesce(confidence_tier, '')) = 'low'", lit("confidence_low")),
            ("coalesce(confidence_tier, '') <> '' and n_items = 0", lit("no_procurement_items")),
        ],
        "null",
    )


def grade() -> str:
    """F31 for a lead that no step rejected: premium or qualified."""
    owned = "(coalesce(trim(domain), '') <> '' and not is_junk_domain and not is_aggregator)"
    return f"case when n_signals >= 2 and {owned} then 'premium' when lower(coalesce(confidence_tier, '')) = 'high' and {any_of([owned, predicates.has_email()])} then 'premium' else 'qualified' end"


def evaluate(df, d: Spark, supplier: bool = False):
    """Adds the facts, reason and grade to leads.

    All of it is one struct-valued expression in which every fact has a name, so
    a filter on the verdict that the optimizer pushes down copies it once and
    doesn't multiply it by its uses.
    """
    all_facts = facts(d, supplier)
    named = lambda text: re.sub(r"\b(" + "|".join(all_facts) + r")\b(?!')", r"f.\1", text)
    fields = ", ".join(f"'{n}', f.{n}" for n in all_facts)
    graded = f"named_struct({fields}, 'reason', r, 'grade', case when r is null then {named(grade())} else 'unqualified' end)"
    verdict = d.let(f"named_struct({', '.join(f'{lit(n)}, {x}' for n, x in all_facts.items())})", "f", d.let(named(gate_reason()), "r", graded))
    return df.selectExpr("*", f"{verdict} as _verdict").selectExpr("* except (_verdict)", "_verdict.*")


def evaluate_sql(source: str, d: Spark, supplier: bool = False) -> str:
    """The same as one SQL text."""
    cols = ", ".join(f"{text} as {name}" for name, text in facts(d, supplier).items())
    return f"select *, case when reason is null then {grade()} else 'unqualified' end as grade from (select *, {gate_reason()} as reason from (select *, {cols} from ({source})))"


def supplier_word(d: Spark) -> str:
    from .. import rules

    return d.rx(f"{texts.low('company_name')} || ' ' || {texts.low('snippet')}", rules.SUPPLIER_PATTERN)


def supplier_verdict(d: Spark, negatives: list[str]) -> tuple[str, str]:
    """F30 over evaluated leads (supplier mode): (reason, grade)."""
    first = [(f"contains({texts.low('company_name')} || ' ' || {texts.low('snippet')}, {lit(w)})", lit(f"negative_keyword:{w}")) for w in negatives]
    reason = cascade([*first, (f"entity = 'aggregator' and not {supplier_word(d)}", lit("aggregator_no_supplier_signal")), ("reason is not null", "reason"), (f"grade = 'qualified' and {supplier_word(d)}", lit("supplier_signal_upgrade"))], "null")
    any_negative = any_of(c for c, _ in first) if first else "false"
    grade_ = cascade([(f"{any_negative} or (entity = 'aggregator' and not {supplier_word(d)}) or reason is not null", lit("unqualified")), (supplier_word(d), lit("premium"))], "grade")
    return reason, grade_


def routing_drop(d: Spark, country: str, negatives: list[str], icp: str = "soft", reverse: str = "strict") -> str:
    """F26-F28 over evaluated leads: the code under which a lead is dropped before or after the gate, or null if it stays."""
    seed = predicates.seed_source(d)
    match = "lower(coalesce(industry_match, ''))"
    icp_bad = {"soft": f"{match} = 'none'", "balanced": f"{match} in ('low', 'none')", "off": "false"}[icp]
    target = "lower(coalesce(target_match, ''))"
    reverse_bad = {"strict": f"{target} in ('low', 'none')", "balanced": f"{target} = 'none'", "off": "false"}[reverse]
    return cascade(
        [
            ("coalesce(trim(country), '') = ''", lit("BLANK_COUNTRY")),
            (f"upper(trim(country)) <> {lit(country)} and not {seed}" if country else "false", lit("COUNTRY_MISMATCH")),
            (predicates.negative_hit(d, negatives), lit("NEGATIVE_KEYWORD_HIT")),
            (icp_bad, lit("ICP_MATCH_LOW")),
            ("deferred", "null"),
            (f"confidence_tier is not null and not {seed} and {reverse_bad}", lit("REVERSE_VERIFY_FAIL")),
            ("grade = 'unqualified'", lit("UNQUALIFIED")),
        ],
        "null",
    )


def needs_review() -> str:
    return "(deferred or lower(coalesce(industry_match, '')) = 'medium' or (confidence_tier is not null and lower(coalesce(target_match, '')) in ('medium', 'low')))"


def route(d: Spark, score: str) -> str:
    """F33 for leads that stayed: where they go."""
    contact = predicates.contact_filled()
    return cascade([("deferred", lit("deferred")), (f"coalesce({score}, 0) >= 90 and {contact}", lit("hot")), (texts.usable_domain(d, "domain"), lit("queue")), (f"not {contact}", lit("rejected"))], lit("kept"))
