"""E-mail rules: hosts, locals, registered domains and the buyer verdict."""

from __future__ import annotations

from .. import rules
from .dialect import Spark, any_of, cascade, in_list, lit


def email_host(d: Spark, x: str) -> str:
    """The text behind the last @, lower case; empty if there is none."""
    return f"trim({d.extract(f'lower(trim({x}))', r'^.+@([^@]+)\z')})"


def email_local(d: Spark, x: str) -> str:
    return d.extract(f"lower(trim({x}))", r"^(.+)@[^@]*\z")


def registered_domain(d: Spark, h: str) -> str:
    """The last two labels of a host, or three behind a common two-part suffix."""
    clean = d.sub(d.sub(f"lower({h})", r"^www\."), r"[^a-z0-9.\-]")
    two, three = d.extract("cl", r"([^.]+\.[^.]+)\z"), d.extract("cl", r"([^.]+\.[^.]+\.[^.]+)\z")
    return d.let(clean, "cl", f"case when {three} = '' then cl when {in_list(two, rules.SECOND_LEVEL_SUFFIXES)} then {three} else {two} end")


def email_reason(d: Spark, email: str, domain: str) -> str:
    """why an address is taken or not; accepted are ok, pr_or_investor_only and free_email_no_verify."""
    site = d.sub(d.sub(f"lower(coalesce({domain}, ''))", r"^https?://"), r"/.*\z")
    pr = any_of([in_list("loc", rules.PR_PREFIXES), in_list(d.extract("loc", r"^([^.\-_]*)"), rules.PR_PREFIXES)])
    free = any_of([in_list("h", rules.FREE_EMAIL_HOSTS), in_list("reg", rules.FREE_EMAIL_HOSTS)])
    non_buyer = any_of([in_list("h", rules.NON_BUYER_EMAIL_HOSTS), in_list("reg", rules.NON_BUYER_EMAIL_HOSTS)])
    reason = cascade(
        [
            ("addr = '' or not contains(h, '.')", lit("invalid_format")),
            (any_of([in_list("addr", rules.PLACEHOLDER_EMAILS), in_list("loc", rules.PLACEHOLDER_LOCALS), d.rx("addr", rules.PLACEHOLDER_PATTERN)]), lit("placeholder_email")),
            (non_buyer, lit("aggregator_email")),
            ("want <> '' and want <> reg", f"case when {free} then 'free_email_no_verify' else 'brand_mismatch' end"),
            (pr, lit("pr_or_investor_only")),
            (f"want = '' and {free}", lit("free_email_no_verify")),
        ],
        lit("ok"),
    )
    # each part is worked out once, under a name
    for name, text in (("want", d.let(site, "st", f"coalesce({registered_domain(d, 'st')}, '')")), ("loc", email_local(d, "addr")), ("reg", registered_domain(d, "h")), ("h", email_host(d, "addr")), ("addr", f"lower(trim(coalesce({email}, '')))")):
        reason = d.let(text, name, reason)
    return reason


def accepted(reason: str) -> str:
    return in_list(reason, ["ok", "pr_or_investor_only", "free_email_no_verify"])


def severity(reason: str) -> str:
    return f"case when {in_list(reason, ['pr_or_investor_only', 'free_email_no_verify'])} then 'warn' else 'reject' end"
