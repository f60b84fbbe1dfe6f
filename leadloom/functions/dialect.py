"""Rule expressions as SQL text for Spark, and for the SQL that results are checked against.

Most of the text is the same for both; where engines differ, a rule asks its
dialect. The helper classes here hold just these differences.
"""

from __future__ import annotations

from collections.abc import Iterable

#: An ASCII word boundary. Java's own \\b also sees letters of other scripts.
_ASCII_BOUNDARY = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"


def lit(value: str) -> str:
    """A string literal; the values are fixed rule texts without quotes or backslashes."""
    if "\\" in value or "'" in value:
        raise ValueError(value)
    return f"'{value}'"


def any_of(parts: Iterable[str]) -> str:
    return "(" + " or ".join(parts) + ")"


def in_list(x: str, values: Iterable[str]) -> str:
    return f"{x} in ({', '.join(lit(v) for v in values)})"


def cascade(rules: Iterable[tuple[str, str]], otherwise: str) -> str:
    """An ordered list of (condition, value): the first condition that holds gives the value."""
    return "case " + " ".join(f"when {c} then {v}" for c, v in rules) + f" else {otherwise} end"


def lookup(x: str, table: dict, otherwise: str = "null") -> str:
    return f"case {x} " + " ".join(f"when {lit(k)} then {lit(v) if isinstance(v, str) else v}" for k, v in table.items()) + f" else {otherwise} end"


class Spark:
    name = "spark"

    def pattern(self, p: str) -> str:
        return "r'" + p.replace(r"\b", _ASCII_BOUNDARY) + "'"

    def rx(self, x: str, p: str) -> str:
        """Whether the pattern occurs in x; null counts as empty."""
        return f"(coalesce({x}, '') rlike {self.pattern(p)})"

    def extract(self, x: str, p: str, group: int = 1) -> str:
        """The group of the first match, or an empty text."""
        return f"regexp_extract(coalesce({x}, ''), {self.pattern(p)}, {group})"

    def extract_all(self, x: str, p: str, group: int = 0) -> str:
        return f"regexp_extract_all(coalesce({x}, ''), {self.pattern(p)}, {group})"

    def sub(self, x: str, p: str, by: str = "") -> str:
        """Every match replaced; in ``by``, $1 is the first group."""
        return f"regexp_replace({x}, {self.pattern(p)}, '{by}')"

    def array(self, *xs: str) -> str:
        return f"array({', '.join(xs)})"

    def drop_nulls(self, arr: str) -> str:
        return f"array_compact({arr})"

    def split(self, x: str, p: str) -> str:
        return f"split({x}, {self.pattern(p)})"

    def each(self, arr: str, var: str, body: str) -> str:
        return f"transform({arr}, {var} -> {body})"

    def keep(self, arr: str, var: str, condition: str) -> str:
        return f"filter({arr}, {var} -> {condition})"

    def size(self, arr: str) -> str:
        return f"size({arr})"

    def distinct(self, arr: str) -> str:
        """Without repetitions, in sorted order."""
        return f"array_sort(array_distinct({arr}))"

    def join(self, arr: str, by: str) -> str:
        return f"array_join({arr}, '{by}')"

    def head(self, arr: str, n: int) -> str:
        return f"slice({arr}, 1, {n})"

    def url_encode(self, x: str) -> str:
        return f"replace(url_encode({x}), '+', '%20')"

    def let(self, x: str, var: str, body: str) -> str:
        """body with x worked out once under the name var."""
        return f"element_at(transform(array({x}), {var} -> {body}), 1)"


class Duck(Spark):
    name = "duck"

    def pattern(self, p: str) -> str:
        return "'" + p + "'"

    def rx(self, x: str, p: str) -> str:
        return f"regexp_matches(coalesce({x}, ''), {self.pattern(p)})"

    def sub(self, x: str, p: str, by: str = "") -> str:
        return f"regexp_replace({x}, {self.pattern(p)}, '{by.replace('$', chr(92))}', 'g')"

    def array(self, *xs: str) -> str:
        return f"[{', '.join(xs)}]"

    def drop_nulls(self, arr: str) -> str:
        return f"list_filter({arr}, lambda _x: _x is not null)"

    def split(self, x: str, p: str) -> str:
        return f"regexp_split_to_array({x}, {self.pattern(p)})"

    def each(self, arr: str, var: str, body: str) -> str:
        return f"list_transform({arr}, lambda {var}: {body})"

    def keep(self, arr: str, var: str, condition: str) -> str:
        return f"list_filter({arr}, lambda {var}: {condition})"

    def size(self, arr: str) -> str:
        return f"len({arr})"

    def distinct(self, arr: str) -> str:
        return f"list_sort(list_distinct({arr}))"

    def join(self, arr: str, by: str) -> str:
        return f"array_to_string({arr}, '{by}')"

    def head(self, arr: str, n: int) -> str:
        return f"({arr})[1:{n}]"

    def let(self, x: str, var: str, body: str) -> str:
        return f"list_transform([{x}], lambda {var}: {body})[1]"


SPARK, DUCK = Spark(), Duck()
