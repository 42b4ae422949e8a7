"""Ordered rules compiled to expressions: the first rule that holds wins, or all matches are gathered.

A cascade is one ``coalesce`` over lazily evaluated expressions, so it stays inside generated code, needs no shuffle
and stops at the first hit of a row. Patterns get Unicode classes and case folding, which Java has off by default.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

UNICODE = "(?Uiu)"


@dataclass(frozen=True)
class Rule:
    """name, pattern, and the groups whose texts put together are the value. exact: letters in just this case."""

    name: str
    pattern: str
    groups: tuple[int, ...] = (1,)
    exact: bool = False

    @property
    def regex(self) -> str:
        return self.pattern if self.exact else UNICODE + self.pattern


def extract(text: Column, regex: str, group: int = 1) -> Column:
    """The group of the first match; null where nothing, or nothing but emptiness, was matched."""
    return F.nullif(F.regexp_extract(text, regex, group), F.lit(""))


def extract_all(text: Column, regex: str, group: int = 1) -> Column:
    """The group of every match, in order; empty without any."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(regex), F.lit(group)), F.array().cast("array<string>"))


def value_of(text: Column, rule: Rule) -> Column:
    parts = [extract(text, rule.regex, g) for g in rule.groups]
    return parts[0] if len(parts) == 1 else F.nullif(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), F.lit(""))


def first_match(text: Column, rules: Sequence[Rule], accept: Callable[[Column], Column] | None = None) -> Column:
    """Value of the first rule with an accepted value. accept turns a value into what is kept of it, null if refused."""
    values = [value_of(text, r) for r in rules]
    return F.coalesce(*[accept(v) if accept else v for v in values])


def first_name(text: Column, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that matches."""
    return F.coalesce(*[F.when(value_of(text, r).isNotNull(), F.lit(r.name)) for r in rules])


def rewrite(text: Column, steps: Sequence[tuple[str, str]], unicode: bool = True) -> Column:
    """The text after replacements, one after the other; their order is part of the meaning."""
    for pattern, to in steps:
        text = F.regexp_replace(text, (UNICODE + pattern) if unicode else pattern, to)
    return text
