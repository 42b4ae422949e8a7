"""Expressions with a time limit: a text on which a rule runs away fails with TimeoutError instead of holding its task."""

from __future__ import annotations

from collections.abc import Iterator

import regex

#: Seconds that one search may take.
LIMIT = 20.0

I, M, S = regex.I, regex.M, regex.S  # noqa: E741


class Pattern:
    """What the rules use of a compiled expression, each call within the limit."""

    def __init__(self, pattern: str, flags: int = 0) -> None:
        self.pattern = pattern
        self._rx = regex.compile(pattern, flags)

    def search(self, text: str, start: int = 0) -> regex.Match | None:
        return self._rx.search(text, start, timeout=LIMIT)

    def match(self, text: str) -> regex.Match | None:
        return self._rx.match(text, timeout=LIMIT)

    def finditer(self, text: str, start: int = 0) -> Iterator[regex.Match]:
        return self._rx.finditer(text, start, timeout=LIMIT)

    def findall(self, text: str) -> list:
        return self._rx.findall(text, timeout=LIMIT)

    def sub(self, to: str, text: str) -> str:
        return self._rx.sub(to, text, timeout=LIMIT)


def compile(pattern: str, flags: int = 0) -> Pattern:  # noqa: A001
    return Pattern(pattern, flags)
