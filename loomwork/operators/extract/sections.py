"""Parts of a document that rules look at, most trusted first."""

from __future__ import annotations

import re

_PROJECT = re.compile("проектная документация", re.I)
_VERDICT = re.compile("соответствует", re.I)


def project(text: str) -> str | None:
    """From the project's heading to the word of conformity, else 1500 characters."""
    m = _PROJECT.search(text)
    if not m:
        return None
    stop = _VERDICT.search(text, m.start())
    return text[m.start() : stop.start() if stop else m.start() + 1500]


def appendix(text: str, line_start: bool = False) -> str | None:
    """From the appendix on. Its heading is capitalised; mentions in small letters don't count."""
    m = re.search(r"^Приложение" if line_start else "Приложение", text, re.M)
    return text[m.start() :] if m else None


def repaired(text: str) -> str:
    """Frequent misspellings of the word for station after "базов…" put right."""
    return re.sub(r"(?<=базов)(\w*\s+)стаци(?=[ийя])", r"\1станци", text, flags=re.I)
