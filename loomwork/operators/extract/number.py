"""The station's number: an ordered grammar of contexts and shapes; the first accepted value wins.

A rule is what stands before the value, the value's shape and what follows. Rules are made from families: each context
is combined with its shapes in order, so the table is short and its order is the order of trust.
"""

from __future__ import annotations

import re
from functools import cache

from . import bounded, sections

# Contexts.
BS = r"\b[БB][СCS]"
STATION = r"базов\w{1,3}\s+станци\w{1,2}"
NO = r"№\s*"
NET = r"(?=\s*(?:сети|стандарт))"
NAMED = r"(?=\s*[\"«])"
FORM = r"(?:ПАО|ООО|ОАО|ЗАО|АО)"

# Shapes, by families in order of trust: (before, shapes, after).
FAMILIES: tuple[tuple[str, tuple[str, ...], str], ...] = (
    (r"\b", (r"BSR_[A-Z0-9_]+", r"BTS-\d{1,3}-\s?\d{3,}\w*", r"BTS-[A-ZА-ЯЁ0-9-]*[A-ZА-ЯЁ0-9]", r"PL[_ ]\d{2}[_ ]?\d{3,6}", r"BTS_\w*\w"), ""),
    (r"\bBTS-?\s*", (r"\d{2}-\d{3,}\w*", r"\d{3,}_\w+"), ""),
    (rf"(?:{BS}|{STATION})\s*{NO}", (r"\d{3,5}\s+[\"«][^\"»]{2,40}[\"»]",), ""),
    (rf"(?:{BS}|{STATION})\s*{NO}", (r"\d{2}-\s?\d{3,}\w*", r"[A-ZА-ЯЁ]{1,3}\d{3,}\w*", r"\d{2}\.\d{2,5}", r"\w+(?:-\w+)+", r"\d{3,6}"), ""),
    (rf"(?:{BS}|{STATION})\s*{NO}", (r"\d{1,5}",), NET),
    (rf"{BS}\s*[-–]\s*", (r"\d{2}-\d{3,}\w*", r"\d{3,}\w*", r"[A-ZА-ЯЁ]{2}\d{3}_\w+", r"\d{1,2}(?=\s+[А-ЯЁ])"), ""),
    (rf"{BS}\s+", (r"\d{2}[_-]\d{2,}\w*", r"\d{4,}\w*", r"\d{1,4}\s*км"), ""),
    (rf"{BS}\s*[\"«]", (r"[\w .-]{2,40}(?=[\"»])",), ""),
    (rf"{STATION}[^.\n№]{{0,60}}{NO}", (r"\d{2}\s?-\s?\d{2,}\w*", r"[A-ZА-ЯЁ]{1,4}\s?\d{3,}\w*", r"\d{3,6}", r"\d{1,2}(?=\s*\(\d)"), ""),
    (rf"{STATION}[^.\n\d]{{0,40}}?\s", (r"\d{2}\s?-\s?\d{2,}\w*", r"\d{4,6}(?!\s*(?:год|м\b|МГц|Вт))", r"[A-Z]{2,}(?:_\w+)+"), ""),
    (r"(?:сотовой|мобильной|подвижной)\s+связи\s+", (r"[A-Z]{2,}[ _]\w+(?:[ _/]\w+){0,3}", r"\d{4,6}"), r"(?=\s*(?:сети|стандарт|,|[\"«]))"),
    (NO, (r"\d{2}\s?-\s?\d{2,}\w*", r"[A-ZА-ЯЁ]{2}\s?\d{3,}\w*", r"\d{2}\.\d{4}", r"\d{2}_\d{3,}\w*"), ""),
    (NO, (r"\w+(?:[-_/]\w+)+", r"\d{3,6}"), rf"(?=\s*(?:[\"«]|{FORM}|сети|стандарт|,|\n|$|размещ|по\s+адресу))"),
    (r"\b", (r"\d{2}-\d{3,5}", r"[A-Z]{2}\d{5,}"), rf"(?=\s*(?:[\"«]|{FORM}|сети|стандарт))"),
    (r"(?:радиоэлектронное\s+средство\)?|станци\w{1,2})\s*[\"«]", (r"[^\"»\n]{2,40}(?=[\"»])",), ""),
    (r"\b(?:УС|РТС|РЭС|ПРС|УРС|БУС)[\s-]*", (r"\d{1,4}\s*км", r"\d{1,2}\.\d", r"\d{1,4}", r"[А-ЯЁ]\w{2,20}"), r"(?=\s|,|[\"«]|$)"),
)

_DOTTED = bounded.compile(r"^\d+\.\d{2,5}$")
_LETTERS = bounded.compile(r"[^\W\d_]{2}")


@cache
def rules() -> tuple[bounded.Pattern, ...]:
    return tuple(bounded.compile(f"{before}({shape}){after}", re.I) for before, shapes, after in FAMILIES for shape in shapes)


def _accepted(value: str, text: str) -> str | None:
    value = re.sub(r"\s*-\s*", "-", value.strip()).replace(" и СКЗ ", " ")
    value = re.sub(r"(?<=[\d_])\s+(?=\d{3,})|(?<=[»\"])\s+$", "", value) if value.startswith(("BTS-", "BSR")) else value
    value = re.sub(r"-(?:СЗЗ|ПСЭЗ|ЗОЗ)$", "", value)
    if not value or len(value) > 60 or "." in value and not _DOTTED.match(value) and not _LETTERS.search(value):
        return None
    quoted = rf"№\s*{re.escape(value)}"
    if re.fullmatch(r"\d{1,2}", value):
        network = rf"{quoted}\s*(?:\([^)]{{0,40}}\)\s*)?(?:{FORM}\s*[\"«][^\"»]{{1,40}}[\"»]\s*)?(?:\s*(?:сети|стандарт)|,\s*абонентск)"
        if not re.search(network, text, re.I):
            return None
    if re.fullmatch(r"20\d\d", value) and not re.search(rf"{quoted}\b", text, re.I):
        return None  # a year
    return value.rstrip("/").strip() or None


def station_number(text: str) -> str | None:
    """From the project's section, the start of the appendix, the appendix, then the whole text. Of each rule only the
    first match is looked at."""
    back = sections.appendix(text)
    for part in (sections.project(text), back and back[:600], back, text):
        for rule in rules() if part else ():
            if (m := rule.search(part)) and (value := _accepted(m[1], part)):
                return value
    return None
