"""Coordinates: marks are normalised to one notation, then one grammar of values, directions and separators is matched.

Every spelling of degree, minute, second and direction becomes ° ' " N E S W first; so few forms are left that
each is one pattern made of the same parts. The first plausible pair in the order of the forms wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from . import bounded, sections

# Rewrites of marks, in order.
MARKS: tuple[tuple[str, str], ...] = (
    (r"``|''|″|”|“", '"'), (r"[`´′’]", "'"), ("„", ","),
    (r"(?<=\d)\s*(?:градус\w*|град\.?|гр\.)", "°"), (r"(?<=\d)\s*(?:минут\w*|мин\.?)", "'"), (r"(?<=\d)\s*(?:секунд\w*|сек\.?)", '"'),
    (r"(?<=\d)º|(?<=\d)˚", "°"), (r"°\s*(\d{1,2})\s*\*", r"°\1'"), (r"(?<=\d)\s*\*", "°"), (r"(\d{1,3})\?(\d{1,2})[?'](?=\d)", r"\1°\2'"), (r"(?<=\d)\?(?=\s*[СCВB]\.)", '"'),
    (r"(\d{1,3})\s*[оo](?=\s*\d{1,2}\s*')", r"\1°"), (r"°(\d{1,2}),(?=\d{1,2}[.,]\d+\s*\")", r"°\1'"), (r"'\s*\.(?=\d)", "'"), (r"(\d{2})\s*\"(?=\s*\d{1,2}[.,]\d+\s*\")", r"\1'"),
    (r"(?<=\d)\.\.(?=\d)", "."), (r"(\d{2,3})\.\s+(?=\d{3,})", r"\1."), (r"(\d{2,3})\s+\.(?=\d{3,})", r"\1."), (r"(\d{1,2}),\s(?=\d{1,4}\s*\")", r"\1,"),
    (r"(?:северн\w*|сев\.?)\s*(?:широт\w*|ш\.?)|(?<![а-яё])[сc]\s*\.?\s*[шщ]\b\.?(?:\s*\.)?", " N "), (r"(?:восточн\w*|вост\.?)\s*(?:долгот\w*|д\.?)|(?<![а-яё])[вb]\s*\.?\s*д\b\.?(?:\s*\.)?", " E "),
    (r"(?:южн\w*|юж\.?)\s*(?:широт\w*|ш\.?)|(?<![а-яё])ю\s*\.?\s*ш\b\.?", " S "), (r"(?:западн\w*|зап\.?)\s*(?:долгот\w*|д\.?)|(?<![а-яё])з\s*\.?\s*д\b\.?", " W "),
)

DEC = r"(\d{2,3}[.,]\d{3,})\s*[°'\"]*"
LONG_DEC = r"(\d{2,3}[.,]\d{5,})\s*[°'\"]*"
POINT_DEC = r"(\d{2,3}\.\d{4,})\s*°?"
DMS = r"(\d{1,3}\s*°\s*\d{1,2}\s*'\s*\d{1,2}(?:\s?[.,]\s?\d+)?)\s*[\"'°]*"
HYPHENS = r"(\d{1,3}-\d{1,2}-\d{1,2}(?:[.,]\d+)?)\s*[\"']*"
GLUED = r"(\d{2,3}\.\d{4}[.,]\d+)"
SEP = r"[\s,;:/().\-–—\"']*(?:и\s+)?"
NORTH, EAST = r"([NSСC])\.?", r"([EWЕВB])\.?"
NOTE = r"\s*\([^)]{5,30}\)\s*"

_NOTHING = "()"
#: Forms in order of trust; four groups each: direction or nothing and value of the latitude, then of the longitude.
FORMS: tuple[str, ...] = (
    rf"{_NOTHING}{DEC}{NOTE}(?:[NS]\s*)?{SEP}{_NOTHING}{DEC}{NOTE}",
    rf"{_NOTHING}{DMS}{NOTE}(?:[NS]\s*)?{SEP}{_NOTHING}{DMS}{NOTE}",
    rf"(?:широта|ш\.?)\s*[:=]?\s*{_NOTHING}{DEC}{SEP}(?:WGS\s*)?(?:долгота|д\.?)\s*[:=]?\s*{_NOTHING}{DEC}",
    rf"\(\s*{_NOTHING}{DEC}\s*[,;]\s*{_NOTHING}{DEC}\s*\)",
    rf"{_NOTHING}{POINT_DEC}[,/\s]+{_NOTHING}{POINT_DEC}(?!\s*[NS])",
    rf"{DEC}(?:{NOTE})?\s*[(,]?\s*{NORTH}{SEP}{DEC}(?:{NOTE})?\s*[(,]?\s*{EAST}",
    rf"{NORTH}\s*:?\s*{DEC}{SEP}{EAST}\s*:?\s*{DEC}",
    rf"(?:широта|ш\.?|N)\s*[:=]?\s*{_NOTHING}{DMS}{SEP}(?:долгота|д\.?|E)\s*[:=]?\s*{_NOTHING}{DMS}",
    rf"{DMS}[)\s]*{NORTH}{SEP}(?:[EЕ]\s*)?{DMS}[)\s]*{EAST}",
    rf"{HYPHENS}\s*{NORTH}{SEP}{HYPHENS}\s*{EAST}",
    rf"{GLUED}\s*{NORTH}{SEP}{GLUED}\s*{EAST}",
    rf"{NORTH}\s*:?\s*{DMS}{SEP}{EAST}\s*:?\s*{DMS}",
    rf"{_NOTHING}{DEC}\s*[,;]?\s*{SEP}[EЕ]\s*:?\s*{_NOTHING}{DEC}",
    rf"{_NOTHING}{DMS}{SEP}[EЕ]?\s*{_NOTHING}{DMS}",
    rf"{_NOTHING}{LONG_DEC}[,;/\s]+{_NOTHING}{LONG_DEC}",
)

_MARKS = tuple((bounded.compile(p, re.I), to) for p, to in MARKS)
_FORMS = tuple(bounded.compile(f) for f in FORMS)
_LABELS = tuple(bounded.compile(p + r"[:\s]*([^\n]{5,80})", re.I) for p in (r"географические\s+координаты", r"координаты"))
_LATITUDE = bounded.compile(rf"{DMS}[)\s]*N|N\s*:?\s*{DMS}")
_LONGITUDE = bounded.compile(rf"{DMS}[)\s]*E|E\s*:?\s*{DMS}")


def normalised(text: str) -> str:
    for rx, to in _MARKS:
        text = rx.sub(to, text)
    return text


def degrees(text: str) -> float | None:
    """Value of a number in any notation; null where minutes reach 60 or seconds pass it."""
    text = text.replace(" ", "")
    if re.fullmatch(r"\d{2,3}\.\d{4}[.,]\d+", text):  # degrees, then minutes and seconds in one
        whole, _, rest = text.partition(".")
        parts = [whole, rest[:2], rest[2:].replace(",", ".")]
    elif "°" in text or text.count("-") == 2:
        parts = re.split(r"[°'-]", text.replace(",", "."))
    else:
        return float(text.replace(",", "."))
    try:
        d, m, s = int(parts[0]), int(parts[1]), float(parts[2])
    except ValueError:
        return None
    return d + m / 60 + s / 3600 if m < 60 and s <= 60 else None


def plausible(lat: float, lon: float) -> bool:
    return 41 <= lat <= 82 and (19 <= lon <= 190 or -180 <= lon <= -168) and abs(lat - lon) >= 1e-9


def _number(x: float) -> str:
    return repr(x).removesuffix(".0")


def _pairs(text: str) -> Iterator[tuple[float, float]]:
    for rx in _FORMS:
        for m in rx.finditer(text):
            values, signs = [], []
            for g in m.groups():
                if g and any(c.isdigit() for c in g):
                    values.append(degrees(g))
                elif g:
                    signs.append(g)
            if len(values) == 2 and None not in values:
                lat, lon = values
                yield (-lat if "S" in signs else lat), (-lon if "W" in signs else lon)
    a, b = _LATITUDE.search(text), _LONGITUDE.search(text)
    if a and b and a.start() != b.start():
        lat, lon = degrees(a[1] or a[2]), degrees(b[1] or b[2])
        if lat is not None and lon is not None:
            yield lat, lon


def coordinates(text: str) -> str | None:
    """"lat, lon" in degrees: in the project's section before the whole text, after a label before anywhere."""
    text = normalised(text)
    for part in (sections.project(text), text):
        if part is None:
            continue
        for rx in _LABELS:
            if (m := rx.search(part)) and (found := next((p for p in _pairs(m[1].strip()) if plausible(*p)), None)):
                return f"{_number(found[0])}, {_number(found[1])}"
        if found := next((p for p in _pairs(part) if plausible(*p)), None):
            return f"{_number(found[0])}, {_number(found[1])}"
    return None
