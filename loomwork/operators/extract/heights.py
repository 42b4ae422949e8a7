"""Antenna heights: a list per document of (height, base, antenna, number), in the order in which they are found."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from . import bounded

GROUND, ROOF = "земля", "кровля"

_N = r"\d{1,3}(?:[.,]\d{1,2})?"
_ITEM = rf"(?:(?:БС|РРС)\s*:\s*)?{_N}(?:\s*-\s*{_N})?"
LIST = rf"({_ITEM}(?:\s*(?:;|/|,\s|\sи\s)\s*(?:{_ITEM}|-))*)"
UNIT = r"\s*(?:м\b\.?|метр\w*)"
_TALK = r"[^.;\d\n]"

# Phrases that announce heights of antennas, in order.
PHRASES: tuple[str, ...] = (
    rf"высот\w+\s+(?:точ\w+\s+)?подвеса{_TALK}{{0,120}}?(?:,?\s*м\s*)?[:=\-–—]?\s*(?<![\d.,]){LIST}",
    rf"высот\w+\s+(?:установки|размещения|фазового\s+центра){_TALK}{{0,120}}?(?:,?\s*м\s*)?[:=\-–—]?\s*(?<![\d.,]){LIST}",
    rf"(?:установлен\w*|размещ\w+|расположен\w*){_TALK}{{0,80}}?на\s+высот\w+{_TALK}{{0,60}}?(?<![\d.,]){LIST}{UNIT}",
    rf"на\s+(?:высот\w+|отметк\w+)\s+(?:подвеса\s+)?{LIST}{UNIT}{_TALK}{{0,60}}",
    rf"\b[HНhн]\s*=\s*{LIST}{UNIT}?{_TALK}{{0,40}}",
    rf"от\s+(?:уровня|поверхности)\s+(?:земли|кровли|крыши){_TALK}{{0,40}}?[:=\-–—]\s*(?<![\d.,]){LIST}{UNIT}?",
)
MAST = rf"(?:мачт|столб|башн|опор)\w*{_TALK}{{0,40}}?высот\w+{_TALK}{{0,20}}?{LIST}{UNIT}"
PAIR = rf"зем\w*\.?\s*/\s*(?:от\s+(?:уровня\s+)?)?кров\w*\.?{_TALK}{{0,40}}?({_N})\s*(?:/|\()\s*({_N}|-)"
TABLE = r"высот\w+[^\n]{0,60}(?:земли|крыши)[^\n]*"

_PHRASES = tuple(bounded.compile(p, re.I) for p in PHRASES)
_MAST, _PAIR, _TABLE = (bounded.compile(p, re.I) for p in (MAST, PAIR, TABLE))
_PLUS = bounded.compile(rf"(?<=\s)\+({_N})(?=\s)")
_PIECES = bounded.compile(rf"шт\.?,\s*({_N}){UNIT},")
_AFTER = bounded.compile(r"тип\w*\s+антенн\w*\s*[-–—:]\s*([^,;\n]{2,60})", re.I)
_CODE = bounded.compile(r"^[AА](\d+)\s*-\s*(.+)$")
_BEFORE = bounded.compile(r"№\s*(\d+)\s+([^;,\n]{2,60});[^;\n]*$")
_MODEL = bounded.compile(r"антенн\w*\s+тип\w*\s+([A-Z][\w/-]*(?:\s[A-Z0-9][\w/-]*)?)|,\s*типа\s+([A-Z][\w/-]*)", re.I)


class Height(NamedTuple):
    height: float
    base: str | None
    antenna: str | None
    number: int | None


def numbers(text: str) -> list[float]:
    """"24, 27" two numbers, "62,5" one, "19-23" both ends; "-" is nothing."""
    text = re.sub(r",\s+|\sи\s", ";", text)
    out = []
    for part in re.split(r"[;/]", text):
        ends = re.fullmatch(rf"\s*({_N})\s*-\s*({_N})\s*", part)
        found = list(ends.groups()) if ends else re.findall(_N, part)[:1]
        out += [float(x.replace(",", ".")) for x in found]
    return out


def based(phrase: str, values: str) -> list[tuple[float, str | None]]:
    """Values with the base that the phrase names; of two bases joined by a slash each has one of two values."""
    low = phrase.lower()
    ground, roof = "земл" in low, "кровл" in low or "крыш" in low
    if ground and roof and re.search(r"земли\s*/\s*(?:кровли|от)", low):
        sides = values.split("/")
        if len(sides) == 2:
            return [(x, b) for side, b in zip(sides, (GROUND, ROOF), strict=True) for x in numbers(side)]
    base = GROUND if ground else ROOF if roof else None
    return [(x, base) for x in numbers(values)]


def _antenna(text: str, start: int, stop: int) -> tuple[str | None, int | None]:
    """The antenna named later in the line, else the one before."""
    rest = text[stop : stop + 300].split("\n", 1)[0]
    if m := _AFTER.search(rest):
        name = m[1].strip()
        return (code[2].strip(), int(code[1])) if (code := _CODE.match(name)) else (name, None)
    line = text[max(0, start - 120) : start].rsplit("\n", 1)[-1]
    if m := _BEFORE.search(line):
        return m[2].strip(), int(m[1])
    return None, None


def _found(text: str) -> Iterator[Height]:
    paired = []
    for m in _PAIR.finditer(text):
        paired.append(m.span())
        who = _antenna(text, *m.span())
        yield from (Height(float(m[k].replace(",", ".")), b, *who) for k, b in ((1, GROUND), (2, ROOF)) if m[k] != "-")
    for rx in _PHRASES:
        for m in rx.finditer(text):
            if any(s < m.end() and m.start() < e for s, e in paired):
                continue
            who = _antenna(text, *m.span())
            yield from (Height(x, b, *who) for x, b in based(m[0], m[m.lastindex]))
    if head := _TABLE.search(text):
        for m in (*_PLUS.finditer(text, head.end()), *_PIECES.finditer(text)):
            yield Height(float(m[1].replace(",", ".")), GROUND, None, None)


def heights(text: str) -> list[Height] | None:
    """All heights from 1 to 500 m, each once; null if there are none. A height without a base goes if the same one with a
    base is there. A single model named for the whole document belongs to all heights, a single height to all models;
    heights of masts count only where there are no others."""
    out = list(dict.fromkeys(h for h in _found(text) if 1 <= h.height <= 500))
    seen: set[tuple] = set()
    out = [h for h in out if not (h[:3] in seen or seen.add(h[:3]))]
    if out and all(h.antenna is None for h in out):
        models = list({(a or b).lower(): (a or b).strip() for a, b in _MODEL.findall(text)}.values())
        if len(models) == 1:
            out = [h._replace(antenna=models[0]) for h in out]
        elif models and len({h.height for h in out}) == 1:
            out = [out[0]._replace(antenna=m) for m in models]
    if not out:
        out = [Height(x, b, None, None) for m in _MAST.finditer(text) for x, b in based(m[0], m[1]) if 1 <= x <= 500]
    named = [(h.height, h.antenna) for h in out if h.base]
    return [h for h in out if h.base or not any(x == h.height and h.antenna in (a, None) for x, a in named)] or None
