"""The station's postal address: candidates after anchors, most explicit anchor first, are cut, judged and cleaned.

An address is a run of parts that starts at a region. So a candidate is found by its anchor or by a region's name, ends at
the first word that can't belong to an address, must name a region and a place, and is cleaned at last.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from . import bounded, sections

# Words of regions, places, streets; words that end an address; contexts of foreign addresses.
REGION = r"(?:[А-ЯЁ][\w-]+\s+(?:област\w*|обл\.?|кра[йяею]\w*|автономн\w+\s+округ\w*|АО|Респ\w*)|Респ\w*\.?\s+[А-ЯЁ][\w-]+(?:\s*[-–(]\s*[А-ЯЁ]\w+\)?)?|[КХЧДЛ]\w{2}\b|(?:г\.\s*)?(?:Москва|Санкт-Петербург|Севастополь)|Чувашия|РД|РТ|РБ)"
PLACE = r"(?:\bг\.|\bгород\w*|\bс\.|\bсел[оае]\b|\bд\.|\bдер\w*|\bп\.|\bпос\w*|\bпгт\b|\bрп\b|\bст-?ца\b|\bх\.|\bхутор\w*|\bаул\b|\bн\.?\s?п\.|\bрайон\w*|\bр-н\b|\bм\.?\s?р-н|\bг\.?\s?о\.|\bстанци\w+|\bст\.|\bснт\b|Москва|Санкт-Петербург|Севастополь)"
STREET = r"(?:\bул\.|\bулиц\w*|\bпр-?к?т\b|\bпроспект\w*|\bпер\.|\bпереул\w*|\bш\.|\bшоссе\b|\bнаб\w*|\bбул\w*|\bб-р\b|\bпл\.|\bпроезд\w*|\bмкр\w*|\bтер\.|\bтракт\w*|\bкм\b)"
STOPS = (
    "(базовая станция", "(антенны", "(оборудование", "(рес ", "антенны на", "антенн на", "антенн,", "оборудовани", "в термобоксе", "на трубостойк", "на парапет", "на надстройк", "размещается в", "устанавливается",
    ", участок ", ", ртс ", "кадастров", "коорди", "географическ", " н =", " н=", " h=", " h =", "стандарт", "сети ", "сеть ", "диапазон", "частот", "мощност", "высот", "азимут", "владелец", "разработчик",
    "заявитель", "юридический адрес", "инн ", "огрн", "телефон", "соответству", "не соответству", "государственн", "санитарн", "санпин", "для целей", "в составе", "пао ", "ооо ", "гигагерц", "мгц", "заключени", "экспертн",
    "проект сзз", "(протокол", "согласно", "(договор", "выполнен", "разработан",
)
FOREIGN = r"(?:юридический\s+адрес|почтовый\s+адрес|заявител\w+|аккредитованн\w+|разработчик\w*|инспекци\w+|фактический\s+адрес\s+(?:владельца|организации)|центр\w*\s+гигиены)[^\n]{0,40}$"
NEIGHBOUR = r"ближайш\w+\s+жил\w+|жилой\s+дом\s+по|этажн\w+\s+застройк"
UNBUILT = r"не\s+(?:была\s+)?построен"

_UP_TO = r"([^\n]{8,420})"
#: Anchors in order of trust: words in any case, then the address as it is written. The last ones, that need nothing but a
#: region, aren't used on the whole text.
ANCHORS: tuple[tuple[str, str], ...] = (
    (r"адрес\w*\s+(?:размещения|места\s+размещения|объекта|расположения|установки)(?:\s+(?:ПРТО|РЭС|объекта|станции))?\s*[:\-–]\s*", _UP_TO),
    (r"(?:место\w*|местоположение)\s+(?:размещения|расположения|нахождения|установки)?(?:\s+(?:ПРТО|РЭС))?\s*[:\-–]\s*", _UP_TO),
    (r"(?m:^)адрес\s*[:\-–]\s*", _UP_TO),
    (r"по\s+адресу\s*[:\-–]?\s*", _UP_TO),
    (r"(?:размещ\w+|расположенн\w+|установленн\w+|располагается)\s*(?:в|на)?\s*[:\-–]\s*", rf"({REGION}[^\n]{{8,400}})"),
    (r"(?:ПРТО|РЭС|станци\w+|БС)\s[^\n]{0,160}?[,(:]\s*", rf"({REGION}[^\n]{{8,400}})"),
    (r"адрес\s*[:\-–]\s*", _UP_TO),
    (r"\b", rf"(\d{{6}},\s*{REGION}[^\n]{{8,400}})"),
    (r"", rf"({REGION}[,\s][^\n]{{8,400}})"),
)
BROAD = 2

_ANCHORS = tuple(bounded.compile(f"(?i:{words}){rest}") for words, rest in ANCHORS)
_REGION, _PLACE, _STREET = bounded.compile(REGION), bounded.compile(PLACE, re.I), bounded.compile(STREET, re.I)
_FOREIGN, _NEIGHBOUR, _UNBUILT = (bounded.compile(p, re.I) for p in (FOREIGN, NEIGHBOUR, UNBUILT))
_DISTANCE = bounded.compile(r",\s*(?:примерно\s+)?\d+(?:[.,]\d+)?\s*к?м\s+(?:на\s+)?\w*(?:восточ|запад|север|южн|юг)\w*", re.I)
_BY_ADDRESS = bounded.compile(r"^(?P<junk>[^\n]{0,300}?)по\s+адресу\s*:?\s*", re.I)
MOST = 200


def cut(text: str) -> str:
    """Up to the first word that ends an address (one at the very start doesn't), or to a distance that no place follows."""
    low = text.lower()
    stop = min((i for w in STOPS if (i := low.find(w)) > 0), default=len(text))
    for m in _DISTANCE.finditer(text):
        if 5 < m.start() < stop and not re.search(rf"{PLACE}|{STREET}|дом\w*", text[m.end() : m.end() + 90], re.I):
            stop = m.start()
            break
    return text[:stop]


def valid(text: str) -> bool:
    """Whether it names a region and a place or street, and isn't the description of something else."""
    if len(text.strip()) < 10 or re.match(r"\s*(?:филиал|проект|материал|санитар|заключени|№)", text, re.I):
        return False
    return bool(_REGION.search(text)) and bool(_PLACE.search(text) or _STREET.search(text))


# Clean-up, in order.
STEPS: tuple[tuple[str, str], ...] = (
    (r"\s+", " "), (r"^(?:GSM|LTE|UMTS|DCS|NR|IMT|[\d/\-,\s])+(?=[А-ЯЁ])", ""), (r"^(?:базов\w+\s+станци\w+|БС|BTS)\s*№?\s*[\w/-]*\s*(?:\"[^\"]*\")?\s*[,:]?\s*(?=[А-ЯЁ\d])", ""),
    (r"^(?:почтовый\s+индекс\s*:?\s*)?\d{6},?\s*", ""), (r"^[\s,;:.\-–—)]+|[\s,;:\-–—(]+$", ""), (r"(?i)^(?:фактическ\w+\s+)?(?:адрес\w*|расположени\w*)(?:\s+размещения)?(?:\s+БС)?\s*[:\-–]\s*", ""),
    (r"\s*\((?:с\.?ш|координ|wgs)[^)]*\)?", ""), (r"\s*\d{2}[.,]\d{4,}[^,]*,\s*\d{2,3}[.,]\d{4,}.*$", ""), (r"\s*\d{2}°.*$", ""), (r"(?<=[^\W\d]),(?=[А-ЯЁ])", ", "), (r"\s+([,;])", r"\1"), (r",(?:\s*,)+", ","),
    (r"\.{2,}", "."), (r"([\w.\- ]{4,}), \1(?=,|$)", r"\1"), (r"\bРД,", "Республика Дагестан,"), (r"\bРТ,", "Республика Татарстан,"), (r"\bРБ,", "Республика Башкортостан,"), (r"(?:,?\s+(?:в|на|по|у|и|от|с))$", ""),
    (r"\s*\([^)]*$", ""), (r"^[\s,;:.\-–—]+|[\s,;:\-–—]+$", ""),
)
_STEPS = tuple((bounded.compile(p), to) for p, to in STEPS)
CAP = 300


def clean(text: str) -> str:
    """An address without what isn't part of it; the same again gives the same. Cut at 300 characters, with dots."""
    if text.endswith("...") and len(text) == CAP + 3:
        return text
    while True:
        new = text
        for rx, to in _STEPS:
            new = rx.sub(to, new)
        if new.count('"') % 2:  # a quote lost its pair
            new = new[:-1] if new.endswith('"') else new.replace('"', "", 1) if new.startswith('"') else new + '"'
        if new.count("(") < new.count(")"):
            new = new.rstrip(")") + ")" * new.count("(")
        if new == text:
            break
        text = new
    return text if len(text) <= CAP else text[:CAP] + "..."


def _candidate(text: str, broad: bool) -> str | None:
    for rx in _ANCHORS if broad else _ANCHORS[:-BROAD]:
        at = 0
        for _ in range(MOST):
            m = rx.search(text, at)
            if not m:
                break
            at = max(m.end(), m.start() + 1)
            raw = m[1]
            if _FOREIGN.search(text[max(0, m.start(1) - 80) : m.start(1)]) or _UNBUILT.search(raw):
                continue
            if junk := _BY_ADDRESS.match(raw):
                if _NEIGHBOUR.search(junk["junk"]):
                    continue
                raw = raw[junk.end() :]
            raw = cut(raw)
            if valid(raw):
                return clean(raw)
    return None


def _broken(text: str) -> bool:
    """Whether the end seems to be missing: a dash, or a last word that is just the beginning of one."""
    return bool(re.search(r"(?:[-–]|\b(?:Республ|облас|обл|рай|ул|г|д|с|п))\.?$", text))


def address(text: str, head: Sequence[str]) -> str | None:
    """The project's section, if its address is whole; the appendix's, if it goes on with it; what there is of either; an
    anchor anywhere; a line of the head that looks like one."""
    back, front = sections.appendix(text, line_start=True), sections.project(text)
    first = _candidate(front, True) if front else None
    if first and not _broken(first) and _REGION.search(first):
        return first
    second = _candidate(back, True) if back else None
    if second and not _broken(second) and _REGION.search(second):
        words = [w for w in re.split(r"[ ,.]+", first or "") if len(w) >= 4 and w.isalpha()]
        return first if words and words[-1].lower() not in second.lower() else second
    if first or second or (found := _candidate(text, False)):
        return first or second or found
    for line in head:
        if _REGION.search(line) and (_PLACE.search(line) or _STREET.search(line)) and valid(part := cut(line)):
            return clean(part)
    return None
