"""Addresses matched to the register: regions first, over a small table; the rest region by region.

The order of an address's segments matters (what comes before the region is known can't be looked up), so a region's
addresses are walked by a small state machine that holds only that region's index. Regions are dealt to tasks by
a cogroup; a region with very many addresses is salted, its index being repeated per salt.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions.fuzzy import osa
from loomwork.operators import geo
from loomwork.operators.registry import Register, match_houses
from loomwork.session import checkpointed, ship

# Words that tell a segment's kind, compound types, synonyms of types, region abbreviations.
KINDS = {
    "region": "область обл край республика респ ао округ",
    "district": "район р-н рн муниципальный мо го",
    "city": "г город гор",
    "settlement": "с село п пос поселок пгт д дер деревня ст станица аул хутор х рп сл нп сп",
    "territory": "снт тер территория мкр микрорайон промзона квартал",
    "street": "ул улица пер переулок пр-т пр-кт проспект пр ш шоссе наб набережная б-р бульвар проезд тракт аллея линия пл площадь прд пркт бр",
}
COMPOUNDS = (
    ("городской округ", "го"), ("муниципальный округ", "го"), ("муниципальный район", "рн"), ("сельское поселение", "сп"), ("городское поселение", "сп"), ("сельский округ", "го"),
    ("внутригородской район", "рн"), ("рабочий поселок", "рп"), ("поселок городского типа", "пгт"), ("м.о.", " мо "), ("г.о.", " го "), ("м.р-н", " рн "), ("ст-ца", " станица "),
    ("р.п.", " рп "), ("п.г.т.", " пгт "), ("пр-зд", " прд "), ("пр-кт", " пркт "), ("пр-т", " пркт "), ("б-р", " бр "),
)
STREET_TYPES = {"улица": "ул", "ул": "ул", "проспект": "пркт", "пркт": "пркт", "переулок": "пер", "пер": "пер", "проезд": "прд", "прд": "прд", "пр": "пркт прд", "шоссе": "ш", "ш": "ш", "набережная": "наб", "наб": "наб", "бульвар": "бр", "бр": "бр", "площадь": "пл", "пл": "пл", "тракт": "тракт", "аллея": "аллея", "линия": "лн линия"}
PLACE_TYPES = {"г": "г", "город": "г", "с": "с", "село": "с", "п": "п", "пос": "п", "поселок": "п", "рп": "рп пгт", "пгт": "пгт рп", "д": "д", "дер": "д", "деревня": "д", "х": "х", "хутор": "х", "аул": "аул", "станица": "стца ст", "сл": "сл"}
ABBREVIATIONS = {"ур": 18, "рд": 5, "рб": 2, "кбр": 7, "кчр": 9, "рт": 16, "рм": 13, "рх": 19, "рсо": 15, "еао": 79, "хмао": 86, "янао": 89, "нао": 83, "мо": 50, "ло": 47}
GENERIC = frozenset("республика область край округ автономный автономная город".split())
FEDERAL = (77, 78, 92)
LOOK_ALIKE = str.maketrans("aeopcxykmb", "аеорсхукмв")
NONE = "нет"
_KIND_OF = {w: k for k, words in KINDS.items() for w in words.split()}

_LEAD = re.compile(r"^\s*(?:ориентир|адрес|рф|россия|российская\s+федерация)\s*[:.,]?\s*", re.I)
_INDEX = re.compile(r"^\d{6}$")
_BUILDING = re.compile(r"^(?:д|дом|зд|здание|стр|строение|соор|влд|владение|уч|участок|корп|корпус)?\.?\s*№?\s*(\d+\s?[а-яa-z]?(?:\s?[/-]\s?\d+[а-яa-z]?)?(?:\s*(?:к|корп|корпус|стр|строение|лит|литера)\.?\s*\w+)*)$", re.I)
_MORE = re.compile(r"^(корп|корпус|к|стр|строение|лит|литера|пом|оф)\.?\s*([\w-]+)$|^(\d{1,3}[а-я]?)$", re.I)
_TAIL = re.compile(r"\s(?:д|дом)\.?\s*(\d+\s?[а-я]?(?:/\d+)?)$", re.I)
_DISTANCE = (re.compile(r"^(?:в\s+)?\d{1,3}$", re.I), re.compile(r"^\d{1,3}\s*(?:км|м)\b", re.I))


def key_of(name: str) -> str:
    low = name.lower().replace("ё", "е").translate(LOOK_ALIKE)
    return " ".join(sorted(re.sub(r"[^\w-]+|_", " ", low).replace("-", " ").split()))


@dataclass(frozen=True)
class Segment:
    text: str
    kind: str | None
    key: str
    marker: str | None


def classify(text: str) -> Segment:
    low = text.lower().replace("ё", "е").translate(LOOK_ALIKE)
    for a, b in COMPOUNDS:
        low = low.replace(a, b)
    kind = marker = None
    words = []
    for w in re.sub(r"[^\w-]+|_", " ", low).split():
        bare = w.strip("-")
        k = _KIND_OF.get(bare)
        if k is None:
            if len(bare) > 1 or bare.isdigit():
                words.append(bare)
        elif kind is None:
            kind, marker = k, bare
        elif k == kind == "street" or (k == kind == "settlement" and words):
            words.append(bare)  # a type word inside a name
    return Segment(text, kind, key_of(" ".join(words)), marker)


def segments(raw: str) -> list[str]:
    raw = _LEAD.sub("", raw).replace(" (", ", (")
    out: list[str] = []
    parts = [p.strip() for p in re.split("[,;]", raw) if p.strip()]
    k = 0
    while k < len(parts):
        if k + 1 < len(parts) and _DISTANCE[0].match(parts[k]) and _DISTANCE[1].match(parts[k + 1]):
            out.append(f"{parts[k]},{parts[k + 1]}")  # a distance that its decimal comma had split
            k += 1
        else:
            out.append(parts[k])
        k += 1
    return out


@dataclass(frozen=True)
class Node:
    id: int
    guid: str
    name: str
    type: str
    level: int
    group: int
    up: tuple[int, ...]

    @property
    def type_key(self) -> str:
        return "".join(c for c in self.type.lower() if c.isalpha())

    def full(self) -> str:
        name = self.name.strip(" -")
        if GENERIC & set(key_of(name).split()):
            return name
        after = self.level < 4 and re.search(r"(?:ий|ый|ая|яя|ое|ье)$", name)
        return f"{name} {self.type}".strip() if after else f"{self.type} {name}".strip()


@dataclass
class RegionIndex:
    """One region's objects by level group and name key."""

    root: Node | None
    by_key: dict[tuple[int, str], list[Node]]
    names: dict[int, list[str]] = field(default_factory=dict)

    def root_words(self) -> set[str]:
        return set(key_of(self.root.name).split()) if self.root else set()

    def under(self, node: Node, top: Node) -> bool:
        return top.id in node.up

    def near(self, group: int, key: str) -> list[Node]:
        """Objects of the one name that is closest within the allowed edits; none if two are as close."""
        limit = max(1, len(key) // 5)
        best, found = limit + 1, []
        for name in self.names.get(group, ()):
            if abs(len(name) - len(key)) <= limit and (d := osa(key, name, limit)) <= limit:
                if d < best:
                    best, found = d, [name]
                elif d == best:
                    found.append(name)
        return self.by_key[group, found[0]] if len(found) == 1 else []

    def find(self, group: int, key: str, *, fuzzy: bool = True, marker: str | None = None, strict: bool = False, hint: Node | None = None) -> Node | None:
        if not key:
            return None
        nodes = self.by_key.get((group, key), [])
        types = PLACE_TYPES.get(marker or "", "").split()
        if nodes and types:
            typed = [n for n in nodes if n.type_key in types]
            nodes = typed if typed or strict else nodes
        if nodes:
            below = [n for n in nodes if hint and self.under(n, hint)]
            return (below or nodes)[0]
        return next(iter(self.near(group, key)), None) if fuzzy and not strict else None

    def street(self, key: str, anchor: Node | None, marker: str | None) -> Node | None:
        if not key:
            return None
        nodes = self.by_key.get((8, key), [])
        types = STREET_TYPES.get(marker or "", "").split()
        nodes = [n for n in nodes if n.type_key in types] or nodes if types else nodes
        if nodes:
            if anchor is None:
                return nodes[0] if len(nodes) == 1 else None
            below = [n for n in nodes if self.under(n, anchor)]
            if len(below) > 1 and anchor.level == 1:
                below = [n for n in below if len(n.up) == 1]  # the city's own, not an enclave's
                return below[0] if len(below) == 1 else None
            if below:
                return below[0]
            if len(nodes) == 1:
                return nodes[0]
        if anchor is None:
            return None
        if not nodes and (close := [n for n in self.near(8, key) if self.under(n, anchor)]) and len(close) == 1:
            return close[0]
        words = set(key.split())
        wider = [n for (g, k), own in self.by_key.items() if g == 8 and words < set(k.split()) and len(k.split()) - len(words) <= 3 for n in own if self.under(n, anchor)]
        return wider[0] if len(wider) == 1 else None


@dataclass
class Found:
    region: Node | None = None
    district: Node | None = None
    place: Node | None = None
    city: str | None = None
    territory: Node | None = None
    street: Node | None = None
    building: str | None = None
    extra: list[str] = field(default_factory=list)


def walk(raw: str, index: RegionIndex, at: int) -> Found:
    """The segments of an address, the one at ``at`` having told the region; what comes before it stays unresolved unless it
    is itself a place or district."""
    f = Found(region=index.root)
    anchor = index.root if index.root and index.root.type_key == "г" else None
    for k, text in enumerate(segments(raw)):
        if f.building and (m := _MORE.match(text)):
            f.building += f", {m[1].lower().rstrip('.')}. {m[2]}" if m[1] else f", {m[3]}"
            continue
        head, _, rest = text.partition("(")
        if not f.building and (f.street or f.place) and (m := _BUILDING.match(head.strip())):
            f.building = m[1].strip()
            if rest:
                f.extra.append(f"({rest}")
            continue
        if _INDEX.match(text):
            continue
        tail = None if f.building else _TAIL.search(text)
        seg = classify(text[: tail.start()] if tail else text)
        if k < at and seg.kind not in ("district", "city", "settlement"):
            f.extra.append(text)
            continue
        node = None
        if k == at and index.root_words() & set(seg.key.split()):
            left = " ".join(w for w in seg.key.split() if w not in index.root_words() and w not in _KIND_OF)
            if left:
                f.district = f.district or index.find(2, left, fuzzy=False)
                f.place = f.place or (None if f.district else index.find(4, left, fuzzy=False))
            continue
        if k == at and seg.key in ABBREVIATIONS:
            continue
        if seg.kind != "street" and seg.key and seg.key.replace(" ", "").isdigit():
            f.extra.append(text)
            continue
        top = f.place or f.territory or f.district or anchor
        if seg.kind == "district":
            node = index.find(2, seg.key) or (index.find(4, seg.key, fuzzy=False) if seg.marker in ("го", "мо") else None)
        elif seg.kind in ("city", "settlement"):
            node = (
                index.find(4, seg.key, marker=seg.marker, strict=True, hint=f.district) or index.find(2, seg.key, marker=seg.marker, strict=True)
                or index.find(4, seg.key, marker=seg.marker, hint=f.district) or index.find(2, seg.key, fuzzy=False, marker=seg.marker)
            )
        elif seg.kind == "territory":
            node = index.find(7, seg.key)
        elif seg.kind == "street":
            node = index.street(seg.key, top, seg.marker)
        elif seg.kind is None:
            node = index.find(4, seg.key) or index.find(2, seg.key) or index.street(seg.key, top, None)
        if node is None:
            f.extra.append(text)
            continue
        if node.group == 2 and node.type_key == "г":
            f.place = f.place or node
        elif node.group == 2:
            f.district = f.district or node
        elif node.group == 4:
            if f.place and index.under(node, f.place):
                f.city = f.place.name if f.place.level == 5 or f.place.type_key == "г" else f.city
                f.place = node
            elif f.place and f.place.type_key == "сп" and node.level in (5, 6):
                f.place = node
            else:
                f.place = f.place or node
        elif node.group == 7:
            f.territory = f.territory or node
        else:
            f.street = f.street or node
        if tail:
            f.building = f.building or tail[1].strip()
    return f


ADDRESS = "id long, regionCode int, region string, district string, city string, settlement string, territory string, street string, streetId long, building string, extra string, matchLevel string, guid string"


def _row(id_: int, code: int, f: Found) -> tuple:
    level, deepest = NONE, None
    city, settlement = f.city, None
    for name, node in (("регион", f.region), ("район", f.district), ("", f.place), ("территория", f.territory), ("улица", f.street)):
        if node is None:
            continue
        if node is f.place:
            name = "город" if node.level == 5 or node.type_key == "г" else "населённый пункт"
            if name == "город":
                city = node.name
            else:
                settlement = node.full()
        level, deepest = name, node
    full = lambda n: n.full() if n else None
    return (id_, code, full(f.region), full(f.district), city, settlement, full(f.territory), full(f.street), f.street.id if f.street else None, f.building, ", ".join(f.extra) or None, level, deepest.guid if deepest else None)


def _index_of(nodes: pd.DataFrame) -> RegionIndex:
    by_key: dict[tuple[int, str], list[Node]] = defaultdict(list)
    root = None
    for x in nodes.sort_values("objectid").itertuples():
        node = Node(int(x.objectid), x.guid, x.name, x.type, int(x.level), int(x.grp), tuple(int(a) for a in x.ancestors))
        if node.level == 1:
            root = root or node
        by_key[node.group, key_of(node.name)].append(node)
    names: dict[int, list[str]] = defaultdict(list)
    for g, k in by_key:
        names[g].append(k)
    return RegionIndex(root, dict(by_key), dict(names))


#: Regions, districts and cities that may be sent to every task; a country has some thousands.
MOST_PLACES = 200_000


def resolve_regions(addresses: DataFrame, index: DataFrame) -> DataFrame:
    """addresses (id, address) with the region's code and the number of the segment that tells it: an abbreviation, a region's
    or federal city's name, a city or district that only one region has. Null where nothing does."""
    spark = addresses.sparkSession
    ship(spark)
    wanted = index.filter("level <= 3 or lower(type) in ('г', 'г.')").select("region", "level", "name", "type")
    rows = wanted.limit(MOST_PLACES + 1).collect()
    if len(rows) > MOST_PLACES:
        raise ValueError(f"over {MOST_PLACES} regions, districts and cities: not a country's register")
    regions: dict[str, int] = {}
    cities: dict[str, set[int]] = defaultdict(set)
    districts: dict[str, set[int]] = defaultdict(set)
    for r in rows:
        if r.level == 1:
            regions.setdefault(key_of(r.name), r.region)
    for r in rows:
        if r.level == 1:
            for w in key_of(r.name).split():
                if len(w) > 3 and w not in GENERIC:
                    regions.setdefault(w, r.region)
        elif "".join(c for c in r.type.lower() if c.isalpha()) == "г":
            cities[key_of(r.name)].add(r.region)
        else:
            districts[key_of(r.name)].add(r.region)
    shared = spark.sparkContext.broadcast((regions, dict(cities), dict(districts)))

    @F.pandas_udf("code int, at int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        regions, cities, districts = shared.value

        def told(raw: str | None) -> tuple[int | None, int | None]:
            for k, text in enumerate(segments(raw or "")):
                seg = classify(text)
                if seg.key in ABBREVIATIONS:
                    return ABBREVIATIONS[seg.key], k
                if seg.kind in ("region", "city", None):
                    code = regions.get(seg.key)
                    if code is None and seg.kind != "city":
                        code = next((regions[w] for w in seg.key.split() if len(w) > 3 and w in regions), None)
                    if code is not None:
                        return code, k
                if seg.kind in ("city", None) and len(own := cities.get(seg.key, ())) == 1:
                    return next(iter(own)), k
                if seg.kind == "district" and len(own := districts.get(seg.key, ())) == 1:
                    return next(iter(own)), k
            return None, None

        for batch in batches:
            yield pd.DataFrame([told(x) for x in batch], columns=["code", "at"]).astype("Int32")

    return addresses.withColumn("r", run.asNondeterministic()("address")).select("*", F.col("r.code").alias("code"), F.col("r.at").alias("at")).drop("r")


def _keys(addresses: DataFrame) -> DataFrame:
    """id, kind, key of the districts and places that addresses (id, address) name."""

    @F.pandas_udf("array<struct<kind:string,key:string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = []
            for raw in batch:
                own = [classify(t) for t in segments(raw or "")]
                rows.append([{"kind": "district" if x.kind == "district" else "place", "key": x.key} for x in own if x.key and x.kind in ("district", "city", "settlement", None)])
            yield pd.Series(rows)

    return addresses.select("id", F.explode(run("address")).alias("x")).select("id", "x.kind", "x.key").distinct()


def resolve_homonyms(addresses: DataFrame, index: DataFrame) -> DataFrame:
    """id and code of addresses (id, address) whose district many regions have, but one only with a settlement of that name too
    that lies in it. By joins on names; where two regions fit, none is told."""
    ship(addresses.sparkSession)

    @F.pandas_udf("string")
    def key(names: pd.Series) -> pd.Series:
        return names.map(lambda n: key_of(n or ""))

    named = index.filter("grp in (2, 4)").select("objectid", "region", "grp", "ancestors", key("name").alias("key"))
    said = _keys(addresses)
    district = said.filter("kind = 'district'").select("id", "key").join(named.filter("grp = 2").select("key", "region", F.col("objectid").alias("top")), "key").select("id", "region", "top")
    place = said.filter("kind = 'place'").select("id", "key").join(named.filter("grp = 4").select("key", "region", "ancestors"), "key").select("id", "region", "ancestors")
    met = district.join(place, ["id", "region"]).filter(F.array_contains("ancestors", F.col("top")))
    found = met.groupBy("id").agg(F.min("region").alias("code"), F.max("region").alias("other"))
    return found.filter("code = other").select("id", "code")


def with_houses(found: DataFrame, register: Register) -> DataFrame:
    """Matched addresses with their house where the register has it: level ``дом``, the house's guid, and houseId."""
    asked = found.filter("streetId is not null and building is not null").select("id", F.col("streetId").alias("street"), "building")
    homes = match_houses(asked, register).select("id", F.col("house").alias("houseId")).join(register.houses.groupBy(F.col("objectid").alias("houseId")).agg(F.min("guid").alias("_guid")), "houseId")
    met = found.join(homes, "id", "left")
    there = F.col("houseId").isNotNull()
    return met.withColumn("matchLevel", F.when(there, "дом").otherwise(F.col("matchLevel"))).withColumn("guid", F.coalesce("_guid", "guid")).drop("_guid")


def located(found: DataFrame, places: DataFrame, streets: DataFrame) -> DataFrame:
    """Matched addresses with lat and lon of those that reach their house, by the map's street or place; null for all others."""
    asked = found.filter("matchLevel = 'дом'").select("id", F.coalesce("city", F.regexp_replace("settlement", r"^\S+\.\s*", "")).alias("place"), F.regexp_replace("street", r"^\S+\.?\s+", "").alias("street"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"))
    return found.join(geo.locate(asked, places, streets).select("id", "lat", "lon"), "id", "left")


def canonical_names(points: DataFrame, index: DataFrame) -> DataFrame:
    """points (id, code, place, street as the map's keys) with the register's names of the place and of the street under it: placeName,
    streetName; null where the region has none, or two."""
    own = index.select("region", "grp", "objectid", "ancestors", F.concat_ws(" ", "type", "name").alias("full"), geo.key(F.col("name")).alias("key"))
    place = points.join(own.filter("grp = 4").select(F.col("region").alias("code"), F.col("key").alias("place"), "objectid", "full"), ["code", "place"])
    place = place.groupBy("id").agg(F.min("objectid").alias("top"), F.max("objectid").alias("_other"), F.min("full").alias("placeName")).filter("top = _other").drop("_other")
    street = points.join(place, "id").join(own.filter("grp = 8").select(F.col("region").alias("code"), F.col("key").alias("street"), "ancestors", "full", "objectid"), ["code", "street"]).filter(F.array_contains("ancestors", F.col("top")))
    street = street.groupBy("id").agg(F.min("full").alias("streetName"), F.min("objectid").alias("_lo"), F.max("objectid").alias("_hi")).filter("_lo = _hi").select("id", "streetName")
    return points.join(place.drop("top"), "id", "left").join(street, "id", "left")


def match_addresses(addresses: DataFrame, index: DataFrame, *, salts: int = 1) -> DataFrame:
    """Structured addresses of (id, address). index: as made by registry.index. Addresses without a region, null and empty
    ones have level ``нет``."""
    ship(addresses.sparkSession)
    index = checkpointed(index)
    told = checkpointed(resolve_regions(addresses.select("id", "address"), index))
    # an address that names no region counts as told before its first segment, if its district and settlement tell one
    more = resolve_homonyms(told.filter("code is null").select("id", "address"), index).select("id", F.col("code").alias("_code"))
    told = told.join(more, "id", "left").withColumn("at", F.when(F.col("code").isNull() & F.col("_code").isNotNull(), F.lit(-1)).otherwise(F.col("at"))).withColumn("code", F.coalesce("code", "_code")).drop("_code")
    asked = told.filter("code is not null").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    nodes = index.select("objectid", "guid", "name", "type", "level", "grp", "ancestors", F.col("region").alias("code")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = [x.split()[0] for x in ADDRESS.split(", ")]
        own = _index_of(b)
        rows = [_row(int(x.id), int(x.code), walk(x.address, own, int(x.at))) for x in a.itertuples()]
        return pd.DataFrame(rows, columns=names).astype({"regionCode": "Int32", "streetId": "Int64"}).replace({np.nan: None})

    found = asked.groupBy("code", "salt").cogroup(nodes.groupBy("code", "salt")).applyInPandas(match, ADDRESS)
    nulls = {x.split()[0]: x.split()[1] for x in ADDRESS.split(", ")}
    lost = told.filter("code is null").select(*[
        F.col("id").cast("long") if n == "id" else F.lit(NONE).alias(n) if n == "matchLevel" else F.col("address").alias(n) if n == "extra" else F.lit(None).cast(t).alias(n) for n, t in nulls.items()
    ])
    return found.unionByName(lost)
