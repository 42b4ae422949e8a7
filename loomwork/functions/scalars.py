"""Scalar functions on columns: numbers, dates, geometry, keys of names and houses, slices of documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.plans.rules import UNICODE, extract

# --- numbers and dates


def half_even(x: Column, digits: int) -> Column:
    """Rounds half to even after scaling, as IEEE arithmetic does."""
    scale = 10.0**digits
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def decimal(text: Column) -> Column:
    """Number with a comma or point and stray spaces; null if it is none."""
    return F.translate(text, ", ", ".").try_cast("double")


def degrees(d: Column, m: Column, s: Column) -> Column:
    """Degrees, minutes and seconds as degrees; null if minutes reach 60 or seconds pass it."""
    d, m, s = (F.coalesce(decimal(x), F.lit(0.0)) if k else decimal(x) for k, x in enumerate((d, m, s)))
    return F.when((m < 60) & (s <= 60), d + m / 60 + s / 3600)


def day(text: Column) -> Column:
    """dd.MM.yyyy as a date; null for a day that doesn't exist."""
    return F.try_to_date(text, "dd.MM.yyyy")


def month(text: Column) -> Column:
    """MM.yyyy as the month's first day."""
    return F.try_to_date(F.concat(F.lit("01."), text), "dd.MM.yyyy")


def moment(text: Column) -> Column:
    """A processing time in one of four spellings; zone and fraction are left out. Null if it is none."""
    plain = F.substring(F.regexp_replace(F.trim(text), r"(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$", ""), 1, 19)
    forms = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy HH:mm:ss", "yyyy-MM-dd")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in forms])


# --- geometry


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of radius 6371 km."""
    rad = 3.141592653589793 / 180
    a = F.pow(F.sin((lat2 - lat1) * rad / 2), 2) + F.cos(lat1 * rad) * F.cos(lat2 * rad) * F.pow(F.sin((lon2 - lon1) * rad / 2), 2)
    return 2 * 6371.0 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def cell(x: Column) -> Column:
    """Cell of a grid of twentieths of a degree, towards zero."""
    return (x * 20).cast("int")


def point(text: Column) -> Column:
    """"lat, lon" as a struct; null unless there are exactly two numbers."""
    parts = F.split(text, ",")
    lat, lon = F.trim(parts[0]).try_cast("double"), F.trim(F.get(parts, F.lit(1))).try_cast("double")
    return F.when((F.size(parts) == 2) & lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def plausible(lat: Column, lon: Column) -> Column:
    """Whether a point lies in the country's ranges of latitude and longitude (beyond 180 degrees, too)."""
    return lat.between(41, 82) & (lon.between(19, 190) | lon.between(-180, -168)) & (lat != lon)


# --- document names and slices

#: Fixed value: the form of a document's name, its number and date.
NAME = r"^\d{2}\.[А-ЯЁA-Z0-9]{2}\.\d{2}\.\d{3}\.[ТT]\.\d{6}\.\d{2}\.\d{2} от \d{2}\.\d{2}\.\d{4}$"


def valid_name(name: Column) -> Column:
    return F.coalesce(F.trim(name).rlike(NAME), F.lit(False))


def safe_name(text: Column) -> Column:
    """A term as a folder name."""
    return F.regexp_replace(text, r'[\\/:*?"<>|\x00-\x1f]', "_")


def head_lines(text: Column, n: int = 12) -> Column:
    return F.transform(F.slice(F.split(text, "\n"), 1, n), lambda x: F.rtrim(x, F.lit("\r")))


def after(text: Column, mark: str, *, fold: bool = False, line_start: bool = False) -> Column:
    """The text from the first ``mark`` on; null without it."""
    regex = f"(?s{'iu' if fold else ''}U){'(?m:^)' if line_start else ''}{mark}.*"
    return F.nullif(F.regexp_extract(text, regex, 0), F.lit(""))


def project_section(text: Column) -> Column:
    """From the project's heading to the word of conformity, else 1500 characters."""
    tail = after(text, "Проектная документация", fold=True)
    stop = F.locate("СООТВЕТСТВУЕТ", tail)
    return F.when(stop > 0, F.substring(tail, F.lit(1), stop - 1)).otherwise(F.substring(tail, 1, 1500))


def appendix(text: Column, line_start: bool = False) -> Column:
    return after(text, "Приложение", line_start=line_start)


def without(text: Column, sections: list[Column]) -> Column:
    """The first section that exists, else the text."""
    return F.coalesce(*sections, text)


# --- keys of names

#: Latin letters and the Cyrillic ones that look alike; rewrites of names; generic words.
LOOK_ALIKE = ("aeopcxykmb", "аеорсхукмв")
NAME_REWRITES = ((r"\bп\.\s*с\.", "поселок сельского типа "), (r"\bв\.\s*о\.", "васильевского острова "), (r"\bим\.|\bимени\b", " "))


def fold_case(text: Column) -> Column:
    return F.translate(F.lower(text), "ё", "е")


def sorted_words(text: Column) -> Column:
    """Words in code-point order, so that their order doesn't matter."""
    return F.array_join(F.array_sort(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")), " ")


def name_key(name: Column) -> Column:
    """Key of a place's or street's name: folded, look-alikes in Cyrillic, abbreviations opened, words sorted."""
    text = F.translate(fold_case(name), *LOOK_ALIKE)
    for pattern, to in NAME_REWRITES:
        text = F.regexp_replace(text, UNICODE + pattern, to)
    return sorted_words(F.regexp_replace(text, r"(?U)[^\w-]+", " "))


def plain_key(name: Column, generic: tuple[str, ...] = ()) -> Column:
    """The map's key of a name: folded, Latin letters kept, generic words dropped, words sorted."""
    words = F.filter(F.split(F.regexp_replace(fold_case(name), r"(?U)[^\w-]+", " "), " "), lambda w: (w != "") & ~w.isin(*generic) if generic else w != "")
    return F.array_join(F.array_sort(words), " ")


#: Words of house numbers that don't tell houses apart.
HOUSE_WORDS = "корпус|корп|строение|стр|литера|лит|дом"


def house_key(number: Column) -> Column:
    """Letters and digits of a house number, in small letters, without the words for its parts."""
    return F.regexp_replace(F.regexp_replace(F.lower(number), HOUSE_WORDS, ""), r"(?U)[^\p{L}\p{Nd}]+", "")


def lead_number(number: Column) -> Column:
    """The number that comes first, with its letter."""
    return F.trim(extract(F.lower(number), r"^(\s*\d+[а-яa-z]?)"))


def level_group(level: Column) -> Column:
    """Regions and districts, towns and settlements, planning units, streets."""
    return F.when(level <= 3, 2).when(level <= 6, 4).when(level == 7, 7).otherwise(8)
