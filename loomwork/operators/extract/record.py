"""Documents to records: every field of a text, what is missing, and the flat row of the sink."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.scalars import day, head_lines, moment, point
from loomwork.operators.relational import complete_name_list, parallel_arrays
from loomwork.plans.rules import extract
from loomwork.session import ship

from . import address, coords, heights, number, owner, sections

HEIGHTS = "array<struct<height:double,base:string,antenna:string,antennaNumber:int>>"
FIELDS = f"baseStationNumber string, baseStationAddress string, operator string, coordinates string, antennaHeights {HEIGHTS}, failure string"

#: Fixed value: number and date in a document's head, looser than its name.
NUMBER_AND_DATE = r"(\d{2}\.[А-ЯЁA-Zа-яёa-z0-9]{2,4}\.\d{2}\.\d{3}\.[ТT]\.\d{6}\.\d{2}\.\d{2}\s+от\s+\d{2}\.\d{2}\.\d{4})"


def fields(text: str) -> tuple:
    text = sections.repaired(text)
    head = [x.rstrip("\r") for x in text.split("\n")[:12]]
    where = address.address(text, head)
    found = heights.heights(text)
    return (
        number.station_number(text), where and address.clean(where), owner.operator(text), coords.coordinates(text),
        found and [{"height": h.height, "base": h.base, "antenna": h.antenna, "antennaNumber": h.number} for h in found],
    )


def extracted(text: Column) -> Column:
    """Struct of the fields that need offsets and candidate loops, in one pass over the text. A text on which a rule fails,
    or takes too long, gets null fields and the failure's name; it never stops the batch."""

    @F.pandas_udf(FIELDS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in FIELDS.split(", ")]
        for batch in batches:
            rows = []
            for text in batch:
                try:
                    rows.append((*fields(text or ""), None))
                except (ValueError, RecursionError, OverflowError, TimeoutError) as e:
                    rows.append((None,) * 5 + (f"{type(e).__name__}: {e}",))
            yield pd.DataFrame(rows, columns=names)

    return run(text)


def records(texts: DataFrame) -> DataFrame:
    """Records of (sourceFileName, text): the JSON fields, ``missingFields`` null when complete, and ``failure``."""
    ship(texts.sparkSession)
    head = head_lines(F.col("text"))
    joined = F.array_join(head, " ")
    rows = texts.select(
        "sourceFileName",
        extract(F.trim(head[0]), r"^(\d+)\b").alias("index"),
        extract(joined, f"(?iu){NUMBER_AND_DATE}").alias("documentNumberAndDate"),
        head.alias("rawFirstLines"),
        extracted(F.col("text")).alias("x"),
    ).select("sourceFileName", "index", "documentNumberAndDate", "rawFirstLines", "x.*")
    wanted = {"Index": "index", "DocumentNumberAndDate": "documentNumberAndDate", "BaseStationNumber": "baseStationNumber", "BaseStationAddress": "baseStationAddress", "Operator": "operator"}
    return rows.withColumn("missingFields", complete_name_list({n: F.col(c) for n, c in wanted.items()}))


def split_name(name: Column) -> tuple[Column, Column]:
    """Document number and date; an impossible date is null, the number stays."""
    return extract(name, r"^\s*(\S+)\s+от\s"), day(extract(name, r"от\s+(\d{2}\.\d{2}\.\d{4})"))


def flat(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sink's rows and the rejects. Key parts that the text lacks come from the file name; antennas without a height
    leave all four arrays."""
    number_, date = split_name(F.col("documentNumberAndDate"))
    number2, date2 = split_name(F.regexp_replace("sourceFileName", r"\.\w+$", ""))
    arrays = parallel_arrays(F.col("antennaHeights"), "height", {"height": None, "base": "", "antenna": "", "antennaNumber": 0})
    where = point(F.col("coordinates"))
    when = moment(F.col("processingDate")) if "processingDate" in rows.columns else F.lit(None).cast("timestamp")
    out = rows.select(
        F.coalesce(number_, number2).alias("document_number"),
        F.coalesce(date, date2).alias("document_date"),
        F.col("index").try_cast("bigint").alias("index"),
        F.col("baseStationNumber").alias("station_number"),
        F.col("baseStationAddress").alias("station_address"),
        "operator",
        where["lat"].alias("latitude"),
        where["lon"].alias("longitude"),
        arrays["height"].alias("antenna_heights"),
        arrays["base"].alias("antenna_height_bases"),
        arrays["antenna"].alias("antenna_types"),
        arrays["antennaNumber"].alias("antenna_numbers"),
        F.coalesce("missingFields", F.array().cast("array<string>")).alias("missing_fields"),
        when.alias("processing_date"),
        F.col("sourceFileName").alias("source_file"),
    )
    keyed = F.col("document_number").isNotNull() & F.col("document_date").isNotNull()
    return out.filter(keyed), out.filter(~keyed).select("source_file", F.lit("no key").alias("reason"))
