"""Sources: text, HTML, JSON and zipped files, map extracts, configuration."""

from __future__ import annotations

import io
import json
import os
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.scalars import valid_name
from loomwork.session import ship

RECORD = (
    "sourceFileName string, relativePath string, `index` string, documentNumberAndDate string, baseStationNumber string, baseStationAddress string, coordinates string, operator string, "
    "antennaHeights array<struct<height:double,base:string,antenna:string,antennaNumber:int>>, processingDate string, missingFields array<string>, rawFirstLines array<string>"
)


def file_name(path: Column) -> Column:
    """File name without folder and ending, with percent signs resolved."""
    return F.regexp_replace(F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B"))), r"\.\w+$", "")


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_name", F.trim(file_name(F.col("path")))).filter(valid_name(F.col("doc_name")))


def documents(spark: SparkSession, path: str, ending: str, column: str = "text") -> DataFrame:
    """(doc_name, path, text) of whole files with valid names below a folder; the file listing is filtered by ending."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{ending}").text(path, wholetext=True)
    return _named(rows.select(F.col("value").alias(column), F.col("_metadata.file_path").alias("path"))).select("doc_name", "path", column)


def legacy_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html) of pages in the windows-1251 charset."""
    ship(spark)
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "html": [bytes(x).decode("cp1251", "replace") for x in b["content"]]})

    return rows.mapInPandas(decode, "path string, html string")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON files, one object each; the log of processed files isn't one."""
    rows = spark.read.schema(RECORD).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return rows.select("*", name.alias("_file")).filter("_file <> '_processed.json'").drop("_file")


def zip_entries(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """(volume, entry, content) of the entries of zip files whose names match; entries stream one by one. A volume that isn't a
    readable zip gives one row with a null entry, so that it can be told."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return unzipped(rows, pattern)


def unzipped(volumes: DataFrame, pattern: str = ".*") -> DataFrame:
    """The same of volumes (path, content) that are rows already."""
    ship(volumes.sparkSession)

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rx = re.compile(pattern)
        for b in batches:
            for volume, content in zip(b["path"], b["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for name in sorted(n for n in z.namelist() if rx.search(n)):
                            yield pd.DataFrame({"volume": [volume], "entry": [name], "content": [z.read(name)]})
                except zipfile.BadZipFile:
                    yield pd.DataFrame({"volume": [volume], "entry": [None], "content": [None]})

    return volumes.select("path", "content").mapInPandas(entries, "volume string, entry string, content binary")


def zipped_records(spark: SparkSession, path: str) -> DataFrame:
    """Records in zip volumes; of equal entry names the first volume's counts."""
    from loomwork.operators.relational import first_wins

    entries = zip_entries(spark, path, r"\.json$").filter("entry is not null and entry not like '%_processed.json'")
    once = first_wins(entries, ["entry"], [F.length("volume"), "volume"])
    return once.select(F.from_json(F.decode("content", "utf-8"), RECORD).alias("r")).select("r.*")


def zipped_register(spark: SparkSession, path: str, family: str, tag: str, columns: str) -> DataFrame:
    """Attribute rows of the register's XML files in zips (``NN/FAMILY_...``), parsed as a stream; columns as attribute name and
    type, plus region from the entry's folder."""
    names = [c.split()[0] for c in columns.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xml.etree import ElementTree

        for b in batches:
            for entry, content in zip(b["entry"], b["content"], strict=True):
                rows: list[list] = []
                for _, node in ElementTree.iterparse(io.BytesIO(content)):
                    if node.tag == tag:
                        rows.append([node.get(n.upper()) for n in names] + [int(entry[:2])])
                        node.clear()
                    if len(rows) >= 20_000:
                        yield pd.DataFrame(rows, columns=[*names, "region"])
                        rows = []
                yield pd.DataFrame(rows, columns=[*names, "region"])

    raw = zip_entries(spark, path, rf"^\d{{2}}/{family}_\d{{8}}_").filter("entry is not null")
    text = raw.select("entry", "content").mapInPandas(parse, ", ".join(f"{n} string" for n in names) + ", region int")
    return text.select(*[F.col(c.split()[0]).try_cast(c.split()[1]).alias(c.split()[0]) for c in columns.split(", ")], "region")


def map_extract(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, lat, lon, tags) and ways (nodes, tags) of a map that was extracted to Parquet."""
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/ways")


def settings(text: str, section: str, env: dict[str, str] | None = None) -> dict[str, object]:
    """A section of a JSON file with comments and trailing commas; variables named SECTION__KEY override its values."""
    plain = re.sub(r'("(?:\\.|[^"\\])*")|//[^\n]*|/\*.*?\*/', lambda m: m[1] or "", text, flags=re.S)
    plain = re.sub(r'("(?:\\.|[^"\\])*")|,(?=\s*[}\]])', lambda m: m[1] or "", plain)
    out = dict(json.loads(plain).get(section, {}))
    for name, value in (env if env is not None else os.environ).items():
        head, _, key = name.partition("__")
        if key and head.lower() == section.lower():
            own = next((k for k in out if k.lower() == key.lower()), key)
            try:
                out[own] = json.loads(value)
            except ValueError:
                out[own] = value
    return out


def newest(versions: str) -> dict | None:
    """The entry with the greatest VersionId of a JSON list."""
    return max(json.loads(versions), key=lambda v: v["VersionId"], default=None)
