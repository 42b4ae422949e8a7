"""Sinks: records as JSON, zip volumes, the analytical table, rejects, schema changes."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.operators.relational import last_wins, not_done
from loomwork.session import ship

VOLUME = 10_000


def to_json(rows: DataFrame) -> DataFrame:
    """(name, json) of records, without their null fields."""
    return rows.select(F.col("sourceFileName").alias("name"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "true"}).alias("json"))


def write_json(rows: DataFrame, path: str) -> None:
    """Records as JSON lines, at most a volume's worth in a file; Spark's commit makes a file appear whole or not at all."""
    to_json(rows).select("json").write.mode("overwrite").option("maxRecordsPerFile", VOLUME).text(path)


def zip_volumes(named: DataFrame, per_volume: int = VOLUME) -> DataFrame:
    """(volume, content) of (name, json): zip archives of at most so many entries each. Volumes are dealt by the names' hash, each
    a row; the caller stores them (content is bounded by the entries of one volume)."""
    ship(named.sparkSession)
    n = max(1, -(-named.count() // per_volume) * 5 // 4)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"name": [], "json": [], "volume": []}), *batches])
        for volume, part in rows.sort_values(["volume", "name"]).groupby("volume"):
            for k in range(0, len(part), per_volume):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    for name, text in zip(part["name"][k : k + per_volume], part["json"][k : k + per_volume], strict=True):
                        z.writestr(zipfile.ZipInfo(f"{name}.json"), text)
                yield pd.DataFrame({"volume": [f"part{int(volume)}-{k // per_volume}.zip"], "content": [out.getvalue()]})

    dealt = named.withColumn("volume", F.pmod(F.xxhash64("name"), F.lit(n))).repartition(n, "volume")
    return dealt.select("name", "json", "volume").mapInPandas(pack, "volume string, content binary")


def upsert_table(current: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The table by document number and date after new rows: the latest processing wins, then the greater file name."""
    both = rows if current is None else current.unionByName(rows, allowMissingColumns=True)
    return last_wins(both, ["document_number", "document_date"], ["processing_date", "source_file"])


def valid_and_rejected(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that can be loaded, and the others with the reason; a bad row never stops the load."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda c: c.isNotNull())
    told = rows.withColumn("reason", F.array_join(missing, ","))
    return told.filter("reason = ''").drop("reason"), told.filter("reason <> ''")


def dead_letters(failed: DataFrame, previous: DataFrame | None, inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Failed documents (doc_name, stage, reason), and the inputs of the next run: what is new and, once, what failed."""
    retry = not_done(inputs, failed, ["doc_name"]) if previous is None else not_done(inputs, previous.join(failed, "doc_name", "left_semi"), ["doc_name"])
    return failed.dropDuplicates(["doc_name"]), retry


def reconcile(table: T.StructType, wanted: T.StructType) -> tuple[str, list[T.StructField]]:
    """What a table needs to take rows of the wanted schema: nothing, added columns, or to be made anew where types differ."""
    own = {f.name.lower(): f.dataType for f in table}
    if any(f.name.lower() in own and own[f.name.lower()] != f.dataType for f in wanted):
        return "recreate", list(wanted)
    added = [f for f in wanted if f.name.lower() not in own]
    return ("add" if added else "none"), added


def jdbc_options(url: str, table: str, batch: int = 5000) -> dict[str, str]:
    """Options for writing to a database in batches."""
    return {"url": url, "dbtable": table, "batchsize": str(batch), "isolationLevel": "NONE"}
