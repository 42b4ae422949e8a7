"""Incremental runs: new files since the last run, in one batch after the other until none is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.operators.relational import apply_delta, last_wins


def process_new(spark: SparkSession, source: str, schema: T.StructType | str, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, fmt: str = "parquet") -> int:
    """Runs the transformation on files that no earlier run has seen, appends to Parquet and returns the rows written. The
    checkpoint holds what was done, so a run that broke off goes on where it stopped."""
    rows = spark.readStream.schema(schema).format(fmt).load(source)
    query = transform(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return sum(int(p.get("sink", {}).get("numOutputRows", -1)) for p in query.recentProgress if int(p.get("sink", {}).get("numOutputRows", -1)) > 0) or sum(p["numInputRows"] for p in query.recentProgress)


def merge_versions(spark: SparkSession, source: str, schema: T.StructType | str, key: str, version: str, tables: str, checkpoint: str) -> None:
    """Applies deltas (key, version, active, ...) as they arrive, each batch in version order: the last change of a key counts.
    Every batch writes a new table under ``tables``/N, so that a failure leaves the one before; batch N reads N-1."""

    def merge(batch: DataFrame, n: int) -> None:
        last = last_wins(batch, [key], [version]).drop(version)
        path = f"{tables}/{n}"
        if n == 0:
            out = last.filter("active").drop("active")
        else:
            out = apply_delta(spark.read.parquet(f"{tables}/{n - 1}"), last, key)
        out.write.mode("overwrite").parquet(path)

    query = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def rates(events: DataFrame, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Events per second over windows of five minutes that slide by one, on a stream or a table."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    w = F.window(time, "5 minutes", "1 minute")
    return rows.groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n", (F.col("n") / 300).alias("per_second"))


def remaining_seconds(total: int, done: int, rate: float, running: float) -> float | None:
    """Time left at the current rate; unknown in the first twenty seconds or without progress."""
    return (total - done) / rate if rate > 0 and running >= 20 else None
