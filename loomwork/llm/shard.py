"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``vnodes`` points of a 64-bit ring; a key belongs to the first point clockwise. No shard takes
more than its capacity: keys that overflow a full shard continue clockwise to the next point whose shard has
room, the keys of an arc in ring order. With ``load_factor`` 1 the capacities are ceil or floor of rows/shards
and add up to the rows, so counts are at most one apart (the ``rows`` law); a larger factor moves fewer keys.

Only counts per arc (shards * vnodes at most, whatever the data) decide who overflows where; the driver
plays the overflow on them. Rows are ranked within their arc by a range partitioning on ring positions,
which spreads any repeated key over many tasks.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free, local_rows, shuffle_partitions, stored


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ring points (unsigned 64 bit) and the shard of each. The points of a shard don't depend on the others."""
    points = np.array([xxhash.xxh3_64_intdigest(f"shard-{s}-point-{v}") for s in range(shards) for v in range(vnodes)], np.uint64)
    owner = np.repeat(np.arange(shards), vnodes)
    order = np.lexsort((owner, points))
    return points[order], owner[order]


def capacities(rows: int, shards: int, load_factor: float) -> list[int]:
    """At 1: floor or ceil of the mean, together exactly the rows. Above: the factor times the mean, rounded up."""
    if load_factor <= 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int(-(-rows * load_factor // shards))] * shards


def overflow(counts: list[int], owner: list[int], caps: list[int]) -> list[list[tuple[int, int]]]:
    """For each arc the (shard, keys) that it fills, in the order of its keys. In round r each arc offers what it
    has left to the r-th point clockwise; arcs come in ring order, so a shard's own keys come before others'."""
    room = list(caps)
    left = list(counts)
    pieces: list[list[tuple[int, int]]] = [[] for _ in counts]
    n = len(counts)
    active = [a for a in range(n) if left[a]]
    for step in range(n):
        if not active:
            break
        again = []
        for a in active:
            s = owner[(a + step) % n]
            took = min(left[a], room[s])
            if took:
                room[s] -= took
                left[a] -= took
                if pieces[a] and pieces[a][-1][0] == s:
                    pieces[a][-1] = (s, pieces[a][-1][1] + took)
                else:
                    pieces[a].append((s, took))
            if left[a]:
                again.append(a)
        active = again
    return pieces


def _text_key(key: Column) -> Column:
    return F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), F.lit("ring"))


def assign(
    docs: DataFrame, *, key: str = "doc_id", shards: int = 24, vnodes: int = 128, load_factor: float = 1.0, partitions: int | None = None
) -> DataFrame:
    """``key``, size, text_crc32, shard and slot of every row of docs (columns: key, text).

    size is the UTF-8 bytes of the text plus 8, text_crc32 its unsigned CRC-32 (null: of the empty text). slot
    counts from 0 without gaps in each shard, in ring order. Rows with equal or null keys share a ring position
    and are told apart by text and place in the input, so one key may hold any part of the rows. No rows, no
    assignment. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    points, owner = ring(shards, vnodes)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _text_key(F.col(key)).alias("pos"),
        F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)).alias("salt"),
    )
    shared = spark.sparkContext.broadcast(points)

    @F.pandas_udf("int")
    def arc_of(pos: pd.Series) -> pd.Series:
        at = np.searchsorted(shared.value, (pos.to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)), side="left")
        return pd.Series((at % len(shared.value)).astype(np.int32))

    # signed order of pos is the order of the ring after flipping the top bit, as arc_of does
    order = ["pos", "key", "text_crc32", "size", "salt"]
    dealt = rows.repartitionByRange(partitions or shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    placed = stored(
        dealt.select("key", "size", "text_crc32", arc_of("pos").alias("arc"), F.shiftright(row, 33).cast("int").alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    )
    # partitions * arcs in theory, partitions + 2 * arcs in fact: arcs are contiguous on the ring
    found = placed.groupBy("part", "arc").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.max("at").alias("last")).collect()
    # the arc that wraps around the ring's end has two stretches of positions; in one partition they are two runs
    counts: dict[int, int] = defaultdict(int)
    for x in found:
        counts[x.arc] += x.n
    arcs = len(points)
    pieces = overflow([counts[a] for a in range(arcs)], owner.tolist(), capacities(sum(counts.values()), shards, load_factor))

    base: dict[int, int] = defaultdict(int)
    spread: dict[int, list[tuple[int, int, int]]] = {}
    for a in range(arcs):
        at = 0
        spread[a] = []
        for s, n in pieces[a]:
            spread[a].append((at, s, base[s]))  # from this rank on: shard, and its first slot
            at += n
            base[s] += n
    seen: dict[int, int] = defaultdict(int)
    lookup = []
    for x in sorted(found, key=lambda x: (x.part, x.arc)):
        gap = x.last - x.first + 1 - x.n  # rows of other arcs between the two runs of a wrapped arc
        lookup.append((x.part, x.arc, int(x.first), seen[x.arc], gap, [{"rank": a, "shard": int(b), "slot": c} for a, b, c in spread[x.arc]]))
        seen[x.arc] += x.n
    ways = local_rows(spark, lookup, "part int, arc int, first long, before long, gap long, pieces array<struct<rank:long,shard:int,slot:long>>")
    # rank within the arc; a second run in the same partition starts after the gap
    rank = F.col("before") + F.when(F.col("gap") == 0, F.col("at") - F.col("first"))
    ranked = placed.join(F.broadcast(ways), ["part", "arc"])
    if any(x[4] for x in lookup):  # one arc in one partition at most: rank its few rows by a window
        w = Window.partitionBy("part", "arc").orderBy("at")
        wrapped = ranked.filter("gap > 0").withColumn("rank", F.col("before") + F.row_number().over(w) - 1)
        ranked = ranked.filter("gap = 0").withColumn("rank", rank).unionByName(wrapped)
    else:
        ranked = ranked.withColumn("rank", rank)
    piece = F.element_at(F.filter("pieces", lambda p: p["rank"] <= F.col("rank")), -1)
    return (
        ranked.withColumn("piece", piece)
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            F.col("piece.shard").alias("shard"),
            (F.col("piece.slot") + F.col("rank") - F.col("piece.rank")).alias("slot"),
        )
    )


def write_shards(docs: DataFrame, path: str, *, key: str = "doc_id", shards: int = 24, **options: object) -> None:
    """Writes docs as Parquet under ``path/shard=N``, rows in slot order. Keys must be unique here: rows are
    joined to their slots by key. Large shards are split over several tasks by ranges of slots."""
    where = assign(docs, key=key, shards=shards, **options).select(F.col(key).alias(free("shard_key", docs.columns)), "shard", "slot")
    on = where.columns[0]
    joined = docs.join(where, docs[key].eqNullSafe(where[on])).drop(on)
    (
        joined.repartitionByRange(max(shards, shuffle_partitions(docs.sparkSession)), "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .drop("slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )
