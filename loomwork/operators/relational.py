"""Relational operators of the document pipeline: keyed sinks, incremental reads, resolution, nearest points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions.scalars import cell, haversine_km

# --- keyed writes


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in the order; ties are broken by it, so give one that tells all rows apart."""
    return _best(rows, keys, [F.col(o).asc() if isinstance(o, str) else o for o in order])


def last_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in the order: what an upsert of all rows would leave."""
    return _best(rows, keys, [F.col(o).desc_nulls_last() for o in order])


def _best(rows: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # a rank filter of one is turned into a group limit before the shuffle, so hot keys don't move whole
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def not_done(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no output yet."""
    return rows.join(done.select(*keys).distinct(), list(keys), "left_anti")


def apply_delta(base: DataFrame, delta: DataFrame, key: str, active: str = "active") -> DataFrame:
    """base after one ordered batch of changes: active rows replace or are added, inactive ones delete."""
    fresh = delta.filter(F.col(active)).drop(active)
    return base.join(delta.select(key), key, "left_anti").unionByName(fresh)


def complete_parts(inputs: DataFrame, outputs: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Counts of inputs and outputs by part, and whether a part is complete and may be skipped."""
    a = inputs.groupBy(*parts).agg(F.count("*").alias("n_in"))
    b = outputs.groupBy(*parts).agg(F.count("*").alias("n_out"))
    joined = a.join(b, list(parts), "left").withColumn("n_out", F.coalesce("n_out", F.lit(0).cast("long")))
    return joined.withColumn("complete", (F.col("n_out") > 0) & (F.col("n_in") == F.col("n_out")))


# --- resolution


def unique_only(candidates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The value of each key that has exactly one; ties are refused."""
    found = candidates.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_other"))
    return found.filter(F.col(value) == F.col("_other")).drop("_other")


def nearest_unique(pairs: DataFrame, keys: Sequence[str], distance: str, value: str) -> DataFrame:
    """The value at the least distance, unless two values share it."""
    x = pairs.groupBy(*keys).agg(
        F.min(F.struct(distance, value)).alias("lo"), F.max(F.struct((-F.col(distance)).alias("d"), F.col(value).alias("v"))).alias("hi")
    )
    return x.filter(F.col(f"lo.{value}") == F.col("hi.v")).select(*keys, f"lo.{distance}", f"lo.{value}")


def ancestors(nodes: DataFrame, key: str, parent: str, depth: int = 8) -> DataFrame:
    """nodes with an array ``ancestors`` from the parent up, at most ``depth`` of them, in as many joins at most."""
    links = nodes.select(F.col(key).alias("_node"), F.col(parent).alias("_up"))
    out = nodes.select("*", F.col(parent).alias("_at"), F.array().cast("array<bigint>").alias("ancestors"))
    for _ in range(depth):
        out = out.withColumn("ancestors", F.when(F.col("_at").isNotNull(), F.concat("ancestors", F.array(F.col("_at").cast("bigint")))).otherwise(F.col("ancestors")))
        out = out.join(links, out["_at"] == links["_node"], "left").drop("_at", "_node").withColumnRenamed("_up", "_at")
    return out.drop("_at")


def blocks_of(key: Column, width: int = 2) -> Column:
    """Blocking keys of a name for fuzzy joins: its grams of ``width`` letters with a mark at either end."""
    text = F.concat(F.lit("^"), key, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(text) - width + 1)), lambda i: F.substr(text, i, F.lit(width))))


# --- nearest points on a grid


def around(lat: Column, lon: Column) -> Column:
    """The nine cells around a point, as an array of (cx, cy)."""
    cx, cy = cell(lat), cell(lon)
    return F.array(*[F.struct((cx + i).alias("cx"), (cy + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])


def nearest_on_grid(points: DataFrame, places: DataFrame, key: str, place: str) -> DataFrame:
    """For each point (key, lat, lon) the nearest place (place, lat, lon) of the nine cells around it, with ``km``; the
    smaller name of two as near. Points without any place nearby have no row. An equi-join on cells, never all pairs."""
    near = points.select(key, "lat", "lon", F.explode(around(F.col("lat"), F.col("lon"))).alias("c")).select(key, "lat", "lon", "c.cx", "c.cy")
    there = places.select(F.col(place), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), cell(F.col("lat")).alias("cx"), cell(F.col("lon")).alias("cy"))
    met = near.join(there, ["cx", "cy"]).withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    return met.groupBy(key).agg(F.min(F.struct("km", place)).alias("x")).select(key, f"x.{place}", "x.km")


def space_cell(lat: Column, lon: Column, km: float) -> Column:
    """Cell of a cubic grid in space, ``km`` wide, that a point of the sphere lies in: points within ``km`` are in neighbouring cells,
    at any latitude."""
    a, o = F.radians(lat), F.radians(lon)
    x, y, z = F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)
    return F.struct(*[F.floor(v * F.lit(6371.0 / km)).alias(n) for v, n in ((x, "cx"), (y, "cy"), (z, "cz"))])


def nearest_within(points: DataFrame, places: DataFrame, key: str, place: str, same: Sequence[str], most_km: float) -> DataFrame:
    """For each point (key, same, lat, lon) the nearest place (place, same, lat, lon) with equal ``same`` within ``most_km``, with ``km``;
    the smaller place of two as near, never the point's own key. A join on cells, so that a name that many share is no one key."""
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
    near = points.select(key, *same, "lat", "lon", space_cell(F.col("lat"), F.col("lon"), most_km).alias("c"), around.alias("d"))
    near = near.select(key, *same, "lat", "lon", *[(F.col(f"c.{c}") + F.col(f"d.{d}")).alias(c) for c, d in (("cx", "i"), ("cy", "j"), ("cz", "k"))])
    there = places.select(place, *same, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), space_cell(F.col("lat"), F.col("lon"), most_km).alias("c")).select("*", "c.*").drop("c")
    met = near.join(there, [*same, "cx", "cy", "cz"]).filter(F.col(key) != F.col(place)).withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    return met.filter(F.col("km") <= most_km).groupBy(key).agg(F.min(F.struct("km", place)).alias("x")).select(key, f"x.{place}", "x.km")


def nearest_namesake(points: DataFrame, places: DataFrame, key: str, name: str, most_km: float) -> DataFrame:
    """For each point (key, name, lat, lon; lat null: no anchor) the place of that name. With an anchor the nearest one
    within ``most_km``; without one only if the name is unique."""
    named = places.select(name, F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    met = points.join(named, name).withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon")))
    found = met.groupBy(key).agg(F.min(F.when(F.col("km") <= most_km, F.struct("km", "p_lat", "p_lon"))).alias("near"), F.count("*").alias("n"), F.min(F.struct("p_lat", "p_lon")).alias("only"), F.max("lat").alias("anchor"))
    lat = F.when(F.col("anchor").isNotNull(), F.col("near.p_lat")).when(F.col("n") == 1, F.col("only.p_lat"))
    lon = F.when(F.col("anchor").isNotNull(), F.col("near.p_lon")).when(F.col("n") == 1, F.col("only.p_lon"))
    return found.select(key, lat.alias("lat"), lon.alias("lon"), F.col("near.km").alias("km")).filter("lat is not null")


# --- nested results


def complete_name_list(columns: dict[str, Column]) -> Column:
    """Names of the fields that are null or blank; null if there are none."""
    names = F.array(*[F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(n)) for n, c in columns.items()])
    missing = F.filter(names, lambda n: n.isNotNull())
    return F.when(F.size(missing) > 0, missing)


def parallel_arrays(items: Column, needed: str, fields: dict[str, object]) -> dict[str, Column]:
    """One array per field of an array of structs; items without the needed field are left out of all of them, other
    nulls become the field's default."""
    whole = F.filter(F.coalesce(items, F.array()), lambda x: x[needed].isNotNull())

    def one(name: str, default: object) -> Column:
        return F.transform(whole, lambda x: x[name] if default is None else F.coalesce(x[name], F.lit(default)))

    return {name: one(name, default) for name, default in fields.items()}


def adjacent_changes(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before it in their group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(value).over(w)
    return rows.withColumn("_before", before).filter(~F.col("_before").eqNullSafe(F.col(value)) | F.col("_before").isNull()).drop("_before")
