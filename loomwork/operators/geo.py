"""Points of places and streets: import, location of addresses, reverse lookup, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.scalars import half_even, haversine_km, plain_key
from loomwork.operators.relational import nearest_namesake, nearest_on_grid

# Kinds of places and streets, words that map names don't need, distances in km.
PLACES = ("city", "town", "village", "hamlet", "suburb", "neighbourhood", "isolated_dwelling", "locality", "quarter")
STREETS = ("motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "living_street", "service", "pedestrian", "road", "track")
SETTLED = ("city", "town", "village", "hamlet")
WORDS = ("улица", "ул", "проспект", "пр", "переулок", "пер", "проезд", "шоссе", "набережная", "бульвар", "площадь", "тракт", "аллея", "линия", "город", "г", "село", "с", "деревня", "д", "поселок", "п", "пгт", "рп", "хутор", "станица", "аул")
PLACE_KM, STREET_KM = 150.0, 50.0
CITY_OK, SETTLEMENT_OK, STREET_OK, NEAR_PLACE, NEAR_STREET, FARTHEST = 25.0, 8.0, 3.0, 7.0, 0.4, 300.0


def key(name: Column) -> Column:
    return plain_key(name, WORDS)


def import_points(nodes: DataFrame, ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places and streets (key, kind, lat, lon) of map nodes (id, lat, lon, tags) and ways (nodes, tags); a street stands at its
    middle node. Points at (0, 0) are no points."""
    tag = lambda t: F.col("tags")[t]
    places = nodes.filter(tag("place").isin(*PLACES) & tag("name").isNotNull()).select(key(tag("name")).alias("key"), tag("place").alias("kind"), "lat", "lon")
    middle = ways.filter(tag("highway").isin(*STREETS) & tag("name").isNotNull() & (F.size("nodes") > 0)).select(
        key(tag("name")).alias("key"), F.lit("street").alias("kind"), F.element_at("nodes", (F.size("nodes") / 2).cast("int") + 1).alias("id")
    )
    streets = middle.join(nodes.select("id", "lat", "lon"), "id").select("key", "kind", "lat", "lon")
    real = (F.col("lat") != 0) | (F.col("lon") != 0)
    return places.filter(real), streets.filter(real)


def rekeyed(points: DataFrame) -> DataFrame:
    """Points whose keys were made by older rules, with today's."""
    return points.withColumn("key", key(F.col("key")))


def locate(addresses: DataFrame, places: DataFrame, streets: DataFrame) -> DataFrame:
    """Points of addresses (id, place, street, lat, lon as an anchor or null): id, lat, lon, level. The place is the nearest
    namesake to the anchor, or the only one; a street the nearest to the anchor, else to the place."""
    asked = addresses.select("id", key(F.col("place")).alias("key"), key(F.col("street")).alias("street_key"), "lat", "lon")
    found = nearest_namesake(asked.filter("key <> ''").select("id", "key", "lat", "lon"), places, "id", "key", PLACE_KM).select("id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    base = asked.join(found, "id", "left")
    at = base.filter("street_key <> '' and coalesce(lat, p_lat) is not null").select("id", F.col("street_key").alias("key"), F.coalesce("lat", "p_lat").alias("lat"), F.coalesce("lon", "p_lon").alias("lon"))
    street = nearest_namesake(at, streets, "id", "key", STREET_KM).select("id", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    out = base.join(street, "id", "left").select("id", half_even(F.coalesce("s_lat", "p_lat"), 6).alias("lat"), half_even(F.coalesce("s_lon", "p_lon"), 6).alias("lon"), F.when(F.col("s_lat").isNotNull(), "улица").when(F.col("p_lat").isNotNull(), "нп").alias("level"))
    return out.filter("lat is not null")


def reverse(points: DataFrame, places: DataFrame, streets: DataFrame) -> DataFrame:
    """The settlement and street nearest to (id, lat, lon), of the nine cells around it: id, place, place_km, street, street_km."""
    p = nearest_on_grid(points, places.filter(F.col("kind").isin(*SETTLED)).withColumnRenamed("key", "place"), "id", "place").withColumnRenamed("km", "place_km")
    s = nearest_on_grid(points, streets.withColumnRenamed("key", "street"), "id", "street").withColumnRenamed("km", "street_km")
    return points.select("id").join(p, "id", "left").join(s, "id", "left")


def conflicts(stations: DataFrame, places: DataFrame, streets: DataFrame) -> DataFrame:
    """Stations (id, lat, lon, city, settlement, street) whose address lies too far from their coordinates, with what is there:
    id, addressByCoords. Located by street the limit is 3 km; else by the nearest namesake, 25 km for a city and 8 for a
    settlement. Beyond 300 km it is a namesake elsewhere and no conflict."""
    near = reverse(stations.select("id", "lat", "lon"), places, streets).filter(F.col("place_km") <= NEAR_PLACE)
    named = stations.withColumn("place", F.coalesce("city", "settlement")).filter("place is not null")
    blind = named.select("id", "place", "street", F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"))
    by_street = locate(blind, places, streets).filter("level = 'улица'").select("id", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    same = named.select("id", "lat", "lon", key(F.col("place")).alias("key")).join(places.select("key", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")), "key")
    least = same.groupBy("id").agg(F.min(haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"))).alias("name_km"))
    met = named.select("id", "lat", "lon", "city").join(near, "id").join(by_street, "id", "left").join(least, "id", "left")
    far = F.when(F.col("s_lat").isNotNull(), haversine_km(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon"))).otherwise(F.col("name_km"))
    limit = F.when(F.col("s_lat").isNotNull(), STREET_OK).when(F.col("city").isNotNull(), CITY_OK).otherwise(SETTLEMENT_OK)
    shown = F.when(F.col("street_km") <= NEAR_STREET, F.col("street"))
    what = F.struct(F.col("place"), half_even(F.col("place_km"), 2).alias("placeDistanceKm"), shown.alias("street"), half_even(far, 2).alias("parsedAddressDistanceKm"), F.lit("osm").alias("source"))
    return met.filter((far > limit) & (far <= FARTHEST)).select("id", what.alias("addressByCoords"))


def rescue_streets(addresses: DataFrame, reversed_: DataFrame) -> DataFrame:
    """Addresses (id, street, extra, matchLevel, ...) without a street whose leftover text names, as ``ул. X``, the street that
    lies within a kilometre of their point: the street is set and the level is ``улица``."""
    named = F.regexp_extract("extra", r"(?iu)ул\.?\s*([А-ЯЁ][^,()]*)", 1)
    met = addresses.join(reversed_.select("id", F.col("street").alias("_street"), "street_km"), "id", "left")
    hit = F.coalesce(F.col("street").isNull() & (key(named) != "") & (key(named) == F.col("_street")) & (F.col("street_km") <= 1), F.lit(False))
    met = met.withColumn("_hit", hit)
    hit = F.col("_hit")
    return met.withColumn("street", F.when(hit, F.concat(F.lit("ул. "), F.trim(named))).otherwise(F.col("street"))).withColumn("matchLevel", F.when(hit, "улица").otherwise(F.col("matchLevel"))).drop("_street", "street_km", "_hit")
