"""The address register: objects, links and houses; full imports, deltas, versions, the house mode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.scalars import house_key, lead_number, level_group, name_key
from loomwork.operators.relational import ancestors
from loomwork.session import checkpointed

# Columns of the register's XML rows, its deepest level, and the longest chain of deltas worth applying.
OBJECT = "_OBJECTID bigint, _OBJECTGUID string, _NAME string, _TYPENAME string, _LEVEL int, _ISACTUAL int, _ISACTIVE int"
LINK = "_OBJECTID bigint, _PARENTOBJID bigint, _ISACTIVE int"
HOUSE = "_OBJECTID bigint, _OBJECTGUID string, _HOUSENUM string, _ADDNUM1 string, _ADDNUM2 string, _ISACTUAL int, _ISACTIVE int"
DEEPEST, LONGEST_CHAIN, OSM_DAYS = 8, 45, 90


def region_of(path: Column) -> Column:
    return F.regexp_extract(path, r"/(\d{2})/[^/]*$", 1).cast("int")


def read_xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Rows of the register's files below ``path``/NN/; attributes become columns, the folder the region."""
    rows = spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    names = [c[1:].lower() for c in rows.columns]
    return rows.select(*[F.col(c).alias(n) for c, n in zip(rows.columns, names, strict=True)], region_of(F.col("_metadata.file_path")).alias("region"))


def active_objects(objects: DataFrame) -> DataFrame:
    live = objects.filter("isactual = 1 and isactive = 1").filter(F.col("level") <= DEEPEST)
    return live.select("objectid", F.coalesce("objectguid", F.lit("")).alias("guid"), F.coalesce("name", F.lit("")).alias("name"), F.coalesce("typename", F.lit("")).alias("type"), "level", "region")


def active_houses(houses: DataFrame) -> DataFrame:
    number = F.concat_ws("/", F.nullif("housenum", F.lit("")), F.nullif("addnum1", F.lit("")), F.nullif("addnum2", F.lit("")))
    return houses.filter("isactual = 1 and isactive = 1").select("objectid", F.coalesce("objectguid", F.lit("")).alias("guid"), number.alias("number"), "region")


def active_links(links: DataFrame, *known: DataFrame) -> DataFrame:
    """Active links of objects that are known."""
    ids = known[0].select("objectid")
    for k in known[1:]:
        ids = ids.union(k.select("objectid"))
    return links.filter("isactive = 1").join(ids, "objectid", "left_semi").select("objectid", F.col("parentobjid").alias("parent"))


@dataclass
class Register:
    objects: DataFrame
    links: DataFrame
    houses: DataFrame | None = None


def full_import(objects: DataFrame, links: DataFrame, houses: DataFrame | None = None) -> Register:
    own = active_objects(objects)
    homes = active_houses(houses) if houses is not None else None
    return Register(own, active_links(links, own, *([homes] if homes is not None else [])), homes)


def apply_delta(register: Register, objects: DataFrame, links: DataFrame) -> Register:
    """The register after one version's changes: active objects replace, inactive ones go with their links; an active link
    of a known object replaces its link. Active rows below the deepest level are ignored."""
    live = (F.col("isactual") == 1) & (F.col("isactive") == 1)
    gone = objects.filter(~live).select("objectid")
    fresh = active_objects(objects)
    own = register.objects.join(gone.union(fresh.select("objectid")), "objectid", "left_anti").unionByName(fresh)
    known = own if register.houses is None else own.select("objectid").union(register.houses.select("objectid"))
    moved = active_links(links, known)
    kept = register.links.join(gone.union(moved.select("objectid")), "objectid", "left_anti")
    return Register(own, kept.unionByName(moved), register.houses)


def without_houses(register: Register) -> Register:
    if register.houses is None:
        return register
    return Register(register.objects, register.links.join(register.houses, "objectid", "left_anti"), None)


def with_houses(register: Register, houses: DataFrame, links: DataFrame) -> Register:
    homes = active_houses(houses)
    return Register(register.objects, register.links.unionByName(active_links(links, homes)), homes)


def version_plan(current: int | None, versions: list[tuple[int, bool]]) -> tuple[str, list[int]]:
    """What to do about published versions (id, has a delta): nothing, apply some in order, or rebuild the newest."""
    newest = max((v for v, _ in versions), default=None)
    if newest is None or current == newest:
        return "none", []
    chain = sorted((v, d) for v, d in versions if current is not None and v > current)
    if current is not None and len(chain) <= LONGEST_CHAIN and all(d for _, d in chain):
        return "apply", [v for v, _ in chain]
    return "rebuild", [newest]


def index(register: Register) -> DataFrame:
    """Objects with parent, ancestors, level group and name key: what matching looks names up in. The tree is stored, as each level
    of ancestors reads it again."""
    tree = checkpointed(register.objects.join(register.links, "objectid", "left"))
    return ancestors(tree, "objectid", "parent").select("*", level_group(F.col("level")).alias("grp"), name_key(F.col("name")).alias("key"))


def match_houses(asked: DataFrame, register: Register) -> DataFrame:
    """For (id, street, building) the house: the one with the exact key, else the only one with the lead number; columns id,
    house, how."""
    homes = register.houses.join(register.links, "objectid").select("objectid", F.col("parent").alias("street"), house_key(F.col("number")).alias("key"), lead_number(F.col("number")).alias("lead"))
    q = asked.select("id", "street", house_key(F.col("building")).alias("q_key"), lead_number(F.col("building")).alias("q_lead"))
    met = q.join(homes, "street").filter("key = q_key or lead = q_lead")
    found = met.groupBy("id").agg(F.min(F.when(F.col("key") == F.col("q_key"), F.col("objectid"))).alias("exact"), F.min("objectid").alias("lo"), F.max("objectid").alias("hi"))
    house = F.coalesce("exact", F.when(F.col("lo") == F.col("hi"), F.col("lo")))
    return found.select("id", house.alias("house"), F.when(F.col("exact").isNotNull(), "exact").when(F.col("lo") == F.col("hi"), "lead").alias("how")).filter("house is not null")
