"""Register, matching, points, classification, sources, sinks and incremental runs on small tables."""

from __future__ import annotations

import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.operators import classify, geo, match, registry
from loomwork.operators import relational as R
from loomwork.sources import files, sinks
from loomwork.streaming import incremental

OBJ = "objectid long, objectguid string, name string, typename string, level int, isactual int, isactive int, region int"
LINK = "objectid long, parentobjid long, isactive int, region int"
HOUSE = "objectid long, objectguid string, housenum string, addnum1 string, addnum2 string, isactual int, isactive int, region int"
OBJECTS = [
    (1, "g1", "Самарская", "обл.", 1, 1, 1, 63), (2, "g2", "Кинельский", "р-н", 2, 1, 1, 63), (3, "g3", "Бобровка", "с.", 6, 1, 1, 63), (4, "g4", "Кирова", "ул.", 8, 1, 1, 63), (5, "g5", "Самара", "г.", 5, 1, 1, 63),
    (6, "g6", "Кирова", "ул.", 8, 1, 1, 63), (7, "g7", "Кирова", "пр-кт", 8, 1, 1, 63), (8, "g8", "Старая", "ул.", 8, 0, 0, 63), (9, "g9", "Москва", "г.", 1, 1, 1, 77), (10, "g10", "Мира", "пр-кт", 8, 1, 1, 77), (11, "g11", "Тверская", "ул.", 9, 1, 1, 77),
]
LINKS = [(2, 1, 1, 63), (3, 2, 1, 63), (4, 3, 1, 63), (5, 1, 1, 63), (6, 5, 1, 63), (7, 5, 1, 63), (8, 3, 1, 63), (10, 9, 1, 77), (20, 4, 1, 63), (21, 4, 1, 63), (22, 6, 1, 63), (23, 6, 1, 63), (24, 6, 0, 63)]
HOUSES = [(20, "h20", "5", None, None, 1, 1, 63), (21, "h21", "7а", "2", None, 1, 1, 63), (22, "h22", "12", "1", None, 1, 1, 63), (23, "h23", "12", "2", None, 1, 1, 63)]


@pytest.fixture(scope="module")
def register(spark):
    return registry.full_import(spark.createDataFrame(OBJECTS, OBJ), spark.createDataFrame(LINKS, LINK), spark.createDataFrame(HOUSES, HOUSE))


def test_import_and_index(register):
    assert {r.objectid for r in register.objects.collect()} == {1, 2, 3, 4, 5, 6, 7, 9, 10}
    assert {r.objectid for r in register.links.collect()} == {2, 3, 4, 5, 6, 7, 10, 20, 21, 22, 23}
    up = {r.objectid: r.ancestors for r in registry.index(register).collect()}
    assert up[4] == [3, 2, 1] and up[1] == [] and up[10] == [9]


def test_delta_and_houses(spark, register):
    changes = spark.createDataFrame([(4, "g4", "Новая", "ул.", 8, 1, 1, 63), (7, "g7", "Кирова", "пр-кт", 8, 1, 0, 63), (30, "g30", "Свет", "ул.", 8, 1, 1, 63), (31, "g31", "x", "x", 9, 1, 1, 63)], OBJ)
    moved = spark.createDataFrame([(30, 5, 1, 63), (99, 5, 1, 63), (4, 5, 1, 63)], LINK)
    new = registry.apply_delta(register, changes, moved)
    names = {r.objectid: r.name for r in new.objects.collect()}
    assert names[4] == "Новая" and 7 not in names and names[30] == "Свет" and 31 not in names
    parents = {r.objectid: r.parent for r in new.links.collect()}
    assert parents[30] == 5 and parents[4] == 5 and 7 not in parents and 99 not in parents and parents[20] == 4
    bare = registry.without_houses(register)
    assert bare.houses is None and not {20, 21, 22, 23} & {r.objectid for r in bare.links.collect()}
    back = registry.with_houses(bare, spark.createDataFrame(HOUSES, HOUSE), spark.createDataFrame(LINKS, LINK))
    assert {r.objectid for r in back.links.collect()} == {r.objectid for r in register.links.collect()}


def test_versions():
    assert registry.version_plan(5, [(4, True), (5, True)]) == ("none", [])
    assert registry.version_plan(3, [(5, True), (4, True)]) == ("apply", [4, 5])
    assert registry.version_plan(3, [(5, True), (4, False)]) == ("rebuild", [5])
    assert registry.version_plan(None, [(5, True)]) == ("rebuild", [5]) and registry.version_plan(1, []) == ("none", [])
    assert registry.version_plan(0, [(v, True) for v in range(1, 60)])[0] == "rebuild"


ADDRESSES = [
    (1, "Самарская область, Кинельский район, с. Бобровка, ул. Кирова, д. 5", ("Самарская обл.", "Кинельский р-н", None, "с. Бобровка", "ул. Кирова", "5", "улица", "g4")),
    (2, "г. Самара, пр-кт Кирова, 12", (None, None, "Самара", None, "пр-кт Кирова", "12", "улица", "g7")),
    (3, "Россия, Самарская обл., с. Бобровка, ул. Кирвоа, дом 7а, корп. 2", (None, None, None, "с. Бобровка", "ул. Кирова", "7а, корп. 2", "улица", "g4")),
    (4, "г. Москва, проспект Мира, 1", ("г. Москва", None, None, None, "пр-кт Мира", None, "улица", "g10")),
    (5, "неизвестно где", (None, None, None, None, None, None, "нет", None)), (6, None, (None, None, None, None, None, None, "нет", None)), (7, "", (None, None, None, None, None, None, "нет", None)),
    (8, "Самарская область, опора в поле", (None, None, None, None, None, None, "регион", "g1")),
]


@pytest.mark.parametrize("salts", [1, 3])
def test_matching(spark, register, salts):
    rows = spark.createDataFrame([(i, a) for i, a, _ in ADDRESSES], "id long, address string")
    got = {r.id: r for r in match.match_addresses(rows, registry.index(register), salts=salts).collect()}
    assert set(got) == {i for i, _, _ in ADDRESSES}
    for i, _, (region, district, city, settlement, street, building, level, guid) in ADDRESSES:
        r = got[i]
        assert (r.street, r.matchLevel, r.guid, r.city) == (street, level, guid, city)
        for want, have in ((region, r.region), (district, r.district), (settlement, r.settlement), (building, r.building)):
            assert want is None or want == have


def test_house_match(spark, register):
    asked = spark.createDataFrame([(1, 4, "5"), (2, 4, "7А, корп. 2"), (3, 4, "7а"), (4, 6, "12"), (5, 6, "12/1"), (6, 4, "99")], "id long, street long, building string")
    got = {r.id: (r.house, r.how) for r in registry.match_houses(asked, register).collect()}
    assert got == {1: (20, "exact"), 2: (21, "exact"), 3: (21, "lead"), 5: (22, "exact")}


PLACES = "key string, kind string, lat double, lon double"


def test_points(spark):
    nodes = spark.createDataFrame([(1, 55.0, 50.0, {"place": "city", "name": "город Самара"}), (2, 55.1, 50.1, {"name": "x"}), (3, 0.0, 0.0, {"place": "town", "name": "Нуль"})], "id long, lat double, lon double, tags map<string,string>")
    ways = spark.createDataFrame([([1, 2, 3], {"highway": "residential", "name": "улица Мира"}), ([2], {"name": "x"})], "nodes array<long>, tags map<string,string>")
    places, streets = geo.import_points(nodes, ways)
    assert [tuple(r) for r in places.collect()] == [("самара", "city", 55.0, 50.0)] and [tuple(r) for r in streets.collect()] == [("мира", "street", 55.1, 50.1)]


def test_locate_reverse_conflict(spark):
    places = spark.createDataFrame([("самара", "city", 53.2, 50.15), ("лесное", "village", 53.5, 50.5), ("лесное", "village", 58.0, 60.0), ("кинель", "town", 53.22, 50.63)], PLACES)
    streets = spark.createDataFrame([("мира", "street", 53.21, 50.16), ("мира", "street", 58.01, 60.01)], PLACES)
    null = None
    asked = spark.createDataFrame([(1, "Самара", "Мира", null, null), (2, "Лесное", null, null, null), (3, "Лесное", null, 53.4, 50.4), (4, "Нигде", null, 53.0, 50.0)], "id long, place string, street string, lat double, lon double")
    got = {r.id: (r.lat, r.lon, r.level) for r in geo.locate(asked, places, streets).collect()}
    assert got == {1: (53.21, 50.16, "улица"), 3: (53.5, 50.5, "нп")}
    stations = spark.createDataFrame([(1, 53.22, 50.63, "Самара", null, null), (2, 53.2, 50.15, "Самара", null, null), (3, 53.2, 50.15, null, "Лесное", null), (4, 53.2, 50.15, null, "Нигде", null), (5, 53.22, 50.63, "Самара", null, "Мира")], "id long, lat double, lon double, city string, settlement string, street string")
    got = {r.id: r.addressByCoords for r in geo.conflicts(stations, places, streets).collect()}
    assert set(got) == {1, 3, 5} and got[1].place == "кинель" and got[1].source == "osm" and got[3].parsedAddressDistanceKm == pytest.approx(40.6, abs=0.3)
    back = geo.reverse(stations.select("id", "lat", "lon"), places, streets)
    lost = spark.createDataFrame([(2, null, "опора у ул. Мира", "город"), (1, null, null, "город")], "id long, street string, extra string, matchLevel string")
    assert {r.id: (r.street, r.matchLevel) for r in geo.rescue_streets(lost, back.withColumn("street_km", F.lit(0.5))).collect()} == {2: ("ул. Мира", "улица"), 1: (None, "город")}


# --- classification


def test_heuristic(spark):
    rows = spark.createDataFrame([("о базовой станции", True), ("GSM", False), ("GSM и ПРТО", True), ("ПРТО", True), (None, False), ("", False)], "text string, want boolean")
    assert all(r.got == r.want for r in rows.select("want", classify.heuristic(F.col("text")).alias("got")).collect())


def test_model(spark):
    rows = [(f"антенна базовой станции номер {i} сети связи", 1.0) for i in range(40)] + [(f"пищевой продукт партия {i} молоко", 0.0) for i in range(40)]
    labelled = spark.createDataFrame(rows, "text string, label double")
    model, figures = classify.train(labelled, features=1 << 9)
    assert figures.accuracy > 0.9 and figures.auc > 0.9
    got = classify.predict(model, spark.createDataFrame([("новая антенна базовой станции",), ("сыр и молоко партия",), (None,)], "text string")).collect()
    assert [r.is_cell for r in got[:2]] == [True, False]
    assert classify.train(labelled, trained_on=80) is None
    with pytest.raises(ValueError, match="no new labels"):
        classify.train(labelled, trained_on=80, force=True)
    with pytest.raises(ValueError, match="are needed"):
        classify.train(labelled.limit(5))
    assert classify.predict(None, labelled).filter("score <> 0.5").count() == 0


def test_what_is_left_to_classify(spark):
    cols = "path string, mtime int, sha256 string"
    todo = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("c", 1, "z"), ("d", 2, "z"), ("e", 1, "z")], cols)
    out = spark.createDataFrame([("a",)], "path string")
    store = spark.createDataFrame([("b", 1, "q", True), ("n", 1, "z", True), ("m", 2, "k", False)], cols + ", processed boolean")
    assert sorted(r.path for r in classify.to_classify(todo, out, store).collect()) == ["d"]
    labels = spark.createDataFrame([("b", 5, "q", False)], cols + ", processed boolean")
    assert {r.path: r.mtime for r in classify.upsert_labels(store, labels).collect()} == {"b": 5, "n": 1, "m": 2}


# --- sources, sinks, incremental runs

NAME = "77.01.09.000.Т.002236.06.26 от 08.06.2026"


def test_files(spark, tmp_path):
    (tmp_path / "t/2026/06").mkdir(parents=True)
    (tmp_path / f"t/2026/06/{NAME}.txt").write_text("текст\nдва", encoding="utf-8")
    (tmp_path / "t/readme.txt").write_text("no")
    (r,) = files.documents(spark, str(tmp_path / "t"), "txt").collect()
    assert (r.doc_name, r.text) == (NAME, "текст\nдва")
    (tmp_path / "old").mkdir()
    (tmp_path / "old/p.html").write_bytes("Привет".encode("cp1251"))
    assert files.legacy_pages(spark, str(tmp_path / "old")).first().html == "Привет"
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{\n"sourceFileName": "a", "antennaHeights": [{"height": 3.5}]}')
    (tmp_path / "j/_processed.json").write_text('{"sourceFileName": "log"}')
    (r,) = files.records(spark, str(tmp_path / "j")).collect()
    assert r.sourceFileName == "a" and r.antennaHeights[0].height == 3.5


def test_zips(spark, tmp_path):
    for volume, rows in (("v.zip", {"a.json": '{"sourceFileName": "1"}', "_processed.json": "{}"}), ("v.part2.zip", {"a.json": '{"sourceFileName": "2"}', "b.json": '{"sourceFileName": "3"}'})):
        with zipfile.ZipFile(tmp_path / volume, "w") as z:
            for n, t in rows.items():
                z.writestr(n, t)
    (tmp_path / "broken.zip").write_bytes(b"PKx")
    assert sorted(r.sourceFileName for r in files.zipped_records(spark, str(tmp_path)).collect()) == ["1", "3"]
    assert files.zip_entries(spark, str(tmp_path)).filter("entry is null").count() == 1
    (tmp_path / "r").mkdir()
    with zipfile.ZipFile(tmp_path / "r/g.zip", "w") as z:
        z.writestr("63/AS_ADDR_OBJ_20260101_x.XML", '<A><OBJECT OBJECTID="1" NAME="Мира" LEVEL="8"/><OBJECT OBJECTID="x"/></A>')
        z.writestr("63/AS_HOUSES_20260101_x.XML", "<A/>")
    got = files.zipped_register(spark, str(tmp_path / "r"), "AS_ADDR_OBJ", "OBJECT", "objectid bigint, name string, level int").collect()
    assert [tuple(r) for r in got] == [(1, "Мира", 8, 63), (None, None, None, 63)]


def test_register_xml(spark, tmp_path):
    (tmp_path / "63").mkdir()
    (tmp_path / "63/AS_ADDR_OBJ.XML").write_text('<A><OBJECT OBJECTID="1" OBJECTGUID="g" NAME="Мира" TYPENAME="ул." LEVEL="8" ISACTUAL="1" ISACTIVE="1"/></A>')
    (r,) = registry.read_xml(spark, f"{tmp_path}/*", "OBJECT", registry.OBJECT).collect()
    assert (r.objectid, r.name, r.level, r.region) == (1, "Мира", 8, 63)


def test_settings():
    text = '{ // note\n "Collect": {"Delay": 5, "Url": "http://x//y", "Terms": ["a",],}, /* no */ }'
    assert files.settings(text, "Collect", {"Collect__Delay": "7", "COLLECT__TERMS": '["b"]', "Other__X": "1"}) == {"Delay": 7, "Url": "http://x//y", "Terms": ["b"]}
    assert files.newest('[{"VersionId": 3}, {"VersionId": 12}]') == {"VersionId": 12}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "sourceFileName string, note string, n int")
    assert sorted(r.json for r in sinks.to_json(rows).collect()) == ['{"sourceFileName":"a","n":1}', '{"sourceFileName":"b","note":"x","n":2}']
    sinks.write_json(rows, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    named = spark.range(25).select(F.concat(F.lit("d"), F.col("id")).alias("name"), F.lit("{}").alias("json"))
    names = [n for r in sinks.zip_volumes(named, 10).collect() for n in zipfile.ZipFile(io.BytesIO(r.content)).namelist()]
    assert len(names) == len(set(names)) == 25
    assert all(len(zipfile.ZipFile(io.BytesIO(r.content)).namelist()) <= 10 for r in sinks.zip_volumes(named, 10).collect())
    good, bad = sinks.valid_and_rejected(rows, ["note", "n"])
    assert good.count() == 1 and [r.reason for r in bad.collect()] == ["note"]
    key = "document_number string, document_date string, processing_date int, source_file string, v int"
    old = spark.createDataFrame([("1", "d", 1, "a", 1), ("2", "d", 5, "a", 2)], key)
    new = spark.createDataFrame([("1", "d", 2, "a", 3), ("2", "d", 5, "b", 4), ("3", None, 1, "c", 5)], key)
    assert sorted(r.v for r in sinks.upsert_table(old, new).collect()) == [3, 4, 5]
    a, b = T.StructType().add("x", "integer"), T.StructType().add("X", "integer").add("y", "string")
    assert sinks.reconcile(a, b)[0] == "add" and sinks.reconcile(b, a)[0] == "none" and sinks.reconcile(a, T.StructType().add("x", "string"))[0] == "recreate"
    failed = spark.createDataFrame([("a", "parse", "x")], "doc_name string, stage string, reason string")
    inputs = spark.createDataFrame([("a",), ("b",)], "doc_name string")
    assert {r.doc_name for r in sinks.dead_letters(failed, None, inputs)[1].collect()} == {"b"}


def test_incremental(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "id long, text string"
    spark.createDataFrame([(1, "a")], schema).write.parquet(f"{source}")
    run = lambda: incremental.process_new(spark, source, schema, lambda d: d.withColumn("up", F.upper("text")), target, mark)
    run()
    spark.createDataFrame([(2, "b")], schema).write.mode("append").parquet(source)
    run()
    run()
    assert sorted((r.id, r.up) for r in spark.read.parquet(target).collect()) == [(1, "A"), (2, "B")]


def test_delta_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "id long, v string, version int, active boolean"
    spark.createDataFrame([(1, "a", 1, True), (2, "b", 1, True), (1, "c", 2, True)], schema).coalesce(1).write.parquet(source)
    args = (spark, source, schema, "id", "version", str(tmp_path / "t"), str(tmp_path / "m"))
    incremental.merge_versions(*args)
    spark.createDataFrame([(2, "b", 3, False), (3, "d", 3, True)], schema).coalesce(1).write.mode("append").parquet(source)
    incremental.merge_versions(*args)
    assert sorted((r.id, r.v) for r in spark.read.parquet(str(tmp_path / "t/1")).collect()) == [(1, "c"), (3, "d")]
    assert incremental.remaining_seconds(100, 50, 5.0, 60) == 10 and incremental.remaining_seconds(100, 50, 5.0, 3) is None
    assert incremental.rates(spark.sql("select timestamp'2026-01-01 00:00:30' ts")).count() == 5


def test_relational(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 3, "c"), (2, 9, "d")], "k int, d int, v string")
    assert [(r.k, r.d, r.v) for r in R.nearest_unique(rows, ["k"], "d", "v").collect()] == [(2, 3, "c")]
    assert [(r.k, r.v) for r in R.unique_only(rows.filter("v <> 'd'"), ["k"], "v").collect()] == [(2, "c")]
    assert sorted((r.k, r.v) for r in R.first_wins(rows, ["k"], ["d", "v"]).collect()) == [(1, "a"), (2, "c")]
