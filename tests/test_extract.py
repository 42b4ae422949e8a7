"""Text rules: input, expected."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwork.functions import scalars as S
from loomwork.functions.fuzzy import osa, osa_distance
from loomwork.operators import pages
from loomwork.operators.extract import address, coords, heights, number, owner, record, sections

COORDINATES = [
    ("координаты 50.4455,5 с.ш. 36.3710,7 в.д.", "50.74875, 36.619638888888886"),
    ("Географические координаты: 55.772190, 37.678168", "55.77219, 37.678168"),
    ("ш. : 55. 772190, д.: 37.678168", "55.77219, 37.678168"),
    ("42*59`11.2`` с.щ. 47*30`10`` в.д.", "42.986444444444444, 47.50277777777778"),
    ("55-25-47 с.ш.; 65-18-27 в.д.", "55.42972222222222, 65.30749999999999"),
    ("59 град. 54 мин. 43.30 сек. сев. широты, 30 град. 18 мин. 3.20 сек. вост. долготы", "59.91202777777777, 30.30088888888889"),
    ("62° 13' 35.2''N\",134° 13' 06.5\"Е", "62.226444444444446, 134.21847222222223"),
    ("N50.69295729 Е37.14713081", "50.69295729, 37.14713081"),
    ("52,118250, 47,200283", "52.11825, 47.200283"),
    ("53.741682 (53°44'30.1\") 58.835268 (58°50'7.0\")", "53.741682, 58.835268"),
    ("54°43'44,8\" с.ш. 55°56'23,4 в.д.", "54.729111111111116, 55.93983333333333"),
    ("66°10'1\" с.ш. 172°51'38,69\" з.д.", "66.16694444444445, -172.86074722222222"),
    ("55.123456, 55.123456", None), ("12.345678, 13.345678", None), ("55°61'10\" с.ш. 37°10'10\" в.д.", None), ("", None),
]
HEIGHTS = [
    ("Высота подвеса антенн: 24, 27 м", [(24, None), (27, None)]), ("высота подвеса 62,5 м", [(62.5, None)]), ("высота установки антенн от уровня земли 19-23 м", [(19, "земля"), (23, "земля")]),
    ("высота подвеса антенн над уровнем земли/кровли: 39,48/- м", [(39.48, "земля")]), ("высота фазового центра: 24\nна отметке 24 м относительно уровня земли", [(24, "земля")]),
    ("высота подвеса 0,5 м", None), ("высота подвеса 600 м", None), ("мачта высотой 23м", [(23, None)]), ("высота подвеса антенн 35 м; азимуты 60, 180, 290", [(35, None)]), ("отн. зем./кров. 24,2/2,2", [(24.2, "земля"), (2.2, "кровля")]),
]
NUMBERS = [
    ("Базовая станция BTS-23- 00489GUL18", "BTS-23-00489GUL18"), ("БС BTS-66-02698DL18-СЗЗ", "BTS-66-02698DL18"), ("базовая станция № 2064, размещаемая по адресу", "2064"), ("БС № 17 сети подвижной связи", "17"),
    ("БС № 17 на улице", None), ("Базовая станция № 40234 \"Северная\"", '40234 "Северная"'), ("БС-02345 по адресу", "02345"), ("БС № 70.195 \"Лес\"", "70.195"), ("станция № 2019 года", None), ("Базовой станции № 64- 01361 ПАО \"МТС\"", "64-01361"),
]
OPERATORS = [
    ('Базовая станция № 1 ПАО "МТC" стандарта', 'ПАО "МТС"'), ("в пределах максимального значения", None), ("услуги Билайн", 'ПАО "ВымпелКом"'), ('Владелец ПРТО: ООО "Рога"', "Рога"), ("ИНН 7743895280", 'ООО "Т2 Мобайл"'),
    ('Базовая станция ГБУЗ НО "Больница"', 'ГБУЗ НО "Больница"'), ('Разработчик ООО "Протон". Приложение. АО "Крымтелеком"', 'АО "Крымтелеком"'), ("Мотив", "Мотив"), ("мотивированное", None),
]
CLEANED = [
    ("Самарская область,Задонский р-н", "Самарская область, Задонский р-н"), ("РД, г. Махачкала, ул. Ленина, 5 в", "Республика Дагестан, г. Махачкала, ул. Ленина, 5"), ('"Респ. Татарстан, г. Казань', "Респ. Татарстан, г. Казань"),
    ("445004, Самарская область, 4,74 км", "Самарская область, 4,74 км"), ("г. Омск,, ул. Мира", "г. Омск, ул. Мира"),
]


@pytest.mark.parametrize(("text", "want"), COORDINATES)
def test_coordinates(text, want):
    assert coords.coordinates(text) == want


@pytest.mark.parametrize(("text", "want"), HEIGHTS)
def test_heights(text, want):
    got = heights.heights(text)
    assert (got and [(h.height, h.base) for h in got]) == want


def test_antennas():
    assert [h.antenna for h in heights.heights("Антенна типа RFS APXVLL13-C. Высота подвеса 30, 35 м")] == ["RFS APXVLL13-C"] * 2
    got = heights.heights("высота подвеса 30 м, тип антенны - A1- ODV-065, азимут 10")
    assert [(h.antenna, h.number) for h in got] == [("ODV-065", 1)]


@pytest.mark.parametrize(("text", "want"), NUMBERS)
def test_numbers(text, want):
    assert number.station_number(text) == want


@pytest.mark.parametrize(("text", "want"), OPERATORS)
def test_operators(text, want):
    assert owner.operator(text) == want


@pytest.mark.parametrize(("text", "want"), CLEANED)
def test_clean(text, want):
    assert address.clean(text) == want


@settings(max_examples=200, deadline=None)
@given(st.text("РДабв., ;:-\"()0123456789 ул.г", max_size=400))
def test_clean_twice_is_clean_once(text):
    once = address.clean(text)
    assert address.clean(once) == once and len(once) <= 303


@settings(max_examples=200, deadline=None)
@given(st.text("абв", max_size=7), st.text("абв", max_size=7))
def test_osa_is_a_distance(a, b):
    assert osa(a, b, 9) == osa(b, a, 9) and (osa(a, b, 9) == 0) == (a == b)
    assert osa(a, b, 1) == min(osa(a, b, 9), 2)


def test_osa_counts_swaps(spark):
    rows = spark.createDataFrame([("кирвоа", "кирова"), ("ca", "abc"), (None, "a"), ("аб", "абвгде")], "a string, b string")
    assert [r[0] for r in rows.select(osa_distance(F.col("a"), F.col("b"), F.lit(3))).collect()] == [1, 3, None, 4]


DOCUMENT = """1006 заключение
№ 14.01.01.000.Т.000592.12.16 от 09.12.2016
Проектная документация
Базовая стация № 40234 "Лесная" ПАО "МегаФон" стандарта GSM-900 по адресу: 445004, Самарская область,Кинельский район, с. Бобровка, ул. Кирова, д. 5, координаты: 53.241667, 50.683333, высота подвеса антенн от уровня земли 24, 27 м
СООТВЕТСТВУЕТ
Приложение
Владелец ПРТО: ПАО "МегаФон", юридический адрес: 127006, г. Москва, пер. Оружейный, д. 41"""
NAME = "14.01.01.000.Т.000592.12.16 от 09.12.2016"


def test_record_and_flat_row(spark):
    rows = spark.createDataFrame([(f"{NAME}.txt", DOCUMENT), ("77.01.09.000.Т.002236.06.26 от 31.02.2026.txt", "ничего"), ("x", None)], "sourceFileName string, text string")
    got = {r.sourceFileName: r for r in record.records(rows).collect()}
    r = got[f"{NAME}.txt"]
    assert (r["index"], r.documentNumberAndDate, r.baseStationNumber, r.operator, r.coordinates) == ("1006", NAME, '40234 "Лесная"', 'ПАО "МегаФон"', "53.241667, 50.683333")
    assert r.baseStationAddress == "Самарская область, Кинельский район, с. Бобровка, ул. Кирова, д. 5" and r.missingFields is None and r.failure is None
    assert [(h.height, h.base) for h in r.antennaHeights] == [(24.0, "земля"), (27.0, "земля")]
    assert got["x"].missingFields == ["Index", "DocumentNumberAndDate", "BaseStationNumber", "BaseStationAddress", "Operator"]
    good, bad = record.flat(record.records(rows))
    (g,) = good.collect()
    assert (g.document_number, str(g.document_date), g["index"], g.latitude, g.antenna_heights, g.antenna_height_bases, g.antenna_numbers) == (NAME.split()[0], "2016-12-09", 1006, 53.241667, [24.0, 27.0], ["земля"] * 2, [0, 0])
    assert {b.source_file for b in bad.collect()} == {"x", "77.01.09.000.Т.002236.06.26 от 31.02.2026.txt"}


def test_sections():
    assert sections.project(DOCUMENT).startswith("Проектная") and "Владелец" not in sections.project(DOCUMENT)
    assert sections.appendix("см. Приложение 1", line_start=True) is None and sections.appendix("см. приложение 1") is None
    assert sections.repaired("базовой стации") == "базовой станции"


PAGE = (
    '<table><tr><td>x</td></tr><tr><td><hr size="1" width="100%"><b>1.</b></td></tr><tr><td>Номер заключения и дата —&nbsp;</td> <td><b>77.01.09.000.Т.002236.06.26 от 08.06.2026</b></td></tr>'
    '<tr><td><hr size="1" width="100%"><b>2.</b></td></tr><tr><td>Номер заключения и дата —&nbsp;</td> <td><b>bad</b></td></tr></table>'
)


def test_pages_to_texts(spark):
    rows = spark.createDataFrame([(1, PAGE), (2, PAGE), (3, "<p>none</p>"), (4, None)], "page int, html string")
    good, bad = pages.split_documents(rows, ["page"])
    assert [r.doc_name for r in good.collect()] == ["77.01.09.000.Т.002236.06.26 от 08.06.2026"] and bad.count() == 2
    (t,) = pages.texts(good).collect()
    assert (t.year, t.month) == (2026, 6) and "Номер заключения и дата" in t.text
    assert pages.table_text("<table><tr><td>a</td></tr></table><table><tr><td><p>one <b>one</b><br>two</p></td><td><p><b>same</b></p></td><td>plain&nbsp;x</td></tr></table>") == "one one\ntwo\none\nsame\nplain x"
    counts = spark.createDataFrame([('<hr size="1"><br> Страницы (всего 12)',), ("none",), ('<hr size="1"><br> Страницы (всего 0)',), (None,)], "h string")
    assert [r[0] for r in counts.select(pages.page_count(F.col("h"))).collect()] == [12, 1, 1, 1]
    terms = spark.createDataFrame([("a/b*",)], "term string")
    assert [(r.folder, str(r.month)) for r in pages.jobs(terms, "11.2025", "01.2026").collect()] == [("a_b_", "2025-11-01"), ("a_b_", "2025-12-01"), ("a_b_", "2026-01-01")]


def test_scalars(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first().v
    assert value(S.valid_name(F.lit("77.01.09.000.T.002236.06.26 от 08.06.2026"))) and not value(S.valid_name(F.lit("77.1.09.000.Т.002236.06.26")))
    assert value(S.name_key(F.lit("3-я Линия"))) == value(S.name_key(F.lit("линия 3-я"))) and value(S.name_key(F.lit("райoн"))) == value(S.name_key(F.lit("район")))
    assert value(S.day(F.lit("31.02.2024"))) is None and str(value(S.day(F.lit("29.02.2024")))) == "2024-02-29"
    assert str(value(S.moment(F.lit("2026-01-02T03:04:05.678+03:00")))) == "2026-01-02 03:04:05" and value(S.moment(F.lit("gestern"))) is None
    assert tuple(value(S.point(F.lit("55.5, 37.25")))) == (55.5, 37.25) and value(S.point(F.lit("55.5"))) is None and value(S.point(F.lit("1,2,3"))) is None
    assert value(S.half_even(F.lit(0.125), 2)) == 0.12 and value(S.half_even(F.lit(525.455), 2)) == 525.46 and value(S.cell(F.lit(-0.04))) == 0
    assert value(S.degrees(F.lit("50"), F.lit("44"), F.lit("55,5"))) == 50 + 44 / 60 + 55.5 / 3600 and value(S.degrees(F.lit("50"), F.lit("60"), F.lit("1"))) is None
    assert value(S.house_key(F.lit("28, корп. 2"))) == "282" and value(S.lead_number(F.lit("28а, стр. 2"))) == "28а"
    assert value(S.plausible(F.lit(66.0), F.lit(-172.0))) and not value(S.plausible(F.lit(55.0), F.lit(55.0)))
    a, b, c, d = map(math.radians, (55.75, 37.62, 59.94, 30.31))
    by_cosines = 6371 * math.acos(math.sin(a) * math.sin(c) + math.cos(a) * math.cos(c) * math.cos(d - b))
    assert value(S.haversine_km(F.lit(55.75), F.lit(37.62), F.lit(59.94), F.lit(30.31))) == pytest.approx(by_cosines)
    assert value(S.project_section(F.lit(DOCUMENT))).startswith("Проектная") and value(S.appendix(F.lit("x приложение"))) is None
    assert value(S.decimal(F.lit("1 234,5"))) == 1234.5
