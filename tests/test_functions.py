from __future__ import annotations

import datetime as dt
import math
import struct
import time

import pytest
from pyspark.sql import functions as F

from heatherd.functions import climate, payload, text
from heatherd.functions.geometry import geojson_to_wkb, is_wkb, point_wkb, point_xy, wkb_is_valid


def test_decimal_comma(column_of):
    texts = ["22,3", "-5", "1.5", "", "n/d", "1d", "0x1p3", " 7", "1e2", ".5", "1.234,5", "Infinity", "NaN", None]
    assert column_of(texts, text.decimal_comma) == [22.3, -5.0, 1.5, None, None, None, None, None, 100.0, 0.5, None, None, None, None]


def test_iso_date(column_of):
    texts = ["2024-01-31", "2024/01/31", "2024-02-30", "2024-1-1", "2024-01-01 00:00", "2024-01-1T", "", None]
    assert column_of(texts, text.iso_date) == [dt.date(2024, 1, 31)] + [None] * 7


def test_hour_formats(column_of):
    assert column_of(["0000 UTC", "1300 UTC", "07:00:00", "7:00", "UTC", None], text.hour_of) == [0, 13, 7, 7, None, None]


def test_month_and_year(column_of):
    assert column_of(["2024-03-01", "bad", None], text.month_of) == [3, None, None]
    assert column_of(["2024-03-01", "bad", None], text.year_of) == [2024, None, None]


def test_null_tokens(column_of):
    assert column_of(["", "NA", "-9999", "-9999,0", "0", None], text.missing_to_null) == [None] * 4 + ["0", None]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Data", "data"),
        ("DATA (YYYY-MM-DD)", "data_yyyy_mm_dd"),
        ("TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)", "temperatura_do_ar_bulbo_seco_horaria_c"),
        ("PRECIPITAÇÃO TOTAL, HORÁRIO (mm)", "precipitacao_total_horario_mm"),
        ("½ dia ª º ²", "12_dia_a_o_2"),
        ("", ""),
    ],
)
def test_snake_case_for_data_and_names(column_of, name, expected):
    assert text.snake_case_name(name) == expected
    assert column_of([name], text.snake_case) == [expected]


def test_snake_case_agrees_for_all_characters(column_of):
    names = [f"a{chr(c)}b" for c in [*range(0x20, 0x3000), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)]]
    assert column_of(names, text.snake_case) == [text.snake_case_name(n) for n in names]


def test_range_checks_keep_bounds(column_of):
    t = column_of([-10.25, -10.0, 3.5, 50.0, 50.01, math.nan, None], climate.qc_temperature, "double")
    assert t == [None, -10.0, 3.5, 50.0, None, None, None]
    h = column_of([-0.5, 0.0, 37.5, 100.0, 100.75], climate.qc_humidity, "double")
    assert h == [None, 0.0, 37.5, 100.0, None]


def test_heat_index(column_of):
    assert column_of([14.3, 24.3, None], lambda c: climate.heat_index(c, F.lit(40.0)), "double") == [
        pytest.approx(57.74, abs=1e-9), pytest.approx(69.74, abs=1e-9), None]


def test_stress_classes_are_closed_on_the_left(column_of):
    values = [71.9, 72.0, 78.9, 79.0, 89.0, None]
    assert column_of(values, climate.stress_class, "double") == [0, 1, 1, 2, 3, None]
    assert column_of(values, climate.stress_label, "double") == ["conforto", "leve", "leve", "moderado", "severo", None]


def test_day_origin_and_fraction(spark):
    rows = spark.createDataFrame([(0, 0), (5, 0), (0, 5), (2, 3)], "o bigint, i bigint")
    got = rows.select(climate.day_origin(F.col("o"), F.col("i")), climate.imputed_fraction(F.col("o"), F.col("i"))).collect()
    assert [tuple(r) for r in got] == [(None, None), ("inmet", 0.0), ("nasa", 1.0), ("misto", 0.6)]


def test_production_markers(column_of):
    texts = ["-", "..", "...", "X", "", None, "1234", "not a number", " 5 ", "nan", "1d"]
    assert column_of(texts, payload.production_value) == [0.0, None, None, None, None, None, 1234.0, None, 5.0, None, None]


def test_grid_sentinel(column_of):
    assert column_of(["-999.0", "-998.6", "-998.4", "0", "x", None], payload.grid_value) == [None, None, -998.4, 0.0, None, None]


def test_grid_keys(column_of):
    assert column_of(["20240229", "20240230", "2024022900", "x"], payload.grid_day) == [dt.date(2024, 2, 29), None, None, None]
    keys = ["2024010123", "2024010124", "20240101", "2024130100", "2024010a00"]
    assert column_of(keys, payload.grid_hour_day) == [dt.date(2024, 1, 1)] + [None] * 4


def test_grid_timestamp_ignores_the_session_zone(spark, column_of):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # midnight did not exist on this day in that zone
        built = column_of(["2018110400"], lambda c: payload.naive_timestamp(payload.grid_hour_day(c), payload.grid_hour(c)))
        assert built == [dt.datetime(2018, 11, 4)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parent_level_by_digits(column_of):
    levels = column_of([3, 31, 3101, 310620, None], payload.parent_level, "bigint")
    assert levels == ["regioes", "estados", "mesorregioes", "municipios", None]


def test_first_filled_property(spark):
    rows = [({"codarea": "31"},), ({"codarea": "", "CODAREA": "32"},), ({"code": ""},), ({},), (None,)]
    df = spark.createDataFrame(rows, "p map<string,string>")
    got = [r[0] for r in df.select(payload.first_filled(F.col("p"), "codarea", "CODAREA", "code")).collect()]
    assert got == ["31", "32", "", None, None]


def test_point_round_trip(spark):
    df = spark.createDataFrame([(-49.22, -16.64), (None, 1.0)], "x double, y double")
    rows = df.select(point_wkb("x", "y").alias("g")).select("g", point_xy("g").alias("p"), is_wkb("g").alias("ok")).collect()
    assert bytes(rows[0]["g"]) == struct.pack("<BI2d", 1, 1, -49.22, -16.64)
    assert tuple(rows[0]["p"]) == (-49.22, -16.64) and rows[0]["ok"]
    assert rows[1]["g"] is None and not rows[1]["ok"]


SQUARE = [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]
HOLE = [[0.5, 0.5], [1.0, 0.5], [1.0, 1.0], [0.5, 0.5]]


@pytest.mark.parametrize(
    "kind, coordinates, size",
    [
        ("Point", [1, 2], 21),
        ("Point", [1, 2, 3], 29),
        ("LineString", [[0, 0], [1, 1]], 9 + 32),
        ("Polygon", [SQUARE], 9 + 4 + 5 * 16),
        ("Polygon", [SQUARE[:-1]], 9 + 4 + 5 * 16),
        ("Polygon", [SQUARE, HOLE], 9 + 4 + 5 * 16 + 4 + 4 * 16),
        ("MultiPolygon", [[SQUARE], [HOLE]], 9 + 93 + 77),
        ("MultiPoint", [[0, 0], [1, 1]], 9 + 42),
        ("Polygon", [], 9),
    ],
)
def test_geojson_packs_to_valid_wkb(kind, coordinates, size):
    import json

    packed = geojson_to_wkb(json.dumps({"type": kind, "coordinates": coordinates}))
    assert len(packed) == size and wkb_is_valid(packed)
    assert not wkb_is_valid(packed[:-1]) and not wkb_is_valid(packed + b"\0")


@pytest.mark.parametrize("bad", [None, "", "null", "{}", '{"type":"Circle","coordinates":[1,2]}', '{"type":"Polygon","coordinates":[[[0,0],[1,1]]]}', '{"type":"Point","coordinates":["a","b"]}'])
def test_bad_geometry_gives_none(bad):
    assert geojson_to_wkb(bad) is None


def test_big_endian_wkb_is_valid():
    assert wkb_is_valid(struct.pack(">BI2d", 0, 1, 1.0, 2.0))
    assert not wkb_is_valid(b"") and not wkb_is_valid(b"\x05abc") and not wkb_is_valid(None)


def test_fields_of_a_line_fold_like_single_texts(column_of):
    lines = ["Data;Hora UTC;(°C)_;;_x_;", "", ";", "ﬁ;½ a;東京;Ș;\uff1b;\u037e", None]
    expected = [None if line is None else [text.snake_case_name(name) for name in line.split(";")] for line in lines]
    assert column_of(lines, lambda c: text.snake_case_fields(c, ";")) == expected


def test_few_characters_that_become_several_cost_little(spark):
    """One ligature in a long text does not make every letter be looked up."""
    def seconds(tail):
        df = spark.range(4_000).select(F.concat(F.repeat(F.lit("Altura ç "), 60), F.col("id"), F.lit(tail)).alias("t"))
        took = []
        for _ in range(3):
            start = time.perf_counter()
            df.agg(F.max(F.length(text.snake_case(F.col("t"))))).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    assert seconds("ﬁ") < 4 * seconds("ç") + 0.5
