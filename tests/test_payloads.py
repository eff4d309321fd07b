from __future__ import annotations

import datetime as dt
import json

import pytest

from heatherd.functions.geometry import wkb_is_valid
from heatherd.operators.daily import live_daily, require_columns
from heatherd.operators.grid import grid_daily, grid_hourly, parameter_names
from heatherd.operators.milk import milk_production
from heatherd.operators.places import PARENT_PATHS, boundaries, localities, regions
from heatherd.operators.stations import station_coordinates, stations


@pytest.fixture
def landed(spark):
    def make(*payloads, **columns):
        texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
        extra = ", ".join(f"{n} string" for n in columns)
        rows = [(t, *columns.values()) for t in texts]
        return spark.createDataFrame(rows, "payload string" + (", " + extra if extra else ""))

    return make


def test_stations_drop_bad_coordinates_and_keep_extra_fields(landed):
    table = stations(landed([
        {"CD_ESTACAO": "K410", "DC_NOME": "HEATH EDGE", "VL_LATITUDE": "-5,75", "VL_LONGITUDE": "-37.5", "SG_ESTADO": "Q1", "Situação": "Aberta"},
        {"CD_ESTACAO": "K411", "DC_NOME": "LOW FORD", "VL_LATITUDE": 2.25, "VL_LONGITUDE": -51.125, "SG_ESTADO": "Q2"},
        {"CD_ESTACAO": "K412", "DC_NOME": "NOWHERE", "VL_LATITUDE": "north", "VL_LONGITUDE": None, "SG_ESTADO": "Q2"},
    ]))
    assert table.columns == ["cd_estacao", "dc_nome", "sg_estado", "vl_latitude", "vl_longitude", "situacao", "geometry"]
    rows = {r["cd_estacao"]: r for r in table.collect()}
    assert set(rows) == {"K410", "K411"}
    assert rows["K410"]["vl_latitude"] == -5.75 and rows["K410"]["situacao"] == "Aberta" and rows["K411"]["situacao"] is None
    assert all(wkb_is_valid(bytes(r["geometry"])) for r in rows.values())


def test_station_coordinates_keep_one_row_per_station(spark):
    df = spark.createDataFrame([("A", 2.0, 1.0), ("A", 1.0, 9.0), ("B", None, 1.0), ("C", 1.0, 1.0)], "cd_estacao string, vl_latitude double, vl_longitude double")
    assert sorted(tuple(r) for r in station_coordinates(df).collect()) == [("A", 1.0, 9.0), ("C", 1.0, 1.0)]
    assert [r[0] for r in station_coordinates(df, ["C"]).collect()] == ["C"]


def test_live_days(landed):
    days = live_daily(landed([
        {"DT_MEDICAO": "2019-08-14", "TEMP_MED": "20.0", "TEMP_MAX": "24.5", "UMID_MED": "50", "UMID_MIN": "41"},
        {"dt_medicao": "2019-08-15", "Temp_Med": "61.5", "TEMP_MAX": 19.5, "UMID_MED": "58", "UMID_MIN": "-12"},
        {"DT_MEDICAO": "15/08/2019", "TEMP_MED": None},
    ], station_code="K410"))
    assert days.columns == ["date", "station_code", "temp_med", "temp_max", "umid_med", "umid_min", "itu_med", "itu_max"]
    rows = {r["date"]: r for r in days.collect()}
    first, second = rows[dt.date(2019, 8, 14)], rows[dt.date(2019, 8, 15)]
    assert first["itu_med"] == pytest.approx(16 + 2.85 + 46.3, abs=1e-6) and first["station_code"] == "K410"
    assert second["temp_med"] is None and second["umid_min"] is None and second["temp_max"] == 19.5 and second["itu_max"] is None
    assert rows[None]["temp_max"] is None


@pytest.mark.parametrize("payload", ["[]", "", "{}", "not json"])
def test_empty_payloads_keep_their_columns(landed, payload):
    df = landed(payload, station_code="A001", cd_estacao="A001")
    assert milk_production(df, "N3").count() == 0
    assert grid_daily(df).count() == 0 and grid_daily(df).columns == ["date", "lat", "lon", "t2m", "rh2m", "prectotcorr"]
    assert grid_hourly(df).count() == 0
    assert grid_hourly(df, None).columns == ["cd_estacao", "datetime", "data", "hora", "lat", "lon"]
    assert localities(df.limit(0)).columns == ["id", "nome", "parent_id"]
    if payload != "{}":
        assert live_daily(df).dropna(subset=["date"]).count() == 0
    assert boundaries(df, "estados").count() == 0


def test_locality_parents(landed):
    states = landed([{"id": i, "nome": n, "regiao": {"id": 7, "sigla": "WW"}} for i, n in ((71, "Åland"), (72, "Brae"))])
    assert sorted(tuple(r) for r in localities(states, PARENT_PATHS["estados"]).collect()) == [(71, "Åland", 7), (72, "Brae", 7)]
    assert {r["parent_id"] for r in localities(states, "nome.id").collect()} == {None}
    assert {r["parent_id"] for r in localities(states).collect()} == {None}
    micro = landed([{"id": 71009, "nome": "x", "mesorregiao": {"id": 7102, "UF": {"id": 71}}}])
    assert localities(micro, PARENT_PATHS["microrregioes"]).collect()[0]["parent_id"] == 71


def test_regions(spark):
    assert {(r["id"], r["nome"]) for r in regions(spark).collect()} >= {(1, "Norte"), (5, "Centro-Oeste")}


def test_boundaries(landed):
    ring = [[3.0, 1.5], [8.0, 1.0], [6.5, 7.25], [3.0, 1.5]]
    collection = {"type": "FeatureCollection", "features": [
        {"properties": {"codarea": "71"}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"properties": {"CODAREA": 72}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"properties": None, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"properties": {"codarea": "74"}, "geometry": None},
        {"properties": {"codarea": "75"}},
    ]}
    rows = boundaries(landed(collection), "estados").collect()
    assert {r["code"] for r in rows} == {"71", "72", None} and {r["nivel"] for r in rows} == {"estados"}
    assert bytes(rows[0]["geometry"])[:5] == b"\x01\x03\x00\x00\x00"
    with pytest.raises(ValueError):
        boundaries(landed(collection), "bairros")


def test_milk(landed):
    series = [
        {"localidade": {"id": "71", "nivel": {"id": "N3"}, "nome": "Åland"}, "serie": {"1998": "812", "1999": "907", "2000": "-", "2001": "..", "total": "4"}},
        {"localidade": {"id": "75", "nome": "Eday"}, "serie": {"1998": "33", "1999": "41.5"}},
        {"localidade": {"id": "x"}, "serie": {"1998": "1"}},
        {"localidade": None, "serie": {"1998": "1"}},
        {"localidade": {"id": "76"}, "serie": None},
    ]
    other = [{"localidade": {"id": "99"}, "serie": {"2020": "1"}}]
    payload = [{"id": "4417", "resultados": [{"classificacoes": [], "series": series}, {"series": other}]}, {"resultados": [{"series": other}]}]
    rows = {(r["code"], r["year"]): r["milk_production_liters"] for r in milk_production(landed(payload), "N3").collect()}
    assert rows == {(71, 1998): 812e3, (71, 1999): 907e3, (71, 2000): 0.0, (75, 1998): 33e3, (75, 1999): 41.5e3}
    assert milk_production(landed(payload[0]), "N3").count() == 0
    with pytest.raises(ValueError):
        milk_production(landed(payload), "N4")


POINT = {"type": "Point", "coordinates": [12.5, 4.25, 90]}


def test_grid_daily(landed):
    rows = grid_daily(landed({"geometry": POINT, "properties": {"parameter": {
        "T2M": {"20150301": 11.25, "20150302": 9.5, "20150303": -999.0},
        "RH2M": {"20150301": 64.0, "20150303": 71.5, "20150304": "wet"},
        "PRECTOTCORR": {"20150302": 0.75, "ANN": 3.0, "2015030500": 1.0},
        "WS2M": {"20150309": 1.0},
    }}})).collect()
    got = {r["date"].day: (r["t2m"], r["rh2m"], r["prectotcorr"]) for r in rows}
    assert got == {1: (11.25, 64.0, None), 2: (9.5, None, 0.75), 3: (None, 71.5, None), 4: (None, None, None)}
    assert {(r["lat"], r["lon"]) for r in rows} == {(4.25, 12.5)}


def test_grid_hourly(landed):
    payload = {"geometry": {"coordinates": [12.5]}, "properties": {"parameter": {
        "T2M": {"2015030100": 7.5, "2015030101": 7.25, "2015030102": -999.0},
        "RH2M": {"2015030100": 55.5, "2015030102": 61.0, "2015030124": 1.0},
        "WS2M": {"2015030105": 3.0},
    }}}
    df = landed(payload, payload, cd_estacao="K410")
    assert parameter_names(df) == ["RH2M", "T2M", "WS2M"]
    rows = grid_hourly(df).collect()
    assert len(rows) == 8  # two payloads never mix
    got = {r["hora"]: (r["t2m"], r["rh2m"], r["ws2m"]) for r in rows}
    assert got == {0: (7.5, 55.5, None), 1: (7.25, None, None), 2: (None, 61.0, None), 5: (None, None, 3.0)}
    assert {(r["cd_estacao"], r["data"], r["lat"], r["lon"]) for r in rows} == {("K410", "2015-03-01", None, 12.5)}
    assert {r["datetime"] for r in rows} == {dt.datetime(2015, 3, 1, h) for h in (0, 1, 2, 5)}
    assert grid_hourly(landed(payload), ["T2M", "RH2M"]).columns == ["cd_estacao", "datetime", "data", "hora", "lat", "lon", "rh2m", "t2m"]


def test_missing_measure_columns_raise(spark):
    with pytest.raises(RuntimeError, match="expected columns missing"):
        require_columns(spark.range(1), "temp")
