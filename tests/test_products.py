"""Landed files to contract tables, end to end."""

from __future__ import annotations

import datetime as dt
import json
import zipfile

import pytest

from heatherd.functions.text import normalized_columns
from heatherd.operators.contracts import check_contract, check_tables, table_names
from heatherd.plans import products

HEADER = "Data;Hora UTC;TEMPERATURA DO AR - BULBO SECO, HORARIA (C);UMIDADE RELATIVA DO AR, HORARIA (%);"
PLACES = {"A001": (-5.75, -37.5), "A002": (2.25, -51.125), "B003": (4.5, 12.5)}
DAYS = [dt.date(y, 1, 1) + dt.timedelta(days=i) for y in (2021, 2022) for i in range(8)]


def station_text(code):
    lines = ["REGIAO:;NO", HEADER]
    for day in DAYS:
        for hour in range(24):
            if code == "A001" or (hour + day.day) % 3:
                lines.append(f"{day};{hour:02d}00 UTC;{20 + hour / 4 + day.day / 7:.1f};{60 - hour};".replace(".", ","))
    return "\n".join(lines).encode("latin-1")


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    for sub in ("stations", "zips", "grid", "point", "states", "shapes", "milk", "tables"):
        (root / sub).mkdir()
    (root / "stations" / "list.json").write_text(json.dumps([
        {"CD_ESTACAO": c, "DC_NOME": c, "SG_ESTADO": "GO", "VL_LATITUDE": str(lat), "VL_LONGITUDE": str(lon)} for c, (lat, lon) in PLACES.items()
    ]))
    with zipfile.ZipFile(root / "zips" / "2021.zip", "w") as z:
        for code in ("A001", "A002", "Z999"):
            z.writestr(f"2021/INMET_{code}_X.CSV", station_text(code))
    for code, (lat, lon) in PLACES.items():
        keys = [(f"{d:%Y%m%d}{h:02d}", 19 + h / 4 + d.day / 8, 58.0 - h) for d in DAYS for h in range(24)]
        parameter = {"T2M": {k: t for k, t, _ in keys}, "RH2M": {k: h for k, _, h in keys}}
        body = {"geometry": {"coordinates": [lon, lat]}, "properties": {"parameter": parameter}}
        (root / "grid" / f"{lat}_{lon}_2021-01-01_2022-12-31_T2M_RH2M.json").write_text(json.dumps(body))
    (root / "point" / "p.json").write_text(json.dumps({"geometry": {"coordinates": [1, 2]}, "properties": {"parameter": {"T2M": {"20240102": 1, "20240101": 2}}}}))
    (root / "states" / "s.json").write_text(json.dumps([{"id": 17, "nome": "TO", "regiao": {"id": 1}}]))
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    (root / "shapes" / "s.json").write_text(json.dumps({"features": [{"properties": {"codarea": "17"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    (root / "milk" / "m.json").write_text(json.dumps([{"resultados": [{"series": [{"localidade": {"id": "17", "nome": "TO"}, "serie": {"2020": "1", "2019": "-"}}]}]}]))
    return root


def test_all_products_keep_their_contracts(spark, landed):
    tables = str(landed / "tables")
    assert products.known_stations(spark, tables) is None
    products.build_stations(spark, tables, str(landed / "stations"))
    products.build_history(spark, tables, archives=str(landed / "zips"))
    products.build_daily(spark, tables)
    products.build_localities(spark, tables, "regioes")
    products.build_localities(spark, tables, "estados", str(landed / "states"))
    products.build_boundaries(spark, tables, "estados", str(landed / "shapes"))
    products.build_milk(spark, tables, "N3", str(landed / "milk"))
    products.build_grid_daily(spark, tables, "2_1_2024", str(landed / "point"))
    products.build_grid_hourly(spark, tables, str(landed / "grid"))
    products.build_imputed(spark, tables, str(landed / "staging"), batch_size=2)
    for path in sorted((landed / "tables").iterdir()):
        assert check_contract(spark, str(path), path.stem).collect() == [], path

    history = products.product(spark, tables, products.HISTORY)
    assert {r[0] for r in history.select("cd_estacao").distinct().collect()} == {"A001", "A002"}  # Z999 is not registered
    imputed = products.product(spark, tables, products.IMPUTED)
    days = {(r["cd_estacao"], r["temp_origem"]): r for r in imputed.collect()}
    assert set(days) == {("A001", "inmet"), ("A002", "misto")}  # B003 never observed
    assert imputed.count() == 2 * len(DAYS)

    problems = check_tables(spark, table_names(spark, tables)).collect()
    assert problems == []
    wrong = {"milk_production": products.product_path(tables, "estacoes"), "estacoes": products.product_path(tables, "estacoes")}
    assert {r["tabela"] for r in check_tables(spark, wrong).collect()} == {"milk_production"}

    blocks = products.missing_grid_blocks(spark, tables, str(landed / "grid"), 2021, 2024, 2)
    assert {(r["cd_estacao"], r["inicio"]) for r in blocks.collect()} == {(c, "2023-01-01") for c in PLACES}

    report = {k: v.collect() for k, v in products.imputation_report(spark, tables, [2022]).items()}
    assert {r["var"] for r in report["hourly_errors"]} == {"temp", "rh"} and report["class_flips"][0]["n_dias_completos"] == 8
    assert tuple(report["completeness"][0]) == (3, 2, 1)
    assert report["day_types"][0]["tipo"] == "observado" and report["day_types"][0]["pct"] == 100.0
    # the sample is taken from the stations that were imputed, within the years asked for
    assert {r["cd_estacao"] for r in report["station_errors"]} == {"A001", "A002"}
    assert products.holdout_sample(spark, tables, [2022], years=(2021, 2021)).count() == 0
    assert {r[0] for r in products.holdout_sample(spark, tables, [2022], codes=["A002"]).select("cd_estacao").distinct().collect()} == {"A002"}

    out = products.left_out(spark, tables, archives=str(landed / "zips"), grid_payloads=str(landed / "grid")).collect()
    assert {tuple(r) for r in out} == {(products.HISTORY, "INMET_Z999_X.CSV", "station is not registered")}

    placed = str(landed / "placed")
    products.build_frame_inputs(spark, tables, placed, buckets=3)
    before = sorted(map(str, imputed.collect()))
    products.build_imputed(spark, tables, str(landed / "staging_placed"), batch_size=2, placed=placed)
    assert sorted(map(str, products.product(spark, tables, products.IMPUTED).collect())) == before

    products.build_grid_hourly(spark, tables, str(landed / "grid"), codes=["A002"])
    assert {r[0] for r in products.product(spark, tables, products.GRID_HOURLY).select("cd_estacao").distinct().collect()} == {"A002"}


def test_column_names(spark):
    assert normalized_columns(spark.createDataFrame([(1, 2)], "`Média (°C)` int, `A` int")).columns == ["media_c", "a"]
