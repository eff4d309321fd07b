from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from heatherd.operators.contracts import CONTRACTS, check_contract, find_contract, unknown_levels
from heatherd.operators.impute import impute_daily
from heatherd.operators.frame import hourly_frame, hourly_observations
from heatherd.functions.geometry import point_wkb
from heatherd.sources import derived
from heatherd.sources.tables import write_table

from conftest import SF_SMALL


@pytest.mark.parametrize(
    "name, contract",
    [
        ("estacoes", "estacoes"),
        ("inmet_historico", "inmet_historico"),
        ("inmet_historico_diario", "inmet_historico_diario"),
        ("inmet_historico_diario_imputado", "inmet_historico_diario_imputado"),
        ("ibge_localidades_estados", "ibge_localidades_*"),
        ("nasa_power_hourly", "nasa_power_hourly*"),
        ("nasa_power_hourly_-8.6_-37.9", "nasa_power_hourly*"),
        ("nasa_power_-8.6_-37.9", "nasa_power_*"),
        ("other", None),
    ],
)
def test_contract_by_name(name, contract):
    assert find_contract(name) == contract


def test_contract_schemas_parse(spark):
    for contract in CONTRACTS.values():
        assert set(contract.sort) <= set(contract.schema.names)


def problems(spark, path, name):
    return sorted((r["check"], r["subject"].rsplit("/", 1)[-1]) for r in check_contract(spark, path, name).collect())


def test_imputed_table_keeps_its_contract(spark, tmp_path):
    frame = hourly_frame(derived.grid(spark, SF_SMALL), hourly_observations(derived.history(spark, SF_SMALL, late_start=True)))
    path = str(tmp_path / "daily")
    write_table(impute_daily(frame), path, sort=["cd_estacao", "data"])
    assert problems(spark, path, "inmet_historico_diario_imputado") == []
    assert ("unexpected column", "tipo") in problems(spark, path, "inmet_historico_diario")


def test_schema_problems(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, "N3", 2020, 1.0)], "code int, geo_level string, year bigint, extra double"), path)
    assert problems(spark, path, "milk_production") == [
        ("missing column", "milk_production_liters"), ("missing column", "nome"),
        ("unexpected column", "extra"), ("wrong type", "code"),
    ]
    assert problems(spark, path, "unheard_of") == [("contract", "unheard_of")]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([], "id bigint, nome string, parent_id bigint"), path)
    assert problems(spark, path, "ibge_localidades_x") == [("empty", "ibge_localidades_x")]


def test_geometry_and_levels(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select(
        F.col("id").cast("string").alias("code"),
        F.when(F.col("id") < 8, "estados").when(F.col("id") == 8, "bairros").alias("nivel"),
        point_wkb(F.col("id").cast("double"), F.lit(1.0)).alias("geometry"),
    )
    cut = F.when(F.col("code") == "3", F.substring("geometry", 1, 9)).otherwise(F.col("geometry"))
    write_table(rows.withColumn("geometry", cut), path)
    assert problems(spark, path, "ibge_malhas_estados") == [("geometry", "geometry"), ("level", "nivel")]
    assert unknown_levels(rows, "nivel", ("estados",)).count() == 2


def test_codec_order_and_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 30_000, numPartitions=1).select(
        F.lit("2024-01-01").cast("date").alias("date"), *[F.lit(1.0).alias(c) for c in ("lat", "lon", "t2m", "rh2m", "prectotcorr")]
    ).withColumn("date", F.date_sub("date", F.monotonically_increasing_id().cast("int")))
    rows.write.option("compression", "snappy").option("parquet.block.row.count.limit", "10000").parquet(path)
    found = {c for c, _ in problems(spark, path, "nasa_power_x")}
    assert found == {"codec", "row group", "order"}
