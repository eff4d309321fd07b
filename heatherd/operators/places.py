"""Localities and boundaries from landed JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heatherd.functions.geometry import geometry_wkb
from heatherd.functions.payload import BOUNDARY_LEVELS, REGIONS, first_filled

# Path to the parent of each locality level; regions have none, and the
# parent of a micro-region is its state.
PARENT_PATHS = {
    "regioes": None,
    "estados": "regiao.id",
    "mesorregioes": "UF.id",
    "microrregioes": "mesorregiao.UF.id",
    "municipios": "microrregiao.id",
}

_FEATURES = "features array<struct<properties:map<string,string>,geometry:string>>"


def localities(payloads: DataFrame, parent_path: str | None = None) -> DataFrame:
    """(id, nome, parent_id) of every object of the JSON lists; a broken parent path gives null."""
    entry = payloads.select(F.explode_outer(F.from_json("payload", "array<string>")).alias("e")).filter(F.startswith("e", F.lit("{")))
    parent = F.lit(None) if parent_path is None else F.get_json_object("e", f"$.{parent_path}")
    return entry.select(
        F.get_json_object("e", "$.id").try_cast("bigint").alias("id"),
        F.get_json_object("e", "$.nome").alias("nome"),
        parent.try_cast("bigint").alias("parent_id"),
    )


def boundaries(payloads: DataFrame, level: str) -> DataFrame:
    """(code, nivel, geometry) of every feature with a valid geometry."""
    if level not in BOUNDARY_LEVELS:
        raise ValueError(f"invalid level {level!r}; must be one of {BOUNDARY_LEVELS}")
    feature = payloads.select(F.explode_outer(F.from_json("payload", _FEATURES)["features"]).alias("f"))
    return feature.select(
        first_filled(F.col("f.properties"), "codarea", "CODAREA", "code").alias("code"),
        F.lit(level).alias("nivel"),
        geometry_wkb(F.col("f.geometry")).alias("geometry"),
    ).filter(F.col("geometry").isNotNull())


def regions(spark) -> DataFrame:
    """The five administrative regions."""
    return spark.createDataFrame([(i, n) for n, i in REGIONS.items()], "id bigint, nome string")
