"""Milk production from the statistics service's nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heatherd.functions.payload import GEO_LEVELS, production_value

_RESULT = (
    "array<struct<resultados:array<struct<series:array<struct<"
    "localidade:struct<id:string,nome:string>,serie:map<string,string>>>>>>>"
)
LITRES_PER_UNIT = 1000.0


def milk_production(payloads: DataFrame, geo_level: str) -> DataFrame:
    """(code, nome, year, milk_production_liters, geo_level) of the first result of each payload.

    A payload of another shape gives no rows. Series without an integer locality and entries
    without an integer year or a known value are left out.
    """
    if geo_level not in GEO_LEVELS:
        raise ValueError(f"invalid level {geo_level!r}; must be one of {GEO_LEVELS}")
    # a lone object would be read as a list of one
    is_list = F.startswith(F.ltrim("payload"), F.lit("["))
    first = F.try_element_at(F.from_json("payload", _RESULT), F.lit(1))["resultados"]
    # outer explodes: an inner one would parse every payload again to drop empty ones
    series = payloads.filter(is_list).select(
        F.explode_outer(F.try_element_at(first, F.lit(1))["series"]).alias("s")
    )
    values = series.select(
        F.col("s.localidade.id").try_cast("bigint").alias("code"),
        F.col("s.localidade.nome").alias("nome"),
        F.explode_outer("s.serie").alias("year", "raw"),
    )
    return values.select(
        "code", "nome", F.col("year").try_cast("bigint").alias("year"),
        (production_value(F.col("raw")) * LITRES_PER_UNIT).alias("milk_production_liters"),
        F.lit(geo_level).alias("geo_level"),
    ).dropna(subset=["code", "year", "milk_production_liters"])
