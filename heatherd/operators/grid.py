"""Gridded series of one point, daily or hourly, from landed JSON.

A payload maps parameter -> key -> value. Its parameters are aligned by key inside the row
that holds them, so unpacking needs no shuffle and payloads never mix. Parameters with the
same keys in the same order, as they usually come, are zipped by position.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from heatherd.functions.payload import (
    coordinate, grid_day, grid_hour, grid_hour_day, grid_value, naive_timestamp,
)
from heatherd.functions.text import number
from heatherd.session import scratch_path

_POINT = (
    "geometry struct<coordinates:array<double>>,"
    "properties struct<parameter:map<string,map<string,string>>>"
)
DAILY_PARAMETERS = ("T2M", "RH2M", "PRECTOTCORR")


def parameter_series(payload: Column, names: Sequence[str]) -> dict[str, Column]:
    """One column per parameter of a parsed payload, a map from key to value; empty for one it lacks."""
    empty = F.create_map().cast("map<string,string>")
    return {f"s{i}": F.coalesce(F.try_element_at(payload, F.lit(name)), empty) for i, name in enumerate(names)}


def aligned(df: DataFrame, series: Sequence[str]) -> DataFrame:
    """Adds `rows`, an array of (key, v0, v1, ...) over the keys of all series; a series without the key has null there.

    Series that differ in their keys are each filled up with the keys of all and sorted by key,
    so that every one is walked once or sorted once, however many there are.
    """
    same = reduce(lambda a, b: a & b, [F.map_keys(s) == F.map_keys(series[0]) for s in series[1:]], F.lit(True))
    every = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.map_keys(s) for s in series]))))
    df = df.withColumn("same", same).withColumn("keys", F.when(F.col("same"), F.map_keys(series[0])).otherwise(every))
    df = df.withColumn("blank", F.map_from_arrays("keys", F.transform("keys", lambda key: F.lit(None).cast("string"))))

    def filled(s: str) -> Column:
        whole = F.map_zip_with(s, "blank", lambda key, value, none: value)
        return F.transform(F.array_sort(F.map_entries(whole)), lambda entry: entry["value"])

    values = [F.when(F.col("same"), F.map_values(s)).otherwise(filled(s)).alias(f"v{i}") for i, s in enumerate(series)]
    return df.withColumn("rows", F.arrays_zip(F.col("keys").alias("key"), *values))


def station_payloads(documents: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Point documents with the stations at their point and the period they cover.

    A landed document is named `<lat>_<lon>_<start>_<end>[_<parameters>].json`.
    """
    part = F.split(F.regexp_replace("file_name", r"\.json$", ""), "_")
    named = documents.select(
        number(F.get(part, F.lit(0))).alias("vl_latitude"), number(F.get(part, F.lit(1))).alias("vl_longitude"),
        F.get(part, F.lit(2)).alias("inicio"), F.get(part, F.lit(3)).alias("fim"), "payload",
    )
    at = coordinates.select("cd_estacao", "vl_latitude", "vl_longitude")
    return named.join(at, ["vl_latitude", "vl_longitude"]).select("cd_estacao", "inicio", "fim", "payload")


def strayed_documents(documents: DataFrame, coordinates: DataFrame) -> DataFrame:
    """File names of the point documents at whose point no station stands."""
    part = F.split(F.regexp_replace("file_name", r"\.json$", ""), "_")
    named = documents.select(
        "file_name", number(F.get(part, F.lit(0))).alias("vl_latitude"), number(F.get(part, F.lit(1))).alias("vl_longitude"))
    return named.join(coordinates, ["vl_latitude", "vl_longitude"], "left_anti").select("file_name")


def _points(payloads: DataFrame, *keep: str) -> DataFrame:
    return payloads.select(*keep, F.from_json("payload", _POINT).alias("p"))


def _unpacked(point: DataFrame, names: Sequence[str], *keep: str) -> DataFrame:
    """One row per key of every parsed payload; a payload without keys gives one with a null key.

    An inner explode would make Spark align every payload twice, once to drop empty ones.
    """
    at = F.col("p.geometry.coordinates")
    series = parameter_series(F.col("p.properties.parameter"), names)
    located = point.select(
        *keep, coordinate(at, 2).alias("lat"), coordinate(at, 1).alias("lon"), *[s.alias(n) for n, s in series.items()])
    zipped = aligned(located, list(series)).select(*keep, "lat", "lon", F.explode_outer("rows").alias("row"))
    return zipped.select(*keep, "lat", "lon", "row.*").toDF(*keep, "lat", "lon", "key", *[f"v{i}" for i in range(len(names))])


def _measures(names: Sequence[str]) -> list[Column]:
    return [grid_value(F.col(f"v{i}")).alias(n.lower()) for i, n in enumerate(names)]


def parameter_names(payloads: DataFrame) -> list[str]:
    """All parameters found in the payloads, in order of their column names."""
    return _point_names(_points(payloads))


def _point_names(point: DataFrame) -> list[str]:
    found = point.select(F.explode(F.map_keys("p.properties.parameter")).alias("name")).distinct().collect()
    return sorted((r["name"] for r in found), key=str.lower)


def grid_daily(payloads: DataFrame) -> DataFrame:
    """(date, lat, lon, t2m, rh2m, prectotcorr); keys that are no date are left out."""
    days = _unpacked(_points(payloads), DAILY_PARAMETERS)
    return days.select(grid_day(F.col("key")).alias("date"), "lat", "lon", *_measures(DAILY_PARAMETERS)).filter(
        F.col("date").isNotNull()
    )


def grid_hourly(payloads: DataFrame, parameters: Sequence[str] | None = None) -> DataFrame:
    """Hours of (cd_estacao, payload) rows with one column per parameter.

    Without `parameters` the payloads are parsed once, into a table of the scratch folder, and all
    that they hold are looked for there. Without a `cd_estacao` column the station is null.
    """
    if "cd_estacao" not in payloads.columns:
        payloads = payloads.withColumn("cd_estacao", F.lit(None).cast("string"))
    point = _points(payloads, "cd_estacao")
    if parameters is None:
        path = scratch_path(payloads.sparkSession, "points")
        point.write.parquet(path)
        point = payloads.sparkSession.read.schema(point.schema).parquet(path)
        parameters = _point_names(point)
    parameters = sorted(parameters, key=str.lower)
    base = ["cd_estacao", "datetime", "data", "hora", "lat", "lon"]
    if not parameters:
        empty = "cd_estacao string, datetime timestamp_ntz, data string, hora bigint, lat double, lon double"
        return payloads.sparkSession.createDataFrame([], empty)
    hours = (
        _unpacked(point, parameters, "cd_estacao")
        .withColumns({"day": grid_hour_day(F.col("key")), "hora": grid_hour(F.col("key"))})
        .filter(F.col("day").isNotNull())
    )
    return hours.withColumns({
        "datetime": naive_timestamp(F.col("day"), F.col("hora")),
        "data": F.col("day").cast("string"),
    }).select(*base, *_measures(parameters))
