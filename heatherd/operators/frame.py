"""Hourly observations and the hourly frame: the grid with the observations beside it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from heatherd.functions.climate import qc_humidity, qc_temperature
from heatherd.functions.text import decimal_comma, hour_of, month_of, year_of
from heatherd.session import broadcast_if, colocates_by_day

# Measure columns of the hourly history.
TEMPERATURE_COLUMN = "temperatura_do_ar_bulbo_seco_horaria_c"
HUMIDITY_COLUMN = "umidade_relativa_do_ar_horaria"

HOUR_KEY = ["cd_estacao", "data", "hora"]


def keep_stations(df: DataFrame, codes: Sequence[str] | DataFrame | None, max_codes: int | None = None) -> DataFrame:
    """Rows of the given stations; no codes keeps all rows.

    A list becomes a pushed-down filter, a table a semi join. `max_codes` is a known
    bound on the table's rows and allows a broadcast.
    """
    if codes is None:
        return df
    if isinstance(codes, DataFrame):
        return df.join(broadcast_if(codes.select("cd_estacao"), max_codes), "cd_estacao", "left_semi")
    return df.filter(F.col("cd_estacao").isin(list(codes)))


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames with columns matched by name.

    A column that a frame lacks is null there; of different numeric types the wider one is kept.
    """
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def hourly_observations(
    history: DataFrame,
    codes: Sequence[str] | DataFrame | None = None,
    temperature: str = TEMPERATURE_COLUMN,
    humidity: str = HUMIDITY_COLUMN,
    max_codes: int | None = None,
) -> DataFrame:
    """One row per station, day and hour: the mean of the readings that pass the range checks.

    Where the session allows it the readings are placed by station and day before they are
    merged, and the hourly frame needs no second shuffle. An archive has one reading an hour,
    so merging before the shuffle would save nothing.
    """
    history = keep_stations(history, codes, max_codes)
    if colocates_by_day(history.sparkSession):
        history = history.select("cd_estacao", "data", "hora_utc", temperature, humidity).repartition("cd_estacao", "data")
    return (
        history.select(
            "cd_estacao", "data", hour_of(F.col("hora_utc")).alias("hora"),
            decimal_comma(F.col(temperature)).alias("temp"), decimal_comma(F.col(humidity)).alias("rh"),
        )
        .groupBy(HOUR_KEY)
        .agg(F.avg(qc_temperature(F.col("temp"))).alias("temp"), F.avg(qc_humidity(F.col("rh"))).alias("rh"))
    )


def observed_hours(
    history: DataFrame, codes: Sequence[str] | DataFrame | None = None, max_codes: int | None = None
) -> DataFrame:
    """Hourly observations from the raw history; a table that holds them merged already is taken as it is."""
    if {"hora", "temp", "rh"} <= set(history.columns):
        return keep_stations(history.select(*HOUR_KEY, "temp", "rh"), codes, max_codes)
    return hourly_observations(history, codes, max_codes=max_codes)


def hourly_frame(grid: DataFrame, observations: DataFrame, placed: bool = False) -> DataFrame:
    """Every grid hour with the observation of that hour, if any, and its month and year.

    Both sides are placed by station and day where the session allows a join on such
    a placement. A day has 24 hours, so no partition gets heavy however long the series
    of one station is, and the daily aggregation that follows needs no second shuffle.
    Tables that are stored this way (`placed`) are joined where they lie.
    """
    columns = HOUR_KEY + [c for c in ("t2m", "rh2m", "batch") if c in grid.columns]
    grid = grid.select(columns)
    if not placed and colocates_by_day(grid.sparkSession):
        grid = grid.repartition("cd_estacao", "data")  # as the observations are
    return grid.join(observations, HOUR_KEY, "left").withColumns(
        {"mes": month_of(F.col("data")), "ano": year_of(F.col("data"))}
    )


def observations_with_grid(observations: DataFrame, grid: DataFrame) -> DataFrame:
    """The opposite preserved side: every observation with the grid value of its hour.

    The grid is never broadcast: days and stations are exploded to hours, which Spark's size
    estimate does not see, and all hours would pass through the driver. Both sides are sorted
    and merged, placed by station and day as the observations are.
    """
    hours = grid.select(*HOUR_KEY, "t2m", "rh2m").hint("merge")
    return observations.join(hours, HOUR_KEY, "left")
