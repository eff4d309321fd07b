"""Weather-like tables derived from the star-schema sample tables.

The sample tables hold no weather. One `lineitem` row becomes one station reading:
the supplier gives the station, the ship date the day, the order the hour of a
six-hour day, and quantity, discount and tax the measured values.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heatherd.operators.frame import HUMIDITY_COLUMN, TEMPERATURE_COLUMN

ROWS_PER_STATION = 12_000
HOURS_PER_DAY = 6
LATE_STATION, LATE_START = 4, "1996-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=64)
def _rows(application: str, sf_dir: str) -> int:
    return table(SparkSession.active(), sf_dir, "lineitem").count()


def reading_count(spark: SparkSession, sf_dir: str) -> int:
    """Counted once per session, from the Parquet footers."""
    return _rows(spark.sparkContext.applicationId, sf_dir)


def station_count(spark: SparkSession, sf_dir: str) -> int:
    """Known on the driver; bounds every per-station table."""
    return max(5, reading_count(spark, sf_dir) // ROWS_PER_STATION)


def code(station: Column) -> Column:
    """Three digits or, where a number needs them, more."""
    digits = station.cast("string")
    return F.concat(F.lit("A"), F.lpad(digits, F.greatest(F.length(digits), F.lit(3)), F.lit("0")))


def season(day: Column, station: Column, hour: Column) -> Column:
    doy = F.dayofyear(day)
    return 15 + F.abs(((doy + 7 * station) % 365) - 182) / F.lit(20.0) + hour / F.lit(2.0)


def readings(spark: SparkSession, sf_dir: str, late_start: bool = False) -> DataFrame:
    """One typed reading per `lineitem` row, with missing and out-of-range values.

    With `late_start` one station has no values before its first year.
    """
    day = F.to_date("l_shipdate")
    doy = F.dayofyear("day")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate"
    )
    rows = lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        (F.col("l_suppkey") % station_count(spark, sf_dir)).alias("station"),
        day.alias("day"),
        (F.col("l_orderkey") % HOURS_PER_DAY).alias("hora"),
    )
    measured_t = F.when(F.col("l_discount") == 0.10, F.lit(99.0)).otherwise(
        season(F.col("day"), F.col("station"), F.col("hora")) + (F.col("l_quantity") - 25) / F.lit(10.0)
    )
    measured_h = F.when(F.col("l_discount") == 0.09, F.lit(-5.0)).otherwise(
        50 + ((doy + F.col("hora")) % 30) + F.col("l_tax") * F.lit(100.0)
    )
    off = (F.col("station") == LATE_STATION) & (F.col("day") < F.lit(LATE_START).cast("date"))
    off = off if late_start else F.lit(False)
    return rows.select(
        "l_orderkey", "l_linenumber", "station", code(F.col("station")).alias("cd_estacao"), "day", "hora",
        F.when(~off & (F.col("l_linenumber") != 7), measured_t).alias("temp"),
        F.when(~off & (F.col("l_linenumber") != 6), measured_h).alias("rh"),
    )


def comma_text(value: Column) -> Column:
    return F.coalesce(F.replace(value.cast("string"), F.lit("."), F.lit(",")), F.lit("-9999"))


def history(spark: SparkSession, sf_dir: str, late_start: bool = False) -> DataFrame:
    """The readings as an all-text hourly history with three hour formats."""
    hh = F.lpad(F.col("hora").cast("string"), 2, "0")
    hour_text = (
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(hh, F.lit("00 UTC")))
        .when(F.col("l_linenumber") % 3 == 1, F.concat(hh, F.lit(":00:00")))
        .otherwise(F.concat(hh, F.lit(":00")))
    )
    return readings(spark, sf_dir, late_start).select(
        "l_orderkey", "l_linenumber", "cd_estacao",
        F.col("day").cast("string").alias("data"),
        hour_text.alias("hora_utc"),
        comma_text(F.col("temp")).alias(TEMPERATURE_COLUMN),
        comma_text(F.col("rh")).alias(HUMIDITY_COLUMN),
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A complete hourly grid: all days, all stations and one station that never observes."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = station_count(spark, sf_dir)
    doy, st, hora = F.dayofyear("day"), F.col("station"), F.col("hora")
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.to_date("l_shipdate").alias("day"))
        .distinct()
        .select("day", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("station"))
        .repartition(parts, "day", "station")  # the few days sit in one partition
        .select("day", "station", F.explode(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1))).alias("hora"))
        .select(
            code(st).alias("cd_estacao"),
            F.col("day").cast("string").alias("data"),
            hora.cast("bigint").alias("hora"),
            (F.lit(0.9) * season(F.col("day"), st, hora) + 1.5
             + ((doy * 7 + hora * 13 + st) % 11) / F.lit(10.0)).alias("t2m"),
            (48 + ((doy + hora) % 30) + ((doy * 3 + st) % 7)).cast("double").alias("rh2m"),
        )
    )


def grid_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the stations of the grid."""
    return spark.range(station_count(spark, sf_dir) + 1).select(code(F.col("id")).alias("cd_estacao"))


def station_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a registered station."""
    return table(spark, sf_dir, "supplier").select(
        code(F.col("s_suppkey")).alias("cd_estacao"),
        F.col("s_name").alias("dc_nome"),
        "s_suppkey", "s_nationkey", "s_acctbal",
    )
