"""Daily climate from the hourly history and from the live daily payload."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from heatherd.functions.climate import heat_index, qc_humidity, qc_temperature
from heatherd.functions.text import decimal_comma, iso_date, number
from heatherd.operators.frame import HUMIDITY_COLUMN, TEMPERATURE_COLUMN


def missing_columns(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n not in df.columns]


def guard_report(tables: dict[str, DataFrame], *names: str) -> DataFrame:
    """(tabela, faltando, linhas): what `require_columns` would say of each table, and its rows."""
    rows = [
        df.agg(F.lit(name).alias("tabela"), F.lit(", ".join(missing_columns(df, *names)) or None).cast("string").alias("faltando"),
               F.count(F.lit(1)).alias("linhas"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, rows)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = missing_columns(df, *names)
    if missing:
        raise RuntimeError(f"expected columns missing: {missing}; available={df.columns[:8]}")


def daily_climate(history: DataFrame, temperature: str = TEMPERATURE_COLUMN, humidity: str = HUMIDITY_COLUMN) -> DataFrame:
    """Station-days with mean and extreme values of the readings that pass the range checks."""
    require_columns(history, temperature, humidity)
    return (
        # parsed once in a projection of its own, because the checks read each value several times
        history.select(
            "cd_estacao", iso_date(F.col("data")).alias("data"),
            decimal_comma(F.col(temperature)).alias("temp"), decimal_comma(F.col(humidity)).alias("rh"),
        )
        .withColumns({"temp": qc_temperature(F.col("temp")), "rh": qc_humidity(F.col("rh"))})
        .groupBy("cd_estacao", "data")
        .agg(
            F.avg("temp").alias("temp_med"), F.max("temp").alias("temp_max"),
            F.avg("rh").alias("umid_med"), F.min("rh").alias("umid_min"),
        )
        .withColumns({
            "itu_med": heat_index(F.col("temp_med"), F.col("umid_med")),
            "itu_max": heat_index(F.col("temp_max"), F.col("umid_min")),
        })
    )


def between_days(daily: DataFrame, station: str, first: str, last: str) -> DataFrame:
    """One station's days in a closed interval; both conditions reach the Parquet scan."""
    return daily.filter(
        (F.col("cd_estacao") == station) & F.col("data").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def live_daily(payloads: DataFrame) -> DataFrame:
    """Days from live payloads: rows of (station_code, payload), the payload a JSON list.

    Keys are matched in any letter case; a missing measure is null; an empty list gives no rows.
    """
    days = payloads.select(
        "station_code", F.explode_outer(F.from_json("payload", "array<map<string,string>>")).alias("day")
    ).filter(F.col("day").isNotNull())

    def field(name: str) -> Column:
        same = F.filter(F.map_entries("day"), lambda e: F.lower(e["key"]) == name)
        return F.try_element_at(same, F.lit(1))["value"]

    checks = {"temp_med": qc_temperature, "temp_max": qc_temperature, "umid_med": qc_humidity, "umid_min": qc_humidity}
    parsed = days.select(
        iso_date(field("dt_medicao")).alias("date"), "station_code", *[number(field(c)).alias(c) for c in checks]
    )
    return parsed.withColumns({c: check(F.col(c)) for c, check in checks.items()}).withColumns({
        "itu_med": heat_index(F.col("temp_med"), F.col("umid_med")),
        "itu_max": heat_index(F.col("temp_max"), F.col("umid_min")),
    })
