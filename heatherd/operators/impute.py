"""Bias correction, hourly imputation and the imputed daily table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heatherd.functions.climate import (
    GRIDDED, OBSERVED, day_origin, day_type, heat_index, hour_source, imputed_fraction,
    qc_humidity, qc_temperature,
)
from heatherd.functions.text import iso_date
from heatherd.operators.fit import MIN_SAMPLES, MONTHS_PER_STATION, VARIABLES, fit
from heatherd.session import broadcast_if

METHODS = ("scaling", "linear")
CHECKS = {"temp": qc_temperature, "rh": qc_humidity}

DAILY_COLUMNS = [
    "cd_estacao", "data", "temp_med", "temp_max", "umid_med", "umid_min", "itu_med", "itu_max",
    "temp_origem", "umid_origem", "temp_frac_imp", "umid_frac_imp", "itu_imputado",
    "n_horas", "n_temp_obs", "n_umid_obs",
]


def corrected(variable: str, method: str) -> Column:
    """Grid value moved to the station's mean and spread.

    `scaling` keeps the variance of the station; `linear` is the least-squares line.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; choose one of {METHODS}")
    p = F.col(f"{variable}_fit")
    slope = F.try_divide(p["sy"], p["sx"])
    slope = p["r"] * slope if method == "linear" else slope
    return p["my"] + slope * (F.col(VARIABLES[variable][0]) - p["mx"])


def correct(
    frame: DataFrame, parameters: DataFrame, method: str = "scaling", station_bound: int | None = None, parameter_rows: int | None = None
) -> DataFrame:
    """Adds `temp_corr` and `rh_corr`, the range-checked corrected grid values.

    The parameter table has one row per station and month. `station_bound`, a known limit
    on the number of stations, proves it small enough to broadcast; without it, or beyond
    the limit, Spark joins by shuffle and splits skewed months itself. `parameter_rows`, the
    counted rows of a stored table, is a closer bound.
    """
    max_rows = parameter_rows
    if max_rows is None and station_bound is not None:
        max_rows = station_bound * MONTHS_PER_STATION
    names = [c for c in parameters.columns if c not in ("cd_estacao", "mes", "first_observed", "observed_hours")]
    return (
        frame.join(broadcast_if(parameters, max_rows), ["cd_estacao", "mes"], "left")
        .withColumns({f"{v}_corr": corrected(v, method) for v in VARIABLES})
        .withColumns({f"{v}_corr": check(F.col(f"{v}_corr")) for v, check in CHECKS.items()})
        .drop(*names)
    )


def impute_hourly(
    frame: DataFrame,
    method: str = "scaling",
    min_samples: int = MIN_SAMPLES,
    station_bound: int | None = None,
    scope: str | None = None,
    parameters: DataFrame | None = None,
    parameter_rows: int | None = None,
) -> DataFrame:
    """Observed hours stay; missing hours take the corrected grid value, tagged by source.

    Without `parameters` they are fitted on the frame itself.
    """
    if parameters is None:
        parameters = fit(frame, min_samples=min_samples, scope=scope, station_bound=station_bound)
    added = {}
    for v in VARIABLES:
        added[f"{v}_imp"] = F.coalesce(F.col(v), F.col(f"{v}_corr"))
        added[f"{v}_src"] = hour_source(F.col(v), F.col(f"{v}_corr"))
    return correct(frame, parameters, method, station_bound, parameter_rows).withColumns(added)


def aggregate_daily(hourly: DataFrame, temp: str = "temp_imp", rh: str = "rh_imp", carry: tuple[str, ...] = ()) -> DataFrame:
    """Daily climate with heat index, origin and imputed share. `carry` keeps per-station columns."""
    counts = {
        f"_{v}_{s}": F.count_if(F.col(f"{v}_src") == s) for v in VARIABLES for s in (OBSERVED, GRIDDED)
    }
    daily = hourly.groupBy("cd_estacao", "data").agg(
        F.avg(temp).alias("temp_med"), F.max(temp).alias("temp_max"),
        F.avg(rh).alias("umid_med"), F.min(rh).alias("umid_min"),
        F.count(F.lit(1)).alias("n_horas"),
        *[c.alias(n) for n, c in counts.items()],
        *[F.max(c).alias(c) for c in carry],
    )
    t_obs, t_imp, r_obs, r_imp = (F.col(n) for n in counts)
    t_frac, r_frac = imputed_fraction(t_obs, t_imp), imputed_fraction(r_obs, r_imp)
    return daily.withColumns({
        "data": iso_date(F.col("data")),
        "itu_med": heat_index(F.col("temp_med"), F.col("umid_med")),
        "itu_max": heat_index(F.col("temp_max"), F.col("umid_min")),
        "temp_origem": day_origin(t_obs, t_imp), "umid_origem": day_origin(r_obs, r_imp),
        "temp_frac_imp": t_frac, "umid_frac_imp": r_frac,
        "itu_imputado": (t_frac > 0) | (r_frac > 0),
        "n_temp_obs": t_obs, "n_umid_obs": r_obs,
    }).select(*DAILY_COLUMNS, *carry)


def impute_daily(
    frame: DataFrame,
    method: str = "scaling",
    min_samples: int = MIN_SAMPLES,
    station_bound: int | None = None,
    scope: str | None = None,
    only_observed_stations: bool = False,
) -> DataFrame:
    """The imputed daily table with the type of every day.

    The first observed day of a station and its observed hours come with its fit parameters, so
    typing the days, or leaving out stations that never observed anything, needs neither a
    second pass nor a shuffle by station. Stations are left out by day, not by hour: a filter on
    the hours would make the join with the parameters an inner one, and Spark, which takes an
    exploded grid for few bytes, could then broadcast all hours.
    """
    hourly = impute_hourly(frame, method, min_samples, station_bound, scope)
    daily = aggregate_daily(hourly, carry=("first_observed", "observed_hours"))
    if only_observed_stations:
        daily = daily.filter(F.col("observed_hours") > 0)
    kind = day_type(F.col("temp_origem"), F.col("data"), F.col("first_observed"))
    return daily.withColumn("tipo", kind).drop("first_observed", "observed_hours")


def first_observed_days(daily: DataFrame) -> DataFrame:
    """First day with an observed temperature hour, and all observed hours, per station."""
    seen = F.col("temp_origem") != GRIDDED
    return daily.groupBy("cd_estacao").agg(
        F.min(F.when(seen, F.col("data"))).alias("first_observed"),
        F.sum(F.col("n_temp_obs") + F.col("n_umid_obs")).alias("observed_hours"),
    )


def add_day_type(daily: DataFrame, only_observed_stations: bool = False, station_bound: int | None = None) -> DataFrame:
    """`tipo` for a daily table that holds the whole series of its stations.

    Optionally drops stations without any observed hour: their days would be pure grid.
    """
    stations = first_observed_days(daily)
    if only_observed_stations:
        stations = stations.filter(F.col("observed_hours") > 0)
    how = "inner" if only_observed_stations else "left"
    kind = day_type(F.col("temp_origem"), F.col("data"), F.col("first_observed"))
    return (
        daily.join(broadcast_if(stations, station_bound), "cd_estacao", how)
        .withColumn("tipo", kind)
        .drop("first_observed", "observed_hours")
    )


def offset_fill(paired: DataFrame, station_bound: int | None = None) -> DataFrame:
    """Alternative fill: grid temperature plus the station's mean difference to the grid."""
    offsets = paired.groupBy("cd_estacao").agg(F.avg(F.col("temp") - F.col("t2m")).alias("offset"))
    return paired.join(broadcast_if(offsets, station_bound), "cd_estacao", "left").withColumn(
        "temp_imputada", F.coalesce(F.col("temp"), F.col("t2m") + F.col("offset"))
    )
