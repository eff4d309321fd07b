"""Imputation error measured by holding out whole years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from heatherd.functions.climate import GRIDDED, heat_index, stress_class
from heatherd.functions.text import iso_date
from heatherd.operators.fit import MIN_SAMPLES, VARIABLES, fit
from heatherd.operators.impute import aggregate_daily, correct
from heatherd.session import broadcast_if

# Fixed value: observed hours that make a day complete.
MIN_HOURS = 23

DAILY_MEASURES = ("temp_med", "temp_max", "itu_med", "itu_max")
METRICS = ("n", "rmse", "mae", "bias", "r2", "var_ratio")


def error_metrics(truth: Column, predicted: Column) -> Column:
    """Errors over the pairs with both values, as one struct; no pairs give n = 0 and nulls."""
    both = truth.isNotNull() & predicted.isNotNull()
    t, p = F.when(both, truth), F.when(both, predicted)
    e = p - t
    n = F.count(t)
    return F.struct(
        n.alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e).alias("bias"),
        (1 - F.try_divide(F.sum(e * e), F.nullif(F.var_pop(t) * n, F.lit(0.0)))).alias("r2"),
        F.try_divide(F.stddev_pop(p), F.nullif(F.stddev_pop(t), F.lit(0.0))).alias("var_ratio"),
    )


def _one_row_per(names: Sequence[str], wide: DataFrame, *keys: str) -> DataFrame:
    """Turns one metric struct per column into one row per variable."""
    rows = F.array(*[F.struct(F.lit(n).alias("var"), F.col(n).alias("m")) for n in names])
    return wide.select(*keys, F.inline(rows)).select(*keys, "var", *[f"m.{m}" for m in METRICS])


def score_frame(
    frame: DataFrame,
    years: Sequence[int],
    method: str = "scaling",
    min_samples: int = MIN_SAMPLES,
    station_bound: int | None = None,
) -> DataFrame:
    """Test-year hours with the correction fitted on all other years."""
    held_out = F.col("ano").isin(list(years))
    parameters = fit(frame, use=~held_out, min_samples=min_samples)
    return correct(frame.filter(held_out), parameters, method, station_bound)


def hourly_errors(scored: DataFrame) -> DataFrame:
    wide = scored.agg(*[error_metrics(F.col(v), F.col(f"{v}_corr")).alias(v) for v in VARIABLES])
    return _one_row_per(list(VARIABLES), wide)


def station_errors(scored: DataFrame, stations: DataFrame | None = None, station_bound: int | None = None) -> DataFrame:
    """Hourly errors per station. Stations given but never scored show n = 0."""
    wide = scored.groupBy("cd_estacao").agg(
        *[error_metrics(F.col(v), F.col(f"{v}_corr")).alias(v) for v in VARIABLES]
    )
    if stations is not None:
        wide = stations.select("cd_estacao").join(broadcast_if(wide, station_bound), "cd_estacao", "left")
    rows = _one_row_per(list(VARIABLES), wide, "cd_estacao")
    return rows.withColumn("n", F.coalesce(F.col("n"), F.lit(0)))


def complete_days(scored: DataFrame, min_hours: int = MIN_HOURS) -> DataFrame:
    """Fully observed test days beside the same days predicted from the grid alone.

    Truth and prediction come from one aggregation by station and day.
    """
    truth = {
        "n_obs_t": F.count("temp"), "n_obs_r": F.count("rh"),
        "temp_med": F.avg("temp"), "temp_max": F.max("temp"),
        "umid_med": F.avg("rh"), "umid_min": F.min("rh"),
    }
    predicted = {
        "temp_med_pred": F.avg("temp_corr"), "temp_max_pred": F.max("temp_corr"),
        "umid_med_pred": F.avg("rh_corr"), "umid_min_pred": F.min("rh_corr"),
    }
    days = (
        scored.groupBy("cd_estacao", "data")
        .agg(*[c.alias(n) for n, c in (truth | predicted).items()])
        .filter((F.col("n_obs_t") >= min_hours) & (F.col("n_obs_r") >= min_hours))
        .withColumn("data", iso_date(F.col("data")))
        .filter(F.col("data").isNotNull())
    )
    index = {}
    for s in ("", "_pred"):
        index[f"itu_med{s}"] = heat_index(F.col(f"temp_med{s}"), F.col(f"umid_med{s}"))
        index[f"itu_max{s}"] = heat_index(F.col(f"temp_max{s}"), F.col(f"umid_min{s}"))
    return days.withColumns(index)


def join_days(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """The same pairing for two separate daily tables: inner join, `_pred` on the right side."""
    keys = ["cd_estacao", "data"]
    renamed = predicted.withColumnsRenamed({c: f"{c}_pred" for c in predicted.columns if c not in keys})
    return truth.join(renamed, keys)


def predicted_days(scored: DataFrame) -> DataFrame:
    """Test days aggregated from the corrected grid alone, in the shape of the imputed daily table."""
    tagged = scored.withColumns({f"{v}_src": F.lit(GRIDDED) for v in VARIABLES})
    return aggregate_daily(tagged, "temp_corr", "rh_corr")


def daily_errors(days: DataFrame) -> DataFrame:
    wide = days.agg(*[error_metrics(F.col(m), F.col(f"{m}_pred")).alias(m) for m in DAILY_MEASURES])
    return _one_row_per(DAILY_MEASURES, wide)


def class_flips(days: DataFrame) -> DataFrame:
    """Complete days and the share of them, in percent, whose stress class changes."""
    changed = stress_class(F.col("itu_max")) != stress_class(F.col("itu_max_pred"))
    return days.agg(
        F.count(F.lit(1)).alias("n_dias_completos"),
        (F.avg(changed.cast("double")) * 100).alias("itu_max_class_flip_pct"),
    )
