"""Range checks, heat index, and the labels of imputed days."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Physical bounds, stress breaks (left-closed) and their labels.
TEMPERATURE_RANGE = (-10.0, 50.0)
HUMIDITY_RANGE = (0.0, 100.0)
STRESS_BREAKS = (72.0, 79.0, 89.0)
STRESS_LABELS = ("conforto", "leve", "moderado", "severo")

# Where an hour or a day comes from, and the kind of a day.
OBSERVED, GRIDDED, MIXED = "inmet", "nasa", "misto"
DAY_OBSERVED, DAY_GAP, DAY_BEFORE = "observado", "gap-fill", "backfill"


def in_range(value: Column, bounds: tuple[float, float]) -> Column:
    """Null outside the bounds. NaN sorts above every number, so it is outside too."""
    low, high = bounds
    return F.when(~((value < low) | (value > high)), value)


def qc_temperature(value: Column) -> Column:
    return in_range(value, TEMPERATURE_RANGE)


def qc_humidity(value: Column) -> Column:
    return in_range(value, HUMIDITY_RANGE)


def heat_index(temperature: Column, humidity: Column) -> Column:
    return 0.8 * temperature + (humidity * (temperature - 14.3)) / 100 + 46.3


def stress_class(index: Column, breaks: tuple[float, ...] = STRESS_BREAKS) -> Column:
    """0 below the first break, then one more for every break reached."""
    return sum(((index >= b).cast("int") for b in breaks[1:]), (index >= breaks[0]).cast("int"))


def stress_label(index: Column) -> Column:
    *below, top = STRESS_LABELS
    label = F.when(index >= STRESS_BREAKS[-1], top)
    for limit, name in reversed(list(zip(STRESS_BREAKS, below))):
        label = F.when(index < limit, name).otherwise(label)
    return label


def hour_source(observed: Column, corrected: Column) -> Column:
    return F.when(observed.isNotNull(), OBSERVED).when(corrected.isNotNull(), GRIDDED)


def day_origin(n_observed: Column, n_imputed: Column) -> Column:
    return (
        F.when(n_observed + n_imputed == 0, None)
        .when(n_imputed == 0, OBSERVED)
        .when(n_observed == 0, GRIDDED)
        .otherwise(MIXED)
    )


def imputed_fraction(n_observed: Column, n_imputed: Column) -> Column:
    return F.try_divide(n_imputed.cast("double"), n_observed + n_imputed)


def day_type(origin: Column, day: Column, first_observed: Column) -> Column:
    """A day without any hour has no origin and is never an observed day."""
    return (
        F.when(origin != GRIDDED, DAY_OBSERVED)
        .when(first_observed.isNull() | (day < first_observed), DAY_BEFORE)
        .otherwise(DAY_GAP)
    )
