"""Station-from-grid bias fit per station and month, with a fallback cascade.

One pass over the hourly frame reduces it to sums per station and month. The station and
global levels are added up from those sums, not from the hours, so the hours are read,
joined and aggregated once, whatever the number of levels and variables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from heatherd.functions.text import iso_date
from heatherd.session import broadcast_if

# Fixed value: paired hours needed before a level may be used.
MIN_SAMPLES = 100

# variable -> (grid predictor, observation)
VARIABLES = {"temp": ("t2m", "temp"), "rh": ("rh2m", "rh")}
LEVELS = ("cell", "station", "global")
STATISTICS = ("n", "mx", "my", "sx", "sy", "r")

# Sums are taken around the middle of each variable's physical range, which keeps their precision.
CENTRES = {"temp": 20.0, "rh": 50.0}

# A cell is a (station, month); a code table can name at most these months (two digits, or none).
MONTHS_PER_STATION = 101


def _pair_sums(variable: str, use: Column) -> list[Column]:
    """Sums over the hours with predictor and observation, and the ends of both ranges."""
    x, y = (F.col(c) for c in VARIABLES[variable])
    both = use & x.isNotNull() & y.isNotNull()
    dx, dy = F.when(both, x - CENTRES[variable]), F.when(both, y - CENTRES[variable])
    sums = {"n": F.count(dx), "x": F.sum(dx), "y": F.sum(dy), "xx": F.sum(dx * dx), "yy": F.sum(dy * dy), "xy": F.sum(dx * dy)}
    ends = {"x0": F.min(dx), "x1": F.max(dx), "y0": F.min(dy), "y1": F.max(dy)}
    first = {"first": F.min(F.when(y.isNotNull(), F.col("day"))), "seen": F.count(y)}
    return [c.alias(f"{variable}_{k}") for k, c in (sums | ends | first).items()]


def cell_sums(frame: DataFrame, use: Column | None = None, scope: str | None = None) -> DataFrame:
    """Counts and sums per (scope, station, month), the first day each variable was observed and its observed hours.

    `use` picks the rows to fit on. Cells without such rows stay in, so the result covers
    every station and month of the frame.
    """
    use = F.lit(True) if use is None else use
    scope_column = (F.lit("all") if scope is None else F.col(scope)).alias("scope")
    days = frame.withColumn("day", iso_date(F.col("data")))
    return days.groupBy(scope_column, "cd_estacao", "mes").agg(*[s for v in VARIABLES for s in _pair_sums(v, use)])


def _merged(variable: str) -> list[Column]:
    how = {"x0": F.min, "x1": F.max, "y0": F.min, "y1": F.max, "first": F.min}
    names = ("n", "x", "y", "xx", "yy", "xy", "seen", *how)
    return [how.get(k, F.sum)(f"{variable}_{k}").alias(f"{variable}_{k}") for k in names]


def _statistics(variable: str) -> Column:
    n, x, y, xx, yy, xy, x0, x1, y0, y1 = (
        F.col(f"{variable}_{k}") for k in ("n", "x", "y", "xx", "yy", "xy", "x0", "x1", "y0", "y1")
    )

    def deviation(square: Column, total: Column, low: Column, high: Column) -> Column:
        spread = F.sqrt(F.greatest(square - total * total / n, F.lit(0.0)) / (n - 1))
        return F.when(n > 1, F.when(low == high, F.lit(0.0)).otherwise(spread))

    sx, sy = deviation(xx, x, x0, x1), deviation(yy, y, y0, y1)
    mx, my = (CENTRES[variable] + F.try_divide(total, n) for total in (x, y))
    r = F.try_divide(xy - F.try_divide(x * y, n), (n - 1) * sx * sy)
    values = {"n": n, "mx": mx, "my": my, "sx": sx, "sy": sy, "r": r, "first": F.col(f"{variable}_first"), "seen": F.col(f"{variable}_seen")}
    return F.struct(*[c.alias(k) for k, c in values.items()]).alias(variable)


def fit_levels(cells: DataFrame) -> DataFrame:
    """Paired statistics of every cell, station and scope, told apart by `level`.

    One struct per variable holds n, the means mx and my, the deviations sx and sy, the
    correlation r of predictor and observation, the first observed day and the observed hours.
    """
    keys = [F.col("scope"), F.col("cd_estacao"), F.col("mes")]
    merged = cells.groupingSets([keys, keys[:2], keys[:1]], *keys).agg(
        F.grouping_id().alias("gid"), *[m for v in VARIABLES for m in _merged(v)]
    )
    level = F.when(F.col("gid") == 0, LEVELS[0]).when(F.col("gid") == 1, LEVELS[1]).otherwise(LEVELS[2])
    return merged.select(
        "scope", "cd_estacao", "mes", level.alias("level"), *[_statistics(v) for v in VARIABLES]
    )


def fit_parameters(levels: DataFrame, min_samples: int = MIN_SAMPLES, scope_bound: int | None = None) -> DataFrame:
    """Parameters of every (station, month): from the cell, else the station, else the scope.

    A level is used when it has enough pairs and a predictor that varies; the last level
    is used as it is. A station has few months, so its own row reaches them by a window.
    """
    own = Window.partitionBy("scope", "cd_estacao")
    station = F.when(F.col("level") == LEVELS[1], F.struct(*VARIABLES))
    last = levels.filter(F.col("level") == LEVELS[2]).select("scope", F.struct(*VARIABLES).alias("last"))
    cells = (
        levels.withColumn("station", F.max(station).over(own))
        .filter(F.col("level") == LEVELS[0])
        .join(broadcast_if(last, scope_bound), "scope", "left")
    )

    def usable(statistics: Column) -> Column:
        return (statistics["n"] >= min_samples) & (statistics["sx"] > 0)

    def pick(v: str) -> list[Column]:
        cell, wider, last = F.col(v), F.col("station")[v], F.col("last")[v]
        chosen = F.when(usable(cell), cell).when(usable(wider), wider).otherwise(last)
        level = F.when(usable(cell), LEVELS[0]).when(usable(wider), LEVELS[1]).otherwise(LEVELS[2])
        return [chosen.alias(f"{v}_fit"), level.alias(f"{v}_level")]

    return cells.select(
        "cd_estacao", "mes", F.col("station.temp.first").alias("first_observed"),
        (F.col("station.temp.seen") + F.col("station.rh.seen")).alias("observed_hours"),
        *[c for v in VARIABLES for c in pick(v)],
    )


def fit(
    frame: DataFrame,
    use: Column | None = None,
    min_samples: int = MIN_SAMPLES,
    scope: str | None = None,
    station_bound: int | None = None,
) -> DataFrame:
    """Parameters for the stations and months of the frame. Without a scope there is one last level."""
    levels = fit_levels(cell_sums(frame, use, scope))
    return fit_parameters(levels, min_samples, scope_bound=1 if scope is None else station_bound)
