"""Imputation of the whole network: resumable and incremental by station, and its sampled validation."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heatherd.operators.fit import MIN_SAMPLES, STATISTICS, VARIABLES, cell_sums, fit_levels, fit_parameters
from heatherd.operators.frame import HOUR_KEY, HUMIDITY_COLUMN, TEMPERATURE_COLUMN, hourly_frame, keep_stations, observed_hours, union_frames
from heatherd.operators.holdout import score_frame
from heatherd.operators.impute import add_day_type, aggregate_daily, impute_daily, impute_hourly
from heatherd.operators.stations import sample_stations, station_batches, station_coordinates
from heatherd.session import broadcast_if, remove_table, written
from heatherd.sources.tables import WRITER, recover_table, write_table

BATCH_SIZE = 20
READING_COLUMNS = ("cd_estacao", "data", "hora_utc", "hora", TEMPERATURE_COLUMN, HUMIDITY_COLUMN, "temp", "rh")
PARAMETER_DIGITS = 10  # the last bits of a sum depend on the order in which Spark adds


def run_folder(staging: str, method: str, years: tuple[int, int] | None, min_samples: int) -> str:
    """Runs with other results stage in other folders."""
    span = "all" if years is None else f"{years[0]:04d}-{years[1]:04d}"
    return f"{staging.rstrip('/')}/{method}-{min_samples}-{span}"


def within_years(grid: DataFrame, years: tuple[int, int] | None) -> DataFrame:
    """ISO text sorts like dates, so the bounds are pushed down to the scan."""
    if years is None:
        return grid
    return grid.filter(F.col("data").between(f"{years[0]:04d}-01-01", f"{years[1]:04d}-12-31"))


# Fingerprints


def content_sums(df: DataFrame, source: str) -> DataFrame:
    """(cd_estacao, ano, fonte, linhas, alto, baixo): what a table holds of each station and year.

    The sums of both halves of a row hash do not depend on the order of rows and count repeated
    ones, so they are added up before the shuffle and a station with very many rows is no hot key.
    """
    values = [c for c in df.columns if c != "cd_estacao"]
    # a null leaves a hash as it is; its place is told by the flag
    mark = F.xxhash64(*[part for c in values for part in (F.col(c).isNull(), F.col(c))])
    return df.groupBy("cd_estacao", F.substring("data", 1, 4).alias("ano")).agg(
        F.lit(source).alias("fonte"), F.count(F.lit(1)).alias("linhas"),
        F.sum(F.shiftrightunsigned(mark, 32)).alias("alto"), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("baixo"))


def input_sums(grid: DataFrame, history: DataFrame, stations: DataFrame, station_bound: int | None = None) -> DataFrame:
    """Content of the grid and of the readings of the stations, by year."""
    readings = history.select([c for c in READING_COLUMNS if c in history.columns])
    sums = [
        content_sums(keep_stations(df, stations, station_bound), source)
        for source, df in (("grid", grid.select(*HOUR_KEY, "t2m", "rh2m")), ("history", readings))
    ]
    return sums[0].union(sums[1])


def changed_periods(before: DataFrame, after: DataFrame) -> DataFrame:
    """(cd_estacao, ano, fonte, mudanca): station years that are new, changed or gone between two tables of sums."""
    key, values = ["cd_estacao", "ano", "fonte"], F.struct("linhas", "alto", "baixo")
    old, new = before.select(*key, values.alias("old")), after.select(*key, values.alias("new"))
    change = (
        F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "gone").when(F.col("old") != F.col("new"), "changed")
    )
    return old.join(new, key, "full").withColumn("mudanca", change).filter("mudanca IS NOT NULL").drop("old", "new")


def _digest(rows: Column) -> Column:
    """One hash of the few rows of a group, whatever their order."""
    return F.md5(F.to_json(F.array_sort(F.collect_list(rows)), {"ignoreNullFields": "false"}))


def station_inputs(sums: DataFrame) -> DataFrame:
    """(cd_estacao, input) of the stations with grid hours; a station has few years."""
    content = _digest(F.struct("fonte", "ano", "linhas", "alto", "baixo"))
    return sums.groupBy("cd_estacao").agg(content.alias("input"), F.count_if(F.col("fonte") == "grid").alias("n")).filter("n > 0").drop("n")


def settled(parameters: DataFrame) -> DataFrame:
    """Parameters to so many digits that every run on the same content has the same ones."""
    def short(v: str) -> Column:
        kept = [F.round(F.col(f"{v}_fit")[s], PARAMETER_DIGITS).alias(s) for s in STATISTICS if s != "n"]
        return F.when(F.col(f"{v}_fit").isNotNull(), F.struct(*kept))

    return parameters.withColumns({f"{v}_fit": short(v) for v in VARIABLES})


def parameter_marks(parameters: DataFrame) -> DataFrame:
    """(cd_estacao, parameters): a hash of what the days of a station are corrected with."""
    used = [f"{v}_fit" for v in VARIABLES]
    return parameters.groupBy("cd_estacao").agg(_digest(F.struct("mes", *used)).alias("parameters"))


# Staging


STATE = "cd_estacao string, input string, cells_run string, parameters string, days_run string"


class Staging:
    """What has been computed so far, by run.

    `cells` holds the sums of the fit by station and month, `days` the imputed days, each in one
    folder per run. `state` says which run's rows count for each station and what they were
    computed from; it is replaced as the last step of a run, so a run that fails changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.run = spark, folder, f"r{uuid.uuid4().hex}"

    def state(self) -> DataFrame:
        recover_table(self.spark, f"{self.folder}/state")
        try:
            return self.spark.read.schema(STATE).parquet(f"{self.folder}/state")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], STATE)

    def write(self, df: DataFrame, table: str) -> None:
        df.write.options(**WRITER).parquet(f"{self.folder}/{table}/run={self.run}")

    def rows(self, table: str, state: DataFrame, station_bound: int | None = None) -> DataFrame:
        """The rows that count for the stations of `state`."""
        stored = self.spark.read.parquet(f"{self.folder}/{table}")
        runs = state.select("cd_estacao", F.col(f"{table}_run").alias("run"))
        return stored.join(broadcast_if(runs, station_bound), ["cd_estacao", "run"], "left_semi").drop("run")

    def publish(self, state: DataFrame) -> None:
        """Makes `state` count and removes the runs that no station refers to any more."""
        write_table(state, f"{self.folder}/state")
        live = self.state()
        for table in ("cells", "days"):
            names = {r[0] for r in live.select(f"{table}_run").distinct().collect()}  # one per run that is still used
            for name in run_names(self.spark, f"{self.folder}/{table}"):
                if name not in names:
                    remove_table(self.spark, f"{self.folder}/{table}/run={name}")


def run_names(spark: SparkSession, folder: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return [one.getPath().getName().removeprefix("run=") for one in system.listStatus(path)]


def staged_days(spark: SparkSession, folder: str) -> DataFrame | None:
    """Daily rows that count so far, or None before the first run."""
    staging = Staging(spark, folder)
    if not run_names(spark, f"{folder}/days"):
        return None
    return staging.rows("days", staging.state())


def pending_stations(stations: DataFrame, inputs: DataFrame, state: DataFrame) -> DataFrame:
    """The stations with grid hours beside what is staged of them; `fresh` when their input is not what was staged."""
    stale = ~F.col("input").eqNullSafe(F.col("staged_input"))
    return (
        stations.join(inputs, "cd_estacao")
        .join(state.withColumnRenamed("input", "staged_input"), "cd_estacao", "left")
        .withColumn("fresh", stale).drop("staged_input")
    )


def impute_all(
    grid: DataFrame,
    history: DataFrame,
    stations: DataFrame,
    staging: str,
    method: str = "scaling",
    years: tuple[int, int] | None = None,
    batch_size: int = BATCH_SIZE,
    codes: Sequence[str] | None = None,
    min_samples: int = MIN_SAMPLES,
    station_bound: int | None = None,
    placed: bool = False,
) -> DataFrame:
    """Imputed daily table of all stations that observed something.

    Work is staged below `staging`, in a folder for each method, span of years and `min_samples`,
    by station. The sums of the fit are computed again where grid or readings of a station have
    changed in content, its days where these or its fitted parameters have. Batches, whose last
    fallback of the fit is their own, stay slices of the registry in code order: a station more or less moves
    them, but days are computed again only for stations that fall back to a batch whose figures
    changed. The result is that of one fresh run. `history` is the raw history or the merged
    observations; `placed` tells that it and the grid are stored where they are joined. A result
    is read before the next run on the same folder.
    """
    spark = grid.sparkSession
    store = Staging(spark, run_folder(staging, method, years, min_samples))
    grid = within_years(grid, years)
    batches = station_batches(station_coordinates(stations, codes), batch_size)
    before = store.state()

    def frame_of(chosen: DataFrame) -> DataFrame:
        chosen = chosen.select("cd_estacao")
        observed = observed_hours(history, chosen, max_codes=station_bound)
        return hourly_frame(keep_stations(grid, chosen, station_bound), observed, placed)

    def fresh_frame(pending: DataFrame):
        """Hours of the fresh stations, joined once: the fit reads them, and the days after it."""
        fresh = pending.filter("fresh")
        return nullcontext() if fresh.isEmpty() else written(frame_of(fresh), "frame")

    sums = input_sums(grid, history, batches, station_bound)
    with (
        written(sums, "sums") as sums,
        written(pending_stations(batches, station_inputs(sums), before), "pending") as pending,
        fresh_frame(pending) as fresh_hours,
    ):
        if fresh_hours is not None:
            store.write(cell_sums(fresh_hours).drop("scope"), "cells")
        run = F.lit(store.run)
        judged = pending.withColumn("cells_run", F.when(F.col("fresh"), run).otherwise(F.col("cells_run")))
        if judged.isEmpty():
            parameters = None
        else:
            scope = judged.select("cd_estacao", F.col("batch").alias("scope"))
            cells = store.rows("cells", judged, station_bound).join(broadcast_if(scope, station_bound), "cd_estacao")
            parameters = settled(fit_parameters(fit_levels(cells), min_samples, scope_bound=station_bound))
        if parameters is not None:
            with written(parameters, "parameters") as parameters:
                marks = parameter_marks(parameters).withColumnRenamed("parameters", "mark")
                stale = F.col("fresh") | ~F.col("parameters").eqNullSafe(F.col("mark"))
                with written(judged.join(marks, "cd_estacao", "left").withColumn("stale", stale), "judged") as judged:
                    again, moved = judged.filter("stale"), judged.filter("stale AND NOT fresh")
                    if not again.isEmpty():
                        # grid and readings are joined again only for stations whose hours are not stored
                        hours = [df for df in (fresh_hours, None if moved.isEmpty() else frame_of(moved)) if df is not None]
                        hourly = impute_hourly(union_frames(hours), method, parameters=parameters, parameter_rows=parameters.count())
                        store.write(aggregate_daily(hourly), "days")
                    after = judged.select(
                        "cd_estacao", "input", "cells_run", F.col("mark").alias("parameters"),
                        F.when(F.col("stale"), run).otherwise(F.col("days_run")).alias("days_run"))
                    if codes is not None:  # the others stay staged
                        after = after.union(before.join(batches, "cd_estacao", "left_anti").select(after.columns))
                    store.publish(after)
        write_table(sums, f"{store.folder}/inputs")
    if parameters is None:
        return add_day_type(aggregate_daily(impute_hourly(frame_of(batches).limit(0), method)), True)
    counted = keep_stations(store.state(), batches, station_bound)
    return add_day_type(store.rows("days", counted, station_bound), only_observed_stations=True, station_bound=station_bound)


def impute_codes(
    grid: DataFrame,
    history: DataFrame,
    codes: Sequence[str],
    method: str = "scaling",
    years: tuple[int, int] | None = None,
    min_samples: int = MIN_SAMPLES,
) -> DataFrame:
    """Imputed daily table of chosen stations, those that never observed anything included.

    The last fallback of the fit is all chosen stations together.
    """
    codes = list(dict.fromkeys(codes))
    chosen = keep_stations(within_years(grid, years), codes)
    return impute_daily(hourly_frame(chosen, observed_hours(history, codes)), method, min_samples, len(codes))


def imputed_stations(daily: DataFrame) -> DataFrame:
    return daily.select("cd_estacao").distinct()


def validate_sample(
    grid: DataFrame,
    history: DataFrame,
    stations: DataFrame,
    test_years: Sequence[int],
    n: int = 12,
    method: str = "scaling",
    years: tuple[int, int] | None = None,
    min_samples: int = MIN_SAMPLES,
) -> DataFrame:
    """Scored hold-out hours of n stations spread evenly over the code order.

    The sample is drawn first, from codes that are stored once: taken up into the plan, whatever
    the stations come from would stand in it for every use of the sample, on both sides of the frame.
    """
    with written(stations.select("cd_estacao").distinct(), "codes") as known:
        sample = [r["cd_estacao"] for r in sample_stations(known, n).collect()]  # n rows at most
    chosen = keep_stations(within_years(grid, years), sample)
    frame = hourly_frame(chosen, observed_hours(history, sample))
    return score_frame(frame, test_years, method, min_samples, station_bound=n)
