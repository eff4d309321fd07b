"""Landed files to contract tables: one job per product.

Tables live in one folder under their contract names. Every job replaces its own table, so
it can run again at any time, and writes the order that the contract declares.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from heatherd.operators import coverage, grid, holdout, milk, places
from heatherd.operators.contracts import CONTRACTS, find_contract
from heatherd.operators.daily import daily_climate
from heatherd.operators.stations import station_coordinates, stations
from heatherd.plans import imputation
from heatherd.plans.work import missing_periods, year_blocks
from heatherd.session import written
from heatherd.sources.colocated import frame_inputs, store_frame_inputs
from heatherd.sources.files import archive_members, history_of, skipped_files, station_code, station_files, station_history, station_lines
from heatherd.sources.payloads import documents
from heatherd.sources.tables import write_table

STATIONS, HISTORY, DAILY = "estacoes", "inmet_historico", "inmet_historico_diario"
GRID_HOURLY, IMPUTED = "nasa_power_hourly", "inmet_historico_diario_imputado"

Paths = str | Sequence[str]


def product_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def product(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(product_path(folder, name))


def write_product(df: DataFrame, folder: str, name: str, spread: Sequence[str] = ()) -> None:
    contract = CONTRACTS[find_contract(name)]
    write_table(df, product_path(folder, name), sort=contract.sort, spread=spread if contract.sort else ())


def build_stations(spark: SparkSession, folder: str, payloads: Paths) -> None:
    write_product(stations(documents(spark, payloads)), folder, STATIONS)


def known_stations(spark: SparkSession, folder: str) -> DataFrame | None:
    """Codes of the registry, or None while there is none."""
    try:
        return product(spark, folder, STATIONS).select("cd_estacao").distinct()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def build_history(
    spark: SparkSession, folder: str, archives: Paths | None = None, files: Paths | None = None, columns: Sequence[str] | None = None
) -> None:
    """Hourly history of the registered stations, from yearly archives or from single files."""
    source, known = _history_source(spark, archives, files), known_stations(spark, folder)
    parsed = station_lines(source, known) if columns is None else station_history(source, known, columns)
    # Sorting samples its input before it reads it: parse once, then sort the parsed table.
    with written(parsed, "history") as parsed:
        history = history_of(parsed) if columns is None else parsed
        # several readings of one station and day may lie in different files of the table
        write_product(history, folder, HISTORY, spread=[c for c in ("hora_utc",) if c in history.columns])


def _history_source(spark: SparkSession, archives: Paths | None, files: Paths | None) -> DataFrame:
    if archives is not None:
        return archive_members(station_files(spark, archives, "zip"))
    return station_files(spark, files)


def left_out(
    spark: SparkSession, folder: str, archives: Paths | None = None, files: Paths | None = None, grid_payloads: Paths | None = None
) -> DataFrame:
    """(produto, file_name, motivo): landed input that the jobs leave out.

    Station files without a code or a header, files of stations that are not registered, and point
    documents at whose point no station stands.
    """
    parts = [spark.createDataFrame([], "produto string, file_name string, motivo string")]
    if archives is not None or files is not None:
        source = _history_source(spark, archives, files).select("file_name", "content")
        parts.append(skipped_files(source).select(F.lit(HISTORY), "file_name", F.lit("no station code or header")))
        known = known_stations(spark, folder)
        if known is not None:
            coded = source.select("file_name", station_code(F.col("file_name")).alias("cd_estacao")).filter("cd_estacao IS NOT NULL")
            unknown = coded.join(known, "cd_estacao", "left_anti")
            parts.append(unknown.select(F.lit(HISTORY), "file_name", F.lit("station is not registered")))
    if grid_payloads is not None:
        coordinates = station_coordinates(product(spark, folder, STATIONS))
        strayed = grid.strayed_documents(documents(spark, grid_payloads), coordinates)
        parts.append(strayed.select(F.lit(GRID_HOURLY), "file_name", F.lit("no station at this point")))
    return reduce(DataFrame.union, parts)


def build_daily(spark: SparkSession, folder: str) -> None:
    write_product(daily_climate(product(spark, folder, HISTORY)), folder, DAILY)


def build_localities(spark: SparkSession, folder: str, level: str, payloads: Paths | None = None) -> None:
    """Localities of one level; the regions are a fixed list and need no payload."""
    if level == "regioes":
        table = places.regions(spark).withColumn("parent_id", F.lit(None).cast("bigint"))
    else:
        table = places.localities(documents(spark, payloads), places.PARENT_PATHS[level])
    write_product(table, folder, f"ibge_localidades_{level}")


def build_boundaries(spark: SparkSession, folder: str, level: str, payloads: Paths) -> None:
    write_product(places.boundaries(documents(spark, payloads), level), folder, f"ibge_malhas_{level}")


def build_milk(spark: SparkSession, folder: str, geo_level: str, payloads: Paths) -> None:
    write_product(milk.milk_production(documents(spark, payloads), geo_level), folder, "milk_production")


def build_grid_daily(spark: SparkSession, folder: str, name: str, payloads: Paths) -> None:
    """Daily series of one point; `name` tells the point and the period."""
    write_product(grid.grid_daily(documents(spark, payloads)), folder, f"nasa_power_{name}")


def build_grid_hourly(
    spark: SparkSession, folder: str, payloads: Paths, parameters: Sequence[str] | None = None, codes: Sequence[str] | None = None
) -> None:
    """Hourly series of all stations, or of the chosen `codes`, whose point has landed."""
    coordinates = station_coordinates(product(spark, folder, STATIONS), codes)
    landed = grid.station_payloads(documents(spark, payloads), coordinates)
    with written(grid.grid_hourly(landed, parameters), "grid") as hours:  # parsed once, not again for the sort
        write_product(hours, folder, GRID_HOURLY)


def build_point_hourly(spark: SparkSession, folder: str, name: str, payloads: Paths, parameters: Sequence[str] | None = None) -> None:
    """Hourly series of one point that is no station; `name` tells the point and the period."""
    with written(grid.grid_hourly(documents(spark, payloads), parameters), "point") as hours:
        write_product(hours, folder, f"{GRID_HOURLY}_{name}")


def missing_grid_blocks(spark: SparkSession, folder: str, payloads: Paths, first_year: int, last_year: int, size: int = 10) -> DataFrame:
    """Stations and periods whose hourly point document has not landed; documents may cover any periods."""
    coordinates = station_coordinates(product(spark, folder, STATIONS))
    plan = year_blocks(coordinates, first_year, last_year, size)
    return missing_periods(plan, grid.station_payloads(documents(spark, payloads), coordinates))


def build_frame_inputs(spark: SparkSession, folder: str, placed: str, buckets: int) -> None:
    """Stores grid and merged observations below `placed` where they are joined, for runs that follow."""
    store_frame_inputs(product(spark, folder, GRID_HOURLY), product(spark, folder, HISTORY), placed, buckets)


def build_imputed(
    spark: SparkSession,
    folder: str,
    staging: str,
    method: str = "scaling",
    years: tuple[int, int] | None = None,
    batch_size: int = imputation.BATCH_SIZE,
    codes: Sequence[str] | None = None,
    placed: str | None = None,
) -> None:
    """The imputed table of the network, or with `codes` of chosen stations.

    Chosen stations are fitted together and all kept, observed or not; nothing is staged. With `placed`
    grid and observations are read as `build_frame_inputs` stored them.
    """
    hours, readings = _inputs(spark, folder, placed)
    if codes is not None:
        daily = imputation.impute_codes(hours, readings, codes, method=method, years=years)
        write_product(daily, folder, IMPUTED)
        return
    registry = product(spark, folder, STATIONS)
    daily = imputation.impute_all(
        hours, readings, registry, staging, method=method, years=years, batch_size=batch_size,
        station_bound=registry.count(),  # a small table; its count bounds every per-station table
        placed=placed is not None,
    )
    write_product(daily, folder, IMPUTED)


def _inputs(spark: SparkSession, folder: str, placed: str | None) -> tuple[DataFrame, DataFrame]:
    """Hourly grid, and readings or merged observations."""
    if placed is not None:
        return frame_inputs(spark, placed)
    return product(spark, folder, GRID_HOURLY), product(spark, folder, HISTORY)


def imputation_report(
    spark: SparkSession, folder: str, test_years: Sequence[int], sample: int = 12, method: str = "scaling",
    codes: Sequence[str] | None = None, years: tuple[int, int] | None = None, placed: str | None = None,
) -> dict[str, DataFrame]:
    """The tables of the quality report: hold-out errors, coverage, composition and what is missing.

    Errors are measured on a sample of the imputed stations, or on all of the chosen `codes`, within
    `years`. The hold-out is computed once; its error tables have a few rows per scored station at
    most and are held by the driver.
    """
    daily, registry = product(spark, folder, IMPUTED), product(spark, folder, STATIONS)
    wanted = registry.dropna(subset=["vl_latitude", "vl_longitude"]).select("cd_estacao")
    if codes is not None:
        wanted = spark.createDataFrame([(c,) for c in dict.fromkeys(codes)], "cd_estacao string")
    by_station = coverage.coverage_by_station(daily)
    with written(holdout_sample(spark, folder, test_years, sample, method, codes, years, placed), "scored") as scored:
        days = holdout.complete_days(scored)
        errors = {
            "hourly_errors": holdout.hourly_errors(scored),
            "station_errors": holdout.station_errors(scored),
            "daily_errors": holdout.daily_errors(days),
            "class_flips": holdout.class_flips(days),
        }
        errors = {name: spark.createDataFrame(table.collect(), table.schema) for name, table in errors.items()}
    return errors | {
        "coverage": coverage.coverage_overall(by_station),
        "most_imputed": coverage.most_imputed(by_station),
        "day_types": coverage.day_types(daily),
        "completeness": coverage.completeness(daily, wanted),
        "excluded": coverage.excluded_stations(daily, wanted),
    }


def holdout_sample(
    spark: SparkSession, folder: str, test_years: Sequence[int], sample: int = 12, method: str = "scaling",
    codes: Sequence[str] | None = None, years: tuple[int, int] | None = None, placed: str | None = None,
) -> DataFrame:
    """Scored hold-out hours of `sample` stations spread over those that were imputed, or of the chosen `codes`."""
    if codes is not None:
        chosen = spark.createDataFrame([(c,) for c in dict.fromkeys(codes)], "cd_estacao string")
    else:
        chosen = imputation.imputed_stations(product(spark, folder, IMPUTED))
    hours, readings = _inputs(spark, folder, placed)
    n = sample if codes is None else max(1, len(codes))
    return imputation.validate_sample(hours, readings, chosen, test_years, n, method, years)
