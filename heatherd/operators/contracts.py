"""Declared table contracts and the checks against them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from heatherd.functions.geometry import is_wkb
from heatherd.functions.payload import BOUNDARY_LEVELS, GEO_LEVELS
from heatherd.sources.tables import ROW_GROUP_ROWS, UNREADABLE, file_counts, order_violations, parquet_layout


@dataclass(frozen=True)
class Contract:
    columns: str
    open: bool = False
    sort: tuple[str, ...] = ()
    geometry: str | None = None
    levels: tuple[str, tuple[str, ...]] | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


# Table names, their columns and their stored order. A name ending in '*' is a prefix.
_DAILY = (
    "cd_estacao string, data date, temp_med double, temp_max double, umid_med double, "
    "umid_min double, itu_med double, itu_max double"
)
CONTRACTS = {
    "estacoes": Contract(
        "cd_estacao string, dc_nome string, sg_estado string, vl_latitude double, vl_longitude double, geometry binary",
        open=True, geometry="geometry",
    ),
    "inmet_historico": Contract("cd_estacao string, data string, hora_utc string", open=True, sort=("cd_estacao", "data")),
    "inmet_historico_diario": Contract(_DAILY, sort=("cd_estacao", "data")),
    "inmet_historico_diario_imputado": Contract(
        _DAILY + ", temp_origem string, umid_origem string, temp_frac_imp double, umid_frac_imp double, "
        "itu_imputado boolean, n_horas bigint, n_temp_obs bigint, n_umid_obs bigint, tipo string",
        sort=("cd_estacao", "data"),
    ),
    "ibge_localidades_*": Contract("id bigint, nome string, parent_id bigint"),
    "ibge_malhas_*": Contract(
        "code string, nivel string, geometry binary", geometry="geometry", levels=("nivel", tuple(BOUNDARY_LEVELS)),
    ),
    "milk_production": Contract(
        "code bigint, nome string, year bigint, milk_production_liters double, geo_level string",
        sort=("geo_level", "year", "code"), levels=("geo_level", tuple(GEO_LEVELS)),
    ),
    "nasa_power_hourly*": Contract(
        "cd_estacao string, data string, hora bigint, lat double, lon double, t2m double, rh2m double",
        open=True, sort=("cd_estacao", "data", "hora"),
    ),
    "nasa_power_*": Contract(
        "date date, lat double, lon double, t2m double, rh2m double, prectotcorr double", sort=("date",),
    ),
}

# Writers may round a row group up to a multiple of their vector length.
ROW_GROUP_SLACK = 2048

PROBLEMS = "check string, subject string, detail string"


def find_contract(name: str) -> str | None:
    """Exact names first, then the longest matching prefix."""
    if name in CONTRACTS:
        return name
    prefixes = [k for k in CONTRACTS if k.endswith("*") and name.startswith(k[:-1])]
    return max(prefixes, key=len, default=None)


def schema_problems(schema: T.StructType, contract: Contract) -> list[tuple[str, str, str]]:
    actual = {f.name: f.dataType.simpleString() for f in schema}
    wanted = {f.name: f.dataType.simpleString() for f in contract.schema}
    problems = [("missing column", c, t) for c, t in wanted.items() if c not in actual]
    problems += [
        ("wrong type", c, f"{actual[c]} instead of {t}") for c, t in wanted.items() if c in actual and actual[c] != t
    ]
    if not contract.open:
        problems += [("unexpected column", c, actual[c]) for c in sorted(actual.keys() - wanted.keys())]
    return problems


def bad_geometries(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~is_wkb(F.col(column)))


def unknown_levels(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(list(allowed)))


def layout_problems(layout: DataFrame) -> DataFrame:
    """Unreadable files, columns stored with another codec, and files whose first of several row groups has an odd size."""
    broken = layout.filter(F.col("codec") == UNREADABLE).select(F.lit("unreadable"), "file_path", "column")
    layout = layout.filter(F.col("codec") != UNREADABLE)
    codecs = layout.filter(F.col("codec") != "ZSTD").groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.lit("codec").alias("check"), F.col("file_path").alias("subject"), F.concat("n", F.lit(" chunks")).alias("detail"))
    first = F.max(F.when(F.col("row_group") == 0, F.col("rows")))
    groups = layout.groupBy("file_path").agg(F.max("row_group").alias("last"), first.alias("first"))
    odd = groups.filter(
        (F.col("last") > 0) & ~F.col("first").between(ROW_GROUP_ROWS, ROW_GROUP_ROWS + ROW_GROUP_SLACK - 1)
    ).select(F.lit("row group"), "file_path", F.concat("first", F.lit(" rows")))
    return codecs.union(odd).union(broken)


def _counted(check: str, subject: str, rows: DataFrame) -> DataFrame:
    """One problem row when `rows` is not empty."""
    n = rows.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0)
    return n.select(F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.concat("n", F.lit(" rows")).alias("detail"))


def check_contract(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All problems of the table at `path`, one row each; no rows mean that it keeps its contract."""
    layout = layout_problems(parquet_layout(spark, path))
    broken = layout.filter(F.col("check") == "unreadable")
    if not broken.isEmpty():  # nothing else can be told of a table with such files
        return layout
    found = find_contract(name)
    if found is None:
        return layout.union(spark.createDataFrame([("contract", name, "no contract has this name")], PROBLEMS))
    df = spark.read.parquet(path)
    contract = CONTRACTS[found]
    problems = spark.createDataFrame(schema_problems(df.schema, contract), PROBLEMS)
    problems = problems.union(layout)
    rows = file_counts(spark, path).agg(F.sum("rows").alias("n")).filter(F.col("n").isNull())
    problems = problems.union(rows.select(F.lit("empty"), F.lit(name), F.lit("0 rows")))
    if contract.geometry in df.columns:
        problems = problems.union(_counted("geometry", contract.geometry, bad_geometries(df, contract.geometry)))
    if contract.levels and contract.levels[0] in df.columns:
        problems = problems.union(_counted("level", contract.levels[0], unknown_levels(df, *contract.levels)))
    if contract.sort and set(contract.sort) <= set(df.columns):
        order = order_violations(spark, path, contract.sort)
        unsorted = order.filter(F.col("violations") > 0)
        problems = problems.union(unsorted.select(F.lit("order"), "file_path", F.concat("violations", F.lit(" rows"))))
        problems = problems.union(order.filter("overlaps").select(F.lit("order"), "file_path", F.lit("overlaps other files")))
    return problems


def check_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Problems of several tables, given as name -> path, with the name of the table in front."""
    found = [check_contract(spark, path, name).select(F.lit(name).alias("tabela"), "check", "subject", "detail") for name, path in paths.items()]
    return reduce(DataFrame.union, found, spark.createDataFrame([], f"tabela string, {PROBLEMS}"))


def table_names(spark: SparkSession, folder: str, suffix: str = ".parquet") -> dict[str, str]:
    """name -> path of the tables in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(one.getPath().getName() for one in listed)
    return {name.removesuffix(suffix): f"{folder.rstrip('/')}/{name}" for name in names if name.endswith(suffix) and not name.startswith((".", "_"))}
