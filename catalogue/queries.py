"""One query per operator, each over whole sample tables and what Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from heatherd.functions import climate, payload, text
from heatherd.functions.geometry import is_wkb, point_xy
from heatherd.operators import (
    contracts, coverage, daily, fit, frame, grid, holdout, impute, milk, places, stations,
)
from heatherd.plans import imputation, work
from heatherd.session import scratch_path, ship_by_value, tune
from heatherd.sources import colocated, derived, files, tables
from heatherd.sources.derived import table
from heatherd.sources.files import batched

ship_by_value(__name__)

# Settings that make every branch reachable on six-hour days (see FIXTURES.md).
MIN_SAMPLES = 620
MIN_HOURS = 5
TEST_YEARS = (2000, 2001)
FILE_LINES = 10_000  # of one derived station file

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Registers the query under its function name; doubles are rounded for comparison."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(tune(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


# Means of short decimals lie exactly on rounding ties, where the last bit decides. A small
# shift that is no short decimal moves them off; the SQL side has the same shift.
TIE_SHIFT = 1.0367255757e-07


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    # adding zero turns a negative zero into a positive one
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c) + F.lit(TIE_SHIFT), digits) + F.lit(0.0) for c in doubles})


# Daily climate and scalar functions


@query
def daily_climate(spark, sf_dir):
    return daily.daily_climate(derived.history(spark, sf_dir))


@query
def station_range(spark, sf_dir):
    days = daily.daily_climate(derived.history(spark, sf_dir))
    return daily.between_days(days, "A001", "1997-01-01", "1998-12-31")


@query
def decimal_comma(spark, sf_dir):
    raw = F.col(frame.TEMPERATURE_COLUMN)
    spoiled = F.when(F.col("l_linenumber") == 4, F.concat(raw, F.lit("d"))).when(F.col("l_linenumber") == 5, "n/d").otherwise(raw)
    return derived.history(spark, sf_dir).select("l_orderkey", "l_linenumber", text.decimal_comma(spoiled).alias("temp"))


@query
def iso_date(spark, sf_dir):
    slashes = F.when(F.col("l_linenumber") == 3, F.replace("data", F.lit("-"), F.lit("/"))).otherwise(F.col("data"))
    return derived.history(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", text.iso_date(slashes).alias("data"),
        text.month_of(F.col("data")).alias("mes"), text.year_of(F.col("data")).alias("ano"),
    )


@query
def hour_text(spark, sf_dir):
    return derived.history(spark, sf_dir).select("l_orderkey", "l_linenumber", text.hour_of(F.col("hora_utc")).alias("hora"))


@query
def qc_temperature(spark, sf_dir):
    return derived.readings(spark, sf_dir).select("l_orderkey", "l_linenumber", climate.qc_temperature(F.col("temp")).alias("temp"))


@query
def qc_humidity(spark, sf_dir):
    return derived.readings(spark, sf_dir).select("l_orderkey", "l_linenumber", climate.qc_humidity(F.col("rh")).alias("rh"))


def _indexed(spark, sf_dir):
    checked = climate.heat_index(climate.qc_temperature(F.col("temp")), climate.qc_humidity(F.col("rh")))
    return derived.readings(spark, sf_dir).select("l_orderkey", "l_linenumber", checked.alias("itu"))


@query
def heat_index(spark, sf_dir):
    return _indexed(spark, sf_dir)


@query
def stress_class(spark, sf_dir):
    return _indexed(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        climate.stress_class(F.col("itu")).alias("classe"), climate.stress_label(F.col("itu")).alias("nome"),
    )


@query
def snake_case(spark, sf_dir):
    spelled = F.concat(F.lit("  Umidade (%) - Média "), F.upper("p_name"), F.lit(" / "), F.col("p_brand"), F.lit("; "), F.col("p_type"), F.lit(" Krakōw ﬁx Șibiu ½ 東京"))
    return table(spark, sf_dir, "part").select("p_partkey", text.snake_case(spelled).alias("nome"))


# Hourly frame


def _observations(spark, sf_dir):
    return frame.hourly_observations(derived.history(spark, sf_dir, late_start=True))


def _frame(spark, sf_dir):
    return frame.hourly_frame(derived.grid(spark, sf_dir), _observations(spark, sf_dir))


def _bound(spark, sf_dir):
    return derived.station_count(spark, sf_dir) + 1


def _daily(spark, sf_dir, method="scaling"):
    return impute.impute_daily(_frame(spark, sf_dir), method, MIN_SAMPLES, _bound(spark, sf_dir))


def _observed_daily(spark, sf_dir):
    """Days of the stations that observed anything."""
    return impute.impute_daily(_frame(spark, sf_dir), "scaling", MIN_SAMPLES, _bound(spark, sf_dir), only_observed_stations=True)


@query
def hourly_dedupe(spark, sf_dir):
    return frame.hourly_observations(derived.history(spark, sf_dir))


@query
def hourly_frame(spark, sf_dir):
    return _frame(spark, sf_dir)


@query
def obs_left_grid(spark, sf_dir):
    return frame.observations_with_grid(_observations(spark, sf_dir), derived.grid(spark, sf_dir))


@query
def frame_bucketed(spark, sf_dir):
    """The frame from stored tables that lie where they are joined, added up by day without an exchange."""
    folder = scratch_path(spark, "placed")
    colocated.store_frame_inputs(derived.grid(spark, sf_dir), derived.history(spark, sf_dir, late_start=True), folder, buckets=8)
    return colocated.stored_frame(spark, folder).groupBy("cd_estacao", "data").agg(
        F.count(F.lit(1)).alias("horas"), F.count("temp").alias("temp_obs"), F.avg("temp").alias("temp"), F.avg("rh").alias("rh"),
        F.avg("t2m").alias("t2m"), F.max("mes").alias("mes"))


# Fit and imputation


@query
def fit_rollup(spark, sf_dir):
    levels = fit.fit_levels(fit.cell_sums(_frame(spark, sf_dir)))
    per_variable = F.inline(F.array(*[
        F.struct(F.lit(v).alias("var"), *[F.col(v)[s].alias(s) for s in fit.STATISTICS]) for v in fit.VARIABLES
    ]))
    return levels.select("level", "cd_estacao", "mes", per_variable)


@query
def fit_cascade(spark, sf_dir):
    fitted = fit.fit(_frame(spark, sf_dir), min_samples=MIN_SAMPLES)
    flat = [F.col(f"{v}_fit")[s].alias(f"{v}_{s}") for v in fit.VARIABLES for s in fit.STATISTICS]
    return fitted.select("cd_estacao", "mes", "first_observed", *flat, *[f"{v}_level" for v in fit.VARIABLES])


def _hourly(spark, sf_dir, method):
    hourly = impute.impute_hourly(_frame(spark, sf_dir), method, MIN_SAMPLES, _bound(spark, sf_dir))
    return hourly.select(*frame.HOUR_KEY, "temp_corr", "rh_corr", "temp_imp", "rh_imp", "temp_src", "rh_src")


@query
def impute_scaling(spark, sf_dir):
    return _hourly(spark, sf_dir, "scaling")


@query
def impute_linear(spark, sf_dir):
    return _hourly(spark, sf_dir, "linear")


@query
def impute_offset(spark, sf_dir):
    paired = frame.observations_with_grid(_observations(spark, sf_dir), derived.grid(spark, sf_dir))
    return impute.offset_fill(paired, _bound(spark, sf_dir)).select(*frame.HOUR_KEY, "offset", "temp_imputada")


@query
def imputed_daily(spark, sf_dir):
    return _daily(spark, sf_dir)


@query
def imputed_daily_linear(spark, sf_dir):
    return _daily(spark, sf_dir, "linear")


@query
def day_type(spark, sf_dir):
    hourly = impute.impute_hourly(_frame(spark, sf_dir), min_samples=MIN_SAMPLES, station_bound=_bound(spark, sf_dir))
    return impute.add_day_type(impute.aggregate_daily(hourly)).select("cd_estacao", "data", "temp_origem", "tipo")


@query
def day_composition(spark, sf_dir):
    return coverage.day_types(_daily(spark, sf_dir))


@query
def impute_network_resumed(spark, sf_dir):
    """A first run on part of the grid and registry, then one on all: the same as one full run."""
    whole, readings, registry = derived.grid(spark, sf_dir), derived.history(spark, sf_dir, late_start=True), _coordinates_table(spark, sf_dir)
    options = {"staging": scratch_path(spark, "staging"), "batch_size": 3, "min_samples": MIN_SAMPLES, "station_bound": _bound(spark, sf_dir)}
    first = registry.filter(F.col("cd_estacao") != "A001")
    imputation.impute_all(whole.filter((F.col("data") < "1997-01-01") | (F.col("cd_estacao") < "A003")), readings, first, **options)
    imputation.impute_all(whole, readings, first, years=(1995, 1996), **options)
    return imputation.impute_all(whole, readings, registry, **options)


def _network_options(spark, sf_dir):
    return {"staging": scratch_path(spark, "staging"), "batch_size": 3, "min_samples": MIN_SAMPLES, "station_bound": _bound(spark, sf_dir)}


def _revised(spark, sf_dir):
    """Grid and readings with other values at the same hours: a station's grid, another one's readings of a year."""
    other = derived.grid(spark, sf_dir).withColumn("t2m", F.when(F.col("cd_estacao") == "A003", F.col("t2m") + 1).otherwise(F.col("t2m")))
    changed = (F.col("cd_estacao") == "A001") & (F.substring("data", 1, 4) == "1997")
    raw = derived.history(spark, sf_dir, late_start=True)
    return other, raw.withColumn(frame.HUMIDITY_COLUMN, F.when(changed, F.lit("50,5")).otherwise(F.col(frame.HUMIDITY_COLUMN)))


@query
def impute_changed_values(spark, sf_dir):
    """A run on other values at the same hours, then one on the right ones: the same as one full run."""
    registry, options = _coordinates_table(spark, sf_dir), _network_options(spark, sf_dir)
    imputation.impute_all(*_revised(spark, sf_dir), registry, **options)
    return imputation.impute_all(derived.grid(spark, sf_dir), derived.history(spark, sf_dir, late_start=True), registry, **options)


@query
def changed_periods(spark, sf_dir):
    """Station years whose grid or readings differ between two deliveries; one station is new, one gone."""
    whole, readings, every = derived.grid(spark, sf_dir), derived.history(spark, sf_dir, late_start=True), derived.grid_stations(spark, sf_dir)
    grid, raw = _revised(spark, sf_dir)
    before = imputation.input_sums(grid.filter("cd_estacao <> 'A000'"), raw, every)
    return imputation.changed_periods(before, imputation.input_sums(whole.filter("cd_estacao <> 'A002'"), readings, every))


@query
def impute_codes(spark, sf_dir):
    """Chosen stations, one of which never observed anything."""
    codes = ["A001", "A004", f"A{_bound(spark, sf_dir) - 1:03d}"]
    return imputation.impute_codes(
        derived.grid(spark, sf_dir), derived.history(spark, sf_dir, late_start=True), codes, min_samples=MIN_SAMPLES)


@query
def impute_network(spark, sf_dir):
    registry = _coordinates_table(spark, sf_dir)
    return imputation.impute_all(
        derived.grid(spark, sf_dir), derived.history(spark, sf_dir, late_start=True), registry,
        staging=scratch_path(spark, "staging"), batch_size=3, min_samples=MIN_SAMPLES, station_bound=_bound(spark, sf_dir),
    )


# Hold-out validation


def _scored(spark, sf_dir, method="scaling"):
    return holdout.score_frame(_frame(spark, sf_dir), TEST_YEARS, method, MIN_SAMPLES, _bound(spark, sf_dir))


@query
def holdout_hourly(spark, sf_dir):
    return holdout.hourly_errors(_scored(spark, sf_dir))


@query
def holdout_hourly_linear(spark, sf_dir):
    return holdout.hourly_errors(_scored(spark, sf_dir, "linear"))


@query
def holdout_by_station(spark, sf_dir):
    grid_stations = derived.grid(spark, sf_dir).select("cd_estacao").distinct()
    return holdout.station_errors(_scored(spark, sf_dir), grid_stations, _bound(spark, sf_dir))


@query
def complete_days(spark, sf_dir):
    return holdout.complete_days(_scored(spark, sf_dir), MIN_HOURS)


@query
def paired_days(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    truth = holdout.complete_days(scored, MIN_HOURS).select("cd_estacao", "data", "temp_med", "itu_max")
    predicted = holdout.predicted_days(scored).select("cd_estacao", "data", "temp_med", "itu_max", "temp_frac_imp")
    return holdout.join_days(truth, predicted)


@query
def holdout_daily(spark, sf_dir):
    return holdout.daily_errors(holdout.complete_days(_scored(spark, sf_dir), MIN_HOURS))


@query
def holdout_daily_linear(spark, sf_dir):
    return holdout.daily_errors(holdout.complete_days(_scored(spark, sf_dir, "linear"), MIN_HOURS))


@query
def class_flip(spark, sf_dir):
    return holdout.class_flips(holdout.complete_days(_scored(spark, sf_dir), MIN_HOURS))


@query
def validate_sample(spark, sf_dir):
    scored = imputation.validate_sample(
        derived.grid(spark, sf_dir), derived.history(spark, sf_dir, late_start=True),
        derived.grid_stations(spark, sf_dir), TEST_YEARS, n=3, min_samples=MIN_SAMPLES,
    )
    return holdout.station_errors(scored)


@query
def report_sample(spark, sf_dir):
    """The hold-out of a report: stations sampled from the imputed ones, within some years."""
    imputed = imputation.imputed_stations(_observed_daily(spark, sf_dir))
    scored = imputation.validate_sample(
        derived.grid(spark, sf_dir), derived.history(spark, sf_dir, late_start=True), imputed, TEST_YEARS, n=3,
        years=(1995, 2001), min_samples=MIN_SAMPLES)
    return holdout.station_errors(scored)


# Coverage


@query
def coverage_station(spark, sf_dir):
    return coverage.coverage_by_station(_daily(spark, sf_dir))


@query
def coverage_overall(spark, sf_dir):
    return coverage.coverage_overall(coverage.coverage_by_station(_daily(spark, sf_dir)))


@query
def coverage_top(spark, sf_dir):
    return coverage.most_imputed(coverage.coverage_by_station(_daily(spark, sf_dir)))


@query
def completeness(spark, sf_dir):
    return coverage.completeness(_observed_daily(spark, sf_dir), derived.station_registry(spark, sf_dir))


@query
def excluded_stations(spark, sf_dir):
    return coverage.excluded_stations(_observed_daily(spark, sf_dir), derived.station_registry(spark, sf_dir))


@query
def observations_per_station(spark, sf_dir):
    return stations.observations_per_station(_daily(spark, sf_dir))


@query
def rows_per_station_top(spark, sf_dir):
    return coverage.rows_per_station(derived.history(spark, sf_dir))


# Stations


def _coordinates_table(spark, sf_dir):
    """Stations with coordinates; a negative balance stands for an unknown position."""
    known = F.col("s_acctbal") >= 0
    return derived.station_registry(spark, sf_dir).select(
        "cd_estacao", "dc_nome",
        F.when(known, -(F.col("s_acctbal") / F.lit(400.0))).alias("vl_latitude"),
        F.when(known, -(F.col("s_acctbal") / F.lit(200.0))).alias("vl_longitude"),
    )


@query
def station_coordinates(spark, sf_dir):
    return stations.station_coordinates(_coordinates_table(spark, sf_dir))


@query
def station_points(spark, sf_dir):
    """Registry packed as JSON lists, one per nation, and unpacked to points."""
    row = F.struct(
        F.col("cd_estacao").alias("CD_ESTACAO"), F.col("dc_nome").alias("DC_NOME"),
        F.col("s_nationkey").cast("string").alias("SG_ESTADO"),
        F.when(F.col("s_acctbal") >= 0, F.replace((-F.col("s_acctbal") / 400).cast("string"), F.lit("."), F.lit(","))).alias("VL_LATITUDE"),
        (-F.col("s_acctbal") / 200).cast("string").alias("VL_LONGITUDE"),
        F.col("s_suppkey").cast("string").alias("Nº Série"),
    )
    lists = derived.station_registry(spark, sf_dir).select("s_suppkey", F.to_json(F.array(row)).alias("payload"))
    unpacked = stations.stations(lists)
    return unpacked.select(
        "cd_estacao", "dc_nome", "sg_estado", "vl_latitude", "vl_longitude", "no_serie",
        point_xy("geometry").alias("xy"), is_wkb("geometry").alias("valida"),
    ).select("*", "xy.*").drop("xy")


@query
def known_stations(spark, sf_dir):
    registry = derived.station_registry(spark, sf_dir).filter(F.col("s_acctbal") >= 0)
    return stations.known_only(
        derived.readings(spark, sf_dir).select("l_orderkey", "l_linenumber", "cd_estacao"), registry
    )


@query
def observed_stations(spark, sf_dir):
    observed = _observed_daily(spark, sf_dir)
    return observed.groupBy("cd_estacao").agg(F.count(F.lit(1)).alias("dias"))


@query
def missing_stations(spark, sf_dir):
    return stations.missing_stations(derived.station_registry(spark, sf_dir), derived.readings(spark, sf_dir))


@query
def sample_stations(spark, sf_dir):
    return stations.sample_stations(derived.station_registry(spark, sf_dir), 12)


@query
def station_batches(spark, sf_dir):
    return stations.station_batches(derived.station_registry(spark, sf_dir), 20)


@query
def year_plan(spark, sf_dir):
    return work.year_blocks(derived.station_registry(spark, sf_dir).select("cd_estacao"), 2001, 2025, 10)


@query
def missing_plan(spark, sf_dir):
    """The years in which a nation's customers ordered are its landed one-year blocks."""
    nation = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("N"), F.col("c_nationkey")).alias("cd_estacao"))
    year = F.year("o_orderdate").cast("string")
    landed = (
        table(spark, sf_dir, "orders")
        .join(nation, F.col("o_custkey") == F.col("c_custkey"))
        .select("cd_estacao", F.concat(year, F.lit("-01-01")).alias("inicio"), F.concat(year, F.lit("-12-31")).alias("fim"))
        .distinct()
    )
    wanted = nation.select("cd_estacao").distinct()
    return work.missing_blocks(work.year_blocks(wanted, 1990, 2005, 1), landed)


@query
def missing_periods(spark, sf_dir):
    """Five-year blocks minus the days that orders of a nation cover, each for a few days from its date."""
    nation = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("N"), F.col("c_nationkey")).alias("cd_estacao"))
    begin = F.to_date("o_orderdate")
    landed = (
        table(spark, sf_dir, "orders")
        .join(nation, F.col("o_custkey") == F.col("c_custkey"))
        .select("cd_estacao", begin.cast("string").alias("inicio"), F.date_add(begin, (F.col("o_orderkey") % 6 - 1).cast("int")).cast("string").alias("fim"))
    )
    wanted = nation.select("cd_estacao").distinct()
    return work.missing_periods(work.year_blocks(wanted, 1990, 1999, 5), landed)


# Localities, boundaries, production


@query
def locality_parents(spark, sf_dir):
    """Customers as localities below nation and region, by nested JSON."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    entry = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"),
        F.struct(
            F.struct(F.col("n_nationkey").alias("id"), F.struct(F.col("r_regionkey").alias("id")).alias("regiao")).alias("UF"),
        ).alias("mesorregiao"),
    )
    lists = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.to_json(F.array(entry)).alias("payload"))
    )
    state = places.localities(lists, places.PARENT_PATHS["microrregioes"])
    region_of = places.localities(lists, "mesorregiao.UF.regiao.id").select("id", F.col("parent_id").alias("region_id"))
    broken = places.localities(lists, "mesorregiao.nome.id").select("id", F.col("parent_id").alias("broken_id"))
    return state.join(region_of, "id").join(broken, "id")


@query
def locality_levels(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", payload.parent_level(F.col("c_custkey")).alias("nivel"))


@query
def region_dimension(spark, sf_dir):
    """Customers per administrative region, their nation's region standing for it."""
    region_of = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_regionkey") + 1).alias("id"))
    return (
        table(spark, sf_dir, "customer")
        .join(region_of, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("id").agg(F.count(F.lit(1)).alias("clientes"))
        .join(F.broadcast(places.regions(spark)), "id")
        .select(F.col("id").cast("bigint").alias("id"), "nome", payload.region_name(F.col("id").cast("int")).alias("nome_mapa"), "clientes")
    )


@query
def boundary_wkb(spark, sf_dir):
    """One square per part, some without a geometry, packed as GeoJSON."""
    k = F.col("p_partkey")
    square = F.format_string('{"type":"Polygon","coordinates":[[[%1$d,%2$d],[%3$d,%2$d],[%3$d,%4$d],[%1$d,%4$d],[%1$d,%2$d]]]}', k, k + 1, k + 2, k + 3)
    point = F.format_string('{"type":"Point","coordinates":[%1$d.5,%2$d.25]}', k, k + 1)
    geometry = F.when(F.col("p_size") < 10, F.lit("null")).when(F.col("p_size") < 30, point).otherwise(square)
    feature = F.format_string('{"type":"FeatureCollection","features":[{"properties":{"codarea":"%1$d"},"geometry":%2$s}]}', k, geometry)
    shapes = places.boundaries(table(spark, sf_dir, "part").select(feature.alias("payload")), "estados")
    return shapes.select("code", "nivel", F.length("geometry").alias("bytes"), is_wkb("geometry").alias("valida"), point_xy("geometry").alias("xy")).select("*", "xy.*").drop("xy")


@query
def wkb_check(spark, sf_dir):
    """Packed points, cut off for some suppliers, counted by validity."""
    packed = stations.stations(_station_lists(spark, sf_dir), [])
    cut = F.when(F.col("cd_estacao").endswith("7"), F.substring("geometry", 1, 20)).otherwise(F.col("geometry"))
    return packed.select("cd_estacao", is_wkb(cut).alias("valida")).groupBy("valida").agg(F.count(F.lit(1)).alias("n"))


def _station_lists(spark, sf_dir):
    row = F.struct(
        F.col("cd_estacao").alias("CD_ESTACAO"), F.lit("-10,5").alias("VL_LATITUDE"), F.lit("-48.25").alias("VL_LONGITUDE"),
    )
    return derived.station_registry(spark, sf_dir).select(F.to_json(F.array(row)).alias("payload"))


def _produced(spark, sf_dir):
    """Order value by nation and year as a series with markers for zero and unknown."""
    nation = table(spark, sf_dir, "nation")
    value = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    kind = F.col("n_nationkey") % 5
    raw = (
        F.when(kind == 1, "-").when(kind == 2, "..").when(kind == 3, "X")
        .otherwise(F.concat(F.lit(" "), F.col("n").cast("string"), F.lit(" ")))
    )
    return value.select("n_nationkey", "n_name", "year", raw.alias("raw"))


@query
def milk_clean(spark, sf_dir):
    return _produced(spark, sf_dir).select("n_nationkey", "year", payload.production_value(F.col("raw")).alias("value"))


@query
def milk_series(spark, sf_dir):
    series = F.struct(
        F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("nome")).alias("localidade"),
        F.create_map(F.col("year").cast("string"), F.col("raw"), F.lit("total"), F.lit("1")).alias("serie"),
    )
    result = F.array(F.struct(F.array(F.struct(F.array(series).alias("series"))).alias("resultados")))
    return milk.milk_production(_produced(spark, sf_dir).select(F.to_json(result).alias("payload")), "N3")


# Grid payloads


@query
def strayed_documents(spark, sf_dir):
    """Point documents of all suppliers against the points of two thirds of them."""
    lat, lon = F.concat((F.col("s_suppkey") % 90).cast("string"), F.lit(".25")), F.concat(F.lit("-"), (F.col("s_suppkey") % 179).cast("string"), F.lit(".5"))
    placed = derived.station_registry(spark, sf_dir).withColumns({"lat": lat, "lon": lon})
    documents = placed.select(F.concat_ws("_", "lat", "lon", F.lit("2001-01-01"), F.lit("2010-12-31.json")).alias("file_name"), F.lit("{}").alias("payload"))
    known = placed.filter(F.col("s_suppkey") % 3 != 0).select(
        "cd_estacao", F.col("lat").cast("double").alias("vl_latitude"), F.col("lon").cast("double").alias("vl_longitude"))
    return grid.strayed_documents(documents, known)


def _grid_payloads(spark, sf_dir, key):
    """The grid packed as the point documents of a station's months, with missing values."""
    names = {"T2M": "t2m", "RH2M": "rh2m", "PRECTOTCORR": "t2m"}

    def series(name):
        day = F.substring("data", 9, 2)
        sparse = day != "17" if name == "RH2M" else F.lit(True)
        value = F.when(day == "13", F.lit("-999.0")).otherwise(F.col(names[name]).cast("string"))
        return F.map_from_entries(F.collect_list(F.when(sparse, F.struct(key.alias("k"), value.alias("v"))))).alias(name)

    parameter = F.struct(*[F.col(n) for n in names])
    point = F.struct(
        F.struct(F.array(F.lit(-37.9), F.lit(-8.6), F.lit(415.0)).alias("coordinates")).alias("geometry"),
        F.struct(parameter.alias("parameter")).alias("properties"),
    )
    # one document holds one station's month, at most 31 days
    return (
        derived.grid(spark, sf_dir)
        .groupBy("cd_estacao", F.substring("data", 1, 7).alias("month"))
        .agg(*[series(n) for n in names])
        .select("cd_estacao", F.to_json(point).alias("payload"))
    )


@query
def grid_hourly(spark, sf_dir):
    key = F.concat(F.replace("data", F.lit("-"), F.lit("")), F.lpad(F.col("hora").cast("string"), 2, "0"))
    return grid.grid_hourly(_grid_payloads(spark, sf_dir, key))


@query
def point_hourly(spark, sf_dir):
    """Documents of points that are no station."""
    key = F.concat(F.replace("data", F.lit("-"), F.lit("")), F.lpad(F.col("hora").cast("string"), 2, "0"))
    points = _grid_payloads(spark, sf_dir, key).drop("cd_estacao")
    return grid.grid_hourly(points, ["T2M", "RH2M"])


@query
def grid_daily(spark, sf_dir):
    """Every hour of the grid as the day of its own year; on some days the key is no date."""
    year = F.substring("data", 1, 4).cast("int") - 100 * F.col("hora")
    date_key = F.concat(year.cast("string"), F.replace(F.substring("data", 5, 6), F.lit("-"), F.lit("")))
    broken = F.substring("data", 6, 5).isin("02-29", "07-19")
    return grid.grid_daily(_grid_payloads(spark, sf_dir, F.when(broken, F.concat(date_key, F.lit("x"))).otherwise(date_key)))


@query
def json_property(spark, sf_dir):
    """The first filled of three names, of which an event has one, an empty one, or several."""
    k = F.get_json_object("props", "$.k")
    case = F.col("event_id") % 5
    properties = F.map_filter(F.create_map(
        F.lit("codarea"), F.when(case == 0, k).when(case == 1, ""), F.lit("CODAREA"), F.when(case.isin(0, 1, 2), F.concat(F.lit("9"), k)),
        F.lit("code"), F.when(case != 4, F.concat(F.lit("7"), k))), lambda name, value: value.isNotNull())
    return table(spark, sf_dir, "events").select(
        "event_id", payload.first_filled(properties, "codarea", "CODAREA", "code").alias("code"), k.try_cast("bigint").alias("k"))


@query
def ill_formed(spark, sf_dir):
    """Payloads that are empty, no JSON or of another shape: each reader has its columns and types, and no rows."""
    broken = F.element_at(F.array(*map(F.lit, ["", "[]", "{", "null", '{"a": 1}', "[1, 2]", "text"])), (F.col("event_id") % 7 + 1).cast("int"))
    texts = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 8 != 7, broken).alias("payload"), F.lit("A001").alias("cd_estacao"), F.lit("A001").alias("station_code"))
    read = {
        "boundaries": places.boundaries(texts, "estados"), "grid_daily": grid.grid_daily(texts), "grid_hourly": grid.grid_hourly(texts, ["T2M", "RH2M"]),
        "live_daily": daily.live_daily(texts), "localities": places.localities(texts, "UF.id"), "milk": milk.milk_production(texts, "N3"),
        "stations": stations.stations(texts, []),
    }
    return frame.union_frames([
        df.agg(F.lit(name).alias("leitor"), F.count(F.lit(1)).alias("linhas"),
               F.lit(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)).alias("colunas"))
        for name, df in read.items()])


@query
def required_columns(spark, sf_dir):
    """What the guard says of histories that lack a measure, and how many rows it keeps from being read."""
    history = derived.history(spark, sf_dir)
    tables_ = {"whole": history, "no_temperature": history.drop(frame.TEMPERATURE_COLUMN), "bare": history.select("cd_estacao", "data")}
    return daily.guard_report(tables_, frame.TEMPERATURE_COLUMN, frame.HUMIDITY_COLUMN)


@query
def live_daily(spark, sf_dir):
    """Event values by user and day as the live payload of a station."""
    spread = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean")
    )
    entry = F.struct(
        F.col("day").cast("string").alias("DT_MEDICAO"),
        F.col("mean").cast("string").alias("Temp_Med"), F.col("high").alias("TEMP_MAX"), F.col("low").alias("UMID_MIN"),
    )
    lists = spread.select(F.col("user_id").cast("string").alias("station_code"), F.to_json(F.array(entry)).alias("payload"))
    return daily.live_daily(lists)


# Station files


def _station_files(spark, sf_dir):
    """The readings as station files of one month, in two header generations."""
    new = F.col("data") >= "1998-01-01"
    header = F.when(new, F.lit("Data;Hora UTC;TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);UMIDADE RELATIVA DO AR, HORARIA (%);Hora UTC;;")).otherwise(
        F.lit("DATA (YYYY-MM-DD);HORA (UTC);UMIDADE RELATIVA DO AR, HORARIA (%);TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);12;")
    )
    t, h = F.col(frame.TEMPERATURE_COLUMN), F.col(frame.HUMIDITY_COLUMN)
    quoted = F.concat(F.lit('"'), F.col("hora_utc"), F.lit('"'))
    line = F.when(new, F.concat_ws(";", "data", "hora_utc", t, h, F.lit("second"), F.lit(""), F.lit(""))).otherwise(
        F.concat_ws(";", "data", quoted, h, t, F.lit("x"), F.lit(""), F.lit("surplus"))
    )
    preamble = ["REGIAO:;NO", "ESTACAO:;IGARAPÉ FUNDO", "ALTITUDE:;27,40"]
    content = F.concat_ws(
        "\r\n", *[F.lit(x) for x in preamble], F.col("header"), F.array_join("lines", "\r\n"), F.lit("")
    )
    # A file holds a range of order keys. Ranges widen with the table, as a fixed one leaves a line or two to a file there;
    # a station with more lines in a range has several files, so the lines of one file are bounded.
    width = max(100_000, derived.reading_count(spark, sf_dir) // 6)
    place = Window.partitionBy("cd_estacao", "month", "part").orderBy("l_orderkey", "l_linenumber")
    return (
        derived.history(spark, sf_dir)
        .withColumns({"month": F.substring("data", 1, 7), "part": F.floor(F.col("l_orderkey") / width)})
        .withColumn("piece", F.floor((F.row_number().over(place) - 1) / FILE_LINES))
        .groupBy("cd_estacao", "month", "part", "piece", header.alias("header"))
        .agg(F.collect_list(line).alias("lines"))
        .select(
            F.concat(F.lit("inmet_"), F.col("cd_estacao"), F.lit("_"), F.col("month"), F.lit("_"), F.col("part"),
                     F.when(F.col("piece") > 0, F.concat(F.lit("_"), F.col("piece"))).otherwise(""), F.lit(".CSV")).alias("file_name"),
            F.encode(content, "ISO-8859-1").alias("content"),
        )
    )


@query
def station_csv(spark, sf_dir):
    columns = ["data", "hora_utc", frame.TEMPERATURE_COLUMN, frame.HUMIDITY_COLUMN]
    return files.station_history(_station_files(spark, sf_dir), columns=columns)


@query
def schema_drift(spark, sf_dir):
    """Values per column over both header generations, with the columns found in the files."""
    history = files.station_history(_station_files(spark, sf_dir))
    wide = history.agg(*[F.count(c).alias(c) for c in history.columns])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("valores")) for c in history.columns])))


def _zipped(batches):
    import io
    import zipfile

    def archive_of(name, content):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"2000/{name}", bytes(content))
            archive.writestr("2000/readme.txt", b"not a station file")
        return packed.getvalue()

    archives = ((archive_of(name, content),) for batch in batches for name, content in zip(batch["file_name"], batch["content"]))
    yield from batched(archives, ["content"])


@query
def zip_members(spark, sf_dir):
    archives = _station_files(spark, sf_dir).mapInPandas(_zipped, "content binary")
    members = files.archive_members(archives)
    columns = ["data", "hora_utc", frame.TEMPERATURE_COLUMN]
    return files.station_history(members, columns=columns).groupBy("cd_estacao", "data").agg(
        F.count(F.lit(1)).alias("linhas"), F.avg(text.decimal_comma(F.col(frame.TEMPERATURE_COLUMN))).alias("temp")
    )


@query
def csv_to_daily(spark, sf_dir):
    """Files of registered stations to daily climate, end to end."""
    registry = derived.station_registry(spark, sf_dir).filter(F.col("s_acctbal") >= 0)
    columns = ["data", "hora_utc", frame.TEMPERATURE_COLUMN, frame.HUMIDITY_COLUMN]
    return daily.daily_climate(files.station_history(_station_files(spark, sf_dir), registry, columns))


@query
def union_by_name(spark, sf_dir):
    """Readings of both halves of the record, one with whole-degree values and without humidity."""
    typed = derived.readings(spark, sf_dir).select("cd_estacao", "day", "temp", "rh")
    early = typed.filter(F.col("day") < "1998-01-01").select("day", "cd_estacao", F.col("temp").cast("int").alias("temp"))
    late = typed.filter(F.col("day") >= "1998-01-01")
    return frame.union_frames([early, late]).groupBy("cd_estacao").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("temp").alias("temp"), F.count("rh").alias("rh")
    )


# Sinks and contracts


def _written_daily(spark, sf_dir, sort):
    path = scratch_path(spark, "daily")
    tables.write_table(daily.daily_climate(derived.history(spark, sf_dir)), path, sort=sort)
    return path


@query
def sorted_sink(spark, sf_dir):
    """A table written in key order and read back."""
    return spark.read.parquet(_written_daily(spark, sf_dir, ["cd_estacao", "data"]))


@query
def replace_kept(spark, sf_dir):
    """A second write that fails leaves the first table as it was."""
    path = _written_daily(spark, sf_dir, ["cd_estacao", "data"])
    days = daily.daily_climate(derived.history(spark, sf_dir))
    broken = days.withColumn("temp_med", F.when(F.dayofyear("data") == 200, F.raise_error(F.lit("broken reading"))).otherwise(F.col("temp_med")))
    try:
        tables.write_table(broken, path, sort=["cd_estacao", "data"])
    except Exception as error:  # the failure is the point; only its own message may pass
        if "broken reading" not in str(error):
            raise
        return spark.read.parquet(path)
    raise AssertionError("the second write was meant to fail")


@query
def stored_range(spark, sf_dir):
    """Two years of one station from a stored table of many row groups, found by their minimum and maximum."""
    path = scratch_path(spark, "long")
    values = F.inline(F.array(*[F.struct(F.lit(n).alias("parametro"), F.col(n).alias("valor")) for n in ("t2m", "rh2m")]))
    long = derived.grid(spark, sf_dir).select(*frame.HOUR_KEY, values)
    tables.write_table(long, path, sort=["cd_estacao", "data", "hora", "parametro"])
    stored = spark.read.parquet(path)
    return stored.filter((F.col("cd_estacao") == "A002") & F.col("data").between("1995-01-01", "1996-12-31"))


@query
def sorted_check(spark, sf_dir):
    """Files of a table written in key order, checked in their stored order."""
    path = _written_daily(spark, sf_dir, ["cd_estacao", "data"])
    return tables.order_violations(spark, path, ["cd_estacao", "data"]).agg(
        F.sum("violations").alias("violations"), F.count_if("overlaps").alias("overlaps"))


@query
def order_broken(spark, sf_dir):
    """Two files that overlap; in one the last day of every station stands behind all other rows."""
    path = scratch_path(spark, "broken")
    days = daily.daily_climate(derived.history(spark, sf_dir)).select("cd_estacao", "data", "temp_med")
    last = F.max("data").over(Window.partitionBy("cd_estacao"))
    for half, order in ((0, []), (1, ["late"])):
        part = days.filter(F.dayofyear("data") % 2 == half).withColumn("late", F.col("data") == last)
        placed = part.repartition(1).sortWithinPartitions(*order, "cd_estacao", "data").drop("late")
        placed.write.mode("append").parquet(path)
    found = tables.order_violations(spark, path, ["cd_estacao", "data"])
    return found.agg(F.sum("violations").alias("violations"), F.count_if("overlaps").alias("overlaps"), F.count(F.lit(1)).alias("files"))


@query
def parquet_layout(spark, sf_dir):
    """Rows by column and codec, from the footers of the written files."""
    path = _written_daily(spark, sf_dir, ["cd_estacao", "data"])
    return tables.parquet_layout(spark, path).groupBy("column", "codec").agg(F.sum("rows").alias("rows"))


@query
def file_counts(spark, sf_dir):
    path = _written_daily(spark, sf_dir, ["cd_estacao", "data"])
    return tables.file_counts(spark, path).agg(F.sum("rows").alias("rows"), F.min(F.col("file_size") > 0).alias("sizes_known"))


@query
def contract_check(spark, sf_dir):
    """The daily table against its contract, and against the contract of another table."""
    path = _written_daily(spark, sf_dir, ["cd_estacao", "data"])
    kept = contracts.check_contract(spark, path, "inmet_historico_diario").withColumn("name", F.lit("own"))
    broken = contracts.check_contract(spark, path, "nasa_power_x").withColumn("name", F.lit("other"))
    return kept.union(broken)


@query
def level_domain(spark, sf_dir):
    levels = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("N"), F.col("p_size") % 10).alias("geo_level"))
    return contracts.unknown_levels(levels, "geo_level", tuple(payload.GEO_LEVELS))
