"""Physical plans: what is shuffled, pushed down and broadcast."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES
from heatherd.operators import daily, frame, impute
from heatherd.functions import text
from heatherd.operators import grid as grids
from heatherd.plans import imputation
from heatherd.sources import colocated, derived
from heatherd.sources.tables import write_table

from conftest import SF_SMALL


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    write_table(derived.grid(spark, SF_SMALL), f"{root}/grid", sort=frame.HOUR_KEY)
    write_table(derived.history(spark, SF_SMALL), f"{root}/history", sort=["cd_estacao", "data"])
    return spark.read.parquet(f"{root}/grid"), spark.read.parquet(f"{root}/history")


def test_frame_and_daily_share_one_placement(spark, landed):
    grid, history = landed
    hourly = frame.hourly_frame(grid, frame.hourly_observations(history))
    plan = final_plan(impute.impute_daily(hourly, min_samples=10, station_bound=6))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    by_day = [line for line in shuffles if re.search(r"\(cd_estacao#\d+, data#\d+, \d+\)", line)]
    assert len(by_day) == 2  # grid and observations, each once; the daily aggregation adds none
    assert plan.count("ReusedExchange") >= 2 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_station_filter_and_columns_reach_the_scan(landed):
    plan = final_plan(frame.hourly_observations(landed[1], ["A001", "A002"]))
    assert "In(cd_estacao, [A001,A002])" in plan and "l_orderkey" not in plan
    narrow = final_plan(daily.daily_climate(landed[1]).select("cd_estacao", "data", "temp_med"))
    assert frame.HUMIDITY_COLUMN not in narrow.split("ReadSchema")[1]


def test_range_lookup_is_pushed_down(spark, landed, tmp_path):
    write_table(daily.daily_climate(landed[1]), str(tmp_path / "d"), sort=["cd_estacao", "data"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    found = daily.between_days(spark.read.parquet(str(tmp_path / "d")), "A001", "1997-01-01", "1997-12-31")
    plan = final_plan(found)
    assert "EqualTo(cd_estacao,A001)" in plan and "GreaterThanOrEqual(data,1997-01-01)" in plan
    assert {r["cd_estacao"] for r in found.collect()} == {"A001"}


def scanned_rows(df):
    """Rows that the scans of an executed plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_row_groups_are_skipped(spark, tmp_path):
    """Groups of 100,000 rows in one file; a range on the sort keys reads those that can hold it."""
    path = str(tmp_path / "long")
    rows = spark.range(0, 450_000, numPartitions=1).selectExpr("format_string('A%03d', id div 50000) AS cd_estacao", "date_add(DATE '1990-01-01', int(id % 50000 div 10)) AS data", "id AS valor")
    write_table(rows, path, sort=["cd_estacao", "data"])
    stored = spark.read.parquet(path)
    assert max(r["n"] for r in stored.groupBy("_metadata.file_path").agg(F.count("*").alias("n")).collect()) > 100_000
    found = daily.between_days(stored, "A003", "1995-01-01", "1996-12-31")
    assert 0 < scanned_rows(found) <= 100_000 < stored.count()
    assert found.count() == 731 * 10


def test_stored_range_query_skips(spark):
    plan = final_plan(QUERIES["stored_range"](spark, SF_SMALL))
    assert "EqualTo(cd_estacao,A002)" in plan


@pytest.fixture
def no_broadcast(spark):
    """Tables as large as those that need their placement."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_frame_and_daily_have_no_exchange(spark, landed, tmp_path, no_broadcast):
    folder = str(tmp_path / "placed")
    colocated.store_frame_inputs(*landed, folder, buckets=4)
    stored = colocated.stored_frame(spark, folder)
    days = impute.aggregate_daily(stored.selectExpr("*", "temp AS temp_imp", "rh AS rh_imp", "'inmet' AS temp_src", "'inmet' AS rh_src"))
    for df in (stored, days):
        plan = final_plan(df)
        assert "Exchange" not in plan and "Bucketed: true" in plan, plan
    fresh = frame.hourly_frame(landed[0], frame.hourly_observations(landed[1]))
    assert sorted(map(str, stored.collect())) == sorted(map(str, fresh.select(stored.columns).collect()))

    # a table that is written again, with other buckets, and read by a session that did not write it
    colocated.store_frame_inputs(landed[0].filter("cd_estacao = 'A001'"), landed[1], folder, buckets=3)
    other = spark.newSession()
    assert {r[0] for r in colocated.stored_frame(other, folder).select("cd_estacao").distinct().collect()} == {"A001"}


def test_buckets_grow_with_the_rows(spark, landed, tmp_path, monkeypatch):
    grid, history = landed
    rows = max(grid.count(), history.count())
    assert colocated.enough_buckets(4, grid, history) == 4
    monkeypatch.setattr(colocated, "BUCKET_ROWS", rows // 9)
    folder = str(tmp_path / "placed")
    colocated.store_frame_inputs(grid, history, folder, buckets=4)
    layouts = [spark.read.json(f"{folder}/{name}/_layout").first()["buckets"] for name in (colocated.GRID, colocated.OBSERVED)]
    assert layouts[0] == layouts[1] >= 9
    assert colocated.stored_frame(spark, folder).count() == grid.count()


def test_imputation_of_stored_tables_shuffles_no_hours(spark, landed, tmp_path, no_broadcast):
    folder = str(tmp_path / "placed")
    colocated.store_frame_inputs(*landed, folder, buckets=4)
    plan = final_plan(impute.impute_daily(colocated.stored_frame(spark, folder), min_samples=10, station_bound=6))
    by_hour = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "data#" in line]
    assert not by_hour


def test_observed_days_fit_once(spark, landed):
    hourly = frame.hourly_frame(landed[0], frame.hourly_observations(landed[1]))
    def fits(**options):  # each brings the levels of its cascade
        days = impute.impute_daily(hourly, min_samples=10, station_bound=6, **options)
        return days._jdf.queryExecution().optimizedPlan().toString().count("Expand")

    assert fits(only_observed_stations=True) == fits()


def test_alignment_grows_with_the_parameters_only(spark):
    def size(n):
        df = spark.createDataFrame([("A", "{}")], "cd_estacao string, payload string")
        return len(grids.grid_hourly(df, [f"P{i}" for i in range(n)])._jdf.queryExecution().optimizedPlan().toString())

    assert size(20) < 2.5 * size(10)


def test_exploded_grid_is_not_broadcast(spark):
    """Two days are exploded to 60,000 hours, which Spark takes for few bytes."""
    days = spark.createDataFrame([("2001-01-01",), ("2001-01-02",)], "data string").distinct()
    grid = days.select("data", F.explode(F.sequence(F.lit(0), F.lit(29_999))).alias("hora")).select(
        F.lit("A001").alias("cd_estacao"), "data", F.col("hora").cast("bigint").alias("hora"), F.lit(1.0).alias("t2m"), F.lit(2.0).alias("rh2m"))
    observed = spark.createDataFrame(
        [("A001", "2001-01-02", 29_999, 20.0, 50.0), ("A001", "2001-01-03", 0, 21.0, None), ("A001", None, 1, 22.0, 1.0)],
        "cd_estacao string, data string, hora bigint, temp double, rh double")
    paired = frame.observations_with_grid(observed, grid)
    assert "Broadcast" not in final_plan(paired)
    assert sorted((r["temp"], r["t2m"]) for r in paired.collect() if r["t2m"] is not None) == [(20.0, 1.0)]
    assert paired.count() == 3


def test_leaving_out_stations_broadcasts_no_hours(spark):
    """Hours of exploded days meet parameters of stations without a bound; one station never observed."""
    days = spark.createDataFrame([("2001-01-01",), ("2001-02-01",)], "data string").distinct()
    stations = days.select("data", F.explode(F.array(F.lit("A001"), F.lit("A002"))).alias("cd_estacao"))
    grid = stations.select("*", F.explode(F.sequence(F.lit(0), F.lit(29_999))).alias("hora")).select(
        "cd_estacao", "data", F.col("hora").cast("bigint").alias("hora"), (F.col("hora") % 7).cast("double").alias("t2m"), F.lit(50.0).alias("rh2m"))
    history = spark.createDataFrame(
        [("A001", "2001-01-01", f"{h:02d}00 UTC", f"{20 + h},5", "50") for h in range(9)],
        f"cd_estacao string, data string, hora_utc string, {frame.TEMPERATURE_COLUMN} string, {frame.HUMIDITY_COLUMN} string")
    hours = frame.hourly_frame(grid, frame.hourly_observations(history))
    found = imputation.imputed_stations(impute.impute_daily(hours, min_samples=3, only_observed_stations=True))
    assert "BuildLeft" not in final_plan(found)
    assert [r[0] for r in found.collect()] == ["A001"]


def test_sampled_stations_are_drawn_once(spark, landed):
    """The plan of a hold-out of sampled stations holds nothing of what the stations come from."""
    grid, history = landed
    drawn = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            drawn.add(1)
            yield row

    codes = [(f"A{i % 5:03d}",) for i in range(10)]
    stations = spark.createDataFrame(spark.sparkContext.parallelize(codes, 2).mapPartitions(counted), "cd_estacao string")
    scored = imputation.validate_sample(grid, history, stations, [2000], n=2, min_samples=10)
    assert {r[0] for r in scored.select("cd_estacao").distinct().collect()} == {"A000", "A002"}
    assert drawn.value == len(codes)
    assert "Subquery" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_parsed_once(spark):
    """Names of the parameters come from the stored table of parsed documents, which the hours come from too."""
    df = spark.createDataFrame([("A", '{"properties": {"parameter": {"T2M": {"2001010100": 1.5}, "RH2M": {}}}}'), ("B", "{")], "cd_estacao string, payload string")
    hours = grids.grid_hourly(df)
    plan = hours._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "jsontostructs" not in plan.lower() and "parquet" in plan
    assert [(r["cd_estacao"], r["t2m"], r["rh2m"]) for r in hours.collect()] == [("A", 1.5, None)]


def test_names_are_built_fast(spark):
    column = F.col("x")
    text.snake_case(column)
    start = time.perf_counter()
    text.snake_case(column)
    assert time.perf_counter() - start < 0.05


def test_drifting_files_are_parsed_once(spark):
    plan = QUERIES["schema_drift"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "decode" not in plan and plan.count("Relation") <= 2  # the stored lines, once for rows and once for header lines


def test_every_query_has_sql_and_builds(spark):
    assert set(QUERIES) == set(ORACLE)
    assert entry(spark).columns[:2] == ["cd_estacao", "data"]


def test_no_query_plans_a_cross_join(spark):
    for name, build in QUERIES.items():
        if name in ("impute_network", "impute_network_resumed", "impute_changed_values"):  # runs jobs while it is built
            continue
        plan = build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
