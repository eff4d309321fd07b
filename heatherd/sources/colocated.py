"""Tables stored where they are joined: bucketed by station and day.

A table written here tells Spark how its rows are placed, so joins with a table of the same
buckets and aggregations by station and day read it without an exchange. Files alone do
not tell this; a reader registers them with their buckets in the catalog of its session,
from a small layout table beside the data.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from heatherd.operators.frame import HOUR_KEY, hourly_frame, observed_hours
from heatherd.session import colocates_by_day, remove_table
from heatherd.sources.tables import WRITER, hidden_path, publish, recover_table

BUCKET_KEY = ("cd_estacao", "data")
BUCKETS = 200
BUCKET_ROWS = 1_000_000  # a task sorts the rows of one bucket of each side
GRID, OBSERVED = "grid", "observed"
LAYOUT = "buckets int, key array<string>, schema string"


def _name(path: str) -> str:
    return f"colocated_{hashlib.md5(path.encode()).hexdigest()}"


def write_colocated(df: DataFrame, path: str, buckets: int = BUCKETS, key: Sequence[str] = BUCKET_KEY) -> None:
    """Replaces the table at `path`, one file per bucket; the old one stays readable until the new one is complete."""
    spark, beside = df.sparkSession, hidden_path(path, f"new-{uuid.uuid4().hex}")
    recover_table(spark, path)
    try:
        (
            df.repartition(buckets, *key)
            .write.format("parquet").options(**WRITER, path=beside).bucketBy(buckets, *key).saveAsTable(_name(beside))
        )
        spark.sql(f"DROP TABLE {_name(beside)}")  # from the catalog; the files stay
        layout = spark.createDataFrame([(buckets, list(key), df.schema.json())], LAYOUT)
        layout.coalesce(1).write.json(f"{beside}/_layout")
        publish(spark, beside, path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {_name(beside)}")
        remove_table(spark, beside)


def read_colocated(spark: SparkSession, path: str) -> DataFrame:
    """The table at `path` with its placement, also in a session that did not write it."""
    layout = spark.read.schema(LAYOUT).json(f"{path.rstrip('/')}/_layout").first()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(layout["schema"])))
    key, place = ", ".join(f"`{c}`" for c in layout["key"]), path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    spark.sql(f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY ({key}) INTO {layout['buckets']} BUCKETS LOCATION '{place}'")
    return spark.table(_name(path))


def enough_buckets(least: int, *parts: DataFrame) -> int:
    """`least` buckets, or so many that one holds about `BUCKET_ROWS` rows of the larger table."""
    most = int(parts[0].sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    rows = max(df.count() for df in parts)
    return max(least, min(most, -(-rows // BUCKET_ROWS)))


def store_frame_inputs(grid: DataFrame, history: DataFrame, folder: str, buckets: int = BUCKETS) -> None:
    """The grid and the merged observations below `folder`, placed alike in `buckets` buckets, or more for large tables.

    Readings are parsed and merged here once, not by every run that follows.
    """
    buckets = enough_buckets(buckets, grid, history)
    write_colocated(grid.select(*HOUR_KEY, "t2m", "rh2m"), f"{folder.rstrip('/')}/{GRID}", buckets)
    write_colocated(observed_hours(history), f"{folder.rstrip('/')}/{OBSERVED}", buckets)


def frame_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(grid, observations) as stored by `store_frame_inputs`."""
    return tuple(read_colocated(spark, f"{folder.rstrip('/')}/{name}") for name in (GRID, OBSERVED))


def stored_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly frame of the stored tables.

    Where the session allows a join placed by part of its keys, the frame and the daily
    aggregation after it have no exchange.
    """
    grid, observed = frame_inputs(spark, folder)
    return hourly_frame(grid, observed, placed=colocates_by_day(spark))
