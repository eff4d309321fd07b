"""Session settings and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A table is broadcast only when its row count is known to stay at or below this.
# The widest table we broadcast (fit parameters) has about 200 bytes per row, so
# the limit means roughly 100 MB.
BROADCAST_ROW_LIMIT = 500_000

# Hours of one day share a partition for the grid join and the daily aggregation.
# Spark accepts a partitioning on part of the join keys only with the second setting
# off. The third lets a join hash its partitions when each is measured to be small;
# larger ones are merged by sorting, which can spill.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are planned for, for the rest of the session.

    Results never depend on them; a caller that keeps other values loses shuffles, not rows.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def colocates_by_day(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true") == "false"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, below the shared folder of the cluster.

    The folder comes from `spark.checkpoint.dir`. Only a plain local session without that
    setting gets a temporary folder of its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        root = tempfile.mkdtemp(prefix="heatherd-")
    return f"{root.rstrip('/')}/heatherd/{name}-{uuid.uuid4().hex}"


def remove_table(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` as a table in the shared scratch folder while the block runs: computed once, then removed."""
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_table(df.sparkSession, path)


def broadcast_if(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Hint a broadcast when the caller can bound the rows of `df`, else leave the join to AQE."""
    if max_rows is not None and max_rows <= BROADCAST_ROW_LIMIT:
        return F.broadcast(df)
    return df


def single_value(df: DataFrame, *columns: str) -> Column:
    """The only row of `df` as a struct-valued scalar subquery."""
    return df.select(F.struct(*columns)).scalar()


def ship_by_value(module: str) -> None:
    """Send the Python functions of a module with the job, so workers need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
