from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from heatherd.session import tune  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # faster plan building
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    )
    session = tune(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column_of(spark):
    """Results of a Column -> Column function over a list of values."""

    def evaluate(values, function, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        return [r[0] for r in df.orderBy("i").select(function(F.col("c"))).collect()]

    return evaluate
