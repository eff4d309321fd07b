"""Shared helpers: scratch tables, batch slicing, word splitting, running totals."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from heatherd.session import ship_by_value

# Bytes of text that one step of an operator holds as Python objects at a time. A longer
# text is a step of its own, so texts are never cut.
SLICE_BYTES = 1 << 20

# Ranges of a running total, and the rows of one below the largest number of ranges.
RANGES, RANGE_ROWS = 4_096, 5_000

# Shuffle files of a finished job are removed at once instead of when the driver collects
# garbage. Batches sent to Python are bounded by bytes as well as by rows.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


@contextmanager
def settings(spark: SparkSession, **more: str):
    """Run jobs under `SETTINGS`; the caller's values come back afterwards."""
    wanted = SETTINGS | {k.replace("__", "."): v for k, v in more.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Scratch:
    """Tables of one operator run in the shared folder `spark.checkpoint.dir`.

    Only a plain local session without that setting gets a temporary folder of the machine.
    `drop` removes tables no longer needed; the last one, which the result is read from, stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            master = spark.conf.get("spark.master", "")
            if master != "local" and not master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            root = tempfile.mkdtemp(prefix="llm-")
        self.spark, self.root = spark, f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """`df` written once and read back: computed once, its lineage cut."""
        df.write.parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, *tables: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = hadoop(self.path(table))
            path.getFileSystem(conf).delete(path, True)

    def clear(self, *keep: str) -> None:
        """Removes all tables but some."""
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [one.getPath().getName() for one in system.listStatus(root)] if system.exists(root) else []
        self.drop(*(name for name in names if name not in keep))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in order, in parts of at most `limit` bytes of `text` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """UTF-8 bytes of each text; a null is an empty text."""
    return [b"" if value is None else value for value in batch.column(text).cast(pa.binary()).to_pylist()]


class Memo(dict):
    """Results of a function by key, forgotten when `limit` entries are held."""

    def __init__(self, function, limit: int = 300_000):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the splitmix64 finalizer)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def exclusive_total(df: DataFrame, light: DataFrame, order: list[str], value: str, alias: str, rows: int) -> DataFrame:
    """Adds `alias`: the sum of `value` over all rows before, in ascending `order`.

    The first order column must be a number. Its approximate quantiles, taken from `light` (the
    same rows, cheap to compute), cut the rows into ranges; sums of earlier ranges and a window
    inside the range give the total, so no task sees all rows. One sum per range (at most
    `RANGES`) meets in one task.
    """
    first, count = order[0], max(1, min(RANGES, -(-rows // RANGE_ROWS)))
    cuts = light.approxQuantile(first, [i / count for i in range(1, count)], 1 / (4 * count)) if count > 1 else []
    cuts = np.array(sorted(set(cuts)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(first).to_numpy(zero_copy_only=False)  # a null becomes nan, and the last range
            spot = np.searchsorted(cuts, keys, side="right")
            spot = np.where(batch.column(first).is_null().to_numpy(zero_copy_only=False), -1, spot)
            yield batch.append_column("_range", pa.array(spot, pa.int64()))

    def placed(frame: DataFrame) -> DataFrame:
        return frame.mapInArrow(place, frame.withColumn("_range", F.lit(0).cast("long")).schema)

    sums = placed(light.select(first, value)).groupBy("_range").agg(F.sum(value).alias("_sum"))
    before = sums.select("_range", F.coalesce(F.sum("_sum").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed(df).withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(before), "_range")
        .withColumn(alias, F.col("_before") + F.col("_inside"))
        .drop("_range", "_before", "_inside")
    )


ship_by_value(__name__)
