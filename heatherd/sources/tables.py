"""Parquet tables: sorted sink, layout report and order check."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from heatherd.session import remove_table, ship_by_value

ship_by_value(__name__)

# Writer settings of every table.
ROW_GROUP_ROWS = 100_000
WRITER = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    "parquet.block.row.count.limit": str(ROW_GROUP_ROWS),
}

UNREADABLE = "unreadable"
LAYOUT = "file_path string, row_group int, column string, codec string, rows bigint"


def write_table(df: DataFrame, path: str, sort: Sequence[str] = (), partition_by: Sequence[str] = (), spread: Sequence[str] = ()) -> None:
    """Replaces the table at `path`; until the new one is complete the old one stays readable.

    With `sort` the files are sorted and do not overlap, so a reader skips row groups by their
    minimum and maximum. `spread` names further columns that split a run of equal sort keys
    over several files. With `partition_by` only the partitions present in `df` are replaced.
    """
    if sort:
        df = df.repartitionByRange(*sort, *spread).sortWithinPartitions(*sort)
    writer = df.write.options(**WRITER)
    if partition_by:
        writer.mode("overwrite").partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)
        return
    recover_table(df.sparkSession, path)
    beside = f"{hidden_path(path, 'new')}-{uuid.uuid4().hex}"
    try:
        writer.parquet(beside)
        publish(df.sparkSession, beside, path)
    finally:
        remove_table(df.sparkSession, beside)


def hidden_path(path: str, what: str) -> str:
    """A name beside the table that readers of the folder around it do not see."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}-{what}" if folder or path.startswith("/") else f".{name}-{what}"


def _files(spark: SparkSession, path: str):
    """Hadoop's path and the file system it lies in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(spark: SparkSession, complete: str, path: str) -> None:
    """Puts the complete table in the place of the one at `path`, by renaming.

    The old table is renamed first and comes back if the new one cannot take its place. A
    process that ends between the two leaves the old table beside; `recover_table` finds it.
    """
    (source, system), (target, _), (aside, _) = (_files(spark, p) for p in (complete, path, hidden_path(path, "old")))
    if not system.exists(source):
        raise OSError(f"nothing to publish at {complete}")
    replaced = system.exists(target)
    if replaced:
        system.delete(aside, True)
        if not system.rename(target, aside):
            raise OSError(f"cannot set {path} aside")
    elif target.getParent() is not None:
        system.mkdirs(target.getParent())
    published = False
    try:
        published = system.rename(source, target)
    finally:
        if not published and replaced:
            system.rename(aside, target)
    if not published:
        raise OSError(f"cannot publish {path}")
    if replaced:
        system.delete(aside, True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Brings back a table that was set aside by a publication which never ended."""
    (target, system), (aside, _) = (_files(spark, p) for p in (path, hidden_path(path, "old")))
    if system.exists(aside):
        if system.exists(target):
            system.delete(aside, True)
        else:
            system.rename(aside, target)


def file_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows and size of every non-empty file."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _before(left: pa.StructArray, right: pa.StructArray) -> np.ndarray:
    """Whether each left key sorts before the right one; nulls come first, as in Spark."""
    less, equal = np.zeros(len(left), bool), np.ones(len(left), bool)
    for a, b in zip(left.flatten(), right.flatten()):
        known = pc.and_(a.is_valid(), b.is_valid())
        smaller = pc.if_else(known, pc.fill_null(pc.less(a, b), False), pc.and_(a.is_null(), b.is_valid()))
        same = pc.if_else(known, pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null()))
        less |= equal & smaller.to_numpy(zero_copy_only=False)
        equal &= same.to_numpy(zero_copy_only=False)
    return less


def _end(key: pa.StructArray, order: str) -> int:
    """Index of the smallest ("ascending") or largest ("descending") key; nulls are smallest."""
    names = [str(i) for i in range(len(key.type))]
    rows = pa.Table.from_arrays(key.flatten(), names)
    nulls = "at_start" if order == "ascending" else "at_end"
    return pc.sort_indices(rows, sort_keys=[(n, order) for n in names], null_placement=nulls)[0].as_py()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as they are stored, cut into runs of neighbours: first and last key, and violations inside."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, index, key = batch.column("file_path"), batch.column("row_index").to_numpy(), batch.column("key")
        same_file = pc.equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)
        breaks = ~same_file | (index[1:] != index[:-1] + 1)
        wrong = _before(key[1:], key[:-1]) & ~breaks
        first = np.flatnonzero(np.append(True, breaks))
        last = np.append(first[1:], len(index)) - 1
        inside = np.add.reduceat(np.append(False, wrong).astype(np.int64), first)
        low, high = first.copy(), last.copy()
        for run in np.flatnonzero(inside):  # the ends of a run in order are its smallest and largest keys
            part = key.slice(first[run], last[run] - first[run] + 1)
            low[run], high[run] = (first[run] + _end(part, order) for order in ("ascending", "descending"))
        yield pa.RecordBatch.from_arrays(
            [path.take(pa.array(first)), pa.array(index[first]), pa.array(inside), *(key.take(pa.array(at)) for at in (first, last, low, high))],
            ["file_path", "row_index", "inside", "first", "last", "low", "high"])


def order_violations(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Per file, the rows that sort before the row stored ahead of them, and whether the file overlaps others.

    Keys are compared where they are read, in runs of stored neighbours. Only the ends of the runs are
    shuffled and compared by file, and of the files only their ranges: a file overlaps when it begins
    before the end of a file that begins earlier.
    """
    stored = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"), F.struct(*keys).alias("key"))
    key = stored.schema["key"].dataType.simpleString()
    runs = stored.mapInArrow(_runs, f"file_path string, row_index bigint, inside bigint, first {key}, last {key}, low {key}, high {key}")
    in_file = Window.partitionBy("file_path").orderBy("row_index")
    files = (
        runs.withColumn("ahead", F.lag("last").over(in_file))
        .groupBy("file_path")
        .agg((F.sum("inside") + F.count_if(F.col("first") < F.col("ahead"))).alias("violations"),
             F.min("low").alias("low"), F.max("high").alias("high"))
    )
    earlier = Window.orderBy("low", "file_path").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("overlaps", F.coalesce(F.col("low") < F.max("high").over(earlier), F.lit(False))).select(
        "file_path", "violations", "overlaps")


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for uri in batch["file_path"]:
            system, name = fs.FileSystem.from_uri(uri)
            try:
                with system.open_input_file(name) as source:
                    meta = pq.ParquetFile(source).metadata
            except (pa.ArrowInvalid, OSError) as error:
                yield pd.DataFrame({"file_path": [uri], "row_group": -1, "column": str(error)[:200], "codec": UNREADABLE, "rows": 0})
                continue
            rows = [
                (uri, g, meta.row_group(g).column(c).path_in_schema, meta.row_group(g).column(c).compression, meta.row_group(g).num_rows)
                for g in range(meta.num_row_groups)
                for c in range(meta.num_columns)
            ]
            yield pd.DataFrame(rows, columns=["file_path", "row_group", "column", "codec", "rows"])


def parquet_layout(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, row group and column, from the footers alone; one of row group -1 for an unreadable file."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_path").alias("file_path"))
    )
    return files.mapInPandas(_footers, LAYOUT)
