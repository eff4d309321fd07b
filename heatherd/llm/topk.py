"""Exact top-k search by distributed histogram selection (operator 12).

Components become floor(256 * x); the score of two vectors is their integer inner product. Every
query is scored against every vector, in blocks. A pass counts the scores of each query in `BINS`
bins of its interval; the counts of all blocks are added up, and the bin that holds the k-th best
score is the interval of the next pass, until a bin is one score wide. A last pass keeps scores at
or above the k-th best and ranks them, ties to the smaller id.

A task leaves out what cannot matter: bins below the one in which its own count reaches k, and in
the last pass all but its own k best. So neither equal scores nor the number of vectors decide how
many rows a pass shuffles. Equal vectors are one row with their smallest ids, and equal queries are
one query; a query's own row is taken out of one more neighbour than asked for. Scores are computed
anew in each pass and never stored.

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors of
different length are not compared; empty vectors score 0 with one another; components and scores
beyond 2^62 count as 2^62; a null id never asks and ranks last in ties; each row but the query's
own is a candidate, also rows with its id or equal rows, and each row of a query gets its own
result; with fewer candidates than k all are returned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from heatherd.llm.common import Scratch, settings
from heatherd.session import ship_by_value

K = 5
EVERY = 50
SCALE = 256.0
BIN_BITS = 10  # 1,024 bins a pass
LIMIT = 1 << 62
BLOCK_BYTES = 2 << 20  # of vectors in one block
GROUP = 64  # most blocks that one group of a query block streams through
STEP = 1 << 22  # scores held at a time
SALTS = 16


def quantized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as little-endian doubles that hold integers; null for the others."""
    for batch in batches:
        lists = batch.column("embedding").cast(pa.list_(pa.float64()))
        values = lists.values.to_numpy(zero_copy_only=False)  # a null is nan
        with np.errstate(over="ignore", invalid="ignore"):
            whole = (np.clip(np.floor(SCALE * values), -LIMIT, LIMIT) + 0.0).astype("<f8")
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        bounds = lists.offsets.to_numpy()
        good = (bad[bounds[1:]] == bad[bounds[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
        out = [whole[a:b].tobytes() if fine else None for a, b, fine in zip(bounds, bounds[1:], good)]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "vector"])


def matrix(vectors: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(vectors, "<f8").reshape(n, dim)


def scores_of(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles are exact while sums stay below 2^53, else Python integers serve."""
    largest = [float(np.abs(side).max(initial=0.0)) for side in (queries, vectors)]
    if largest[0] * largest[1] * max(queries.shape[1], 1) < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    integers = [np.array([[int(x) for x in row] for row in side], dtype=object).reshape(side.shape) for side in (queries, vectors)]
    return np.clip(integers[0] @ integers[1].T, -LIMIT, LIMIT).astype(np.int64)


def pack(table: pa.Table) -> pa.Table:
    """One block: the rows of a group in one row."""
    table = table.sort_by("key").combine_chunks()
    ids = table.column("ids").to_pylist() if "ids" in table.column_names else []
    return pa.table({
        "dim": table.column("dim").slice(0, 1), "block": table.column("block").slice(0, 1), "n": pa.array([table.num_rows], pa.int32()),
        "keys": pa.array([table.column("key").to_pylist()], pa.list_(pa.binary())),
        "vectors": pa.array([b"".join(table.column("vector").to_pylist())], pa.binary()),
        "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
    })


BLOCK_SCHEMA = "dim int, block int, n int, keys array<binary>, vectors binary, ids array<array<long>>"


class Block:
    """A block of vectors as a task holds it."""

    def __init__(self, row: dict):
        self.keys, self.ids, self.low = row["keys"], row["ids"], None
        self.vectors = matrix(row["vectors"], row["dim"], row["n"])
        self.weights = np.array([len(ids) for ids in self.ids], np.float64)
        last = np.iinfo(np.int64).max
        self.first = np.array([last if not ids or ids[0] is None else ids[0] for ids in self.ids], np.int64)

    def scored(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first query, scores) of some queries at a time."""
        step = max(1, STEP // max(len(vectors), 1))
        for start in range(0, len(self.vectors), step):
            yield start, scores_of(self.vectors[start : start + step], vectors)


class Histogram:
    """Counts of one query block over the vectors that a task has seen."""

    schema = "dim int, g int, pos int, bin int, n long"

    def __init__(self, queries: Block, place: tuple[int, int], keep: int, shift: int):
        self.queries, self.place, self.keep, self.shift = queries, place, keep, shift
        self.bins = (1 << BIN_BITS) + 1  # the last one is for scores above the interval
        self.counts = np.zeros((len(queries.vectors), self.bins), np.int64)

    def add(self, block: Block) -> None:
        for start, scores in self.queries.scored(block.vectors):
            above = scores - self.queries.low[start : start + len(scores), None]
            at = np.minimum(above >> self.shift, self.bins - 1) + self.bins * np.arange(len(scores))[:, None]
            seen = above >= 0
            weights = np.broadcast_to(block.weights, scores.shape)
            counted = np.bincount(at[seen], weights[seen], self.bins * len(scores))
            self.counts[start : start + len(scores)] += counted.astype(np.int64).reshape(len(scores), self.bins)

    def rows(self) -> pa.RecordBatch:
        better = np.cumsum(self.counts[:, ::-1], axis=1)[:, ::-1] - self.counts
        pos, at = np.nonzero((self.counts > 0) & (better < self.keep))
        full = lambda value: pa.array(np.full(len(pos), value, np.int32))
        return pa.RecordBatch.from_arrays(
            [full(self.place[0]), full(self.place[1]), pa.array(pos, pa.int32()), pa.array(at, pa.int32()), pa.array(self.counts[pos, at])],
            ["dim", "g", "pos", "bin", "n"])


class Best:
    """The best vectors of each query that a task has seen, at or above the query's k-th best score."""

    schema = "query binary, score long, ids array<long>, key binary"

    def __init__(self, queries: Block, place: tuple[int, int], keep: int, shift: int):
        self.queries, self.keep = queries, keep
        self.pos, self.score, self.first = (np.zeros(0, np.int64) for _ in range(3))
        self.found: list[tuple[list, bytes]] = []

    def add(self, block: Block) -> None:
        for start, scores in self.queries.scored(block.vectors):
            pos, at = np.nonzero(scores >= self.queries.low[start : start + len(scores), None])
            pos, at = self.leading(pos + start, scores[pos, at], block.first[at], at)
            known = len(self.found)
            self.found += [(block.ids[i], block.keys[i]) for i in at.tolist()]
            mark = np.arange(known, len(self.found))
            score = scores[pos - start, at]
            self.pos, self.score = np.concatenate([self.pos, pos]), np.concatenate([self.score, score])
            self.first = np.concatenate([self.first, block.first[at]])
            marks = np.concatenate([np.arange(known), mark])
            order = self.order(self.pos, self.score, self.first)
            self.pos, self.score, self.first = self.pos[order], self.score[order], self.first[order]
            self.found = [self.found[i] for i in marks[order].tolist()]

    def order(self, pos: np.ndarray, score: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Positions of the `keep` best of each query, best first."""
        order = np.lexsort([first, -score, pos])
        sorted_pos = pos[order]
        begin = np.searchsorted(sorted_pos, sorted_pos)
        return order[np.arange(len(order)) - begin < self.keep]

    def leading(self, pos, score, first, at) -> tuple[np.ndarray, np.ndarray]:
        order = self.order(pos, score, first)
        return pos[order], at[order]

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([self.queries.keys[i] for i in self.pos.tolist()], pa.binary()), pa.array(self.score, pa.int64()),
             pa.array([ids for ids, _ in self.found], pa.list_(pa.int64())), pa.array([key for _, key in self.found], pa.binary())],
            ["query", "score", "ids", "key"])


def streamed(batches: Iterator[pa.RecordBatch], kind: type, keep: int, shift: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (dim, g, h, block); block -1 is the query block that those of its group meet."""
    state = group = None
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["block"] < 0:
                group = (row["dim"], row["g"], row["h"])
                if state is not None:
                    yield state.rows()
                queries = Block(row)
                queries.low = np.array(row["low"], np.int64)
                state = kind(queries, (row["dim"], row["g"]), keep, shift)
            elif group == (row["dim"], row["g"], row["h"]):  # else no query has vectors of this length
                state.add(Block(row))
    if state is not None:
        yield state.rows()


class Search:
    """Blocks of queries and vectors in written tables, and the passes over them."""

    def __init__(self, scratch: Scratch, keep: int, queries: DataFrame, vectors: DataFrame):
        self.scratch, self.keep = scratch, keep
        shape = vectors.agg(F.max("dim").alias("dim"), F.count("*").alias("n"), F.max("norm").alias("norm")).first()
        asked = queries.agg(F.count("*").alias("n"), F.max("norm").alias("norm")).first()
        self.empty = not asked["n"]
        rows = max(1, BLOCK_BYTES // (8 * max(shape["dim"] or 1, 1)))
        self.n_blocks, self.n_asked = (max(1, -(-count // rows)) for count in (shape["n"], asked["n"]))
        # |inner product| is at most the product of the norms
        self.bound = min(LIMIT, int((asked["norm"] or 0.0) * (shape["norm"] or 0.0) * 1.000001) + 1)
        self.blocks = scratch.write(self.packed(vectors, self.n_blocks), "blocks")
        self.asked = scratch.write(self.packed(queries, self.n_asked), "asked")
        tasks = 2 * int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
        self.n_groups = max(-(-self.n_blocks // GROUP), min(self.n_blocks, tasks // self.n_asked), 1)

    @staticmethod
    def packed(df: DataFrame, blocks: int) -> DataFrame:
        block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
        return df.withColumn("block", block).groupBy("dim", "block").applyInArrow(pack, BLOCK_SCHEMA)

    def run(self, low: DataFrame | None, kind: type, shift: int) -> DataFrame:
        """Each query block meets all blocks of vectors of its length, in `n_groups` groups of them."""
        asked = self.asked.withColumnRenamed("block", "g")
        if low is None:
            asked = asked.withColumn("low", F.array_repeat(F.lit(-self.bound), F.col("n")))
        else:
            lows = low.groupBy("dim", "g").agg(F.array_sort(F.collect_list(F.struct("pos", "low"))).alias("lows"))
            asked = asked.join(lows, ["dim", "g"]).withColumn("low", F.col("lows.low")).drop("lows")
        columns = ["dim", "g", "h", "block", "n", "keys", "vectors", "ids", "low"]
        asked = asked.withColumn("block", F.lit(-1)).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(self.n_groups - 1))))
        blocks = (
            self.blocks.withColumn("h", F.pmod("block", F.lit(self.n_groups)))
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(self.n_asked - 1))))
            .withColumn("low", F.lit(None).cast("array<long>"))
        )
        placed = asked.select(columns).union(blocks.select(columns)).repartition("dim", "g", "h")
        keep = self.keep
        return placed.sortWithinPartitions("dim", "g", "h", "block").mapInArrow(
            lambda batches: streamed(batches, kind, keep, shift), kind.schema)

    def narrowed(self, low: DataFrame | None, counted: DataFrame, shift: int) -> DataFrame:
        """The lower end of the bin with the k-th best score; of the lowest one when there are fewer scores."""
        query = ["dim", "g", "pos"]
        total = counted.groupBy(*query, "bin").agg(F.sum("n").alias("n"))
        down = F.sum("n").over(Window.partitionBy(*query).orderBy(F.desc("bin")))
        found = total.withColumn("upto", down).groupBy(*query).agg(
            F.coalesce(F.max(F.when(F.col("upto") >= self.keep, F.col("bin"))), F.min("bin")).alias("bin"))
        start = found.withColumn("low", F.lit(-self.bound)) if low is None else found.join(low, query)
        return start.select(*query, (F.col("low") + F.col("bin").cast("long") * F.lit(1 << shift)).alias("low"))

    def best(self) -> DataFrame:
        """(query, score, ids, key): each query's best vectors, at least the `keep` best of all."""
        low, shift = None, max(0, math.ceil(math.log2(2 * self.bound + 1)) - BIN_BITS)
        step = 0
        while True:
            counted = self.run(low, Histogram, shift)
            low = self.scratch.write(self.narrowed(low, counted, shift), f"low-{step}")
            if step:
                self.scratch.drop(f"low-{step - 1}")
            if shift == 0:
                return self.run(low, Best, 0)
            shift, step = max(0, shift - BIN_BITS), step + 1


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each row whose vec_id is divisible by `every`.

    `vectors` has vec_id and embedding.
    """
    spark, keep = vectors.sparkSession, k + 1
    scratch = Scratch(spark, "topk")
    with settings(spark):
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        rows = rows.mapInArrow(quantized, "vec_id long, vector binary").where("vector IS NOT NULL")
        rows = scratch.write(rows.withColumn("key", F.unhex(F.md5("vector"))), "rows")
        dim = (F.length("vector") / 8).cast("int").alias("dim")
        asked = rows.where(F.col("vec_id") % every == 0)

        in_order = Window.partitionBy("key").orderBy(F.col("vec_id").asc_nulls_last())
        first = rows.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= keep)
        one = first.groupBy("key").agg(
            F.first("vector").alias("vector"), F.array_sort(F.collect_list(F.struct("place", "vec_id"))).getField("vec_id").alias("ids"))
        distinct = with_norm(one.select("key", dim, "vector", "ids"), scratch, "distinct")
        queries = with_norm(asked.groupBy("key").agg(F.first("vector").alias("vector")).select("key", dim, "vector"), scratch, "queries")
        search = Search(scratch, keep, queries, distinct)
        scratch.drop("distinct", "queries")
        best = scratch.write(search.best() if not search.empty else spark.createDataFrame([], Best.schema), "best")
        scratch.drop("blocks", "asked")

        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0].asc_nulls_last(), "key")
        ranked = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
        single = F.flatten(F.collect_list(F.transform("ids", lambda vec_id: F.struct(
            (-F.col("score")).alias("minus"), vec_id.isNull().alias("nameless"), vec_id.alias("vec_id"), F.col("key").alias("key")))))
        tops = scratch.write(ranked.groupBy("query").agg(F.slice(F.array_sort(single), 1, keep).alias("top")), "tops")
    salted = tops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query"),
                         F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("salt"))
    own = F.array_position(F.transform("top", lambda one: (one["vec_id"] == F.col("query_id")) & (one["key"] == F.col("query"))), True)
    own = F.when(own > 0, own).otherwise(keep).cast("int")
    others = F.concat(F.slice("top", F.lit(1), own - 1), F.slice("top", own + 1, F.lit(keep)))
    return (
        asked.join(salted, ["query", "salt"])
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "one"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "one.vec_id", (-F.col("one.minus")).alias("score"))
    )


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the length of each vector."""
    for batch in batches:
        norms = [float(np.linalg.norm(np.frombuffer(vector, "<f8"))) for vector in batch.column("vector").to_pylist()]
        yield batch.append_column("norm", pa.array(norms, pa.float64()))


def with_norm(df: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    return scratch.write(df.mapInArrow(measured, df.withColumn("norm", F.lit(0.0)).schema), name)


ship_by_value(__name__)
