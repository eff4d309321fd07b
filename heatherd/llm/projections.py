"""Embedding near-duplicates by collision-counting projections (operator 4).

Unit vectors are projected on random lines. Two vectors collide on a line when one lies in the
window of half-width `WINDOW` centred at the other; near vectors collide on more lines. Pairs with
at least `needed` collisions on `LINES` lines are verified by their cosine in double precision;
`needed` is the largest count that a pair exactly at the threshold reaches with probability
`COUNT_RECALL`, from the binomial distribution.

Counting over all pairs would be quadratic, so pairs are first brought together by several
tables of `k` further lines each, cut into cells: a pair exactly at the threshold shares a cell
of some table with probability `CELL_RECALL`, and `k` grows with the logarithm of the number of
vectors so that cells keep their size. All of this is derived from the threshold (`plan`); nearer
pairs are found more often. Every link returned is verified, and counted in the first table that has it.

Equal vectors are one row with a weight. A cell with more than `BLOCK` rows is compared block by
block; a block returns link counts and roots, never its pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing; vectors of different length do not link; a row with a null id is reported with no links
and no component; rows that share an id are rows of one node, and each other row counts as a
link; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heatherd.llm.common import Scratch, mix, settings
from heatherd.llm.components import components
from heatherd.session import ship_by_value

THRESHOLD = 0.9
LINES, COUNT_RECALL = 32, 0.995
CELL_WIDTH, CELL_RECALL, CELL_ROWS = 2.0, 0.97, 256
BLOCK = 1_024
SEED = 7


def normal_tail(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2))


def same_cell(distance: float) -> float:
    """Probability that two points at a distance share a cell of one randomly shifted line."""
    r = distance / CELL_WIDTH
    return 1 - 2 * normal_tail(1 / r) - 2 * r / math.sqrt(2 * math.pi) * (1 - math.exp(-1 / (2 * r * r)))


@dataclass(frozen=True)
class Plan:
    k: int
    tables: int
    window: float
    needed: int
    threshold: float

    def lines(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counting lines, table lines and the shifts of their cells, for vectors of a length."""
        rng = np.random.default_rng([SEED, dim])
        return (rng.standard_normal((dim, LINES)), rng.standard_normal((dim, self.tables * self.k)),
                rng.uniform(0, CELL_WIDTH, self.tables * self.k))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """Cell of each row in each table, as one 64-bit key."""
        _, lines, shifts = self.lines(unit.shape[1])
        at = np.floor((unit @ lines + shifts) / CELL_WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), self.tables, self.k)
        key = np.full((len(unit), self.tables), unit.shape[1], np.uint64)
        for i in range(self.k):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + at[:, :, i])
        return key.view(np.int64)


def plan(vectors: int, threshold: float = THRESHOLD) -> Plan:
    near, far = math.sqrt(2 - 2 * threshold), math.sqrt(2)
    k = max(2, math.ceil(math.log(max(vectors / CELL_ROWS, 1)) / -math.log(same_cell(far))))
    tables = math.ceil(math.log(1 - CELL_RECALL) / math.log(1 - same_cell(near) ** k))
    p = 1 - 2 * normal_tail(1)  # the window is as wide as the spread of near pairs
    reach = [sum(math.comb(LINES, i) * p**i * (1 - p) ** (LINES - i) for i in range(n, LINES + 1)) for n in range(LINES + 1)]
    return Plan(k, tables, near, max(n for n in range(LINES + 1) if reach[n] >= COUNT_RECALL), threshold)


def unit_rows(vectors: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def valid_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of the usable vectors as little-endian doubles."""
    for batch in batches:
        column = batch.column("embedding").cast(pa.list_(pa.float64()))
        out = []
        for i in range(len(column)):
            values = column[i].values
            row = values.to_numpy(zero_copy_only=False) if values is not None and len(values) and not values.null_count else None
            good = row is not None and np.isfinite(row).all() and row.any()
            out.append((row + 0.0).astype("<f8").tobytes() if good else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "vector"])


def by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pa.compute.binary_length(batch.column("vector")).to_numpy()
    for size in np.unique(sizes):
        yield batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))


def to_cells(batches: Iterator[pa.RecordBatch], how: Plan) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in by_length(whole) if whole.num_rows else ():
            keys = how.cells(unit_rows(batch.column("vector").to_pylist()))
            for t in range(how.tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), t, np.int32)), pa.array(keys[:, t]), *(batch.column(c) for c in ("vec_id", "mark", "weight", "vector"))],
                    ["t", "cell", "vec_id", "mark", "weight", "vector"])


def window_pairs(line: np.ndarray, window: float) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of vectors once, smaller position first, that lie in each other's window on a line."""
    order = np.argsort(line).astype(np.int32)
    at = line[order]
    first = np.arange(len(at), dtype=np.int32)
    sizes = np.searchsorted(at, at + window, "right").astype(np.int32) - first - 1
    a = np.repeat(first, sizes)
    b = np.arange(1, len(a) + 1, dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes - first).astype(np.int32), sizes)
    a, b = order[a], order[b]
    return np.minimum(a, b), np.maximum(a, b)


def compare(rows: pa.Table, how: Plan) -> pa.RecordBatch:
    """Links of one block: (vec_id, mark, links, root), the root a vector of the block it is joined with."""
    ids, mark, weight, place = (rows.column(c).to_numpy() for c in ("vec_id", "mark", "weight", "place"))
    t, i, j = (rows.column(c)[0].as_py() for c in ("t", "i", "j"))
    unit = unit_rows(rows.column("vector").to_pylist())
    at = unit @ how.lines(unit.shape[1])[0]
    count = np.zeros(len(ids) ** 2, np.int8)
    for line in at.T:
        a, b = window_pairs(line, how.window)
        count[a.astype(np.int64) * len(ids) + b] += 1
    a, b = np.divmod(np.flatnonzero(count >= how.needed), len(ids))
    if i != j:
        apart = place[a] != place[b]
        a, b = a[apart], b[apart]
    near = np.zeros(len(a), bool)
    for start in range(0, len(a), 200_000):
        part = slice(start, start + 200_000)
        near[part] = np.einsum("ij,ij->i", unit[a[part]], unit[b[part]]) >= how.threshold
    a, b = a[near], b[near]
    if len(a) and t:
        keys = how.cells(unit)[:, :t]
        new = np.ones(len(a), bool)
        for column in keys.T:
            new &= column[a] != column[b]
        a, b = a[new], b[new]
    links = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
    root, before = np.arange(len(ids)), None
    while before is None or (root != before).any():
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, before[a])
        root = root[root]
    found = links > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[found]), pa.array(mark[found]), pa.array(links[found].astype(np.int64)), pa.array(ids[root[found]])],
        ["vec_id", "mark", "links", "root"])


def compare_blocks(batches: Iterator[pa.RecordBatch], how: Plan) -> Iterator[pa.RecordBatch]:
    """The rows arrive sorted by block (t, cell, i, j)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        rows = pa.Table.from_batches([*held, batch])
        keys = [rows.column(c).to_numpy() for c in ("t", "cell", "i", "j")]
        starts = np.flatnonzero(np.append(True, np.any([key[1:] != key[:-1] for key in keys], axis=0)))
        for start, stop in zip(starts, starts[1:]):
            yield compare(rows.slice(start, stop - start), how)
        held = rows.slice(starts[-1]).to_batches()
    if held:
        yield compare(pa.Table.from_batches(held), how)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors` (vec_id, embedding)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "projections")
    with settings(spark):
        rows = scratch.write(
            vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(valid_vectors, "vec_id long, vector binary"), "rows")
        usable = rows.where("vec_id is not null and vector is not null")
        reps = scratch.write(usable.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"))
            .withColumn("mark", F.xxhash64("vector")), "reps")  # tells vectors of one id apart
        how = plan(reps.count(), threshold)
        cells = reps.mapInArrow(lambda batches: to_cells(batches, how), "t int, cell long, vec_id long, mark long, weight long, vector binary")
        full = scratch.write(cells.groupBy("t", "cell").count().where("count > 1"), "full")
        parts = F.ceil(F.col("count") / BLOCK).cast("int")
        placed = cells.join(full, ["t", "cell"]).withColumn("parts", parts).withColumn(
            "place", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            "t", "cell", "vec_id", "mark", "weight", "vector", "place", F.least("place", "other").alias("i"), F.greatest("place", "other").alias("j"))
        found = scratch.write(
            pairs.repartition("t", "cell", "i", "j").sortWithinPartitions("t", "cell", "i", "j")
            .mapInArrow(lambda batches: compare_blocks(batches, how), "vec_id long, mark long, links long, root long"), "found")

        owners = rows.join(reps.select("vector", F.col("vec_id").alias("rep")), "vector").select("vec_id", "rep")
        owners = scratch.write(owners.where("vec_id is not null"), "owners")
        same = owners.where("vec_id <> rep").select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))
        edges = found.where("vec_id <> root").select(F.col("root").alias("a"), F.col("vec_id").alias("b")).union(same)
        labels = components(edges, scratch, "all")
        links = found.groupBy("vec_id", "mark").agg(F.sum("links").alias("links"))
        counted = reps.join(links, ["vec_id", "mark"], "left").select("vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
        result = (
            rows.join(counted, "vector", "left").join(labels.toDF("vec_id", "component"), "vec_id", "left")
            .select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id"))
        )
        result = scratch.write(result, "result")
        scratch.drop("rows", "reps", "full", "found", "owners")
    return result


ship_by_value(__name__)
