"""Connected components of a link table, by contraction rounds over written tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heatherd.llm.common import Scratch
from heatherd.session import ship_by_value


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links (a, b) of one partition that join two of its trees; the others add nothing."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(node, node)) != top:
            parent[node], node = top, up
        return top

    for batch in batches:
        keep = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = root(a), root(b)
            keep.append(x != y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        yield batch.filter(pa.array(keep, pa.bool_()))


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    Every round hangs each node on the neighbour that comes first in a random order and joins the
    nodes that hang on the same one, so the number of nodes falls by a constant share whatever
    the shape. Only minima per node are aggregated, after a map-side combine: a node with very
    many links is no hot key. Each round is written, so a lost executor costs one round at most.
    """
    rank = lambda column: F.struct(F.xxhash64(column).alias("hash"), column.alias("id"))
    edges = scratch.write(links.select("a", "b").where("a <> b").mapInArrow(forest, "a long, b long"), f"{name}-edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(steps)
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("node", "other")
        hook = both.groupBy("node").agg(F.min(rank(F.col("other"))).alias("first")).select(
            "node", F.least(F.col("first"), rank(F.col("node"))).getField("id").alias("to"))
        hook = scratch.write(hook.toDF("node", "to"), f"{name}-hook{k}")
        moved = (
            edges.join(hook.toDF("a", "x"), "a").join(hook.toDF("b", "y"), "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        edges = scratch.write(moved.mapInArrow(forest, "a long, b long").distinct(), f"{name}-edges{k}")
        steps.append(hook)
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    top = steps[-1].select("node", F.col("to").alias("component"))
    for hook in reversed(steps[:-1]):
        top = hook.join(top.toDF("to", "component"), "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    top = scratch.write(top, f"{name}-tops")
    least = scratch.write(top.groupBy("component").agg(F.min("node").alias("least")), f"{name}-least")
    return scratch.write(top.join(least, "component").select("node", F.col("least").alias("component")), f"{name}-labels")


ship_by_value(__name__)
