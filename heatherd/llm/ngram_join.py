"""N-gram Jaccard join over count vectors (operator 2).

A document is its set of distinct word shingles. The shingles are hashed into groups; the
numbers per group are a point, and the summed coordinate minima of two points bound the
overlap of the sets from above. Unrelated sets of n shingles agree by chance in nearly all of
a few coordinates once n is large, so their number grows with the set: a power of two, one for
two shingles and `GROUPS` at least. The group is the low bits of a hash, so halves of a larger point
add up to the smaller one, and two points are compared in the coordinates of the smaller one.
Points of one bucket are packed into an R-tree (`CountTree`) in `GROUPS` coordinates:
a node keeps the largest coordinates below it, so the same sum bounds the overlap with
everything in the node. Pairs that the bounds leave are verified on the sets themselves.

Buckets come from prefixes: with all shingles in one fixed order, two sets that are similar
enough share one of the first `n - ceil(t n) + 1`. Rare shingles come first. How common a shingle
is comes from counters of fixed size (`SLOTS`) filled from the whole corpus; the counters only
choose the order, so they cannot lose a link. Shared passages thus make no buckets unless they
make up the document.

Inside a bucket not all pairs are built. First every member is compared with the bucket's
smallest one, then members of other components with a random one. What is then still apart is
compared through the tree, in blocks of at most `BLOCK` rows. No link between different components is lost, and copies of one
set are one member throughout.

Defined cases: a document without words or text has an empty set and links with nothing; one
with fewer words than a shingle is one shingle; rows with a null id are reported with their size
and no component; rows that share an id are one node of the graph, each reported; an empty table
gives an empty result; other columns are ignored. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from heatherd.llm.common import Scratch, mix, settings, slices, texts_of
from heatherd.llm.components import components
from heatherd.session import ship_by_value

WIDTH = 5
PERCENT = 80
GROUPS = 64  # least coordinates of a point, and those of the tree
PER_GROUP = 2  # shingles for which a point has one coordinate: with more, chance agreement lets near misses pass
SLOT_BITS, CHUNKS = 22, 64  # counters for the order of shingles (a power of two), and the parts they travel in
SLOTS = 1 << SLOT_BITS
COUNTED = 1 << 20  # shingles that enter the counters at a time
BLOCK = 2_000  # rows of one side of a bucket that one step compares
SMALL = 256  # pairs of a block that are compared without a tree
PAIRS = 50_000  # pairs that are bounded at a time
BASE = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a sequence of word hashes."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    count = len(hashes) - width + 1
    rolling = np.full(count, width, np.uint64)
    for step in range(width):
        rolling = rolling * BASE + hashes[step : step + count]
    found = mix(rolling)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])]


class Shingler:
    """Sets of many texts; words are those of ASCII white space splitting, A-Z in lower case."""

    def __init__(self, width: int):
        self.width = width

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # hashing a word anew takes less time than finding it in a large table
        return shingle_set(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), self.width)


def groups_of(size: int) -> int:
    """Coordinates of the point of a set."""
    return max(GROUPS, 1 << (-(-size // PER_GROUP) - 1).bit_length()) if size else GROUPS


def point(found: np.ndarray) -> bytes:
    groups = groups_of(len(found))
    return packed(np.bincount((found & np.uint64(groups - 1)).astype(np.int64), minlength=groups))


def folded(data: bytes, size: int, groups: int) -> np.ndarray:
    """The point of a set of `size` shingles in fewer coordinates."""
    return unpacked(data, groups_of(size)).reshape(-1, groups).sum(axis=0)


def packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs; the width follows from the length."""
    width = next(w for w in (1, 2, 4, 8) if counts.max(initial=0) < 1 << 8 * w)
    return counts.astype(f"<u{width}").tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // size}").astype(np.int64)


def points(rows: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Points in `GROUPS` coordinates."""
    out = np.empty((len(rows), GROUPS), np.int64)
    shapes = np.array([(len(row), groups_of(size)) for row, size in zip(rows, sizes.tolist())], np.int64).reshape(-1, 2)
    for length, groups in np.unique(shapes, axis=0).tolist():
        some = np.flatnonzero((shapes[:, 0] == length) & (shapes[:, 1] == groups))
        for part in np.array_split(some, -(-len(some) * groups // (1 << 22))):  # so many numbers at a time
            counts = np.frombuffer(b"".join([rows[i] for i in part]), f"<u{length // groups}")
            out[part] = counts.reshape(len(part), -1, GROUPS).sum(axis=1)
    return out


def sharpened(a: list[bytes], sizes_a: np.ndarray, b: list[bytes], sizes_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether each pair still reaches the similarity in as many coordinates as both points have."""
    out = np.ones(len(a), bool)
    for i in np.flatnonzero(np.minimum(sizes_a, sizes_b) > GROUPS * PER_GROUP):
        m, n = int(sizes_a[i]), int(sizes_b[i])
        groups = min(groups_of(m), groups_of(n))
        out[i] = possible(np.minimum(folded(a[i], m, groups), folded(b[i], n, groups)).sum(), m + n, percent)
    return out


def describe(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A row per document (id, size, fingerprint, point), then the partition's counters in parts."""
    make, counters = Shingler(width), np.zeros(SLOTS, np.uint32)
    held, n_held = [], 0

    def count_held() -> None:
        if held:
            slots = (np.concatenate(held) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            np.add(counters, np.bincount(slots, minlength=SLOTS), out=counters, casting="unsafe")
            held.clear()

    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fingerprint", pa.binary()),
                        ("point", pa.binary()), ("chunk", pa.int32()), ("counters", pa.binary())])
    for batch in slices(batches, "text"):
        sizes, prints, places = [], [], []
        for text in texts_of(batch, "text"):
            found = make(text)
            held.append(found)
            n_held += len(found)
            if n_held >= COUNTED:
                count_held()
                n_held = 0
            sizes.append(len(found))
            prints.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            places.append(point(found))
        nulls = pa.nulls(len(sizes))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), pa.array(prints, pa.binary()), pa.array(places),
             nulls.cast(pa.int32()), nulls.cast(pa.binary())], schema=schema)
    count_held()
    parts = counters.reshape(CHUNKS, -1)
    used = [i for i in range(CHUNKS) if parts[i].any()]
    nulls = pa.nulls(len(used))
    yield pa.RecordBatch.from_arrays(
        [nulls.cast(pa.int64()), nulls.cast(pa.int64()), nulls.cast(pa.binary()), nulls.cast(pa.binary()),
         pa.array(used, pa.int32()), pa.array([packed(parts[i]) for i in used], pa.binary())], schema=schema)


def add_counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("counters").to_pylist()):
            sums[chunk] = sums.get(chunk, 0) + unpacked(part, SLOTS // CHUNKS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([packed(s) for s in sums.values()], pa.binary())],
        ["chunk", "counters"])


def prefixes(batches: Iterator[pa.RecordBatch], width: int, percent: int, ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(token, doc_id) for the prefix of every set; equal sets of one partition appear once."""
    make, seen = Shingler(width), set()
    for batch in slices(batches, "text"):
        tokens, docs = [], []
        for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
            found = make(text)
            mark = xxhash.xxh3_128_digest(found.tobytes())
            if doc is None or not len(found) or mark in seen:
                continue
            seen.add(mark)
            order = np.lexsort((found, ranks[(found >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]))
            first = found[order[: len(found) + percent * len(found) // -100 + 1]]
            tokens.append(first.view(np.int64))
            docs.append(np.full(len(first), doc, np.int64))
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(docs))], ["token", "doc_id"])


def possible(overlap: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap reaches the similarity, for sets of `total` shingles together."""
    return (100 + percent) * overlap >= percent * total


class CountTree:
    """Packed R-tree over points of one block: runs of points by size, then by their widest coordinate."""

    FAN = 16

    def __init__(self, at: np.ndarray, sizes: np.ndarray):
        wide = at[:, int(np.argmax(at.var(axis=0)))]
        run = max(1, int(len(at) ** 0.5))
        by_size = np.argsort(sizes, kind="stable")
        slab = np.empty(len(at), np.int64)
        slab[by_size] = np.arange(len(at)) // run
        self.order = np.lexsort((wide, slab))
        self.levels = [(at[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > self.FAN:
            most, low, high = self.levels[-1]
            cuts = np.arange(0, len(most), self.FAN)
            self.levels.append((np.maximum.reduceat(most, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))

    def search(self, at: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) whose bound reaches the similarity."""
        found = [[], []]
        for start in range(0, len(at), self.FAN):
            query = np.arange(start, min(start + self.FAN, len(at)))
            nodes = np.arange(len(self.levels[-1][0]))
            query, nodes = np.repeat(query, len(nodes)), np.tile(nodes, len(query))
            for depth in range(len(self.levels) - 1, -1, -1):
                most, low, high = self.levels[depth]
                size = sizes[query]
                near = (100 * high[nodes] >= percent * size) & (percent * low[nodes] <= 100 * size)
                query, nodes = query[near], nodes[near]
                bound = np.minimum(at[query], most[nodes]).sum(axis=1)
                near = possible(bound, sizes[query] + low[nodes], percent)
                query, nodes = query[near], nodes[near]
                if depth:
                    child = nodes[:, None] * self.FAN + np.arange(self.FAN)
                    inside = child < len(self.levels[depth - 1][0])
                    query, nodes = np.repeat(query, inside.sum(axis=1)), child[inside]
            found[0].append(query)
            found[1].append(self.order[nodes])
        return np.concatenate(found[0]), np.concatenate(found[1])


def small_blocks(block: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs (query, indexed row) within each block; `block` is ascending."""
    query, index = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    blocks = block[query]
    first = np.searchsorted(block[index], blocks, side="left")
    count = np.searchsorted(block[index], blocks, side="right") - first
    left = np.repeat(query, count)
    nth = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
    return left, index[np.repeat(first, count) + nth]


def compare_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within each block (token, i, j).

    The rows arrive sorted by block; `side` 0 holds the queries, `side` 1 the indexed rows. A block
    of more than `SMALL` pairs goes through the tree; pairs of small ones are bounded directly.
    """
    def settle(rows: pa.Table) -> pa.RecordBatch:
        side, doc, label, sizes = (rows.column(c).to_numpy() for c in ("side", "doc_id", "label", "n_shingles"))
        keys = [rows.column(c).to_numpy() for c in ("token", "i", "j")]
        new = np.append(True, np.any([key[1:] != key[:-1] for key in keys], axis=0))
        block = np.cumsum(new)
        packed_points = rows.column("point").to_pylist()
        at = points(packed_points, sizes)
        sides = [np.bincount(block[side == k], minlength=block[-1] + 1) for k in (0, 1)]
        large = sides[0] * sides[1] > SMALL
        small, found = np.flatnonzero(~large[block]), []
        left, right = small_blocks(block[small], side[small])
        for begin in range(0, len(left), PAIRS):
            a, b = small[left[begin : begin + PAIRS]], small[right[begin : begin + PAIRS]]
            some = (label[a] != label[b]) & (100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b]))
            a, b = a[some], b[some]
            near = possible(np.minimum(at[a], at[b]).sum(axis=1), sizes[a] + sizes[b], percent)
            found.append((a[near], b[near]))
        for number in np.flatnonzero(large):
            start, stop = np.searchsorted(block, [number, number + 1])
            query, index = (start + np.flatnonzero(side[start:stop] == k) for k in (0, 1))
            left, right = CountTree(at[index], sizes[index]).search(at[query], sizes[query], percent)
            found.append((query[left], index[right]))
        left, right = (np.concatenate([pair[k] for pair in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        apart = label[left] != label[right]
        left, right = left[apart], right[apart]
        _, once = np.unique(np.stack([np.minimum(doc[left], doc[right]), np.maximum(doc[left], doc[right])], axis=1), axis=0, return_index=True)
        left, right = left[once], right[once]
        near = sharpened([packed_points[i] for i in left], sizes[left], [packed_points[i] for i in right], sizes[right], percent)
        a, b = doc[left[near]], doc[right[near]]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        rows = pa.Table.from_batches([*held, batch])
        keys = [rows.column(c).to_numpy() for c in ("token", "i", "j")]
        cut = int(np.flatnonzero(np.append(True, np.any([key[1:] != key[:-1] for key in keys], axis=0)))[-1])
        if cut:  # the last block may go on
            yield settle(rows.slice(0, cut))
        held = rows.slice(cut).to_batches()
    if held:
        yield settle(pa.Table.from_batches(held))


def verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            overlap = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
            keep.append(possible(overlap, len(x) + len(y), percent))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def bounded(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (a, m), (b, n) = ((batch.column(f"point_{side}").to_pylist(), batch.column(f"size_{side}").to_numpy()) for side in "ab")
        near = possible(np.minimum(points(a, m), points(b, n)).sum(axis=1), m + n, percent)
        near[near] = sharpened([a[i] for i in np.flatnonzero(near)], m[near], [b[i] for i in np.flatnonzero(near)], n[near], percent)
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def sets_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    make = Shingler(width)
    for batch in slices(batches, "text"):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([make(t).tobytes() for t in texts_of(batch, "text")], pa.binary())], ["doc_id", "set"])


def jaccard_groups(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch = Scratch(spark, "ngram-join")
    with settings(spark):
        described = scratch.write(docs.mapInArrow(
            lambda batches: describe(batches, width),
            "doc_id long, n_shingles long, fingerprint binary, point binary, chunk int, counters binary"), "described")
        parts = (
            described.where("chunk is not null").select("chunk", "counters").repartition(CHUNKS, "chunk")
            .mapInArrow(add_counters, "chunk int, counters binary").collect()  # SLOTS numbers, whatever the input
        )
        counters = np.zeros((CHUNKS, SLOTS // CHUNKS), np.int64)
        for part in parts:
            counters[part.chunk] = unpacked(part.counters, SLOTS // CHUNKS)
        # only the order of the counts matters, so it fits 32 bits at any scale
        ranks = np.unique(counters.ravel(), return_inverse=True)[1].astype(np.uint32)
        shared_ranks = spark.sparkContext.broadcast(ranks)
        rows = described.where("chunk is null").drop("chunk", "counters")

        # one member for all copies of a set, or of an id
        known = rows.where("doc_id is not null and fingerprint is not null")
        classes = scratch.write(known.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "classes")
        members = scratch.write(known.join(classes, "fingerprint").select("doc_id", "rep", "n_shingles", "point"), "members")
        shared = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
        copies = members.where("doc_id <> rep").select("doc_id", "rep").distinct()
        reps = members.where("doc_id = rep").select("doc_id", "n_shingles", "point")

        tokens = scratch.write(docs.mapInArrow(
            lambda batches: prefixes(batches, width, percent, shared_ranks.value), "token long, doc_id long"), "prefixes")
        counted = tokens.groupBy("token").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        common = scratch.write(counted.where("low <> high").select("token"), "common")
        hits = tokens.join(common, "token")
        hits = hits.join(copies.toDF("doc_id", "rep"), "doc_id", "left").select("token", F.coalesce("rep", "doc_id").alias("doc_id")).distinct()
        hits = scratch.write(hits, "all-hits")
        scratch.drop("prefixes", "common")
        # most buckets of a group of near copies have the same members: one of them is enough
        marks = [F.bit_xor(F.xxhash64(F.lit(seed), "doc_id")).alias(f"mark{seed}") for seed in (1, 2)]
        buckets = hits.groupBy("token").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last"), F.count("*").alias("n"), *marks)
        buckets = buckets.where("pivot <> last").groupBy("pivot", "last", "n", "mark1", "mark2").agg(F.min("token").alias("token"))
        pivots = scratch.write(buckets.select("token", "pivot"), "pivots")
        hits = scratch.write(hits.join(pivots.select("token"), "token"), "hits")
        scratch.drop("all-hits")
        stars = hits.join(pivots, "token").where("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
        stars = scratch.write(stars, "stars")

        wanted = hits.select("doc_id").distinct()
        sets = scratch.write(
            docs.join(wanted, "doc_id", "left_semi").mapInArrow(lambda batches: sets_of(batches, width), "doc_id long, set binary"), "sets")

        def links(pairs: DataFrame, name: str) -> DataFrame:
            a = reps.toDF("a", "size_a", "point_a")
            b = reps.toDF("b", "size_b", "point_b")
            near = pairs.join(a, "a").join(b, "b").where(
                (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")))
            near = scratch.write(near.mapInArrow(lambda batches: bounded(batches, percent), "a long, b long"), f"{name}-near")
            both = near.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
            return scratch.write(both.mapInArrow(lambda batches: verify(batches, percent), "a long, b long"), f"{name}-links")

        def labelled_hits(labels: DataFrame, name: str) -> DataFrame:
            joined = hits.join(labels.toDF("doc_id", "label"), "doc_id", "left")
            return scratch.write(joined.withColumn("label", F.coalesce("label", "doc_id")), name)

        star_links = links(stars, "star")
        labelled = labelled_hits(components(star_links, scratch, "star"), "starred")
        # a second round with a random member of every bucket joins most of what is left of dense groups
        pick = F.min(F.struct(F.xxhash64("doc_id", "token").alias("hash"), F.col("doc_id").alias("pick"), F.col("label").alias("main")))
        picks = labelled.groupBy("token").agg(pick.alias("at")).select("token", "at.pick", "at.main")
        again = labelled.join(picks, "token").where("label <> main").select(
            F.least("doc_id", "pick").alias("a"), F.greatest("doc_id", "pick").alias("b")).distinct()
        tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        picked = scratch.write(again.join(tested, ["a", "b"], "left_anti"), "picked")
        star_links = star_links.union(links(picked, "picked"))
        tested = tested.union(picked)
        scratch.drop("starred")

        labelled = labelled_hits(components(star_links, scratch, "picked"), "labelled")
        main = labelled.groupBy("token").agg(
            F.min("label").alias("main"), F.max("label").alias("high"), F.count("*").alias("n")).where("main <> high")
        mixed = labelled.join(main, "token").withColumn("odd", F.col("label") != F.col("main"))
        odd = mixed.where("odd").groupBy("token").agg(F.count("*").alias("n_odd"))
        cells = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
        mixed = mixed.join(odd, "token").withColumns({"cells_i": cells("n_odd"), "cells_j": cells("n")})
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        place = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
        queries = mixed.where("odd").withColumn("i", place("cells_i")).withColumn("j", every("cells_j")).withColumn("side", F.lit(0))
        indexed = mixed.withColumn("j", place("cells_j")).withColumn("i", every("cells_i")).withColumn("side", F.lit(1))
        columns = ["token", "i", "j", "side", "doc_id", "label"]
        blocks = scratch.write(queries.select(columns).union(indexed.select(columns)), "blocks").join(reps, "doc_id")
        pairs = (
            blocks.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
            .mapInArrow(lambda batches: compare_blocks(batches, percent), "a long, b long").distinct()
            .join(tested, ["a", "b"], "left_anti")
        )
        pairs = scratch.write(pairs, "pairs")
        scratch.drop("blocks", "labelled", "hits")
        cross_links = links(pairs, "cross")

        all_links = star_links.union(cross_links)
        # an id that stands in several rows joins the classes of all of them
        repeated = members.join(shared, "doc_id", "left_semi").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        labels = components(all_links.union(repeated), scratch, "all")
        owned = members.groupBy("doc_id").agg(F.min("rep").alias("rep"))
        owned = owned.join(labels.toDF("rep", "component"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("group"))
        result = rows.select("doc_id", "n_shingles").join(owned, "doc_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("group", "doc_id").alias("component_id"))
        result = scratch.write(result, "result")
        scratch.clear("result")
        return result


def keep_first(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One row for the smallest id of each group, and all rows without an id; input columns."""
    first = jaccard_groups(docs, percent, width).where("doc_id = component_id").select("doc_id").distinct()
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    kept = docs.join(first, "doc_id", "left_semi").withColumn("_rank", rank).where("_rank = 1")
    return docs.where("doc_id is null").unionByName(kept.select(*docs.columns))


ship_by_value(__name__)
