"""Conversation prefix trie from range minima over sorted LCPs (operator 11).

Conversations become sequences of turn fingerprints (two 64-bit hashes of role and text), are sorted
as sequences, and the LCP of neighbours, the number of first turns they share, is kept. Members of a
prefix stand side by side: the prefix of depth d at one conversation reaches to both sides as far as
no LCP falls below d. A task holds a block of the order, builds a sparse table of range minima over
its LCPs, and every prefix of every conversation searches its left and right end there, bisecting
by powers of two, without a stack and without regard to other prefixes. The first member stands for
the node.

All figures of a node are sums over its interval: a leaf ends where the next LCP is shorter than the
conversation, a child starts where the LCP equals the depth, and the bytes that the subtree saves
are those of the turns shared with the conversation before. So a node that reaches over the edge of
a block, and only such a one, is added up from its parts, found by the hash of its prefix; edges
of tasks are then put right from the first and the last conversation of each task.

Defined cases: a null role or text is an empty one; turns of one number follow by role, then by the
hash of the text; a null turn comes first; rows without conv_id are left out; repeated rows are
repeated turns; an empty table gives an empty result; other columns are ignored. A conversation
is one row of 24 bytes a turn, its texts are not kept together. The digest of the ends of a node is
read from its ids in order, packed by block; only the digest itself is one stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from heatherd.llm.common import Scratch, mix, settings
from heatherd.session import ship_by_value

FAMILY = 5  # conversations that share the first turns of their first one
MOST = 9  # shared turns are fewer
BLOCK_ROWS, BLOCK_TURNS = 4_096, 200_000
SALTS = 16
NONE = hashlib.sha256(b"").hexdigest()
SEEDS = (0x6A09E667F3BCC909, 0xBB67AE8584CAA73B)

CLOSED, OPEN, EDGE = 0, 1, 2
PARTS = (
    "kind int, k1 long, k2 long, p1 long, p2 long, depth int, conv_id long, parent_conv_id long, parent_open boolean, "
    "n_convs long, n_children long, n_leaves long, shared long, before long, ends string, first_end long, part int, edge binary"
)


def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): each conversation with the first turns of its family's first one, as (f1, f2, n_bytes)."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        "turn", role.alias("role"), F.xxhash64(F.lit(1), role, text).alias("f1"), F.xxhash64(F.lit(2), role, text).alias("f2"),
        F.octet_length(text).alias("n_bytes")).alias("turn"))
    plain = lambda turn: F.struct(turn["f1"].alias("f1"), turn["f2"].alias("f2"), turn["n_bytes"].alias("n_bytes"))
    own = rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("turn")), plain).alias("own"))
    first = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.slice("own", 1, MOST).alias("first"))
    both = own.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(first, "family", "left")
    h = shared_turns(F.col("conv_id"))
    begin = F.coalesce(F.slice("first", F.lit(1), h), F.array().cast("array<struct<f1:bigint,f2:bigint,n_bytes:int>>"))
    return both.select("conv_id", F.concat(begin, F.slice("own", h + 1, F.size("own"))).alias("seq"))


class Rows:
    """Conversations in order, as flat arrays."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, f1: np.ndarray, f2: np.ndarray, n_bytes: np.ndarray):
        self.ids, self.sizes, self.f1, self.f2, self.n_bytes = ids, sizes, f1, f2, n_bytes
        self.starts = np.cumsum(sizes) - sizes

    def __len__(self) -> int:
        return len(self.ids)

    @staticmethod
    def of(batch: pa.RecordBatch) -> Rows:
        lists = batch.column("seq")
        f1, f2, n_bytes = (part.to_numpy(zero_copy_only=False) for part in lists.flatten().flatten())
        return Rows(batch.column("conv_id").to_numpy(), np.diff(lists.offsets.to_numpy()).astype(np.int64),
                    f1.astype(np.int64), f2.astype(np.int64), n_bytes.astype(np.int64))

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        return Rows(*(np.concatenate([getattr(part, name) for part in parts]) for name in ("ids", "sizes", "f1", "f2", "n_bytes")))

    def part(self, begin: int, end: int) -> Rows:
        low = self.starts[begin] if begin < len(self) else len(self.f1)
        high = self.starts[end] if end < len(self) else len(self.f1)
        return Rows(self.ids[begin:end], self.sizes[begin:end], self.f1[low:high], self.f2[low:high], self.n_bytes[low:high])

    def lcps(self) -> np.ndarray:
        """Turns that each row shares with the one before; -1 for the first row."""
        least = np.minimum(self.sizes[:-1], self.sizes[1:])
        begins = np.cumsum(least) - least
        place = np.arange(least.sum()) - np.repeat(begins, least)
        a, b = np.repeat(self.starts[:-1], least) + place, np.repeat(self.starts[1:], least) + place
        differ = np.flatnonzero((self.f1[a] != self.f1[b]) | (self.f2[a] != self.f2[b]))
        first = np.append(differ, len(a))[np.searchsorted(differ, begins)]
        return np.concatenate([[-1], np.minimum(first - begins, least)]).astype(np.int64)

    def prefixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two hashes and the bytes of the prefix before each turn, and a last one of everything."""
        place = (np.arange(len(self.f1)) - np.repeat(self.starts, self.sizes)).astype(np.uint64)
        keys = []
        for seed, turn in zip(SEEDS, (self.f1, self.f2)):
            value = mix(turn.view(np.uint64) + mix(place + np.uint64(seed)))
            keys.append(np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(value)]))
        return keys[0], keys[1], np.concatenate([[0], np.cumsum(self.n_bytes)])


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of 2^k values from each place on."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half, last = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(last[:-half], last[half:]))
    return levels


def extents(levels: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row around `row` that no LCP below `depth` parts from it; `levels` of the LCPs."""
    count, left, right = len(levels[0]), row.copy(), row.copy()
    for k in range(len(levels) - 1, -1, -1):
        size, least = 1 << k, levels[k]
        far = right + size < count
        at = np.where(far, right + 1, 0)
        right += size * (far & (least[np.minimum(at, len(least) - 1)] >= depth))
        far = left - size >= 0
        at = np.where(far, left - size + 1, 0)
        left -= size * (far & (least[np.minimum(at, len(least) - 1)] >= depth))
    return left, right


def least_between(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    k = np.log2(right - left + 1).astype(np.int64)
    out = np.empty(len(left), levels[0].dtype)
    for level in np.unique(k):
        some = k == level
        out[some] = np.minimum(levels[level][left[some]], levels[level][right[some] - (1 << level) + 1])
    return out


def block_nodes(rows: Rows, lcp: np.ndarray, following: int | None, first: bool) -> pa.RecordBatch:
    """Nodes of a block, or their parts. `lcp[0]` looks back to the row before the block, `following` ahead.

    `first`: there is no row before in this task; `following` is None: there is none behind. Both
    count as LCPs of -1 here; `edge_corrections` puts that right.
    """
    count = len(rows)
    ahead = np.append(lcp[1:], -1 if following is None else following)
    k1, k2, size_before = rows.prefixes()

    row = np.repeat(np.arange(count), rows.sizes + 1)
    begin = np.cumsum(rows.sizes + 1) - (rows.sizes + 1)
    depth = np.arange(len(row)) - begin[row]
    inner = lcp.copy()
    inner[0] = -1
    left, right = extents(sparse_table(inner), row, depth)
    ends = np.bincount(begin[left[begin + rows.sizes]] + rows.sizes, minlength=len(row))  # rows that end at a prefix

    own = left == row  # the first member stands for the node
    number = np.cumsum(own) - 1
    up = np.maximum(np.arange(len(row)) - 1, 0)
    parent = number[begin[left[up]] + np.maximum(depth - 1, 0)][own]
    row, depth, right, ends = row[own], depth[own], right[own], ends[own]

    shared = np.where(lcp > 0, size_before[rows.starts + np.maximum(lcp, 0)] - size_before[rows.starts], 0)
    total = lambda values: np.concatenate([[0], np.cumsum(values)])
    shared_total, leaf_total = total(shared), total(ahead < rows.sizes)
    continued = (row == 0) & (lcp[0] >= depth)
    opened = (right == count - 1) & ((following is None) | (ahead[-1] >= depth)) | continued | ((row == 0) & first)
    conv = least_between(sparse_table(rows.ids), row, right)
    children = np.bincount(parent[(depth > 0) & ~continued], minlength=len(row))
    at = rows.starts[row]
    key = [(k[at + depth] ^ k[at]).view(np.int64) for k in (k1, k2)]
    above = at + np.maximum(depth - 1, 0)
    parent_key = [(k[above] ^ k[at]).view(np.int64) for k in (k1, k2)]
    listed, first_end = [], []
    names = [str(one) for one in rows.ids.tolist()]
    for start, n, is_open in zip(row.tolist(), ends.tolist(), opened.tolist()):
        text = ",".join(names[start : start + n]) if n else None
        listed.append(text if is_open else NONE if text is None else hashlib.sha256(text.encode()).hexdigest())
        first_end.append(int(rows.ids[start]) if n else None)
    n = len(row)
    return pa.RecordBatch.from_arrays([
        pa.array(np.where(opened, OPEN, CLOSED), pa.int32()), pa.array(key[0]), pa.array(key[1]),
        pa.array(parent_key[0], mask=depth == 0), pa.array(parent_key[1], mask=depth == 0), pa.array(depth, pa.int32()),
        pa.array(conv), pa.array(conv[parent], mask=(depth == 0) | opened[parent]), pa.array(opened[parent]),
        pa.array(right - row + 1), pa.array(children, pa.int64()), pa.array(leaf_total[right + 1] - leaf_total[row]),
        pa.array(shared_total[right + 1] - shared_total[row + ~continued]), pa.array(size_before[above] - size_before[at]),
        pa.array(listed, pa.string()), pa.array(first_end, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
    ], names=[name.split()[0] for name in PARTS.split(", ")])


def packed_edge(first: Rows, last: Rows) -> bytes:
    return np.concatenate([np.concatenate([one.sizes, one.f1, one.f2, one.n_bytes]) for one in (first, last)]).astype("<i8").tobytes()


def unpacked_edge(edge: bytes) -> list[Rows]:
    values, out, at = np.frombuffer(edge, "<i8"), [], 0
    for _ in range(2):
        n = int(values[at])
        f1, f2, n_bytes = values[at + 1 : at + 1 + 3 * n].reshape(3, n)
        out.append(Rows(np.zeros(1, np.int64), np.array([n]), f1, f2, n_bytes))
        at += 1 + 3 * n
    return out


def partial_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, seq) of one task to its nodes; a last row holds its first and last conversation."""
    held: list[Rows] = []
    first = before = None

    def block(rows: Rows, following: Rows | None) -> pa.RecordBatch:
        lcp = rows.lcps() if before is None else Rows.joined([before, rows]).lcps()[1:]
        ahead = None if following is None else int(Rows.joined([rows.part(len(rows) - 1, len(rows)), following]).lcps()[1])
        return block_nodes(rows, lcp, ahead, before is None)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(Rows.of(batch))
        if first is None:
            first = held[0].part(0, 1)
        rows, turns = (sum(map(size, held)) for size in (len, lambda part: len(part.f1)))
        if rows > 1 and (rows > BLOCK_ROWS or turns > BLOCK_TURNS):
            whole = Rows.joined(held)
            ready, held = whole.part(0, rows - 1), [whole.part(rows - 1, rows)]
            yield block(ready, held[0])
            before = ready.part(rows - 2, rows - 1)
    if held:
        rest = Rows.joined(held)
        yield block(rest, None)
        edge = packed_edge(first, rest.part(len(rest) - 1, len(rest)))
        row = {"kind": EDGE, "part": TaskContext.get().partitionId(), "edge": edge}
        yield pa.RecordBatch.from_pylist([row], schema=ARROW_PARTS)


ARROW_PARTS = pa.schema([
    (name, {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}[kind])
    for name, kind in (column.split() for column in PARTS.split(", "))
])


def edge_corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the LCP between two tasks changes in the parts on both sides of it."""
    for batch in batches:
        for before, after in zip(batch.column("before").to_pylist(), batch.column("edge").to_pylist()):
            if before is None:
                continue
            (_, last), (following, _) = unpacked_edge(before), unpacked_edge(after)
            lcp = int(Rows.joined([last, following]).lcps()[1])
            out = []
            for rows, depths in ((last, range(len(last.f1) + 1) if lcp >= len(last.f1) else ()), (following, range(lcp + 1))):
                k1, k2, size = (part.view(np.int64) for part in rows.prefixes())
                ahead = rows is following
                for d in depths:
                    out.append({
                        "kind": OPEN, "k1": int(k1[d]), "k2": int(k2[d]), "n_convs": 0, "n_leaves": 0 if ahead else -1,
                        "n_children": -1 if ahead and d < lcp else 0, "shared": int(size[lcp]) if ahead else 0})
            yield pa.RecordBatch.from_pylist(out, schema=ARROW_PARTS)


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node; rows come sorted by node and first id."""
    node, digest = None, None
    for batch in batches:
        keys, out = [], []
        for k1, k2, ends in zip(*(batch.column(name).to_pylist() for name in ("k1", "k2", "ends"))):
            if (k1, k2) == node:
                digest.update(b",")
            else:
                if node is not None:
                    keys.append(node)
                    out.append(digest.hexdigest())
                node, digest = (k1, k2), hashlib.sha256()
            digest.update(ends.encode())
        yield pa.RecordBatch.from_pydict({"k1": [a for a, _ in keys], "k2": [b for _, b in keys], "ends": out}, schema=DIGESTS)
    if node is not None:
        yield pa.RecordBatch.from_pydict({"k1": [node[0]], "k2": [node[1]], "ends": [digest.hexdigest()]}, schema=DIGESTS)


DIGESTS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends", pa.string())])


def prefix_nodes(sequences: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes of the trie of `sequences` (conv_id, seq): one row per distinct prefix.

    A node is known by its smallest member and its depth; the text of its last turn is the turn of
    this depth in that conversation.
    """
    ordered = sequences.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    parts = scratch.write(ordered.mapInArrow(partial_nodes, PARTS), "parts")
    # one row per task of the sort
    edges = parts.where(F.col("kind") == EDGE).select("edge", F.lag("edge").over(Window.orderBy("part")).alias("before"))
    opened = parts.where(F.col("kind") == OPEN)
    total = lambda name: F.sum(name).alias(name)
    merged = opened.union(edges.mapInArrow(edge_corrections, PARTS)).groupBy("k1", "k2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        total("n_convs"), total("n_children"), total("n_leaves"), total("shared"), F.max("before").alias("before"))
    listed = opened.where("ends IS NOT NULL").select("k1", "k2", "first_end", "ends").repartition("k1", "k2")
    listed = listed.sortWithinPartitions("k1", "k2", "first_end").drop("first_end").mapInArrow(digests, "k1 long, k2 long, ends string")
    merged = scratch.write(merged.join(listed, ["k1", "k2"], "left").withColumn("ends", F.coalesce("ends", F.lit(NONE))), "merged")

    columns = ["p1", "p2", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "shared", "before", "ends"]
    closed = parts.where(F.col("kind") == CLOSED)
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int").alias("salt")
    below = closed.where("parent_open").select(*columns, salt).union(merged.select(*columns, salt))
    above = merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    nodes = below.join(above, ["p1", "p2", "salt"], "left").drop("salt").unionByName(
        closed.where("NOT parent_open").select(*columns, "parent_conv_id"))
    return nodes.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of `turns` (conv_id, turn, role, text)."""
    scratch = Scratch(turns.sparkSession, "trie")
    with settings(turns.sparkSession):
        return prefix_nodes(scratch.write(rebuilt(turns), "sequences"), scratch)


ship_by_value(__name__)
