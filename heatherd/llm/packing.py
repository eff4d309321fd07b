"""Hierarchical packing into several context sizes (operator 10).

A document's ids are cut into full windows of the largest tier; what remains is routed to the
smallest tier that holds it. Each tier is packed from long to short: the gap that a remainder
leaves in its window is filled with whole remainders of shorter tiers, and what none of them fits
is cut from one exactly. Windows therefore are full powers of two, which need no padding; only
the last window of a group of documents may be padded. Sequences of one tier are dealt into
steps of equal size.

Full windows never move: they are numbered where they are made. Remainders are packed in groups of
about `GROUP_ROWS` documents, dealt by a hash of id and row, so the work of a group is bounded
whatever the input and equal ids do not meet in one group.

Defined cases: a null text is an empty one, of the end id alone; a null id stays null; equal rows
are packed separately; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from heatherd.llm.common import Scratch, mix, settings, slices, texts_of
from heatherd.llm.tokens import Encoder
from heatherd.session import ship_by_value

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 0
WINDOW = 1024
TIERS = (64, 128, 256, 512, 1024)  # powers of two up to the window
GROUP_ROWS = 2_000
STEP_TOKENS = 8 * WINDOW
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
         "offset long, tier int, step_id long")
MADE = f"{PIECE}, group long, ids binary"
TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, TYPES[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def make_pieces(batches: Iterator[pa.RecordBatch], path: str, end: int, groups: int) -> Iterator[pa.RecordBatch]:
    """Full windows as finished sequences, and remainders with their ids and group."""
    encoder, last = Encoder(path, spaces=True), np.array([end], "<u4").tobytes()
    schema, size = arrow_schema(MADE), 4 * WINDOW
    sequence = (TaskContext.get().partitionId() << 33) * 2  # even: full windows; odd: packed groups
    per_step, made, row = STEP_TOKENS // WINDOW, 0, 0
    for batch in slices(batches, "text"):
        columns: list[list] = [[] for _ in schema]
        for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode([t.decode() for t in texts_of(batch, "text")])):
            ids += last
            total, row = len(ids) // 4, row + 1
            for begin in range(0, len(ids) - size + 1, size):
                piece = (doc, begin // 4, WINDOW, zlib.crc32(ids[begin : begin + size]), total,
                         sequence + 2 * made, 0, WINDOW, sequence + 2 * (made // per_step), None, None)
                for column, value in zip(columns, piece):
                    column.append(value)
                made += 1
            rest = len(ids) % size
            if rest:
                key = np.array([(doc or 0) & 0xFFFFFFFFFFFFFFFF, row], np.uint64)
                group = int(mix(mix(key[:1]) + key[1:])[0] % np.uint64(groups))
                piece = (doc, (len(ids) - rest) // 4, rest // 4, None, total, None, None, None, None, group, ids[len(ids) - rest :])
                for column, value in zip(columns, piece):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Shelf:
    """Remainders by length; `mask` has a bit for each length in stock."""

    def __init__(self, window: int):
        self.stock: list[list] = [[] for _ in range(window + 1)]
        self.mask = 0

    def put(self, length: int, item) -> None:
        self.stock[length].append(item)
        self.mask |= 1 << length

    def take(self, length: int):
        item = self.stock[length].pop()
        if not self.stock[length]:
            self.mask &= ~(1 << length)
        return item

    def longest(self, most: int) -> int:
        """The largest length in stock up to `most`, or 0."""
        return max((self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1, 0)

    def next_longer(self, length: int) -> int:
        above = self.mask >> (length + 1)
        return length + 1 + (above & -above).bit_length() - 1 if above else 0


def fill_windows(items: list[tuple[int, int]], tiers: tuple[int, ...] = TIERS) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Windows (tier, pieces) from items (length, item); a piece is (item, begin in it, length).

    Every window but the last one is full.
    """
    shelf = Shelf(tiers[-1])
    for length, item in items:
        shelf.put(length, (item, 0))
    while shelf.mask:
        length = shelf.longest(tiers[-1])
        tier = next(t for t in tiers if t >= length)
        pieces, gap = [], tier
        while gap and shelf.mask:
            fits = shelf.longest(gap)
            length = fits or shelf.next_longer(gap)
            item, begin = shelf.take(length)
            part = min(length, gap)
            pieces.append((item, begin, part))
            if length > part:
                shelf.put(length - part, (item, begin + part))
            gap -= part
        yield tier, pieces


def pack_group(rows: pa.Table) -> pa.Table:
    """Pieces of one group of remainders, placed."""
    rows = rows.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("doc_tokens", "ascending")])
    doc, start, total = (rows.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
    ids, group = rows.column("ids").to_pylist(), rows.column("group")[0].as_py()
    windows = list(fill_windows([(len(one) // 4, i) for i, one in enumerate(ids)]))
    windows.sort(key=lambda window: -window[0])
    schema = arrow_schema(PIECE)
    columns: list[list] = [[] for _ in schema]
    used, step, before = 0, -1, None
    for number, (tier, pieces) in enumerate(windows):
        if tier != before or used + tier > STEP_TOKENS:
            step, used, before = step + 1, 0, tier
        used, offset, name = used + tier, 0, (group << 32) * 2 + 1
        for item, begin, length in pieces:
            crc = zlib.crc32(ids[item][4 * begin : 4 * (begin + length)])
            piece = (doc[item], start[item] + begin, length, crc, total[item], name + 2 * number, offset, tier, name + 2 * step)
            for column, value in zip(columns, piece):
                column.append(value)
            offset += length
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END) -> DataFrame:
    """One row per piece of every row of `docs` (doc_id, text): its place in the document and in a sequence."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch = Scratch(spark, "packing")
    with settings(spark):
        groups = max(1, -(-docs.count() // GROUP_ROWS))
        made = scratch.write(docs.mapInArrow(lambda batches: make_pieces(batches, tokenizer, end, groups), MADE), "made")
        packed = made.where("group is not null").groupBy("group").applyInArrow(pack_group, PIECE)
        names = [part.split()[0] for part in PIECE.split(", ")]
        pieces = scratch.write(made.where("group is null").select(names).union(packed), "pieces")
        scratch.drop("made")
    return pieces


ship_by_value(__name__)
