"""Removal of repeated passages by a hash-compared suffix sort (operator 7).

Every byte covered by a `LENGTH`-byte string that also starts in a document with a smaller id is
removed. A string is found at an anchor: the smallest hash among its `GRAM`-byte pieces, so equal
strings have equal anchors at equal places, and only anchors (about one in eighteen bytes) are
shuffled. Anchors of a single document go. Occurrences of one anchor whose whole surroundings
agree are settled by their smallest id, and one of them stands for all. What is left are the edges
of repeats, where surroundings differ: their strings are sorted as suffixes.

Strings that meet in a sort agree in more than their anchor. A string has 17 bytes before its anchor
or 18 after it; these bytes and the anchor are its key, so every surrounding gives two rows at most and
equal strings have equal keys. A key with more than `BLOCK` rows is split: rows with the same bytes
are settled by their smallest id, the others are halved by the distance of the anchor, which makes
the keys longer, at last as long as the string.

The sort (`sort_suffixes`) is a mergesort. Prefix polynomial hashes give the hash of any substring;
a binary search over them finds the common extension of two suffixes, so a comparison takes a
logarithmic number of steps. Neighbours that agree in `LENGTH` bytes are compared byte by byte
before they count as equal; a collision sends the block to a sort on the bytes.

Defined cases: a null text is an empty one; texts shorter than `LENGTH` lose nothing; a row with a
null id neither removes nor is removed from; equal rows share their result; rows that share an id
but not the text do not remove from each other (they are told apart by 15 bits of their checksum);
an empty table gives an empty result; columns of the input pass through, but those named like a
result are replaced. Long texts are scanned in overlapping parts of `PART` bytes. A removal may
cut a multi-byte character; `kept` therefore holds bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heatherd.llm.common import Scratch, mix, settings, slices, texts_of
from heatherd.session import ship_by_value

LENGTH = 50  # bytes of a string
GRAM = 16  # bytes of an anchor
PART = 1 << 17  # bytes scanned at a time: the arrays of a part stay in a processor's cache
HELD = 1 << 20  # bytes of edges that a task sorts at a time, unless one key has more
BLOCK = 2_048  # rows of one key that are sorted together
ROWS = 20_000  # edges cut at a time
POSITION_BITS = 28
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
TABLE = mix(np.arange(1, 257, dtype=np.uint64))  # a random 64-bit value for each byte
TAG = 0x7FFF


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Prefix polynomial hashes of a buffer: `of(start, length)` is the hash of any substring."""

    up, down = powers(BASE, 1), powers(INVERSE, 1)

    def __init__(self, data: np.ndarray):
        if len(data) + 1 > len(Hashes.up):
            Hashes.up, Hashes.down = powers(BASE, 2 * len(data) + 2), powers(INVERSE, 2 * len(data) + 2)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(TABLE[data] * Hashes.up[: len(data)], out=self.total[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.total[start + length] - self.total[start]) * Hashes.down[start]


def anchors(data: np.ndarray, hashes: Hashes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of all strings inside the texts data[begins:ends].

    Returns token, place, strings before the anchor, number of strings and text of each run of
    strings that share an anchor. The leftmost of equal hashes counts.
    """
    grams = hashes.total[GRAM:] - hashes.total[:-GRAM]
    grams *= Hashes.down[: len(grams)]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0x94D049BB133111EB)
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, step = LENGTH - GRAM + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[: len(least) - step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    stops = ends - LENGTH + 1  # strings that begin from here on leave the text
    begin = np.unique(np.concatenate([np.flatnonzero(least[1:] != least[:-1]) + 1, begins, stops]))
    count = np.diff(np.append(begin, len(least)))
    text = np.searchsorted(begins, begin, side="right") - 1
    inside = (begin < len(least)) & (text >= 0)
    inside &= begin < stops[text]
    begin, count, text = begin[inside], count[inside], text[inside]
    place = (least[begin] & low).astype(np.int64)
    return grams[place].view(np.int64), place, place - begin, count, text


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Buffers of whole texts or overlapping parts of a long one.

    Yields the bytes, the bounds of the texts in them, and for each text the row's id, tag and the
    offset that turns a place of the buffer into a place of the text.
    """
    for batch in slices(batches, "text", PART):
        rows = [(doc, text) for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"))
                if doc is not None and len(text) >= LENGTH]
        if not rows:
            continue
        docs, tags = np.array([doc for doc, _ in rows]), np.array([zlib.crc32(text) & TAG for _, text in rows])
        if len(rows) == 1:
            text = rows[0][1]
            for begin in range(0, len(text) - LENGTH + 1, PART):
                data = np.frombuffer(text[begin : begin + PART + LENGTH - 1], np.uint8)
                yield data, np.array([0]), np.array([len(data)]), docs, tags, np.array([begin])
            continue
        sizes = np.array([len(text) for _, text in rows])
        ends = np.cumsum(sizes)
        yield np.frombuffer(b"".join(text for _, text in rows), np.uint8), ends - sizes, ends, docs, tags, sizes - ends


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, around, doc_id, place): `around` hashes all strings of the anchor, `place` packs
    the tag, the place of the anchor, the strings before it and their number."""
    for data, begins, ends, docs, tags, shift in parts(batches):
        hashes = Hashes(data)
        token, place, before, count, row = anchors(data, hashes, begins, ends)
        around = mix(hashes.of(place - before, count + LENGTH - 1) + before.astype(np.uint64) * np.uint64(64) + count.astype(np.uint64))
        packed = (tags[row] << 48) | ((place + shift[row]) << 12) | (before << 6) | count
        yield pa.RecordBatch.from_arrays(
            [pa.array(token), pa.array(around.view(np.int64)), pa.array(docs[row]), pa.array(packed)],
            ["token", "around", "doc_id", "place"])


def common_extension(hashes: Hashes, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the strings at x and y, by binary search on hashes."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), LENGTH)
    for _ in range(LENGTH.bit_length()):
        middle = (low + high + 1) // 2
        same = hashes.of(x, middle) == hashes.of(y, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def not_after(data: np.ndarray, hashes: Hashes, x: np.ndarray, y: np.ndarray, strictly: np.ndarray) -> np.ndarray:
    """Whether the string at x comes before that at y, or also equals it where not `strictly`."""
    length = common_extension(hashes, x, y)
    equal = length >= LENGTH
    return np.where(equal, ~strictly, data[x + np.minimum(length, LENGTH - 1)] < data[y + np.minimum(length, LENGTH - 1)])


def sort_suffixes(data: np.ndarray, hashes: Hashes, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the strings at `at` by group, then by their bytes: a bottom-up mergesort.

    All merges of a round run together: an element's place is its own index plus its rank in the
    sibling run, found by binary search.
    """
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group)
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    size, local = np.repeat(sizes, sizes), np.arange(len(at)) - base
    run = 1
    while run < sizes.max(initial=0):
        sibling = (local // run) ^ 1
        low, high = np.minimum(sibling * run, size), np.minimum((sibling + 1) * run, size)
        begin, active = low.copy(), np.flatnonzero(low < high)
        second = sibling < local // run  # of equal strings, those of the first run come first
        while len(active):
            middle = (low[active] + high[active]) // 2
            other = at[order[base[active] + middle]]
            goes_on = not_after(data, hashes, other, at[order[active]], ~second[active])
            low[active] = np.where(goes_on, middle + 1, low[active])
            high[active] = np.where(goes_on, high[active], middle)
            active = active[low[active] < high[active]]
        rank = low - begin
        target = base + (local // (2 * run)) * 2 * run + local % run + rank
        merged = np.empty_like(order)
        merged[target] = order
        order, run = merged, run * 2
    return order


def repeated(data: np.ndarray, at: np.ndarray, group: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which of the strings also occur, in their group, in a document with a smaller id.

    A string whose hash is alone in its group equals no other, so only the rest is sorted.
    """
    hashes, out = Hashes(data), np.zeros(len(at), bool)
    whole = mix(hashes.of(at, LENGTH) + mix(group))
    order = np.argsort(whole)
    alike = whole[order[1:]] == whole[order[:-1]]
    several = np.sort(order[np.append(False, alike) | np.append(alike, False)])
    if len(several):
        out[several] = repeated_among(data, hashes, at[several], group[several], docs[several])
    return out


def repeated_among(data: np.ndarray, hashes: Hashes, at: np.ndarray, group: np.ndarray, docs: np.ndarray) -> np.ndarray:
    order = sort_suffixes(data, hashes, at, group)
    x, y = at[order[:-1]], at[order[1:]]
    same = group[order[:-1]] == group[order[1:]]
    same[same] = common_extension(hashes, x[same], y[same]) >= LENGTH
    pairs = np.flatnonzero(same)
    reach = np.arange(LENGTH)
    for start in range(0, len(pairs), 100_000):
        part = pairs[start : start + 100_000]
        if (data[x[part][:, None] + reach] != data[y[part][:, None] + reach]).any():
            strings = [(int(g), data[p : p + LENGTH].tobytes()) for g, p in zip(group, at)]
            order = np.array(sorted(range(len(at)), key=strings.__getitem__))
            same = np.array([strings[i] == strings[j] for i, j in zip(order, order[1:])], bool)
            break
    first = np.flatnonzero(np.append(True, ~same))
    owner = np.minimum.reduceat(docs[order], first)
    out = np.empty(len(at), bool)
    out[order] = docs[order] > np.repeat(owner, np.diff(np.append(first, len(order))))
    return out


def distances(level: int) -> list[tuple[int, int]]:
    """Ranges of the number of bytes before the anchor: two at first, then halves down to single ones."""
    out = [(0, LENGTH - GRAM)]
    for _ in range(level + 1):
        halves = [((lo, (lo + hi) // 2), ((lo + hi) // 2 + 1, hi)) if lo < hi else ((lo, hi),) for lo, hi in out]
        out = [one for pair in halves for one in pair]
    return out


EDGE = "key long, doc_id long, place long, skip long, bytes binary"
EDGE_NAMES = ["key", "doc_id", "place", "skip", "bytes"]


def split_edges(doc: np.ndarray, place: np.ndarray, skip: np.ndarray, texts: list[bytes], ranges: list[tuple[int, int]]) -> pa.RecordBatch:
    """One row for each edge and each range of distances that its strings have.

    An edge is the bytes of an anchor's strings without the first `skip`. The key hashes what all
    strings of a range share: the anchor, and as many bytes around it as the range allows.
    """
    sizes = np.array([len(text) for text in texts])
    offset = np.cumsum(sizes) - sizes
    hashes = Hashes(np.frombuffer(b"".join(texts), np.uint8))
    before = ((place >> 6) & 63) - skip
    lowest = before - (sizes - LENGTH)
    rows, keys, skips, cuts = [], [], [], []
    for lo, hi in ranges:
        top, bottom = np.minimum(before, hi), np.maximum(lowest, lo)
        row = np.flatnonzero(top >= bottom)
        start = before[row] - top[row]
        keys.append(mix(hashes.of((offset + before)[row] - lo, LENGTH - (hi - lo)) + np.uint64(lo)).view(np.int64))
        rows.append(row)
        skips.append(skip[row] + start)
        stop = start + top[row] - bottom[row] + LENGTH
        cuts += [texts[i][x:y] for i, x, y in zip(row.tolist(), start.tolist(), stop.tolist())]
    row = np.concatenate(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(keys)), pa.array(doc[row]), pa.array(place[row]), pa.array(np.concatenate(skips)), pa.array(cuts, pa.binary())],
        EDGE_NAMES)


def cut_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each edge of a document."""
    ranges = distances(0)
    for batch in slices(batches, "text", HELD):
        held: list[tuple] = []
        for doc, text, places in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"), batch.column("places")):
            for start in range(0, len(places), ROWS):
                place = places.values.slice(start, ROWS).to_numpy()
                begin = ((place >> 12) & ((1 << 36) - 1)) - ((place >> 6) & 63)
                stop = begin + (place & 63) + LENGTH - 1
                held.append((np.full(len(place), doc), place, [text[x:y] for x, y in zip(begin.tolist(), stop.tolist())]))
                if sum(len(one[1]) for one in held) >= ROWS:
                    yield from split_held(held, ranges)
                    held = []
        yield from split_held(held, ranges)


def split_held(held: list[tuple], ranges: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if held:
        place = np.concatenate([one[1] for one in held])
        yield split_edges(np.concatenate([one[0] for one in held]), place, np.zeros_like(place), [text for one in held for text in one[2]], ranges)


def halve_edges(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            doc, place, skip = (batch.column(name).to_numpy() for name in ("doc_id", "place", "skip"))
            yield split_edges(doc, place, skip, batch.column("bytes").to_pylist(), distances(level))


FLAG = "doc_id long, place long, a long, b long"


def sort_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed strings `a` to `b` of each edge, from rows that arrive sorted by key."""
    def settle(rows: pa.Table) -> pa.RecordBatch:
        key, doc, place, skip = (rows.column(c).to_numpy() for c in ("key", "doc_id", "place", "skip"))
        packed = rows.column("bytes").combine_chunks()
        if isinstance(packed, pa.ChunkedArray):
            packed = packed.chunk(0)
        bounds = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1].astype(np.int64)
        data = np.frombuffer(packed.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        offset, count = bounds[:-1] - bounds[0], np.diff(bounds) - LENGTH + 1
        row = np.repeat(np.arange(len(key)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        # equal strings have their anchor at the same distance
        code = np.cumsum(np.append(0, key[1:] != key[:-1]))
        group = code[row] * 64 + (((place >> 6) & 63) - skip)[row] - nth
        flag = repeated(data, offset[row] + nth, np.unique(group, return_inverse=True)[1], doc[row])
        opens = flag & np.append(True, (row[1:] != row[:-1]) | ~flag[:-1])
        closes = flag & np.append((row[1:] != row[:-1]) | ~flag[1:], True)
        a, b = np.flatnonzero(opens), np.flatnonzero(closes)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[row[a]]), pa.array(place[row[a]]), pa.array(skip[row[a]] + nth[a]), pa.array(skip[row[b]] + nth[b])],
            ["doc_id", "place", "a", "b"])

    def several(rows: pa.Table) -> pa.Table:
        """Rows whose key others have, too: the only ones that can hold equal strings."""
        key = rows.column("key").to_numpy()
        alike = key[1:] == key[:-1]
        return rows.filter(pa.array(np.append(False, alike) | np.append(alike, False)))

    def settled(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = several(rows)
        if rows.num_rows:
            yield settle(rows.combine_chunks())

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < HELD or not batch.num_rows:
            continue
        rows = pa.Table.from_batches(held)
        key = rows.column("key").to_numpy()
        cut = int(np.flatnonzero(np.append(True, key[1:] != key[:-1]))[-1])  # the last key may go on
        if cut:
            yield from settled(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
            size = sum(one.nbytes for one in held)
    if held:
        yield from settled(pa.Table.from_batches(held))


def sort_keys(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(sort_edges, FLAG)


def settle_edges(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Removed strings of all edges (`EDGE`): keys of up to `BLOCK` rows are sorted, others are split first."""
    out, level, name = None, 0, "cut"
    while True:
        crowded = scratch.write(rows.groupBy("key").count().where(F.col("count") > BLOCK).select("key"), f"crowded-{level}")
        few = crowded.isEmpty()
        some = scratch.write(sort_keys(rows if few else rows.join(crowded, "key", "left_anti")), f"sorted-{level}")
        out = some if out is None else out.union(some)
        if few:
            scratch.drop(name, f"crowded-{level}")
            return out
        full = rows.join(crowded, "key", "left_semi").withColumn(
            "distance", F.shiftright("place", 6).bitwiseAND(F.lit(63)) - F.col("skip"))
        full = scratch.write(full, f"full-{level}")
        scratch.drop(name, f"crowded-{level}")
        owners = scratch.write(full.groupBy("bytes", "distance").agg(F.min("doc_id").alias("owner")), f"owners-{level}")
        full = full.join(owners, ["bytes", "distance"])
        alike = full.where("doc_id > owner").select(
            "doc_id", "place", F.col("skip").alias("a"), (F.col("skip") + F.length("bytes") - LENGTH).alias("b"))
        out = out.union(scratch.write(alike, f"alike-{level}"))
        if all(lo == hi for lo, hi in distances(level)):  # a key is a whole string now
            scratch.drop(f"full-{level}", f"owners-{level}")
            return out
        level += 1
        left, ranges = full.where("doc_id = owner").select(*EDGE_NAMES), level
        rows = scratch.write(left.mapInArrow(lambda batches, at=ranges: halve_edges(batches, at), EDGE), f"halves-{level}")
        scratch.drop(f"full-{level - 1}", f"owners-{level - 1}")
        name = f"halves-{level}"


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that the ranges cover, in order; ranges that touch are one run."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    first = np.append(True, begin[1:] > reach[:-1])
    return begin[first], reach[np.append(np.flatnonzero(first)[1:] - 1, len(begin) - 1)]


def cut_out(batches: Iterator[pa.RecordBatch], text: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text, HELD):
        texts = texts_of(batch, text)
        sizes = np.array([len(data) for data in texts])
        offset = np.cumsum(sizes + 1) - sizes - 1  # one byte apart, so that runs end with their text
        ranges = batch.column("_ranges")
        row = pa.compute.list_parent_indices(ranges).to_numpy()
        begin, end = (pa.compute.struct_field(ranges.flatten(), name).to_numpy() for name in ("begin", "end"))
        kept, spans = list(texts), np.zeros(len(texts), np.int64)
        if len(row):
            begin, end = merged(begin + offset[row], end + offset[row])
            row = np.searchsorted(offset, begin, side="right") - 1
            spans = np.bincount(row, minlength=len(texts))
            first = np.cumsum(spans) - spans
            for i in np.flatnonzero(spans).tolist():
                runs = slice(first[i], first[i] + spans[i])
                opens, closes = (begin[runs] - offset[i]).tolist(), (end[runs] - offset[i]).tolist()
                kept[i] = b"".join(texts[i][x:y] for x, y in zip([0, *closes], [*opens, len(texts[i])]))
        left = np.array([len(data) for data in kept])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in names), pa.array(sizes), pa.array(sizes - left), pa.array(spans), pa.array(kept, pa.binary())],
            [*names, "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The rows of `docs` (doc_id, text, ...) with n_bytes, n_removed, n_spans and the bytes `kept`."""
    spark = docs.sparkSession
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept", "_ranges")
    scratch = Scratch(spark, "suffix-dedup")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = plain.mapInArrow(find_anchors, "token long, around long, doc_id long, place long")
    # Sides that are hashed hold each key once: a hot key is one row there, and rows of the other side need no sort.
    with settings(spark):
        shared = scratch.write(
            found.groupBy("token").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
            .where("low <> high").select("token"), "shared")
        hits = scratch.write(found.join(shared.hint("shuffle_hash"), "token"), "hits")
        around = scratch.write(hits.groupBy("token", "around").agg(F.min("doc_id").alias("owner")), "around")
        kinds = scratch.write(around.groupBy("token").count().where("count > 1").select("token"), "kinds")
        owned = scratch.write(hits.join(around.hint("shuffle_hash"), ["token", "around"]), "owned")
        scratch.drop("shared", "hits", "around")
        count = F.col("place").bitwiseAND(F.lit(63))
        everything = ["doc_id", "place", F.lit(0).cast("long").alias("a"), (count - 1).alias("b")]
        inside = scratch.write(owned.where("doc_id > owner").select(*everything), "inside")
        edges = scratch.write(owned.where("doc_id = owner").join(kinds.hint("shuffle_hash"), "token", "left_semi").select(
            "token", "around", "doc_id", "place"), "edges")
        scratch.drop("owned", "kinds")
        # one occurrence of a surrounding stands for the others of its document
        firsts = scratch.write(edges.groupBy("token", "around").agg(
            F.min("doc_id").alias("doc_id"), F.min("place").alias("first"), F.count("*").alias("n")), "firsts")
        twins = edges.join(firsts.where("n > 1").select("token", "around", "first"), ["token", "around"]).where("place <> first")
        twins = scratch.write(twins.select("doc_id", F.col("place").alias("twin"), F.col("first").alias("place")), "twins")
        wanted = firsts.groupBy("doc_id", F.shiftright("first", 48).alias("tag")).agg(F.collect_list("first").alias("places"))
        tagged = plain.withColumn("tag", F.crc32(F.col("text").cast("binary")).bitwiseAND(F.lit(TAG).cast("long")))
        cut = scratch.write(tagged.join(wanted, ["doc_id", "tag"]).select("doc_id", "text", "places").mapInArrow(cut_edges, EDGE), "cut")
        scratch.drop("edges", "firsts")
        found_again = settle_edges(cut, scratch)
        shared_flags = found_again.join(twins, ["doc_id", "place"]).select("doc_id", F.col("twin").alias("place"), "a", "b")
        begin = F.shiftright("place", 12).bitwiseAND(F.lit((1 << 36) - 1)) - F.shiftright("place", 6).bitwiseAND(F.lit(63))
        gone = inside.union(found_again).union(shared_flags).select(
            "doc_id", F.shiftright("place", 48).alias("tag"), (begin + F.col("a")).alias("begin"), (begin + F.col("b") + LENGTH).alias("end"))
        gone = gone.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("begin", "end")).alias("_ranges"))
        gone = scratch.write(gone, "gone")
        scratch.clear("gone")
        names = docs.columns
        whole = docs.withColumn("_tag", F.crc32(F.col("text").cast("binary")).bitwiseAND(F.lit(TAG).cast("long")))
        joined = whole.join(gone.toDF("_id", "_tag2", "_ranges"),
                            (F.col("doc_id") == F.col("_id")) & (F.col("_tag") == F.col("_tag2")), "left")
        schema = docs.select("*", *(F.lit(0).cast("long").alias(n) for n in ("n_bytes", "n_removed", "n_spans")),
                             F.lit(None).cast("binary").alias("kept")).schema
        result = joined.select(*names, "_ranges").mapInArrow(lambda batches: cut_out(batches, "text", names), schema)
        result = scratch.write(result, "result")
        scratch.drop("gone")
    return result


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows of `docs` with the kept text; bytes of a character that a removal cut are left out.

    `n_chars` becomes the length of that text. A text that is wholly repeated becomes empty.
    """
    names = docs.columns

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "kept"):
            texts = [kept.decode(errors="ignore") for kept in batch.column("kept").to_pylist()]
            columns = {name: batch.column(name) for name in names}
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return remove_repeats(docs).mapInArrow(decode, docs.schema)


ship_by_value(__name__)
