"""Quality rules, n-gram join, suffix dedup, mixing and the operators' defined cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from heatherd.llm import mixing, ngram_join, quality, suffix_dedup
from heatherd.llm.components import components
from heatherd.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Quality rules


def plain_quality(text, rules=quality.Rules()):
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))

    def inside(n):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        hit = set()
        for i in range(len(words) - n + 1):
            if grams[tuple(words[i : i + n])] > 1:
                hit.update(range(i, i + n))
        return hit

    seen, lines, line_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                lines += 1
                line_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    repeat = len(inside(8))
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * repeat > 30 * len(words)
    grams = [sum(len(words[i]) for i in inside(n)) for n in sorted(rules.gram_percent)]
    kept = (not failed and 100 * line_chars <= 30 * chars and 100 * symbols <= 30 * len(words)
            and all(100 * g <= p * chars for g, (_, p) in zip(grams, sorted(rules.gram_percent.items()))))
    return len(words), chars, symbols, lines, repeat, line_chars, grams, failed, kept


def test_quality_matches_plain_computation(docs, corpus):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", "dup_gram_chars", "base_failed", "kept"]
    got = quality.quality_rules(docs).select("doc_id", "text", *names).collect()
    assert len(got) == len(corpus)
    for row in got:
        assert tuple(row)[2:] == plain_quality(row.text), row.doc_id
    assert any(row.kept for row in got) and not all(row.kept for row in got)


def test_quality_keeps_columns_and_empty_tables(docs, no_docs):
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.quality_rules(no_docs).count() == 0


def test_colliding_window_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(quality, "mix", lambda values: values.astype(np.uint64) & np.uint64(1))
    words = np.array([1, 2, 3, 4, 1, 2, 3, 5, 9, 9], np.uint64)
    starts = dict(quality.repeated_windows(words, np.zeros(10, int), [2, 3]))
    assert starts[2].tolist() == [0, 1, 4, 5] and starts[3].tolist() == [0, 4]


# N-gram Jaccard join


def shingles(text):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def groups_of(links, nodes):
    top = {n: n for n in nodes}

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        top[y] = x
    return {n: root(n) for n in nodes}


def plain_groups(rows):
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    links = [(a, b) for a, x in sets for b, y in sets if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    return groups_of(links, {doc for doc, _ in sets})


@pytest.mark.parametrize("small, block", [(256, 2_000), (0, 3)])
def test_ngram_join_matches_all_pairs(docs, corpus, monkeypatch, small, block):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    got = ngram_join.jaccard_groups(docs).collect()
    want = plain_groups(corpus)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((r[0], len(shingles(r[1]))) for r in corpus)
    assert all(r.component_id == (want[r.doc_id] if r.doc_id is not None else None) for r in got)
    assert len(set(want.values())) < len(want)


def test_ngram_join_keeps_one_row_of_each_group(docs, corpus):
    want = plain_groups(corpus)
    got = ngram_join.keep_first(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.where("doc_id is not null").collect()) == sorted(set(want.values()))
    assert got.where("doc_id is null").count() == 2


def test_ngram_join_of_nothing(no_docs):
    assert ngram_join.jaccard_groups(no_docs).count() == 0
    assert ngram_join.jaccard_groups(no_docs.unionByName(no_docs)).columns == ["doc_id", "n_shingles", "component_id"]


def test_counters_of_whole_runs(monkeypatch):
    texts = ["a b c d e f g a b c d e", "", None, "a b c d e", "x", "A B  c\nd e f"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    slots = Counter()
    for text in texts:
        words = (text or "").lower().split()
        hashes = np.array([xxhash.xxh3_64_intdigest(word.encode()) for word in words], np.uint64)
        slots.update((ngram_join.shingle_set(hashes, 5) >> np.uint64(64 - ngram_join.SLOT_BITS)).tolist())
    for counted in (1, 7, 1 << 20):  # shingles that are counted at a time
        monkeypatch.setattr(ngram_join, "COUNTED", counted)
        last = list(ngram_join.describe(iter([batch]), 5))[-1]
        part, found = ngram_join.SLOTS // ngram_join.CHUNKS, {}
        for chunk, data in zip(last.column("chunk").to_pylist(), last.column("counters").to_pylist()):
            counts = ngram_join.unpacked(data, part)
            found |= {chunk * part + int(i): int(counts[i]) for i in np.flatnonzero(counts)}
        assert found == slots


def test_points_of_large_sets_prune_unrelated_ones():
    rng = np.random.default_rng(8)
    for size in (300, 513, 2_000, 5_000):
        base = np.unique(rng.integers(0, 1 << 63, 2 * size).astype(np.uint64))[: 2 * size]
        rng.shuffle(base)
        sets = [base[:size], base[size:], np.concatenate([base[: size - size // 12], base[-(size // 12):]])]
        packed = [ngram_join.point(np.sort(one)) for one in sets]
        sizes = np.array([len(one) for one in sets])
        assert np.array_equal(ngram_join.points(packed, sizes), [np.bincount((one & np.uint64(63)).astype(int), minlength=64) for one in sets])
        # with few coordinates two unrelated large sets seem to overlap
        few = ngram_join.possible(np.minimum(*ngram_join.points(packed[:2], sizes[:2])).sum(), 2 * size, 80)
        assert few == (size >= 2_000)
        kept = ngram_join.sharpened([packed[0]] * 2, sizes[[0, 0]], packed[1:], sizes[1:], 80)
        assert kept.tolist() == [size <= 512, True]  # below, the 64 coordinates decide alone
    # sets of different widths meet in the coordinates of the smaller one
    one = np.unique(rng.integers(0, 1 << 63, 1_100).astype(np.uint64))
    two = one[: len(one) * 9 // 10]
    assert ngram_join.groups_of(len(one)) == 256 and ngram_join.groups_of(len(two)) == 128
    sizes = np.array([len(one)]), np.array([len(two)])
    assert ngram_join.sharpened([ngram_join.point(one)], sizes[0], [ngram_join.point(two)], sizes[1], 80).all()


def test_count_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(5)
    centres = rng.poisson(3, (12, ngram_join.GROUPS))
    at = centres[rng.integers(0, 12, 300)] + rng.poisson(0.05, (300, ngram_join.GROUPS))
    sizes = at.sum(axis=1)
    query, found = ngram_join.CountTree(at, sizes).search(at, sizes, 80)
    overlap = np.minimum(at[:, None], at).sum(axis=2)
    near = (180 * overlap >= 80 * (sizes[:, None] + sizes)) & (100 * np.minimum(sizes[:, None], sizes) >= 80 * np.maximum(sizes[:, None], sizes))
    assert set(zip(query.tolist(), found.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(near))))
    assert len(query) < near.size / 3


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(5, 5), (1, 2), (2, 1), (1, 2)]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(5), Scratch(spark, "test"), "t")
    links = [(a, b) for a, b in links if a != b]
    want = groups_of(links, {n for link in links for n in link})
    assert {r.node: r.component for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test"), "t").count() == 0


# Suffix dedup


def plain_removal(rows, length=suffix_dedup.LENGTH):
    owner = {}
    for doc, text, *_ in rows:
        data = (text or "").encode()
        if doc is not None:
            for i in range(len(data) - length + 1):
                owner[data[i : i + length]] = min(doc, owner.get(data[i : i + length], doc))
    out = []
    for doc, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        if doc is not None:
            for i in range(len(data) - length + 1):
                if owner[data[i : i + length]] < doc:
                    gone[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc, len(data), sum(gone), spans, bytes(d for d, g in zip(data, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("block, part", [(2_048, 1 << 20), (1, 300)])
def test_suffix_dedup_matches_all_strings(docs, corpus, monkeypatch, block, part):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    got = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    want = plain_removal(corpus)
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == want
    assert any(removed for _, _, removed, _, _ in want)


@pytest.mark.parametrize("block", [2_048, 3])
def test_suffix_dedup_of_hot_anchors(spark, monkeypatch, block):
    """A line ten thousand times in one document, and one passage in ever different surroundings."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = np.random.default_rng(7)
    noise = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    line, passage, half = noise(70), noise(60), noise(33)
    rows = [(1, noise(40) + line + noise(9)), (2, "\n".join([line[3:60]] * 10_000)), (3, line * 2), (3, passage + line[:52])]
    rows += [(10 + i, noise(30) + passage[i % 12 :] + noise(30) + half + noise(20)) for i in range(200)]
    rows += [(300 + i, noise(i % 7) + passage[:48] + "é" * (i % 3) + line[20:] + half) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == plain_removal(rows)


def test_suffix_dedup_keeps_columns(docs, no_docs):
    got = suffix_dedup.without_repeats(docs.drop("n_removed", "kept"))
    assert got.columns == docs.drop("n_removed", "kept").columns and got.count() == docs.count()
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_sort_orders_strings_and_survives_collisions(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3_000).astype(np.uint8)
    data[1_000:1_400] = data[200:600]
    at, group = np.arange(len(data) - suffix_dedup.LENGTH + 1), rng.integers(0, 2, len(data) - suffix_dedup.LENGTH + 1)
    hashes = suffix_dedup.Hashes(data)
    order = suffix_dedup.sort_suffixes(data, hashes, at, group)
    keys = [(int(group[i]), data[at[i] : at[i] + suffix_dedup.LENGTH].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(at)))
    docs = rng.integers(0, 50, len(at))
    owner = defaultdict(lambda: 99)
    for i, doc in enumerate(docs):
        key = (int(group[i]), data[at[i] : at[i] + suffix_dedup.LENGTH].tobytes())
        owner[key] = min(owner[key], doc)
    want = [bool(docs[i] > owner[(int(group[i]), data[at[i] : at[i] + suffix_dedup.LENGTH].tobytes())]) for i in range(len(at))]
    assert suffix_dedup.repeated(data, at, group, docs).tolist() == want
    monkeypatch.setattr(suffix_dedup, "TABLE", np.ones(256, np.uint64))  # every string of a length collides
    assert suffix_dedup.repeated(data, at, group, docs).tolist() == want


# Mixing


def plain_targets(sizes, weights=mixing.WEIGHTS, most=mixing.MAX_REPEATS):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] >= most * sizes[s]}
        if not over:
            return target
        capped |= over
        if len(capped) == len(names):
            return {s: most * sizes[s] for s in names}


def test_mix_targets_and_copies(docs, corpus):
    sizes = Counter()
    for _, text, _, source, _ in corpus:
        sizes[source] += len(WORD.findall(text or ""))
    want = plain_targets(sizes)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(corpus)
    for row in got:
        assert row["size"] == len(WORD.findall(row.text or "")) and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(want[row.source])
        rate = row.target / row.source_size
        assert row.copies in (int(rate), int(rate) + 1) and row.copies <= 3
    assert Counter(map(str, got)) == Counter(map(str, mixing.mix_sources(docs.repartition(5)).collect()))


def test_mix_comes_near_its_targets(spark):
    df = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 5) * (F.col("id") % 3)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    taken = mixing.mix_sources(df).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target"))
    for row in taken.collect():
        assert row.taken == pytest.approx(row.target, rel=0.08), row.source


def test_emitted_copies(docs, no_docs):
    counts = {(r.doc_id, r.text): r.copies for r in mixing.mix_sources(docs.dropDuplicates()).collect()}
    got = Counter((r.doc_id, r.text) for r in mixing.emit_copies(docs.dropDuplicates()).collect())
    assert all(got[key] == copies for key, copies in counts.items())
    assert mixing.emit_copies(docs).columns == docs.columns
    assert mixing.mix_sources(no_docs).count() == 0
