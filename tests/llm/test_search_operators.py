"""The conversation trie, exact top-k search and spelling variants against plain computations."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from heatherd.llm import prefix_trie, spelling, topk
from heatherd.llm.common import Scratch

# Conversation prefix trie

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [t[2:] for t in sorted(turns)] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        rebuilt[conv] = own.get(conv - conv % 5, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = Counter(path[:-1] for path in members if path)
    saved, leaves = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    return Counter(
        (min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path], leaves[path], saved[path],
         hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
        for path, convs in members.items())


def found_trie(spark, rows):
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'clash' AS n_convs", "0 AS depth", "1 AS seq").repartition(5)
    found = prefix_trie.prefix_trie(df).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    return Counter(tuple(row) for row in found)


def conversations(seed, count):
    """Few different turns, so that prefixes are shared; copies, hot first turns, gaps, ties, long ones."""
    rng, rows = random.Random(seed), []
    for conv in range(count):
        kind = rng.random()
        if kind < 0.1:
            continue  # an absent conversation, sometimes the first of its family
        turns = [("user", "hello é")] if kind < 0.5 else []
        turns += [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "ü"])) for _ in range(rng.randint(0 if turns else 1, 5))]
        if kind > 0.8:
            turns = [("user", "hello é"), ("assistant", "copy"), ("user", "copy")]
        if conv == 17:
            turns = [("user", f"turn {i % 7}") for i in range(400)]
        rows += [(conv, None if i == 0 and conv % 11 == 0 else i, role, text) for i, (role, text) in enumerate(turns)]
    rows += [(None, 1, "user", "nobody"), (3, 1, "user", "same number"), (3, 1, "assistant", "same number"), (3, 1, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, parts", [(4_096, 4), (3, 4), (7, 13), (1, 3)])
def test_trie_matches_plain_prefixes(spark, monkeypatch, block, parts):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", block)
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 50 * block)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rows = conversations(block, 150)
        assert found_trie(spark, rows) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_trie_of_little(spark):
    assert found_trie(spark, []) == Counter()
    # with h = crc32("1") % 9 = 1 its own first turn goes, and the family has no first conversation
    for rows in ([(1, 0, "user", "x")], [(1, 0, "user", "x"), (6, 0, "user", "y")], [(5, 0, None, None)], [(-3, 0, "user", "x")]):
        if rows[0][0] >= 0:
            assert found_trie(spark, rows) == plain_trie(rows)
        else:
            assert sum(found_trie(spark, rows).values()) >= 1


def test_extents_match_a_scan():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 8, 17, 100):
        lcp = rng.integers(0, 4, n)
        row, depth = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
        left, right = prefix_trie.extents(prefix_trie.sparse_table(lcp), row, depth)
        for i, d, low, high in zip(row, depth, left, right):
            want_low, want_high = i, i
            while want_low > 0 and lcp[want_low] >= d:
                want_low -= 1
            while want_high + 1 < n and lcp[want_high + 1] >= d:
                want_high += 1
            assert (low, high) == (want_low, want_high)


# Exact top-k


def plain_top(rows, k, every):
    def whole(vector):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            return None
        return [max(-(2**62), min(2**62, math.floor(256 * x))) for x in vector]

    usable = [(i, vec_id, v) for i, (vec_id, vector) in enumerate(rows) if (v := whole(vector)) is not None]
    out = Counter()
    for i, query, q in usable:
        if query is None or math.fmod(query, every):
            continue
        scored = [(-max(-(2**62), min(2**62, sum(a * b for a, b in zip(q, v)))), vec_id is None, vec_id) for j, vec_id, v in usable if j != i and len(v) == len(q)]
        out.update((query, rank, vec_id, -minus) for rank, (minus, _, vec_id) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1))
    return out


def found_top(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'clash' AS score", "1 AS rank", "2 AS key").repartition(3)
    return Counter(tuple(r) for r in topk.top_k(df, **options).select("query_id", "rank", "vec_id", "score").collect())


def vectors(seed, n, dim=6):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), rng.randint(-2, 2) / 4]) for _ in range(dim)]) for i in range(n)]
    rows += [(1_000 + i, rows[3][1]) for i in range(60)]  # a common vector, also asked for
    rows += [(2_000 + i, [0.0] * dim) for i in range(30)]  # all scores are tied
    rows += [(3_000, [1.0, None] + [0.0] * (dim - 2)), (3_010, None), (3_020, [math.nan] * dim), (3_030, [math.inf] * dim)]
    rows += [(3_040, [0.5] * 3), (3_041, [0.25] * 3), (3_050, [7.0]), (3_060, []), (3_061, []), (None, rows[3][1]), (None, [3.0] * dim)]
    rows += [(10, rows[10][1]), (10, rows[11][1]), (20, rows[20][1])]  # equal rows, and another vector under the same id
    return rows


@pytest.mark.parametrize("block_bytes, bits, k", [(2 << 20, 10, 5), (400, 2, 3), (48, 4, 1)])
def test_top_k_matches_all_scores(spark, monkeypatch, block_bytes, bits, k):
    monkeypatch.setattr(topk, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(topk, "BIN_BITS", bits)
    monkeypatch.setattr(topk, "STEP", 100)
    rows = vectors(k, 40 if block_bytes < 1_000 else 300)
    assert found_top(spark, rows, k=k, every=10) == plain_top(rows, k, 10)


def test_top_k_of_extremes(spark):
    rows = [(0, [1e300, -1e300]), (50, [1e12, 3.7]), (51, [-1e12, 1e9]), (52, [1e-300, -1e-300]), (53, [2.0**40, 2.0**41]), (100, [0.1, 0.2])]
    assert found_top(spark, rows) == plain_top(rows, 5, 50)
    assert found_top(spark, [(0, [1.0])]) == found_top(spark, [(1, [1.0]), (2, [1.0])]) == found_top(spark, []) == Counter()


# Spelling variants

DOCS = "doc_id long, text string"


def plain_words(rows, length, count):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % 31 == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            if len(run) >= length:
                total[run] += 1
    return {word: n for word, n in total.items() if n >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    return any(a == b[:i] + b[i + 1 :] or (len(a) == len(b) and a[:i] + a[i + 1 :] == b[:i] + b[i + 1 :]) for i in range(len(b)))


def plain_variants(rows, length=7, count=2, ratio=10):
    words = plain_words(rows, length, count)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[word] = best if best is not None and words[best] >= ratio * words[word] else None
    out = Counter()
    for word in words:
        root = word
        while form[root] is not None:
            root = form[root]
        out[(word, form[word], root, words[word], len(near[word]), words[form[word]] if form[word] else None)] += 1
    return out


def found_variants(spark, rows, **options):
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'clash' AS word", "1 AS n", "2 AS label").repartition(3)
    return Counter(tuple(r) for r in spelling.variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n").collect())


def spelled_corpus(seed):
    """Words with one and two edits at every place, repeated letters, words inside words, counts far apart."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "abababab", "straßen×÷ÿ", "Àlphabetic", "x" * 300]
    words = []
    for word in base:
        words += [word] * rng.choice([1, 2, 3, 25, 400])
        for _ in range(4):
            i, c = rng.randint(0, len(word)), rng.choice("abz")
            words += [rng.choice([word[:i] + c + word[i:], word[:i] + c + word[i + 1 :], word[:i] + word[i + 1 :]])] * rng.choice([1, 2, 3, 30])
    rng.shuffle(words)
    rows = [(i, rng.choice([" ", "\n", "1", "_", "× "]).join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    return rows + [(None, words[0] + " " + words[1]), (None, None), (7, ""), (8, None), rows[0], (5, "UPPERCASE uppercase UpperCase"), (9, "日本語テキスト" * 3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_match_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(spelling, "WORDS", 17)
    monkeypatch.setattr(spelling, "HELD", 50)
    monkeypatch.setattr(spelling, "LONG", 500)
    rows = spelled_corpus(seed)
    assert found_variants(spark, rows) == plain_variants(rows)


def test_forms_are_followed_to_the_last(spark):
    words = {"chainsaw": 2, "chainsaws": 20, "chainsawss": 200, "chainsawsss": 2_000, "lonesome": 5}
    rows = [(i, " ".join([word] * n)) for i, (word, n) in enumerate(words.items())]
    found = found_variants(spark, rows, length=6)
    assert found == plain_variants(rows, length=6)
    assert {row[0]: row[2] for row in found if row[0] == "chainsaw"} == {"chainsaw": "chainsawsss"}
    assert found_variants(spark, []) == Counter() == found_variants(spark, [(1, "short words"), (2, None)])


def test_neighbours_of_dense_words(spark):
    """All words of a small alphabet: every place branches."""
    import itertools

    words = ["".join(w) for n in (3, 4, 5) for w in itertools.product("ab", repeat=n)] + ["abc", "abcc", "c" * 60, "c" * 61]
    df = spark.createDataFrame([(i, w, 2) for i, w in enumerate(words)], "id long, word string, n long")
    got = spelling.neighbours(df, Scratch(spark, "test")).select("word", "near").collect()
    assert Counter(map(tuple, got)) == Counter((a, b) for a in words for b in words if one_edit(a, b))


def test_frontier_plan_has_no_cross_join(spark):
    words = spark.createDataFrame([(1, "spelling", 3), (2, "speling", 2)], "id long, word string, n long")
    spelled = words.mapInArrow(spelling.spell, spelling.SPELLED)
    reached = spelling.step(spelling.entering(spelled, words), spelling.edge_table(spelled, spelling.trie_nodes(spelled), words))
    plan = reached._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_pair_is_searched_from_one_of_its_words(spark):
    class Watched(Scratch):
        found = []

        def write(self, df, table):
            out = super().write(df, table)
            self.found += [tuple(r) for r in out.collect()] if table.startswith("found") else []
            return out

    words = ["spelling", "speling", "spellling", "spelping", "spellinß", "aaaaaaa", "aaaaaaaa", "aaaaaaab", "baaaaaa", "lonesome"]
    df = spark.createDataFrame([(i, w, i + 2) for i, w in enumerate(words)], "id long, word string, n long")
    got = spelling.neighbours(df, Watched(spark, "test")).collect()
    assert Counter(tuple(r) for r in got) == Counter((a, b, j + 2) for a in words for j, b in enumerate(words) if one_edit(a, b))
    pairs = {(words[a], words[b]) for a, b in Watched.found}
    assert ("speling", "spelling") in pairs and ("spelling", "spellinß") in pairs
    assert not pairs & {(b, a) for a, b in pairs}


def test_first_states_are_not_kept_beside_the_nodes(spark):
    class Watched(Scratch):
        held, seen = set(), []

        def write(self, df, table):
            self.held.add(table)
            self.seen.append(set(self.held))
            return super().write(df, table)

        def drop(self, *tables):
            self.held -= set(tables)
            super().drop(*tables)

    words = spark.createDataFrame([(1, "spelling", 3), (2, "speling", 2)], "id long, word string, n long")
    got = spelling.neighbours(words, Watched(spark, "test")).collect()
    assert Counter(tuple(r) for r in got) == Counter([("spelling", "speling", 2), ("speling", "spelling", 3)])
    assert not any({"states", "nodes"} <= held for held in Watched.seen)
