"""Spelling variants by a relational trie frontier (operator 13).

Words of the corpus are spelled into a trie that is a distributed table of edges. A state (word,
rest of the word, node, edits) joins the edges below its node, level by level: without an edit it
follows the edge that spells the word, and every other edge that spells it with one character
inserted or replaced by a later one makes a state with one edit; with one edit only the spelling edge
goes on. States with one edit that end with the word at a node where a word ends are neighbours; the
pair is verified. A state is kept only where the next letter of its word follows at the node.

Deletions are insertions seen from the other word, and of two words that differ by a replacement one
has the smaller letter: each pair is found from one of its words, and holds both ways. The edit is
made where the word and the path first differ, so equal letters side by side give no state twice.

Two things keep the frontier small, and lose no pair. One edit lies in the first or in the second
half of a word, so each word starts halfway down a trie of the words and halfway down a trie of the
reversed words, where few edges branch off. And chains of nodes without a branch are one edge with a
longer label, so the number of levels follows the branching, not the longest word. Nodes are known
by two 64-bit hashes of their prefix.

A word's form is its most frequent neighbour, if that is `RATIO` times as frequent; the root is
reached by following forms.

Defined cases: a null text has no words; a null id counts as an empty one in the hash that decides
deletions; equal rows count as often as they occur; ties between neighbours go to the smaller word
in code point order; an empty table gives an empty result; other columns are ignored. Long texts are
read match by match. A word of any length is one row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from heatherd.llm.common import Scratch, mix, settings, slices, texts_of
from heatherd.session import ship_by_value

LENGTH = 7  # code points of a word, at least
COUNT = 2  # occurrences of a word, at least
RATIO = 10
DAMAGE = 31  # one distinct run in so many of a document loses a character
LONG = 1 << 20  # characters; the runs of a longer text are not listed at once
HELD = 200_000  # words a task counts before it passes them on
WORDS = 5_000  # words spelled out at a time
SEEDS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)
LETTERS = {"plain": (0x61, 0x7A), "accented": (0xC0, 0xFF)}  # code points of words, at most 64 each
JOINS = {"spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold": "32MB"}  # hash partitions that are measured to be small


def damaged(run: str, mark: int) -> str:
    if mark % DAMAGE:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def count_words(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of the texts of a task; a word can come several times."""
    runs_of = re.compile(rf"[a-z\xc0-\xff]{{{length},}}")
    held: dict[str, int] = {}

    def passed_on() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in slices(batches, "text"):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
            text = text.lower().decode()  # of bytes: A-Z only
            runs = runs_of.findall(text) if len(text) <= LONG else map(re.Match.group, runs_of.finditer(text))
            begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter(runs).items():
                mark = zlib.crc32(run.encode(), begun)
                word = run if mark % DAMAGE else damaged(run, mark)
                if len(word) >= length:
                    held[word] = held.get(word, 0) + n
            if len(held) >= HELD:
                yield passed_on()
    yield passed_on()


def corpus_words(docs: DataFrame, length: int = LENGTH, count: int = COUNT) -> DataFrame:
    """(word, n) over all texts of `docs` (doc_id, text)."""
    rows = docs.select("doc_id", "text").mapInArrow(lambda batches: count_words(batches, length), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def start_of(length, backward: bool):
    """Depth at which a word of this length enters a trie: its half, the middle counted once."""
    return length - length // 2 if backward else length // 2


SPELLED = "k1 long, k2 long, backward boolean, depth int, next int, rest int, enters boolean, id long"


def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each word (id, word) in both tries, from where a word one shorter would enter.

    `next` is the code point that follows, -1 where the word ends, `rest` what is left of the word. Hashes of
    prefixes are running exclusive ors over a random value for each code point and place.
    """
    for whole in batches:
        for begin in range(0, whole.num_rows, WORDS):
            batch = whole.slice(begin, WORDS)
            words, ids = batch.column("word").to_pylist(), batch.column("id").to_numpy()
            for backward in (False, True):
                spelled = [word[::-1] for word in words] if backward else words
                sizes = np.array([len(word) for word in words], np.int64)
                codes = np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4").astype(np.int64)
                starts = np.cumsum(sizes) - sizes
                place = np.arange(len(codes)) - np.repeat(starts, sizes)
                keys = []
                for seed in SEEDS:
                    value = mix(codes.astype(np.uint64) + mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(backward) + np.uint64(seed)))
                    keys.append(np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(value)]))
                lowest = start_of(sizes - 1, backward)
                count = sizes - lowest + 1
                word = np.repeat(np.arange(len(words)), count)
                depth = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + lowest[word]
                at = starts[word] + depth
                follow = np.where(depth < sizes[word], np.append(codes, -1)[at], -1)
                node = [(key[at] ^ key[starts[word]]).view(np.int64) for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[0]), pa.array(node[1]), pa.array(np.full(len(word), backward)), pa.array(depth, pa.int32()),
                     pa.array(follow, pa.int32()), pa.array(sizes[word] - depth, pa.int32()), pa.array(depth == start_of(sizes, backward)[word]),
                     pa.array(ids[word])],
                    ["k1", "k2", "backward", "depth", "next", "rest", "enters", "id"])


def directed(word: Column, backward: Column) -> Column:
    return F.when(backward, F.reverse(word)).otherwise(word)


def trie_nodes(spelled: DataFrame) -> DataFrame:
    """Nodes of both tries: where a prefix branches, a word ends or a word enters.

    With each goes what its words can be followed by: their next letters, as bits, and the least and
    most that is left of them; `ended` is the word that ends there.
    """
    return spelled.groupBy("k1", "k2").agg(
        (F.min("next") < F.max("next")).alias("branches"), F.max("enters").alias("enters"), F.max(F.when(F.col("next") < 0, F.col("id"))).alias("ended"),
        *[F.bit_or(F.expr(f"CASE WHEN next BETWEEN {a} AND {b} THEN shiftleft(1L, next - {a}) ELSE 0L END")).alias(name) for name, (a, b) in LETTERS.items()],
        F.min("rest").alias("least"), F.max("rest").alias("most"),
    ).where("branches OR enters OR ended IS NOT NULL").drop("branches", "enters")


def edge_table(spelled: DataFrame, nodes: DataFrame, words: DataFrame) -> DataFrame:
    """Edges (k1, k2, label, c1, c2) of both tries with what is known of the child: see `trie_nodes`.

    All words through a child that hold its parent agree on it, so one of them spells the label.
    """
    known = ["ended", *LETTERS, "least", "most"]
    rows = spelled.select("k1", "k2", "id", "backward", "depth").join(nodes, ["k1", "k2"])
    rows = rows.withColumnsRenamed({"k1": "c1", "k2": "c2", "depth": "low"})
    path = Window.partitionBy("id", "backward").orderBy("low")  # the nodes of one word
    pairs = rows.select("*", *[F.lag(of).over(path).alias(name) for name, of in (("k1", "c1"), ("k2", "c2"), ("high", "low"))]).where("high IS NOT NULL")
    same = [F.min(c).alias(c) for c in ("id", "k1", "k2", "high", "low", *known)]
    edges = pairs.groupBy("c1", "c2", "backward").agg(*same).join(words.select("id", "word"), "id")
    label = F.substr(directed(F.col("word"), F.col("backward")), F.col("high") + 1, F.col("low") - F.col("high"))
    return edges.select("k1", "k2", label.alias("label"), "c1", "c2", *known)


def entering(spelled: DataFrame, words: DataFrame) -> DataFrame:
    """The first states of all words in both tries."""
    left = F.substr(directed(F.col("word"), F.col("backward")), F.col("depth") + 1)
    return spelled.where("enters").join(words.select("id", "word"), "id").select("id", left.alias("rest"), "k1", "k2", F.lit(0).alias("edits"))


def step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level down; with an edit only along the edge that spells the word.

    States that cannot go on are left out: the next letter of the word must follow at the child, and
    as much must be left of the word as of one below it, or one less before an edit.
    """
    size, spells = F.length("label"), F.startswith("rest", "label")
    near = (F.length("rest") - size).between(F.col("least") - 1, F.col("most"))
    met = states.select("id", "rest", F.col("k1").alias("s1"), F.col("k2").alias("s2"), "edits").join(
        edges, (F.col("s1") == F.col("k1")) & (F.col("s2") == F.col("k2")) & near & ((F.col("edits") == 0) | spells))
    ways = F.when(spells, F.array(size)).otherwise(F.array(size - 1, size))  # letters used of the word: one less than of the path, or as many
    moved = met.select("*", spells.alias("spells"), F.explode(ways).alias("used")).where(F.col("used") <= F.length("rest")).select(
        "*", F.substr("rest", F.col("used") + 1).alias("later"))
    moved = moved.select("*", F.length("later").alias("left"), F.ascii("later").alias("next"))
    follows = reduce(Column.__or__, [F.expr(f"next BETWEEN {a} AND {b} AND shiftright({name}, next - {a}) & 1 = 1") for name, (a, b) in LETTERS.items()])
    touched = F.col("left").between(F.col("least"), F.col("most")) & F.when(F.col("left") == 0, F.col("ended").isNotNull()).otherwise(follows)
    untouched = F.col("left").between(F.col("least") - 1, F.col("most")) & (F.col("most") > 0)
    piece = F.substr("rest", F.lit(1), F.col("used"))
    # of two texts whose lengths differ by at most one, a distance of one is one edit
    one_edit = ((F.col("used") < size) | (piece < F.col("label"))) & ((size == 1) | (F.levenshtein(piece, "label", 1) == 1))
    fresh = F.col("spells") & (F.col("edits") == 0)
    return moved.where(F.when(fresh, untouched).otherwise(touched & (F.col("spells") | one_edit))).select(
        "id", F.col("later").alias("rest"), F.col("c1").alias("k1"), F.col("c2").alias("k2"), "ended", F.when(fresh, 0).otherwise(1).alias("edits"), "left")


def neighbours(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, near, near_n): every ordered pair of `words` (id, word, n) that are one edit apart."""
    spelled = scratch.write(words.select("id", "word").mapInArrow(spell, SPELLED), "spelled")
    nodes = scratch.write(trie_nodes(spelled), "nodes")  # a job of its own leaves no shuffle files to the next one
    edges = scratch.write(edge_table(spelled, nodes, words), "edges")
    scratch.drop("nodes")
    states = scratch.write(entering(spelled, words), "states")
    scratch.drop("spelled")
    level, found = 0, []
    while not states.isEmpty():
        reached = scratch.write(step(states, edges), f"states-{level}")
        scratch.drop("states" if level == 0 else f"states-{level - 1}")
        ended = (F.col("edits") == 1) & (F.col("left") == 0)
        found.append(scratch.write(reached.where(ended).select("id", F.col("ended").alias("near")), f"found-{level}"))
        states, level = reached.where(~ended).select("id", "rest", "k1", "k2", "edits"), level + 1
    scratch.drop("states" if level == 0 else f"states-{level - 1}", "edges")
    pairs = reduce(DataFrame.union, found, words.select("id", F.col("id").alias("near")).limit(0)).distinct()
    named = words.select("id", "word", "n").join(pairs, "id").join(words.select(F.col("id").alias("near"), F.col("word").alias("other"), F.col("n").alias("near_n")), "near")
    both = F.array(F.struct("word", F.col("other").alias("near"), "near_n"), F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return named.where(F.levenshtein("word", "other", 1) == 1).select(F.inline(both))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of the rows of `forms` (word, form), by doubling; forms grow more frequent, so there is no cycle."""
    up, k = forms.select("word", F.col("form").alias("root")), 0
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = scratch.write(up.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{k}")
        if k:
            scratch.drop(f"roots-{k - 1}")
        up, k = joined.select("word", "root"), k + 1
        if joined.where("moved").isEmpty():
            return up


def variants(docs: DataFrame, length: int = LENGTH, count: int = COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of `docs` (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "spelling")
    with settings(docs.sparkSession, **JOINS):
        words = scratch.write(corpus_words(docs, length, count).withColumn("id", F.monotonically_increasing_id()), "words")
        pairs = neighbours(words, scratch)
        best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
        near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
        chosen = F.col("n_near").isNotNull() & (-F.col("best.minus") >= ratio * F.col("n"))
        judged = scratch.write(
            words.join(near, "word", "left").select(
                "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best.form")).alias("form"),
                F.when(chosen, -F.col("best.minus")).alias("form_n")), "judged")
        scratch.drop("words")
        top = roots(judged.where("form IS NOT NULL"), scratch)
    return judged.join(top, "word", "left").withColumn("root", F.coalesce("root", "word"))


ship_by_value(__name__)
