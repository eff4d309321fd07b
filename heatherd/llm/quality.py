"""Quality rules by repetition coverage (operator 8).

Rolling hashes of several n-gram lengths, computed in numpy, find the n-grams that occur at
least twice in a text; the characters of the words inside them, and those of repeated lines,
are measured against all characters of words. Rows with few words, many repeated words, a
coverage above the limit of its length, or many symbols for their words are rejected.

Defined cases: a null text counts as an empty one and is rejected (no words); a row with a null
id is measured like any other; rows are independent, so repeated rows give repeated results; an
empty table gives an empty result; other columns of the input pass through unless named like a
measure, in which case the measure replaces them. Texts of any length are measured whole, a long
one in a step of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from heatherd.llm.common import Memo, mix, settings, slices, texts_of
from heatherd.session import ship_by_value

SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_chars long, dup_gram_chars array<long>, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict; the shares are whole percent of a text's words or word characters."""

    min_words: int = 20
    repeat_window: int = 8
    repeat_percent: int = 30
    line_percent: int = 30
    symbol_percent: int = 30  # symbols for each hundred words
    # n-gram length -> largest share of characters inside n-grams that occur twice or more
    gram_percent: dict[int, int] = field(default_factory=lambda: {3: 50, 4: 40, 5: 35, 6: 34, 7: 33, 8: 32, 9: 31, 10: 30})


def repeated_windows(words: np.ndarray, doc: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each length, ascending: starts of the windows that occur twice or more in their text.

    `words` are word hashes of several texts in a row, `doc` the text of each word. A window that
    occurs twice starts with a shorter window that does, so only those are looked at again.
    """
    base, size = np.uint64(0x9E3779B97F4A7C15), len(words)
    rolling, have = words.copy(), 1
    starts = np.arange(size)
    for length in lengths:
        for step in range(have, length):
            rolling[: size - step] = rolling[: size - step] * base + words[step:]
        have = length
        starts = starts[starts + length <= size]
        starts = starts[doc[starts] == doc[starts + length - 1]]
        key = mix(rolling[starts] + mix(doc[starts]))
        order = np.argsort(key, kind="stable")
        key, placed = key[order], starts[order]
        same = key[1:] == key[:-1]
        left, right = placed[:-1][same], placed[1:][same]
        equal = doc[left] == doc[right]
        for step in range(length):
            equal &= words[left + step] == words[right + step]
        if equal.all():
            twice = np.zeros(len(placed), bool)
            twice[1:] |= same
            twice[:-1] |= same
            starts = np.sort(placed[twice])
        else:  # two different windows with one hash: group by the windows themselves
            rows = np.stack([doc[starts].astype(np.uint64), *(words[starts + step] for step in range(length))], axis=1)
            _, group, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
            starts = starts[count[group.ravel()] > 1]
        yield length, starts


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of `size` words lie in a window of `length` words at one of `starts`."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0


def line_repeats(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters of the words in them."""
    seen, lines, chars = set(), 0, 0
    for line in text.split(b"\n"):
        if line in seen:
            lines += 1
            chars += sum(len(word.decode()) for word in line.split())
        elif line.strip():
            seen.add(line)
    return lines, chars


def measure(texts: list[bytes], hashes: Memo, lengths: Memo, rules: Rules) -> dict[str, np.ndarray | list]:
    split = [text.split() for text in texts]
    counts = np.array([len(words) for words in split], np.int64)
    total, n = int(counts.sum()), len(texts)
    flat = [word for words in split for word in words]
    words = np.fromiter(map(hashes.__getitem__, flat), np.uint64, total)
    chars = np.fromiter(map(lengths.__getitem__, flat), np.int64, total)
    doc = np.repeat(np.arange(n), counts)
    per_doc = lambda weights: np.bincount(doc, weights, n).astype(np.int64)
    repeat_words = np.zeros(n, np.int64)
    grams = []
    for length, starts in repeated_windows(words, doc, sorted({rules.repeat_window, *rules.gram_percent})):
        inside = covered(starts, length, total)
        if length == rules.repeat_window:
            repeat_words = per_doc(inside)
        if length in rules.gram_percent:
            grams.append(per_doc(chars * inside))
    word_chars = per_doc(chars)
    repeats = [line_repeats(text) for text in texts]
    line_chars = np.array([r[1] for r in repeats], np.int64)
    failed = (counts < rules.min_words) | (100 * repeat_words > rules.repeat_percent * counts)
    symbols = np.array([len(text) - len(text.translate(None, SYMBOLS)) for text in texts], np.int64)
    kept = ~failed & (100 * line_chars <= rules.line_percent * word_chars) & (100 * symbols <= rules.symbol_percent * counts)
    for gram, (_, percent) in zip(grams, sorted(rules.gram_percent.items())):
        kept &= 100 * gram <= percent * word_chars
    return {
        "n_words": counts, "word_chars": word_chars,
        "n_symbols": symbols,
        "n_dup_lines": np.array([r[0] for r in repeats], np.int64), "n_repeat_words": repeat_words,
        "dup_line_chars": line_chars, "dup_gram_chars": list(np.stack(grams, axis=1)) if grams else [[]] * n,
        "base_failed": failed, "kept": kept,
    }


def quality_rules(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Adds the measures and the verdict to every row, in one pass without a shuffle."""
    names = [part.split()[0] for part in MEASURES.split(", ")]
    df = df.drop(*(name for name in names if name != text))
    schema = df.select("*", *(F.lit(None).cast(p.split()[1]).alias(p.split()[0]) for p in MEASURES.split(", "))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, lengths = Memo(xxhash.xxh3_64_intdigest), Memo(lambda word: len(word.decode()))
        for batch in slices(batches, text):
            found = measure(texts_of(batch, text), hashes, lengths, rules)
            arrays = [pa.array(found[name], pa.list_(pa.int64()) if name == "dup_gram_chars" else None) for name in names]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])

    with settings(df.sparkSession):
        return df.mapInArrow(run, schema)


def keep_good(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows that pass, with the columns of the input."""
    return quality_rules(df, text, rules).where("kept").select(*df.columns)


ship_by_value(__name__)
