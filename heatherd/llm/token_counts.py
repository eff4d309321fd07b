"""Greedy word-piece counts by a linear longest-match automaton (operator 9).

A word with the space before it is cut greedily: the longest piece of the vocabulary that fits
comes first, then the longest that fits the rest. The automaton is the trie of the vocabulary;
each node has a failure link, the node for what is left once the longest pieces of its string are
taken off, and the number of pieces taken off. Reading a word is then linear in its bytes, and the
count comes without building a piece. Every single byte is a piece, so no word fails.

Defined cases: a null text has no words and no pieces; words are those of ASCII white space
splitting; a row with a null id is counted like any other; equal rows have equal counts; an empty
table gives an empty result; columns of the input pass through, but those named like a result are
replaced. Long words and texts are read whole.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heatherd.llm.common import Memo, slices, texts_of
from heatherd.session import ship_by_value

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_vocabulary(path: str) -> set[bytes]:
    """Pieces of a rank file; those with white space other than one leading space cannot occur."""
    with open(path, "rb") as lines:
        pieces = {base64.b64decode(line.split()[0]) for line in lines if line.strip()}
    return {piece for piece in pieces if len((piece[1:] if piece[:1] == b" " else piece).split()) == 1
            and not set(piece[1:]) & set(b" \t\n\r\x0b\x0c") or len(piece) == 1}


class LongestMatch:
    """`count(word)` is the number of greedy longest pieces of a byte string."""

    def __init__(self, pieces: set[bytes]):
        missing = [value for value in range(256) if bytes([value]) not in pieces]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        step: dict[int, int] = {}  # node * 256 + byte -> node; the root is 0
        depth_first: list[tuple[int, int]] = [(0, 0)]  # parent and byte of each node
        ends = [False]
        for piece in sorted(pieces):
            node = 0
            for value in piece:
                child = step.get(node << 8 | value)
                if child is None:
                    child = step[node << 8 | value] = len(ends)
                    ends.append(False)
                    depth_first.append((node, value))
                node = child
            ends[node] = True
        children: list[list[int]] = [[] for _ in ends]
        for node, (parent, _) in enumerate(depth_first[1:], 1):
            children[parent].append(node)
        fail, popped, queue = [0] * len(ends), [0] * len(ends), deque(children[0])
        while queue:
            node = queue.popleft()
            queue.extend(children[node])
            parent, value = depth_first[node]
            if ends[node]:  # the whole string is one piece; nothing is left
                popped[node] = 1
                continue
            left, count = fail[parent], popped[parent]
            while (target := step.get(left << 8 | value)) is None:
                count += popped[left]
                left = fail[left]
            fail[node], popped[node] = target, count
        self.step, self.fail, self.popped = step, fail, popped

    def count(self, word: bytes) -> int:
        step, fail, popped, node, count = self.step, self.fail, self.popped, 0, 0
        for value in word:
            while (target := step.get(node << 8 | value)) is None:
                count += popped[node]
                node = fail[node]
            node = target
        while node:
            count += popped[node]
            node = fail[node]
        return count


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds n_words and n_tokens to every row, in one pass; the automaton has the vocabulary's size."""
    docs = docs.drop("n_words", "n_tokens")
    shared = docs.sparkSession.sparkContext.broadcast(LongestMatch(read_vocabulary(vocabulary)))
    schema = docs.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_tokens")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value.count
        memo = Memo(lambda word: count(b" " + word))
        for batch in slices(batches, text):
            words = [value.split() for value in texts_of(batch, text)]
            sizes = np.array([len(one) for one in words], np.int64)
            counts = np.array([sum(map(memo.__getitem__, one)) for one in words], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes), pa.array(counts)], [*batch.schema.names, "n_words", "n_tokens"])

    return docs.mapInArrow(run, schema)


ship_by_value(__name__)
