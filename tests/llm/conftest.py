from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def prose():
    """Invented sentences from a fixed seed."""
    rng = random.Random(11)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiouéß") for _ in range(rng.randint(1, 3))) for _ in range(400)]
    return lambda n: " ".join(rng.choice(words) for _ in range(n))


DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def corpus(prose):
    """Rows with every awkward case: copies, near copies, shared passages, nulls, ties, long and empty texts."""
    base = [prose(60) for _ in range(6)]
    passage = prose(40)
    texts = [*base, base[0], base[0], base[1] + " tail words here", "start " + base[1], base[2].replace(" ", "\n", 3)]
    near = base[3].split()
    for i in range(12):  # a chain of near copies
        near[5 * i % len(near)] = f"changed{i}"
        texts.append(" ".join(near))
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(8)]
    texts += [None, "", "   \n", "one", "one", "one two", "A b C d", "a B c D", "x" * 3_000, "same line\nsame line\nsame line", prose(3_000), "é" * 80, "é" * 79]
    rows = [(i * 3 + 1, text, "en", None if i % 7 == 0 else f"s{i % 4}", None if text is None else len(text)) for i, text in enumerate(texts)]
    rows += [(1, base[4], "en", "s1", 1), (1, base[4], "en", "s1", 1), (None, base[0], None, None, None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus as a table that also has columns named like results."""
    df = spark.createDataFrame(corpus, DOCS)
    return df.selectExpr("*", "'clash' AS n_words", "'clash' AS size", "'clash' AS kept", "0 AS n_removed", "0 AS component_id").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
