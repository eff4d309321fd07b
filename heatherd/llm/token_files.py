"""Token ids in ORC files (operator 3).

Documents are placed and sorted by id, encoded, and written as ORC: integer run-length encoding
packs the ids, row indexes keep the range of document ids per `INDEX_ROWS` rows, and Bloom
filters answer for single ids, so a reader skips stripes and row groups by metadata. Stripes are
read in parallel. A document's place in the corpus needs only the sizes, which are a column.

Defined cases: a null text is an empty one, of the end id alone; rows with a null id come first;
rows that share an id follow each other by their text; an empty table gives an empty result; other
columns are not stored. A text is encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from heatherd.llm.common import Scratch, exclusive_total, settings, slices, texts_of
from heatherd.llm.tokens import Encoder
from heatherd.session import ship_by_value

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 2
INDEX_ROWS = 1_000
STRIPE_BYTES = 64 << 20
SCHEMA = "doc_id long, n_tokens long, ids array<int>"


def encode_rows(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    encoder, last = Encoder(path, spaces=False), np.array([end], "<u4").tobytes()
    for batch in slices(batches, "text"):
        ids = [one + last for one in encoder.encode([text.decode() for text in texts_of(batch, "text")])]
        sizes = np.array([len(one) // 4 for one in ids], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        values = np.frombuffer(b"".join(ids), "<i4")
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
            ["doc_id", "n_tokens", "ids"])


def write_tokens(docs: DataFrame, target: str, tokenizer: str = TOKENIZER, end: int = END) -> None:
    """Writes the ids of every row of `docs` (doc_id, text) below `target`, in ascending id order."""
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = placed.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    with settings(docs.sparkSession):
        placed.mapInArrow(lambda batches: encode_rows(batches, tokenizer, end), SCHEMA).write.options(**{
            "orc.bloom.filter.columns": "doc_id", "orc.row.index.stride": str(INDEX_ROWS),
            "orc.stripe.size": str(STRIPE_BYTES), "orc.compress": "ZSTD",
        }).orc(target)


def read_tokens(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, n_tokens, ids); a filter on doc_id skips stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(target)


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        bounds, values = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4", copy=False)
        sums = [zlib.crc32(values[a:b]) for a, b in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(sums, pa.int64())],
            ["doc_id", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, read back from the files."""
    stored = read_tokens(spark, target)
    light = stored.select("doc_id", "n_tokens")
    summed = stored.mapInArrow(checksums, "doc_id long, n_tokens long, ids_crc32 long")
    with settings(spark):
        out = exclusive_total(summed, light, ["doc_id", "ids_crc32"], "n_tokens", "start", light.count())
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def tokenize_to_files(docs: DataFrame, **options) -> DataFrame:
    target = Scratch(docs.sparkSession, "tokens").path("orc")
    write_tokens(docs, target, **options)
    return token_index(docs.sparkSession, target)


ship_by_value(__name__)
