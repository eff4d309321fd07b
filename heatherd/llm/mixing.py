"""Mixing sources to target weights (operator 6).

The sizes of each source are added up; weights become target sizes, capped at `MAX_REPEATS` times
the source, with the excess dealt out again by weight until no target is above its cap. A
source's repetition rate is target over size. Each document is taken floor(rate) times plus one
more with probability equal to the fraction, drawn from a hash of seed, source and id, so reruns
agree and no document exceeds the cap.

Defined cases: a null text has no words; a null source is a source of its own, ranked last; a row
with a null id draws from its source alone; equal rows draw equally; a source without words gets
no target and its documents are taken once at rate 0, that is never; an empty table gives an
empty result; columns of the input pass through, but those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from heatherd.llm.common import Scratch, settings
from heatherd.session import ship_by_value

WEIGHTS = (5.0, 2.0, 1.0)  # repeated over the sources in code point order
MAX_REPEATS = 3.0
SEED = 20240601
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text: the places where one begins."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def drawn(seed: int, source: Column, doc_id: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of a hash; exact in a double."""
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(source, F.lit("\x01null")), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: float = MAX_REPEATS, share: float = 1.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Capped sources are those with the smallest cap per weight. In that order, with running sums, a
    source is capped exactly when dealing what is left by the weights left would reach its cap.
    The table has one row per source; it is sorted by source and by cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(max_repeats))
    ratio = F.col("cap") / F.col("weight")
    before = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.when(left / weights_left < ratio, left / weights_left)  # null for capped sources
    return (
        ranked.withColumn("level", level).withColumn("level", F.max("level").over(every))
        .withColumn("target", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))))
        .select("source", "source_size", "target")
    )


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: float = MAX_REPEATS, share: float = 1.0, seed: int = SEED
) -> DataFrame:
    """The rows of `docs` (doc_id, text, source, ...) with size, source_size, target and `copies`."""
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    sized = docs.withColumn("size", n_words(F.col("text")))
    with settings(docs.sparkSession):
        sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        targets = Scratch(docs.sparkSession, "mixing").write(source_targets(sizes, weights, max_repeats, share), "targets")
    mixed = sized.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(max_repeats))).otherwise(0.0)
    extra = drawn(seed, F.col("source"), F.col("doc_id")) < rate - F.floor(rate)
    return mixed.withColumn("copies", F.floor(rate) + extra.cast("long"))


def emit_copies(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as the mix takes it, with the columns of the input."""
    mixed = mix_sources(docs, **options).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


ship_by_value(__name__)
