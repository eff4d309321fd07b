"""Work plans: which (station, period) blocks of the grid are wanted, and which are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def year_blocks(stations: DataFrame, first_year: int, last_year: int, size: int) -> DataFrame:
    """One row per station and block of up to `size` years, with ISO start and end."""
    if last_year < first_year:
        raise ValueError(f"invalid year range: {first_year}-{last_year}")
    starts = F.sequence(F.lit(first_year), F.lit(last_year), F.lit(size))
    blocks = stations.select("*", F.explode(starts).alias("year"))
    end_year = F.least(F.col("year") + (size - 1), F.lit(last_year))
    return blocks.withColumns({
        "inicio": F.concat(F.lpad(F.col("year").cast("string"), 4, "0"), F.lit("-01-01")),
        "fim": F.concat(F.lpad(end_year.cast("string"), 4, "0"), F.lit("-12-31")),
    }).drop("year")


def missing_blocks(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned blocks that have not landed."""
    return plan.join(landed.select("cd_estacao", "inicio", "fim"), ["cd_estacao", "inicio", "fim"], "left_anti")


def covered_periods(landed: DataFrame) -> DataFrame:
    """(cd_estacao, inicio, fim): landed periods merged where they overlap or follow each other by a day.

    `landed` has ISO dates. A period that is no period, or ends before it begins, covers nothing.
    A station has one row per landed document.
    """
    periods = landed.select(
        "cd_estacao", F.expr("try_cast(inicio AS date)").alias("inicio"), F.expr("try_cast(fim AS date)").alias("fim")
    ).filter("inicio <= fim")
    in_order = Window.partitionBy("cd_estacao").orderBy("inicio", "fim")
    reached = F.max("fim").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("inicio") <= F.date_add(reached, 1), 0).otherwise(1)
    island = F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        periods.withColumn("begins", begins).withColumn("island", island)
        .groupBy("cd_estacao", "island").agg(F.min("inicio").alias("inicio"), F.max("fim").alias("fim")).drop("island")
    )


def missing_periods(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """The parts of the planned blocks that no landed period covers, with their ISO dates and the other columns of the plan.

    Landed periods need not have the bounds of the plan. A gap is what lies between two covered
    periods of a station, or before the first or after the last one; a block misses where it meets gaps.
    """
    in_order = Window.partitionBy("cd_estacao").orderBy("inicio")
    covered = covered_periods(landed).withColumns({"fim_antes": F.lag("fim").over(in_order), "ultimo": F.lead("inicio").over(in_order).isNull()})
    first, last = (F.lit(day).cast("date") for day in ("0001-01-01", "9999-12-31"))
    before = F.struct(
        F.coalesce(F.date_add("fim_antes", 1), first).alias("low"), F.date_sub("inicio", 1).alias("high"))
    after = F.struct(F.date_add("fim", 1).alias("low"), last.alias("high"))
    gaps = covered.select("cd_estacao", F.explode(F.when(F.col("ultimo"), F.array(before, after)).otherwise(F.array(before))).alias("gap"))
    wanted = plan.withColumns({c: F.col(c).cast("date") for c in ("inicio", "fim")})
    # a station without any landed period misses all of its blocks
    met = wanted.join(gaps, "cd_estacao", "left").withColumns({
        "inicio": F.greatest("inicio", F.coalesce("gap.low", "inicio")), "fim": F.least("fim", F.coalesce("gap.high", "fim"))})
    return met.filter("inicio <= fim").withColumns({c: F.col(c).cast("string") for c in ("inicio", "fim")}).select(*plan.columns)
