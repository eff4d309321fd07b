"""How much of a daily table is imputed, per station and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from heatherd.functions.climate import OBSERVED


def coverage_by_station(daily: DataFrame) -> DataFrame:
    """Imputed shares per station, in code order."""
    return daily.groupBy("cd_estacao").agg(
        F.count(F.lit(1)).alias("dias"),
        F.avg((F.col("temp_origem") != OBSERVED).cast("double")).alias("frac_dias_temp_tocada"),
        F.avg("temp_frac_imp").alias("frac_horas_temp_imp"),
        F.avg("umid_frac_imp").alias("frac_horas_umid_imp"),
    ).orderBy("cd_estacao")


def coverage_overall(coverage: DataFrame) -> DataFrame:
    """Station count, days, and the mean over stations of the imputed shares."""
    return coverage.agg(
        F.count(F.lit(1)).alias("estacoes"),
        F.sum("dias").alias("dias"),
        F.avg("frac_horas_temp_imp").alias("frac_horas_temp_imp"),
        F.avg("frac_horas_umid_imp").alias("frac_horas_umid_imp"),
    )


def most_imputed(coverage: DataFrame, n: int | None = None) -> DataFrame:
    """Stations ranked by imputed share: all of them, or the first `n` as a top-n report.

    Shares equal to nine digits are a tie, which goes to the lower code: the last bits of a mean
    depend on the order in which Spark adds, and would rank tied stations differently from run
    to run. There is one row per station.
    """
    order = [F.round("frac_horas_temp_imp", 9).desc_nulls_first(), F.asc("cd_estacao")]
    first = coverage if n is None else coverage.orderBy(*order).limit(n)
    return first.withColumn("posicao", F.row_number().over(Window.orderBy(*order)))


def day_types(daily: DataFrame) -> DataFrame:
    """Days per type with their percentage, most frequent first."""
    counts = daily.groupBy("tipo").agg(F.count(F.lit(1)).alias("dias"))
    total = F.sum("dias").over(Window.partitionBy())  # a handful of types
    return counts.withColumn("pct", F.col("dias") / total * 100).orderBy(F.desc("dias"))


def completeness(daily: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted stations, how many the daily table has, and how many are left out."""
    have = daily.select("cd_estacao").distinct().withColumn("tem", F.lit(1))
    return (
        wanted.select("cd_estacao").distinct().join(have, "cd_estacao", "left")
        .agg(
            F.count(F.lit(1)).alias("desejadas"),
            F.count("tem").alias("imputadas"),
            F.count_if(F.col("tem").isNull()).alias("excluidas"),
        )
    )


def excluded_stations(daily: DataFrame, wanted: DataFrame) -> DataFrame:
    """Codes of the wanted stations that the daily table does not have, in order."""
    return wanted.select("cd_estacao").distinct().join(daily.select("cd_estacao").distinct(), "cd_estacao", "left_anti").orderBy("cd_estacao")


def rows_per_station(history: DataFrame, n: int = 10) -> DataFrame:
    """The n stations with most rows; ties go to the lower code."""
    counts = history.groupBy("cd_estacao").agg(F.count(F.lit(1)).alias("linhas"))
    return counts.orderBy(F.desc("linhas"), "cd_estacao").limit(n)
