"""The station registry: payload to table, coordinates, membership, ordering and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from heatherd.functions.geometry import point_wkb
from heatherd.functions.text import decimal_comma, snake_case_name
from heatherd.operators.frame import keep_stations
from heatherd.session import broadcast_if, single_value

# Fields of every station payload.
STATION_FIELDS = ("CD_ESTACAO", "DC_NOME", "SG_ESTADO", "VL_LATITUDE", "VL_LONGITUDE")


def payload_fields(payloads: DataFrame) -> list[str]:
    """All field names used by any station of the payloads."""
    entries = payloads.select(F.explode(F.from_json("payload", "array<map<string,string>>")).alias("e"))
    names = entries.select(F.explode(F.map_keys("e")).alias("name")).distinct().collect()
    return sorted(r["name"] for r in names)


def stations(payloads: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Station table from JSON lists in `payload`; stations without valid coordinates are dropped.

    Extra fields are kept as text under their normalized names. Naming the `fields` saves
    the pass that looks for them.
    """
    fields = payload_fields(payloads) if fields is None else list(fields)
    fields = list(dict.fromkeys([*STATION_FIELDS, *fields]))
    entry = payloads.select(F.explode_outer(F.from_json("payload", "array<map<string,string>>")).alias("e"))
    table = entry.select(*[F.try_element_at("e", F.lit(f)).alias(snake_case_name(f)) for f in fields])
    return (
        table.withColumns({c: decimal_comma(F.col(c)) for c in ("vl_latitude", "vl_longitude")})
        .dropna(subset=["vl_latitude", "vl_longitude"])
        .withColumn("geometry", point_wkb(F.col("vl_longitude"), F.col("vl_latitude")))
    )


def station_coordinates(stations: DataFrame, codes: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """One row per station with both coordinates, in code order; of several rows the smallest coordinates are kept."""
    at = F.struct("vl_latitude", "vl_longitude")
    return (
        keep_stations(stations.select("cd_estacao", "vl_latitude", "vl_longitude"), codes)
        .dropna()
        .groupBy("cd_estacao")
        .agg(F.min(at).alias("at"))
        .select("cd_estacao", "at.*")
        .orderBy("cd_estacao")
    )


def known_only(df: DataFrame, stations: DataFrame | None, station_bound: int | None = None) -> DataFrame:
    """Rows of registered stations; without a registry all rows stay."""
    return keep_stations(df, stations, station_bound)


def observations_per_station(daily: DataFrame) -> DataFrame:
    return daily.groupBy("cd_estacao").agg(
        (F.sum("n_temp_obs") + F.sum("n_umid_obs")).alias("obs")
    )


def observed_only(daily: DataFrame, station_bound: int | None = None) -> DataFrame:
    """Days of stations that observed anything at all."""
    observed = observations_per_station(daily).filter(F.col("obs") > 0)
    return daily.join(broadcast_if(observed, station_bound), "cd_estacao", "left_semi")


def missing_stations(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Wanted stations that have no row in `present`."""
    return wanted.select("cd_estacao").distinct().join(present.select("cd_estacao").distinct(), "cd_estacao", "left_anti")


def station_index(stations: DataFrame) -> DataFrame:
    """Position of every station in code order, from 0.

    Codes are counted per two-character prefix first, so no task sorts the whole registry.
    """
    codes = stations.select("cd_estacao").distinct().withColumn("prefix", F.substring("cd_estacao", 1, 2))
    before = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        codes.groupBy("prefix").agg(F.count(F.lit(1)).alias("size"))
        .select("prefix", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    within = F.row_number().over(Window.partitionBy("prefix").orderBy("cd_estacao")) - 1
    return (
        codes.withColumn("within", within)
        .join(starts, "prefix")
        .select("cd_estacao", (F.col("start") + F.col("within")).alias("posicao"))
    )


def station_batches(stations: DataFrame, batch_size: int) -> DataFrame:
    return station_index(stations).select(
        "cd_estacao", F.floor(F.col("posicao") / batch_size).cast("int").alias("batch")
    )


def sample_stations(stations: DataFrame, n: int) -> DataFrame:
    """n stations evenly spread over the code order; all of them when there are not more than n."""
    indexed = station_index(stations)
    total = single_value(indexed.agg(F.count(F.lit(1)).alias("n")), "n")["n"]
    step = total / F.lit(float(n))
    # i-th pick is floor(i * step); a position is picked when some i below n gives it
    i = F.ceil(F.col("posicao") / step)
    hit = [(F.floor(k * step) == F.col("posicao")) & (k >= 0) & (k < n) for k in (i - 1, i, i + 1)]
    return indexed.filter((total <= n) | hit[0] | hit[1] | hit[2]).select("cd_estacao")
