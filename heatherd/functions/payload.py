"""Values inside landed JSON payloads: production markers, grid keys, coordinates, codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from heatherd.functions.text import number

# Grid series write -999 for a missing value.
MISSING_BELOW = -999.0 + 0.5

# Production markers. A dash is a true zero, the others are unknown.
ZERO_MARKER = "-"
UNKNOWN_MARKERS = ["..", "...", "X", ""]

# Administrative regions.
REGIONS = {"Norte": 1, "Nordeste": 2, "Sudeste": 3, "Sul": 4, "Centro-Oeste": 5}

# Allowed level names.
BOUNDARY_LEVELS = ["regioes", "estados", "mesorregioes", "municipios"]
GEO_LEVELS = ["N1", "N2", "N3", "N6", "N8", "N9"]


def production_value(raw: Column) -> Column:
    s = F.btrim(raw, F.lit(" \t\n\r\x0b\x0c"))
    infinite = F.lower(F.ltrim(s, F.lit("+-"))).isin("inf", "infinity")
    return (
        F.when(s == ZERO_MARKER, F.lit(0.0))
        .when(s.isin(UNKNOWN_MARKERS), None)
        .when(infinite, s.try_cast("double"))
        .otherwise(number(s))
    )


def grid_value(raw: Column) -> Column:
    value = number(raw)
    return F.when(value > MISSING_BELOW, value)


def _key_date(key: Column) -> Column:
    return F.concat_ws("-", F.substring(key, 1, 4), F.substring(key, 5, 2), F.substring(key, 7, 2)).try_cast("date")


def grid_day(key: Column) -> Column:
    return F.when(key.rlike(r"^\d{8}$"), _key_date(key))


def grid_hour_day(key: Column) -> Column:
    """Day of a YYYYMMDDHH key, null unless the whole key is valid."""
    return F.when(key.rlike(r"^\d{8}([01]\d|2[0-3])$"), _key_date(key))


def grid_hour(key: Column) -> Column:
    return F.substring(key, 9, 2).try_cast("bigint")


def naive_timestamp(day: Column, hour: Column) -> Column:
    """Built from its fields, so no session time zone is involved."""
    return F.make_timestamp_ntz(
        F.year(day), F.month(day), F.day(day), hour.cast("int"), F.lit(0), F.lit(0)
    )


def coordinate(coordinates: Column, position: int) -> Column:
    return F.try_element_at(coordinates, F.lit(position))


def first_filled(properties: Column, *names: str) -> Column:
    """First property that is neither missing nor empty; the last name is taken as it is."""
    *preferred, last = names
    candidates = [F.nullif(F.try_element_at(properties, F.lit(n)), F.lit("")) for n in preferred]
    return F.coalesce(*candidates, F.try_element_at(properties, F.lit(last)))


def parent_level(code: Column) -> Column:
    """Level of the area that a locality code names, by the number of its digits."""
    digits = F.length(code.cast("string"))
    return (
        F.when(digits <= 1, "regioes")
        .when(digits <= 2, "estados")
        .when(digits <= 4, "mesorregioes")
        .when(digits.isNotNull(), "municipios")
    )


def region_name(region_id: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for n, i in REGIONS.items() for x in (i, n)]), region_id)
