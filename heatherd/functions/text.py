"""Text to typed values. Bad input gives null, never an error, with ANSI mode on or off."""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

# Tokens that mean "missing" in station files.
NULL_TOKENS = ["", "NA", "-9999", "-9999,0"]

# Characters with an ASCII part under NFKD, and what is left of them; built from the character
# database, so any script folds as in Python. Single characters go through one translation.
_FOLDED = {
    chr(c): folded
    for c in range(0x80, sys.maxunicode + 1)
    if (folded := unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode())
}
_ONE_TO_ONE = {c: f for c, f in _FOLDED.items() if len(f) == 1}
_ONE_TO_MANY = {c: f for c, f in _FOLDED.items() if len(f) > 1}
_PIECES = r"[\x00-\x7F]+|[^\x00-\x7F]"


def number(text: Column) -> Column:
    """Plain decimal text. Spark's own cast also takes '1d', '0x1p3', 'Infinity' and padded text;
    looking at both ends and for an x keeps those out at less cost than a pattern.
    """
    t = text.cast("string")
    ends = F.right(t, F.lit(1)).between(".", "9") & (F.left(t, F.lit(1)) > " ")
    hexadecimal = F.contains(t, F.lit("x")) | F.contains(t, F.lit("X"))
    return F.when(ends & ~hexadecimal, t.try_cast("double"))


def decimal_comma(text: Column) -> Column:
    return number(F.replace(text.cast("string"), F.lit(","), F.lit(".")))


def iso_date(text: Column) -> Column:
    """yyyy-MM-dd only. The cast reads that form fastest, but takes shorter and longer ones too."""
    t = text.cast("string")
    dashes = (F.substring(t, 5, 1) == "-") & (F.substring(t, 8, 1) == "-")
    full = (F.length(t) == 10) & F.right(t, F.lit(1)).between("0", "9")
    return F.when(dashes & full, t.try_cast("date"))


def hour_of(text: Column) -> Column:
    """Hour from '0000 UTC', '00:00:00' or '00:00': the first one or two digits."""
    return F.regexp_substr(text, F.lit(r"\d{1,2}")).try_cast("bigint")


def month_of(iso_text: Column) -> Column:
    return F.substring(iso_text, 6, 2).try_cast("int")


def year_of(iso_text: Column) -> Column:
    return F.substring(iso_text, 1, 4).try_cast("int")


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(NULL_TOKENS), text)


def snake_case(text: Column) -> Column:
    """ASCII snake case of text in any script; characters without an ASCII part are dropped."""
    return F.btrim(F.regexp_replace(F.lower(_ascii(text)), "[^a-z0-9]+", "_"), F.lit("_"))


def snake_case_fields(line: Column, separator: str) -> Column:
    """The snake case of every field of a line without line feeds: the line is folded once, not field by field."""
    plain = F.lower(_ascii(F.replace(line, F.lit(separator), F.lit("\n"))))
    return F.split(F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9\n]+", "_"), "(?<![^\n])_|_(?![^\n])", ""), "\n")


def _ascii(text: Column) -> Column:
    """The ASCII parts of the characters of a text."""
    plain = F.translate(text, "".join(_ONE_TO_ONE), "".join(_ONE_TO_ONE.values()))
    # of what is left, few characters become several, such as a ligature; only characters beyond ASCII are looked up
    several = F.split(F.lit("\n".join(_ONE_TO_MANY.values())), "\n")
    pieces = F.transform(
        F.regexp_extract_all(plain, F.lit(_PIECES), F.lit(0)),
        lambda c: F.when(F.ascii(c) < 128, c).otherwise(F.coalesce(F.get(several, F.instr(F.lit("".join(_ONE_TO_MANY)), c) - 1), F.lit(""))))
    return F.when(plain.rlike(r"[^\x00-\x7F]"), F.array_join(pieces, "")).otherwise(plain)


def snake_case_name(name: str) -> str:
    """The same for one column name, for any script."""
    ascii_name = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub("[^a-z0-9]+", "_", ascii_name.lower()).strip("_")


def normalized_columns(df: DataFrame) -> DataFrame:
    """The same table with snake-case column names."""
    return df.toDF(*[snake_case_name(c) for c in df.columns])
