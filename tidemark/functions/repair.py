"""Missing values, tolerant and strict parsing.

Every function maps columns to a column, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's number parser takes "5d", "5f" and hexadecimal floats; text data does not mean those.
# Breaking these letters makes such text, and "inf", unparsable, at one evaluation of the input.
_NOT_DIGITS = "dDfFxX"
# Spark's timestamp cast also takes a bare year, a year and month, or a bare time.
_SHORTEST_DATE = len("2023-1-5")


def missing_to_null(value: Column, tokens: Iterable[str]) -> Column:
    """NULL where the text is one of ``tokens``; everything else unchanged."""
    return F.when(~value.isin(*tokens), value)


def is_missing(value: Column, tokens: Iterable[str]) -> Column:
    return value.isNull() | value.isin(*tokens)


def nan_to_null(value: Column) -> Column:
    """NaN compares greater than any number and poisons means, so it becomes NULL at the scan."""
    return F.nullif(value, F.lit(float("nan")))


def try_number(value: Column, kind: str = "double") -> Column:
    """Text to a finite number; unparsable text, infinity and NaN give NULL."""
    if kind not in ("double", "float"):
        return value.try_cast(kind)
    digits = F.translate(value.cast("string"), _NOT_DIGITS, "?" * len(_NOT_DIGITS))
    return nan_to_null(digits.try_cast(kind))


def try_date(value: Column, formats: Iterable[str] = ()) -> Column:
    """Text to timestamp; ISO by default, else the first of ``formats`` that fits; NULL if none."""
    formats = list(formats)
    if formats:
        return F.coalesce(*[F.try_to_timestamp(value, F.lit(pattern)) for pattern in formats])
    text = F.trim(value)
    whole_date = (F.substring(text, 5, 1) == "-") & (F.length(text) >= _SHORTEST_DATE)
    return F.when(whole_date, value.try_cast("timestamp"))


def strict_cast(value: Column, kind: str) -> Column:
    """Cast that fails the job on text that does not parse, whatever the ANSI setting."""
    parsed = value.try_cast(kind)
    message = F.concat(F.lit(f"not a {kind}: "), value.cast("string"))
    return F.when(value.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def flag_to_boolean(value: Column) -> Column:
    """Truthiness of a numeric flag where a missing flag counts as true."""
    return F.coalesce(value.cast("double") != 0, F.lit(True))


def flag_to_int(value: Column) -> Column:
    return value.cast("int")


def default_when_unmatched(matched: Column, value: Column, default: float) -> Column:
    """The default only where the joined row is absent: a NULL in a present row stays NULL."""
    return F.when(matched, value).otherwise(F.lit(default))


def month_of(moment: Column) -> Column:
    return F.month(moment)


def month_of_text(text: Column) -> Column:
    """Month number out of yyyy-mm-dd text by position; NULL if those two characters are no number."""
    return F.substring(text, 6, 2).try_cast("int")


def to_decimal(value: Column, precision: int = 10, scale: int = 2) -> Column:
    return value.try_cast(f"decimal({precision},{scale})")
