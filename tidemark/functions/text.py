"""Rows as delimited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_point(value: Column, decimals: int = 2) -> Column:
    """Text with exactly ``decimals`` places and no thousands separator; NULL stays NULL."""
    return F.when(value.isNotNull(), F.format_string(f"%.{decimals}f", value))


def delimited(columns: list[Column], blank: str = "", separator: str = ",") -> Column:
    """One line of text; NULL is written as ``blank`` and keeps its place between separators."""
    return F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit(blank)) for c in columns])
