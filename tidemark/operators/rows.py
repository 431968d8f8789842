"""Filters and projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import round_to
from tidemark.functions.repair import missing_to_null, try_number
from tidemark.schemas import CLEAN_FIELDS, SALES_THRESHOLD


def above_threshold(
    df: DataFrame, column: str = "Weekly_Sales", limit: float = SALES_THRESHOLD
) -> DataFrame:
    """Rows strictly above ``limit``; NULL is not above anything."""
    return df.where(F.col(column) > F.lit(limit))


def above_threshold_tolerant(
    df: DataFrame, column: str = "Weekly_Sales", limit: float = SALES_THRESHOLD
) -> DataFrame:
    """As ``above_threshold`` over text: rows that do not parse, or lack the column, are left out."""
    if column not in df.columns:
        return df.where(F.lit(False))
    return df.where(try_number(F.col(column)) > F.lit(limit))


def in_domain(df: DataFrame, column: str, allowed: Iterable) -> DataFrame:
    return df.where(F.col(column).isin(*allowed))


def drop_missing_measure(df: DataFrame, column: str, tokens: Iterable[str]) -> DataFrame:
    return df.where(missing_to_null(F.col(column), tokens).isNotNull())


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def require_truthy(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose ``columns`` are present and, if numeric, not zero."""
    for name in columns:
        df = df.where(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, T.NumericType):
            df = df.where(F.col(name) != 0)
    return df


def split_rejects(df: DataFrame, kinds: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows whose key columns all cast, with the cast values, and the others as read."""
    parsed = {name: F.col(name).try_cast(kind) for name, kind in kinds.items()}
    valid = F.lit(True)
    for value in parsed.values():
        valid = valid & value.isNotNull()
    good = df.where(valid).withColumns(parsed)
    return good, df.where(~valid)


def project_clean(df: DataFrame, columns: Sequence[str] = CLEAN_FIELDS) -> DataFrame:
    return df.select(*columns)


def project_typed(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Select and cast to a declared schema; a column the input lacks takes its default."""
    defaults = defaults or {}
    return df.select(
        *[
            optional_column(df, field.name, defaults.get(field.name)).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )


def optional_column(df: DataFrame, name: str, default: object = None) -> Column:
    """The column if the input has it, else a constant. NULLs of a present column stay."""
    return F.col(name) if name in df.columns else F.lit(default)


def drop_and_rename(df: DataFrame, drop: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(dict(rename or {}))


def round_floats(df: DataFrame, decimals: int = 2, mode: str = "half_up") -> DataFrame:
    """Round every float and double column, going by the schema."""
    floating = (T.FloatType, T.DoubleType)
    return df.select(
        *[
            round_to(F.col(f.name), decimals, mode).cast(f.dataType).alias(f.name)
            if isinstance(f.dataType, floating)
            else f.name
            for f in df.schema
        ]
    )
