"""Key joins. The physical strategy is left to Spark: adaptive execution broadcasts small
sides and splits skewed partitions of the others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.repair import default_when_unmatched
from tidemark.operators.blocks import as_list
from tidemark.operators.ordered import MATCHED
from tidemark.operators.reduce import first_per_key


def normalize_key(df: DataFrame, key: str = "index", kind: str = "bigint") -> DataFrame:
    """Both sides of a join need one key type; text and number keys meet as ``kind``."""
    return df.withColumn(key, F.col(key).try_cast(kind))


def join_inner(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return left.join(right, as_list(key), "inner")


def join_left(
    left: DataFrame, right: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    joined = left.join(right, as_list(key), "left")
    return joined.select(*columns) if columns else joined


def cogroup_first_left(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    left_order: str | Sequence[str] | None,
    right_order: str | Sequence[str] | None,
    defaults: Mapping[str, float] | None = None,
) -> DataFrame:
    """Left join of the first row per key of each side.

    Keys only on the right are dropped. A column on both sides takes the right row's value where
    there is one. ``defaults`` apply where the right row is absent, not where it holds NULL.
    An order of None says that side has one row per key already and skips its aggregate.
    """
    keys = as_list(key)
    if left_order is not None:
        left = first_per_key(left, keys, left_order)
    if right_order is not None:
        right = first_per_key(right, keys, right_order)
    return merge_right_wins(left, right, keys, defaults)


def merge_right_wins(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    defaults: Mapping[str, float] | None = None,
) -> DataFrame:
    keys, defaults = as_list(key), dict(defaults or {})
    renamed = {c: f"__right_{c}" for c in right.columns if c not in keys}
    marked = right.withColumnsRenamed(renamed).withColumn(MATCHED, F.lit(True))
    matched = F.coalesce(F.col(MATCHED), F.lit(False))
    joined = left.join(marked, keys, "left")

    def merged(name: str):
        if name in keys or name not in renamed:
            return F.col(name)
        value = F.col(renamed[name])
        if name in left.columns:
            return F.when(matched, value).otherwise(F.col(name)).alias(name)
        if name in defaults:
            return default_when_unmatched(matched, value, defaults[name]).alias(name)
        return value.alias(name)

    names = [*left.columns, *[c for c in right.columns if c not in left.columns]]
    return joined.select(*[merged(n) for n in names])
