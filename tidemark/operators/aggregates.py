"""Grouped means and counts. All combine map-side; no group is ever collected."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exact import mean_of_doubles
from tidemark.functions.numbers import divide_units, round_to, whole_units
from tidemark.operators.blocks import as_list
from tidemark.operators.rows import above_threshold_tolerant
from tidemark.schemas import SALES_THRESHOLD


def mean_by(
    df: DataFrame,
    by: str | Sequence[str] | None,
    value: str,
    name: str,
    decimals: int = 2,
    rounding: str = "half_up",
    exact_scale: int | None = None,
    empty: float | None = None,
) -> DataFrame:
    """Mean of ``value`` per group, rounded. NULLs are skipped.

    The result does not depend on partitioning or retries: doubles are summed exactly, as they are, and divided and
    rounded once. With ``exact_scale`` values are taken as decimals of that scale, which is cheaper and right for money.
    ``empty`` replaces the mean of no values.
    """
    keys = as_list(by)
    if exact_scale is None:
        result = mean_of_doubles(df, keys, value, name)
        mean = round_to(F.col(name), decimals, rounding)
    else:
        result = df.groupBy(*keys).agg(
            whole_units(F.col(value), exact_scale).alias("__units"), F.count(value).alias("__count")
        )
        mean = F.when(
            F.col("__count") > 0,
            divide_units(F.col("__units"), F.col("__count"), exact_scale, decimals, rounding),
        )
    if empty is not None:
        mean = F.coalesce(mean, F.lit(empty))
    return result.select(*keys, mean.alias(name))


def monthly_average(
    threshold: float = SALES_THRESHOLD,
    value: str = "Weekly_Sales",
    month: str = "Month",
    name: str = "Average_Weekly_Sales",
    **options,
) -> Callable[[DataFrame], DataFrame]:
    """Filter, group and mean as one step for ``df.transform``."""

    def step(df: DataFrame) -> DataFrame:
        kept = above_threshold_tolerant(df, value, threshold)
        return mean_by(kept, month, value, name, **options)

    return step
