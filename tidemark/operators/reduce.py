"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import as_list

_PLACE = "__place"


def first_per_key(
    df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str]
) -> DataFrame:
    """One whole row per key: the smallest by ``order_by``, remaining columns breaking ties.

    A rank limit, which Spark applies in each task before the shuffle: a key with many rows reaches the final task as
    one row per map task. Rows travel as they are, of whatever types. (A minimum over structs would do the same in a
    sort aggregate, copying rows into structs; a hash aggregate holds values of fixed width only, so whole rows would have
    to be fetched by a second shuffle of the table.)
    """
    keys, order = as_list(key), as_list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn(_PLACE, place).where(F.col(_PLACE) <= 1).drop(_PLACE)
