"""Dense row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import (
    BLOCK,
    BROADCAST_ROWS,
    POSITION,
    BlockedTable,
    OrderSpan,
    as_list,
    cut,
    cuts_evenly,
    rows_for,
    scale_of,
)
from tidemark.session import scratch_path

_ID = "__row_id"
_PART = "__part"
_OFFSET = "__offset"
# monotonically_increasing_id keeps the row number within its partition in the low 33 bits.
_ROW_BITS = 33


def row_index(
    df: DataFrame,
    order_by: str | Sequence[str],
    name: str = "index",
    start: int = 0,
    partition_by: str | Sequence[str] | None = None,
    span: OrderSpan | None = None,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Add ``name``: start, start + 1, ... in ``order_by``, restarting per ``partition_by`` if given.

    Up to ``rows_per_block`` rows one task numbers the table. Beyond that it is numbered block by
    block, plus the count of the blocks before. An order that gives no even blocks is range sorted
    once into a scratch table, whose partition sizes give the offsets; it belongs to the open
    ``scratch_scope``, if any, since the result reads it.
    """
    order, keys = as_list(order_by), as_list(partition_by)
    names = [c for c in df.columns if c != name]
    span = span or OrderSpan.measure(df, order)
    rows_per_block = rows_for(df, span.rows, rows_per_block)
    if span.too_large(rows_per_block):
        if not cuts_evenly(df, order, span, rows_per_block):
            numbered = _number_sorted(df, order)
            if not keys:
                return numbered.select(*names, (F.col(POSITION) + start).alias(name))
            df, order = numbered, [POSITION]
            span = OrderSpan(span.rows, 0, span.rows - 1)
        blocked = cut(df, order[0], keys, span, rows_per_block)
        if blocked is not None:
            return _number_by_block(blocked, order, name, start).select(*names, name)
    window = Window.partitionBy(*keys).orderBy(*order)
    number = F.row_number().over(window).cast("long") + (start - 1)
    return df.select(*names, number.alias(name))


def row_index_in_files(
    df: DataFrame,
    order_by: str | Sequence[str],
    name: str = "index",
    start: int = 0,
    span: OrderSpan | None = None,
    rows_per_block: int | None = None,
) -> DataFrame:
    """As ``row_index`` without keys, laid out to be written: the n-th partition holds the n-th range of numbers, sorted.

    The blocks that numbering cuts are the ranges, so one shuffle serves both; nothing is sampled. Neighbouring
    blocks are taken together where there are more than ``BROADCAST_ROWS``, so that their offsets are always few.
    """
    order = as_list(order_by)
    names = [c for c in df.columns if c != name]
    span = span or OrderSpan.measure(df, order)
    rows_per_block = rows_for(df, span.rows, rows_per_block)
    if not span.too_large(rows_per_block):
        return row_index(df, order, name, start, span=span, rows_per_block=rows_per_block).select(*names, name)
    if not cuts_evenly(df, order, span, rows_per_block):
        stored, offsets = _sorted_parts(df, order)
        parts = offsets.agg(F.max(_PART)).first()[0] + 1
        numbered = stored.repartitionById(parts, F.col(_PART)).sortWithinPartitions(_ID).join(F.broadcast(offsets), _PART)
        return numbered.select(*names, (F.col(_ID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.col(_OFFSET) + start).alias(name))
    blocks = span.block_count(rows_per_block)
    parts = min(blocks, BROADCAST_ROWS)
    block = span.block_of(scale_of(df.schema[order[0]]), rows_per_block)
    # Blocks are numbered from 0, for NULL, to their count.
    part = F.call_function("div", block * F.lit(parts).cast("long"), F.lit(blocks + 1).cast("long")).cast("int")
    placed = df.withColumn(_PART, part)
    counts = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = _offsets(counts)
    within = Window.partitionBy(_PART).orderBy(*order)
    local = placed.repartitionById(parts, F.col(_PART)).withColumn(_ID, F.row_number().over(within).cast("long"))
    return local.join(F.broadcast(offsets), _PART).select(*names, (F.col(_ID) + F.col(_OFFSET) + (start - 1)).alias(name))


def _number_by_block(blocked: BlockedTable, order: list[str], name: str, start: int) -> DataFrame:
    local = blocked.frame.withColumn(
        _ID, F.row_number().over(blocked.within_block(order)).cast("long")
    )
    counts = blocked.split_rows().groupBy(*blocked.keys, BLOCK).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = counts.select(
        *blocked.keys, BLOCK, F.sum("__rows").over(blocked.before_block()).alias(_OFFSET)
    )
    joined = blocked.with_frame(local).attach(offsets)
    number = F.col(_ID) + F.coalesce(F.col(_OFFSET), F.lit(0)) + (start - 1)
    return joined.withColumn(name, number)


def _number_sorted(df: DataFrame, order: list[str]) -> DataFrame:
    """0-based positions through one range sort."""
    stored, offsets = _sorted_parts(df, order)
    within = F.col(_ID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stored.join(F.broadcast(offsets), _PART)
        .withColumn(POSITION, within + F.col(_OFFSET))
        .drop(_PART, _OFFSET, _ID)
    )


def _sorted_parts(df: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of a range sort with their part and place, written out so that they cannot change; and the
    offset of each part.

    Sort bounds are sampled, so a second run of the same sort may cut elsewhere; the written
    table pins them and also survives the loss of executors. Ties are broken by content and
    then by source row, which lets the sort spread a value that holds much of the table.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in order]
    ties = [F.xxhash64(*rest)] if rest else []
    ties.append(F.monotonically_increasing_id())
    path = scratch_path(spark, "row-index")
    (
        df.orderBy(*order, *ties)
        .withColumn(_ID, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    stored = spark.read.parquet(path).withColumn(_PART, F.shiftright(F.col(_ID), _ROW_BITS).cast("int"))
    # One row per partition of the sort, so this side stays as small as the shuffle is wide.
    return stored, _offsets(stored.groupBy(_PART).agg(F.count(F.lit(1)).alias("__rows")))


def _offsets(counts: DataFrame) -> DataFrame:
    """How many rows lie before each part, given how many it has."""
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(_PART, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias(_OFFSET))
