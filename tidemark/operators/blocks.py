"""Cutting an ordered table into blocks of bounded size.

The bound holds up to MAX_BLOCKS blocks; a table beyond that, some ten million times a block, gets larger ones.

A window over the whole table (or over one key that holds a third of it) sorts all its
rows in one task. Fill and row numbering avoid that by working block by block and handing
one small value from each block to the next. A block is a range of the leading order
column, computed by arithmetic: no shuffle, and the same answer when a task runs again.
NULLs, which come first in an order, are a block of their own. Before any cut the rows of
every block are counted, in one pass that combines map-side and reads one column, so neither
repeated values nor holes can make a block too large unseen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

BLOCK = "__block"
POSITION = "__position"

# Rows a block should have at most. Also the size from which a key counts as hot.
ROWS_PER_BLOCK = 1_000_000
# Bytes a block should have at most, by the widths of its columns; text counts for TEXT_BYTES.
BLOCK_BYTES = 128 * 1024 * 1024
TEXT_BYTES = 64
# Smaller tables are not cut, larger ones so that every core has a block.
LEAST_BLOCK_ROWS = 100_000
# Upper bound on the number of blocks: what the one-task window over per-block rows has to sort.
MAX_BLOCKS = 10_000_000
# How much larger than wanted a block may get.
MAX_SPREAD = 4
# Broadcast a per-block table only up to this many rows; beyond it the join is left to Spark.
BROADCAST_ROWS = 100_000
# Broadcast a table whose size was counted only up to this.
BROADCAST_BYTES = 8 * 1024 * 1024

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def as_list(names: str | Sequence[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def fixed_width(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def scale_of(field: T.StructField) -> Column | None:
    """A column as whole numbers in the same order, if its type has that."""
    value = F.col(field.name)
    if isinstance(field.dataType, _INTEGRAL):
        return value.cast("long")
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(field.dataType, T.TimestampNTZType):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, value)
    return None


@dataclass(frozen=True)
class OrderSpan:
    """Row count and range of an order, from one pass over its leading column alone.

    Measure it on the base table and hand it on when the table to be ordered is an expensive
    derivation: a span that is too wide only makes blocks smaller.
    """

    rows: int
    low: int | None = None
    high: int | None = None
    nulls: int = 0

    @classmethod
    def measure(cls, df: DataFrame, order_by: str | Sequence[str]) -> OrderSpan:
        order = as_list(order_by)
        value = scale_of(df.schema[order[0]])
        if value is None:
            return cls(rows=df.count())
        row = df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.count_if(value.isNull()).alias("nulls"),
        ).first()
        return cls(row["rows"], row["low"], row["high"], row["nulls"])

    @classmethod
    def measure_all(cls, frames: Sequence[DataFrame], lead: str) -> list[OrderSpan]:
        """The spans of several tables along a column they share, in one job."""
        values = [scale_of(frame.schema[lead]) for frame in frames]
        if any(value is None for value in values):
            return [cls.measure(frame, lead) for frame in frames]
        found = _tagged(frames, values).groupBy("__table").agg(
            F.count(F.lit(1)).alias("rows"), F.min("__value").alias("low"), F.max("__value").alias("high"),
            F.count_if(F.col("__value").isNull()).alias("nulls"),
        )
        by_table = {r["__table"]: cls(r["rows"], r["low"], r["high"], r["nulls"]) for r in found.collect()}
        return [by_table.get(i, cls(0)) for i in range(len(frames))]

    def union(self, other: OrderSpan) -> OrderSpan:
        """The span to cut two tables by when their blocks have to line up."""
        nulls, rows = self.nulls + other.nulls, max(self.rows, other.rows)
        known = [s for s in (self, other) if s.low is not None]
        if not known:
            return OrderSpan(rows, None, None, nulls)
        return OrderSpan(rows, min(s.low for s in known), max(s.high for s in known), nulls)

    def block_rows(self, rows_per_block: int) -> int:
        return max(rows_per_block, math.ceil(self.rows / MAX_BLOCKS), 1)

    def too_large(self, rows_per_block: int) -> bool:
        return self.rows > self.block_rows(rows_per_block)

    @property
    def _halvings(self) -> int:
        """How often to halve values so that their differences fit a long: once, if at all."""
        return 1 if self.high - self.low >= 2**63 - 1 else 0

    def _width_and_extent(self, rows_per_block: int) -> tuple[int, int]:
        extent = (self.high >> self._halvings) - (self.low >> self._halvings) + 1
        wanted = -(-extent * self.block_rows(rows_per_block) // max(self.rows, 1))
        return min(max(1, wanted), 2**63 - 1), extent

    def block_count(self, rows_per_block: int) -> int:
        width, extent = self._width_and_extent(rows_per_block)
        return -(-extent // width) + 1

    def block_of(self, value: Column, rows_per_block: int) -> Column:
        """Block 0 for NULL, then ascending from 1. Values outside a span measured elsewhere belong to
        its first or last block."""
        width, _ = self._width_and_extent(rows_per_block)
        inside = F.least(F.greatest(value, F.lit(self.low).cast("long")), F.lit(self.high).cast("long"))
        halved = F.shiftright(inside, self._halvings) - F.lit(self.low >> self._halvings).cast("long")
        block = F.call_function("div", halved, F.lit(width).cast("long")) + 1
        # Never NULL, and known not to be: joins on it then add no filters below the shuffle.
        return F.coalesce(F.when(value.isNull(), F.lit(0)).otherwise(block).cast("long"), F.lit(0).cast("long"))


def rows_for(df: DataFrame, rows: int, rows_per_block: int | None = None) -> int:
    """Rows per block of a table of ``rows`` rows: as given, or by the bytes of a row and the cores at hand."""
    if rows_per_block is not None:
        return rows_per_block
    width = sum(8 if fixed_width(f.dataType) else TEXT_BYTES for f in df.schema)
    by_bytes = max(1, min(ROWS_PER_BLOCK, BLOCK_BYTES // max(width, 1)))
    by_cores = math.ceil(rows / df.sparkSession.sparkContext.defaultParallelism)
    return min(by_bytes, max(LEAST_BLOCK_ROWS, by_cores))


def _tagged(frames: Sequence[DataFrame], values: Sequence[Column]) -> DataFrame:
    """One column of each table, with the number of the table."""
    parts = [f.select(F.lit(i).alias("__table"), v.alias("__value")) for i, (f, v) in enumerate(zip(frames, values))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def cuts_evenly(df: DataFrame | Sequence[DataFrame], order: list[str], span: OrderSpan, rows_per_block: int) -> bool:
    """Whether arithmetic blocks of the leading column stay within MAX_SPREAD of the wanted size, by count, in
    the table or in each of several, in one job."""
    frames = [df] if isinstance(df, DataFrame) else list(df)
    values = [scale_of(frame.schema[order[0]]) for frame in frames]
    if span.low is None or any(value is None for value in values):
        return False
    blocks = _tagged(frames, [span.block_of(value, rows_per_block) for value in values])
    sizes = blocks.groupBy("__table", "__value").agg(F.count(F.lit(1)).alias("__rows"))
    largest = sizes.agg(F.max("__rows")).first()[0]
    return (largest or 0) <= MAX_SPREAD * span.block_rows(rows_per_block)


@dataclass(frozen=True)
class BlockedTable:
    """A table with its block column. Rows of keys that fit one task are all in block -1."""

    frame: DataFrame
    keys: list[str]
    carry_rows: int  # upper bound of (key, block) pairs that hand a value on

    def within_block(self, order: list[str]) -> WindowSpec:
        return Window.partitionBy(*self.keys, BLOCK).orderBy(*order)

    def before_block(self) -> WindowSpec:
        return (
            Window.partitionBy(*self.keys)
            .orderBy(BLOCK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )

    def split_rows(self) -> DataFrame:
        return self.frame.where(F.col(BLOCK) >= 0) if self.keys else self.frame

    def attach(self, carry: DataFrame) -> DataFrame:
        """Join a one-row-per-(key, block) table to the rows of that block."""
        renamed = carry.select(
            *[F.col(name).alias(f"__carry_{name}") for name in [*self.keys, BLOCK]],
            *[name for name in carry.columns if name not in (*self.keys, BLOCK)],
        )
        same = F.col(BLOCK) == F.col(f"__carry_{BLOCK}")
        for name in self.keys:
            same = same & self.frame[name].eqNullSafe(F.col(f"__carry_{name}"))
        # Fixed-width columns make the row bound a size bound. Text has no such bound, so there the
        # choice is left to Spark, which knows the size by then; a sort-merge join would take the
        # partitioning and order the rows have already.
        fixed = all(fixed_width(f.dataType) for f in carry.schema if f.name not in self.keys)
        side = F.broadcast(renamed) if fixed and self.carry_rows <= BROADCAST_ROWS else renamed
        return self.frame.join(side, same, "left").drop(
            *[f"__carry_{name}" for name in [*self.keys, BLOCK]]
        )

    def with_frame(self, frame: DataFrame) -> BlockedTable:
        return BlockedTable(frame, self.keys, self.carry_rows)


@dataclass(frozen=True)
class HotKeys:
    """Keys above a size, in a written table."""

    frame: DataFrame
    rows: int
    bytes: int  # counted over the rows

    def side(self) -> DataFrame:
        """For a join: broadcast if its counted size allows, else left to Spark."""
        return F.broadcast(self.frame) if self.bytes <= BROADCAST_BYTES else self.frame


def hot_keys(df: DataFrame, keys: list[str], more_than: int) -> HotKeys:
    """Keys with more than ``more_than`` rows.

    Counting combines map-side. What is found is written and never collected: there are at most rows / more_than
    of them, which on a large table is many. The driver learns their number and size only. The table belongs to the
    open ``scratch_scope``, if any, since the result reads it.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    found = counted.where(F.col("__rows") > more_than).drop("__rows")
    path = scratch_path(df.sparkSession, "hot-keys")
    found.write.parquet(path)
    stored = df.sparkSession.read.schema(found.schema).parquet(path)
    widths = [F.lit(16) if fixed_width(df.schema[k].dataType) else 16 + F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys]
    size = stored.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(sum(widths, F.lit(0))), F.lit(0)).alias("bytes")).first()
    return HotKeys(stored, size["rows"], size["bytes"])


def cut(
    df: DataFrame,
    lead: str,
    keys: list[str],
    span: OrderSpan,
    rows_per_block: int,
) -> BlockedTable | None:
    """Add the block column; None if every group already fits one task.

    ``span`` has to cut evenly. With ``keys`` only hot keys are split.
    """
    if not span.too_large(rows_per_block):
        return None
    block = span.block_of(scale_of(df.schema[lead]), rows_per_block)
    blocks = span.block_count(rows_per_block)
    if not keys:
        return BlockedTable(df.withColumn(BLOCK, block), [], blocks)
    hot = hot_keys(df, keys, span.block_rows(rows_per_block))
    if not hot.rows:
        return None
    marks = replace(hot, frame=hot.frame.select(*[F.col(name).alias(f"__hot_{name}") for name in keys], F.lit(True).alias("__hot")))
    same = F.lit(True)
    for name in keys:
        same = same & df[name].eqNullSafe(F.col(f"__hot_{name}"))
    frame = (
        df.join(marks.side(), same, "left")
        .withColumn(BLOCK, F.when(F.col("__hot"), block).otherwise(F.lit(-1)))
        .drop("__hot", *[f"__hot_{name}" for name in keys])
    )
    return BlockedTable(frame, keys, hot.rows * blocks)
