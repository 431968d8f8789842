"""Ordered forward fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import (
    BLOCK,
    POSITION,
    BlockedTable,
    OrderSpan,
    as_list,
    cut,
    cuts_evenly,
    fixed_width,
    rows_for,
)
from tidemark.operators.index import row_index


def forward_fill(
    df: DataFrame,
    columns: str | Sequence[str],
    order_by: str | Sequence[str],
    partition_by: str | Sequence[str] | None = None,
    fill_when: Mapping[str, Column] | None = None,
    span: OrderSpan | None = None,
    rows_per_block: int | None = None,
    carry_when: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Replace NULLs by the latest earlier non-NULL value in ``order_by``; leading NULLs stay.

    ``order_by`` has to be a total order (within ``partition_by`` if given). ``fill_when`` narrows,
    per column, which rows are filled; rows left out keep their value, NULL included. ``carry_when`` narrows, per
    column, whose values are carried; a row left out takes the carried one.

    Up to ``rows_per_block`` rows (by default what the bytes of a row and the cores at hand give) one
    task sorts the table. Beyond that the table is cut into
    blocks: fill inside each block, take each block's last values, run those forward over the
    blocks (one row per block), and add them to the rows still empty. A keyed fill does this
    for keys above that size and leaves the other keys whole.
    """
    columns, order, keys = as_list(columns), as_list(order_by), as_list(partition_by)
    fill_when, carry_when = dict(fill_when or {}), dict(carry_when or {})
    names = df.columns
    span = span or OrderSpan.measure(df, order)
    rows_per_block = rows_for(df, span.rows, rows_per_block)
    if span.too_large(rows_per_block):
        if not cuts_evenly(df, order, span, rows_per_block):
            # No order column to cut by: number the rows once, then go by number.
            df = row_index(df, order, name=POSITION, rows_per_block=rows_per_block, span=span)
            order, span = [POSITION], OrderSpan(span.rows, 0, span.rows - 1)
        blocked = cut(df, order[0], keys, span, rows_per_block)
        if blocked is not None:
            return fill_by_block(blocked, columns, order, fill_when, carry_when).select(*names)
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    latest = {name: F.last(_carried(name, carry_when), ignorenulls=True).over(window) for name in columns}
    return df.select(*[_filled(n, latest, fill_when).alias(n) if n in latest else n for n in names])


def fill_by_block(
    blocked: BlockedTable,
    columns: list[str],
    order: list[str],
    fill_when: Mapping[str, Column],
    carry_when: Mapping[str, Column],
    shared: Sequence[str] | None = None,
    lies_by_block: bool = False,
) -> DataFrame:
    """Fill a cut table; the result keeps the block column and its partitioning and sort order.

    The last values of blocks come from a second, pruned pass over the input, which a table that is read from files
    can afford. An input that is costly to make is walked once instead: with ``shared``, the columns that will be asked
    for, rows are shuffled by block once, and both the rows and the last values are read from that one shuffle. It is
    one for Spark as long as both need the same columns, so all of ``shared`` are kept for both.
    """
    names, groups = blocked.frame.columns, [*blocked.keys, BLOCK]
    if shared is not None:
        # Spark drops a shuffle to a layout that rows have already; after a join it has to stay, or the join runs twice.
        parts = [int(blocked.frame.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1] if lies_by_block else []
        blocked = blocked.with_frame(blocked.frame.repartition(*parts, *groups))
    window = blocked.within_block(order)
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.frame.select(
        *names,
        *[F.last(_carried(n, carry_when), ignorenulls=True).over(upto).alias(f"__local_{n}") for n in columns],
        *([F.lead(F.lit(1)).over(window).isNull().alias("__ends")] if shared is not None else []),
    )
    if shared is None:
        tails = _tails(blocked, columns, order, carry_when)
    else:
        kept = [c for c in names if c in shared or c in groups or c in order]
        # Always true, which the optimizer can't know: no column of these is pruned on either way.
        local = local.where(F.xxhash64(*kept) >= F.lit(-(2**63)))
        split = F.when(F.col("__ends"), F.col(BLOCK) >= 0)
        tails = local.where(split).select(*groups, *[F.col(f"__local_{n}").alias(f"__tail_{n}") for n in columns])
        local = local.drop("__ends")
    carry = tails.select(
        *groups,
        *[
            F.last(f"__tail_{n}", ignorenulls=True).over(blocked.before_block()).alias(f"__before_{n}")
            for n in columns
        ],
    )
    joined = blocked.with_frame(local).attach(carry)
    latest = {n: F.coalesce(F.col(f"__local_{n}"), F.col(f"__before_{n}")) for n in columns}
    return joined.select(
        *[_filled(n, latest, fill_when).alias(n) if n in latest else n for n in names]
    )


def _tails(blocked: BlockedTable, columns: list[str], order: list[str], carry_when: Mapping[str, Column]) -> DataFrame:
    """Last valid value of each column in each block: a partial aggregate over a pruned pass, one row per block.

    Values of fixed width are held by a hash aggregate. Of a text only the place is, and the texts at these places
    are fetched in another pruned pass. (With several order columns a place has no fixed width; then a sort aggregate
    holds places and values.)
    """
    groups, rows = [*blocked.keys, BLOCK], blocked.split_rows()
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    kinds = {f.name: f.dataType for f in rows.schema}
    apart = [n for n in columns if not fixed_width(kinds[n])] if len(order) == 1 and fixed_width(kinds[order[0]]) else []

    def at(name: str) -> Column:
        return F.when(_carried(name, carry_when).isNotNull(), place)

    found = rows.groupBy(*groups).agg(
        *[F.max(at(n)).alias(f"__at_{n}") if n in apart else F.max_by(n, at(n)).alias(f"__tail_{n}") for n in columns]
    )
    if not apart:
        return found
    # Of all rows those at a last place; a list of its one value is no sort aggregate either.
    placed = blocked.with_frame(rows.select(*groups, place.alias("__place"), *[_carried(n, carry_when).alias(n) for n in apart]))
    hits = placed.attach(found.select(*groups, *[f"__at_{n}" for n in apart]))
    hits = hits.select(*groups, *[F.when(F.col("__place") == F.col(f"__at_{n}"), F.col(n)).alias(n) for n in apart])
    hits = hits.where(F.coalesce(*[F.col(n).cast("string") for n in apart]).isNotNull())
    texts = hits.groupBy(*groups).agg(*[F.get(F.collect_list(n), 0).alias(f"__tail_{n}") for n in apart])
    same = F.lit(True)
    for name in groups:
        same = same & found[name].eqNullSafe(texts[name])
    return found.join(texts, same, "left").select(*[found[g] for g in groups], *[f"__tail_{n}" for n in columns])


def _carried(name: str, carry_when: Mapping[str, Column]) -> Column:
    return F.when(carry_when[name], F.col(name)) if name in carry_when else F.col(name)


def _filled(name: str, latest: Mapping[str, Column], fill_when: Mapping[str, Column]) -> Column:
    # The latest valid value of a row that has a value is that value.
    if name not in fill_when:
        return latest[name]
    return F.when(fill_when[name], latest[name]).otherwise(F.col(name))
