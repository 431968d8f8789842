"""Tables that are filled, filtered and joined along one ordering key, cut into blocks once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import (
    BLOCK,
    POSITION,
    BlockedTable,
    OrderSpan,
    cut,
    cuts_evenly,
    rows_for,
)
from tidemark.operators.fill import fill_by_block, forward_fill
from tidemark.operators.index import row_index
from tidemark.operators.reduce import first_per_key

MATCHED = "__matched"
_PLACE = "__place"


@dataclass(frozen=True)
class OrderedTable:
    """A table whose join key leads its order; the key alone is the order where it is unique.

    If the table is larger than one task should sort, it carries a block column: every fill
    then works block by block, and joining two tables that were cut alike uses (block, key), so
    that one shuffle per table serves all fills and the join.
    """

    frame: DataFrame
    key: str
    order: tuple[str, ...]
    span: OrderSpan
    rows_per_block: int
    blocked: BlockedTable | None = None
    shuffled: bool = False  # rows lie by block already

    @classmethod
    def align(
        cls,
        frames: Sequence[DataFrame],
        key: str,
        rows_per_block: int | None = None,
        spans: Sequence[OrderSpan] | None = None,
        orders: Sequence[Sequence[str]] | None = None,
    ) -> list[OrderedTable]:
        """Cut tables by one common span if any of them needs cutting.

        ``orders`` are the total orders of the tables, each led by the key. Measuring spans and counting
        blocks run jobs over the keys of ``frames``; hand in ``spans`` of base tables to save the first.

        A table whose keys give no even blocks is numbered once and cut by number instead; all
        its fills share that, but its join has to shuffle by key.
        """
        spans = spans or OrderSpan.measure_all(frames, key)
        shared = spans[0]
        for span in spans[1:]:
            shared = shared.union(span)
        if rows_per_block is None:
            rows_per_block = min(rows_for(frame, shared.rows) for frame in frames)
        large = shared.too_large(rows_per_block)
        alike = large and cuts_evenly(frames, [key], shared, rows_per_block)
        tables = []
        orders = [tuple(o) for o in orders] if orders else [(key,)] * len(frames)
        for frame, span, order in zip(frames, spans, orders):
            if order[0] != key:
                raise ValueError(f"the order of a table has to start with its key: {order}")
            blocked = None
            if alike:
                span = shared
                blocked = cut(frame, key, [], span, rows_per_block)
            elif span.too_large(rows_per_block):
                if not cuts_evenly(frame, [key], span, rows_per_block):
                    frame = row_index(frame, order, POSITION, span=span, rows_per_block=rows_per_block)
                    order, span = (POSITION,), OrderSpan(span.rows, 0, span.rows - 1)
                blocked = cut(frame, order[0], [], span, rows_per_block)
            cut_frame = blocked.frame if blocked else frame
            tables.append(cls(cut_frame, key, order, span, rows_per_block, blocked))
        return tables

    def apply(self, step: Callable[[DataFrame], DataFrame]) -> OrderedTable:
        """A row-wise step (filter, added or changed columns); it must keep key and block."""
        return replace(self, frame=step(self.frame))

    def fill(
        self,
        columns: Sequence[str],
        fill_when: Mapping[str, Column] | None = None,
        carry_when: Mapping[str, Column] | None = None,
        shared: Sequence[str] | None = None,
    ) -> OrderedTable:
        """As ``forward_fill`` along the order. ``shared`` names the columns that will be asked for: a cut table is
        then walked once for its rows and the last values of its blocks."""
        if not columns:
            return self
        if self.blocked is None:
            filled = forward_fill(
                self.frame,
                columns,
                self.order,
                fill_when=fill_when,
                span=self.span,
                rows_per_block=self.rows_per_block,
                carry_when=carry_when,
            )
        else:
            filled = fill_by_block(
                self.blocked.with_frame(self.frame), list(columns), list(self.order), fill_when or {}, carry_when or {},
                shared, lies_by_block=self.shuffled,
            )
        return replace(self, frame=filled, shuffled=self.blocked is not None)

    def first_per_key(self) -> OrderedTable:
        """The first row of each key. Where all rows of a key are in one block, on the layout of the fill."""
        rest = [c for c in self.order if c != self.key]
        if not rest:
            return self
        if self.blocked is None or self.order[0] != self.key:
            return replace(self, frame=first_per_key(self.frame.drop(BLOCK), self.key, rest), blocked=None, shuffled=False)
        window = Window.partitionBy(BLOCK, self.key).orderBy(*rest)
        rows = self._by_block().withColumn(_PLACE, F.row_number().over(window)).where(F.col(_PLACE) == 1)
        return replace(self, frame=rows.drop(_PLACE), shuffled=True)

    def join(self, other: OrderedTable, how: str = "inner") -> OrderedTable:
        """Join on the key. Columns of both sides must differ apart from it."""
        cut_alike = self.blocked and other.blocked and self.span == other.span
        if not cut_alike or not self.order[0] == other.order[0] == self.key:
            right = other.frame.drop(BLOCK, POSITION)
            return replace(self, frame=self.frame.join(right, self.key, how), shuffled=False)
        left, right = self._by_block(), other._by_block()
        return replace(self, frame=left.join(right, [BLOCK, self.key], how), shuffled=True)

    def _by_block(self) -> DataFrame:
        """Shuffle by block ahead of the join, so that a fill after it finds its rows in place.

        Only of use if a join on (block, key) accepts rows that lie by block alone.
        """
        conf = self.frame.sparkSession.conf
        needs_all_keys = conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true") == "true"
        return self.frame if self.shuffled or needs_all_keys else self.frame.repartition(BLOCK)

    def rows(self) -> DataFrame:
        return self.frame.drop(BLOCK, POSITION)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.frame.columns if c not in (BLOCK, POSITION)]
