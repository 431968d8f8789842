"""Exact top-k search by branch and bound over blocks of dimensions.

Vectors lie in vertical layout: a block is one binary value, all its first dimensions, then all its second ones.
The blocks of queries and of candidates are dealt to the cells of a grid, so that every query meets every candidate in
one cell. A cell reads its queries, then its candidates block by block. It grows the inner products over the first
blocks of dimensions; the rest of a product is at most the product of the two remaining lengths (Cauchy-Schwarz), so
a pair whose sum and bound stay under the query's k-th best so far is out, and the next dimensions are read for the
surviving pairs only. How many dimensions come before the first test follows from how many pairs have survived so far.
Scores are integers below 2^53, so doubles hold them exactly; where the lengths say that no sum can pass 2^22, singles
do. Bounds are rounded up.

A cell gives at most k rows a query; the k best of those are the answer. Work is queries times candidates by
definition. A task is one cell: memory is its queries, which have a limit, and one block of candidates, and no side
is broadcast or collected. A vector is copied once for each row or column of the grid, whose size follows from the
cores and the work and not from the number of shuffle partitions.

Defined results: vectors that are null, or hold a null, NaN or infinite component, take no part; nor do vectors
of another length than a query's take part for it. Ties go to the smaller ``vec_id``. Rows with a null ``vec_id``
take no part. Repeated ids are candidates of their own; a query leaves out every row of its own id. With
fewer than k candidates all are returned; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, job_settings

SCALE = 256
EVERY = 50
TOP = 5
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
DIMS = 16
# Components that a block holds at most (one vector at least), that candidates met at once do, and that the blocks of
# a task do that are not yet full. Parquet looks at the size of a page after a hundred values only, so blocks are small.
BLOCK_COMPONENTS, MET_COMPONENTS, WAITING_COMPONENTS = 1 << 16, 1 << 19, 1 << 23
# Components of the queries of a cell, and products of components that make a cell's work.
CELL_COMPONENTS, CELL_PRODUCTS = 1 << 24, 1 << 42
# Candidates that are scored without a bar at once, and surviving pairs that go on together.
AT_ONCE, PAIRS_AT_ONCE = 256, 1024
# Sums of integers up to here are exact in singles, and rounded by less than a half with a bound added.
SINGLES = 2.0**22
# A row is a block of up to half a megabyte, or one long vector, so Python gets few at a time.
FEW = {"spark__sql__execution__arrow__maxRecordsPerBatch": "8"}

_BLOCK = "asked boolean, deal long, low long, n int, dims int, ids binary, columns binary"
_BLOCK_ARROW = pa.schema([
    ("asked", pa.bool_()), ("deal", pa.int64()), ("low", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("columns", pa.binary()),
])


def _usable(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and floor(scale * x) of the vectors that take part, a matrix for each length."""
    batch = batch.filter(pc.and_(batch.column(0).is_valid(), batch.column(1).is_valid()))
    ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")  # nulls become NaN
    ends = np.cumsum(lengths, dtype=np.int64)
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        vectors = values[(ends[rows] - dims)[:, None] + np.arange(dims)]
        whole = np.isfinite(vectors).all(axis=1)
        yield ids[rows[whole]], np.floor(vectors[whole] * scale)


def _rows(most: int, dims: int, components: int = BLOCK_COMPONENTS) -> int:
    """Vectors of a block."""
    return max(1, min(most, components // max(1, dims)))


def _blocks(block_rows: int, every: int, scale: int):
    """Rows (id, vector) of one task as vertical blocks of equal dimensions: all as candidates, some also as queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # Blocks are dealt in turn, from another start in each task.
        deal = {asked: TaskContext.get().partitionId() * 0x9E3779B1 % 2**31 for asked in (False, True)}
        waiting: dict[tuple[bool, int], list] = {}
        held = 0

        def emit(asked: bool, dims: int, full: bool = False) -> Iterator[pa.RecordBatch]:
            """``full``: what fills no block waits on."""
            nonlocal held
            ids, vectors = (np.concatenate(x) for x in zip(*waiting.pop((asked, dims))))
            rows = _rows(block_rows, dims)
            end = len(ids) // rows * rows if full else len(ids)
            if end < len(ids):
                waiting[asked, dims] = [(ids[end:], vectors[end:])]
            held -= vectors[:end].size
            for start in range(0, end, rows):
                own = ids[start : start + rows]
                order = np.argsort(own, kind="stable")
                own, block = own[order], vectors[start : start + rows][order]
                kind = "<i2" if np.abs(block).max(initial=0) < 2**15 else "<f8"
                deal[asked] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([asked]), pa.array([deal[asked]]), pa.array([int(own[0])]), pa.array([len(own)], pa.int32()), pa.array([dims], pa.int32()),
                        pa.array([own.astype("<i8").tobytes()]), pa.array([np.ascontiguousarray(block.T, dtype=kind).tobytes()]),
                    ],
                    schema=_BLOCK_ARROW,
                )

        for batch in batches:
            for ids, vectors in _usable(batch, scale):
                query = ids % every == 0
                for asked, own, part in ((False, ids, vectors), (True, ids[query], vectors[query])):
                    if not len(own):
                        continue
                    key = (asked, part.shape[1])
                    waiting.setdefault(key, []).append((own, part))
                    held += part.size
                    if sum(len(x) for x, _ in waiting[key]) >= _rows(block_rows, key[1]):
                        yield from emit(*key, full=True)
            if held > WAITING_COMPONENTS:
                for key in list(waiting):
                    yield from emit(*key)
        for key in list(waiting):
            yield from emit(*key)

    return run


def _columns(parts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (a row for each dimension) of blocks of equal dimensions."""
    ids, columns = [], []
    for row in parts:
        kind = "<f8" if len(row["columns"]) == 8 * row["n"] * row["dims"] else "<i2"
        ids.append(np.frombuffer(row["ids"], dtype="<i8"))
        columns.append(np.frombuffer(row["columns"], dtype=kind).reshape(row["dims"], row["n"]))
    columns = np.concatenate(columns, axis=1)
    # Vectors without components all score 0.
    return np.concatenate(ids), columns if len(columns) else np.zeros((1, columns.shape[1]))


def _left(columns: np.ndarray, starts: list[int]) -> np.ndarray:
    """Length of what is left of each vector from each start on, rounded up."""
    squares, left = np.zeros(columns.shape[1]), np.zeros((len(starts), columns.shape[1]))
    for k in range(len(starts) - 2, -1, -1):
        for column in columns[starts[k] : starts[k + 1]]:
            squares += np.square(column, dtype="f8")
        left[k] = np.sqrt(squares) * (1 + 1e-6)
    return left


class _Cell:
    """The queries of a cell and the best of their candidates so far."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray, top: int, step: int, query_rows: int):
        self.ids, self.top, self.query_rows = ids, top, query_rows
        # Dimensions of most weight first.
        self.order = np.argsort([-np.square(column, dtype="f8").sum() for column in columns], kind="stable")
        self.starts = [*range(0, len(columns), step), len(columns)]
        self.stored = columns[self.order]
        self.columns: dict[str, np.ndarray] = {}
        self.rows: dict[str, np.ndarray] = {}
        self.left = _left(self.stored, self.starts)
        # The block of dimensions after which pairs are first held against the bar.
        self.first = max(1, len(self.starts) // 2)
        self.scores = np.full((len(ids), top), -np.inf)
        self.found = np.zeros((len(ids), top), dtype=np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates ``ids`` of the queries at ``rows``: the best of them and of those before stay."""
        if not len(rows):
            return
        met = np.unique(rows)
        at = np.concatenate([np.repeat(met, self.top), rows])
        ids = np.concatenate([self.found[met].ravel(), ids])
        scores = np.concatenate([self.scores[met].ravel(), scores])
        order = np.lexsort((ids, -scores, at))
        at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        kept = rank < self.top
        self.found[at[kept], rank[kept]], self.scores[at[kept], rank[kept]] = ids[order[kept]], scores[order[kept]]

    def meet(self, ids: np.ndarray, columns: np.ndarray) -> None:
        """All queries against a block of candidates, in the order of their ids."""
        order = np.argsort(ids, kind="stable")
        ids, columns = ids[order], columns[self.order][:, order]
        left = _left(columns, self.starts)
        longest = float(self.left[0].max() * left[0].max())
        kind = "f4" if longest < SINGLES else "f8"
        if kind not in self.rows:
            self.columns[kind] = self.stored.astype(kind, copy=False)
            self.rows[kind] = np.ascontiguousarray(self.columns[kind].T)
        columns, most = columns.astype(kind, copy=False), 0.0
        rows = np.ascontiguousarray(columns.T)
        for start in range(0, len(self.ids), self.query_rows):
            some = slice(start, start + self.query_rows)
            begin = 0
            if np.isneginf(self.scores[some, -1]).any():  # no bar yet: the first candidates make one
                begin = min(AT_ONCE, len(ids))
                self._all(some, ids[:begin], columns[:, :begin], kind)
            if begin < len(ids):
                most = max(most, self._bounded(some, ids[begin:], columns[:, begin:], rows[begin:], left[:, begin:], kind, longest))
        # The next dimensions cost some 1/256 of a survivor's for all pairs.
        if most > 1 / 256:
            self.first = min(self.first + 1, len(self.starts) - 1)
        elif most < 1 / 4096:
            self.first = max(self.first - 1, 1)

    def _bounded(self, some: slice, ids: np.ndarray, columns: np.ndarray, rows: np.ndarray, left: np.ndarray, kind: str, longest: float) -> float:
        """Branch and bound over blocks of dimensions; the share of pairs that the first test has left."""
        q, q_left, bar = self.columns[kind], self.left, self.scores[some, -1]
        to = self.starts[self.first]
        # What is left counts as one more dimension, so the product of both is the highest score that can come.
        most = np.vstack([q[:to, some], q_left[self.first, some].astype(kind)]).T @ np.vstack([columns[:to], left[self.first].astype(kind)])
        slack = 0.5 + 4 * (to + 2) * float(np.finfo(kind).eps) * longest
        alive = most >= (bar - slack).astype(kind)[:, None]
        pairs = np.count_nonzero(alive)
        if pairs * 16 > alive.size:  # no bar, or very many equals
            self._all(some, ids, columns, kind)
            return 0.0 if np.isneginf(bar).any() else pairs / alive.size
        i, j = np.divmod(np.flatnonzero(alive), len(ids))
        i += some.start
        other = self.ids[i] != ids[j]
        i, j = i[other], j[other]
        kept = [self._go_on(i[k : k + PAIRS_AT_ONCE], j[k : k + PAIRS_AT_ONCE], rows, left, kind) for k in range(0, len(i), PAIRS_AT_ONCE)]
        if kept:
            i, j, score = (np.concatenate(x) for x in zip(*kept))
            self.add(i, ids[j], score.astype("f8"))
        return pairs / alive.size

    def _go_on(self, i: np.ndarray, j: np.ndarray, rows: np.ndarray, left: np.ndarray, kind: str) -> tuple[np.ndarray, ...]:
        """Pairs that the first test has left, over the other dimensions: those that the bar leaves, and their scores."""
        score, start = np.zeros(len(i), dtype=kind), 0
        for k in range(min(self.first + 1, len(self.starts) - 1), len(self.starts)):
            part = slice(start, start := self.starts[k])
            score += np.einsum("pd,pd->p", self.rows[kind][i, part], rows[j, part])
            keep = score + self.left[k, i] * left[k, j] >= self.scores[i, -1] - 0.5
            i, j, score = i[keep], j[keep], score[keep]
        return i, j, score

    def _all(self, some: slice, ids: np.ndarray, columns: np.ndarray, kind: str) -> None:
        """Whole scores of all pairs; of those, what passes the worst of the best so far."""
        for start in range(0, len(ids), AT_ONCE):
            part = slice(start, start + AT_ONCE)
            own, score = ids[part], (self.columns[kind][:, some].T @ columns[:, part]).astype("f8")
            score[self.ids[some, None] == own] = -np.inf
            bar, last = self.scores[some, -1:], self.found[some, -1:]
            score[(score < bar) | (score == bar) & (own >= last)] = -np.inf
            if len(own) > self.top:
                cut = np.partition(score, len(own) - self.top, axis=1)[:, [len(own) - self.top]]
                i, j = np.nonzero((score >= cut) & (score > -np.inf))
            else:
                i, j = np.nonzero(score > -np.inf)
            self.add(i + some.start, own[j], score[i, j])

    def result(self) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(self.ids), QUERY_ROWS):
            some = slice(start, start + QUERY_ROWS)
            i, j = np.nonzero(self.scores[some] > -np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[some][i]), pa.array(self.found[some][i, j]), pa.array(self.scores[some][i, j].astype(np.int64))], schema=_FOUND_ARROW
            )


_FOUND = "query_id long, vec_id long, score long"
_FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _search(top: int, step: int, query_rows: int, block_rows: int):
    """Blocks sorted by cell and dimensions, queries before candidates, as the best of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell, queries, waiting = None, None, [], []

        def meet() -> None:
            nonlocal cell
            if not queries and cell is None or not waiting:
                waiting.clear()
                return
            if cell is None:
                cell = _Cell(*_columns(queries), top, step, query_rows)
                queries.clear()
            cell.meet(*_columns(waiting))
            waiting.clear()

        def end() -> Iterator[pa.RecordBatch]:
            nonlocal cell
            meet()
            if cell is not None:
                yield from cell.result()
            cell = None
            queries.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if at != (row["cell"], row["dims"]):
                    yield from end()
                    at = (row["cell"], row["dims"])
                if row["asked"]:
                    queries.append(row)
                    continue
                # Blocks of candidates wait for others, up to a bound.
                if waiting and sum(x["n"] for x in waiting) + row["n"] > _rows(block_rows, row["dims"], MET_COMPONENTS):
                    meet()
                waiting.append(row)
        yield from end()

    return run


def _grid(blocks: DataFrame) -> tuple[int, int]:
    """Groups of candidates and groups of queries: a cell for each core twice, more if its work or its queries pass a limit."""
    size = F.col("n").cast("double") * F.greatest("dims", F.lit(1))
    by_dims = blocks.groupBy("dims").agg(
        *(F.coalesce(F.sum(F.when(kind, what)), F.lit(0.0)).alias(name) for kind, what, name in (
            (~F.col("asked"), F.col("n").cast("double"), "rows"), (~F.col("asked"), F.lit(1.0), "row_blocks"), (~F.col("asked"), size, "row_size"),
            (F.col("asked"), F.lit(1.0), "query_blocks"), (F.col("asked"), size, "query_size"),
        ))
    )
    total = by_dims.agg(
        *(F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in ("row_blocks", "row_size", "query_blocks", "query_size")),
        F.coalesce(F.sum(F.col("rows") * F.col("query_size")), F.lit(0.0)).alias("products"),
    ).first()
    cells = max(2 * blocks.sparkSession.sparkContext.defaultParallelism, math.ceil(total.products / CELL_PRODUCTS))
    # What is copied and found together is least at this shape; what is found takes twice a query's own room.
    across = max(round(math.sqrt(3 * cells * total.query_size / max(1.0, total.row_size))), math.ceil(total.query_size / CELL_COMPONENTS))
    across = int(max(1, min(across, total.query_blocks)))
    return int(max(1, min(math.ceil(cells / across), total.row_blocks))), across


def search(vectors: DataFrame, top: int = TOP, every: int = EVERY, scale: int = SCALE,
           block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, dims: int = DIMS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` highest inner products of floor(scale * x) for each query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates are all rows but the query's own.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    with Scratch(vectors.sparkSession, "topk") as scratch:
        blocks = scratch.write(rows.mapInArrow(_blocks(block_rows, every, scale), _BLOCK), "blocks")
        # Every query block meets every candidate block: a query block goes to all cells of its column of the
        # grid, a candidate block to all cells of its row. Rows are blocks, not vectors.
        down, across = _grid(blocks)
        numbers = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
        own = F.pmod("deal", F.when(F.col("asked"), across).otherwise(down)).cast("int")
        cells = F.when(F.col("asked"), F.transform(numbers(down), lambda r: r * across + own)).otherwise(
            F.transform(numbers(across), lambda c: own * across + c))
        dealt = blocks.withColumn("cell", F.explode(cells)).repartitionById(down * across, F.col("cell"))
        dealt = dealt.sortWithinPartitions("cell", "dims", F.desc("asked"), "low", "deal")
        with job_settings(vectors.sparkSession, **FEW):
            found = scratch.write(dealt.mapInArrow(_search(top, dims, query_rows, block_rows), _FOUND), "found", keep=True)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
