"""Line dedup: hashes of lines are range partitioned with a secondary sort, first occurrences are streamed, and
documents get a compressed bitmap of the lines they keep. (Between tasks the places of lines that go travel, a list for each
text that loses any; the bitmap is made where the text is cut.)

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least ``least`` code points
found in two or more documents lose all their lines except in the smallest ``doc_id`` that holds them.

* Only 128-bit hashes of keys and places travel, never text.
* The sort order is (hash, doc, row, line), and ranges are cut in that whole order: a line that a third of all
  documents share is spread over as many tasks as its rows need. Each task streams its range and notes the first
  document of each hash; a hash that crosses ranges is the first or the last of its ranges, so two rows for each
  range are enough to correct it. They are broadcast: at most twice the number of shuffle partitions.
* The sorted table is written, since cut points are sampled and a lost executor must not move them.

Defined results: a null or empty text is one empty line, which stays. A null ``doc_id`` is a document that
comes before all others. Rows with the same ``doc_id`` are one document: none of them drops a line that the
document is first to hold. Very long texts are split whole, one at a time. An empty table gives no rows. Other columns are not read, or carried by ``clean``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, Scratch, per_slice, slices

LEAST_CHARS = 10
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_LINES = "h1 long, h2 long, doc long, row long, line int"
_LINES_ARROW = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("line", pa.int32())])
_MARKED = "part int, " + _LINES + ", first_doc long, first_null boolean"
_MARKED_ARROW = pa.schema([("part", pa.int32()), *_LINES_ARROW, ("first_doc", pa.int64()), ("first_null", pa.bool_())])


def _keys(least: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        digest = xxhash.xxh3_128_digest
        hashes, docs, rows, lines = [], [], [], []
        for doc, row, text in zip(*(c.to_pylist() for c in batch.columns)):
            for i, line in enumerate((text or "").split("\n")):
                key = line.strip(SPACES)
                if len(key) >= least:
                    hashes.append(digest(key.translate(_FOLD).encode("utf-8", "surrogatepass")))
                    docs.append(doc)
                    rows.append(row)
                    lines.append(i)
        pair = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
        columns = [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(docs, pa.int64()), pa.array(rows, pa.int64()), pa.array(lines, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, schema=_LINES_ARROW)

    return per_slice(run)


def _stream_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in sorted order, each with the first document that this task has seen for its hash."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    last: tuple[int, int] | None = None
    first_doc: int | None = None
    for batch in slices(batches, 50_000):
        h1, h2 = (batch.column(i).to_numpy() for i in (0, 1))
        starts = np.ones(len(h1), dtype=bool)
        starts[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = last == (int(h1[0]), int(h2[0]))
        starts[0] = not goes_on
        docs = batch.column(2)
        own = docs.take(pa.array(np.flatnonzero(starts)))
        firsts = pa.concat_arrays([pa.array([first_doc if goes_on else None], pa.int64()), own])
        first = firsts.take(pa.array(np.cumsum(starts)))
        last, first_doc = (int(h1[-1]), int(h2[-1])), first[-1].as_py()
        nulls = first.is_null()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(h1), part, dtype=np.int32)), *batch.columns, first, nulls], schema=_MARKED_ARROW
        )


def _bitmap(n_lines: int, dropped) -> bytes:
    """A set bit for each line that stays."""
    keep = np.ones(n_lines, dtype=bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def _row_key():
    """Tells rows of one doc_id apart; equal rows have equal lines and so the same bitmap."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def bitmaps(docs: DataFrame, scratch: Scratch, least: int = LEAST_CHARS) -> DataFrame:
    """doc, row, dropped (places of lines that go), only for rows that lose a line."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), _row_key().alias("row"), "text")
    lines = rows.mapInArrow(_keys(least), _LINES)
    order = ["h1", "h2", F.col("doc").asc_nulls_first(), "row", "line"]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = scratch.write(ranged.mapInArrow(_stream_first, _MARKED), "lines")

    # The first and the last hash of each range, with the first document there: of the ranges that share a
    # hash the lowest has the first document.
    key = F.struct("h1", "h2")
    ends = marked.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    edges = ends.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias("k"))
    edges = edges.select("part", F.col("k")["h1"].alias("h1"), F.col("k")["h2"].alias("h2"))
    at_edges = marked.join(F.broadcast(edges), ["part", "h1", "h2"]).groupBy("h1", "h2", "part")
    first = F.struct(F.coalesce("first_doc", F.lit(0)).alias("first_doc"), "first_null")
    at_edges = at_edges.agg(F.min(first).alias("first"))
    crossing = at_edges.groupBy("h1", "h2").agg(F.min_by("first", "part").alias("first"), F.count("*").alias("ranges"))
    crossing = crossing.where("ranges > 1").select("h1", "h2", "first")

    joined = marked.join(F.broadcast(crossing), ["h1", "h2"], "left")
    true_null = F.coalesce(F.col("first")["first_null"], F.col("first_null"))
    true_doc = F.coalesce(F.col("first")["first_doc"], F.col("first_doc"))
    true_first = F.when(~true_null, true_doc)
    late = joined.where(~F.col("doc").eqNullSafe(true_first))
    return late.groupBy("doc", "row").agg(F.collect_set("line").alias("dropped"))


_KEPT = "doc_id long, n_lines long, n_dropped long, kept string, keep_bitmap binary"
_KEPT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string()), ("keep_bitmap", pa.binary())])


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, counts, drops, kept, maps = [], [], [], [], []
    for doc, text, dropped in zip(*(c.to_pylist() for c in batch.columns)):
        lines = (text or "").split("\n")
        gone = set(dropped or ())
        ids.append(doc)
        counts.append(len(lines))
        drops.append(len(gone))
        kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text or "")
        maps.append(_bitmap(len(lines), list(gone)))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(drops, pa.int64()), pa.array(kept, pa.string()), pa.array(maps, pa.binary())],
        schema=_KEPT_ARROW,
    )


def _with_dropped(docs: DataFrame, label: str, least: int) -> DataFrame:
    """``docs`` as one struct ``whole``, with the places of the lines that go (null if none)."""
    with Scratch(docs.sparkSession, label) as scratch:
        gone = scratch.write(bitmaps(docs, scratch, least), "dropped", keep=True)
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("whole")
    rows = docs.select(whole, F.col("doc_id").cast("long").alias("id"), _row_key().alias("key"))
    return rows.join(gone, F.col("id").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("row")), "left")


def dedup(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text that stays) and keep_bitmap, one row per row of ``docs``."""
    rows = _with_dropped(docs.select("doc_id", "text"), "line-dedup", least)
    return rows.select("id", F.col("whole")["text"].alias("text"), "dropped").mapInArrow(per_slice(_cut), _KEPT)


def _cleaned(at: int):
    """Rows (whole, dropped): the columns of ``whole``, the one at ``at`` without the lines that go."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole = batch.column(0)
        columns = whole.flatten()
        texts = []
        for text, dropped in zip(columns[at].to_pylist(), batch.column(1).to_pylist()):
            gone = set(dropped or ())
            texts.append("\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in gone) if gone else text)
        columns[at] = pa.array(texts, columns[at].type)
        return pa.RecordBatch.from_arrays(columns, names=[whole.type.field(i).name for i in range(whole.type.num_fields)])

    return per_slice(run)


def clean(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with its columns, less the lines that go. A text takes time in proportion to its lines."""
    rows = _with_dropped(docs, "line-clean", least).select("whole", "dropped")
    return rows.mapInArrow(_cleaned(docs.columns.index("text")), docs.schema)
