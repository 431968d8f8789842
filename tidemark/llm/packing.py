"""Best-fit packing by hierarchical residual packing.

Texts are tokenized once; pieces (document, place, length, checksum) are written, and only lengths are packed.
They are dealt to tasks by a hash, a few bytes a piece, so that every task gets lengths of all kinds however the texts
lie. In the first round every task packs runs of its own pieces by best fit, longest first. Bins that are nearly
full are done. The others are items of the next round, in which a task gets the bins of several tasks: a tree
whose levels hold fewer and fewer tasks, until one task has all that is left or a round no longer joins
anything. Bins are items like pieces, so a round only adds (bin, parent bin, offset) rows, and a piece finds its
place by following its bins upwards.

Rounds stop when one joins less than one in ``STALLED`` items, or after ``MOST_ROUNDS``; no piece is lost then, but bins
that are left could still be joined: of the bins of the last round less than one in ``STALLED`` fewer, as a rule.

A task holds at most ``RUN_ITEMS`` items (of a few bytes) at a time, whatever the size of the corpus: a longer
partition is packed run by run. Every round is written, so a lost executor repeats tasks of one round only.

Defined results: a null text is empty and is its end id alone. Rows with equal ``doc_id`` are documents of their
own, told apart by nothing but their places. A text of more than ``size`` ids is cut into whole pieces of that
size and a rest; very long texts are tokenized whole, one at a time. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_ROWS, Scratch, slices

SIZE = 2048
END = 0
RUN_ITEMS = 200_000
FAN_IN = 8
# A bin with less room than this share of its size is done.
FULL_SHARE = 64
# A round that joins less than one in so many items is the last; so is the one of this number.
STALLED = 200
MOST_ROUNDS = 12

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, item long"
_PIECE_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("item", pa.int64())]
)


def _pieces(tokenizer: str, end: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from tidemark.llm.tokens import encoder

        encode, last, item = encoder(tokenizer).ids, struct.pack("<I", end), TaskContext.get().partitionId() << 40
        for batch in slices(batches, SLICE_ROWS):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                data = ids + last
                for k, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), item))
                    item += 1
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE_ARROW)]
                yield pa.RecordBatch.from_arrays(columns, schema=_PIECE_ARROW)

    return run


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and what each bin holds: longest items first, into the fullest bin with room.

    ``open_bins[r]`` are the bins with room r; a bit set over r finds the least room that is enough.
    """
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, used = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            where = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, where = size, len(used)
            used.append(0)
        bins[i], offsets[i] = where, size - room
        used[where] += length
        left = room - length
        if left:
            open_bins[left].append(where)
            rooms |= 1 << left
    return bins, offsets, np.array(used, dtype=np.int64)


_PLACED = "item long, parent long, offset long, held long, members long"
_PLACED_ARROW = pa.schema([("item", pa.int64()), ("parent", pa.int64()), ("offset", pa.int64()), ("held", pa.int64()), ("members", pa.int64())])


def _pack(size: int, number: int, run_items: int):
    """Items (item, length) to parents; parents are numbered by round, task and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = (number << 57) | (TaskContext.get().partitionId() << 34)
        waiting, count = [], 0

        def emit() -> pa.RecordBatch:
            nonlocal first, waiting, count
            table = pa.Table.from_batches(waiting).combine_chunks()
            lengths = table.column(1).to_numpy()
            bins, offsets, used = best_fit(lengths, size)
            members = np.bincount(bins, minlength=len(used))
            made = [table.column(0).combine_chunks(), pa.array(bins + first), pa.array(offsets), pa.array(used[bins]), pa.array(members[bins])]
            first += len(used)
            waiting, count = [], 0
            return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(made, _PLACED_ARROW)], schema=_PLACED_ARROW)

        for batch in slices(batches, run_items):
            if count and count + batch.num_rows > run_items:
                yield emit()
            waiting.append(batch)
            count += batch.num_rows
        if count:
            yield emit()

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, run_items: int = RUN_ITEMS,
         fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    with Scratch(docs.sparkSession, "pack") as scratch:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        pieces = scratch.write(rows.mapInArrow(_pieces(tokenizer, end, size), _PIECE), "pieces", keep=True)
        items = pieces.select("item", "length")
        # Where each piece stands: (item, node, offset), its node being its highest bin so far.
        rounds: list[DataFrame] = []
        tasks = items.rdd.getNumPartitions()
        items = items.repartition(tasks, "item")
        for number in range(MOST_ROUNDS):
            # What several tasks have left over meets in one: files are read together, nothing is shuffled.
            items = items.coalesce(tasks) if number else items
            placed = scratch.write(items.mapInArrow(_pack(size, number, run_items), _PLACED), f"round{number}")
            rounds.append(placed)
            # The first row of a bin, at offset 0, stands for it.
            bins = placed.where("offset = 0")
            loose = bins.where(F.col("held") * FULL_SHARE < size * (FULL_SHARE - 1))
            items = loose.select(F.col("parent").alias("item"), F.col("held").alias("length"))
            seen = placed.agg(F.count("*").alias("items"), F.count(F.when(F.col("members") > 1, 1)).alias("joined")).first()
            left = loose.count()
            little = number > 0 and seen["joined"] * STALLED < seen["items"]
            if little or left < 2 or (tasks == 1 and seen["items"] <= run_items):
                break
            # Never fewer tasks than runs: what can't be joined doesn't gather in one task.
            tasks = max(-(-tasks // fan_in), -(-left // run_items))
        nodes = pieces.select("item", F.col("item").alias("node"), F.lit(0).cast("long").alias("at"))
        for placed in rounds:
            step = placed.select(F.col("item").alias("child"), "parent", "offset")
            nodes = nodes.join(step, F.col("node") == F.col("child"), "left").select(
                "item", F.coalesce("parent", "node").alias("node"), (F.col("at") + F.coalesce("offset", F.lit(0))).alias("at")
            )
        places = scratch.write(nodes.select(F.col("item").alias("id"), F.col("node").alias("sequence_id"), F.col("at").alias("offset")), "places", keep=True)
    return pieces.join(places, F.col("item") == F.col("id")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
