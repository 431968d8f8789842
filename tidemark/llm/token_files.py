"""Token-ID output in patched frame-of-reference blocks.

Ids are cut into blocks of ``BLOCK`` ids. A block stores its minimum, and of each id the difference to it in as
many bits as nine tenths of the differences need; the ids that need more are exceptions, stored whole with
their places. A segment is a header, the index of its documents (lengths), the index of its blocks (minimum,
width, number of exceptions, place of its bits), the packed bits and the exceptions; it decodes on its own.

Documents are range partitioned and sorted by ``doc_id``, tokenized once, and written as segments of bounded size
(one binary value a row in Parquet files, so any store Spark writes to holds them). Places of documents in the
whole sequence come from the files: sums per segment, per part, then per document.

Defined results: a null or empty text is its end id alone. A null ``doc_id`` comes first. Rows of one ``doc_id``
stand in the order of their texts' hashes. An empty table writes no segment. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_ROWS, job_settings, slices

BLOCK = 256
PERCENTILE = 90
END = 0
# Ids of a segment, unless a single document has more.
SEGMENT_IDS = 1_000_000
_MAGIC = b"PFR1"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1))) + 1, 0).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of 64-bit words."""
    words = np.zeros((BLOCK * width // 64, len(values)), dtype=np.uint64)
    columns = np.ascontiguousarray(values.T)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        column = columns[i].astype(np.uint64)
        words[word] |= column << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= column >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T)
    values = np.empty((BLOCK, len(words)), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        value = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | columns[word + 1] << np.uint64(64 - shift)
        values[i] = value & mask
    return np.ascontiguousarray(values.T)


def encode(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """A sequence of unsigned 32-bit ids as one self-contained value."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    padded = np.full(n_blocks * BLOCK, ids[-1] if n else 0, dtype=np.uint32)
    padded[:n] = ids
    blocks = padded.reshape(n_blocks, BLOCK)
    low = blocks.min(axis=1) if n_blocks else np.zeros(0, dtype=np.uint32)
    over = blocks - low[:, None]
    place = -(-BLOCK * percentile // 100) - 1
    widths = _bits(np.partition(over, place, axis=1)[:, place]) if n_blocks else np.zeros(0, dtype=np.int64)
    outside = over > ((np.int64(1) << widths) - 1).astype(np.uint32)[:, None]
    starts = np.zeros(n_blocks + 1, dtype=np.int64)
    np.cumsum(widths * (BLOCK // 64), out=starts[1:])
    packed = np.zeros(starts[-1], dtype=np.uint64)
    inside = over
    inside[outside] = 0
    for width in np.unique(widths[widths > 0]).tolist():
        mine = np.flatnonzero(widths == width)
        at = starts[mine][:, None] + np.arange(width * BLOCK // 64)
        packed[at] = _pack(inside[mine], width)
    where = np.nonzero(outside)
    return b"".join(
        (
            _MAGIC,
            struct.pack("<IIII", n, n_blocks, int(starts[-1]), len(where[0])),
            low.astype("<u4").tobytes(),
            widths.astype("u1").tobytes(),
            outside.sum(axis=1).astype("<u2").tobytes(),
            starts[:-1].astype("<u4").tobytes(),
            packed.astype("<u8").tobytes(),
            where[1].astype("u1").tobytes(),
            blocks[where].astype("<u4").tobytes(),
        )
    )


def decode(data: bytes) -> np.ndarray:
    """The ids of :func:`encode`, as unsigned 32-bit values."""
    if data[:4] != _MAGIC:
        raise ValueError("not a token segment")
    n, n_blocks, n_words, n_out = struct.unpack_from("<IIII", data, 4)
    at = 20

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(data, dtype=kind, count=count, offset=at)
        at += values.nbytes
        return values

    low, widths, exceptions = take("<u4", n_blocks), take("u1", n_blocks), take("<u2", n_blocks)
    starts, packed = take("<u4", n_blocks).astype(np.int64), take("<u8", n_words)
    places, values = take("u1", n_out), take("<u4", n_out)
    blocks = np.zeros((n_blocks, BLOCK), dtype=np.uint64)
    for width in np.unique(widths[widths > 0]).tolist():
        mine = np.flatnonzero(widths == width)
        at_words = starts[mine][:, None] + np.arange(width * BLOCK // 64)
        blocks[mine] = _unpack(packed[at_words], width)
    blocks += low[:, None].astype(np.uint64)
    blocks[np.repeat(np.arange(n_blocks), exceptions), places] = values
    return blocks.reshape(-1)[:n].astype("<u4")


_SEGMENT = "part int, segment int, n_docs long, n_tokens long, doc_ids binary, null_ids binary, lengths binary, ids binary"
_SEGMENT_ARROW = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
     ("doc_ids", pa.binary()), ("null_ids", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary())]
)


def _segments(tokenizer: str, end: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from tidemark.llm.tokens import encoder

        encode_texts, last = encoder(tokenizer).ids, struct.pack("<I", end)
        part, made = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        ids: list[bytes] = []
        waiting = 0

        def emit() -> pa.RecordBatch:
            nonlocal docs, ids, waiting, made
            lengths = np.array([len(x) // 4 for x in ids], dtype="<i8")
            data = np.frombuffer(b"".join(ids), dtype="<u4")
            row = [
                part, made, len(docs), len(data),
                np.array([d or 0 for d in docs], dtype="<i8").tobytes(),
                np.packbits([d is None for d in docs]).tobytes(), lengths.tobytes(), encode(data),
            ]
            docs, ids, waiting, made = [], [], 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SEGMENT_ARROW)], schema=_SEGMENT_ARROW)

        for batch in slices(batches, SLICE_ROWS):
            for doc, got in zip(batch.column(0).to_pylist(), encode_texts(batch.column(1).to_pylist())):
                if docs and waiting + len(got) // 4 + 1 > most:
                    yield emit()
                docs.append(doc)
                ids.append(got + last)
                waiting += len(got) // 4 + 1
        if docs:
            yield emit()

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of all documents under ``path``, in ascending order of ``doc_id``."""
    order = [F.col("doc_id").asc_nulls_first(), "tie"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    with job_settings(docs.sparkSession):
        ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
        ranged.mapInArrow(_segments(tokenizer, end, segment_ids), _SEGMENT).write.parquet(path)


_READ = "part int, segment int, place int, doc_id long, before long, n_tokens long, ids_crc32 long"
_READ_ARROW = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()),
     ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        row = batch.to_pylist()[0]
        n = row["n_docs"]
        lengths = np.frombuffer(row["lengths"], dtype="<i8")
        ends = np.cumsum(lengths)
        data = decode(row["ids"]).tobytes()
        crcs = [zlib.crc32(memoryview(data)[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lengths.tolist())]
        nulls = np.unpackbits(np.frombuffer(row["null_ids"], dtype=np.uint8), count=n).astype(bool)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["segment"], np.int32)),
                pa.array(np.arange(n, dtype=np.int32)), pa.array(np.frombuffer(row["doc_ids"], dtype="<i8"), mask=nulls),
                pa.array(ends - lengths), pa.array(lengths.astype(np.int64)), pa.array(crcs, pa.int64()),
            ],
            schema=_READ_ARROW,
        )


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files, as decoded from them.

    ``start`` needs the ids of all parts before: one row per part is summed in one task, segments within parts.
    """
    files = spark.read.schema(_SEGMENT).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    parts = sizes.select("part", (F.sum("part_tokens").over(Window.orderBy("part")) - F.col("part_tokens")).alias("part_start"))
    in_part = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_tokens")
    starts = files.select("part", "segment", "n_tokens", in_part.alias("segment_start")).join(parts, "part")
    starts = starts.select("part", "segment", (F.col("segment_start") + F.col("part_start")).alias("base"))
    rows = files.mapInArrow(_documents, _READ).join(starts, ["part", "segment"])
    return rows.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
