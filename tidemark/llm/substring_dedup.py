"""Substring dedup by relative Lempel-Ziv parsing: documents are factored against indexed blocks of the corpus.

A phrase is ``WINDOW`` consecutive words. The reference is the whole corpus, cut into blocks around anchors: the
anchor of a phrase is the least hash among its runs of ``ANCHOR`` words, so equal phrases have equal anchors,
wherever they stand, and neighbouring phrases mostly share one. A block is an anchor and the phrases that stand
around one occurrence of it, as fingerprints.

1. Anchors are counted (map-side combined). What occurs once can't be in a repeated phrase and goes.
2. Blocks of repeated anchors are kept: document, place, fingerprints. Equal blocks are grouped for the first
   place of each; a passage that a third of all documents share is one row from here on.
3. Different blocks of one anchor are compared phrase by phrase for the first place of every phrase.
4. Each document is parsed greedily: at its first repeated phrase a factor copies from that phrase's first
   place in the corpus, and is extended while the next phrase continues the copy; where it ends, the next phrase,
   which crosses the factor's border, is looked up in the same way, and so on. Factors have at least ``WINDOW``
   words, and the words they cover go.

Phrases are compared by the 64-bit hash of the anchor, the place of the anchor in the phrase and 40 bits of the
whole phrase. What travels is hashes and places, and the texts once.

Defined results: a null text has no words. A text of fewer words than a phrase loses none. A null ``doc_id`` comes
before all others. Rows with the same ``doc_id`` are ordered by a hash of their texts; equal rows are one document
and keep the same words. Very long texts are read whole, slice by slice of the corpus. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Hashes, Scratch, mix, per_slice

WINDOW = 20
ANCHOR = 5
PRINT_BYTES = 5

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words: doubling, then the rest."""
    length, made = 1, mix(h + _GOLD)
    powers = {1: made}
    while length * 2 <= size:
        made = mix(made[: len(made) - length] * _GOLD + made[length:])
        length *= 2
        powers[length] = made
    at, whole, n = 0, np.zeros(max(len(h) - size + 1, 0), dtype=np.uint64), max(len(h) - size + 1, 0)
    for length in sorted(powers, reverse=True):
        if size & length:
            whole = mix(whole * _GOLD + powers[length][at : at + n])
            at += length
    return whole


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` neighbours, the first of equals; by doubling, then one overlap."""
    length, place = 1, np.arange(len(values))
    while length < width:
        step = min(length, width - length)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        length += step
    return place


def anchors(words: list[list[bytes]], hashes: Hashes, window: int, anchor: int, prints: bool = True):
    """Blocks of some documents: their numbers of blocks, then for each block the anchor hash, place of the first
    phrase, number of phrases and place of the anchor in the first; and the hashes of all phrases in turn."""
    sizes = np.array([len(w) for w in words])
    starts = np.append(0, np.cumsum(sizes))
    h = hashes.of([x for w in words for x in w])
    phrases_of = np.maximum(sizes - window + 1, 0)
    if not phrases_of.sum():
        return None
    doc = np.repeat(np.arange(len(words)), phrases_of)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(phrases_of) - phrases_of, phrases_of)
    begin = starts[doc] + at
    runs = _runs(h, anchor)
    place = _least(runs, window - anchor + 1)[begin]
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    counts = np.diff(np.append(first, len(doc)))
    made = _runs(h, window)[begin] if prints else None
    blocks_of = np.bincount(doc[first], minlength=len(words))
    return blocks_of, runs[place[first]], at[first], counts, place[first] - begin[first], made


_BLOCKS = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("lead", pa.int32()), ("prints", pa.binary())])
_BLOCKS_DDL = "anchor long, doc long, row long, start int, lead int, prints binary"


def _anchor_hashes(window: int, anchor: int):
    hashes = Hashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = anchors([_words(t) for t in batch.column(0).to_pylist()], hashes, window, anchor, prints=False)
        if found is None:
            return None
        return pa.RecordBatch.from_arrays([pa.array(found[1].astype(np.int64))], names=["anchor"])

    return per_slice(run)


def _blocks(window: int, anchor: int):
    """``lead`` is the place of the anchor in the block's first phrase."""
    hashes = Hashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = anchors([_words(t) for t in batch.column(2).to_pylist()], hashes, window, anchor)
        if found is None:
            return None
        blocks_of, hashed, first, counts, lead, phrases = found
        source = pa.array(np.repeat(np.arange(batch.num_rows), blocks_of))
        data = np.ascontiguousarray(phrases.astype("<u8").view("u1").reshape(-1, 8)[:, :PRINT_BYTES])
        ends = np.append(0, np.cumsum(counts * PRINT_BYTES)).astype(np.int32)
        prints = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        columns = [
            pa.array(hashed.astype(np.int64)), batch.column(0).take(source), batch.column(1).take(source),
            pa.array(first.astype(np.int32)), pa.array(lead.astype(np.int32)), prints,
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_BLOCKS)

    return per_slice(run)


_PHRASES = pa.schema(
    [("anchor", pa.int64()), ("at", pa.int32()), ("print", pa.int64()), ("known", pa.bool_()), ("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int32())]
)
_PHRASES_DDL = "anchor long, at int, print long, known boolean, doc long, row long, start int"


def _phrases(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Phrases of blocks (anchor, lead, prints, known, doc, row, start); ``at`` is the place of the anchor in the phrase."""
    prints = batch.column(2).to_pylist()
    counts = np.array([len(p) // PRINT_BYTES for p in prints])
    source = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts)
    wide = np.zeros((len(source), 8), dtype=np.uint8)
    wide[:, :PRINT_BYTES] = np.frombuffer(b"".join(prints), dtype=np.uint8).reshape(-1, PRINT_BYTES)
    lead, start = batch.column(1).to_numpy()[source], batch.column(6).to_numpy()[source]
    kept = pa.array(source)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(kept), pa.array((lead - place).astype(np.int32)), pa.array(wide.view("<i8").reshape(-1)),
            *[batch.column(k).take(kept) for k in (3, 4, 5)], pa.array((start + place).astype(np.int32)),
        ],
        schema=_PHRASES,
    )


def copies(docs: DataFrame, scratch: Scratch, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc, row and ``found``: for each stretch of repeated phrases its start, its number of phrases, and the
    document, row and place where those stand first."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text"
    )
    counted = keyed.select("text").mapInArrow(_anchor_hashes(window, anchor), "anchor long").groupBy("anchor").agg(F.count("*").alias("n"))
    repeated = scratch.write(counted.where("n > 1").select("anchor"), "repeated")
    blocks = scratch.write(keyed.mapInArrow(_blocks(window, anchor), _BLOCKS_DDL).join(repeated, "anchor"), "blocks")

    # The first place of each different block. Null documents come first; equal rows have equal places.
    place = F.struct(F.col("doc").isNotNull().alias("known"), "doc", "row", "start")
    block = ["anchor", "lead", "prints"]
    different = scratch.write(blocks.groupBy(*block).agg(F.min(place).alias("first")), "different")
    # Different blocks of one anchor: the first place of each phrase among them.
    phrase = ["anchor", "at", "print"]
    several = different.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    compared = different.join(several, "anchor").select(*block, "first.*")
    phrases = scratch.write(compared.mapInArrow(per_slice(_phrases, 5000), _PHRASES_DDL), "phrases")
    phrases = phrases.select(*phrase, place.alias("own"))
    firsts = phrases.groupBy(*phrase).agg(F.min("own").alias("source"), F.max("own").alias("last"))
    shared = phrases.join(firsts.where("source < last").drop("last"), phrase).where("source < own").select("own", "source")

    # Of a repeated block all phrases have an earlier place: its first one's. Of a first one, those found above.
    first = F.col("first")
    later = blocks.join(different, block).where(place > first)
    whole = later.select(
        "doc", "row", F.struct(F.col("start"), (F.length("prints") / PRINT_BYTES).cast("int").alias("n"), first["doc"].alias("from_doc"), first["row"].alias("from_row"), first["start"].alias("from_start")).alias("f"),
    )
    own, source = F.col("own"), F.col("source")
    single = shared.select(
        own["doc"].alias("doc"), own["row"].alias("row"),
        F.struct(own["start"].alias("start"), F.lit(1).alias("n"), source["doc"].alias("from_doc"), source["row"].alias("from_row"), source["start"].alias("from_start")).alias("f"),
    )
    return whole.union(single).groupBy("doc", "row").agg(F.collect_set("f").alias("found"))


def parse(found: list[tuple], window: int = WINDOW) -> list[tuple]:
    """Greedy factors (start, words, from_doc, from_row, from_start) of a document, from its repeated phrases:
    stretches (start, phrases, from_doc, from_row, from_start)."""
    factors: list[list] = []
    last: list | None = None
    for start, n, from_doc, from_row, from_start in sorted(found, key=lambda f: f[0]):
        if last and last[4] + start - last[0] == from_start and last[2] == from_doc and last[3] == from_row and start <= last[0] + last[1] - window + 1:
            last[1] = max(last[1], start + n - 1 + window - last[0])
        else:
            last = [start, n - 1 + window, from_doc, from_row, from_start]
            factors.append(last)
    return [tuple(f) for f in factors]


_FACTOR = "array<struct<start:int,words:int,from_doc:long,from_start:int>>"
_CUT_DDL = f"doc_id long, n_words long, n_removed long, kept string, factors {_FACTOR}"
_CUT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
     ("factors", pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("from_doc", pa.int64()), ("from_start", pa.int32())])))]
)


def _cut(window: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stretches = batch.column(2)
        flat = stretches.flatten()
        rows = list(zip(*(flat.field(c).to_pylist() for c in ("start", "n", "from_doc", "from_row", "from_start"))))
        counts = stretches.value_lengths().fill_null(0).to_pylist()
        sizes, removed, kept, factors, at = [], [], [], [], 0
        for text, n in zip(batch.column(1).to_pylist(), counts):
            words = _words(text)
            made = parse(rows[at : at + n], window) if n else []
            at += n
            left, end = words, 0
            if made:
                left = []
                for start, length, *_ in made:  # in the order of their starts
                    left += words[end:start]
                    end = max(end, start + length)
                left += words[end:]
            sizes.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left))
            factors.append([{"start": f[0], "words": f[1], "from_doc": f[2], "from_start": f[4]} for f in made])
        columns = [
            batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()), pa.array(factors, _CUT.field("factors").type),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_CUT)

    return per_slice(run)


def dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words that stay, joined by spaces) and factors."""
    docs = docs.select("doc_id", "text")
    with Scratch(docs.sparkSession, "substring") as scratch:
        found = scratch.write(copies(docs, scratch, window, anchor), "found", keep=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    same = F.col("id").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("row"))
    return rows.join(found, same, "left").select("id", "text", "found").mapInArrow(_cut(window), _CUT_DDL)
