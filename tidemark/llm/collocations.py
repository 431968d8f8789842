"""Collocations by an FM-index per shard: phrases of two to ``LONGEST`` words that stand out.

Texts are lower-cased (A-Z), split at punctuation and line ends into pieces, and these into words; a phrase lies within
a piece. Everything is counted by language.

1. Shards: every task indexes its pieces by language, some ``SHARD_WORDS`` words at a time. An index holds the
   Burrows-Wheeler transforms of the shard's word ids, forwards and backwards. Rows are sorted by their first words only,
   as deep as phrases are long, which is all that intervals of such phrases need. Ids are local to the shard.
2. A phrase is an interval of rows in both transforms. One step of backward search, for all phrases of a shard at once:
   the symbols that an interval of the forward transform holds are the words that stand before the phrase, how often each
   occurs is the count of the longer phrase, and ranks give its interval. The smaller symbols' counts place it in
   the backward interval, so that the next step can extend to the other side. Steps take turns.
3. Level by level, counts are summed over shards (by 128-bit keys of phrases; a shard gives a phrase one row), and only
   phrases that occur ``LEAST`` times in all go back to their shards to be extended: a phrase cannot occur more often
   than its parts. A longer phrase is also left out in the shard where the part on its other side isn't frequent.
4. A candidate's cuts are looked up among the frequent phrases, as its parts are frequent too. Its greatest extension
   to the left and right tells whether a longer candidate occurs as often as it does.

Memory follows the size of a shard, or the longest piece if that is longer; what a shard gets back is bounded by its
own number of words. A hot language is many shards; a hot phrase is one row a shard. Nothing is collected or broadcast
by this module, and each level is written, so that a lost executor repeats tasks of one level only.

Defined results: a null text is empty, a null language is ``und``. Rows count one by one, also with an equal or null
``doc_id``. Texts without words, and an empty table, add nothing. Texts are read whole, however long. Equal scores are
ordered by count, then by the phrase's bytes. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, job_settings, mix, per_slice, slices

LONGEST = 5
LEAST = 100
BEST = 2000
SHARD_WORDS = 1_500_000
# Parts of all keys that are summed one after the other, so that only a part's shuffle is on disk.
PARTS = 3

# Words, and what ends a piece, in UTF-8: all of these marks are single bytes.
_TOKEN = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]+|[.,;:!?\n\x0b\x0c\r]")
_ENDS = [bytes([c]) for c in b".,;:!?\n\x0b\x0c\r"]
_PACKED_BITS = 21

_END = np.zeros(1, dtype=np.int32)
_ODD = np.array([0x9E3779B97F4A7C15, 0xD1342543DE82EF95], dtype=np.uint64)

# A row is a shard, so Python gets one at a time.
ONE_BY_ONE = {"spark__sql__execution__arrow__maxRecordsPerBatch": "1"}


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``keys``, and the place of each among the different ones."""
    order = np.argsort(keys)
    held = keys[order]
    step = np.zeros(len(keys), dtype=np.int64)
    step[1:] = held[1:] != held[:-1]
    rank = np.empty(len(keys), dtype=np.int64)
    rank[order] = np.cumsum(step)
    return order, rank


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    moved = np.zeros(len(x), dtype=np.int64)
    moved[: max(len(x) - by, 0)] = x[by:]
    return moved


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The Burrows-Wheeler transform of ``ids`` (0 ends a piece), rows sorted by their first ``depth`` symbols or more."""
    rank, known = ids.astype(np.int64), 1
    if int(rank.max()) < 1 << _PACKED_BITS:
        # Three symbols fit one number.
        order, rank = _ranks((rank << 2 * _PACKED_BITS) | (_ahead(rank, 1) << _PACKED_BITS) | _ahead(rank, 2))
        known = 3
    while known < depth:
        order, rank = _ranks(rank * (int(rank.max()) + 1) + _ahead(rank, known))
        known *= 2
    return np.roll(ids, 1)[order].astype("<i4")


def last_to_first(bwt: np.ndarray) -> np.ndarray:
    """For each row, the row that its symbol begins."""
    row = np.empty(len(bwt), dtype=np.int64)
    row[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    return row


def extend(bwt: np.ndarray, rank: np.ndarray, low: np.ndarray, other: np.ndarray, size: np.ndarray):
    """One word more on the side that ``bwt`` holds: (phrase, symbol, low, other, size) of each extension; ``rank`` is its
    last-to-first mapping.

    ``low`` and ``other`` are where the intervals of the phrases begin in this transform and in the opposite one.
    """
    phrase = np.repeat(np.arange(len(low)), size)
    rows = np.arange(len(phrase)) - np.repeat(np.cumsum(size) - size, size) + low[phrase]
    symbol = bwt[rows].astype(np.int64)
    key = phrase * (int(bwt.max()) + 1) + symbol
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.append(starts, len(key)))
    first = order[starts]
    of = phrase[first]
    # Rows before the extension within its phrase are those of smaller symbols.
    within = starts - (np.cumsum(size) - size)[of]
    made = of, symbol[first], rank[rows[first]], other[of] + within, counts
    words = made[1] > 0
    return tuple(x[words] for x in made)


_SHARD = "shard long, lang string, n long, words binary, forward binary, backward binary"
_SHARD_ARROW = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("words", pa.binary()), ("forward", pa.binary()), ("backward", pa.binary())])
# The phrases of a shard, a value for each column: ids of their words, intervals, counts; and which words they use, with
# their keys.
# With them the texts and counts of those phrases they extend that this shard is to name.
_STATE = "shard long, lang string, ids binary, low binary, other binary, size binary, used binary, keys binary, phrases array<string>, counts array<long>"
_STATE_ARROW = pa.schema([
    ("shard", pa.int64()), ("lang", pa.string()), *[(c, pa.binary()) for c in ("ids", "low", "other", "size", "used", "keys")],
    ("phrases", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])


def _packed(x: np.ndarray) -> bytes:
    """Numbers under 2**32 byte by byte, all lowest bytes first: most higher ones are 0 and compress away."""
    return np.ascontiguousarray(x.astype("<u4").reshape(-1).view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def _shards(most: int, depth: int):
    """Rows (lang, text) of one task as shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 32
        vocabularies: dict[str, dict[bytes, int]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        held: dict[str, int] = {}

        def emit(lang: str) -> pa.RecordBatch | None:
            nonlocal made
            vocabulary, ids = vocabularies.pop(lang), np.concatenate([[0], *waiting.pop(lang), [0]]).astype(np.int64)
            held.pop(lang)
            # One end between pieces is enough.
            ids = ids[np.concatenate([[True], (ids[1:] > 0) | (ids[:-1] > 0)])]
            words = list(vocabulary)[len(_ENDS) :]
            if not words:
                return None
            # Frequent words get small ids.
            order = np.argsort(-np.bincount(ids, minlength=len(words) + 1)[1:], kind="stable")
            place = np.zeros(len(words) + 1, dtype=np.int64)
            place[order + 1] = np.arange(1, len(words) + 1)
            ids, words = place[ids], [words[k] for k in order.tolist()]
            made += 1
            values = b"\n".join(words), _packed(transform(ids, depth)), _packed(transform(ids[::-1], depth))
            columns = [pa.array([made]), pa.array([lang]), pa.array([int((ids > 0).sum())]), *[pa.array([v], pa.binary()) for v in values]]
            return pa.RecordBatch.from_arrays(columns, schema=_SHARD_ARROW)

        def fresh() -> dict[bytes, int]:
            """Numbers words as they come, from 1; ends are 0."""
            vocabulary = defaultdict(count(1).__next__)
            vocabulary.update(dict.fromkeys(_ENDS, 0))
            return vocabulary

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = _TOKEN.findall((text or "").encode("utf-8", "surrogatepass").lower())
                if not tokens:
                    continue
                if lang not in vocabularies:
                    vocabularies[lang] = fresh()
                numbers = vocabularies[lang]
                ids = np.fromiter(map(numbers.__getitem__, tokens), dtype=np.int32, count=len(tokens))
                waiting.setdefault(lang, []).extend((ids, _END))
                held[lang] = held.get(lang, 0) + len(ids)
                if held[lang] >= most and (made_batch := emit(lang)) is not None:
                    yield made_batch
        for lang in list(waiting):
            if (made_batch := emit(lang)) is not None:
                yield made_batch

    return run


def word_keys(words: bytes) -> np.ndarray:
    """Two 64-bit halves of each word's hash; id 0 is no word."""
    import xxhash

    digests = [xxhash.xxh3_128_digest(w) for w in words.split(b"\n")]
    return np.frombuffer(b"\0" * 16 + b"".join(digests), dtype="<u8").reshape(-1, 2)


def phrase_keys(lang: str, ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Two halves of a hash of each phrase; ``ids`` are places in ``keys``."""
    state = np.tile(word_keys(lang.encode("utf-8", "surrogatepass"))[1], (len(ids), 1))
    for column in ids.T:
        state = mix(state * _ODD + keys[column])
    return state


def _state(row: dict, ids, low, other, size, phrases=(), counts=()) -> pa.RecordBatch:
    used = np.unique(ids)
    values = [_packed(x) for x in (ids.T, low, other, size, used)] + [word_keys(row["words"])[used].tobytes()]
    columns = [pa.array([row["shard"]]), pa.array([row["lang"]]), *[pa.array([v], pa.binary()) for v in values]]
    columns += [pa.array([list(phrases)], pa.list_(pa.string())), pa.array([list(counts)], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, schema=_STATE_ARROW)


def _ids(data: bytes, length: int) -> np.ndarray:
    """The words of phrases, a row for each."""
    return _unpacked(data).reshape(length, -1).T


def _first(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (shard, lang, words, forward): the state of single words."""
    (row,) = batch.to_pylist()
    size = np.bincount(_unpacked(row["forward"]), minlength=row["words"].count(b"\n") + 2)
    low = (np.cumsum(size) - size)[1:]
    return _state(row, np.arange(1, len(size))[:, None], low, low, size[1:])


def _named(row: dict, length: int) -> tuple[list[str], list[int]]:
    """The texts and counts of the phrases that a shard is to name."""
    words = np.array([b"", *row["words"].split(b"\n")], dtype=object)
    chosen = [(i, f) for i, f in zip(row["chosen"], row["counts"])]
    ids = _ids(row["ids"], length)[np.array([i for i, _ in chosen], dtype=np.int64)]
    return [b" ".join(words[x]).decode("utf-8", "surrogatepass") for x in ids], [f for _, f in chosen]


def _next(length: int, leftwards: bool):
    """Rows (shard, lang, words, bwt, ids, low, other, size, alive, chosen, counts): the state of phrases of ``length`` words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        (row,) = batch.to_pylist()
        alive = np.sort(np.array(row["alive"], dtype=np.int64))
        bwt, ids = _unpacked(row["bwt"]), _ids(row["ids"], length - 1)[alive]
        low, other, size = (_unpacked(row[c])[alive] for c in ("low", "other", "size"))
        if not leftwards:
            low, other = other, low
        of, symbol, new_low, new_other, count = extend(bwt, last_to_first(bwt), low, other, size)
        # The part on the other side is the phrase whose interval holds the new one; it has to be frequent too.
        order = np.argsort(low)
        at = order[np.maximum(np.searchsorted(low[order], new_low, side="right") - 1, 0)]
        stays = (low[at] <= new_low) & (new_low < low[at] + size[at])
        of, symbol, new_low, new_other, count = (x[stays] for x in (of, symbol, new_low, new_other, count))
        symbol = symbol[:, None]
        longer = np.hstack([symbol, ids[of]] if leftwards else [ids[of], symbol])
        if not leftwards:
            new_low, new_other = new_other, new_low
        return _state(row, longer, new_low, new_other, count, *_named(row, length - 1))

    return run


_LOCAL = "shard long, i int, a long, b long, size long"
_LOCAL_ARROW = pa.schema([("shard", pa.int64()), ("i", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("size", pa.int64())])
_EMIT_ROWS = 100_000


def _phrases(length: int, part: int, parts: int):
    """Rows (shard, lang, ids, size, used, keys) as a row for each phrase of one part of all keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size, ids, used = _unpacked(row["size"]), _ids(row["ids"], length), _unpacked(row["used"])
                words = np.frombuffer(row["keys"], dtype="<u8").reshape(-1, 2)
                for start in range(0, len(size), _EMIT_ROWS):
                    places = np.searchsorted(used, ids[start : start + _EMIT_ROWS])
                    keys = phrase_keys(row["lang"], places, words)
                    own = np.flatnonzero(keys[:, 0] % np.uint64(parts) == part)
                    keys = keys[own].view(np.int64)
                    columns = [
                        pa.array(np.full(len(own), row["shard"], dtype=np.int64)), pa.array((own + start).astype(np.int32)),
                        pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(size[own + start]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=_LOCAL_ARROW)

    return run


_TEXT_ARROW = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _texts(length: int):
    """Rows (shard, lang, words, ids, chosen, counts): the texts of the chosen phrases with their counts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        (row,) = batch.to_pylist()
        texts, counts = _named(row, length)
        columns = [pa.array([row["lang"]] * len(texts), pa.string()), pa.array(np.full(len(texts), length, dtype=np.int32)), pa.array(texts, pa.string()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, schema=_TEXT_ARROW)

    return run


def frequent(docs: DataFrame, scratch: Scratch, least: int, longest: int, shard_words: int) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of up to ``longest`` words that occur ``least`` times; (lang, n)."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        return scratch.write(df, name, keep, codec="zstd")

    shards = stored(rows.mapInArrow(_shards(shard_words, longest), _SHARD), "shards")
    totals = stored(shards.groupBy("lang").agg(F.sum("n").alias("n")), "totals", keep=True)
    named: list[DataFrame] = []
    same = Window.partitionBy("a", "b")
    with job_settings(docs.sparkSession, **ONE_BY_ONE):
        state = stored(shards.select("shard", "lang", "words", "forward").mapInArrow(per_slice(_first), _STATE), "state1")
        for length in range(1, longest + 1):
            # Single words are many only once; phrases are summed a part of all keys at a time.
            parts = PARTS if length > 1 else 1
            found = []
            for part in range(parts):
                local = state.select("shard", "lang", "ids", "size", "used", "keys").mapInArrow(_phrases(length, part, parts), _LOCAL)
                local = local.withColumns({"f": F.sum("size").over(same), "namer": F.min("shard").over(same)}).where(F.col("f") >= least)
                # The first of the shards that have a phrase names it.
                names = F.col("namer") == F.col("shard")
                held = local.groupBy("shard").agg(
                    F.collect_list("i").alias("alive"), F.collect_list(F.when(names, F.struct("i", "f"))).alias("named")
                )
                found.append(stored(held, f"alive{length}-{part}"))
            alive = found[0]
            for more in found[1:]:
                alive = alive.union(more)
            lists = {c: F.flatten(F.collect_list(c)).alias(c) for c in ("alive", "named")}
            alive = alive.groupBy("shard").agg(*lists.values()).select("shard", "alive", F.col("named.i").alias("chosen"), F.col("named.f").alias("counts"))
            if length == longest:
                last = shards.select("shard", "lang", "words").join(state.select("shard", "ids"), "shard").join(alive.drop("alive"), "shard")
                last = last.select("shard", "lang", "words", "ids", "chosen", "counts").mapInArrow(per_slice(_texts(length)), "lang string, words int, phrase string, f long")
                named.append(stored(last, f"texts{length}", keep=True))
                break
            side = "forward" if length % 2 else "backward"
            index = shards.select("shard", "words", F.col(side).alias("bwt"))
            waiting = state.select("shard", "lang", "ids", "low", "other", "size").join(alive, "shard").join(index, "shard")
            waiting = waiting.select("shard", "lang", "words", "bwt", "ids", "low", "other", "size", "alive", "chosen", "counts")
            longer = stored(waiting.mapInArrow(per_slice(_next(length + 1, side == "forward")), _STATE), f"state{length + 1}")
            scratch.drop(state)
            texts = longer.select("lang", F.explode(F.arrays_zip("phrases", "counts")).alias("x"))
            texts = texts.select("lang", F.lit(length).alias("words"), F.col("x.phrases").alias("phrase"), F.col("x.counts").alias("f"))
            named.append(stored(texts, f"texts{length}", keep=True))
            state = longer
    whole = named[0]
    for more in named[1:]:
        whole = whole.union(more)
    return whole, totals


def mine(docs: DataFrame, least: int = LEAST, best: int = BEST, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``best`` collocations of each language."""
    with Scratch(docs.sparkSession, "phrases") as scratch:
        phrases, totals = frequent(docs, scratch, least, longest, shard_words)
    candidates = phrases.where("words > 1")
    # A longer phrase covers what it adds one word to; if a phrase further inside is as frequent, so is all between.
    inside = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    longer = candidates.where("words > 2").select("lang", F.explode(inside).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    candidates = candidates.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(100 * F.col("longer") >= 100 * F.col("f"), F.lit(False)))
    parts = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "words")
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(parts, 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    cuts = cuts.withColumn("score", F.expr("(1000 * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    weakest = F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
