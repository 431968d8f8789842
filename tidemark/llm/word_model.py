"""Quality classifier: an interpolated modified Kneser-Ney model of trusted words, and quantiles of perplexity.

Tokens are words (runs of letters and digits, in any script), single marks, and single characters of scripts that
are written without spaces; case counts. Tokens and n-grams are 64-bit hashes, so no vocabulary is held anywhere:
every table below grows with the text it is made from.

1. Trusted documents (labelled of good quality) are counted: sums per task, then per n-gram. One half of
   them, by a hash of the id, trains; the other half sets the thresholds, as texts that a model has seen are no
   measure of it.
2. Lower orders count the different left neighbours. Discounts come from the counts of counts of each order.
   An n-gram's hash is that of its context and its last token, so these two are what is shuffled and written.
3. Logarithms telescope: ln p of an n-gram is ln p of its suffix plus the back-off of its context, plus a correction
   if training has the n-gram. So a text's sum is a constant for each token and, for each n-gram of any order in it,
   a value of the model times the occurrences, once as target and once as context.
4. Each document's n-grams are counted within it. What a task has counted of some documents (a block, of about
   ``MOST_HELD`` n-grams) becomes a row per n-gram and occurrences, which lists the documents by two bytes each. These
   rows are shuffled by n-gram and joined to the model, which is written in buckets by n-gram once, and summed per
   block and document. The model holds each n-gram once, and a hot n-gram has a few rows a block however many documents
   have it (its salt). ``PASSES`` passes over as many parts of the documents keep a part's shuffle on disk only.
5. A document is kept if its perplexity is at most its language's ``QUANTILE`` of trusted documents: mean surprise
   less an allowance that shrinks with the root of the length, as short texts scatter. The quantile is read from
   a histogram in steps of a thousandth, over all trusted documents of the second half.
6. So is a limit of the share of n-grams that a text has had before: words repeated over and over have the
   perplexity of the same words in any order, so n-grams alone keep most of such texts.

Defined results: a null or empty text, or one of spaces, has no perplexity and is not kept. Languages (null is one)
with fewer than ``LEAST_TRUSTED`` such documents take the quantile of all. Without labels everything with text is
kept, without a perplexity. A document is trusted if all its labels say so. Repeated rows are judged alike; an
empty table gives no rows. Very long texts are scored whole. Other columns are not read, or carried by ``keep_good``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, job_settings, mix, slices

ORDER = 2
QUANTILE = 0.995
# Nats allowed to a text of one token.
SPREAD = 2.0
LEAST_TRUSTED = 20
# Few counts can give a discount of 0, by which what training does not have would be impossible.
LEAST_DISCOUNT = 0.1
PASSES = 6
# Parts of the highest order's n-grams that are given their probabilities one after the other.
PARTS = 4
# Keys that stand for documents themselves, so many that none is hot.
_MARKS = 4096
# A task hands on what it has counted when it holds so many n-grams.
MOST_HELD = 2_000_000
# Documents of a block: their numbers in it take two bytes.
_BLOCK = 1 << 16
# Rows of an Arrow batch that Python hands on.
_BATCH = 100_000
_STEPS = 1000
# Rows between Spark and Python are short here, but for texts.
_BATCHES = {"spark__sql__execution__arrow__maxRecordsPerBatch": "20000", "spark__sql__execution__arrow__maxBytesPerBatch": "4m"}

_START = np.uint64(0x51A7)
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
# Thai to Myanmar, Khmer, kana, Han and Hangul are taken by character.
_SCRIPTS = "฀-႟ក-៿぀-ヿ㐀-鿿가-힯\U00020000-\U0003ffff"
_TOKENS = re.compile(f"[{_SCRIPTS}]|\\w+|[^\\w\\s]").findall
# Kinds of characters: none of a token, a token of its own, one of these scripts, of words.
_SPACE, _MARK, _LONE, _WORD = range(4)
# Characters that are hashed at once, and characters of texts that are cut into tokens at once.
_WINDOW, _TEXTS = 1 << 18, 1 << 20


def tokens(text: str | None) -> list[str]:
    """What the tokens of a text are; ``_Hashes`` cuts many texts alike."""
    return _TOKENS(text or "")


@cache
def _kinds() -> np.ndarray:
    """Of every code point, as the expression of ``tokens`` takes it."""
    every = "".join(map(chr, range(0x110000)))
    made = np.full(len(every), _MARK, np.uint8)
    for pattern, kind in (("\\s+", _SPACE), ("\\w+", _WORD)):
        for found in re.finditer(pattern, every):
            made[found.start() : found.end()] = kind
    for found in re.finditer(f"[{_SCRIPTS}]+", every):
        part = made[found.start() : found.end()]
        part[:] = np.where(part == _WORD, _LONE, _MARK)
    return made


class _Hashes:
    """Of the tokens of texts, all at once: the sum of what each character gives at its place in the token."""

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All hashes, and the number of tokens of each text."""
        texts = [t or "" for t in texts]
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds = _kinds()[codes]
        starts = self._starts(kinds)
        sums = np.zeros(len(starts), np.uint64)
        for low in range(0, len(codes), _WINDOW):
            high = min(low + _WINDOW, len(codes))
            first = max(np.searchsorted(starts, low, "right") - 1, 0)
            own = starts[first : np.searchsorted(starts, high)]
            if not len(own):
                continue
            # The first token may have begun in a window before.
            cuts = np.maximum(own, low)
            begin = cuts[0]
            places = np.arange(begin, high) - np.repeat(own, np.diff(np.append(cuts, high)))
            given = mix((places.view(np.uint64) << np.uint64(21)) + codes[begin:high] + np.uint64(1))
            given[kinds[begin:high] == _SPACE] = 0
            sums[first : first + len(own)] += np.add.reduceat(given, cuts - begin)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        return mix(sums), np.diff(np.searchsorted(starts, ends), prepend=0)

    def _starts(self, kinds: np.ndarray) -> np.ndarray:
        word = kinds >= _LONE
        if not (kinds == _LONE).any():
            on = np.append(False, word[:-1])
        else:
            # A word takes all word characters after its first, of whatever script.
            here = np.arange(len(kinds))
            run = np.maximum.accumulate(np.where(word, 0, here + 1))
            begun = np.maximum.accumulate(np.where(kinds == _WORD, here, -1))
            on = np.append(-1, begun[:-1]) >= run
        return np.flatnonzero((kinds == _MARK) | (word & ~on))


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _xxhash64(values: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    x = (seed + (_P5 + np.uint64(8))) ^ (_rotated(values * _P2, 31) * _P1)
    x = _rotated(x, 27) * _P1 + _P4
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def joined(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The hashes of n-grams by their contexts and last tokens, as Spark's ``xxhash64`` of both gives them."""
    return _xxhash64(token, _xxhash64(context, np.uint64(42)))


class _Keys:
    """Of some texts: ``levels[k - 1]`` has the hashes of the k tokens from each place on; before each text are
    ``order`` - 1 starts. ``at`` has the places of the texts' tokens, ``counts`` their number in each text."""

    def __init__(self, texts: list[str | None], hashes: _Hashes, order: int):
        found, self.counts = hashes.of(texts)
        before = np.repeat(np.arange(1, len(texts) + 1) * (order - 1), self.counts)
        self.at = np.arange(len(found)) + before
        words = np.full(len(found) + len(texts) * (order - 1), _START)
        words[self.at] = found
        self.levels = [words]
        for k in range(2, order + 1):
            self.levels.append(joined(self.levels[-1][:-1], words[k - 1 :]))

    def each(self) -> Iterator[list[np.ndarray]]:
        """The levels of each text."""
        order, start = len(self.levels), 0
        for count in self.counts.tolist():
            end = start + count + order - 1
            yield [level[start : end - k] for k, level in enumerate(self.levels)]
            start = end


def keys(text: str | None, hashes: _Hashes, order: int) -> list[np.ndarray]:
    """For k from 1 to ``order``, the hashes of the k tokens up to each place; before a text are ``order`` - 1 starts."""
    return next(_Keys([text], hashes, order).each())


def _together(lengths: list[int]) -> Iterator[slice]:
    """Texts that are cut into tokens together: a long one alone."""
    first, size = 0, 0
    for i, n in enumerate(lengths):
        if i > first and size + n > _TEXTS:
            yield slice(first, i)
            first, size = i, 0
        size += n
    if first < len(lengths):
        yield slice(first, len(lengths))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _count(order: int):
    """For each order k from the highest to 2 the context c{k}; g1, the last token; n."""
    names = [*(f"c{k}" for k in range(order, 1, -1)), "g1"]

    def emit(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        _, first, n = np.unique(rows[:, 0], return_index=True, return_counts=True)
        columns = [_signed(np.ascontiguousarray(rows[first, i])) for i in range(1, len(names) + 1)]
        made = pa.RecordBatch.from_arrays([*columns, pa.array(n.astype(np.int64))], names=[*names, "n"])
        return slices([made], _BATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        held, size = [], 0
        for batch in slices(batches):
            texts = batch.column(0).to_pylist()
            for some in _together([len(t or "") for t in texts]):
                made = _Keys(texts[some], hashes, order)
                if len(made.at):
                    contexts = [made.levels[k - 2][made.at - k + 1] for k in range(order, 1, -1)]
                    held.append(np.stack([made.levels[-1][made.at - order + 1], *contexts, made.levels[0][made.at]], axis=1))
                    size += len(made.at)
            if size >= MOST_HELD:
                yield from emit(held)
                held, size = [], 0
        if held:
            yield from emit(held)

    return run, ", ".join(f"{name} long" for name in [*names, "n"])


def _gram(k: int) -> Column:
    """Of a row that has context c{k} and last token g1."""
    return F.xxhash64(f"c{k}", "g1") if k > 1 else F.col("g1")


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Of counts 1, 2 and 3 or more, by how many n-grams occur once to four times."""
    share = ones / (ones + 2 * twos) if ones else 0.0
    made = []
    for k, (here, more) in enumerate(((ones, twos), (twos, threes), (threes, fours)), start=1):
        made.append(min(max(k - (k + 1) * share * more / here, 0.0), float(k)) if here else min(k, 1) * 0.5)
    return made[0], made[1], made[2]


def model(training: DataFrame, scratch: Scratch, order: int = ORDER) -> tuple[DataFrame, float | None]:
    """key, target, context: what an n-gram adds to ln p of a text each time it ends at a token and comes before
    one; and ln p of a token that training does not have, None if it has no token. It reads tables of ``scratch``."""
    run, schema = _count(order)
    counted = training.select("text").mapInArrow(run, schema)
    below: DataFrame | None = None
    levels: dict[int, DataFrame] = {}
    for k in range(order, 0, -1):
        by = [f"c{k}", "g1"] if k > 1 else ["g1"]
        n = F.sum("n") if k == order else F.count("*")
        rows = counted if k == order else levels[k + 1]
        levels[k] = scratch.write(rows.groupBy(*by).agg(n.alias("n"), *[F.min(f"c{j}").alias(f"c{j}") for j in range(k - 1, 1, -1)]), f"order{k}")
    base, targets, contexts = None, [], []
    for k in range(1, order + 1):
        level = levels[k]
        of = level.agg(*[F.count(F.when(F.col("n") == j, 1)).alias(f"n{j}") for j in (1, 2, 3, 4)]).first()
        d1, d2, d3 = (max(d, LEAST_DISCOUNT) for d in discounts(*of))
        off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        if k == 1:
            whole = level.agg(F.sum("n").alias("total"), F.sum(off).alias("freed"), F.count("*").alias("kinds")).first()
            if not whole["total"]:
                return training.sparkSession.createDataFrame([], "key long, target float, context float"), None
            # One kind more than there are: all that training does not have.
            unseen = whole["freed"] / whole["total"] / (whole["kinds"] + 1)
            base = math.log(unseen)
            p = (F.col("n") - off) / whole["total"] + unseen
            below = scratch.write(level.select(F.col("g1").alias("key"), F.log(p).alias("p"), (F.log(p) - base).cast("float").alias("target")), "scored1")
        else:
            sums = level.groupBy(f"c{k}").agg(F.sum("n").alias("total"), F.sum(off).alias("freed"))
            sums = scratch.write(sums, f"contexts{k}")
            share = F.col("freed") / F.col("total")
            contexts.append(sums.select(F.col(f"c{k}").alias("key"), F.log(share).cast("float").alias("context")))
            last = k == order
            shorter = below.select(F.col("key").alias("suffix"), F.col("p").alias("shorter"))
            made = []
            # The joins shuffle every n-gram twice, so they take a part of them at a time.
            for part in range(PARTS if last else 1):
                rows = level.select(_gram(k).alias("key"), f"c{k}", _gram(k - 1).alias("suffix"), (F.col("n") - off).alias("kept"))
                rows = rows.where(F.pmod("key", F.lit(PARTS)) == part) if last else rows
                rows = rows.join(sums.hint("shuffle_hash"), f"c{k}").join(shorter.hint("shuffle_hash"), "suffix")
                backed = F.log(share) + F.col("shorter")
                p = F.log(F.col("kept") / F.col("total") + F.exp(backed))
                held = ["key", (p - backed).cast("float").alias("target")]
                made.append(scratch.write(rows.select(*held, *([] if last else [p.alias("p")])), f"scored{k}-{part}"))
            below = made[0]
            for more in made[1:]:
                below = below.union(more)
        targets.append(below.select("key", "target"))
        scratch.drop(level)
    # N-grams of the highest order are no contexts; the others may be both.
    lower = targets[0].withColumn("context", F.lit(0.0).cast("float"))
    for more in targets[1:-1]:
        lower = lower.union(more.withColumn("context", F.lit(0.0).cast("float")))
    for more in contexts:
        lower = lower.union(more.select("key", F.lit(0.0).cast("float").alias("target"), "context"))
    lower = lower.groupBy("key").agg(*[F.sum(c).cast("float").alias(c) for c in ("target", "context")])
    lower = scratch.write(lower, "lower")
    return (lower.union(targets[-1].withColumn("context", F.lit(0.0).cast("float"))) if order > 1 else lower), base


_GRAMS = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("ended", pa.int32()), ("led", pa.int32()), ("held", pa.binary())])
_GRAMS_SQL = "key long, block long, ended int, led int, held binary"
_ADDED = pa.schema([("block", pa.int64()), ("places", pa.binary()), ("sums", pa.binary()), ("texts", pa.binary())])
_ADDED_SQL = "block long, places binary, sums binary, texts binary"
_SUMMED = pa.schema([("added", pa.float64()), *[(c, pa.int64()) for c in ("a", "b", "all_grams", "all_fresh")]])
_SUMMED_SQL = "added double, a long, b long, all_grams long, all_fresh long"


def _within(made: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """A text's n-grams of all orders, of its ``keys``, how often each ends at a token and comes before one; how many of the highest
    order there are, and how many for the first time."""
    order, n, fresh = len(made), len(made[-1]), 0
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k, level in enumerate(made if n else [], start=1):
        ends = level[-n:]
        found, ended = np.unique(ends, return_counts=True)
        fresh = len(found)
        if k == order:
            parts.append((found, ended, np.zeros_like(ended)))
            continue
        # Each comes before a token but the text's last; so does the one that ends before the text.
        led = ended.copy()
        led[np.searchsorted(found, ends[-1])] -= 1
        parts.append((np.append(found, level[-n - 1]), np.append(ended, 0), np.append(led, 1)))
    if not parts:
        return made[0][:0], np.empty(0, np.int64), np.empty(0, np.int64), 0, 0
    found, ended, led = (np.concatenate(c) for c in zip(*parts))
    return found, ended, led, n, fresh


def _grams(order: int):
    """Rows (a, b, text) as blocks of texts. A row per n-gram and its occurrences in a text of the block, as target and
    as context: ``held`` has the places in the block of all texts that have it so. And a row that stands for the texts:
    ``held`` has a, b, the number of n-grams and of those had for the first time, of each."""

    def emit(first: int, texts: list[tuple]) -> Iterator[pa.RecordBatch]:
        of, ended, led = (np.concatenate([t[i] for t in texts]) for i in (2, 3, 4))
        places = np.repeat(np.arange(len(texts), dtype="<u2"), [len(t[2]) for t in texts])
        # Rows alike lie together; should two kinds have one value here, they make more rows than they need.
        sorting = np.argsort(of + ended.astype(np.uint64) * _P1 + led.astype(np.uint64) * _P2)
        of, ended, led, places = of[sorting], ended[sorting], led[sorting], places[sorting]
        other = (of[1:] != of[:-1]) | (ended[1:] != ended[:-1]) | (led[1:] != led[:-1])
        starts = np.concatenate(([0], np.flatnonzero(other) + 1))
        ends = np.append(starts, len(of)).astype(np.int32) * 2
        held = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(places)])
        block = pa.array(np.full(len(starts), first))
        columns = [_signed(of[starts]), block, pa.array(ended[starts].astype(np.int32)), pa.array(led[starts].astype(np.int32)), held]
        yield from slices([pa.RecordBatch.from_arrays(columns, schema=_GRAMS)], _BATCH)
        whole = np.array([(t[0], t[1], t[5], t[6]) for t in texts], dtype="<i8").tobytes()
        yield pa.RecordBatch.from_pylist([{"key": (first >> 33) % _MARKS, "block": first, "ended": 0, "led": 0, "held": whole}], schema=_GRAMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        first = TaskContext.get().partitionId() << 33
        texts, size = [], 0
        for batch in slices(batches):
            a, b, whole = (c.to_pylist() for c in batch.columns)
            for some in _together([len(t or "") for t in whole]):
                for its_a, its_b, made in zip(a[some], b[some], _Keys(whole[some], hashes, order).each()):
                    found, ended, led, n, fresh = _within(made)
                    if n:
                        texts.append((its_a, its_b, found, ended, led, n, fresh))
                        size += len(found)
                    if size >= MOST_HELD or len(texts) == _BLOCK:
                        yield from emit(first, texts)
                        first, texts, size = first + len(texts), [], 0
        if texts:
            yield from emit(first, texts)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, value, mark, held): what n-grams of a block give to its texts, summed over rows that lie together."""
    for batch in batches:
        marks = batch.column("mark")
        own = batch.filter(marks)
        if own.num_rows:
            none = pa.nulls(own.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([own.column("block"), none, none, own.column("held")], schema=_ADDED)
        rows = batch.filter(pc.invert(marks))
        if not rows.num_rows:
            continue
        held = rows.column("held")
        ends = np.frombuffer(held.buffers()[1], dtype=np.int32)[held.offset : held.offset + len(held) + 1] // 2
        places = np.frombuffer(held.buffers()[2], dtype="<u2", count=ends[-1])
        block, value = rows.column("block").to_numpy(), rows.column("value").to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]))
        made = []
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            sums = np.bincount(places[ends[low] : ends[high]], np.repeat(value[low:high], np.diff(ends[low : high + 1])))
            found = np.flatnonzero(sums)
            made.append((int(block[low]), found.astype("<u2").tobytes(), sums[found].tobytes(), None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _ADDED.types)], schema=_ADDED)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text, of the rows of ``_added`` in the order of their blocks."""
    block, texts, sums = None, None, np.zeros(_BLOCK)

    def emit() -> pa.RecordBatch:
        columns = [pa.array(np.ascontiguousarray(texts[:, i])) for i in range(4)]
        return pa.RecordBatch.from_arrays([pa.array(sums[: len(texts)].copy()), *columns], schema=_SUMMED)

    for batch in batches:
        for its, places, added, whole in zip(*(c.to_pylist() for c in batch.columns)):
            if its != block:
                if block is not None:
                    yield emit()
                block = its
                sums[:] = 0.0
            if whole is not None:
                texts = np.frombuffer(whole, dtype="<i8").reshape(-1, 4)
            else:
                sums[np.frombuffer(places, dtype="<u2")] += np.frombuffer(added)
    if block is not None:
        yield emit()


def scores(texts: DataFrame, table: DataFrame, base: float | None, scratch: Scratch, order: int = ORDER, passes: int = PASSES) -> DataFrame:
    """doc_id, lang, n_grams, fresh, surprise (mean of -ln p): one row per row of ``texts`` (doc_id, lang, text).
    ``table`` is removed from ``scratch`` once it is written in buckets. Texts are held by their place in a task, so a
    partition read again has to give its rows in the same order, as files do."""
    spark = texts.sparkSession
    # 128 bits tell texts apart; rows of one id and text have one sum.
    whole = F.coalesce("text", F.lit(""))
    a, b = F.xxhash64("doc_id", whole).alias("a"), F.xxhash64(whole, F.lit("b"), "doc_id").alias("b")
    rows = scratch.write(texts.select("doc_id", "lang", a, b), "rows")
    none = F.lit(0.0).cast("float")
    table = table.union(spark.range(-_MARKS + 1, _MARKS).select(F.col("id").alias("key"), none.alias("target"), none.alias("context")))
    # Shuffled once, and not in every pass.
    sharded = scratch.buckets(table, "model", "key")
    scratch.drop(table)
    sums: DataFrame | None = None
    for number in range(passes):
        mine = texts.where(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(passes)) == number)
        grams = mine.select(a, b, "text").mapInArrow(_grams(order), _GRAMS_SQL)
        found = grams.join(sharded.hint("shuffle_hash"), "key")
        value = F.col("ended") * F.col("target").cast("double") + F.col("led") * F.col("context").cast("double")
        found = found.select("block", value.alias("value"), F.col("key").between(-_MARKS + 1, _MARKS - 1).alias("mark"), "held")
        of = found.mapInArrow(_added, _ADDED_SQL).repartition("block").sortWithinPartitions("block").mapInArrow(_summed, _SUMMED_SQL)
        with job_settings(spark, **_BATCHES):
            part = scratch.write(of, f"sums{number}")
        sums = part if sums is None else sums.union(part)
    each = sums.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in ("added", "all_grams", "all_fresh")])
    judged = rows.join(each.hint("merge"), ["a", "b"], "left")
    n_grams, fresh = (F.coalesce(c, F.lit(0)) for c in ("all_grams", "all_fresh"))
    judged = judged.withColumns({"n_grams": n_grams, "fresh": fresh})
    surprise = F.when(F.col("n_grams") > 0, -(F.lit(base).cast("double") + F.col("added") / F.col("n_grams")))
    return judged.select("doc_id", "lang", "n_grams", "fresh", surprise.alias("surprise"))


def share_again() -> Column:
    """Of a text's n-grams, those that it has had before."""
    return 1 - F.col("fresh") / F.nullif("n_grams", F.lit(0))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, order: int = ORDER,
          least_trusted: int = LEAST_TRUSTED) -> DataFrame:
    """doc_id, lang, n_grams, perplexity, most (the perplexity up to which it would be kept) and kept.

    A language with fewer than ``least_trusted`` trusted texts of the second half takes the limits of all.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    with Scratch(spark, "quality") as scratch:
        good = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("good_id")).agg(F.min("quality").alias("q"), F.count(F.when(F.col("quality").isNull(), 1)).alias("unknown"))
        good = good.where("q = 1 and unknown = 0").select("good_id", F.pmod(F.xxhash64("good_id"), F.lit(2)).alias("half"))
        good = scratch.write(good, "good")
        # A merge join at every size: labels grow with the corpus, and texts are shuffled once.
        training = texts.join(good.where("half = 0").hint("merge"), F.col("doc_id") == F.col("good_id"), "left_semi")
        # Written, so that the shuffles of texts and of counts are not on disk together.
        training = scratch.write(training.select("text"), "training")
        table, base = model(training, scratch, order)
        scratch.drop(training)
        rows = scratch.write(scores(texts, table, base, scratch, order), "scores", keep=True)

        held = rows.where("surprise is not null").join(good.where("half = 1"), F.col("doc_id") == F.col("good_id"), "left_semi")
        fair = F.ceil((F.col("surprise") - SPREAD / F.sqrt("n_grams")) * _STEPS)
        again = F.ceil(share_again() * _STEPS)
        measures = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("step")) for m, v in (("most", fair), ("again", again))]))
        steps = held.select("lang", measures.alias("m")).groupBy("lang", "m.measure", "m.step").agg(F.count("*").alias("n"))
        steps = scratch.write(steps, "steps")

        def limit(by: list[str], frame: DataFrame) -> DataFrame:
            so_far = F.sum("n").over(Window.partitionBy("measure", *by).orderBy("step"))
            ranked = frame.withColumn("up_to", so_far).withColumn("all", F.sum("n").over(Window.partitionBy("measure", *by)))
            reached = ranked.where(F.col("up_to") >= F.col("all") * quantile).groupBy("measure", *by).agg((F.min("step") / _STEPS).alias("limit"), F.max("all").alias("trusted"))
            each = [F.max(F.when(F.col("measure") == m, F.col("limit"))).alias(m) for m in ("most", "again")]
            return reached.groupBy(*by).agg(*each, F.max("trusted").alias("trusted"))

        own = limit(["lang"], steps).where(F.col("trusted") >= least_trusted)
        own = own.select(F.col("lang").alias("its_lang"), F.col("most").alias("own_most"), F.col("again").alias("own_again"))
        whole = limit([], steps.groupBy("measure", "step").agg(F.sum("n").alias("n")))
        own = scratch.write(own, "own", keep=True)
        found = whole.first()
    anywhere, any_again = (F.lit(found[m] if found else None).cast("double") for m in ("most", "again"))
    most = F.coalesce("own_most", anywhere) + SPREAD / F.sqrt("n_grams")
    judged = rows.join(own, F.col("lang").eqNullSafe(F.col("its_lang")), "left")
    fits = (F.col("surprise") <= most) & (share_again() <= F.coalesce("own_again", any_again))
    kept = (F.col("n_grams") > 0) & F.coalesce(fits, F.lit(True))
    return judged.select(
        "doc_id", "lang", "n_grams", F.exp("surprise").alias("perplexity"), F.when(F.col("n_grams") > 0, F.exp(most)).alias("most"), kept.alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``docs`` less those rejected. Rows of one id are kept or rejected together: one good text keeps them."""
    kept = judge(docs, labels, quantile).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
