"""Near duplicates by SetSketch registers.

A document's set of shingles is summarised in ``M`` registers. Every element gets ``M`` exponentially spaced points,
the j-th drawn from a truncated exponential distribution on the j-th interval and given to the j-th register of
the element's own order; a register keeps the logarithm (base ``BASE``) of its least point. Registers of a union
are the maxima of the registers, and two registers are equal about as often as the sets are alike.

1. Documents with equal sets are one class; only its smallest id goes on (a map-side combined minimum).
2. Bands of registers are hashed; representatives that share a band are in a bucket.
3. Each bucket's smallest member is its hub. Pairs of member and hub are estimated by maximum likelihood over all
   registers jointly (greater, smaller, equal, and the known set sizes), those of a second sketch of ``FINE`` registers
   that only members of buckets get included; the promising ones are verified on full sets, the best of each member first, then the best between components, then what is left between components.
   Linear in the members: no bucket is written out as pairs.
4. Links are joined to components. A bucket all of whose members are in one component is finished.
5. In the others, members of different components are compared by their sketches in blocks of bounded size, each
   pair in its first common band only. What goes on is no pair but every member with a candidate, once a bucket.
6. These meet again with their full sets: candidates of a block are verified there, the likeliest first, unless their
   components are joined by then, and only links that join components leave it. So whatever shares a band and is
   estimated near the threshold is verified or already in one component, and no step writes more rows than buckets have.

What can be lost is a pair above the threshold that shares none of the ``BANDS`` bands: with the defaults under 3 in a
million at a similarity of 0.8, and fewer above, or one that is estimated six standard deviations too low, by the first
sketch or by both (about one in a hundred million at 0.8); where a group has other links, its component stays whole.
A group whose members are 0.67 alike, say, gives pairs in numbers that only estimates can turn down; by both
sketches they are far off.

Hot groups: equal sets are pre-aggregated; members are joined to hubs by plain joins of two shuffled sides, which
adaptive execution can split; blocks split the rest. Nothing is collected.

Defined results: a text without words has an empty set, is linked with nothing, and is kept. One word is one
shingle. Rows with the same ``doc_id`` are one document, whose links are those of all its texts. Rows with a null
``doc_id`` are linked with nothing and kept, with a null component. Very long texts are read whole; their sets are held a few
texts at a time. An empty table gives no rows. Other columns
are not read, or carried by ``keep_one``.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Hashes, Scratch, job_settings, mix, per_slice

SIMILAR = 80
SHINGLE = 2
M = 256
BASE = 1.001
RATE = 20.0
TOP = 65535
BAND_REGISTERS = 6
BANDS = M // BAND_REGISTERS
# Six standard deviations of the estimate at the threshold.
MARGIN = 0.15
BLOCK_ROWS = 2048
# Bytes of full sets that a block holds at most, unless one set has more.
BLOCK_BYTES = 8 * 1024 * 1024

# Registers of a second sketch, made only for documents that share a bucket: with both, an estimate is so sharp that
# six standard deviations are less than half of those of the first alone.
FINE = 1024
FINE_MARGIN = 0.07

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


@cache
def _intervals(m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``m`` points of an element: its jump, where its interval begins, and the interval's mass."""
    begins = -np.log1p(-np.arange(m) / m) / RATE
    ends = np.append(begins[1:], np.inf)
    return np.arange(1, m + 1, dtype=np.uint64) * _GOLD, begins, 1 - np.exp(-RATE * (ends - begins))


def sketch(elements: np.ndarray, owner: np.ndarray, n: int, m: int = M) -> np.ndarray:
    """``m`` registers, a power of two, of ``n`` sets; ``owner`` tells whose element each hash is."""
    jumps, begins, mass = _intervals(m)
    least = np.full(n * m, np.inf)
    for j in range(m):
        u = (mix(elements + jumps[j]) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        points = begins[j] - np.log1p(-u * mass[j]) / RATE
        turn = elements + np.uint64(j) * (elements >> np.uint64(8) | np.uint64(1))
        key = owner * m + (turn & np.uint64(m - 1)).astype(np.int64)
        # Intervals ascend: a register hit at an earlier step holds a lesser point already.
        free = np.isinf(least[key])
        np.minimum.at(least, key[free], points[free])
        unfilled = np.isinf(least).reshape(n, m).any(axis=1)[owner]
        elements, owner = elements[unfilled], owner[unfilled]
        if not len(owner):
            break
    with np.errstate(divide="ignore"):
        values = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(values, 0, TOP).astype("<u2").reshape(n, m)


def shingles(text: str | None, hashes: Hashes, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the shingles of a text, sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = hashes.of(words)
    k = min(size, len(h))
    state = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        state = mix(state * _GOLD + h[i : len(h) - k + 1 + i])
    return np.unique(state)


_SIGNED = "doc_id long, n long, s1 long, s2 long, sketch binary"
_SIGNED_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sketch", pa.binary())])


def _signatures(size: int):
    hashes = Hashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, hashes, size) for t in batch.column(1).to_pylist()]
        sizes = np.array([len(s) for s in sets])
        registers = sketch(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
        digests = _digests(sets)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                pa.array([r.tobytes() if k else None for r, k in zip(registers, sizes)], pa.binary()),
            ],
            schema=_SIGNED_ARROW,
        )

    return per_slice(run)


def band_hashes(registers: np.ndarray) -> np.ndarray:
    rows = registers[:, : BANDS * BAND_REGISTERS].reshape(len(registers), BANDS, BAND_REGISTERS).astype(np.uint64)
    state = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(BAND_REGISTERS):
        state = mix(state * _GOLD + rows[:, :, i])
    return state.astype(np.int64)


def _registers(values, m: int = M) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype="<u2").reshape(-1, m)


_BANDED = pa.schema([("band", pa.int64()), ("rep", pa.int64())])
_NAMED = pa.schema([("band", pa.int64()), ("rep", pa.int64()), ("label", pa.int64())])


def _bands(batch: pa.RecordBatch) -> pa.RecordBatch:
    hashed = band_hashes(_registers(batch.column(1).to_pylist()))
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    return pa.RecordBatch.from_arrays([pa.array(hashed.reshape(-1)), pa.array(np.repeat(ids, BANDS))], schema=_BANDED)


def _labelled_bands(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (rep, label, sketch): a row for each band."""
    hashed = band_hashes(_registers(batch.column(2).to_pylist()))
    reps, labels = (np.repeat(batch.column(i).to_numpy(zero_copy_only=False), BANDS) for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(hashed.reshape(-1)), pa.array(reps), pa.array(labels)], schema=_NAMED)


def _collision(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def likely_similarity(greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, m: int = M) -> np.ndarray:
    """Jaccard similarity of greatest likelihood, given how many of ``m`` registers of a are greater and smaller than b's."""
    a, b = n_a / (n_a + n_b), n_b / (n_a + n_b)
    equal = m - greater - smaller

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = _collision(np.maximum(a - b * j, 0)), _collision(np.maximum(b - a * j, 0))
        tiny = 1e-300
        return (
            greater * np.log(np.maximum(up, tiny)) + smaller * np.log(np.maximum(down, tiny))
            + equal * np.log(np.maximum(1 - up - down, tiny))
        )

    low, high = np.zeros(len(a)), np.minimum(a / b, b / a)
    for _ in range(40):  # the likelihood is concave: thirds close in on its peak
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


_ESTIMATED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("alike", pa.float64())])


def _sides(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (one > two).sum(axis=1), (one < two).sum(axis=1)


def _estimate(batch: pa.RecordBatch) -> pa.RecordBatch:
    coarse = _sides(*(_registers(batch.column(i).to_pylist()) for i in (2, 3)))
    fine = _sides(*(_registers(batch.column(i).to_pylist(), FINE) for i in (6, 7)))
    n_a, n_b = (batch.column(i).to_numpy().astype(float) for i in (4, 5))
    alike = likely_similarity(coarse[0] + fine[0], coarse[1] + fine[1], n_a, n_b, M + FINE)
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alike)], schema=_ESTIMATED)


_LINKED = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(percent: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        linked = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            linked.append(_alike(np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8"), percent))
        keep = pa.array(linked)
        return pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], schema=_LINKED)

    return per_slice(run, 64)


_SETS = pa.schema([("rep", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("elements", pa.binary()), ("fine", pa.binary())])


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), dtype="<i8").reshape(-1, 2)


def _sets(size: int):
    hashes = Hashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, hashes, size) for t in batch.column(1).to_pylist()]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        fine = sketch(mix(np.concatenate(sets) ^ _SALT), owner, len(sets), FINE)
        digests = _digests(sets)
        columns = [pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([f.tobytes() for f in fine], pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests[:, 0]), pa.array(digests[:, 1]), *columns], schema=_SETS)

    return per_slice(run)


_FOUND = pa.schema([("band", pa.int64()), ("rep", pa.int64())])
_PAIRS_AT_ONCE = 20_000
_FINE_PAIRS_AT_ONCE = 5_000


def _alike(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _candidates(batch: pa.RecordBatch, percent: int):
    """For each pair of blocks (a row: band, low, high, members): its band, and candidates among members of different
    components as places in the flat list of members, with their estimates; and that list."""
    bands = batch.column(0).to_numpy()
    crossed = batch.column(1).to_numpy() != batch.column(2).to_numpy()
    members = batch.column(3)
    sizes = np.diff(members.offsets.to_numpy())
    flat = members.flatten()
    reps, labels, blocks, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "label", "block", "n"))
    registers, fine = _registers(flat.field("sketch").to_pylist()), _registers(flat.field("fine").to_pylist(), FINE)
    hashed = band_hashes(registers)
    start = 0
    for band, cross, size in zip(bands.tolist(), crossed.tolist(), sizes.tolist()):
        i, j = np.triu_indices(size, 1)
        i, j = i + start, j + start
        start += size
        # No two sets are more alike than their sizes.
        sized = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        open_pairs = (labels[i] != labels[j]) & (reps[i] != reps[j]) & sized
        if cross:
            open_pairs &= blocks[i] != blocks[j]
        i, j = i[open_pairs], j[open_pairs]
        alike = np.zeros(len(i))
        for at in range(0, len(i), _PAIRS_AT_ONCE):
            x, y = i[at : at + _PAIRS_AT_ONCE], j[at : at + _PAIRS_AT_ONCE]
            # A pair is looked at in the first band that it shares.
            mine = hashed[x, (hashed[x] == hashed[y]).argmax(axis=1)] == band
            x, y = x[mine], y[mine]
            sizes_of = n[x].astype(float), n[y].astype(float)
            coarse = _sides(registers[x], registers[y])
            # The first sketch alone turns down what is far off, both decide about the rest.
            near = np.flatnonzero(likely_similarity(*coarse, *sizes_of) >= percent / 100 - MARGIN)
            for some in np.array_split(near, len(near) // _FINE_PAIRS_AT_ONCE + 1):
                sharp = _sides(fine[x[some]], fine[y[some]])
                both = likely_similarity(coarse[0][some] + sharp[0], coarse[1][some] + sharp[1], sizes_of[0][some], sizes_of[1][some], M + FINE)
                alike[at + np.flatnonzero(mine)[some]] = both
        good = np.flatnonzero(alike >= percent / 100 - FINE_MARGIN)
        yield band, i[good], j[good], alike[good], flat


def _with_candidates(percent: int):
    """The members that have a candidate, of each pair of blocks."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bands, found = [], []
        for band, i, j, _, flat in _candidates(batch, percent):
            reps = np.unique(flat.field("rep").to_numpy(zero_copy_only=False)[np.concatenate((i, j))])
            bands.append(np.full(len(reps), band, dtype=np.int64))
            found.append(reps)
        columns = (pa.array(np.concatenate(x), pa.int64()) for x in (bands, found))
        return pa.RecordBatch.from_arrays(list(columns), schema=_FOUND)

    return run


def _settle(percent: int):
    """Links that join components, among the candidates of each pair of blocks; members have their full sets."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        linked = []
        for _, i, j, alike, flat in _candidates(batch, percent):
            reps, labels = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "label"))
            elements = flat.field("elements")
            lower: dict[int, int] = {}

            def root(label: int) -> int:
                while label in lower:
                    label = lower[label]
                return label

            sets: dict[int, np.ndarray] = {}
            for k in np.argsort(-alike, kind="stable").tolist():
                x, y = int(i[k]), int(j[k])
                low, high = sorted((root(int(labels[x])), root(int(labels[y]))))
                if low == high:
                    continue
                for place in (x, y):
                    if place not in sets:
                        sets[place] = np.frombuffer(elements[place].as_py(), dtype="<u8")
                if _alike(sets[x], sets[y], percent):
                    lower[high] = low
                    linked.append((int(reps[x]), int(reps[y])))
        columns = zip(*linked) if linked else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_LINKED)

    return run


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label: the smallest node that each node of ``links`` (a, b) is connected with."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct()
    both = scratch.write(both, "edges", few=True)
    labels = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label"))
    while True:
        theirs = labels.select(F.col("node").alias("v"), F.col("label").alias("their"))
        near = both.join(theirs, "v").groupBy("u").agg(F.min("their").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("u")).select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        # A label is a node: take over its label too, so long chains shorten by half.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        made = scratch.write(lower.join(jump, "label").select("node", "before", F.least("label", "further").alias("label")), "labels", few=True)
        labels = made.select("node", "label")
        if not made.where("label <> before").limit(1).count():
            return labels


def link(docs: DataFrame, percent: int = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Two documents are linked if ``100 * shared shingles >= percent * all shingles`` of both.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Scratch(spark, "near") as scratch:
        signed = scratch.write(texts.mapInArrow(_signatures(size), _SIGNED), "signed", keep=True)
        usable = signed.where("n > 0 and doc_id is not null")
        classes = scratch.write(usable.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")), "classes", keep=True)
        first = F.col("doc_id") == F.col("rep")
        reps = usable.join(classes, ["s1", "s2"]).where(first).select("rep", "n", "s1", "s2", "sketch")
        reps = scratch.write(reps, "reps")
        banded = reps.select("rep", "sketch").mapInArrow(per_slice(_bands, 2000), "band long, rep long")
        hubs = banded.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"), F.count("*").alias("members"))
        hubs = scratch.write(hubs.where("last > hub").select("band", "hub", "members"), "hubs")
        buckets = scratch.write(banded.join(hubs, "band"), "buckets")
        asked = buckets.select("rep").distinct()
        reps = scratch.write(reps.join(asked, "rep"), "asked")
        ids = reps.select(F.col("rep").alias("doc_id")).distinct()
        both = texts.join(ids, "doc_id", "left_semi").mapInArrow(_sets(size), "rep long, s1 long, s2 long, elements binary, fine binary")
        sets = scratch.write(both, "sets")
        # An id may have several texts; equal ones have equal sketches.
        fine = sets.groupBy("rep", "s1", "s2").agg(F.max("fine").alias("fine"))
        reps = scratch.write(reps.join(fine, ["rep", "s1", "s2"]).select("rep", "s1", "s2", "n", "sketch", "fine"), "fine")

        def estimated(pairs: DataFrame) -> DataFrame:
            def side(end: str) -> DataFrame:
                return reps.select(F.col("rep").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("sketch", "n", "fine")])

            rows = pairs.join(side("a"), "a").join(side("b"), "b")
            rows = rows.select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b", "fine_a", "fine_b")
            return rows.mapInArrow(per_slice(_estimate, 2000), "a long, b long, alike double").where(
                F.col("alike") >= percent / 100 - FINE_MARGIN
            )

        def verified(pairs: DataFrame) -> DataFrame:
            one = sets.select(F.col("rep").alias("a"), F.col("elements").alias("set_a"))
            two = sets.select(F.col("rep").alias("b"), F.col("elements").alias("set_b"))
            rows = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
            return rows.mapInArrow(_verify(percent), "a long, b long").distinct()

        def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
            """Pairs whose ends are not in one component, with the components low and high."""
            one = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
            two = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
            rows = pairs.join(one, "a", "left").join(two, "b", "left")
            ends = F.coalesce("label_a", "a"), F.coalesce("label_b", "b")
            return rows.select("a", "b", "alike", F.least(*ends).alias("low"), F.greatest(*ends).alias("high")).where("low < high")

        to_hubs = buckets.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
        likely = scratch.write(estimated(to_hubs), "likely")
        best = likely.groupBy("b").agg(F.max(F.struct("alike", "a")).alias("best")).select(F.col("best")["a"].alias("a"), "b")
        # Texts of one document belong together.
        texts_of = usable.select("doc_id", "s1", "s2").join(classes, ["s1", "s2"]).select("doc_id", "rep").distinct()
        lowest = texts_of.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select("doc_id", "a")
        same = texts_of.join(lowest, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))
        links = scratch.write(verified(best).union(same), "links", few=True)
        labels = components(links, scratch)
        # Then the best pair between each two components that pairs still join, then all such pairs.
        pair = F.max(F.struct("alike", "a", "b")).alias("best")
        between = labelled(likely, labels).groupBy("low", "high").agg(pair)
        between = scratch.write(verified(between.select(F.col("best")["a"].alias("a"), F.col("best")["b"].alias("b"))), "between", few=True)
        links = links.union(between)
        labels = components(links, scratch)
        links = links.union(scratch.write(verified(labelled(likely, labels)), "rest", few=True))
        labels = components(links, scratch)
        # All pairs with a hub are settled: verified, in one component, or not alike. Others remain where a
        # bucket has more members and several components.
        # Labels meet documents, one row each, and bands are made from these anew.
        at = labels.select(F.col("node").alias("rep"), "label")
        current = reps.join(at, "rep", "left").select("rep", F.coalesce("label", "rep").alias("label"), "sketch")
        named = scratch.write(current.mapInArrow(per_slice(_labelled_bands, 2000), "band long, rep long, label long"), "named")
        ends = F.min("label").alias("low_label"), F.max("label").alias("high_label")

        def in_blocks(rows: DataFrame, mixed: DataFrame, members: DataFrame) -> DataFrame:
            """Rows (band, rep, label) of buckets (band, parts) as a row for each two blocks, with what members have."""
            rows = rows.join(mixed, "band").withColumn("block", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
            rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            member = F.struct("label", "block", *members.columns)
            groups = rows.join(members, "rep").groupBy(
                "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
            ).agg(F.collect_list(member).alias("member"))
            return groups.where(F.size("member") > 1)

        mixed = named.groupBy("band").agg(*ends, F.count("*").alias("members")).where("low_label < high_label")
        mixed = mixed.select("band", F.ceil(F.col("members") / BLOCK_ROWS).cast("int").alias("parts"))
        groups = in_blocks(named, mixed, reps.select("rep", "n", "sketch", "fine"))
        # A row is up to two blocks of sketches.
        with job_settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="64"):
            found = scratch.write(groups.mapInArrow(per_slice(_with_candidates(percent)), "band long, rep long").distinct(), "found")
        if found.limit(1).count():
            asked = found.select("rep").distinct()
            own = ["rep", "s1", "s2"]
            whole = sets.join(asked, "rep", "left_semi").groupBy(*own).agg(F.max("elements").alias("elements"))
            whole = scratch.write(reps.join(whole, own).select("rep", "n", "sketch", "fine", "elements"), "whole")
            size = whole.groupBy("rep").agg((8 * F.sum("n")).alias("size"))
            rows = scratch.write(found.join(named, ["band", "rep"]).distinct().join(size, "rep"), "open", few=True)
            wanted = F.greatest(F.count("*") / BLOCK_ROWS, F.sum("size") / BLOCK_BYTES)
            mixed = rows.groupBy("band").agg(F.ceil(wanted).cast("int").alias("parts"))
            groups = in_blocks(rows.drop("size"), mixed, whole)
            with job_settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="8"):
                joined = groups.mapInArrow(per_slice(_settle(percent)), "a long, b long").distinct()
                links = links.union(scratch.write(joined, "links", few=True))
            labels = components(links, scratch)
        labels = scratch.write(labels, "components", keep=True, few=True)

    mine = signed.select("doc_id", "n", "s1", "s2").join(classes, ["s1", "s2"], "left")
    mine = mine.join(labels, F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.coalesce("label", "rep")).otherwise(F.col("doc_id")))
    return mine.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, percent: int = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """``docs`` without those that are not the smallest of their component."""
    gone = link(docs, percent, size).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
