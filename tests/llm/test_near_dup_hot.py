"""A group whose members are nearly alike enough: rows written in proportion to its members, not to its pairs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import common, near_dup

N = 300


def texts() -> dict[int, str]:
    """Nearly all 0.75 to 0.8 alike to each other; a tenth are linked."""
    made = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    found = {}
    for d in range(N):
        words = list(base)
        for place in made.sample(range(400), 11 if d % 10 == 0 else 12 + d % 3):
            words[place] = f"x{d}-{place}"
        found[d] = " ".join(words)
    return found


def test_rows_of_a_hot_group(spark, monkeypatch):
    rows = texts()
    sets = {d: set(zip(t.split(), t.split()[1:])) for d, t in rows.items()}
    lowest = dict.fromkeys(sets)
    for d in lowest:
        lowest[d] = d

    def root(d: int) -> int:
        while lowest[d] != d:
            d = lowest[d]
        return d

    close = 0
    for a in sets:
        for b in range(a + 1, N):
            both = len(sets[a] & sets[b])
            whole = len(sets[a]) + len(sets[b]) - both
            close += 75 * whole <= 100 * both < 80 * whole
            if 100 * both >= 80 * whole:
                low, high = sorted((root(a), root(b)))
                lowest[high] = low
    assert close > 10_000
    written = {}
    write = common.Scratch.write

    def counting(self, df, name, **options):
        stored = write(self, df, name, **options)
        written[name] = max(written.get(name, 0), stored.count())
        return stored

    monkeypatch.setattr(common.Scratch, "write", counting)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = {r.doc_id: r.component_id for r in near_dup.link(docs).collect()}
    assert got == {d: root(d) for d in rows}
    # Every member is in each of the bands once.
    assert max(written.values()) <= near_dup.BANDS * N
    assert written["found"] + written["links"] <= near_dup.BANDS * N
