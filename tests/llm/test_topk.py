"""The search over a grid of cells against plain Python, and what it moves."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk
from tidemark.llm.common import Scratch


def plain(rows, every=topk.EVERY, top=topk.TOP):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    best = {}
    for query_id, q in whole:
        if query_id % every == 0:
            best.setdefault(query_id, []).extend(
                (-sum(a * b for a, b in zip(q, c)), i) for i, c in whole if len(c) == len(q) and i != query_id)
    return sorted((q, k + 1, i, -s) for q, found in best.items() for k, (s, i) in enumerate(sorted(found)[:top]))


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.fixture
def plans(monkeypatch):
    """Plans of the tables that operators write, by name."""
    seen, write = {}, Scratch.write

    def noted(self, df, name, *args, **kwargs):
        seen[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name, *args, **kwargs)

    monkeypatch.setattr(Scratch, "write", noted)
    return seen


def test_queries_are_neither_broadcast_nor_copied_for_each_shuffle_partition(spark, plans):
    """Query blocks had a copy for each shuffle partition, and all copies were broadcast."""
    vectors = spark.range(300).select(F.col("id").alias("vec_id"), F.array(F.col("id") % 7 / 7.0, F.col("id") % 11 / 11.0).alias("embedding"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = plain([(i, [i % 7 / 7, i % 11 / 11]) for i in range(300)])
    exchanged = set()
    try:
        for partitions in ("4", "500"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert found(topk.search(vectors)) == wanted
            assert "Broadcast" not in plans["found"] and "Join" not in plans["found"]
            exchanged |= {line.split("Exchange ")[1].split(", REPARTITION")[0] for line in plans["found"].splitlines() if "Exchange " in line and "REPARTITION" in line}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len({x.rsplit(", ", 1)[-1] for x in exchanged}) == 1


@pytest.mark.parametrize("large", [1.0, 3000.0])
def test_many_cells_against_plain_scores(spark, monkeypatch, large):
    """Cells of few queries, blocks of a few rows, three lengths, equal vectors, repeated ids; components in two bytes and in eight."""
    monkeypatch.setattr(topk, "CELL_COMPONENTS", 40)
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-large, large) for _ in range(dims)]) for dims, n in ((9, 400), (4, 120), (1, 3)) for i in rng.sample(range(2000), n)]
    rows += [(i * 10, [0.5] * 9) for i in range(60)] + [(100, [0.25] * 9)] * 3 + [(50, [0.25] * 4), (150, [])]
    rng.shuffle(rows)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert found(topk.search(vectors, every=10, block_rows=7, query_rows=3, dims=2)) == plain(rows, every=10)


@pytest.mark.parametrize("spread,size,kind", [(1.0, 30, "f4"), (0.7, 100, "f4"), (1.0, 2, "f4"), (0.9, 10**6, "f8")])
def test_a_cell_against_all_scores(monkeypatch, spread, size, kind):
    """Weights that fall by dimension, many ties (size 2), singles and doubles: the bound leaves few pairs and loses none."""
    rng = np.random.default_rng(3)
    vectors = np.rint(rng.normal(0, size, (24, 9000)) * spread ** rng.permutation(24)[:, None])
    ids, asked = rng.permutation(9000), rng.choice(9000, 60, replace=False)
    went, go_on = [], topk._Cell._go_on
    monkeypatch.setattr(topk._Cell, "_go_on", lambda self, i, *rest: (went.append(len(i)), go_on(self, i, *rest))[1])
    cell = topk._Cell(ids[asked], vectors[:, asked], 5, 4, 25)
    for start in range(0, 9000, 900):
        cell.meet(ids[start : start + 900], vectors[:, start : start + 900])
    assert kind in cell.rows and 0 < sum(went) < 9000 * 60 / 10
    scores = vectors[:, asked].T @ vectors
    for k, query in enumerate(ids[asked]):
        best = np.lexsort((ids, -scores[k]))
        best = best[ids[best] != query][:5]
        assert cell.found[k].tolist() == ids[best].tolist() and cell.scores[k].tolist() == scores[k][best].tolist()


def test_vectors_that_are_all_equal(spark):
    """Every pair reaches the bar: the smallest ids are the best, and no more than the ties of a few candidates are sorted at once."""
    vectors = spark.range(6000).select(F.col("id").alias("vec_id"), F.array_repeat(F.lit(0.1), 20).alias("embedding"))
    got = found(topk.search(vectors))
    assert got == [(q, k + 1, i, 12500) for q in range(0, 6000, 50) for k, i in enumerate([x for x in range(6) if x != q][:5])]


def test_a_cell_has_a_bound_and_the_grid_follows_the_work(spark, monkeypatch):
    def blocks(asked, candidates):
        return spark.createDataFrame([(True, 1000, 64)] * asked + [(False, 4000, 64)] * candidates, "asked boolean, n int, dims int")

    assert topk._grid(blocks(0, 0)) == (1, 1)
    cores = spark.sparkContext.defaultParallelism
    assert topk._grid(blocks(1, 40 * cores)) == (2 * cores, 1)
    down, across = topk._grid(blocks(200, 2500))
    assert across >= 200 * 64_000 / topk.CELL_COMPONENTS and down * across >= 200 * 64_000 * 1e7 / topk.CELL_PRODUCTS
    monkeypatch.setattr(topk, "CELL_COMPONENTS", 128_000)
    assert topk._grid(blocks(200, 2500))[1] >= 100
