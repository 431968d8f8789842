"""Forward fill: block-wise and plain forms agree, and the rules of the operator hold."""

from __future__ import annotations

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.blocks import MAX_SPREAD, OrderSpan, cuts_evenly
from tidemark.operators.fill import forward_fill
from tidemark.operators.index import row_index
from tidemark.operators.ordered import OrderedTable

SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
values = st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=1, max_size=60)


def series(spark, cells, step=1, keys=1):
    rows = [(100 + i * step, i % keys, v, None if v is None else f"t{v}") for i, v in enumerate(cells)]
    return spark.createDataFrame(rows, "id bigint, k int, v bigint, t string")


def expected(cells, step=1, keys=1):
    frame = pd.DataFrame(
        {"id": [100 + i * step for i in range(len(cells))], "k": [i % keys for i in range(len(cells))],
         "v": pd.array(cells, dtype="Int64")}
    )
    frame["v"] = frame.groupby("k")["v"].ffill() if keys > 1 else frame["v"].ffill()
    return [(i, None if v is pd.NA else int(v)) for i, v in zip(frame["id"], frame["v"])]


def filled(df):
    return [(r["id"], r["v"]) for r in df.orderBy("id").collect()]


@SLOW
@given(cells=values, block=st.integers(1, 70))
def test_any_block_size_gives_the_plain_result(spark, cells, block):
    df = series(spark, cells)
    result = forward_fill(df, ["v", "t"], "id", rows_per_block=block)
    assert filled(result) == expected(cells)
    for row in result.collect():
        assert row["t"] == (None if row["v"] is None else f"t{row['v']}")


@SLOW
@given(cells=values, block=st.integers(1, 30), keys=st.integers(2, 4))
def test_keyed_fill_does_not_cross_keys(spark, cells, block, keys):
    result = forward_fill(series(spark, cells, keys=keys), "v", "id", "k", rows_per_block=block)
    assert filled(result) == expected(cells, keys=keys)


@pytest.mark.parametrize("step", [1, MAX_SPREAD - 1, 1000])
def test_sparse_keys(spark, step):
    cells = [None, 1, None, None, 5, None, 7, None, None, None] * 5
    df = series(spark, cells, step=step)
    assert filled(forward_fill(df, "v", "id", rows_per_block=7)) == expected(cells, step=step)


def test_keys_crowded_at_one_end_are_numbered_first(spark):
    """One outlier stretches the range, so that blocks of equal width would hold everything else."""
    ids = [*range(100), 10**15]
    df = spark.createDataFrame([(i, i if i % 10 == 0 else None) for i in ids], "id bigint, v bigint")
    span = OrderSpan.measure(df, "id")
    assert not cuts_evenly(df, ["id"], span, 5)
    assert filled(forward_fill(df, "v", "id", rows_per_block=5)) == [(i, i // 10 * 10 if i < 100 else 10**15) for i in ids]
    assert cuts_evenly(series(spark, [1] * 50, step=1000), ["id"], OrderSpan.measure(series(spark, [1] * 50, step=1000), "id"), 5)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_order_by_time_then_id(spark, kind):
    cells = [None, 1, None, None, 5, None, 7, None, None, None] * 5
    days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 10).cast("int")).cast(kind)
    df = series(spark, cells).withColumn("at", days)
    for block in (12, 1000):
        result = forward_fill(df, "v", ["at", "id"], rows_per_block=block)
        assert filled(result) == expected(cells)
        numbers = row_index(df, ["at", "id"], "n", rows_per_block=block).orderBy("id").collect()
        assert [r["n"] for r in numbers] == list(range(len(cells)))


def test_keyed_fill_in_composite_order(spark):
    rows = [(i // 50, i, i % 2, i if i % 9 == 0 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "at int, id bigint, k int, v bigint")
    plain = filled(forward_fill(df, "v", ["at", "id"], "k"))
    assert filled(forward_fill(df, "v", ["at", "id"], "k", rows_per_block=60)) == plain


@pytest.mark.parametrize(
    "cells", [[None] * 20, [None] * 10 + [3], [3] + [None] * 19, [1, 2, 3], [None, None, 4] + [None] * 12 + [9]]
)
def test_long_gaps_cross_blocks(spark, cells):
    df = series(spark, cells)
    for block in (1, 2, 3, 100):
        assert filled(forward_fill(df, "v", "id", rows_per_block=block)) == expected(cells)


def test_hole_in_the_key_leaves_empty_blocks(spark):
    ids = [*range(0, 10), *range(28, 38)]
    df = spark.createDataFrame([(i, 1 if i == 0 else None) for i in ids], "id bigint, v bigint")
    result = forward_fill(df, "v", "id", rows_per_block=2)
    assert filled(result) == [(i, 1) for i in ids]


def test_fill_is_idempotent(spark):
    once = forward_fill(series(spark, [None, 2, None, 4, None]), "v", "id", rows_per_block=2)
    assert filled(forward_fill(once, "v", "id", rows_per_block=2)) == filled(once)


@pytest.mark.parametrize("block", [3, 1000])
def test_result_does_not_depend_on_partitioning(spark, block):
    cells = [None, 1, None, None, 5, None, 7, None, None, None] * 3
    df = series(spark, cells)
    for laid_out in (df.repartition(1), df.repartition(7), df.orderBy(F.rand(3))):
        assert filled(forward_fill(laid_out, "v", "id", rows_per_block=block)) == expected(cells)


def test_one_hot_key_among_small_ones(spark):
    """A third of the rows under one key, NULL being a key of its own."""
    rows = [(i, None if i % 3 == 0 else i % 40, i if i % 7 == 0 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "id bigint, k bigint, v bigint")
    plain = filled(forward_fill(df, "v", "id", "k"))
    assert filled(forward_fill(df, "v", "id", "k", rows_per_block=30)) == plain


def test_fill_when_leaves_other_rows_alone(spark):
    df = spark.createDataFrame(
        [(1, "5", 5), (2, "null", None), (3, "bad", None), (4, "null", None)], "id bigint, raw string, v bigint"
    )
    for block in (1, 100):
        result = forward_fill(df, "v", "id", fill_when={"v": F.col("raw") == "null"}, rows_per_block=block)
        assert filled(result) == [(1, 5), (2, 5), (3, None), (4, 5)]


def test_columns_keep_order_and_types(spark):
    df = series(spark, [1, None, 3])
    for block in (1, 100):
        assert forward_fill(df, ["v"], "id", rows_per_block=block).dtypes == df.dtypes


def test_ordered_tables_join_alike_cut_or_not(spark):
    left = series(spark, [1, None, None, 4] * 6).select("id", "v")
    right = series(spark, [None, 2, None, 8] * 6).select("id", F.col("v").alias("w"))
    results = []
    for block in (5, 1000):
        a, b = OrderedTable.align([left, right], "id", block)
        joined = a.fill(["v"]).join(b.fill(["w"])).rows()
        results.append(sorted(joined.select("id", "v", "w").collect()))
        assert joined.columns == ["id", "v", "w"]
    assert results[0] == results[1]


def test_ordered_tables_with_sparse_keys(spark):
    left = series(spark, [1, None, None, 4] * 6, step=1000).select("id", "v")
    right = series(spark, [None, 2, None, 8] * 6, step=1000).select("id", F.col("v").alias("w"))
    a, b = OrderedTable.align([left, right], "id", 5)
    joined = a.fill(["v"]).apply(lambda d: d.where("v > 0")).fill(["v"]).join(b.fill(["w"])).rows()
    c, d = OrderedTable.align([left, right], "id", 1000)
    plain = c.fill(["v"]).join(d.fill(["w"])).rows()
    assert sorted(joined.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("block", [4, 1000])
def test_row_numbers(spark, block):
    df = series(spark, list(range(30)), keys=3)
    assert [tuple(r) for r in row_index(df.select("id"), "id", rows_per_block=block).orderBy("id").collect()] == [
        (100 + i, i) for i in range(30)
    ]
    by_text = row_index(df.select("id", "t"), ["t", "id"], "n", 1, rows_per_block=block)
    assert [r["n"] for r in by_text.orderBy("t", "id").collect()] == list(range(1, 31))
    per_key = row_index(df.select("id", "k"), "id", "n", 1, "k", rows_per_block=block)
    assert [r["n"] for r in per_key.orderBy("k", "id").collect()] == [*range(1, 11)] * 3


def test_row_numbers_with_many_equal_order_values(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("same"), "id")
    numbered = row_index(df, "same", "n", rows_per_block=100)
    assert sorted(r["n"] for r in numbered.collect()) == list(range(3000))
    edges = numbered.groupBy("same").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    assert sorted(tuple(r) for r in edges.collect()) == [(0, 0, 1499), (1, 1500, 2999)]


def test_row_index_replaces_an_existing_index(spark):
    df = spark.createDataFrame([(9, "a"), (4, "b")], "index bigint, name string")
    assert sorted(tuple(r) for r in row_index(df, "name").collect()) == [("a", 0), ("b", 1)]


@pytest.mark.parametrize("block", [4, 1000])
def test_row_index_in_the_order_of_the_index_it_replaces(spark, block):
    df = spark.createDataFrame([(i * 3, f"n{i}") for i in range(20)], "index bigint, name string")
    assert sorted(tuple(r) for r in row_index(df, "index", rows_per_block=block).collect()) == sorted(
        (f"n{i}", i) for i in range(20))


def test_carry_too_large_to_broadcast_is_joined(spark, monkeypatch):
    from tidemark.operators import blocks

    monkeypatch.setattr(blocks, "BROADCAST_ROWS", 0)
    rows = [(i, None if i % 3 == 0 else i % 40, i if i % 7 == 0 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "id bigint, k bigint, v bigint")
    result = forward_fill(df, "v", "id", "k", rows_per_block=30)
    assert filled(result) == filled(forward_fill(df, "v", "id", "k"))
    numbered = row_index(df, "id", "n", 0, "k", rows_per_block=30)
    assert numbered.exceptAll(row_index(df, "id", "n", 0, "k")).isEmpty()


def test_span_narrower_than_the_table(spark):
    cells = [None, 1, None, None, 5, None, 7, None, None, None] * 3
    span = OrderSpan(rows=20, low=105, high=124)
    result = forward_fill(series(spark, cells, keys=2), "v", "id", "k", span=span, rows_per_block=3)
    assert filled(result) == expected(cells, keys=2)


LONG = 2**63


def test_keys_at_both_ends_of_the_long_range(spark):
    ids = [-LONG, -LONG + 1, *range(-50, 50), LONG - 2, LONG - 1, *[i * (LONG // 60) for i in range(-59, 60) if i]]
    rows = sorted((i, None if k % 3 else k) for k, i in enumerate(ids))
    df = spark.createDataFrame(rows, "id bigint, v bigint")
    frame = pd.DataFrame({"v": pd.array([v for _, v in rows], dtype="Int64")}).ffill()
    want = [(i, None if v is pd.NA else int(v)) for (i, _), v in zip(rows, frame["v"])]
    for block in (3, 20, 60, 500):
        assert filled(forward_fill(df, "v", "id", rows_per_block=block)) == want
        numbered = row_index(df, "id", "n", rows_per_block=block).orderBy("id").collect()
        assert [r["n"] for r in numbered] == list(range(len(rows)))
    span = OrderSpan.measure(df, "id")
    sizes = df.groupBy(span.block_of(F.col("id"), 60).alias("b")).count().collect()
    assert all(0 < r["b"] <= span.block_count(60) for r in sizes)


def test_a_repeated_key_is_counted_and_split(spark):
    """Even keys and one key with most of the rows: blocks by key would hold it whole."""
    df = spark.range(600).select(F.when(F.col("id") < 300, F.col("id")).otherwise(150).alias("k"), "id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("v"))
    span = OrderSpan.measure(df, "k")
    assert not cuts_evenly(df, ["k"], span, 20)
    rows = sorted((r["k"], r["id"], r["v"]) for r in df.collect())
    last, want = None, {}
    for k, i, v in rows:
        last = v if v is not None else last
        want[i] = last
    assert {r["id"]: r["v"] for r in forward_fill(df, "v", ["k", "id"], rows_per_block=20).collect()} == want


def test_rows_without_a_key_are_a_block_of_their_own(spark):
    df = spark.range(200).select(F.when(F.col("id") % 20 > 0, F.col("id")).alias("k"), "id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"))
    span = OrderSpan.measure(df, "k")
    assert span.nulls == 10 and cuts_evenly(df, ["k"], span, 25)
    largest = df.groupBy(span.block_of(F.col("k"), 25)).count().agg(F.max("count")).first()[0]
    assert largest <= MAX_SPREAD * 25
    rows = sorted(((r["k"] is not None, r["k"] or 0, r["id"], r["v"]) for r in df.collect()))
    last, want = None, {}
    for _, _, i, v in rows:
        last = v if v is not None else last
        want[i] = last
    assert {r["id"]: r["v"] for r in forward_fill(df, "v", ["k", "id"], rows_per_block=25).collect()} == want
