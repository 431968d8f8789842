"""What one task holds has a bound, however large the tables are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import blocks, quality
from tidemark.sources import files
from workload import queries


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    """Test tables are tiny; large ones would not be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_literal_rows_do_not_shuffle_what_they_are_joined_to(spark, no_auto_broadcast):
    """A store of a few would otherwise be one task's rows, sorted."""
    stores = files.typed_rows(spark, [(1, "first"), (2, "second")], "store int, name string")
    sales = spark.range(1000).select((F.col("id") % 5).cast("int").alias("store"))
    joined = sales.join(stores, "store").groupBy("name").count()
    text = plan(sales.join(stores, "store"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text
    assert {r["name"]: r["count"] for r in joined.collect()} == {"first": 200, "second": 200}


def test_order_of_a_long_file_is_checked_in_runs(spark, tmp_path, monkeypatch):
    """One file of 1,000 rows, with a break inside a run and one between two runs, and a second file that begins too low."""
    monkeypatch.setattr(quality, "RUN_ROWS", 100)
    place = F.col("id") + F.when(F.col("id") == 550, 10).otherwise(0)
    rows = spark.range(0, 1000, 1, 1).select(F.when(F.col("id") < 700, place).otherwise(F.col("id") - 500).alias("v"))
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    checked = quality.check_sorted(stored, "v")
    assert "run#" in plan(checked).split("Window [lag(key")[1].split("\n")[0]
    assert tuple(checked.first()) == (1000, 2, 0)
    spark.range(0, 2000, 1, 2).select((F.col("id") % 1000).alias("v")).write.parquet(str(tmp_path / "two"))
    assert tuple(quality.check_sorted(spark.read.parquet(str(tmp_path / "two")), "v").first()) == (2000, 0, 1)


def test_order_is_checked_by_as_many_tasks_as_rows_need(spark, tmp_path, monkeypatch):
    """Rows of long file names compress so well that adaptive execution would give one task nearly all."""
    monkeypatch.setattr(quality, "ROWS_PER_BLOCK", 200)
    spark.range(0, 1000, 1, 1).write.parquet(str(tmp_path / "rows"))
    checked = quality.check_sorted(spark.read.parquet(str(tmp_path / "rows")), "id")
    text = plan(checked)
    assert "REPARTITION_BY_NUM" in text and ", 10)" in text
    assert tuple(checked.first()) == (1000, 0, 0)


def test_blocks_of_the_queries_have_the_size_of_a_block(spark):
    assert queries._block(spark.range(70)) == 10
    assert queries._block(spark.range(20 * blocks.ROWS_PER_BLOCK)) == blocks.ROWS_PER_BLOCK
