"""The shape of physical plans: what must not be there at scale, and what must."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.operators import aggregates, joins, rows
from tidemark.operators.fill import forward_fill
from workload import inputs


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    """Test tables are tiny; large ones would not be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def below(text: str, node: str) -> list[str]:
    """For each line with ``node``, the part of the plan under it."""
    lines = text.split("\n")

    def depth(line: str) -> int:
        return len(re.match(r"[\s:+\-|]*", line).group())

    found = []
    for i, line in enumerate(lines):
        if node in line:
            under = []
            for following in lines[i + 1 :]:
                if following.strip() and depth(following) <= depth(line):
                    break
                under.append(following)
            found.append("\n".join(under))
    return found


def test_block_fill_collects_only_block_rows_in_one_task(spark, sf_dir):
    events = inputs.dirty_events(spark, sf_dir)
    text = plan(forward_fill(events, ["value"], "event_id", rows_per_block=100))
    single = below(text, "Exchange SinglePartition")
    assert len(single) == 1
    assert "max_by" in single[0].split("\n")[0]  # the per-block aggregate, not the table


def test_plain_fill_is_the_single_partition_form(spark, sf_dir):
    text = plan(forward_fill(inputs.dirty_events(spark, sf_dir), ["value"], "event_id"))
    assert "Exchange SinglePartition" in text


def test_fill_reads_only_needed_columns(spark, sf_dir):
    events = inputs.dirty_events(spark, sf_dir)
    filled = forward_fill(events, ["value", "event_type"], "event_id", rows_per_block=100)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(filled.select("event_id", "value")))
    assert schemas and all("props" not in s and "ts" not in s for s in schemas)


def test_join_after_block_fill_needs_no_further_shuffle_or_sort(spark, sf_dir, no_auto_broadcast):
    text = plan(contract.queries()["flow_fill_all_blocks_clean"](spark, sf_dir))
    under = below(text, "SortMergeJoin [__block")[0]
    first_line = under.split("\n")[0]
    assert "Exchange" not in first_line and "Sort" not in first_line
    for line in under.split("\n"):
        if "Exchange hashpartitioning" in line:
            assert re.search(r"hashpartitioning\((__block|__carry___block|index)#", line)
    # The join sits right on the two fills: walking down from it, a window comes before any shuffle.
    for branch in under.split("\n   +- Project")[:1]:
        assert branch.find("Window") < branch.find("Exchange hashpartitioning")


def test_filter_goes_below_the_join(spark, sf_dir, no_auto_broadcast):
    left = inputs.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "index")
    joined = joins.join_inner(left, inputs.lines(spark, sf_dir), "index")
    text = plan(rows.above_threshold(joined, "o_totalprice", 100000.0))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_totalprice,100000.0\)", text)


def test_filter_does_not_pass_the_fill(spark, sf_dir):
    events = inputs.dirty_events(spark, sf_dir)
    text = plan(forward_fill(events, ["value"], "event_id").where("user_id = 3"))
    assert all("user_id" not in pushed for pushed in re.findall(r"PushedFilters: \[([^\]]*)\]", text))


def test_mean_combines_before_the_shuffle(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
    text = plan(aggregates.mean_by(orders, "month", "o_totalprice", "average", exact_scale=2))
    (under,) = below(text, "Exchange hashpartitioning(month")
    assert "HashAggregate" in under.split("\n")[0] and "partial_" in under.split("\n")[0]


def test_exact_mean_of_doubles_combines_before_the_shuffle(spark, sf_dir):
    """Rows shuffle as sums by group and power; what is gathered is a row for each power."""
    orders = inputs.table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
    text = plan(aggregates.mean_by(orders, "month", "o_totalprice", "average"))
    assert "SortAggregate" not in text and "Python" not in text
    rows = [u for u in below(text, "Exchange hashpartitioning(month") if "FileScan" in u]
    assert all("HashAggregate" in u.split("\n")[0] and "partial_" in u.split("\n")[0] for u in rows)


def test_first_per_key_combines_before_the_shuffle(spark, sf_dir):
    text = plan(joins.first_per_key(inputs.lines(spark, sf_dir), "index", inputs.LINE_ORDER))
    (under,) = below(text, "Exchange hashpartitioning(index")
    assert "WindowGroupLimit" in under.split("\n")[0] and "Partial" in under.split("\n")[0]
    assert "SortAggregate" not in text


def test_no_sort_aggregate_in_first_rows_and_text_tails(spark, sf_dir):
    assert "SortAggregate" not in plan(contract.queries()["cogroup_first_left"](spark, sf_dir))
    events = inputs.dirty_events(spark, sf_dir)
    assert "SortAggregate" not in plan(forward_fill(events, ["event_type", "value"], "event_id", rows_per_block=100))


def executed(df) -> str:
    """The plan that ran, with what it reused."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["flow_drop_then_fill_blocks_clean", "flow_zero_repair_blocks_clean", "flow_validated_blocks_clean"])
def test_a_flow_walks_each_table_once(spark, sf_dir, no_auto_broadcast, name):
    """Rows and the last values of blocks come from one shuffle: a scan for each table, one join of the two."""
    text = executed(contract.queries()[name](spark, sf_dir))
    assert text.count("Scan parquet") == 2
    assert len(re.findall(r"SortMergeJoin[^\n]*index#", text)) == 1
    assert "ReusedExchange" in text


@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if n.startswith("flow_") and "published" not in n))
def test_no_python_in_flows_and_no_cross_join(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "NestedLoop"):
        assert node not in text


def test_left_join_reads_only_projected_columns(spark, sf_dir):
    left = inputs.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "index")
    text = plan(joins.join_left(left, inputs.lines(spark, sf_dir), "index", ["index", "o_totalprice", "price"]))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {
        "o_orderkey:bigint,o_totalprice:double", "l_orderkey:bigint,l_extendedprice:double"}


def test_text_carry_is_not_forced_into_a_broadcast(spark, sf_dir, no_auto_broadcast):
    """Its rows are bounded, its size is not; the join then uses the layout of the fill."""
    events = inputs.dirty_events(spark, sf_dir)
    assert "BroadcastHashJoin" in plan(forward_fill(events, ["value"], "event_id", rows_per_block=100))
    text = plan(forward_fill(events, ["event_type"], "event_id", rows_per_block=100))
    joins_of_texts = [u for u in re.findall(r"\n[^\n]*Join[^\n]*", text) if "__carry_" in u]
    assert any("SortMergeJoin" in j for j in joins_of_texts)
    (under,) = [u for u in below(text, "SortMergeJoin") if "Window" in "".join(u.split("\n")[:3])]
    assert "Exchange" not in "".join(under.split("\n")[:3])


@pytest.mark.parametrize("name", ["flow_cogroup_blocks_clean", "flow_validated_duplicates_blocks_clean"])
def test_first_rows_per_key_are_taken_on_the_layout_of_the_fill(spark, sf_dir, no_auto_broadcast, name):
    """One shuffle per table for fill, first row per key and join."""
    text = plan(contract.queries()[name](spark, sf_dir))
    join = text.find("SortMergeJoin [__block")
    assert join > 0
    assert "row_number()" in text[join:]
    assert "hashpartitioning(index" not in text[join:]
