"""Flows on small hand-checked tables."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import joins
from tidemark.operators.aggregates import mean_by
from tidemark.operators.fill import forward_fill
from tidemark.plans import flow, policy, statements
from tidemark.plans.flow import parse_economic, parse_sales


def sales(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], schemas.SALES_TEXT)


ECONOMIC = "index bigint, IsHoliday int, CPI double, Unemployment string"


def economic(spark, *rows):
    return spark.createDataFrame(list(rows), ECONOMIC)


def repaired_sales(spark, rules, *rows, rows_per_block=100):
    table = flow.OrderedTable.align([parse_sales(rules, sales(spark, *rows))], "index", rows_per_block)[0]
    result = flow._repair_sales(rules, table).rows()
    return [
        (r["index"], r["Store_ID"], r["day"], r["Dept"], r["Weekly_Sales"])
        for r in result.withColumn("day", F.date_format("Date", "yyyy-MM-dd")).orderBy("index").collect()
    ]


@pytest.mark.parametrize("block", [1, 100])
def test_missing_values_take_the_previous_row(spark, block):
    assert repaired_sales(
        spark, policy.VALIDATED,
        ("1", "1", "2023-01-01", "1", "1000.50"),
        ("2", "1", "", "1", "2000.75"),
        ("3", "1", "2023-01-03", "1", ""),
        rows_per_block=block,
    ) == [
        (1, 1, "2023-01-01", 1, 1000.5),
        (2, 1, "2023-01-01", 1, 2000.75),
        (3, 1, "2023-01-03", 1, 2000.75),
    ]


def test_rows_with_bad_keys_are_dropped(spark):
    assert repaired_sales(
        spark, policy.VALIDATED,
        ("1", "1", "2023-01-01", "1", "1000.5"),
        ("2", "invalid", "2023-01-01", "1", "1500.25"),
        ("3", "2", "2023-01-01", "1", "1500.25"),
        ("invalid", "data", "row", "here", "now"),
    ) == [(1, 1, "2023-01-01", 1, 1000.5), (3, 2, "2023-01-01", 1, 1500.25)]


def test_economic_fill_crosses_stores(spark):
    raw = spark.createDataFrame(
        [("1", 1, 100.0, "5.0"), ("2", 1, None, "6.0"), ("3", 2, 102.0, None)],
        "index string, Store_ID int, CPI double, Unemployment string",
    )
    filled = forward_fill(parse_economic(policy.VALIDATED, raw), ["CPI", "Unemployment"], "index")
    assert [(r["index"], r["CPI"], r["Unemployment"]) for r in filled.orderBy("index").collect()] == [
        (1, 100.0, 5.0), (2, 100.0, 6.0), (3, 102.0, 6.0)]


def test_merge_of_two_sides(spark):
    left = spark.createDataFrame(
        [("0", "1", 100.0), ("1", "2", 200.0), ("7", "1", 300.0)], "index string, Store_ID string, Weekly_Sales double")
    right = spark.createDataFrame(
        [("0", 5.0, 100.0), ("1", 5.0, None), ("1", 6.0, 1.0), ("9", 5.0, 100.0)],
        "index string, Unemployment double, CPI double")
    merged = joins.cogroup_first_left(
        left, right, "index", None, ["Unemployment"], {"CPI": 0.0, "Unemployment": 0.0})
    assert sorted(tuple(r) for r in merged.collect()) == [
        ("0", "1", 100.0, 5.0, 100.0), ("1", "2", 200.0, 5.0, None), ("7", "1", 300.0, 0.0, 0.0)]


def test_mean_of_one_row(spark):
    df = spark.createDataFrame([(1, 2, 24924.50)], "Store_ID int, Month int, Weekly_Sales double")
    assert tuple(mean_by(df, "Month", "Weekly_Sales", "Average_Weekly_Sales").first()) == (2, 24924.5)


def test_leading_missing_value_is_dropped_by_validation_and_kept_elsewhere(spark):
    rows = (("1", "1", "null", "1", "50"), ("2", "1", "2023-01-02", "1", "60"))
    assert [r[0] for r in repaired_sales(spark, policy.VALIDATED, *rows)] == [2]
    assert [r[2] for r in repaired_sales(spark, policy.FILL_SELECTED, *rows)] == [None, "2023-01-02"]


def test_zero_sales(spark):
    rows = (("1", "1", "2023-01-01", "1", "50"), ("2", "1", "2023-01-01", "1", "0"), ("3", "1", "2023-01-01", "1", "null"))
    # Validation drops the zero, but the zero is what the next gap is filled with, so that goes too.
    assert [r[0] for r in repaired_sales(spark, policy.VALIDATED, *rows)] == [1]
    assert [r[4] for r in repaired_sales(spark, policy.ZERO_REPAIR, *rows)] == [50.0, 50.0, 50.0]


def test_bad_number_by_policy(spark):
    rows = (("1", "1", "2023-01-01", "1", "50"), ("2", "1", "2023-01-01", "1", "bad"), ("3", "1", "2023-01-01", "1", "null"))
    assert [r[4] for r in repaired_sales(spark, policy.FILL_SELECTED, *rows)] == [50.0, 50.0, 50.0]
    assert [r[4] for r in repaired_sales(spark, policy.COGROUP, *rows)] == [50.0, None, 50.0]
    with pytest.raises(PySparkException, match="not a double: bad"):
        flow.run(policy.DROP_THEN_FILL, sales(spark, *rows), economic(spark, (1, 0, 1.0, "1"), (2, 0, 1.0, "1"))).clean.collect()


def test_other_stores_feed_the_date_but_not_the_sales_fill(spark):
    rows = (
        ("1", "1", "2023-01-01", "1", "50"),
        ("2", "3", "2023-02-02", "1", "999"),
        ("3", "1", "null", "1", "null"),
    )
    assert repaired_sales(spark, policy.VALIDATED, *rows)[-1] == (3, 1, "2023-01-01", 1, 50.0)
    assert repaired_sales(spark, policy.ZERO_REPAIR, *rows)[-1] == (3, 1, "2023-02-02", 1, 50.0)


@pytest.mark.parametrize("block", [1, 100])
def test_whole_flow_for_each_policy(spark, block):
    raw = [
        ("1", "1", "2023-01-06", "3", "20000"),
        ("2", "2", "null", "4", "10000"),
        ("3", "1", "2023-02-03", "3", "null"),
        ("4", "9", "2023-02-10", "5", "40000"),
        ("5", "2", "2023-02-17", "4", "15000.5"),
    ]
    right = [(1, 0, 211.0, "8.1"), (2, 1, None, "8.2"), (3, 0, 212.0, "null"), (4, 0, 213.0, "8.4")]

    def run(rules, rows=raw):
        result = flow.run(rules, sales(spark, *rows), economic(spark, *right), rows_per_block=block, exact_scale=2)
        clean = sorted(tuple(r) for r in result.clean.collect())
        return clean, sorted(tuple(r) for r in result.aggregate.collect())

    # Row 3 dropped for its missing sales; row 5 has no economic row; row 2 is not above 10000.
    assert run(policy.DROP_THEN_FILL) == (
        [(1, 1, 3, 0, 20000.0, 211.0, "8.1"), (9, 2, 5, 0, 40000.0, 213.0, "8.4")], [(1, 20000.0), (2, 40000.0)])
    # Row 3 takes the sales of row 2 and so stays below; CPI is not filled, Unemployment is.
    assert run(policy.FILL_SELECTED) == (
        [(1, 1, 3, 0, 20000.0, 211.0, 8.1), (9, 2, 5, 0, 40000.0, 213.0, 8.4)], [(1, 20000.0), (2, 40000.0)])
    # Left join: row 5 stays, without economic values.
    clean, means = run(policy.COGROUP)
    assert (2, 2, 4, None, 15000.5, None, None) in clean and means == [(1, 20000.0), (2, 27500.25)]
    # No threshold on clean rows; store 9 is out; defaults where no economic row exists.
    clean, means = run(policy.VALIDATED)
    assert clean == [
        (1, 1, 3, 0, 20000.0, 211.0, 8.1), (1, 2, 3, 0, 10000.0, 212.0, 8.2),
        (2, 1, 4, 0, 10000.0, 211.0, 8.2), (2, 2, 4, 0, 15000.5, 0.0, 0.0)]
    assert means == [(1, 20000.0), (2, 15000.5)]
    clean, means = run(policy.ZERO_REPAIR)
    assert clean == [
        (1, 1, 3, False, 20000.0, 211.0, 8.1), (1, 2, 3, False, 10000.0, 212.0, 8.2),
        (2, 1, 4, True, 10000.0, 211.0, 8.2)]
    assert means == [(1, 15000.0), (2, 10000.0)]
    # Four-byte measures, mean rounded to whole numbers.
    clean, means = run(policy.FILL_ALL)
    assert means == [(1, 20000.0), (2, 40000.0)] and len(clean) == 2


def test_flow_without_threshold_differs_from_flow_with(spark):
    left = sales(spark, ("1", "1", "2023-01-06", "3", "5"), ("2", "1", "2023-01-06", "3", "20000"))
    right = economic(spark, (1, 0, 1.0, "1"), (2, 0, 1.0, "1"))
    for where, count in (("both", 1), ("none", 2), ("aggregate", 2)):
        rules = replace(policy.FILL_SELECTED, threshold_on=where)
        assert flow.run(rules, left, right).clean.count() == count


def test_sql_flow(spark):
    left = sales(
        spark,
        ("1", "1", "2023-01-06", "3", "20000.25"), ("2", "2", "null", "4", "30000"),
        ("3", "1", "2023-02-03", "3", "null"), ("4", "9", "2023-02-10", "5", "40000"), ("5", "2", "2023-02-17", "4", "15000.5"),
    )
    clean, aggregate = statements.run_sql(spark, left, economic(spark, (1, 0, 211.126, "8.1")), ordered=True)
    assert [tuple(map(str, r)) for r in clean.collect()] == [
        ("1", "1", "3", "20000.25", "211.13", "8.10"), ("2", "2", "4", "15000.50", "None", "None")]
    assert [tuple(map(str, r)) for r in aggregate.collect()] == [("1", "20000.25"), ("2", "15000.50")]
    assert dict(aggregate.dtypes) == {"month": "int", "Avg_Sales": "decimal(10,2)"}


def test_first_per_key_with_one_key_holding_most_rows(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7919 % 5003).alias("place"), F.concat(F.lit("r"), "id").alias("name"),
    )
    best = {}
    for row in df.collect():
        best[row["k"]] = min(best.get(row["k"], (10**9,)), (row["place"], row["name"]))
    picked = joins.first_per_key(df.repartition(7), "k", "place").collect()
    assert {r["k"]: (r["place"], r["name"]) for r in picked} == best and len(picked) == len(best)


def test_fill_after_join_refuses_several_rows_per_key(spark):
    with pytest.raises(ValueError):
        flow.run(policy.DROP_THEN_FILL, sales(spark), economic(spark), economic_order=["index", "CPI"])


@pytest.mark.parametrize("block", [1, 100])
def test_both_sides_keep_their_first_row_and_clashes_follow_the_policy(spark, block):
    left = spark.createDataFrame(
        [("1", "1", "2023-01-06", "3", "20000", 2), ("1", "2", "2023-03-06", "4", "30000", 1),
         ("2", "2", "2023-02-06", "4", "null", 1), ("2", "1", "2023-02-07", "4", "50000", 2), ("9", "1", "2023-02-07", "4", "60000", 1)],
        "index string, Store_ID string, Date string, Dept string, Weekly_Sales string, copy int",
    )
    right = spark.createDataFrame(
        [(1, 7, 0, 211.0, "8.1", 2), (1, 8, 1, 212.0, "8.2", 1), (2, None, 0, None, "8.3", 1)],
        "index bigint, Store_ID int, IsHoliday int, CPI double, Unemployment string, line int",
    )

    def run(rules):
        result = flow.run(
            rules, left, right, sales_order=["index", "copy"], economic_order=["index", "line"], rows_per_block=block
        )
        return sorted((tuple(r) for r in result.clean.collect()), key=str)

    # Key 2 takes its sales from the last row of key 1; the right store wins where a right row is, NULL or not.
    assert sorted(map(str, run(policy.COGROUP))) == sorted(map(str, [
        (8, 3, 4, 1, 30000.0, 212.0, 8.2), (None, 2, 4, 0, 20000.0, None, 8.3), (1, 2, 4, None, 60000.0, None, None)]))
    assert run(policy.VALIDATED) == [
        (1, 2, 4, 0, 60000.0, 0.0, 0.0), (2, 2, 4, 0, 20000.0, 211.0, 8.3), (2, 3, 4, 0, 30000.0, 212.0, 8.2)]


def test_flow_result_carries_rejects_and_errors(spark):
    left = sales(spark, ("1", "1", "2023-01-06", "3", "bad"), ("x", "1", "no date", "3", "1"), ("3", "y", "null", "3", ""))
    result = flow.run(policy.VALIDATED, left, economic(spark, (1, 0, 1.0, "worse")))
    assert sorted(r["index"] for r in result.rejected.collect()) == ["3", "x"]
    assert {r["column"]: r["n_bad"] for r in result.errors.collect()} == {"Date": 1, "Weekly_Sales": 1, "CPI": 0, "Unemployment": 1}
    assert flow.run(policy.COGROUP, left, economic(spark)).rejected.count() == 0
