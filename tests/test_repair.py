"""Column functions, row by row."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import numbers, repair, text
from tidemark.operators import aggregates, rows


def apply(spark, values, kind, function):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(function(F.col("x"))).collect()]


def test_missing_tokens(spark):
    raw = ["null", "None", "", "NULL", None, "7"]
    assert apply(spark, raw, "string", lambda c: repair.missing_to_null(c, schemas.TOKEN_NULL)) == [
        None, "None", "", "NULL", None, "7"]
    assert apply(spark, raw, "string", lambda c: repair.missing_to_null(c, schemas.TOKENS_NULL_NONE_BLANK)) == [
        None, None, None, "NULL", None, "7"]
    assert apply(spark, raw, "string", lambda c: repair.is_missing(c, schemas.TOKENS_NULL_NONE)) == [
        True, True, False, False, True, False]


@pytest.mark.parametrize(
    "raw, number",
    [("1000.50", 1000.5), (" 7 ", 7.0), ("-3e2", -300.0), ("", None), ("bad", None), ("5d", None), ("5.F", None),
     ("0x10", None), ("NaN", None), (None, None), ("1,000", None)],
)
def test_try_number(spark, raw, number):
    assert apply(spark, [raw], "string", repair.try_number) == [number]


def test_try_number_of_whole_numbers(spark):
    assert apply(spark, ["5", "5.5", "x", None], "string", lambda c: repair.try_number(c, "bigint")) == [
        5, None, None, None]


def test_try_date(spark):
    def day(column):
        return F.date_format(repair.try_date(column), "yyyy-MM-dd")

    raw = ["2023-01-05", "2023-01-05T10:00:00", "2023", "12:30", "not-a-date", "2023-02-30", None]
    assert apply(spark, raw, "string", day) == ["2023-01-05", "2023-01-05", None, None, None, None, None]


def test_strict_cast_passes_null_and_fails_on_text(spark):
    assert apply(spark, ["1.5", None], "string", lambda c: repair.strict_cast(c, "double")) == [1.5, None]
    with pytest.raises(PySparkException, match="not a double: bad"):
        apply(spark, ["bad"], "string", lambda c: repair.strict_cast(c, "double"))


def test_zero_nan_and_flags(spark):
    assert apply(spark, [0.0, 2.0, None], "double", repair.zero_to_null) == [None, 2.0, None]
    assert apply(spark, [float("nan"), 2.0, None], "double", repair.nan_to_null) == [None, 2.0, None]
    assert apply(spark, [0, 1, None], "int", repair.flag_to_boolean) == [False, True, True]


def test_month_of_text(spark):
    assert apply(spark, ["2023-07-01", "2023-7-01", "x", None], "string", repair.month_of_text) == [
        7, None, None, None]


def test_rounding_modes(spark):
    values = [0.125, 2.675, -0.125, 0.135]
    assert apply(spark, values, "double", lambda c: numbers.round_to(c, 2)) == [0.13, 2.68, -0.13, 0.14]
    assert apply(spark, values, "double", lambda c: numbers.round_to(c, 2, "half_even")) == [0.12, 2.68, -0.12, 0.14]
    with pytest.raises(ValueError):
        numbers.round_to(F.lit(1), 2, "up")


@pytest.mark.parametrize(
    "values, decimals, mode, mean",
    [
        ([0.01, 0.02], 2, "half_up", 0.02), ([0.01, 0.02], 2, "half_even", 0.02),
        ([0.02, 0.03], 2, "half_up", 0.03), ([0.02, 0.03], 2, "half_even", 0.02),
        ([-0.02, -0.03], 2, "half_up", -0.03), ([-0.02, -0.03], 2, "half_even", -0.02),
        ([1.0, 2.0], 0, "half_up", 2.0), ([1.0, 2.0, 2.0], 0, "half_up", 2.0), ([0.5, None], 0, "half_even", 0.0),
        ([9e15 / 100] * 3, 2, "half_up", 9e15 / 100), ([None], 2, "half_up", None),
    ],
)
def test_exact_mean(spark, values, decimals, mode, mean):
    df = spark.createDataFrame([(1, v) for v in values], "k int, v double")
    result = aggregates.mean_by(df, "k", "v", "m", decimals, mode, exact_scale=2).first()
    assert result["m"] == mean


def test_mean_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert aggregates.mean_by(df, None, "v", "m", empty=0.0).first()["m"] == 0.0
    assert aggregates.mean_by(df, None, "v", "m", empty=0.0, exact_scale=2).first()["m"] == 0.0


def test_text(spark):
    assert apply(spark, [1234567.891, None], "double", text.fixed_point) == ["1234567.89", None]
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert df.select(text.delimited([F.col("a"), F.col("b"), F.col("c")])).first()[0] == "1,,x"
    assert df.select(text.delimited([F.col("a"), F.col("b")], blank="None")).first()[0] == "1,None"


def test_threshold_is_strict_and_tolerant(spark):
    df = spark.createDataFrame([("10000",), ("10000.01",), ("bad",), (None,)], "Weekly_Sales string")
    assert [r[0] for r in rows.above_threshold_tolerant(df).collect()] == ["10000.01"]
    assert rows.above_threshold_tolerant(df, "absent").count() == 0


def test_require_truthy(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, None)], "id int, v double")
    assert [r["id"] for r in rows.require_truthy(df, ["v"]).collect()] == [2]


def test_split_rejects(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "index string, name string")
    good, bad = rows.split_rejects(df, {"index": "bigint"})
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert sorted(r["name"] for r in bad.collect()) == ["b", "c"]


def test_project_typed_uses_defaults_only_for_absent_columns(spark):
    df = spark.createDataFrame([("1", None)], "Store_ID string, CPI double")
    row = rows.project_typed(df, schemas.CLEAN, {"IsHoliday": 0, "CPI": 9.0}).first()
    assert (row["Store_ID"], row["CPI"], row["IsHoliday"], row["Month"]) == (1, None, 0, None)


def test_round_floats(spark):
    df = spark.createDataFrame([(1.239, 5, "1.239")], "a double, b int, c string")
    assert tuple(rows.round_floats(df).first()) == (1.24, 5, "1.239")
