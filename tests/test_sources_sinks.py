"""Readers, writers and output checks on small files."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.plans import flow, policy, publish
from tidemark.session import scratch_path, tune
from tidemark.sinks import files as sinks
from tidemark.sinks import outputs, tables
from tidemark.sinks.client import to_client
from tidemark.sources import files, relational
from test_flows import economic, sales

CSV = '''whatever,the,header,says,here
1,1,2023-01-01,1,1000.50
2,1,,1,null
3,"1, or 2",2023-01-03,"say ""hi""",
4,2,2023-01-04
'''


@pytest.fixture
def sales_csv(tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(CSV)
    return str(path)


def test_positional_csv(spark, sales_csv):
    df = files.read_csv_positional(spark, sales_csv, schemas.SALES_FIELDS)
    assert df.columns == list(schemas.SALES_FIELDS)
    assert [tuple(r) for r in df.orderBy("index").collect()] == [
        ("1", "1", "2023-01-01", "1", "1000.50"),
        ("2", "1", "", "1", "null"),
        ("3", "1, or 2", "2023-01-03", 'say "hi"', ""),
        ("4", "2", "2023-01-04", None, None),
    ]
    blanks_null = files.read_csv_positional(spark, sales_csv, schemas.SALES_FIELDS, keep_blank=False)
    assert blanks_null.where("index = 2").first()["Date"] is None


def test_read_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    df.write.parquet(str(tmp_path / "t.parquet"))
    sinks.write_csv(df, str(tmp_path / "t.csv"))
    assert files.read_table(spark, str(tmp_path / "t.parquet")).dtypes == df.dtypes
    assert files.read_table(spark, str(tmp_path / "t.csv")).dtypes == [("id", "string"), ("name", "string")]
    assert files.read_table(spark, str(tmp_path / "t.csv"), df.schema).collect() == df.collect()


def test_bulk_load(spark, tmp_path):
    path = tmp_path / "load.csv"
    path.write_text("a,b,c,d,e\n1,2,2023-01-01,3,10.5\n2,2,2023-01-02,3,null\n")
    with pytest.raises(PySparkException, match="not a double: null"):
        files.bulk_load_csv(spark, str(path), "loads.strict_sales", schemas.SALES_TYPED)
    loaded = files.bulk_load_csv(spark, str(path), "loads.sales", schemas.SALES_TYPED, strict=False)
    assert loaded.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.SALES_TYPED]
    assert [r["Weekly_Sales"] for r in loaded.orderBy("index").collect()] == [10.5, None]


def test_jdbc_options():
    options = relational.jdbc_options("jdbc:x:y", "sales", "index", (0, 1000), 16, driver="d.Driver")
    assert options == {
        "url": "jdbc:x:y", "dbtable": "sales", "fetchsize": "10000", "driver": "d.Driver",
        "partitionColumn": "index", "lowerBound": "0", "upperBound": "1000", "numPartitions": "16",
    }
    with pytest.raises(ValueError):
        relational.jdbc_options("jdbc:x:y", "sales", "index")


def test_range_predicates_cover_every_row_once(spark):
    df = spark.createDataFrame([(i,) for i in [None, -5, 0, 3, 10, 11, 99]], "k int")
    for cuts in ([], [3], [0, 10, 50]):
        parts = [df.where(p).collect() for p in relational.range_predicates("k", cuts)]
        assert sum(len(p) for p in parts) == df.count()
        assert len(parts) == len(cuts) + 1


def test_headerless_csv_spells_null(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 10003.1)], "store int, cpi double, sales double")
    path = str(tmp_path / "plain")
    sinks.write_csv_headerless(df, path)
    assert [r["value"] for r in spark.read.text(path).collect()] == ["1,None,10003.1"]
    sinks.write_csv_headerless(df.limit(0), path)
    assert spark.read.text(path).count() == 0  # replaced, not appended


def test_averages_have_two_places(spark, tmp_path):
    df = spark.createDataFrame([(4, 40373.4)], "month int, mean double")
    sinks.write_averages_headerless(df, str(tmp_path / "mean"), "month", "mean")
    assert spark.read.text(str(tmp_path / "mean")).first()["value"] == "4,40373.40"


def test_indexed_csv(spark, tmp_path):
    df = spark.createDataFrame([(m, m * 1.5) for m in (2, 3, 1)], "Month int, Average_Weekly_Sales double")
    path = tmp_path / "indexed"
    sinks.write_csv_indexed(df, str(path), "Month", single_file=True)
    (part,) = path.glob("part-*.csv")
    assert part.read_text().splitlines() == [
        "index,Month,Average_Weekly_Sales", "0,1,1.5", "1,2,3.0", "2,3,4.5"]
    sinks.write_csv_indexed(df, str(path), "Month", start=1)
    rows = spark.read.option("header", True).csv(str(path)).orderBy("index").collect()
    assert [tuple(r) for r in rows] == [("1", "1", "1.5"), ("2", "2", "3.0"), ("3", "3", "4.5")]


def test_table_is_created_and_replaced(spark):
    df = spark.createDataFrame([("1", 2.5, "extra")], "Month string, Average_Weekly_Sales double, more string")
    for _ in range(2):
        tables.write_table(df, "marts.aggregated", schemas.AGGREGATE)
    stored = spark.table("marts.aggregated")
    assert stored.schema == schemas.AGGREGATE and [tuple(r) for r in stored.collect()] == [(1, 2.5)]


def test_partitioned_table(spark):
    df = spark.createDataFrame([(1, 2.5), (2, 3.5)], schemas.AGGREGATE)
    tables.write_table(df, "marts.by_month", schemas.AGGREGATE, partition_by="Month")
    assert sorted(spark.table("marts.by_month").select("Month", "Average_Weekly_Sales").collect()) == [(1, 2.5), (2, 3.5)]


def test_output_checks(spark, tmp_path):
    path = str(tmp_path / "out")
    wanted = [outputs.Output("out", path, "parquet", schemas.AGGREGATE)]
    assert outputs.missing_outputs(spark, wanted) == ["out"]
    df = spark.createDataFrame([(1, 2.5)], schemas.AGGREGATE)
    runs = []

    def job():
        runs.append(1)
        df.write.mode("overwrite").parquet(path)

    assert outputs.run_if_incomplete(spark, wanted, job) is True
    assert outputs.run_if_incomplete(spark, wanted, job) is False
    assert len(runs) == 1
    (tmp_path / "out" / "_SUCCESS").unlink()  # a job that died half-way
    assert outputs.run_if_incomplete(spark, wanted, job) is True
    df.limit(0).write.mode("overwrite").parquet(path)
    assert outputs.missing_outputs(spark, wanted) == ["out"]
    with pytest.raises(RuntimeError):
        outputs.run_if_incomplete(spark, [outputs.Output("never", path + "-never", "csv", schemas.AGGREGATE)], lambda: None)


def test_csv_output_with_another_header_is_not_accepted(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame([(1, 2.5)], "Month int, Mean double"), path)
    assert outputs.missing_outputs(spark, [outputs.Output("agg", path, "csv", schemas.AGGREGATE)]) == ["agg"]


def test_publish_and_rerun(spark, tmp_path):
    result = flow.run(
        policy.VALIDATED,
        sales(spark, ("1", "1", "2023-01-06", "3", "20000.5"), ("2", "2", "null", "4", "30000")),
        economic(spark, (1, 0, 211.0963582, "8.106")),
    )
    targets = publish.Targets(
        clean_csv=str(tmp_path / "clean"), aggregate_csv=str(tmp_path / "agg"),
        clean_table="published.clean", aggregate_table="published.aggregated",
    )
    assert publish.publish_if_incomplete(spark, policy.VALIDATED, result, targets) is True
    assert publish.publish_if_incomplete(spark, policy.VALIDATED, result, targets) is False
    assert spark.table("published.clean").schema == schemas.CLEAN
    assert [r["CPI"] for r in spark.table("published.clean").orderBy("CPI").collect()] == [0.0, 211.1]
    assert [tuple(r) for r in spark.table("published.aggregated").collect()] == [(1, 25000.25)]
    clean = spark.read.option("header", True).csv(str(tmp_path / "clean"))
    assert [(r["index"], r["CPI"], r["Weekly_Sales"]) for r in clean.orderBy("index").collect()] == [
        ("1", "211.0963582", "20000.5"), ("2", "0.0", "30000.0")]
    (part,) = (tmp_path / "agg").glob("part-*.csv")
    assert part.read_text() == "index,Month,Average_Weekly_Sales\n1,1,25000.25\n"


@pytest.mark.parametrize("name", sorted(policy.POLICIES))
def test_every_policy_publishes_and_then_has_nothing_to_do(spark, tmp_path, name):
    rules = policy.POLICIES[name]
    result = flow.run(
        rules,
        sales(spark, ("1", "1", "2023-01-06", "3", "20000.5"), ("2", "2", "2023-01-06", "4", "30000")),
        economic(spark, (1, 0, 211.0963582, "8.106"), (2, 0, None, "8.2")),
    )
    targets = publish.Targets(clean_csv=str(tmp_path / "clean"), aggregate_csv=str(tmp_path / "agg"))
    assert publish.publish_if_incomplete(spark, rules, result, targets) is True
    assert publish.publish_if_incomplete(spark, rules, result, targets) is False
    lines = sorted(r["value"] for r in spark.read.text(targets.aggregate_csv).collect())
    assert lines == {
        "headed": ["1,25000.0", "month,Avg_Sales"],
        "headerless": ["1,25000.25"],
        "indexed": sorted([
            f"{rules.index_start},1,25000.25", f"{rules.index_name},Month,{rules.average_column}"]),
    }[rules.files]
    if name == "fill_selected":
        assert "2,1,4,0,30000.0,None,8.2" in [r["value"] for r in spark.read.text(targets.clean_csv).collect()]


def test_scratch_path_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and first != second


def test_schema_contracts():
    assert schemas.CLEAN.fieldNames() == list(schemas.CLEAN_FIELDS)
    assert isinstance(schemas.AGGREGATE["Month"].dataType, T.IntegerType)


def test_to_client_is_bounded(spark):
    df = spark.createDataFrame([(1, 2.5), (2, 3.5)], schemas.AGGREGATE)
    assert list(to_client(df.orderBy("Month"), max_rows=2).index) == [0, 1]
    with pytest.raises(ValueError):
        to_client(df, max_rows=1)


def test_tune_sizes_the_shuffle(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        tune(spark, shuffle_bytes=10**14)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 476838
        tune(spark, shuffle_bytes=1)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 476838
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", ["drop_then_fill", "fill_selected", "validated"])
def test_a_rightly_empty_output_is_in_order(spark, tmp_path, name):
    rules = policy.POLICIES[name]
    result = flow.run(rules, sales(spark, ("1", "9", "2023-01-06", "3", "5")), economic(spark, (1, 0, 211.0, "8.1")))
    targets = publish.Targets(clean_csv=str(tmp_path / "clean"), aggregate_csv=str(tmp_path / "agg"))
    assert publish.publish_if_incomplete(spark, rules, result, targets) is True
    assert publish.publish_if_incomplete(spark, rules, result, targets) is False
