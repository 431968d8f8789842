"""Replaced tables, contents and order of outputs, rejected lines, scratch and stage metrics."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.fill import forward_fill
from tidemark.operators.index import row_index, row_index_in_files
from tidemark.operators.quality import StageMetrics, check_sorted
from tidemark.session import scratch_path, scratch_scope
from tidemark.sinks import contents, files as sinks, outputs, tables
from tidemark.sources import files

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v double")


def failing(spark):
    return spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") < 99, 1.0).otherwise(F.raise_error(F.lit("no"))).alias("v"))


@pytest.mark.parametrize("placed", [False, True])
def test_failed_replacement_leaves_the_old_rows(spark, tmp_path, placed):
    name, location = f"swaps.failed_{placed}".lower(), f"file://{tmp_path}/failed" if placed else None
    tables.write_table(frame(spark, [(1, 1.0)]), name, SCHEMA, location)
    with pytest.raises(PySparkException):
        tables.write_table(failing(spark), name, SCHEMA, location)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, 1.0)]
    tables.write_table(frame(spark, [(2, 2.0)]), name, SCHEMA, location)
    assert [tuple(r) for r in spark.table(name).collect()] == [(2, 2.0)]


def test_old_versions_go_but_the_last(spark, tmp_path):
    root = tmp_path / "versions"
    for i in range(4):
        tables.write_table(frame(spark, [(i, 0.0)]), "swaps.versions", SCHEMA, f"file://{root}")
        assert spark.table("swaps.versions").first()["k"] == i
    assert len(list(root.iterdir())) == 2
    tables.drop_table(spark, "swaps.versions", f"file://{root}")
    assert not list(root.iterdir()) and not spark.catalog.tableExists("swaps.versions")


def test_other_columns_and_partitions_change_names(spark):
    wide = T.StructType([*SCHEMA.fields, T.StructField("name", T.StringType())])
    tables.write_table(frame(spark, [(1, 1.0)]), "swaps.shape", SCHEMA)
    tables.write_table(frame(spark, [(2, 2.0)]).withColumn("name", F.lit("x")), "swaps.shape", wide)
    assert [tuple(r) for r in spark.table("swaps.shape").collect()] == [(2, 2.0, "x")]
    for rows in ([(1, 1.0), (2, 2.0)], [(3, 3.0)]):
        tables.write_table(frame(spark, rows), "swaps.shape", SCHEMA, partition_by="k")
        assert sorted((r.k, r.v) for r in spark.table("swaps.shape").collect()) == rows
    assert {t.name for t in spark.catalog.listTables("swaps") if t.name.startswith("shape")} == {"shape"}


def test_a_table_of_another_writer_is_replaced_and_its_files_stay(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS swaps")
    frame(spark, [(1, 1.0)]).write.mode("overwrite").saveAsTable("swaps.foreign")
    tables.write_table(frame(spark, [(5, 5.0)]), "swaps.foreign", SCHEMA)
    assert [tuple(r) for r in spark.table("swaps.foreign").collect()] == [(5, 5.0)]


def test_tables_switch_together_or_not_at_all(spark, monkeypatch):
    one, two = frame(spark, [(1, 1.0)]), frame(spark, [(2, 2.0)])

    def both(a, b, **more):
        tables.replace_tables(spark, [tables.Replacement(a, "swaps.a", SCHEMA), tables.Replacement(b, "swaps.b", SCHEMA, **more)])

    both(one, one)
    with pytest.raises(tables.ContractBroken, match="no rows"):
        both(two, two.limit(0), may_be_empty=False)
    with pytest.raises(tables.ContractBroken, match="NULL"):
        both(two, two.withColumn("v", F.lit(None)), required=("v",))
    point, calls = tables._point, []

    def second_fails(spark, staged):
        calls.append(staged)
        if len(calls) == 2:
            raise RuntimeError("catalog away")
        return point(spark, staged)

    monkeypatch.setattr(tables, "_point", second_fails)
    with pytest.raises(RuntimeError):
        both(two, two)
    assert [spark.table(f"swaps.{t}").first()["k"] for t in "ab"] == [1, 1]


def test_changed_files_are_reported(spark, tmp_path):
    def output(name):
        sinks.write_csv(frame(spark, [(i, i / 3) for i in range(100)]).repartition(3), str(tmp_path / name), SCHEMA)
        return outputs.Output(name, str(tmp_path / name), "csv", SCHEMA)

    wanted = [output(n) for n in ("sound", "cut", "double", "text", "value")]
    parts = {o.name: sorted((tmp_path / o.name).glob("part-*.csv"))[0] for o in wanted}
    lines = {name: part.read_text().splitlines() for name, part in parts.items()}
    parts["cut"].write_text("\n".join(lines["cut"][:-2]) + "\n")
    parts["double"].with_name("part-99999-copy.csv").write_text(parts["double"].read_text())
    parts["text"].write_text("\n".join([*lines["text"][:-1], lines["text"][-1].split(",")[0] + ",much"]) + "\n")
    parts["value"].write_text("\n".join([*lines["value"][:-1], lines["value"][-1].split(",")[0] + ",0.125"]) + "\n")
    for folder in tmp_path.iterdir():
        for crc in folder.glob(".*.crc"):
            crc.unlink()
    found = {r.output: r.problem for r in outputs.check_contents(spark, wanted).collect()}
    assert found == {"sound": None, "cut": "rows", "double": "rows", "text": "not of its type: v", "value": "values"}
    assert outputs.missing_outputs(spark, wanted) == []
    assert sorted(outputs.missing_outputs(spark, wanted, contents=True)) == ["cut", "double", "text", "value"]


def test_truncated_parquet_of_a_table_is_reported(spark, tmp_path):
    tables.write_table(frame(spark, [(i, 1.0) for i in range(1000)]), "swaps.truncated", SCHEMA, f"file://{tmp_path}/t")
    wanted = [outputs.Output("t", "swaps.truncated", "table", SCHEMA)]
    assert outputs.missing_outputs(spark, wanted, contents=True) == []
    for part in tmp_path.glob("t/version-*/part-*.parquet"):
        part.write_bytes(part.read_bytes()[:-20])
        part.with_name(f".{part.name}.crc").unlink()
    spark.catalog.refreshTable("swaps.truncated")
    assert [r.problem for r in outputs.check_contents(spark, wanted).collect()] == ["unreadable"]


def test_notes_agree_between_text_and_tables(spark, tmp_path):
    schema = T.StructType([*SCHEMA.fields, T.StructField("s", T.StringType()), T.StructField("b", T.BooleanType())])
    rows = spark.createDataFrame([(None, None, None, None), (1, -0.0, 'a "b", c', True), (2, 1e-300, "", False), (2, float("nan"), "é", None)], schema)
    notes = []
    for repeat in (rows, rows.repartition(5)):
        sinks.write_csv(repeat, str(tmp_path / "csv"), schema)
        sinks.write_csv_headerless(repeat, str(tmp_path / "plain"), schema=schema)
        tables.write_table(repeat, "swaps.notes", schema, f"file://{tmp_path}/notes")
        notes += [contents.noted(spark, p) for p in (str(tmp_path / "csv"), str(tmp_path / "plain"), tables.table_location(spark, "swaps.notes"))]
    assert len(set(notes)) == 1 and notes[0][0] == 4
    wanted = [outputs.Output("csv", str(tmp_path / "csv"), "csv", schema), outputs.Output("plain", str(tmp_path / "plain"), "csv", schema, False, null="None")]
    assert outputs.missing_outputs(spark, wanted, contents=True) == []


@pytest.mark.parametrize("key", ["k", "name"])
def test_indexed_files_lie_in_the_order_of_their_names(spark, tmp_path, key):
    """By arithmetic blocks, and by a sort where a text order can't be cut; some rows have no key."""
    rows = spark.range(2000).select(
        F.when(F.col("id") % 50 > 0, F.col("id") * 37 % 2003).alias("k"), F.format_string("n%05d", F.col("id") * 37 % 2003).alias("name"), "id"
    ).repartition(5)
    path = tmp_path / "indexed"
    sinks.write_csv_indexed(rows, str(path), [key, "id"], start=1, rows_per_block=100)
    read = [line.split(",") for part in sorted(path.glob("part-*.csv")) for line in part.read_text().splitlines()[1:]]
    assert [int(r[0]) for r in read] == list(range(1, 2001))
    want = [r.id for r in rows.orderBy(key, "id").collect()]
    assert [int(r[3]) for r in read] == want
    assert key == "name" or len(list(path.glob("part-*.csv"))) > 3  # a small sort may be one part
    stored = spark.read.schema("index long, k long, name string, id long").option("header", True).csv(str(path))
    assert tuple(check_sorted(stored, "index").first()) == (2000, 0, 0)
    back = check_sorted(stored, "id").first()
    assert back["breaks_within"] > 0


def test_layout_needs_one_shuffle_of_rows(spark):
    rows = spark.range(5000).withColumn("v", F.rand(1))
    text = row_index_in_files(rows, "id", rows_per_block=100)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text
    wide = [line for line in text.split("\n") if "Exchange" in line and "Broadcast" not in line and "SinglePartition" not in line and "__part" in line]
    assert len([line for line in wide if "REPARTITION_BY" in line]) == 1
    assert len(wide) == 2  # and one of counts


def test_rejected_lines(spark, tmp_path):
    lines = ["a,b,c", "1,2,3", '1,"x, ""y""",3', "1,2,3,4,5", '"x', '1,2"2,3', "1,2", "", ",,", '1,"open,3', 'a,"b"c,d']
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    good, bad = files.read_csv_checked(spark, str(tmp_path / "in.csv"), ["p", "q", "r"])
    assert [tuple(r) for r in good.collect()] == [("1", "2", "3"), ("1", 'x, "y"', "3"), ("1", "2", None), ("", "", "")]
    assert {r.line: r.reason for r in bad.collect()} == {
        "1,2,3,4,5": "surplus fields", '"x': "quotes", '1,2"2,3': "quotes", '1,"open,3': "quotes", 'a,"b"c,d': "quotes"}
    assert all(r.file.endswith("in.csv") and r.offset == 0 for r in bad.collect())
    good, bad = files.read_csv_checked(spark, str(tmp_path / "in.csv"), ["p", "q", "r"], header=False, short_lines=False, keep_blank=False)
    assert "1,2" in {r.line for r in bad.where("reason = 'missing fields'").collect()}
    assert [tuple(r) for r in good.collect()] == [("a", "b", "c"), ("1", "2", "3"), ("1", 'x, "y"', "3"), (None, None, None)]


def test_scratch_goes_with_its_scope(spark, tmp_path):
    with scratch_scope(spark):
        path = scratch_path(spark, "scoped")
        spark.range(3).write.parquet(path)
        with scratch_scope(spark):
            row_index(spark.range(300).select(F.format_string("t%d", "id").alias("t")), "t", rows_per_block=10).count()
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(PySparkException):
        spark.read.parquet(path)


@pytest.mark.parametrize("text", [False, True])
def test_many_hot_keys_stay_off_the_driver(spark, monkeypatch, text):
    """More than 100,000 keys above the block size: numbers of them reach the driver, keys don't."""
    from pyspark.sql.classic.dataframe import DataFrame

    keys = 100_500
    key = F.format_string("key-%d", F.col("id") % keys) if text else F.col("id") % keys
    rows = spark.range(2 * keys).select("id", key.alias("k"), F.when(F.col("id") < keys, F.col("id")).alias("v"))
    collected = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(len(found := collect(self))) or found)
    filled = forward_fill(rows, "v", "id", "k", rows_per_block=1)
    wrong = filled.where(F.col("v") != F.col("id") % keys).limit(1)
    assert wrong.isEmpty() and filled.where("v is null").isEmpty()
    assert max(collected, default=0) <= 2


def test_metrics_are_of_a_published_flow_only(spark):
    metrics = StageMetrics(True)
    watched = metrics.watch(spark.range(10).withColumn("v", F.when(F.col("id") > 3, 1)), "numbers", ["v"])
    with pytest.raises(RuntimeError):
        metrics.values
    watched.write.format("noop").mode("overwrite").save()
    metrics.fill()
    assert metrics.values == {"numbers": {"rows": 10, "nulls_v": 4}}
    assert StageMetrics().watch(spark.range(1), "off").columns == ["id"]
