"""Write both outputs of a flow, computing its clean rows once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import fixed_point
from tidemark.operators.rows import round_floats
from tidemark.plans.flow import FlowResult, average
from tidemark.plans.policy import Policy
from tidemark.schemas import KEY, SALES_THRESHOLD
from tidemark.session import scratch_path, scratch_scope
from tidemark.sinks.files import write_csv, write_csv_headerless, write_csv_indexed
from tidemark.sinks.outputs import Output, run_if_incomplete
from tidemark.sinks.tables import Replacement, replace_tables


# How files without a header spell NULL.
HEADERLESS_NULL = "None"


@dataclass(frozen=True)
class Targets:
    """Where a run publishes; None leaves that output out."""

    clean_csv: str | None = None
    aggregate_csv: str | None = None
    clean_table: str | None = None
    aggregate_table: str | None = None
    clean_location: str | None = None
    aggregate_location: str | None = None


def publish(
    spark: SparkSession,
    policy: Policy,
    result: FlowResult,
    targets: Targets,
    threshold: float = SALES_THRESHOLD,
    exact_scale: int | None = 2,
) -> None:
    """Clean rows and means are written once each, every output reads those copies, and they go at the end.

    Caching would lose its blocks with their executors and then recompute fill and join; a
    written table does not. The first write fills ``result.metrics``. Both tables switch together, after the
    files are there; every output notes what it holds.
    """
    with scratch_scope(spark):
        path, means_path = scratch_path(spark, f"clean-{policy.name}"), scratch_path(spark, f"means-{policy.name}")
        result.keyed.write.parquet(path)
        result.metrics.fill()
        keyed = spark.read.schema(result.keyed.schema).parquet(path)
        means = average(policy, keyed.drop(KEY), threshold, exact_scale)
        # One row per month.
        means.coalesce(1).write.parquet(means_path)
        means = spark.read.schema(means.schema).parquet(means_path)
        _write_all(policy, keyed, means, targets)


def _write_all(policy: Policy, keyed: DataFrame, means: DataFrame, targets: Targets) -> None:
    clean = keyed.drop(KEY)
    if targets.clean_csv:
        if policy.files == "indexed":
            write_csv_indexed(
                keyed.withColumnRenamed(KEY, "__key"), targets.clean_csv, "__key",
                policy.index_name, policy.index_start, drop=["__key"], schema=_in_file(policy, clean.schema),
            )
        else:
            _write_plain(policy, clean, targets.clean_csv, clean.schema)
    if targets.aggregate_csv:
        _write_means(policy, means, targets.aggregate_csv)
    tables = [
        Replacement(round_floats(df) if policy.round_tables else df, table, df.schema, location)
        for df, table, location in (
            (clean, targets.clean_table, targets.clean_location),
            (means, targets.aggregate_table, targets.aggregate_location),
        )
        if table
    ]
    replace_tables(keyed.sparkSession, tables)


def _in_file(policy: Policy, schema: T.StructType) -> T.StructType:
    """The columns of an output's files."""
    index = [T.StructField(policy.index_name, T.LongType())] if policy.files == "indexed" else []
    return T.StructType([*index, *schema.fields])


def _write_plain(policy: Policy, df: DataFrame, path: str, schema: T.StructType) -> None:
    if policy.files == "headerless":
        write_csv_headerless(df, path, HEADERLESS_NULL, schema)
    else:
        write_csv(df, path, schema)


def _write_means(policy: Policy, means: DataFrame, path: str) -> None:
    schema = means.schema
    if policy.fixed_averages:
        text = fixed_point(F.col(policy.average_column), policy.decimals)
        means = means.withColumn(policy.average_column, text)
    if policy.files == "indexed":
        write_csv_indexed(
            means, path, policy.month_column, policy.index_name, policy.index_start, single_file=True,
            schema=_in_file(policy, schema),
        )
    else:
        _write_plain(policy, means, path, schema)


def expected_outputs(policy: Policy, result: FlowResult, targets: Targets) -> list[Output]:
    header = policy.files != "headerless"

    null = None if header else HEADERLESS_NULL
    order = (policy.index_name,) if policy.files == "indexed" else ()

    clean, means = result.clean.schema, result.aggregate.schema
    wanted = [
        # Sales may all be below the threshold.
        Output("clean_csv", targets.clean_csv, "csv", _in_file(policy, clean), header, True, null, order),
        Output("aggregate_csv", targets.aggregate_csv, "csv", _in_file(policy, means), header, True, null, order),
        Output("clean_table", targets.clean_table, "table", clean, may_be_empty=True),
        Output("aggregate_table", targets.aggregate_table, "table", means, may_be_empty=True),
    ]
    return [output for output in wanted if output.target]


def publish_if_incomplete(
    spark: SparkSession, policy: Policy, result: FlowResult, targets: Targets, contents: bool = True, **options
) -> bool:
    """Publish unless all targets are in order already; True if anything was written.

    With ``contents`` outputs count as in order only if they hold, row for row, what was noted when they were written.
    """
    return run_if_incomplete(
        spark,
        expected_outputs(policy, result, targets),
        lambda: publish(spark, policy, result, targets, **options),
        contents,
    )
