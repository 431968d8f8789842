"""Counts about a table: profile, zeros, conversion errors, stage metrics. One pass each."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.blocks import ROWS_PER_BLOCK, as_list

_FLOATING = (T.FloatType, T.DoubleType)
# Rows of a split of a file that are compared in one group.
RUN_ROWS = 1 << 16


def profile(df: DataFrame) -> DataFrame:
    """Per column: rows, missing (NULL or NaN), NULL only, and zeros (NULL for non-numeric)."""
    fields = df.schema.fields
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(fields):
        value = F.col(f"`{field.name}`")
        missing = value.isNull()
        if isinstance(field.dataType, _FLOATING):
            missing = missing | F.isnan(value)
        counts.append(F.count_if(missing).alias(f"missing_{i}"))
        counts.append(F.count_if(value.isNull()).alias(f"null_{i}"))
        if isinstance(field.dataType, T.NumericType):
            counts.append(F.count_if(value == 0).alias(f"zero_{i}"))
        else:
            counts.append(F.lit(None).cast("long").alias(f"zero_{i}"))
    one_row = df.agg(*counts)
    per_column = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"missing_{i}").alias("missing_count"),
                F.col(f"null_{i}").alias("null_count"),
                F.col(f"zero_{i}").alias("zero_count"),
            )
            for i, field in enumerate(fields)
        ]
    )
    return one_row.select(F.inline(per_column))


def zero_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) == 0)


def zero_counts(df: DataFrame, before: str, after: str) -> DataFrame:
    """Zeros in a measure before and after its repair."""
    return df.agg(
        F.count_if(F.col(before) == 0).alias("zeros_before"),
        F.count_if(F.col(after) == 0).alias("zeros_after"),
    )


def conversion_errors(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Per raw column, how many present values did not parse."""
    totals = df.agg(
        *[F.count_if(F.col(n).isNotNull() & p.isNull()).alias(n) for n, p in parsed.items()]
    )
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("column_name"), F.col(n).alias("error_count"))
                    for n in parsed
                ]
            )
        )
    )


class StageMetrics:
    """Counts of rows and NULLs at the stages of a flow, taken by the job that first runs them; no job of their own.

    A stage that a plan reads twice, through one shuffle, is counted where the shuffle is written. If a lost executor
    makes Spark write it again, its rows may count again: metrics tell about a run, and decide nothing.
    """

    def __init__(self, on: bool = False) -> None:
        self._on = on
        self._observations: dict[str, Observation] = {}
        self._values: dict[str, dict[str, int]] | None = None

    def watch(self, df: DataFrame, stage: str, columns: Sequence[str] = ()) -> DataFrame:
        if not self._on:
            return df
        df, self._observations[stage] = observe_stage(df, f"{stage}-{uuid.uuid4().hex}", columns)
        return df

    def fill(self) -> None:
        """Take over what the job that just ended has counted; later calls change nothing."""
        if self._on and self._values is None:
            self._values = {stage: dict(o.get) for stage, o in self._observations.items()}

    @property
    def values(self) -> dict[str, dict[str, int]]:
        """By stage and count, in the order of the flow."""
        if self._values is None:
            raise RuntimeError("stages are counted by the job that publishes a watched flow")
        return self._values

    def table(self, spark: SparkSession) -> DataFrame:
        """stage, metric, total."""
        rows = [(stage, name, int(total or 0)) for stage, found in self.values.items() for name, total in found.items()]
        return spark.createDataFrame(rows, "stage string, metric string, total bigint")


def observe_stage(
    df: DataFrame, stage: str, columns: Sequence[str] = ()
) -> tuple[DataFrame, Observation]:
    """Count rows and NULLs as they pass, at no extra pass; read ``observation.get`` after an action."""
    observation = Observation(stage)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
    return df.observe(observation, *metrics), observation


def check_sorted(df: DataFrame, order_by: str | Sequence[str]) -> DataFrame:
    """Whether files hold their rows in order: rows, breaks_within and breaks_between, one row.

    ``df`` is read straight from files that a sorted write made, whose names are in the order of their contents. Rows
    are compared with the one before them in runs of up to ``RUN_ROWS`` of the same split of a file, and runs by their
    first and last keys; only keys and places are shuffled, a run at a time, and one task sees one row for each run.
    """
    order = as_list(order_by)
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    placed = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), key.alias("key"),
    )
    # One task reads a split, and counts its rows up.
    placed = placed.withColumn("run", F.call_function("div", F.col("at"), F.lit(RUN_ROWS).cast("long")))
    run = ["file", "split", "run"]
    # By rows, as adaptive execution goes by compressed bytes, and names of files compress to nearly none.
    parts = -(-df.count() // (ROWS_PER_BLOCK // 2))
    placed = placed.repartition(max(1, parts), *run)
    within = Window.partitionBy(*run).orderBy("at")
    compared = placed.withColumn("before", F.lag("key").over(within))
    runs = compared.groupBy(*run).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") > F.col("key")).alias("breaks"),
        F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"),
    )
    # Names count up, beyond the digits that they are padded to.
    number = F.regexp_extract("file", "part-([0-9]+)", 1).try_cast("long")
    along = Window.orderBy(number, *run)
    same = (F.lag("file").over(along) == F.col("file")) & (F.lag("split").over(along) == F.col("split"))
    joined = runs.withColumns({"last_before": F.lag("last").over(along), "same": F.coalesce(same, F.lit(False))})
    broken = F.col("last_before") > F.col("first")
    return joined.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        (F.coalesce(F.sum("breaks"), F.lit(0)) + F.count_if(broken & F.col("same"))).alias("breaks_within"),
        F.count_if(broken & ~F.col("same")).alias("breaks_between"),
    )
