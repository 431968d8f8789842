"""One query per operator and flow; each reads whole tables of ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import numbers, repair, text
from tidemark.operators import aggregates, joins, quality, rows
from tidemark.operators.blocks import ROWS_PER_BLOCK
from tidemark.operators.fill import forward_fill
from tidemark.operators.index import row_index
from tidemark.plans import flow, policy, publish, statements
from tidemark.session import scratch_path, tune
from tidemark.sinks import files as csv_sinks
from tidemark.sinks import contents, outputs, tables
from tidemark.sinks.tables import write_table
from tidemark.sources import files
from workload import inputs
from workload.inputs import LINE_ORDER, THRESHOLD

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Blocks that a table of the block-wise queries is cut into; more where they would pass the library's size of a block.
BLOCKS = 7


def query(function: Query) -> Query:
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    REGISTRY[function.__name__] = tuned
    return function


def _catalog_schema(spark: SparkSession) -> str:
    """A catalog schema whose folder is scratch too, so that nothing lands in the working folder."""
    location = scratch_path(spark, "schema")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS tidemark_check LOCATION '{location}'")
    return "tidemark_check"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "orders")


def _block(df: DataFrame) -> int:
    """Rows per block that make ``BLOCKS`` blocks of a table, or more."""
    return max(1, min(df.count() // BLOCKS, ROWS_PER_BLOCK))


def _monthly(df: DataFrame) -> DataFrame:
    return df.withColumn("month", repair.month_of(F.col("o_orderdate")))


# --- sources -------------------------------------------------------------------------------


@query
def scan_parquet(spark, sf_dir):
    events = files.read_parquet(spark, f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def scan_csv_positional(spark, sf_dir):
    path = scratch_path(spark, "sales-csv")
    inputs.sales(spark, sf_dir).write.option("header", True).option("emptyValue", "").csv(path)
    return files.read_csv_positional(spark, path, schemas.SALES_FIELDS)


@query
def scan_csv_rejects(spark, sf_dir):
    """Lines of a sales file some of which are broken: how many are read, and those that are not, with why."""
    path = scratch_path(spark, "broken-csv")
    inputs.broken_lines(spark, sf_dir).write.text(path)
    good, rejected = files.read_csv_checked(spark, path, schemas.SALES_FIELDS, header=False, short_lines=False)
    placed = F.col("file").endswith(".txt") & (F.col("offset") >= 0)
    return rejected.where(placed).select("line", "reason").union(
        good.groupBy("Store_ID").agg(F.count("index").cast("string").alias("n")).select(F.concat(F.lit("store "), "Store_ID"), "n")
    )


@query
def scan_dispatch(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    csv_sinks.write_csv(inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), path)
    schema = T.StructType(
        [T.StructField("c_custkey", T.LongType()), T.StructField("c_mktsegment", T.StringType())]
    )
    customers = files.read_table(spark, path, schema)
    orders = files.read_table(spark, f"{sf_dir}/orders.parquet")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .groupBy("c_mktsegment")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query
def bulk_load_csv(spark, sf_dir):
    path, location = scratch_path(spark, "load-csv"), scratch_path(spark, "load-table")
    csv_sinks.write_csv(inputs.sales_null_only(spark, sf_dir), path)
    schema = T.StructType(
        [T.StructField("index", T.LongType()), T.StructField("Store_ID", T.IntegerType()),
         T.StructField("Date", T.StringType()), T.StructField("Dept", T.IntegerType()),
         T.StructField("Weekly_Sales", T.DoubleType())]
    )
    table = f"{_catalog_schema(spark)}.sales_load"
    return files.bulk_load_csv(spark, path, table, schema, location=location, strict=False)


@query
def typed_literal_table(spark, sf_dir):
    schema = T.StructType(
        [T.StructField("Store_ID", T.IntegerType()), T.StructField("store_name", T.StringType())]
    )
    stores = files.typed_rows(spark, [(1, "first"), (2, "second")], schema)
    sales = inputs.sales_null_only(spark, sf_dir)
    return sales.join(stores, "Store_ID").groupBy("store_name").agg(F.count(F.lit(1)).alias("sales"))


# --- sinks ---------------------------------------------------------------------------------


def _measures(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "o_orderkey", "o_orderstatus", repair.zero_to_null(F.col("o_custkey") % 3).alias("grade"), "o_totalprice"
    )


_MEASURES = T.StructType(
    [T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
     T.StructField("grade", T.LongType()), T.StructField("o_totalprice", T.DoubleType())]
)


@query
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    csv_sinks.write_csv(_measures(spark, sf_dir), path)
    return files.read_table(spark, path, _MEASURES)


@query
def sink_headerless_roundtrip(spark, sf_dir):
    clean, averages = scratch_path(spark, "clean"), scratch_path(spark, "averages")
    measures = _measures(spark, sf_dir)
    csv_sinks.write_csv_headerless(measures, clean)
    means = aggregates.mean_by(measures, "o_orderstatus", "o_totalprice", "mean", exact_scale=2)
    csv_sinks.write_averages_headerless(means, averages, "o_orderstatus", "mean")
    read = spark.read.schema(_MEASURES).option("nullValue", "None").csv(clean)
    lines = spark.read.text(averages).select(
        F.split("value", ",")[0].alias("o_orderstatus"), F.col("value").alias("line")
    )
    return read.join(lines, "o_orderstatus")


@query
def sink_indexed_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "indexed")
    means = aggregates.mean_by(
        _monthly(_orders(spark, sf_dir)), "month", "o_totalprice", "average", exact_scale=2
    )
    csv_sinks.write_csv_indexed(means, path, "month", single_file=True)
    return files.read_table(
        spark,
        path,
        T.StructType([T.StructField("index", T.LongType()), T.StructField("month", T.IntegerType()),
                      T.StructField("average", T.DoubleType())]),
    )


@query
def sink_indexed_sharded_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "indexed-shards")
    csv_sinks.write_csv_indexed(
        _orders(spark, sf_dir).select("o_orderdate", "o_orderkey", "o_totalprice"),
        path,
        ["o_orderdate", "o_orderkey"],
    )
    written = spark.read.option("header", True).csv(path)
    return written.select(
        F.col("index").cast("long").alias("index"),
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
    )


@query
def sink_table_roundtrip(spark, sf_dir):
    location = scratch_path(spark, "table")
    schema = T.StructType(
        [T.StructField("Month", T.IntegerType()), T.StructField("Store_ID", T.IntegerType()),
         T.StructField("Weekly_Sales", T.DoubleType())]
    )
    orders = _orders(spark, sf_dir).select(
        repair.month_of(F.col("o_orderdate")).alias("Month"),
        (F.col("o_custkey") % 5).alias("Store_ID"),
        F.col("o_totalprice").alias("Weekly_Sales"),
        "o_orderkey",
    )
    table = f"{_catalog_schema(spark)}.clean_roundtrip"
    write_table(orders, table, schema, location=location)
    return spark.table(table)


# --- parsing and repair --------------------------------------------------------------------


@query
def normalize_missing(spark, sf_dir):
    sales = inputs.sales(spark, sf_dir)
    raw = F.col("Weekly_Sales")
    return sales.select(
        "index",
        repair.missing_to_null(raw, schemas.TOKEN_NULL).alias("null_only"),
        repair.missing_to_null(raw, schemas.TOKENS_NULL_NONE).alias("null_none"),
        repair.missing_to_null(raw, schemas.TOKENS_NULL_NONE_BLANK).alias("null_none_blank"),
        repair.nan_to_null(
            F.when(raw == "0", F.lit(float("nan"))).otherwise(F.col("index").cast("double"))
        ).alias("no_nan"),
    )


@query
def try_numeric(spark, sf_dir):
    return inputs.sales(spark, sf_dir, bad_keys=True).select(
        repair.try_number(F.col("Weekly_Sales")).alias("sales"),
        repair.try_number(F.col("Store_ID"), "bigint").alias("store"),
    )


@query
def try_date(spark, sf_dir):
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    mixed = F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = _orders(spark, sf_dir).select(
        "o_orderkey",
        inputs.dirty_date_text(F.col("o_orderkey"), F.col("o_orderdate")).alias("raw"),
        mixed.alias("mixed"),
    )
    return orders.select(
        "o_orderkey",
        F.date_format(repair.try_date(F.col("raw")), "yyyy-MM-dd").alias("iso"),
        F.date_format(
            repair.try_date(F.col("mixed"), ["yyyy-MM-dd", "dd/MM/yyyy"]), "yyyy-MM-dd"
        ).alias("by_format"),
    )


@query
def strict_cast(spark, sf_dir):
    known = rows.drop_missing_measure(
        inputs.sales_null_only(spark, sf_dir), "Weekly_Sales", schemas.TOKEN_NULL
    )
    return known.select("index", repair.strict_cast(F.col("Weekly_Sales"), "double").alias("sales"))


@query
def reject_bad_keys(spark, sf_dir):
    good, bad = rows.split_rejects(
        inputs.sales(spark, sf_dir, bad_keys=True), {"index": "bigint", "Store_ID": "int"}
    )

    def labelled(df: DataFrame, kind: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), F.col("index").cast("string").alias("index"),
            F.col("Store_ID").cast("string").alias("Store_ID"), "Weekly_Sales",
        )

    return labelled(good, "good").unionByName(labelled(bad, "bad"))


@query
def normalize_key(spark, sf_dir):
    left = joins.normalize_key(inputs.sales(spark, sf_dir, bad_keys=True))
    right = joins.normalize_key(
        inputs.lines(spark, sf_dir).select(F.col("index").cast("string").alias("index"), "flag")
    )
    return joins.join_inner(left, right, "index").groupBy("flag").agg(F.count(F.lit(1)).alias("rows"))


@query
def cast_flag(spark, sf_dir):
    flag = F.when(~inputs.every(F.col("o_orderkey"), 5), F.col("o_orderkey") % 2)
    return _orders(spark, sf_dir).select(
        "o_orderkey",
        repair.flag_to_boolean(flag).alias("as_boolean"),
        repair.flag_to_int(flag).alias("as_int"),
    )


@query
def zero_as_missing(spark, sf_dir):
    return inputs.sales(spark, sf_dir).select(
        "index", repair.zero_to_null(repair.try_number(F.col("Weekly_Sales"))).alias("sales")
    )


@query
def default_on_unmatched(spark, sf_dir):
    left = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("index"))
    right = inputs.economic(spark, sf_dir).select("index", "CPI")
    return joins.merge_right_wins(left, right, "index", {"CPI": 0.0})


@query
def month_of_date(spark, sf_dir):
    return _monthly(_orders(spark, sf_dir)).select("o_orderkey", "month")


@query
def month_from_text(spark, sf_dir):
    return inputs.sales(spark, sf_dir).select(
        "index", repair.month_of_text(F.col("Date")).alias("month")
    )


@query
def decimal_measures(spark, sf_dir):
    sixth = F.col("l_extendedprice").cast("decimal(12,2)") * F.lit(0.125).cast("decimal(4,3)")
    return inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        repair.to_decimal(sixth).cast("double").alias("sales"),
        repair.to_decimal(F.col("l_quantity")).cast("double").alias("quantity"),
    )


@query
def round_half_up(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "o_orderkey", numbers.round_to(F.col("o_totalprice"), 1).alias("rounded")
    )


@query
def round_half_even(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "o_orderkey", numbers.round_to(F.col("o_totalprice"), 1, "half_even").alias("rounded")
    )


@query
def round_all_floats(spark, sf_dir):
    return rows.round_floats(
        _orders(spark, sf_dir).select(
            "o_orderkey", "o_orderstatus", (F.col("o_totalprice") / 7).alias("seventh"),
            (F.col("o_custkey") / 3).alias("third"),
        )
    )


@query
def format_row_text(spark, sf_dir):
    return inputs.economic(spark, sf_dir).select(
        "index",
        text.delimited(
            [F.col("index"), F.col("IsHoliday"), F.col("CPI"), F.col("Unemployment"), F.col("Type")]
        ).alias("line"),
        text.fixed_point(F.col("CPI")).alias("fixed"),
    )


# --- ordered fill --------------------------------------------------------------------------

_GAPS = ["value", "event_type", "score"]


@query
def ffill_all(spark, sf_dir):
    events = inputs.dirty_events(spark, sf_dir)
    return forward_fill(events, [c for c in events.columns if c != "event_id"], "event_id")


@query
def ffill_all_blocks(spark, sf_dir):
    events = inputs.dirty_events(spark, sf_dir)
    columns = [c for c in events.columns if c != "event_id"]
    return forward_fill(events, columns, "event_id", rows_per_block=_block(events))


@query
def ffill_columns(spark, sf_dir):
    return forward_fill(inputs.dirty_events(spark, sf_dir), ["value", "score"], "event_id")


@query
def ffill_composite_order_blocks(spark, sf_dir):
    """Ordered by time and id: no integer key, so rows are numbered first."""
    events = inputs.dirty_events(spark, sf_dir).join(
        inputs.table(spark, sf_dir, "events").select("event_id", "ts"), "event_id"
    )
    filled = forward_fill(events, _GAPS, ["ts", "event_id"], rows_per_block=_block(events))
    return filled.drop("ts")


def _parsed_sales(spark, sf_dir):
    raw = F.col("Weekly_Sales")
    return inputs.sales(spark, sf_dir).select(
        F.col("index").cast("bigint").alias("index"),
        F.col("Store_ID").cast("int").alias("Store_ID"),
        raw.alias("raw"),
        repair.try_number(raw).alias("sales"),
    )


@query
def ffill_after_try_cast(spark, sf_dir):
    return forward_fill(_parsed_sales(spark, sf_dir), "sales", "index").select("index", "sales")


@query
def ffill_missing_only(spark, sf_dir):
    missing = repair.is_missing(F.col("raw"), schemas.TOKENS_NULL_NONE)
    filled = forward_fill(_parsed_sales(spark, sf_dir), "sales", "index", fill_when={"sales": missing})
    return filled.select("index", "sales")


@query
def ffill_missing_only_blocks(spark, sf_dir):
    missing = repair.is_missing(F.col("raw"), schemas.TOKENS_NULL_NONE)
    sales = _parsed_sales(spark, sf_dir)
    filled = forward_fill(sales, "sales", "index", fill_when={"sales": missing}, rows_per_block=_block(sales))
    return filled.select("index", "sales")


@query
def ffill_by_key(spark, sf_dir):
    return forward_fill(inputs.dirty_events(spark, sf_dir), _GAPS, "event_id", "user_id")


@query
def ffill_by_key_blocks(spark, sf_dir):
    """Keyed by an attribute with few values, so that every key is split."""
    sales = _parsed_sales(spark, sf_dir)
    return forward_fill(sales, "sales", "index", "Store_ID", rows_per_block=_block(sales)).select(
        "index", "Store_ID", "sales"
    )


@query
def ffill_before_filter(spark, sf_dir):
    filled = forward_fill(_parsed_sales(spark, sf_dir), "sales", "index")
    return rows.in_domain(filled, "Store_ID", schemas.STORES).select("index", "Store_ID", "sales")


@query
def ffill_after_filter(spark, sf_dir):
    kept = rows.in_domain(_parsed_sales(spark, sf_dir), "Store_ID", schemas.STORES)
    return forward_fill(kept, "sales", "index").select("index", "Store_ID", "sales")


# --- joins ---------------------------------------------------------------------------------


@query
def join_inner(spark, sf_dir):
    left = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("index"), "o_totalprice")
    return joins.join_inner(left, inputs.lines(spark, sf_dir), "index").select(
        "index", "line", "o_totalprice", "price"
    )


@query
def join_left(spark, sf_dir):
    left = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("index"), "o_totalprice")
    return joins.join_left(
        left, inputs.economic(spark, sf_dir), "index", ["index", "o_totalprice", "CPI", "Unemployment"]
    )


@query
def cogroup_first_left(spark, sf_dir):
    left = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("index"), "o_custkey", "o_totalprice")
    right = inputs.economic_lines(spark, sf_dir).select("index", *LINE_ORDER, "CPI", "Unemployment")
    merged = joins.cogroup_first_left(
        left, right, "index", ["o_custkey", "o_totalprice"], LINE_ORDER, {"CPI": 0.0}
    )
    return merged.select("index", "o_totalprice", "line", "CPI", "Unemployment")


@query
def merge_right_wins(spark, sf_dir):
    left = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("index"), F.col("o_totalprice").alias("CPI"),
        F.lit("order").alias("Type"), "o_orderstatus",
    )
    right = inputs.economic(spark, sf_dir).select("index", "CPI", "Type", "IsHoliday")
    return joins.merge_right_wins(left, right, "index")


# --- filters and projections ---------------------------------------------------------------


@query
def filter_threshold(spark, sf_dir):
    return rows.above_threshold(_orders(spark, sf_dir), "o_totalprice", THRESHOLD).select(
        "o_orderkey", "o_totalprice"
    )


@query
def filter_threshold_tolerant(spark, sf_dir):
    return rows.above_threshold_tolerant(
        inputs.sales(spark, sf_dir), "Weekly_Sales", THRESHOLD
    ).select("index", "Weekly_Sales")


@query
def filter_domain(spark, sf_dir):
    return rows.in_domain(_parsed_sales(spark, sf_dir), "Store_ID", schemas.STORES).select("index", "Store_ID")


@query
def drop_missing_measure(spark, sf_dir):
    return rows.drop_missing_measure(
        inputs.sales(spark, sf_dir), "Weekly_Sales", schemas.TOKEN_NULL
    ).select("index", "Weekly_Sales")


@query
def require_not_null(spark, sf_dir):
    return rows.require_not_null(
        inputs.dirty_events(spark, sf_dir), ["value", "event_type"]
    ).select("event_id", "value", "event_type")


@query
def require_truthy(spark, sf_dir):
    filled = forward_fill(_parsed_sales(spark, sf_dir), "sales", "index")
    return rows.require_truthy(filled, ["sales"]).select("index", "sales")


def _joined(spark, sf_dir):
    return flow.parse_sales(policy.FILL_SELECTED, inputs.sales(spark, sf_dir)).join(
        inputs.economic(spark, sf_dir), "index"
    )


@query
def project_clean(spark, sf_dir):
    return rows.project_clean(
        _joined(spark, sf_dir).withColumn("Month", repair.month_of(F.col("Date")))
    )


@query
def project_typed(spark, sf_dir):
    joined = _joined(spark, sf_dir).withColumn("Month", repair.month_of(F.col("Date")))
    numeric = joined.drop("IsHoliday").withColumn(
        "Unemployment", repair.try_number(F.col("Unemployment"))
    )
    return rows.project_typed(numeric, schemas.CLEAN, {"IsHoliday": 0})


@query
def drop_rename(spark, sf_dir):
    return rows.drop_and_rename(
        inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name"),
        ["c_name"],
        {"c_acctbal": "Average_Weekly_Sales"},
    )


@query
def optional_column_default(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        rows.optional_column(lines, "IsHoliday", 0).alias("IsHoliday"),
        rows.optional_column(lines, "l_quantity", 0.0).alias("l_quantity"),
    )


# --- aggregates ----------------------------------------------------------------------------


@query
def agg_monthly_avg(spark, sf_dir):
    orders = _monthly(
        _orders(spark, sf_dir).join(
            inputs.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        )
    )
    kept = rows.above_threshold(orders, "o_totalprice", THRESHOLD)
    return aggregates.mean_by(kept, "month", "o_totalprice", "average", exact_scale=2).orderBy("month")


@query
def agg_monthly_avg_sum_count(spark, sf_dir):
    return aggregates.mean_by(
        _monthly(_orders(spark, sf_dir)), "month", "o_totalprice", "average", exact_scale=2
    )


@query
def agg_monthly_avg_whole(spark, sf_dir):
    return aggregates.mean_by(
        _monthly(_orders(spark, sf_dir)), "month", "o_totalprice", "average", decimals=0,
        rounding="half_even", exact_scale=2,
    )


@query
def agg_filtered_monthly(spark, sf_dir):
    sales = inputs.sales(spark, sf_dir).select(
        repair.month_of_text(F.col("Date")).alias("Month"), "Weekly_Sales"
    )
    return sales.transform(aggregates.monthly_average(THRESHOLD, exact_scale=2))


@query
def agg_empty_default(spark, sf_dir):
    none_left = rows.above_threshold(_orders(spark, sf_dir), "o_totalprice", 1e12)
    return aggregates.mean_by(none_left, None, "o_totalprice", "average", empty=0.0)


@query
def agg_decimal_avg(spark, sf_dir):
    orders = _monthly(_orders(spark, sf_dir)).select(
        "month", repair.to_decimal(F.col("o_totalprice")).alias("Weekly_Sales")
    )
    return statements.monthly_statement(spark, orders).select(
        "month", F.col("Avg_Sales").cast("double").alias("Avg_Sales")
    )


@query
def profile_table(spark, sf_dir):
    merged = inputs.dirty_events(spark, sf_dir).withColumn("zeroed", F.col("event_id") % 3)
    return quality.profile(
        merged.withColumn("holed", F.when(F.col("event_id") % 10 == 0, float("nan")).otherwise(F.col("value")))
    )


@query
def zero_rows_report(spark, sf_dir):
    parsed = _parsed_sales(spark, sf_dir).withColumnRenamed("sales", "before")
    repaired = forward_fill(
        parsed.withColumn("after", repair.zero_to_null(F.col("before"))), "after", "index"
    )
    return quality.zero_counts(repaired, "before", "after")


@query
def zero_rows_list(spark, sf_dir):
    return quality.zero_rows(_parsed_sales(spark, sf_dir), "sales").select("index", "Store_ID")


# --- order and row numbers -----------------------------------------------------------------


@query
def sort_by_hidden_column(spark, sf_dir):
    joined = statements.join_statement(
        spark,
        statements.typed_sales(inputs.sales_null_only(spark, sf_dir)),
        statements.typed_economic(inputs.economic(spark, sf_dir, with_bad=False)),
    )
    return _plain(statements.clean_statement(spark, joined, THRESHOLD, ordered=True))


@query
def sort_aggregate(spark, sf_dir):
    return aggregates.mean_by(
        _monthly(_orders(spark, sf_dir)), "month", "o_totalprice", "average", exact_scale=2
    ).orderBy("month")


_NUMBERED = ["o_orderkey", "o_orderdate", "o_orderstatus"]


@query
def row_index_zero_based(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(*_NUMBERED)
    return row_index(orders, ["o_orderdate", "o_orderkey"]).select("index", "o_orderkey")


@query
def row_index_zero_based_blocks(spark, sf_dir):
    """By date and key: too large for one task, and no integer order, so one written range sort."""
    orders = _orders(spark, sf_dir).select(*_NUMBERED)
    return row_index(
        orders, ["o_orderdate", "o_orderkey"], rows_per_block=_block(orders)
    ).select("index", "o_orderkey")


@query
def row_index_one_based(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(*_NUMBERED)
    return row_index(orders, "o_orderkey", start=1, rows_per_block=_block(orders)).select("index", "o_orderkey")


@query
def row_index_per_key(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(*_NUMBERED)
    return row_index(orders, "o_orderkey", start=1, partition_by="o_orderstatus").select(
        "index", "o_orderkey", "o_orderstatus"
    )


@query
def row_index_per_key_blocks(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(*_NUMBERED)
    return row_index(
        orders, "o_orderkey", start=1, partition_by="o_orderstatus", rows_per_block=_block(orders)
    ).select("index", "o_orderkey", "o_orderstatus")


@query
def sink_order_check(spark, sf_dir):
    """Files of a sharded indexed output, and of the same rows laid out by another column: are they in order?"""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice")
    sorted_path, other = scratch_path(spark, "sorted-csv"), scratch_path(spark, "unsorted")
    csv_sinks.write_csv_indexed(orders, sorted_path, "o_orderkey", rows_per_block=_block(orders))
    # Three files, or more where a task would sort more than a block.
    parts = max(3, -(-orders.count() // ROWS_PER_BLOCK))
    orders.repartitionByRange(parts, "o_totalprice").sortWithinPartitions("o_totalprice").write.parquet(other)
    read = spark.read.schema("index long, o_orderkey long, o_orderdate string, o_totalprice double").option("header", True).csv(sorted_path)

    def checked(df, by, name):
        in_order = (F.col("breaks_within") == 0) & (F.col("breaks_between") == 0)
        return quality.check_sorted(df, by).select(F.lit(name).alias("output"), "rows", in_order.alias("in_order"))

    return checked(read, ["index", "o_orderkey"], "indexed").union(checked(spark.read.parquet(other), "o_orderkey", "by price")).union(
        checked(spark.read.parquet(other), "o_totalprice", "its own order")
    )


@query
def agg_mean_any_double(spark, sf_dir):
    """Mean of doubles of very different sizes, to the last bit."""
    scaled = F.col("o_totalprice") * F.pow(F.lit(2.0), (F.col("o_orderkey") % 21 - 10).cast("double"))
    return aggregates.mean_by(_monthly(_orders(spark, sf_dir)).withColumn("scaled", scaled), "month", "scaled", "average")


@query
def round_binary_exact(spark, sf_dir):
    """Eighths and thousandths at two places: ties to even where the double is one, else to the nearer."""
    eighths = F.floor(F.col("o_totalprice")) + (F.col("o_orderkey") % 8) / 8.0
    halves = F.col("o_orderkey") % 1000 + 0.5
    return _orders(spark, sf_dir).select(
        "o_orderkey", numbers.round_to(eighths, 2, "half_even_binary").alias("eighths"), numbers.round_to(halves, 0, "half_even_binary").alias("halves")
    )


@query
def sink_table_failed_replace(spark, sf_dir):
    """A table of which a replacement fails while it is written, and another one breaks its contract: the old rows."""
    table, location = f"{_catalog_schema(spark)}.failed_replace", scratch_path(spark, "failed-replace")
    measures = _measures(spark, sf_dir)
    tables.drop_table(spark, table)
    tables.write_table(measures, table, _MEASURES, location=location)
    last = measures.agg(F.max("o_orderkey")).first()[0]
    broken = measures.withColumn("o_totalprice", F.when(F.col("o_orderkey") < last, F.col("o_totalprice")).otherwise(F.raise_error(F.lit("one row fails"))))
    gaps = tables.Replacement(measures.withColumn("o_orderstatus", F.lit(None)), table, _MEASURES, location, required=("o_orderstatus",))
    for attempt in (lambda: tables.write_table(broken, table, _MEASURES, location=location), lambda: tables.replace_tables(spark, [gaps])):
        try:
            attempt()
        except (PySparkException, tables.ContractBroken):
            continue
        raise AssertionError("the replacement should have failed")
    return spark.table(table)


@query
def sink_tables_switch_together(spark, sf_dir):
    """Two tables replaced twice; the second time one of them breaks its contract, and neither changes."""
    schema, measures = _catalog_schema(spark), _measures(spark, sf_dir)
    clean, means = f"{schema}.together_clean", f"{schema}.together_means"
    for table in (clean, means):
        tables.drop_table(spark, table)
    means_of = aggregates.mean_by(measures, "o_orderstatus", "o_totalprice", "mean", exact_scale=2)
    tables.replace_tables(spark, [tables.Replacement(measures, clean, _MEASURES), tables.Replacement(means_of, means, means_of.schema)])
    try:
        tables.replace_tables(spark, [
            tables.Replacement(measures.limit(0), clean, _MEASURES),
            tables.Replacement(means_of.limit(0), means, means_of.schema, may_be_empty=False),
        ])
    except tables.ContractBroken:
        return spark.table(clean).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows")).join(spark.table(means), "o_orderstatus")
    raise AssertionError("the replacement should have failed")


# --- quality and run control ---------------------------------------------------------------


def _written_outputs(spark, sf_dir):
    """Two written outputs, one of them also expected in another shape, and one that is absent."""
    measures = _measures(spark, sf_dir)
    first, second = scratch_path(spark, "out-clean"), scratch_path(spark, "out-agg")
    measures.write.parquet(first)
    means = aggregates.mean_by(measures, "o_orderstatus", "o_totalprice", "mean", exact_scale=2)
    csv_sinks.write_csv(means, second)
    averages = means.schema
    return [
        outputs.Output("clean", first, "parquet", _MEASURES),
        outputs.Output("aggregate", second, "csv", averages),
        outputs.Output("wrong_shape", first, "parquet", averages),
        outputs.Output("absent", scratch_path(spark, "out-absent"), "parquet", averages),
    ]


@query
def validate_outputs(spark, sf_dir):
    return outputs.check_outputs(spark, _written_outputs(spark, sf_dir))


@query
def validate_output_contents(spark, sf_dir):
    """Outputs that were changed after they were written: a text in a numeric column, a file that lost its end, and a
    file that is there twice; and one that is as written."""
    measures = _measures(spark, sf_dir).select("o_orderkey", "o_totalprice")
    schema = measures.schema
    found = []
    for name in ("as written", "text in a column", "rows lost", "file twice"):
        path, changed = scratch_path(spark, "content"), scratch_path(spark, "content-changed")
        csv_sinks.write_csv(measures.repartition(3), path, schema)
        note = contents.noted(spark, path)
        stored = spark.read.option("header", True).csv(path)
        first = stored.agg(F.min(F.col("o_orderkey").cast("long"))).first()[0]
        own = F.col("o_orderkey") == first
        if name == "text in a column":
            stored = stored.withColumn("o_totalprice", F.when(own, F.lit("n/a")).otherwise(F.col("o_totalprice")))
        elif name == "rows lost":
            stored = stored.where(~own)
        elif name == "file twice":
            stored = stored.union(stored.where(own))
        csv_sinks.write_csv(stored, changed)
        contents.record(spark, changed, {"rows": note[0], "checksum": note[1]})
        found.append(outputs.Output(name, changed, "csv", schema))
    return outputs.check_contents(spark, found)


@query
def missing_outputs(spark, sf_dir):
    """Of some written outputs those that are absent or of another shape, with the rows of the sound ones."""
    expected = _written_outputs(spark, sf_dir)
    missing = outputs.missing_outputs(spark, expected)
    sound = [o for o in expected if o.name not in missing]
    counts = [(o.name, False, o.read(spark).count()) for o in sound] + [(name, True, None) for name in missing]
    return spark.createDataFrame(counts, "output string, missing boolean, rows long")


@query
def missing_names(spark, sf_dir):
    """Months expected from the orders, without those that sales above a limit produced."""
    orders = _monthly(_orders(spark, sf_dir))
    expected = orders.select(F.concat_ws("-", F.year("o_orderdate"), "month").alias("output")).distinct()
    found = rows.above_threshold(orders, "o_totalprice", 499000.0).select(
        F.concat_ws("-", F.year("o_orderdate"), "month").alias("output")
    ).distinct()
    return outputs.missing_names(expected, found, "output")


@query
def flow_rejects(spark, sf_dir):
    """Sales rows that the validated flow does not accept."""
    return _flow(spark, sf_dir, policy.VALIDATED).rejected


@query
def flow_conversion_errors(spark, sf_dir):
    """Texts in the validated flow's inputs that are neither missing nor parsable."""
    return _flow(spark, sf_dir, policy.VALIDATED).errors


@query
def idempotent_rerun(spark, sf_dir):
    """A first run writes, a second finds everything in order; (run, wrote, rows) of each."""
    path = scratch_path(spark, "rerun")
    measures = _measures(spark, sf_dir)
    wanted = [outputs.Output("clean", path, "parquet", _MEASURES)]
    wrote = [
        outputs.run_if_incomplete(spark, wanted, lambda: measures.write.mode("overwrite").parquet(path))
        for _ in range(2)
    ]
    total = spark.read.parquet(path).count()
    return spark.createDataFrame(
        [(i, w, total) for i, w in enumerate(wrote)], "run int, wrote boolean, rows bigint"
    )


@query
def observe_metrics(spark, sf_dir):
    observed, observation = quality.observe_stage(
        inputs.dirty_events(spark, sf_dir), "events", ["value", "event_type"]
    )
    observed.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [(name, int(value)) for name, value in observation.get.items()], "metric string, total bigint"
    )


@query
def conversion_error_counts(spark, sf_dir):
    sales = inputs.sales(spark, sf_dir, bad_keys=True)
    return quality.conversion_errors(
        sales,
        {
            "index": F.col("index").try_cast("bigint"),
            "Store_ID": F.col("Store_ID").try_cast("int"),
            "Date": repair.try_date(F.col("Date")),
            "Weekly_Sales": repair.try_number(F.col("Weekly_Sales")),
        },
    )


@query
def flow_stage_metrics(spark, sf_dir):
    """Rows and gaps at the stages of the validated flow, counted by the job that publishes it."""
    result = flow.run(
        policy.VALIDATED, inputs.sales(spark, sf_dir, bad_keys=True), inputs.economic_lines(spark, sf_dir),
        threshold=THRESHOLD, economic_order=["index", *LINE_ORDER], rows_per_block=_block(_orders(spark, sf_dir)), watch=True,
    )
    publish.publish(spark, policy.VALIDATED, result, publish.Targets(), THRESHOLD)
    return result.metrics.table(spark)


# --- SQL -----------------------------------------------------------------------------------


def _sql_inputs(spark, sf_dir):
    return (
        statements.typed_sales(inputs.sales_null_only(spark, sf_dir)),
        statements.typed_economic(inputs.economic(spark, sf_dir, with_bad=False)),
    )


def _plain(df: DataFrame) -> DataFrame:
    """Decimals and floats as doubles: every engine prints those the same way."""
    kinds = (T.DecimalType, T.FloatType)
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, kinds) else f.name
            for f in df.schema
        ]
    )


@query
def sql_join_left(spark, sf_dir):
    return _plain(statements.join_statement(spark, *_sql_inputs(spark, sf_dir)))


@query
def sql_cte_filter(spark, sf_dir):
    joined = statements.join_statement(spark, *_sql_inputs(spark, sf_dir))
    return _plain(statements.clean_statement(spark, joined, THRESHOLD))


@query
def sql_monthly_avg(spark, sf_dir):
    """Over registered views, as a caller with own SQL would."""
    orders = _monthly(_orders(spark, sf_dir)).select(
        "month", repair.to_decimal(F.col("o_totalprice")).alias("Weekly_Sales")
    )
    statements.register(tidemark_monthly_source=orders)
    clean = spark.sql("SELECT month, Weekly_Sales FROM tidemark_monthly_source")
    return _plain(statements.monthly_statement(spark, clean, ordered=True))


# --- whole flows ---------------------------------------------------------------------------


def _flow(spark, sf_dir, rules: policy.Policy, blocks: bool = False, form: str = "") -> flow.FlowResult:
    options = {"threshold": THRESHOLD, "exact_scale": 2}
    if blocks:
        options["rows_per_block"] = _block(_orders(spark, sf_dir))
    if rules.join == "first_left":
        lines = inputs.economic_lines_with_store if form == "clash" else inputs.economic_lines
        sales = inputs.sales_twice if form else inputs.sales
        if form:
            options["sales_order"] = ["index", "copy"]
        return flow.run(
            rules,
            sales(spark, sf_dir, bad_keys=rules.reject_bad_keys),
            lines(spark, sf_dir),
            economic_order=["index", *LINE_ORDER],
            **options,
        )
    if form:
        return flow.run(
            rules, inputs.sales_twice(spark, sf_dir), inputs.economic(spark, sf_dir),
            sales_order=["index", "copy"], **options,
        )
    source = inputs.sales_null_only if rules.bad_value == "fail" else inputs.sales
    return flow.run(rules, source(spark, sf_dir), inputs.economic(spark, sf_dir), **options)


def _register_flow(name: str, rules: policy.Policy, blocks: bool = False, form: str = "") -> None:
    def clean(spark, sf_dir):
        return _plain(_flow(spark, sf_dir, rules, blocks, form).clean)

    def aggregate(spark, sf_dir):
        return _flow(spark, sf_dir, rules, blocks, form).aggregate

    clean.__name__, aggregate.__name__ = f"{name}_clean", f"{name}_agg"
    query(clean)
    query(aggregate)


for _rules in policy.POLICIES.values():
    _register_flow(f"flow_{_rules.name}", _rules)
    # The same flows with blocks small enough that every fill and join runs block-wise.
    _register_flow(f"flow_{_rules.name}_blocks", _rules, True)
# Several sales rows per key; and an economic side with a column that sales have too.
for _rules in (policy.COGROUP, policy.VALIDATED):
    for _form in ("duplicates", "clash"):
        _register_flow(f"flow_{_rules.name}_{_form}", _rules, form=_form)
        _register_flow(f"flow_{_rules.name}_{_form}_blocks", _rules, True, _form)
_register_flow("flow_fill_all_duplicate_keys", policy.FILL_ALL, form="duplicates")
_register_flow("flow_fill_all_duplicate_keys_blocks", policy.FILL_ALL, True, "duplicates")


# --- keys that are hard to cut -------------------------------------------------------------


@query
def ffill_hashed_key_blocks(spark, sf_dir):
    """Keys from one end of the long range to the other."""
    events = inputs.wide_keys(spark, sf_dir)
    filled = forward_fill(events, _GAPS, "wide", rows_per_block=_block(events))
    return filled.select("event_id", "wide", *_GAPS)


@query
def row_index_hashed_key_blocks(spark, sf_dir):
    events = inputs.wide_keys(spark, sf_dir)
    return row_index(events, "wide", rows_per_block=_block(events)).select("index", "event_id")


@query
def ffill_null_key_blocks(spark, sf_dir):
    """Rows without a key come first and are a block of their own."""
    events = inputs.null_keys(spark, sf_dir)
    filled = forward_fill(events, _GAPS, ["key", "event_id"], rows_per_block=_block(events))
    return filled.select("event_id", "key", *_GAPS)


@query
def ffill_text_order_blocks(spark, sf_dir):
    """A text order can't be cut by arithmetic: the table is range sorted and cut by number."""
    kinds = inputs.table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("kind"))
    events = inputs.dirty_events(spark, sf_dir).join(kinds, "event_id")
    filled = forward_fill(events, _GAPS, ["kind", "event_id"], rows_per_block=_block(events))
    return filled.select("event_id", "kind", *_GAPS)


@query
def row_index_text_order_blocks(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    return row_index(events, ["event_type", "event_id"], rows_per_block=_block(events) // 8 + 1).select("index", "event_id")


@query
def ffill_busy_day_blocks(spark, sf_dir):
    """A third of the rows share one day: no even blocks by day, so the table is range sorted."""
    events = inputs.busy_day(spark, sf_dir)
    filled = forward_fill(events, _GAPS, ["day", "event_id"], rows_per_block=_block(events) // 8 + 1)
    return filled.select("event_id", *_GAPS)


@query
def row_index_busy_day_blocks(spark, sf_dir):
    events = inputs.busy_day(spark, sf_dir)
    numbered = row_index(events, ["day", "event_id"], start=1, rows_per_block=_block(events) // 8 + 1)
    return numbered.select("index", "event_id")


@query
def flow_sql_drop_nulls_clean(spark, sf_dir):
    sales, economic = inputs.sales_null_only(spark, sf_dir), inputs.economic(spark, sf_dir, with_bad=False)
    return _plain(statements.run_sql(spark, sales, economic, THRESHOLD)[0])


@query
def flow_sql_drop_nulls_agg(spark, sf_dir):
    sales, economic = inputs.sales_null_only(spark, sf_dir), inputs.economic(spark, sf_dir, with_bad=False)
    return _plain(statements.run_sql(spark, sales, economic, THRESHOLD, ordered=True)[1])


@query
def flow_sql_published_index(spark, sf_dir):
    """The numbered clean file of the SQL flow, in the order of its dates, as read back."""
    sales, economic = _sql_inputs(spark, sf_dir)
    targets = statements.SqlTargets(scratch_path(spark, "sql-clean-csv"), scratch_path(spark, "sql-aggregate-csv"))
    statements.publish_sql(spark, sales, economic, targets, THRESHOLD)
    numbered = "index bigint, Store_ID int, month int, Dept int, Weekly_Sales double, CPI double, Unemployment double"
    return spark.read.schema(numbered).option("header", True).csv(targets.clean_csv)


@query
def flow_zero_repair_profile(spark, sf_dir):
    """The check between join and output: rows, gaps and zeros of every merged column."""
    merged = _flow(spark, sf_dir, policy.ZERO_REPAIR).merged
    return quality.profile(merged.select("index", *schemas.CLEAN_FIELDS, "Type", "Size"))


@query
def flow_published(spark, sf_dir):
    """The validated flow written to all four targets, read back from the aggregate table."""
    result, schema = _flow(spark, sf_dir, policy.VALIDATED), _catalog_schema(spark)
    targets = publish.Targets(
        clean_csv=scratch_path(spark, "clean-csv"),
        aggregate_csv=scratch_path(spark, "aggregate-csv"),
        clean_table=f"{schema}.clean",
        aggregate_table=f"{schema}.aggregated",
        clean_location=scratch_path(spark, "clean-table"),
        aggregate_location=scratch_path(spark, "aggregate-table"),
    )
    publish.publish(spark, policy.VALIDATED, result, targets, THRESHOLD, exact_scale=2)
    return spark.table(f"{schema}.aggregated")


@query
def flow_published_index(spark, sf_dir):
    """The numbered clean file of the validated flow, as read back."""
    result = _flow(spark, sf_dir, policy.VALIDATED)
    targets = publish.Targets(clean_csv=scratch_path(spark, "clean-csv"))
    publish.publish(spark, policy.VALIDATED, result, targets, THRESHOLD, exact_scale=2)
    numbered = T.StructType([T.StructField("index", T.LongType()), *schemas.CLEAN.fields])
    return files.read_table(spark, targets.clean_csv, numbered)
