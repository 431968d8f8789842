"""The sales flow: read, repair, fill, join, derive the month, filter, average, publish."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.repair import (
    default_when_unmatched,
    flag_to_boolean,
    is_missing,
    missing_to_null,
    month_of,
    nan_to_null,
    strict_cast,
    try_date,
    try_number,
    zero_to_null,
)
from tidemark.operators.aggregates import mean_by
from tidemark.operators.ordered import MATCHED, OrderedTable
from tidemark.operators.quality import StageMetrics
from tidemark.operators.rows import above_threshold, in_domain, require_truthy, split_rejects
from tidemark.plans.policy import ALL, Policy
from tidemark.schemas import CLEAN_FIELDS, KEY, SALES_THRESHOLD

_FILL_DATE = "__fill_date"
_FILL_SALES = "__fill_sales"
_ORDER = "__order_"
_RIGHT = "__right_"
_SALES_KEYS = {KEY: "bigint", "Store_ID": "int"}


@dataclass(frozen=True)
class FlowResult:
    clean: DataFrame
    aggregate: DataFrame
    keyed: DataFrame  # the clean rows with their key, for numbering them in key order
    merged: DataFrame  # all columns after repair and join, for profiling
    rejected: DataFrame | None = None  # sales rows with keys that the policy does not accept
    errors: DataFrame | None = None  # unparsable values by column
    metrics: StageMetrics = field(default_factory=StageMetrics)  # rows and NULLs by stage, once published


def run(
    policy: Policy,
    sales: DataFrame,
    economic: DataFrame,
    threshold: float = SALES_THRESHOLD,
    economic_order: Sequence[str] = (KEY,),
    sales_order: Sequence[str] = (KEY,),
    exact_scale: int | None = 2,
    rows_per_block: int | None = None,
    watch: bool = False,
) -> FlowResult:
    """Both outputs of a policy, what they were made from, and what was rejected on the way.

    The outputs are lazy, but cutting large tables is not: it measures both keys and counts their blocks.
    ``sales_order`` and ``economic_order`` are total orders of the two tables, each led by the key; the key
    alone where it is unique. A policy that joins first rows keeps the first row per key of both sides.
    ``exact_scale`` is that of ``mean_by``: money of two decimals by default, so that neither partitioning nor
    a retry can change the last digit. ``watch`` counts rows and NULLs at each stage, for ``metrics`` of the result, while
    the job that publishes runs; the counted columns are then computed whatever is asked for.
    """
    sales_order, economic_order = list(sales_order), list(economic_order)
    repeats = [o for o in (sales_order, economic_order) if o != [KEY]]
    if policy.fill_at == "after_join" and repeats:
        raise ValueError("a fill after the join needs one row per key on both sides: the key is its order")
    raw_sales, raw_economic = sales, economic
    sales = parse_sales(policy, sales, [c for c in sales_order if c != KEY])
    economic = parse_economic(policy, economic)
    own_order = [KEY, *[_ORDER + c for c in sales_order if c != KEY]]
    left, right = OrderedTable.align([sales, economic], KEY, rows_per_block, orders=[own_order, economic_order])
    # Watched from here on: cutting has read the tables already, in jobs of its own.
    metrics = StageMetrics(watch)
    left = left.apply(lambda df: metrics.watch(df, "sales", ["Date", "Weekly_Sales"]))
    right = right.apply(lambda df: metrics.watch(df, "economic", [c for c in ("CPI", "Unemployment") if c in df.columns]))
    if policy.fill_at == "before_join":
        wanted = [c for c in _selected(policy.fill_economic, right) if c not in economic_order]
        right = right.fill(wanted, shared=_asked(right))
    left = _repair_sales(policy, left)
    left = left.apply(lambda df: metrics.watch(df, "repaired", ["Date", "Weekly_Sales"]))
    if policy.join == "first_left":
        left, right = left.first_per_key(), right.first_per_key()
    left = left.apply(lambda df: df.drop(*[c for c in df.columns if c.startswith(_ORDER)]))
    joined = _join(policy, left, right)
    if policy.fill_at == "after_join":
        joined = joined.fill([c for c in joined.columns if c != KEY], shared=_asked(joined))
    rows = metrics.watch(joined.rows(), "joined", ["Date", "Weekly_Sales", "CPI", "Unemployment"])
    result = _outputs(policy, rows, threshold, exact_scale, metrics)
    return replace(
        result, rejected=rejected_sales(policy, raw_sales), errors=bad_values(policy, raw_sales, raw_economic), metrics=metrics
    )


def rejected_sales(policy: Policy, sales: DataFrame) -> DataFrame:
    """Sales rows whose keys the policy does not accept, as read."""
    if not policy.reject_bad_keys:
        return sales.limit(0)
    return split_rejects(sales, _SALES_KEYS)[1]


def bad_values(policy: Policy, sales: DataFrame, economic: DataFrame) -> DataFrame:
    """Values of each repaired column that are neither missing nor parsable: column, n_bad."""
    sales_tokens, economic_tokens = list(policy.sales_tokens), list(policy.economic_tokens)

    def counted(df: DataFrame, name: str, parsed, tokens: list[str]) -> DataFrame:
        text = F.col(name).cast("string")
        bad = text.isNotNull() & ~text.isin(*tokens) & parsed(text).isNull() if tokens else text.isNotNull() & parsed(text).isNull()
        return df.agg(F.count_if(bad).alias("n_bad")).select(F.lit(name).alias("column"), "n_bad")

    def number(text):
        return try_number(text, policy.measure)

    rows = counted(sales, "Date", try_date, sales_tokens).union(counted(sales, "Weekly_Sales", number, sales_tokens))
    for name in policy.parse_economic:
        if name in economic.columns:
            rows = rows.union(counted(economic, name, number, economic_tokens))
    return rows


def parse_sales(policy: Policy, sales: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Typed sales; NULL where a value is missing or, unless the policy fails on it, unparsable.

    Columns of ``order`` come along under names of their own.
    """
    if policy.reject_bad_keys:
        sales, _ = split_rejects(sales, _SALES_KEYS)
    tokens = policy.sales_tokens
    date_text = missing_to_null(F.col("Date").cast("string"), tokens) if tokens else F.col("Date").cast("string")
    text = F.col("Weekly_Sales").cast("string")
    sales_text = missing_to_null(text, tokens) if tokens else text
    number = (
        strict_cast(sales_text, policy.measure)
        if policy.bad_value == "fail"
        else try_number(sales_text, policy.measure)
    )
    columns = [
        F.col(KEY).try_cast("bigint").alias(KEY),
        F.col("Store_ID").try_cast("int").alias("Store_ID"),
        try_date(date_text).alias("Date"),
        F.col("Dept").try_cast("int").alias("Dept"),
        number.alias("Weekly_Sales"),
        *[F.col(c).alias(_ORDER + c) for c in order],
    ]
    if policy.bad_value == "null":
        columns += [
            is_missing(F.col("Date").cast("string"), tokens).alias(_FILL_DATE),
            is_missing(text, tokens).alias(_FILL_SALES),
        ]
    return sales.select(*columns)


def parse_economic(policy: Policy, economic: DataFrame) -> DataFrame:
    def parsed(field: T.StructField):
        value = F.col(field.name)
        if field.name == KEY:
            return value.try_cast("bigint")
        if field.name in policy.parse_economic and isinstance(field.dataType, T.NumericType):
            return nan_to_null(value.cast(policy.measure))
        if field.name in policy.parse_economic:
            text = value
            if policy.economic_tokens:
                text = missing_to_null(text, policy.economic_tokens)
            return try_number(text, policy.measure)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return nan_to_null(value)
        return value

    typed = economic.select(*[parsed(f).alias(f.name) for f in economic.schema])
    return typed.where(F.col(KEY).isNotNull()) if policy.reject_bad_keys else typed


def _repair_sales(policy: Policy, sales: OrderedTable) -> OrderedTable:
    def keep_stores(df: DataFrame) -> DataFrame:
        return in_domain(df, "Store_ID", policy.stores)

    if policy.drop_missing_sales:
        sales = sales.apply(lambda df: df.where(F.col("Weekly_Sales").isNotNull()))
    if policy.stores and policy.stores_at == "start":
        sales = sales.apply(keep_stores)
    if policy.fill_at == "before_join":
        columns = _selected(policy.fill_sales, sales)
        when = {}
        if policy.bad_value == "null":
            when = {"Date": F.col(_FILL_DATE), "Weekly_Sales": F.col(_FILL_SALES)}
        if policy.zero_is_missing:
            sales = sales.apply(
                lambda df: df.withColumn("Weekly_Sales", zero_to_null(F.col("Weekly_Sales")))
            )
        carry = {}
        if policy.stores_at == "after_date_fill":
            # Dates of other stores feed the fill, their sales do not: one walk for both.
            carry = {c: F.col("Store_ID").isin(*policy.stores) for c in columns if c != "Date"}
        sales = sales.fill(columns, when, carry, shared=_asked(sales))
        if policy.stores_at == "after_date_fill":
            sales = sales.apply(keep_stores)
    if policy.require_truthy:
        sales = sales.apply(lambda df: require_truthy(df, policy.require_truthy))
    return sales.apply(lambda df: df.drop(_FILL_DATE, _FILL_SALES))


def _asked(table: OrderedTable) -> list[str]:
    """The columns that the clean output is made from, as far as a table has them."""
    needed = {KEY, "Date", *CLEAN_FIELDS}
    return [c for c in table.columns if c in needed or c.startswith(("__", _RIGHT))]


def _selected(wanted: tuple[str, ...] | str, table: OrderedTable) -> list[str]:
    present = [c for c in table.columns if c != KEY and not c.startswith("__")]
    return present if wanted == ALL else [c for c in wanted if c in present]


def _join(policy: Policy, left: OrderedTable, right: OrderedTable) -> OrderedTable:
    both = [c for c in right.columns if c in left.columns and c != KEY]
    if policy.clash == "right":
        right = right.apply(lambda df: df.withColumnsRenamed({c: _RIGHT + c for c in both}))
    else:
        right = right.apply(lambda df: df.drop(*both))
        both = []
    if policy.join == "inner" and not both:
        return left.join(right, "inner")
    how = "inner" if policy.join == "inner" else "left"
    joined = left.join(right.apply(lambda df: df.withColumn(MATCHED, F.lit(True))), how)
    matched = F.coalesce(F.col(MATCHED), F.lit(False))
    kinds = {f.name: f.dataType for f in left.frame.schema}
    values = {c: F.when(matched, F.col(_RIGHT + c).try_cast(kinds[c])).otherwise(F.col(c)) for c in both}
    if policy.unmatched is not None:
        values |= {
            name: default_when_unmatched(matched, F.col(name), policy.unmatched)
            for name in ("CPI", "Unemployment")
        }
    return joined.apply(lambda df: df.withColumns(values).drop(MATCHED, *[_RIGHT + c for c in both]))


def _outputs(
    policy: Policy, joined: DataFrame, threshold: float, exact_scale: int | None, metrics: StageMetrics
) -> FlowResult:
    holiday = {
        "keep": F.col("IsHoliday"),
        "zero": F.lit(0),
        "boolean": flag_to_boolean(F.col("IsHoliday")),
    }[policy.holiday]
    month = policy.month_column
    merged = joined.withColumn("IsHoliday", holiday).withColumn(month, month_of(F.col("Date")))
    keyed = merged.select(KEY, *[month if c == "Month" else c for c in CLEAN_FIELDS])
    if policy.threshold_on == "both":
        keyed = above_threshold(keyed, "Weekly_Sales", threshold)
    keyed = metrics.watch(keyed, "clean")
    clean = keyed.drop(KEY)
    return FlowResult(clean, average(policy, clean, threshold, exact_scale), keyed, merged)


def average(
    policy: Policy, clean: DataFrame, threshold: float, exact_scale: int | None = 2
) -> DataFrame:
    """The monthly mean of clean rows under the policy's threshold, rounding and names."""
    above = clean if policy.threshold_on == "none" else above_threshold(clean, limit=threshold)
    result = mean_by(
        above.withColumn("Weekly_Sales", F.col("Weekly_Sales").cast("double")),
        policy.month_column,
        "Weekly_Sales",
        policy.average_column,
        policy.decimals,
        exact_scale=exact_scale,
    )
    return result.orderBy(policy.month_column) if policy.sort_aggregate else result
