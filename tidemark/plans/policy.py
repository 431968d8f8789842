"""What a flow does with missing values, bad values, stores, thresholds and rounding.

One flow, many rule sets: each difference between them is a field, and each rule set a value.
"""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.schemas import (
    STORES,
    TOKEN_NULL,
    TOKENS_NULL_NONE,
    TOKENS_NULL_NONE_BLANK,
)

ALL = "all"


@dataclass(frozen=True)
class Policy:
    name: str

    # Reading: which texts mean "missing", and what an unparsable number or date becomes:
    # "fill" (missing), "null" (NULL that is not filled), "fail" (numbers fail the job).
    sales_tokens: tuple[str, ...] = TOKEN_NULL
    economic_tokens: tuple[str, ...] = TOKEN_NULL
    bad_value: str = "fill"
    parse_economic: tuple[str, ...] = ("Unemployment",)
    measure: str = "double"
    reject_bad_keys: bool = False
    zero_is_missing: bool = False
    drop_missing_sales: bool = False

    # Fill: before or after the join, and which columns (ALL for every one but the key).
    fill_at: str = "before_join"
    fill_sales: tuple[str, ...] | str = ("Date", "Weekly_Sales")
    fill_economic: tuple[str, ...] | str = ("Unemployment",)
    require_truthy: tuple[str, ...] = ()

    # Stores: no filter, or a filter before any fill, or between date and sales fill.
    stores: tuple[int, ...] | None = None
    stores_at: str = "start"

    # Join: "inner", or "first_left" (left join of the first row per key on each side).
    join: str = "inner"
    unmatched: float | None = None
    # A column that both sides have: from "left" (sales), or from "right" where a right row matched.
    clash: str = "left"

    # Output.
    holiday: str = "keep"  # "keep", "zero" or "boolean"
    threshold_on: str = "both"  # "both", "aggregate" or "none"
    month_column: str = "Month"
    average_column: str = "Average_Weekly_Sales"
    decimals: int = 2
    sort_aggregate: bool = False
    # Files: "headed", "headerless" or "indexed" (a leading row number from index_start on, in
    # key order for clean rows); averages as numbers or at fixed decimals.
    files: str = "indexed"
    index_start: int = 0
    index_name: str = "index"  # its header; blank for none
    fixed_averages: bool = False
    round_tables: bool = False  # floats in catalog tables at two places


DROP_THEN_FILL = Policy(
    "drop_then_fill",
    bad_value="fail",
    parse_economic=(),
    drop_missing_sales=True,
    fill_at="after_join",
    fill_sales=ALL,
    fill_economic=ALL,
    average_column="Avg_Sales",
    sort_aggregate=True,
    index_name="",
)

FILL_ALL = Policy(
    "fill_all",
    sales_tokens=(),
    economic_tokens=(),
    measure="float",
    fill_sales=ALL,
    fill_economic=ALL,
    month_column="month",
    average_column="Avg_Sales",
    decimals=0,
    files="headed",
)

FILL_SELECTED = Policy("fill_selected", files="headerless", fixed_averages=True)

COGROUP = Policy(
    "cogroup",
    sales_tokens=TOKENS_NULL_NONE,
    economic_tokens=TOKENS_NULL_NONE,
    bad_value="null",
    join="first_left",
    clash="right",
)

VALIDATED = Policy(
    "validated",
    sales_tokens=TOKENS_NULL_NONE_BLANK,
    economic_tokens=TOKENS_NULL_NONE,
    parse_economic=("CPI", "Unemployment"),
    reject_bad_keys=True,
    fill_economic=("CPI", "Unemployment"),
    require_truthy=("Date", "Weekly_Sales"),
    stores=STORES,
    join="first_left",
    unmatched=0.0,
    holiday="zero",
    threshold_on="aggregate",
    index_start=1,
    fixed_averages=True,
    round_tables=True,
)

ZERO_REPAIR = Policy(
    "zero_repair",
    sales_tokens=(),
    economic_tokens=(),
    parse_economic=("CPI", "Unemployment"),
    zero_is_missing=True,
    fill_economic=("CPI", "Unemployment", "MarkDown4", "MarkDown5", "Type", "Size"),
    stores=STORES,
    stores_at="after_date_fill",
    holiday="boolean",
    threshold_on="none",
    sort_aggregate=True,
)

POLICIES = {
    p.name: p
    for p in (DROP_THEN_FILL, FILL_ALL, FILL_SELECTED, COGROUP, VALIDATED, ZERO_REPAIR)
}
