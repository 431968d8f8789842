"""The SQL each registered query is checked against, for DuckDB over the same files.

Written from the definition of each operator: one global window where the Spark side works in
blocks, integer arithmetic where rounding matters.
"""

from __future__ import annotations

T = 100000.0

# The rules by which inputs.py puts in missing values, in SQL.
_DIRTY_SALES = """CASE WHEN o_orderkey % 7 = 0 THEN 'null' WHEN o_orderkey % 11 = 0 THEN ''
  WHEN o_orderkey % 13 = 0 THEN 'bad' WHEN o_orderkey % 17 = 0 THEN '0'
  WHEN o_orderkey % 23 = 0 THEN 'None' ELSE CAST(o_totalprice AS VARCHAR) END"""
_DIRTY_DATE = """CASE WHEN o_orderkey % 19 = 0 THEN 'null' WHEN o_orderkey % 29 = 0 THEN 'not-a-date'
  ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


def _sales(bad_keys: bool = False) -> str:
    index, store = "CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey % 5 AS VARCHAR)"
    if bad_keys:
        index = f"CASE WHEN o_orderkey % 31 = 0 THEN 'invalid' ELSE {index} END"
        store = f"CASE WHEN o_custkey % 37 = 0 THEN 'x' ELSE {store} END"
    return f"""sales AS (SELECT {index} AS "index", {store} AS "Store_ID", {_DIRTY_DATE} AS "Date",
  CAST(o_custkey % 97 AS VARCHAR) AS "Dept", {_DIRTY_SALES} AS "Weekly_Sales" FROM orders)"""


SALES = _sales()
SALES_BAD_KEYS = _sales(bad_keys=True)
SALES_NULL_ONLY = """sales AS (SELECT o_orderkey AS "index", CAST(o_custkey % 5 AS INTEGER) AS "Store_ID",
  CASE WHEN o_orderkey % 19 = 0 THEN 'null' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Date",
  CAST(o_custkey % 97 AS INTEGER) AS "Dept",
  CASE WHEN o_orderkey % 7 = 0 THEN 'null' WHEN o_orderkey % 17 = 0 THEN '0'
    ELSE CAST(o_totalprice AS VARCHAR) END AS "Weekly_Sales" FROM orders)"""

LINES = """lines AS (SELECT l_orderkey AS "index", l_linenumber AS line, l_extendedprice AS price,
  l_quantity AS quantity, l_returnflag AS flag, l_linestatus AS status, l_partkey AS part FROM lineitem)"""


def _economic_columns(rule: str, with_bad: bool) -> str:
    bad = f"WHEN {rule} % 11 = 0 THEN 'bad'" if with_bad else ""
    return f"""CAST(flag = 'R' AS INTEGER) AS "IsHoliday",
  CASE WHEN {rule} % 5 <> 0 THEN price END AS "CPI",
  CASE WHEN {rule} % 6 = 0 THEN 'null' {bad} ELSE CAST(quantity AS VARCHAR) END AS "Unemployment",
  CASE WHEN {rule} % 8 <> 0 THEN status END AS "Type",
  CASE WHEN {rule} % 9 <> 0 THEN part END AS "Size" """


ECONOMIC_LINES = f"""{LINES},
economic_lines AS (SELECT "index", line, price, quantity, flag, status, part,
  {_economic_columns('("index" + line)', True)} FROM lines)"""


def _economic(with_bad: bool = True) -> str:
    return f"""{LINES},
firsts AS (SELECT "index", min({{'line': line, 'price': price, 'quantity': quantity, 'flag': flag,
  'status': status, 'part': part}}) AS f FROM lines GROUP BY "index"),
first_lines AS (SELECT "index", f.price AS price, f.quantity AS quantity, f.flag AS flag,
  f.status AS status, f.part AS part FROM firsts),
economic AS (SELECT "index", {_economic_columns('"index"', with_bad)} FROM first_lines)"""


ECONOMIC = _economic()
ECONOMIC_NULL_ONLY = _economic(with_bad=False)

EVENTS = """events_gaps AS (SELECT event_id, user_id,
  CASE WHEN event_id % 7 > 2 THEN value END AS value,
  CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type,
  CASE WHEN event_id % 4 <> 0 THEN user_id * 10 END AS score FROM events)"""

PARSED = f"""{SALES},
parsed AS (SELECT CAST("index" AS BIGINT) AS "index", CAST("Store_ID" AS INTEGER) AS "Store_ID",
  "Weekly_Sales" AS raw, TRY_CAST("Weekly_Sales" AS DOUBLE) AS sales FROM sales)"""


def fill(column: str, order: str = '"index"', by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return (
        f"last_value({column} IGNORE NULLS) OVER ({part}ORDER BY {order} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


def exact_mean(value: str, decimals: int = 2) -> str:
    """Half-up mean of two-decimal values, in whole cents until the last step."""
    units = f"CAST(sum(CAST(CAST({value} AS DECIMAL(18,2)) * 100 AS BIGINT)) AS HUGEINT)"
    step = f"(count({value}) * {10 ** (2 - decimals)})"
    return f"CAST((2 * {units} + {step}) // (2 * {step}) AS DOUBLE) / {float(10**decimals)}"


def month(date: str) -> str:
    return f"CAST(month({date}) AS INTEGER)"


ORACLES: dict[str, str] = {}

# --- sources and sinks ---------------------------------------------------------------------

ORACLES["scan_parquet"] = "SELECT * FROM events"
ORACLES["scan_csv_positional"] = f"WITH {SALES} SELECT * FROM sales"
ORACLES["scan_dispatch"] = """SELECT c_mktsegment, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"""
ORACLES["bulk_load_csv"] = f"""WITH {SALES_NULL_ONLY} SELECT "index", "Store_ID", "Date", "Dept",
  TRY_CAST("Weekly_Sales" AS DOUBLE) AS "Weekly_Sales" FROM sales"""
ORACLES["typed_literal_table"] = f"""WITH {SALES_NULL_ONLY}
SELECT CASE "Store_ID" WHEN 1 THEN 'first' ELSE 'second' END AS store_name, count(*) AS sales
FROM sales WHERE "Store_ID" IN (1, 2) GROUP BY 1"""

_MEASURES = "SELECT o_orderkey, o_orderstatus, nullif(o_custkey % 3, 0) AS grade, o_totalprice FROM orders"
ORACLES["sink_csv_roundtrip"] = _MEASURES
ORACLES["sink_headerless_roundtrip"] = f"""WITH m AS ({_MEASURES}),
lines AS (SELECT o_orderstatus, concat(o_orderstatus, ',', printf('%.2f', {exact_mean('o_totalprice')})) AS line
  FROM m GROUP BY o_orderstatus)
SELECT m.*, line FROM m JOIN lines USING (o_orderstatus)"""
_MONTHLY = f"""SELECT {month('o_orderdate')} AS month, {exact_mean('o_totalprice')} AS average
FROM orders GROUP BY 1"""
ORACLES["sink_indexed_roundtrip"] = f"""WITH m AS ({_MONTHLY})
SELECT row_number() OVER (ORDER BY month) - 1 AS "index", month, average FROM m"""
ORACLES["sink_indexed_sharded_roundtrip"] = """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1
  AS "index", o_orderkey, o_totalprice FROM orders"""
ORACLES["sink_table_roundtrip"] = f"""SELECT {month('o_orderdate')} AS "Month",
  CAST(o_custkey % 5 AS INTEGER) AS "Store_ID", o_totalprice AS "Weekly_Sales" FROM orders"""

# --- parsing and repair --------------------------------------------------------------------

ORACLES["normalize_missing"] = f"""WITH {SALES} SELECT "index",
  CASE WHEN "Weekly_Sales" NOT IN ('null') THEN "Weekly_Sales" END AS null_only,
  CASE WHEN "Weekly_Sales" NOT IN ('null', 'None') THEN "Weekly_Sales" END AS null_none,
  CASE WHEN "Weekly_Sales" NOT IN ('null', 'None', '') THEN "Weekly_Sales" END AS null_none_blank,
  CASE WHEN "Weekly_Sales" <> '0' THEN CAST("index" AS DOUBLE) END AS no_nan FROM sales"""
ORACLES["try_numeric"] = f"""WITH {SALES_BAD_KEYS}
SELECT TRY_CAST("Weekly_Sales" AS DOUBLE) AS sales, TRY_CAST("Store_ID" AS BIGINT) AS store FROM sales"""
ORACLES["try_date"] = f"""SELECT o_orderkey,
  strftime(TRY_CAST({_DIRTY_DATE} AS TIMESTAMP), '%Y-%m-%d') AS iso,
  strftime(o_orderdate, '%Y-%m-%d') AS by_format FROM orders"""
ORACLES["strict_cast"] = f"""WITH {SALES_NULL_ONLY}
SELECT "index", CAST("Weekly_Sales" AS DOUBLE) AS sales FROM sales WHERE "Weekly_Sales" <> 'null'"""
ORACLES["reject_bad_keys"] = f"""WITH {SALES_BAD_KEYS}
SELECT CASE WHEN TRY_CAST("index" AS BIGINT) IS NOT NULL AND TRY_CAST("Store_ID" AS INTEGER) IS NOT NULL
  THEN 'good' ELSE 'bad' END AS kind, "index", "Store_ID", "Weekly_Sales" FROM sales"""
ORACLES["normalize_key"] = f"""WITH {SALES_BAD_KEYS}, {LINES}
SELECT flag, count(*) AS rows FROM sales JOIN lines ON TRY_CAST(sales."index" AS BIGINT) = lines."index"
GROUP BY flag"""
ORACLES["cast_flag"] = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 5 = 0 THEN true ELSE o_orderkey % 2 <> 0 END AS as_boolean,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 2 AS INTEGER) END AS as_int FROM orders"""
ORACLES["zero_as_missing"] = f"""WITH {SALES}
SELECT "index", nullif(TRY_CAST("Weekly_Sales" AS DOUBLE), 0) AS sales FROM sales"""
ORACLES["default_on_unmatched"] = f"""WITH {ECONOMIC}
SELECT o_orderkey AS "index", CASE WHEN e."index" IS NULL THEN 0.0 ELSE e."CPI" END AS "CPI"
FROM orders LEFT JOIN economic e ON o_orderkey = e."index" """
ORACLES["month_of_date"] = f"SELECT o_orderkey, {month('o_orderdate')} AS month FROM orders"
ORACLES["month_from_text"] = f"""WITH {SALES}
SELECT "index", TRY_CAST(substr("Date", 6, 2) AS INTEGER) AS month FROM sales"""
ORACLES["decimal_measures"] = """SELECT l_orderkey, l_linenumber,
  CAST((CAST(round(l_extendedprice * 100) AS BIGINT) + 4) // 8 AS DOUBLE) / 100.0 AS sales,
  CAST(CAST(l_quantity AS DECIMAL(10,2)) AS DOUBLE) AS quantity FROM lineitem"""
_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
ORACLES["round_half_up"] = f"""SELECT o_orderkey, CAST(({_CENTS} + 5) // 10 AS DOUBLE) / 10.0 AS rounded
FROM orders"""
ORACLES["round_half_even"] = f"""SELECT o_orderkey, CAST({_CENTS} // 10 + CASE
    WHEN {_CENTS} % 10 > 5 OR ({_CENTS} % 10 = 5 AND ({_CENTS} // 10) % 2 = 1) THEN 1 ELSE 0 END
  AS DOUBLE) / 10.0 AS rounded FROM orders"""
ORACLES["round_all_floats"] = """SELECT o_orderkey, o_orderstatus, round(o_totalprice / 7, 2) AS seventh,
  round(o_custkey / 3, 2) AS third FROM orders"""
ORACLES["format_row_text"] = f"""WITH {ECONOMIC}
SELECT "index", concat("index", ',', "IsHoliday", ',', coalesce(CAST("CPI" AS VARCHAR), ''), ',',
    "Unemployment", ',', coalesce("Type", '')) AS line,
  printf('%.2f', "CPI") AS fixed FROM economic"""

# --- ordered fill --------------------------------------------------------------------------

ORACLES["ffill_all"] = f"""WITH {EVENTS} SELECT event_id, {fill('user_id', 'event_id')} AS user_id,
  {fill('value', 'event_id')} AS value, {fill('event_type', 'event_id')} AS event_type,
  {fill('score', 'event_id')} AS score FROM events_gaps"""
ORACLES["ffill_all_blocks"] = ORACLES["ffill_all"]
ORACLES["ffill_columns"] = f"""WITH {EVENTS} SELECT event_id, user_id, {fill('value', 'event_id')} AS value,
  event_type, {fill('score', 'event_id')} AS score FROM events_gaps"""
_BY_TIME = "ts, g.event_id"
ORACLES["ffill_composite_order_blocks"] = f"""WITH {EVENTS}
SELECT g.event_id, g.user_id, {fill('g.value', _BY_TIME)} AS value,
  {fill('g.event_type', _BY_TIME)} AS event_type, {fill('g.score', _BY_TIME)} AS score
FROM events_gaps g JOIN events USING (event_id)"""
ORACLES["ffill_after_try_cast"] = f"""WITH {PARSED} SELECT "index", {fill('sales')} AS sales FROM parsed"""
ORACLES["ffill_missing_only"] = f"""WITH {PARSED} SELECT "index",
  CASE WHEN raw IN ('null', 'None') THEN {fill('sales')} ELSE sales END AS sales FROM parsed"""
ORACLES["ffill_missing_only_blocks"] = ORACLES["ffill_missing_only"]
ORACLES["ffill_by_key"] = f"""WITH {EVENTS} SELECT event_id, user_id,
  {fill('value', 'event_id', 'user_id')} AS value, {fill('event_type', 'event_id', 'user_id')} AS event_type,
  {fill('score', 'event_id', 'user_id')} AS score FROM events_gaps"""
ORACLES["ffill_by_key_blocks"] = f"""WITH {PARSED}
SELECT "index", "Store_ID", {fill('sales', by='"Store_ID"')} AS sales FROM parsed"""
ORACLES["ffill_before_filter"] = f"""WITH {PARSED},
filled AS (SELECT "index", "Store_ID", {fill('sales')} AS sales FROM parsed)
SELECT * FROM filled WHERE "Store_ID" IN (1, 2)"""
ORACLES["ffill_after_filter"] = f"""WITH {PARSED}
SELECT "index", "Store_ID", {fill('sales')} AS sales FROM parsed WHERE "Store_ID" IN (1, 2)"""

# --- joins ---------------------------------------------------------------------------------

ORACLES["join_inner"] = """SELECT o_orderkey AS "index", l_linenumber AS line, o_totalprice,
  l_extendedprice AS price FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""
ORACLES["join_left"] = f"""WITH {ECONOMIC} SELECT o_orderkey AS "index", o_totalprice, "CPI", "Unemployment"
FROM orders LEFT JOIN economic e ON o_orderkey = e."index" """
_FIRST = """firsts AS (SELECT "index", min({'line': line, 'price': price, 'quantity': quantity, 'flag': flag,
  'status': status, 'part': part, 'cpi': "CPI", 'unemployment': "Unemployment"}) AS f
  FROM economic_lines GROUP BY "index")"""
ORACLES["cogroup_first_left"] = f"""WITH {ECONOMIC_LINES}, {_FIRST}
SELECT o_orderkey AS "index", o_totalprice, f.line AS line,
  CASE WHEN firsts."index" IS NULL THEN 0.0 ELSE f.cpi END AS "CPI", f.unemployment AS "Unemployment"
FROM orders LEFT JOIN firsts ON o_orderkey = firsts."index" """
ORACLES["merge_right_wins"] = f"""WITH {ECONOMIC} SELECT o_orderkey AS "index", o_orderstatus,
  CASE WHEN e."index" IS NULL THEN o_totalprice ELSE "CPI" END AS "CPI",
  CASE WHEN e."index" IS NULL THEN 'order' ELSE "Type" END AS "Type", "IsHoliday"
FROM orders LEFT JOIN economic e ON o_orderkey = e."index" """

# --- filters and projections ---------------------------------------------------------------

ORACLES["filter_threshold"] = f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > {T}"
ORACLES["filter_threshold_tolerant"] = f"""WITH {SALES}
SELECT "index", "Weekly_Sales" FROM sales WHERE TRY_CAST("Weekly_Sales" AS DOUBLE) > {T}"""
ORACLES["filter_domain"] = f"""WITH {PARSED}
SELECT "index", "Store_ID" FROM parsed WHERE "Store_ID" IN (1, 2)"""
ORACLES["drop_missing_measure"] = f"""WITH {SALES}
SELECT "index", "Weekly_Sales" FROM sales WHERE "Weekly_Sales" <> 'null'"""
ORACLES["require_not_null"] = f"""WITH {EVENTS} SELECT event_id, value, event_type FROM events_gaps
WHERE value IS NOT NULL AND event_type IS NOT NULL"""
ORACLES["require_truthy"] = f"""WITH {PARSED}, filled AS (SELECT "index", {fill('sales')} AS sales FROM parsed)
SELECT * FROM filled WHERE sales IS NOT NULL AND sales <> 0"""

_JOINED = f"""{SALES}, {ECONOMIC},
joined AS (SELECT CAST("Store_ID" AS INTEGER) AS "Store_ID", CAST("Dept" AS INTEGER) AS "Dept",
  CAST(month(TRY_CAST(nullif("Date", 'null') AS TIMESTAMP)) AS INTEGER) AS "Month", "IsHoliday",
  TRY_CAST("Weekly_Sales" AS DOUBLE) AS "Weekly_Sales", "CPI", "Unemployment"
  FROM sales JOIN economic ON CAST(sales."index" AS BIGINT) = economic."index")"""
_CLEAN = '"Store_ID", "Month", "Dept", "IsHoliday", "Weekly_Sales", "CPI", "Unemployment"'
ORACLES["project_clean"] = f"WITH {_JOINED} SELECT {_CLEAN} FROM joined"
ORACLES["project_typed"] = f"""WITH {_JOINED}
SELECT "Store_ID", "Month", "Dept", 0 AS "IsHoliday", "Weekly_Sales", "CPI",
  TRY_CAST("Unemployment" AS DOUBLE) AS "Unemployment" FROM joined"""
ORACLES["drop_rename"] = 'SELECT c_custkey, c_acctbal AS "Average_Weekly_Sales" FROM customer'
ORACLES["optional_column_default"] = """SELECT l_orderkey, l_linenumber, 0 AS "IsHoliday", l_quantity
FROM lineitem"""

# --- aggregates ----------------------------------------------------------------------------

ORACLES["agg_monthly_avg"] = f"""SELECT {month('o_orderdate')} AS month, {exact_mean('o_totalprice')} AS average
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > {T} GROUP BY 1 ORDER BY 1"""
ORACLES["agg_monthly_avg_sum_count"] = _MONTHLY
ORACLES["agg_monthly_avg_whole"] = f"""WITH m AS (SELECT {month('o_orderdate')} AS month,
  CAST(sum({_CENTS}) AS HUGEINT) AS cents, count(*) * 100 AS step FROM orders GROUP BY 1)
SELECT month, CAST(cents // step + CASE WHEN 2 * (cents % step) > step
    OR (2 * (cents % step) = step AND (cents // step) % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) AS average FROM m"""
ORACLES["agg_filtered_monthly"] = f"""WITH {SALES}
SELECT TRY_CAST(substr("Date", 6, 2) AS INTEGER) AS "Month",
  {exact_mean('TRY_CAST("Weekly_Sales" AS DOUBLE)')} AS "Average_Weekly_Sales"
FROM sales WHERE TRY_CAST("Weekly_Sales" AS DOUBLE) > {T} GROUP BY 1"""
ORACLES["agg_empty_default"] = """SELECT coalesce(round(avg(o_totalprice), 2), 0.0) AS average
FROM orders WHERE o_totalprice > 1e12"""
ORACLES["agg_decimal_avg"] = f"""SELECT {month('o_orderdate')} AS month,
  {exact_mean('o_totalprice')} AS "Avg_Sales" FROM orders GROUP BY 1"""


def _profiled(name: str, missing: str, null: str, zero: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, count(*) AS row_count, CAST(count_if({missing}) AS BIGINT) AS missing_count, "
        f"CAST(count_if({null}) AS BIGINT) AS null_count, CAST({zero} AS BIGINT) AS zero_count FROM profiled"
    )


def _profile_sql() -> str:
    numeric = ["event_id", "user_id", "value", "score", "zeroed"]
    parts = [
        _profiled(c, f"{c} IS NULL", f"{c} IS NULL", f"count_if({c} = 0)") for c in numeric
    ]
    parts.append(
        _profiled("event_type", "event_type IS NULL", "event_type IS NULL", "CAST(NULL AS BIGINT)")
    )
    parts.append(
        _profiled("holed", "holed IS NULL OR isnan(holed)", "holed IS NULL", "count_if(holed = 0)")
    )
    return f"""WITH {EVENTS}, profiled AS (SELECT *, event_id % 3 AS zeroed,
      CASE WHEN event_id % 10 = 0 THEN CAST('nan' AS DOUBLE) ELSE value END AS holed FROM events_gaps)
    {" UNION ALL ".join(parts)}"""


ORACLES["profile_table"] = _profile_sql()
ORACLES["zero_rows_report"] = f"""WITH {PARSED},
repaired AS (SELECT sales AS before, {fill('nullif(sales, 0)')} AS after FROM parsed)
SELECT CAST(count_if(before = 0) AS BIGINT) AS zeros_before,
  CAST(count_if(after = 0) AS BIGINT) AS zeros_after FROM repaired"""
ORACLES["zero_rows_list"] = f"""WITH {PARSED} SELECT "index", "Store_ID" FROM parsed WHERE sales = 0"""

# --- order and row numbers -----------------------------------------------------------------

ORACLES["sort_aggregate"] = f"{_MONTHLY} ORDER BY month"
ORACLES["row_index_zero_based"] = """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS "index",
  o_orderkey FROM orders"""
ORACLES["row_index_zero_based_blocks"] = ORACLES["row_index_zero_based"]
ORACLES["row_index_one_based"] = """SELECT row_number() OVER (ORDER BY o_orderkey) AS "index", o_orderkey
FROM orders"""
ORACLES["row_index_per_key"] = """SELECT row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey)
  AS "index", o_orderkey, o_orderstatus FROM orders"""
ORACLES["row_index_per_key_blocks"] = ORACLES["row_index_per_key"]

# --- quality -------------------------------------------------------------------------------

ORACLES["missing_outputs"] = """SELECT 'clean' AS output, false AS missing, count(*) AS rows FROM orders
UNION ALL SELECT 'aggregate', false, count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'wrong_shape', true, NULL UNION ALL SELECT 'absent', true, NULL"""
ORACLES["missing_names"] = """SELECT DISTINCT concat(year(o_orderdate), '-', month(o_orderdate)) AS output
FROM orders WHERE concat(year(o_orderdate), '-', month(o_orderdate)) NOT IN
  (SELECT concat(year(o_orderdate), '-', month(o_orderdate)) FROM orders WHERE o_totalprice > 499000.0)"""
ORACLES["validate_outputs"] = """WITH written AS (SELECT count(*) > 0 AS has_rows FROM orders)
SELECT output, present, present AS complete, shape_ok AS schema_ok, present AND has_rows AS has_rows
FROM written, (VALUES ('clean', true, true), ('aggregate', true, true), ('wrong_shape', true, false),
  ('absent', false, false)) AS expected(output, present, shape_ok)"""
ORACLES["idempotent_rerun"] = """SELECT run, run = 0 AS wrote, rows FROM
  (SELECT count(*) AS rows FROM orders), (VALUES (0), (1)) AS runs(run)"""
ORACLES["observe_metrics"] = f"""WITH {EVENTS}
SELECT 'rows' AS metric, CAST(count(*) AS BIGINT) AS total FROM events_gaps
UNION ALL SELECT 'nulls_value', CAST(count_if(value IS NULL) AS BIGINT) FROM events_gaps
UNION ALL SELECT 'nulls_event_type', CAST(count_if(event_type IS NULL) AS BIGINT) FROM events_gaps"""


def _errors(name: str, kind: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, CAST(count_if(\"{name}\" IS NOT NULL AND "
        f"TRY_CAST(\"{name}\" AS {kind}) IS NULL) AS BIGINT) AS error_count FROM sales"
    )


ORACLES["conversion_error_counts"] = f"WITH {SALES_BAD_KEYS} " + " UNION ALL ".join(
    [
        _errors("index", "BIGINT"),
        _errors("Store_ID", "INTEGER"),
        _errors("Date", "TIMESTAMP"),
        _errors("Weekly_Sales", "DOUBLE"),
    ]
)

# --- SQL over named inputs -----------------------------------------------------------------


def _single(value: str) -> str:
    """A four-byte float, seen as the double it stands for."""
    return f"CAST(CAST({value} AS FLOAT) AS DOUBLE)"


SQL_JOINED = f"""{SALES_NULL_ONLY}, {ECONOMIC_NULL_ONLY},
joined AS (SELECT "Store_ID", nullif("Date", 'null') AS "Date", "Dept",
  {_single('''CAST(nullif("Weekly_Sales", 'null') AS DOUBLE)''')} AS "Weekly_Sales",
  {_single('"CPI"')} AS "CPI", {_single('''CAST(nullif("Unemployment", 'null') AS DOUBLE)''')} AS "Unemployment"
  FROM sales LEFT JOIN economic USING ("index"))"""
ORACLES["sql_join_left"] = f"WITH {SQL_JOINED} SELECT * FROM joined"


def _cents(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(10,2)) AS DOUBLE)"


SQL_CLEAN = f"""{SQL_JOINED},
clean AS (SELECT "Store_ID", TRY_CAST(substr("Date", 6, 2) AS INTEGER) AS month, "Dept",
  {_cents('"Weekly_Sales"')} AS "Weekly_Sales", {_cents('"CPI"')} AS "CPI",
  {_cents('"Unemployment"')} AS "Unemployment"
  FROM joined WHERE "Store_ID" IN (1, 2) AND "Date" IS NOT NULL AND "Weekly_Sales" > {T})"""
ORACLES["sql_cte_filter"] = f"WITH {SQL_CLEAN} SELECT * FROM clean"
ORACLES["sort_by_hidden_column"] = ORACLES["sql_cte_filter"]
ORACLES["flow_sql_drop_nulls_clean"] = ORACLES["sql_cte_filter"]
ORACLES["flow_sql_drop_nulls_agg"] = f"""WITH {SQL_CLEAN}
SELECT month, {exact_mean('"Weekly_Sales"')} AS "Avg_Sales" FROM clean GROUP BY month"""
ORACLES["sql_monthly_avg"] = ORACLES["agg_decimal_avg"]

# --- whole flows: each is a CTE "clean" with all seven columns -----------------------------


def _typed_sales(sales: str, tokens: str, measure: str = "DOUBLE", also: str = "") -> str:
    """Typed sales with flags for the texts that mean "missing"."""
    known_date = f"CASE WHEN \"Date\" NOT IN ({tokens}) THEN \"Date\" END"
    known_sales = f"CASE WHEN \"Weekly_Sales\" NOT IN ({tokens}) THEN \"Weekly_Sales\" END"
    number = f"TRY_CAST({known_sales} AS DOUBLE)"
    if measure == "FLOAT":
        number = _single(number)
    return f"""{sales},
typed AS (SELECT TRY_CAST("index" AS BIGINT) AS "index", TRY_CAST("Store_ID" AS INTEGER) AS "Store_ID",
  TRY_CAST({known_date} AS TIMESTAMP) AS "Date", CAST("Dept" AS INTEGER) AS "Dept",
  {number} AS "Weekly_Sales",
  "Date" IN ({tokens}) AS date_missing, "Weekly_Sales" IN ({tokens}) AS sales_missing{also} FROM sales)"""


def _flow(ctes: str, threshold_clean: bool, threshold_mean: bool, average: str, month_name: str = "Month",
          decimals: int = 2, holiday: str = '"IsHoliday"') -> tuple[str, str]:
    """(clean, aggregate) SQL over a CTE "merged" with Date and the measures."""
    head = f"""WITH {ctes},
flowed AS (SELECT "Store_ID", CAST(month("Date") AS INTEGER) AS "{month_name}", "Dept",
  {holiday} AS "IsHoliday", "Weekly_Sales", "CPI", "Unemployment" FROM merged)"""
    kept = f'WHERE "Weekly_Sales" > {T}'
    clean = f"{head} SELECT * FROM flowed {kept if threshold_clean else ''}"
    mean = f"""{head} SELECT "{month_name}", {exact_mean('"Weekly_Sales"', decimals)} AS "{average}"
FROM flowed {kept if threshold_mean else ''} GROUP BY "{month_name}" """
    return clean, mean


def _add_flow(name: str, *args, blocks: bool = False, **options) -> None:
    clean, mean = _flow(*args, **options)
    for suffix in ("", "_blocks") if blocks else ("",):
        ORACLES[f"flow_{name}{suffix}_clean"] = clean
        ORACLES[f"flow_{name}{suffix}_agg"] = mean


_NO_TOKEN = "'no such text'"
_NUMBER = 'TRY_CAST("Unemployment" AS DOUBLE)'

# Rows with missing sales go first; the join result is then filled in every column.
_add_flow(
    "drop_then_fill",
    f"""{_typed_sales(SALES_NULL_ONLY, "'null'")}, {ECONOMIC},
both_sides AS (SELECT * FROM typed JOIN economic USING ("index") WHERE "Weekly_Sales" IS NOT NULL),
merged AS (SELECT "index", {', '.join(f'{fill(c)} AS {c}' for c in
    ['"Store_ID"', '"Date"', '"Dept"', '"IsHoliday"', '"Weekly_Sales"', '"CPI"', '"Unemployment"'])}
  FROM both_sides)""",
    True, True, "Avg_Sales", blocks=True,
)

# Both sides filled in every column before the join; four-byte measures; whole-number mean.
_add_flow(
    "fill_all",
    f"""{_typed_sales(SALES, _NO_TOKEN, "FLOAT")}, {ECONOMIC},
left_filled AS (SELECT "index", {fill('"Store_ID"')} AS "Store_ID", {fill('"Date"')} AS "Date",
  {fill('"Dept"')} AS "Dept", {fill('"Weekly_Sales"')} AS "Weekly_Sales" FROM typed),
right_filled AS (SELECT "index", {fill('"IsHoliday"')} AS "IsHoliday", {fill('"CPI"')} AS "CPI",
  {fill(_single(_NUMBER))} AS "Unemployment" FROM economic),
merged AS (SELECT * FROM left_filled JOIN right_filled USING ("index"))""",
    True, True, "Avg_Sales", month_name="month", decimals=0, blocks=True,
)

# Three columns filled before the join; CPI keeps its gaps.
_add_flow(
    "fill_selected",
    f"""{_typed_sales(SALES, "'null'")}, {ECONOMIC},
left_filled AS (SELECT "index", "Store_ID", {fill('"Date"')} AS "Date", "Dept",
  {fill('"Weekly_Sales"')} AS "Weekly_Sales" FROM typed),
right_filled AS (SELECT "index", "IsHoliday", "CPI", {fill(_NUMBER)} AS "Unemployment" FROM economic),
merged AS (SELECT * FROM left_filled JOIN right_filled USING ("index"))""",
    True, True, "Average_Weekly_Sales", blocks=True,
)

_LINE_ORDER = '"index", line, price, quantity, flag, status, part'


def _first_economic(cpi: str, unemployment: str) -> str:
    """Fill over all lines in their full order, then the first line of each key."""
    return f"""{ECONOMIC_LINES},
lines_filled AS (SELECT {_LINE_ORDER}, "IsHoliday", {cpi} AS "CPI", {unemployment} AS "Unemployment"
  FROM economic_lines),
firsts AS (SELECT "index", min({{'line': line, 'price': price, 'quantity': quantity, 'flag': flag,
  'status': status, 'part': part, 'holiday': "IsHoliday", 'cpi': "CPI", 'unemployment': "Unemployment"}}) AS f
  FROM lines_filled GROUP BY "index")"""


# Only missing texts are filled: a bad number stays NULL.
_add_flow(
    "cogroup",
    f"""{_typed_sales(SALES, "'null', 'None'")},
{_first_economic('"CPI"', fill(_NUMBER, _LINE_ORDER))},
left_filled AS (SELECT "index", "Store_ID",
  CASE WHEN date_missing THEN {fill('"Date"')} ELSE "Date" END AS "Date", "Dept",
  CASE WHEN sales_missing THEN {fill('"Weekly_Sales"')} ELSE "Weekly_Sales" END AS "Weekly_Sales" FROM typed),
merged AS (SELECT l.*, f.holiday AS "IsHoliday", f.cpi AS "CPI", f.unemployment AS "Unemployment"
  FROM left_filled l LEFT JOIN firsts ON l."index" = firsts."index")""",
    True, True, "Average_Weekly_Sales", blocks=True,
)

# Bad keys and other stores go before the fill; absent and zero values after it.
_VALIDATED = f"""{_typed_sales(SALES_BAD_KEYS, "'null', 'None', ''")},
{_first_economic(fill('"CPI"', _LINE_ORDER), fill(_NUMBER, _LINE_ORDER))},
left_filled AS (SELECT "index", "Store_ID", {fill('"Date"')} AS "Date", "Dept",
  {fill('"Weekly_Sales"')} AS "Weekly_Sales" FROM typed WHERE "index" IS NOT NULL AND "Store_ID" IN (1, 2)),
merged AS (SELECT l.*, CASE WHEN firsts."index" IS NULL THEN 0.0 ELSE f.cpi END AS "CPI",
    CASE WHEN firsts."index" IS NULL THEN 0.0 ELSE f.unemployment END AS "Unemployment"
  FROM left_filled l LEFT JOIN firsts ON l."index" = firsts."index"
  WHERE "Date" IS NOT NULL AND "Weekly_Sales" IS NOT NULL AND "Weekly_Sales" <> 0)"""
_add_flow("validated", _VALIDATED, False, True, "Average_Weekly_Sales", holiday="0", blocks=True)
ORACLES["flow_published"] = ORACLES["flow_validated_agg"]
ORACLES["flow_published_index"] = f"""WITH {_VALIDATED}
SELECT row_number() OVER (ORDER BY "index") AS "index", "Store_ID", CAST(month("Date") AS INTEGER) AS "Month",
  "Dept", 0 AS "IsHoliday", "Weekly_Sales", "CPI", "Unemployment" FROM merged"""

# Dates are filled over all stores, sales over the kept ones with zeros as gaps; no threshold.
_ZERO_REPAIR = f"""{_typed_sales(SALES, _NO_TOKEN)}, {ECONOMIC},
dated AS (SELECT "index", "Store_ID", {fill('"Date"')} AS "Date", "Dept",
  nullif("Weekly_Sales", 0) AS "Weekly_Sales" FROM typed),
left_filled AS (SELECT "index", "Store_ID", "Date", "Dept", {fill('"Weekly_Sales"')} AS "Weekly_Sales"
  FROM dated WHERE "Store_ID" IN (1, 2)),
right_filled AS (SELECT "index", "IsHoliday", {fill('"CPI"')} AS "CPI", {fill(_NUMBER)} AS "Unemployment",
  {fill('"Type"')} AS "Type", {fill('"Size"')} AS "Size" FROM economic),
merged AS (SELECT * FROM left_filled JOIN right_filled USING ("index"))"""
_add_flow(
    "zero_repair", _ZERO_REPAIR, False, False, "Average_Weekly_Sales",
    holiday='coalesce("IsHoliday" <> 0, true)', blocks=True,
)


def _merged_profile() -> str:
    numeric = ["index", "Store_ID", "Month", "Dept", "Weekly_Sales", "CPI", "Unemployment", "Size"]
    parts = [_profiled(c, f'"{c}" IS NULL', f'"{c}" IS NULL', f'count_if("{c}" = 0)') for c in numeric]
    parts += [_profiled(c, f'"{c}" IS NULL', f'"{c}" IS NULL', "NULL") for c in ("IsHoliday", "Type")]
    return f"""WITH {_ZERO_REPAIR}, profiled AS (SELECT *, month("Date") AS "Month" FROM merged)
    {" UNION ALL ".join(parts)}"""


ORACLES["flow_zero_repair_profile"] = _merged_profile()


# --- several sales rows per key, and a column that both sides have -------------------------


def _sales_twice(bad_keys: bool = False) -> str:
    index = "CAST(o_orderkey AS VARCHAR)"
    if bad_keys:
        index = f"CASE WHEN o_orderkey % 31 = 0 THEN 'invalid' ELSE {index} END"
    once = _sales(bad_keys).replace("sales AS (", "sales_once AS (", 1)
    return f"""{once},
sales AS (SELECT *, 1 AS copy FROM sales_once UNION ALL
  SELECT {index}, CAST((o_custkey + 1) % 5 AS VARCHAR), '2024-02-02', '50',
    printf('%.2f', o_totalprice * 2), 2 FROM orders)"""


_COPIES = '"index", copy'
_FIRST_COPY = 'QUALIFY row_number() OVER (PARTITION BY "index" ORDER BY copy) = 1'


def _cogroup_twice(store: str) -> str:
    return f"""{_typed_sales(_sales_twice(), "'null', 'None'", also=", copy")},
{_first_economic('"CPI"', fill(_NUMBER, _LINE_ORDER))},
left_filled AS (SELECT "index", "Store_ID",
  CASE WHEN date_missing THEN {fill('"Date"', _COPIES)} ELSE "Date" END AS "Date", "Dept",
  CASE WHEN sales_missing THEN {fill('"Weekly_Sales"', _COPIES)} ELSE "Weekly_Sales" END AS "Weekly_Sales", copy
  FROM typed),
first_left AS (SELECT * FROM left_filled {_FIRST_COPY}),
merged AS (SELECT l."index", {store} AS "Store_ID", l."Date", l."Dept", l."Weekly_Sales", f.holiday AS "IsHoliday",
  f.cpi AS "CPI", f.unemployment AS "Unemployment"
  FROM first_left l LEFT JOIN firsts ON l."index" = firsts."index")"""


_add_flow("cogroup_duplicates", _cogroup_twice('l."Store_ID"'), True, True, "Average_Weekly_Sales", blocks=True)
_add_flow(
    "cogroup_clash",
    _cogroup_twice('CASE WHEN firsts."index" IS NULL THEN l."Store_ID" ELSE CAST(l."index" % 3 AS INTEGER) END'),
    True, True, "Average_Weekly_Sales", blocks=True,
)

_VALIDATED_TWICE = f"""{_typed_sales(_sales_twice(bad_keys=True), "'null', 'None', ''", also=", copy")},
{_first_economic(fill('"CPI"', _LINE_ORDER), fill(_NUMBER, _LINE_ORDER))},
left_filled AS (SELECT "index", "Store_ID", {fill('"Date"', _COPIES)} AS "Date", "Dept",
  {fill('"Weekly_Sales"', _COPIES)} AS "Weekly_Sales", copy
  FROM typed WHERE "index" IS NOT NULL AND "Store_ID" IN (1, 2)),
first_left AS (SELECT * FROM left_filled
  WHERE "Date" IS NOT NULL AND "Weekly_Sales" IS NOT NULL AND "Weekly_Sales" <> 0 {_FIRST_COPY}),
merged AS (SELECT l."index", l."Store_ID", l."Date", l."Dept", l."Weekly_Sales",
    CASE WHEN firsts."index" IS NULL THEN 0.0 ELSE f.cpi END AS "CPI",
    CASE WHEN firsts."index" IS NULL THEN 0.0 ELSE f.unemployment END AS "Unemployment"
  FROM first_left l LEFT JOIN firsts ON l."index" = firsts."index")"""
for _name in ("validated_duplicates", "validated_clash"):
    _add_flow(_name, _VALIDATED_TWICE, False, True, "Average_Weekly_Sales", holiday="0", blocks=True)

_add_flow(
    "fill_all_duplicate_keys",
    f"""{_typed_sales(_sales_twice(), _NO_TOKEN, "FLOAT", also=", copy")}, {ECONOMIC},
left_filled AS (SELECT "index", {fill('"Store_ID"', _COPIES)} AS "Store_ID", {fill('"Date"', _COPIES)} AS "Date",
  {fill('"Dept"', _COPIES)} AS "Dept", {fill('"Weekly_Sales"', _COPIES)} AS "Weekly_Sales" FROM typed),
right_filled AS (SELECT "index", {fill('"IsHoliday"')} AS "IsHoliday", {fill('"CPI"')} AS "CPI",
  {fill(_single(_NUMBER))} AS "Unemployment" FROM economic),
merged AS (SELECT * FROM left_filled JOIN right_filled USING ("index"))""",
    True, True, "Avg_Sales", month_name="month", decimals=0, blocks=True,
)

# --- keys that are hard to cut -------------------------------------------------------------

_WIDE = f"""{EVENTS},
wide_events AS (SELECT *, (event_id % 1009 - 504) * 18300000000000000 + event_id AS wide FROM events_gaps)"""


def _gap_fills(order: str) -> str:
    return ", ".join(f"{fill(c, order)} AS {c}" for c in ("value", "event_type", "score"))


ORACLES["ffill_hashed_key_blocks"] = f"WITH {_WIDE} SELECT event_id, wide, {_gap_fills('wide')} FROM wide_events"
ORACLES["row_index_hashed_key_blocks"] = f"""WITH {_WIDE}
SELECT row_number() OVER (ORDER BY wide) - 1 AS "index", event_id FROM wide_events"""
ORACLES["ffill_null_key_blocks"] = f"""WITH {EVENTS},
keyed AS (SELECT *, CASE WHEN event_id % 50 <> 0 THEN event_id END AS key FROM events_gaps)
SELECT event_id, key, {_gap_fills('key NULLS FIRST, event_id')} FROM keyed"""
ORACLES["ffill_text_order_blocks"] = f"""WITH {EVENTS},
texts AS (SELECT g.*, e.event_type AS kind FROM events_gaps g JOIN events e USING (event_id))
SELECT event_id, kind, {_gap_fills('kind, event_id')} FROM texts"""
ORACLES["row_index_text_order_blocks"] = """SELECT row_number() OVER (ORDER BY event_type, event_id) - 1 AS "index",
  event_id FROM events"""
_BUSY = f"""{EVENTS},
days AS (SELECT *, CAST('2024-01-01' AS DATE) + CAST(CASE WHEN event_id % 3 = 0 THEN 40 ELSE event_id % 90 END AS INTEGER) AS day
  FROM events_gaps)"""
ORACLES["ffill_busy_day_blocks"] = f"WITH {_BUSY} SELECT event_id, {_gap_fills('day, event_id')} FROM days"
ORACLES["row_index_busy_day_blocks"] = f"""WITH {_BUSY}
SELECT row_number() OVER (ORDER BY day, event_id) AS "index", event_id FROM days"""

ORACLES["flow_rejects"] = f"""WITH {SALES_BAD_KEYS}
SELECT * FROM sales WHERE TRY_CAST("index" AS BIGINT) IS NULL OR TRY_CAST("Store_ID" AS INTEGER) IS NULL"""
_SALES_TOKENS, _LINE_TOKENS = "'null', 'None', ''", "'null', 'None'"
ORACLES["flow_conversion_errors"] = f"""WITH {SALES_BAD_KEYS}, {ECONOMIC_LINES}
SELECT 'Date' AS "column", count(*) AS n_bad FROM sales
  WHERE "Date" NOT IN ({_SALES_TOKENS}) AND TRY_CAST("Date" AS TIMESTAMP) IS NULL
UNION ALL SELECT 'Weekly_Sales', count(*) FROM sales
  WHERE "Weekly_Sales" NOT IN ({_SALES_TOKENS}) AND TRY_CAST("Weekly_Sales" AS DOUBLE) IS NULL
UNION ALL SELECT 'CPI', 0
UNION ALL SELECT 'Unemployment', count(*) FROM economic_lines
  WHERE "Unemployment" NOT IN ({_LINE_TOKENS}) AND TRY_CAST("Unemployment" AS DOUBLE) IS NULL"""
ORACLES["flow_sql_published_index"] = f"""WITH {SQL_JOINED.replace('SELECT "Store_ID"', 'SELECT "index", "Store_ID"', 1)},
dated AS (SELECT row_number() OVER (ORDER BY "Date", "index") - 1 AS "index", "Store_ID",
  TRY_CAST(substr("Date", 6, 2) AS INTEGER) AS month, "Dept",
  {_cents('"Weekly_Sales"')} AS "Weekly_Sales", {_cents('"CPI"')} AS "CPI", {_cents('"Unemployment"')} AS "Unemployment"
  FROM joined WHERE "Store_ID" IN (1, 2) AND "Date" IS NOT NULL AND "Weekly_Sales" > {T})
SELECT * FROM dated"""


# --- replaced tables, contents and order of outputs, exact numbers, stages of a flow ----------

ORACLES["sink_table_failed_replace"] = _MEASURES
ORACLES["sink_tables_switch_together"] = f"""WITH m AS ({_MEASURES})
SELECT o_orderstatus, count(*) AS rows, {exact_mean('o_totalprice')} AS mean FROM m GROUP BY o_orderstatus"""
ORACLES["sink_order_check"] = """SELECT output, rows, in_order FROM (SELECT count(*) AS rows FROM orders),
  (VALUES ('indexed', true), ('by price', false), ('its own order', true)) AS t(output, in_order)"""
ORACLES["validate_output_contents"] = """SELECT output, n + more AS rows, n AS written, problem FROM (SELECT count(*) AS n FROM orders),
  (VALUES ('as written', 0, NULL), ('text in a column', 0, 'not of its type: o_totalprice'), ('rows lost', -1, 'rows'),
    ('file twice', 1, 'rows')) AS t(output, more, problem)"""
# Whole numbers of 2**-60: every scaled price is one.
ORACLES["agg_mean_any_double"] = f"""WITH s AS (SELECT {month('o_orderdate')} AS month,
  CAST(o_totalprice * pow(2.0, o_orderkey % 21 - 10) * pow(2.0, 60) AS HUGEINT) AS units FROM orders),
g AS (SELECT month, CAST(sum(units) AS HUGEINT) AS units, count(*) * CAST(pow(2.0, 60) AS HUGEINT) AS one FROM s GROUP BY month)
SELECT month, CAST((200 * units + one) // (2 * one) AS DOUBLE) / 100.0 AS average FROM g"""
ORACLES["round_binary_exact"] = """WITH t AS (SELECT o_orderkey,
  CAST(floor(o_totalprice) AS BIGINT) * 1000 + (o_orderkey % 8) * 125 AS thousandths FROM orders)
SELECT o_orderkey, CAST(thousandths // 10 + CASE WHEN thousandths % 10 > 5 OR (thousandths % 10 = 5 AND (thousandths // 10) % 2 = 1)
    THEN 1 ELSE 0 END AS DOUBLE) / 100.0 AS eighths,
  CAST(o_orderkey % 1000 + (o_orderkey % 1000) % 2 AS DOUBLE) AS halves FROM t"""
ORACLES["scan_csv_rejects"] = """WITH b AS (SELECT *, CAST(o_custkey % 5 AS VARCHAR) AS store, CAST(o_totalprice AS VARCHAR) AS price,
  concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey % 5 AS VARCHAR), '2024-01-01') AS cut FROM orders),
l AS (SELECT *, concat_ws(',', CAST(o_orderkey AS VARCHAR), store, strftime(o_orderdate, '%Y-%m-%d'), '"7, or ""8\"""', price) AS whole FROM b),
r AS (SELECT store, CASE WHEN o_orderkey % 41 = 0 THEN whole || ',more' WHEN o_orderkey % 43 = 0 THEN cut
    WHEN o_orderkey % 47 = 0 THEN cut || ',"7,' || price WHEN o_orderkey % 53 = 0 THEN cut || ',7 "or" 8,' || price END AS line,
  CASE WHEN o_orderkey % 41 = 0 THEN 'surplus fields' WHEN o_orderkey % 43 = 0 THEN 'missing fields'
    WHEN o_orderkey % 47 = 0 OR o_orderkey % 53 = 0 THEN 'quotes' END AS reason FROM l)
SELECT line, reason FROM r WHERE reason IS NOT NULL
UNION ALL SELECT 'store ' || store, CAST(count(*) AS VARCHAR) FROM r WHERE reason IS NULL GROUP BY store"""


def _stage(stage: str, rows: str, gaps: tuple[str, ...] = ()) -> str:
    parts = [f"SELECT '{stage}' AS stage, 'rows' AS metric, count(*) AS total FROM {rows}"]
    parts += [f"SELECT '{stage}', 'nulls_{c}', CAST(count_if({g} IS NULL) AS BIGINT) FROM {rows}" for c, g in ((g.strip('"'), g) for g in gaps)]
    return " UNION ALL ".join(parts)


_DATED = ('"Date"', '"Weekly_Sales"')
ORACLES["flow_stage_metrics"] = f"""WITH {_VALIDATED},
accepted AS (SELECT * FROM typed WHERE "index" IS NOT NULL AND "Store_ID" IS NOT NULL),
parsed AS (SELECT "CPI", {_NUMBER} AS "Unemployment" FROM economic_lines)
{_stage("sales", "accepted", _DATED)} UNION ALL {_stage("economic", "parsed", ('"CPI"', '"Unemployment"'))}
UNION ALL {_stage("repaired", "merged", _DATED)} UNION ALL {_stage("joined", "merged", (*_DATED, '"CPI"', '"Unemployment"'))}
UNION ALL {_stage("clean", "merged")}"""
