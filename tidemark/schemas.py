"""Table contracts and the fixed values of the data format."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, field order, missing tokens, store ids and the
# sales threshold are part of the data format and of the expected results.
KEY = "index"
SALES_FIELDS = ("index", "Store_ID", "Date", "Dept", "Weekly_Sales")
ECONOMIC_FIELDS = (
    "index", "IsHoliday", "Temperature", "Fuel_Price",
    "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5",
    "CPI", "Unemployment", "Type", "Size",
)
CLEAN_FIELDS = ("Store_ID", "Month", "Dept", "IsHoliday", "Weekly_Sales", "CPI", "Unemployment")
TOKEN_NULL = ("null",)
TOKENS_NULL_NONE = ("null", "None")
TOKENS_NULL_NONE_BLANK = ("null", "None", "")
STORES = (1, 2)
SALES_THRESHOLD = 10000.0


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Every field as text: what a dirty sales file is read with.
SALES_TEXT = _struct(*[(name, T.StringType()) for name in SALES_FIELDS])

SALES_TYPED = _struct(
    ("index", T.LongType()),
    ("Store_ID", T.IntegerType()),
    ("Date", T.TimestampType()),
    ("Dept", T.IntegerType()),
    ("Weekly_Sales", T.DoubleType()),
)

ECONOMIC = _struct(
    ("index", T.LongType()),
    ("IsHoliday", T.IntegerType()),
    ("Temperature", T.DoubleType()),
    ("Fuel_Price", T.DoubleType()),
    ("MarkDown1", T.DoubleType()),
    ("MarkDown2", T.DoubleType()),
    ("MarkDown3", T.DoubleType()),
    ("MarkDown4", T.DoubleType()),
    ("MarkDown5", T.DoubleType()),
    ("CPI", T.DoubleType()),
    ("Unemployment", T.StringType()),
    ("Type", T.StringType()),
    ("Size", T.LongType()),
)

CLEAN = _struct(
    ("Store_ID", T.IntegerType()),
    ("Month", T.IntegerType()),
    ("Dept", T.IntegerType()),
    ("IsHoliday", T.IntegerType()),
    ("Weekly_Sales", T.DoubleType()),
    ("CPI", T.DoubleType()),
    ("Unemployment", T.DoubleType()),
)

AGGREGATE = _struct(("Month", T.IntegerType()), ("Average_Weekly_Sales", T.DoubleType()))
