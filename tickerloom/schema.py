"""Column names and types of a price panel."""

from __future__ import annotations

from pyspark.sql import types as T

SYMBOL = "symbol"
DATE = "published_date"

# Column names of the raw and the feature table.
OHLC = ["open", "high", "low", "close"]
PAGE_FIELDS = [
    "published_date", "open", "high", "low", "close",
    "per_change", "traded_quantity", "traded_amount", "status",
]
PAGE_ROW_NUMBER = "DT_Row_Index"
REQUIRED = [
    "published_date", "open", "high", "low", "close",
    "traded_quantity", "traded_amount", "symbol",
]
FEATURES = [
    "open", "high", "low", "close", "per_change",
    "traded_quantity", "traded_amount", "price_range", "daily_return",
]
TARGET = "target"

INTEGER_FIELDS = {"status"}
NUMERIC_FIELDS = [name for name in PAGE_FIELDS if name != DATE]

# The date stays text until it is parsed: whole-row dedupe comes before date parsing.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            T.StringType()
            if name == DATE
            else T.IntegerType()
            if name in INTEGER_FIELDS
            else T.DoubleType(),
        )
        for name in PAGE_FIELDS
    ]
    + [T.StructField(SYMBOL, T.StringType())]
)
