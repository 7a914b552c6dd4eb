"""Numeric columns: tolerant casts, price text, currency, clipping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, NumericType, StringType

# Fixed value: text that reads as a number. Testing it first keeps the cast from raising, which is
# slow on text, and from accepting forms like '1d'.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def to_number(col: Column, kind: DataType | None = None) -> Column:
    """Double from a column of type ``kind`` (text, if not given); null where it is no number or NaN."""
    kind = kind or StringType()
    if isinstance(kind, (DoubleType, FloatType)):
        return nan_to_null(col.cast("double"))
    if isinstance(kind, (NumericType, BooleanType)):
        return col.cast("double")
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def parse_price(col: Column) -> Column:
    return to_number(F.regexp_replace(col.cast("string"), "[$,]", ""))


def convert(price: Column, rate: Column) -> Column:
    """Local price in whole units, halves to even."""
    return F.bround(price * rate, 0)


def clip(col: Column, low: float | None, high: float | None) -> Column:
    """``col`` within [low, high]; null stays null, a missing bound does not limit."""
    clipped = col
    if high is not None:
        clipped = F.when(clipped > high, F.lit(high)).otherwise(clipped)
    if low is not None:
        clipped = F.when(clipped < low, F.lit(low)).otherwise(clipped)
    return clipped
