"""Warehouse casts (rounding) and landing casts (lossless or rejected)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.registry import NUMERIC

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)
TIMES = (T.TimestampType, T.TimestampNTZType)

MAX_EXACT_DOUBLE = 2**53
INTEGER_TEXT = r"^-?[0-9]+$"
NUMBER_TEXT = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|nan|inf|infinity)$"


def field_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a column, names compared the way Spark resolves them."""
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    raise ValueError(f"no column {name!r} in {df.columns}")


def to_integer(df: DataFrame, name: str) -> Column:
    """64-bit integer, halves away from zero.

    A plain Spark cast truncates, so fractional input is rounded first; the
    choice follows the type the column really has.
    """
    col = F.col(name)
    if isinstance(field_type(df, name), (*FRACTIONAL, T.DecimalType)):
        col = F.round(col)
    return col.cast("bigint")


def to_numeric(df: DataFrame, name: str) -> Column:
    """Exact decimal(38,9), halves away from zero.

    NaN and infinity cast to null in Spark; they are an error here, as for integers.
    """
    col = F.col(name)
    exact = col.cast(NUMERIC)
    if isinstance(field_type(df, name), FRACTIONAL):
        no_value = F.raise_error(F.lit(f"{name} has no {NUMERIC} value")).cast(NUMERIC)
        return F.coalesce(exact, F.when(col.isNotNull(), no_value))
    return exact


def to_timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp")


def number_text(col: Column) -> Column:
    """Text of a floating number: 1, 1.5, 1e+10, 1e-7.

    Digits are those Java prints, which before JDK 19 are not always the shortest
    for numbers of 16 digits or more.
    """
    text = col.cast("string")
    size = F.abs(col)
    plain = F.rtrim(F.rtrim(text.cast("decimal(38,24)").cast("string"), F.lit("0")), F.lit("."))
    short = F.replace(text, F.lit(".0E"), F.lit("E"))
    return (
        F.when(F.isnan(col), "nan")
        .when(size == float("inf"), F.when(col > 0, "inf").otherwise("-inf"))
        .when(size == 0, F.replace(text, F.lit(".0"), F.lit("")))
        .when(size < 1e-6, F.replace(short, F.lit("E"), F.lit("e")))
        .when(size < 1e10, plain)
        .when(col.isNotNull(), F.replace(short, F.lit("E"), F.lit("e+")))
    )


class SafeCast(NamedTuple):
    """The cast, and where it would lose or invent something (None: never)."""

    value: Column
    bad: Column | None


def _whole_seconds(col: Column) -> Column:
    return F.date_trunc("second", col) != col


def safe_cast(col: Column, source: T.DataType, target: T.DataType) -> SafeCast | None:
    """Cast that keeps every value, or None if the types do not convert.

    Nulls always pass. Times are kept to the whole second, as landed files are.
    """
    fractional = isinstance(source, FRACTIONAL)
    integral = isinstance(source, INTEGRAL)
    text = isinstance(source, T.StringType)
    scalar = integral or fractional or text or isinstance(source, (T.BooleanType, T.DecimalType))

    if isinstance(target, T.StringType):
        if text:
            return SafeCast(col, None)
        if fractional:
            return SafeCast(number_text(col), None)
        return SafeCast(col.cast("string"), None) if scalar or isinstance(source, T.DateType) else None

    if isinstance(target, T.LongType):
        if integral or isinstance(source, T.BooleanType):
            return SafeCast(col.cast("bigint"), None)
        if fractional:
            limit = float(2**63)
            inside = ~F.isnan(col) & (col >= -limit) & (col < limit)
            return SafeCast(col.cast("bigint"), ~inside | (col != F.rint(col)))
        if isinstance(source, T.DecimalType):
            value = col.try_cast("bigint")
            return SafeCast(value, col.isNotNull() & (value.isNull() | (value.cast(source) != col)))
        if text:
            value = col.try_cast("bigint")
            return SafeCast(value, col.isNotNull() & (~col.rlike(INTEGER_TEXT) | value.isNull()))

    if isinstance(target, T.DoubleType):
        if isinstance(source, T.LongType):
            return SafeCast(col.cast("double"), ~col.between(-MAX_EXACT_DOUBLE, MAX_EXACT_DOUBLE))
        if text:
            return SafeCast(col.try_cast("double"), col.isNotNull() & ~col.rlike(NUMBER_TEXT))
        return SafeCast(col.cast("double"), None) if scalar else None

    if isinstance(target, T.TimestampNTZType):
        if isinstance(source, TIMES):
            return SafeCast(col.cast("timestamp_ntz"), _whole_seconds(col))
        if isinstance(source, T.DateType):
            return SafeCast(col.cast("timestamp_ntz"), None)
        if integral:
            return SafeCast(F.timestamp_seconds(col).cast("timestamp_ntz"), None)
        if text:
            value = col.try_cast("timestamp_ntz")
            return SafeCast(value, col.isNotNull() & (value.isNull() | _whole_seconds(value)))

    return SafeCast(col, None) if source == target else None
