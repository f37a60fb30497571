"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.casts import FRACTIONAL, TIMES, field_type, number_text
from tripmart.registry import NULL_KEY_TOKEN

SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MICROS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def key_text(df: DataFrame, name: str, zone_suffix: str = "") -> Column:
    """Text of a column as the key hashes it; times print the same in every session."""
    col, dtype = F.col(name), field_type(df, name)
    if isinstance(dtype, TIMES):
        text = F.when(
            F.date_trunc("second", col) == col, F.date_format(col, SECONDS_FORMAT)
        ).otherwise(F.date_format(col, MICROS_FORMAT))
        return F.concat(text, F.lit(zone_suffix)) if zone_suffix else text
    if isinstance(dtype, FRACTIONAL):
        return number_text(col)
    return col.cast("string")


def surrogate_key(df: DataFrame, *names: str, zone_suffix: str = "") -> Column:
    """MD5 of the dash-joined columns, nulls spelled out.

    `names` must be the raw columns: once a cast of the same name replaces one,
    its text and so the key would change.
    """
    parts = [F.coalesce(key_text(df, name, zone_suffix), F.lit(NULL_KEY_TOKEN)) for name in names]
    return F.md5(F.concat_ws("-", *parts))
