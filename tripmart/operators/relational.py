"""Deduplication, tagged union, constants, sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.keys import surrogate_key

ROW_NUMBER = "__row_num"


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by `order_by`.

    Give an order that is total over the columns that matter, so that the result
    does not depend on how rows are spread. Catalyst puts a group limit below the
    shuffle, so each task sends at most one row per key however hot the key is.
    Name the most selective fixed-width key first: it becomes the sort prefix.
    """
    if not order_by:
        raise ValueError("order_by must not be empty: the surviving row would be arbitrary")
    by_key = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn(ROW_NUMBER, F.row_number().over(by_key))
        .where(F.col(ROW_NUMBER) == 1)
        .drop(ROW_NUMBER)
    )


def tag_union(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """All rows of all parts, each marked with the part it came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)


def conform_constants(df: DataFrame, constants: Mapping[str, tuple[Any, str]]) -> DataFrame:
    """Add columns a feed lacks: name -> (value, type)."""
    return df.withColumns({name: F.lit(value).cast(dtype) for name, (value, dtype) in constants.items()})


def sample_groups(df: DataFrame, keys: Sequence[str], share: float | None) -> DataFrame:
    """All rows of about `share` of the keys, chosen by a hash of the key; None keeps all.

    Unlike a limit it commutes with whatever works per key, so it can stand below a
    deduplication, whose shuffle then carries that share of the rows only.
    """
    if share is None or share == 1:
        return df
    if not 0 < share < 1:
        raise ValueError("share must be above 0 and at most 1")
    digits = F.substring(surrogate_key(df, *keys), 1, 4)
    return df.where(digits < F.lit(format(round(share * 16**4), "04x")))


def sample(df: DataFrame, rows: int | None) -> DataFrame:
    """At most `rows` arbitrary rows; None keeps all."""
    return df if rows is None else df.limit(rows)
