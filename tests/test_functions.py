import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import (
    code_label,
    coalesce_default,
    last_published_month,
    normalize_run_id,
    number_text,
    publication_date,
    replace_literal,
    safe_cast,
    surrogate_key,
    to_integer,
    to_numeric,
    trip_file_name,
    url_basename,
)
from tripmart.registry import NULL_KEY_TOKEN, PAYMENT_TYPES


def values(df, col):
    return [row[0] for row in df.select(col).collect()]


def single(spark, rows, dtype):
    return spark.createDataFrame([(row,) for row in rows], f"x {dtype}").coalesce(1)


def test_code_labels(spark):
    df = single(spark, [0, 1, 6, 7, None], "bigint")
    assert values(df, code_label(F.col("x"), PAYMENT_TYPES)) == [None, "Credit card", "Voided trip", None, None]


@pytest.mark.parametrize(
    ("rows", "dtype", "want"),
    [
        ([2.5, -2.5, 7.0, 0.49999999999999994, None], "double", [3, -3, 7, 0, None]),
        (["12", "-3", None], "string", [12, -3, None]),
        ([1, None], "int", [1, None]),
    ],
)
def test_to_integer(spark, rows, dtype, want):
    df = single(spark, rows, dtype)
    assert values(df, to_integer(df, "X")) == want


def test_to_integer_rounds_decimals(spark):
    df = single(spark, ["2.5", "-2.5", "2.4"], "string").select(F.col("x").cast("decimal(10,2)"))
    assert values(df, to_integer(df, "x")) == [3, -3, 2]


@pytest.mark.parametrize(("rows", "dtype"), [([float("nan")], "double"), (["1.0"], "string"), (["a"], "string")])
def test_to_integer_rejects(spark, rows, dtype):
    df = single(spark, rows, dtype)
    with pytest.raises(Exception, match="CAST"):
        values(df, to_integer(df, "x"))


def test_to_numeric(spark):
    df = single(spark, [12.3, 0.0000000005, -0.0000000005, None], "double")
    got = [None if v is None else str(v) for v in values(df, to_numeric(df, "x"))]
    assert got == ["12.300000000", "1E-9", "-1E-9", None]


@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf")])
def test_to_numeric_rejects(spark, value):
    df = single(spark, [value], "double")
    with pytest.raises(Exception, match="no decimal"):
        values(df, to_numeric(df, "x"))


def test_surrogate_key_spells_nulls_out(spark):
    at = dt.datetime(2023, 1, 2, 3, 4, 5)
    df = spark.createDataFrame([(None, at), ("1", at), (None, None)], "v string, t timestamp_ntz").coalesce(1)
    texts = [f"{NULL_KEY_TOKEN}-2023-01-02 03:04:05", "1-2023-01-02 03:04:05", f"{NULL_KEY_TOKEN}-{NULL_KEY_TOKEN}"]
    assert values(df, surrogate_key(df, "v", "t")) == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_surrogate_key_keeps_fractions_and_zone(spark):
    at = dt.datetime(2023, 1, 2, 3, 4, 5, 120)
    df = spark.createDataFrame([(1.0, at)], "v double, t timestamp")
    want = hashlib.md5(b"1-2023-01-02 03:04:05.000120+00").hexdigest()
    assert values(df, surrogate_key(df, "v", "t", zone_suffix="+00")) == [want]


def test_number_text(spark):
    cases = {
        1.0: "1", 1.5: "1.5", -2.0: "-2", 123456789.0: "123456789", 1.5e10: "1.5e+10", 1e20: "1e+20",
        12345678901234567.0: "1.2345678901234568e+16", 0.1: "0.1", 0.001: "0.001", 1e-5: "0.00001", 1e-7: "1e-7",
        0.0: "0", 1e7: "10000000", 12345678.25: "12345678.25", float("inf"): "inf", float("-inf"): "-inf",
    }
    df = single(spark, [*cases, float("nan"), None], "double")
    assert values(df, number_text(F.col("x"))) == [*cases.values(), "nan", None]


@pytest.mark.parametrize(
    ("rows", "source", "target", "bad"),
    [
        ([1.0, 1.5, float("nan"), 2.0**63, -(2.0**63), None], "double", "bigint", [0, 1, 1, 1, 0, 0]),
        (["1", "1.0", " 1", "", None], "string", "bigint", [0, 1, 1, 1, 0]),
        (["1.5", "1e3", "x", "1d", None], "string", "double", [0, 0, 1, 1, 0]),
        ([2**53, 2**53 + 1, None], "bigint", "double", [0, 1, 0]),
        (
            [dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 1, 0, 0, 0, 1000), None],
            "timestamp_ntz", "timestamp_ntz", [0, 1, 0],
        ),
        (["2023-01-01 10:00:00", "no time", "2023-01-01 10:00:00.5"], "string", "timestamp_ntz", [0, 1, 1]),
    ],
)
def test_safe_cast_finds_losses(spark, rows, source, target, bad):
    df = single(spark, rows, source)
    cast = safe_cast(F.col("x"), df.schema["x"].dataType, T.StructType.fromDDL(f"x {target}")["x"].dataType)
    assert values(df, F.coalesce(cast.bad, F.lit(False)).cast("int")) == bad
    kept = [row for row, flag in zip(rows, bad) if not flag]
    clean = single(spark, kept, source)
    assert [v is None for v in values(clean, cast.value)] == [v is None for v in kept]


def test_safe_cast_without_conversion():
    assert safe_cast(F.lit(1), T.BinaryType(), T.DoubleType()) is None
    assert safe_cast(F.lit(1), T.TimestampNTZType(), T.LongType()) is None


def test_text(spark):
    df = single(spark, ["a/b/c.parquet", "c.parquet", "a/"], "string")
    assert values(df, url_basename(F.col("x"))) == ["c.parquet", "c.parquet", ""]
    df = single(spark, ["manual__2023-04-01T00:00:00+00:00", "a---b"], "string")
    assert values(df, normalize_run_id(F.col("x"))) == ["manual-2023-04-01-00-00-00-00-00", "a--b"]
    df = single(spark, ["Boro Zone", "Yellow Zone", "BoroBoro", None], "string")
    assert values(df, replace_literal(F.col("x"), "Boro", "Green")) == ["Green Zone", "Yellow Zone", "GreenGreen", None]
    assert values(df, coalesce_default(F.col("x"), "none"))[-1] == "none"
    name = trip_file_name(F.lit("green"), F.lit(2023), F.lit(4))
    assert values(df.limit(1), name) == ["green_tripdata_2023-04.parquet"]


@pytest.mark.parametrize(
    ("today", "newest", "months"),
    [
        ("2023-01-15", (2022, 11), {2022: 12, 2023: 0}),
        ("2023-02-28", (2022, 12), {2022: 12, 2023: 0}),
        ("2023-03-31", (2023, 1), {2022: 12, 2023: 1, 2024: 0}),
    ],
)
def test_publication_wraps_over_the_year(spark, today, newest, months):
    as_of = F.to_date(F.lit(today))
    got = publication_date(as_of)
    assert tuple(spark.range(1).select(F.year(got), F.month(got)).first()) == newest
    df = single(spark, list(months), "int")
    assert values(df, last_published_month(F.col("x"), as_of)) == list(months.values())
