"""Reading and writing tables: Parquet globs, the zone CSV, day partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.casts import field_type
from tripmart.registry import PICKUP_DAY, ZONES_CSV
from tripmart.sources.versions import refresh


def scan_parquet(spark: SparkSession, location: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(location)
    return df.select(*columns) if columns else df


def register_external(spark: SparkSession, locations: Mapping[str, str]) -> None:
    """Register Parquet globs as views, so that SQL can name them."""
    for name, location in locations.items():
        spark.read.parquet(location).createOrReplaceTempView(name)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup CSV, its decimal key exposed as the integer that trips carry.

    An id with a fraction is an error: rounded, it would stand for another zone.
    """
    zones = spark.read.schema(ZONES_CSV).csv(path, header=True, escape='"', mode="FAILFAST")
    whole = F.col("locationid") == F.floor("locationid")
    problem = F.raise_error(F.concat(F.lit("zone id isn't an integer: "), F.col("locationid").cast("string")))
    checked = F.when(F.col("locationid").isNull() | whole, F.col("locationid").cast("bigint")).otherwise(problem.cast("bigint"))
    return zones.withColumn("locationid", checked)


def with_day(df: DataFrame, timestamp: str, day: str = PICKUP_DAY) -> DataFrame:
    """Add the partition day and bring its rows together.

    A rebalance, not a repartition: adaptive execution splits a day that holds a
    large part of the rows over several tasks and joins small days.
    """
    return df.withColumn(day, F.to_date(timestamp)).hint("rebalance", F.col(day))


def write_day_partitioned(
    df: DataFrame, path: str, timestamp: str = "pickup_datetime", day: str = PICKUP_DAY
) -> None:
    with_day(df, timestamp, day).write.mode("overwrite").partitionBy(day).parquet(path)


def read_days(
    table: DataFrame,
    start: datetime,
    end: datetime,
    timestamp: str = "pickup_datetime",
    day: str = PICKUP_DAY,
) -> DataFrame:
    """Rows with start <= timestamp < end.

    A bound on the timestamp does not prune day partitions, so the same bound is put on the day.
    Days are of UTC, so plain bounds are taken as UTC and the session must be in UTC; bounds with a
    zone are converted.
    """
    if table.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        raise ValueError("read_days needs a session in UTC; call tripmart.session.configure first")
    start, end = (b.astimezone(UTC).replace(tzinfo=None) if b.tzinfo else b for b in (start, end))
    dtype = field_type(table, timestamp)
    low, high = (F.lit(bound.isoformat(sep=" ")).cast(dtype) for bound in (start, end))
    return table.where(
        F.col(day).between(F.lit(start.date()), F.lit(end.date()))
        & (F.col(timestamp) >= low)
        & (F.col(timestamp) < high)
    )


def materialize(
    df: DataFrame, name: str, partition_by: str | None = None, location: str | None = None
) -> DataFrame:
    """Full refresh of a table: readers see the old rows until the new ones are all written.

    Rows should come clustered by `partition_by`, see `with_day`. `location` is the
    folder that holds the tables; the warehouse folder by default.
    """
    return refresh(df, name, partition_by, location)
