"""Which files a run asks for, and which of them exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.periods import last_published_month, publication_date
from tripmart.functions.text import trip_file_name


def run_grid(
    spark: SparkSession, vehicle_types: Sequence[str], years: Sequence[int] | None = None
) -> DataFrame:
    """One row per vehicle type and year; a null year means the newest published month."""
    wanted = [(name, year) for name in vehicle_types for year in (years or [None])]
    return spark.createDataFrame(wanted, "vehicle_type string, year int")


def month_grid(runs: DataFrame, as_of: Column, month: int | None = None) -> DataFrame:
    """The monthly files of every (vehicle_type, year) row of `runs`.

    Past years give all twelve months, the running year those already published,
    a null year the newest published month only.
    """
    newest = publication_date(as_of)
    year = F.coalesce(F.col("year"), F.year(newest))
    last = last_published_month(F.col("year"), as_of)
    if month is not None:
        months = F.array(F.lit(month))
    else:
        months = (
            F.when(F.col("year").isNull(), F.array(F.month(newest)))
            .when(last >= 1, F.sequence(F.lit(1), last))
            .otherwise(F.array().cast("array<int>"))
        )
    files = runs.select("vehicle_type", year.alias("year"), F.explode(months).alias("month"))
    return files.withColumn(
        "file_name", trip_file_name(F.col("vehicle_type"), F.col("year"), F.col("month"))
    )


def mark_available(wanted: DataFrame, available: DataFrame, key: str, mark: str = "available") -> DataFrame:
    """All `wanted` rows with a column that says whether their key is available.

    One join gives both halves, so what is wanted is shuffled once however often the halves
    are read within a job. A null key is never available.
    """
    keys = available.select(key).where(F.col(key).isNotNull()).distinct().withColumn(mark, F.lit(True))
    return wanted.join(keys, key, "left").withColumn(mark, F.coalesce(mark, F.lit(False)))


def split_available(wanted: DataFrame, available: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """`wanted` rows whose key is available, and those whose key is not.

    Only distinct available keys are shuffled, so a key listed many times costs no more.
    """
    keys = available.select(key).distinct()
    return wanted.join(keys, key, "left_semi"), wanted.join(keys, key, "left_anti")
