"""Building the whole warehouse, or a part of it."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import fits_broadcast, sample
from tripmart.plans.marts import dim_zones, fact_fhv, fact_taxi
from tripmart.plans.staging import stage_fhv, stage_green, stage_yellow
from tripmart.registry import (
    FEEDS,
    FHV_FACT_TABLE,
    PICKUP_COLUMNS,
    PICKUP_DAY,
    RAW_VIEW,
    STAGING_VIEW,
    TAXI_FACT_TABLE,
    ZONE_SEED,
    ZONE_TABLE,
)
from tripmart.session import configure, sized
from tripmart.sources import input_bytes, materialize, read_zones, scan_by_columns, with_day
from tripmart.sources.files import Store
from tripmart.sources.footers import Opener
from tripmart.sources.versions import table_facts

STAGES = {"green": stage_green, "yellow": stage_yellow, "fhv": stage_fhv}
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
FACT_FEEDS = {TAXI_FACT_TABLE: ("green", "yellow"), FHV_FACT_TABLE: ("fhv",)}


def read_feed(
    spark: SparkSession, feed: str, location: str, opener: Opener | None = None
) -> tuple[list[DataFrame], int]:
    """Landed files of a feed, and their uncompressed bytes; those landed as they came may have several sets of types."""
    if FEEDS[feed].raw_ddl:
        return [spark.read.parquet(location)], input_bytes(spark, location, opener)
    return scan_by_columns(spark, location, opener)


def stage(
    feed: str,
    parts: Sequence[DataFrame],
    sample_limit: int | None = None,
    day: str | None = None,
    sample_share: float | None = None,
) -> DataFrame:
    """A staging set; each kind of raw file is staged by its own types."""
    staged = [STAGES[feed](part, day=day, sample_share=sample_share) for part in parts]
    return sample(reduce(DataFrame.unionByName, staged), sample_limit)


def build(
    spark: SparkSession,
    raw: Mapping[str, str],
    zones_csv: str,
    facts: Sequence[str] = (TAXI_FACT_TABLE, FHV_FACT_TABLE),
    sample_limit: int | None = None,
    location: str | None = None,
    sample_share: float | None = None,
    opener: Opener | None = None,
) -> dict[str, DataFrame]:
    """Register raw and staging views, refresh the zone table and the chosen fact tables.

    `raw` maps a feed to the location of its landed files. `sample_limit` keeps that
    many rows per staging view, `sample_share` that share of the trip keys, for trial runs. `location` is where tables
    are put, `opener` opens footers as for `ingest`. Shuffles are sized by the bytes that the footers tell.
    """
    configure(spark)
    feeds = list(dict.fromkeys(feed for fact in facts for feed in FACT_FEEDS[fact]))
    found = {feed: read_feed(spark, feed, raw[feed], opener) for feed in feeds}
    sources = {feed: parts for feed, (parts, _) in found.items()}
    staged = {feed: stage(feed, parts, sample_limit, None, sample_share) for feed, parts in sources.items()}
    views = {RAW_VIEW % feed: reduce(DataFrame.unionByName, parts) for feed, parts in sources.items()}
    views |= {STAGING_VIEW % feed: df for feed, df in staged.items()}
    views[ZONE_SEED] = read_zones(spark, zones_csv)
    for name, df in views.items():
        df.createOrReplaceTempView(name)

    zones = materialize(dim_zones(views[ZONE_SEED]), ZONE_TABLE, location=location)
    tables = {ZONE_TABLE: zones}
    # Trips keep their place when the zones are broadcast, so they can be clustered while narrow.
    early = sample_limit is None and fits_broadcast(zones)
    for fact in facts:
        with sized(spark, sum(found[feed][1] for feed in FACT_FEEDS[fact])):
            trips = [
                stage(feed, sources[feed], None, PICKUP_DAY, sample_share) if early else staged[feed]
                for feed in FACT_FEEDS[fact]
            ]
            rows = _fact_rows(fact, trips, zones)
            if not early:
                rows = with_day(rows, "pickup_datetime")
            tables[fact] = materialize(rows, fact, partition_by=PICKUP_DAY, location=location)
    return views | tables


def _fact_rows(fact: str, trips: Sequence[DataFrame], zones: DataFrame) -> DataFrame:
    return (fact_taxi if fact == TAXI_FACT_TABLE else fact_fhv)(*trips, zones)


def pickup_days(
    spark: SparkSession,
    raw: Mapping[str, str],
    months: Iterable[tuple[str, int, int]],
    opener: Opener | None = None,
) -> DataFrame:
    """(pickup_date) of the trips in the landed months, given as (feed, year, month). Null if a trip has no pickup time."""
    by_feed: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for feed, year, month in months:
        by_feed[feed].append((year, month))
    days = [spark.createDataFrame([], f"{PICKUP_DAY} date")]
    for feed, wanted in by_feed.items():
        for part in read_feed(spark, feed, raw[feed], opener)[0]:
            inside = reduce(Column.__or__, [(F.col("year") == y) & (F.col("month") == m) for y, m in wanted])
            days.append(part.where(inside).select(F.to_date(PICKUP_COLUMNS[feed]).alias(PICKUP_DAY)))
    return reduce(DataFrame.unionAll, days).distinct()


def refresh_days(
    spark: SparkSession,
    raw: Mapping[str, str],
    fact: str,
    days: DataFrame,
    opener: Opener | None = None,
) -> list[date | None]:
    """Rebuild only the given days of a fact table; returns them.

    A trip's key holds its pickup time, so a day stands alone. Take `days` from `pickup_days` of the months that have just
    landed; where months were published again, unite it with their days before the landing. The bounds of the
    days reach the scan of the raw files. The days are written aside and then take the places of the old ones one after
    the other; days left without trips go. A run that was interrupted is repaired by running it again.
    """
    configure(spark)
    days = stored_days(days)
    touched = sorted((r[0] for r in days.collect()), key=lambda d: (d is not None, d or date.min))  # one entry a day
    if not touched:
        return []
    known = [d for d in touched if d is not None]
    zones, place = spark.table(ZONE_TABLE), table_facts(spark, fact)["location"]
    chosen = days.select(F.col(PICKUP_DAY).alias("touched"))
    chosen = F.broadcast(chosen) if fits_broadcast(chosen) else chosen
    trips, n_bytes = [], 0
    for feed in FACT_FEEDS[fact]:
        parts, size = read_feed(spark, feed, raw[feed], opener)
        pickup = F.col(PICKUP_COLUMNS[feed])
        inside = pickup.isNull() if None in touched else F.lit(False)
        if known:
            inside |= (pickup >= F.lit(known[0])) & (pickup < F.lit(known[-1] + timedelta(days=1)))
        on = F.to_date(pickup).eqNullSafe(F.col("touched"))
        trips.append(stage(feed, [p.where(inside).join(chosen, on, "left_semi") for p in parts]))
        n_bytes += size
    store, aside = Store(spark), f"{place}-days-{uuid.uuid4().hex}"
    try:
        with sized(spark, n_bytes):
            rows = with_day(_fact_rows(fact, trips, zones), "pickup_datetime")
            rows.write.partitionBy(PICKUP_DAY).parquet(aside)
        made = {path.rsplit("/", 1)[-1] for path, _ in store.children(aside)}
        for day in touched:
            folder = f"{PICKUP_DAY}={NULL_PARTITION if day is None else day}"
            if store.exists(f"{place}/{folder}"):
                store.move(f"{place}/{folder}", f"{aside}/_old/{folder}")
            if folder in made:
                store.move(f"{aside}/{folder}", f"{place}/{folder}")
    finally:
        store.delete(aside)
    spark.sql(f"REFRESH TABLE {fact}")
    return touched


def stored_days(days: DataFrame) -> DataFrame:
    """The days as rows of their own, so that they aren't found anew for each use."""
    return days.sparkSession.createDataFrame([tuple(r) for r in days.distinct().collect()], f"{PICKUP_DAY} date")
