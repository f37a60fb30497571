"""Typed, deduplicated staging sets, one per feed."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import code_label, surrogate_key, to_integer, to_numeric, to_timestamp
from tripmart.operators import conform_constants, dedup_first, sample, sample_groups
from tripmart.registry import KEY_ZONE_SUFFIX, NUMERIC, PAYMENT_TYPES
from tripmart.sources.tables import with_day

# Staged columns in output order, as (name, raw column, type).
TAXI_COLUMNS = """
    vendorid                 vendorid                   integer
    ratecodeid               ratecodeid                 integer
    pickup_locationid        pulocationid               integer
    dropoff_locationid       dolocationid               integer
    pickup_datetime          {prefix}_pickup_datetime   timestamp
    dropoff_datetime         {prefix}_dropoff_datetime  timestamp
    store_and_fwd_flag       store_and_fwd_flag         same
    passenger_count          passenger_count            integer
    trip_distance            trip_distance              numeric
    trip_type                trip_type                  integer
    fare_amount              fare_amount                numeric
    extra                    extra                      numeric
    mta_tax                  mta_tax                    numeric
    tip_amount               tip_amount                 numeric
    tolls_amount             tolls_amount               numeric
    ehail_fee                ehail_fee                  numeric
    improvement_surcharge    improvement_surcharge      numeric
    total_amount             total_amount               numeric
    payment_type             payment_type               integer
    payment_type_description payment_type               payment
    congestion_surcharge     congestion_surcharge       numeric
"""
# Columns the yellow feed lacks: every such trip is hailed on the street, none by app.
YELLOW_CONSTANTS = {"trip_type": (1, "bigint"), "ehail_fee": (0, NUMERIC)}
FHV_COLUMNS = """
    affiliated_base_number   affiliated_base_number string
    dispatching_base_num     dispatching_base_num   string
    dropoff_locationid       dolocationid           integer
    pickup_locationid        pulocationid           integer
    dropoff_datetime         dropoff_datetime       timestamp
    pickup_datetime          pickup_datetime        timestamp
    sr_flag                  sr_flag                integer
"""


def _columns(spec: str) -> list[list[str]]:
    return [line.split() for line in spec.strip().splitlines()]


def _staged(df: DataFrame, name: str, raw: str, kind: str) -> Column:
    if kind == "integer":
        col = to_integer(df, raw)
    elif kind == "numeric":
        col = to_numeric(df, raw)
    elif kind == "timestamp":
        col = to_timestamp(raw)
    elif kind == "payment":
        col = code_label(F.col(raw), PAYMENT_TYPES)
    elif kind == "string":
        col = F.col(raw).cast("string")
    else:
        col = F.col(raw)
    return col.alias(name)


def _project(df: DataFrame, spec: str, key: tuple[str, str], day: str | None) -> DataFrame:
    """Type the columns; with `day`, cluster by the pickup day first.

    Rows are moved at their raw width, before keys and exact decimals widen them.
    The key hashes raw columns, so it is taken in the same select as their casts.
    """
    _, pickup = key
    if day is not None:
        df = with_day(df, pickup, day)
    tripid = surrogate_key(df, *key, zone_suffix=KEY_ZONE_SUFFIX).alias("tripid")
    return df.select(tripid, *[_staged(df, *column) for column in _columns(spec)], *([day] if day else []))


def _stage_taxi(
    raw: DataFrame,
    prefix: str,
    sample_limit: int | None,
    day: str | None,
    constants: Mapping[str, tuple[Any, str]],
    sample_share: float | None,
) -> DataFrame:
    """One trip per vendor and pickup time.

    Only the raw columns that are staged pass the shuffle. All of them order the
    survivors, so equal runs agree. A share of the keys is taken before they are shuffled.
    """
    spec, pickup = TAXI_COLUMNS.format(prefix=prefix), f"{prefix}_pickup_datetime"
    used = list(dict.fromkeys(source for _, source, _ in _columns(spec) if source not in constants))
    known = raw.select(*used).where(F.col("vendorid").isNotNull())
    keys = [pickup, "vendorid"]
    known = sample_groups(known, ["vendorid", pickup], sample_share)
    kept = dedup_first(known, keys, [name for name in used if name not in keys])
    kept = conform_constants(kept, constants)
    return sample(_project(kept, spec, ("vendorid", pickup), day), sample_limit)


def stage_green(
    raw: DataFrame, sample_limit: int | None = None, day: str | None = None, sample_share: float | None = None
) -> DataFrame:
    return _stage_taxi(raw, "lpep", sample_limit, day, {}, sample_share)


def stage_yellow(
    raw: DataFrame, sample_limit: int | None = None, day: str | None = None, sample_share: float | None = None
) -> DataFrame:
    return _stage_taxi(raw, "tpep", sample_limit, day, YELLOW_CONSTANTS, sample_share)


def stage_fhv(
    raw: DataFrame, sample_limit: int | None = None, day: str | None = None, sample_share: float | None = None
) -> DataFrame:
    """All rows: this feed is neither deduplicated nor filtered."""
    used = list(dict.fromkeys(source for _, source, _ in _columns(FHV_COLUMNS)))
    key = ("dispatching_base_num", "pickup_datetime")
    wanted = sample_groups(raw.select(*used), key, sample_share)
    return sample(_project(wanted, FHV_COLUMNS, key, day), sample_limit)
