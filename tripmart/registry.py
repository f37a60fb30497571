"""What the feeds look like: raw schemas, staged columns, labels, names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Raw schemas a file must cast to before it is landed, in file order.
GREEN_RAW = """
    VendorID STRING,
    lpep_pickup_datetime TIMESTAMP_NTZ, lpep_dropoff_datetime TIMESTAMP_NTZ,
    store_and_fwd_flag STRING,
    RatecodeID BIGINT, PULocationID BIGINT, DOLocationID BIGINT, passenger_count BIGINT,
    trip_distance DOUBLE, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE,
    tolls_amount DOUBLE, ehail_fee DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE,
    payment_type BIGINT, trip_type BIGINT, congestion_surcharge DOUBLE
"""
YELLOW_RAW = """
    VendorID STRING,
    tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ,
    passenger_count BIGINT, trip_distance DOUBLE, RatecodeID STRING, store_and_fwd_flag STRING,
    PULocationID BIGINT, DOLocationID BIGINT, payment_type BIGINT,
    fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE,
    improvement_surcharge DOUBLE, total_amount DOUBLE, congestion_surcharge DOUBLE, airport_fee DOUBLE
"""
ZONES_CSV = "locationid DECIMAL(38,9), borough STRING, zone STRING, service_zone STRING"

PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
NUMERIC = "decimal(38,9)"
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_ZONE_SUFFIX = "+00"  # how the warehouse prints a UTC timestamp, kept so that keys stay the same
UNKNOWN_BOROUGH = "Unknown"
PICKUP_COLUMNS = {"green": "lpep_pickup_datetime", "yellow": "tpep_pickup_datetime", "fhv": "pickup_datetime"}
FILE_NAME = "%s_tripdata_%d-%02d.parquet"
PUBLICATION_LAG_MONTHS = 2
VEHICLE_TYPES = ("fhv", "fhvhv", "green", "yellow")
DEFAULT_VEHICLE_TYPES = ("green", "yellow")

# Table and view names that downstream queries already use.
RAW_VIEW = "stg_%s_trips_raw_external"
STAGING_VIEW = "stg_%s_trips"
ZONE_SEED = "taxi_zone_lookup"
ZONE_TABLE = "dim_zones"
TAXI_FACT_TABLE = "fact_taxi_trips"
FHV_FACT_TABLE = "fact_fhv_trips"
# ----------------------------------------------------------------------------

# Partition column of the fact tables.
PICKUP_DAY = "pickup_date"


@dataclass(frozen=True)
class Feed:
    """A feed; without a schema its files are landed with the types they have."""

    name: str
    raw_ddl: str | None = None

    @property
    def schema(self) -> T.StructType | None:
        return T.StructType.fromDDL(self.raw_ddl) if self.raw_ddl else None


FEEDS: Mapping[str, Feed] = {
    "fhv": Feed("fhv"),
    "fhvhv": Feed("fhvhv"),
    "green": Feed("green", GREEN_RAW),
    "yellow": Feed("yellow", YELLOW_RAW),
}


def feed_of(name: str, feeds: Mapping[str, Feed] = FEEDS) -> Feed:
    if name not in feeds:
        raise ValueError(f"unknown feed {name!r}, expected one of {sorted(feeds)}")
    return feeds[name]
