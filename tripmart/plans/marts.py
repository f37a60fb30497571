"""The zone dimension and the fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import replace_literal
from tripmart.operators import join_roles, tag_union
from tripmart.registry import PICKUP_DAY, UNKNOWN_BOROUGH

# Fact columns in output order.
TAXI_FACT = """
    tripid vendorid service_type ratecodeid
    pickup_locationid pickup_borough pickup_zone
    dropoff_locationid dropoff_borough dropoff_zone
    pickup_datetime dropoff_datetime store_and_fwd_flag passenger_count trip_distance trip_type
    fare_amount extra mta_tax tip_amount tolls_amount ehail_fee improvement_surcharge total_amount
    payment_type payment_type_description congestion_surcharge
"""
FHV_FACT = """
    tripid affiliated_base_number dispatching_base_num sr_flag
    pickup_locationid pickup_borough pickup_zone
    dropoff_locationid dropoff_borough dropoff_zone
    pickup_datetime dropoff_datetime
"""
ROLES = {"pickup": "pickup_locationid", "dropoff": "dropoff_locationid"}


def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        "locationid",
        "borough",
        "zone",
        replace_literal(F.col("service_zone"), "Boro", "Green").alias("service_zone"),
    )


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose pickup and dropoff zones are both known, with their names."""
    known = zones.where(F.col("borough") != UNKNOWN_BOROUGH)
    return join_roles(trips, known, "locationid", ROLES, ["borough", "zone"])


def _fact(trips: DataFrame, zones: DataFrame, columns: str) -> DataFrame:
    """The fact columns, and the pickup day if the trips came clustered by it."""
    day = [PICKUP_DAY] if PICKUP_DAY in trips.columns else []
    return with_zones(trips, zones).select(*columns.split(), *day)


def fact_taxi(green: DataFrame, yellow: DataFrame, zones: DataFrame) -> DataFrame:
    return _fact(tag_union({"Green": green, "Yellow": yellow}, "service_type"), zones, TAXI_FACT)


def fact_fhv(fhv: DataFrame, zones: DataFrame) -> DataFrame:
    return _fact(fhv, zones, FHV_FACT)
