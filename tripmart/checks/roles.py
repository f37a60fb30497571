"""The driver tables in the roles of trip feeds and zones.

Each select list is given for Spark and, where functions differ, for SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

UNKNOWN = "CASE WHEN r_name = 'ASIA' THEN 'Unknown' ELSE r_name END"

# name -> expression; `{hours(x)}` differs between the engines.
GREEN = {
    "VendorID": "CAST(l_suppkey AS {string})",
    "lpep_pickup_datetime": "l_shipdate",
    "lpep_dropoff_datetime": "l_shipdate + {hours}(l_linenumber)",
    "store_and_fwd_flag": "l_returnflag",
    "RatecodeID": "CAST(l_linenumber AS BIGINT)",
    "PULocationID": "l_suppkey % 25",
    "DOLocationID": "l_partkey % 25",
    "passenger_count": "CAST(l_quantity AS BIGINT)",
    "trip_distance": "l_quantity",
    "fare_amount": "l_extendedprice",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "tip_amount": "l_discount",
    "tolls_amount": "l_tax",
    "ehail_fee": "l_discount",
    "improvement_surcharge": "l_tax",
    "total_amount": "l_extendedprice",
    "payment_type": "CAST(l_linenumber AS BIGINT)",
    "trip_type": "CAST(l_orderkey % 2 + 1 AS BIGINT)",
    "congestion_surcharge": "l_tax",
}
YELLOW = {
    "VendorID": "CAST(o_custkey AS {string})",
    "tpep_pickup_datetime": "o_orderdate",
    "tpep_dropoff_datetime": "o_orderdate + {hours}(CAST(o_orderkey % 24 AS INT))",
    "passenger_count": "o_custkey % 6",
    "trip_distance": "o_totalprice",
    "RatecodeID": "CAST(o_orderkey % 6 AS {string})",
    "store_and_fwd_flag": "o_orderstatus",
    "PULocationID": "o_custkey % 25",
    "DOLocationID": "o_orderkey % 25",
    "payment_type": "CAST(substr(o_orderpriority, 1, 1) AS BIGINT)",
    "fare_amount": "o_totalprice",
    "extra": "CAST(0.5 AS DOUBLE)",
    "mta_tax": "CAST(0.5 AS DOUBLE)",
    "tip_amount": "o_totalprice",
    "tolls_amount": "CAST(0 AS DOUBLE)",
    "improvement_surcharge": "CAST(0.3 AS DOUBLE)",
    "total_amount": "o_totalprice",
    "congestion_surcharge": "CAST(2.5 AS DOUBLE)",
    "airport_fee": "CAST(0 AS DOUBLE)",
}
FHV = {
    "dispatching_base_num": "CAST(user_id AS {string})",
    "affiliated_base_number": "event_type",
    "pickup_datetime": "ts",
    "dropOff_datetime": "ts + {hours}(CAST(user_id % 5 AS INT))",
    "PUlocationID": "CAST(user_id % 25 AS DOUBLE)",
    "DOlocationID": "event_id % 25",
    "SR_Flag": "value",
}
NATION_ZONES = {
    "locationid": "CAST(n_nationkey AS BIGINT)",
    "borough": UNKNOWN,
    "zone": "n_name",
    "service_zone": "replace(n_name, 'NATION', 'Boro')",
}
# One zone per supplier: a dimension that grows with the data.
SUPPLIER_ZONES = {
    "locationid": "s_suppkey",
    "borough": UNKNOWN,
    "zone": "s_name",
    "service_zone": "replace(s_name, 'Supplier', 'Boro')",
}

SPARK_WORDS = {"string": "STRING", "hours": "make_dt_interval(0, "}
SQL_WORDS = {"string": "VARCHAR", "hours": "to_hours("}


def _select_list(columns: dict[str, str], words: dict[str, str]) -> list[str]:
    filled = {
        name: text.replace("{hours}(", words["hours"]).replace("{string}", words["string"])
        for name, text in columns.items()
    }
    return [f"{text} AS {name}" for name, text in filled.items()]


def select_sql(columns: dict[str, str]) -> str:
    return ", ".join(_select_list(columns, SQL_WORDS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_role(df: DataFrame, columns: dict[str, str], *extra: str) -> DataFrame:
    return df.selectExpr(*_select_list(columns, SPARK_WORDS), *extra)


def green_raw(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return as_role(table(spark, sf_dir, "lineitem"), GREEN, *extra)


def yellow_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_role(table(spark, sf_dir, "orders"), YELLOW)


def fhv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_role(table(spark, sf_dir, "events"), FHV)


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return as_role(nations.join(regions, nations.n_regionkey == regions.r_regionkey), NATION_ZONES)


def supplier_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    suppliers = table(spark, sf_dir, "supplier")
    places = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    return as_role(suppliers.join(places, suppliers.s_nationkey == places.n_nationkey), SUPPLIER_ZONES)
