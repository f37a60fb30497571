"""One query per operator; each reads whole tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.checks import roles
from tripmart.checks.roles import table
from tripmart.functions import (
    code_label,
    coalesce_default,
    normalize_run_id,
    publication_date,
    replace_literal,
    safe_cast,
    surrogate_key,
    to_integer,
    to_numeric,
    to_timestamp,
    url_basename,
)
from tripmart.operators import (
    conform_constants,
    dedup_first,
    extract_links,
    join_roles,
    mark_available,
    month_grid,
    run_grid,
    sample,
    split_available,
    tag_union,
)
from tripmart.plans import (
    build,
    dim_zones,
    fact_fhv,
    fact_taxi,
    pickup_days,
    refresh_days,
    stage_fhv,
    stage_green,
    stage_yellow,
)
from tripmart.plans.staging import YELLOW_CONSTANTS
from tripmart.registry import FHV_FACT_TABLE, PAYMENT_TYPES, PICKUP_DAY, UNKNOWN_BOROUGH, ZONE_TABLE
from tripmart.session import configure, scratch_dir
from tripmart.sources import (
    ingest,
    materialize,
    read_days,
    read_ledger,
    read_raw,
    read_zones,
    register_external,
    scan_parquet,
    write_day_partitioned,
)
from tripmart.sources.commit import raw_path
from tripmart.sources.versions import table_facts

Query = Callable[[SparkSession, str], DataFrame]
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text, which both engines hash alike."""
    columns = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, TIME_TEXT)
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        columns.append(col.alias(field.name))
    return df.select(*columns)


# --- scans, casts, scalar functions -------------------------------------------


def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]
    return scan_parquet(spark, f"{sf_dir}/lineitem*.parquet", columns)


def external_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_external(spark, {"orders_external": f"{sf_dir}/orders*.parquet"})
    return spark.sql("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders_external")


def seed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "zones-csv")
    zones = roles.supplier_zones(spark, sf_dir)
    zones.write.option("header", True).option("quoteAll", True).csv(path)
    return read_zones(spark, path)


def key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", surrogate_key(orders, "o_custkey", "o_orderdate").alias("tripid"))


def key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("vendor", F.nullif("o_custkey", F.lit(899)))
    return orders.select("o_orderkey", surrogate_key(orders, "vendor", "o_orderdate").alias("tripid"))


def code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", code_label(F.col("l_linenumber"), PAYMENT_TYPES).alias("label")
    )


def replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", replace_literal(F.col("c_name"), "Customer", "Green").alias("name")
    )


def integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    halves = table(spark, sf_dir, "lineitem").withColumn("half", F.col("l_quantity") / 2)
    halves = halves.withColumn("minus_half", -F.col("half"))
    return halves.select(
        "l_orderkey",
        "l_linenumber",
        to_integer(halves, "half").alias("half"),
        to_integer(halves, "minus_half").alias("minus_half"),
    )


def numerics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    price, discount = (to_numeric(lines, name) for name in ("l_extendedprice", "l_discount"))
    # Exact sums: the decimals themselves are compared, not their nearest doubles.
    return lines.groupBy("l_returnflag").agg(
        F.sum(price).cast("decimal(38,9)").cast("string").alias("price"),
        F.sum(discount).cast("decimal(38,9)").cast("string").alias("discount"),
        F.count("*").alias("n_rows"),
    )


def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", to_timestamp("ts").alias("at"))


def constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return conform_constants(orders, YELLOW_CONSTANTS)


def base_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", url_basename(F.col("url")).alias("name"))


def run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", normalize_run_id(F.col("url")).alias("run_id"))


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month")
    )


def publication_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = publication_date(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(newest).alias("year"), F.month(newest).alias("month")
    )


def defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, sf_dir, "orders").select("o_orderkey", coalesce_default(status, "F").alias("status"))


# --- filters, joins, windows, set operations -----------------------------------


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    priority = orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return priority.where(F.col("priority").isNotNull())


def zones_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.supplier_zones(spark, sf_dir).where(F.col("borough") != UNKNOWN_BOROUGH)


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_first(
        table(spark, sf_dir, "lineitem"),
        ["l_shipdate", "l_suppkey"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"],
    )


def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_union({"Green": feed_a(spark, sf_dir), "Yellow": feed_b(spark, sf_dir)}, "service_type")


def role_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the zone of their customer and of their supplier."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    trips = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customers, F.col("o_custkey") == customers.c_custkey)
        .join(suppliers, F.col("l_suppkey") == suppliers.s_suppkey)
        .select("l_orderkey", "l_linenumber", "l_extendedprice", "c_nationkey", "s_nationkey")
    )
    zones = roles.nation_zones(spark, sf_dir).where(F.col("borough") != UNKNOWN_BOROUGH)
    known = {"pickup": "c_nationkey", "dropoff": "s_nationkey"}
    return join_roles(trips, zones, "locationid", known, ["borough", "zone"])


def limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a sample keeps is open; its size, and that keys stay unique, is not."""
    rows = sample(feed_a(spark, sf_dir), 10)
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("tripid").alias("n_trips"),
        F.count("vendorid").alias("n_vendors"),
    )


# --- models --------------------------------------------------------------------


def feed_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_green(roles.green_raw(spark, sf_dir))


def feed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_yellow(roles.yellow_raw(spark, sf_dir))


def feed_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_fhv(roles.fhv_raw(spark, sf_dir))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zones(roles.supplier_zones(spark, sf_dir))


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_taxi(
        feed_a(spark, sf_dir), feed_b(spark, sf_dir), dim_zones(roles.nation_zones(spark, sf_dir))
    )


def fact_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_fhv(feed_c(spark, sf_dir), dim_zones(roles.nation_zones(spark, sf_dir)))


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "days")
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "pickup_datetime")
    write_day_partitioned(events, path)
    return spark.read.parquet(path).withColumn("pickup_date", F.col("pickup_date").cast("string"))


def table_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table as a day-partitioned table, clustered while rows are narrow."""
    trips = stage_fhv(roles.fhv_raw(spark, sf_dir), day=PICKUP_DAY)
    rows = fact_fhv(trips, dim_zones(roles.nation_zones(spark, sf_dir)))
    location, name = scratch_dir(spark, "tables"), f"fact_trips_refreshed_{uuid.uuid4().hex}"
    for part in (rows.limit(10), rows):  # the second refresh replaces the first
        materialize(part, name, PICKUP_DAY, location=location)
    place = table_facts(spark, name)["location"]
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay
    return spark.read.parquet(place).withColumn(PICKUP_DAY, F.col(PICKUP_DAY).cast("string"))


def day_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table built from two months, one of which is then published again beside a third: only their days are rebuilt."""
    root = scratch_dir(spark, "warehouse")
    trips, zones_csv = roles.fhv_raw(spark, sf_dir), f"{root}/zones"
    roles.nation_zones(spark, sf_dir).write.option("header", True).csv(zones_csv)
    step = F.pmod(F.datediff("pickup_datetime", F.lit("2024-01-01")), F.lit(3))
    _write_source(trips.where(step == 0), f"{root}/in", "fhv", 1)
    _write_source(trips.where((step == 1) & (F.hour("pickup_datetime") < 12)), f"{root}/in", "fhv", 2)
    land = {"strict": False, "on_error": "raise", "only_new": True}
    ingest(spark, f"{root}/in", f"{root}/lake", ["fhv"], [2023], **land)
    raw = {"fhv": raw_path(f"{root}/lake", "fhv")}
    build(spark, raw, zones_csv, [FHV_FACT_TABLE], location=f"{root}/tables")
    _write_source(trips.where(step == 1), f"{root}/in", "fhv", 2, "overwrite")
    _write_source(trips.where(step == 2), f"{root}/in", "fhv", 3)
    report = ingest(spark, f"{root}/in", f"{root}/lake", ["fhv"], [2023], **land).where("status = 'landed'")
    months = [(r["vehicle_type"], r["year"], r["month"]) for r in report.collect()]
    refresh_days(spark, raw, FHV_FACT_TABLE, pickup_days(spark, raw, months))
    place = table_facts(spark, FHV_FACT_TABLE)["location"]
    for name in (FHV_FACT_TABLE, ZONE_TABLE):
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(place).withColumn(PICKUP_DAY, F.col(PICKUP_DAY).cast("string"))


def sample_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial build: a tenth of the trip keys, whole, chosen below the deduplication by the model's own argument."""
    return stage_green(roles.green_raw(spark, sf_dir), sample_share=0.1)


def day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "days")
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "pickup_datetime")
    write_day_partitioned(events, path)
    wanted = read_days(spark.read.parquet(path), datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18, 30))
    return wanted.select("event_id", "pickup_datetime", "event_type")


# --- manifest and ingest ---------------------------------------------------------


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_links(table(spark, sf_dir, "pages"), "html", prefix='href="', suffix='"')
    return found.select(replace_literal(replace_literal(F.col("url"), 'href="', ""), '"', "").alias("url"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each order status as a feed: its years, up to its newest order."""
    per_year = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("vehicle_type"), F.year("o_orderdate").alias("year"))
        .agg(F.max("o_orderdate").alias("newest"))
    )
    runs = per_year.withColumn("as_of", F.max("newest").over(Window.partitionBy("vehicle_type")))
    return month_grid(runs, F.col("as_of"))


def _membership(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    wanted = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey", "l_suppkey"
    )
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return split_available(wanted, orders.select(F.col("o_orderkey").alias("orderkey")), "orderkey")


def manifest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _membership(spark, sf_dir)[0]


def manifest_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _membership(spark, sf_dir)[1]


def manifest_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of the membership split by one join."""
    wanted = table(spark, sf_dir, "lineitem").select(F.nullif("l_orderkey", F.lit(7)).alias("orderkey"), "l_linenumber", "l_partkey")
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return mark_available(wanted, orders.select(F.col("o_orderkey").alias("orderkey")), "orderkey")


def manifest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files asked for by statuses as feeds and years: whole years, one month of each year, and the newest month."""
    orders = table(spark, sf_dir, "orders")
    feeds = sorted(r[0] for r in orders.select("o_orderstatus").distinct().collect())
    years = sorted(r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect())
    as_of = F.lit(orders.agg(F.max("o_orderdate")).first()[0])
    asked = {
        "years": month_grid(run_grid(spark, feeds, years), as_of),
        "month": month_grid(run_grid(spark, feeds, years), as_of, month=3),
        "newest": month_grid(run_grid(spark, feeds), as_of),
    }
    placed = orders.groupBy(
        F.col("o_orderstatus").alias("vehicle_type"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.count("*").alias("n_orders"))
    return tag_union(asked, "asked").join(placed, ["vehicle_type", "year", "month"], "left")


def safe_cast_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.col("l_quantity") / 2
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(safe_cast(half, T.DoubleType(), T.LongType()).bad).alias("n_bad"),
        )
    )


def _write_source(df: DataFrame, root: str, feed: str, month: int, mode: str = "error") -> None:
    df.write.mode(mode).parquet(f"{root}/{feed}_tripdata_2023-{month:02d}.parquet")


def ingest_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months whose types differ land with one schema."""
    source, dest = scratch_dir(spark, "source"), scratch_dir(spark, "dest")
    trips = roles.green_raw(spark, sf_dir, "l_linestatus")
    months = {1: trips.where("l_linestatus = 'F'"), 2: trips.where("l_linestatus <> 'F'")}
    months[2] = months[2].withColumns(
        {
            "VendorID": F.col("VendorID").cast("bigint"),
            "RatecodeID": F.col("RatecodeID").cast("double"),
            "PULocationID": F.col("PULocationID").cast("double"),
            "passenger_count": F.col("passenger_count").cast("double"),
            "payment_type": F.col("payment_type").cast("int"),
        }
    )
    for month, df in months.items():
        _write_source(df.drop("l_linestatus"), source, "green", month)
    ingest(spark, source, dest, ["green"], [2023], strict=False, on_error="raise")
    return spark.read.parquet(raw_path(dest, "green"))


def ingest_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months keep their own types; the reader brings them together."""
    source, dest = scratch_dir(spark, "source"), scratch_dir(spark, "dest")
    events = table(spark, sf_dir, "events")
    _write_source(events.where("event_type = 'error'"), source, "fhv", 1)
    others = events.where("event_type <> 'error'")
    _write_source(others.withColumn("user_id", F.col("user_id").cast("double")), source, "fhv", 2)
    ingest(spark, source, dest, ["fhv"], [2023], strict=False, on_error="raise")

    def same_types(df: DataFrame) -> DataFrame:
        return df.select("event_id", "ts", to_integer(df, "user_id").alias("user_id"), "event_type", "value", "props")

    return read_raw(spark, raw_path(dest, "fhv"), same_types)


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean month, one with values a cast would lose, one with a wrong name, one that is missing."""
    source, dest = scratch_dir(spark, "source"), scratch_dir(spark, "dest")
    trips = roles.green_raw(spark, sf_dir)
    flag = F.col("store_and_fwd_flag")
    _write_source(trips.where(flag == "A"), source, "green", 1)
    halves = trips.withColumn("passenger_count", F.col("trip_distance") / 2)
    _write_source(halves.where(flag == "N"), source, "green", 2)
    _write_source(trips.withColumnRenamed("extra", "Extra").where(flag == "R"), source, "green", 3)
    report = ingest(spark, source, dest, ["green"], [2023], strict=False, as_of=date(2023, 6, 15))
    return report.select("file_name", "status", "n_rows", "n_bad")


def ingest_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger and the report of a second run say: one month as before, one published again, one new."""
    source, dest = scratch_dir(spark, "source"), scratch_dir(spark, "dest")
    trips = roles.green_raw(spark, sf_dir)
    flag = F.col("store_and_fwd_flag")
    _write_source(trips.where(flag == "A"), source, "green", 1)
    _write_source(trips.where((flag == "N") & (F.col("payment_type") > 2)), source, "green", 2)
    land = {"strict": False, "on_error": "raise", "as_of": date(2024, 6, 15), "only_new": True}
    ingest(spark, source, dest, ["green"], [2023], **land)
    _write_source(trips.where(flag == "N"), source, "green", 2, "overwrite")
    _write_source(trips.where(flag == "R"), source, "green", 3)
    second = ingest(spark, source, dest, ["green"], [2023], **land).where("status <> 'missing'")
    stored = read_ledger(spark, dest).select("file_name", F.col("status").alias("ledger_status"), F.col("n_rows").alias("ledger_rows"))
    landed = spark.read.parquet(raw_path(dest, "green")).groupBy("month").agg(F.count("*").alias("landed_rows"))
    return second.select("file_name", "month", "status", "n_rows").join(stored, "file_name").join(landed, "month")


def ingest_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a feed with a schema, landed as they are; the reader brings their types together."""
    source, dest = scratch_dir(spark, "source"), scratch_dir(spark, "dest")
    trips = roles.green_raw(spark, sf_dir, "l_linestatus").select("VendorID", "passenger_count", "fare_amount", "l_linestatus")
    for month, status, kind in ((1, "F", "double"), (2, "O", "bigint")):
        part = trips.where(F.col("l_linestatus") == status).withColumn("passenger_count", F.col("passenger_count").cast(kind))
        _write_source(part.drop("l_linestatus"), source, "green", month)
    ingest(spark, source, dest, ["green"], [2023], strict=False, on_error="raise", enforce=False)

    def same_types(df: DataFrame) -> DataFrame:
        return df.select("VendorID", to_integer(df, "passenger_count").alias("passenger_count"), "fare_amount", "month")

    return read_raw(spark, raw_path(dest, "green"), same_types)


QUERIES: dict[str, Query] = {
    "scan_parquet": scan,
    "register_external": external_view,
    "seed_csv": seed_csv,
    "surrogate_key": key,
    "surrogate_key_nulls": key_nulls,
    "case_code_label": code_labels,
    "replace_literal": replaced,
    "cast_integer": integers,
    "cast_numeric": numerics,
    "cast_timestamp": timestamps,
    "conform_constants": constants,
    "filter_not_null": not_null,
    "dim_filter_neq": zones_known,
    "dedup_row_number": dedup,
    "tag_union_all": union,
    "role_playing_join": role_join,
    "stg_feed_a": feed_a,
    "stg_feed_b": feed_b,
    "stg_feed_c": feed_c,
    "dim_zones": zones,
    "fact_trips": fact_trips,
    "fact_passthrough": fact_passthrough,
    "write_day_partitioned": days,
    "materialize_table": table_refresh,
    "sample_limit": limited,
    "extract_links": links,
    "url_basename": base_names,
    "normalize_run_id": run_ids,
    "date_parts": date_parts,
    "publication_month": publication_month,
    "coalesce_default": defaults,
    "manifest": manifest,
    "manifest_valid": manifest_valid,
    "manifest_invalid": manifest_invalid,
    "safe_cast_check": safe_cast_check,
    "ingest_enforced": ingest_enforced,
    "ingest_passthrough": ingest_passthrough,
    "ingest_report": ingest_report,
    "ingest_rerun": ingest_rerun,
    "ingest_local": ingest_local,
    "refresh_days": day_refresh,
    "sample_build": sample_share,
    "read_days": day_range,
    "manifest_marked": manifest_marked,
    "manifest_grid": manifest_grid,
}


def comparable(query: Query) -> Query:
    return lambda spark, sf_dir: plain(query(configure(spark), sf_dir))


def queries() -> dict[str, Query]:
    return {name: comparable(query) for name, query in QUERIES.items()}
