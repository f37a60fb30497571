import datetime as dt
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripmart.checks import roles
from tripmart.plans import build, dim_zones, fact_fhv, fact_taxi, stage_fhv, stage_green, stage_yellow
from tripmart.registry import FEEDS
from tripmart.session import sizing
from tripmart.sources import (
    materialize,
    read_days,
    read_zones,
    register_external,
    write_day_partitioned,
)

SF_DIR = "/root/testdata/sf0.001"
STAGED = [
    ("tripid", "string"), ("vendorid", "bigint"), ("ratecodeid", "bigint"), ("pickup_locationid", "bigint"),
    ("dropoff_locationid", "bigint"), ("pickup_datetime", "timestamp"), ("dropoff_datetime", "timestamp"),
    ("store_and_fwd_flag", "string"), ("passenger_count", "bigint"), ("trip_distance", "decimal(38,9)"),
    ("trip_type", "bigint"), ("fare_amount", "decimal(38,9)"), ("extra", "decimal(38,9)"), ("mta_tax", "decimal(38,9)"),
    ("tip_amount", "decimal(38,9)"), ("tolls_amount", "decimal(38,9)"), ("ehail_fee", "decimal(38,9)"),
    ("improvement_surcharge", "decimal(38,9)"), ("total_amount", "decimal(38,9)"), ("payment_type", "bigint"),
    ("payment_type_description", "string"), ("congestion_surcharge", "decimal(38,9)"),
]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_schemas(spark):
    assert stage_green(roles.green_raw(spark, SF_DIR)).dtypes == STAGED
    assert stage_yellow(roles.yellow_raw(spark, SF_DIR)).dtypes == STAGED
    fhv = stage_fhv(roles.fhv_raw(spark, SF_DIR))
    assert fhv.dtypes == [
        ("tripid", "string"), ("affiliated_base_number", "string"), ("dispatching_base_num", "string"),
        ("dropoff_locationid", "bigint"), ("pickup_locationid", "bigint"),
        ("dropoff_datetime", "timestamp"), ("pickup_datetime", "timestamp"), ("sr_flag", "bigint"),
    ]


def test_roles_have_the_raw_schemas(spark):
    for raw, feed in ((roles.green_raw(spark, SF_DIR), "green"), (roles.yellow_raw(spark, SF_DIR), "yellow")):
        assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in FEEDS[feed].schema]


def test_staging_invariants(spark):
    raw = roles.green_raw(spark, SF_DIR)
    raw = raw.withColumn("VendorID", F.when(F.col("VendorID") != "3", F.col("VendorID")))
    keys = raw.where("VendorID is not null").select("VendorID", "lpep_pickup_datetime").distinct().count()
    staged = stage_green(raw)
    assert staged.count() == keys == staged.select("tripid").distinct().count()
    assert staged.where("vendorid is null").count() == 0
    assert stage_green(raw, sample_limit=10).count() == 10
    yellow = stage_yellow(roles.yellow_raw(spark, SF_DIR))
    zones = dim_zones(roles.nation_zones(spark, SF_DIR))
    fact = fact_taxi(staged, yellow, zones)
    assert len(fact.columns) == 27
    known = [row[0] for row in zones.where("borough <> 'Unknown'").select("locationid").collect()]
    union = staged.unionByName(yellow)
    both_known = F.col("pickup_locationid").isin(known) & F.col("dropoff_locationid").isin(known)
    assert fact.count() == union.where(both_known).count()


def test_staging_reads_only_what_it_stages(spark):
    raw = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    plan = final_plan(stage_yellow(roles.as_role(raw, roles.YELLOW)).select("tripid"))
    assert plan.count("WindowGroupLimit") >= 2
    assert "airport_fee" not in plan
    assert "IsNotNull(o_custkey)" in plan


def test_fact_joins_without_moving_trips(spark):
    zones = dim_zones(roles.nation_zones(spark, SF_DIR))
    fact = fact_fhv(stage_fhv(roles.fhv_raw(spark, SF_DIR)), zones)
    plan = final_plan(fact)
    assert "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_zone_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"locationid","borough","zone","service_zone"\n1,"EWR","Newark, ""N""","EWR"\n4,"Bronx",,"Boro Zone"\n')
    zones = read_zones(spark, str(path))
    assert zones.dtypes[0] == ("locationid", "bigint")
    assert [tuple(row) for row in dim_zones(zones).collect()] == [
        (1, "EWR", 'Newark, "N"', "EWR"), (4, "Bronx", None, "Green Zone")
    ]


def test_days_prune(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumnRenamed("ts", "pickup_datetime")
    write_day_partitioned(events, str(tmp_path / "days"))
    table = spark.read.parquet(str(tmp_path / "days"))
    start, end = dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 11)
    got = read_days(table, start, end)
    assert "PartitionFilters: [isnotnull(pickup_date" in final_plan(got)
    times = [row[0] for row in events.select("pickup_datetime").collect()]
    assert got.count() == sum(start <= t < end for t in times)
    assert table.count() == len(times)


@contextmanager
def small_partitions(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256KB")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    with small_partitions(spark):
        day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).cast("int")
        trips = spark.range(0, 400_000, 1, 16).select(
            "id", F.col("id").cast("string").alias("s"), F.timestamp_seconds(day * 86400).alias("pickup_datetime")
        )
        write_day_partitioned(trips, str(tmp_path / "days"))
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "days").glob("pickup_date=*")}
    assert len(files) == 20
    assert files["pickup_date=1970-01-01"] > 2
    assert spark.read.parquet(str(tmp_path / "days")).count() == 400_000


def test_facts_cluster_by_day_while_narrow(spark, tmp_path):
    """One exchange, below the joins; a hot day is still split, and no row is lost."""
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).cast("int")
    raw = spark.range(0, 200_000, 1, 16).select(
        F.col("id").cast("string").alias("dispatching_base_num"),
        F.lit("b").alias("affiliated_base_number"),
        F.timestamp_seconds(day * 86400).alias("pickup_datetime"),
        F.timestamp_seconds(day * 86400).alias("dropoff_datetime"),
        (F.col("id") % 25).alias("pulocationid"),
        (F.col("id") % 24).alias("dolocationid"),
        F.lit(1).alias("sr_flag"),
    )
    zones = dim_zones(roles.nation_zones(spark, SF_DIR))
    with small_partitions(spark):
        fact = fact_fhv(stage_fhv(raw, day="pickup_date"), zones)
        plan = final_plan(fact).split("== Initial Plan ==")[0]
        fact.write.partitionBy("pickup_date").parquet(str(tmp_path / "fact"))
    assert plan.count("Exchange hashpartitioning(pickup_date") == plan.count("Exchange hashpartitioning") == 1
    assert plan.index("BroadcastHashJoin") < plan.index("Exchange hashpartitioning(pickup_date")
    assert len(list((tmp_path / "fact" / "pickup_date=1970-01-01").glob("*.parquet"))) > 2
    late = fact_fhv(stage_fhv(raw), zones)
    assert spark.read.parquet(str(tmp_path / "fact")).count() == late.count()
    assert fact.drop("pickup_date").exceptAll(late).isEmpty()


def test_materialize_and_register(spark, tmp_path):
    zones = dim_zones(roles.nation_zones(spark, SF_DIR))
    for _ in range(2):
        assert materialize(zones, "zones_table").count() == 25
    register_external(spark, {"events_raw": f"{SF_DIR}/events*.parquet"})
    assert spark.sql("SELECT count(*) FROM events_raw").first()[0] == 1000
    spark.sql("DROP TABLE zones_table")


@pytest.mark.parametrize("limit", [None, 10])
def test_build_whole_warehouse(spark, tmp_path, limit):
    raw = {
        "green": roles.green_raw(spark, SF_DIR).where("lpep_pickup_datetime < '1995-03-01'"),
        "yellow": roles.yellow_raw(spark, SF_DIR).where("tpep_pickup_datetime < '1995-03-01'"),
        "fhv": roles.fhv_raw(spark, SF_DIR),
    }
    for feed, df in raw.items():
        df.write.parquet(str(tmp_path / feed))
    zones = roles.nation_zones(spark, SF_DIR)
    zones.coalesce(1).write.option("header", True).csv(str(tmp_path / "zones"))
    locations = {feed: str(tmp_path / feed) for feed in ("green", "yellow", "fhv")}
    build(spark, locations, str(tmp_path / "zones"), sample_limit=limit, location=str(tmp_path / "tables"))

    taxi, fhv = spark.table("fact_taxi_trips"), spark.table("fact_fhv_trips")
    assert (len(taxi.columns), len(fhv.columns)) == (28, 13)
    assert taxi.columns[-1] == fhv.columns[-1] == "pickup_date"
    staged = {feed: spark.table(f"stg_{feed}_trips").count() for feed in locations}
    if limit:
        assert set(staged.values()) == {10}
        assert taxi.count() <= 20
        assert fhv.count() <= 10
    else:
        want = fact_taxi(stage_green(raw["green"]), stage_yellow(raw["yellow"]), dim_zones(zones))
        assert taxi.where("pickup_date <> to_date(pickup_datetime)").count() == 0
        assert taxi.drop("pickup_date").exceptAll(want).count() == want.exceptAll(taxi.drop("pickup_date")).count() == 0
        assert taxi.count() == want.count() > 0
        assert spark.table("dim_zones").count() == 25
    assert list(Path(tmp_path / "tables").glob("fact_taxi_trips/version-*/pickup_date=*"))
    for table in ("fact_taxi_trips", "fact_fhv_trips", "dim_zones"):
        spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize(
    ("size", "partitions", "split"),
    [(1, 16, 128 * 1024**2), (1024**4, 5462, 128 * 1024**2), (100 * 1024**4, 50_000, 1024**3)],
)
def test_sizing_follows_the_data(size, partitions, split):
    settings = sizing(size, cores=16)
    assert settings["spark.sql.shuffle.partitions"] == str(partitions)
    assert settings["spark.sql.files.maxPartitionBytes"] == str(split)
