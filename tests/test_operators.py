import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.operators import (
    conform_constants,
    dedup_first,
    extract_links,
    fits_broadcast,
    join_roles,
    month_grid,
    run_grid,
    sample,
    split_available,
    tag_union,
)
from tripmart.plans.marts import with_zones


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_first_per_key(spark):
    rows = [("1", 10, 2.0), ("1", 10, 1.0), ("1", 11, 5.0), (None, 10, 0.0), (None, 10, 3.0)]
    df = spark.createDataFrame(rows, "v string, t int, fare double")
    kept = dedup_first(df, ["t", "v"], ["fare"])
    assert sorted(map(tuple, kept.collect()), key=str) == [("1", 10, 1.0), ("1", 11, 5.0), (None, 10, 0.0)]
    assert kept.columns == df.columns


def test_dedup_needs_an_order(spark):
    with pytest.raises(ValueError, match="order_by"):
        dedup_first(spark.range(1), ["id"], [])


def test_dedup_of_a_hot_key_thins_before_the_shuffle(spark):
    hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000)
    df = spark.range(60_000).repartition(8).select(hot.alias("k"), (F.col("id") * 7919 % 60_013).alias("o"))
    kept = dedup_first(df, ["k"], ["o"])
    assert final_plan(kept).count("WindowGroupLimit") >= 2
    want = {row["k"]: row["o"] for row in df.groupBy("k").agg(F.min("o").alias("o")).collect()}
    assert {row["k"]: row["o"] for row in kept.collect()} == want


def test_union_and_constants(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "s string, id int")
    both = tag_union({"A": a, "B": b}, "tag")
    assert sorted(map(tuple, both.collect())) == [(1, "x", "A"), (2, "y", "B"), (2, "y", "B")]
    filled = conform_constants(a, {"fee": (0, "decimal(38,9)"), "kind": (1, "bigint")})
    assert filled.dtypes[2:] == [("fee", "decimal(38,9)"), ("kind", "bigint")]
    assert sample(b, None).count() == 2
    assert sample(b, 1).count() == 1


ZONES = "locationid bigint, borough string, zone string"


def test_zone_filter_is_three_valued(spark):
    zones = spark.createDataFrame([(1, "Unknown", "a"), (2, None, "b"), (3, "Bronx", "c")], ZONES)
    ids = [1, 2, 3, 4, None]
    pairs = [(p, d) for p in ids for d in ids]
    trips = spark.createDataFrame(pairs, "pickup_locationid bigint, dropoff_locationid bigint")
    rows = [tuple(row) for row in with_zones(trips, zones).collect()]
    assert rows == [(3, 3, "Bronx", "c", "Bronx", "c")]


def test_role_join_broadcasts_one_small_dimension_once(spark):
    zones = spark.range(50).select(F.col("id").alias("locationid"), F.lit("b").alias("borough"), F.lit("z").alias("zone"))
    zones = zones.repartition(2)
    trips = spark.range(1000).select((F.col("id") % 60).alias("p"), (F.col("id") % 55).alias("d"))
    joined = join_roles(trips, zones, "locationid", {"pickup": "p", "dropoff": "d"}, ["borough", "zone"])
    plan = final_plan(joined)
    assert "SortMergeJoin" not in plan
    assert "ReusedExchange" in plan
    assert joined.columns == ["p", "d", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone"]
    assert joined.count() == sum(1 for i in range(1000) if i % 60 < 50 and i % 55 < 50)


def test_role_join_of_a_large_dimension_splits_a_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        zones = spark.range(2000).select(
            F.col("id").alias("locationid"), F.lit("b").alias("borough"), F.col("id").cast("string").alias("zone")
        )
        trips = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2500).alias("p"), F.col("id").alias("n")
        )
        joined = join_roles(trips, zones, "locationid", {"pickup": "p"}, ["zone"], broadcast_max_rows=100)
        assert "skew=true" in final_plan(joined)
        assert joined.count() == trips.where("p < 2000").count()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_fits_broadcast_measures(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=50_000)
    assert fits_broadcast(df.where("s = ''"))


def test_links_on_one_line_stay_apart(spark):
    base = "https://files.example.org/trip-data"
    html = (
        f'<a href="{base}/green_tripdata_2023-01.parquet">a</a> <a href="{base}/green_tripdata_2023-02.parquet">b</a>\n'
        f"<a href='{base}/green_tripdata_2023-01.parquet'>again</a> <a href=\"{base}/readme.pdf\">c</a> other.parquet"
    )
    pages = spark.createDataFrame([(html,), (html,), (None,)], "html string")
    got = sorted(row[0] for row in extract_links(pages, "html", base).collect())
    assert got == [f"{base}/green_tripdata_2023-0{m}.parquet" for m in (1, 2)]


def test_link_prefix_is_literal(spark):
    pages = spark.createDataFrame([("http://aXb/1.parquet http://a.b/2.parquet http://a.b/3xparquet",)], "html string")
    assert [row[0] for row in extract_links(pages, "html", "http://a.b").collect()] == ["http://a.b/2.parquet"]


@pytest.mark.parametrize(
    ("years", "today", "month", "want"),
    [
        (None, "2023-01-10", None, [(2022, 11)]),
        (None, "2023-04-10", None, [(2023, 2)]),
        ([2022], "2023-01-10", None, [(2022, m) for m in range(1, 13)]),
        ([2023], "2023-01-10", None, []),
        ([2023], "2023-05-10", None, [(2023, m) for m in (1, 2, 3)]),
        ([2024], "2023-05-10", None, []),
        ([2021, 2022], "2023-05-10", 7, [(2021, 7), (2022, 7)]),
    ],
)
def test_month_grid(spark, years, today, month, want):
    grid = month_grid(run_grid(spark, ["green", "fhv"], years), F.to_date(F.lit(today)), month)
    got = sorted((r["vehicle_type"], r["year"], r["month"]) for r in grid.collect())
    assert got == sorted((v, y, m) for v in ("green", "fhv") for y, m in want)
    assert all(
        r["file_name"] == f"{r['vehicle_type']}_tripdata_{r['year']}-{r['month']:02d}.parquet" for r in grid.collect()
    )


def test_split_available_covers_all(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "u string")
    available = spark.createDataFrame([("b",), ("b",), ("c",), (None,)], "u string")
    valid, invalid = split_available(wanted, available, "u")
    assert [r[0] for r in valid.collect()] == ["b", "b"]
    assert sorted(str(r[0]) for r in invalid.collect()) == ["None", "a"]


def test_dates_are_plain(spark):
    grid = month_grid(run_grid(spark, ["green"], [2022]), F.lit(dt.date(2023, 1, 1)))
    assert grid.count() == 12


def test_read_days_takes_bounds_with_a_zone(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    from tripmart.sources import read_days, write_day_partitioned

    hours = spark.range(72).selectExpr("timestamp '2023-05-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS pickup_datetime")
    write_day_partitioned(hours, str(tmp_path / "days"))
    table = spark.read.parquet(str(tmp_path / "days"))
    east = timezone(timedelta(hours=9))
    assert read_days(table, datetime(2023, 5, 2, tzinfo=east), datetime(2023, 5, 3, tzinfo=east)).count() == 24
    assert read_days(table, datetime(2023, 5, 2), datetime(2023, 5, 3)).count() == 24
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            read_days(table, datetime(2023, 5, 2), datetime(2023, 5, 3))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_zone_ids_must_be_integers(spark, tmp_path):
    from tripmart.sources import read_zones

    path = tmp_path / "zones.csv"
    path.write_text("locationid,borough,zone,service_zone\n1.5,a,b,c\n2,a,b,c\n")
    with pytest.raises(Exception, match="isn't an integer"):
        read_zones(spark, str(path)).collect()
