"""Refreshes and landings that are interrupted, sizing, samples, and rebuilt days."""

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from test_landing import AS_OF, FEEDS, landed, long_months, months, put, run
from tripmart import session
from tripmart.checks import roles
from tripmart.operators import mark_available, sample_groups
from tripmart.plans import build, pickup_days, refresh_days, stage_green
from tripmart.plans import warehouse
from tripmart.sources import ingest, input_bytes, materialize, read_by_columns, read_ledger, recover
from tripmart.sources import landing
from tripmart.sources.commit import Run, raw_path
from tripmart.sources.files import Store
from tripmart.sources.versions import table_facts

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def name(spark):
    yield "refreshed"
    spark.sql("DROP TABLE IF EXISTS refreshed")


def versions(root):
    return sorted(p.name for p in Path(root).glob("version-*"))


@pytest.mark.parametrize("day", [None, "day"])
def test_a_failing_refresh_leaves_the_old_table(spark, tmp_path, name, day):
    rows = spark.range(100).withColumn("day", F.lit(dt.date(2024, 1, 1)))
    materialize(rows, name, day, str(tmp_path))
    old = table_facts(spark, name)["location"]
    fails_last = spark.range(0, 1000, 1, 8).withColumn("day", F.when(F.col("id") == 999, F.raise_error(F.lit("stop"))).otherwise(F.lit(dt.date(2024, 1, 2))))
    with pytest.raises(Exception, match="stop"):
        materialize(fails_last, name, day, str(tmp_path))
    assert table_facts(spark, name)["location"] == old
    assert spark.table(name).agg(F.sum("id"), F.max("day")).first()[:] == (4950, dt.date(2024, 1, 1))
    assert len(versions(tmp_path / name)) == 1


def test_refresh_from_the_table_itself(spark, tmp_path, name):
    materialize(spark.range(10).withColumn("day", F.lit(dt.date(2024, 1, 1))), name, "day", str(tmp_path))
    begun = spark.table(name)
    for n in (20, 40):
        materialize(spark.table(name).union(spark.table(name)), name, "day", str(tmp_path))
        assert spark.table(name).count() == n
        if n == 20:
            assert begun.count() == 10  # a reader of the version before goes on
    assert len(versions(tmp_path / name)) == 2
    plan = spark.table(name).where("day = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_refresh_with_other_columns_or_over_other_tables(spark, tmp_path, name):
    spark.range(3).write.saveAsTable(name)
    assert materialize(spark.range(5), name, None, str(tmp_path)).count() == 5
    assert materialize(spark.range(4).withColumn("x", F.lit("a")), name, None, str(tmp_path)).columns == ["id", "x"]
    assert materialize(spark.range(4).withColumn("x", F.lit("a")), name, "x", str(tmp_path)).count() == 4


def mixed(root, shift=0):
    put(root, long_months(50, zone=pa.array(range(shift, 50 + shift))), "fhv", 1, "part-0")
    put(root, long_months(50, zone=pa.array([float(i + shift) for i in range(50)])), "fhv", 1, "part-1")


def zones(spark, dest):
    parts = read_by_columns(spark, raw_path(str(dest), "fhv"))
    return sorted(r[0] for p in parts for r in p.select(F.col("zone").cast("long")).collect())


def test_a_job_that_ends_between_two_column_sets_leaves_the_old_month(spark, tmp_path, monkeypatch):
    mixed(tmp_path / "in")
    run(spark, tmp_path / "in", tmp_path / "out", "fhv")
    old = zones(spark, tmp_path / "out")
    mixed(tmp_path / "in", 1000)
    wrote, write = [], landing._write_months

    def dies(df, path):
        if wrote:
            raise KeyboardInterrupt
        wrote.append(path)
        write(df, path)

    monkeypatch.setattr(landing, "_write_months", dies)
    with pytest.raises(KeyboardInterrupt):
        run(spark, tmp_path / "in", tmp_path / "out", "fhv")
    assert len(wrote) == 1 and zones(spark, tmp_path / "out") == old
    monkeypatch.undo()
    assert recover(spark, str(tmp_path / "out")) == ([], [])  # it might still be running
    assert len(recover(spark, str(tmp_path / "out"), abandoned_hours=0)[1]) == 1
    assert zones(spark, tmp_path / "out") == old
    run(spark, tmp_path / "in", tmp_path / "out", "fhv")
    assert zones(spark, tmp_path / "out") == [k + 1000 for k in old]
    assert not list((tmp_path / "out" / "_landing").iterdir())


@pytest.mark.parametrize("moves", range(5))
def test_an_interrupted_swap_is_finished_by_the_next_run(spark, tmp_path, monkeypatch, moves):
    for month in (1, 2):
        put(tmp_path / "in", months(), month=month)
    run(spark, tmp_path / "in", tmp_path / "out")
    for month in (1, 2):
        put(tmp_path / "in", long_months(5), month=month)
    done, move = [], Store.move

    def dies(self, source, target):
        if len(done) == moves:
            raise KeyboardInterrupt
        done.append(source)
        move(self, source, target)

    monkeypatch.setattr(Store, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        run(spark, tmp_path / "in", tmp_path / "out")
    monkeypatch.undo()
    sizes = spark.read.option("recursiveFileLookup", True).parquet(raw_path(str(tmp_path / "out"), "green")).count()
    assert sizes in (2 + 2, 2, 5 + 2, 5, 5 + 5)  # months are old, new, or for a moment not there, never half
    finished, rolled_back = recover(spark, str(tmp_path / "out"))
    assert (len(finished), rolled_back) == (1, [])
    assert len(landed(spark, tmp_path / "out")) == 10
    assert {r.n_rows for r in read_ledger(spark, str(tmp_path / "out")).collect()} == {5}
    assert recover(spark, str(tmp_path / "out")) == ([], [])


def test_a_move_can_be_repeated(spark, tmp_path):
    store = Store(spark)
    for name in ("a/x", "a/y", "b/x"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    store.move(str(tmp_path / "a"), str(tmp_path / "b"))
    assert {p.name: p.read_text() for p in (tmp_path / "b").iterdir() if p.suffix != ".crc"} == {"x": "a/x", "y": "a/y"}
    assert not (tmp_path / "a").exists()
    assert store.children(str(tmp_path / "none")) == []


def test_only_new_files_land_again(spark, tmp_path):
    put(tmp_path / "in", months(), month=1)
    put(tmp_path / "in", months(), month=2, part="part-0")
    put(tmp_path / "in", months(zone=pa.array([1.5, 2.0])), month=3)
    first = run(spark, tmp_path / "in", tmp_path / "out", only_new=True)
    assert {m: r["status"] for m, r in first.items()} == {1: "landed", 2: "landed", 3: "failed"}
    put(tmp_path / "in", months(), month=2, part="part-1")
    put(tmp_path / "in", months(), month=4)
    second = run(spark, tmp_path / "in", tmp_path / "out", only_new=True)
    assert {m: r["status"] for m, r in second.items()} == {1: "unchanged", 2: "landed", 3: "failed", 4: "landed"}
    assert second[1]["n_rows"] == 2
    ledger = {r.month: (r.status, r.n_rows, r.n_parts) for r in read_ledger(spark, str(tmp_path / "out")).collect()}
    assert ledger == {1: ("landed", 2, 1), 2: ("landed", 4, 2), 3: ("failed", 2, 1), 4: ("landed", 2, 1)}
    third = run(spark, tmp_path / "in", tmp_path / "out")
    assert {m: r["status"] for m, r in third.items()} == {1: "landed", 2: "landed", 3: "failed", 4: "landed"}


def test_statistics_decide_what_is_read(spark, tmp_path, monkeypatch):
    """The same report with and without them."""
    odd = {
        1: {},
        2: {"fare": pa.array([2**53, None], pa.int64())},
        3: {"fare": pa.array([2**53 + 1, 1], pa.int64())},
        4: {"pickup": pa.nulls(2, pa.timestamp("us")), "zone": pa.array([None, None], pa.float64())},
        5: {"zone": pa.array([1.5, None], pa.float64())},
    }
    reports, scanned = [], []
    scans = landing._risky_scans
    monkeypatch.setattr(landing, "_risky_scans", lambda *a: scanned[-1].extend(found := scans(*a)) or found)
    for with_statistics in (True, False):
        source = tmp_path / f"in-{with_statistics}"
        source.mkdir()
        for month, columns in odd.items():
            pq.write_table(months(**columns), source / f"green_tripdata_2023-{month:02d}.parquet", write_statistics=with_statistics)
        scanned.append([])
        report = run(spark, source, tmp_path / f"out-{with_statistics}")
        reports.append({m: (r["status"], r["n_rows"], r["n_bad"], r["error"]) for m, r in report.items()})
    assert reports[0] == reports[1]
    assert [reports[0][m][0] for m in range(1, 6)] == ["landed", "landed", "failed", "landed", "failed"]
    read = [{(p[-10:-8], name) for _, names, paths in found for p in paths for name in names} for found in scanned]
    # What remains are times that aren't all null, the large integer and the doubles.
    assert read[0] == {("01", "pickup"), ("02", "pickup"), ("03", "pickup"), ("05", "pickup"), ("03", "fare"), ("05", "zone")}
    assert read[0] < read[1]


def test_kinds_of_scans_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "MAX_SCANS", 1)
    put(tmp_path / "in", months(fare=pa.array([2**53 + 1, 1], pa.int64())), month=1)
    put(tmp_path / "in", months(fare=pa.array([1, 1], pa.int64()), pickup=pa.nulls(2, pa.timestamp("us"))), month=2)
    report = run(spark, tmp_path / "in", tmp_path / "out")
    assert [report[m]["status"] for m in (1, 2)] == ["failed", "landed"]


def write_raw(spark, root):
    roles.fhv_raw(spark, SF_DIR).write.parquet(f"{root}/fhv")
    roles.nation_zones(spark, SF_DIR).coalesce(1).write.option("header", True).csv(f"{root}/zones")


def test_shuffles_follow_the_input(spark, tmp_path, monkeypatch):
    write_raw(spark, tmp_path)
    size = input_bytes(spark, str(tmp_path / "fhv"))
    key = "spark.sql.shuffle.partitions"
    before, seen, write = spark.conf.get(key), {}, warehouse.materialize

    def noted(df, name, **options):
        seen[name] = int(spark.conf.get(key))
        if name == "fact_fhv_trips":
            seen["plan"] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, **options)

    monkeypatch.setattr(warehouse, "materialize", noted)
    for part in (size // 20, size // 100):
        monkeypatch.setattr(session, "SHUFFLE_PARTITION_BYTES", part)
        build(spark, {"fhv": str(tmp_path / "fhv")}, str(tmp_path / "zones"), ["fact_fhv_trips"], location=str(tmp_path / "tables"))
        wanted = -(-size // part)
        assert seen["fact_fhv_trips"] == wanted
        assert f"hashpartitioning(pickup_date" in seen["plan"] and f", {wanted})" in seen["plan"]
        assert spark.conf.get(key) == before
    for table in ("fact_fhv_trips", "dim_zones"):
        spark.sql(f"DROP TABLE {table}")


def test_sized_restores_what_was_unset(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError), session.sized(spark, 1 << 50):
        assert spark.conf.get(key) == "50000"
        raise ValueError
    assert spark.conf.get(key, None) == before


def test_whole_keys_are_sampled_below_the_shuffle(spark):
    raw = roles.green_raw(spark, SF_DIR)
    share, full = stage_green(raw, sample_share=0.2), stage_green(raw)
    assert 0.1 * full.count() < share.count() < 0.3 * full.count()
    assert share.exceptAll(full).isEmpty()
    plan = share._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window ") < plan.index("substring(md5")  # the filter stands further down
    keys = ["VendorID", "lpep_pickup_datetime"]
    kept = sample_groups(raw, keys, 0.2)
    assert kept.join(sample_groups(raw, keys, 0.2).select(*keys).distinct(), keys).count() == kept.count()
    assert raw.join(kept.select(*keys).distinct(), keys).count() == kept.count()
    assert sample_groups(raw, keys, None) is raw
    for bad in (0, 1.5, -1):
        with pytest.raises(ValueError):
            sample_groups(raw, keys, bad)


def test_both_halves_from_one_shuffle(spark):
    wanted = spark.range(1000).select((F.col("id") % 50).alias("k"), "id").union(spark.sql("SELECT CAST(NULL AS BIGINT), 1L"))
    available = spark.range(30).select((F.col("id") % 20).alias("k")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = mark_available(wanted, available, "k")
        assert {(r.available, r.n) for r in marked.groupBy("available").agg(F.count("*").alias("n")).collect()} == {(True, 400), (False, 601)}
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1
        assert plan.count("Exchange hashpartitioning(k") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rebuilt_days_equal_a_full_build(spark, tmp_path):
    roles.nation_zones(spark, SF_DIR).coalesce(1).write.option("header", True).csv(str(tmp_path / "zones"))
    trips = roles.fhv_raw(spark, SF_DIR)
    day = F.datediff("pickup_datetime", F.lit("2024-01-01"))
    no_time = trips.limit(5).withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz"))
    drifted = lambda df: df.withColumn("DOlocationID", F.col("DOlocationID").cast("double"))

    def publish(month, df):
        df.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/in/fhv_tripdata_2023-{month:02d}.parquet")

    def land():
        report = ingest(spark, f"{tmp_path}/in", f"{tmp_path}/lake", ["fhv"], [2023], strict=False, on_error="raise", as_of=AS_OF, only_new=True)
        return [(r["vehicle_type"], r["year"], r["month"]) for r in report.where("status = 'landed'").collect()]

    raw = {"fhv": raw_path(f"{tmp_path}/lake", "fhv")}
    tables = str(tmp_path / "tables")
    publish(1, trips.where(day < 5))
    publish(2, drifted(trips.where((day >= 5) & (day < 9))))
    land()
    build(spark, raw, f"{tmp_path}/zones", ["fact_fhv_trips"], location=tables)
    before = pickup_days(spark, raw, [("fhv", 2023, 2)])
    before = spark.createDataFrame(before.collect(), before.schema)
    kept = {p: p.stat().st_mtime_ns for p in Path(tables).rglob("pickup_date=2024-01-02/*.parquet")}
    publish(2, drifted(trips.where((day >= 5) & (day < 8))))  # the day 8 is gone
    publish(3, trips.where((day >= 7) & (day < 12) & (day != 8)).unionByName(no_time))
    landed_now = land()
    assert landed_now == [("fhv", 2023, 2), ("fhv", 2023, 3)]
    touched = refresh_days(spark, raw, "fact_fhv_trips", pickup_days(spark, raw, landed_now).union(before))
    assert len(touched) == 8 and touched[0] is None
    assert kept == {p: p.stat().st_mtime_ns for p in Path(tables).rglob("pickup_date=2024-01-02/*.parquet")} and kept
    got = [tuple(r) for r in spark.table("fact_fhv_trips").collect()]
    spark.sql("DROP TABLE fact_fhv_trips")
    build(spark, raw, f"{tmp_path}/zones", ["fact_fhv_trips"], location=str(tmp_path / "full"))
    want = [tuple(r) for r in spark.table("fact_fhv_trips").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) > 100
    assert refresh_days(spark, raw, "fact_fhv_trips", before.limit(0)) == []
    for table in ("fact_fhv_trips", "dim_zones"):
        spark.sql(f"DROP TABLE {table}")


def test_build_with_an_opener(spark, tmp_path):
    write_raw(spark, tmp_path)
    used = str(tmp_path / "used")

    def opener(path):
        import pyarrow.fs as pafs

        open(used, "a").close()
        return pafs.LocalFileSystem(), path.removeprefix("file:").replace("//", "/")

    build(spark, {"fhv": str(tmp_path / "fhv")}, str(tmp_path / "zones"), ["fact_fhv_trips"], location=str(tmp_path / "t"), opener=opener)
    assert Path(used).exists() and spark.table("fact_fhv_trips").count() > 0
    for table in ("fact_fhv_trips", "dim_zones"):
        spark.sql(f"DROP TABLE {table}")


def test_runs_name_their_places(spark, tmp_path):
    one = Run(spark, str(tmp_path) + "/")
    assert one.aside("green") != one.aside("green")
    assert not one.committed()
    assert FEEDS["green"].raw_ddl
