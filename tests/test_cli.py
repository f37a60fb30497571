"""The whole way from published files to fact tables, through the command line."""

import pytest

from tripmart.__main__ import main, parser
from tripmart.checks import roles

SF_DIR = "/root/testdata/sf0.001"


def test_land_and_build(spark, tmp_path):
    source, dest, tables = (str(tmp_path / name) for name in ("source", "dest", "tables"))
    raw = {
        "green": roles.green_raw(spark, SF_DIR).where("lpep_pickup_datetime < '1995-02-01'"),
        "yellow": roles.yellow_raw(spark, SF_DIR).where("tpep_pickup_datetime < '1995-02-01'"),
        "fhv": roles.fhv_raw(spark, SF_DIR),
    }
    for feed, df in raw.items():
        df.write.parquet(f"{source}/{feed}_tripdata_2022-01.parquet")
    zones = str(tmp_path / "zones")
    roles.nation_zones(spark, SF_DIR).write.option("header", True).csv(zones)

    main(["ingest", "--source", source, "--dest", dest, "--vehicle-type", "green", "yellow", "fhv", "--year", "2022"])
    for feed, df in raw.items():
        assert spark.read.parquet(f"{dest}/raw/vehicle_type={feed}/year=2022/month=1").count() == df.count()

    main(["build", "--landed", dest, "--zones", zones, "--location", tables])
    assert spark.table("fact_taxi_trips").count() > 0
    assert spark.table("fact_fhv_trips").count() > 0
    for table in ("fact_taxi_trips", "fact_fhv_trips", "dim_zones"):
        spark.sql(f"DROP TABLE {table}")

    with pytest.raises(FileNotFoundError):
        main(["ingest", "--source", source, "--dest", dest, "--year", "2022", "--raise-if-any-not-found"])


def test_only_published_files_are_wanted(spark, tmp_path):
    base = "https://files.example.org/trip-data"
    page = tmp_path / "page.html"
    page.write_text(f'<a href="{base}/fhv_tripdata_2022-02.parquet">February</a>\n<p>no other</p>')
    for month in (1, 2):
        spark.range(month).write.parquet(f"{tmp_path}/in/fhv_tripdata_2022-{month:02d}.parquet")
    run = ["ingest", "--source", f"{tmp_path}/in", "--dest", f"{tmp_path}/out", "--vehicle-type", "fhv", "--year", "2022"]
    main([*run, "--pages", str(page), "--base-url", base])
    rows = spark.read.parquet(f"{tmp_path}/out/raw/vehicle_type=fhv").collect()
    assert [(row["year"], row["month"]) for row in rows] == [(2022, 2)] * 2
    with pytest.raises(SystemExit):
        main([*run, "--pages", str(page)])


def test_unknown_vehicle_type_is_refused():
    with pytest.raises(SystemExit):
        parser().parse_args(["ingest", "--source", "s", "--dest", "d", "--vehicle-type", "boat"])
