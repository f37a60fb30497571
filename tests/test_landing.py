import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tripmart.functions import to_integer
from tripmart.registry import Feed
from tripmart.sources import IngestError, ingest, read_raw
from tripmart.sources.footers import uri_mapper
from tripmart.sources.landing import raw_path

RAW = "VendorID STRING, pickup TIMESTAMP_NTZ, zone BIGINT, fare DOUBLE"
FEEDS = {"green": Feed("green", RAW), "fhv": Feed("fhv")}
AT = dt.datetime(2023, 1, 1, 12, 30)
AS_OF = dt.date(2024, 2, 1)


def months(**columns):
    base = {
        "VendorID": pa.array(["1", None], pa.string()),
        "pickup": pa.array([AT, None], pa.timestamp("us")),
        "zone": pa.array([7, None], pa.int64()),
        "fare": pa.array([2.5, None], pa.float64()),
    }
    return pa.table({**base, **columns})


def put(root, table, feed="green", month=1, part=None):
    path = Path(root) / f"{feed}_tripdata_2023-{month:02d}.parquet"
    if part:
        path.mkdir(parents=True, exist_ok=True)
        path = path / f"{part}.parquet"
    Path(root).mkdir(parents=True, exist_ok=True)
    pq.write_table(table, path)


def run(spark, source, dest, feed="green", strict=False, **options):
    options = {"as_of": AS_OF, "feeds": FEEDS, **options}
    report = ingest(spark, str(source), str(dest), [feed], [2023], strict=strict, **options)
    return {row["month"]: row for row in report.collect() if row["status"] != "missing"}


def landed(spark, dest, feed="green"):
    rows = spark.read.parquet(raw_path(str(dest), feed)).collect()
    return sorted((tuple(row) for row in rows), key=str)


DRIFTS = {
    "integer vendor": {"VendorID": pa.array([1, None], pa.int64())},
    "double vendor": {"VendorID": pa.array([1.0, None], pa.float64())},
    "double zone": {"zone": pa.array([7.0, None], pa.float64())},
    "small zone": {"zone": pa.array([7, None], pa.int32())},
    "text zone": {"zone": pa.array(["7", None], pa.string())},
    "decimal zone": {"zone": pa.array([7, None], pa.decimal128(10, 2))},
    "text fare": {"fare": pa.array(["2.5", None], pa.string())},
    "float fare": {"fare": pa.array([2.5, None], pa.float32())},
    "nanoseconds": {"pickup": pa.array([AT, None], pa.timestamp("ns"))},
    "milliseconds": {"pickup": pa.array([AT, None], pa.timestamp("ms"))},
    "utc": {"pickup": pa.array([AT, None], pa.timestamp("us", "UTC"))},
    "text time": {"pickup": pa.array(["2023-01-01 12:30:00", None], pa.string())},
}


def test_types_that_drift_land_alike(spark, tmp_path):
    put(tmp_path / "in", months(), month=12)
    for month, columns in enumerate(list(DRIFTS.values())[:11], start=1):
        put(tmp_path / "in", months(**columns), month=month)
    report = run(spark, tmp_path / "in", tmp_path / "out")
    assert {m: (r["status"], r["n_rows"], r["n_bad"], r["error"]) for m, r in report.items()} == {
        m: ("landed", 2, 0, None) for m in range(1, 13)
    }
    rows = landed(spark, tmp_path / "out")
    assert rows == sorted(
        [("1", AT, 7, 2.5, 2023, m) for m in range(1, 13)] + [(None,) * 4 + (2023, m) for m in range(1, 13)], key=str
    )


def test_text_times_land(spark, tmp_path):
    put(tmp_path / "in", months(**DRIFTS["text time"]))
    assert run(spark, tmp_path / "in", tmp_path / "out")[1]["status"] == "landed"
    assert landed(spark, tmp_path / "out")[0] == ("1", AT, 7, 2.5, 2023, 1)


def test_null_column_lands(spark, tmp_path):
    put(tmp_path / "in", months(fare=pa.nulls(2), pickup=pa.nulls(2), zone=pa.nulls(2)))
    assert run(spark, tmp_path / "in", tmp_path / "out")[1]["error"] is None
    assert landed(spark, tmp_path / "out") == [("1", None, None, None, 2023, 1), (None,) * 4 + (2023, 1)]


BAD = {
    "fraction": (months(zone=pa.array([1.5, 2.0])), "zone (1)"),
    "nan": (months(zone=pa.array([float("nan"), 2.0])), "zone (1)"),
    "milliseconds": (months(pickup=pa.array([AT.replace(microsecond=5000), AT], pa.timestamp("ms"))), "pickup (1)"),
    "nanoseconds": (months(pickup=pa.array([1, 2], pa.timestamp("ns"))), "pickup (2)"),
    "text": (months(zone=pa.array(["a", "1"])), "zone (1)"),
    "order": (months().select(["pickup", "VendorID", "zone", "fare"]), "columns are"),
    "case": (months().rename_columns(["vendorid", "pickup", "zone", "fare"]), "columns are"),
    "type": (months(fare=pa.array([b"x", b"y"])), "does not convert"),
}


def test_bad_files_are_rejected_alone(spark, tmp_path):
    put(tmp_path / "in", months(), month=12)
    for month, (table, _) in enumerate(BAD.values(), start=1):
        put(tmp_path / "in", table, month=month)
    (tmp_path / "in" / "green_tripdata_2023-11.parquet").write_bytes(b"not parquet")
    report = run(spark, tmp_path / "in", tmp_path / "out")
    for month, (_, error) in enumerate(BAD.values(), start=1):
        assert report[month]["status"] == "failed"
        assert error in report[month]["error"]
    assert report[11]["status"] == "failed"
    assert report[12]["status"] == "landed"
    assert {row[-1] for row in landed(spark, tmp_path / "out")} == {12}


def test_on_error_raise_lands_the_others_first(spark, tmp_path):
    put(tmp_path / "in", months(), month=1)
    put(tmp_path / "in", BAD["fraction"][0], month=2)
    with pytest.raises(IngestError, match="1 of 2"):
        run(spark, tmp_path / "in", tmp_path / "out", on_error="raise")
    assert {row[-1] for row in landed(spark, tmp_path / "out")} == {1}


def test_loose_names(spark, tmp_path):
    shuffled = months().select(["fare", "zone", "pickup", "VendorID"])
    put(tmp_path / "in", shuffled.rename_columns(["FARE", "zone", "pickup", "vendorid"]))
    assert run(spark, tmp_path / "in", tmp_path / "out", strict_names=False)[1]["status"] == "landed"
    assert landed(spark, tmp_path / "out")[0] == ("1", AT, 7, 2.5, 2023, 1)


def test_rerun_replaces_only_its_months(spark, tmp_path):
    put(tmp_path / "in", months(), month=1)
    put(tmp_path / "in", months(), month=2)
    run(spark, tmp_path / "in", tmp_path / "out")
    first = landed(spark, tmp_path / "out")
    run(spark, tmp_path / "in", tmp_path / "out")
    assert landed(spark, tmp_path / "out") == first
    put(tmp_path / "in", months().slice(0, 0), month=2)
    assert run(spark, tmp_path / "in", tmp_path / "out", month=2)[2]["n_rows"] == 0
    assert landed(spark, tmp_path / "out") == [row for row in first if row[-1] == 1]


def test_month_of_several_parts_is_one_unit(spark, tmp_path):
    put(tmp_path / "in", months(), month=1, part="part-0")
    put(tmp_path / "in", months(**DRIFTS["double zone"]), month=1, part="part-1")
    put(tmp_path / "in", months(), month=2, part="part-0")
    put(tmp_path / "in", BAD["fraction"][0], month=2, part="part-1")
    report = run(spark, tmp_path / "in", tmp_path / "out")
    assert (report[1]["status"], report[1]["n_rows"]) == ("landed", 4)
    assert (report[2]["status"], report[2]["n_bad"]) == ("failed", 1)
    assert [row[-1] for row in landed(spark, tmp_path / "out")] == [1] * 4


def test_96_bit_times_land(spark, tmp_path):
    for feed in ("green", "fhv"):
        path = tmp_path / f"{feed}_tripdata_2023-01.parquet"
        pq.write_table(months(), path, use_deprecated_int96_timestamps=True)
        report = run(spark, tmp_path, tmp_path / "out", feed)
        assert report[1]["error"] is None
        assert AT in [row[1] for row in landed(spark, tmp_path / "out", feed)]


def long_months(n, **columns):
    base = {
        "VendorID": pa.array(["1"] * n),
        "pickup": pa.array([AT] * n, pa.timestamp("us")),
        "zone": pa.array(range(n), pa.int64()),
        "fare": pa.array([float(i) for i in range(n)]),
    }
    return pa.table({**base, **columns})


@pytest.mark.parametrize("feed", ["green", "fhv"])
@pytest.mark.parametrize("column", ["zone", "fare"])
def test_bad_pages_reject_their_file_alone(spark, tmp_path, feed, column):
    """The footer is whole. `zone` is damaged where values are checked, `fare` only where they are written."""
    drift = {"zone": pa.array([float(i) for i in range(5000)])}
    put(tmp_path / "in", long_months(5000, **drift), feed, 1)
    put(tmp_path / "in", long_months(5000, **drift), feed, 2)
    path = tmp_path / "in" / f"{feed}_tripdata_2023-02.parquet"
    chunk = pq.ParquetFile(path).metadata.row_group(0).column(["VendorID", "pickup", "zone", "fare"].index(column))
    data = bytearray(path.read_bytes())
    start = chunk.dictionary_page_offset or chunk.data_page_offset
    data[start : start + chunk.total_compressed_size] = b"\xab" * chunk.total_compressed_size
    path.write_bytes(data)
    report = run(spark, tmp_path / "in", tmp_path / "out", feed)
    assert report[1]["status"] == "landed"
    assert report[2]["status"] == "failed"
    assert "unreadable data" in report[2]["error"]
    rows = landed(spark, tmp_path / "out", feed)
    assert (len(rows), {row[-1] for row in rows}) == (5000, {1})


def test_a_mixed_month_with_a_bad_page_keeps_the_old_rows(spark, tmp_path):
    put(tmp_path / "in", long_months(5000), "fhv", 1, "part-0")
    put(tmp_path / "in", long_months(5000, zone=pa.array([float(i) for i in range(5000)])), "fhv", 1, "part-1")
    assert run(spark, tmp_path / "in", tmp_path / "out", "fhv")[1]["status"] == "landed"
    path = tmp_path / "in" / "fhv_tripdata_2023-01.parquet" / "part-1.parquet"
    chunk = pq.ParquetFile(path).metadata.row_group(0).column(3)
    data = bytearray(path.read_bytes())
    start = chunk.dictionary_page_offset or chunk.data_page_offset
    data[start : start + chunk.total_compressed_size] = b"\xab" * chunk.total_compressed_size
    path.write_bytes(data)
    assert run(spark, tmp_path / "in", tmp_path / "out", "fhv")[1]["status"] == "failed"
    root = raw_path(str(tmp_path / "out"), "fhv")
    assert read_raw(spark, root, lambda df: df.select("fare")).count() == 10_000


def test_odd_columns_fail_their_file_alone(spark, tmp_path):
    odd = [{"year": [1]}, {"a": pa.array([1], pa.time32("s"))}, {"a": pa.array([None], pa.float16())}]
    for month, columns in enumerate(odd, start=1):
        put(tmp_path / "in", pa.table(columns), "fhv", month)
    put(tmp_path / "in", pa.table([[1], [2]], ["a", "A"]), "fhv", 4)
    put(tmp_path / "in", pa.table({"a": [1]}), "fhv", 5)
    status = {m: r["status"] for m, r in run(spark, tmp_path / "in", tmp_path / "out", "fhv").items()}
    assert (status[1], status[4], status[5]) == ("failed", "failed", "landed")


@pytest.mark.parametrize(
    ("path", "uri"),
    [
        ("file:/a b/c", "/a b/c"),
        ("file:///a/c", "/a/c"),
        ("/a/c", "/a/c"),
        ("s3a://bucket/c", "s3://bucket/c"),
        ("wasbs://box@name.blob.core.windows.net/c", "abfss://box@name.dfs.core.windows.net/c"),
        ("dbfs:/a/c", "/dbfs/a/c"),
        ("hdfs://host:8020/c", "hdfs://host:8020/c"),
        ("gs://bucket/c", "gs://bucket/c"),
    ],
)
def test_paths_as_arrow_names_them(path, uri):
    assert uri_mapper()(path) == uri


def test_a_file_in_two_places_is_ambiguous(spark, tmp_path):
    put(tmp_path / "in" / "a", months(), month=1)
    put(tmp_path / "in" / "b", months(), month=1)
    put(tmp_path / "in" / "b", months(), month=2)
    report = run(spark, tmp_path / "in", tmp_path / "out")
    assert (report[1]["status"], report[2]["status"]) == ("failed", "landed")
    assert "more than once" in report[1]["error"]


def test_odd_paths(spark, tmp_path):
    source = tmp_path / "in put+100%"
    put(source, months(), month=1)
    put(source, BAD["fraction"][0], month=2)
    report = run(spark, source, tmp_path / "out")
    assert (report[1]["status"], report[2]["status"]) == ("landed", "failed")


def test_pass_through_keeps_each_type(spark, tmp_path):
    put(tmp_path / "in", pa.table({"a": [1, 2], "b": ["x", "y"]}), "fhv", 1)
    put(tmp_path / "in", pa.table({"a": [1.5], "b": ["z"]}), "fhv", 2)
    put(tmp_path / "in", pa.table({"a": [3], "b": ["u"]}), "fhv", 3, "part-0")
    put(tmp_path / "in", pa.table({"a": [4.5], "b": ["v"]}), "fhv", 3, "part-1")
    for _ in range(2):
        report = run(spark, tmp_path / "in", tmp_path / "out", "fhv")
        assert {m: (r["status"], r["n_rows"]) for m, r in report.items()} == {
            1: ("landed", 2), 2: ("landed", 1), 3: ("landed", 2)
        }
        root = raw_path(str(tmp_path / "out"), "fhv")
        assert spark.read.parquet(f"{root}/year=2023/month=1").dtypes == [("a", "bigint"), ("b", "string")]
        assert spark.read.parquet(f"{root}/year=2023/month=2").dtypes == [("a", "double"), ("b", "string")]
        rows = read_raw(spark, root, lambda df: df.select(to_integer(df, "a").alias("a"), "b")).collect()
        assert sorted(map(tuple, rows)) == [(1, "x"), (2, "y"), (2, "z"), (3, "u"), (5, "v")]


def test_missing_and_published(spark, tmp_path):
    put(tmp_path / "in", months(), month=1)
    put(tmp_path / "in", months(), month=2)
    with pytest.raises(FileNotFoundError, match="green_tripdata_2023-03.parquet"):
        run(spark, tmp_path / "in", tmp_path / "out", strict=True)
    base = "https://files.example.org/trip-data"
    published = spark.createDataFrame([(f"{base}/green_tripdata_2023-{m}.parquet",) for m in ("02", "05")], "url string")
    report = ingest(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), ["green"], [2023],
        published=published, strict=False, as_of=AS_OF, feeds=FEEDS,
    )
    status = {row["month"]: row["status"] for row in report.collect()}
    assert status == {**{m: "missing" for m in range(1, 13)}, 2: "landed"}


def test_newest_month_is_taken_without_years(spark, tmp_path):
    put(tmp_path / "in", months(), month=11)
    put(tmp_path / "in", months(), month=12)
    report = ingest(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), ["green"], as_of=dt.date(2024, 1, 20), feeds=FEEDS
    )
    assert [(r["month"], r["status"]) for r in report.collect()] == [(11, "landed")]


@pytest.mark.parametrize(
    ("options", "error"),
    [
        ({"vehicle_types": ["boat"]}, ValueError),
        ({"years": ["2023"]}, TypeError),
        ({"years": [2023], "month": 13}, ValueError),
        ({"month": 1}, ValueError),
        ({"on_error": "ignore"}, ValueError),
    ],
)
def test_arguments_are_checked(spark, tmp_path, options, error):
    with pytest.raises(error):
        ingest(spark, str(tmp_path), str(tmp_path), **options)
