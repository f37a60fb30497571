"""The report of a landing lists months in order, whichever file's footer is read first."""

from datetime import date

from tripmart.checks import roles
from tripmart.sources import landing


def test_report_is_in_order_of_months(spark, tmp_path, monkeypatch):
    trips = roles.fhv_raw(spark, "/root/testdata/sf0.001").limit(5)
    for month in (1, 2, 3):
        trips.coalesce(1).write.parquet(f"{tmp_path}/in/fhv_tripdata_2023-{month:02d}.parquet")
    collect = landing._collect_months
    monkeypatch.setattr(landing, "_collect_months", lambda *args: sorted(collect(*args), key=lambda m: -m.month))
    report = landing.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/lake", ["fhv"], [2023], strict=False, as_of=date(2023, 12, 1))
    assert [r.month for r in report.where("status = 'landed'").collect()] == [1, 2, 3]
