"""Landing monthly trip files as partitioned Parquet.

Driver side there is metadata only: one entry per file, as Spark's own file index
holds. Footers are read, values checked and files written in tasks. A run writes aside and swaps its
months in at the end, see `commit`; what became of each file is kept in a ledger.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce
from typing import NamedTuple, TypeVar

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.manifest import month_grid, run_grid, split_available
from tripmart.registry import DEFAULT_VEHICLE_TYPES, FEEDS, Feed, feed_of
from tripmart.session import configure, sized
from tripmart.sources.commit import LEDGER, MonthKey, Run, raw_path, recover
from tripmart.sources.enforce import NANOS, enforce_schema
from tripmart.sources.files import Store
from tripmart.sources.footers import Opener, list_files, list_parquet, month_of_file, read_footers, same_path

REPORT = (
    "vehicle_type string, year int, month int, file_name string, "
    "status string, n_rows bigint, n_bad bigint, error string"
)
LEDGER_ROWS = f"{REPORT}, length bigint, modified timestamp, n_parts bigint, landed_at timestamp"
LANDED, FAILED, MISSING, UNCHANGED = "landed", "failed", "missing", "unchanged"
MAX_SCANS = 16  # of files with equal columns, by which of them could lose values
UNREADABLE = re.compile(r"\[FAILED_READ_FILE\S*\] Encountered error while reading file (\S+)\.\s")

Result = TypeVar("Result")


class IngestError(RuntimeError):
    """Some files were rejected; the others have been landed."""


@dataclass
class Month:
    """A published file: all of it is landed, or nothing."""

    vehicle_type: str
    year: int
    month: int
    file_name: str
    # part path -> its columns, as JSON of (name, type) pairs
    parts: dict[str, str] = field(default_factory=dict)
    # part path -> columns whose statistics prove that no cast loses a value
    proven: dict[str, frozenset[str]] = field(default_factory=dict)
    n_rows: int = 0
    n_bytes: int = 0
    n_bad: int = 0
    length: int = 0
    modified: datetime | None = None
    error: str | None = None
    missing: bool = False
    unchanged: bool = False

    def whole(self, part: str) -> str:
        """Path of the published file that `part` belongs to."""
        return part[: part.rindex(self.file_name) + len(self.file_name)]

    @property
    def key(self) -> MonthKey:
        return self.vehicle_type, self.year, self.month

    def fail(self, why: str) -> None:
        self.error = self.error or why

    def report(self) -> tuple:
        status = MISSING if self.missing else FAILED if self.error else UNCHANGED if self.unchanged else LANDED
        rows = None if self.missing else self.n_rows
        return (
            self.vehicle_type, self.year, self.month, self.file_name,
            status, rows, self.n_bad, self.error,
        )


@contextmanager
def _nanos_readable(spark: SparkSession):
    """Nanosecond columns arrive as integers; Spark refuses the file otherwise."""
    key = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _by_columns(months: Iterable[Month]) -> dict[str, list[str]]:
    """Paths that share the same columns and types can be read together.

    A folder whose parts agree is named as one path: its parts need not be looked up one by one.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for month in months:
        kinds = set(month.parts.values())
        for path, columns in month.parts.items():
            groups[columns].append(path if len(kinds) > 1 else month.whole(path))
    return {columns: sorted(set(paths)) for columns, paths in groups.items()}


def _collect_months(files: DataFrame, opener: Opener | None = None) -> list[Month]:
    months: dict[str, Month] = {}
    for row in read_footers(files, opener).collect():
        month = months.setdefault(
            row["file_name"], Month(row["vehicle_type"], row["year"], row["month"], row["file_name"])
        )
        if row["error"]:
            month.fail(row["error"])
        else:
            month.parts[row["path"]] = row["columns"]
            month.proven[row["path"]] = frozenset(json.loads(row["proven"]))
            month.n_rows += row["n_rows"]
            month.n_bytes += row["n_bytes"]
        month.length += row["length"]
        month.modified = max(filter(None, (month.modified, row["modified"])))
    for month in months.values():
        places = sorted({month.whole(path) for path in month.parts})
        if len(places) > 1:
            month.fail(f"found more than once: {places}")
    return list(months.values())


class Group(NamedTuple):
    """Files with equal columns: how to read them, how to cast them, where a cast would lose a value."""

    schema: T.StructType
    casts: list[Column]
    bad: dict[str, Column]


def _enforced_groups(
    spark: SparkSession, feed: Feed, months: list[Month], strict_names: bool
) -> dict[str, Group]:
    """Groups by their columns; months whose names or types do not match are failed."""
    groups = {}
    for columns, paths in _by_columns(months).items():
        try:
            df = spark.read.parquet(paths[0])
            casts, bad = enforce_schema(df, feed.schema, dict(json.loads(columns)), strict_names)
            groups[columns] = Group(df.schema, casts, bad)
        except (ValueError, AnalysisException) as problem:
            for month in months:
                if columns in month.parts.values():
                    month.fail(str(problem))
    return groups


def _read_groups(
    spark: SparkSession, groups: Mapping[str, Group], months: Iterable[Month]
) -> list[tuple[Group, DataFrame]]:
    return [
        (groups[columns], spark.read.schema(groups[columns].schema).parquet(*paths))
        for columns, paths in _by_columns(months).items()
    ]


def _risky_scans(groups: Mapping[str, Group], months: Iterable[Month]) -> list[tuple[Group, list[str], list[str]]]:
    """(group, columns, paths): which columns of which files have to be read to know that no value is lost.

    Statistics in footers decide the others. Beyond MAX_SCANS kinds of files their columns are united.
    """
    kinds: dict[str, dict[frozenset[str], list[str]]] = defaultdict(lambda: defaultdict(list))
    for month in months:
        risks = {p: (c, frozenset(groups[c].bad) - month.proven.get(p, frozenset())) for p, c in month.parts.items()}
        alike = len(set(risks.values())) == 1
        for path, (columns, risky) in risks.items():
            if risky:
                kinds[columns][risky].append(month.whole(path) if alike else path)
    scans = []
    for columns, by_risk in kinds.items():
        if len(by_risk) > MAX_SCANS:
            by_risk = {frozenset().union(*by_risk): [p for paths in by_risk.values() for p in paths]}
        scans += [(groups[columns], sorted(risky), sorted(set(paths))) for risky, paths in by_risk.items()]
    return scans


def _bad_values(spark: SparkSession, scans: Iterable[tuple[Group, list[str], list[str]]]) -> list[Row]:
    """Lossy values per file and column: one job over only the columns that could lose any."""
    counts = []
    for group, names, paths in scans:
        df = spark.read.schema(group.schema).parquet(*paths)
        per_file = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            *[F.count_if(group.bad[name]).alias(name) for name in names]
        )
        by_name = F.create_map(*[part for name in names for part in (F.lit(name), F.col(f"`{name}`"))])
        lost = F.map_filter(by_name, lambda _, n: n > 0).alias("bad")
        counts.append(per_file.select("path", lost).where(F.size("bad") > 0))
    return reduce(DataFrame.unionAll, counts).collect() if counts else []


def _good(months: Iterable[Month]) -> list[Month]:
    return [month for month in months if not month.error]


def _isolating(months: list[Month], action: Callable[[list[Month]], Result]) -> Result:
    """Run `action` on the good months.

    A footer can be fine and a data page not, which only reading shows and which ends
    the job. Then that month is failed and the action is run without it.
    """
    owner = {same_path(path): month for month in months for path in month.parts}
    while True:
        try:
            return action(_good(months))
        except Exception as problem:
            found = UNREADABLE.search(str(problem))
            month = owner.get(same_path(found[1], encoded=True)) if found else None
            if month is None or month.error:
                raise
            month.fail(f"unreadable data in {same_path(found[1], encoded=True)}")


def _check_values(spark: SparkSession, groups: Mapping[str, Group], months: list[Month]) -> None:
    owner = {same_path(path): month for month in months for path in month.parts}
    for row in _isolating(months, lambda good: _bad_values(spark, _risky_scans(groups, good))):
        month = owner[same_path(row["path"], encoded=True)]
        month.n_bad += sum(row["bad"].values())
        lost = ", ".join(f"{name} ({n})" for name, n in sorted(row["bad"].items()))
        month.fail(f"values would be lost: {lost}")


def _with_month(df: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    year, month = month_of_file()
    return df.select(*columns, year.alias("year"), month.alias("month"))


def _write_months(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("year", "month").parquet(path)


def _empty_months(df: DataFrame, months: Iterable[Month], path: str) -> None:
    """Months without rows make no partition, so each gets a file without rows."""
    for month in months:
        if not month.n_rows:
            df.limit(0).write.mode("append").parquet(f"{path}/year={month.year}/month={month.month}")


def _land_enforced(spark: SparkSession, feed: Feed, months: list[Month], run: Run, strict_names: bool) -> str:
    """Write the good months aside; returns where."""
    groups = _enforced_groups(spark, feed, _good(months), strict_names)
    _check_values(spark, groups, _good(months))

    def write(good: list[Month]) -> str:
        path = run.aside(feed.name)
        if good:
            parts = [_with_month(df, group.casts) for group, df in _read_groups(spark, groups, good)]
            landed = reduce(DataFrame.unionByName, parts)
            _write_months(landed, path)
            _empty_months(landed.drop("year", "month"), good, path)
        return path

    return _isolating(_good(months), write)


def _unresolved(spark: SparkSession, columns: str, paths: Sequence[str]) -> str | None:
    """Why files with these columns can't be landed as they are; their data are not read."""
    clash = [name for name, _ in json.loads(columns) if name.lower() in ("year", "month")]
    if clash:
        return f"columns named as the partitions: {clash}"
    try:
        _with_month(spark.read.parquet(paths[0]), ["*"])
    except PySparkException as problem:
        return f"Spark can't read these columns: {str(problem).splitlines()[0]}"
    return None


def _land_as_is(spark: SparkSession, feed: Feed, months: list[Month], run: Run) -> str:
    """Write the good months aside, one write per set of columns; returns where."""
    for month in _good(months):
        if any(kind.startswith(NANOS) for columns in month.parts.values() for _, kind in json.loads(columns)):
            month.fail("nanosecond times cannot be kept unchanged")
    for columns, paths in _by_columns(_good(months)).items():
        problem = _unresolved(spark, columns, paths)
        for month in months:
            if problem and columns in month.parts.values():
                month.fail(problem)

    def write(good: list[Month]) -> str:
        path = run.aside(feed.name)
        for columns, paths in _by_columns(good).items():
            df = _with_month(spark.read.parquet(*paths), ["*"])
            _write_months(df, path)
            _empty_months(df.drop("year", "month"), [m for m in good if columns in m.parts.values()], path)
        return path

    return _isolating(_good(months), write)


def read_ledger(spark: SparkSession, dest: str) -> DataFrame:
    """The newest row of each file that any run to `dest` has met."""
    path = f"{dest.rstrip('/')}/{LEDGER}"
    if not Store(spark).exists(path):
        return spark.createDataFrame([], LEDGER_ROWS)
    rows = spark.read.schema(LEDGER_ROWS).parquet(path)
    names = [f.name for f in rows.schema.fields]
    newest = rows.groupBy("file_name").agg(F.max_by(F.struct(*names), F.struct("landed_at", "status")).alias("row"))
    return newest.select("row.*")


def _write_ledger(spark: SparkSession, run: Run, months: list[Month]) -> None:
    rows = [(*m.report(), m.length, m.modified, len(m.parts)) for m in months if not m.missing and not m.unchanged]
    if rows:
        columns = LEDGER_ROWS.rsplit(",", 1)[0]
        stamped = spark.createDataFrame(rows, columns).withColumn("landed_at", F.current_timestamp())
        stamped.coalesce(1).write.parquet(run.ledger)


def _split_unchanged(files: DataFrame, ledger: DataFrame) -> tuple[DataFrame, list[Month]]:
    """Files that are new or were published again, and the months that have landed as they are."""
    now = files.groupBy("file_name").agg(
        F.sum("length").alias("length"), F.max("modified").alias("modified"), F.count("*").alias("n_parts")
    )
    landed = ledger.where(F.col("status") == LANDED)
    same = landed.join(now, ["file_name", "length", "modified", "n_parts"], "left_semi")
    months = [
        Month(r["vehicle_type"], r["year"], r["month"], r["file_name"], n_rows=r["n_rows"], unchanged=True)
        for r in same.collect()
    ]
    return split_available(files, same, "file_name")[1], months


def _check_arguments(
    vehicle_types: Sequence[str], years: Sequence[int] | None, month: int | None, on_error: str,
    feeds: Mapping[str, Feed],
) -> None:
    for name in vehicle_types:
        feed_of(name, feeds)
    numbers = [*(years or []), *([] if month is None else [month])]
    if any(type(number) is not int for number in numbers):
        raise TypeError("years and month must be integers")
    if month is not None and not 1 <= month <= 12:
        raise ValueError("month must be 1 to 12")
    if month is not None and not years:
        raise ValueError("a month needs years")
    if on_error not in ("report", "raise"):
        raise ValueError("on_error must be 'report' or 'raise'")


def ingest(
    spark: SparkSession,
    source: str,
    dest: str,
    vehicle_types: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
    month: int | None = None,
    *,
    published: DataFrame | None = None,
    strict: bool = True,
    on_error: str = "report",
    strict_names: bool = True,
    as_of: date | None = None,
    feeds: Mapping[str, Feed] = FEEDS,
    opener: Opener | None = None,
    only_new: bool = False,
    enforce: bool = True,
) -> DataFrame:
    """Land the wanted months from `source` below `dest`/raw, return one outcome per file.

    Without `years` the newest published month is taken. `published` (column `url`)
    restricts the run to published links, else every listed file counts. A wanted file that
    does not exist raises if `strict` and is reported otherwise. A file whose names,
    types or values do not fit its feed is rejected alone; `on_error="raise"` raises
    once the others are landed. Running again replaces the same months; with `only_new` files that have landed
    with the same length and time are left alone and reported as unchanged. Without `enforce` files of all feeds are
    landed as they are, as a local copy is. `opener` gives the Arrow file system
    and the name of a path, for storage whose credentials Arrow does not find itself. Nothing below `dest`/raw changes
    before all of the run has been written; an interrupted run is finished or rolled back by the next one.
    """
    vehicle_types = list(DEFAULT_VEHICLE_TYPES if vehicle_types is None else vehicle_types)
    _check_arguments(vehicle_types, years, month, on_error, feeds)
    configure(spark)
    recover(spark, dest)

    wanted = month_grid(
        run_grid(spark, vehicle_types, years), F.current_date() if as_of is None else F.lit(as_of), month
    ).distinct()
    files = list_files(spark, source)
    available = files.select("file_name")
    if published is not None:
        names = published.select(F.substring_index("url", "/", -1).alias("file_name"))
        available, _ = split_available(available, names, "file_name")
    valid, invalid = split_available(wanted, available, "file_name")
    absent = [
        Month(row["vehicle_type"], row["year"], row["month"], row["file_name"], missing=True, error="not found")
        for row in invalid.collect()
    ]
    if absent and strict:
        raise FileNotFoundError(f"not found: {sorted(month.file_name for month in absent)}")

    chosen, _ = split_available(files, valid, "file_name")
    unchanged: list[Month] = []
    if only_new:
        chosen, unchanged = _split_unchanged(chosen, read_ledger(spark, dest))
    run = Run(spark, dest)
    places: dict[str, str] = {}
    try:
        with _nanos_readable(spark):
            months = _collect_months(chosen, opener)
            for name in vehicle_types:
                of_feed = [m for m in months if m.vehicle_type == name]
                if not of_feed:
                    continue
                with sized(spark, sum(m.n_bytes for m in of_feed)):
                    if enforce and feeds[name].raw_ddl:
                        places[name] = _land_enforced(spark, feeds[name], of_feed, run, strict_names)
                    else:
                        places[name] = _land_as_is(spark, feeds[name], of_feed, run)
        _write_ledger(spark, run, months)
    except Exception:
        run.roll_back()
        raise
    run.commit((m.key, places[m.vehicle_type]) for m in _good(months))
    run.finish()

    # Footers come back in the order in which tasks read them.
    landed = sorted(months, key=lambda m: (m.vehicle_type, m.year, m.month, m.file_name))
    outcomes = [m.report() for m in (*landed, *unchanged, *absent)]
    if on_error == "raise" and any(m.error for m in months):
        failed = {m.file_name: m.error for m in months if m.error}
        raise IngestError(f"{len(failed)} of {len(months)} files rejected: {failed}")
    return spark.createDataFrame(outcomes, REPORT)


def scan_by_columns(
    spark: SparkSession, location: str, opener: Opener | None = None
) -> tuple[list[DataFrame], int]:
    """One DataFrame per set of columns below a folder, and the uncompressed bytes of all its files.

    Files that all agree give one plain scan.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    n_bytes = 0
    for row in read_footers(list_parquet(spark, location), opener).collect():
        if row["error"]:
            raise IngestError(f"{row['path']}: {row['error']}")
        groups[row["columns"]].append(row["path"])
        n_bytes += row["n_bytes"]
    if not groups:
        raise FileNotFoundError(f"no Parquet file below {location}")
    if len(groups) == 1:
        return [spark.read.parquet(location)], n_bytes
    # Named files alone don't tell the partition columns, their common folder does.
    together = spark.read.option("basePath", location.rstrip("/"))
    return [together.parquet(*paths) for paths in groups.values()], n_bytes


def read_by_columns(spark: SparkSession, location: str, opener: Opener | None = None) -> list[DataFrame]:
    """Read a folder of Parquet files whose types differ, as one DataFrame per set of columns."""
    return scan_by_columns(spark, location, opener)[0]


def input_bytes(spark: SparkSession, location: str, opener: Opener | None = None) -> int:
    """Uncompressed bytes of all Parquet files below a folder, from their footers."""
    footers = read_footers(list_parquet(spark, location), opener)
    return footers.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]


def read_raw(
    spark: SparkSession,
    location: str,
    project: Callable[[DataFrame], DataFrame] | None = None,
    opener: Opener | None = None,
) -> DataFrame:
    """All rows of such a folder: `project` brings each kind to common types, then they are united.

    Without `project` Spark widens the types as in any union.
    """
    parts = read_by_columns(spark, location, opener)
    return reduce(DataFrame.unionByName, map(project, parts) if project else parts)
