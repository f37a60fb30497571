"""Listing Parquet files and reading their footers, in tasks."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# {vehicle_type}_tripdata_{year}-{month}.parquet, a file or a folder of part files.
FILE_PATTERN = r"([^/]+)_tripdata_([0-9]{4})-([0-9]{2})\.parquet(?:/[^/]*)?$"
# A path to its Arrow file system and its name there; it must travel to tasks.
Opener = Callable[[str], tuple]
FOOTER = "columns string, n_rows bigint, n_bytes bigint, proven string, error string"
MAX_EXACT_DOUBLE = 2**53


def list_parquet(spark: SparkSession, root: str) -> DataFrame:
    """Paths, lengths and times of all Parquet files below `root`; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Trip files below `root`: path, length, modified, vehicle_type, year, month, file_name."""
    paths = list_parquet(spark, root)
    part = lambda group: F.regexp_extract("path", FILE_PATTERN, group)
    return paths.where(F.col("path").rlike(FILE_PATTERN)).select(
        "path",
        "length",
        "modified",
        part(1).alias("vehicle_type"),
        part(2).cast("int").alias("year"),
        part(3).cast("int").alias("month"),
        F.concat(part(1), F.lit("_tripdata_"), part(2), F.lit("-"), part(3), F.lit(".parquet")).alias("file_name"),
    )


def month_of_file() -> tuple[Column, Column]:
    """Year and month of the file a row comes from, by plain cuts as this runs per row."""
    tail = F.substring_index("_metadata.file_path", "_tripdata_", -1)
    return tail.substr(1, 4).cast("int"), tail.substr(6, 2).cast("int")


def uri_mapper() -> Callable[[str], str]:
    """A function from paths as Hadoop names them to paths as Arrow does; local ones come without scheme."""

    # Nested, so that it travels by value.
    def arrow_uri(path):
        scheme, colon, rest = path.partition(":")
        if not colon or "/" in scheme or scheme == "file":
            return "/" + (rest if scheme == "file" else path).lstrip("/")
        if scheme == "dbfs":  # seen by tasks as a mounted folder
            return "/dbfs/" + rest.lstrip("/")
        if scheme in ("wasb", "wasbs"):
            scheme, rest = scheme.replace("wasb", "abfs"), rest.replace(".blob.", ".dfs.", 1)
        return f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}"

    return arrow_uri


def read_footers(files: DataFrame, opener: Opener | None = None) -> DataFrame:
    """Add column names with types, row count, uncompressed bytes and proven columns of each `path`; unreadable files keep the error.

    A column is proven if statistics of all its row groups say that it has only nulls, or only integers that a double
    holds exactly: no cast of such a column to the type of a feed can lose a value.

    Storage that can't be opened is an error of the run. `opener` replaces Arrow's own choice of file system.

    The paths are spread by count: adaptive execution would see a few kilobytes of
    text and put all of them into one task.
    """

    arrow_uri, limit = uri_mapper(), MAX_EXACT_DOUBLE

    # Nested, so that it travels by value and executors need not have this package.
    def footers(batches):
        import json

        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def store_of(path):
            if opener is not None:
                return opener(path)
            uri = arrow_uri(path)
            return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)

        def harmless(group, place, kind):
            found = group.column(place).statistics
            if found is None or not found.has_null_count:
                return False
            if found.null_count == group.num_rows:
                return True
            exact = pa.types.is_integer(kind) and found.has_min_max
            return exact and -limit <= found.min and found.max <= limit

        def footer_of(fs, name):
            with fs.open_input_file(name) as handle:
                footer = pq.ParquetFile(handle)
                stored = [footer.schema.column(i) for i in range(len(footer.schema))]
                # Arrow shows 96-bit times as nanoseconds; Spark reads them, unlike 64-bit ones.
                int96 = {column.path for column in stored if column.physical_type == "INT96"}
                columns = [
                    [column.name, "int96" if column.name in int96 else str(column.type)]
                    for column in footer.schema_arrow
                ]
                meta = footer.metadata
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                place = {column.path: i for i, column in enumerate(stored)}
                proven = [
                    f.name for f in footer.schema_arrow if f.name in place and all(harmless(g, place[f.name], f.type) for g in groups)
                ]
                return json.dumps(columns), meta.num_rows, sum(g.total_byte_size for g in groups), json.dumps(proven), None

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                fs, name = store_of(path)
                try:
                    found.append(footer_of(fs, name))
                except Exception as problem:  # the outcome of this file, not of the run
                    found.append((None, None, None, None, f"{type(problem).__name__}: {problem}"))
            columns, n_rows, n_bytes, proven, error = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(columns, pa.string()),
                    pa.array(n_rows, pa.int64()),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(proven, pa.string()),
                    pa.array(error, pa.string()),
                ],
                names=[*batch.schema.names, "columns", "n_rows", "n_bytes", "proven", "error"],
            )

    tasks = files.sparkSession.sparkContext.defaultParallelism
    known = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.repartition(tasks).mapInArrow(footers, f"{known}, {FOOTER}")


def same_path(path: str, encoded: bool = False) -> str:
    """One spelling for file:/x, file:///x and, from row metadata, percent-encoded paths."""
    return re.sub(r"^file:/+", "/", unquote(path) if encoded else path)
