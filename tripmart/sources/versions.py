"""Full refresh of tables without a moment in which the old rows are gone and the new ones not there.

Each refresh writes a folder of its own. Only when that write has ended the catalog's entry is switched to it, which
is one change of the table's location. A refresh that fails leaves the old version as it was. The version before
stays for readers that began on it, until the next refresh.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tripmart.sources.files import Store

VERSIONED, PREVIOUS = "tripmart.versioned", "tripmart.previous"


@contextmanager
def _partitions_by_folder(spark: SparkSession):
    """Partitions are found in the table's folder, so switching the folder switches all of them at once."""
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table_root(spark: SparkSession, name: str, location: str | None = None) -> str:
    """The folder that holds the versions of a table."""
    return f"{(location or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{name}"


def table_facts(spark: SparkSession, name: str) -> dict[str, str]:
    """Location and own properties of a table; nothing if there is none."""
    if not spark.catalog.tableExists(name):
        return {}
    details = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if details.get("Type") == "VIEW":
        return {}
    own = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return {"location": details["Location"]} | {key: own[key] for key in (VERSIONED, PREVIOUS) if key in own}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(df: DataFrame, name: str, path: str, partition_by: str | None) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    partitions = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    with _partitions_by_folder(df.sparkSession):
        df.sparkSession.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {partitions} LOCATION {_quoted(path)} "
            f"TBLPROPERTIES ('{VERSIONED}' = 'true')"
        )


def refresh(df: DataFrame, name: str, partition_by: str | None = None, location: str | None = None) -> DataFrame:
    """Write the next version of a table and switch to it.

    Rows may be derived from the table's present version. A table with other columns, or made by other means, is
    replaced by a new entry after the write; its old files are deleted only if the catalog manages them.
    """
    spark = df.sparkSession
    store = Store(spark)
    root = table_root(spark, name, location)
    path = f"{root}/version-{uuid.uuid4().hex}"
    writer = df.write.format("parquet")
    try:
        (writer.partitionBy(partition_by) if partition_by else writer).save(path)
    except Exception:
        store.delete(path)
        raise
    old = table_facts(spark, name)
    wanted = [(f.name, f.dataType) for f in df.schema.fields]
    if partition_by:
        wanted = [c for c in wanted if c[0] != partition_by] + [c for c in wanted if c[0] == partition_by]
    if VERSIONED in old and [(f.name, f.dataType) for f in spark.table(name).schema.fields] == wanted:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _create(df, name, path, partition_by)
    if VERSIONED in old:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = {_quoted(old['location'])})")
        outdated = old.get(PREVIOUS)
        if outdated and outdated != old["location"]:
            store.delete(outdated)
    return spark.table(name)
