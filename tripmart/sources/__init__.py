from tripmart.sources.commit import recover
from tripmart.sources.landing import IngestError, ingest, input_bytes, read_by_columns, read_ledger, read_raw, scan_by_columns
from tripmart.sources.tables import (
    materialize,
    read_days,
    read_zones,
    register_external,
    scan_parquet,
    with_day,
    write_day_partitioned,
)

__all__ = [
    "IngestError",
    "ingest",
    "input_bytes",
    "materialize",
    "read_by_columns",
    "read_days",
    "read_ledger",
    "read_raw",
    "read_zones",
    "recover",
    "register_external",
    "scan_by_columns",
    "scan_parquet",
    "with_day",
    "write_day_partitioned",
]
