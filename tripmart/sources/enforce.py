"""Bringing a file to the schema of its feed, or saying why it cannot be."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.casts import safe_cast

NANOS = "timestamp[ns"


def _source_column(name: str, arrow_type: str, dtype: T.DataType) -> tuple[Column, T.DataType, Column | None]:
    """The column as Spark reads it; nanoseconds become times, the rest below a microsecond is a loss."""
    col = F.col(f"`{name}`")
    if arrow_type.startswith(NANOS):
        micros = F.timestamp_micros(F.expr(f"`{name}` div 1000"))
        return micros.cast("timestamp_ntz"), T.TimestampNTZType(), col % 1000 != 0
    return col, dtype, None


def enforce_schema(
    df: DataFrame,
    schema: T.StructType,
    arrow_types: Mapping[str, str] | None = None,
    strict_names: bool = True,
) -> tuple[list[Column], dict[str, Column]]:
    """Casts of `df` to `schema`, and per column where a cast would lose a value.

    Raises ValueError if names or types cannot match at all.
    """
    wanted = schema.fieldNames()
    if strict_names and df.columns != wanted:
        raise ValueError(f"columns are {df.columns}, expected {wanted}")
    present = {f.name.lower(): f for f in df.schema.fields}
    casts, bad = [], {}
    for target in schema.fields:
        source = present.get(target.name.lower())
        if source is None:
            raise ValueError(f"no column {target.name}")
        col, dtype, lossy = _source_column(
            source.name, (arrow_types or {}).get(source.name, ""), source.dataType
        )
        cast = safe_cast(col, dtype, target.dataType)
        if cast is None:
            raise ValueError(f"column {target.name}: {dtype.simpleString()} does not convert")
        casts.append(cast.value.alias(target.name))
        checks = [check for check in (lossy, cast.bad) if check is not None]
        if checks:
            bad[target.name] = reduce(Column.__or__, checks)
    return casts, bad
