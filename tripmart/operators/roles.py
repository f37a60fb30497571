"""Joining one dimension in several roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32 * 1024**2
ROW_OVERHEAD_BYTES = 64


def fits_broadcast(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """Count rows and bytes in one aggregation, which sends one row a task."""
    text = F.concat_ws("", *[F.col(f"`{name}`").cast("string") for name in df.columns])
    size = df.agg(F.count("*").alias("n"), F.sum(F.octet_length(text) + ROW_OVERHEAD_BYTES).alias("size")).first()
    return size["n"] <= max_rows and (size["size"] or 0) <= max_bytes


def join_roles(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    roles: Mapping[str, str],
    attributes: Sequence[str],
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Inner-join `dimension` once per role.

    `roles` maps a role to its key column in `facts`; each role adds one
    `{role}_{attribute}` column per attribute. A dimension that measures small is
    broadcast, and as both roles read the same columns Spark builds it once. A
    larger one is shuffled, where the adaptive skew join splits hot keys.
    """
    dimension = dimension.select(key, *attributes)
    small = fits_broadcast(dimension, broadcast_max_rows)
    joined = facts
    for role, fact_key in roles.items():
        side = F.broadcast(dimension) if small else dimension
        joined = joined.alias("facts").join(
            side.alias("role"), F.col(f"facts.{fact_key}") == F.col(f"role.{key}"), "inner"
        )
        joined = joined.select(
            "facts.*", *[F.col(f"role.{name}").alias(f"{role}_{name}") for name in attributes]
        )
    return joined
