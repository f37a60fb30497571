"""Small text and label expressions."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.registry import FILE_NAME


def code_label(code: Column, labels: Mapping[Any, str]) -> Column:
    """Label of a code; codes without one, and null, give null."""
    (first, text), *rest = labels.items()
    label = F.when(code == first, text)
    for value, text in rest:
        label = label.when(code == value, text)
    return label


def replace_literal(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def url_basename(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def normalize_run_id(run_id: Column) -> Column:
    return replace_literal(F.translate(run_id, "_:T+", "----"), "--", "-")


def trip_file_name(vehicle_type: Column, year: Column, month: Column) -> Column:
    return F.format_string(FILE_NAME, vehicle_type, year, month)


def coalesce_default(col: Column, default: Any) -> Column:
    return F.coalesce(col, default if isinstance(default, Column) else F.lit(default))
