"""Published links in a table of web pages."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What ends a link inside markup; a greedy match would run several links of a line together.
IN_LINK = r"[^\"'<>\s]*?"


def extract_links(
    pages: DataFrame, html: str, prefix: str, suffix: str = ".parquet", link: str = "url"
) -> DataFrame:
    """Distinct links that begin with `prefix` and end at the first `suffix`."""
    pattern = re.escape(prefix) + IN_LINK + re.escape(suffix)
    found = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0))
    return (
        pages.where(F.contains(F.col(html), F.lit(prefix)))
        .select(F.explode(F.array_distinct(found)).alias(link))
        .distinct()
    )
