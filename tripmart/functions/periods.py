"""Which months are published at a given date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.registry import PUBLICATION_LAG_MONTHS


def publication_date(as_of: Column, lag: int = PUBLICATION_LAG_MONTHS) -> Column:
    """A day in the newest published month; wraps over the turn of the year."""
    return F.add_months(as_of.cast("date"), -lag)


def last_published_month(year: Column, as_of: Column, lag: int = PUBLICATION_LAG_MONTHS) -> Column:
    """12 for past years, the lagged month for the running one, 0 if none is out yet."""
    newest = publication_date(as_of, lag)
    return (
        F.when(year < F.year(as_of), 12)
        .when(year == F.year(newest), F.month(newest))
        .otherwise(0)
    )
