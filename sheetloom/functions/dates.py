"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_date(col: Column) -> Column:
    return col.cast("date")


def month_year(col: Column) -> Column:
    """Short month and two-digit year, such as ``Jan 24``."""
    return F.date_format(col, "MMM yy")


def stamp(col: Column) -> Column:
    """The date without separators."""
    return F.date_format(col, "yyyyMMdd")


def in_years(col: Column, first: int, last: int) -> Column:
    return F.year(col).between(first, last)
