"""Unions and differences of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*tables: DataFrame) -> DataFrame:
    """All rows; columns that a table lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_with_key(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """All rows, each with the name of its table."""
    return union_by_name(*[table.select(F.lit(name).alias(key), "*") for name, table in tables.items()])


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of every table by position, duplicates kept."""
    return reduce(lambda a, b: a.unionAll(b), tables)


def difference(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of the first table that the second lacks."""
    return df.subtract(other)
