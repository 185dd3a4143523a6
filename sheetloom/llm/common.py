"""Small helpers that several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What separates words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
# Rows that a window over one group of running_total() may see, as a power of two.
FAN = 8


def word_count(text: Column) -> Column:
    """Words of the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(df: DataFrame, *more: Column) -> Column:
    """64-bit hash of all columns, nulls told apart by place. Map columns, which have no hash, count by their entries."""
    flat = [F.map_entries(F.col(f"`{c}`")) if kind.startswith("map<") else F.col(f"`{c}`") for c, kind in df.dtypes]
    nulls = [F.col(f"`{c}`").isNull() for c in df.columns]
    return F.xxhash64(*flat, *nulls, *more)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bits_for(n: int) -> int:
    """Bits that hold the numbers 0 to n - 1."""
    return max(1, math.ceil(math.log2(max(2, n))))


def running_total(df: DataFrame, by: list[str], key: str, value: str, name: str, bits: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """``name``: the sum of ``value`` over the rows of the group that come before, by ascending ``key``.

    ``key`` is a long from 0 to 2^bits - 1, spread evenly, as hashes and running numbers are; ``ties`` complete the
    order. A plain window would take a whole group into one task. Here rows meet in cells of the key that hold a few
    hundred rows of a group each; the totals of the cells, 2^FAN times fewer, are added up the same way.
    """
    order = [F.col(key), *[F.col(c) for c in ties]]

    def before(window: Window) -> Column:
        return F.coalesce(F.sum(value).over(window), F.lit(0)).cast("long")

    if bits <= FAN:
        window = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order)
        return df.withColumn(name, before(window.rowsBetween(Window.unboundedPreceding, -1)))
    cell, total, offset, part = (f"_{x}{bits}" for x in ("cell", "total", "before", "inside"))
    celled = df.withColumn(cell, F.shiftrightunsigned(F.col(key).cast("long"), FAN))
    totals = celled.groupBy(*by, cell).agg(F.sum(value).alias(total))
    offsets = running_total(totals, by, cell, total, offset, bits - FAN).drop(total)
    window = Window.partitionBy(*by, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # The rows are dealt and sorted by cell for the window already; a broadcast could take them, as their file is small beside them.
    joined = celled.withColumn(part, before(window)).join(offsets.hint("merge"), [*by, cell])
    return joined.withColumn(name, F.col(offset) + F.col(part)).drop(cell, offset, part)
