"""Key, reference and round-trip checks. Each returns the offending rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators.joins import Keys, _pairs, equi_join


def check_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that are null in part or occur more than once, with their number of rows."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | any_null)


def check_reference(child: DataFrame, parent: DataFrame, on: Keys) -> DataFrame:
    """Child rows whose complete key the parent lacks; keys that are null in part refer to nothing."""
    pairs = _pairs(on)
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c, _ in pairs])
    return equi_join(child.where(filled), parent, on, "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, on: Keys) -> DataFrame:
    """Distinct orphaned keys with their number of rows.

    Keys of equal types on both sides are grouped together, once: tasks combine them before the shuffle and hold
    one table of keys, with neither sorts nor a join. Other keys are combined before their join.
    """
    pairs = _pairs(on)
    names = [c for c, _ in pairs]
    if any(child.schema[c].dataType != parent.schema[p].dataType for c, p in pairs):
        return check_reference(child.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), parent, on)
    sides = child.select(*[F.col(f"`{c}`") for c in names], F.lit(1).alias("_n")).unionAll(
        parent.select(*[F.col(f"`{p}`").alias(c) for c, p in pairs], F.lit(None).cast("int").alias("_n")))
    # Rows of the parent alone are null in _n.
    found = sides.dropna(subset=names).groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count("_n").alias("n"), F.count(F.lit(1)).alias("_all"))
    return found.where(F.col("n") == F.col("_all")).drop("_all")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of nulls of each column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(cols)])
    return counts.select(F.inline(lines))


def compare_tables(source: DataFrame, rebuilt: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row counts of both sides and of the row copies that only one side holds, in one aggregation."""
    sides = source.select(*cols, F.lit(1).alias("_s"), F.lit(0).alias("_r")).unionByName(
        rebuilt.select(*cols, F.lit(0).alias("_s"), F.lit(1).alias("_r"))
    )
    copies = sides.groupBy(*cols).agg(F.sum("_s").alias("_s"), F.sum("_r").alias("_r"))
    nothing = F.lit(0).cast("long")
    return copies.agg(
        F.coalesce(F.sum("_s"), nothing).alias("source_rows"),
        F.coalesce(F.sum("_r"), nothing).alias("rebuilt_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_s") - F.col("_r"), nothing)), nothing).alias("only_source"),
        F.coalesce(F.sum(F.greatest(F.col("_r") - F.col("_s"), nothing)), nothing).alias("only_rebuilt"),
    )
