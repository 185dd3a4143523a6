"""Priorities, and in older layouts the areas they apply to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators import ordering as O
from sheetloom.operators import projection as P
from sheetloom.operators.reshape import matrix_to_bridge


def priorities_table(sheet: DataFrame, header_row: int) -> DataFrame:
    """Priorities under the names of the header row, with the code as number."""
    named = P.promote_header(sheet, "_ord", header_row)
    return named.withColumn("priority_id", P.as_integer(F.col("code"))).drop("code")


def priority_areas(sheet: DataFrame, names: Sequence[str], area_ids: Sequence[int], marks: Sequence[str] = ("x",)) -> DataFrame:
    """Rows (priority, area) of the older layout, whose area columns stand in the order of the ids."""
    cols = [c for c in sheet.columns if c != "_ord"]
    body = sheet.where(F.col(cols[0]) != "Theme").select(*cols, "_ord")
    renamed = body.toDF(*names, *[f"x{i}" for i in area_ids], "_ord")
    long = matrix_to_bridge(renamed, [*names, "_ord"], [f"x{i}" for i in area_ids], "area_id", marks,
                            lambda header: F.substring(header, 2, 10).cast("bigint"), position="_at")
    return P.across(long, P.columns_where(long, suffix="_id"), lambda c, name: P.as_integer(c))


def priority_area_bridge(long: DataFrame) -> DataFrame:
    """Distinct (priority, area) pairs, numbered by first appearance."""
    seen = O.first_seen(long.withColumn("_place", F.struct("_ord", "_at")), ["priority_id", "area_id"], "_place")
    return O.add_id(seen, "id", ["_seen"]).drop("_seen")


def priority_dimension(long: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct priorities without their areas."""
    return P.relocate(long.select(*cols).distinct(), "priority_id")
