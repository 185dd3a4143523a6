"""Habitats of areas: two presence matrices to texts, a dimension and two bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators import ordering as O
from sheetloom.operators.joins import equi_join
from sheetloom.operators.reshape import explode_delim, matrix_to_bridge, prefixed_id
from sheetloom.operators.sets import union_with_key
from sheetloom.session import staged, staged_by

# Fixed value: what separates the habitats of one area.
HABITAT_SEP = ":\n"


def habitat_rows(sheet: DataFrame) -> DataFrame:
    """Area and habitat of every marked cell; the sub-header row is left out."""
    rows = sheet.where(F.col("identifier") != "Habitat")
    cols = [c for c in sheet.columns if c not in ("identifier", "_ord")]
    bridge = matrix_to_bridge(rows, ["identifier", "_ord"], cols, "area_id", header_id=prefixed_id)
    return bridge.where(F.col("area_id").isNotNull()).select("area_id", F.col("identifier").alias("habitat"), "_ord")


def habitat_texts(rows: DataFrame, name: str) -> DataFrame:
    """Habitats of each area as one text in sheet order."""
    return O.collapse(rows, ["area_id"], "habitat", HABITAT_SEP, ["_ord"], name)


def habitat_tables(creation: DataFrame, management: DataFrame) -> dict[str, DataFrame]:
    """The habitat dimension, numbered by first appearance, and its two bridges.

    Each sheet is read once, for the cells that all three tables start from; one job writes both bridges.
    """
    long = {
        "1": explode_delim(creation, "habitat", HABITAT_SEP),
        "2": explode_delim(management, "habitat", HABITAT_SEP),
    }
    placed = staged(union_with_key(long, "_sheet"), "habitat-cells")
    seen = O.first_seen(placed.withColumn("_at", F.struct("_sheet", "area_id", "_ord")), ["habitat"], "_at")
    habitat = staged(O.add_id(seen, "habitat_id", ["_seen"]).select("habitat_id", "habitat"), "habitats")
    numbered = equi_join(placed, habitat, ["habitat"]).select("_sheet", "area_id", "habitat_id")
    bridges = staged_by(numbered, "_sheet", list(long), "habitat-bridges")
    return {"habitat": habitat, "habitat_creation_area": bridges["1"], "habitat_management_area": bridges["2"]}
