"""Areas and their funding schemes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import text as X
from sheetloom.operators import ordering as O
from sheetloom.operators import projection as P
from sheetloom.operators.joins import left_join
from sheetloom.operators.reshape import explode_delim


def parsed_areas(sheet: DataFrame) -> DataFrame:
    """Numbered areas with clean names; line breaks go from links and schemes."""
    named = P.rename(sheet, {
        "area_id": "identifier", "area_name": "title", "area_description": "brief_narrative",
        "area_link": "links_to_further_info_guidance",
    })
    numbered = named.withColumns({
        "area_id": P.as_integer(F.col("area_id")),
        "area_name": X.clean_text(F.col("area_name")),
    }).where(F.col("area_id").isNotNull())
    return P.across(numbered, ["area_link", "local_funding_schemes"], lambda c, name: X.remove_all(c, r"\r|\n"))


def funding_schemes(areas: DataFrame) -> DataFrame:
    """One row per scheme of an area, numbered in sheet order."""
    cells = areas.select("area_id", "area_name", "local_funding_schemes", "_ord")
    rows = explode_delim(cells, "local_funding_schemes", "; ", position="_at")
    numbered = O.add_id(rows.where(F.col("local_funding_schemes").isNotNull()), "id", ["_ord", "_at"])
    return numbered.select("id", "area_id", "area_name", "local_funding_schemes")


def condensed_schemes(schemes: DataFrame) -> DataFrame:
    """Schemes of each area as one text."""
    return O.collapse(schemes, ["area_id"], "local_funding_schemes", "\n", ["id"])


def areas_table(areas: DataFrame, management: DataFrame, creation: DataFrame) -> DataFrame:
    """Areas with their habitat texts."""
    linked = areas.withColumn("area_link", X.replace_all(F.col("area_link"), [("; ", "\n")])).drop("local_funding_schemes")
    return left_join(left_join(linked, management, ["area_id"]), creation, ["area_id"])
