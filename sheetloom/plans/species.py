"""Species with backbone names and pictures, and what they are linked with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.functions.names import clean_name_column
from sheetloom.operators import ordering as O
from sheetloom.operators import projection as P
from sheetloom.operators import reshape as R
from sheetloom.operators.joins import equi_join, left_join

# Columns shown with a species.
SHOWN = ("species_id", "common_name", "scientific_name", "gbif_species_url", "species_link")


def image_table(urls: DataFrame, metadata: DataFrame) -> DataFrame:
    """Pictures that have both an address and a catalogue entry."""
    addressed = urls.select(P.as_integer(F.col("usage_key")).alias("usage_key"), F.col("urls").alias("image_url"))
    described = metadata.drop("amended_file_name", "full_file_path").withColumn("usage_key", P.as_integer(F.col("usage_key")))
    return equi_join(addressed, described, ["usage_key"])


def species_table(sheet: DataFrame, backbone: DataFrame, images: DataFrame, base_url: str) -> DataFrame:
    """Species found in the backbone by name, with a picture where there is one."""
    named = P.rename(sheet.drop("relevant_priorities"), {"common_name": "species", "species_link": "link_to_further_guidance"})
    addressed = backbone.withColumn("gbif_species_url", F.concat(F.lit(base_url), F.col("usage_key").cast("string")))
    found = equi_join(named, addressed, [("linnaean_name", "canonical_name")])
    return left_join(found, images.select("usage_key", "image_url", "license", "attribution"), ["usage_key"])


def species_priority(sheet: DataFrame) -> DataFrame:
    """One numbered row per species and priority of its list."""
    cells = sheet.select("species_id", "relevant_priorities", "_ord")
    rows = R.explode_delim(cells, "relevant_priorities", ", ", position="_at")
    keyed = rows.select("species_id", P.as_integer(F.col("relevant_priorities")).alias("priority_id"), "_ord", "_at")
    return O.add_id(keyed, "id", ["_ord", "_at"]).select("id", "priority_id", "species_id")


def species_area(sheet: DataFrame, header_row: int, narrow: bool = False) -> DataFrame:
    """One numbered row per species and marked area, in area order."""
    body = sheet.where((F.col("_ord") > header_row) & F.col("x1").isNotNull())
    cols = [c for c in sheet.columns if c not in ("x1", "identifier", "_ord")]
    read = R.narrow_id if narrow else R.prefixed_id
    long = R.matrix_to_bridge(body, ["x1", "_ord"], cols, "area_id", ("x",), read)
    keyed = long.select(P.as_integer(F.col("x1")).alias("species_id"), "area_id", "_ord")
    return O.add_id(keyed, "id", ["area_id", "_ord"]).select("id", "species_id", "area_id")


def enriched(bridge: DataFrame, species: DataFrame, dimension: DataFrame, key: str, shown: Sequence[str] = SHOWN) -> DataFrame:
    """A species bridge with the columns of its other side and of the species."""
    rows = left_join(bridge, dimension, [key])
    return left_join(rows, species.select(*shown), ["species_id"])


def names_table(species: DataFrame) -> DataFrame:
    """Common names cleaned as column headers are, later copies numbered."""
    cleaned = species.select("common_name", clean_name_column(F.col("common_name")).alias("_clean"), "species_id")
    return O.unique_suffix(cleaned, "_clean", ["species_id"], "clean_name").drop("_clean")


def species_measures(sheet: DataFrame, names: DataFrame) -> DataFrame:
    """Measures and the species they help, with the place of the species' column; a column is one
    species, joined by its cleaned name."""
    cols = [c for c in sheet.columns if c not in ("measure_id", "priority", "measure", "_ord")]
    bridge = R.matrix_to_bridge(sheet, ["measure_id"], cols, "clean_name", position="place")
    return equi_join(bridge, names.select("clean_name", "species_id"), ["clean_name"]).drop("clean_name")


def species_priority_area(
    species: DataFrame, by_priority: DataFrame, by_area: DataFrame, priorities: DataFrame, areas: DataFrame
) -> DataFrame:
    """Every priority and area of each species; species without either keep one row."""
    rows = equi_join(species, by_priority.select("species_id", "priority_id"), ["species_id"], "left")
    rows = equi_join(rows, by_area.select("species_id", "area_id"), ["species_id"], "left")
    rows = left_join(rows, priorities, ["priority_id"])
    return left_join(rows, areas.select("area_id", "area_name"), ["area_id"])


def species_of(rows: DataFrame, col: str, value: int) -> DataFrame:
    """Species listed for one area or one priority."""
    return rows.where(F.col(col) == value).select("common_name").distinct()
