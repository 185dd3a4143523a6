"""Species occurrences inside a region."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sheetloom.functions.geometry import polygon_literal
from sheetloom.functions.names import clean_names
from sheetloom.operators import spatial as S

# Columns of an occurrence archive that are published.
PUBLISHED = (
    "modified", "license", "rightsHolder", "institutionCode", "sex", "lifeStage", "eventDate", "year",
    "verbatimLocality", "latitude", "longitude", "scientificName", "kingdom", "phylum", "class", "order", "family",
    "genericName", "lastInterpreted", "taxonKey", "species", "level3Name",
)


def region_occurrences(archive: DataFrame, keys: DataFrame, region_wkt: str, first: int, last: int) -> DataFrame:
    """Published columns, under cleaned names, of the occurrences of listed taxa in a region and years."""
    region = archive.sparkSession.range(1).select(polygon_literal(region_wkt).alias("polygon"))
    found = S.near_occurrences(
        archive, region, keys, "decimalLongitude", "decimalLatitude", "year", first, last, "taxonKey"
    )
    located = found.withColumnsRenamed({"decimalLatitude": "latitude", "decimalLongitude": "longitude"})
    return located.select(*PUBLISHED).toDF(*clean_names(PUBLISHED))
