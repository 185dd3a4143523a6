"""Service responses held as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The part of an occurrence record that is read.
RESULTS = (
    "array<struct<rightsHolder: string, "
    "media: array<struct<format: string, identifier: string, license: string>>>>"
)


def plucked(json: Column, schema: str) -> Column:
    """Typed value of a JSON text; null where it does not fit."""
    return F.from_json(json, schema)


def explode_media(df: DataFrame, json: str, keep: Sequence[str]) -> DataFrame:
    """One row per medium of every result, with the result's rights holder and the parent columns."""
    results = df.select(*keep, F.explode(plucked(F.col(json), RESULTS)).alias("_r"))
    media = results.select(*keep, F.col("_r.rightsHolder").alias("rights_holder"), F.explode("_r.media").alias("_m"))
    return media.select(*keep, "rights_holder", "_m.format", "_m.identifier", "_m.license")
