"""What the portal page asks of the published table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators import facets as C
from sheetloom.operators.reshape import explode_delim

# Facets of the page, and the columns of its measures and grants.
FACETS = ("measure_type", "core_supplementary", "stakeholder")
MEASURE = ("priority_id", "biodiversity_priority", "measure", "concise_measure", "measure_id", "link_to_further_guidance")
GRANT = ("grant_id", "grant_name", "url")


def page(slim: DataFrame, refine: C.Refinement) -> dict[str, DataFrame]:
    """Facet counts, measures, grants of each measure, and whether there are grants, under one refinement."""
    return {
        "facets": C.facet_counts(slim, FACETS, refine),
        "measures": C.facet_groups(slim, MEASURE, refine, FACETS),
        "grants": C.facet_details(slim, "measure_id", GRANT, refine),
        "grants_exist": C.facet_exists(slim, "grant_id", refine),
    }


def measure_details(measures: DataFrame, measure_ids: Sequence[int] | None = None, long: bool = False) -> DataFrame:
    """Species and benefits of measures; the long form has one row per species and benefit."""
    rows = measures if measure_ids is None else measures.where(F.col("measure_id").isin(*measure_ids))
    rows = rows.select("measure_id", "species", "benefits")
    return explode_delim(explode_delim(rows, "species", "\n"), "benefits", "\n") if long else rows
