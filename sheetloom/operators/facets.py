"""Refinements and facets of a published table: OR inside a facet, AND between facets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Refinement = Mapping[str, Sequence[Any]]


def set_refinement(refine: Refinement, facet: str, *values: Any) -> dict[str, list[Any]]:
    """Replace one facet's refinement; no values clear it."""
    kept = {name: list(chosen) for name, chosen in refine.items() if name != facet}
    return kept | ({facet: list(values)} if values else {})


def _passes(refine: Refinement, but: str | None = None) -> Column:
    tests = [F.coalesce(F.col(name).isin(*values), F.lit(False)) for name, values in refine.items() if name != but]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def refine_rows(df: DataFrame, refine: Refinement) -> DataFrame:
    """Rows that pass every refined facet."""
    for name, values in refine.items():
        df = df.where(F.col(name).isin(*values))
    return df


def facet_counts(df: DataFrame, facets: Sequence[str], refine: Refinement) -> DataFrame:
    """Rows per facet value, each facet ignoring its own refinement, in one pass.

    The filter of facets that only refine goes to the scan; counts are combined before the shuffle, so
    a value that most rows share is no burden.
    """
    fixed = {name: values for name, values in refine.items() if name not in facets}
    shown = {name: values for name, values in refine.items() if name in facets}
    cells = F.array(*[
        F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value"), _passes(shown, f).alias("_in"))
        for f in facets
    ])
    rows = refine_rows(df, fixed).select(F.inline(cells))
    return (
        rows.where(F.col("value").isNotNull())
        .groupBy("facet", "value")
        .agg(F.count_if(F.col("_in")).alias("n"))
        .where(F.col("n") > 0)
    )


def facet_groups(df: DataFrame, by: Sequence[str], refine: Refinement, needed: Sequence[str] = ()) -> DataFrame:
    """Distinct groups of the refined rows; none unless one of the ``needed`` facets is refined."""
    rows = refine_rows(df, refine)
    if needed and not any(refine.get(name) for name in needed):
        rows = rows.where(F.lit(False))
    return rows.select(*by).distinct()


def facet_details(df: DataFrame, key: str, details: Sequence[str], refine: Refinement) -> DataFrame:
    """Detail rows of every key at once, in place of one query per shown row; null details are left out."""
    return refine_rows(df, refine).select(key, *details).where(F.col(details[0]).isNotNull()).distinct()


def facet_exists(df: DataFrame, col: str, refine: Refinement) -> DataFrame:
    """Whether the refined rows hold any value of a column."""
    found = F.count(F.col(col)) > 0
    return refine_rows(df, refine).agg(found.alias("has_any"))
