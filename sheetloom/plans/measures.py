"""Measures by area and priority, their grants and benefits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.functions import text as X
from sheetloom.functions.names import clean_names
from sheetloom.operators import ordering as O
from sheetloom.operators import projection as P
from sheetloom.operators import reshape as R
from sheetloom.operators.joins import equi_join, left_join
from sheetloom.operators.sets import union_by_name

# The stand-in for a missing grant cell, and what is removed from the joined cells.
PLACEHOLDER = "xxx"
GRANT_NOISE = r"; xxx|\r|\n"
MULTI_SEP = "; "

# Columns of the published slim table.
SLIM = (
    "core_supplementary", "measure_type", "stakeholder", "area_name", "area_id", "grant_id", "priority_id",
    "biodiversity_priority", "measure", "concise_measure", "measure_id", "link_to_further_guidance", "grant_name", "url",
)


def raw_measures(sheet: DataFrame, header_row: int, first_area_column: int = 16) -> DataFrame:
    """Numbered measures: attribute names come from the header row, area columns keep their own."""
    cols = [c for c in sheet.columns if c != "_ord"]
    attributes = cols[: first_area_column - 1]
    named = P.promote_header(sheet, "_ord", header_row, attributes)
    coded = named.where(F.col("associated_priority_code").isNotNull())
    renamed = coded.withColumnRenamed("associated_priority_code", "priority_id")
    return O.add_id(renamed, "measure_id", ["_ord"])


def joined_grants(*cells: Column, drop_placeholder: bool = False) -> Column:
    """Grant cells as one delimited text. The placeholder of a missing first cell stays, as in the
    published table, and later reads as a row without grant; ``drop_placeholder`` removes it too."""
    joined = X.paste(*[F.coalesce(cell, F.lit(PLACEHOLDER)) for cell in cells], sep=MULTI_SEP)
    cleaned = X.remove_all(joined, GRANT_NOISE)
    return F.regexp_replace(cleaned, rf"^{PLACEHOLDER}; ", "") if drop_placeholder else cleaned


def area_rows(measures: DataFrame, attributes: Sequence[str], area_columns: Sequence[str], marks: Sequence[str] = ("x",)) -> DataFrame:
    """One row per measure and marked area."""
    return R.matrix_to_bridge(measures, attributes, area_columns, "area_id", marks, R.prefixed_id)


def split_grants(rows: DataFrame, grant_cells: Sequence[str], drop_placeholder: bool = False) -> DataFrame:
    """One row per grant, stakeholder and type of each measure and area, without repeats."""
    granted = rows.withColumn("grant_id", joined_grants(*[F.col(c) for c in grant_cells], drop_placeholder=drop_placeholder))
    numbered = granted.drop(*grant_cells).withColumn("priority_id", P.as_integer(F.col("priority_id")))
    split = R.explode_chain(numbered, {"grant_id": MULTI_SEP, "stakeholder": MULTI_SEP, "measure_type": MULTI_SEP})
    return split.withColumn("grant_id", X.blank_as_null(F.col("grant_id"), PLACEHOLDER)).distinct()


def area_measures(
    split: DataFrame, areas: DataFrame, priorities: DataFrame, grants: DataFrame, schemes: DataFrame, concise: DataFrame
) -> DataFrame:
    """The wide published table. A missing grant matches a missing one; grants without address are dropped."""
    wide = left_join(split, areas, ["area_id"])
    wide = left_join(wide, priorities, ["priority_id"])
    details = grants.select("grant_id", "grant_name", "grant_scheme", "grant_summary", "url")
    wide = P.without_dead_links(left_join(wide, details, ["grant_id"], null_safe=True))
    wide = left_join(wide, schemes, ["area_id"])
    return left_join(wide, concise, ["measure_id"])


def slim(wide: DataFrame) -> DataFrame:
    return wide.select(*SLIM)


def benefits_table(spark, labels: Sequence[str]) -> DataFrame:
    """Benefits numbered in sheet order, with their cleaned names; the labels are one row of a sheet."""
    rows = [(i, label, name) for i, (label, name) in enumerate(zip(labels, clean_names(labels)), start=1)]
    return spark.createDataFrame(rows, "benefit_id int, benefit string, benefit_name string")


def bridge_by_header(sheet: DataFrame, ids: Mapping[str, int], name: str, marks: Sequence[str] = ("x", "X")) -> DataFrame:
    """Marked cells of a measure sheet, whose columns are cleaned names with an id each."""
    cols = P.columns_where(sheet, names=ids)
    cells = R.matrix_to_bridge(sheet, ["measure_id"], cols, "_header", marks, position="place")
    return R.header_lookup(cells, "_header", ids, name)


def collapsed_names(bridge: DataFrame, names: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """Names behind a measure's ids as one text, in the order of the sheet's columns."""
    rows = left_join(bridge, names.select(key, text), [key])
    return O.collapse(rows, ["measure_id"], text, "\n", ["place", key], name)


def measures_table(base: DataFrame, benefits: DataFrame, species: DataFrame, concise: DataFrame) -> DataFrame:
    """Measures with texts of benefits and species; a measure without benefit is left out, one without
    species stays."""
    rows = equi_join(base, benefits, ["measure_id"])
    return left_join(left_join(rows, species, ["measure_id"]), concise, ["measure_id"])


def two_scheme_grants(rows: DataFrame, first: str, second: str) -> DataFrame:
    """Grants of the two-column layout: codes of two and of three letters, each masked, then stacked."""
    split = R.explode_chain(rows, {first: MULTI_SEP, second: MULTI_SEP})
    masked = split.withColumns({
        "cs_id": X.valid_code(F.col(first), 2), "sfi_id": X.valid_code(F.col(second), 3),
    }).drop(first, second)
    ids = [c for c in masked.columns if c not in ("cs_id", "sfi_id")]
    return R.melt(masked, ids, ["sfi_id", "cs_id"], "_scheme", "grant_id").drop("_scheme").distinct()


def linked_grants(long: DataFrame, grants: DataFrame, by: Sequence[str]) -> DataFrame:
    """Addresses of all grants of a wide key as one text; a missing address reads NA."""
    linked = left_join(long, grants.select("grant_id", "url"), ["grant_id"], null_safe=True)
    return O.collapse(linked, by, "url", "\n", ["grant_id"], "grant_link")


def older_measures(by_area: DataFrame, by_priority: DataFrame) -> DataFrame:
    """Measures of the first layout: two sheets stacked, codes picked out of text, cells split side by
    side, then one row per priority, area and scheme."""
    stacked = union_by_name(by_area.withColumn("_sheet", F.lit(1)), by_priority.withColumn("_sheet", F.lit(2)))
    numbered = O.add_id(stacked, "measure_id", ["_sheet", "_ord"]).drop("_sheet", "_ord")
    cleaned = numbered.withColumns({
        "measure": F.coalesce("recommended_measures", "recommended_measure"),
        "level_of_ambition": X.blank_as_null(F.col("level_of_ambition"), "N/A"),
        "land_type": X.blank_as_null(F.col("land_type"), "N/A"),
        "countryside_stewardship": X.grant_codes(F.col("countryside_stewardship")),
    })
    zipped = R.explode_zip(cleaned, ["stakeholder", "countryside_stewardship", "sfi"], MULTI_SEP)
    priorities = P.columns_where(zipped, prefix="associated_priority")
    kept = [c for c in zipped.columns if c not in priorities and not c.startswith("recommended")]
    long = R.melt(zipped.select(*kept, *priorities), kept, priorities, "_name", "priority_id", drop_nulls=True).drop("_name")
    areas = R.explode_delim(long, "associated_area_codes", MULTI_SEP)
    schemes = ["countryside_stewardship", "sfi", "woodland", "other"]
    ids = [c for c in areas.columns if c not in schemes]
    coded = R.melt(areas, ids, schemes, "grant_scheme", "link_or_code", drop_nulls=True)
    named = P.rename(coded, {
        "ambition": "level_of_ambition", "stakeholder_type": "stakeholder", "area_id": "associated_area_codes",
        "guidance": "link_to_further_guidance",
    })
    first = ("measure_id", "measure", "ambition", "land_type", "stakeholder_type", "area_id", "priority_id", "guidance")
    typed = P.across(named, P.columns_where(named, suffix="_id", dtype=T.StringType), lambda c, name: P.as_integer(c))
    return P.relocate(typed, *first)
