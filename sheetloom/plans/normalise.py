"""Third normal form: twenty tables from the published ones, and the wide table rebuilt from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.operators import ordering as O
from sheetloom.operators.catalog import apply_schema
from sheetloom.operators.edits import Reference
from sheetloom.operators.joins import equi_join, follow_keys, lookup_join, semi_all
from sheetloom.operators.projection import known_or_null
from sheetloom.session import staged, staged_by, staged_together


def _text(*names: str) -> list[tuple[str, T.DataType]]:
    return [(name, T.StringType()) for name in names]


def _number(*names: str) -> list[tuple[str, T.DataType]]:
    """Ids are 64 bits wide, so that no key of a large table is lost."""
    return [(name, T.LongType()) for name in names]


# The tables, their keys and what they refer to.
COLUMNS: dict[str, list[tuple[str, T.DataType]]] = {
    "measure": _number("measure_id") + _text(
        "measure", "other_priorities_delivered", "core_supplementary", "mapped_unmapped", "relevant_map_layer",
        "link_to_further_guidance", "concise_measure",
    ),
    "measure_type": _number("measure_type_id") + _text("measure_type"),
    "stakeholder": _number("stakeholder_id") + _text("stakeholder"),
    "measure_has_type": _number("measure_id", "measure_type_id"),
    "measure_has_stakeholder": _number("measure_id", "stakeholder_id"),
    "area": _number("area_id") + _text("area_name", "area_description", "area_link", "bng_hab_mgt", "bng_hab_creation"),
    "priority": _number("priority_id") + _text("biodiversity_priority", "simplified_biodiversity_priority", "theme"),
    "species": _text("taxa", "common_name", "assemblage", "species_link", "linnaean_name") + _number("species_id") + _text(
        "usage_key", "scientific_name", "status",
        "kingdom", "phylum", "order", "family", "genus", "species", "kingdom_key", "phylum_key", "class_key",
        "order_key", "family_key", "genus_key", "species_key", "synonym", "class", "accepted_usage_key",
        "verbatim_name",
    ) + [("verbatim_index", T.LongType())] + _text("gbif_species_url", "image_url", "license", "attribution", "photo_url"),
    "grant_table": _text("grant_id", "grant_name", "grant_scheme", "url", "grant_summary"),
    "measure_area_priority": _number("measure_id", "area_id", "priority_id"),
    "measure_area_priority_grant": _number("measure_id", "area_id", "priority_id") + _text("grant_id"),
    "species_area_priority": _number("species_id", "area_id", "priority_id"),
    "area_geom": _text("geo_point_2d", "geo_shape") + _number("area_id"),
    "area_funding_schemes": _number("id", "area_id") + _text("area_name", "local_funding_schemes"),
    "benefits": _number("benefit_id") + _text("benefit"),
    "measure_has_benefits": _number("measure_id", "benefit_id"),
    "measure_has_species": _number("measure_id", "species_id"),
    "habitat": _number("habitat_id") + _text("habitat"),
    "habitat_creation_area": _number("area_id", "habitat_id"),
    "habitat_management_area": _number("area_id", "habitat_id"),
}
PRIMARY: dict[str, tuple[str, ...]] = {
    "measure": ("measure_id",),
    "measure_type": ("measure_type_id",),
    "stakeholder": ("stakeholder_id",),
    "measure_has_type": ("measure_id", "measure_type_id"),
    "measure_has_stakeholder": ("measure_id", "stakeholder_id"),
    "area": ("area_id",),
    "priority": ("priority_id",),
    "species": ("species_id",),
    "grant_table": ("grant_id",),
    "measure_area_priority": ("measure_id", "area_id", "priority_id"),
    "species_area_priority": ("species_id", "area_id", "priority_id"),
    "area_funding_schemes": ("id",),
    "benefits": ("benefit_id",),
    "measure_has_benefits": ("measure_id", "benefit_id"),
    "measure_has_species": ("measure_id", "species_id"),
    "habitat": ("habitat_id",),
    "habitat_creation_area": ("habitat_id", "area_id"),
    "habitat_management_area": ("habitat_id", "area_id"),
}
PARENTS: dict[str, dict[str, tuple[str, ...]]] = {
    "measure_has_type": {"measure": ("measure_id",), "measure_type": ("measure_type_id",)},
    "measure_has_stakeholder": {"measure": ("measure_id",), "stakeholder": ("stakeholder_id",)},
    "measure_area_priority": {"measure": ("measure_id",), "area": ("area_id",), "priority": ("priority_id",)},
    "measure_area_priority_grant": {
        "measure_area_priority": ("measure_id", "area_id", "priority_id"), "grant_table": ("grant_id",),
    },
    "species_area_priority": {"species": ("species_id",), "area": ("area_id",), "priority": ("priority_id",)},
    "area_funding_schemes": {"area": ("area_id",)},
    "measure_has_benefits": {"measure": ("measure_id",), "benefits": ("benefit_id",)},
    "measure_has_species": {"measure": ("measure_id",), "species": ("species_id",)},
    "habitat_creation_area": {"habitat": ("habitat_id",), "area": ("area_id",)},
    "habitat_management_area": {"habitat": ("habitat_id",), "area": ("area_id",)},
}

BRIDGES = {"measure_type": "measure_has_type", "stakeholder": "measure_has_stakeholder"}
SCHEMAS = {name: T.StructType([T.StructField(c, k) for c, k in cols]) for name, cols in COLUMNS.items()}
REFERENCES = [
    Reference(child, parent, tuple((c, c) for c in cols))
    for child, parents in PARENTS.items()
    for parent, cols in parents.items()
]


def owned_values(source: DataFrame, owner: str, cols: Sequence[str]) -> DataFrame:
    """``kind``, ``owner`` and ``value``: what several columns hold, by the column's name, beside an owner and once more without. Null values are left out."""
    cells = [F.struct(F.lit(c).alias("kind"), by.cast("long").alias("owner"), F.col(c).cast("string").alias("value")) for c in cols for by in (F.col(owner), F.lit(None))]
    return source.select(F.inline(F.array(*cells))).where("value IS NOT NULL")


def numbered_values(values: DataFrame, rows: int) -> DataFrame:
    """``id``: the number of each value of a kind by its order, from 1; all kinds in one pass. ``rows`` bounds the values of a kind."""
    if rows > O.TABLE_ROWS:
        return O.row_numbers(values, ["kind"], ["value"], "id", O.TABLE_ROWS)
    return values.withColumn("id", F.row_number().over(Window.partitionBy("kind").orderBy("value")).cast("long"))


def load_core(
    source: DataFrame, measures: DataFrame, areas: DataFrame, priorities: DataFrame, grants: DataFrame, validate: bool = True
) -> dict[str, DataFrame]:
    """The tables behind measures, areas, priorities and grants.

    A fact needs its parents, and a grant fact its triple; a grant is kept where it exists or is missing.
    Without ``validate`` the facts are taken as they come, as in the earlier load.

    The published tables and the values beside measures share one grouping and are written by one job, dimensions and
    bridges by a second one, so later steps know their true size and broadcast what is small. Facts are read from
    ``source``, which should be stored: they are dealt once by their triple, on which triples, grant facts and the
    joins between them all agree.
    """

    def shaped(df: DataFrame, name: str) -> DataFrame:
        return apply_schema(df, SCHEMAS[name])

    first = {
        "measure": shaped(measures, "measure"),
        "area": shaped(areas.where(F.col("area_id").isNotNull()), "area"),
        "priority": shaped(priorities, "priority"),
        "grant_table": shaped(grants.where(F.col("grant_id").isNotNull()), "grant_table"),
        # Types and holders hang on the measure alone: their pairs are few and stand for the facts.
        "owned": owned_values(source.select("measure_id", *BRIDGES).distinct(), "measure_id", list(BRIDGES)),
    }
    counts: dict[str, int] = {}
    tables = staged_together(first, "core", distinct=first.keys() - {"priority"}, counts=counts)
    owned = tables.pop("owned")
    numbered = numbered_values(owned.where("owner IS NULL").select("kind", "value"), counts["owned"])
    linked = equi_join(equi_join(owned, tables["measure"], [("owner", "measure_id")], "left_semi"), numbered, ["kind", "value"])
    bridge = F.coalesce(*[F.when(F.col("kind") == c, F.lit(name)) for c, name in BRIDGES.items()])
    tagged = numbered.select("kind", "id", "value", F.lit(None).cast("long").alias("owner")).unionByName(
        linked.select(bridge.alias("kind"), "id", F.lit(None).cast("string").alias("value"), "owner"))
    second = staged_by(tagged, "kind", [*BRIDGES, *BRIDGES.values()], "dimensions")
    for col, name in BRIDGES.items():
        tables[col] = second[col].select(F.col("id").alias(f"{col}_id"), F.col("value").alias(col))
        tables[name] = second[name].select(F.col("owner").alias("measure_id"), F.col("id").alias(f"{col}_id"))
    keys = ["measure_id", "area_id", "priority_id"]
    rows = shaped(source.select(*keys, "grant_id"), "measure_area_priority_grant").dropna(subset=keys)
    if validate:
        # What holds for a triple holds for its grant facts, so both are tested against the same parents.
        rows = semi_all(rows, [(tables["measure"], ["measure_id"]), (tables["area"], ["area_id"]), (tables["priority"], ["priority_id"])])
    dealt = rows.repartition(*keys)
    tables["measure_area_priority"] = dealt.select(*keys).distinct()
    tables["measure_area_priority_grant"] = known_or_null(dealt.distinct(), "grant_id", tables["grant_table"])
    return tables


def load_rest(core: Mapping[str, DataFrame], published: Mapping[str, DataFrame], validate: bool = True) -> dict[str, DataFrame]:
    """The remaining tables from their published forms, written by one job; rows without their parents are left out.

    Benefits that are repeated as a whole count once.
    """
    tables = dict(core)
    for name in ("species", "benefits", "habitat", "area_geom", "area_funding_schemes",
                 "measure_has_benefits", "measure_has_species", "habitat_creation_area", "habitat_management_area"):
        if name in published:
            tables[name] = apply_schema(published[name], SCHEMAS[name])
    if "species" in tables:
        tables["species"] = tables["species"].where(F.col("species_id").isNotNull())
    if "species_area" in published and "species_priority" in published:
        pairs = equi_join(published["species_area"].select("species_id", "area_id"),
                          published["species_priority"].select("species_id", "priority_id"), ["species_id"],
                          "inner" if validate else "left")
        tables["species_area_priority"] = apply_schema(pairs, SCHEMAS["species_area_priority"])
    if validate:
        for name in published.keys() | {"species_area_priority"}:
            for parent, cols in PARENTS.get(name, {}).items():
                if name in tables and parent in tables:
                    tables[name] = equi_join(tables[name], tables[parent].select(*cols), list(cols), "left_semi")
    rest = {name: df for name, df in tables.items() if name not in core}
    return tables | staged_together(rest, "rest", distinct=rest.keys() & {"benefits"})


Join = Callable[..., DataFrame]


def rebuild(tables: Mapping[str, DataFrame], join: Join = equi_join) -> DataFrame:
    """The wide table: one row per fact, type, stakeholder and grant.

    What belongs to a measure is joined on the measure's side first, and what belongs to a grant on the
    grant's, so the facts go through four joins instead of nine.
    """
    m = tables["measure"].select(
        "measure_id", "measure", "concise_measure", "core_supplementary", "mapped_unmapped", "link_to_further_guidance"
    )
    types = equi_join(tables["measure_has_type"], tables["measure_type"], ["measure_type_id"], "left").drop("measure_type_id")
    holders = equi_join(tables["measure_has_stakeholder"], tables["stakeholder"], ["stakeholder_id"], "left").drop("stakeholder_id")
    measure_side = equi_join(equi_join(m, types, ["measure_id"], "left"), holders, ["measure_id"], "left")
    grant_side = equi_join(tables["measure_area_priority_grant"], tables["grant_table"], ["grant_id"], "left")
    keys = ["measure_id", "area_id", "priority_id"]
    facts = equi_join(tables["measure_area_priority"], grant_side, keys, "left")
    wide = join(facts, tables["area"], ["area_id"], "left")
    wide = join(wide, tables["priority"], ["priority_id"], "left")
    return join(wide, measure_side, ["measure_id"], "left")


def rebuild_hot(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The wide table by joins that keep hot keys out of the shuffle; they are found as the facts are written."""

    triples, frequent = follow_keys(tables["measure_area_priority"], [["area_id"], ["priority_id"], ["measure_id"]], "triples")

    def join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
        return lookup_join(left, right, on, how, frequent=frequent[tuple(on)])

    return rebuild({**tables, "measure_area_priority": triples}, join)


def required_columns(names: Sequence[str]) -> dict[str, list[str]]:
    """Columns that may not be null: keys of bridges and the funding-scheme table."""
    wanted = {"area_funding_schemes": ["area_id", "area_name", "local_funding_schemes"]}
    return {name: cols for name, cols in wanted.items() if name in names}
