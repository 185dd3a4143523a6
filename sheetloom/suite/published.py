"""The flat published table in terms of the test tables, its normal form, and what the portal asks of it."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.operators import facets as C
from sheetloom.operators.checks import compare_tables
from sheetloom.operators.joins import equi_join
from sheetloom.plans import normalise as N
from sheetloom.plans import portal
from sheetloom.plans.measures import SLIM
from sheetloom.session import scratch_path, staged
from sheetloom.sinks.files import read_in_order, write_sorted
from sheetloom.suite.registry import Tables, query

FLAT = """
flat AS (SELECT l_partkey AS measure_id, p_name AS measure, p_type AS measure_type, l_linestatus AS stakeholder,
  CASE WHEN p_retailprice > 1000 THEN 'Core' ELSE 'Supplementary' END AS core_supplementary,
  p_type || ' ' || p_name AS concise_measure,
  o_custkey AS area_id, c_name AS area_name, l_linenumber AS priority_id, 'Priority ' || l_linenumber AS biodiversity_priority,
  CASE WHEN p_size > 25 THEN p_brand END AS grant_id,
  CASE WHEN p_size > 25 THEN p_brand || ': grant' END AS grant_name,
  CASE WHEN p_size > 25 THEN 'https://grants.example/' || lower(p_brand) END AS url,
  CASE WHEN p_size < 40 THEN 'https://guidance.example/' || p_partkey END AS link_to_further_guidance
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""


def part_measures(t: Tables) -> DataFrame:
    """Parts as measures, each with at most one grant."""
    granted = F.col("p_size") > 25
    return t.part.select(
        F.col("p_partkey").alias("measure_id"),
        F.col("p_name").alias("measure"),
        F.col("p_type").alias("measure_type"),
        F.when(F.col("p_retailprice") > 1000, "Core").otherwise("Supplementary").alias("core_supplementary"),
        F.concat_ws(" ", "p_type", "p_name").alias("concise_measure"),
        F.when(granted, F.col("p_brand")).alias("grant_id"),
        F.when(granted, F.concat(F.col("p_brand"), F.lit(": grant"))).alias("grant_name"),
        F.when(granted, F.concat(F.lit("https://grants.example/"), F.lower("p_brand"))).alias("url"),
        F.when(F.col("p_size") < 40, F.concat(F.lit("https://guidance.example/"), F.col("p_partkey").cast("string")))
        .alias("link_to_further_guidance"),
    )


def customer_areas(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("area_id"), F.col("c_name").alias("area_name"))


def flat_source(t: Tables) -> DataFrame:
    """One row per line of an order: part as measure, customer as area, line number as priority."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus")
    placed = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    keyed = placed.select(
        F.col("l_partkey").alias("measure_id"),
        F.col("o_custkey").alias("area_id"),
        F.col("l_linenumber").alias("priority_id"),
        F.concat(F.lit("Priority "), F.col("l_linenumber").cast("string")).alias("biodiversity_priority"),
        F.col("l_linestatus").alias("stakeholder"),
    )
    return equi_join(equi_join(keyed, part_measures(t), ["measure_id"]), customer_areas(t), ["area_id"])


# Refinements as a user of the page might set them, without and with a chosen area.
REFINE = {"measure_type": ["ECONOMY", "PROMO"], "stakeholder": ["F"]}
REFINED = "measure_type IN ('ECONOMY', 'PROMO') AND stakeholder = 'F'"
AREA = "Customer#000000077"


KEYS = ("measure_id", "area_id", "priority_id", "measure_type", "stakeholder", "grant_id")


def core_source(t: Tables) -> DataFrame:
    """The relations of the flat source, written once since many tables are read from them."""
    return staged(flat_source(t).select(*KEYS, "biodiversity_priority"), "flat-source")


def core_tables(t: Tables, source: DataFrame) -> dict[str, DataFrame]:
    """The normal form; measures, areas and grants have published tables of their own."""
    measures = part_measures(t)
    return N.load_core(
        source, measures, customer_areas(t), source.select("priority_id", "biodiversity_priority").distinct(), measures
    )


VIEW = FLAT + """,
map AS (SELECT DISTINCT measure_id, area_id, priority_id FROM flat),
m AS (SELECT DISTINCT measure_id, measure, core_supplementary, link_to_further_guidance, concise_measure FROM flat),
mt AS (SELECT DISTINCT measure_id, measure_type FROM flat), mh AS (SELECT DISTINCT measure_id, stakeholder FROM flat),
mag AS (SELECT DISTINCT measure_id, area_id, priority_id, grant_id FROM flat),
g AS (SELECT DISTINCT grant_id, grant_name, url FROM flat WHERE grant_id IS NOT NULL),
p AS (SELECT DISTINCT priority_id, biodiversity_priority FROM flat), a AS (SELECT DISTINCT area_id, area_name FROM flat),
rebuilt AS (SELECT map.measure_id, m.measure, m.concise_measure, m.core_supplementary, m.link_to_further_guidance,
  mt.measure_type, mh.stakeholder, map.area_id, a.area_name, CAST(map.priority_id AS BIGINT) AS priority_id,
  p.biodiversity_priority, mag.grant_id, g.grant_name, g.url
FROM map LEFT JOIN m USING (measure_id) LEFT JOIN a USING (area_id) LEFT JOIN p USING (priority_id)
LEFT JOIN mt USING (measure_id) LEFT JOIN mh USING (measure_id)
LEFT JOIN mag USING (measure_id, area_id, priority_id) LEFT JOIN g ON mag.grant_id = g.grant_id)"""


@query("star_view", f"WITH {VIEW} SELECT * FROM rebuilt")
def star_view(t: Tables) -> DataFrame:
    N.rebuild(core_tables(t, core_source(t))).select(*SLIM).createOrReplaceTempView("published_slim")
    return t.spark.table("published_slim")


@query("star_view_hot", f"""
WITH {VIEW} SELECT area_id, measure_type, stakeholder, count(*) AS n, count(grant_id) AS granted FROM rebuilt GROUP BY ALL""")
def star_view_hot(t: Tables) -> DataFrame:
    """Rebuilt with the joins that keep hot keys out of the shuffle."""
    wide = N.rebuild_hot(core_tables(t, core_source(t)))
    return wide.groupBy("area_id", "measure_type", "stakeholder").agg(
        F.count(F.lit(1)).alias("n"), F.count("grant_id").alias("granted")
    )


COUNTS = ("measure", "measure_type", "stakeholder", "measure_has_type", "measure_has_stakeholder", "area", "priority",
          "grant_table", "measure_area_priority", "measure_area_priority_grant")


@query("load_normal_form", f"""
WITH {FLAT}
SELECT 'measure' AS table_name, count(*) AS n FROM part
UNION ALL SELECT 'measure_type', count(DISTINCT measure_type) FROM flat
UNION ALL SELECT 'stakeholder', count(DISTINCT stakeholder) FROM flat
UNION ALL SELECT 'measure_has_type', count(DISTINCT (measure_id, measure_type)) FROM flat
UNION ALL SELECT 'measure_has_stakeholder', count(DISTINCT (measure_id, stakeholder)) FROM flat
UNION ALL SELECT 'area', count(*) FROM customer
UNION ALL SELECT 'priority', count(DISTINCT priority_id) FROM flat
UNION ALL SELECT 'grant_table', count(DISTINCT p_brand) FROM part WHERE p_size > 25
UNION ALL SELECT 'measure_area_priority', count(DISTINCT (measure_id, area_id, priority_id)) FROM flat
UNION ALL SELECT 'measure_area_priority_grant', count(DISTINCT (measure_id, area_id, priority_id, coalesce(grant_id, ''))) FROM flat""")
def load_normal_form(t: Tables) -> DataFrame:
    tables = core_tables(t, core_source(t))
    result = None
    for name in COUNTS:
        line = tables[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        result = line if result is None else result.unionByName(line)
    return result


@query("roundtrip_counts", f"""
WITH {VIEW},
s AS (SELECT measure_id, area_id, priority_id, measure_type, stakeholder, grant_id FROM flat),
r AS (SELECT measure_id, area_id, priority_id, measure_type, stakeholder, grant_id FROM rebuilt)
SELECT (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM r) AS rebuilt_rows,
       (SELECT count(*) FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM r)) AS only_source,
       (SELECT count(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM s)) AS only_rebuilt""")
def roundtrip_counts(t: Tables) -> DataFrame:
    source = core_source(t)
    return compare_tables(source, N.rebuild(core_tables(t, source)), KEYS)


@query("published_slim", f"WITH {FLAT} SELECT * FROM flat")
def published_slim(t: Tables) -> DataFrame:
    return flat_source(t).select(*SLIM)


@query("facet_refine", f"WITH {FLAT} SELECT measure_id, area_id, measure_type, stakeholder, grant_id FROM flat WHERE {REFINED}")
def facet_refine(t: Tables) -> DataFrame:
    refined = C.refine_rows(flat_source(t), REFINE)
    return refined.select("measure_id", "area_id", "measure_type", "stakeholder", "grant_id")


@query("facet_counts", f"""
WITH {FLAT}
SELECT 'measure_type' AS facet, measure_type AS value, count(*) AS n FROM flat WHERE stakeholder = 'F' GROUP BY ALL
UNION ALL SELECT 'core_supplementary', core_supplementary, count(*) FROM flat WHERE {REFINED} GROUP BY ALL
UNION ALL SELECT 'stakeholder', stakeholder, count(*) FROM flat WHERE measure_type IN ('ECONOMY', 'PROMO') GROUP BY ALL""")
def facet_counts(t: Tables) -> DataFrame:
    return C.facet_counts(flat_source(t), portal.FACETS, REFINE)


@query("facet_groups", f"""
WITH {FLAT} SELECT DISTINCT priority_id, biodiversity_priority, measure, concise_measure, measure_id, link_to_further_guidance
FROM flat WHERE {REFINED}""")
def facet_groups(t: Tables) -> DataFrame:
    return C.facet_groups(flat_source(t), portal.MEASURE, REFINE, portal.FACETS)


@query("facet_groups_ordered", f"""
WITH {FLAT}, g AS (SELECT DISTINCT priority_id, biodiversity_priority, measure, concise_measure, measure_id, link_to_further_guidance FROM flat WHERE {REFINED})
SELECT row_number() OVER (ORDER BY priority_id, measure_id) AS place, * FROM g""")
def facet_groups_ordered(t: Tables) -> DataFrame:
    """The groups as the page lists them, by priority; files hold them in that order."""
    path = scratch_path(t.spark, "groups")
    order = ["priority_id", "measure_id"]
    write_sorted(C.facet_groups(flat_source(t), portal.MEASURE, REFINE, portal.FACETS), path, order)
    return read_in_order(t.spark, path, order)


@query("facet_details", f"""
WITH {FLAT} SELECT DISTINCT measure_id, grant_id, grant_name, url FROM flat WHERE {REFINED} AND grant_id IS NOT NULL""")
def facet_details(t: Tables) -> DataFrame:
    return C.facet_details(flat_source(t), "measure_id", portal.GRANT, REFINE)


@query("facet_exists", f"WITH {FLAT} SELECT count(grant_id) > 0 AS has_any FROM flat WHERE {REFINED}")
def facet_exists(t: Tables) -> DataFrame:
    return C.facet_exists(flat_source(t), "grant_id", REFINE)


@query("measure_details", """
SELECT doc_id AS measure_id, unnest(string_split(text, chr(10))) AS species, lang AS benefits FROM documents""")
def measure_details(t: Tables) -> DataFrame:
    measures = t.documents.select(F.col("doc_id").alias("measure_id"), F.col("text").alias("species"), F.col("lang").alias("benefits"))
    return portal.measure_details(measures, long=True)


@query("portal_page", f"""
WITH {FLAT}, here AS (SELECT * FROM flat WHERE area_name = '{AREA}')
SELECT 'measures' AS part, count(*) AS n FROM (SELECT DISTINCT priority_id, measure_id FROM here WHERE {REFINED})
UNION ALL SELECT 'grants', count(*) FROM (SELECT DISTINCT measure_id, grant_id FROM here WHERE {REFINED} AND grant_id IS NOT NULL)
UNION ALL SELECT 'facets', (SELECT count(DISTINCT measure_type) FROM here WHERE stakeholder = 'F')
  + (SELECT count(DISTINCT core_supplementary) FROM here WHERE {REFINED})
  + (SELECT count(DISTINCT stakeholder) FROM here WHERE measure_type IN ('ECONOMY', 'PROMO'))
UNION ALL SELECT 'grants_exist', 1""")
def portal_page(t: Tables) -> DataFrame:
    chosen = C.set_refinement(REFINE, "area_name", AREA)
    result = None
    for name, part in portal.page(flat_source(t), chosen).items():
        line = part.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
        result = line if result is None else result.unionByName(line)
    return result


def published_rest(t: Tables) -> dict[str, DataFrame]:
    """Published tables beside the core: parts as species, nations as benefits, regions as habitats."""
    lines = t.lineitem.select("l_partkey", "l_suppkey", "l_linenumber")
    return {
        "species": t.part.select(F.col("p_partkey").alias("species_id"), F.col("p_name").alias("common_name"), F.col("p_type").alias("taxa")),
        "benefits": t.nation.select(F.col("n_nationkey").alias("benefit_id"), F.col("n_name").alias("benefit")),
        "habitat": t.region.select(F.col("r_regionkey").alias("habitat_id"), F.col("r_name").alias("habitat")),
        "area_geom": t.customer.select(F.col("c_custkey").alias("area_id"), F.col("c_name").alias("geo_point_2d"), F.lit(None).cast("string").alias("geo_shape")),
        "area_funding_schemes": t.customer.select(
            F.col("c_custkey").alias("id"), (F.col("c_custkey") + 5).alias("area_id"), F.col("c_name").alias("area_name"), F.col("c_mktsegment").alias("local_funding_schemes")
        ),
        "measure_has_benefits": lines.select(F.col("l_partkey").alias("measure_id"), (F.col("l_suppkey") % 30).alias("benefit_id")).distinct(),
        "measure_has_species": lines.select(F.col("l_partkey").alias("measure_id"), (F.col("l_partkey") + F.col("l_linenumber")).alias("species_id")).distinct(),
        "species_area": t.orders.select((F.col("o_orderkey") % 500).alias("species_id"), F.col("o_custkey").alias("area_id")).distinct(),
        "species_priority": lines.select(F.col("l_partkey").alias("species_id"), (F.col("l_linenumber") + 2).alias("priority_id")).distinct(),
        "habitat_creation_area": t.customer.select(F.col("c_custkey").alias("area_id"), (F.col("c_nationkey") % 7).alias("habitat_id")),
        "habitat_management_area": t.customer.select((F.col("c_custkey") + 3).alias("area_id"), (F.col("c_nationkey") % 5).alias("habitat_id")),
    }


# The same tables in SQL, with the rows that have no parents left out.
WHOLE = {
    "measure": "SELECT DISTINCT measure_id, measure, core_supplementary, link_to_further_guidance, concise_measure FROM parts",
    "measure_type": "SELECT row_number() OVER (ORDER BY measure_type) AS measure_type_id, measure_type FROM (SELECT DISTINCT measure_type FROM flat WHERE measure_type IS NOT NULL)",
    "stakeholder": "SELECT row_number() OVER (ORDER BY stakeholder) AS stakeholder_id, stakeholder FROM (SELECT DISTINCT stakeholder FROM flat WHERE stakeholder IS NOT NULL)",
    "measure_has_type": "SELECT DISTINCT measure_id, measure_type_id FROM flat JOIN measure_type USING (measure_type)",
    "measure_has_stakeholder": "SELECT DISTINCT measure_id, stakeholder_id FROM flat JOIN stakeholder USING (stakeholder)",
    "area": "SELECT c_custkey AS area_id, c_name AS area_name FROM customer",
    "priority": "SELECT DISTINCT priority_id, biodiversity_priority FROM flat",
    "species": "SELECT p_partkey AS species_id, p_name AS common_name, p_type AS taxa FROM part",
    "grant_table": "SELECT DISTINCT grant_id, grant_name, url FROM parts WHERE grant_id IS NOT NULL",
    "measure_area_priority": "SELECT DISTINCT measure_id, area_id, priority_id FROM flat",
    "measure_area_priority_grant": "SELECT DISTINCT measure_id, area_id, priority_id, grant_id FROM flat",
    "species_area_priority": """SELECT a.species_id, a.area_id, p.priority_id FROM (SELECT DISTINCT o_orderkey % 500 AS species_id, o_custkey AS area_id FROM orders) a
      JOIN (SELECT DISTINCT l_partkey AS species_id, l_linenumber + 2 AS priority_id FROM lineitem) p USING (species_id)
      WHERE a.species_id IN (SELECT species_id FROM species) AND p.priority_id IN (SELECT priority_id FROM priority)""",
    "area_geom": "SELECT c_name AS geo_point_2d, c_custkey AS area_id FROM customer",
    "area_funding_schemes": """SELECT c_custkey AS id, c_custkey + 5 AS area_id, c_name AS area_name, c_mktsegment AS local_funding_schemes FROM customer
      WHERE c_custkey + 5 IN (SELECT c_custkey FROM customer)""",
    "benefits": "SELECT n_nationkey AS benefit_id, n_name AS benefit FROM nation",
    "measure_has_benefits": "SELECT DISTINCT l_partkey AS measure_id, l_suppkey % 30 AS benefit_id FROM lineitem WHERE l_suppkey % 30 IN (SELECT n_nationkey FROM nation)",
    "measure_has_species": "SELECT DISTINCT l_partkey AS measure_id, l_partkey + l_linenumber AS species_id FROM lineitem WHERE l_partkey + l_linenumber IN (SELECT p_partkey FROM part)",
    "habitat": "SELECT r_regionkey AS habitat_id, r_name AS habitat FROM region",
    "habitat_creation_area": "SELECT c_custkey AS area_id, c_nationkey % 7 AS habitat_id FROM customer WHERE c_nationkey % 7 IN (SELECT r_regionkey FROM region)",
    "habitat_management_area": "SELECT c_custkey + 3 AS area_id, c_nationkey % 5 AS habitat_id FROM customer WHERE c_custkey + 3 IN (SELECT c_custkey FROM customer)",
}


def _given(name: str) -> list[str]:
    """Columns of a table that the SQL above fills."""
    return [c for c, _ in N.COLUMNS[name] if re.search(rf"(?<!\w){c}\b", WHOLE[name])]


def _content_sql(name: str) -> str:
    """Rows and the sum of a weighted number for each cell: ids as they are, texts by 28 bits of their check sum."""
    texts = {c for c, kind in N.COLUMNS[name] if kind.typeName() == "string"}
    cells = []
    for i, (c, kind) in enumerate(N.COLUMNS[name], start=1):
        if c in _given(name):
            value = f"CAST('0x' || right(md5(CAST({c} AS VARCHAR)), 7) AS BIGINT)" if kind.typeName() == "string" else c
            cells.append(f"coalesce({value}, 0) * {i}")
    return f"SELECT '{name}' AS table_name, count(*) AS n, CAST(sum({' + '.join(cells)}) AS BIGINT) AS content FROM {name}"


PARTS = """
parts AS (SELECT p_partkey AS measure_id, p_name AS measure, CASE WHEN p_retailprice > 1000 THEN 'Core' ELSE 'Supplementary' END AS core_supplementary,
  p_type || ' ' || p_name AS concise_measure, CASE WHEN p_size > 25 THEN p_brand END AS grant_id, CASE WHEN p_size > 25 THEN p_brand || ': grant' END AS grant_name,
  CASE WHEN p_size > 25 THEN 'https://grants.example/' || lower(p_brand) END AS url,
  CASE WHEN p_size < 40 THEN 'https://guidance.example/' || p_partkey END AS link_to_further_guidance FROM part)"""


def _text_number(c: str) -> Column:
    """The last seven hexadecimal digits of the check sum, as a number."""
    return F.conv(F.right(F.md5(F.col(c).cast("binary")), F.lit(7)), 16, 10).cast("long")


@query("load_whole_normal_form", f"WITH {FLAT}, {PARTS}, "
       + ", ".join(f"{name} AS ({sql})" for name, sql in WHOLE.items()) + " " + " UNION ALL ".join(_content_sql(name) for name in WHOLE))
def load_whole_normal_form(t: Tables) -> DataFrame:
    """Rows and content of all twenty tables: ids and check sums of texts, each column with a weight of its own."""
    tables = N.load_rest(core_tables(t, core_source(t)), published_rest(t))
    result = None
    for name in WHOLE:
        terms = [F.coalesce(_text_number(c) if kind.typeName() == "string" else F.col(c), F.lit(0)) * i for i, (c, kind) in enumerate(N.COLUMNS[name], start=1) if c in _given(name)]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        line = tables[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.sum(total).cast("long").alias("content"))
        result = line if result is None else result.unionByName(line)
    return result
