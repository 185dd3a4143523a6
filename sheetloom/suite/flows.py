"""The published tables end to end, on sheets that are built from the test tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.functions.names import clean_name
from sheetloom.operators import ordering as O
from sheetloom.operators import reshape as R
from sheetloom.plans import areas as PA
from sheetloom.plans import grants as PG
from sheetloom.plans import habitats as PH
from sheetloom.plans import images as PI
from sheetloom.plans import measures as PM
from sheetloom.plans import occurrences as PO
from sheetloom.plans import priorities as PP
from sheetloom.plans import project as PJ
from sheetloom.plans import species as PS
from sheetloom.suite.joins import PRIORITIES, priority_matrix
from sheetloom.suite.registry import Tables, query
from sheetloom.suite.text import image_paths


def text(name: str) -> Column:
    return F.col(name).cast("string")


# ---- habitats: names and brands of parts as habitats, sizes as areas


def habitat_sheet(t: Tables, where: str) -> DataFrame:
    sizes = list(range(1, 51))
    parts = t.part.where(where).select(F.concat_ws(" ", "p_name", "p_brand").alias("identifier"), "p_size", "p_partkey")
    order = parts.groupBy("identifier").agg(F.min("p_partkey").alias("_ord"))
    wide = parts.groupBy("identifier").pivot("p_size", sizes).agg(F.count(F.lit(1))).join(order, "identifier")
    marks = [F.when(F.col(f"`{s}`") == 1, "x").when(F.col(f"`{s}`") > 1, "X").alias(f"x{s}") for s in sizes]
    return wide.select("identifier", "_ord", *marks)


HABITATS = """
c AS (SELECT p_name || ' ' || p_brand AS habitat, p_size AS area_id, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS o FROM part WHERE p_retailprice <= 1000),
m AS (SELECT p_name || ' ' || p_brand AS habitat, p_size AS area_id, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS o FROM part WHERE p_retailprice > 1000),
rows AS (SELECT DISTINCT 1 AS s, habitat, area_id, o FROM c UNION ALL SELECT DISTINCT 2, habitat, area_id, o FROM m),
firsts AS (SELECT habitat, min((s, area_id, o)) AS f FROM rows GROUP BY habitat),
dim AS (SELECT row_number() OVER (ORDER BY f) AS habitat_id, habitat FROM firsts)"""


@query("habitat_texts", f"""
WITH {HABITATS} SELECT area_id, string_agg(habitat, ':' || chr(10) ORDER BY o) AS bng_hab_creation FROM rows WHERE s = 1 GROUP BY area_id""", wide=("area_id",))
def habitat_texts(t: Tables) -> DataFrame:
    return PH.habitat_texts(PH.habitat_rows(habitat_sheet(t, "p_retailprice <= 1000")), "bng_hab_creation")


@query("habitats", f"""
WITH {HABITATS}
SELECT CASE s WHEN 1 THEN 'creation' ELSE 'management' END AS sheet, area_id, habitat_id, habitat FROM rows JOIN dim USING (habitat)""", wide=("area_id",))
def habitats(t: Tables) -> DataFrame:
    creation = PH.habitat_rows(habitat_sheet(t, "p_retailprice <= 1000"))
    management = PH.habitat_rows(habitat_sheet(t, "p_retailprice > 1000"))
    tables = PH.habitat_tables(creation, management)
    both = tables["habitat_creation_area"].withColumn("sheet", F.lit("creation")).unionByName(
        tables["habitat_management_area"].withColumn("sheet", F.lit("management"))
    )
    return both.join(tables["habitat"], "habitat_id").select("sheet", "area_id", "habitat_id", "habitat")


# ---- areas: customers


def area_sheet(t: Tables) -> DataFrame:
    number = F.when(F.col("c_acctbal") > 9000, F.lit("to follow")).otherwise(text("c_custkey"))
    schemes = F.when(F.col("c_acctbal") > 0, F.concat("c_mktsegment", F.lit("; \n"), F.lit("zone "), text("c_nationkey"), F.lit("; a fund\r\n")))
    return t.customer.select(
        number.alias("identifier"), F.concat("c_name", F.lit("-east, "), "c_mktsegment").alias("title"),
        F.col("c_mktsegment").alias("brief_narrative"), F.concat(F.lit("https://a.example; \nhttps://b.example/"), text("c_custkey")).alias(
            "links_to_further_info_guidance"), schemes.alias("local_funding_schemes"), F.col("c_custkey").alias("_ord"),
    )


AREAS = """
a AS (SELECT c_custkey AS area_id, c_name || ' - east  ' || c_mktsegment AS area_name, c_mktsegment AS area_description,
  'https://a.example' || chr(10) || 'https://b.example/' || c_custkey AS area_link, c_mktsegment, c_nationkey, c_acctbal FROM customer WHERE c_acctbal <= 9000),
s AS (SELECT area_id, area_name, unnest([1, 2, 3]) AS pos, unnest([c_mktsegment, 'zone ' || c_nationkey, 'a fund']) AS scheme FROM a WHERE c_acctbal > 0)"""


@query("area_funding_schemes", f"""
WITH {AREAS} SELECT row_number() OVER (ORDER BY area_id, pos) AS id, CAST(area_id AS INT) AS area_id, area_name, scheme AS local_funding_schemes FROM s""", wide=("area_id",))
def area_funding_schemes(t: Tables) -> DataFrame:
    return PA.funding_schemes(PA.parsed_areas(area_sheet(t)))


@query("areas", f"""
WITH {AREAS}, c AS (SELECT area_id, string_agg(scheme, chr(10) ORDER BY pos) AS schemes FROM s GROUP BY area_id),
h AS (SELECT c_custkey AS area_id, c_name AS hab FROM customer WHERE c_acctbal > 4000)
SELECT CAST(a.area_id AS INT) AS area_id, area_name, area_description, area_link, h.hab AS bng_hab_mgt, h.hab AS bng_hab_creation, c.schemes AS local_funding_schemes
FROM a LEFT JOIN h ON a.area_id = h.area_id LEFT JOIN c ON a.area_id = c.area_id""", wide=("area_id",))
def areas(t: Tables) -> DataFrame:
    parsed = PA.parsed_areas(area_sheet(t))
    texts = t.customer.where("c_acctbal > 4000").select(F.col("c_custkey").cast("int").alias("area_id"), F.col("c_name").alias("hab"))
    table = PA.areas_table(parsed, texts.withColumnRenamed("hab", "bng_hab_mgt"), texts.withColumnRenamed("hab", "bng_hab_creation"))
    schemes = PA.condensed_schemes(PA.funding_schemes(parsed))
    return table.drop("_ord").join(schemes, "area_id", "left")


# ---- priorities: parts under a header row


@query("priorities", """
SELECT p_partkey + 1 AS _ord, p_type AS theme, p_name AS biodiversity_priority,
       CASE WHEN p_size > 40 THEN NULL ELSE CAST(p_partkey AS INT) END AS priority_id FROM part""", wide=("priority_id",))
def priorities(t: Tables) -> DataFrame:
    code = F.when(F.col("p_size") > 40, F.lit("none")).otherwise(text("p_partkey"))
    rows = t.part.select(F.col("p_type").alias("x1"), code.alias("x2"), F.col("p_name").alias("x3"), (F.col("p_partkey") + 1).alias("_ord"))
    header = t.spark.createDataFrame([("Theme", "Code", "Biodiversity priority", 0)], "x1 string, x2 string, x3 string, _ord bigint")
    return PP.priorities_table(header.unionByName(rows), 0)


@query("priority_areas", """
WITH m AS (SELECT l_partkey AS priority_id, l_linenumber AS area_id FROM lineitem GROUP BY ALL)
SELECT row_number() OVER (ORDER BY priority_id, area_id) AS id, CAST(priority_id AS INT) AS priority_id, area_id FROM m""", wide=("priority_id", "area_id"))
def priority_areas(t: Tables) -> DataFrame:
    wide = line_matrix(t).join(t.part.select("p_partkey", "p_type", "p_name"), "p_partkey")
    sheet = wide.select(F.col("p_type").alias("x1"), text("p_partkey").alias("x2"), F.col("p_name").alias("x3"),
                        *[F.col(f"x{n}").alias(f"a{n}") for n in LINES], F.col("p_partkey").alias("_ord"))
    long = PP.priority_areas(sheet, ["theme", "priority_id", "biodiversity_priority"], LINES)
    return PP.priority_area_bridge(long).select("id", "priority_id", "area_id")


# ---- measures: parts by line number, each line number one area

LINES = [1, 2, 3, 4, 5, 6, 7]


def line_matrix(t: Tables) -> DataFrame:
    """Parts by line number, marked x where such a line exists."""
    wide = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).pivot("l_linenumber", LINES).agg(F.count(F.lit(1)))
    return wide.select("p_partkey", *[F.when(F.col(f"`{n}`") > 0, F.lit("x")).alias(f"x{n}") for n in LINES])


ATTRIBUTES = ["Associated priority code", "Measure", "Core / supplementary", "Measure type", "Stakeholder",
              "Link to further guidance", "Higher tier", "Other funding"]
CELLS = ["higher_tier", "other_funding"]


def measure_sheet(t: Tables) -> DataFrame:
    """Attribute names stand in the first row, which carries no marks."""
    cells = [
        F.when(F.col("p_size") < 49, text("p_size")), F.col("p_name"), F.col("p_type"),
        F.when(F.col("p_size") > 25, F.lit("Land; Water")).otherwise("Land"), F.concat(F.lit("Farmers; "), F.col("p_brand")),
        F.concat(F.lit("https://guide.example/"), text("p_partkey")), F.when(F.col("p_size") > 30, F.concat(F.col("p_brand"), F.lit("\r\n"))),
        F.when(F.col("p_retailprice") > 1000, F.lit("OF1")),
    ]
    rows = line_matrix(t).join(t.part, "p_partkey").select(
        *[c.alias(f"c{i}") for i, c in enumerate(cells)], *[f"x{n}" for n in LINES], (F.col("p_partkey") + 1).alias("_ord")
    )
    names = [*[F.lit(a).alias(f"c{i}") for i, a in enumerate(ATTRIBUTES)], *[F.lit(None).cast("string").alias(f"x{n}") for n in LINES]]
    return rows.unionByName(t.spark.range(1).select(*names, F.lit(0).cast("long").alias("_ord")))


MEASURES = """
sheet AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS measure_id FROM part
  WHERE p_size < 49 AND p_partkey IN (SELECT l_partkey FROM lineitem)),
cells AS (SELECT DISTINCT measure_id, p_size AS priority_id, p_name AS measure, p_type AS core_supplementary, l_linenumber AS area_id,
  CASE WHEN p_size > 25 THEN ['Land', 'Water'] ELSE ['Land'] END AS types, ['Farmers', p_brand] AS holders,
  'https://guide.example/' || p_partkey AS link_to_further_guidance,
  CASE WHEN p_size > 30 THEN CASE WHEN p_retailprice > 1000 THEN [p_brand, 'OF1'] ELSE [p_brand] END
       WHEN p_retailprice > 1000 THEN [NULL, 'OF1'] ELSE [NULL] END AS grants
  FROM sheet JOIN lineitem ON l_partkey = p_partkey),
g1 AS (SELECT * EXCLUDE (grants), unnest(grants) AS grant_id FROM cells),
g2 AS (SELECT * EXCLUDE (holders), unnest(holders) AS stakeholder FROM g1),
split AS (SELECT DISTINCT * EXCLUDE (types), unnest(types) AS measure_type FROM g2)"""


def split_measures(t: Tables) -> DataFrame:
    measures = PM.raw_measures(measure_sheet(t), 0, len(ATTRIBUTES) + 1)
    attributes = ["measure_id", "priority_id", *[clean_name(a) for a in ATTRIBUTES[1:]]]
    return PM.split_grants(PM.area_rows(measures, attributes, [f"x{n}" for n in LINES]), CELLS)


@query("area_measures_split", f"""
WITH {MEASURES} SELECT measure_id, CAST(priority_id AS INT) AS priority_id, measure, core_supplementary, area_id, link_to_further_guidance,
  grant_id, stakeholder, measure_type FROM split""", wide=("priority_id", "area_id"))
def area_measures_split(t: Tables) -> DataFrame:
    return split_measures(t)


WIDE = MEASURES + """,
gr AS (SELECT p_brand AS grant_id, p_brand || ': grant' AS grant_name, CASE WHEN p_brand > 'Brand#2' THEN 'https://g.example/' || p_brand END AS url
  FROM (SELECT DISTINCT p_brand FROM part)),
ar AS (SELECT DISTINCT l_linenumber AS area_id, 'Area ' || l_linenumber AS area_name FROM lineitem WHERE l_linenumber < 7),
pr AS (SELECT DISTINCT p_size AS priority_id, 'Priority ' || p_size AS biodiversity_priority FROM part),
wide AS (SELECT s.*, ar.area_name, pr.biodiversity_priority, gr.grant_name, gr.url, c.p_name || '.' AS concise_measure
  FROM split s LEFT JOIN ar ON s.area_id = ar.area_id LEFT JOIN pr ON s.priority_id = pr.priority_id LEFT JOIN gr ON s.grant_id = gr.grant_id
  LEFT JOIN part c ON s.measure_id = c.p_partkey
  WHERE (s.grant_id IS NOT NULL AND gr.url IS NOT NULL) OR s.grant_id IS NULL)"""


@query("area_measures", f"""
WITH {WIDE} SELECT core_supplementary, measure_type, stakeholder, area_name, area_id, grant_id, CAST(priority_id AS INT) AS priority_id,
  biodiversity_priority, measure, concise_measure, measure_id, link_to_further_guidance, grant_name, url FROM wide""", wide=("area_id", "priority_id"))
def area_measures(t: Tables) -> DataFrame:
    brand = F.col("p_brand")
    grants = t.part.select(brand.alias("grant_id")).distinct().select(
        "grant_id", F.concat("grant_id", F.lit(": grant")).alias("grant_name"), F.lit("HT").alias("grant_scheme"),
        F.lit("").alias("grant_summary"),
        F.when(F.col("grant_id") > "Brand#2", F.concat(F.lit("https://g.example/"), F.col("grant_id"))).alias("url"),
    )
    lines = t.lineitem.where("l_linenumber < 7").select(F.col("l_linenumber").alias("area_id")).distinct()
    areas_table = lines.withColumn("area_name", F.concat(F.lit("Area "), text("area_id")))
    codes = t.part.select(F.col("p_size").alias("priority_id")).distinct()
    named = codes.withColumn("biodiversity_priority", F.concat(F.lit("Priority "), text("priority_id")))
    schemes = lines.withColumn("local_funding_schemes", F.lit("fund"))
    concise = t.part.select(F.col("p_partkey").alias("measure_id"), F.concat("p_name", F.lit(".")).alias("concise_measure"))
    return PM.slim(PM.area_measures(split_measures(t), areas_table, named, grants, schemes, concise))


@query("two_scheme_grants", r"""
WITH r AS (SELECT p_partkey, unnest([upper(p_type[1:2]) || p_size, 'see text']) AS cs, p_size, p_type FROM part),
s AS (SELECT p_partkey, cs, unnest([upper(p_type[1:3]) || p_size, 'n/a']) AS sfi FROM r)
SELECT DISTINCT p_partkey, CASE WHEN regexp_matches(cs, '^[A-Z]{2}\d+$') THEN cs END AS grant_id FROM s
UNION SELECT DISTINCT p_partkey, CASE WHEN regexp_matches(sfi, '^[A-Z]{3}\d+$') THEN sfi END FROM r2""".replace("FROM r2", "FROM s"))
def two_scheme_grants(t: Tables) -> DataFrame:
    def cell(n: int, other: str) -> Column:
        return F.concat(F.upper(F.substring("p_type", 1, n)), text("p_size"), F.lit(f"; {other}"))

    rows = t.part.select("p_partkey", cell(2, "see text").alias("cs"), cell(3, "n/a").alias("sfi"))
    return PM.two_scheme_grants(rows, "cs", "sfi")


@query("linked_grants", f"""
WITH {MEASURES}, gr AS (SELECT DISTINCT p_brand AS grant_id, CASE WHEN p_brand > 'Brand#2' THEN 'https://g.example/' || p_brand END AS url FROM part)
SELECT measure_id, area_id, string_agg(coalesce(url, 'NA'), chr(10) ORDER BY s.grant_id NULLS LAST) AS grant_link
FROM (SELECT DISTINCT measure_id, area_id, grant_id FROM split) s LEFT JOIN gr ON s.grant_id = gr.grant_id GROUP BY ALL""", wide=("area_id",))
def linked_grants(t: Tables) -> DataFrame:
    grants = t.part.select(F.col("p_brand").alias("grant_id")).distinct().withColumn(
        "url", F.when(F.col("grant_id") > "Brand#2", F.concat(F.lit("https://g.example/"), F.col("grant_id")))
    )
    rows = split_measures(t).select("measure_id", "area_id", "grant_id").distinct()
    return PM.linked_grants(rows, grants, ["measure_id", "area_id"])


@query("older_measures", r"""
WITH raw AS (SELECT 1 AS sheet, p_partkey, p_name AS measure, CASE WHEN p_size > 45 THEN NULL ELSE p_type END AS ambition, p_brand,
    p_size, p_retailprice FROM part
  UNION ALL SELECT 2, s_suppkey, s_name, 'SMALL', 'Brand#0', s_nationkey, s_acctbal FROM supplier),
n AS (SELECT *, row_number() OVER (ORDER BY sheet, p_partkey) AS measure_id FROM raw),
z AS (SELECT *, unnest(['Farmers', 'Owners']) AS stakeholder_type, unnest(CASE WHEN p_size > 20 THEN ['AB1', 'CD22'] ELSE ['PH1', 'PH1'] END) AS cs FROM n),
p AS (SELECT *, unnest([p_size, p_size + 1]) AS priority_id FROM z),
a AS (SELECT *, unnest([1, 2]) AS area_id FROM p)
SELECT measure_id, measure, ambition, stakeholder_type, CAST(area_id AS INT) AS area_id, CAST(priority_id AS INT) AS priority_id, 'countryside_stewardship' AS grant_scheme, cs AS link_or_code FROM a
UNION ALL SELECT measure_id, measure, ambition, stakeholder_type, CAST(area_id AS INT), CAST(priority_id AS INT), 'sfi', p_brand FROM a WHERE sheet = 1""", wide=("area_id", "priority_id"))
def older_measures(t: Tables) -> DataFrame:
    stewardship = F.when(F.col("size") > 20, F.lit("AB1 and text; CD22")).otherwise("see text")

    def sheet(df: DataFrame, measure: str, sfi: Column) -> DataFrame:
        return df.select(
            F.col("name").alias(measure), F.lit("Farmers; Owners").alias("stakeholder"), "level_of_ambition", F.lit("N/A").alias("land_type"),
            stewardship.alias("countryside_stewardship"), sfi.alias("sfi"), F.lit(None).cast("string").alias("woodland"),
            F.lit(None).cast("string").alias("other"), text("size").alias("associated_priority_1"),
            (F.col("size") + 1).cast("string").alias("associated_priority_2"), F.lit("1; 2").alias("associated_area_codes"),
            F.lit("guide").alias("link_to_further_guidance"), "_ord",
        )

    parts = t.part.select(
        F.col("p_name").alias("name"), F.when(F.col("p_size") > 45, "N/A").otherwise(F.col("p_type")).alias("level_of_ambition"),
        F.col("p_size").alias("size"), F.col("p_partkey").alias("_ord"), "p_brand",
    )
    suppliers = t.supplier.select(
        F.col("s_name").alias("name"), F.lit("SMALL").alias("level_of_ambition"), F.col("s_nationkey").alias("size"), F.col("s_suppkey").alias("_ord")
    )
    rows = PM.older_measures(
        sheet(parts, "recommended_measures", F.col("p_brand")), sheet(suppliers, "recommended_measure", F.lit(None).cast("string"))
    )
    return rows.select("measure_id", "measure", "ambition", "stakeholder_type", "area_id", "priority_id", "grant_scheme", "link_or_code")


# ---- benefits and species of measures: customers by order priority, and by line number


BENEFITS = """
b AS (SELECT DISTINCT o_custkey AS measure_id, CAST(o_orderpriority[1] AS INT) AS benefit_id, o_orderpriority AS benefit FROM orders)"""


@query("measure_benefits", f"WITH {BENEFITS} SELECT measure_id, string_agg(benefit, chr(10) ORDER BY benefit_id) AS benefits FROM b GROUP BY measure_id")
def measure_benefits(t: Tables) -> DataFrame:
    names = PM.benefits_table(t.spark, PRIORITIES)
    ids = {clean_name(p): i for i, p in enumerate(PRIORITIES, start=1)}
    sheet = priority_matrix(t).withColumnRenamed("o_custkey", "measure_id")
    return PM.collapsed_names(PM.bridge_by_header(sheet, ids, "benefit_id"), names, "benefit_id", "benefit", "benefits")


@query("measures", f"""
WITH {BENEFITS}, g AS (SELECT measure_id, string_agg(benefit, chr(10) ORDER BY benefit_id) AS benefits FROM b GROUP BY measure_id),
s AS (SELECT o_custkey AS measure_id, string_agg(n, chr(10) ORDER BY n) AS species FROM (
  SELECT DISTINCT o_custkey, 'Species ' || l_linenumber AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P') GROUP BY ALL)
SELECT c_custkey AS measure_id, c_name AS measure, g.benefits, s.species, c_mktsegment AS concise_measure
FROM customer JOIN g ON c_custkey = g.measure_id LEFT JOIN s ON c_custkey = s.measure_id""")
def measures(t: Tables) -> DataFrame:
    partial = t.orders.where("o_orderstatus = 'P'").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    wide = partial.groupBy(F.col("o_custkey").alias("measure_id")).pivot("l_linenumber", LINES).agg(F.count(F.lit(1)))
    sheet = wide.select("measure_id", *[F.when(F.col(f"`{n}`") > 0, "X").alias(f"species_{n}") for n in LINES])
    species = t.lineitem.select(F.col("l_linenumber").alias("species_id")).distinct().withColumn(
        "common_name", F.concat(F.lit("Species "), text("species_id"))
    )
    bridge = PS.species_measures(sheet, PS.names_table(species))
    base = t.customer.select(F.col("c_custkey").alias("measure_id"), F.col("c_name").alias("measure"))
    concise = t.customer.select(F.col("c_custkey").alias("measure_id"), F.col("c_mktsegment").alias("concise_measure"))
    texts = PM.collapsed_names(bridge, species, "species_id", "common_name", "species")
    return PM.measures_table(base, measure_benefits(t), texts, concise)


# ---- species: parts, with their names as backbone


def species_sheet(t: Tables) -> DataFrame:
    codes = F.concat_ws(", ", text("p_size"), (F.col("p_size") + 7).cast("string"), F.when(F.col("p_size") > 40, F.lit("tbc")))
    return t.part.select(
        F.col("p_partkey").alias("species_id"), F.col("p_type").alias("taxa"), F.col("p_name").alias("species"),
        F.concat_ws(" ", "p_brand", "p_type").alias("linnaean_name"), codes.alias("relevant_priorities"),
        F.lit("guide").alias("link_to_further_guidance"), F.col("p_partkey").alias("_ord"),
    )


def species(t: Tables) -> DataFrame:
    known = t.part.where("p_size > 5").groupBy(F.concat_ws(" ", "p_brand", "p_type").alias("canonical_name")).agg(
        F.min("p_partkey").alias("usage_key"), F.upper(F.min("p_name")).alias("scientific_name")
    )
    metadata = known.select(text("usage_key").alias("usage_key"), F.lit("a").alias("amended_file_name"), F.lit("b").alias("full_file_path"),
                            F.lit("by").alias("license"), F.col("scientific_name").alias("attribution"))
    urls = known.where("usage_key > 20").select(text("usage_key").alias("usage_key"), F.concat(F.lit("https://i.example/"), text("usage_key")).alias("urls"))
    return PS.species_table(species_sheet(t).drop("_ord"), known, PS.image_table(urls, metadata), "https://species.example/")


SPECIES = """
k AS (SELECT p_brand || ' ' || p_type AS canonical_name, min(p_partkey) AS usage_key, upper(min(p_name)) AS scientific_name FROM part WHERE p_size > 5 GROUP BY ALL),
sp AS (SELECT p_partkey AS species_id, p_type AS taxa, p_name AS common_name, p_brand || ' ' || p_type AS linnaean_name, 'guide' AS species_link, usage_key, scientific_name,
  'https://species.example/' || usage_key AS gbif_species_url, CASE WHEN usage_key > 20 THEN 'https://i.example/' || usage_key END AS image_url,
  CASE WHEN usage_key > 20 THEN 'by' END AS license, CASE WHEN usage_key > 20 THEN scientific_name END AS attribution, p_size
  FROM part JOIN k ON p_brand || ' ' || p_type = canonical_name),
spp AS (SELECT p_partkey AS species_id, unnest(CASE WHEN p_size > 40 THEN [1, 2, 3] ELSE [1, 2] END) AS pos,
  unnest(CASE WHEN p_size > 40 THEN [p_size, p_size + 7, NULL] ELSE [p_size, p_size + 7] END) AS priority_id FROM part),
spa AS (SELECT DISTINCT l_partkey AS species_id, l_linenumber AS area_id FROM lineitem)"""


@query("species", f"WITH {SPECIES} SELECT * EXCLUDE (p_size) FROM sp")
def species_query(t: Tables) -> DataFrame:
    return species(t)


@query("species_priority", f"""
WITH {SPECIES} SELECT row_number() OVER (ORDER BY species_id, pos) AS id, CAST(priority_id AS INT) AS priority_id, species_id FROM spp""", wide=("priority_id",))
def species_priority(t: Tables) -> DataFrame:
    return PS.species_priority(species_sheet(t))


def species_area_sheet(t: Tables) -> DataFrame:
    return line_matrix(t).select(text("p_partkey").alias("x1"), F.lit("name").alias("identifier"),
                                 *[F.col(f"x{n}").alias("x1_2" if n == 1 else f"x{n}") for n in LINES],
                                 (F.col("p_partkey") + 1).alias("_ord"))


@query("species_area", f"""
WITH {SPECIES} SELECT row_number() OVER (ORDER BY a.area_id, a.species_id) AS id, CAST(a.species_id AS INT) AS species_id, a.area_id,
  'Area ' || a.area_id AS area_name, sp.common_name, sp.scientific_name, sp.gbif_species_url, sp.species_link, sp.image_url
FROM spa a LEFT JOIN sp ON a.species_id = sp.species_id""", wide=("species_id", "area_id"))
def species_area(t: Tables) -> DataFrame:
    bridge = PS.species_area(species_area_sheet(t), 0)
    names = t.lineitem.select(F.col("l_linenumber").alias("area_id")).distinct().withColumn("area_name", F.concat(F.lit("Area "), text("area_id")))
    return PS.enriched(bridge, species(t), names, "area_id", [*PS.SHOWN, "image_url"])


@query("species_priority_area", f"""
WITH {SPECIES} SELECT sp.species_id, sp.common_name, CAST(p.priority_id AS INT) AS priority_id, a.area_id FROM sp
LEFT JOIN spp p ON sp.species_id = p.species_id LEFT JOIN spa a ON sp.species_id = a.species_id""", wide=("priority_id", "area_id"))
def species_priority_area(t: Tables) -> DataFrame:
    codes = t.part.select(F.col("p_size").alias("priority_id")).distinct().withColumn("theme", F.lit("t"))
    lines = t.lineitem.select(F.col("l_linenumber").alias("area_id")).distinct().withColumn("area_name", text("area_id"))
    rows = PS.species_priority_area(
        species(t), PS.species_priority(species_sheet(t)), PS.species_area(species_area_sheet(t), 0), codes, lines
    )
    return rows.select("species_id", "common_name", "priority_id", "area_id")


@query("species_of_one", f"""
WITH {SPECIES}, rows AS (SELECT sp.species_id, sp.common_name, p.priority_id, a.area_id FROM sp
  LEFT JOIN spp p ON sp.species_id = p.species_id LEFT JOIN spa a ON sp.species_id = a.species_id)
SELECT DISTINCT 'area 3' AS listed_for, common_name FROM rows WHERE area_id = 3
UNION ALL SELECT DISTINCT 'priority 12', common_name FROM rows WHERE priority_id = 12""")
def species_of_one(t: Tables) -> DataFrame:
    """Species of one area, and of one priority."""
    rows = species_priority_area(t)
    area, priority = PS.species_of(rows, "area_id", 3), PS.species_of(rows, "priority_id", 12)
    return area.select(F.lit("area 3").alias("listed_for"), "common_name").unionByName(priority.select(F.lit("priority 12").alias("listed_for"), "common_name"))


# ---- grants: scraped headings, funds, listings, code lists


@query("grants", r"""
WITH h AS (SELECT 1 AS s, p_partkey AS page, 'CPHT' AS grant_scheme, upper(p_type) AS grant_id,
    'https://grants.example/apply/country-park-higher-tier#' || lower(p_type) || '-' || replace(p_name, ' ', '-') AS url,
    upper(p_type) || ': ' || upper(p_name[1:1]) || p_name[2:] AS grant_name FROM part WHERE p_size <= 40),
f AS (SELECT 2, s_suppkey, NULL, 'OF' || s_suppkey, CASE WHEN s_acctbal > 0 THEN 'https://fund.example/' || s_suppkey END,
    'OF' || s_suppkey || ': ' || CASE WHEN s_nationkey > 5 THEN s_name ELSE 'NA' END FROM supplier),
u AS (SELECT * FROM h UNION ALL SELECT * FROM f)
SELECT row_number() OVER (ORDER BY s, page) AS id, grant_scheme, grant_id, url, grant_name,
  'Grant name: ' || grant_name || chr(10) || chr(10) || 'Grant scheme: ' || coalesce(grant_scheme, 'NA') || chr(10) || chr(10)
  || 'Link: <a href=' || coalesce(url, 'NA') || ' target=_blank>' || coalesce(url, 'NA') || '</a>' || chr(10) || chr(10) || 'url: ' || coalesce(url, 'NA') AS grant_summary
FROM u""")
def grants(t: Tables) -> DataFrame:
    slug = F.concat(F.lower("p_type"), F.lit("-"), F.replace("p_name", F.lit(" "), F.lit("-")))
    heading = F.when(F.col("p_size") > 40, F.lit("<h3>no id</h3>")).otherwise(F.concat(F.lit('<h3 id="'), slug, F.lit('">x</h3>')))
    pages = t.part.select(F.lit("https://grants.example/apply/country-park-higher-tier").alias("url"),
                          F.concat(F.lit("<h2>t</h2>"), heading).alias("html"), "p_partkey")
    key = text("s_suppkey")
    sheet = t.supplier.select(
        F.concat(F.lit("OF"), key).alias("code"), F.when(F.col("s_nationkey") > 5, F.col("s_name")).alias("fund_name"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("https://fund.example/"), key)).alias("link"), F.col("s_suppkey").alias("_ord"),
    )
    actions = PG.scraped_actions(pages, "url", "html", "p_partkey")
    # A heading is placed by its page here, and a fund by its line; both orders are one column.
    funds = PG.other_funds(sheet).withColumn("_page", F.col("_ord"))
    return PG.consolidated(actions, funds)


@query("listed_grants", r"""
SELECT p_partkey, upper(p_type[1:2]) || CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) ELSE '' END AS grant_id,
  upper(p_type[1:2]) || CASE WHEN p_size > 25 THEN p_size || ': ' ELSE ' ' END || p_name AS grant_name,
  'https://www.example/grants/' || p_partkey AS url, 'Countryside Stewardship' AS grant_scheme FROM part WHERE p_size > 5""")
def listed_grants(t: Tables) -> DataFrame:
    code = F.concat(F.upper(F.substring("p_type", 1, 2)), F.when(F.col("p_size") > 25, F.concat(text("p_size"), F.lit(": "))).otherwise(" "))
    title = F.when(F.col("p_size") > 5, F.concat(F.lit(" \n"), code, F.col("p_name"), F.lit("  "))).otherwise("Next page")
    links = t.part.select("p_partkey", title.alias("text"), F.concat(F.lit("/grants/"), text("p_partkey")).alias("url"))
    return PG.listed_grants(links, "https://www.example")


@query("stub_grants", r"""
WITH s AS (SELECT p_partkey, p_brand || ': ' || p_name AS grant_name, p_brand AS grant_id, p_name AS summary FROM part)
SELECT p_partkey, grant_name, grant_id, summary, 'SFI' AS grant_scheme, summary AS summary_wrapped,
  'https://find.example/' || lower(replace(replace(grant_name, ': ', '-'), ' ', '-')) AS url FROM s""")
def stub_grants(t: Tables) -> DataFrame:
    items = t.part.select("p_partkey", F.concat("p_brand", F.lit(": "), "p_name").alias("line"))
    return PG.stub_grants(items, "line", "https://find.example").drop("line")


@query("stewardship_grants", """
SELECT 'https://book.example' AS url, p_brand || ': ' || p_name AS grant_name, p_brand AS grant_id, 'Sustainable Farming Initiative' AS grant_scheme,
  CAST(p_size AS VARCHAR) AS annual_payment, p_type[1:1] || lower(p_type[2:]) AS category FROM part""")
def stewardship_grants(t: Tables) -> DataFrame:
    codes = t.part.select(F.col("p_brand").alias("code"), F.col("p_name").alias("sfi_action"), text("p_size").alias("annual_payment"),
                          F.concat(F.lit("Actions for "), "p_type").alias("category"))
    return PG.stewardship_grants(codes, "https://book.example")


@query("grants_with_focus", """
WITH cat AS (SELECT upper(p_type[1:2]) AS prefix, min(p_type) AS meaning FROM part GROUP BY ALL),
g AS (SELECT p_partkey, upper(p_type[1:2]) || p_size AS grant_id, 'https://g.example' AS url, p_name AS grant_name, CASE WHEN p_size > 25 THEN 'Own' END AS own,
  meaning[1:1] || lower(meaning[2:]) AS meaning FROM part LEFT JOIN cat ON upper(p_type[1:2]) = prefix)
SELECT grant_id, row_number() OVER (ORDER BY p_partkey) AS id, url, grant_name, coalesce(own, meaning) AS grant_focus, 'CS' AS grant_scheme,
 'Grant name: ' || grant_name || chr(10) || chr(10) || 'Grant focus: ' || coalesce(own, meaning) || chr(10) || chr(10) || 'Grant scheme: CS' || chr(10) || chr(10)
 || 'Link: <a href=' || url || ' target=_blank>' || url || '</a>' || chr(10) || chr(10) || 'url: ' || url AS grant_summary FROM g""")
def grants_with_focus(t: Tables) -> DataFrame:
    prefix = F.upper(F.substring("p_type", 1, 2))
    codes = t.part.groupBy(prefix.alias("code")).agg(F.min("p_type").alias("meaning")).withColumn("scheme", F.lit(PG.COUNTRYSIDE))
    table = t.part.select(
        F.concat(prefix, text("p_size")).alias("grant_id"), F.lit("https://g.example").alias("url"), F.col("p_name").alias("grant_name"),
        F.when(F.col("p_size") > 25, "Own").alias("category"), F.lit("CS").alias("grant_scheme"), F.col("p_partkey").alias("_ord"),
    )
    return PG.with_focus(table, PG.code_categories(codes), ["_ord"]).drop("_ord")


# ---- occurrences, images, project plan


@query("occurrences", """
SELECT event_id AS taxon_key, user_id AS individual, value AS longitude, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS latitude, CAST(year(ts) AS INT) AS year
FROM events WHERE year(ts) BETWEEN 2019 AND 2024 AND event_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
  AND value >= 5 AND value < 40 AND CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 10 AND CAST(json_extract_string(props, '$.k') AS DOUBLE) < 90""")
def occurrences(t: Tables) -> DataFrame:
    renamed = {"latitude": "decimalLatitude", "longitude": "decimalLongitude"}
    known = {
        "decimalLongitude": F.col("value"), "decimalLatitude": F.get_json_object("props", "$.k").cast("double"),
        "year": F.year("ts"), "taxonKey": F.col("event_id"), "species": text("user_id"),
    }
    archive = t.events.select(*[
        known.get(renamed.get(c, c), F.lit(None).cast("string")).alias(renamed.get(c, c)) for c in PO.PUBLISHED
    ])
    keys = t.orders.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("taxonKey"))
    region = "POLYGON ((5 10, 40 10, 40 90, 5 90, 5 10))"
    found = PO.region_occurrences(archive, keys, region, 2019, 2024)
    return found.select("taxon_key", F.col("species").cast("long").alias("individual"), "longitude", "latitude", "year")


@query("keys_without_files", r"""
WITH f AS (SELECT c_name AS folder FROM customer)
SELECT CAST(nullif(regexp_extract(folder, '[0-9]{7}$'), '') AS INT) AS usage_key FROM f
WHERE folder NOT IN (SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'P')""", wide=("usage_key",))
def keys_without_files(t: Tables) -> DataFrame:
    partial = t.orders.where("o_orderstatus = 'P'")
    files = t.customer.join(partial, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_name").alias("folder"))
    return PI.keys_without_files(t.customer.select(F.col("c_name").alias("folder")), files, "folder")


@query("image_catalogue", """
SELECT replace(p_name, ' ', '_') AS common_name, CASE WHEN p_size > 25 THEN 'BY-NC' ELSE 'by' END AS license, count(*) AS n FROM part GROUP BY ALL""")
def image_catalogue(t: Tables) -> DataFrame:
    catalogue = PI.image_catalogue(image_paths(t), "path", "upload")
    return catalogue.groupBy("common_name", "license").agg(F.count(F.lit(1)).alias("n"))


@query("project_activities", """
WITH p AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'wp ' || user_id END AS wp, event_type AS activity, ts FROM events WHERE event_type <> 'error')
SELECT last_value(wp IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wp, event_id, activity,
  CASE WHEN activity = 'click' THEN '' ELSE 'detail' END AS detail, strftime(ts, '%b %y') AS start_date, CAST(NULL AS VARCHAR) AS end_date FROM p""")
def project_activities(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    sheet = t.events.select(
        F.when(kind == "purchase", F.concat(F.lit("wp "), text("user_id"))).alias("wp"), F.when(kind != "error", kind).alias("activity"),
        F.when(kind != "click", F.lit("detail")).alias("detail"), F.col("ts").alias("start_date"), F.lit(None).cast("string").alias("end_date"),
        F.col("event_id").alias("_ord"),
    )
    activities = PJ.clean_activities(sheet)
    shown = PJ.activity_table(activities.withColumn("activity", F.concat_ws("|", "activity", text("_ord"))))
    return R.separate(shown, "activity", ["activity", "event_id"], "|").withColumn("event_id", F.col("event_id").cast("long"))


@query("project_spots", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS spot_date, upper(o_orderpriority) AS spot_type FROM orders")
def project_spots(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").alias("spot_date"), F.lower("o_orderpriority").alias("spot_type"))
    return PJ.spots(rows)


