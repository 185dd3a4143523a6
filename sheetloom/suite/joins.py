"""Joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.functions.geometry import parse_polygon
from sheetloom.functions.names import clean_name
from sheetloom.operators import joins as J
from sheetloom.operators import reshape as R
from sheetloom.operators.fuzzy import fuzzy_join, fuzzy_pairs
from sheetloom.operators.spatial import spatial_join
from sheetloom.session import spread
from sheetloom.suite.projections import labelled
from sheetloom.suite.registry import Tables, query


@query("j_inner", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def j_inner(t: Tables) -> DataFrame:
    joined = J.equi_join(t.orders, t.customer, [("o_custkey", "c_custkey")])
    return joined.select("o_orderkey", "o_custkey", "c_name", "c_mktsegment")


@query("j_left", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def j_left(t: Tables) -> DataFrame:
    return J.lookup_join(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


@query("j_nullsafe", """
WITH k AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
g AS (SELECT quality, toxic, count(*) AS n FROM k GROUP BY ALL)
SELECT k.doc_id, k.quality, k.toxic, g.n FROM k LEFT JOIN g
  ON k.quality IS NOT DISTINCT FROM g.quality AND k.toxic IS NOT DISTINCT FROM g.toxic""")
def j_nullsafe(t: Tables) -> DataFrame:
    rows = labelled(t).select("doc_id", "quality", "toxic")
    groups = rows.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))
    return J.lookup_join(rows, groups, ["quality", "toxic"], null_safe=True)


@query("j_composite", """
WITH f AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) AS lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, f.lines FROM lineitem l
LEFT JOIN f USING (l_orderkey, l_partkey, l_suppkey)""")
def j_composite(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    returned = t.lineitem.where("l_returnflag = 'R'").groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))
    return J.equi_join(t.lineitem.select(*keys, "l_linenumber"), returned, keys, "left")


@query("j_many_many", """
WITH area AS (SELECT DISTINCT o_custkey AS area_id, l_partkey AS species_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
priority AS (SELECT DISTINCT l_partkey AS species_id, l_returnflag AS priority FROM lineitem)
SELECT a.species_id, a.area_id, p.priority FROM area a JOIN priority p ON a.species_id = p.species_id
WHERE a.species_id IN (SELECT p_partkey FROM part) AND a.area_id IN (SELECT c_custkey FROM customer)""")
def j_many_many(t: Tables) -> DataFrame:
    area = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("area_id"), F.col("l_partkey").alias("species_id")
    ).distinct()
    priority = t.lineitem.select(F.col("l_partkey").alias("species_id"), F.col("l_returnflag").alias("priority")).distinct()
    pairs = J.equi_join(area, priority, ["species_id"])
    valid = J.semi_all(pairs, [(t.part, [("species_id", "p_partkey")]), (t.customer, [("area_id", "c_custkey")])])
    return valid.select("species_id", "area_id", "priority")


@query("j_using", """
SELECT c_nationkey AS nationkey, c.customers, s.suppliers
FROM (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY ALL) c
LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL) s
  ON c_nationkey = s_nationkey""")
def j_using(t: Tables) -> DataFrame:
    customers = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    rich = t.supplier.where("s_acctbal > 5000")
    suppliers = rich.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    return customers.join(suppliers, on=["nationkey"], how="left")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def priority_matrix(t: Tables) -> DataFrame:
    """Customers by order priority, a cell marked x where there is such an order."""
    wide = t.orders.groupBy("o_custkey").pivot("o_orderpriority", PRIORITIES).agg(F.count(F.lit(1)))
    return wide.select("o_custkey", *[F.when(F.col(f"`{p}`") > 0, F.lit("x")).alias(clean_name(p)) for p in PRIORITIES])


@query("header_lookup", """
SELECT DISTINCT o_custkey, CAST(o_orderpriority[1] AS INT) AS priority_id FROM orders""", wide=("priority_id",))
def header_lookup(t: Tables) -> DataFrame:
    matrix = priority_matrix(t)
    bridge = R.matrix_to_bridge(matrix, ["o_custkey"], matrix.columns[1:], "header")
    ids = {clean_name(name): i for i, name in enumerate(PRIORITIES, start=1)}
    return R.header_lookup(bridge, "header", ids, "priority_id")


@query("j_semi", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 20)
  AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000)""")
def j_semi(t: Tables) -> DataFrame:
    parents = [
        (t.part.where("p_size > 20"), [("l_partkey", "p_partkey")]),
        (t.supplier.where("s_acctbal > 3000"), [("l_suppkey", "s_suppkey")]),
    ]
    return J.semi_all(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), parents)


@query("j_anti", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def j_anti(t: Tables) -> DataFrame:
    return J.equi_join(t.documents.select("doc_id", "source"), t.labels, ["doc_id"], "left_anti")


@query("j_fuzzy", """
WITH a AS (SELECT DISTINCT p_name FROM part), b AS (SELECT DISTINCT upper(p_name) AS wanted FROM part WHERE p_size > 10)
SELECT a.p_name, b.wanted, CAST(levenshtein(lower(a.p_name), lower(b.wanted)) AS INT) AS distance
FROM a, b WHERE levenshtein(lower(a.p_name), lower(b.wanted)) <= 3""")
def j_fuzzy(t: Tables) -> DataFrame:
    names = t.part.select(F.col("p_name").alias("text"))
    wanted = t.part.where("p_size > 10").select(F.upper("p_name").alias("text"))
    pairs = fuzzy_pairs(names, wanted, max_dist=3)
    return pairs.withColumnsRenamed({"left_text": "p_name", "right_text": "wanted"})


@query("j_fuzzy_rows", """
WITH need AS (SELECT p_type || ' ' || p_brand AS wanted, min(p_partkey) AS first_part FROM part GROUP BY ALL)
SELECT p.p_partkey, p.p_name, n.wanted, n.first_part, CAST(levenshtein(lower(p.p_name), lower(n.wanted)) AS INT) AS distance
FROM part p JOIN need n ON abs(len(p.p_name) - len(n.wanted)) <= 9 AND levenshtein(lower(p.p_name), lower(n.wanted)) <= 9""")
def j_fuzzy_rows(t: Tables) -> DataFrame:
    label = F.concat_ws(" ", "p_type", "p_brand")
    need = t.part.groupBy(label.alias("wanted")).agg(F.min("p_partkey").alias("first_part"))
    return fuzzy_join(t.part.select("p_partkey", "p_name"), need, "p_name", "wanted", max_dist=9)


def located(t: Tables) -> DataFrame:
    """Points of the embeddings: first and second component."""
    return t.embeddings.select(
        "vec_id", F.col("label").alias("taxon_key"),
        F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"),
    )


@query("j_spatial", """
WITH pts AS (SELECT event_id, value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y FROM events),
boxes AS (SELECT p_partkey AS area_id, p_size * 2.0 AS x0, (p_retailprice - 900) / 2 AS y0, p_size * 2.0 + p_size / 8.0 AS x1,
          (p_retailprice - 900) / 2 + p_size / 16.0 AS y1 FROM part)
SELECT area_id, event_id FROM pts JOIN boxes ON x >= x0 AND x < x1 AND y >= y0 AND y < y1""")
def j_spatial(t: Tables) -> DataFrame:
    points = t.events.select("event_id", F.col("value").alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y"))
    corner_x, corner_y = F.col("p_size") * 2.0, (F.col("p_retailprice") - 900) / 2
    far_x, far_y = corner_x + F.col("p_size") / 8.0, corner_y + F.col("p_size") / 16.0

    def pair(x, y):
        return F.concat_ws(" ", x.cast("string"), y.cast("string"))

    corners = [pair(corner_x, corner_y), pair(far_x, corner_y), pair(far_x, far_y), pair(corner_x, far_y), pair(corner_x, corner_y)]
    wkt = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *corners), F.lit("))"))
    # Rows are short and parsing takes long; texts are made where they are parsed.
    sized = spread(t.part.select(F.col("p_partkey").alias("area_id"), "p_size", "p_retailprice"))
    areas = sized.select("area_id", parse_polygon(wkt).alias("polygon"))
    return spatial_join(points, areas, "x", "y").select("area_id", "event_id")


@query("j_coalesce", """
SELECT d.doc_id, coalesce(a.toxic, b.quality) AS category, coalesce(a.score, b.score) AS score FROM documents d
LEFT JOIN (SELECT doc_id, toxic, toxic * 10 AS score FROM labels WHERE toxic = 1) a ON d.doc_id = a.doc_id
LEFT JOIN (SELECT doc_id, quality, quality * 20 AS score FROM labels WHERE quality = 1) b ON d.doc_id = b.doc_id""")
def j_coalesce(t: Tables) -> DataFrame:
    toxic = t.labels.where("toxic = 1").select("doc_id", F.col("toxic").alias("category"), (F.col("toxic") * 10).alias("score"))
    good = t.labels.where("quality = 1").select("doc_id", F.col("quality").alias("category"), (F.col("quality") * 20).alias("score"))
    first = J.equi_join(t.documents.select("doc_id"), toxic, ["doc_id"], "left")
    return J.coalesce_join(first, good, ["doc_id"], ["category", "score"])


# Boxes of three regions, each inside the next, as half side lengths.
TIERS = {1: 0.02, 2: 0.08, 3: 0.5}


@query("tiered_fallback", """
WITH p AS (SELECT vec_id, label AS taxon_key, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
r AS (SELECT tier, h FROM (VALUES (1, 0.02), (2, 0.08), (3, 0.5)) v(tier, h)),
f AS (SELECT taxon_key, vec_id, tier FROM p JOIN r ON x >= -h AND x < h AND y >= -h AND y < h)
SELECT taxon_key, vec_id, CAST(tier AS INT) AS tier FROM f
QUALIFY tier = min(tier) OVER (PARTITION BY taxon_key)""")
def tiered_fallback(t: Tables) -> DataFrame:
    def box(h: float) -> str:
        return f"POLYGON (({-h} {-h}, {h} {-h}, {h} {h}, {-h} {h}, {-h} {-h}))"

    regions = t.spark.createDataFrame([(i, box(h)) for i, h in TIERS.items()], "tier int, wkt string")
    polygons = regions.select("tier", parse_polygon(F.col("wkt")).alias("polygon"))
    inside = spatial_join(located(t), polygons, "x", "y").select("taxon_key", "vec_id", "tier")
    return J.tiered_fill(inside, "taxon_key", "tier").select("taxon_key", "vec_id", "tier")
