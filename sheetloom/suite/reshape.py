"""Wide to long, presence matrices and delimited cells."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators import reshape as R
from sheetloom.suite.joins import priority_matrix
from sheetloom.suite.projections import labelled
from sheetloom.suite.registry import Tables, query


@query("r_melt", """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def r_melt(t: Tables) -> DataFrame:
    return R.melt(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "value")


@query("r_melt_nulls", """
WITH k AS (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, 'all' AS kind, name, value FROM (
  SELECT doc_id, 'quality' AS name, quality AS value FROM k UNION ALL SELECT doc_id, 'toxic', toxic FROM k)
UNION ALL
SELECT doc_id, 'filled', name, value FROM (
  SELECT doc_id, 'quality' AS name, quality AS value FROM k UNION ALL SELECT doc_id, 'toxic', toxic FROM k)
WHERE value IS NOT NULL""")
def r_melt_nulls(t: Tables) -> DataFrame:
    rows = labelled(t)
    both = R.melt(rows, ["doc_id"], ["quality", "toxic"], "name", "value").withColumn("kind", F.lit("all"))
    filled = R.melt(rows, ["doc_id"], ["quality", "toxic"], "name", "value", drop_nulls=True).withColumn("kind", F.lit("filled"))
    return both.unionByName(filled)


@query("r_matrix", """
SELECT DISTINCT o_custkey, CAST(o_orderpriority[1] AS INT) AS area_id FROM orders""", wide=("area_id",))
def r_matrix(t: Tables) -> DataFrame:
    matrix = priority_matrix(t)
    return R.matrix_to_bridge(matrix, ["o_custkey"], matrix.columns[1:], "area_id", header_id=R.prefixed_id)


@query("r_explode", """
SELECT p_partkey, unnest(coalesce(string_split(p_name, ' '), [NULL])) AS p_name, p_type FROM part""")
def r_explode(t: Tables) -> DataFrame:
    return R.explode_delim(t.part.select("p_partkey", "p_name", "p_type"), "p_name", " ")


@query("r_explode_outer", """
WITH k AS (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN NULL ELSE d.source || '; ' || d.lang END AS codes
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, unnest(coalesce(string_split(codes, '; '), [NULL])) AS codes FROM k""")
def r_explode_outer(t: Tables) -> DataFrame:
    codes = F.when(F.col("quality").isNotNull(), F.concat_ws("; ", "source", "lang"))
    return R.explode_delim(labelled(t).select("doc_id", codes.alias("codes")), "codes", "; ")


@query("r_explode_zip", """
WITH s AS (SELECT p_partkey, string_split(p_name, ' ') AS n, string_split(p_type || ' ' || p_brand, ' ') AS b, p_brand FROM part)
SELECT p_partkey, unnest(n) AS p_name, unnest(b) AS kind, p_brand FROM s""")
def r_explode_zip(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_name", F.concat_ws(" ", "p_type", "p_brand").alias("kind"), "p_brand")
    return R.explode_zip(rows, ["p_name", "kind", "p_brand"], " ")


@query("r_explode_chain", """
WITH a AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS p_name, p_type || '; ' || p_brand AS grant_id FROM part)
SELECT p_partkey, p_name, unnest(string_split(grant_id, '; ')) AS grant_id FROM a""")
def r_explode_chain(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_name", F.concat_ws("; ", "p_type", "p_brand").alias("grant_id"))
    return R.explode_chain(rows, {"p_name": " ", "grant_id": "; "})


@query("r_separate", """
SELECT o_orderkey, o_orderpriority, string_split(o_orderpriority, '-')[1] AS priority_id,
       string_split(o_orderpriority, '-')[2] AS priority, string_split(o_orderpriority, '-')[3] AS rest FROM orders""")
def r_separate(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return R.separate(rows, "o_orderpriority", ["priority_id", "priority", "rest"], "-", keep=True)


@query("r_enframe", """
SELECT c_custkey, CAST(unnest(range(1, 4)) AS INT) AS benefit_id,
       unnest([c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR)]) AS benefit FROM customer""")
def r_enframe(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return R.enframe(rows, ["c_name", "c_mktsegment", "c_nationkey"], "benefit_id", "benefit")


@query("r_pivot_back", """
SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') > 0 AS x1_urgent,
       count(*) FILTER (o_orderpriority = '5-LOW') > 0 AS x5_low FROM orders GROUP BY o_custkey""")
def r_pivot_back(t: Tables) -> DataFrame:
    return priority_matrix(t).select(
        "o_custkey", F.col("x1_urgent").isNotNull().alias("x1_urgent"), F.col("x5_low").isNotNull().alias("x5_low")
    )
