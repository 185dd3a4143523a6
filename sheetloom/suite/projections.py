"""Column choice, filters and row slices."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.functions import geometry as G
from sheetloom.functions import text as X
from sheetloom.operators import ordering as O
from sheetloom.operators import projection as P
from sheetloom.operators import spatial as S
from sheetloom.suite.registry import Tables, query


@query("slim_view", "SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def slim_view(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")


@query("drop_cols", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def drop_cols(t: Tables) -> DataFrame:
    return t.part.drop("p_size", "p_retailprice")


@query("rename_cols", """
SELECT s_suppkey AS stakeholder_id, s_name AS stakeholder, s_nationkey AS nation, s_acctbal AS balance FROM supplier""")
def rename_cols(t: Tables) -> DataFrame:
    named = P.rename(t.supplier, {"stakeholder_id": "s_suppkey", "stakeholder": "s_name", "balance": "s_acctbal"})
    return P.rename_prefixed(named, "s_nation", "nation")


@query("transmute", """
SELECT p_partkey AS measure_id, p_name AS measure, p_type AS measure_type, p_size > 25 AS is_large FROM part""")
def transmute(t: Tables) -> DataFrame:
    return P.transmute(
        t.part, measure_id=F.col("p_partkey"), measure=F.col("p_name"), measure_type=F.col("p_type"),
        is_large=F.col("p_size") > 25,
    )


@query("relocate", """
SELECT c_mktsegment AS at1_c_mktsegment, c_name AS at2_c_name, c_custkey AS at3_c_custkey,
       c_nationkey AS at4_c_nationkey, c_acctbal AS at5_c_acctbal FROM customer""")
def relocate(t: Tables) -> DataFrame:
    moved = P.relocate(t.customer, "c_mktsegment", "not_there", "c_name")
    return moved.toDF(*[f"at{i}_{name}" for i, name in enumerate(moved.columns, start=1)])


@query("across", """
SELECT l_orderkey, l_linenumber, CAST(round(l_quantity * 100) AS BIGINT) AS l_quantity,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS l_extendedprice,
       CAST(round(l_discount * 100) AS BIGINT) AS l_discount, CAST(round(l_tax * 100) AS BIGINT) AS l_tax
FROM lineitem""")
def across(t: Tables) -> DataFrame:
    cols = P.columns_where(t.lineitem, prefix="l_", dtype=T.DoubleType)
    changed = P.across(t.lineitem, cols, lambda c, name: F.round(c * 100).cast("long"))
    return changed.select("l_orderkey", "l_linenumber", *cols)


@query("clean_names", """
SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS x2_nation, c_acctbal AS balance_percent,
       c_mktsegment AS customer_name_2 FROM customer""")
def clean_names(t: Tables) -> DataFrame:
    messy = t.customer.toDF("Customer Key", "customerName", "2 nation", "Balance %", "Customer  name")
    return P.clean_names(messy)


@query("promote_header", """
SELECT c_custkey + 1 AS _ord, CAST(c_custkey AS VARCHAR) AS customer_no, c_name AS x2_name, c_mktsegment AS segment_percent
FROM customer""")
def promote_header(t: Tables) -> DataFrame:
    """Customers as text under a first row that names the columns."""
    body = t.customer.select(
        F.col("c_custkey").cast("string").alias("x1"), F.col("c_name").alias("x2"), F.col("c_mktsegment").alias("x3"),
        (F.col("c_custkey") + 1).alias("_ord"),
    )
    names = [F.lit(name).alias(f"x{i}") for i, name in enumerate(("Customer no.", "2 Name", "segment %"), start=1)]
    header = t.spark.range(1).select(*names, F.lit(0).cast("long").alias("_ord"))
    return P.promote_header(body.unionByName(header), "_ord", 0)


@query("try_casts", """
SELECT o_orderkey, TRY_CAST(string_split(o_orderpriority, '-')[1] AS BIGINT) AS priority_id,
       TRY_CAST(string_split(o_orderpriority, '-')[2] AS BIGINT) AS not_a_number,
       CASE WHEN regexp_matches(o_orderpriority, '^[0-9]+$') THEN TRY_CAST(o_orderpriority AS BIGINT) END AS whole
FROM orders""")
def try_casts(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        P.as_integer(X.split_take(F.col("o_orderpriority"), "-", 1)).alias("priority_id"),
        P.as_integer(X.split_take(F.col("o_orderpriority"), "-", 2)).alias("not_a_number"),
        P.leading_integer(F.col("o_orderpriority")).alias("whole"),
    )


def labelled(t: Tables) -> DataFrame:
    """Documents with the quality of those that are labelled, as a nullable key."""
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")


@query("f_notnull", """
SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL""")
def f_notnull(t: Tables) -> DataFrame:
    return labelled(t).where(F.col("quality").isNotNull()).select("doc_id", "lang", "quality")


@query("f_range", """
SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 10 AND 30 AND p_type <> 'PROMO' AND p_brand = 'Brand#12'""")
def f_range(t: Tables) -> DataFrame:
    kept = F.col("p_size").between(10, 30) & (F.col("p_type") != "PROMO") & (F.col("p_brand") == "Brand#12")
    return t.part.where(kept).select("p_partkey", "p_name", "p_size")


@query("f_in", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def f_in(t: Tables) -> DataFrame:
    rich = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    urgent = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return urgent.join(rich, "o_custkey", "left_semi").select("o_orderkey", "o_custkey", "o_orderpriority")


@query("f_null_or", """
SELECT d.doc_id, l.quality AS grant_id, l.toxic AS url FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE (l.quality IS NOT NULL AND l.toxic IS NOT NULL) OR l.quality IS NULL""")
def f_null_or(t: Tables) -> DataFrame:
    rows = labelled(t).select("doc_id", F.col("quality").alias("grant_id"), F.col("toxic").alias("url"))
    return P.without_dead_links(rows)


@query("f_regex", "SELECT p_partkey, p_brand FROM part WHERE regexp_matches(p_brand, '^[A-Z][a-z]+#[12][0-9]$')")
def f_regex(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_brand").rlike("^[A-Z][a-z]+#[12][0-9]$")).select("p_partkey", "p_brand")


@query("f_in_or_null", """
SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IN (SELECT quality FROM labels WHERE toxic = 1 AND quality = 1) OR l.quality IS NULL""")
def f_in_or_null(t: Tables) -> DataFrame:
    known = t.labels.where("toxic = 1 AND quality = 1")
    return P.known_or_null(labelled(t).select("doc_id", "quality"), "quality", known)


@query("f_like_date", """
SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE o_orderpriority LIKE '%MED%' AND o_orderdate > DATE '1997-01-01'""")
def f_like_date(t: Tables) -> DataFrame:
    kept = t.orders.where("o_orderpriority LIKE '%MED%' AND o_orderdate > date'1997-01-01'")
    return kept.select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("order_date"))


@query("f_param", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_custkey = 77 AND o_orderstatus = 'O'")
def f_param(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT o_orderkey, o_orderstatus, o_totalprice FROM {orders} WHERE o_custkey = :key AND o_orderstatus = :status",
        args={"key": 77, "status": "O"}, orders=t.orders,
    )


REGION = "POLYGON ((10 0.5, 45 0.5, 70 30, 45 80, 20 60, 10 0.5))"


@query("occ_predicate", """
WITH ring AS (SELECT [{'x':10.0,'y':0.5},{'x':45.0,'y':0.5},{'x':70.0,'y':30.0},{'x':45.0,'y':80.0},{'x':20.0,'y':60.0},{'x':10.0,'y':0.5}] AS r),
pts AS (SELECT event_id, user_id, event_type, value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y, ts FROM events)
SELECT event_id, user_id, x, y FROM pts, ring
WHERE year(ts) BETWEEN 2019 AND 2024 AND event_type IN ('view', 'click')
  AND len(list_filter(range(1, 6), lambda i: (r[i].y > y) <> (r[i+1].y > y)
      AND x < (r[i+1].x - r[i].x) * (y - r[i].y) / nullif(r[i+1].y - r[i].y, 0) + r[i].x)) % 2 = 1""")
def occ_predicate(t: Tables) -> DataFrame:
    points = t.events.select(
        "event_id", "user_id", "event_type", F.col("value").alias("x"), "ts",
        F.get_json_object("props", "$.k").cast("double").alias("y"),
    )
    region = t.spark.range(1).select(G.polygon_literal(REGION).alias("polygon"))
    keys = points.where(F.col("event_type").isin("view", "click")).select("event_type").distinct()
    found = S.near_occurrences(points, region, keys, "x", "y", "ts", 2019, 2024, "event_type")
    return found.select("event_id", "user_id", "x", "y")


@query("mask_codes", """
SELECT p_partkey,
       CASE WHEN regexp_matches(upper(p_type[1:2]) || p_size, '^[A-Z]{2}\\d+$') THEN upper(p_type[1:2]) || p_size END AS cs_id,
       CASE WHEN regexp_matches(p_brand, '^[A-Z]{3}\\d+$') THEN p_brand END AS sfi_id FROM part""".replace("\\\\", "\\"))
def mask_codes(t: Tables) -> DataFrame:
    code = F.concat(F.upper(F.substring("p_type", 1, 2)), F.col("p_size").cast("string"))
    return t.part.select("p_partkey", X.valid_code(code, 2).alias("cs_id"), X.valid_code(F.col("p_brand"), 3).alias("sfi_id"))


@query("slice_rows", """
WITH n AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS _ord FROM customer)
SELECT _ord, c_custkey, c_name FROM n WHERE _ord >= 2""")
def slice_rows(t: Tables) -> DataFrame:
    numbered = O.row_numbers(t.customer.select("c_custkey", "c_name"), [], ["c_custkey"], "_ord")
    return O.slice_rows(numbered, "_ord", 2).select("_ord", "c_custkey", "c_name")
