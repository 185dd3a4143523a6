"""Aggregations, nesting and the generic analysis call."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators import aggregate as A
from sheetloom.operators import ordering as O
from sheetloom.suite.projections import labelled
from sheetloom.suite.registry import Tables, query

COLLAPSE = "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id"


@query("agg_collapse", COLLAPSE)
def agg_collapse(t: Tables) -> DataFrame:
    return O.collapse(t.conversations, ["conv_id"], "text", "\n", ["turn"])


@query("agg_collapse_ranged", COLLAPSE)
def agg_collapse_ranged(t: Tables) -> DataFrame:
    """The route that groups of any size take, forced here."""
    return O.collapse(t.conversations, ["conv_id"], "text", "\n", ["turn"], group_rows=0)


@query("agg_collapse_na", """
WITH k AS (SELECT d.source, d.doc_id, CASE WHEN l.quality = 1 THEN 'doc ' || d.doc_id END AS v
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT source, string_agg(coalesce(v, 'NA'), ':' || chr(10) ORDER BY doc_id) AS names,
       string_agg(v, ':' || chr(10) ORDER BY doc_id) AS known FROM k GROUP BY source""")
def agg_collapse_na(t: Tables) -> DataFrame:
    value = F.when(F.col("quality") == 1, F.concat(F.lit("doc "), F.col("doc_id").cast("string")))
    rows = labelled(t).select("source", "doc_id", value.alias("v"))
    named = O.collapse(rows, ["source"], "v", ":\n", ["doc_id"], "names")
    known = O.collapse(rows, ["source"], "v", ":\n", ["doc_id"], "known", na_text=None)
    return named.join(known, "source")


@query("agg_wide_key", """
SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus, year(l_shipdate)::INT AS ship_year,
       string_agg(CAST(l_orderkey AS VARCHAR), chr(10) ORDER BY l_orderkey, l_linenumber) AS grant_link
FROM lineitem GROUP BY ALL""")
def agg_wide_key(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("ship_year", F.year("l_shipdate"))
    keys = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "ship_year"]
    return O.collapse(rows, keys, "l_orderkey", "\n", ["l_orderkey", "l_linenumber"], "grant_link")


@query("agg_distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def agg_distinct(t: Tables) -> DataFrame:
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query("agg_group_all", """
SELECT n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def agg_group_all(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT n_name, c_mktsegment FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY ALL",
        customer=t.customer, nation=t.nation,
    )


COUNTED = ("customer", "documents", "events", "lineitem", "orders", "pages", "part", "supplier")


@query("agg_count", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in COUNTED))
def agg_count(t: Tables) -> DataFrame:
    counts = [getattr(t, n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in COUNTED]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


@query("agg_next_key", "SELECT max(p_partkey) + 1 AS next_key FROM part")
def agg_next_key(t: Tables) -> DataFrame:
    return t.part.agg((F.max("p_partkey") + 1).alias("next_key"))


@query("agg_first", "SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type FROM events GROUP BY user_id")
def agg_first(t: Tables) -> DataFrame:
    return O.first_value(t.events, ["user_id"], "event_type", ["ts", "event_id"], "first_type")


@query("agg_all", """
SELECT 'verdict' AS part, NULL::BIGINT AS doc_id, bool_and(quality = 1) AS holds FROM labels
UNION ALL SELECT 'failing', doc_id, false FROM labels WHERE quality <> 1""")
def agg_all(t: Tables) -> DataFrame:
    verdict, failing = A.all_true(t.labels, F.col("quality") == 1)
    top = verdict.select(F.lit("verdict").alias("part"), F.lit(None).cast("long").alias("doc_id"), F.col("all_true").alias("holds"))
    return top.unionByName(failing.select(F.lit("failing").alias("part"), "doc_id", F.lit(False).alias("holds")))


@query("agg_ratio", """
SELECT l_returnflag, l_linestatus,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / count(l_orderkey) AS y_axis
FROM lineitem WHERE l_shipdate > DATE '1994-01-01' GROUP BY ALL""")
def agg_ratio(t: Tables) -> DataFrame:
    rows = t.lineitem.where("l_shipdate > date'1994-01-01'")
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    return A.ratio(rows, ["l_returnflag", "l_linestatus"], total, F.count("l_orderkey"), "y_axis")


@query("agg_month_year", """
SELECT CAST(month(o_orderdate) AS INT) AS month, CAST(year(o_orderdate) AS INT) AS series,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS y_axis
FROM orders WHERE o_orderdate > DATE '1995-12-31' GROUP BY ALL""")
def agg_month_year(t: Tables) -> DataFrame:
    mean = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    rows = t.orders.where("o_orderdate > date'1995-12-31'")
    return A.month_series(rows, {"y_axis": mean}, F.col("o_orderdate"))


@query("agg_totals", """
SELECT c_mktsegment, count(c_custkey) AS customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS mean_balance,
       grouping(c_mktsegment) = 1 AS is_total
FROM customer GROUP BY ROLLUP (c_mktsegment)""")
def agg_totals(t: Tables) -> DataFrame:
    mean = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    return A.with_totals(t.customer, ["c_mktsegment"], customers=F.count("c_custkey"), mean_balance=mean)


@query("adv_analysis", """
SELECT * FROM (
  SELECT event_type AS x_axis, CAST(month(ts) AS INT) AS series, count(*) AS n, count(DISTINCT user_id) AS users
  FROM events WHERE value > 10 GROUP BY ALL ORDER BY n DESC, x_axis, series LIMIT 20) WHERE x_axis IS NOT NULL""")
def adv_analysis(t: Tables) -> DataFrame:
    return A.analyze(
        t.events,
        select=["count(*) AS n", "count(DISTINCT user_id) AS users"],
        where="value > 10",
        group_by=["event_type AS x_axis", "month(ts) AS series"],
        order_by=["n DESC", "x_axis", "series"],
        limit=20,
    )


@query("adv_analysis_nulls", """
WITH k AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
g AS (SELECT quality, count(*) AS n FROM k GROUP BY quality)
SELECT 'after_limit' AS rule, quality, n FROM (SELECT * FROM g ORDER BY n DESC LIMIT 2) WHERE quality IS NOT NULL
UNION ALL SELECT 'before', quality, n FROM (SELECT * FROM g WHERE quality IS NOT NULL ORDER BY n DESC LIMIT 2)""")
def adv_analysis_nulls(t: Tables) -> DataFrame:
    results = [
        A.analyze(labelled(t), ["count(*) AS n"], None, ["quality"], ["n DESC"], 2, rule).withColumn("rule", F.lit(rule))
        for rule in ("after_limit", "before")
    ]
    return results[0].unionByName(results[1])


@query("nest_unnest", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""")
def nest_unnest(t: Tables) -> DataFrame:
    nested = A.nest(t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"), ["l_suppkey"], nest_rows=100)
    rich = t.supplier.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"))
    return A.unnest(nested.join(rich, "l_suppkey", "left_semi"), ["l_suppkey"])
