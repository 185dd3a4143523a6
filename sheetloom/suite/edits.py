"""Catalogue, checks and row edits."""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.operators import catalog as K
from sheetloom.operators import checks as Q
from sheetloom.operators import edits as E
from sheetloom.operators.joins import equi_join
from sheetloom.operators.ordering import add_id, next_key
from sheetloom.session import scratch_path
from sheetloom.sinks.publish import bulk_load, read_published
from sheetloom.suite.projections import labelled
from sheetloom.suite.registry import Tables, query

NAMES = ("customer", "orders", "lineitem", "part", "supplier")


def _stack(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for more in frames[1:]:
        result = result.unionByName(more)
    return result


@query("cat_tables", " UNION ALL ".join(f"SELECT 'listed_{n}' AS table_name, count(*) AS n FROM {n}" for n in NAMES))
def cat_tables(t: Tables) -> DataFrame:
    for name in NAMES:
        getattr(t, name).createOrReplaceTempView(f"listed_{name}")
    listed = [r.table_name for r in K.list_tables(t.spark).where("table_name LIKE 'listed%'").collect()]
    return _stack([t.spark.table(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in listed])


ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
          "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@query("cat_describe", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{k}' AS column_type, count(*) - count({c}) AS nulls FROM orders"
    for i, (c, k) in enumerate(ORDERS.items(), start=1)))
def cat_describe(t: Tables) -> DataFrame:
    """Columns and types, with the number of nulls of each."""
    return K.describe(t.orders).join(Q.check_not_null(t.orders, t.orders.columns), "column_name")


PROFILED = {"doc_id": "bigint", "lang": "string", "source": "string", "quality": "int", "toxic": "int", "score": "double"}


@query("profile", "WITH k AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic, d.n_chars / 8.0 AS score FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) "
       + " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, '{k}' AS column_type, count(*) AS rows, count(*) - count({c}) AS nulls,
  count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS lowest, CAST(max({c}) AS VARCHAR) AS highest,
  list_sort((SELECT list(v ORDER BY md5(v)) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM k WHERE {c} IS NOT NULL))[1:3]) AS samples FROM k"""
                            for c, k in PROFILED.items()))
def profile(t: Tables) -> DataFrame:
    """Bounds of numbers, of which 12 is greater than 9, and the values of least check sum."""
    scores = t.documents.select("doc_id", (F.col("n_chars") / 8).alias("score"))
    return K.profile(equi_join(labelled(t), scores, ["doc_id"]))


SKETCHED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderstatus": "string"}


@query("profile_approximate", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, '{k}' AS column_type, count(*) AS rows, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS lowest,
  CAST(max({c}) AS VARCHAR) AS highest, true AS distinct_near, true AS median_near, true AS samples_held FROM orders""" for c, k in SKETCHED.items()))
def profile_approximate(t: Tables) -> DataFrame:
    """Sketches beside exact figures: distinct values within five errors, medians of a rank near the middle, samples that the column holds."""
    rows = t.orders.select(*SKETCHED)
    guessed = K.profile(rows, approximate=True)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"), (F.col(c).cast("double") if k != "string" else F.lit(None).cast("double")).alias("x")) for c, k in SKETCHED.items()])
    tall = rows.select(F.inline(cells)).join(F.broadcast(guessed.select("column_name", "median", "samples")), "column_name")
    exact = tall.groupBy("column_name").agg(
        F.countDistinct("v").alias("_distinct"), F.avg((F.col("x") < F.col("median")).cast("int")).alias("_below"), F.avg((F.col("x") <= F.col("median")).cast("int")).alias("_upto"),
        F.countDistinct(F.when(F.array_contains("samples", F.col("v")), F.col("v"))).alias("_held"))
    joined = guessed.join(exact, "column_name")
    near = F.abs(F.col("distinct_values") - F.col("_distinct")) <= F.greatest(F.lit(1.0), 5 * K.RSD * F.col("_distinct"))
    middle = F.col("median").isNull() | ((F.col("_below") <= 0.5 + 2 / K.ACCURACY) & (F.col("_upto") >= 0.5 - 2 / K.ACCURACY))
    return joined.select("column_name", "column_type", "rows", "nulls", "lowest", "highest", near.alias("distinct_near"), middle.alias("median_near"),
                         (F.col("_held") == F.size("samples")).alias("samples_held"))


SHOP = {"shop_region": "region", "shop_nation": "nation", "shop_supplier": "supplier", "lookup_part": "part"}
SHOP_PARENTS = {"shop_nation": ["shop_region"], "shop_supplier": ["shop_nation"]}


@query("cat_recreate", """
SELECT 1 AS step, 'shop_supplier' AS table_name, 'dropped' AS state, count(*) AS n FROM supplier
UNION ALL SELECT 2, 'shop_nation', 'dropped', count(*) FROM nation UNION ALL SELECT 3, 'shop_region', 'dropped', count(*) FROM region
UNION ALL SELECT 4, 'lookup_part', 'kept', count(*) FROM part""")
def cat_recreate(t: Tables) -> DataFrame:
    """A database made anew, filled, and its base tables dropped, children before parents; lookup tables are kept."""
    K.recreate_database(t.spark, "shop", scratch_path(t.spark, "shop"))
    lines = []
    for name, source in SHOP.items():
        getattr(t, source).write.saveAsTable(f"shop.{name}")
        lines.append((name, t.spark.table(f"shop.{name}").count()))
    counts = dict(lines)
    base, lookups = K.split_lookups(r.table_name for r in K.list_tables(t.spark, "shop").collect())
    dropped = K.drop_tables(t.spark, [f"shop.{n}" for n in base], {f"shop.{c}": [f"shop.{p}" for p in ps] for c, ps in SHOP_PARENTS.items()})
    left = {r.table_name for r in K.list_tables(t.spark, "shop").collect()}
    steps = [(n.split(".")[1], "dropped" if n.split(".")[1] not in left else "there") for n in dropped] + [(n, "kept" if n in left else "gone") for n in lookups]
    t.spark.sql("DROP DATABASE shop CASCADE")
    return t.spark.createDataFrame([(i, n, s, counts[n]) for i, (n, s) in enumerate(steps, start=1)], "step int, table_name string, state string, n bigint")


@query("schema_apply", """
SELECT CAST(o_custkey AS INT) AS area_id, CAST(o_orderkey AS VARCHAR) AS area_name, TRY_CAST(o_orderpriority AS INT) AS priority_id,
       CAST(NULL AS VARCHAR) AS area_link FROM orders""")
def schema_apply(t: Tables) -> DataFrame:
    schema = T.StructType.fromDDL("area_id int, area_name string, priority_id int, area_link string")
    rows = t.orders.select(F.col("o_orderkey").alias("area_name"), F.col("o_custkey").alias("area_id"),
                           F.col("o_orderpriority").alias("priority_id"), "o_totalprice")
    return K.apply_schema(rows, schema)


# Fixed value: a portal record schema, as the portal states it.
RECORD = json.dumps({"type": "object", "properties": {"fields": {"type": "object", "properties": {
    "p_partkey": {"type": "integer"}, "p_name": {"type": "string"}, "p_size": {"type": "integer"},
    "p_retailprice": {"type": "string"}, "p_comment": {"type": "string"},
}}}})


@query("schema_conform", """
SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice, CAST(NULL AS VARCHAR) AS p_comment
FROM part""")
def schema_conform(t: Tables) -> DataFrame:
    return K.conform(t.part, K.record_schema(RECORD))


@query("schema_report", """
SELECT column_name, wanted, found, state, CASE WHEN found IS NOT NULL THEN (SELECT count(*) - count(p_partkey) FROM part) END AS nulls FROM (VALUES
  ('p_partkey', 'bigint', 'bigint', 'ok'), ('p_name', 'string', 'string', 'ok'), ('p_size', 'bigint', 'int', 'wrong type'),
  ('p_retailprice', 'string', 'double', 'wrong type'), ('p_comment', 'string', NULL, 'missing'),
  ('p_brand', NULL, 'string', 'extra'), ('p_type', NULL, 'string', 'extra')) v(column_name, wanted, found, state)""")
def schema_report(t: Tables) -> DataFrame:
    nulls = Q.check_not_null(t.part, t.part.columns)
    return K.conformity(t.part, K.record_schema(RECORD)).join(nulls, "column_name", "left")


@query("check_pk", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def check_pk(t: Tables) -> DataFrame:
    return Q.check_key(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("check_fk", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def check_fk(t: Tables) -> DataFrame:
    solvent = t.customer.where("c_acctbal > 0")
    return Q.check_reference(t.orders.select("o_orderkey", "o_custkey"), solvent, [("o_custkey", "c_custkey")])


@query("check_fk_composite", """
SELECT l.l_partkey, l.l_suppkey, l.l_returnflag, count(*) AS n FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_linestatus = 'F' AND f.l_partkey = l.l_partkey
                  AND f.l_suppkey = l.l_suppkey AND f.l_returnflag = l.l_returnflag) GROUP BY ALL""")
def check_fk_composite(t: Tables) -> DataFrame:
    keys = ["l_partkey", "l_suppkey", "l_returnflag"]
    return Q.orphan_keys(t.lineitem, t.lineitem.where("l_linestatus = 'F'").select(*keys), keys)


@query("check_not_null", """
WITH k AS (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS nulls FROM k UNION ALL SELECT 'quality', count(*) - count(quality) FROM k
UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM k""")
def check_not_null(t: Tables) -> DataFrame:
    return Q.check_not_null(labelled(t), ["doc_id", "quality", "toxic"])


@query("c_insert_distinct", """
WITH d AS (SELECT row_number() OVER (ORDER BY p_type) AS type_id, p_type FROM (SELECT DISTINCT p_type FROM part WHERE p_size > 49 AND p_retailprice > 1050)),
n AS (SELECT DISTINCT p_type FROM part WHERE p_type NOT IN (SELECT p_type FROM d))
SELECT type_id, p_type FROM d UNION ALL
SELECT (SELECT coalesce(max(type_id), 0) FROM d) + row_number() OVER (ORDER BY p_type), p_type FROM n""")
def c_insert_distinct(t: Tables) -> DataFrame:
    known = t.part.where("p_size > 49 AND p_retailprice > 1050").select("p_type").distinct()
    return E.insert_distinct(add_id(known, "type_id", ["p_type"]), t.part, "type_id", ["p_type"])


@query("c_insert_by_name", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL
SELECT s_suppkey + (SELECT max(c_custkey) + 1 FROM customer), s_name, s_nationkey, NULL, NULL FROM supplier""")
def c_insert_by_name(t: Tables) -> DataFrame:
    start = next_key(t.customer, "c_custkey")
    rows = t.supplier.select(
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_name").alias("c_name"), (F.col("s_suppkey") + start).alias("c_custkey")
    )
    return E.insert_by_name(t.customer, rows, ["c_custkey"])


@query("c_insert_values", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT (SELECT max(s_suppkey) + 1 FROM supplier), 'New supplier', NULL, 12.5""")
def c_insert_values(t: Tables) -> DataFrame:
    key = next_key(t.supplier, "s_suppkey")
    return E.insert_values(t.supplier, {"s_name": "New supplier", "s_suppkey": key, "s_acctbal": 12.5}, ["s_suppkey"])


@query("c_update", """
WITH ch AS (SELECT s_suppkey, upper(s_name) AS s_name, CASE WHEN s_acctbal > 5000 THEN 0.0 END AS s_acctbal FROM supplier WHERE s_nationkey < 10)
SELECT s.s_suppkey, coalesce(ch.s_name, s.s_name) AS s_name, s.s_nationkey, coalesce(ch.s_acctbal, s.s_acctbal) AS s_acctbal
FROM supplier s LEFT JOIN ch ON s.s_suppkey = ch.s_suppkey""")
def c_update(t: Tables) -> DataFrame:
    changes = t.supplier.where("s_nationkey < 10").select(
        "s_suppkey", F.upper("s_name").alias("s_name"), F.when(F.col("s_acctbal") > 5000, 0.0).alias("s_acctbal")
    )
    return E.update_by_key(t.supplier, changes, ["s_suppkey"])


@query("c_delete", "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def c_delete(t: Tables) -> DataFrame:
    keys = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return E.delete_by_key(t.customer, keys)


CHAIN = [
    E.Reference("orders", "customer", (("o_custkey", "c_custkey"),)),
    E.Reference("lineitem", "orders", (("l_orderkey", "o_orderkey"),)),
]


@query("c_cascade", """
WITH c AS (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'), o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
SELECT 'customer' AS table_name, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM c
UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM o
UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM l""")
def c_cascade(t: Tables) -> DataFrame:
    tables = {"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem}
    keys = t.customer.where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    left = E.delete_cascade(tables, CHAIN, "customer", keys)
    firsts = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}
    return _stack([
        left[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n"), F.sum(k).alias("keys")) for n, k in firsts.items()
    ])


@query("c_upsert", """
SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_size > 40 THEN 0 ELSE p_size END AS p_size, p_retailprice FROM part
UNION ALL SELECT p_partkey + (SELECT max(p_partkey) + 1 FROM part), NULL, NULL, NULL, 0, NULL FROM part WHERE p_size < 3""")
def c_upsert(t: Tables) -> DataFrame:
    changed = t.part.where("p_size > 40").select("p_partkey", F.lit(0).alias("p_size"))
    start = next_key(t.part, "p_partkey")
    new = t.part.where("p_size < 3").select((F.col("p_partkey") + start).alias("p_partkey"), F.lit(0).alias("p_size"))
    return E.upsert(t.part, changed.unionByName(new), ["p_partkey"])


@query("c_bulk_load", """
SELECT 'customer' AS table_name, 'key(c_custkey)' AS rule, (SELECT count(*) - count(DISTINCT c_custkey) FROM customer) AS violations
UNION ALL SELECT 'orders', 'key(o_orderkey)', (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders)
UNION ALL SELECT 'lineitem', 'key(l_orderkey,l_linenumber)',
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'reference(o_custkey)->customer', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'lineitem', 'reference(l_orderkey)->orders', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'orders', 'not null(o_custkey)', (SELECT count(*) FROM orders WHERE o_custkey IS NULL)
UNION ALL SELECT 'published', 'accepted', 0""")
def c_bulk_load(t: Tables) -> DataFrame:
    """The line items break their key, so the load is refused and nothing is published."""
    tables = {"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem}
    primary = {"customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]}
    root = scratch_path(t.spark, "publish")
    sound, report = bulk_load(t.spark, root, 1, tables, primary, CHAIN, {"orders": ["o_custkey"]})
    verdict = t.orders.agg(F.lit("published").alias("table_name"), F.lit("accepted").alias("rule"),
                           (F.count(F.lit(1)) * 0 + int(sound)).alias("violations"))
    return report.unionByName(verdict)


@query("c_bulk_load_sound", """
SELECT 'customer' AS table_name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders""")
def c_bulk_load_sound(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "publish")
    tables = {"customer": t.customer, "orders": t.orders}
    bulk_load(t.spark, root, 1, tables, {"customer": ["c_custkey"], "orders": ["o_orderkey"]}, CHAIN[:1])
    read = {n: read_published(t.spark, root, n) for n in tables}
    return _stack([df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n, df in read.items()])


@query("c_restore", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def c_restore(t: Tables) -> DataFrame:
    """Deleted rows inserted again give the table back."""
    keys = t.customer.where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    gone = equi_join(t.customer, keys, ["c_custkey"], "left_semi")
    return E.insert_by_name(E.delete_by_key(t.customer, keys), gone, ["c_custkey"])
