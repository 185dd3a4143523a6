"""Numbering, filling, sorting and set operations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.functions.names import clean_name_column
from sheetloom.operators import ordering as O
from sheetloom.operators import sets as U
from sheetloom.session import scratch_path
from sheetloom.sinks import files as W
from sheetloom.suite.projections import labelled
from sheetloom.suite.registry import Tables, query


@query("w_add_id", """
SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS id, p_partkey, p_name FROM part""")
def w_add_id(t: Tables) -> DataFrame:
    return O.add_id(t.part.select("p_partkey", "p_name"), "id", ["p_name", "p_partkey"])


@query("w_add_id_ranged", """
SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id, o_orderkey, o_totalprice FROM orders""")
def w_add_id_ranged(t: Tables) -> DataFrame:
    """The route that large tables take, forced here."""
    return O.add_id(t.orders.select("o_orderkey", "o_totalprice"), "id", ["o_totalprice", "o_orderkey"], group_rows=0)


@query("w_first_seen", """
WITH seen AS (SELECT p_type, min(p_partkey) AS k FROM part GROUP BY p_type)
SELECT row_number() OVER (ORDER BY k) AS habitat_id, p_type AS habitat FROM seen""")
def w_first_seen(t: Tables) -> DataFrame:
    seen = O.first_seen(t.part, ["p_type"], "p_partkey")
    return O.add_id(seen, "habitat_id", ["_seen"]).select("habitat_id", F.col("p_type").alias("habitat"))


@query("w_sequence", """
SELECT (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY t) AS p_partkey, t AS p_type
FROM (SELECT DISTINCT p_type || '/' || p_brand AS t FROM part)""")
def w_sequence(t: Tables) -> DataFrame:
    new = t.part.select(F.concat_ws("/", "p_type", "p_brand").alias("p_type")).distinct()
    return O.sequence_ids(new, t.part, "p_partkey", ["p_type"])


def sparse_events(t: Tables) -> DataFrame:
    """Events whose value is kept for purchases only."""
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    return t.events.select("event_id", "user_id", "ts", value.alias("value"))


FILL_DOWN = """
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events"""


@query("w_fill_down", FILL_DOWN)
def w_fill_down(t: Tables) -> DataFrame:
    return O.fill_down(sparse_events(t), ["user_id"], ["ts", "event_id"], ["value"]).drop("ts")


@query("w_fill_down_ranged", FILL_DOWN)
def w_fill_down_ranged(t: Tables) -> DataFrame:
    """The route that groups of any size take, forced here."""
    return O.fill_down(sparse_events(t), ["user_id"], ["ts", "event_id"], ["value"], group_rows=0).drop("ts")


@query("w_topk", """
SELECT event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 30""")
def w_topk(t: Tables) -> DataFrame:
    return O.top_k(t.events.select("event_type", "event_id", "value"), ["event_type"], ["-value", "event_id"], 30)


@query("w_dedupe_names", """
WITH c AS (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') AS clean FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY clean ORDER BY p_partkey) AS k FROM c)
SELECT p_partkey, clean || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS clean_name FROM n""")
def w_dedupe_names(t: Tables) -> DataFrame:
    named = t.part.select("p_partkey", clean_name_column(F.col("p_name")).alias("clean"))
    return O.unique_suffix(named, "clean", ["p_partkey"], "clean_name").select("p_partkey", "clean_name")


@query("s_order", """
WITH k AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT row_number() OVER (ORDER BY quality NULLS LAST, doc_id DESC) AS place, doc_id, quality FROM k""")
def s_order(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return O.row_numbers(rows, [], ["quality", "-doc_id"], "place")


@query("s_sorted_files", """
WITH k AS (SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT row_number() OVER (ORDER BY quality DESC NULLS LAST, lang NULLS LAST, doc_id) AS place, doc_id, lang, quality, true AS in_order FROM k""")
def s_sorted_files(t: Tables) -> DataFrame:
    """Written sorted and read back in the order of the files; the manifest says whether each file follows the one before."""
    order = ["-quality", "lang", "doc_id"]
    path = scratch_path(t.spark, "sorted")
    W.write_sorted(labelled(t).select("doc_id", "lang", "quality"), path, order)
    sound = W.manifest(t.spark, path, order).agg(F.every("in_order").alias("in_order"))
    return W.read_in_order(t.spark, path, order).join(F.broadcast(sound), how="cross").select("place", "doc_id", "lang", "quality", "in_order")


@query("s_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def s_limit(t: Tables) -> DataFrame:
    return O.limit_rows(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 100)


@query("u_by_name", """
SELECT s_nationkey AS nation, s_name AS name, NULL AS segment FROM supplier
UNION ALL SELECT c_nationkey, c_name, c_mktsegment FROM customer""")
def u_by_name(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    customers = t.customer.select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name")
    )
    return U.union_by_name(suppliers, customers)


@query("u_with_id", "SELECT o_orderstatus AS status, o_orderkey, o_totalprice FROM orders")
def u_with_id(t: Tables) -> DataFrame:
    parts = {s: t.orders.where(F.col("o_orderstatus") == s).select("o_orderkey", "o_totalprice") for s in ("F", "O", "P")}
    return U.union_with_key(parts, "status")


@query("u_all", """
SELECT l_partkey AS key FROM lineitem UNION ALL SELECT p_partkey FROM part UNION ALL SELECT l_suppkey FROM lineitem""")
def u_all(t: Tables) -> DataFrame:
    return U.union_all([t.lineitem.select(F.col("l_partkey").alias("key")), t.part.select("p_partkey"), t.lineitem.select("l_suppkey")])


@query("u_except", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u_except(t: Tables) -> DataFrame:
    return U.difference(t.customer.select("c_custkey"), t.orders.where("o_orderstatus = 'P'").select("o_custkey"))
