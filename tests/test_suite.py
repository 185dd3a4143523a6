"""Every registered query against its SQL, and the plans that matter at scale."""

import glob
import os

import duckdb
import pytest
from compare import compare

import __spark_entry__ as driver
from sheetloom.operators import joins as J
from sheetloom.suite.registry import QUERIES, Tables

FOLDER = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    state, note, _ = compare(spark, con, name, FOLDER)
    # The smallest tables may hold no row for a query; its columns and types are compared all the same.
    assert state in ("ok", "rows only", "EMPTY"), note


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["facet_counts", "r_matrix", "j_fuzzy", "j_spatial", "html_links", "s_clean_text", "agg_collapse", "c_cascade"])
def test_plans_stay_on_the_jvm_without_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["f_range"](spark, FOLDER))
    assert "PushedFilters" in text and "p_retailprice" not in text


def test_dimensions_are_broadcast_and_facts_joined_once_each(spark):
    text = plan(QUERIES["star_view"](spark, FOLDER))
    assert "BroadcastHashJoin" in text and "Cartesian" not in text


def test_skewed_sides_come_straight_from_a_shuffle(spark):
    """Adaptive execution splits a skewed partition only below a bare shuffle."""
    t = Tables(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(J.equi_join(t.orders, t.customer, [("o_custkey", "c_custkey")]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and text.count("Exchange") == 2
