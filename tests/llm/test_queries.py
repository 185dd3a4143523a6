"""Registered queries against their SQL, and the pipeline as a whole."""

import glob
import os

import duckdb
import pytest
from compare import compare

import __spark_entry__ as driver
import corpus_pipeline
from sheetloom.llm.registry import QUERIES, SQL

FOLDER = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    state, note, _ = compare(spark, con, name, FOLDER)
    assert state == "ok", note


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_native_plans_hold_no_python(spark):
    for name in ("op1_mix_sources", "op5_exact_dedup"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    given = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, given, FOLDER)
        assert new.columns == docs.columns
        given = new
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.where("n_tokens > 0").count() == out.count() > 0
