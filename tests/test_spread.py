"""Costly work on tables of few bytes, and what a task holds of large ones."""

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from sheetloom import session
from sheetloom.operators import checks as Q
from sheetloom.operators import spatial as S
from sheetloom.sources import html as H
from sheetloom.sources.files import read_geometry

PAGE = "<table><tr><th>a<th>b<tr><td>1<td>2</table>"
SHAPES = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((5 5, 6 5, 6 5.1, 5 5.1, 5 5)))"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_of_one_file_are_parsed_by_several_tasks(spark):
    pages = spark.range(25_000).coalesce(1).select("id", F.lit(PAGE).alias("html"))
    rows = H.extract_tables(pages, "html", "id", ncol=2)
    assert rows.rdd.getNumPartitions() == 3
    assert rows.count() == 50_000


def test_pages_are_parsed_once_for_headers_and_bodies(spark):
    pages = spark.createDataFrame([(1, PAGE), (1, PAGE), (None, PAGE), (2, None)], "id int, html string")
    stacked = H.stacked_tables(H.extract_tables(pages, "html", "id", ncol=2), "id", ["a", "b"])
    assert "MapInPandas" not in plan(stacked)
    assert [tuple(r) for r in stacked.collect()] == [(1, 0, 1, "1", "2")] * 4


def test_shapes_of_one_file_are_parsed_by_several_tasks_and_only_there(spark):
    texts = spark.range(25_000).coalesce(1).select("id", F.lit(SHAPES).alias("wkt"))
    shapes = read_geometry(texts.withColumn("wkt", F.when(F.col("id") != 7, F.col("wkt"))), "wkt", "id")
    assert shapes.rdd.getNumPartitions() == 3
    parts = S.single_parts(shapes, "polygons", "area_id").select("area_id", "part")
    assert not [line for line in plan(parts).splitlines() if "Filter" in line and "size(" in line]
    assert parts.count() == 2 * 24_999


def test_slivers_are_measured_once(spark):
    shapes = read_geometry(spark.createDataFrame([(1, SHAPES), (2, None)], "id int, wkt string"), "wkt", "id")
    kept, dropped = S.slivers(S.single_parts(shapes, "polygons", "area_id"), "polygons", 0.5)
    assert "Generate" not in plan(kept) + plan(dropped)
    assert [r.part for r in kept.collect()] == [1] and [r.part for r in dropped.collect()] == [2]


def test_orphans_need_no_join(spark, rows):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "b"), (3, None), (None, "a")], "k int, c string")
    parent = spark.createDataFrame([(2, "b"), (2, "b"), (9, "z"), (None, "a"), (3, None)], "p int, q string")
    orphans = Q.orphan_keys(child, parent, [("k", "p"), ("c", "q")])
    assert "Join" not in plan(orphans)
    assert rows(orphans) == [(1, "a", 2)]
    assert rows(Q.orphan_keys(child, parent.withColumn("p", F.col("p").cast("long")), [("k", "p"), ("c", "q")])) == [(1, "a", 2)]


def test_tables_written_together_are_not_sorted(spark, monkeypatch):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(key)), write(self, *a, **k))[1])
    before = spark.conf.get(key)
    tables = session.staged_together({"a": spark.range(3), "b": spark.createDataFrame([("x",)], "v string"), "c": spark.range(0)}, "t", distinct=["b"])
    assert {n: df.count() for n, df in tables.items()} == {"a": 3, "b": 1, "c": 0}
    by = session.staged_by(spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "t string, n int"), "t", ["x", "y"], "b")
    assert {n: [r.n for r in df.collect()] for n, df in by.items()} == {"x": [1], "y": [2]}
    assert seen == ["3", "2"] and spark.conf.get(key) == before
