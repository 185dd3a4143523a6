"""Reshaping, aggregation, facets, checks, edits and catalogue on small tables."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.operators import aggregate as A
from sheetloom.operators import catalog as K
from sheetloom.operators import checks as Q
from sheetloom.operators import edits as E
from sheetloom.operators import facets as C
from sheetloom.operators import projection as P
from sheetloom.operators import reshape as R
from sheetloom.operators import sets as U
from sheetloom.operators.fuzzy import backbone_match_near
from sheetloom.operators.joins import missing_names
from sheetloom.operators.ordering import collapse
from sheetloom.session import scratch_path
from sheetloom.sinks import files as W


def test_matrix_marks_and_headers(spark, rows):
    sheet = spark.createDataFrame([("m1", "x", "X", None), ("m2", "y", "x", "x")], "id string, x7 string, x7_2 string, x112 string")
    cols = ["x7", "x7_2", "x112"]
    assert rows(R.matrix_to_bridge(sheet, ["id"], cols, "area", header_id=R.prefixed_id)) == [
        ("m1", 7), ("m1", 7), ("m2", 112), ("m2", 7)]
    assert rows(R.matrix_to_bridge(sheet, ["id"], cols, "area", ("x",), R.narrow_id)) == [("m1", 7), ("m2", 11), ("m2", 7)]
    assert rows(R.matrix_to_bridge(sheet, ["id"], cols, "h", position="at"), "id", "h", "at")[0] == ("m1", "x7", 1)
    assert P.area_headers(["x7_2", "x12"]) == ["x7", "x12"]


@settings(max_examples=8, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 5), st.integers(0, 4)), min_size=1))
def test_unpivoting_a_pivot_gives_the_pairs_back(spark, pairs):
    bridge = spark.createDataFrame(sorted(pairs), "id int, area int")
    wide = bridge.groupBy("id").pivot("area", list(range(5))).agg(F.first(F.lit("x")))
    back = R.matrix_to_bridge(wide, ["id"], [str(i) for i in range(5)], "area", header_id=lambda h: h.cast("int"))
    assert {tuple(r) for r in back.collect()} == pairs


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.text("abc ", max_size=3), min_size=1, max_size=4), min_size=1, max_size=6))
def test_splitting_a_collapse_gives_the_rows_back(spark, groups):
    data = [(g, i, v) for g, values in enumerate(groups) for i, v in enumerate(values)]
    joined = collapse(spark.createDataFrame(data, "g int, i int, v string"), ["g"], "v", "; ", ["i"])
    back = R.explode_delim(joined, "v", "; ", position="p")
    assert sorted((r.g, r.p - 1, r.v) for r in back.collect()) == sorted(data)


def test_splits_keep_missing_cells(spark, rows):
    df = spark.createDataFrame([(1, "a|b", "p"), (2, None, "q|r")], "id int, u string, v string")
    assert rows(R.explode_delim(df, "u", "|"), "id", "u") == [(1, "a"), (1, "b"), (2, None)]
    assert len(rows(R.explode_chain(df, {"u": "|", "v": "|"}))) == 4
    assert rows(R.explode_zip(df, ["u", "v"], "|")) == [(1, "a", "p"), (1, "b", "p"), (2, None, "q"), (2, None, "r")]
    bad = spark.createDataFrame([(1, "a|b|c", "p|q")], "id int, u string, v string")
    with pytest.raises(Exception, match="cannot split in parallel"):
        R.explode_zip(bad, ["u", "v"], "|").collect()


def test_separate_enframe_and_melt(spark, rows):
    df = spark.createDataFrame([(1, "AB1: text: more"), (2, "none")], "id int, v string")
    assert rows(R.separate(df, "v", ["code", "summary"], ": ")) == [(1, "AB1", "text"), (2, "none", None)]
    wide = spark.createDataFrame([(1, "a", None)], "id int, p string, q string")
    assert rows(R.enframe(wide, ["p", "q"], "n", "v")) == [(1, 1, "a"), (1, 2, None)]
    assert len(rows(R.melt(wide, ["id"], ["p", "q"], "k", "v"))) == 2
    assert rows(R.melt(wide, ["id"], ["p", "q"], "k", "v", drop_nulls=True)) == [(1, "p", "a")]


def test_header_promotion_for_part_of_the_columns(spark, rows):
    sheet = spark.createDataFrame([(0, "Measure type", "No.", None), (1, "Land", "5", "x")], "_ord int, c1 string, c2 string, x7 string")
    named = P.promote_header(sheet, "_ord", 0, ["c1", "c2"])
    assert named.columns == ["_ord", "measure_type", "no", "x7"] and rows(named) == [(1, "Land", "5", "x")]
    with pytest.raises(ValueError):
        P.promote_header(sheet, "_ord", 9)


def test_numbers_of_texts(spark):
    df = spark.createDataFrame([("7",), ("7.9",), ("abc",), ("",), (None,), (" 12 ",), ("1e2",)], "v string")
    assert [r[0] for r in df.select(P.as_integer(F.col("v"))).collect()] == [7, 7, None, None, None, 12, 100]
    assert [r[0] for r in df.limit(3).select(P.leading_integer(F.col("v"))).collect()] == [7, 7, None]


def test_column_choice_and_renaming(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "x_id int, x_v double, sfi_action_name string")
    assert P.columns_where(df, prefix="x_", dtype=T.DoubleType) == ["x_v"]
    assert P.columns_where(df, suffix="_id", names=["x_id", "gone"]) == ["x_id"]
    assert P.columns_where(df, start=2) == ["x_v", "sfi_action_name"]
    assert P.rename_prefixed(df, "sfi", "action").columns[-1] == "action"
    assert P.relocate(df, "gone", "x_v").columns[0] == "x_v"
    with pytest.raises(ValueError):
        P.rename_prefixed(df, "x_", "y")


def test_grants_without_an_address(spark, rows):
    df = spark.createDataFrame([("g", "u"), ("g", None), (None, None), (None, "u")], "grant_id string, url string")
    assert rows(P.without_dead_links(df)) == [("g", "u"), (None, "u"), (None, None)]
    known = spark.createDataFrame([("g",), (None,)], "grant_id string")
    assert len(rows(P.known_or_null(df.unionByName(df.limit(1).withColumn("grant_id", F.lit("h"))), "grant_id", known))) == 4


def test_facets_ignore_their_own_refinement(spark, rows):
    data = [("t1", "core", "F"), ("t1", "other", "F"), ("t2", "core", "O"), ("t2", None, "F")]
    df = spark.createDataFrame(data, "type string, status string, holder string")
    refine = {"type": ["t1"], "holder": ["F"]}
    got = rows(C.facet_counts(df, ["type", "status"], refine))
    assert got == [("status", "core", 1), ("status", "other", 1), ("type", "t1", 2), ("type", "t2", 1)]
    assert rows(C.refine_rows(df, {"type": ["t1", "t2"], "holder": ["O"]})) == [("t2", "core", "O")]
    assert C.set_refinement(refine, "type") == {"holder": ["F"]}
    assert C.set_refinement(refine, "type", "a", "b")["type"] == ["a", "b"]
    assert rows(C.facet_groups(df, ["status"], {}, ["type"])) == []
    assert rows(C.facet_exists(df, "status", {"type": ["t2"], "holder": ["F"]})) == [(False,)]
    assert rows(C.facet_details(df, "type", ["status"], {})) == [("t1", "core"), ("t1", "other"), ("t2", "core")]


def test_null_groups_leave_after_the_limit(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,), (None,), (None,)], "g string")
    call = dict(select=["count(*) AS n"], group_by=["g"], order_by=["n DESC", "g"], limit=2)
    assert rows(A.analyze(df, **call)) == [("a", 1)]
    assert rows(A.analyze(df, **call, drop_null_groups="before")) == [("a", 1), ("b", 1)]
    assert rows(A.analyze(df, **call, drop_null_groups=None)) == [("a", 1), (None, 3)]
    assert rows(A.analyze(df, ["count(*) AS n"], where="g = 'a'")) == [(1,)]


def test_nesting_is_undone_exactly(spark, rows):
    data = [("hot", i % 7, "v") for i in range(200)] + [("cold", 1, None)] * 3
    df = spark.createDataFrame(data, "k string, i int, v string")
    nested = A.nest(df, ["k"], nest_rows=2)
    assert nested.where(F.size("data") > 7).count() == 0 and nested.where("k = 'hot'").count() > 1
    assert rows(A.unnest(nested, ["k"])) == rows(df)
    copies = spark.createDataFrame([("c",)] * 10_000, "k string").withColumn("i", F.lit(1))
    assert A.unnest(A.nest(copies, ["k"]), ["k"]).count() == 10_000


def test_totals_and_all_true(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 4)], "g string, v int")
    assert rows(A.with_totals(df, ["g"], total=F.sum("v"))) == [("a", 3, False), (None, 4, False), (None, 7, True)]
    verdict, failing = A.all_true(df, F.col("v") < 3)
    assert rows(verdict) == [(False,)] and rows(failing) == [(None, 4)]


def test_key_and_reference_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, p string")
    assert rows(Q.check_key(df, ["k"])) == [(1, 2)]
    assert rows(Q.check_key(df, ["p"])) == [("a", 2), (None, 1)]
    parent = spark.createDataFrame([("b",)], "p string")
    assert rows(Q.check_reference(df, parent, ["p"])) == [(1, "a"), (1, "a")]
    assert rows(Q.orphan_keys(df, parent, ["p"])) == [("a", 2)]
    assert rows(Q.check_not_null(df, ["k", "p"])) == [("k", 0), ("p", 1)]
    assert rows(Q.compare_tables(df, df.distinct(), ["k", "p"])) == [(3, 2, 1, 0)]


def test_edits(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, name string, n int")
    with pytest.raises(ValueError):
        E.insert_by_name(df, spark.createDataFrame([(3, 1)], "id int, gone int"))
    with pytest.raises(ValueError):
        E.insert_values(df, {"id": 2}, ["id"])
    assert rows(E.insert_values(df, {"id": 3, "name": "c"}, ["id"]))[-1] == (3, "c", None)
    change = spark.createDataFrame([(2, None, 9)], "id int, name string, n int")
    assert rows(E.update_by_key(df, change, ["id"])) == [(1, "a", 5), (2, "b", 9)]
    assert rows(E.update_by_key(df, change, ["id"], set_nulls=True)) == [(1, "a", 5), (2, None, 9)]
    with pytest.raises(ValueError):
        E.update_by_key(df, change.unionByName(change), ["id"])
    assert rows(E.delete_by_key(df, change.select("id"))) == [(1, "a", 5)]
    assert rows(E.clear(df)) == []
    assert rows(E.upsert(df, spark.createDataFrame([(2, 0), (7, 1)], "id int, n int"), ["id"])) == [(1, "a", 5), (2, "b", 0), (7, None, 1)]
    grown = E.insert_distinct(df.select("id", "name"), spark.createDataFrame([("b",), ("z",), (None,), ("c",)], "name string"), "id", ["name"])
    assert rows(grown) == [(1, "a"), (2, "b"), (3, "c"), (4, "z")]


def test_cascade_follows_composite_references_only_to_its_own_rows(spark, rows):
    """Deleting measure 1 leaves measure 2 alone although both have the same type."""
    tables = {
        "measure": spark.createDataFrame([(1,), (2,)], "measure_id int"),
        "measure_type": spark.createDataFrame([(1,), (2,)], "measure_type_id int"),
        "measure_has_type": spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "measure_id int, measure_type_id int"),
        "fact": spark.createDataFrame([(1, 5), (2, 5)], "measure_id int, area_id int"),
        "grant": spark.createDataFrame([(1, 5, "g"), (2, 5, "g"), (2, 5, "h")], "measure_id int, area_id int, grant_id string"),
    }
    refs = [
        E.Reference("measure_has_type", "measure", (("measure_id", "measure_id"),)),
        E.Reference("measure_has_type", "measure_type", (("measure_type_id", "measure_type_id"),)),
        E.Reference("fact", "measure", (("measure_id", "measure_id"),)),
        E.Reference("grant", "fact", (("measure_id", "measure_id"), ("area_id", "area_id"))),
    ]
    left = E.delete_cascade(tables, refs, "measure", spark.createDataFrame([(1,)], "measure_id int"))
    assert rows(left["measure"]) == [(2,)] and rows(left["measure_has_type"]) == [(2, 1)]
    assert rows(left["fact"]) == [(2, 5)] and rows(left["grant"]) == [(2, 5, "g"), (2, 5, "h")]
    assert rows(left["measure_type"]) == [(1,), (2,)]


def test_catalogue(spark, rows, tmp_path):
    assert K.load_order(["c", "a", "b"], {"c": ["b"], "b": ["a"]}) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        K.load_order(["a", "b"], {"a": ["b"], "b": ["a"]})
    assert K.split_lookups(["areas", "areas-lookup"]) == (["areas"], ["areas-lookup"])
    K.recreate_database(spark, "loom_test", f"{tmp_path}/first")
    for name in ("parent", "child"):
        spark.range(2).write.format("parquet").saveAsTable(f"loom_test.{name}")
    assert rows(K.list_tables(spark, "loom_test")) == [("child",), ("parent",)]
    dropped = K.drop_tables(spark, ["loom_test.parent", "loom_test.child"], {"loom_test.child": ["loom_test.parent"]})
    assert dropped == ["loom_test.child", "loom_test.parent"]
    K.recreate_database(spark, "loom_test", f"{tmp_path}/second")
    assert rows(K.list_tables(spark, "loom_test")) == []
    spark.sql("DROP DATABASE loom_test CASCADE")
    df = spark.createDataFrame([("1", "a"), ("x", None)], "id string, v string")
    schema = K.record_schema(json.dumps({"id": {"type": "integer"}, "w": {"type": ["string", "null"]}}))
    assert rows(K.conform(df, schema)) == [(1, None), (None, None)]
    assert {r.column_name: r.state for r in K.conformity(df, schema).collect()} == {"id": "wrong type", "w": "missing", "v": "extra"}
    assert rows(K.profile(df), "column_name", "rows", "nulls", "distinct_values") == [("id", 2, 0, 2), ("v", 2, 1, 1)]
    assert rows(K.profile(df, approximate=True), "column_name", "nulls") == [("id", 0), ("v", 1)]
    with pytest.raises(ValueError):
        K.apply_schema(df, T.StructType([T.StructField("key", T.IntegerType(), False)]))


def test_unions(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "id int, v string"), spark.createDataFrame([(2,)], "id int")
    assert rows(U.union_by_name(a, b)) == [(1, "x"), (2, None)]
    assert rows(U.union_with_key({"p": a, "q": b}, "key")) == [("p", 1, "x"), ("q", 2, None)]
    assert rows(U.union_all([b, b])) == [(2,), (2,)] and rows(U.difference(b, b)) == []


def test_profile_bounds_follow_the_type(spark):
    rows = spark.createDataFrame([(n, float(n), str(n), None if n % 2 else {"a": n}) for n in range(1, 13)], "i int, x double, t string, m map<string,int>")
    exact = {r.column_name: r for r in K.profile(rows).collect()}
    assert (exact["i"].lowest, exact["i"].highest, exact["x"].highest, exact["t"].highest) == ("1", "12", "12.0", "9")
    assert exact["m"].lowest is None and exact["m"].nulls == 6 and exact["i"].distinct_values == 12
    for c in "ixt":
        assert len(exact[c].samples) == 3 and set(exact[c].samples) <= {str(r[c]) for r in rows.collect()}
    again = {r.column_name: r.samples for r in K.profile(rows.repartition(5)).collect()}
    assert again == {c: r.samples for c, r in exact.items()}
    near = {r.column_name: r for r in K.profile(rows, approximate=True).collect()}
    assert near["x"].median == 6.0 and near["t"].median is None and near["i"].highest == "12" and near["m"].rows == 12
    empty = {r.column_name: r for r in K.profile(rows.limit(0), approximate=True).collect()}
    assert empty["i"].rows == 0 and empty["i"].samples == [] and empty["i"].lowest is None


def test_sorted_files_are_read_in_order(spark):
    data = [(None if i % 7 == 0 else i % 50, f"k{i % 13}", i) for i in range(3000)]
    df = spark.createDataFrame(data, "v int, g string, i int").repartition(6)
    path, order = scratch_path(spark, "sorted"), ["-v", "g", "i"]
    W.write_sorted(df, path, order, 4)
    files = W.manifest(spark, path, order).orderBy("_file").collect()
    assert len(files) > 1 and all(f.in_order for f in files) and sum(f.rows for f in files) == 3000
    want = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    got = sorted(W.read_in_order(spark, path, order).collect(), key=lambda r: r.place)
    assert [(r.v, r.g, r.i) for r in got] == want and [r.place for r in got] == list(range(1, 3001))
    # Files sorted downwards do not follow each other upwards.
    down = scratch_path(spark, "sorted")
    W.write_sorted(df, down, ["-i"], 4)
    assert [f.in_order for f in W.manifest(spark, down, ["i"]).orderBy("_file").collect()] == [True, False, False, False]


def test_names_near_a_backbone(spark, rows):
    backbone = spark.createDataFrame([("Vulpes vulpes", 1), ("Vulpes vulpas", 2), ("Apis mellifera", 3)], "canonical string, usage_key int")
    names = spark.createDataFrame([(1, "Vulpes vulpes"), (2, "vulpes vulpis"), (3, "Apis melifera"), (4, "Bombus"), (5, None), (6, "Apis melifera")], "i int, name string")
    got = backbone_match_near(names, "name", backbone, "canonical", "u/")
    assert rows(got, "i", "match_name", "match_distance", "usage_key", "backbone_url") == [
        (1, "Vulpes vulpes", 0, 1, "u/1"), (2, "Vulpes vulpas", 1, 2, "u/2"), (3, "Apis mellifera", 1, 3, "u/3"), (4, None, None, None, None),
        (5, None, None, None, None), (6, "Apis mellifera", 1, 3, "u/3")]
    assert rows(missing_names(got, "name")) == [("Bombus",)]
