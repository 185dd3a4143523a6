import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetloom.operators import ordering as O


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds more than a third of all rows; order values repeat."""
    rng = random.Random(7)
    data = [("hot" if i % 5 < 2 else f"g{i % 97}", i // 3, None if rng.random() < 0.6 else i, i) for i in range(6000)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "g string, o int, v int, k int").repartition(7)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_row_numbers_of_groups(skewed, rows, limit):
    data, df = skewed
    got = rows(O.row_numbers(df, ["g"], ["o", "k"], "n", group_rows=limit), "k", "n")
    want, seen = [], {}
    for g, o, v, k in sorted(data, key=lambda r: (r[1], r[3])):
        seen[g] = seen.get(g, 0) + 1
        want.append((k, seen[g]))
    assert got == sorted(want, key=lambda r: tuple((False, str(v)) for v in r))


@pytest.mark.parametrize("limit", [10**6, 0])
def test_dense_ids(skewed, limit):
    data, df = skewed
    got = {r.k: r.id for r in O.add_id(df, "id", ["o", "k"], after=10, group_rows=limit).collect()}
    assert got == {r[3]: i for i, r in enumerate(sorted(data, key=lambda r: (r[1], r[3])), start=11)}


@pytest.mark.parametrize("limit", [10**6, 0])
@pytest.mark.parametrize("by", [["g"], []])
def test_fill_down(skewed, limit, by):
    data, df = skewed
    got = {r.k: r.v for r in O.fill_down(df, by, ["o", "k"], ["v"], group_rows=limit).collect()}
    last, want = {}, {}
    for g, o, v, k in sorted(data, key=lambda r: (r[1], r[3])):
        key = g if by else ""
        if v is not None:
            last[key] = v
        want[k] = last.get(key)
    assert got == want


@pytest.mark.parametrize("limit", [10**6, 0])
def test_collapse_in_order_with_missing_values(skewed, limit):
    data, df = skewed
    got = {r.g: r.v for r in O.collapse(df, ["g"], "v", ":\n", ["o", "k"], group_rows=limit).collect()}
    want = {}
    for g, o, v, k in sorted(data, key=lambda r: (r[1], r[3])):
        want.setdefault(g, []).append("NA" if v is None else str(v))
    assert got == {g: ":\n".join(vs) for g, vs in want.items()}


def test_ranged_route_with_equal_rows_only(spark):
    """Copies of one row are spread over partitions and still numbered without gaps."""
    df = spark.createDataFrame([("a", 1)] * 500, "g string, o int")
    got = O.add_id(df, "id", ["o"], group_rows=0)
    assert sorted(r.id for r in got.collect()) == list(range(1, 501))
    assert sorted(r.n for r in O.row_numbers(df, ["g"], ["o"], "n", group_rows=0).collect()) == list(range(1, 501))


def test_ranged_route_with_null_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(300)] + [("b", i) for i in range(40)], "g string, o int")
    got = O.row_numbers(df, ["g"], ["o"], "n", group_rows=0)
    assert all(r.n == r.o + 1 for r in got.collect()) and got.count() == 340


def test_descending_and_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "k int, v int")
    for limit in (100, 0):
        assert {r.k: r.n for r in O.row_numbers(df, [], ["-v"], "n", limit).collect()} == {3: 1, 2: 2, 1: 3}
        assert {r.k: r.n for r in O.row_numbers(df, [], ["v"], "n", limit).collect()} == {2: 1, 3: 2, 1: 3}


def test_whole_table_window_leaves_several_partitions(spark):
    df = spark.range(20_000).withColumn("v", F.col("id") * 2)
    numbered = O.add_id(df, "n", ["id"])
    assert numbered.rdd.getNumPartitions() > 1
    assert numbered.where("n <> id + 1").count() == 0


def test_large_tables_are_never_ordered_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(O, "TABLE_ROWS", 100)
    plan = O.add_id(spark.range(5000), "n", ["-id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("Broadcast")[0].split("Join")[0]
    assert O.add_id(spark.range(5000), "n", ["-id"]).where("n <> 5000 - id").count() == 0


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") > 99, "hot").otherwise("cold"))
    top = O.top_k(df, ["g"], ["-id"], 3)
    assert sorted(r.id for r in top.collect()) == [97, 98, 99, 997, 998, 999]
    assert O.top_k(df, ["g"], ["-id"], 2000).count() == 1000
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_sequences_first_seen_and_suffix(spark, rows):
    seen = O.first_seen(spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "v string, o int"), ["v"], "o")
    assert rows(O.add_id(seen, "id", ["_seen"]), "id", "v") == [(1, "b"), (2, "a")]
    old = spark.createDataFrame([(4, "x")], "id int, v string")
    assert rows(O.sequence_ids(spark.createDataFrame([("p",), ("q",)], "v string"), old, "id", ["v"])) == [(5, "p"), (6, "q")]
    assert O.next_key(old.limit(0), "id") == 1
    names = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("a", 4)], "n string, o int")
    assert [r[0] for r in O.unique_suffix(names, "n", ["o"], "u").orderBy("o").select("u").collect()] == ["a", "a_2", "b", "a_3"]


def test_slices_and_first_value(spark, rows):
    df = spark.createDataFrame([(i, i % 2) for i in range(1, 8)], "o int, g int")
    assert [r[0] for r in rows(O.slice_rows(df, "o", 2), "o")] == [2, 3, 4, 5, 6, 7]
    assert [r[0] for r in rows(O.slice_rows(df, "o", 2, 4), "o")] == [2, 3, 4]
    assert [r[0] for r in rows(O.limit_rows(df, ["-o"], 2), "o")] == [6, 7]
    assert rows(O.first_value(df, ["g"], "o", ["o"], "f")) == [(0, 2), (1, 1)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=40))
def test_both_routes_agree(spark, data):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(data)], "g string, v int, k int")
    for limit in (10**6, 0):
        filled = {r.k: r.v for r in O.fill_down(df, ["g"], ["k"], ["v"], group_rows=limit).collect()}
        last, want = {}, {}
        for i, (g, v) in enumerate(data):
            last[g] = v if v is not None else last.get(g)
            want[i] = last[g]
        assert filled == want


def test_only_large_groups_take_the_range_route(spark, monkeypatch):
    seen = []
    ranged = O._ranged
    monkeypatch.setattr(O, "_ranged", lambda df, by, order: seen.append({r.g for r in df.select("g").distinct().collect()}) or ranged(df, by, order))
    data = [("hot" if i % 3 == 0 else None if i % 3 == 1 and i % 2 else f"g{i % 40}", i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, o int")
    got = O.row_numbers(df, ["g"], ["-o"], "n", group_rows=400)
    assert seen == [{"hot", None}]
    # The other groups are dealt once, by the group.
    cold = got._jdf.queryExecution().executedPlan().toString().split("Union")[1].split("_part")[0]
    assert cold.count("Exchange hashpartitioning(g") == 1
    counts = {}
    for g, o in sorted(data, key=lambda r: -r[1]):
        counts[g] = counts.get(g, 0) + 1
        data[o] = (g, counts[g])
    assert sorted((r.o, r.g, r.n) for r in got.collect()) == [(i, g, n) for i, (g, n) in enumerate(data)]


def test_ties_are_ordered_alike_on_every_route(spark):
    data = [("a", 1, v, w) for v in (3, None, 1, 2) for w in (["y"], ["x", "z"], None)] * 2 + [("b", 1, 5, None)]
    df = spark.createDataFrame(data, "g string, o int, v int, w array<string>").repartition(5)
    routes = []
    for limit in (10**6, 3, 0):
        numbered = O.row_numbers(df, ["g"], ["o"], "n", group_rows=limit)
        joined = O.collapse(df, ["g"], "v", ",", ["o"], group_rows=limit)
        filled = O.fill_down(df, ["g"], ["o"], ["v"], group_rows=limit)
        routes.append([sorted(map(str, x.collect())) for x in (numbered, joined, filled)])
    assert routes[0] == routes[1] == routes[2]
    assert "v='1,1,1,1,1,1,2,2,2,2,2,2,3,3,3,3,3,3,NA,NA,NA,NA,NA,NA'" in routes[0][1][0]
