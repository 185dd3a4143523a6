import math
import random

import pytest
from pyspark.sql import functions as F

from sheetloom.functions import geometry as G
from sheetloom.functions.geometry import parse_polygon
from sheetloom.operators import joins as J
from sheetloom.operators import spatial as S
from sheetloom.operators.fuzzy import fuzzy_join, fuzzy_pairs
from sheetloom.operators.links import apply_link_status
from sheetloom.operators.spatial import spatial_join


def test_null_keys_match_only_when_asked(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id int, g string")
    b = spark.createDataFrame([("x", 10), (None, 20)], "g string, v int")
    assert rows(J.equi_join(a, b, ["g"], "left"), "id", "v") == [(1, 10), (2, None)]
    assert rows(J.equi_join(a, b, ["g"], "left", null_safe=True), "id", "v") == [(1, 10), (2, 20)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join_equals_plain_join_under_skew(spark, rows, how, null_safe):
    data = [("hot", i) for i in range(400)] + [(None, i) for i in range(300)] + [(f"k{i % 50}", i) for i in range(200)]
    left = spark.createDataFrame(data, "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)] + [(f"k{i}", i) for i in range(30)], "k string, v int")
    plain = rows(J.equi_join(left, right, ["k"], how, null_safe))
    assert rows(J.lookup_join(left, right, ["k"], how, null_safe, hot_rows=100)) == plain
    # Too many lookup rows for the hot keys: the plain join takes over.
    assert rows(J.lookup_join(left, right, ["k"], how, null_safe, hot_rows=100, broadcast_rows=1)) == plain


def test_lookup_join_keeps_hot_keys_out_of_the_shuffle(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", 0)], "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = J.lookup_join(left, right, ["k"], hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Union" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_frequent_keys_are_found_as_a_table_is_written(spark, rows):
    data = [("hot", i % 3, i) for i in range(4000)] + [(None, 5, i) for i in range(3000)] + [(f"k{i}", i, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, j int, i int")
    kept, found = J.follow_keys(df, [["k"], ["k", "j"], ["i"]], "followed")
    assert rows(kept) == rows(df) and kept.columns == df.columns
    want = {r.h: r.n for r in df.groupBy("k").count().select(F.xxhash64("k").alias("h"), F.col("count").alias("n")).collect()}
    one = {spot: n for spot, n in found["k",].items() if n > 100}
    assert set(one) == {spot for spot, n in want.items() if n > 100} and all(want[s] <= n <= want[s] + len(data) / 500 for s, n in one.items())
    assert sum(n > 1000 for n in found["k", "j"].values()) == 4 and not [n for n in found["i",].values() if n > 100]
    kept, found = J.follow_keys(spark.createDataFrame([], "k string"), [["k"]], "followed")
    assert kept.count() == 0 and found == {("k",): {}}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_by_known_keys_bytes_and_other_types(spark, rows, how):
    left = spark.createDataFrame([(1, 2, i) for i in range(300)] + [(i, i, i) for i in range(50)] + [(None, 2, 0)] * 200, "a int, b int, i int")
    right = spark.createDataFrame([(1, 2, "x" * 50), (1, 2, "y"), (3, 3, None), (None, 2, "n")], "a int, b int, v string")
    plain = rows(J.equi_join(left, right, ["a", "b"], how))
    kept, found = J.follow_keys(left, [["a", "b"]], "followed")
    frequent = found["a", "b"]
    for limits in ({}, {"broadcast_bytes": 60}, {"hot_rows": 10**6}):
        assert rows(J.lookup_join(kept, right, ["a", "b"], how, **{"hot_rows": 100, "frequent": frequent} | limits)) == plain
    # What the sketch says changes no row: a key that is not there, cold keys called hot.
    assert rows(J.lookup_join(left, right, ["a", "b"], how, hot_rows=1, frequent={1: 9, **dict.fromkeys(frequent, 9)})) == plain
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [J.lookup_join(kept, right, ["a", "b"], how, hot_rows=100, broadcast_bytes=n, frequent=frequent)._jdf.queryExecution().executedPlan().toString() for n in (60, 10_000)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ["BroadcastHashJoin" in p for p in plans] == [False, True]
    longs = right.select(F.col("a").cast("bigint"), "b", "v")
    assert rows(J.lookup_join(left, longs, ["a", "b"], how, hot_rows=100)) == plain


def test_composite_renamed_semi_and_coalesce(spark, rows):
    a = spark.createDataFrame([(1, 2, "a"), (1, 3, "b")], "x int, y int, v string")
    b = spark.createDataFrame([(1, 2, "B")], "p int, q int, v string")
    assert rows(J.equi_join(a, b.drop("v"), [("x", "p"), ("y", "q")]), "x", "y", "v") == [(1, 2, "a")]
    parents = [(b.select("p"), [("x", "p")]), (b.select("q"), [("y", "q")])]
    assert rows(J.semi_all(a, parents)) == [(1, 2, "a")]
    c = spark.createDataFrame([(1, None, "k"), (2, "own", "k")], "id int, category string, o string")
    d = spark.createDataFrame([(1, "other"), (2, "late")], "id int, category string")
    assert rows(J.coalesce_join(c, d, ["id"], ["category"]), "id", "category") == [(1, "other"), (2, "own")]


def test_tiered_fill_takes_the_first_tier_with_rows(spark, rows):
    data = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", 1, 3), ("b", 3, 4)], "k string, tier int, v int")
    assert rows(J.tiered_fill(data, "k", "tier"), "k", "v") == [("a", 2), ("a", 3), ("b", 4)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("max_dist", [0, 1, 2, 3])
def test_fuzzy_pairs_equal_brute_force(spark, rows, max_dist):
    rng = random.Random(max_dist)

    def word():
        return "".join(rng.choice("abAB") for _ in range(rng.randint(0, 11)))

    left = {word() for _ in range(120)} | {"", "a", "needle in hay"}
    right = {word() for _ in range(120)} | {"", "b", "needl in hays"}
    got = rows(fuzzy_pairs(spark.createDataFrame([(w,) for w in left], "text string"),
                           spark.createDataFrame([(w,) for w in right], "text string"), max_dist))
    want = {(a, b, distance(a.lower(), b.lower())) for a in left for b in right if distance(a.lower(), b.lower()) <= max_dist}
    assert set(got) == want and len(got) == len(want)


def test_fuzzy_pairs_with_case(spark, rows):
    a = spark.createDataFrame([("Abc",), ("xyz",)], "text string")
    b = spark.createDataFrame([("abc",), ("xyzz",)], "text string")
    assert rows(fuzzy_pairs(a, b, 1, ignore_case=False)) == [("Abc", "abc", 1), ("xyz", "xyzz", 1)]


def test_fuzzy_join_keeps_copies_of_rows(spark, rows):
    a = spark.createDataFrame([(1, "gadwall"), (2, "gadwall"), (3, None)], "key int, name string")
    b = spark.createDataFrame([("Gadwal", "n1"), ("swift", "n2")], "wanted string, note string")
    assert rows(fuzzy_join(a, b, "name", "wanted"), "key", "wanted", "note", "distance") == [
        (1, "Gadwal", "n1", 1), (2, "Gadwal", "n1", 1)]


def inside(x, y, ring):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    return odd


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_spatial_join_equals_brute_force(spark, rows, how):
    rng = random.Random(3)
    shapes = []
    for i in range(40):
        size = 10 ** rng.uniform(-2, 1.5)
        cx, cy = rng.uniform(-20, 20), rng.uniform(-20, 20)
        ring = [(cx + rng.uniform(-size, size), cy + rng.uniform(-size, size)) for _ in range(rng.randint(3, 7))]
        shapes.append((i, [*ring, ring[0]]))
    points = [(i, rng.uniform(-25, 25), rng.uniform(-25, 25)) for i in range(600)] + [(600, None, 1.0)]
    wkt = [(i, "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))") for i, ring in shapes]
    polygons = spark.createDataFrame(wkt, "area int, wkt string").select("area", parse_polygon(F.col("wkt")).alias("polygon"))
    placed = spark.createDataFrame(points, "id int, x double, y double")
    pairs = {(p, a) for p, x, y in points if x is not None for a, ring in shapes if inside(x, y, ring)}
    if how == "inner":
        assert set(rows(spatial_join(placed, polygons, "x", "y"), "id", "area")) == pairs
    else:
        got = rows(spatial_join(placed.unionByName(placed.where("id < 10")), polygons, "x", "y", how="left_semi"), "id")
        found = {p for p, _ in pairs}
        assert sorted(r[0] for r in got) == sorted([*found, *[p for p in found if p < 10]])


def test_a_mismatched_type_of_join_is_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        J.lookup_join(df, df, ["id"], "full_outer")


def test_a_large_region_becomes_many_cells(spark):
    """Points in and around a star with a hole, beside small boxes, against ray casting."""
    rng = random.Random(5)
    star = [(math.cos(a) * r, math.sin(a) * r) for a, r in ((i * math.pi / 12, 90 if i % 2 else 40 + 2 * (i % 7)) for i in range(24))]
    hole = [(-8.5, -7.25), (9.0, -6.0), (2.0, 11.5)]
    shapes = {1: [star, hole], 2: [[(-80, -80), (80, -80), (80, 80), (-80, 80)]]} | {
        i: [[(x, y), (x + w, y), (x + w, y + w), (x, y + w)]] for i in range(3, 30) for x, y, w in [(rng.randint(-90, 90), rng.randint(-90, 90), rng.choice([0.5, 1, 3]))]}
    closed = {k: [[*ring, ring[0]] for ring in rings] for k, rings in shapes.items()}
    rings = spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in r] for r in v]) for k, v in closed.items()], "id int, polygon array<array<struct<x:double,y:double>>>")
    spots = [(rng.uniform(-95, 95), rng.uniform(-95, 95)) for _ in range(1500)] + [(float(x), float(y)) for x in range(-80, 81, 16) for y in range(-80, 81, 16)] + [(float("nan"), 1.0)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "p int, x double, y double")

    def holds(shape, x, y):
        crossed = 0
        for ring in shape:
            for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:], strict=True):
                crossed += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
        return crossed % 2 == 1

    want = sorted((i, k) for i, (x, y) in enumerate(spots) for k, shape in closed.items() if holds(shape, x, y))
    got = S.spatial_join(points, rings, "x", "y")
    assert sorted((r.p, r.id) for r in got.collect()) == want
    semi = S.spatial_join(points, rings, "x", "y", how="left_semi")
    assert sorted(r.p for r in semi.collect()) == sorted({i for i, _ in want})
    boxed = rings.where("id < 3").withColumns({"_box": G.bounds(F.col("polygon")), "_sides": G.edges(F.col("polygon"))})
    cells = S.cover(boxed.withColumn("_level", S._level(F.col("_box"))), F.lit(True)).collect()
    # Leaves do not overlap, inner ones hold no sides, and those on the border only a few.
    assert len({(c.id, c._level, c._cx, c._cy) for c in cells}) == len(cells) > 100
    assert sum(c._whole for c in cells) > 40 and all((c._sides is None) == c._whole for c in cells)
    assert max(len(c._sides) for c in cells if not c._whole and c.id == 1) < 20


def test_links_are_split_by_their_status(spark, rows):
    pages = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "a"), (6, "d")], "id int, url string")
    log = spark.createDataFrame([("a", "200"), ("b", "httr2_http_404"), ("c", "httr2_failure"), ("d", None), (None, "200")], "url string, status string")
    good, bad = apply_link_status(pages, log, "url")
    assert rows(good, "id") == [(1,), (3,), (4,), (5,), (6,)]
    assert rows(bad) == [(2, "b", "httr2_http_404")]
    good, bad = apply_link_status(pages, log, "url", keep_status=["200"])
    assert rows(good, "id") == [(1,), (5,)] and rows(bad, "id") == [(2,), (3,), (4,), (6,)]
    assert rows(apply_link_status(pages.limit(0), log, "url")[1]) == []


def test_boxes_crowded_cells_and_other_shapes_meet_their_points(spark, monkeypatch):
    """Corners and edges of boxes in several orders, shapes that only look like boxes, and cells cut into shares."""
    boxes = [[(0, 0), (4, 0), (4, 2), (0, 2)], [(1, 1), (1, 3), (3, 3), (3, 1)], [(4, 2), (0, 2), (0, 0), (4, 0)]]
    others = [[(0, 0), (4, 2), (4, 0), (0, 2)], [(0, 0), (4, 0), (4, 2), (4, 0)], [(0, 0), (2, 0), (4, 2), (0, 2)], [(0.0, 0), (1, 0), (-0.0, 0), (0, 1)]]
    closed = [[(float(x), float(y)) for x, y in [*ring, ring[0]]] for ring in [*boxes, *others]]
    shapes = spark.createDataFrame([(i, [ring]) for i, ring in enumerate(closed)] + [(99, None)], "area int, polygon array<array<struct<x:double,y:double>>>")
    spots = [(x / 2, y / 2) for x in range(-1, 10) for y in range(-1, 8)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "p int, x double, y double")
    known = shapes.where("area < 99").select("area", G.is_box(F.col("polygon"), G.bounds(F.col("polygon"))).alias("plain"))
    assert {r.area for r in known.collect() if r.plain} == {0, 1, 2}
    monkeypatch.setattr(S, "TASK_PAIRS", 5)
    got = S.spatial_join(points, shapes, "x", "y")
    assert got.rdd.getNumPartitions() > 4
    assert sorted((r.p, r.area) for r in got.collect()) == sorted((i, a) for i, (x, y) in enumerate(spots) for a, ring in enumerate(closed) if inside(x, y, ring))


def _boxes(spark, corners):
    rings = [(i, [[(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]]) for i, (x, y) in enumerate(corners)]
    return spark.createDataFrame(rings, "area int, polygon array<array<struct<x:double,y:double>>>")


def _spied(monkeypatch):
    counts, real = [], S._dealt

    def spy(*given):
        out = real(*given)
        counts.append(tuple(df.count() for df in out))
        return out

    monkeypatch.setattr(S, "_dealt", spy)
    return counts


@pytest.mark.parametrize("known", [200_000, 1])
def test_points_in_cells_without_polygons_are_not_dealt(spark, monkeypatch, known):
    monkeypatch.setattr(S, "KNOWN_CELLS", known, raising=False)
    shapes = _boxes(spark, [(-60.0, -60.0), (0.0, 0.0), (100.0, 100.0)])
    points = spark.createDataFrame([(i, i / 10, i / 10) for i in range(-600, 1010)], "p int, x double, y double")
    counts = _spied(monkeypatch)
    got = S.spatial_join(points, shapes, "x", "y")
    assert counts[0][0] < (100 if known > 1 else 2000)
    assert sorted((r.p, r.area) for r in got.collect()) == [(i, a) for a, at in ((0, -600), (1, 0), (2, 1000)) for i in range(at, at + 10)]


def test_shares_of_a_crowded_cell_repeat_few_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "TASK_PAIRS", 50)
    monkeypatch.setattr(S, "PLAIN_TIMES", 1, raising=False)
    shapes = _boxes(spark, [*[(i / 1000, 0.0) for i in range(200)], (1000.0, 1000.0)])
    points = spark.createDataFrame([(i, i / 200, 0.5) for i in range(200)], "p int, x double, y double")
    counts = _spied(monkeypatch)
    got = S.spatial_join(points, shapes, "x", "y")
    assert sum(counts[0]) < 40_000
    want = sorted((i, a) for i in range(200) for a in range(200) if a / 1000 <= i / 200 < a / 1000 + 1)
    assert sorted((r.p, r.area) for r in got.collect()) == want
