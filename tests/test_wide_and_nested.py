"""Wide ids, hot keys beside small ones, repeated suffixes, nested markup and grids of several sizes."""

import html
import html.entities
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from sheetloom.operators import aggregate as A
from sheetloom.operators import ordering as O
from sheetloom.operators import projection as P
from sheetloom.operators import reshape as R
from sheetloom.operators import spatial as S
from sheetloom.functions import geometry as G
from sheetloom.functions.names import unique_names
from sheetloom.functions.text import trailing_key
from sheetloom.plans import normalise as N
from sheetloom.sinks import publish as PUB
from sheetloom.session import scratch_path, staged_by, staged_together
from sheetloom.sources import html as H
from sheetloom.suite.registry import Tables


def test_ids_beyond_32_and_53_bits(spark):
    texts = ["3000000000", "9007199254740993", "9223372036854775807", "-4e9", "12.9", "x", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(P.as_integer(F.col("t"))).collect()] == [3000000000, 9007199254740993, 9223372036854775807, -4000000000, 12, None, None, None]
    head = spark.createDataFrame([("x3000000000_2",)], "h string")
    assert head.select(R.prefixed_id(F.col("h"))).first()[0] == 3000000000
    assert spark.createDataFrame([("bee__9007199254",)], "h string").select(trailing_key(F.col("h"), 10)).first()[0] == 9007199254


def test_a_hot_key_leaves_small_ones_in_one_piece(spark, rows):
    data = [("hot", i) for i in range(1000)] + [(f"k{j}", i) for j in range(10) for i in range(j + 1)] + [(None, 1)]
    df = spark.createDataFrame(data, "k string, v int")
    nested = A.nest(df, ["k"], nest_rows=100)
    pieces = {r.k: r.n for r in nested.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert pieces.pop("hot") == 10 and set(pieces.values()) == {1}
    assert rows(A.unnest(nested, ["k"])) == rows(df)


def test_suffixes_never_collide(spark):
    names = ["a", "a", "a_2", None, None, "a_2", "b"]
    df = spark.createDataFrame(list(enumerate(names)), "o int, n string")
    got = [r.u for r in O.unique_suffix(df, "n", ["o"], "u").orderBy("o").collect()]
    # A column of values and a header come out alike.
    assert [v for v in got if v] == unique_names([n for n in names if n]) and got[3] is None and got[4] is None


def test_totals_compute_two_levels_only(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "x", 3)], "g string, h string, v int")
    out = A.with_totals(df, ["g", "h"], s=F.sum("v"))
    assert sorted((r.g or "", r.h or "", r.s, r.is_total) for r in out.collect()) == [("", "", 6, True), ("", "x", 3, False), ("a", "x", 1, False), ("a", "y", 2, False)]


def test_known_or_null_reads_its_rows_once(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("z", 3), ("a", 4)], "g string, v int")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "g string")
    out = P.known_or_null(df, "g", known)
    assert rows(out) == rows(df.where("v <> 3"))


PAGE = (
    "<div class='outer'><div class='ad'>one<div>in</div>two</div></div><ul><li>a &#163;5 &ndash; 6<ul><li>b<li>c &amp;lt;</ul></li><li class='x y'>d</ul>"
    "<a href='/q?a=1&amp;b=&#x41;'>caf&eacute; &bogus; &#128512;</a><table><tr><th>Code<th>Rate<tr><td>A<td>1</table><table><tr><th>Rate<th>Note<tr><td>2<td>n</table>"
)


def test_nested_elements_and_references(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "id int, html string")

    def texts(tag, cls=None):
        return [r.text for r in H.extract_text(pages, "html", tag, cls, ["id"]).collect()]

    assert texts("div", "ad") == ["oneintwo"] and texts("div") == ["oneintwo", "oneintwo", "in"]
    assert texts("li") == ["a £5 – 6bc &lt;", "b", "c &lt;", "d"] and texts("li", "y") == ["d"]
    link = H.extract_links(pages, "html", ["id"]).first()
    assert (link.text, link.url) == ("café &bogus; \U0001f600", "/q?a=1&b=A")


def test_tables_stand_under_their_own_headers(spark, rows):
    pages = spark.createDataFrame([(1, PAGE), (2, "<table><tr><td>Note<td>Code<tr><td>m<td>B<tr><td>only</table>")], "id int, html string")
    stacked = H.stacked_tables(H.extract_tables(pages, "html", "id", ncol=2), "id", ["code", "rate", "note"])
    assert rows(stacked, "id", "code", "rate", "note") == rows(spark.createDataFrame([(1, "A", "1", None), (1, None, "2", "n"), (2, "B", None, "m")], "id int, code string, rate string, note string"))


def test_semi_join_over_many_grid_sizes(spark):
    g = random.Random(1)
    squares = [(i, f"MULTIPOLYGON((({x} {y},{x + s} {y},{x + s} {y + s},{x} {y + s},{x} {y})))") for i, s in enumerate([0.5, 1, 3, 9, 20, 70]) for x, y in [(g.uniform(0, 60), g.uniform(0, 60))]]
    shapes = spark.createDataFrame(squares, "id int, wkt string").select("id", F.explode(G.parse_multipolygon(F.col("wkt"))).alias("polygon"))
    points = spark.createDataFrame([(i, g.uniform(-10, 140), g.uniform(-10, 140)) for i in range(400)] + [(400, None, 1.0)], "p int, x double, y double")
    inner = {r.p for r in S.spatial_join(points, shapes, "x", "y").collect()}
    semi = S.spatial_join(points, shapes, "x", "y", how="left_semi")
    got = sorted(r.p for r in semi.collect())
    assert got == sorted(inner) and got
    assert semi._jdf.queryExecution().optimizedPlan().toString().count("points-") <= 2


def test_the_polygons_box_reaches_the_scan(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    shape = spark.range(1).select(G.polygon_literal("POLYGON((10 1,20 1,20 5,10 1))").alias("polygon"))
    plan = S.near_occurrences(t.events.withColumn("y", F.col("value")), shape, t.events.select("event_type"), "value", "y", "ts", 2019, 2024, "event_type")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(value,10.0)" in text and "GreaterThanOrEqual(ts" in text


def test_rebuilding_broadcasts_dimensions_and_deals_facts_by_triple(spark):
    text = driver.queries()["star_view"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning(priority_id" not in text


def test_a_refused_load_can_be_repeated(spark):
    root = scratch_path(spark, "published")
    good, bad = spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(1,), (1,)], "id int")
    assert not PUB.bulk_load(spark, root, 3, {"t": bad}, {"t": ["id"]})[0] and PUB.current_version(spark, root) is None
    assert PUB.bulk_load(spark, root, 3, {"t": good}, {"t": ["id"]})[0] and PUB.current_version(spark, root) == 3
    with pytest.raises(ValueError, match="published already"):
        PUB.bulk_load(spark, root, 3, {"t": good}, {"t": ["id"]})


def test_tables_written_together_come_back_as_they_were(spark):
    one = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, [1, 2])], "id int, A string, l array<int>")
    two = spark.createDataFrame([("x", 5, "y"), (None, None, None)], "a string, `my id` bigint, B string")
    none = spark.createDataFrame([], "id int, a string")
    counts = {}
    back = staged_together({"one": one, "two": two, "none": none}, "together", distinct={"one", "none"}, counts=counts)
    assert {n: df.dtypes for n, df in back.items()} == {n: df.dtypes for n, df in {"one": one, "two": two, "none": none}.items()}
    assert sorted(map(str, back["one"].collect())) == sorted(map(str, one.distinct().collect()))
    assert sorted(map(str, back["two"].collect())) == sorted(map(str, two.collect()))
    assert counts == {"one": 2, "two": 2, "none": 0} and back["none"].count() == 0 and staged_together({}, "nothing") == {}


def test_rows_are_written_by_their_tag(spark):
    rows = spark.createDataFrame([("a/b", 1), ("c", 2), (None, 3), ("other", 4), ("a/b", 5)], "t string, v int")
    parts = staged_by(rows, "t", ["a/b", "c", "absent"], "tagged")
    assert {k: sorted(r.v for r in df.collect()) for k, df in parts.items()} == {"a/b": [1, 5], "c": [2], "absent": []}


def test_the_normal_form_takes_few_jobs(spark):
    group = "normal form"
    spark.sparkContext.setJobGroup(group, group)
    try:
        driver.queries()["star_view"](spark, "/root/testdata/sf0.001")
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 18


def test_values_are_numbered_alike_on_both_routes(spark, monkeypatch):
    values = spark.createDataFrame([("t", f"v{i:03}") for i in range(300)] + [("s", "only")], "kind string, value string")
    short = sorted(map(tuple, N.numbered_values(values, 301).collect()))
    monkeypatch.setattr(O, "TABLE_ROWS", 10)
    assert sorted(map(tuple, N.numbered_values(values, 301).select("kind", "value", "id").collect())) == short


def test_repeated_benefits_count_once(spark):
    core = {"measure": spark.createDataFrame([(1,)], "measure_id bigint")}
    benefits = spark.createDataFrame([(1, "b"), (1, "b"), (2, "b")], "benefit_id int, benefit string")
    assert sorted(map(tuple, N.load_rest(core, {"benefits": benefits})["benefits"].collect())) == [(1, "b"), (2, "b")]


def test_references_are_decoded_as_a_parser_does(spark):
    rng = random.Random(3)
    names = rng.sample(sorted(html.entities.html5), 400)
    texts = [f"a&{n}b" for n in names] + [f"x &{n.rstrip(';')} y" for n in names[:100]]
    texts += [f"&#{n};" for n in (0, 1, 9, 10, 11, 13, 31, 65, 127, 128, 129, 150, 159, 160, 55296, 64976, 65534, 128512, 1114111, 1114112, 10**12, 10**30)]
    texts += [f"&#x{n:X} z" for n in (0, 65, 0x80, 0x1F600, 0x10FFFF, 0x110000, 16**20)] + ["&#0000000000065;", "&#x00000000041;", "&#;&#x;&;&&amp;amp;", "&lbrace;&NewLine;&amp &notit; &nosuch; &ampfoo; & b"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", H.decoded(F.col("t")).alias("d"))
    assert {r.i: r.d for r in rows.collect()} == {i: html.unescape(t) for i, t in enumerate(texts)}


def test_links_texts_and_tables_decode_alike(spark):
    body = "&lbrace;x&amp y&#128;&nbsp"
    page = f'<div>{body}</div><a href="/p?a=1&copy=2&amp;b=&#128;">{body}</a><table><tr><td>h</td></tr><tr><td>{body}</td></tr></table>'
    pages = spark.createDataFrame([(1, page)], "k int, html string")
    want = html.unescape(body)
    link = H.extract_links(pages, "html", ["k"]).first()
    assert link.text == want and link.url == "/p?a=1&copy=2&b=€"
    assert H.extract_text(pages, "html", "div", None, ["k"]).first().text == want
    assert H.extract_tables(pages, "html", "k", 1).where("row = 1").first().cells[0] == " ".join(want.split())
