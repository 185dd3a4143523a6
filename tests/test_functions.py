from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetloom.functions import geometry as G
from sheetloom.functions import names as N
from sheetloom.functions import text as X
from sheetloom.functions.text import _even_lines


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).first().r


NAMES = [
    ("sp ace", "sp_ace"), ("a**^@", "a"), ("%", "percent"), ("*", "x"), ("d(!)9", "d_9"), ("can\"'t", "cant"),
    ("  leading spaces", "leading_spaces"), ("ação", "acao"), ("Farœ", "faroe"), ("testCamelCase", "test_camel_case"),
    ("average # of days", "average_number_of_days"), ("jan2009sales", "jan2009sales"), ("2 areas", "x2_areas"),
    ("usageKey", "usage_key"), ("HTMLParser", "html_parser"), ("Bechstein's", "bechsteins"), ("by-nc/4.0/", "by_nc_4_0"),
    (None, "na"), ("", "x"),
]


@pytest.mark.parametrize("raw, want", NAMES)
def test_clean_name_on_driver_and_in_columns(spark, raw, want):
    assert N.clean_name(raw) == want
    assert one(spark, N.clean_name_column(F.col("v")), v=raw) == want


def test_names_stay_distinct():
    assert N.clean_names(["a", "A", "b", "a!"]) == ["a", "a_2", "b", "a_3"]
    assert len(set(N.unique_names(["a", "a", "a_2"]))) == 3


@pytest.mark.parametrize("raw, want", [
    ("a-b", "a - b"), ("a - b", "a - b"), ("a -b", "a -b"), ("a--b", "a -  - b"), ("a, b;c  d", "a  b c d"), ("a,b", "a b"), (None, None),
])
def test_clean_text(spark, raw, want):
    assert one(spark, X.clean_text(F.col("v")), v=raw) == want


def test_templates_and_paste_write_missing_values(spark):
    assert one(spark, X.template("{a}: {b}!", a=F.col("a"), b=F.col("b")), a="x", b=None) == "x: NA!"
    assert one(spark, X.paste(F.col("a"), F.col("b"), sep="; "), a=None, b="y") == "NA; y"


def test_url_slug_and_scheme(spark):
    url = "https://x.example/get-ready-to-apply/countryside-stewardship-higher-tier-actions"
    assert one(spark, X.scheme_from_url(F.col("v")), v=url) == "CSHTA"
    assert one(spark, X.slug_code(F.col("v")), v="che3-planting-new-hedges") == "CHE3"
    assert one(spark, X.slug_description(F.col("v")), v="che3-planting-new-hedges") == "Planting new hedges"
    stub = "AHL1: Pollen (10%), x – y"
    assert one(spark, X.url_from_stub(F.col("v"), "https://f.example"), v=stub) == "https://f.example/ahl1-pollen-10-percent-x-y"


@pytest.mark.parametrize("raw, want", [
    ("AB1; CD22 text", "AB1; CD22"), ("see AB1", "PH1"), ("text", "PH1"), (None, None), ("BC3", "BC3"),
])
def test_grant_codes(spark, raw, want):
    got = one(spark, X.grant_codes(F.col("v")), v=raw)
    assert got == want


def test_codes_and_prefixes(spark):
    assert one(spark, X.valid_code(F.col("v"), 2), v="AB12") == "AB12"
    assert one(spark, X.valid_code(F.col("v"), 2), v="ABC12") is None
    assert one(spark, X.code_prefix(F.col("v")), v="AB12x") == "AB"
    assert one(spark, X.code_prefix(F.col("v")), v="Ab12") == ""
    assert one(spark, X.trailing_key(F.col("v")), v="data/species/gadwall__2498089") == 2498089
    assert one(spark, X.trailing_key(F.col("v")), v="data/species/gadwall__249808") is None
    assert one(spark, X.licence_short(F.col("v")), v="http://c.example/licenses/by-nc/4.0/") == "by-nc/4.0/"


def test_sentence_case(spark):
    assert one(spark, X.sentence_case(F.col("v")), v="ONE two. THREE! four") == "One two. Three! Four"


@pytest.mark.parametrize("file_name, licence, credit", [
    ("Gadwall_BY-NC_A B.jpg", "BY-NC", "A B"), ("Swift_by Jo.png", "by", "Jo"), ("Satan's bolete_BY_x'y.jpg", "BY", "x_y"),
])
def test_file_names(spark, file_name, licence, credit):
    parts = X.file_name_parts(F.lit("Name__123"), F.col("f"), F.lit("data/Name__123"), "up")
    assert one(spark, parts["license"], f=file_name) == licence
    assert one(spark, parts["attribution"], f=file_name) == credit
    assert one(spark, parts["usage_key"], f=file_name) == "123"
    assert one(spark, parts["write_path_thumbnail"], f=file_name).startswith("up/123__thumbnail__")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=9), max_size=7), st.integers(4, 12))
def test_even_wrapping_is_the_cheapest(words, width):
    lines = _even_lines(" ".join(words), width).split("\n") if words else []

    def cost(lines):
        if any(len(line) > width and " " in line for line in lines):
            return float("inf")
        return sum(max(width - len(line), 0) ** 2 if len(line) <= width else 0 for line in lines[:-1])

    options = []
    for n in range(len(words)):
        for cut in combinations(range(1, len(words)), n):
            ends = [0, *cut, len(words)]
            options.append([" ".join(words[a:b]) for a, b in zip(ends, ends[1:])])
    assert not words or cost(lines) == min(map(cost, options))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=14), max_size=12))
def test_wrapping_by_filling_lines(spark, words):
    got = one(spark, X.wrap(F.col("v"), 8), v=" ".join(words))
    lines, line = [], ""
    for word in words:
        if line and len(line) + 1 + len(word) <= 8:
            line += " " + word
        else:
            if line:
                lines.append(line)
            line = word
    assert got == "\n".join([*lines, line] if line else lines)


def test_wkt(spark):
    def parsed(wkt, parse=G.parse_polygon):
        return spark.range(1).select(parse(F.lit(wkt)).alias("p")).first().p

    ring = "0 0, 4 0, 4 4, 0 4, 0 0"
    assert len(parsed(f"POLYGON (({ring}))")[0]) == 5
    for broken in (f"POLYGON ({ring})", "POLYGON ((0 0, 4 0, 4 4, 0 4))", "POINT (1 2)", "POLYGON ((a b, c d, e f, a b))", None):
        assert parsed(broken) is None
    holed = f"polygon(({ring}),(1 1, 2 1, 2 2, 1 2, 1 1))"
    assert len(parsed(holed)) == 2
    many = f"MULTIPOLYGON ((({ring})), (({ring}), (1 1, 2 1, 2 2, 1 2, 1 1)))"
    assert [len(p) for p in parsed(many, G.parse_multipolygon)] == [1, 2]
    assert [len(p) for p in parsed(holed, G.parse_multipolygon)] == [2]
    shape = G.parse_polygon(F.lit(holed))
    area, hole, solid, out = spark.range(1).select(
        G.area(shape), G.contains(shape, F.lit(1.5), F.lit(1.5)), G.contains(shape, F.lit(3.0), F.lit(3.0)),
        G.contains(shape, F.lit(5.0), F.lit(3.0)),
    ).first()
    assert (area, hole, solid, out) == (15.0, False, True, False)
    bow = G.parse_polygon(F.lit("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))"))
    box = G.parse_polygon(F.lit(f"POLYGON (({ring}))"))
    assert tuple(spark.range(1).select(G.self_intersects(bow[0]), G.self_intersects(box[0])).first()) == (True, False)


def test_half_open_edges(spark):
    box = G.polygon_literal("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")
    points = [(0.0, 0.5, True), (1.0, 0.5, False), (0.5, 0.0, True), (0.5, 1.0, False)]
    df = spark.createDataFrame(points, "x double, y double, want boolean")
    assert df.where(G.contains(box, F.col("x"), F.col("y")) != F.col("want")).count() == 0
