"""Published tables, files and pages on small sheets with the awkward cells of real ones."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from sheetloom.operators import checks as Q
from sheetloom.operators.edits import load_report
from sheetloom.operators.links import apply_link_status, media_files
from sheetloom.plans import areas as PA
from sheetloom.plans import grants as PG
from sheetloom.plans import habitats as PH
from sheetloom.plans import measures as PM
from sheetloom.plans import normalise as PN
from sheetloom.plans import portal as PT
from sheetloom.plans import priorities as PP
from sheetloom.plans import species as PS
from sheetloom.session import scratch_path
from sheetloom.sinks import files as W
from sheetloom.sinks import publish as PUB
from sheetloom.sources import files as S
from sheetloom.sources import html as H
from sheetloom.sources.media import explode_media


@pytest.mark.parametrize("first, second, want", [
    ("AB1", "OF1", ["AB1", "OF1"]), ("AB1", None, ["AB1"]), (None, "OF1", [None, "OF1"]), (None, None, [None]), ("A1\r\n", None, ["A1"]),
])
def test_grant_cells_in_all_combinations(spark, first, second, want):
    row = [(1, "4", "Farmers", "Land", first, second)]
    df = spark.createDataFrame(row, "measure_id int, priority_id string, stakeholder string, measure_type string, ht string, other string")
    got = [r.grant_id for r in PM.split_grants(df, ["ht", "other"]).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    tidy = [r.grant_id for r in PM.split_grants(df, ["ht", "other"], drop_placeholder=True).collect()]
    assert sorted(tidy, key=str) == sorted([w for w in want if w] or [None], key=str)


def test_measures_from_a_sheet(spark, rows):
    sheet = spark.createDataFrame([
        (0, "Associated priority code", "Measure", "Stakeholder", None, None),
        (1, None, "no code", "A", "x", "x"), (2, "3", "plant", "A; B", "x", "X"), (3, "tbc", "dig", None, None, "x"),
    ], "_ord int, c1 string, c2 string, c3 string, x7 string, x7_2 string")
    measures = PM.raw_measures(sheet, 0, 4)
    assert rows(measures, "measure_id", "priority_id", "measure") == [(1, "3", "plant"), (2, "tbc", "dig")]
    assert rows(PM.area_rows(measures, ["measure_id"], ["x7", "x7_2"])) == [(1, 7), (2, 7)]


def test_wide_table_matches_missing_grants_with_missing_ones(spark, rows):
    split = spark.createDataFrame(
        [(1, 7, 3, "g"), (1, 7, 3, None), (1, 7, 3, "dead")], "measure_id int, area_id int, priority_id int, grant_id string")
    grants = spark.createDataFrame(
        [("g", "n", "s", "t", "u"), (None, "nothing", None, None, None), ("dead", "d", None, None, None)],
        "grant_id string, grant_name string, grant_scheme string, grant_summary string, url string")
    side = spark.createDataFrame([(7, "Area")], "area_id int, area_name string")
    priority = spark.createDataFrame([(3, "P")], "priority_id int, biodiversity_priority string")
    concise = spark.createDataFrame([(2, "c")], "measure_id int, concise_measure string")
    wide = PM.area_measures(split, side, priority, grants, side.withColumnRenamed("area_name", "local_funding_schemes"), concise)
    assert rows(wide, "grant_id", "grant_name", "concise_measure") == [("g", "n", None), (None, "nothing", None)]


def test_measures_without_benefit_leave_and_without_species_stay(spark, rows):
    base = spark.createDataFrame([(1,), (2,)], "measure_id int")
    benefits = spark.createDataFrame([(1, "b")], "measure_id int, benefits string")
    species = spark.createDataFrame([(2, "s")], "measure_id int, species string")
    concise = spark.createDataFrame([(1, "c")], "measure_id int, concise_measure string")
    assert rows(PM.measures_table(base, benefits, species, concise)) == [(1, "b", None, "c")]


def test_habitats(spark, rows):
    sheet = spark.createDataFrame([
        ("Habitat", 0, "x", "x"), ("Pond", 1, "x", None), ("Fen", 2, "X", "x"), (None, 3, "x", None), ("Bog", 4, "?", None),
    ], "identifier string, _ord int, x1 string, x12 string")
    bridge = PH.habitat_rows(sheet)
    assert rows(PH.habitat_texts(bridge, "h")) == [(1, "Pond:\nFen"), (12, "Fen")]
    tables = PH.habitat_tables(bridge.where("area_id = 12"), bridge)
    assert rows(tables["habitat"]) == [(1, "Fen"), (2, "Pond")]
    assert rows(tables["habitat_creation_area"]) == [(12, 1)]
    assert rows(tables["habitat_management_area"]) == [(1, 1), (1, 2), (12, 1)]
    # The sheets themselves are not read again.
    assert all("LocalTableScan" not in t._jdf.queryExecution().executedPlan().toString() for t in tables.values())
    none = PH.habitat_tables(bridge.where("false"), bridge.where("false"))
    assert all(t.count() == 0 for t in none.values())


def test_areas(spark, rows):
    sheet = spark.createDataFrame([
        (0, "7", "Vale-east, x", "d", "a; b\r\n", "S2; \nS1"), (1, "tbc", "n", None, None, None), (2, "8", "y", None, None, None),
    ], "_ord int, identifier string, title string, brief_narrative string, links_to_further_info_guidance string, local_funding_schemes string")
    parsed = PA.parsed_areas(sheet)
    assert rows(parsed, "area_id", "area_name", "area_link") == [(7, "Vale - east  x", "a; b"), (8, "y", None)]
    schemes = PA.funding_schemes(parsed)
    assert rows(schemes, "id", "local_funding_schemes") == [(1, "S2"), (2, "S1")]
    assert rows(PA.condensed_schemes(schemes)) == [(7, "S2\nS1")]


def test_older_priorities(spark, rows):
    sheet = spark.createDataFrame(
        [("Theme", "h", "h", None, None, 0), ("Water", "4", "rivers", "x", None, 1), ("Land", "2", "woods", "x", "x", 2)],
        "x1 string, x2 string, x3 string, a string, b string, _ord int")
    long = PP.priority_areas(sheet, ["theme", "priority_id", "biodiversity_priority"], [7, 112])
    assert rows(PP.priority_area_bridge(long)) == [(1, 4, 7), (2, 2, 7), (3, 2, 112)]
    assert rows(PP.priority_dimension(long, ["theme", "priority_id"])) == [(2, "Land"), (4, "Water")]


def test_species(spark, rows):
    sheet = spark.createDataFrame([(1, "3, x", 0), (2, None, 1)], "species_id int, relevant_priorities string, _ord int")
    assert rows(PS.species_priority(sheet)) == [(1, 3, 1), (2, None, 1), (3, None, 2)]
    matrix = spark.createDataFrame([(0, "h", "h", "x"), (1, "9", "n", "x"), (2, None, "n", "x"), (3, "5", "n", "X")],
                                   "_ord int, x1 string, identifier string, x1_2 string")
    assert rows(PS.species_area(matrix, 0)) == [(1, 9, 1)]
    names = PS.names_table(spark.createDataFrame([(1, "A b"), (2, "A-b")], "species_id int, common_name string"))
    measures = spark.createDataFrame([(5, "p", "m", "x", "X", "x")], "measure_id int, priority string, measure string, a_b string, a_b_2 string, gone string")
    assert rows(PS.species_measures(measures, names), "measure_id", "species_id", "place") == [(5, 1, 1), (5, 2, 2)]


def test_grants(spark, rows):
    assert rows(PG.other_funds(spark.createDataFrame([("OF1", None, None, 0)], "code string, fund_name string, link string, _ord int")),
                "grant_name", "url") == [("OF1: NA", None)]
    links = spark.createDataFrame([(" AB12: Title ", "/a"), ("AB Some", "/b"), ("About", "/c"), (None, "/d")], "text string, url string")
    assert rows(PG.listed_grants(links, "https://w.example"), "grant_id", "grant_name", "url") == [
        ("AB", "AB Some", "https://w.example/b"), ("AB12", "AB12: Title", "https://w.example/a")]
    codes = spark.createDataFrame([("AB", "MEANING here", PG.COUNTRYSIDE), ("CD", "m", "Other")], "code string, meaning string, scheme string")
    assert rows(PG.code_categories(codes)) == [("AB", "Meaning here")]


def normal_form(spark):
    source = spark.createDataFrame([
        (1, 7, 3, "Land", "Farmers", "g"), (1, 7, 3, "Water", "Owners", "g"), (1, 7, 3, "Land", "Farmers", None),
        (2, 7, 3, "Land", "Farmers", "unknown"), (9, 7, 3, "Land", "Farmers", None), (2, None, 3, None, None, None),
    ], "measure_id int, area_id int, priority_id int, measure_type string, stakeholder string, grant_id string")
    measures = spark.createDataFrame([(1, "m1"), (2, "m2")], "measure_id int, measure string")
    areas = spark.createDataFrame([(7, "a7"), (None, "none")], "area_id int, area_name string")
    priorities = spark.createDataFrame([(3, "p3")], "priority_id int, biodiversity_priority string")
    grants = spark.createDataFrame([("g", "G", "u"), (None, "x", "y")], "grant_id string, grant_name string, url string")
    return source, measures, areas, priorities, grants


def test_normal_form_and_its_view(spark, rows):
    parts = normal_form(spark)
    tables = PN.load_core(*parts)
    assert rows(tables["measure_area_priority"]) == [(1, 7, 3), (2, 7, 3)]
    assert rows(tables["measure_has_type"]) == [(1, 1), (1, 2), (2, 1)]
    # Types, stakeholders and grants of one fact multiply.
    view = PN.rebuild(tables)
    assert view.where("measure_id = 1").count() == 8
    assert rows(view.where("measure_id = 2"), "measure_type", "grant_id") == [("Land", None)]
    assert rows(PN.rebuild_hot(tables), *view.columns) == rows(view)
    report = load_report(tables, {n: PN.PRIMARY[n] for n in tables if n in PN.PRIMARY},
                         [r for r in PN.REFERENCES if r.child in tables and r.parent in tables])
    broken = {(r.table_name, r.rule): r.violations for r in report.collect() if r.violations}
    assert not broken
    # Without validation the facts of an unknown measure stay, as in the earlier load.
    loose = PN.load_core(*parts, validate=False)
    assert (9, 7, 3) in rows(loose["measure_area_priority"])
    assert (9, 7, 3, None) in rows(loose["measure_area_priority_grant"])
    source = parts[0].where("measure_id = 1")
    both = Q.compare_tables(source, view.where("measure_id = 1"), ["measure_id", "area_id", "priority_id", "measure_type", "stakeholder", "grant_id"])
    assert both.first().only_source == 0


def test_rest_of_the_normal_form(spark, rows):
    core = PN.load_core(*normal_form(spark))
    published = {
        "species": spark.createDataFrame([(1, "S"), (None, "x")], "species_id int, common_name string"),
        "species_area": spark.createDataFrame([(1, 7), (1, 99)], "species_id int, area_id int"),
        "species_priority": spark.createDataFrame([(1, 3), (1, 4)], "species_id int, priority_id int"),
        "benefits": spark.createDataFrame([(1, "b")], "benefit_id int, benefit string"),
        "measure_has_benefits": spark.createDataFrame([(1, 1), (5, 1)], "measure_id int, benefit_id int"),
        "area_funding_schemes": spark.createDataFrame([(1, 7, "a7", "f"), (2, 8, "a8", "f")], "id int, area_id int, area_name string, local_funding_schemes string"),
    }
    tables = PN.load_rest(core, published)
    assert rows(tables["species_area_priority"]) == [(1, 7, 3)]
    assert rows(tables["measure_has_benefits"]) == [(1, 1)] and rows(tables["area_funding_schemes"], "id") == [(1,)]
    assert tables["species"].count() == 1 and len(PN.SCHEMAS) == 20


def test_portal_page(spark, rows):
    slim = spark.createDataFrame(
        [(1, "m", 3, "p", "Land", "Core", "F", 7, "g", "G", "u", None, None), (1, "m", 3, "p", "Water", "Core", "F", 7, None, None, None, None, None)],
        "measure_id int, measure string, priority_id int, biodiversity_priority string, measure_type string, core_supplementary string, "
        "stakeholder string, area_id int, grant_id string, grant_name string, url string, concise_measure string, link_to_further_guidance string")
    page = PT.page(slim, {"area_id": [7], "measure_type": ["Water"]})
    assert rows(page["facets"]) == [("core_supplementary", "Core", 1), ("measure_type", "Land", 1), ("measure_type", "Water", 1), ("stakeholder", "F", 1)]
    assert page["measures"].count() == 1 and page["grants"].count() == 0 and rows(page["grants_exist"]) == [(False,)]
    details = spark.createDataFrame([(1, "a\nb", "p\nq"), (2, None, "p")], "measure_id int, species string, benefits string")
    assert len(rows(PT.measure_details(details, long=True))) == 5 and rows(PT.measure_details(details, [2])) == [(2, None, "p")]


def test_links_and_media(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, url string")
    log = spark.createDataFrame([("a", "200"), ("b", "httr2_http_404"), ("c", "httr2_failure")], "url string, status string")
    good, failed = apply_link_status(df, log, "url")
    assert rows(good, "id") == [(1,), (3,)] and rows(failed, "id") == [(2,)]
    good, failed = apply_link_status(df, log, "url", keep_status=["200"])
    assert rows(good, "id") == [(1,)] and rows(failed, "id") == [(2,), (3,)]
    json = '[{"rightsHolder": "A. B", "media": [{"format": "image/jpeg", "identifier": "u", "license": "http://c/by-nc/4.0/"}, {"format": "video"}]}, {"media": []}]'
    media = explode_media(spark.createDataFrame([(7, json), (8, "broken"), (9, None)], "usage_key int, json string"), "json", ["usage_key"])
    assert media.count() == 2
    names = spark.createDataFrame([(7, "Small Blue")], "usage_key int, common_name string")
    assert rows(media_files(media, names, "usage_key", "d"), "file_path") == [("d/small_blue__7/small_blue__by_nc_4_0__a_b__.jpg",)]


def test_html(spark, rows):
    page = """<HTML lang='en'><a class="x" href="/a?x=1&amp;y=2">A <b>b</b> &amp; c</a><a name=n>no address</a><a href=/bare>d</a>
      <h3 id="AB1-x">t</h3><h3>none</h3><div class="ad wide">one<br>two</div><div class="other">z</div>
      <table><tr><th>Code</th><th>SFI action</th><tr><td>A<td>1 <i>x</i></table><table><tr><td>only</td></tr></table></HTML>"""
    pages = spark.createDataFrame([(1, page), (2, None), (3, "plain")], "id int, html string")
    assert rows(H.extract_links(pages, "html", ["id"]), "text", "url") == [("A b & c", "/a?x=1&y=2"), ("d", "/bare"), ("no address", None)]
    assert rows(H.extract_attr(pages, "html", "h3", "id", ["id"], "v"), "position", "v") == [(0, "AB1-x")]
    assert rows(H.extract_attr(pages, "html", "html", "lang", ["id"], "v"), "v") == [("en",)]
    assert rows(H.extract_text(pages, "html", "div", "ad", ["id"]), "text", "first_line") == [("one\ntwo", "one")]
    tables = H.extract_tables(pages, "html", "id", ncol=2)
    assert rows(H.table_columns(tables, ["Code", "SFI action"], "id")) == [(1, "A", "1 x")]
    assert rows(H.page_urls(spark, "https://l", 3), "url") == [("https://l",), ("https://l?page=2",), ("https://l?page=3",)]


def test_files(spark, rows):
    df = spark.createDataFrame([(1, 1.5, 'say "a;b"\nnext', None), (2, None, "", "z")], "id int, v double, t string, n string")
    path = scratch_path(spark, "delim")
    W.write_delim(df.coalesce(1), path)
    raw = b"".join(open(f, "rb").read() for f in glob.glob(f"{path}/*.csv"))
    assert b"id;v;t;n\n1;1,5;" in raw
    assert rows(S.read_delim(spark, path, ";", df.schema, decimal_comma=True), "id", "v", "n") == [(1, 1.5, None), (2, None, "z")]
    assert rows(S.read_delim(spark, path, ";"), "t")[-1][0] in ("", None, 'say "a;b"\nnext')
    excel = scratch_path(spark, "excel")
    W.write_excel_csv(df.coalesce(1), excel)
    assert all(open(f, "rb").read().startswith(b"\xef\xbb\xbfid,") for f in glob.glob(f"{excel}/*.csv"))
    arrays = scratch_path(spark, "arrays")
    W.write_json_array(df.repartition(2), arrays)
    assert spark.read.option("multiLine", True).json(arrays).count() == 2
    bundle = S.read_bundle(spark, {"My sheet": path}, sep=";")
    assert S.pluck(bundle, "my_sheet").columns == ["id", "v", "t", "n"]
    with pytest.raises(KeyError):
        S.pluck(bundle, "gone")
    folder = scratch_path(spark, "parts")
    os.makedirs(folder)
    for name, first, last in (("a.csv", 0, 3), ("b.csv", 3, 400), ("c.csv", 400, 402)):
        with open(f"{folder}/{name}", "w") as out:
            out.write("id\n" + "".join(f"{i}\n" for i in range(first, last)))
    lines = S.with_order(S.read_csv(spark, folder, "id int", multi_line=False)).orderBy("_ord").select("id")
    assert [r[0] for r in lines.collect()] == list(range(402))
    listing = S.list_files(spark, path, "*.csv")
    assert listing.count() >= 1 and rows(listing.select((F.col("length") > 0).alias("ok")).distinct()) == [(True,)]


def test_a_failed_load_is_never_read(spark, rows):
    root = scratch_path(spark, "root")
    good = {"t": spark.createDataFrame([(1,)], "id int")}
    bad = {"t": spark.createDataFrame([(1,), (1,)], "id int")}
    assert PUB.current_version(spark, root) is None
    assert PUB.bulk_load(spark, root, 1, good, {"t": ["id"]})[0]
    sound, report = PUB.bulk_load(spark, root, 2, bad, {"t": ["id"]})
    assert not sound and rows(report, "violations") == [(2,)]
    assert PUB.current_version(spark, root) == 1 and rows(PUB.read_published(spark, root, "t")) == [(1,)]
    with pytest.raises(FileNotFoundError):
        PUB.read_published(spark, root + "-none", "t")


def test_helpers_of_python_tasks_travel_with_the_task(tmp_path):
    """A worker without this package can still run them."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from sheetloom.functions.text import _even_lines
    from sheetloom.sources.html import _page_tables

    (tmp_path / "job.bin").write_bytes(cloudpickle.dumps((_page_tables, _even_lines)))
    script = (
        "import pickle; tables, wrap = pickle.load(open('job.bin', 'rb'));"
        "print(tables('<table><tr><td>a</table>'), wrap('aa bb cc', 5).split())"
    )
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "[[['a']]] ['aa', 'bb', 'cc']", done.stderr
