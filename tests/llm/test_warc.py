"""Archives written and read back; filters that reach the parser."""

import hashlib

from pyspark.sql import functions as F

from sheetloom.llm import warc
from sheetloom.session import scratch_path

BIG = "<p>payload</p>\r\n\r\nWARC/1.1\r\n" * 60


def pages(spark):
    return spark.createDataFrame(
        [
            (1, "http://a/1", BIG, 1), (2, "http://a/2", BIG, 1), (3, None, "short", 1), (4, "http://a/4", "short", 1), (5, "http://a/5\r\nX: y", None, 1),
            (None, "http://a/null", BIG, 1), (6, "http://a/6", "", 1), (7, "http://a/7", "ä" * 500, 2), (7, "http://a/7", "ä" * 500, 2), (8, "u", "é" * 499 + "a", None),
        ],
        "page_id bigint, url string, html string, payload int",
    )


def test_round_trip(spark):
    got = sorted(map(tuple, warc.archive_pages(pages(spark), scratch_path(spark, "t")).collect()), key=str)
    want = []
    for i, _, html, _ in pages(spark).collect():
        body = (html or "").encode()
        first = 2 if html == BIG and i != 2 else None
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if first else "response", first))
    assert got == sorted(want, key=str)


def test_payload_and_headers(spark):
    path = scratch_path(spark, "t")
    warc.write_archives(warc.roles(pages(spark)), path)
    rows = {r.record_id: r for r in warc.read_archives(spark, path).collect()}
    assert bytes(rows["<urn:page:2>"].payload).decode() == BIG and rows["<urn:page:1>"].payload is None
    assert rows["<urn:page:5>"].target_uri == "http://a/5%0D%0AX: y" and rows["<urn:page:5>"].payload_length == 0
    assert rows["<urn:page:1>"].http_status == 200 and rows["<urn:page:1>"].payload_length == len(BIG)


def test_filters_are_pushed_down(spark):
    path = scratch_path(spark, "t")
    warc.write_archives(warc.roles(pages(spark)), path, "none")
    read = warc.read_archives(spark, path, payload=False)
    some = read.where((F.col("record_type") == "revisit") & F.col("record_id").startswith("<urn:page:1"))
    assert [r.record_id for r in some.collect()] == ["<urn:page:1>"]
    assert "record_type = revisit" not in some._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    assert read.where("payload is not null").count() == 0 and read.count() == 10


def test_skipped_content_is_not_read():
    reader = warc.WarcReader({"path": "x"})
    list(reader.pushFilters([warc.EqualTo(("record_type",), "response")]))
    assert not reader.fits({"warc-type": "revisit"}) and reader.fits({"warc-type": "response"})


def test_empty_table(spark):
    assert warc.archive_pages(pages(spark).limit(0), scratch_path(spark, "t")).count() == 0
