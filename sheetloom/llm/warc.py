"""WARC archives: written as text by Spark, read by a Python data source.

A record is a header block, a blank line, the content and two line ends, so Spark's text writer with that
line separator produces archives in any store it can write to, under its own commit protocol.

The reader plans partitions of whole files (small ones together), takes filters on record type and header fields from
Catalyst, parses the header of a record first and steps over the content of records that a filter rules out, without
decoding it. It streams: one record is in memory at a time.

Defined results: a null payload is empty; of equal payloads of at least ``SHARED`` bytes the rows with the largest
page_id are responses and the others revisits of it (null ids lose to any other; rows that share the largest id, which
nothing tells apart, are all responses); null ids and URLs leave their header out and come back as null; line ends in a
URL are percent-encoded. Empty tables give empty archives; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith

# The record format, and the least payload that is stored once only.
VERSION = "WARC/1.1"
END = "\r\n"
SHARED = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of small files that one partition reads.
PARTITION_BYTES = 64 << 20

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, refers_to string, "
    "content_length bigint, http_status int, http_content_type string, payload_length bigint, payload binary"
)
# Columns that come from the WARC header and can therefore decide before the content is read.
HEADER_FIELDS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
    "content_type": "content-type", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}


def payload_bytes(html: Column) -> Column:
    return F.coalesce(html.cast("binary"), F.lit(b""))


def roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", shared: int = SHARED) -> DataFrame:
    """page_id, url, payload, digest, size and refers_to (null for responses).

    Only digests of payloads that occur several times meet the pages again; both sides of that join are dealt by
    digest, so that adaptive execution can split a frequent payload.
    """
    payload = payload_bytes(F.col(f"`{html}`"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    groups = rows.where(F.col("size") >= shared).groupBy("digest").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    joined = rows.join(groups, "digest", "left")
    refers = F.when((F.col("size") >= shared) & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return joined.select("page_id", "url", "payload", "digest", "size", refers.alias("refers_to"))


def records(rows: DataFrame) -> DataFrame:
    """One text ``value`` per row of ``roles``: a whole WARC record without the separator that ends it."""

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)))

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))

    revisit = F.col("refers_to").isNotNull()
    safe_url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("size").cast("string"), F.lit(END + END)).cast("binary")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat_ws(
        "",
        F.lit(VERSION + END),
        F.when(revisit, F.lit(f"WARC-Type: revisit{END}")).otherwise(F.lit(f"WARC-Type: response{END}")),
        field("WARC-Record-ID", urn(F.col("page_id"))), field("WARC-Target-URI", safe_url),
        F.lit(f"WARC-Date: 1970-01-01T00:00:00Z{END}Content-Type: application/http; msgtype=response{END}"),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}{END}")), field("WARC-Refers-To", urn(F.col("refers_to"))),
        field("Content-Length", F.octet_length(block)), F.lit(END),
    )
    # A binary cast to string keeps its bytes as they are.
    return rows.select(F.concat(head.cast("binary"), block).cast("string").alias("value"))


def write_archives(rows: DataFrame, path: str, compression: str = "gzip") -> None:
    """Archives in ``path``, a file per task and 50 000 records at most."""
    records(rows).write.option("lineSep", END + END).option("compression", compression).option("maxRecordsPerFile", 50_000).text(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``; without ``payload`` no content is decoded at all.

    Filters on HEADER_FIELDS (equality, IN, prefix, not null) go down to the parser.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()


class Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


class WarcSource(DataSource):
    """Options: ``path`` (a folder or file, in any file system that pyarrow knows), ``payload`` (true or false)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true") == "true"
        self.tests: list[tuple[str, str, tuple[str, ...]]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep what the header can answer, hand back the rest."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADER_FIELDS and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.tests.append((HEADER_FIELDS[column], "in", (f.value,)))
            elif column in HEADER_FIELDS and isinstance(f, In):
                self.tests.append((HEADER_FIELDS[column], "in", tuple(f.value)))
            elif column in HEADER_FIELDS and isinstance(f, StringStartsWith):
                self.tests.append((HEADER_FIELDS[column], "prefix", (f.value,)))
            elif column in HEADER_FIELDS and isinstance(f, IsNotNull):
                self.tests.append((HEADER_FIELDS[column], "there", ()))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, path = file_system(self.path)
        found = fs.get_file_info(path)
        files = [found] if found.is_file else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        files = sorted((f for f in files if f.is_file and f.size and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
        out, size = [], PARTITION_BYTES
        for f in files:
            if size + f.size > PARTITION_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(f.path)
            size += f.size
        return out

    def fits(self, header: dict[str, str]) -> bool:
        for name, kind, values in self.tests:
            value = header.get(name)
            if value is None or (kind == "in" and value not in values) or (kind == "prefix" and not value.startswith(values[0])):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        rows: list[tuple] = []
        held = 0
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = [{"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]] for x in SCHEMA.split(", ")]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for path in partition.paths:
            with fs.open_input_stream(path, compression=None) as raw:
                # gzip.open reads archives of one member and of a member per record alike.
                source = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
                for row in self.records(io.BufferedReader(_Raw(source), 1 << 20)):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > 4 << 20:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()

    def records(self, source: io.BufferedReader) -> Iterator[tuple]:
        while line := source.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
            header = _fields(source)
            left = length = int(header["content-length"])
            if not self.fits(header):
                while left:  # stepped over, never decoded
                    left -= len(source.read(min(left, 1 << 20))) or _cut_short()
                continue
            status = kind = payload = size = None
            if length and header.get("content-type", "").startswith("application/http"):
                first = source.readline()
                status = int(first.split()[1])
                http, used = _fields(source, count=True)
                left -= len(first) + used
                kind = http.get("content-type")
                size = int(http["content-length"]) if "content-length" in http else left
            if self.payload and header.get("warc-type") != "revisit":
                payload = source.read(left)
                if len(payload) < left:
                    _cut_short()
            else:
                while left:
                    left -= len(source.read(min(left, 1 << 20))) or _cut_short()
            yield (*(header.get(HEADER_FIELDS[c]) for c in ("record_id", "record_type", "target_uri", "date", "content_type", "payload_digest", "refers_to")), length, status, kind, size, payload)


class _Raw(io.RawIOBase):
    """A stream with read() as a raw stream, so that lines can be read from it through a buffer."""

    def __init__(self, source) -> None:
        self.source = source

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.source.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def _cut_short() -> int:
    raise ValueError("a WARC record ends before its Content-Length")


def _fields(source, count: bool = False):
    out, used = {}, 0
    while line := source.readline():
        used += len(line)
        if line in (b"\r\n", b"\n"):
            break
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return (out, used) if count else out


def archive_pages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages to archives in ``path``, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are measured and digested from the payload as read; revisits, which store none, say both in their headers.
    """
    write_archives(roles(pages, page_id, url, html), path)
    read = read_archives(pages.sparkSession, path).where(F.col("record_type").isin("response", "revisit"))
    kind = dict(pages.dtypes)[page_id]

    def page(urn: str) -> Column:
        return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)

    whole = F.col("record_type") == "response"
    return read.select(
        page("record_id").alias("page_id"),
        F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"),
    )
