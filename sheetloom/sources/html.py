"""Pieces of HTML pages as rows. Links and attributes stay on the JVM; nested elements and tables use a parser."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.functions.names import clean_name_column, clean_names
from sheetloom.session import spread, staged

# Character references: decimal, hexadecimal or named. The standard library has the names of HTML 5, the older ones also
# without a semicolon; the longest of several that fit counts.
_OLD_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
REFERENCE = rf"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{{1,31}};|(?:{_OLD_NAMES}))"
# In an attribute an old name that goes on, as in the parts of an address, is no reference.
GOES_ON = "(?![=A-Za-z0-9])"
BUCKETS = 4096


@cache
def _names_text() -> str:
    lists: list[list[dict]] = [[] for _ in range(BUCKETS)]
    for name, value in html5.items():
        lists[zlib.crc32(name.encode()) % BUCKETS].append({"n": name, "v": value})
    return json.dumps(lists)


def _names() -> Column:
    """The names as a literal: short lists by the check sum of the name, since Spark's own map is searched from end to end."""
    return F.from_json(F.lit(_names_text()), "array<array<struct<n:string,v:string>>>")


def _named(names: Column, name: Column) -> Column:
    bucket = F.get(names, (F.crc32(name.cast("binary")) % BUCKETS).cast("int"))
    return F.get(F.transform(F.filter(bucket, lambda e: e["n"] == name), lambda e: e["v"]), F.lit(0))


def _numbered(digits: Column) -> Column:
    """The character of a hexadecimal number, as a browser reads it: old Windows characters for 128 to 159, nothing for other controls."""
    windows = F.array(*[F.lit(bytes([c]).decode("cp1252", "ignore") or chr(c)) for c in range(0x80, 0xA0)])
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    code = F.when(F.length(short) > 6, F.lit(0x110000)).otherwise(F.conv(short, 16, 10).cast("long"))
    wrong = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    none = (code.between(1, 0x1F) & ~code.isin(9, 10, 12, 13)) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    plain_ = F.decode(F.unhex(F.lpad(F.conv(code.cast("string"), 10, 16), 8, "0")), "UTF-32")
    return (
        F.when(wrong, F.lit("\ufffd")).when(code.between(0x80, 0x9F), F.get(windows, (code - 0x80).cast("int")))
        .when(none, F.lit("")).otherwise(plain_)
    )


def decoded(text: Column, in_attribute: bool = False) -> Column:
    """Text with its character references decoded, each once; unknown ones stay as they are."""
    pattern = REFERENCE[:-1] + f"{GOES_ON if in_attribute else ''})"
    old = f"^(?:{_OLD_NAMES}){GOES_ON if in_attribute else ''}"

    def character(names: Column, ref: Column) -> Column:
        inner = F.substring(ref, F.lit(2), F.length(ref))
        digits = F.rtrim(F.substring(inner, F.lit(2), F.length(inner)), F.lit(";"))
        hexed = F.when(F.lower(F.left(digits, F.lit(1))) == "x", F.substring(digits, F.lit(2), F.length(digits))).otherwise(
            F.when(F.length(F.regexp_replace(digits, "^0+", "")) > 7, F.lit("110000")).otherwise(F.conv(digits, 10, 16)))
        start = F.regexp_extract(inner, old, 0)
        prefixed = F.when(start != "", F.concat(_named(names, start), F.substring(inner, F.length(start) + 1, F.length(inner))))
        return F.when(inner.startswith("#"), _numbered(hexed)).otherwise(F.coalesce(_named(names, inner), prefixed, ref))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    # An array of one element binds the table of names, so that the plan holds it once.
    characters = F.get(F.transform(F.array(_names()), lambda names: F.transform(found, lambda ref: character(names, ref))), F.lit(0))
    joined = F.array_join(F.zip_with(pieces, characters, lambda piece, char: F.concat(piece, F.coalesce(char, F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def plain(html: Column) -> Column:
    """Text of a fragment: tags dropped, character references decoded."""
    return decoded(F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", ""))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in an opening tag, quoted or bare; null where the tag lacks it."""
    pattern = rf"""(?is)^<[^>]*?\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    found = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(pattern), decoded(found, in_attribute=True))


def _flat_elements(html: Column, tag: str) -> Column:
    """Elements that never hold one of their own kind, such as links."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>"), F.lit(0))


def extract_links(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """Text and address of every link of every page; a link without address has a null one."""
    found = pages.select(*keep, F.posexplode(_flat_elements(F.col(html), "a")).alias("position", "_a"))
    return found.select(*keep, "position", plain(F.col("_a")).alias("text"), attribute(F.col("_a"), "href").alias("url"))


def extract_attr(pages: DataFrame, html: str, tag: str, attr: str, keep: list[str], name: str) -> DataFrame:
    """An attribute of every such tag that has it, with the tag's position on its page."""
    opened = F.regexp_extract_all(F.col(html), F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>"), F.lit(0))
    tags = pages.select(*keep, F.posexplode(opened).alias("position", "_tag"))
    return tags.select(*keep, "position", attribute(F.col("_tag"), attr).alias(name)).where(F.col(name).isNotNull())


def extract_text(pages: DataFrame, html: str, tag: str, cls: str | None, keep: list[str]) -> DataFrame:
    """Text of every such element with what it holds, and its first line; with ``cls`` only elements of that class.

    An element inside one of its own kind is an element too, as a parser sees it; the pages stay where they are.
    """
    kept = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").alias("_html"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_of = batch.column("_html").to_pylist()
            texts = [(i, text) for i, page in enumerate(pages_of) if page is not None for text in _element_texts(page, tag, cls)]
            at = pa.array([i for i, _ in texts], pa.int64())
            names = [n for n in batch.schema.names if n != "_html"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n).take(at) for n in names], pa.array([t for _, t in texts], pa.string())], names=[*names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "_html")
    found = kept.mapInArrow(parse, f"{fields}, text string")
    return found.select(*keep, "text", F.element_at(F.split("text", "\n"), 1).alias("first_line"))


# Elements whose end tag may be left out, and what an open one does not reach out of.
OPTIONAL_END = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "td": ("table",), "th": ("table",), "tr": ("table",), "p": ("div", "td", "li", "section"),
}


class _Elements(HTMLParser):
    """Texts of the elements of one kind, in the order in which they open."""

    def __init__(self, tag: str, cls: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.cls, self.fence = tag, cls, OPTIONAL_END.get(tag, ())
        self.texts: list[str | None] = []
        self.open: list[tuple[int, int]] = []
        self.depth = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.handle_data("\n")
        if tag in self.fence:
            self.depth += 1
        if tag == self.tag:
            if self.fence and self.open and self.open[-1][1] == self.depth:
                self.open.pop()
            classes = (dict(attrs).get("class") or "").split()
            self.texts.append("" if self.cls is None or self.cls in classes else None)
            self.open.append((len(self.texts) - 1, self.depth))

    def handle_endtag(self, tag: str) -> None:
        if tag == self.tag and self.open:
            self.open.pop()
        if tag in self.fence:
            self.depth -= 1
            while self.open and self.open[-1][1] > self.depth:
                self.open.pop()

    def handle_data(self, data: str) -> None:
        for place, _ in self.open:
            if self.texts[place] is not None:
                self.texts[place] += data


def _element_texts(html: str, tag: str, cls: str | None) -> list[str]:
    parser = _Elements(tag, cls)
    parser.feed(html)
    parser.close()
    return [text.strip(" ") for text in parser.texts if text is not None]


class _Tables(HTMLParser):
    """Cells of the tables of one page, nested tables apart."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.done: list[list[list[str]]] = []
        self.open: list[list[list[str]]] = []
        self.cell: list[bool] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.open.append([])
            self.cell.append(False)
        elif self.open and tag == "tr":
            self.open[-1].append([])
            self.cell[-1] = False
        elif self.open and tag in ("td", "th"):
            if not self.open[-1]:
                self.open[-1].append([])
            self.open[-1][-1].append("")
            self.cell[-1] = True

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.done.append(self.open.pop())
            self.cell.pop()
        elif self.cell and tag in ("td", "th", "tr"):
            self.cell[-1] = False

    def handle_data(self, data: str) -> None:
        if self.cell and self.cell[-1]:
            self.open[-1][-1][-1] += data


def _page_tables(html: str) -> list[list[list[str]]]:
    parser = _Tables()
    parser.feed(html)
    parser.close()
    return [[[re.sub(r"\s+", " ", cell).strip() for cell in row] for row in table] for table in parser.done]


def extract_tables(pages: DataFrame, html: str, key: str, ncol: int = 4) -> DataFrame:
    """Rows of the page tables of ``ncol`` columns: key, table, row (0 is the header) and cells.

    Table markup leaves end tags out at will, so a parser reads it, over Arrow batches. The pages are spread
    over tasks by their number, and nothing is grouped.
    """
    kind = pages.schema[key].dataType.simpleString()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (page, t, r, cells)
                for page, text in zip(batch[key], batch[html])
                if text is not None
                for t, table in enumerate(_page_tables(text))
                for r, cells in enumerate(table)
            ]
            yield pd.DataFrame(rows, columns=[key, "table", "row", "cells"])

    parsed = spread(pages.select(key, html)).mapInPandas(parse, f"`{key}` {kind}, `table` int, `row` int, cells array<string>")
    return parsed.where(F.size("cells") == ncol)


def table_columns(rows: DataFrame, names: list[str], key: str) -> DataFrame:
    """Body rows of extracted tables under cleaned names."""
    body = rows.where(F.col("row") > 0)
    return body.select(key, *[F.element_at("cells", i).alias(n) for i, n in enumerate(clean_names(names), start=1)])


def stacked_tables(rows: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Body rows of all extracted tables, each under its own header, one below the other.

    ``names`` are the cleaned names wanted; a table without one of them has null there, and further columns are left out.
    Rows meet their header in a join on page and table, so any number of pages will do. They are written before,
    since both sides of the join are read from them, and parsing takes long.
    """
    rows = staged(rows, "table-rows")
    headers = rows.where(F.col("row") == 0).select(F.col(key).alias("_key"), F.col("table").alias("_table"), F.transform("cells", clean_name_column).alias("_names"))
    body = rows.where(F.col("row") > 0).join(headers, (F.col(key) == F.col("_key")) & (F.col("table") == F.col("_table")))

    def cell(name: str) -> Column:
        place = F.array_position("_names", F.lit(name)).cast("int")
        return F.when(place > 0, F.try_element_at("cells", place)).alias(name)

    return body.select(key, "table", "row", *[cell(n) for n in names])


def page_urls(spark: SparkSession, base: str, pages: int) -> DataFrame:
    """Addresses of a listing: the first page bare, the others with their number."""
    number = F.col("id").cast("string")
    url = F.when(F.col("id") == 1, F.lit(base)).otherwise(F.concat(F.lit(f"{base}?page="), number))
    return spark.range(1, pages + 1).select(F.col("id").cast("int").alias("page"), url.alias("url"))


def page_urls_for(sites: DataFrame, base: str, pages: str, keep: list[str]) -> DataFrame:
    """Addresses of the listings of many sites at once."""
    numbered = sites.select(*keep, base, F.explode(F.sequence(F.lit(1), F.col(pages).cast("int"))).alias("page"))
    url = F.when(F.col("page") == 1, F.col(base)).otherwise(
        F.concat(F.col(base), F.lit("?page="), F.col("page").cast("string"))
    )
    return numbered.select(*keep, "page", url.alias("url"))
