"""Delimited text whose quoted cells hold line breaks, read by many tasks a file.

A line ends a record exactly if the quotes up to its end are even in number. Each split counts its own quotes while it is
read; the counts of all splits, one row each, then tell in which state a split begins, and only the lines of records
that take several lines are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.session import staged
from sheetloom.sources.files import read_delim


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in the split, the parity of quotes up to them, and the last odd line before them."""
    at: tuple[str, int] | None = None
    n, parity, last = 0, 0, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, odd = batch.column(0), batch.column(1), batch.column(3).to_numpy()
        same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(~same) + 1).tolist(), batch.num_rows]
        line, inside, opened = (np.empty(batch.num_rows, np.int64) for _ in range(3))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            here = (file[a].as_py(), start[a].as_py())
            if here != at:
                at, n, parity, last = here, 0, 0, -1
            line[a:b] = np.arange(n, n + b - a)
            inside[a:b] = (parity + np.cumsum(odd[a:b])) & 1
            seen = np.maximum.accumulate(np.concatenate(([last], np.where(odd[a:b] == 1, line[a:b], -1))))
            opened[a:b] = seen[:-1]
            n, parity, last = n + b - a, int(inside[b - 1]), int(seen[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(line), pa.array(inside), pa.array(opened)], names=[*batch.schema.names, "line", "inside", "opened"]
        )


def _odd(value: Column) -> Column:
    return (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, start and line where each record of the files begins, and its text without the line break at its end.

    Quotes are taken as well-formed: they enclose whole cells, and those within are doubled. A quote that is never closed
    takes the rest of its file into one record. Empty files have no records; empty lines outside of quotes are records.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    text = spark.read.option("lineSep", "\n").text(path).select(*place, "value", _odd(F.col("value")).cast("long").alias("odd"))
    # Written first, so that both uses see the same splits.
    kind = "file string, start bigint, value string, odd bigint, line bigint, inside bigint, opened bigint"
    lines = staged(text.mapInArrow(_numbered, kind), "quoted-lines")

    ends = lines.groupBy("file", "start").agg(F.sum("odd").alias("_odd"), F.max(F.when(F.col("odd") == 1, F.col("line"))).alias("_last"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opener = F.when(F.col("_last").isNotNull(), F.struct("start", F.col("_last").alias("line")))
    splits = ends.select(
        "file", "start", (F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2).alias("_before"),
        F.last(opener, ignorenulls=True).over(earlier).alias("_from"),
    )
    # One row a split: the optimiser sees its size and leaves the lines where they are while it is small.
    known = lines.join(staged(splits, "quoted-splits"), ["file", "start"])
    after = (F.col("inside") + F.col("_before")) % 2
    known = known.withColumns({"_after": after, "_prior": (after + F.col("odd")) % 2})

    whole = known.where("_prior = 0 AND _after = 0").select("file", "start", "line", "value")
    own = F.struct("start", "line")
    first = F.when(F.col("_prior") == 0, own).when(F.col("opened") >= 0, F.struct("start", F.col("opened").alias("line"))).otherwise(F.col("_from"))
    parts = known.where("_prior = 1 OR _after = 1").select("file", first.alias("first"), F.struct("start", "line", "value").alias("part"))
    joined = parts.groupBy("file", "first").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    several = joined.select("file", "first.start", "first.line", F.array_join(F.col("parts.value"), "\n").alias("value"))
    return whole.unionByName(several).withColumn("value", F.regexp_replace("value", r"\r\z", ""))


def read_quoted(spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None, order: str | None = None) -> DataFrame:
    """Delimited text with a header, as ``read_delim`` reads it, but a file is as many tasks as it has splits.

    Without a schema every column is text, named by the header. ``order`` names a column by which the rows follow the
    files. The first line of a file begins its header. Empty lines are skipped, short rows are filled with nulls, and a
    carriage return before a line break that ends a record belongs to the break.
    """
    wanted = read_delim(spark, path, sep).schema if schema is None else T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = records(spark, path).where("value <> '' AND NOT (start = 0 AND line = 0)")
    options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": "", "multiLine": "true"}
    cells = F.from_csv("value", _ddl(wanted), options)
    placed = [] if order is None else [F.struct("file", "start", "line").alias(order)]
    return rows.select(cells.alias("_cells"), *placed).select("_cells.*", *([order] if order else []))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
