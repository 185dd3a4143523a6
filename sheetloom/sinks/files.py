"""Files for the portal and for spreadsheets. Every writer leaves the table partitioned."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.operators.ordering import nulls_last


def with_decimal_comma(df: DataFrame) -> DataFrame:
    """Fractional numbers as text with a decimal comma."""
    kinds = (T.DoubleType, T.FloatType, T.DecimalType)
    return df.select(*[
        F.translate(F.col(f"`{f.name}`").cast("string"), ".", ",").alias(f.name)
        if isinstance(f.dataType, kinds) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def write_delim(df: DataFrame, path: str, sep: str = ";", decimal_comma: bool | None = None) -> None:
    """Delimited text with a header; nulls are empty. Semicolon files use the decimal comma."""
    comma = sep == ";" if decimal_comma is None else decimal_comma
    table = with_decimal_comma(df) if comma else df
    options = {"sep": sep, "header": "true", "nullValue": "", "emptyValue": '""', "quote": '"', "escape": '"'}
    table.write.options(**options).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    write_delim(df, path, ",")


def write_excel_csv(df: DataFrame, path: str) -> None:
    """Comma text that spreadsheets open as UTF-8: a byte-order mark stands before the first name."""
    first, *rest = df.columns
    write_csv(df.toDF(f"\ufeff{first}", *rest), path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text without quoting."""
    df.write.options(sep="\t", header="true", nullValue="", quote="").csv(path)


def write_sorted(df: DataFrame, path: str, order: Sequence[str], parts: int | None = None) -> None:
    """Parquet files whose order is the sort order: range partitioned by the keys and sorted inside each file.

    Adaptive execution chooses how many there are, unless ``parts`` does.
    """
    keys = nulls_last(*order)
    df.repartitionByRange(*([parts] if parts else []), *keys).sortWithinPartitions(*keys).write.parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Rows with ``_file``, its number among the files in order, and ``_row``, from 0."""
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, "part-([0-9]+)", 1).cast("int")
    return spark.read.parquet(path).select("*", F.struct(number.alias("number"), name.alias("name")).alias("_file"), F.col("_metadata.row_index").alias("_row"))


def manifest(spark: SparkSession, path: str, order: Sequence[str]) -> DataFrame:
    """One row per file of a sorted table, in order: file, rows before it, rows, first and last key, and whether it follows the file before."""
    names = [n.lstrip("-") for n in order]
    key = F.struct(*[F.col(f"`{n}`") for n in names])
    files = _placed(spark, path).groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), F.min_by(key, "_row").alias("first"), F.max_by(key, "_row").alias("last"))
    by_file = Window.orderBy("_file")
    before = F.lag("last").over(by_file)
    after, same = F.lit(False), F.lit(True)
    for n in order:
        a, b = F.col("_before")[n.lstrip("-")], F.col("first")[n.lstrip("-")]
        beyond = (a < b) if n.startswith("-") else (a > b)
        # Nulls stand last in either direction.
        after = after | (same & F.coalesce(beyond | (a.isNull() & b.isNotNull()), a.isNull() & b.isNotNull()))
        same = same & a.eqNullSafe(b)
    earlier = F.coalesce(F.sum("rows").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = files.withColumn("_before", before).withColumn("rows_before", earlier)
    return listed.select("_file", F.col("_file.name").alias("file"), "rows_before", "rows", "first", "last", (F.col("_before").isNull() | ~after).alias("in_order"))


def read_in_order(spark: SparkSession, path: str, order: Sequence[str], name: str = "place") -> DataFrame:
    """A sorted table with the place of each row, from 1: rows before its file and its row in the file. Nothing is sorted again."""
    offsets = manifest(spark, path, order).select("_file", "rows_before")
    rows = _placed(spark, path).join(F.broadcast(offsets), "_file")
    return rows.withColumn(name, F.col("rows_before") + F.col("_row") + 1).drop("_file", "_row", "rows_before")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record a line, null fields kept."""
    df.write.option("ignoreNullFields", "false").json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """JSON arrays as text files: every output part is one array of its rows.

    The rows of a part are framed where they lie, so no task holds more than it already had.
    """
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = "["
        for batch in batches:
            lines = []
            for line in batch.column(0).to_pylist():
                lines.append(opener + line)
                opener = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if opener == "[" else "]"])], ["value"])

    df.select(record.alias("value")).mapInArrow(framed, "value string").write.text(path)


def save_tables(tables: Mapping[str, DataFrame], folder: str, parquet: bool = True) -> None:
    """Each table as semicolon text, and as Parquet for later runs."""
    for name, table in tables.items():
        write_delim(table, f"{folder}/csv/{name}")
        if parquet:
            write_parquet(table, f"{folder}/parquet/{name}")
