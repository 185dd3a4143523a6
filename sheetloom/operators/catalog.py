"""Table lists, column descriptions, profiles and record schemas."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.operators.ordering import top_k
from sheetloom.session import staged

# Values shown of a column, the relative error of distinct counts and the rows (in shares of one) that a median may be off.
SAMPLES = 3
RSD = 0.02
ACCURACY = 1000

# Record-schema types and their column types.
JSON_TYPES: dict[str, T.DataType] = {
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the tables of a database; without one, of the current database and the session's views."""
    if database is None:
        listed = spark.sql("SHOW TABLES")
    else:
        listed = spark.sql(f"SHOW TABLES IN `{database}`").where(~F.col("isTemporary"))
    return listed.select(F.col("tableName").alias("table_name"))


def describe(df: DataFrame) -> DataFrame:
    """Column position, name and type; one row per column of the schema."""
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")


def _ordered(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType, T.StructType, T.ArrayType, T.CalendarIntervalType))


def _lines(cols: Sequence[str], make: Callable[[int, str], list[Column]]) -> Column:
    """One row per column from a table of a single row."""
    return F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), *make(i, c)) for i, c in enumerate(cols)]))


def profile(df: DataFrame, cols: Sequence[str] | None = None, approximate: bool = False, samples: int = SAMPLES) -> DataFrame:
    """Each column's type, rows, nulls, distinct values, least and greatest value, and some of its values.

    Bounds are those of the column's own type, written as text; types without an order have none. The samples are the
    distinct values with the least check sums, so a table has the same ones however it is dealt.

    The exact form counts (column, value) pairs first, combined before the shuffle, so no task holds a column's values.
    The approximate form is one pass of sketches that merge: distinct values and the ``median`` of numbers within their
    sketch's error, and for each of ``samples`` seeds the value of least hash.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    names = {c: types[c].simpleString() for c in cols}

    def low_and_high(i: int, c: str) -> list[Column]:
        if not _ordered(types[c]):
            return [F.lit(None).cast("string").alias(f"low_{i}"), F.lit(None).cast("string").alias(f"high_{i}")]
        return [F.min(c).cast("string").alias(f"low_{i}"), F.max(c).cast("string").alias(f"high_{i}")]

    if approximate:
        aggs = []
        for i, c in enumerate(cols):
            text = F.col(c).cast("string")
            number = isinstance(types[c], T.NumericType)
            median = F.percentile_approx(c, 0.5, ACCURACY).cast("double") if number else F.lit(None).cast("double")
            chosen = [F.min_by(text, F.when(text.isNotNull(), F.xxhash64(F.lit(seed), text))) for seed in range(samples)]
            aggs += [
                F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"), F.approx_count_distinct(text, RSD).alias(f"distinct_{i}"),
                *low_and_high(i, c), median.alias(f"median_{i}"), F.array(*chosen).alias(f"samples_{i}"),
            ]
        wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)

        def line(i: int, c: str) -> list[Column]:
            held = F.array_sort(F.array_distinct(F.array_compact(F.col(f"samples_{i}"))))
            given = {"nulls": "nulls", "distinct": "distinct_values", "low": "lowest", "high": "highest", "median": "median"}
            return [F.lit(names[c]).alias("column_type"), F.col("rows"), *[F.col(f"{k}_{i}").alias(v) for k, v in given.items()], held.alias("samples")]

        return wide.select(_lines(cols, line))
    bounds = df.agg(*[x for i, c in enumerate(cols) for x in low_and_high(i, c)])
    bounds = bounds.select(_lines(cols, lambda i, c: [F.col(f"low_{i}").alias("lowest"), F.col(f"high_{i}").alias("highest")]))
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(names[c]).alias("column_type"), F.col(c).cast("string").alias("v"))
        for c in cols
    ])
    # Written once: counted for the totals and searched for the samples.
    pairs = staged(df.select(F.inline(cells)).groupBy("column_name", "column_type", "v").agg(F.count(F.lit(1)).alias("n")), "profile")
    totals = pairs.groupBy("column_name", "column_type").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("distinct_values"),
    )
    least = top_k(pairs.where("v IS NOT NULL").select("column_name", "v", F.md5(F.col("v").cast("binary")).alias("_sum")), ["column_name"], ["_sum"], samples)
    held = least.groupBy("column_name").agg(F.array_sort(F.collect_list("v")).alias("samples"))
    found = totals.join(F.broadcast(bounds), "column_name").join(held, "column_name", "left")
    return found.withColumn("samples", F.coalesce("samples", F.array().cast("array<string>")))


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the order and with the types of a table definition; values that do not fit become null."""
    missing = [f.name for f in schema.fields if f.name not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    fields = []
    for f in schema.fields:
        value = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        fields.append(value.alias(f.name))
    return df.select(*fields)


def record_schema(text: str) -> T.StructType:
    """Column types of a JSON Schema record: its ``fields`` properties where it has them, else its own."""
    schema = json.loads(text)
    node = schema
    for step in ("properties", "fields", "properties"):
        if isinstance(node, Mapping) and step in node:
            node = node[step]
    fields = []
    for name, rule in node.items():
        kind = rule.get("type", "string")
        kind = next((k for k in kind if k != "null"), "string") if isinstance(kind, list) else kind
        fields.append(T.StructField(name, JSON_TYPES.get(kind, T.StringType())))
    return T.StructType(fields)


def conformity(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per column of either side: ok, missing, extra or wrong type."""
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in schema.fields}
    rows = []
    for name in [*want, *[n for n in have if n not in want]]:
        if name not in have:
            state = "missing"
        elif name not in want:
            state = "extra"
        else:
            state = "ok" if have[name] == want[name] else "wrong type"
        rows.append((name, want.get(name), have.get(name), state))
    return df.sparkSession.createDataFrame(rows, "column_name string, wanted string, found string, state string")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table in the shape of a record schema: columns cast, missing ones null, extra ones left out."""
    return apply_schema(df, schema)


def load_order(tables: Iterable[str], parents: Mapping[str, Sequence[str]]) -> list[str]:
    """Tables with every parent before its children."""
    ordered: list[str] = []
    pending = list(tables)
    while pending:
        ready = [t for t in pending if all(p in ordered or p not in pending or p == t for p in parents.get(t, ()))]
        if not ready:
            raise ValueError(f"circular references between {pending}")
        ordered += ready
        pending = [t for t in pending if t not in ready]
    return ordered


def drop_tables(spark: SparkSession, tables: Iterable[str], parents: Mapping[str, Sequence[str]]) -> list[str]:
    """Drop tables, children before parents; returns the order used."""
    ordered = load_order(tables, parents)[::-1]
    for table in ordered:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return ordered


def recreate_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """An empty database, at a location if given, in place of one that may exist."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    spark.sql(f"CREATE DATABASE `{name}`" + (f" LOCATION '{location}'" if location else ""))


def split_lookups(names: Iterable[str], word: str = "lookup") -> tuple[list[str], list[str]]:
    """Base tables, and those whose name holds the word."""
    names = list(names)
    return [n for n in names if word not in n], [n for n in names if word in n]
