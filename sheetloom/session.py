"""Session builder for local runs, and the shared folder every durable step uses."""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from collections import Counter
from collections.abc import Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cpus: int | str = 8, app: str = "sheetloom", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a local master, as in tests, gets a folder of its own when the setting is missing;
    a cluster must name one that all its machines can reach.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named and not current:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="sheetloom-")
    if not current:
        context.setCheckpointDir(named)
    return named or os.path.dirname(current)


# Rows of one task, for work that takes some hundred microseconds a row.
SPREAD_ROWS = 10_000


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """The rows dealt out evenly over as many tasks as their number needs, for costly work on a table of few bytes.

    Such a table is one file, which Spark reads in a task or two however many rows it has.
    """
    return df.repartition(df.count() // rows + 1)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The table written once to the shared folder, for plans that read it many times."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    # With the schema at hand no file needs to be opened for it.
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _unsorted_writes(spark: SparkSession, folders: int) -> Iterator[None]:
    """Tasks that write to a few folders keep a file open for each, instead of sorting all their rows by folder."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(folders))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder that a job has written, or no rows if it had none for it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def staged_by(rows: DataFrame, tag: str, values: Sequence[str], label: str) -> dict[str, DataFrame]:
    """Rows tagged with where they belong, written by one job: for each of the tag's ``values`` the rows without the tag."""
    path = scratch_path(rows.sparkSession, label)
    # Numbers stand for the values, which may hold anything.
    number = F.coalesce(*[F.when(F.col(tag) == v, F.lit(i)) for i, v in enumerate(values)])
    rest = rows.drop(tag)
    with _unsorted_writes(rows.sparkSession, len(values)):
        rows.select(number.alias("_tag"), *[F.col(f"`{c}`") for c in rest.columns]).where("_tag IS NOT NULL").write.partitionBy("_tag").parquet(path)
    return {v: _written(rows.sparkSession, f"{path}/_tag={i}", rest.schema) for i, v in enumerate(values)}


def staged_together(tables: Mapping[str, DataFrame], label: str, distinct: Collection[str] = (), counts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Tables of any columns, written by one job into a folder each; those named in ``distinct`` share one grouping.

    ``counts`` is filled with the number of rows written of each table, which the job counts on its way.

    Columns of equal type share a slot, so rows are as wide as the widest table of each type. Each table is read with
    its own folder's size, by which the optimiser picks broadcasts. Tables without rows come back empty.
    """
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    kinds: dict[str, T.DataType] = {}
    places: dict[str, list[str]] = {}
    for name, df in tables.items():
        used: Counter[str] = Counter()
        places[name] = []
        for field in df.schema.fields:
            kind = field.dataType.simpleString()
            slot = f"{zlib.crc32(kind.encode()):08x}_{used[kind]}"
            used[kind] += 1
            kinds[slot] = field.dataType
            places[name].append(slot)

    def laid_out(number: int, name: str) -> DataFrame:
        df, found = tables[name], dict(zip(places[name], tables[name].columns, strict=True))
        slots = [F.col(f"`{found[s]}`").alias(s) if s in found else F.lit(None).cast(k).alias(s) for s, k in kinds.items()]
        return df.select(F.lit(number).alias("_table"), *slots)

    def joined(chosen: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, chosen)

    laid = {name: laid_out(i, name) for i, name in enumerate(tables)}
    once = [laid[n] for n in tables if n in distinct]
    rows = joined(([joined(once).distinct()] if once else []) + [laid[n] for n in tables if n not in distinct])
    seen = Observation()
    if counts is not None:
        rows = rows.observe(seen, *[F.count_if(F.col("_table") == i).alias(str(i)) for i in range(len(tables))])
    path = scratch_path(spark, label)
    with _unsorted_writes(spark, len(tables)):
        rows.write.partitionBy("_table").parquet(path)
    if counts is not None:
        counts |= {name: seen.get[str(i)] for i, name in enumerate(tables)}
    schema = T.StructType([T.StructField(s, k) for s, k in kinds.items()])
    result = {}
    for i, (name, df) in enumerate(tables.items()):
        found = _written(spark, f"{path}/_table={i}", schema)
        result[name] = found.select(*[F.col(s).alias(c) for s, c in zip(places[name], df.columns, strict=True)])
    return result


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
