"""Publishing: whole databases, and sets of tables that become visible together or not at all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.operators.catalog import recreate_database
from sheetloom.operators.edits import Reference, load_report
from sheetloom.session import scratch_path

MARK = "_published"


def publish_database(spark: SparkSession, source: str, target: str, location: str | None = None) -> list[str]:
    """Copy every table of a database to another that is created anew, at a location if given."""
    recreate_database(spark, target, location)
    names = sorted(t.name for t in spark.catalog.listTables(source) if not t.isTemporary)
    for name in names:
        spark.table(f"`{source}`.`{name}`").write.format("parquet").saveAsTable(f"`{target}`.`{name}`")
    return names


def bulk_load(
    spark: SparkSession,
    root: str,
    version: int,
    tables: Mapping[str, DataFrame],
    primary: Mapping[str, Sequence[str]],
    references: Sequence[Reference] = (),
    required: Mapping[str, Sequence[str]] | None = None,
) -> tuple[bool, DataFrame]:
    """Write all tables, check them, and mark the version as published only if every rule holds.

    A version that is published already is refused. Checks read the written files, so what was checked is what is published. A version without its mark
    is never read, so a failed or interrupted load leaves the earlier version in force.
    """
    if version in published_versions(spark, root):
        raise ValueError(f"version {version} is published already")
    folder = f"{root}/v{version:08d}"
    for name, table in tables.items():
        # An earlier attempt at this version that was refused or broke off is written over; nobody reads it.
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
    written = {name: spark.read.parquet(f"{folder}/{name}") for name in tables}
    report_path = scratch_path(spark, "load-report")
    load_report(written, primary, references, required).write.parquet(report_path)
    report = spark.read.parquet(report_path)
    sound = not report.where(F.col("violations") > 0).limit(1).collect()
    if sound:
        spark.range(1).select(F.lit(version).alias("version")).write.json(f"{folder}/{MARK}")
    return sound, report


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions below the root that carry the mark."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/v*/{MARK}/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getParent().getName()[1:]) for f in (found or []))


def current_version(spark: SparkSession, root: str) -> int | None:
    """Largest published version below the root."""
    return max(published_versions(spark, root), default=None)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published below {root}")
    return spark.read.parquet(f"{root}/v{version:08d}/{name}")
