"""Where the suite modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of a folder as attributes, each read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        # Kept, since each reading looks for the schema in a file.
        found = self.__dict__[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return found

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"


def query(name: str, sql: str | None = None, wide: tuple[str, ...] = ()) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function from tables to a result, with its equivalent SQL where SQL can express it.

    ``wide``: columns that hold ids read from texts or headers, which are 64 bits wide whatever the SQL counts with.
    """

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in wide)
            SQL[name] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if wide else sql
        return build

    return register
