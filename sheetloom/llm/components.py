"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.session import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for each node of ``links`` (a, b) that is not its own root.

    A round links all greater neighbours of a node to its least one, then the lesser ones too; stars of whole
    components are left after a logarithmic number of rounds. Nodes with many links are handled by counts and joins that
    adaptive execution can split; each round is written, so lost executors cost a round at most.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            both.where("b < a").join(least, "a").where("m < b").select("a", F.col("m").alias("b"))
        ).where("a <> b").distinct()
        large = staged(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least).distinct()
        edges = staged(small, "links")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
