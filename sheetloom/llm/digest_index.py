"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

The index is a Parquet table in a folder of the caller's choice, bucketed and sorted by the SHA-256 of the text, so a
later batch meets it in a sort-merge anti-join for which the index itself is neither shuffled nor rewritten. New
digests are appended; running a batch again appends nothing.

Defined results: a null text is empty; of equal texts of a batch the row with the largest doc_id stays (null ids lose to
any other; rows that share the largest id all stay, as nothing tells them apart); a text that the index already holds is
not kept; an empty batch gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.session import staged


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


class DigestIndex:
    """The index kept in ``path``; ``buckets`` is fixed when the index is made, and kept beside it for whoever opens it later."""

    def __init__(self, spark: SparkSession, path: str, buckets: int) -> None:
        self.spark = spark
        buckets = self._made_with(f"{path.rstrip('/')}/_buckets", buckets)
        self.name = f"digest_index_{hashlib.sha1(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, group_size BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        self.buckets = buckets

    def _made_with(self, path: str, buckets: int) -> int:
        """The number that the index was made with; a new index is made with ``buckets``. Readers pass over names with an underscore."""
        try:
            return self.spark.read.schema("n int").parquet(path).first().n
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        self.spark.range(1).select(F.lit(buckets).alias("n")).coalesce(1).write.parquet(path)
        return buckets

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def groups(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Texts of a batch: digest, the id that stays, number of rows. Counted before the shuffle."""
        rows = docs.select(text_digest(F.col(f"`{text}`")).alias("digest"), F.col(f"`{doc_id}`").alias("doc_id"))
        return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))

    def append_new(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Append the digests of the batch that the index lacks. A task writes whole buckets, so each gets one file."""
        new = self.groups(docs, doc_id, text).join(self.table().hint("merge"), "digest", "left_anti")
        new.select("digest", "keep_id", "group_size").repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)

    def dedup(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Label each row of a batch, then append its new digests.

        Returns doc_id, keep_id, group_size (rows of this batch), kept, text_sha256, and ``indexed`` (the text was in the
        index before). A digest is taken as new if its entry is missing or if it is this batch's own, as after a rerun.
        """
        self.append_new(docs, doc_id, text)
        rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_digest(F.col(f"`{text}`")).alias("digest"))
        entries = self.table().select("digest", F.col("keep_id").alias("_entry"))
        groups = self.groups(docs, doc_id, text).join(entries.hint("merge"), "digest", "left")
        own = F.col("_entry").eqNullSafe(F.col("_own"))
        groups = groups.withColumnRenamed("keep_id", "_own").select("digest", "group_size", F.col("_entry").alias("keep_id"), (~own).alias("indexed"))
        # Written first, so that both sides of the next join come straight from a shuffle: adaptive execution then splits a frequent text.
        groups = staged(groups, "digest-groups")
        joined = rows.join(groups, "digest")
        kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("indexed")
        return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "indexed")
