"""Aggregations, and the generic analysis call of the portal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.session import staged

NEST_ROWS = 100_000
COPY_BLOCK = 4096


def ratio(df: DataFrame, by: Sequence[str], numerator: Column, denominator: Column, name: str) -> DataFrame:
    """Quotient of two aggregates; null where the divisor is 0."""
    return df.groupBy(*by).agg((numerator / F.nullif(denominator, F.lit(0))).alias(name))


def with_totals(df: DataFrame, by: Sequence[str], **aggs: Column) -> DataFrame:
    """Aggregates per group and one grand-total row, marked by ``is_total``."""
    keys = [F.col(c) for c in by]
    grouped = df.groupingSets([keys, []], *keys).agg(F.grouping_id().alias("_gid"), *[agg.alias(name) for name, agg in aggs.items()])
    return grouped.withColumn("is_total", F.col("_gid") == (1 << len(by)) - 1).drop("_gid")


def all_true(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """One row telling whether the test holds throughout, and the rows where it does not."""
    verdict = df.agg(F.coalesce(F.bool_and(F.coalesce(test, F.lit(False))), F.lit(True)).alias("all_true"))
    return verdict, df.where(~F.coalesce(test, F.lit(False)))


def analyze(
    df: DataFrame,
    select: Sequence[str],
    where: str | None = None,
    group_by: Sequence[str] = (),
    order_by: Sequence[str] = (),
    limit: int | None = None,
    drop_null_groups: str | None = "after_limit",
) -> DataFrame:
    """Aggregate expressions over groups, written as SQL expressions with aliases.

    The portal removes groups with a null key only after the limit, so a limit of n may give n - 1
    rows; ``drop_null_groups="before"`` removes them first and None keeps them.
    """
    rows = df.where(where) if where else df
    if group_by:
        grouped = rows.select("*", *[F.expr(g) for g in group_by])
        keys = grouped.columns[len(rows.columns) :]
        # Keys get names of their own first, since a plain column appears twice after the select.
        keyed = grouped.toDF(*rows.columns, *[f"_group_{i}" for i in range(len(keys))])
        aggs = [F.expr(s) for s in select] or [F.count(F.lit(1)).alias("_n")]
        result = keyed.groupBy(*[F.col(f"_group_{i}").alias(k) for i, k in enumerate(keys)]).agg(*aggs)
        result = result if select else result.drop("_n")
    else:
        keys = []
        result = rows.agg(*[F.expr(s) for s in select])
    if drop_null_groups == "before" and keys:
        result = result.dropna(subset=keys)
    if order_by:
        result = result.orderBy(*[F.expr(o[:-5]).desc_nulls_last() if o.lower().endswith(" desc") else
                                  F.expr(o[:-4] if o.lower().endswith(" asc") else o).asc_nulls_last() for o in order_by])
    if limit is not None:
        result = result.limit(limit)
    if drop_null_groups == "after_limit" and keys:
        result = result.dropna(subset=keys)
    return result


def nest(df: DataFrame, by: Sequence[str], name: str = "data", nest_rows: int = NEST_ROWS) -> DataFrame:
    """Rows of each key folded into arrays of structs.

    Equal rows are held once with their number of ``copies``. A key with at most ``nest_rows`` different rows is one
    piece, whatever other keys hold; a key with more is spread over as many pieces as it needs, so that no array and no
    task grows with the key.
    """
    rest = [c for c in df.columns if c not in by]
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    if not rest:
        return counted.groupBy(*by, F.lit(0).alias("piece")).agg(F.collect_list(F.struct("copies")).alias(name))
    # The rows are read twice, so they are written once; only keys above the limit, a short list, are joined back.
    counted = staged(counted, "nested")
    large = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > nest_rows)
    known = large.select(*[F.col(f"`{c}`").alias(f"_large_{c}") for c in by], F.ceil(F.col("_n") / nest_rows).alias("_pieces"))
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"_large_{c}")) for c in by])
    piece = F.pmod(F.xxhash64(*rest), F.coalesce("_pieces", F.lit(1))).cast("int")
    return counted.join(known, same, "left").groupBy(*by, piece.alias("piece")).agg(F.collect_list(F.struct(*rest, "copies")).alias(name))


def unnest(df: DataFrame, by: Sequence[str], name: str = "data") -> DataFrame:
    """Inverse of :func:`nest`: every copy of every row again."""
    rows = df.select(*by, F.inline(name))
    blocks = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPY_BLOCK))))
    left = F.least(F.lit(COPY_BLOCK), F.col("copies") - F.col("_block") * COPY_BLOCK)
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1), left))).drop("_block", "_copy", "copies")


def month_series(df: DataFrame, value: Mapping[str, Column], ts: Column) -> DataFrame:
    """Aggregates by month for each year."""
    return df.groupBy(F.month(ts).alias("month"), F.year(ts).alias("series")).agg(
        *[agg.alias(name) for name, agg in value.items()]
    )
