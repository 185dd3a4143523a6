"""Joins with the null and name rules of the wrangling scripts, and with hot keys handled.

Plain joins are left to the optimiser and to adaptive execution, which picks broadcasts by measured
size and splits skewed sort-merge partitions; that needs both sides to come straight from a shuffle,
so semi and anti joins take their key tables as they are, without a distinct. ``lookup_join`` is for
facts against lookups that were aggregated on the same key: keys that hold very many fact rows
never enter the shuffle. They are found by a sketch that is filled while the facts are written for
several readers, so no job counts keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.session import staged

Keys = Sequence[str | tuple[str, str]]

# A key with more fact rows than this is hot, so a table of n rows has at most n / HOT_ROWS of them.
HOT_ROWS = 10_000_000
# Most lookup rows, and bytes of them, that may be broadcast for the hot keys.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20
# Keys that a sketch follows: some 32 KB a task. It names each key that holds a 250th of all rows or more.
TRACKED = 1 << 10


def _pairs(on: Keys) -> list[tuple[str, str]]:
    return [(key, key) if isinstance(key, str) else key for key in on]


def _condition(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    tests = []
    for l, r in pairs:
        one, other = F.col(f"_l.`{l}`"), F.col(f"_r.`{r}`")
        tests.append(one.eqNullSafe(other) if null_safe else one == other)
    return reduce(lambda a, b: a & b, tests)


def _joined(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str, null_safe: bool) -> DataFrame:
    return left.alias("_l").join(right.alias("_r"), _condition(pairs, null_safe), how)


def equi_join(left: DataFrame, right: DataFrame, on: Keys, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Join on equal keys, keeping the left key columns once; ``null_safe`` lets null match null."""
    pairs = _pairs(on)
    renamed = right.select(
        *[F.col(r).alias(f"_right_{r}") for r in dict.fromkeys(r for _, r in pairs)],
        *[F.col(f"`{c}`") for c in right.columns if c not in {r for _, r in pairs}],
    )
    joined = _joined(left, renamed, [(l, f"_right_{r}") for l, r in pairs], how, null_safe)
    return joined.drop(*[f"_right_{r}" for _, r in pairs]) if how not in ("left_semi", "left_anti") else joined


def left_join(left: DataFrame, right: DataFrame, on: Keys, null_safe: bool = False) -> DataFrame:
    return equi_join(left, right, on, "left", null_safe)


def _spot(names: Sequence[str]) -> Column:
    """A number for the values of some columns. Different values may share one; they are then hot together."""
    return F.xxhash64(*[F.col(f"`{n}`") for n in names])


def follow_keys(df: DataFrame, key_sets: Sequence[Sequence[str]], label: str) -> tuple[DataFrame, dict[tuple[str, ...], dict[int, int]]]:
    """The table written once, and for each set of keys its frequent values with about the rows they hold.

    A sketch of frequent items is filled by each task as it writes and merged as the tasks end. Numbers of rows are
    at most a 500th of all rows too high; keys that hold less than a 250th may be left out.
    """
    seen = Observation()
    tops = [F.expr(f"approx_top_k(_spot_{i}, {TRACKED}, {TRACKED})").alias(f"top_{i}") for i in range(len(key_sets))]
    spots = {f"_spot_{i}": _spot(keys) for i, keys in enumerate(key_sets)}
    kept = staged(df.withColumns(spots).observe(seen, *tops).drop(*spots), label)
    found = seen.get
    return kept, {tuple(keys): {r["item"]: r["count"] for r in found.get(f"top_{i}") or []} for i, keys in enumerate(key_sets)}


def _comparable(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> bool:
    """Whether equal keys have equal numbers by ``_spot``: types agree, and zeros have no sign."""
    kinds = [(left.schema[l].dataType, right.schema[r].dataType) for l, r in pairs]
    return all(l == r and not isinstance(l, (T.FloatType, T.DoubleType, T.ArrayType, T.StructType, T.MapType)) for l, r in kinds)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    how: str = "left",
    null_safe: bool = False,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    frequent: Mapping[int, int] | None = None,
) -> DataFrame:
    """Inner or left join of a large table with a lookup, safe against hot keys.

    The rows of hot keys meet a broadcast of just those keys' lookup rows, whose number and bytes are
    known by then; all other rows take the ordinary join. When those lookup rows are too many to
    broadcast, or keys have different or nested types or are fractions, the ordinary join does it all
    and adaptive execution splits the skewed partitions.

    ``frequent`` is what ``follow_keys`` found for the left keys, here or in the stored facts behind a
    joined left side; the result does not depend on it. Without it the left side is written once.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    pairs = _pairs(on)
    left_keys, right_keys = [l for l, _ in pairs], [r for _, r in pairs]
    if not _comparable(left, right, pairs):
        return equi_join(left, right, on, how, null_safe)
    if frequent is None:
        left, followed = follow_keys(left, [left_keys], "lookup-left")
        frequent = followed[tuple(left_keys)]
    # At most (rows / hot_rows) keys, and never more than a sketch follows.
    hot = [spot for spot, n in frequent.items() if n > hot_rows]
    if not hot:
        return equi_join(left, right, on, how, null_safe)
    size = Observation()
    # Text of the values, and what a row takes besides.
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in right.columns]))) + 8 * (len(right.columns) + 1)
    found = right.where(_spot(right_keys).isin(hot)).observe(size, F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes"))
    hot_lookup = staged(found, "hot-lookup")
    held = size.get
    if (held.get("rows") or 0) > broadcast_rows or (held.get("bytes") or 0) > broadcast_bytes:
        return equi_join(left, right, on, how, null_safe)
    is_hot = _spot(left_keys).isin(hot)
    hot_part = equi_join(left.where(is_hot), F.broadcast(hot_lookup), on, how, null_safe)
    cold_part = equi_join(left.where(~is_hot), right, on, how, null_safe)
    return hot_part.unionByName(cold_part)


def semi_all(df: DataFrame, parents: Sequence[tuple[DataFrame, Keys]]) -> DataFrame:
    """Rows whose keys exist in every parent."""
    for parent, on in parents:
        df = equi_join(df, parent, on, "left_semi")
    return df


def coalesce_join(left: DataFrame, right: DataFrame, on: Keys, shared: Sequence[str], how: str = "left") -> DataFrame:
    """Join tables that share further column names; the left value wins where it is present."""
    moved = right.withColumnsRenamed({name: f"_other_{name}" for name in shared})
    joined = equi_join(left, moved, on, how)
    merged = joined.withColumns({name: F.coalesce(name, f"_other_{name}") for name in shared})
    return merged.drop(*[f"_other_{name}" for name in shared])


def tiered_fill(rows: DataFrame, key: str, tier: str) -> DataFrame:
    """Rows of the first tier that has any, for each key.

    Equals trying each tier in turn for the keys still without rows. The rows are read several times,
    so they are written once, which also finds the hot keys; the lowest tier per key is combined before
    the shuffle, and the join back leaves hot keys out of it.
    """
    rows, found = follow_keys(rows, [[key]], "tiers")
    lowest = rows.groupBy(key).agg(F.min(tier).alias("_tier"))
    return lookup_join(rows, lowest, [key], "inner", frequent=found[key,]).where(F.col(tier) == F.col("_tier")).drop("_tier")


def backbone_match(names: DataFrame, name: str, backbone: DataFrame, canonical: str, base_url: str) -> DataFrame:
    """Attach backbone columns by exact canonical name; unmatched names keep null columns."""
    addressed = backbone.withColumn(
        "backbone_url", F.concat(F.lit(base_url), F.coalesce(F.col("usage_key").cast("string"), F.lit("NA")))
    )
    return lookup_join(names, addressed, [(name, canonical)], "left")


def missing_names(matched: DataFrame, name: str, found: str = "backbone_url") -> DataFrame:
    """The distinct names that met nothing in the backbone."""
    return matched.where(F.col(found).isNull() & F.col(name).isNotNull()).select(name).distinct()
