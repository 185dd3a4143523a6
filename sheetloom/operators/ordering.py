"""Operators whose result depends on row order: numbering, filling down, joining text in order.

Spark keeps no row order, so each of these takes the columns that define it. Rows that agree in all of
them are ordered by their other columns, in the table's order and with nulls last, on every route; rows
that agree in those too are equal, so it does not matter which comes first. A plain window sends
a whole group to one task, which is right for groups of a known size only. Each operator therefore
counts its groups first. Those of more than ``group_rows`` rows (``TABLE_ROWS`` where the table as a whole
is ordered), a short list, take the range route, and they alone: their rows are range
partitioned on group and order, written once, worked on within their partitions, and corrected by
what earlier partitions of the same group hold. A partition edge cuts at most one group, so the
table of corrections has fewer rows than there are partitions and can be broadcast. All other groups
are shuffled once, for the window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.functions.text import NA_TEXT, sql_text
from sheetloom.session import shared_dir, staged

# Most rows that one task may hold for a group, and for a table that is ordered as a whole.
GROUP_ROWS = 5_000_000
TABLE_ROWS = 200_000
# Rows for which a further partition pays after a whole-table window.
SPREAD_ROWS = 2_000
# Largest k that Spark applies to a group before the shuffle.
PUSHED_K = 1_000


def _limit(by: Sequence[str], group_rows: int) -> int:
    return group_rows if by else min(group_rows, TABLE_ROWS)


def _routes(df: DataFrame, by: Sequence[str], group_rows: int) -> tuple[DataFrame | None, DataFrame | None, int]:
    """Rows of the groups that a task can hold, rows of the others (None if there are none), and the rows of a table without groups.

    At most (rows / group_rows) groups are larger, a short list by construction.
    """
    limit = _limit(by, group_rows)
    if not by:
        total = df.count()
        return (df, None, total) if total <= limit else (None, df, total)
    if group_rows and df.count() <= limit:
        return df, None, 0
    large = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).drop("_n").collect()
    if not large:
        return df, None, 0
    types = ", ".join(f"`_large{i}` {df.schema[c].dataType.simpleString()}" for i, c in enumerate(by))
    listed = F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in large], types))
    same = reduce(Column.__and__, [df[f"`{c}`"].eqNullSafe(listed[f"_large{i}"]) for i, c in enumerate(by)])
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi"), 0


def _joined(parts: Sequence[DataFrame | None]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def _with_ties(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> list[str]:
    """The order, completed by the other columns that can be sorted."""
    used = {*by, *[n.lstrip("-") for n in order]}
    return [*order, *[f.name for f in df.schema.fields if f.name not in used and _sortable(f.dataType)]]


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """Partitions again after a whole-table window has put all rows into one."""
    parts = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // SPREAD_ROWS)
    return df.repartition(parts) if parts > 1 else df


def nulls_last(*names: str) -> list[Column]:
    """Sort order with missing values at the end; ``-name`` sorts downwards."""
    return [F.col(f"`{n[1:]}`").desc_nulls_last() if n.startswith("-") else F.col(f"`{n}`").asc_nulls_last() for n in names]


def _ranged(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows in range partitions with ``_part`` and, inside it, ``_pos`` from 0.

    The input is written first, so that its row numbers are the same on every attempt; they stand last in the
    order, which spreads any number of equal rows. The ranged rows are written too, so every later step sees
    the same partitions.
    """
    shared_dir(df.sparkSession)
    staged = df.checkpoint().withColumn("_row", F.monotonically_increasing_id())
    keys = nulls_last(*by, *order, "_row")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stable = staged.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_row").checkpoint()
    place = F.monotonically_increasing_id()
    return stable.withColumn("_part", F.shiftright(place, 33)).withColumn("_pos", place.bitwiseAND(F.lit((1 << 33) - 1)))


def _with_carry(rows: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach the corrections, one row per partition at most."""
    same = rows["_part"] == carry["_carry_part"]
    for name in by:
        same = same & rows[name].eqNullSafe(carry[f"_carry_{name}"])
    joined = rows.join(F.broadcast(carry), same, "left")
    return joined.drop("_carry_part", *[f"_carry_{name}" for name in by])


def _carry_of(summary: DataFrame, by: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Per group and partition what the earlier partitions hold; only partitions after a group's first."""
    window = Window.partitionBy(*by).orderBy("_part")
    numbered = summary.withColumn("_nth", F.row_number().over(window))
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    carried = numbered.select(
        "_nth",
        F.col("_part").alias("_carry_part"),
        *[F.col(name).alias(f"_carry_{name}") for name in by],
        *[value.over(earlier).alias(name) for name, value in values.items()],
    )
    return carried.where("_nth > 1").drop("_nth")


def row_numbers(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "rn", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Position of each row in its group, from 1."""
    order = _with_ties(df, by, order)
    small, large, total = _routes(df, by, group_rows)
    if small is not None:
        window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        numbered = small.withColumn(name, F.row_number().over(window.orderBy(*nulls_last(*order))).cast("long"))
        small = numbered if by else _spread(numbered, total)
    if large is not None:
        large = _ranged_numbers(large, by, order, name)
    return _joined([small, large])


def _ranged_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    rows = _ranged(df, by, order)
    if not by:
        counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        numbered = rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_pos") + 1)
        return numbered.drop("_part", "_pos", "_before")
    inside = rows.withColumn("_local", F.row_number().over(Window.partitionBy("_part", *by).orderBy("_pos")))
    summary = rows.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_n"))
    carry = _carry_of(summary, by, {"_before": F.sum("_n")})
    numbered = _with_carry(inside, carry, by)
    numbered = numbered.withColumn(name, (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("long"))
    return numbered.drop("_part", "_pos", "_local", "_before")


def add_id(
    df: DataFrame, name: str, order: Sequence[str], after: int = 0, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Dense number from ``after`` + 1 in the given order, as the first column."""
    numbered = row_numbers(df, [], order, "_id", group_rows)
    others = [c for c in df.columns if c != name]
    return numbered.select((F.col("_id") + after).alias(name), *others)


def first_seen(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """Distinct rows with the order value at which each first appears, as ``_seen``."""
    return df.groupBy(*cols).agg(F.min(order).alias("_seen"))


def sequence_ids(new: DataFrame, existing: DataFrame, key: str, order: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Numbers for new rows that continue after the largest existing key."""
    return add_id(new, key, order, after=next_key(existing, key) - 1, group_rows=group_rows)


def next_key(df: DataFrame, key: str) -> int:
    """Largest key plus one; 1 for an empty table."""
    return (df.agg(F.max(key)).first()[0] or 0) + 1


def fill_down(
    df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Replace nulls with the last value above, inside each group."""
    order = _with_ties(df, by, order)
    small, large, total = _routes(df, by, group_rows)
    if small is not None:
        window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        window = window.orderBy(*nulls_last(*order)).rowsBetween(Window.unboundedPreceding, 0)
        filled = small.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in cols})
        small = filled if by else _spread(filled, total)
    if large is not None:
        large = _ranged_fill(large, by, order, cols)
    return _joined([small, large])


def _ranged_fill(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    rows = _ranged(df, by, order)
    upto = Window.partitionBy("_part", *by).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in cols})
    lasts = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_last_{c}") for c in cols]
    summary = rows.groupBy("_part", *by).agg(*lasts)
    carry = _carry_of(summary, by, {f"_above_{c}": F.last(f"_last_{c}", ignorenulls=True) for c in cols})
    filled = _with_carry(inside, carry, by)
    return filled.withColumns({c: F.coalesce(c, f"_above_{c}") for c in cols}).select(*df.columns)


def _listagg(value: str, sep: str, order: Sequence[str]) -> Column:
    keys = ", ".join(f"`{n.lstrip('-')}` {'DESC' if n.startswith('-') else 'ASC'} NULLS LAST" for n in order)
    return F.expr(f"listagg(`{value}`, {sql_text(sep)}) WITHIN GROUP (ORDER BY {keys})")


def collapse(
    df: DataFrame,
    by: Sequence[str],
    col: str,
    sep: str,
    order: Sequence[str],
    name: str | None = None,
    na_text: str | None = NA_TEXT,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Join the values of each group in order; nulls read NA, or are left out when ``na_text`` is None.

    The joined text is one value, as the operator demands; on the range route no task ever holds a
    group's rows, only the text pieces of its partitions.
    """
    name = name or col
    value = F.col(col).cast("string")
    needed = df.select(*by, (F.coalesce(value, F.lit(na_text)) if na_text is not None else value).alias("_value"),
                       *[F.col(n.lstrip("-")).alias(f"_key{i}") for i, n in enumerate(order)])
    keys = [("-" if n.startswith("-") else "") + f"_key{i}" for i, n in enumerate(order)]
    small, large, _ = _routes(needed, by, group_rows)
    keys.append("_value")
    if small is not None:
        small = small.groupBy(*by).agg(_listagg("_value", sep, keys).alias(name))
    if large is not None:
        pieces = _ranged(large, by, keys).groupBy(*by, "_part").agg(_listagg("_value", sep, ["_pos"]).alias("_piece"))
        large = pieces.groupBy(*by).agg(_listagg("_piece", sep, ["_part"]).alias(name))
    return _joined([small, large])


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """First k rows of each group. Spark keeps at most k rows a group in each task before the shuffle;
    it does so up to PUSHED_K, and beyond that rows are numbered by the route their groups need."""
    if k > PUSHED_K:
        return row_numbers(df, by, order, "_nth").where(F.col("_nth") <= k).drop("_nth")
    window = Window.partitionBy(*by).orderBy(*nulls_last(*order))
    return df.withColumn("_nth", F.row_number().over(window)).where(F.col("_nth") <= k).drop("_nth")


def first_value(df: DataFrame, by: Sequence[str], col: str, order: Sequence[str], name: str) -> DataFrame:
    """Value of the first row of each group."""
    return df.groupBy(*by).agg(F.min_by(F.col(col), F.struct(*order)).alias(name))


def slice_rows(df: DataFrame, order: str, first: int, last: int | None = None) -> DataFrame:
    """Rows whose position column lies from first to last."""
    inside = F.col(order) >= first
    return df.where(inside if last is None else inside & (F.col(order) <= last))


def limit_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First n rows in order; each task keeps n rows, so nothing is sorted whole."""
    return df.orderBy(*nulls_last(*order)).limit(n)


def unique_suffix(df: DataFrame, col: str, order: Sequence[str], name: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Number the later copies of a repeated value: a, a_2, a_3.

    A numbered value may meet one that was there before, so repeated values are numbered again, in the same order, until
    all differ: a, a, a_2 gives a, a_2, a_2_2, as it does for a header. Nulls are left alone.
    """
    out = df.withColumn("_now", F.col(col))
    while True:
        out = staged(row_numbers(out, ["_now"], order, "_nth", group_rows), "suffixed")
        again = F.col("_now").isNotNull() & (F.col("_nth") > 1)
        if not out.agg(F.count_if(again)).first()[0]:
            return out.withColumn(name, F.col("_now")).drop("_now", "_nth")
        numbered = F.when(again, F.concat_ws("_", F.col("_now"), F.col("_nth").cast("string"))).otherwise(F.col("_now"))
        out = out.withColumn("_now", numbered).drop("_nth")
