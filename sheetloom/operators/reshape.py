"""Wide to long and back, and delimited cells to rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.functions.text import literal


def melt(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str, drop_nulls: bool = False
) -> DataFrame:
    """One row per id row and column; null values stay unless dropped."""
    long = df.unpivot(list(ids), list(cols), name, value)
    return long.where(F.col(value).isNotNull()) if drop_nulls else long


def matrix_to_bridge(
    df: DataFrame,
    ids: Sequence[str],
    cols: Sequence[str],
    header: str,
    marks: Sequence[str] = ("x", "X"),
    header_id: Callable[[Column], Column] | None = None,
    position: str | None = None,
) -> DataFrame:
    """Rows of a presence matrix that carry a mark, one per marked cell.

    The header text, or what ``header_id`` reads from it, becomes the second key. Several columns may
    share one header, so cells are addressed by position and named only afterwards. ``position`` names
    an extra column with the place of the marked column, from 1.
    """
    if not cols:
        raise ValueError("no matrix columns")
    marked = F.filter(
        F.array(*[
            F.struct(F.lit(c).alias("h"), F.lit(i).alias("i"), F.col(f"`{c}`").alias("v"))
            for i, c in enumerate(cols, start=1)
        ]),
        lambda cell: cell["v"].isin(*marks),
    )
    head = F.col("_cell.h")
    return df.select(*ids, F.explode(marked).alias("_cell")).select(
        *ids,
        (header_id(head) if header_id else head).alias(header),
        *([F.col("_cell.i").alias(position)] if position else []),
    )


def header_lookup(bridge: DataFrame, header: str, ids: Mapping[str, int], name: str) -> DataFrame:
    """Replace a header text by its id; headers without one are dropped.

    The mapping holds one entry per column of a sheet, so its table is small enough to broadcast.
    """
    table = bridge.sparkSession.createDataFrame(list(ids.items()) or [("", 0)], f"`{header}` string, `{name}` bigint")
    return bridge.join(F.broadcast(table), header).drop(header)


def prefixed_id(header: Column, prefix: str = "x") -> Column:
    """Area number of a header such as ``x7`` or ``x7_2``."""
    return F.regexp_extract(header, rf"^{prefix}([0-9]+)", 1).try_cast("bigint")


def narrow_id(header: Column) -> Column:
    """Area number from characters two and three only, as in the older layout."""
    return F.replace(F.substring(header, 2, 2), F.lit("_"), F.lit("")).try_cast("bigint")


def explode_delim(df: DataFrame, col: str, sep: str, position: str | None = None) -> DataFrame:
    """One row per piece of a delimited cell; a null cell keeps its row. ``position`` names an extra
    column with the place of the piece in its cell, from 1."""
    pieces = F.split(F.col(col), literal(sep), -1)
    if position is None:
        rows = F.explode_outer(pieces)
        return df.select(*[rows.alias(c) if c == col else F.col(c) for c in df.columns])
    rows = df.select("*", F.posexplode_outer(pieces).alias("_at", "_piece"))
    return rows.select(
        *[F.col("_piece").alias(c) if c == col else F.col(c) for c in df.columns],
        F.coalesce(F.col("_at") + 1, F.lit(1)).alias(position),
    )


def explode_chain(df: DataFrame, seps: Mapping[str, str]) -> DataFrame:
    """Split several columns one after the other: every combination of their pieces."""
    for col, sep in seps.items():
        df = explode_delim(df, col, sep)
    return df


def explode_zip(df: DataFrame, cols: Sequence[str], sep: str) -> DataFrame:
    """Split several columns side by side; single pieces repeat, any other mismatch is an error."""
    lists = {c: F.coalesce(F.split(F.col(c), literal(sep), -1), F.array(F.lit(None).cast("string"))) for c in cols}
    longest = F.greatest(*[F.size(pieces) for pieces in lists.values()])
    mismatch = F.raise_error(F.concat(F.lit("cannot split in parallel: "), F.concat_ws(", ", F.lit(list(cols)))))

    def recycled(pieces: Column) -> Column:
        return (
            F.when(F.size(pieces) == longest, pieces)
            .when(F.size(pieces) == 1, F.array_repeat(pieces[0], longest))
            .otherwise(mismatch.cast("array<string>"))
        )

    zipped = F.arrays_zip(*[recycled(pieces).alias(c) for c, pieces in lists.items()])
    rows = df.withColumn("_row", F.explode(zipped))
    return rows.select(*[F.col(f"_row.{c}").alias(c) if c in lists else F.col(c) for c in df.columns])


def separate(df: DataFrame, col: str, into: Sequence[str], sep: str, keep: bool = False) -> DataFrame:
    """Split a cell into fixed columns; missing pieces are null and further pieces are dropped."""
    pieces = F.split(F.col(col), literal(sep), -1)
    parts = {name: F.try_element_at(pieces, F.lit(i)) for i, name in enumerate(into, start=1)}
    result = []
    for c in df.columns:
        if c != col or keep:
            result.append(F.col(c))
        if c == col:
            result.extend(part.alias(name) for name, part in parts.items())
    return df.select(*result)


def enframe(df: DataFrame, cols: Sequence[str], position: str, value: str) -> DataFrame:
    """Cells of a row as (position, value) rows, positions from 1."""
    cells = F.array(*[F.col(c).cast("string") for c in cols])
    kept = [c for c in df.columns if c not in cols]
    return df.select(*kept, F.posexplode(cells).alias("_at", value)).select(
        *kept, (F.col("_at") + 1).alias(position), value
    )
