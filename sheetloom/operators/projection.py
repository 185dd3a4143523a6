"""Column choice, renaming, header handling and filters that need more than one call."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.functions.names import clean_names as _clean_names


def columns_where(
    df: DataFrame,
    *,
    prefix: str | None = None,
    suffix: str | None = None,
    names: Iterable[str] | None = None,
    start: int | None = None,
    stop: int | None = None,
    dtype: type[T.DataType] | None = None,
    excluding: Iterable[str] = (),
) -> list[str]:
    """Columns chosen by position (from 1, inclusive), prefix, suffix, list or type; absent names are skipped."""
    skipped = set(excluding)
    wanted = None if names is None else set(names)
    chosen = []
    for place, field in enumerate(df.schema.fields, start=1):
        if (
            field.name not in skipped
            and (prefix is None or field.name.startswith(prefix))
            and (suffix is None or field.name.endswith(suffix))
            and (wanted is None or field.name in wanted)
            and (start is None or place >= start)
            and (stop is None or place <= stop)
            and (dtype is None or isinstance(field.dataType, dtype))
        ):
            chosen.append(field.name)
    return chosen


def across(df: DataFrame, cols: Sequence[str], change: Callable[[Column, str], Column]) -> DataFrame:
    """Apply one expression, given the column and its name, to every chosen column."""
    return df.withColumns({name: change(F.col(f"`{name}`"), name) for name in cols})


def transmute(df: DataFrame, **exprs: Column) -> DataFrame:
    """Keep only the named expressions."""
    return df.select(*[expr.alias(name) for name, expr in exprs.items()])


def relocate(df: DataFrame, *first: str) -> DataFrame:
    """Move the named columns to the front; names that are absent are skipped."""
    present = [name for name in first if name in df.columns]
    return df.select(*present, *[name for name in df.columns if name not in present])


def rename(df: DataFrame, new_from_old: Mapping[str, str]) -> DataFrame:
    """Rename by a mapping of new name to old name."""
    return df.withColumnsRenamed({old: new for new, old in new_from_old.items()})


def rename_prefixed(df: DataFrame, prefix: str, new: str) -> DataFrame:
    """Give the one column that starts with the prefix a fixed name."""
    found = columns_where(df, prefix=prefix)
    if len(found) > 1:
        raise ValueError(f"{len(found)} columns start with {prefix!r}: {found}")
    return df.withColumnsRenamed(dict.fromkeys(found, new))


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case every column name, keeping names distinct."""
    return df.toDF(*_clean_names(df.columns))


def area_headers(names: Iterable[str]) -> list[str]:
    """Area columns without what follows the first underscore: ``x7_2`` and ``x7`` both name area 7."""
    return [name.split("_", 1)[0] if "_" in name else name for name in names]


def promote_header(df: DataFrame, order: str, row: int, cols: Sequence[str] | None = None) -> DataFrame:
    """Use one row as the header of the given columns (all by default) and keep the rows after it.

    Only that row reaches the driver.
    """
    targets = list(cols) if cols is not None else [name for name in df.columns if name != order]
    header = df.where(F.col(order) == row).select(*targets).first()
    if header is None:
        raise ValueError(f"no row {row} in {order}")
    new_names = dict(zip(targets, _clean_names(header)))
    return df.where(F.col(order) > row).toDF(*[new_names.get(name, name) for name in df.columns])


def as_integer(col: Column) -> Column:
    """Number of a text, null where it is not one; fractions are cut off. 64 bits wide and exact over its range."""
    text = F.trim(col.cast("string"))
    return F.when(text.rlike(r"^[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?$"), text.try_cast("decimal(38,18)").try_cast("bigint"))


def leading_integer(col: Column) -> Column:
    """Number of a text that starts with a digit, else null."""
    return F.when(col.rlike("^[0-9]"), as_integer(col))


def known_or_null(df: DataFrame, key: str, lookup: DataFrame) -> DataFrame:
    """Rows whose key is null or occurs in the lookup's column of the same name, in one pass over the rows."""
    known = lookup.select(F.col(key).alias("_known")).where(F.col("_known").isNotNull()).distinct()
    joined = df.join(known, F.col(key) == F.col("_known"), "left")
    return joined.where(F.col(key).isNull() | F.col("_known").isNotNull()).select(*[F.col(f"`{c}`") for c in df.columns])


def without_dead_links(df: DataFrame, key: str = "grant_id", url: str = "url") -> DataFrame:
    """Drop rows that have a key but no address; keep rows without a key."""
    return df.where((F.col(key).isNotNull() & F.col(url).isNotNull()) | F.col(key).isNull())
