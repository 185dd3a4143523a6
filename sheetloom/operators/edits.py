"""Row edits as functions from a table and a table of changes to the next snapshot.

Nothing is changed in place: the caller writes the returned tables to a new folder and publishes it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators.catalog import load_order
from sheetloom.operators.checks import check_key, check_not_null, orphan_keys
from sheetloom.operators.joins import equi_join
from sheetloom.operators.ordering import GROUP_ROWS, sequence_ids


@dataclass(frozen=True)
class Reference:
    """A foreign key from child columns to parent columns."""

    child: str
    parent: str
    on: tuple[tuple[str, str], ...]


def _refuse_repeated_keys(changes: DataFrame, keys: Sequence[str]) -> None:
    repeated = check_key(changes, keys).limit(1).collect()
    if repeated:
        raise ValueError(f"a change needs one complete key each: {repeated[0].asDict()}")


def insert_by_name(df: DataFrame, rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Append rows by column name; columns they lack are null, columns the table lacks are an error."""
    extra = [c for c in rows.columns if c not in df.columns]
    if extra:
        raise ValueError(f"the table has no columns {extra}")
    cast = rows.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in rows.columns])
    if keys:
        _refuse_repeated_keys(cast, keys)
        if equi_join(df, cast, list(keys), "left_semi").limit(1).collect():
            raise ValueError(f"a row with such a key {list(keys)} exists already")
    return df.unionByName(cast, allowMissingColumns=True)


def insert_values(df: DataFrame, values: Mapping[str, object], keys: Sequence[str] = ()) -> DataFrame:
    """Append one row given as a mapping."""
    unknown = [c for c in values if c not in df.columns]
    if unknown:
        raise ValueError(f"the table has no columns {unknown}")
    row = df.sparkSession.range(1).select(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in values.items()])
    return insert_by_name(df, row, keys)


def insert_distinct(
    dimension: DataFrame, source: DataFrame, key: str, cols: Sequence[str], group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Append the distinct non-null values that the dimension lacks, numbered on after its largest key."""
    new = source.select(*cols).dropna(subset=list(cols)).distinct()
    new = equi_join(new, dimension, list(cols), "left_anti")
    return dimension.unionByName(sequence_ids(new, dimension, key, list(cols), group_rows), allowMissingColumns=True)


def update_by_key(df: DataFrame, changes: DataFrame, keys: Sequence[str], set_nulls: bool = False) -> DataFrame:
    """Overwrite the columns that the changes hold, in the rows with their key.

    A null in a change leaves the value alone unless ``set_nulls``. Keys cannot be changed.
    """
    cols = [c for c in changes.columns if c not in keys]
    unknown = [c for c in cols if c not in df.columns]
    if unknown:
        raise ValueError(f"the table has no columns {unknown}")
    _refuse_repeated_keys(changes, keys)
    renamed = changes.select(*keys, *[F.col(c).cast(df.schema[c].dataType).alias(f"_new_{c}") for c in cols],
                             F.lit(True).alias("_hit"))
    joined = equi_join(df, renamed, list(keys), "left")

    def value(c: str):
        new = F.col(f"_new_{c}")
        return (F.when(F.col("_hit"), new).otherwise(F.col(c)) if set_nulls else F.coalesce(new, F.col(c))).alias(c)

    return joined.select(*[value(c) if c in cols else F.col(c) for c in df.columns])


def delete_by_key(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop the rows whose key is listed; the key table's columns are the key."""
    return equi_join(df, keys, keys.columns, "left_anti")


def clear(df: DataFrame) -> DataFrame:
    """The table without rows."""
    return df.limit(0)


def upsert(df: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update rows whose key exists and append the others, in one join."""
    unknown = [c for c in changes.columns if c not in df.columns]
    if unknown:
        raise ValueError(f"the table has no columns {unknown}")
    _refuse_repeated_keys(changes, keys)
    new = changes.select(*[F.col(c).cast(df.schema[c].dataType).alias(f"_new_{c}") for c in changes.columns])
    same = [F.col(k) == F.col(f"_new_{k}") for k in keys]
    joined = df.join(new, same, "full_outer")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in changes.columns else F.col(c) for c in df.columns]
    )


def delete_cascade(
    tables: Mapping[str, DataFrame], references: Sequence[Reference], table: str, keys: DataFrame
) -> dict[str, DataFrame]:
    """Delete rows by key together with every row that refers to them, directly or not.

    Parents come before children, so one semi join per reference finds what goes; composite keys count.
    """
    parents: dict[str, list[str]] = {}
    for ref in references:
        parents.setdefault(ref.child, []).append(ref.parent)
    gone: dict[str, DataFrame] = {table: equi_join(tables[table], keys, keys.columns, "left_semi")}
    result = dict(tables)
    result[table] = delete_by_key(tables[table], keys)
    for name in load_order(tables, parents):
        lost, kept = None, result[name]
        for ref in references:
            if ref.child != name or ref.parent not in gone:
                continue
            parent_keys = gone[ref.parent].select(*[F.col(p).alias(c) for c, p in ref.on])
            cols = [c for c, _ in ref.on]
            hit = equi_join(kept, parent_keys, cols, "left_semi")
            lost = hit if lost is None else lost.unionByName(hit)
            kept = equi_join(kept, parent_keys, cols, "left_anti")
        if lost is not None:
            gone[name] = gone[name].unionByName(lost) if name in gone else lost
            result[name] = kept
    return result


def load_report(
    tables: Mapping[str, DataFrame],
    primary: Mapping[str, Sequence[str]],
    references: Sequence[Reference] = (),
    required: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Number of violations of every key, reference and not-null rule, one row per rule."""
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations")

    def line(table: str, rule: str, counted: DataFrame) -> DataFrame:
        return counted.select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations")

    lines = []
    for name, cols in primary.items():
        lines.append(line(name, f"key({','.join(cols)})", check_key(tables[name], cols).agg(total)))
    for ref in references:
        orphans = orphan_keys(tables[ref.child], tables[ref.parent], list(ref.on))
        rule = f"reference({','.join(c for c, _ in ref.on)})->{ref.parent}"
        lines.append(line(ref.child, rule, orphans.agg(total)))
    for name, cols in (required or {}).items():
        nulls = check_not_null(tables[name], cols).withColumnRenamed("nulls", "n")
        for col in cols:
            lines.append(line(name, f"not null({col})", nulls.where(F.col("column_name") == col).agg(total)))
    report = lines[0]
    for more in lines[1:]:
        report = report.unionByName(more)
    return report
