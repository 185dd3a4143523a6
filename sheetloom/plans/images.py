"""Image catalogue from file names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import text as X
from sheetloom.operators.joins import equi_join


def image_catalogue(files: DataFrame, path: str, target: str) -> DataFrame:
    """Names, keys, licences, credits and target paths read from image paths."""
    folder, name = X.folder_and_file(F.col(path))
    images = files.where(F.col(path).rlike(r"\.(jpg|png)$"))
    base = F.regexp_replace(F.col(path), r"/[^/]*$", "")
    parts = X.file_name_parts(folder, name, base, target)
    return images.select("*", *[column.alias(c) for c, column in parts.items()])


def keys_without_files(folders: DataFrame, files: DataFrame, folder: str, width: int = 7) -> DataFrame:
    """Keys at the end of the names of folders that hold no file."""
    empty = equi_join(folders.select(folder).distinct(), files.select(folder), [folder], "left_anti")
    return empty.select(X.trailing_key(F.col(folder), width).alias("usage_key"))
