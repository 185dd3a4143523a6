"""Files: delimited text, Parquet, folders of sheets, listings and geometry tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.functions.geometry import parse_multipolygon
from sheetloom.functions.names import clean_names
from sheetloom.session import spread


def read_delim(
    spark: SparkSession, path: str, sep: str = ";", schema: T.StructType | str | None = None, decimal_comma: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Delimited text with a header. Without a schema every column is text, so nothing is scanned twice.

    With ``decimal_comma`` the floating-point columns of the schema are read from numbers such as 1,5.
    Cells may hold line breaks inside quotes; a file is then one task. Pass ``multi_line=False`` for files without them,
    which Spark splits.
    """
    options = {"sep": sep, "header": "true", "multiLine": str(multi_line).lower(), "quote": '"', "escape": '"', "nullValue": ""}
    reader = spark.read.options(**options)
    if schema is None:
        return reader.option("inferSchema", "false").csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not decimal_comma:
        return reader.schema(wanted).csv(path)
    text = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f.dataType)
        for f in wanted.fields
    ])
    raw = reader.schema(text).csv(path)
    return raw.select(*[
        F.translate(F.col(f.name), ",", ".").try_cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in wanted.fields
    ])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    return read_delim(spark, path, ",", schema, multi_line=multi_line)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Tab-separated archive; its quotes are plain characters and lines are splittable."""
    reader = spark.read.options(sep="\t", header="true", quote="", nullValue="")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_bundle(spark: SparkSession, paths: Mapping[str, str], fmt: str = "csv", sep: str = ",") -> dict[str, DataFrame]:
    """Sheets by cleaned name, each with cleaned column names; one file or folder per sheet."""
    names = clean_names(paths)
    sheets = {}
    for name, path in zip(names, paths.values()):
        sheet = read_delim(spark, path, sep) if fmt == "csv" else spark.read.format(fmt).load(path)
        sheets[name] = sheet.toDF(*clean_names(sheet.columns))
    return sheets


def pluck(bundle: Mapping[str, DataFrame], name: str) -> DataFrame:
    if name not in bundle:
        raise KeyError(f"no sheet {name!r}; there are {sorted(bundle)}")
    return bundle[name]


def with_order(df: DataFrame, name: str = "_ord") -> DataFrame:
    """Add a column that follows the order of the lines of a file source: by file name, place in the file, line.

    Several files are packed into tasks by size, so the running id alone follows the lines of one split only.
    """
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    return df.withColumn(name, F.struct(*place))


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """Path, parent folder, file name and size of the files whose name matches; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    listing = reader.option("recursiveFileLookup", str(recursive).lower()).load(folder)
    pieces = F.split("path", "/")
    return listing.select(
        "path",
        F.try_element_at(pieces, F.lit(-2)).alias("folder"),
        F.try_element_at(pieces, F.lit(-1)).alias("file_name"),
        "length",
    )


def read_geometry(df: DataFrame, wkt: str, id_column: str, area: str = "area_id") -> DataFrame:
    """Geometry table: the id under the area's name, and the parsed polygons beside their text.

    Texts are short and parsing takes long, so the rows are spread before.
    """
    return spread(df).withColumn("polygons", parse_multipolygon(F.col(wkt))).withColumnRenamed(id_column, area)
