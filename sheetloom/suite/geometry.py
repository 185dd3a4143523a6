"""Geometry on shapes that are built from the test tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import geometry as G
from sheetloom.operators import spatial as S
from sheetloom.operators.ordering import add_id
from sheetloom.sources.files import read_geometry
from sheetloom.suite.joins import located
from sheetloom.suite.registry import Tables, query


def _pairs(*points: tuple[Column, Column]) -> Column:
    return F.concat_ws(", ", *[F.concat_ws(" ", x.cast("string"), y.cast("string")) for x, y in points])


def _box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return _pairs((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))


def part_shapes(t: Tables) -> DataFrame:
    """A two-part shape for each part: a box by its size, and a second one that is a sliver for small parts."""
    size = F.col("p_size").cast("double")
    key = F.col("p_partkey").cast("double")
    first = _box(key, size, size, F.lit(2.0))
    second = _box(key + 100, size, size / 64, F.lit(1.0))
    wkt = F.concat(F.lit("MULTIPOLYGON ((("), first, F.lit(")), (("), second, F.lit(")))"))
    return t.part.select(F.col("p_partkey").alias("area_id"), "p_size", wkt.alias("geo_shape"))


@query("geom_load", """
SELECT p_partkey AS area_id, 2 AS parts, CAST(p_partkey AS DOUBLE) AS first_x, CAST(p_partkey + 100 AS DOUBLE) AS second_x FROM part""")
def geom_load(t: Tables) -> DataFrame:
    rows = part_shapes(t).withColumnRenamed("area_id", "id")
    shapes = read_geometry(rows, "geo_shape", "id")
    return shapes.select(
        "area_id", F.size("polygons").alias("parts"),
        F.col("polygons")[0][0][0]["x"].alias("first_x"), F.col("polygons")[1][0][0]["x"].alias("second_x"),
    )


@query("g_parse", """
SELECT p_partkey AS area_id, CASE WHEN p_size > 25 THEN 5 END AS points, p_size > 25 AS sound FROM part""")
def g_parse(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("double")
    ring = _box(F.col("p_partkey").cast("double"), size, size, size)
    sound = F.concat(F.lit("POLYGON (("), ring, F.lit("))"))
    one_paren = F.concat(F.lit("POLYGON ("), ring, F.lit(")"))
    parsed = G.parse_polygon(F.when(F.col("p_size") > 25, sound).otherwise(one_paren))
    return t.part.select(
        F.col("p_partkey").alias("area_id"), F.when(parsed.isNotNull(), F.size(parsed[0])).alias("points"),
        parsed.isNotNull().alias("sound"),
    )


REGION = "POLYGON ((-0.2 -0.2, 0.2 -0.15, 0.25 0.1, 0.0 0.3, -0.25 0.05, -0.2 -0.2), (-0.05 -0.05, 0.05 -0.05, 0.0 0.05, -0.05 -0.05))"


@query("g_contains", """
WITH rings AS (SELECT [
  [{'x':-0.2,'y':-0.2},{'x':0.2,'y':-0.15},{'x':0.25,'y':0.1},{'x':0.0,'y':0.3},{'x':-0.25,'y':0.05},{'x':-0.2,'y':-0.2}],
  [{'x':-0.05,'y':-0.05},{'x':0.05,'y':-0.05},{'x':0.0,'y':0.05},{'x':-0.05,'y':-0.05}]] AS rs),
p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
c AS (SELECT vec_id, x, y, list_sum(list_transform(rs, lambda r: len(list_filter(range(1, len(r)), lambda i: (r[i].y > y) <> (r[i+1].y > y)
      AND x < (r[i+1].x - r[i].x) * (y - r[i].y) / nullif(r[i+1].y - r[i].y, 0) + r[i].x)))) AS n FROM p, rings)
SELECT vec_id, n % 2 = 1 AS inside FROM c""")
def g_contains(t: Tables) -> DataFrame:
    inside = G.contains(G.polygon_literal(REGION), F.col("x"), F.col("y"))
    return located(t).select("vec_id", inside.alias("inside"))


@query("g_area", """
SELECT p_partkey AS area_id, CAST(part AS INT) AS part, CASE part WHEN 1 THEN p_size * 2.0 ELSE p_size / 64.0 END AS area
FROM part, (VALUES (1), (2)) v(part)""")
def g_area(t: Tables) -> DataFrame:
    parts = S.single_parts(read_geometry(part_shapes(t), "geo_shape", "area_id"), "polygons", "area_id")
    return parts.select("area_id", "part", F.round(G.area(F.col("polygons")), 6).alias("area"))


@query("g_explode", """
SELECT p_partkey AS area_id, CAST(part AS INT) AS part, row_number() OVER (ORDER BY p_partkey, part) AS feature_id
FROM part, (VALUES (1), (2)) v(part)""")
def g_explode(t: Tables) -> DataFrame:
    parts = S.single_parts(read_geometry(part_shapes(t), "geo_shape", "area_id"), "polygons", "area_id")
    return add_id(parts.select("area_id", "part"), "feature_id", ["area_id", "part"])


@query("g_slivers", """
SELECT p_partkey AS area_id, CAST(part AS INT) AS part, CASE part WHEN 1 THEN p_size * 2.0 ELSE p_size / 64.0 END >= 0.5 AS kept
FROM part, (VALUES (1), (2)) v(part)""")
def g_slivers(t: Tables) -> DataFrame:
    parts = S.single_parts(read_geometry(part_shapes(t), "geo_shape", "area_id"), "polygons", "area_id")
    kept, dropped = S.slivers(parts, "polygons", 0.5)
    flagged = kept.select("area_id", "part", F.lit(True).alias("kept"))
    return flagged.unionByName(dropped.select("area_id", "part", F.lit(False).alias("kept")))


@query("g_self_intersect", "SELECT p_partkey AS area_id, p_size > 25 AS crosses FROM part")
def g_self_intersect(t: Tables) -> DataFrame:
    """Bow ties for large parts, boxes for the others."""
    x, w = F.col("p_partkey").cast("double"), F.col("p_size").cast("double")
    zero, one = F.lit(0.0), F.lit(1.0)
    bow = _pairs((x, zero), (x + w, one), (x + w, zero), (x, one), (x, zero))
    ring = F.when(F.col("p_size") > 25, bow).otherwise(_box(x, zero, w, one))
    parsed = G.parse_polygon(F.concat(F.lit("POLYGON (("), ring, F.lit("))")))
    return t.part.select(F.col("p_partkey").alias("area_id"), G.self_intersects(parsed[0]).alias("crosses"))


@query("g_per_area", """
SELECT p_size AS size_id, 2 * count(*) AS features, min(p_partkey) AS first_feature FROM part GROUP BY p_size""")
def g_per_area(t: Tables) -> DataFrame:
    parts = S.single_parts(read_geometry(part_shapes(t), "geo_shape", "area_id"), "polygons", "area_id")
    return S.features_per_area(parts.withColumnRenamed("p_size", "size_id"), "size_id", "area_id")
