"""Queries on polygons that overlap or meet off their vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.operators import geo
from statlake.plans import testdata as td

#: A rectangle per customer on a grid of quarters: (left, bottom, width, height).
_RECTANGLE = ("(c_custkey % 40) * 0.75", "(c_custkey * 7 % 40) * 0.5", "1 + (c_custkey % 3) * 0.5", "1 + (c_custkey % 4) * 0.75")
_KEY = "lpad(CAST(c_nationkey + 1 AS {text}), 2, '0') || '000'"


def rectangles(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping rectangles of each nation, some with a hole."""
    left, bottom, width, height = (F.expr(x).cast("double") for x in _RECTANGLE)

    def ring(x, y, w, h):
        return F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in ((F.lit(0.0), F.lit(0.0)), (w, F.lit(0.0)), (w, h), (F.lit(0.0), h), (F.lit(0.0), F.lit(0.0)))])

    outer = ring(left, bottom, width, height)
    hole = ring(left + 0.25, bottom + 0.25, F.lit(0.5), F.lit(0.5))
    polygon = F.when(F.expr("c_custkey % 5 = 0"), F.array(outer, hole)).otherwise(F.array(outer))
    return td.table(spark, sf, "customer").select(F.expr(_KEY.format(text="STRING")).alias("area_code"), F.array(polygon).alias("polygons"))


def union_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """Area of each nation's union, from its edges and from its stitched polygons."""
    b = geo.dissolve(rectangles(spark, sf), overlay=True)
    rings = F.flatten(F.col("polygons"))
    stitched = F.aggregate(rings, F.lit(0.0), lambda acc, r: acc + geo.ring_area2(r) / 2)
    return b.select("area_code", F.round("area", 6).alias("area"), F.round(stitched, 6).alias("polygon_area"))


QUERIES = {"union_overlaps": union_overlaps}

_L, _B, _W, _H = _RECTANGLE
_CELLS = f"""SELECT count(*) / 16.0 AS area, area_code FROM (SELECT DISTINCT area_code, i, j FROM (
  SELECT {_KEY.format(text='VARCHAR')} AS area_code, c_custkey, CAST({_L} * 4 AS BIGINT) AS l, CAST({_B} * 4 AS BIGINT) AS b,
    unnest(range(0, CAST(({_W}) * 4 AS BIGINT))) AS di, CAST(({_H}) * 4 AS BIGINT) AS h FROM customer) c,
  LATERAL (SELECT l + di AS i, b + dj AS j FROM (SELECT unnest(range(0, h)) AS dj)
    WHERE NOT (c_custkey % 5 = 0 AND di BETWEEN 1 AND 2 AND dj BETWEEN 1 AND 2)) x) GROUP BY area_code"""
ORACLE = {"union_overlaps": f"SELECT area_code, round(CAST(area AS DOUBLE), 6) AS area, round(CAST(area AS DOUBLE), 6) AS polygon_area FROM ({_CELLS})"}
