"""The main pipeline with its geometry options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.plans import testdata as td
from statlake.plans.tidy import tidy

TABLE_ID = "0003000009"


def _observations(spark: SparkSession, sf: str) -> DataFrame:
    c = td.customer_municipalities(spark, sf)
    return c.select(F.lit(TABLE_ID).alias("stats_data_id"), F.lit("E").alias("lang"), F.col("c_custkey").alias("page_offset"), F.lit(0).alias("pos"), F.col("area_code").alias("area"),
                    F.lit(td.UNIT).alias("unit"), F.round(F.col("value") * 100).cast("bigint").cast("string").alias("value"))


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    areas = td.customer_municipalities(spark, sf).select("area_code").distinct()
    return areas.select(F.lit(TABLE_ID).alias("stats_data_id"), F.lit("E").alias("lang"), F.lit("area").alias("axis"), F.lit("Area").alias("axis_name"), F.lit(1).alias("axis_pos"),
                        F.col("area_code").alias("code"), F.concat(F.lit("area "), F.col("area_code")).alias("name"))


def tidy_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """Decoded rows with the boundaries of their codes: level from the codes,
    year, datum and designated cities by argument."""
    r = tidy(_observations(spark, sf), _codes(spark, sf), stats_data_id=TABLE_ID, lang="E", axes=["area"], keep_lineage=True,
             geometry_areas=td.supplier_small_areas(spark, sf), geometry_designated="city", geometry_year=2015, geometry_datum="2011")
    return r.data.select(F.col("page_offset").alias("c_custkey"), "area", "area_code", "value", F.col("polygons").isNotNull().alias("has_geometry"), "boundary_area", "srid")



QUERIES = {"tidy_geometry": tidy_geometry}


def oracle(customers: str, boundaries: str) -> dict[str, str]:
    """``boundaries``: SQL of the dissolved areas with wards counted towards their city."""
    return {"tidy_geometry": f"""SELECT d.c_custkey, 'area ' || d.area_code AS area, d.area_code, CAST(round(d.value * 100) AS DOUBLE) AS value,
  b.area_code IS NOT NULL AS has_geometry, b.area AS boundary_area, CASE WHEN b.area_code IS NOT NULL THEN 6668 END AS srid
FROM {customers} d LEFT JOIN ({boundaries}) b ON b.area_code = d.area_code"""}
