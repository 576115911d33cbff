"""Data model: axis names, schemas and the small result bundle.

Raw observation fields are all strings (codes stay codes; ``value`` is split
into a double and an annotation later).  The column set is fixed: every
classification axis is declared, axes that a table does not use are null and
are dropped after decoding.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Classification axes of a cube, in the order a response lists them.
CAT_AXES = [f"cat{i:02d}" for i in range(1, 16)]
AXES = ["tab", *CAT_AXES, "area", "time"]

# Lineage / key columns every landed observation carries.
KEY_COLS = ["stats_data_id", "lang", "query_fingerprint", "page_offset", "pos"]

OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField("stats_data_id", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("query_fingerprint", T.StringType()),
        T.StructField("page_offset", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        *[T.StructField(a, T.StringType()) for a in AXES],
        T.StructField("unit", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
    ]
)

CLASSES_SCHEMA = T.StructType(
    [
        T.StructField("stats_data_id", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("axis", T.StringType()),
        T.StructField("axis_name", T.StringType()),
        T.StructField("axis_pos", T.IntegerType()),
        T.StructField("code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("parent", T.StringType()),
        T.StructField("extra", T.StringType()),
    ]
)

NOTES_SCHEMA = T.StructType(
    [
        T.StructField("stats_data_id", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("char", T.StringType()),
        T.StructField("note", T.StringType()),
    ]
)

PAGE_INFO_SCHEMA = T.StructType(
    [
        T.StructField("stats_data_id", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("query_fingerprint", T.StringType()),
        T.StructField("page_offset", T.LongType()),
        T.StructField("total_number", T.LongType()),
        T.StructField("from_number", T.LongType()),
        T.StructField("to_number", T.LongType()),
        T.StructField("next_key", T.LongType()),
    ]
)

# Polygon geometry without a geometry library: rings of (x, y) points.
POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
POLYGONS = T.ArrayType(T.ArrayType(RING))


@dataclass
class Result:
    """A tidy result plus its side tables.

    A DataFrame cannot carry table attributes, so the notes legend (and,
    for geometry joins, the unmatched codes) travel next to it.
    """

    data: DataFrame
    notes: DataFrame | None = None
    unmatched: DataFrame | None = None
