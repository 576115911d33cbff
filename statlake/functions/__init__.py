"""Column expressions: all built-in Spark functions, no Python on the row path."""

from statlake.functions.values import (
    NUMERIC_PATTERN,
    annotation_of,
    as_count,
    boundary_srid,
    dig,
    numeric_value,
    prefecture_area_code,
    redact_param,
    split_value_annotation,
    year_of_time_code,
)

__all__ = [
    "NUMERIC_PATTERN",
    "annotation_of",
    "as_count",
    "boundary_srid",
    "dig",
    "numeric_value",
    "prefecture_area_code",
    "redact_param",
    "split_value_annotation",
    "year_of_time_code",
]
