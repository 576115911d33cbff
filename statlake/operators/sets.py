"""Set operations used across the pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_fill(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns missing from a frame are null
    (heterogeneous pages / records line up)."""
    if not frames:
        raise ValueError("union_fill needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_codes(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null codes of one column."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def codes_except(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Distinct codes of ``a`` not in ``b`` (set difference, left anti)."""
    return distinct_codes(a, col).join(distinct_codes(b, col), col, "left_anti")


def codes_intersect(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Distinct codes present in both."""
    return distinct_codes(a, col).join(distinct_codes(b, col), col, "left_semi")


def comma_list(codes: Column) -> Column:
    """An array of codes as the service's comma-joined request form."""
    return F.array_join(codes, ",")
