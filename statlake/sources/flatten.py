"""Flatten nested JSON records into ``(row_id, path, value)`` rows.

Rules (the service's record conventions):

1. nested keys are joined with ``_``; a leading ``@`` is stripped;
2. a ``$`` text node takes its parent's name (``{"@code": c, "$": v}`` under
   ``X`` gives ``X = v`` and ``X_code = c``); a ``$`` at the root is ``value``;
3. array elements get 1-based index suffixes (``R_1_id``, ``R_2_id``);
4. JSON null is kept as a null value; empty ``{}`` / ``[]`` produce nothing.

Implementation: the record is parsed once to VARIANT and walked level by
level with ``variant_explode_outer`` in one lateral chain.  Leaves pass
through a level unchanged, containers are expanded, empty containers drop
out.  There is no union of per-level branches, so the input is scanned and
parsed exactly once.  Object keys come back in sorted order (a property of
VARIANT), so the wide form orders its columns by path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_IS_CONTAINER = ("(try_variant_get(n.v, '$', 'map<string,variant>') IS NOT NULL "
                 "OR try_variant_get(n.v, '$', 'array<variant>') IS NOT NULL)")

# A non-null ``pos`` means the node was a container with children (expand
# it); a null ``pos`` means a leaf (keep) or an empty container (drop).  The
# type test runs only for those null-``pos`` rows.
_LEVEL = f"""
SELECT n.row_id,
       CASE WHEN e.pos IS NOT NULL THEN
         concat_ws('_', nullif(n.path, ''),
                   CASE WHEN e.key IS NULL THEN CAST(e.pos + 1 AS STRING)
                        WHEN e.key = '$' THEN NULL
                        ELSE regexp_replace(e.key, '^@', '') END)
       ELSE n.path END AS path,
       CASE WHEN e.pos IS NOT NULL THEN e.value ELSE n.v END AS v
FROM {{nodes}} AS n, LATERAL variant_explode_outer(n.v) AS e
WHERE e.pos IS NOT NULL OR NOT {_IS_CONTAINER}
"""


def flatten_json(df: DataFrame, json_col: str = "record", id_col: str = "row_id",
                 max_depth: int = 8) -> DataFrame:
    """JSON text column -> long ``(row_id, path, value)``.

    Unparsable text gives no rows.  Containers still present after
    ``max_depth`` levels raise an error inside the job (no extra pass).
    """
    spark = df.sparkSession
    nodes = df.select(
        F.col(id_col).alias("row_id"),
        F.lit("").alias("path"),
        F.try_parse_json(F.col(json_col)).alias("v"),
    ).where(F.col("v").isNotNull())
    for _ in range(max_depth):
        nodes = spark.sql(_LEVEL, nodes=nodes)
    container = (F.try_variant_get(F.col("v"), "$", "map<string,variant>").isNotNull()
                 | F.try_variant_get(F.col("v"), "$", "array<variant>").isNotNull())
    value = F.when(
        container, F.raise_error(F.lit(f"flatten_json: nesting deeper than max_depth={max_depth}"))
    ).otherwise(F.col("v").cast("string"))
    return nodes.select(
        "row_id",
        F.when(F.col("path") == "", F.lit("value")).otherwise(F.col("path")).alias("path"),
        value.cast("string").alias("value"),
    )


#: More paths than this do not become columns.
MOST_COLUMNS = 2000


def flatten_wide(long: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long ``(row_id, path, value)`` -> one row per record, one column per
    path.  Pass ``columns`` to skip the distinct pass over paths; absent
    paths are null (union with fill).  More than ``MOST_COLUMNS`` paths are an
    error: the long form holds any number."""
    if columns is None:
        columns = sorted(r["path"] for r in long.select("path").distinct().limit(MOST_COLUMNS + 1).collect())
        if len(columns) > MOST_COLUMNS:
            raise ValueError(f"more than {MOST_COLUMNS} different paths; use the long form")
    # One conditional aggregate per path: a single shuffle on row_id.
    aggs = [F.first(F.when(F.col("path") == F.lit(c), F.col("value")), ignorenulls=True).alias(c)
            for c in columns]
    return long.groupBy("row_id").agg(*aggs)
