"""Small fixed tables as literal DataFrames.

A SQL ``VALUES`` clause becomes a ``LocalRelation``: the rows live in the
plan (no Python RDD, one partition, exact size known to the planner), so
broadcasting them is free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """``rows`` as a DataFrame with the DDL ``schema`` (e.g. "a string, b int")."""
    st = T._parse_datatype_string(schema)
    if not isinstance(st, T.StructType):
        raise ValueError("schema must describe a struct")
    names = [f"c{i}" for i in range(len(st.fields))]
    casts = ", ".join(
        f"CAST({n} AS {f.dataType.simpleString()}) AS `{f.name}`" for n, f in zip(names, st.fields, strict=True)
    )
    if not rows:
        nulls = ", ".join("NULL" for _ in names)
        return spark.sql(f"SELECT {casts} FROM VALUES ({nulls}) AS t({', '.join(names)}) WHERE FALSE")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(names)})")
