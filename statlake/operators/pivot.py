"""Long -> wide reshaping of tidy results.

The wide form is one conditional aggregate per column label, grouped by the
id columns: a single shuffle with map-side partial aggregation, so even a
very hot id group collapses before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DUPLICATE_POLICIES = ("raise", "first", "sum", "count")
#: More labels than this do not become columns; ``pivot_map`` takes any number.
MOST_COLUMNS = 2000


class DuplicateCellsError(ValueError):
    """More than one value for an (id, name) cell."""


def default_id_cols(columns: list[str], names_from: str, values_from: str) -> list[str]:
    drop = {names_from, f"{names_from}_code", values_from, "annotation"}
    return [c for c in columns if c not in drop]


def _check(data: DataFrame, names_from: str, values_from: str, id_cols: list[str] | None, duplicates: str) -> list[str]:
    """The id columns of a pivot whose arguments hold."""
    cols = data.columns
    if not isinstance(names_from, str) or names_from not in cols:
        raise ValueError("names_from must be a column name in data")
    if values_from not in cols:
        raise ValueError(f"values_from ({values_from!r}) is not a column in data")
    if duplicates not in DUPLICATE_POLICIES:
        raise ValueError(f"duplicates must be one of {DUPLICATE_POLICIES}")
    if id_cols is None:
        return default_id_cols(cols, names_from, values_from)
    missing = [c for c in id_cols if c not in cols]
    if missing:
        raise ValueError(f"Unknown id_cols: {missing}")
    return id_cols


def pivot_map(data: DataFrame, names_from: str, values_from: str = "value", id_cols: list[str] | None = None,
              duplicates: str = "raise", out_col: str = "cells") -> DataFrame:
    """One row per id with its cells as a map from label to value, for any
    number of labels not known beforehand; nothing comes to the driver.

    Cells are aggregated by (id, label) first, where ``raise`` stops the job at a
    cell with several values, so a row's map holds each label once.  A null label is
    the key ``null``."""
    id_cols = _check(data, names_from, values_from, id_cols, duplicates)
    label = F.coalesce(F.col(names_from).cast("string"), F.lit("null")).alias("__label")
    how = {"sum": F.sum(values_from), "count": F.count("*")}.get(duplicates, F.first(values_from, ignorenulls=True))
    cells = data.groupBy(*id_cols, label).agg(how.alias("__cell"), F.count("*").alias("__n"))
    if duplicates == "raise":
        said = F.raise_error(F.concat(F.lit("several values share the cell "), F.col("__label")))
        cells = cells.withColumn("__cell", F.when(F.col("__n") > 1, said.cast(cells.schema["__cell"].dataType)).otherwise(F.col("__cell")))
    return cells.groupBy(*id_cols).agg(F.map_from_entries(F.collect_list(F.struct("__label", "__cell"))).alias(out_col))


def pivot_wide(data: DataFrame, names_from: str, values_from: str = "value",
               id_cols: list[str] | None = None, values: list[str] | None = None,
               duplicates: str = "raise") -> DataFrame:
    """Spread the labels of ``names_from`` across columns.

    * ``id_cols`` default: every column except ``names_from``, its
      ``_code`` partner, ``values_from`` and ``annotation``; with no id
      columns the result is one row.
    * ``values``: the column labels (e.g. from the code list) -- skips a
      distinct pass; default is the sorted distinct labels, an error beyond
      ``MOST_COLUMNS`` of them (``pivot_map`` has no such bound).
    * ``duplicates``: ``raise`` (default) if a cell has more than one value;
      ``first`` / ``sum`` aggregate; ``count`` gives cell counts with 0 for
      absent cells (what an aggregate-less cast silently does).
    """
    id_cols = _check(data, names_from, values_from, id_cols, duplicates)
    if values is None:
        values = [r[0] for r in data.select(names_from).distinct().limit(MOST_COLUMNS + 1).collect()]
        if len(values) > MOST_COLUMNS:
            raise ValueError(f"{names_from} has more than {MOST_COLUMNS} labels; use pivot_map")
        values = sorted(values, key=lambda v: (v is None, v if v is not None else ""))
    if duplicates == "raise":
        dup = (
            data.groupBy(*id_cols, names_from).count().where(F.col("count") > 1).limit(1).count()
        )
        if dup:
            raise DuplicateCellsError(
                "several values share one cell; pass duplicates='first'|'sum'|'count' "
                "or add id columns"
            )
    # One conditional aggregate per label: a single shuffle with map-side
    # partial aggregation (Spark's own pivot aggregates twice).
    name, val = F.col(names_from), F.col(values_from)
    aggs = []
    for v in values:
        hit = name.isNull() if v is None else (name == F.lit(v))
        label = "null" if v is None else str(v)
        if duplicates == "sum":
            expr = F.sum(F.when(hit, val))
        elif duplicates == "count":
            expr = F.count(F.when(hit, F.lit(1)))
        else:  # raise (cells are unique) or first
            expr = F.first(F.when(hit, val), ignorenulls=True)
        aggs.append(expr.alias(label))
    if not aggs:
        return data.select(*id_cols).distinct()
    return data.groupBy(*id_cols).agg(*aggs)
