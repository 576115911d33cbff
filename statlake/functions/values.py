"""Scalar column functions.

Everything returns a ``Column`` built from Spark built-ins so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A cell is numeric only in plain decimal / exponent notation, optionally
# padded with whitespace.  Spark's own string->double cast also accepts
# forms such as "1d", "Infinity" or "NaN"; those are markers, not numbers.
NUMERIC_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_EDGE_SPACE = r"^\s+|\s+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_value(raw: str | Column) -> Column:
    """Parse a cell to double; null when the cell is not a plain number."""
    raw = _col(raw)
    cleaned = F.regexp_replace(raw, _EDGE_SPACE, "")
    return F.when(raw.rlike(NUMERIC_PATTERN), cleaned.try_cast("double"))


def annotation_of(raw: str | Column) -> Column:
    """The original cell when it is a non-empty, non-numeric marker."""
    raw = _col(raw)
    return F.when(
        raw.isNotNull() & (F.length(raw) > 0) & ~raw.rlike(NUMERIC_PATTERN), raw
    )


def split_value_annotation(df: DataFrame, col: str = "value") -> DataFrame:
    """Replace the string ``value`` column by a double ``value`` and a string
    ``annotation`` column (suppression / footnote markers such as ``-``,
    ``***``, ``X``).  Empty and null cells give null in both.  A frame
    without a value column still gains typed columns."""
    if col not in df.columns:
        return df.withColumns(
            {col: F.lit(None).cast("double"), "annotation": F.lit(None).cast("string")}
        )
    raw = F.col(col)
    # Both outputs lead with the same regex test, so whole-stage codegen's
    # subexpression elimination evaluates it once per row.
    is_num = raw.rlike(NUMERIC_PATTERN)
    return df.withColumns({
        "annotation": F.when(~is_num & (F.length(raw) > 0), raw),
        col: F.when(is_num, F.regexp_replace(raw, _EDGE_SPACE, "").try_cast("double")),
    })


def redact_param(c: str | Column, name: str = "appId") -> Column:
    """Hide the value of a URL query parameter wherever it appears."""
    return F.regexp_replace(_col(c), rf"({name}=)[^&\s\"]+", "$1<hidden>")


def as_count(c: str | Column) -> Column:
    """Lenient count parse: null when not an integer."""
    return _col(c).try_cast("bigint")


def year_of_time_code(c: str | Column) -> Column:
    """Year of a time code such as ``2018000103`` (first four characters)."""
    return F.substring(_col(c), 1, 4).try_cast("int")


def prefecture_area_code(code: str | Column) -> Column:
    """Two-digit prefecture code -> five-digit area code (``13`` -> ``13000``)."""
    return F.concat(_col(code), F.lit("000"))


def boundary_srid(datum: str | Column) -> Column:
    """Datum choice -> spatial reference id (JGD2011 6668, else JGD2000 4612)."""
    return F.when(_col(datum) == "2011", F.lit(6668)).otherwise(F.lit(4612))


def dig(json_text: str | Column, *keys: str) -> Column:
    """Null-safe nested access into JSON text: ``dig(body, "A", "B")`` is
    ``A.B`` or null when any level is missing (keys may contain ``@``)."""
    path = "$" + "".join("['" + k.replace("'", "\\'") + "']" for k in keys)
    return F.get_json_object(_col(json_text), path)
