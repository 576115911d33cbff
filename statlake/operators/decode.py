"""Code -> label decoding, column order and cube filters.

Decoding is one LEFT equi-join per axis against that axis's code list,
keyed by ``(stats_data_id, lang, code)``.  Unknown codes keep their row with
a null label; a code listed twice fans the row out (the reference's merge
semantics).  Code lists are metadata, so they are usually tiny and are
broadcast -- but only after their size has been checked; above the bound
the join is left to the planner (sort-merge, AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from statlake.model import AXES

#: Code-list rows that one decode may broadcast, over all its axes.
DEFAULT_BROADCAST_ROWS = 200_000
TAIL = ["unit", "value", "annotation"]


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (``limit`` stops early).
    """
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def axis_summary(classes: DataFrame) -> list[dict]:
    """Axes present in the code lists, in response order, with code-list
    sizes.  One aggregate job; at most one row per axis (18) reaches the
    driver, where it is sorted."""
    rows = (
        classes.groupBy("axis")
        .agg(
            F.min("axis_pos").alias("axis_pos"),
            F.count(F.lit(1)).alias("n_codes"),
            F.min("axis_name").alias("axis_name"),
            (F.min("axis_name") == F.max("axis_name")).alias("one_name"),
        )
        .collect()
    )
    out = [r.asDict() for r in rows if r["axis"] is not None]
    return sorted(out, key=lambda r: (r["axis_pos"] is None, r["axis_pos"] or 0, r["axis"]))


def decoded_column_order(columns: list[str], axis_ids: list[str]) -> list[str]:
    """area, area_code, time, time_code, other decoded axes as label/code
    pairs (in code-list order), then any other columns, then unit, value,
    annotation."""
    front: list[str] = []
    for axis in ("area", "time"):
        if axis in axis_ids:
            front += [axis, f"{axis}_code"]
    for axis in axis_ids:
        if axis not in ("area", "time"):
            front += [axis, f"{axis}_code"]
    tail = [c for c in TAIL if c in columns]
    middle = [c for c in columns if c not in front and c not in tail]
    return front + middle + tail


def decode_axes(obs: DataFrame, classes: DataFrame, axes: list[str] | None = None,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                drop_unused_axes: bool = True, keys: list[str] | None = None) -> DataFrame:
    """Decode every axis present in both the data and ``classes``.

    ``axes`` names the axes the data carries (default: every axis column
    of ``obs``); those without a code list stay as raw code columns, the
    other declared-but-absent axis columns are dropped.  For axis ``X`` the
    coded column becomes ``X_code`` and ``X`` holds the label; ``X`` carries
    the axis display name as column metadata (``label``) when the code
    lists agree on one.
    """
    if axes is not None:
        classes = classes.where(F.col("axis").isin(axes))
    summary = [s for s in axis_summary(classes) if s["axis"] in obs.columns]
    keep_raw = set(axes or []) - {s["axis"] for s in summary}
    if keys is None:  # lake-wide: codes are unique per (table, language)
        keys = [k for k in ("stats_data_id", "lang") if k in obs.columns and k in classes.columns]
    out = obs
    # the bound holds for all axes together: the smallest lists are broadcast first
    left, small = max_broadcast_rows, set()
    for s in sorted(summary, key=lambda s: s["n_codes"]):
        if s["n_codes"] <= left:
            small.add(s["axis"])
            left -= s["n_codes"]
    for s in summary:
        axis = s["axis"]
        lookup = classes.where(F.col("axis") == axis).select(
            *[F.col(k).alias(f"__{axis}_{k}") for k in keys],
            F.col("code").alias(f"__{axis}_code"),
            F.col("name").alias(f"__{axis}_label"),
        )
        code = obs[axis]
        if axis in small:
            lookup = F.broadcast(lookup)
        else:  # rows without a code would all meet in one task; no code has such a name
            spread = F.pmod(F.xxhash64(*[obs[c] for c in obs.columns if not isinstance(obs.schema[c].dataType, MapType)]), F.lit(4096))
            code = F.coalesce(code, F.concat(F.lit("\u0000none-"), spread.cast("string")))
        cond = code == lookup[f"__{axis}_code"]
        for k in keys:  # null is a value: pages that name no language carry their own lists
            cond = cond & obs[k].eqNullSafe(lookup[f"__{axis}_{k}"])
        out = out.join(lookup, cond, "left")
    decoded = [s["axis"] for s in summary]
    exprs: dict[str, object] = {}
    for c in obs.columns:
        if c in decoded:
            continue
        if drop_unused_axes and c in AXES and c not in keep_raw:
            continue
        exprs[c] = obs[c]
    for s in summary:
        axis = s["axis"]
        meta = {"label": s["axis_name"]} if s["one_name"] else {}
        exprs[axis] = F.col(f"__{axis}_label").alias(axis, metadata=meta)
        exprs[f"{axis}_code"] = obs[axis].alias(f"{axis}_code")
    order = decoded_column_order(list(exprs), decoded)
    return out.select(*[exprs[c].alias(c) if c not in decoded else exprs[c] for c in order])


def filter_codes(df: DataFrame, **codes: str | list[str] | None) -> DataFrame:
    """Keep rows whose axis code is in the given list; several axes AND
    together (``filter_codes(df, area=["13000"], cat01=["00", "12"])``).
    Applied to landed parquet the predicates reach the scan."""
    for axis, wanted in codes.items():
        if wanted is None:
            continue
        values = [wanted] if isinstance(wanted, str) else list(wanted)
        df = df.where(F.col(axis).isin(values))
    return df


def time_window(df: DataFrame, time_from: str | None = None, time_to: str | None = None,
                col: str = "time") -> DataFrame:
    """Inclusive window on fixed-width time codes (string comparison)."""
    if time_from is not None:
        df = df.where(F.col(col) >= F.lit(time_from))
    if time_to is not None:
        df = df.where(F.col(col) <= F.lit(time_to))
    return df


def coded_columns(obs: DataFrame, axes: list[str] | None = None,
                  keep: list[str] | None = None) -> DataFrame:
    """Coded rows only (``decode_labels = FALSE``): axis codes under the axis
    names, ``unit`` and ``value``; no ``_code`` columns, no joins."""
    axes = [a for a in (axes or AXES) if a in obs.columns]
    keep = [c for c in (keep or []) if c in obs.columns and c not in TAIL and c not in axes]
    tail = [c for c in TAIL if c in obs.columns]
    return obs.select(*keep, *axes, *tail)
