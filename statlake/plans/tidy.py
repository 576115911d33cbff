"""End-to-end pipelines over a landed cube.

``tidy``: restrict -> filter codes/time -> page -> split value/annotation
-> decode every axis -> order columns.  On landed parquet this is one
stage: scan (filters pushed down) -> projection -> broadcast hash joins,
with no shuffle unless a limit (top-k) or geometry join asks for one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.values import split_value_annotation
from statlake.model import AXES, Result
from statlake.operators.decode import (
    DEFAULT_BROADCAST_ROWS,
    coded_columns,
    decode_axes,
    filter_codes,
    time_window,
)
from statlake.operators.paging import take_rows
from statlake.operators.quality import (
    InvalidArgument,
    check_count,
    language_choice,
    normalise_lang,
    prefer_language,
    validate_stats_data_args,
)
from statlake.plans.reference import lookup_curated_id

#: Columns that tell where a row comes from; ``extra`` holds further keys of its record.
LINEAGE = ["lang", "query_fingerprint", "page_offset", "pos", "extra"]


def _restrict(df: DataFrame, stats_data_id, lang) -> DataFrame:
    if stats_data_id is not None and "stats_data_id" in df.columns:
        ids = [stats_data_id] if isinstance(stats_data_id, str) else list(stats_data_id)
        df = df.where(F.col("stats_data_id").isin(ids))
    if lang is not None and "lang" in df.columns:
        df = df.where(F.col("lang") == normalise_lang(lang))
    return df


def _prepare(obs, stats_data_id, lang, fallback_lang, codes, time_from, time_to,
             limit, start_position, order_by, pages=None, pulls=None) -> DataFrame:
    check_count(limit, "limit")
    check_count(start_position, "start_position")
    if int(start_position) == 0:
        raise InvalidArgument("start_position counts from 1")
    if fallback_lang:
        first, second = normalise_lang(lang or "E"), normalise_lang(fallback_lang)
        o = _restrict(obs, stats_data_id, None)
        o = o.where(F.col("lang").isin(first, second))
        if pages is None:
            o = prefer_language(o, keys=["stats_data_id"], preferred=first, fallback=second).drop("lang_used")
        else:  # page statuses decide: an error of the service is not masked by the other language
            choice = language_choice(pages, preferred=first, fallback=second).where("lang_used is not null")
            choice = choice.select("stats_data_id", F.col("lang_used").alias("lang"))
            o = o.join(choice, ["stats_data_id", "lang"], "left_semi")
    else:
        o = _restrict(obs, stats_data_id, lang)
    o = filter_codes(o, **(codes or {}))
    o = time_window(o, time_from, time_to)
    if limit is not None or int(start_position) > 1:
        o = take_rows(o, limit=limit, start_position=int(start_position), order_by=order_by, keys=pulls)
    return o


def tidy(obs: DataFrame, classes: DataFrame | None = None, notes: DataFrame | None = None, *,
         stats_data_id=None, lang: str | None = None, fallback_lang: str | None = None,
         codes: dict | None = None, time_from: str | None = None, time_to: str | None = None,
         decode_labels: bool = True, limit: int | None = None, start_position: int = 1,
         order_by: list[str] | None = None, axes: list[str] | None = None,
         keep_lineage: bool = False, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
         geometry: DataFrame | None = None, pages: DataFrame | None = None, pulls: list[str] | None = None,
         geometry_areas: DataFrame | None = None, geometry_level: str = "auto", geometry_designated: str = "both",
         geometry_year: int | None = None, geometry_datum: str = "2000", geometry_overlay: bool = False) -> Result:
    """Tidy, labelled observations (+ notes legend, + unmatched codes when
    ``geometry`` boundaries are given).

    ``limit`` and ``start_position`` count the matches of each pull; ``pulls`` names
    the columns that tell pulls apart (an empty list: all rows left by the filters
    are one, and the first rows are a plain top-k).  ``geometry_areas`` are small
    areas from which the boundaries of the codes in the data are made, at
    ``geometry_level`` and with the other ``geometry_`` options.  ``pages``
    (classified page statuses: ``stats_data_id``, ``lang``, ``ok``,
    ``error_class``) makes a language fallback stop at errors that the other
    language must not hide."""
    if (geometry is not None or geometry_areas is not None) and not decode_labels:
        raise InvalidArgument("geometry requires decode_labels=True (it joins on area_code)")
    if geometry is not None and geometry_areas is not None:
        raise InvalidArgument("give boundaries or small areas, not both")
    if isinstance(stats_data_id, str):
        validate_stats_data_args(stats_data_id, limit=limit, start_position=start_position)
    o = _prepare(obs, stats_data_id, lang, fallback_lang, codes, time_from, time_to,
                 limit, start_position, order_by, pages, pulls)
    o = split_value_annotation(o)
    if decode_labels and classes is not None:
        cl = _restrict(classes, stats_data_id, None)
        keys = None
        if lang is not None and not fallback_lang:
            cl = cl.where(F.col("lang") == normalise_lang(lang))
            if isinstance(stats_data_id, str):
                keys = []  # both sides hold one table in one language: join on the code alone
        data = decode_axes(o, cl, axes=axes, max_broadcast_rows=max_broadcast_rows, keys=keys)
    else:
        data = coded_columns(o, axes=axes, keep=[c for c in o.columns if c not in AXES])
    if not keep_lineage:
        data = data.drop(*[c for c in LINEAGE if c in data.columns])
    nt = _restrict(notes, stats_data_id, lang) if notes is not None else None
    unmatched = None
    if geometry is not None:
        from statlake.operators.geo import join_geometry

        data, unmatched = join_geometry(data, geometry)
    elif geometry_areas is not None:
        from statlake.operators.geo import attach_geometry

        data, unmatched = attach_geometry(data, geometry_areas, geometry_level, geometry_designated, geometry_year, geometry_datum, overlay=geometry_overlay)
    return Result(data=data, notes=nt, unmatched=unmatched)


def coded(obs: DataFrame, *, stats_data_id=None, lang: str | None = None,
          codes: dict | None = None, time_from: str | None = None, time_to: str | None = None,
          limit: int | None = None, start_position: int = 1, order_by: list[str] | None = None,
          axes: list[str] | None = None, keep: list[str] | None = None, pulls: list[str] | None = None) -> DataFrame:
    """Coded observations: codes under the axis names, ``value`` still a
    string, no annotation column."""
    if isinstance(stats_data_id, str):
        validate_stats_data_args(stats_data_id, limit=limit, start_position=start_position)
    o = _prepare(obs, stats_data_id, lang, None, codes, time_from, time_to,
                 limit, start_position, order_by, pulls=pulls)
    return coded_columns(o, axes=axes, keep=keep)


def tidy_curated(key: str, obs: DataFrame, classes: DataFrame | None = None,
                 notes: DataFrame | None = None, **kwargs) -> Result:
    """``tidy`` for a curated table key."""
    return tidy(obs, classes, notes, stats_data_id=lookup_curated_id(key), **kwargs)


def labour_force_survey(obs, classes=None, notes=None, **kwargs) -> Result:
    return tidy_curated("labour_force_survey", obs, classes, notes, **kwargs)


def family_income_survey(obs, classes=None, notes=None, **kwargs) -> Result:
    return tidy_curated("family_income_survey", obs, classes, notes, **kwargs)


def population_census(obs, classes=None, notes=None, **kwargs) -> Result:
    return tidy_curated("population_census", obs, classes, notes, **kwargs)


def economic_census(obs, classes=None, notes=None, **kwargs) -> Result:
    return tidy_curated("economic_census", obs, classes, notes, **kwargs)


def annotation_counts(data: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """Frequency of each annotation marker of each table, with its legend text.

    Counts are kept by those of ``stats_data_id`` and ``lang`` that ``data``
    has; a legend counts only for its own table and language."""
    keys = [k for k in ("stats_data_id", "lang") if k in data.columns]
    counts = (
        data.where(F.col("annotation").isNotNull())
        .groupBy(*keys, "annotation").agg(F.count(F.lit(1)).alias("n"))
    )
    if notes is None:
        return counts
    on = [*[k for k in keys if k in notes.columns], "annotation"]
    legend = notes.withColumn("annotation", F.col("char")).groupBy(*on).agg(F.min("note").alias("note"))
    renamed = legend.select(*[F.col(k).alias(f"legend_{k}") for k in on], "note")
    match = [counts[k].eqNullSafe(renamed[f"legend_{k}"]) for k in on]
    return counts.join(renamed, match, "left").select(*counts.columns, "note")
