"""Registered queries: each runs one reference operator (or a chain of
them) over the test tables shaped as a statistics lake, next to the DuckDB
SQL that must give the same rows.

Every query reads whole tables; limits appear only where the operator *is*
a limit (``limit_offset``, ``search_default_limit``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.values import split_value_annotation, year_of_time_code
from statlake.operators import geo
from statlake.operators.hierarchy import axis_hierarchy
from statlake.operators.paging import incomplete_tables, missing_pages, page_plan, split_batches, take_rows
from statlake.operators.pivot import pivot_map, pivot_wide
from statlake.operators.quality import (
    contract_violations,
    fresh_metadata,
    language_choice,
    prefer_language,
    response_status,
)
from statlake.operators.search import reorder_search_columns, search_catalog, search_tables
from statlake.plans import testdata as td
from statlake.plans.lake import landed_cube, landed_derived
from statlake.plans.collection import QUERIES as COLLECTION_QUERIES
from statlake.plans.manytables import QUERIES as MANY_TABLE_QUERIES
from statlake.plans.overlays import QUERIES as OVERLAY_QUERIES
from statlake.plans.reference import prefectures
from statlake.plans.tidy import annotation_counts, coded, tidy
from statlake.plans.tidygeo import QUERIES as TIDY_GEOMETRY_QUERIES
from statlake.plans.trees import QUERIES as TREE_QUERIES
from statlake.sources.flatten import flatten_json, flatten_wide
from statlake.sources.responses import catalog_records, class_rows, note_rows, page_info, value_rows

CUBE_AXES = ["area", "time", "cat01", "cat02"]
CAT01_LABELS = [e for _, e, _ in td.CAT01_CODES]
ORDER_KEY = ["page_offset", "pos", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


def _tidy_cube(spark, sf, **kw):
    lake = landed_cube(spark, sf)
    obs = lake["observations"]
    if not kw.get("keep_lineage"):
        obs = obs.drop(*ORDER_KEY[2:])
    return tidy(obs, lake["classes"], lake["notes"],
                stats_data_id=td.CUBE_ID, lang="E", **kw)


# ---------------------------------------------------------------------------
# Cube: decode, coded paths, filters, paging
# ---------------------------------------------------------------------------

def tidy_decode(spark: SparkSession, sf: str) -> DataFrame:
    return _tidy_cube(spark, sf).data


def cube_pages_tidy(spark: SparkSession, sf: str) -> DataFrame:
    """Parse + decode at full cube size: the cube is landed as JSON data
    pages (once), then one job parses every page and decodes every axis."""
    lake = landed_cube(spark, sf)
    pages = landed_derived(spark, sf, "cube-pages",
                           lambda s, d: td.cube_pages(landed_cube(s, d)["observations"]))
    obs = value_rows(pages)
    return tidy(obs, lake["classes"], lake["notes"], stats_data_id=td.CUBE_ID, lang="E").data


def coded_only(spark: SparkSession, sf: str) -> DataFrame:
    obs = landed_cube(spark, sf)["observations"]
    return coded(obs, stats_data_id=td.CUBE_ID, axes=CUBE_AXES)


def tidy_codes_only(spark: SparkSession, sf: str) -> DataFrame:
    return _tidy_cube(spark, sf, decode_labels=False, axes=CUBE_AXES).data


def filter_codes(spark: SparkSession, sf: str) -> DataFrame:
    return _tidy_cube(spark, sf, codes={"area": ["01000", "02000", "03000", "99000"],
                                        "cat01": ["A", "R"]}).data


def time_window(spark: SparkSession, sf: str) -> DataFrame:
    return _tidy_cube(spark, sf, time_from="1996000000", time_to="1998000000").data


def limit_offset(spark: SparkSession, sf: str) -> DataFrame:
    d = _tidy_cube(spark, sf, limit=1000, start_position=101,
                   order_by=ORDER_KEY, keep_lineage=True, pulls=[]).data
    return d.select("area_code", "time_code", "cat01_code", "cat02_code", "value", "annotation",
                    "page_offset", "pos", "l_partkey", "l_suppkey", "l_extendedprice")


def time_years(spark: SparkSession, sf: str) -> DataFrame:
    d = _tidy_cube(spark, sf).data
    return d.groupBy(year_of_time_code("time_code").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("annotation").alias("n_annotated"))


def pivot_wide_sum(spark: SparkSession, sf: str) -> DataFrame:
    d = _tidy_cube(spark, sf).data
    return pivot_wide(d, "cat01", "value", id_cols=["area_code", "time_code", "cat02_code"],
                      values=CAT01_LABELS, duplicates="sum")


def pivot_duplicates_count(spark: SparkSession, sf: str) -> DataFrame:
    d = _tidy_cube(spark, sf).data
    return pivot_wide(d, "cat01", values=CAT01_LABELS, duplicates="count")


def pivot_default(spark: SparkSession, sf: str) -> DataFrame:
    """Labels found in the data, ids by default, several values in a cell an error."""
    d = _tidy_cube(spark, sf).data.groupBy("area_code", "time_code", "cat02_code", "cat01").agg(F.sum("value").alias("value"))
    return pivot_wide(d, "cat01")


def pivot_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """One sparse row a part, a cell for each of its suppliers and ship dates."""
    li = td.table(spark, sf, "lineitem")
    label = F.concat_ws(" ", F.col("l_suppkey").cast("string"), F.date_format("l_shipdate", "yyyy-MM-dd"))
    rows = li.select("l_partkey", label.alias("name"), F.col("l_quantity").cast("long").alias("value"))
    wide = pivot_map(rows, "name", duplicates="sum")
    largest = F.aggregate(F.map_values("cells"), F.lit(0).cast("long"), lambda a, v: F.greatest(a, v))
    total = F.aggregate(F.map_values("cells"), F.lit(0).cast("long"), lambda a, v: a + v)
    return wide.select("l_partkey", F.size("cells").alias("n_cells"), largest.alias("largest"), total.alias("total"), F.array_min(F.map_keys("cells")).alias("first_label"))


def annotation_report(spark: SparkSession, sf: str) -> DataFrame:
    r = _tidy_cube(spark, sf)
    return annotation_counts(r.data, r.notes)


def prefecture_join(spark: SparkSession, sf: str) -> DataFrame:
    d = _tidy_cube(spark, sf).data
    j = d.join(F.broadcast(prefectures(spark)), "area_code", "left")
    return j.groupBy("area_code", "code", "name_en", "name_ja", "region_en").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


# ---------------------------------------------------------------------------
# Landed pages
# ---------------------------------------------------------------------------

def _event_pages(spark, sf):
    """Data-page bodies derived from events, landed once per session."""
    return landed_derived(spark, sf, "event-pages", td.event_pages)


PAGE_COLS = ["stats_data_id", "page_offset", "pos", "tab", "cat01", "area", "time", "unit", "value"]


def value_pages(spark: SparkSession, sf: str) -> DataFrame:
    rows = value_rows(_event_pages(spark, sf))
    return split_value_annotation(rows.select(*PAGE_COLS))


def class_pages(spark: SparkSession, sf: str) -> DataFrame:
    cl = class_rows(_event_pages(spark, sf))
    return cl.select("stats_data_id", "lang", "axis", "axis_name", "axis_pos", "code", "name",
                     "level", "unit", "parent").distinct()


def note_pages(spark: SparkSession, sf: str) -> DataFrame:
    return note_rows(_event_pages(spark, sf))


def page_counters(spark: SparkSession, sf: str) -> DataFrame:
    info = page_info(_event_pages(spark, sf))
    return info.select("stats_data_id", "lang", "page_offset", "status_raw", "total_number",
                       "from_number", "to_number", "next_key")


def pages_tidy(spark: SparkSession, sf: str) -> DataFrame:
    """The whole path from landed JSON: land the pages (observations, code
    lists, notes, manifest) as a parquet lake, read it back and decode with
    the code lists the pages carried.  ``tab`` has no code list, so it stays
    a raw code column."""
    from statlake.plans.lake import land_responses, read_lake
    from statlake.session import scratch_path

    base = scratch_path(spark, "pages-lake")
    land_responses(_event_pages(spark, sf), base)
    lake = read_lake(spark, base)
    return tidy(lake["observations"], lake["classes"], lake["notes"], stats_data_id=td.EVENTS_ID,
                lang="J", axes=["tab", "cat01", "area", "time"]).data


def page_rows_window(spark: SparkSession, sf: str) -> DataFrame:
    """Start position + limit on landed pages, rows numbered by ranges of their order."""
    rows = value_rows(_event_pages(spark, sf)).select(*PAGE_COLS, "lang", "query_fingerprint")
    return split_value_annotation(take_rows(rows, limit=500, start_position=1200).select(*PAGE_COLS))


def incomplete_first_pages(spark: SparkSession, sf: str) -> DataFrame:
    return incomplete_tables(td.order_first_pages(spark, sf))


def page_plan_query(spark: SparkSession, sf: str) -> DataFrame:
    return page_plan(td.order_first_pages(spark, sf), page_size=td.FIRST_PAGE_SIZE,
                     keys=["stats_data_id"])


def page_gaps(spark: SparkSession, sf: str) -> DataFrame:
    plan = page_plan_query(spark, sf)
    return missing_pages(plan, td.landed_manifest(spark, sf), keys=["stats_data_id"])


def page_batches(spark: SparkSession, sf: str) -> DataFrame:
    return split_batches(page_gaps(spark, sf), 5, keys=["stats_data_id"])


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    from statlake.session import scratch_path
    from statlake.streaming.ingest import land_pages, read_observations, start_ingest

    base = scratch_path(spark, "stream-ingest")
    landing, target, ckpt = f"{base}/landing", f"{base}/target", f"{base}/checkpoint"
    land_pages(_event_pages(spark, sf), landing)
    q = start_ingest(spark, landing, target, ckpt, available_now=True)
    q.awaitTermination()
    rows = read_observations(spark, target)
    return split_value_annotation(rows.select(*PAGE_COLS))


# ---------------------------------------------------------------------------
# Catalogue
# ---------------------------------------------------------------------------

def _catalog_long(spark, sf):
    rec = catalog_records(td.catalog_pages(spark, sf))
    rec = rec.select(F.get_json_object("record", "$['@id']").alias("table_id"), "record")
    return flatten_json(rec, "record", id_col="table_id", max_depth=4)


def catalog_flatten_long(spark: SparkSession, sf: str) -> DataFrame:
    return _catalog_long(spark, sf).withColumnRenamed("row_id", "table_id")


def _catalog_wide(spark, sf):
    return flatten_wide(_catalog_long(spark, sf), td.CATALOG_COLUMNS).drop("row_id")


def catalog_search(spark: SparkSession, sf: str) -> DataFrame:
    found = search_catalog(_catalog_wide(spark, sf), keyword="hot OR plate",
                           survey_years="198001-199512", updated_from="202101", updated_to="202206")
    return reorder_search_columns(found)


def search_default_limit(spark: SparkSession, sf: str) -> DataFrame:
    return search_tables(_catalog_wide(spark, sf), keyword="ring", gov_org="00017")


def file_catalog_long(spark: SparkSession, sf: str) -> DataFrame:
    rec = catalog_records(td.file_catalog_pages(spark, sf), kind="catalog")
    rec = rec.select(F.get_json_object("record", "$['@id']").alias("dataset_id"), "record")
    return flatten_json(rec, "record", id_col="dataset_id", max_depth=5).withColumnRenamed("row_id", "dataset_id")


def props_flatten(spark: SparkSession, sf: str) -> DataFrame:
    ev = td.table(spark, sf, "events").select("event_id", "props")
    return flatten_json(ev, "props", id_col="event_id")


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------

def status_classes(spark: SparkSession, sf: str) -> DataFrame:
    st = response_status(td.status_bodies(spark, sf))
    return st.select("event_id", "is_json", "status", "ok", "error_class", "error_msg")


def contract_report(spark: SparkSession, sf: str) -> DataFrame:
    v = contract_violations(td.order_requests(spark, sf))
    return v.select("o_orderkey", F.array_join("violations", ",").alias("violations"),
                    F.size("violations").alias("n_violations"))


def _event_lang(spark, sf):
    ev = td.table(spark, sf, "events")
    lang = F.when(F.col("event_type") == "purchase", F.lit("E")).otherwise(F.lit("J"))
    return ev.select("event_id", F.col("user_id").cast("string").alias("stats_data_id"), lang.alias("lang"))


def prefer_language_query(spark: SparkSession, sf: str) -> DataFrame:
    return prefer_language(_event_lang(spark, sf), keys=["stats_data_id"]).select("event_id", "stats_data_id", "lang_used")


def language_choice_query(spark: SparkSession, sf: str) -> DataFrame:
    st = response_status(td.status_bodies(spark, sf))
    ev = td.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    pages = st.join(ev, "event_id").select(
        F.col("user_id").cast("string").alias("stats_data_id"),
        F.when(F.col("event_type").isin("view", "click", "error"), F.lit("E")).otherwise(F.lit("J")).alias("lang"),
        "ok", "error_class")
    return language_choice(pages)


AS_OF = "2024-01-31 00:00:00"
TTL = 3 * 24 * 3600


def fresh_metadata_query(spark: SparkSession, sf: str) -> DataFrame:
    ev = td.table(spark, sf, "events")
    snaps = ev.select(
        F.col("user_id").cast("string").alias("stats_data_id"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("E")).otherwise(F.lit("J")).alias("lang"),
        F.col("ts").alias("fetched_at"), "event_id")
    out = fresh_metadata(snaps, AS_OF, TTL, keys=["stats_data_id", "lang"], tiebreak=["event_id"])
    return out.select("stats_data_id", "lang", "event_id", "fresh")


# ---------------------------------------------------------------------------
# Geography
# ---------------------------------------------------------------------------

def _small_areas(spark, sf):
    return td.supplier_small_areas(spark, sf)


def boundary_keys(spark: SparkSession, sf: str) -> DataFrame:
    sa = geo.clean_boundary_rows(_small_areas(spark, sf))
    return sa.select("KEY_CODE", geo.boundary_key("prefecture").alias("pref_code"),
                     geo.boundary_key("municipality").alias("muni_code"),
                     geo.boundary_key("small_area").alias("small_area_code"))


def dissolve_area(spark: SparkSession, sf: str) -> DataFrame:
    b = geo.boundaries(_small_areas(spark, sf), "municipality", "both", with_geometry=False)
    return b.select("area_code", "PREF_NAME", "CITY_NAME", "area")


def dissolve_city_mode(spark: SparkSession, sf: str) -> DataFrame:
    b = geo.boundaries(_small_areas(spark, sf), "municipality", "city", with_geometry=False)
    return b.select("area_code", "PREF_NAME", "CITY_NAME", "area")


def dissolve_small_area(spark: SparkSession, sf: str) -> DataFrame:
    b = geo.boundaries(_small_areas(spark, sf), "small_area", with_geometry=False)
    return b.select("area_code", "PREF_NAME", "CITY_NAME", "S_NAME", "area")


def dissolve_rings(spark: SparkSession, sf: str) -> DataFrame:
    """Stitched geometry; its own area must equal the edge-sum area."""
    b = geo.boundaries(_small_areas(spark, sf), "prefecture", with_geometry=True)
    rings = F.flatten(F.col("polygons"))
    poly_area = F.aggregate(rings, F.lit(0.0), lambda acc, r: acc + geo.ring_area2(r) / 2)
    return b.select("area_code", "area", poly_area.alias("polygon_area"))


def geometry_join(spark: SparkSession, sf: str) -> DataFrame:
    """Level inferred from the codes (municipality), prefectures resolved
    from the data, designated-city parents added, every data row kept."""
    data = td.customer_municipalities(spark, sf)
    joined, _ = geo.attach_geometry(data, _small_areas(spark, sf), level="auto", designated="both")
    return joined.select("c_custkey", "area_code", F.col("polygons").isNotNull().alias("has_geometry"), "area")


def unmatched_codes(spark: SparkSession, sf: str) -> DataFrame:
    data = td.customer_municipalities(spark, sf)
    bnd = geo.boundaries(_small_areas(spark, sf), "municipality", "both", with_geometry=False)
    return geo.unmatched_codes(data, bnd)


def range_rollup(spark: SparkSession, sf: str) -> DataFrame:
    data = td.customer_municipalities(spark, sf)
    aggs = [F.count(F.lit(1)).alias("n"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("total_cents")]
    return geo.rollup_measure(data, aggs, mode="both")


def prefecture_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return geo.resolve_prefectures(td.customer_municipalities(spark, sf))


def area_levels(spark: SparkSession, sf: str) -> DataFrame:
    cube = landed_cube(spark, sf)["observations"].agg(geo.level_of("area").alias("level"))
    muni = td.customer_municipalities(spark, sf).agg(geo.level_of("area_code").alias("level"))
    return cube.select(F.lit("cube").alias("source"), "level").unionByName(
        muni.select(F.lit("customers").alias("source"), "level"))


def axis_hierarchy_query(spark: SparkSession, sf: str) -> DataFrame:
    return axis_hierarchy(td.customer_hierarchy_classes(spark, sf)).select("code", "ancestor", "depth")


def language_fallback_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every table in the language its page statuses allow: an error of
    the service in the first language is not hidden by the other."""
    ev = td.table(spark, sf, "events")
    lang = F.when(F.col("event_type").isin("view", "click", "error"), F.lit("E")).otherwise(F.lit("J"))
    obs = ev.select(F.col("user_id").cast("string").alias("stats_data_id"), lang.alias("lang"),
                    F.col("user_id").cast("string").alias("query_fingerprint"), F.col("event_id").alias("page_offset"),
                    F.lit(0).alias("pos"), F.col("event_type").alias("cat01"), F.lit(td.UNIT).alias("unit"),
                    F.col("event_id").cast("string").alias("value"))
    st = response_status(td.status_bodies(spark, sf)).join(ev.select("event_id", "user_id", "event_type"), "event_id")
    pages = st.select(F.col("user_id").cast("string").alias("stats_data_id"), lang.alias("lang"), "ok", "error_class")
    r = tidy(obs, lang="E", fallback_lang="J", pages=pages, decode_labels=False, axes=["cat01"], keep_lineage=True)
    return r.data.select("stats_data_id", "lang", "cat01", F.col("page_offset").alias("event_id"))


def ingest_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Stream pages of every status into the lake: what is left out is reported
    in the quarantine table, once for each different body."""
    from statlake.session import scratch_path
    from statlake.streaming.ingest import ingest_batch, read_quarantine

    base = scratch_path(spark, "ingest-errors")
    bodies = td.status_bodies(spark, sf).select("body")
    for _ in range(2):  # a replayed batch adds nothing
        ingest_batch(bodies, f"{base}/target", f"{base}/quarantine")
    return read_quarantine(spark, f"{base}/quarantine").groupBy("reason").agg(F.count("*").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tidy_decode": tidy_decode,
    "cube_pages_tidy": cube_pages_tidy,
    "coded_only": coded_only,
    "tidy_codes_only": tidy_codes_only,
    "filter_codes": filter_codes,
    "time_window": time_window,
    "limit_offset": limit_offset,
    "time_years": time_years,
    "pivot_wide": pivot_wide_sum,
    "pivot_duplicates_count": pivot_duplicates_count,
    "pivot_default": pivot_default,
    "pivot_sparse": pivot_sparse,
    "annotation_counts": annotation_report,
    "prefecture_join": prefecture_join,
    "value_pages": value_pages,
    "class_pages": class_pages,
    "note_pages": note_pages,
    "page_counters": page_counters,
    "pages_tidy": pages_tidy,
    "page_rows_window": page_rows_window,
    "incomplete_tables": incomplete_first_pages,
    "page_plan": page_plan_query,
    "page_gaps": page_gaps,
    "page_batches": page_batches,
    "stream_ingest": stream_ingest,
    "catalog_flatten_long": catalog_flatten_long,
    "catalog_search": catalog_search,
    "search_default_limit": search_default_limit,
    "file_catalog_long": file_catalog_long,
    "props_flatten": props_flatten,
    "status_classes": status_classes,
    "contract_violations": contract_report,
    "prefer_language": prefer_language_query,
    "language_choice": language_choice_query,
    "fresh_metadata": fresh_metadata_query,
    "boundary_keys": boundary_keys,
    "dissolve_area": dissolve_area,
    "dissolve_city_mode": dissolve_city_mode,
    "dissolve_small_area": dissolve_small_area,
    "dissolve_rings": dissolve_rings,
    "geometry_join": geometry_join,
    "unmatched_codes": unmatched_codes,
    "range_rollup": range_rollup,
    "prefecture_prefixes": prefecture_prefixes,
    "area_levels": area_levels,
    "axis_hierarchy": axis_hierarchy_query,
    "fallback_blocked": language_fallback_rows,
    "ingest_errors": ingest_errors,
    **MANY_TABLE_QUERIES,
    **COLLECTION_QUERIES,
    **OVERLAY_QUERIES,
    **TIDY_GEOMETRY_QUERIES,
    **TREE_QUERIES,
}
