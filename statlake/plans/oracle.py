"""DuckDB SQL twins of the registered queries (same column names)."""

from __future__ import annotations

from statlake.operators.search import TEXT_COLUMNS
from statlake.plans import testdata as td
from statlake.plans import collection, overlays, tidygeo, trees
from statlake.plans.manytables import ORACLE as MANY_TABLE_ORACLE
from statlake.plans.reference import PREFECTURES

TIDY = f"({td.tidy_cube_sql()})"
OBS = f"({td.CUBE_OBS_SQL})"
PREFS_SQL = td._values_sql([(c, e, j, r) for c, e, j, r in PREFECTURES],
                           ["code", "name_en", "name_ja", "region_en"])
WARDS = f"""(SELECT parent_code, parent_name, unnest(generate_series(ward_min, ward_max)) AS ward
  FROM {td.DESIGNATED_SQL})"""
CLEAN_SA = f"""(SELECT * FROM ({td.SMALL_AREAS_SQL}) WHERE KEY_CODE IS NOT NULL AND length(KEY_CODE) >= 9
  AND CITY_NAME IS NOT NULL AND (HCODE IS NULL OR HCODE <> '8154'))"""
MUNI_UNION = f"""(SELECT KEY_CODE, PREF_NAME, CITY_NAME, PREF || CITY AS area_code FROM {CLEAN_SA}
  UNION ALL
  SELECT k.KEY_CODE, k.PREF_NAME, w.parent_name AS CITY_NAME, w.parent_code AS area_code
  FROM {CLEAN_SA} k JOIN {WARDS} w ON TRY_CAST(k.PREF || k.CITY AS INTEGER) = w.ward)"""
MUNI_BND = f"""(SELECT area_code, arg_min(PREF_NAME, KEY_CODE) AS PREF_NAME,
  arg_min(CITY_NAME, KEY_CODE) AS CITY_NAME, CAST(count(*) AS DOUBLE) AS area
  FROM {MUNI_UNION} GROUP BY area_code)"""
CUST = f"({td.CUSTOMER_MUNI_SQL})"
FIRST_PAGES_PLAN = f"""(SELECT stats_data_id, "offset",
  least(CAST({td.FIRST_PAGE_SIZE} AS BIGINT), target_last - "offset" + 1) AS size
FROM (SELECT stats_data_id, total_number AS target_last,
        unnest(generate_series(to_number + 1, total_number, {td.FIRST_PAGE_SIZE})) AS "offset"
      FROM ({td.FIRST_PAGES_SQL})
      WHERE next_key IS NOT NULL AND to_number IS NOT NULL AND to_number < total_number))"""
GAPS = f"""(SELECT p.* FROM {FIRST_PAGES_PLAN} p WHERE NOT EXISTS (
  SELECT 1 FROM ({td.MANIFEST_SQL}) m WHERE m.stats_data_id = p.stats_data_id AND m."offset" = p."offset"))"""
CATALOG = f"({td.CATALOG_SQL})"


def _kw(term: str) -> str:
    parts = [f"coalesce(contains(lower({c}), '{term.lower()}'), false)" for c in TEXT_COLUMNS]
    return "(" + " OR ".join(parts) + ")"


FRIENDLY = """id, STAT_NAME AS stat_name, STATISTICS_NAME AS statistics_name, TITLE AS title,
  GOV_ORG AS gov_org, SURVEY_DATE AS survey_date, CYCLE AS cycle, UPDATED_DATE AS updated_date,
  STAT_NAME_code, GOV_ORG_code, TITLE_no"""

_L = [e for _, e, _ in td.CAT01_CODES]
_PREF_CODES = ", ".join(f"'{p[0]}'" for p in PREFECTURES)

_HIER = f"""WITH RECURSIVE cl AS ({td.HIERARCHY_CLASSES_SQL}),
walk(code, ancestor, depth) AS (
  SELECT code, parent, 1 FROM cl WHERE parent IS NOT NULL
  UNION ALL
  SELECT w.code, c.parent, w.depth + 1 FROM walk w JOIN cl c ON c.code = w.ancestor
  WHERE c.parent IS NOT NULL)
SELECT code, ancestor, depth FROM walk"""

_CONTRACT_RULES = [
    ("stats_data_id_empty", "stats_data_id IS NULL OR stats_data_id = ''"),
    ("stats_data_id_not_digits", "stats_data_id <> '' AND NOT regexp_matches(stats_data_id, '^[0-9]+$')"),
    ("lang_invalid", "lang IS NOT NULL AND upper(lang) NOT IN ('E', 'J')"),
    ("limit_not_count", "\"limit\" IS NOT NULL AND NOT regexp_matches(\"limit\", '^[0-9]+$')"),
    ("start_position_not_count", "start_position IS NOT NULL AND NOT regexp_matches(start_position, '^[0-9]+$')"),
    ("start_position_zero", "regexp_matches(start_position, '^0+$')"),
    ("stats_code_invalid", "stats_code IS NOT NULL AND NOT regexp_matches(stats_code, '^[0-9]{5}([0-9]{3})?$')"),
]
_CONTRACT = f"""SELECT o_orderkey,
  concat_ws(',', {', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _CONTRACT_RULES)}) AS violations,
  {' + '.join(f"(CASE WHEN {c} THEN 1 ELSE 0 END)" for _, c in _CONTRACT_RULES)} AS n_violations
FROM ({td.ORDER_REQUESTS_SQL})"""

_LANG_CHOICE = f"""WITH s AS ({td.STATUS_SQL}),
p AS (SELECT CAST(e.user_id AS VARCHAR) AS stats_data_id,
        CASE WHEN e.event_type IN ('view', 'click', 'error') THEN 'E' ELSE 'J' END AS lang,
        s.ok, s.error_class
      FROM s JOIN events e ON e.event_id = s.event_id),
a AS (SELECT stats_data_id,
        bool_or(lang = 'E' AND ok) AS pref_ok, bool_or(lang = 'J' AND ok) AS fb_ok,
        bool_or(lang = 'E' AND NOT ok AND error_class NOT IN ('no_data', 'invalid_param')) AS pref_hard,
        min(CASE WHEN lang = 'E' AND NOT ok THEN error_class END) AS pref_error
      FROM p GROUP BY stats_data_id)
SELECT stats_data_id,
  CASE WHEN coalesce(pref_ok, false) THEN 'E' WHEN coalesce(pref_hard, false) THEN NULL
       WHEN coalesce(fb_ok, false) THEN 'J' END AS lang_used,
  CASE WHEN coalesce(pref_ok, false) THEN 'preferred' WHEN coalesce(pref_hard, false) THEN 'blocked: ' || pref_error
       WHEN coalesce(fb_ok, false) THEN 'fallback' ELSE 'unavailable' END AS reason
FROM a"""

_MUNI_KEYED = f"""(SELECT KEY_CODE, PREF_NAME, CITY_NAME, PREF || CITY AS area_code FROM {CLEAN_SA})"""
_WARD_ROWS = f"""(SELECT k.KEY_CODE, k.PREF_NAME, w.parent_name AS CITY_NAME, w.parent_code AS area_code
  FROM {_MUNI_KEYED} k JOIN {WARDS} w ON TRY_CAST(k.area_code AS INTEGER) = w.ward)"""
_CITY_MODE = f"""SELECT area_code, arg_min(PREF_NAME, KEY_CODE) AS PREF_NAME, arg_min(CITY_NAME, KEY_CODE) AS CITY_NAME,
  CAST(count(*) AS DOUBLE) AS area
FROM (SELECT * FROM {_MUNI_KEYED} WHERE KEY_CODE NOT IN (SELECT KEY_CODE FROM {_WARD_ROWS})
      UNION ALL SELECT * FROM {_WARD_ROWS})
GROUP BY area_code"""

_EV_LANG = """(SELECT event_id, CAST(user_id AS VARCHAR) AS stats_data_id,
  CASE WHEN event_type = 'purchase' THEN 'E' ELSE 'J' END AS lang FROM events)"""

_CLASS_PAGES = f"""SELECT DISTINCT * FROM (
  SELECT '{td.EVENTS_ID}' AS stats_data_id, 'J' AS lang, 'cat01' AS axis, 'イベント種別' AS axis_name,
    1 AS axis_pos, event_type AS code, upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS name,
    '1' AS level, CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS parent FROM events
  UNION ALL
  SELECT '{td.EVENTS_ID}', 'J', 'area', '地域', 2, lpad(CAST(user_id AS VARCHAR), 5, '0'),
    'user ' || lpad(CAST(user_id AS VARCHAR), 5, '0'), '1', NULL, NULL FROM events
  UNION ALL
  SELECT '{td.EVENTS_ID}', 'J', 'time', '時間軸', 3, strftime(ts, '%Y%m%d') || '00',
    strftime(ts, '%Y%m%d'), '1', NULL, NULL FROM events)"""

_PAGE_COUNTERS = f"""WITH p AS (
  SELECT CAST(floor(event_id / {td.PAGE_SIZE}) AS BIGINT) AS page_no, count(*) AS c FROM events GROUP BY 1),
t AS (SELECT count(*) AS n FROM events)
SELECT '{td.EVENTS_ID}' AS stats_data_id, 'J' AS lang, page_no * {td.PAGE_SIZE} + 1 AS page_offset,
  '0' AS status_raw, t.n AS total_number, page_no * {td.PAGE_SIZE} + 1 AS from_number,
  page_no * {td.PAGE_SIZE} + c AS to_number,
  CASE WHEN page_no * {td.PAGE_SIZE} + c < t.n THEN page_no * {td.PAGE_SIZE} + c + 1 END AS next_key
FROM p, t"""

ORACLE: dict[str, str] = {
    "tidy_decode": td.tidy_cube_sql(),
    "cube_pages_tidy": td.tidy_cube_sql(),
    "coded_only": f"SELECT area, time, cat01, cat02, unit, raw_value AS value FROM {OBS}",
    "tidy_codes_only": f"""SELECT stats_data_id, area, time, cat01, cat02, unit,
  {td.value_sql('raw_value')} AS value, {td.annotation_sql('raw_value')} AS annotation FROM {OBS}""",
    "filter_codes": f"""SELECT * FROM {TIDY}
  WHERE area_code IN ('01000', '02000', '03000', '99000') AND cat01_code IN ('A', 'R')""",
    "time_window": f"SELECT * FROM {TIDY} WHERE time_code BETWEEN '1996000000' AND '1998000000'",
    "limit_offset": f"""SELECT area_code, time_code, cat01_code, cat02_code, value, annotation,
  page_offset, pos, l_partkey, l_suppkey, l_extendedprice
FROM ({td.tidy_cube_sql(", o.l_orderkey AS page_offset, o.l_linenumber AS pos, o.l_partkey, "
                        "o.l_suppkey, o.l_extendedprice, o.l_shipdate")})
ORDER BY page_offset, pos, l_partkey, l_suppkey, l_extendedprice, l_shipdate LIMIT 1000 OFFSET 100""",
    "time_years": f"""SELECT TRY_CAST(substr(time_code, 1, 4) AS INTEGER) AS year, count(*) AS n,
  count(annotation) AS n_annotated FROM {TIDY} GROUP BY 1""",
    "pivot_wide": f"""SELECT area_code, time_code, cat02_code,
  {', '.join(f'sum(value) FILTER (WHERE cat01 = {td._lit(v)}) AS "{v}"' for v in _L)}
FROM {TIDY} GROUP BY area_code, time_code, cat02_code""",
    "pivot_default": f"""SELECT area_code, time_code, cat02_code,
  {', '.join(f'sum(value) FILTER (WHERE cat01 = {td._lit(v)}) AS "{v}"' for v in _L)}
FROM {TIDY} GROUP BY area_code, time_code, cat02_code""",
    "pivot_sparse": """SELECT l_partkey, CAST(count(*) AS INTEGER) AS n_cells, CAST(max(v) AS BIGINT) AS largest, CAST(sum(v) AS BIGINT) AS total, min(name) AS first_label
FROM (SELECT l_partkey, CAST(l_suppkey AS VARCHAR) || ' ' || strftime(l_shipdate, '%Y-%m-%d') AS name, sum(CAST(l_quantity AS BIGINT)) AS v
  FROM lineitem GROUP BY 1, 2) GROUP BY l_partkey""",
    "pivot_duplicates_count": f"""SELECT area, area_code, time, time_code, cat02, cat02_code, stats_data_id, unit,
  {', '.join(f'count(*) FILTER (WHERE cat01 = {td._lit(v)}) AS "{v}"' for v in _L)}
FROM {TIDY} GROUP BY area, area_code, time, time_code, cat02, cat02_code, stats_data_id, unit""",
    "annotation_counts": f"""SELECT t.stats_data_id, t.annotation, count(*) AS n, n.note FROM {TIDY} t
  LEFT JOIN {td.CUBE_NOTES_SQL} n ON n.char = t.annotation
  WHERE t.annotation IS NOT NULL GROUP BY t.stats_data_id, t.annotation, n.note""",
    "prefecture_join": f"""SELECT t.area_code, p.code, p.name_en, p.name_ja, p.region_en,
  count(*) AS n, sum(t.value) AS total
FROM {TIDY} t LEFT JOIN {PREFS_SQL} p ON p.code || '000' = t.area_code
GROUP BY t.area_code, p.code, p.name_en, p.name_ja, p.region_en""",
    "value_pages": td.event_values_sql(),
    "class_pages": _CLASS_PAGES,
    "note_pages": f"""SELECT DISTINCT '{td.EVENTS_ID}' AS stats_data_id, 'J' AS lang, char, note FROM (
  SELECT '***' AS char, '秘匿' AS note FROM events
  UNION ALL
  SELECT min(lpad(CAST(user_id AS VARCHAR), 5, '0')), 'first area of a page' FROM events GROUP BY floor(event_id / {td.PAGE_SIZE}))""",
    "page_counters": _PAGE_COUNTERS,
    "pages_tidy": f"""SELECT 'user ' || area AS area, area AS area_code, substr(time, 1, 8) AS time, time AS time_code,
  upper(substr(cat01, 1, 1)) || substr(cat01, 2) AS cat01, cat01 AS cat01_code, tab, stats_data_id, unit, value, annotation
FROM ({td.event_values_sql()})""",
    "page_rows_window": f"""SELECT * FROM ({td.event_values_sql()}) WHERE page_offset + pos >= 1200
ORDER BY page_offset, pos LIMIT 500""",
    "incomplete_tables": f"""SELECT * FROM ({td.FIRST_PAGES_SQL})
WHERE next_key IS NULL AND to_number < total_number""",
    "page_plan": f"SELECT * FROM {FIRST_PAGES_PLAN}",
    "page_gaps": f"SELECT * FROM {GAPS}",
    "page_batches": f"""SELECT *, CAST(floor((row_number() OVER (PARTITION BY stats_data_id ORDER BY "offset") - 1) / 5)
  AS INTEGER) AS batch_id FROM {GAPS}""",
    "stream_ingest": td.event_values_sql(),
    "catalog_flatten_long": "\nUNION ALL\n".join(
        f"SELECT id AS table_id, '{c}' AS path, {c} AS value FROM {CATALOG}" for c in td.CATALOG_COLUMNS),
    "catalog_search": f"""SELECT {FRIENDLY} FROM {CATALOG}
WHERE ({_kw('hot')} OR {_kw('plate')})
  AND substr(regexp_replace(SURVEY_DATE, '[^0-9]', '', 'g'), 1, 6) BETWEEN '198001' AND '199512'
  AND substr(regexp_replace(UPDATED_DATE, '[^0-9]', '', 'g'), 1, 8) BETWEEN '20210100' AND '20220699'""",
    "search_default_limit": f"""SELECT {FRIENDLY} FROM {CATALOG}
WHERE {_kw('ring')} AND GOV_ORG_code = '00017' ORDER BY id LIMIT 100""",
    "file_catalog_long": td.FILE_CATALOG_LONG_SQL,
    "props_flatten": """SELECT event_id AS row_id, j.key AS path, j.value ->> '$' AS value
FROM events, json_each(props) AS j""",
    "status_classes": td.STATUS_SQL,
    "contract_violations": _CONTRACT,
    "prefer_language": f"""SELECT event_id, stats_data_id, lang AS lang_used FROM {_EV_LANG} e WHERE lang = 'E'
UNION ALL
SELECT event_id, stats_data_id, lang FROM {_EV_LANG} j WHERE lang = 'J'
  AND NOT EXISTS (SELECT 1 FROM {_EV_LANG} x WHERE x.lang = 'E' AND x.stats_data_id = j.stats_data_id)""",
    "language_choice": _LANG_CHOICE,
    "fresh_metadata": f"""SELECT stats_data_id, lang, event_id,
  ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 259200 SECOND AS fresh
FROM (SELECT CAST(user_id AS VARCHAR) AS stats_data_id,
        CASE WHEN event_type IN ('view', 'click') THEN 'E' ELSE 'J' END AS lang, ts, event_id FROM events)
QUALIFY row_number() OVER (PARTITION BY stats_data_id, lang ORDER BY ts DESC, event_id DESC) = 1""",
    "boundary_keys": f"""SELECT KEY_CODE, substr(PREF, 1, 2) || '000' AS pref_code, PREF || CITY AS muni_code,
  KEY_CODE AS small_area_code FROM {CLEAN_SA}""",
    "dissolve_area": f"SELECT * FROM {MUNI_BND}",
    "dissolve_city_mode": _CITY_MODE,
    "dissolve_small_area": f"""SELECT KEY_CODE AS area_code, arg_min(PREF_NAME, KEY_CODE) AS PREF_NAME,
  arg_min(CITY_NAME, KEY_CODE) AS CITY_NAME, arg_min(S_NAME, KEY_CODE) AS S_NAME, CAST(count(*) AS DOUBLE) AS area
FROM {CLEAN_SA} GROUP BY KEY_CODE""",
    "dissolve_rings": f"""SELECT substr(PREF, 1, 2) || '000' AS area_code, CAST(count(*) AS DOUBLE) AS area,
  CAST(count(*) AS DOUBLE) AS polygon_area FROM {CLEAN_SA} GROUP BY 1""",
    "geometry_join": f"""SELECT d.c_custkey, d.area_code, b.area_code IS NOT NULL AS has_geometry, b.area
FROM {CUST} d LEFT JOIN {MUNI_BND} b ON b.area_code = d.area_code""",
    "unmatched_codes": f"""SELECT DISTINCT area_code FROM {CUST} d WHERE area_code IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {MUNI_BND} b WHERE b.area_code = d.area_code)""",
    "range_rollup": f"""SELECT area_code, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM {CUST} GROUP BY area_code
UNION ALL
SELECT w.parent_code AS area_code, count(*) AS n,
  CAST(sum(CAST(round(d.value * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM {CUST} d JOIN {WARDS} w ON TRY_CAST(d.area_code AS INTEGER) = w.ward GROUP BY w.parent_code""",
    "prefecture_prefixes": f"""SELECT DISTINCT substr(area_code, 1, 2) AS pref,
  substr(area_code, 1, 2) IN ({_PREF_CODES}) AS valid FROM {CUST} WHERE area_code IS NOT NULL""",
    "area_levels": f"""SELECT 'cube' AS source, CASE WHEN coalesce(bool_and(ends_with(area, '000')), false)
  THEN 'prefecture' ELSE 'municipality' END AS level FROM {OBS}
UNION ALL
SELECT 'customers', CASE WHEN coalesce(bool_and(ends_with(area_code, '000')), false)
  THEN 'prefecture' ELSE 'municipality' END FROM {CUST}""",
    "axis_hierarchy": _HIER,
}
ORACLE |= MANY_TABLE_ORACLE
ORACLE |= collection.oracle(ORACLE) | overlays.ORACLE | tidygeo.oracle(CUST, ORACLE['dissolve_city_mode']) | trees.oracle(CATALOG, FRIENDLY, _kw)
ORACLE["fallback_blocked"] = f"""SELECT CAST(e.user_id AS VARCHAR) AS stats_data_id, c.lang_used AS lang, e.event_type AS cat01, e.event_id
FROM events e JOIN ({ORACLE['language_choice']}) c ON c.stats_data_id = CAST(e.user_id AS VARCHAR)
WHERE c.lang_used = CASE WHEN e.event_type IN ('view', 'click', 'error') THEN 'E' ELSE 'J' END"""
ORACLE["ingest_errors"] = f"""SELECT reason, count(DISTINCT CASE WHEN is_json THEN event_id ELSE -1 END) AS n
FROM (SELECT *, CASE WHEN status = 0 THEN 'no_page_key' ELSE error_class END AS reason FROM ({td.STATUS_SQL})) GROUP BY reason"""
