"""Shape the driver's TPC-H-like test tables as a statistics lake.

Every builder here reads the given parquet tables, so the work grows with
the scale factor, and every builder has a DuckDB SQL twin (``*_SQL``) used
by the oracle.  The mapping:

* cube observations: lineitem -> orders -> customer;  area = customer
  nation as a prefecture-style code, time = order year, cat01/cat02 =
  return flag / line status, value = quantity with markers mixed in;
* code lists: nation/region for ``area`` (customers of one nation carry a
  code that is in no list, so some labels are null), years for ``time``, fixed lists for ``cat01``/``cat02``;
* landed data pages: events grouped into pages of ``PAGE_SIZE`` records;
* catalogue pages: part rows as table entries;
* request log: orders as data requests (for contract checks and paging);
* small areas: one unit square per supplier.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.frames import literal_frame
from statlake.operators.decode import sized_broadcast
from statlake.plans.reference import DESIGNATED_CITIES

CUBE_ID = "0003000001"
EVENTS_ID = "0003000002"
PAGE_SIZE = 999
UNIT = "件"

# Fixed values of the adapter (invented for the test tables).
CAT01_CODES = [("A", "Accepted", "受理"), ("N", "Not returned", "未返品"), ("R", "Returned", "返品")]
CAT02_CODES = [("F", "Filled", "完了"), ("O", "Open", "未完")]
EVENT_TYPES = [("view", "View", "閲覧"), ("click", "Click", "クリック"),
               ("purchase", "Purchase", "購入"), ("signup", "Sign-up", "登録"),
               ("error", "Error", "エラー")]
CUBE_NOTES = [("***", "秘匿 (suppressed)"), ("-", "該当数値なし (nil)"), ("x", "不詳 (unknown)")]
AXIS_NAMES = {
    "cat01": ("Return flag", "返品区分", 1),
    "cat02": ("Line status", "明細状態", 2),
    "area": ("Area", "地域", 3),
    "time": ("Time", "時間軸", 4),
}
YEARS = (1990, 2031)  # time code list covers [1990, 2031)
UNLISTED_NATION, UNLISTED_AREA = 24, "99000"  # its customers carry a code that no list has


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# Cube observations
# ---------------------------------------------------------------------------

def _cell(q):
    """Quantity -> raw cell text, with markers and edge cases mixed in."""
    return (
        F.when(q >= 49, F.lit("***"))
        .when(q == 1, F.lit("-"))
        .when(q == 2, F.lit(""))
        .when(q == 3, F.lit("   "))
        .when(q == 4, F.lit(None).cast("string"))
        .when(q == 5, F.lit("x"))
        .when(q == 6, F.lit(" 6e0 "))
        .when(q == 7, F.lit("+7."))
        .when(q == 8, F.lit("8d"))
        .otherwise(q.cast("string"))
    )


CELL_SQL = """CASE WHEN l_quantity >= 49 THEN '***' WHEN l_quantity = 1 THEN '-'
  WHEN l_quantity = 2 THEN '' WHEN l_quantity = 3 THEN '   ' WHEN l_quantity = 4 THEN NULL
  WHEN l_quantity = 5 THEN 'x' WHEN l_quantity = 6 THEN ' 6e0 ' WHEN l_quantity = 7 THEN '+7.'
  WHEN l_quantity = 8 THEN '8d' ELSE CAST(l_quantity AS VARCHAR) END"""


def cube_observations(spark: SparkSession, sf_dir: str, with_order_key: bool = False) -> DataFrame:
    """Coded observations of the cube (lake schema).

    orders is joined to customer first (the smaller join), then lineitem to
    that; the planner picks broadcast or sort-merge from real sizes.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    oc = od.join(cu, od["o_custkey"] == cu["c_custkey"])
    # lineitem and orders both grow with the data: the planner's sort-merge
    # join can spill, and AQE splits a skewed order key.
    j = li.join(oc, li["l_orderkey"] == oc["o_orderkey"])
    cols = [
        F.lit(CUBE_ID).alias("stats_data_id"),
        F.lit("E").alias("lang"),
        F.lit(CUBE_ID).alias("query_fingerprint"),
        F.col("l_orderkey").cast("bigint").alias("page_offset"),
        F.col("l_linenumber").cast("int").alias("pos"),
        F.when(F.col("c_nationkey") == UNLISTED_NATION, F.lit(UNLISTED_AREA))
        .otherwise(F.concat(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit("000"))).alias("area"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("000000")).alias("time"),
        F.col("l_returnflag").alias("cat01"),
        F.col("l_linestatus").alias("cat02"),
        F.lit(UNIT).alias("unit"),
        _cell(F.col("l_quantity")).alias("value"),
    ]
    if with_order_key:
        cols += [F.col(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")]
    return j.select(*cols)


CUBE_OBS_SQL = f"""SELECT '{CUBE_ID}' AS stats_data_id, 'E' AS lang,
  l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_shipdate,
  CASE WHEN c.c_nationkey = {UNLISTED_NATION} THEN '{UNLISTED_AREA}'
    ELSE lpad(CAST(c.c_nationkey + 1 AS VARCHAR), 2, '0') || '000' END AS area,
  CAST(year(o.o_orderdate) AS VARCHAR) || '000000' AS time,
  l.l_returnflag AS cat01, l.l_linestatus AS cat02, '{UNIT}' AS unit,
  {CELL_SQL} AS raw_value
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey"""


def cube_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long code lists of the cube, in both languages (three plan branches:
    fixed lists as literals, regions, nations)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    fixed = []
    for li, lang in ((0, "E"), (1, "J")):
        for axis, codes in (("cat01", CAT01_CODES), ("cat02", CAT02_CODES)):
            for c, e, j in codes:
                fixed.append((lang, axis, AXIS_NAMES[axis][li], AXIS_NAMES[axis][2], c, (e, j)[li], "1", None))
        fixed.append((lang, "area", AXIS_NAMES["area"][li], AXIS_NAMES["area"][2], "00000",
                      ("All areas", "全地域")[li], "1", None))
        for y in range(*YEARS):
            fixed.append((lang, "time", AXIS_NAMES["time"][li], AXIS_NAMES["time"][2], f"{y}000000",
                          (str(y), f"{y}年")[li], "1", None))
    lit = literal_frame(spark, fixed, "lang string, axis string, axis_name string, axis_pos int, "
                                     "code string, name string, level string, parent string")
    langs = F.explode(F.array(F.lit("E"), F.lit("J"))).alias("lang")
    area_name = F.when(F.col("lang") == "E", F.lit(AXIS_NAMES["area"][0])).otherwise(F.lit(AXIS_NAMES["area"][1]))

    def area_rows(df, code, name_e, name_j, level, parent):
        return df.select(langs, code.alias("code"), name_e.alias("name_e"), name_j.alias("name_j"),
                         parent.alias("parent")).select(
            "lang", F.lit("area").alias("axis"), area_name.alias("axis_name"),
            F.lit(AXIS_NAMES["area"][2]).alias("axis_pos"), "code",
            F.when(F.col("lang") == "E", F.col("name_e")).otherwise(F.col("name_j")).alias("name"),
            F.lit(level).alias("level"), "parent")

    regions = area_rows(
        region, F.concat(F.lit("9"), (F.col("r_regionkey") + 1).cast("string"), F.lit("000")),
        F.col("r_name"), F.concat(F.col("r_name"), F.lit("地方")), "2", F.lit("00000"))
    nations = area_rows(
        nation,
        F.concat(F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0"), F.lit("000")),
        F.col("n_name"), F.concat(F.col("n_name"), F.lit("国")), "3",
        F.concat(F.lit("9"), (F.col("n_regionkey") + 1).cast("string"), F.lit("000")))
    out = lit.unionByName(regions).unionByName(nations)
    return out.select(F.lit(CUBE_ID).alias("stats_data_id"), "lang", "axis", "axis_name",
                      F.col("axis_pos").cast("int").alias("axis_pos"), "code", "name", "level",
                      F.lit(None).cast("string").alias("unit"), "parent")


def _values_sql(rows, cols):
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


def _lit(v):
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def cube_classes_sql(lang: str = "E") -> str:
    """Code lists of one language as a SQL query with the lake columns."""
    li = 0 if lang == "E" else 1
    parts = []
    for axis, codes in (("cat01", CAT01_CODES), ("cat02", CAT02_CODES)):
        an, aj, pos = AXIS_NAMES[axis]
        vals = _values_sql([(c, e if lang == "E" else j) for c, e, j in codes], ["code", "name"])
        parts.append(
            f"SELECT '{CUBE_ID}' AS stats_data_id, '{lang}' AS lang, '{axis}' AS axis, "
            f"'{(an, aj)[li]}' AS axis_name, {pos} AS axis_pos, code, name, '1' AS level, "
            f"CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS parent FROM {vals}")
    an, aj, pos = AXIS_NAMES["area"]
    head = (f"SELECT '{CUBE_ID}' AS stats_data_id, '{lang}' AS lang, 'area' AS axis, "
            f"'{(an, aj)[li]}' AS axis_name, {pos} AS axis_pos, ")
    root_name = "All areas" if lang == "E" else "全地域"
    parts.append(head + f"'00000' AS code, '{root_name}' AS name, '1' AS level, "
                 "CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS parent")
    reg_name = "r_name" if lang == "E" else "r_name || '地方'"
    parts.append(head + f"'9' || CAST(r_regionkey + 1 AS VARCHAR) || '000' AS code, {reg_name} AS name, "
                 "'2' AS level, CAST(NULL AS VARCHAR) AS unit, '00000' AS parent FROM region")
    nat_name = "n_name" if lang == "E" else "n_name || '国'"
    parts.append(head + "lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || '000' AS code, "
                 f"{nat_name} AS name, '3' AS level, CAST(NULL AS VARCHAR) AS unit, "
                 "'9' || CAST(n_regionkey + 1 AS VARCHAR) || '000' AS parent "
                 "FROM nation")
    an, aj, pos = AXIS_NAMES["time"]
    yname = "CAST(range AS VARCHAR)" if lang == "E" else "CAST(range AS VARCHAR) || '年'"
    parts.append(
        f"SELECT '{CUBE_ID}' AS stats_data_id, '{lang}' AS lang, 'time' AS axis, "
        f"'{(an, aj)[li]}' AS axis_name, {pos} AS axis_pos, CAST(range AS VARCHAR) || '000000' AS code, "
        f"{yname} AS name, '1' AS level, CAST(NULL AS VARCHAR) AS unit, "
        f"CAST(NULL AS VARCHAR) AS parent FROM range({YEARS[0]}, {YEARS[1]})")
    return "\nUNION ALL\n".join(parts)


def cube_notes(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, [(CUBE_ID, "E", c, n) for c, n in CUBE_NOTES],
                         "stats_data_id string, lang string, char string, note string")


CUBE_NOTES_SQL = _values_sql([(c, n) for c, n in CUBE_NOTES], ["char", "note"])

NUM_RX = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def value_sql(raw: str) -> str:
    return (f"CASE WHEN regexp_matches({raw}, '{NUM_RX}') "
            f"THEN TRY_CAST(regexp_replace({raw}, '^\\s+|\\s+$', '', 'g') AS DOUBLE) END")


def annotation_sql(raw: str) -> str:
    return (f"CASE WHEN {raw} IS NOT NULL AND length({raw}) > 0 "
            f"AND NOT regexp_matches({raw}, '{NUM_RX}') THEN {raw} END")


def tidy_cube_sql(extra: str = "") -> str:
    """The decoded cube (English labels) as SQL."""
    return f"""WITH obs AS ({CUBE_OBS_SQL}), cl AS ({cube_classes_sql('E')})
SELECT a.name AS area, o.area AS area_code, t.name AS time, o.time AS time_code,
  c1.name AS cat01, o.cat01 AS cat01_code, c2.name AS cat02, o.cat02 AS cat02_code,
  o.stats_data_id, o.unit, {value_sql('o.raw_value')} AS value,
  {annotation_sql('o.raw_value')} AS annotation{extra}
FROM obs o
LEFT JOIN cl a ON a.axis = 'area' AND a.code = o.area AND a.stats_data_id = o.stats_data_id
LEFT JOIN cl t ON t.axis = 'time' AND t.code = o.time AND t.stats_data_id = o.stats_data_id
LEFT JOIN cl c1 ON c1.axis = 'cat01' AND c1.code = o.cat01 AND c1.stats_data_id = o.stats_data_id
LEFT JOIN cl c2 ON c2.axis = 'cat02' AND c2.code = o.cat02 AND c2.stats_data_id = o.stats_data_id"""


# ---------------------------------------------------------------------------
# Landed data pages (from events)
# ---------------------------------------------------------------------------

_PAGES_SQL = """
WITH ev AS (
  SELECT event_id, CAST(floor(event_id / __PAGE__) AS BIGINT) AS page_no,
         to_json(named_struct('@tab', '01', '@cat01', event_type,
                              '@area', lpad(CAST(user_id AS STRING), 5, '0'),
                              '@time', date_format(ts, 'yyyyMMdd') || '00',
                              '@unit', '__UNIT__', '$', CAST(value AS STRING))) AS rec,
         event_type, lpad(CAST(user_id AS STRING), 5, '0') AS area,
         date_format(ts, 'yyyyMMdd') || '00' AS time
  FROM __EVENTS__
),
pg AS (
  SELECT page_no,
         transform(array_sort(collect_list(named_struct('k', event_id, 'r', rec))), x -> x.r) AS recs,
         array_sort(collect_set(event_type)) AS types,
         array_sort(collect_set(area)) AS areas,
         array_sort(collect_set(time)) AS times, min(area) AS least_area
  FROM ev GROUP BY page_no
)
SELECT page_no,
  '{"GET_STATS_DATA":{"RESULT":{"STATUS":0,"ERROR_MSG":"正常に終了しました。"},' ||
  '"PARAMETER":{"LANG":"J","STATS_DATA_ID":"__SID__"},' ||
  '"STATISTICAL_DATA":{"RESULT_INF":{"TOTAL_NUMBER":' || CAST((SELECT count(*) FROM __EVENTS__) AS STRING) ||
  ',"FROM_NUMBER":' || CAST(page_no * __PAGE__ + 1 AS STRING) ||
  ',"TO_NUMBER":' || CAST(page_no * __PAGE__ + size(recs) AS STRING) ||
  CASE WHEN page_no * __PAGE__ + size(recs) < (SELECT count(*) FROM __EVENTS__)
       THEN ',"NEXT_KEY":' || CAST(page_no * __PAGE__ + size(recs) + 1 AS STRING) ELSE '' END ||
  '},"CLASS_INF":{"CLASS_OBJ":[' ||
  '{"@id":"cat01","@name":"イベント種別","CLASS":' ||
  CASE WHEN size(types) = 1 THEN types_json[0] ELSE '[' || array_join(types_json, ',') || ']' END || '},' ||
  '{"@id":"area","@name":"地域","CLASS":[' || array_join(areas_json, ',') || ']},' ||
  '{"@id":"time","@name":"時間軸","CLASS":[' || array_join(times_json, ',') || ']}]},' ||
  '"DATA_INF":{"NOTE":[{"@char":"***","$":"秘匿"},{"@char":"' || least_area || '","$":"first area of a page"}],"VALUE":' ||
  CASE WHEN size(recs) = 1 THEN recs[0] ELSE '[' || array_join(recs, ',') || ']' END ||
  '}}}}' AS body
FROM (
  SELECT page_no, recs,
    transform(types, x -> to_json(named_struct('@code', x, '@name', upper(substr(x, 1, 1)) || substr(x, 2), '@level', '1'))) AS types_json,
    transform(areas, x -> to_json(named_struct('@code', x, '@name', 'user ' || x, '@level', '1'))) AS areas_json,
    least_area, transform(times, x -> to_json(named_struct('@code', x, '@name', substr(x, 1, 8), '@level', '1'))) AS times_json,
    types
  FROM pg
) p
"""


def event_pages(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Landed data-page bodies built from events: ``(page_no, body)``.

    Pages group consecutive event ids, so a page holds at most
    ``page_size`` records whatever the data skew; single-record pages and
    single-code classes are written as lone objects, as the service does.
    """
    view = f"statlake_events_{uuid.uuid4().hex[:10]}"
    table(spark, sf_dir, "events").createOrReplaceTempView(view)
    sql = (_PAGES_SQL.replace("__PAGE__", str(int(page_size))).replace("__UNIT__", UNIT)
           .replace("__SID__", EVENTS_ID).replace("__EVENTS__", view))
    return spark.sql(sql)


def event_values_sql(page_size: int = PAGE_SIZE) -> str:
    """Flat rows the event pages must parse back to (value split)."""
    raw = "CAST(value AS VARCHAR)"
    return f"""SELECT '{EVENTS_ID}' AS stats_data_id,
  CAST(floor(event_id / {page_size}) AS BIGINT) * {page_size} + 1 AS page_offset,
  CAST(row_number() OVER (PARTITION BY floor(event_id / {page_size}) ORDER BY event_id) - 1 AS INTEGER) AS pos,
  '01' AS tab, event_type AS cat01, lpad(CAST(user_id AS VARCHAR), 5, '0') AS area,
  strftime(ts, '%Y%m%d') || '00' AS time, '{UNIT}' AS unit,
  {value_sql(raw)} AS value, {annotation_sql(raw)} AS annotation
FROM events"""


# ---------------------------------------------------------------------------
# Response status bodies (from events)
# ---------------------------------------------------------------------------

_STATUS_CASE = """CASE WHEN value < 1 THEN NULL WHEN value < 2 THEN 'nan'
  WHEN value >= 49 THEN '999' WHEN event_type = 'view' THEN '0' WHEN event_type = 'click' THEN '100'
  WHEN event_type = 'signup' THEN '201' WHEN event_type = 'purchase' THEN '302' ELSE '503' END"""


def status_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response body per event with every status shape: ok, the four
    error bands, 'other', a non-numeric status, a missing status and
    non-JSON (HTML) bodies; messages carry an appId to redact."""
    ev = table(spark, sf_dir, "events")
    status = F.expr(_STATUS_CASE)
    msg = F.concat(F.lit("エラー: https://api.example.org/rest/3.0/app/json/getStatsData?appId=KEY"),
                   F.col("user_id").cast("string"), F.lit("&statsDataId="), F.col("event_id").cast("string"))
    status_json = (
        F.when(status.isNull(), F.lit(""))
        .when(status == "nan", F.lit('"STATUS":"not-a-number",'))
        .otherwise(F.concat(F.lit('"STATUS":'), status, F.lit(",")))
    )
    json_body = F.concat(F.lit('{"GET_STATS_DATA":{"RESULT":{'), status_json,
                         F.lit('"ERROR_MSG":"'), msg, F.lit('"}}}'))
    html = (F.col("event_type") == "error") & (F.col("value") >= 45)
    body = F.when(html, F.lit("<html><body>Service Unavailable</body></html>")).otherwise(json_body)
    return ev.select("event_id", body.alias("body"))


STATUS_SQL = f"""WITH s AS (
  SELECT event_id, event_type, value,
    CASE WHEN event_type = 'error' AND value >= 45 THEN NULL ELSE TRY_CAST({_STATUS_CASE} AS INTEGER) END AS status,
    'エラー: https://api.example.org/rest/3.0/app/json/getStatsData?appId=KEY' || CAST(user_id AS VARCHAR)
      || '&statsDataId=' || CAST(event_id AS VARCHAR) AS msg
  FROM events)
SELECT event_id,
  NOT (event_type = 'error' AND value >= 45) AS is_json,
  status,
  coalesce(status = 0, false) AS ok,
  CASE WHEN status IS NULL THEN 'parse_error' WHEN status = 0 THEN NULL
       WHEN floor(status / 100) = 1 THEN 'invalid_param' WHEN floor(status / 100) = 2 THEN 'no_data'
       WHEN floor(status / 100) = 3 THEN 'auth' WHEN floor(status / 100) = 5 THEN 'server'
       ELSE 'other' END AS error_class,
  CASE WHEN status <> 0 THEN regexp_replace(msg, '(appId=)[^&\\s"]+', '\\1<hidden>', 'g') END AS error_msg
FROM s"""


# ---------------------------------------------------------------------------
# Catalogue pages (from part)
# ---------------------------------------------------------------------------

def _catalog_fields():
    gov = F.lpad(F.regexp_extract("p_brand", r"([0-9]+)", 1), 5, "0")
    size3 = F.lpad(F.col("p_size").cast("string"), 3, "0")
    return {
        "id": F.format_string("%010d", F.col("p_partkey")),
        "STAT_NAME": F.col("p_type"),
        "STAT_NAME_code": F.concat(gov, size3),
        "GOV_ORG": F.col("p_brand"),
        "GOV_ORG_code": gov,
        "STATISTICS_NAME": F.concat_ws(" ", "p_type", "p_name"),
        "TITLE": F.col("p_name"),
        "TITLE_no": size3,
        "CYCLE": F.when(F.col("p_size") <= 25, F.lit("月次")).otherwise(F.lit("年次")),
        "SURVEY_DATE": F.concat((F.col("p_size") + 1970).cast("string"),
                                F.lpad((F.col("p_partkey") % 12 + 1).cast("string"), 2, "0")),
        "UPDATED_DATE": F.date_format(
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("p_partkey") % 1500).cast("int")),
            "yyyy-MM-dd"),
    }


CATALOG_COLUMNS = ["id", "STAT_NAME", "STAT_NAME_code", "GOV_ORG", "GOV_ORG_code", "STATISTICS_NAME",
                   "TITLE", "TITLE_no", "CYCLE", "SURVEY_DATE", "UPDATED_DATE"]

CATALOG_SQL = """SELECT printf('%010d', p_partkey) AS id, p_type AS STAT_NAME,
  lpad(regexp_extract(p_brand, '([0-9]+)', 1), 5, '0') || lpad(CAST(p_size AS VARCHAR), 3, '0') AS STAT_NAME_code,
  p_brand AS GOV_ORG, lpad(regexp_extract(p_brand, '([0-9]+)', 1), 5, '0') AS GOV_ORG_code,
  concat_ws(' ', p_type, p_name) AS STATISTICS_NAME, p_name AS TITLE,
  lpad(CAST(p_size AS VARCHAR), 3, '0') AS TITLE_no,
  CASE WHEN p_size <= 25 THEN '月次' ELSE '年次' END AS CYCLE,
  CAST(p_size + 1970 AS VARCHAR) || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') AS SURVEY_DATE,
  strftime(DATE '2020-01-01' + CAST(p_partkey % 1500 AS INTEGER), '%Y-%m-%d') AS UPDATED_DATE
FROM part"""


def catalog_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Catalogue listing bodies (``GET_STATS_LIST``) built from part rows,
    ``page_size`` entries per body; ``{@code, $}`` objects as the service
    writes them."""
    part = table(spark, sf_dir, "part")
    f = _catalog_fields()
    rec = F.to_json(F.struct(
        f["id"].alias("@id"),
        F.struct(f["STAT_NAME_code"].alias("@code"), f["STAT_NAME"].alias("$")).alias("STAT_NAME"),
        F.struct(f["GOV_ORG_code"].alias("@code"), f["GOV_ORG"].alias("$")).alias("GOV_ORG"),
        f["STATISTICS_NAME"].alias("STATISTICS_NAME"),
        F.struct(f["TITLE_no"].alias("@no"), f["TITLE"].alias("$")).alias("TITLE"),
        f["CYCLE"].alias("CYCLE"),
        f["SURVEY_DATE"].alias("SURVEY_DATE"),
        f["UPDATED_DATE"].alias("UPDATED_DATE"),
    ))
    recs = part.select(F.floor(F.col("p_partkey") / page_size).alias("page_no"),
                       F.col("p_partkey").alias("k"), rec.alias("rec"))
    pages = recs.groupBy("page_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "rec"))), lambda x: x["rec"]).alias("recs"))
    node = F.when(F.size("recs") == 1, F.col("recs")[0]).otherwise(
        F.concat(F.lit("["), F.array_join("recs", ","), F.lit("]")))
    body = F.concat(
        F.lit('{"GET_STATS_LIST":{"RESULT":{"STATUS":0,"ERROR_MSG":""},"DATALIST_INF":{"NUMBER":'),
        F.size("recs").cast("string"), F.lit(',"TABLE_INF":'), node, F.lit("}}}"))
    return pages.select("page_no", body.alias("body"))


# ---------------------------------------------------------------------------
# Request log and first pages (from orders)
# ---------------------------------------------------------------------------

def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data requests shaped from orders, some of them breaking contracts."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").startswith("5"), F.concat(F.lit("T"), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("o_orderkey").cast("string")).alias("stats_data_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("E")).when(F.col("o_orderstatus") == "O", F.lit("j"))
        .otherwise(F.lit("X")).alias("lang"),
        (F.floor(F.col("o_totalprice")).cast("bigint") - 50000).cast("string").alias("limit"),
        (F.length("o_orderpriority") - 5).cast("string").alias("start_position"),
        F.substring(F.concat(F.col("o_orderkey").cast("string"), F.lit("0000000")), 1,
                    F.when(F.col("o_orderstatus") == "P", 6).otherwise(8)).alias("stats_code"),
    )


ORDER_REQUESTS_SQL = """SELECT o_orderkey,
  CASE WHEN starts_with(o_orderpriority, '5') THEN 'T' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS stats_data_id,
  CASE WHEN o_orderstatus = 'F' THEN 'E' WHEN o_orderstatus = 'O' THEN 'j' ELSE 'X' END AS lang,
  CAST(CAST(floor(o_totalprice) AS BIGINT) - 50000 AS VARCHAR) AS "limit",
  CAST(length(o_orderpriority) - 5 AS VARCHAR) AS start_position,
  substr(CAST(o_orderkey AS VARCHAR) || '0000000', 1, CASE WHEN o_orderstatus = 'P' THEN 6 ELSE 8 END) AS stats_code
FROM orders"""

FIRST_PAGE_SIZE = 100


def order_first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-page counters of many tables (one per order)."""
    o = table(spark, sf_dir, "orders")
    total = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    to = F.least(total, F.lit(FIRST_PAGE_SIZE).cast("bigint"))
    nxt = F.when((total > FIRST_PAGE_SIZE) & (F.col("o_orderstatus") != "P"),
                 F.lit(FIRST_PAGE_SIZE + 1).cast("bigint"))
    return o.select(F.col("o_orderkey").cast("string").alias("stats_data_id"),
                    total.alias("total_number"), to.alias("to_number"), nxt.alias("next_key"))


FIRST_PAGES_SQL = f"""SELECT CAST(o_orderkey AS VARCHAR) AS stats_data_id,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS total_number,
  least(CAST(floor(o_totalprice / 1000) AS BIGINT), {FIRST_PAGE_SIZE}) AS to_number,
  CASE WHEN CAST(floor(o_totalprice / 1000) AS BIGINT) > {FIRST_PAGE_SIZE} AND o_orderstatus <> 'P'
       THEN {FIRST_PAGE_SIZE + 1} END AS next_key
FROM orders"""


def landed_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages already landed (with replays): one row per lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("stats_data_id"),
                     (F.col("l_linenumber").cast("bigint") * FIRST_PAGE_SIZE + 1).alias("offset"))


MANIFEST_SQL = f"""SELECT CAST(l_orderkey AS VARCHAR) AS stats_data_id,
  CAST(l_linenumber AS BIGINT) * {FIRST_PAGE_SIZE} + 1 AS "offset" FROM lineitem"""


# ---------------------------------------------------------------------------
# Municipality-coded measures (from customer) and small areas (from supplier)
# ---------------------------------------------------------------------------

def customer_municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(c_custkey, area_code, value)`` with five-digit municipality codes;
    city numbers 101-140 hit many designated-city ward ranges."""
    c = table(spark, sf_dir, "customer")
    code = F.concat(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"),
                    (F.col("c_custkey") % 40 + 101).cast("string"))
    return c.select("c_custkey", code.alias("area_code"), F.col("c_acctbal").alias("value"))


CUSTOMER_MUNI_SQL = """SELECT c_custkey,
  lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || CAST(c_custkey % 40 + 101 AS VARCHAR) AS area_code,
  c_acctbal AS value FROM customer"""


def supplier_small_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small-area boundary features: one unit square per supplier on a
    ten-column grid; PREF from the nation, CITY 101-105 from the grid
    column pair, so neighbouring squares share edges.  Some rows are water
    areas (HCODE 8154) or lack a city name, for the cleaning rules."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = s.join(sized_broadcast(n, 100_000), s["s_nationkey"] == n["n_nationkey"], "left")
    pref = F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0")
    city = (F.floor((F.col("s_suppkey") % 10) / 2) + 101).cast("string")
    x = (F.col("s_suppkey") % 10).cast("double")
    y = F.floor(F.col("s_suppkey") / 10).cast("double")

    def pt(dx, dy):
        return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

    ring = F.array(pt(0, 0), pt(1, 0), pt(1, 1), pt(0, 1), pt(0, 0))
    return s.select(
        F.concat(pref, city, F.format_string("%04d", F.col("s_suppkey"))).alias("KEY_CODE"),
        pref.alias("PREF"), city.alias("CITY"),
        F.col("n_name").alias("PREF_NAME"),
        F.when(F.col("s_acctbal") > 9000, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("n_name"), F.lit(" 市"), city)).alias("CITY_NAME"),
        F.col("s_name").alias("S_NAME"),
        F.when(F.col("s_acctbal") < 0, F.lit("8154")).otherwise(F.lit("8101")).alias("HCODE"),
        F.array(F.array(ring)).alias("polygons"),
        F.lit(4612).alias("srid"),
    )


SMALL_AREAS_SQL = """SELECT
  lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') || CAST(CAST(floor((s_suppkey % 10) / 2) AS BIGINT) + 101 AS VARCHAR)
    || printf('%04d', s_suppkey) AS KEY_CODE,
  lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') AS PREF,
  CAST(CAST(floor((s_suppkey % 10) / 2) AS BIGINT) + 101 AS VARCHAR) AS CITY,
  n_name AS PREF_NAME,
  CASE WHEN s_acctbal > 9000 THEN NULL
       ELSE n_name || ' 市' || CAST(CAST(floor((s_suppkey % 10) / 2) AS BIGINT) + 101 AS VARCHAR) END AS CITY_NAME,
  s_name AS S_NAME,
  CASE WHEN s_acctbal < 0 THEN '8154' ELSE '8101' END AS HCODE
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

DESIGNATED_SQL = _values_sql(DESIGNATED_CITIES, ["parent_code", "parent_name", "ward_min", "ward_max"])


def customer_hierarchy_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A four-level code list: customer -> nation -> region -> all areas."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nat = F.concat(F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0"), F.lit("000"))
    reg = F.concat(F.lit("9"), (F.col("n_regionkey") + 1).cast("string"), F.lit("000"))

    def rows(df, code, parent, level):
        return df.select(F.lit(CUBE_ID).alias("stats_data_id"), F.lit("E").alias("lang"),
                         F.lit("cat03").alias("axis"), code.alias("code"), parent.alias("parent"),
                         F.lit(level).alias("level"))

    return (
        rows(c, F.concat(F.lit("C"), F.col("c_custkey").cast("string")),
             F.concat(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit("000")), "4")
        .unionByName(rows(n, nat, reg, "3"))
        .unionByName(rows(r, F.concat(F.lit("9"), (F.col("r_regionkey") + 1).cast("string"), F.lit("000")),
                          F.lit("00000"), "2"))
        .unionByName(rows(spark.range(0, 1, 1, numPartitions=1), F.lit("00000"), F.lit(None).cast("string"), "1"))
    )


HIERARCHY_CLASSES_SQL = f"""SELECT 'C' || CAST(c_custkey AS VARCHAR) AS code,
  lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || '000' AS parent FROM customer
UNION ALL SELECT lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || '000', '9' || CAST(n_regionkey + 1 AS VARCHAR) || '000' FROM nation
UNION ALL SELECT '9' || CAST(r_regionkey + 1 AS VARCHAR) || '000', '00000' FROM region
UNION ALL SELECT '00000', NULL"""


# ---------------------------------------------------------------------------
# File catalogue pages (from pages)
# ---------------------------------------------------------------------------

RESOURCES_PER_DATASET = 5
DATASETS_PER_BODY = 50


def file_catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``GET_DATA_CATALOG`` bodies: every ``RESOURCES_PER_DATASET``
    consecutive web pages form one dataset whose resources are the page
    URLs (a lone resource is written as an object, not an array)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ds = pages.groupBy(F.floor(F.col("page_id") / RESOURCES_PER_DATASET).alias("ds")).agg(
        F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("res"))
    res = F.transform("res", lambda r: F.struct(F.concat(F.lit("R"), r["page_id"].cast("string")).alias("@id"),
                                                r["url"].alias("URL")))
    res_json = F.when(F.size("res") == 1, F.to_json(F.get(res, 0))).otherwise(F.to_json(res))
    title = F.regexp_extract(F.get(F.col("res"), 0)["url"], "://([^/]+)", 1)
    record = F.concat(
        F.lit('{"@id":"D'), F.format_string("%06d", F.col("ds")), F.lit('","DATASET":'),
        F.to_json(F.struct(title.alias("TITLE"))), F.lit(',"RESOURCES":{"RESOURCE":'), res_json, F.lit("}}"))
    recs = ds.select(F.floor(F.col("ds") / DATASETS_PER_BODY).alias("body_no"), "ds", record.alias("rec"))
    bodies = recs.groupBy("body_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ds", "rec"))), lambda x: x["rec"]).alias("recs"))
    body = F.concat(
        F.lit('{"GET_DATA_CATALOG":{"RESULT":{"STATUS":0,"ERROR_MSG":""},"DATA_CATALOG_LIST_INF":{"DATA_CATALOG_INF":'),
        F.when(F.size("recs") == 1, F.get(F.col("recs"), 0)).otherwise(
            F.concat(F.lit("["), F.array_join("recs", ","), F.lit("]"))),
        F.lit("}}}"))
    return bodies.select("body_no", body.alias("body"))


FILE_CATALOG_LONG_SQL = f"""WITH p AS (
  SELECT page_id, url, CAST(floor(page_id / {RESOURCES_PER_DATASET}) AS BIGINT) AS ds,
         row_number() OVER (PARTITION BY floor(page_id / {RESOURCES_PER_DATASET}) ORDER BY page_id) AS i,
         count(*) OVER (PARTITION BY floor(page_id / {RESOURCES_PER_DATASET})) AS n
  FROM pages),
d AS (SELECT ds, arg_min(url, page_id) AS first_url FROM p GROUP BY ds)
SELECT 'D' || printf('%06d', ds) AS dataset_id, 'id' AS path, 'D' || printf('%06d', ds) AS value FROM d
UNION ALL
SELECT 'D' || printf('%06d', ds), 'DATASET_TITLE', regexp_extract(first_url, '://([^/]+)', 1) FROM d
UNION ALL
SELECT 'D' || printf('%06d', ds),
  CASE WHEN n = 1 THEN 'RESOURCES_RESOURCE_id' ELSE 'RESOURCES_RESOURCE_' || CAST(i AS VARCHAR) || '_id' END,
  'R' || CAST(page_id AS VARCHAR) FROM p
UNION ALL
SELECT 'D' || printf('%06d', ds),
  CASE WHEN n = 1 THEN 'RESOURCES_RESOURCE_URL' ELSE 'RESOURCES_RESOURCE_' || CAST(i AS VARCHAR) || '_URL' END,
  url FROM p"""


# ---------------------------------------------------------------------------
# The cube as landed data pages (parse + decode at full cube size)
# ---------------------------------------------------------------------------

ORDERS_PER_PAGE = 1000  # an order has at most seven lines: <= 7000 records per page


def cube_pages(obs: DataFrame) -> DataFrame:
    """Serialise cube observations as data-page bodies, one page per range
    of ``ORDERS_PER_PAGE`` order keys (``page_offset`` is the order key in
    the landed cube), records in order-key order."""
    rec = F.to_json(F.struct(
        F.col("cat01").alias("@cat01"), F.col("cat02").alias("@cat02"), F.col("area").alias("@area"),
        F.col("time").alias("@time"), F.col("unit").alias("@unit"), F.col("value").alias("$")))
    recs = obs.select(F.floor(F.col("page_offset") / ORDERS_PER_PAGE).alias("page_no"),
                      F.struct("page_offset", "pos", "l_partkey", "l_suppkey", "l_extendedprice").alias("k"),
                      rec.alias("rec"))
    pages = recs.groupBy("page_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "rec"))), lambda x: x["rec"]).alias("recs"))
    node = F.when(F.size("recs") == 1, F.get(F.col("recs"), 0)).otherwise(
        F.concat(F.lit("["), F.array_join("recs", ","), F.lit("]")))
    body = F.concat(
        F.lit('{"GET_STATS_DATA":{"RESULT":{"STATUS":0,"ERROR_MSG":""},'
              f'"PARAMETER":{{"LANG":"E","STATS_DATA_ID":"{CUBE_ID}"}},'
              '"STATISTICAL_DATA":{"RESULT_INF":{"FROM_NUMBER":'),
        (F.col("page_no") * ORDERS_PER_PAGE + 1).cast("string"),
        F.lit('},"DATA_INF":{"VALUE":'), node, F.lit("}}}}"))
    return pages.select("page_no", body.alias("body"))
