"""A lake of many tables in two languages, derived from orders.

Each order priority is a table of its own.  All tables use the status codes F, O
and P, with another meaning (label) in each; the last table lists no label for P.
Queries here decode, page and report over all tables at once, keyed by table,
language and code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.plans import testdata as td
from statlake.plans.tidy import annotation_counts, tidy

AXES = ["cat01", "time"]
_SID = "'00040000' || lpad(substr(o_orderpriority, 1, 1), 2, '0')"
_LANG = "CASE WHEN o_custkey % 2 = 0 THEN 'E' ELSE 'J' END"
_RAW = """CASE WHEN o_orderkey % 17 = 0 THEN '***' WHEN o_orderkey % 19 = 0 THEN '-'
  ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS {text}) END"""
#: Rows of each table and language: the same text runs in Spark and in DuckDB.
_OBS = """SELECT {sid} AS stats_data_id, {lang} AS lang, {sid} || '-all' AS query_fingerprint,
  o_orderkey AS page_offset, o_custkey AS pos, o_orderstatus AS cat01, CAST(year(o_orderdate) AS {text}) || '000000' AS time,
  'yen' AS unit, {raw} AS value FROM {orders}"""
_CODES = """SELECT DISTINCT {sid} AS stats_data_id, {lang} AS lang, o_orderpriority, o_orderstatus AS code,
  o_orderstatus || ' of ' || o_orderpriority || ' in ' || ({lang}) AS name FROM {orders}
  WHERE NOT (o_orderpriority LIKE '5%' AND o_orderstatus = 'P')"""
_YEARS = """SELECT DISTINCT {sid} AS stats_data_id, {lang} AS lang, CAST(year(o_orderdate) AS {text}) || '000000' AS code,
  ({lang}) || CAST(year(o_orderdate) AS {text}) AS name FROM {orders}"""


def _fill(sql: str, text: str, orders: str) -> str:
    return sql.format(sid=f"({_SID})", lang=f"({_LANG})", raw=_RAW.format(text=text), text=text, orders=orders)


def observations(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_fill(_OBS, "STRING", "{orders}"), orders=td.table(spark, sf, "orders"))


def classes(spark: SparkSession, sf: str) -> DataFrame:
    orders = td.table(spark, sf, "orders")
    status = spark.sql(_fill(_CODES, "STRING", "{orders}"), orders=orders).select("stats_data_id", "lang", F.lit("cat01").alias("axis"), F.lit(1).alias("axis_pos"), "code", "name")
    years = spark.sql(_fill(_YEARS, "STRING", "{orders}"), orders=orders).select("stats_data_id", "lang", F.lit("time").alias("axis"), F.lit(2).alias("axis_pos"), "code", "name")
    return status.unionByName(years).withColumn("axis_name", F.col("axis"))


def notes(spark: SparkSession, sf: str) -> DataFrame:
    """A marker means something else in each table and language."""
    tables = observations(spark, sf).select("stats_data_id", "lang").distinct()
    marker = F.explode(F.array(F.lit("***"), F.lit("-"))).alias("char")
    return tables.select("stats_data_id", "lang", marker).withColumn("note", F.concat_ws(" ", "char", "stats_data_id", "lang"))


def lake_tidy(spark: SparkSession, sf: str) -> DataFrame:
    """All tables and languages decoded in one job."""
    r = tidy(observations(spark, sf), classes(spark, sf), axes=AXES, keep_lineage=True)
    return r.data.select("stats_data_id", "lang", "page_offset", "cat01", "cat01_code", "time", "time_code", "unit", "value", "annotation")


def lake_limit_per_table(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of every table and language."""
    r = tidy(observations(spark, sf), axes=AXES, decode_labels=False, limit=25, keep_lineage=True, order_by=["page_offset", "pos"])
    return r.data.select("stats_data_id", "lang", "page_offset", "cat01", "value", "annotation")


def filtered_window(spark: SparkSession, sf: str) -> DataFrame:
    """Start position without a limit, counted over the filtered rows of every
    table and language."""
    r = tidy(observations(spark, sf), axes=AXES, decode_labels=False, codes={"cat01": ["F", "P"]}, start_position=11, keep_lineage=True)
    return r.data.select("stats_data_id", "lang", "page_offset", "cat01", "value", "annotation")


def lake_annotation_counts(spark: SparkSession, sf: str) -> DataFrame:
    r = tidy(observations(spark, sf), axes=AXES, decode_labels=False, keep_lineage=True)
    return annotation_counts(r.data, notes(spark, sf))


QUERIES = {f.__name__: f for f in (lake_tidy, lake_limit_per_table, filtered_window, lake_annotation_counts)}

_O = f"({_fill(_OBS, 'VARCHAR', 'orders')})"
_SPLIT = f"{td.value_sql('o.value')} AS value, {td.annotation_sql('o.value')} AS annotation"
_NUMBERED = "row_number() OVER (PARTITION BY stats_data_id, lang ORDER BY page_offset, pos)"

ORACLE = {
    "lake_tidy": f"""SELECT o.stats_data_id, o.lang, o.page_offset, c.name AS cat01, o.cat01 AS cat01_code, t.name AS time, o.time AS time_code,
  o.unit, {_SPLIT} FROM {_O} o
LEFT JOIN ({_fill(_CODES, 'VARCHAR', 'orders')}) c ON c.stats_data_id = o.stats_data_id AND c.lang = o.lang AND c.code = o.cat01
LEFT JOIN ({_fill(_YEARS, 'VARCHAR', 'orders')}) t ON t.stats_data_id = o.stats_data_id AND t.lang = o.lang AND t.code = o.time""",
    "lake_limit_per_table": f"""SELECT stats_data_id, lang, page_offset, cat01, {_SPLIT}
FROM (SELECT *, {_NUMBERED} AS k FROM {_O}) o WHERE k <= 25""",
    "filtered_window": f"""SELECT stats_data_id, lang, page_offset, cat01, {_SPLIT}
FROM (SELECT *, {_NUMBERED} AS k FROM {_O} WHERE cat01 IN ('F', 'P')) o WHERE k >= 11""",
    "lake_annotation_counts": f"""SELECT stats_data_id, lang, annotation, count(*) AS n, annotation || ' ' || stats_data_id || ' ' || lang AS note
FROM (SELECT stats_data_id, lang, {_SPLIT} FROM {_O} o) WHERE annotation IS NOT NULL GROUP BY ALL""",
}
