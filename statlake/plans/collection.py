"""Queries about collecting pages: doubled pages, pages that name no language,
pages of mixed sizes and what they leave to pull."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.operators.paging import landed_ranges, missing_ranges, plan_ranges
from statlake.plans import testdata as td
from statlake.plans.lake import land_responses, landed_derived, read_lake
from statlake.plans.tidy import tidy
from statlake.session import scratch_path
from statlake.sources.responses import class_rows, value_rows


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return landed_derived(spark, sf, "event-pages", td.event_pages)


def doubled_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every page twice in one landing, with a failed one, then all landed again."""
    pages = _pages(spark, sf).select("body")
    failed = td.status_bodies(spark, sf).where("event_id = 0").select("body")
    base = scratch_path(spark, "doubled-lake")
    for _ in range(2):
        land_responses(pages.unionAll(pages).unionAll(failed).unionAll(failed), base)
    lake = read_lake(spark, base)
    rows = lake["observations"].groupBy("page_offset").agg(F.count("*").alias("n_rows"))
    listed = lake["manifest"].groupBy("page_offset").agg(F.count("*").alias("n_pages"))
    return rows.join(listed, "page_offset").withColumn("n_failed", F.lit(lake["failed"].count()))


def unnamed_language(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that name no language decode with the code lists they carry."""
    bodies = _pages(spark, sf).select(F.regexp_replace("body", '"LANG":"[A-Z]",?', "").alias("body"))
    r = tidy(value_rows(bodies), class_rows(bodies), axes=["tab", "cat01", "area", "time"], keep_lineage=True)
    return r.data.select("area", "area_code", "time", "time_code", "cat01", "cat01_code", "tab", "stats_data_id", "lang", "unit", "value", "annotation")


#: Landed pages of 100 and of 1,000 rows for each order's table, some failed.
_MIXED = """SELECT CAST(l_orderkey AS {text}) AS stats_data_id,
  CAST(1 + (l_partkey % 40) * 45 AS BIGINT) AS from_number,
  CAST((l_partkey % 40) * 45 + CASE WHEN l_linenumber % 3 = 0 THEN 1000 ELSE 100 END AS BIGINT) AS to_number,
  l_returnflag <> 'R' AS ok FROM {lineitem}"""
_TOTALS = "SELECT CAST(o_orderkey AS {text}) AS stats_data_id, CAST(floor(o_totalprice / 100) AS BIGINT) AS total_number FROM {orders}"


def _mixed(spark, sf):
    return spark.sql(_MIXED.replace("{text}", "STRING"), lineitem=td.table(spark, sf, "lineitem"))


def _totals(spark, sf):
    return spark.sql(_TOTALS.replace("{text}", "STRING"), orders=td.table(spark, sf, "orders"))


def page_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return landed_ranges(_mixed(spark, sf), keys=["stats_data_id"], span=500)


def range_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return missing_ranges(_totals(spark, sf), _mixed(spark, sf), keys=["stats_data_id"])


def range_plan(spark: SparkSession, sf: str) -> DataFrame:
    return plan_ranges(range_gaps(spark, sf), page_size=400, keys=["stats_data_id"])


QUERIES = {f.__name__: f for f in (doubled_pages, unnamed_language, page_coverage, range_gaps, range_plan)}

_M = f"({_MIXED.format(text='VARCHAR', lineitem='lineitem')})"
_COVERED = f"""SELECT stats_data_id, min(from_number) AS from_number, max(to_number) AS to_number FROM (
  SELECT *, sum(first) OVER (PARTITION BY stats_data_id ORDER BY from_number, to_number ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT *, CASE WHEN from_number <= 1 + max(to_number) OVER (PARTITION BY stats_data_id ORDER BY from_number, to_number
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS first FROM {_M} WHERE ok)) GROUP BY stats_data_id, run"""
# row by row: a row is missing if no landed page holds it; runs of missing rows are gaps
_GAPS = f"""SELECT stats_data_id, min(k) AS from_number, max(k) AS to_number FROM (
  SELECT stats_data_id, k, k - row_number() OVER (PARTITION BY stats_data_id ORDER BY k) AS run FROM (
    SELECT t.stats_data_id, CAST(u.k AS BIGINT) AS k FROM (SELECT stats_data_id, max(total_number) AS total_number FROM ({_TOTALS.format(text='VARCHAR', orders='orders')}) GROUP BY 1) t,
      unnest(range(1, t.total_number + 1)) AS u(k)
    WHERE NOT EXISTS (SELECT 1 FROM ({_COVERED}) c WHERE c.stats_data_id = t.stats_data_id AND u.k BETWEEN c.from_number AND c.to_number)))
GROUP BY stats_data_id, run"""


def oracle(others: dict[str, str]) -> dict[str, str]:
    return {
        "doubled_pages": f"""SELECT CAST(floor(event_id / {td.PAGE_SIZE}) AS BIGINT) * {td.PAGE_SIZE} + 1 AS page_offset, count(*) AS n_rows,
  CAST(1 AS BIGINT) AS n_pages, 1 AS n_failed FROM events GROUP BY 1""",
        "unnamed_language": f"SELECT area, area_code, time, time_code, cat01, cat01_code, tab, stats_data_id, NULL AS lang, unit, value, annotation FROM ({others['pages_tidy']})",
        "page_coverage": _COVERED,
        "range_gaps": _GAPS,
        "range_plan": f"""SELECT stats_data_id, CAST(u.o AS BIGINT) AS "offset", CAST(least(400, to_number - u.o + 1) AS BIGINT) AS size
FROM ({_GAPS}) g, unnest(range(g.from_number, g.to_number + 1, 400)) AS u(o)""",
    }
