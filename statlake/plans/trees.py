"""Queries on totals over code trees and on the trigram index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.operators.hierarchy import KEYS
from statlake.operators.intervals import interval_labels, rollup_totals
from statlake.operators.search import reorder_search_columns
from statlake.operators.search_index import search_indexed, write_index
from statlake.plans import testdata as td
from statlake.plans.lake import landed_derived
from statlake.session import scratch_path
from statlake.sources.flatten import flatten_json, flatten_wide
from statlake.sources.responses import catalog_records


def axis_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and their balances under every code: customer, nation, region, all."""
    classes = td.customer_hierarchy_classes(spark, sf)
    c = td.table(spark, sf, "customer")
    values = c.select(F.lit(td.CUBE_ID).alias("stats_data_id"), F.lit("E").alias("lang"), F.lit("cat03").alias("axis"),
                      F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code"), F.lit(1).cast("long").alias("n_rows"),
                      F.round(F.col("c_acctbal") * 100).cast("long").alias("total_cents"))
    return rollup_totals(interval_labels(classes), values, ["n_rows", "total_cents"]).drop(*KEYS)


#: Each order hangs on the order before it of the same customer: long, uneven chains.
_CHAIN = """SELECT CAST(o_custkey % 7 AS {text}) AS axis, CAST(o_orderkey AS {text}) AS code,
  CAST(lag(o_orderkey) OVER (PARTITION BY o_custkey % 7 ORDER BY o_orderkey) AS {text}) AS parent, CAST(floor(o_totalprice) AS BIGINT) AS v FROM {orders}"""


def chain_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals along chains of thousands of codes: as many rounds as a deep tree's logarithm."""
    rows = spark.sql(_CHAIN.replace("{text}", "STRING"), orders=td.table(spark, sf, "orders"))
    rows = rows.select(F.lit(td.CUBE_ID).alias("stats_data_id"), F.lit("E").alias("lang"), "axis", "code", "parent", "v")
    return rollup_totals(interval_labels(rows), rows, ["v"]).select("axis", "code", "n_codes", "v")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    def wide(s, d):
        rec = catalog_records(td.catalog_pages(s, d))
        rec = rec.select(F.get_json_object("record", "$['@id']").alias("table_id"), "record")
        return flatten_wide(flatten_json(rec, "record", id_col="table_id", max_depth=4), td.CATALOG_COLUMNS).drop("row_id")
    return landed_derived(spark, sf, "catalog-wide", wide)


def index_search(spark: SparkSession, sf: str) -> DataFrame:
    """AND and OR over the landed index: the same entries as a scan finds."""
    catalog = _catalog(spark, sf)
    path = scratch_path(spark, "trigrams")
    write_index(catalog, path)
    return reorder_search_columns(search_indexed(catalog, path, "hot plate OR bolt AND small OR RING"))


QUERIES = {f.__name__: f for f in (axis_totals, chain_totals, index_search)}

_BELOW = f"""WITH RECURSIVE cl AS ({td.HIERARCHY_CLASSES_SQL}),
below(code, member) AS (SELECT code, code FROM cl UNION ALL SELECT c.parent, b.member FROM below b JOIN cl c ON c.code = b.code WHERE c.parent IS NOT NULL)
SELECT b.code, CAST(count(*) AS BIGINT) AS n_codes, CAST(count(c_custkey) AS BIGINT) AS n_rows, CAST(coalesce(sum(CAST(round(c_acctbal * 100) AS BIGINT)), 0) AS BIGINT) AS total_cents
FROM below b LEFT JOIN customer ON b.member = 'C' || CAST(c_custkey AS VARCHAR) GROUP BY b.code"""


def oracle(catalog: str, friendly: str, kw) -> dict[str, str]:
    return {
        "axis_totals": _BELOW,
        # in a chain all codes from one on lie below it
        "chain_totals": f"""SELECT axis, code, CAST(count(*) OVER below AS BIGINT) AS n_codes, CAST(sum(v) OVER below AS BIGINT) AS v
FROM ({_CHAIN.format(text='VARCHAR', orders='orders')}) WINDOW below AS (PARTITION BY axis ORDER BY CAST(code AS BIGINT) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
        "index_search": f"SELECT {friendly} FROM {catalog} WHERE ({kw('hot')} AND {kw('plate')}) OR ({kw('bolt')} AND {kw('small')}) OR {kw('ring')}",
    }
