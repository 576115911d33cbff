import os

from pyspark.sql import functions as F

import pages as P
from pages import page, rows, tons
from statlake.operators import geo
from statlake.plans.tidy import tidy
from statlake.session import scratch_path
from statlake.sources.flatten import flatten_json
from statlake.sources.responses import class_rows, is_json_array, meta_table_info, read_bodies, value_rows
from test_areas import plots


def test_language_fallback_per_table(landed):
    bodies = landed(page(tons(1)), page(tons(2), lang="J"), page(tons(3), table="0009100009", lang="J"))
    got = tidy(value_rows(bodies), class_rows(bodies), lang="E", fallback_lang="J", keep_lineage=True).data
    assert sorted((r["stats_data_id"], r["lang"], r["value"]) for r in rows(got)) == [(P.HARBOUR, "E", 1.0), ("0009100009", "J", 3.0)]


def test_tidy_with_geometry(spark, landed):
    bodies = landed(page(tons(5, quay="46370")))
    bounds = geo.boundaries(plots(spark, {(0, 0): ("46", "370")}), "municipality", "ward")
    res = tidy(value_rows(bodies), class_rows(bodies), geometry=bounds)
    row = res.data.collect()[0]
    assert row.area_code == "46370" and row.polygons is not None
    assert res.unmatched.count() == 0


def test_read_bodies_hive_layout(spark):
    base = scratch_path(spark, "t-landing").replace("file:", "")
    folder = os.path.join(base, f"stats_data_id={P.HARBOUR}", "lang=E")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "one.json"), "w", encoding="utf-8") as f:
        f.write(page(tons(4, "#"), named=False).replace("{", "{\n", 3))
    b = read_bodies(spark, base, partitions=["stats_data_id", "lang"])
    assert {"body", "source_path", "stats_data_id", "lang"} <= set(b.columns)
    assert [(r["stats_data_id"], r["lang"]) for r in rows(value_rows(b))] == [(P.HARBOUR, "E")] * 2


def test_is_json_array_and_table_info(spark, landed):
    df = spark.createDataFrame([("[3]",), ('{"a":[1]}',), ("[ ]",), ("?",)], "t string")
    got = [r.a for r in df.select(F.coalesce(is_json_array(F.col("t")), F.lit(False)).alias("a")).collect()]
    assert got[:2] == [True, False] and got[3] is False
    info = meta_table_info(landed(P.describe()))
    flat = flatten_json(info.select(F.lit(1).alias("row_id"), F.col("table_inf").alias("record")))
    assert {r["path"]: r["value"] for r in rows(flat)} == {"id": P.HARBOUR, "TITLE_no": "7", "TITLE": "Tonnage"}


def test_attach_geometry_keeps_national_row(spark):
    areas = plots(spark, {(0, 0): ("46", "380"), (1, 0): ("46", "381")})
    d = spark.createDataFrame([("00000",), ("46380",), ("46381",), ("46000",)], "area_code string")
    joined, unmatched = geo.attach_geometry(d, areas)
    assert {r["area_code"]: r["polygons"] is not None for r in rows(joined)} == {"00000": False, "46380": True, "46381": True, "46000": False}
    assert sorted(r["area_code"] for r in rows(unmatched)) == ["00000", "46000"]


def test_language_choice_blocks_hard_errors(spark):
    from statlake.operators.quality import classify_status, language_choice

    pages = spark.createDataFrame([
        ("t1", "E", "0"), ("t1", "J", "0"),          # English ok
        ("t2", "E", "200"), ("t2", "J", "0"),        # no English release -> Japanese
        ("t3", "E", "500"), ("t3", "J", "0"),        # server error: not masked
        ("t4", "J", "0"),                            # English never landed -> Japanese
    ], "stats_data_id string, lang string, status_raw string")
    out = {r.stats_data_id: (r.lang_used, r.reason) for r in language_choice(classify_status(pages)).collect()}
    assert out == {"t1": ("E", "preferred"), "t2": ("J", "fallback"),
                   "t3": (None, "blocked: server"), "t4": ("J", "fallback")}
