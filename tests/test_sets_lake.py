from pyspark.sql import functions as F

import pages as P
from pages import cell, page, rows, tons
from statlake.operators.sets import codes_except, codes_intersect, comma_list, union_fill
from statlake.plans.lake import land_responses, read_lake
from statlake.plans.tidy import tidy
from statlake.session import scratch_path


def test_union_fill_and_code_sets(spark):
    a = spark.createDataFrame([("1", "x")], "id string, TITLE string")
    b = spark.createDataFrame([("2", "y")], "id string, OTHER string")
    u = union_fill([a, b]).orderBy("id").collect()
    assert u[0].OTHER is None and u[1].TITLE is None
    c1 = spark.createDataFrame([("01",), ("02",), ("02",), (None,)], "c string")
    c2 = spark.createDataFrame([("02",)], "c string")
    assert [r.c for r in codes_except(c1, c2, "c").collect()] == ["01"]
    assert [r.c for r in codes_intersect(c1, c2, "c").collect()] == ["02"]
    arr = spark.range(1).select(comma_list(F.array(F.lit("01000"), F.lit("02000"))).alias("s")).collect()[0].s
    assert arr == "01000,02000"


def harbour_lake(spark, landed, *bodies):
    base = scratch_path(spark, "t-lake")
    land_responses(landed(*bodies), base)
    return base, read_lake(spark, base)


def test_landing_again_adds_nothing_and_completes(spark, landed):
    first, second = page(tons(1, 2), total=3, go_on=True), page(tons(3), start=3, total=3, lists=P.code_lists(cargo={"g9": ("Salt", None)}))
    base, _ = harbour_lake(spark, landed, first, page([], status=200))
    for batch in ((first,), (first, second), (first, second)):
        land_responses(landed(*batch), base)
    lake = read_lake(spark, base)
    assert sorted(r["value"] for r in rows(lake["observations"])) == ["1", "2", "3"]
    assert lake["manifest"].count() == 2 and {r["error_class"] for r in rows(lake["failed"])} == {"no_data"}
    assert {r["code"] for r in rows(lake["classes"].where("axis = 'cat01'"))} == {*P.CARGO, "g9"}


def test_rows_of_an_unfinished_landing_do_not_count(spark, landed):
    base, lake = harbour_lake(spark, landed, page(tons(1)))
    stray = lake["observations"].withColumn("load", F.lit("unfinished"))
    stray.write.mode("append").partitionBy("stats_data_id", "load").parquet(f"{base}/observations")
    assert read_lake(spark, base)["observations"].count() == 1


def test_decoding_a_landed_lake_needs_no_shuffle_of_its_rows(spark, landed):
    _, lake = harbour_lake(spark, landed, page([cell(text="1"), cell(cargo="g2", text="2")]))
    d = tidy(lake["observations"], lake["classes"], lake["notes"], stats_data_id=P.HARBOUR, lang="E", codes={"cat01": ["g2"]}).data
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "In(cat01, [g2])" in plan or "EqualTo(cat01,g2)" in plan
    assert [r["value"] for r in rows(d)] == [2.0]


def test_missing_pages_are_planned_again(spark, landed):
    from statlake.operators.paging import missing_pages, page_plan
    from statlake.sources.responses import page_info

    info = page_info(landed(page(tons(1, 2, 3), total=12, go_on=True), page([], start=4, status=500), page(tons(7, 8, 9), start=7, total=12)))
    keys = ["stats_data_id", "lang", "query_fingerprint"]
    plan = page_plan(info.where("from_number = 1"), page_size=3, keys=keys)
    todo = missing_pages(plan, info.withColumnRenamed("page_offset", "offset"), keys=keys)
    assert sorted(r["offset"] for r in rows(todo)) == [4, 10]  # the failed page counts as missing



def test_dig_null_safe(spark):
    from statlake.functions import dig

    df = spark.createDataFrame([('{"A":{"B":1,"@id":"x"}}',), ("<html>",)], "j string")
    rows = df.select(dig("j", "A", "B").alias("b"), dig("j", "A", "C").alias("c"),
                     dig("j", "Z").alias("z"), dig("j", "A", "@id").alias("i")).collect()
    assert (rows[0].b, rows[0].c, rows[0].z, rows[0].i) == ("1", None, None, "x")
    assert (rows[1].b, rows[1].i) == (None, None)


def test_axis_label_metadata_survives_parquet(spark, landed):
    from statlake.sources.responses import class_rows, value_rows

    b = landed(page(tons(1)))
    d = tidy(value_rows(b), class_rows(b)).data
    path = scratch_path(spark, "t-label")
    d.write.parquet(path)
    back = spark.read.parquet(path)
    assert back.schema["cat01"].metadata.get("label") == "Cargo"
    assert back.schema["area"].metadata.get("label") == "Quay"


def test_each_body_parsed_once(landed):
    from statlake.sources.responses import value_rows

    found = value_rows(landed(page(tons(1))))
    plan = found.where(F.col("stats_data_id") == P.HARBOUR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(GET_STATS_DATA") == 1
