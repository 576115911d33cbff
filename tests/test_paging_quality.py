import datetime as dt

import pytest

from statlake.functions.values import redact_param
from statlake.operators.paging import incomplete_tables, missing_pages, page_plan, split_batches, take_rows
from statlake.operators.quality import (
    InvalidArgument,
    classify_status,
    contract_violations,
    fresh_metadata,
    normalise_lang,
    prefer_language,
    response_status,
    validate_boundary_year_datum,
    validate_search_args,
    validate_stats_data_args,
)


def fp(spark, rows):
    return spark.createDataFrame(rows, "stats_data_id string, total_number bigint, to_number bigint, next_key bigint")


def test_page_plan_fans_out_and_trims(spark):
    plan = page_plan(fp(spark, [("a", 250, 100, 101), ("b", 50, 50, None), ("c", 300, 100, None)]),
                     page_size=100).orderBy("stats_data_id", "offset").collect()
    assert [(r.stats_data_id, r.offset, r.size) for r in plan] == [("a", 101, 100), ("a", 201, 50)]


def test_page_plan_with_limit_and_guard(spark):
    plan = page_plan(fp(spark, [("a", 1000, 3, 4), ("b", 5, 5, 6)]), page_size=100000, limit=3).collect()
    assert plan == []  # page size becomes 3 and to >= target: no fan-out, no reversed sequence
    plan = page_plan(fp(spark, [("a", 10, 3, 4)]), page_size=100000, limit=8).orderBy("offset").collect()
    assert [(r.offset, r.size) for r in plan] == [(4, 5)]  # page size = min(limit, cap) = 8, target 8


def test_incomplete_flag(spark):
    inc = incomplete_tables(fp(spark, [("a", 300, 100, None), ("b", 100, 100, None)])).collect()
    assert [r.stats_data_id for r in inc] == ["a"]


def test_missing_pages_and_batches(spark):
    plan = spark.createDataFrame([("a", o, 3) for o in (4, 7, 10, 13, 16)], "stats_data_id string, offset bigint, size bigint")
    landed = spark.createDataFrame([("a", 7), ("a", 7), ("a", 13)], "stats_data_id string, offset bigint")
    todo = missing_pages(plan, landed, keys=["stats_data_id"])
    assert sorted(r.offset for r in todo.collect()) == [4, 10, 16]
    b = split_batches(todo, 2, keys=["stats_data_id"]).orderBy("offset").collect()
    assert [r.batch_id for r in b] == [0, 0, 1]
    with pytest.raises(ValueError):
        split_batches(todo, 0)


def test_take_rows_row_index(spark):
    df = spark.createDataFrame([(1, i) for i in range(3)] + [(4, i) for i in range(3)], "page_offset bigint, pos int")
    got = take_rows(df, limit=2, start_position=3).collect()
    assert [(r.page_offset + r.pos) for r in got] == [3, 4]
    assert take_rows(df, limit=0).count() == 0


@pytest.mark.parametrize("status,cls,ok", [
    ("0", None, True), ("100", "invalid_param", False), ("200", "no_data", False), ("300", "auth", False),
    ("500", "server", False), ("999", "other", False), (None, "parse_error", False),
    ("not-a-number", "parse_error", False),
])
def test_status_classes(spark, status, cls, ok):
    df = spark.createDataFrame([(status, "bad request for appId=SUPERSECRET&x=1")], "status_raw string, error_msg string")
    r = classify_status(df).collect()[0]
    assert (r.error_class, r.ok) == (cls, ok)
    if status not in ("0",):
        assert r.error_msg is None or ("SUPERSECRET" not in r.error_msg and "appId=<hidden>" in r.error_msg)


def test_response_status_non_json(spark):
    df = spark.createDataFrame([("<html>not json</html>",), ('{"GET_STATS_DATA":{"RESULT":{"STATUS":0}}}',)], "body string")
    rows = sorted(response_status(df).collect(), key=lambda r: r.is_json)
    assert (rows[0].is_json, rows[0].error_class) == (False, "parse_error")
    assert (rows[1].is_json, rows[1].ok) == (True, True)


def test_redact_every_occurrence(spark):
    df = spark.createDataFrame([("u?appId=K1&a=1 appId=K2 \"appId=K3\"",)], "s string")
    out = df.select(redact_param("s").alias("s")).collect()[0].s
    assert "K1" not in out and "K2" not in out and "K3" not in out and out.count("<hidden>") == 3


def test_driver_side_validation():
    assert normalise_lang("j") == "J"
    for bad in ("X", ["E", "J"]):
        with pytest.raises(InvalidArgument):
            normalise_lang(bad)
    for args in (("",), ("abc123",), ("123", -5), ("123", None, 0), ("123", 2.7)):
        with pytest.raises(InvalidArgument):
            validate_stats_data_args(*args)
    validate_stats_data_args("0009900001", 10, 1)
    for kw in ({"search_kind": "9"}, {"limit": -1}, {"stats_code": "123"}):
        with pytest.raises(InvalidArgument):
            validate_search_args(**kw)
    validate_boundary_year_datum(2020, "2011")
    validate_boundary_year_datum(2015, "2011")
    for y, d in ((1995, "2000"), (2010, "2011")):
        with pytest.raises(InvalidArgument):
            validate_boundary_year_datum(y, d)


def test_contract_violations(spark):
    df = spark.createDataFrame([("123", "E", "5", "1"), ("abc", "X", "-1", "0")],
                               "stats_data_id string, lang string, limit string, start_position string")
    v = {r.stats_data_id: r.violations for r in contract_violations(df).collect()}
    assert v["123"] == []
    assert set(v["abc"]) == {"stats_data_id_not_digits", "lang_invalid", "limit_not_count", "start_position_zero"}


def test_prefer_language(spark):
    df = spark.createDataFrame([("t1", "E", 1), ("t1", "J", 2), ("t2", "J", 3)], "stats_data_id string, lang string, v int")
    out = {(r.stats_data_id, r.lang_used) for r in prefer_language(df).collect()}
    assert out == {("t1", "E"), ("t2", "J")}


def test_fresh_metadata_ttl(spark):
    t0 = dt.datetime(2024, 1, 10)
    df = spark.createDataFrame(
        [("a", "E", t0, 1), ("a", "E", t0 - dt.timedelta(days=5), 2), ("b", "E", t0 - dt.timedelta(days=40), 3)],
        "stats_data_id string, lang string, fetched_at timestamp, v int")
    out = {r.stats_data_id: (r.v, r.fresh) for r in fresh_metadata(df, "2024-01-10 00:00:00", 30 * 24 * 3600).collect()}
    assert out == {"a": (1, True), "b": (3, False)}
