"""Readers of landed pages."""

import json

import pages as P
import pytest
from pages import cell, page, rows, tons
from pyspark.sql import functions as F

from statlake.sources.flatten import flatten_json, flatten_wide
from statlake.sources.responses import (
    axis_rows,
    catalog_records,
    class_rows,
    failed_pages,
    meta_class_rows,
    note_rows,
    page_info,
    value_rows,
)


@pytest.mark.parametrize("count", [0, 1, 2, 7])
def test_a_page_of_any_number_of_cells(landed, count):
    got = rows(value_rows(landed(page(tons(*range(count))))).orderBy("pos"))
    assert [(r["pos"], r["value"]) for r in got] == [(k, str(k)) for k in range(count)]
    for r in got:
        assert (r["stats_data_id"], r["lang"], r["page_offset"], r["area"], r["cat01"], r["unit"]) == (P.HARBOUR, "E", 1, "90100", "g1", "t")
        assert r["cat07"] is None and r["extra"] is None


def test_row_numbers_run_over_pages(landed):
    bodies = [page(tons(*range(s, s + 3)), start=s, total=9) for s in (7, 1, 4)]
    got = rows(value_rows(landed(*bodies)))
    assert sorted((r["page_offset"] + r["pos"], r["value"]) for r in got) == [(k, str(k)) for k in range(1, 10)]


def test_keys_outside_the_axes_are_kept(landed):
    got = rows(value_rows(landed(page([cell(text="1"), cell(text="2", berth="B7", draught="4.1")]), page([cell(text="3", tide="low")], start=3))).orderBy("page_offset", "pos"))
    assert [r["extra"] for r in got] == [None, {"berth": "B7", "draught": "4.1"}, {"tide": "low"}]


def test_identity_of_a_page_that_names_no_table(spark, landed):
    body = page(tons(5), named=False)
    assert rows(value_rows(landed(body)))[0]["stats_data_id"] is None
    named = spark.createDataFrame([(body, P.HARBOUR, "E")], "body string, stats_data_id string, lang string")
    for reader in (value_rows, class_rows, note_rows, page_info):
        assert {(r["stats_data_id"], r["lang"]) for r in rows(reader(named))} == {(P.HARBOUR, "E")}


def test_failed_pages_give_no_rows_but_a_report(landed):
    bodies = landed(page(tons(1), status=100, message="bad appId=SECRET"), "<html>down</html>", page(tons(2)), "{}")
    assert [r["value"] for r in rows(value_rows(bodies))] == ["2"]
    bad = rows(failed_pages(bodies))
    assert sorted(r["error_class"] for r in bad) == ["invalid_param", "parse_error", "parse_error"]
    assert not any("SECRET" in (r["error_msg"] or "") for r in bad)


def test_page_counters(landed):
    r = rows(page_info(landed(page(tons(1, 2), start=11, total=40, go_on=True))))[0]
    assert (r["page_offset"], r["from_number"], r["to_number"], r["total_number"], r["next_key"]) == (11, 11, 12, 40, 13)


def test_code_lists_are_the_union_of_all_pages(landed):
    first = page(tons(1), lists=P.code_lists(cargo={"g1": ("Grain", "g0")}))
    later = page(tons(2), start=2, lists=P.code_lists(cargo={"g2": ("Timber", "g0")}, quays={"90300": "New quay"}))
    got = {(r["axis"], r["code"]): r for r in rows(class_rows(landed(first, later, later)))}
    assert {k for k in got if k[0] == "cat01"} == {("cat01", "g1"), ("cat01", "g2")}
    assert ("area", "90300") in got and len(got) == 2 + 3 + 2
    assert got["cat01", "g2"]["parent"] == "g0" and got["cat01", "g2"]["axis_name"] == "Cargo" and got["area", "90300"]["axis_pos"] == 2


def test_further_keys_of_a_code(landed):
    got = rows(class_rows(landed(page(tons(1), lists=P.code_lists(more={"@since": "1880", "@a": "x"})))))
    assert {r["extra"] for r in got} == {'{"a":"x","since":"1880"}'}
    assert {r["extra"] for r in rows(class_rows(landed(page(tons(1)))))} == {None}


def test_an_empty_code_list_has_no_rows_but_a_named_axis(landed):
    bodies = landed(page(tons(1), lists=P.code_lists(cargo={})))
    assert {r["axis"] for r in rows(class_rows(bodies))} == {"area", "time"}
    assert {(r["axis"], r["axis_name"], r["axis_pos"]) for r in rows(axis_rows(bodies))} == {("cat01", "Cargo", 1), ("area", "Quay", 2), ("time", "Year", 3)}


def test_legends_of_all_pages(landed):
    bodies = landed(page(tons(1)), page(tons(2), start=2, legend=(("#", "estimate"), ("%", "rounded"))), page(tons(3), start=3, legend=()))
    assert sorted((r["char"], r["note"]) for r in rows(note_rows(bodies))) == [("#", "estimate"), ("%", "rounded")]


def test_metadata_lists_equal_those_of_the_pages(landed):
    columns = ["axis", "axis_name", "axis_pos", "code", "name", "level", "parent"]
    a, b = (sorted(map(tuple, f.select(*columns).collect()), key=str) for f in (meta_class_rows(landed(P.describe())), class_rows(landed(page(tons(1))))))
    assert a == b and meta_class_rows(landed(P.describe(status=300))).count() == 0


@pytest.mark.parametrize("record, flat", [
    ({"@k": "9", "NAME": {"@code": "n1", "$": "Pier"}}, {"k": "9", "NAME_code": "n1", "NAME": "Pier"}),
    ({"LIST": {"ITEM": [{"@k": "a"}, {"@k": None}]}}, {"LIST_ITEM_1_k": "a", "LIST_ITEM_2_k": None}),
    ({"EMPTY": {}, "NONE": [], "N": 4}, {"N": "4"}),
    ({"$": "bare"}, {"value": "bare"}),
])
def test_flat_paths(spark, record, flat):
    df = spark.createDataFrame([(3, json.dumps(record))], "row_id int, record string")
    assert {r["path"]: r["value"] for r in rows(flatten_json(df))} == flat


def listing(entries, kind="list", status=0):
    root, inside = (("GET_STATS_LIST", {"DATALIST_INF": {"NUMBER": len(entries), "TABLE_INF": P.one_or_many(entries)}}) if kind == "list" else
                    ("GET_DATA_CATALOG", {"DATA_CATALOG_LIST_INF": {"DATA_CATALOG_INF": P.one_or_many(entries)}}))
    return json.dumps({root: {"RESULT": {"STATUS": status, "ERROR_MSG": ""}, **(inside if status == 0 else {})}})


def test_one_catalogue_row_a_record_with_or_without_ids(spark, landed):
    entries = [{"@id": "k1", "TITLE": "a"}, {"@id": "k1", "TITLE": "b"}, {"TITLE": "c"}, {"TITLE": "d", "NOTE": {"$": "x"}}]
    wide = rows(flatten_wide(flatten_json(catalog_records(landed(listing(entries[:3]), listing(entries[3:]))))))
    assert sorted((r["TITLE"], r["id"], r["NOTE"]) for r in wide) == [("a", "k1", None), ("b", "k1", None), ("c", None, None), ("d", None, "x")]
    twice = spark.createDataFrame([(n, listing(entries)) for n in (1, 2)], "page_no int, body string")
    assert catalog_records(twice).select("row_id").distinct().count() == 8
    assert catalog_records(landed(listing(entries, status=200))).count() == 0


def test_file_catalogue_numbers_its_files(landed):
    entry = {"@id": "d9", "FILES": {"FILE": [{"URL": "u/1"}, {"URL": "u/2"}]}}
    long = flatten_json(catalog_records(landed(listing([entry], "catalog")), kind="catalog"))
    assert {r["path"]: r["value"] for r in rows(long.where(F.col("path") != "id"))} == {"FILES_FILE_1_URL": "u/1", "FILES_FILE_2_URL": "u/2"}
