"""Decoding, filters, paging, fallback and pivot over landed pages."""

import random

import pages as P
import pytest
from pages import cell, page, rows, tons
from pyspark.sql import functions as F

from statlake.functions.values import split_value_annotation
from statlake.operators.decode import decode_axes, decoded_column_order
from statlake.operators.pivot import DuplicateCellsError, pivot_wide
from statlake.operators.quality import InvalidArgument, classify_status
from statlake.plans.tidy import annotation_counts, coded, tidy
from statlake.sources.responses import class_rows, note_rows, page_info, value_rows

AXES = ["cat01", "area", "time"]


def lake(bodies):
    return value_rows(bodies), class_rows(bodies), note_rows(bodies)


def test_every_cell_gets_its_labels(landed):
    cells = [cell(q, c, y, str(k)) for k, (q, c, y) in enumerate((q, c, y) for q in P.QUAYS for c in P.CARGO for y in P.YEARS)]
    data = tidy(*lake(landed(page(cells)))).data
    assert data.columns == ["area", "area_code", "time", "time_code", "cat01", "cat01_code", "stats_data_id", "unit", "value", "annotation"]
    assert data.schema["area"].metadata == {"label": "Quay"}
    for r in rows(data):
        want = cells[int(r["value"])]
        assert (r["area_code"], r["cat01_code"], r["time_code"]) == (want["@area"], want["@cat01"], want["@time"])
        assert (r["area"], r["cat01"], r["time"]) == (P.QUAYS[want["@area"]], P.CARGO[want["@cat01"]][0], P.YEARS[want["@time"]])


def test_two_tables_with_one_code_of_two_meanings(landed):
    other = P.code_lists(cargo={"g1": ("Gravel", None)})
    bodies = landed(page(tons(1)), page(tons(2), table="0009100008", lists=other), page(tons(3), lang="J", lists=P.code_lists(cargo={"g1": ("Kokumotsu", None)})))
    obs, lists, _ = lake(bodies)
    data = rows(tidy(obs, lists, keep_lineage=True).data)
    assert {(r["stats_data_id"], r["lang"], r["cat01"]) for r in data} == {(P.HARBOUR, "E", "Grain"), ("0009100008", "E", "Gravel"), (P.HARBOUR, "J", "Kokumotsu")}


def test_unlisted_codes_keep_their_rows_and_double_ones_fan_out(spark):
    obs = spark.createDataFrame([("q1",), ("q2",), (None,)], "area string")
    lists = spark.createDataFrame([("area", "Quay", 1, "q1", "one"), ("area", "Quay", 1, "q1", "uno")], "axis string, axis_name string, axis_pos int, code string, name string")
    for bound in (1000, 1):  # broadcast and shuffled
        got = sorted(((r["area_code"], r["area"]) for r in rows(decode_axes(obs, lists, max_broadcast_rows=bound))), key=str)
        assert got == [("q1", "one"), ("q1", "uno"), ("q2", None), (None, None)]


def test_order_of_decoded_columns():
    columns = ["more", "annotation", "value", "unit", "cat02", "cat02_code", "cat01_code", "cat01", "time", "time_code", "area", "area_code"]
    random.Random(1).shuffle(columns)
    got = decoded_column_order(columns, ["cat02", "time", "cat01", "area"])
    assert got == ["area", "area_code", "time", "time_code", "cat02", "cat02_code", "cat01", "cat01_code", "more", "unit", "value", "annotation"]


NUMBERS = {"3": 3.0, " 4\t": 4.0, "-2.50": -2.5, "+.5": 0.5, "6.": 6.0, "7E2": 700.0}
MARKS = ["#", "-", "...", " ", "1 2", "nan", "Infinity", "0x1F", "8f", "1,000"]


def test_cells_are_numbers_or_marks(spark):
    df = spark.createDataFrame([(t,) for t in [*NUMBERS, *MARKS, "", None]], "value string").withColumn("text", F.col("value"))
    for r in rows(split_value_annotation(df)):
        assert r["value"] == NUMBERS.get(r["text"])
        assert r["annotation"] == (r["text"] if r["text"] in MARKS else None)
    added = split_value_annotation(spark.createDataFrame([(1,)], "k int"))
    assert dict(added.dtypes) == {"k": "int", "value": "double", "annotation": "string"}


def test_coded_rows(landed):
    obs, lists, notes = lake(landed(page(tons("12", "#"))))
    plain = coded(obs, axes=AXES)
    assert plain.columns == [*AXES, "unit", "value"] and sorted(r["value"] for r in rows(plain)) == ["#", "12"]
    split = tidy(obs, lists, notes, decode_labels=False, axes=AXES).data
    assert sorted(((r["cat01"], r["value"], r["annotation"]) for r in rows(split)), key=str) == [("g1", 12.0, None), ("g1", None, "#")]
    none = tidy(obs.where(F.lit(False)), lists, notes).data
    assert none.count() == 0 and "cat01_code" in none.columns


@pytest.mark.parametrize("start, limit", [(1, None), (3, None), (1, 2), (2, 2), (3, 0), (9, 5), (1, 200_000), (2, 200_000)])
def test_start_and_limit_count_matches_of_each_pull(landed, start, limit):
    tables = {P.HARBOUR: range(1, 13), "0009100008": range(101, 106)}
    bodies = [page([cell(text=str(k), cargo="g2" if k % 2 else "g1") for k in ks[s:s + 4]], table=t, start=s + 1, total=len(ks))
              for t, ks in ((t, list(ks)) for t, ks in tables.items()) for s in range(0, len(ks), 4)]
    obs = value_rows(landed(*bodies))
    got = tidy(obs, codes={"cat01": ["g1"]}, decode_labels=False, axes=AXES, start_position=start, limit=limit).data
    want = [float(k) for ks in tables.values() for k in [k for k in ks if k % 2 == 0][start - 1:None if limit is None else start - 1 + limit]]
    assert sorted(r["value"] for r in rows(got)) == sorted(want)


def test_windows_and_wrong_arguments(landed):
    obs = value_rows(landed(page([cell(year=y, text=str(k)) for k, y in enumerate(P.YEARS)])))
    assert [r["value"] for r in rows(tidy(obs, decode_labels=False, axes=AXES, time_from="1908000000").data)] == [1.0]
    assert [r["value"] for r in rows(tidy(obs, decode_labels=False, axes=AXES, time_to="1907999999").data)] == [0.0]
    for wrong in ({"start_position": 0}, {"limit": -1}, {"geometry": obs, "decode_labels": False}):
        with pytest.raises(InvalidArgument):
            tidy(obs, **wrong)


def test_marks_are_counted_with_the_legend_of_their_own_table(landed):
    bodies = landed(page(tons("#", "#", "4")), page(tons("#", "?"), table="0009100008", legend=(("#", "guess"),)))
    obs, _, notes = lake(bodies)
    data = tidy(obs, decode_labels=False, axes=AXES, keep_lineage=True).data
    got = {(r["stats_data_id"], r["annotation"]): (r["n"], r["note"]) for r in rows(annotation_counts(data, notes))}
    assert got == {(P.HARBOUR, "#"): (2, "estimate"), ("0009100008", "#"): (1, "guess"), ("0009100008", "?"): (1, None)}


def test_fallback_stops_at_errors_of_the_service(landed):
    def table(k):
        return f"00091001{k:02d}"
    bodies = landed(page(tons(1), table=table(1)), page(tons(2), table=table(1), lang="J"), page([], table=table(2), status=200), page(tons(3), table=table(2), lang="J"),
                    page([], table=table(3), status=500), page(tons(4), table=table(3), lang="J"), page(tons(5), table=table(4), lang="J"))
    statuses = classify_status(page_info(bodies))
    got = rows(tidy(value_rows(bodies), lang="E", fallback_lang="J", pages=statuses, decode_labels=False, axes=AXES, keep_lineage=True).data)
    assert sorted((r["stats_data_id"], r["lang"], r["value"]) for r in got) == [(table(1), "E", 1.0), (table(2), "J", 3.0), (table(4), "J", 5.0)]


def test_pivot(landed, spark):
    cells = [cell(cargo=c, quay=q, text=str(k)) for k, (c, q) in enumerate((c, q) for c in P.CARGO for q in P.QUAYS)]
    wide = {r["area"]: r for r in rows(pivot_wide(tidy(*lake(landed(page(cells)))).data, "cat01"))}
    assert {q: [wide[q][n] for n, _ in P.CARGO.values()] for q in wide} == {"North quay": [0.0, 2.0, 4.0], "South quay": [1.0, 3.0, 5.0]}
    long = spark.createDataFrame([("n", "x", 2.0), ("n", "x", 5.0), ("s", "y", 1.0)], "area string, cat01 string, value double")
    with pytest.raises(DuplicateCellsError):
        pivot_wide(long, "cat01")
    assert {r["area"]: (r["x"], r["y"]) for r in rows(pivot_wide(long, "cat01", duplicates="count"))} == {"n": (2, 0), "s": (0, 1)}
    assert {r["area"]: (r["x"], r["y"]) for r in rows(pivot_wide(long, "cat01", duplicates="sum"))} == {"n": (7.0, None), "s": (None, 1.0)}
    for wrong in (("zone", {}), ("cat01", {"values_from": "weight"}), ("cat01", {"id_cols": ["zone"]})):
        with pytest.raises(ValueError):
            pivot_wide(long, wrong[0], **wrong[1])
