"""Interval labels, totals over code trees, trigram search, sparse pivots."""

import random

import pytest

from statlake.operators.intervals import interval_labels, rollup_totals
from statlake.operators.quality import InvalidArgument
from statlake.operators.search import keyword_predicate
from statlake.operators.search_index import search_indexed, write_index
from statlake.session import scratch_path

CLASSES = "stats_data_id string, lang string, axis string, code string, parent string"


def below(links, code):
    out, todo = set(), [code]
    while todo:
        c = todo.pop()
        out.add(c)
        todo += [k for k, p in links.items() if p == c]
    return out


def test_totals_of_a_random_forest(spark):
    rng = random.Random(3)
    links = {f"n{i}": None if rng.random() < 0.1 else f"n{rng.randrange(i)}" for i in range(1, 60)} | {"n0": None, "stray": "unlisted"}
    rows = [("t", lang, "area", c, p) for lang in ("E", None) for c, p in links.items()]
    classes = spark.createDataFrame(rows + rows[:5], CLASSES)  # an entry that is listed twice is one
    data = [("t", lang, "area", rng.choice([*links, "gone"]), rng.randrange(100)) for lang in ("E", None) for _ in range(300)]
    values = spark.createDataFrame(data, "stats_data_id string, lang string, axis string, code string, v long")
    got = {(r["lang"], r["code"]): (r["n_codes"], r["v"]) for r in rollup_totals(interval_labels(classes), values, ["v"]).collect()}
    links["unlisted"] = None
    assert got == {(lang, c): (len(m := below(links, c)), sum(v for _, k, _, code, v in data if k == lang and code in m)) for lang in ("E", None) for c in links}


def test_chain_of_ten_thousand_codes(spark):
    n = 10_000
    classes = spark.createDataFrame([("t", "E", "a", f"c{i}", f"c{i - 1}" if i else None) for i in range(n)], CLASSES)
    labels = interval_labels(classes)
    got = {r["code"]: (r["first"], r["last"]) for r in labels.collect()}
    assert got == {f"c{i}": (i + 1, n) for i in range(n)}


def test_cycles_have_no_label_and_two_parents_are_an_error(spark):
    rows = [("t", "E", "a", "x", "y"), ("t", "E", "a", "y", "x"), ("t", "E", "a", "under", "x"), ("t", "E", "a", "top", None), ("t", "E", "a", "leaf", "top")]
    assert {r["code"] for r in interval_labels(spark.createDataFrame(rows, CLASSES)).collect()} == {"top", "leaf"}
    with pytest.raises(InvalidArgument, match="more than one parent"):
        interval_labels(spark.createDataFrame([("t", "E", "a", "x", "p"), ("t", "E", "a", "x", "q")], CLASSES))


def test_totals_must_be_exact(spark):
    labels = interval_labels(spark.createDataFrame([("t", "E", "a", "x", None)], CLASSES))
    with pytest.raises(InvalidArgument, match="whole number"):
        rollup_totals(labels, spark.createDataFrame([("t", "E", "a", "x", 1.5)], "stats_data_id string, lang string, axis string, code string, v double"), ["v"])


@pytest.mark.parametrize("keyword", ["river", "RIVER port", "river OR ka", "ka", "port AND ri", "日本 統計", "zzz", "x OR iver", "fish OR river AND flow"])
def test_index_finds_what_a_scan_finds(spark, keyword):
    rows = [("1", "River flow", "port"), ("2", "river", None), ("3", None, None), ("4", "PORT of Ri", "Ka"), ("5", "日本の統計 日本", "x"), ("6", "driver", "airport"), ("7", "ri", "ver port")]
    catalog = spark.createDataFrame(rows, "id string, TITLE string, GOV_ORG string")
    path = scratch_path(spark, "t-index")
    write_index(catalog, path)
    scan = {r["id"] for r in catalog.where(keyword_predicate(catalog, keyword)).collect()}
    assert {r["id"] for r in search_indexed(catalog, path, keyword).collect()} == scan


def test_index_reads_only_the_buckets_of_its_terms(spark):
    from statlake.operators.search_index import candidates

    path = scratch_path(spark, "t-buckets")
    write_index(spark.createDataFrame([(str(i), f"title number {i * 37}") for i in range(500)], "id string, TITLE string"), path)
    plan = candidates(spark, path, "number")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(gram" in plan


def test_sparse_pivot_of_a_hundred_thousand_labels(spark):
    from statlake.operators.pivot import pivot_map, pivot_wide

    rows = spark.range(100_000).selectExpr("id % 3 AS area", "CAST(id AS STRING) AS name", "id AS value")
    got = {r["area"]: (len(r["cells"]), r["cells"][str(r["area"] + 300)]) for r in pivot_map(rows, "name").collect()}
    assert got == {0: (33_334, 300), 1: (33_333, 301), 2: (33_333, 302)}
    with pytest.raises(ValueError, match="pivot_map"):
        pivot_wide(rows, "name")


def test_sparse_pivot_policies(spark):
    from statlake.operators.pivot import pivot_map

    df = spark.createDataFrame([("n", "x", 1), ("n", "x", 2), ("n", None, 5), (None, "y", 7)], "area string, name string, value long")
    cells = lambda **k: {r["area"]: r["cells"] for r in pivot_map(df, "name", **k).collect()}
    assert cells(duplicates="sum") == {"n": {"x": 3, "null": 5}, None: {"y": 7}}
    assert cells(duplicates="count") == {"n": {"x": 2, "null": 1}, None: {"y": 1}}
    with pytest.raises(Exception, match="several values share the cell x"):
        cells()
