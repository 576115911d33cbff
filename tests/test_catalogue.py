"""Search over the catalogue."""

import itertools

import pytest
from pages import rows

from statlake.operators.quality import InvalidArgument
from statlake.operators.search import SEARCH_COLUMNS, collapse_date_range, parse_keyword, reorder_search_columns, search_catalog, search_tables

ENTRIES = [  # id, title, statistics, code, office, office code, surveyed, updated, kind
    ("k1", "Grain by quay", "Harbour survey", "00900101", "Port office", "00900", "2015", "2021-06-01", "1"),
    ("k2", "Timber by ship", "Harbour survey", "00900102", "Port office", "00900", "201507", "2022-01-31", "2"),
    ("k3", "Grain by ship", "River survey", "00910101", "Canal office", "00910", "199912", "2019-12-31", "1"),
    ("k4", None, "River count", "00910102", "Canal office", "00910", None, None, "1"),
]


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame(ENTRIES, "id string, TITLE string, STAT_NAME string, STAT_NAME_code string, GOV_ORG string, GOV_ORG_code string, "
                                          "SURVEY_DATE string, UPDATED_DATE string, SEARCH_KIND string")


@pytest.mark.parametrize("filters, found", [
    ({"keyword": "grain"}, "k1 k3"), ({"keyword": "GRAIN ship"}, "k3"), ({"keyword": "grain AND quay"}, "k1"), ({"keyword": "quay OR timber"}, "k1 k2"),
    ({"keyword": "grain AND quay OR river"}, "k1 k3 k4"), ({"keyword": "river OR grain AND quay"}, "k1 k3 k4"), ({"keyword": " "}, "k1 k2 k3 k4"),
    ({"stats_code": "00900"}, "k1 k2"), ({"stats_code": "00910101"}, "k3"), ({"gov_org": "00910"}, "k3 k4"), ({"search_kind": "2"}, "k2"),
    ({"survey_years": "2015"}, "k1 k2"), ({"survey_years": "201501-201512"}, "k2"), ({"survey_years": "201500-201512"}, "k1 k2"), ({"survey_years": "1999-2014"}, "k3"),
    ({"updated_from": "2021"}, "k1"), ({"updated_from": "2020", "updated_to": "2022"}, "k1 k2"), ({"updated_to": "2019"}, "k3"),
    ({"limit": 2}, "k1 k2"), ({"start_position": 3}, "k3 k4"), ({"start_position": 2, "limit": 2, "search_kind": "1"}, "k3 k4"), ({"limit": 0}, ""),
])
def test_filters(catalogue, filters, found):
    assert sorted(r["id"] for r in rows(search_catalog(catalogue, **filters))) == found.split()


@pytest.mark.parametrize("filters", [{"stats_field": "02"}, {"stats_field": "0201"}, {"open_years": "2020"}, {"search_kind": "3"}, {"limit": -1}, {"stats_code": "1"}])
def test_a_filter_is_never_skipped(catalogue, filters):
    with pytest.raises(InvalidArgument):
        search_catalog(catalogue, **filters)
    if "search_kind" in filters:
        with pytest.raises(InvalidArgument):
            search_catalog(catalogue.drop("SEARCH_KIND"), search_kind="1")


def test_keywords_and_ranges():
    assert parse_keyword("a b AND c OR d") == [["a", "b", "c"], ["d"]] and parse_keyword("  ") == []
    for low, high in itertools.product((None, "2001"), (None, "2009")):
        assert collapse_date_range(low, high) == ("-".join(x for x in (low, high) if x) or None)


def test_friendly_columns_come_first(catalogue):
    found = search_tables(catalogue, keyword="timber")
    front = [c for c in SEARCH_COLUMNS if SEARCH_COLUMNS[c] in catalogue.columns]
    assert found.columns[:len(front)] == front and rows(found)[0]["title"] == "Timber by ship"
    assert reorder_search_columns(catalogue.select("SEARCH_KIND")).columns == ["SEARCH_KIND"]


def test_the_default_limit_is_a_hundred(spark, catalogue):
    many = spark.range(250).selectExpr("lpad(cast(id as string), 4, '0') as id", "'x' as TITLE")
    assert sorted(r["id"] for r in rows(search_tables(many))) == [f"{k:04d}" for k in range(100)]
