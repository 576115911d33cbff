"""Sorts of one task are bounded, whatever the size of the landed files."""

import pytest

from statlake.operators.paging import take_rows
from statlake.session import partitions_for


def test_limit_of_pulls_is_cut_on_partitions_of_bounded_size(spark):
    rows = spark.range(0, 5000, 1, 1).selectExpr("CAST(id % 2 AS STRING) AS stats_data_id", "id DIV 100 AS page_offset", "CAST(id % 100 AS INT) AS pos")
    got = take_rows(rows, limit=7, start_position=40)
    assert sorted((r["stats_data_id"], r["page_offset"] * 100 + r["pos"]) for r in got.collect()) == sorted(
        (str(k), 2 * i + k) for k in (0, 1) for i in range(39, 46))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_a_far_start_does_not_meet_in_one_task(spark):
    rows = spark.range(0, 9000, 1, 3).selectExpr("CAST(id % 2 AS STRING) AS stats_data_id", "id DIV 100 AS page_offset", "CAST(id % 100 AS INT) AS pos")
    got = take_rows(rows, limit=5, start_position=1200)
    assert sorted((r["stats_data_id"], r["page_offset"] * 100 + r["pos"]) for r in got.collect()) == sorted(
        (str(k), 2 * i + k) for k in (0, 1) for i in range(1199, 1204))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in plan or "WindowGroupLimit" in plan


def test_partitions_follow_the_rows(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with partitions_for(spark, 100):
        assert spark.conf.get(key) == before
    with pytest.raises(KeyError), partitions_for(spark, 50_000_001):
        assert spark.conf.get(key) == "101"
        raise KeyError
    assert spark.conf.get(key) == before
