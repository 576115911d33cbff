"""Lists that are ranked by rulers."""

from pyspark.sql import functions as F

from statlake.operators import intervals

WALK = "id long, next long, ahead long"


def test_rulers_rank_a_long_list_and_leave_cycles_out(spark, monkeypatch):
    monkeypatch.setattr(intervals, "SHORT", 40)
    monkeypatch.setattr(intervals, "RULER", 4)
    line = [(i * 7, (i + 1) * 7 if i < 399 else None, i % 3) for i in range(400)]
    ring = [(100_001 + i, 100_001 + (i + 1) % 30, 1) for i in range(30)]
    lead = [(200_001, 100_001, 1), (300_001, None, 5)]
    got = {r["id"]: r["ahead"] for r in intervals._ranked(spark.createDataFrame(line + ring + lead, WALK)).collect()}
    assert got == {i * 7: sum(k % 3 for k in range(i, 400)) for i in range(400)} | {300_001: 5}


def test_a_walk_handles_few_rows_a_round(spark, monkeypatch):
    """After a few rounds only the rows that have not met a ruler are written."""
    written, plain = [], intervals.cut_lineage

    def counted(df, name="cut"):
        out = plain(df, name)
        if name == "walk":
            written.append(out.count())
        return out

    monkeypatch.setattr(intervals, "cut_lineage", counted)
    monkeypatch.setattr(intervals, "SHORT", 500)
    n = 4000
    walk = spark.range(n).select("id", F.when(F.col("id") < n - 1, F.col("id") + 1).alias("next"), F.lit(1).cast("long").alias("ahead"))
    got = intervals._ranked(walk).agg(F.sum("ahead"), F.count("*")).first()
    assert tuple(got) == (n * (n + 1) // 2, n)
    assert sum(written) < 6 * n  # each of 13 rounds wrote all rows before
