import os

import pages as P
import pytest
from pages import page, rows, tons
from statlake.session import scratch_path
from statlake.streaming.ingest import ingest_batch, read_observations, read_quarantine, start_ingest


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text.replace(", ", ",\n"))  # landed bodies are often pretty-printed


def test_stream_ingest_exactly_once_and_resume(spark):
    base = scratch_path(spark, "t-stream").replace("file:", "")
    landing, target, ckpt = f"{base}/landing", f"{base}/target", f"{base}/ckpt"
    first, second = page(tons(1, 2, 3), total=6, go_on=True), page(tons(4, 5, 6), start=4, total=6)
    _write(landing, "a.json", first)
    start_ingest(spark, landing, target, ckpt).awaitTermination()
    assert read_observations(spark, target).count() == 3
    _write(landing, "b.json", first)  # the same page again, a new one, and one that failed
    _write(landing, "c.json", second)
    _write(landing, "d.json", page([], status=500, message="appId=SECRET"))
    start_ingest(spark, landing, target, ckpt).awaitTermination()
    assert sorted(int(r["value"]) for r in rows(read_observations(spark, target))) == [1, 2, 3, 4, 5, 6]
    left = rows(read_quarantine(spark, f"{target}-quarantine"))
    assert [(r["reason"], "SECRET" in r["error_msg"]) for r in left] == [("server", False)]


def test_identity_of_the_landing_folders(spark):
    base = scratch_path(spark, "t-folders").replace("file:", "")
    for turn in (1, 2):  # the second run finds the page landed again
        _write(f"{base}/landing/stats_data_id={P.HARBOUR}/lang=E", f"{turn}.json", page(tons(8), named=False))
        start_ingest(spark, f"{base}/landing", f"{base}/target", f"{base}/ckpt", identity=["stats_data_id", "lang"]).awaitTermination()
        assert [(r["stats_data_id"], r["lang"], r["value"]) for r in rows(read_observations(spark, f"{base}/target"))] == [(P.HARBOUR, "E", "8")]


@pytest.mark.parametrize("turns", [1, 3])
def test_replays_with_null_keys_add_nothing(spark, landed, turns):
    base = scratch_path(spark, "t-replay")
    batch = landed(page(tons(1, 2), lang=None), page(tons(7), named=False), "<html/>")
    for _ in range(turns):
        ingest_batch(batch, f"{base}/target", f"{base}/left")
    assert sorted(r["value"] for r in rows(read_observations(spark, f"{base}/target"))) == ["1", "2"]
    assert sorted(r["reason"] for r in rows(read_quarantine(spark, f"{base}/left"))) == ["no_page_key", "parse_error"]


def test_entry_and_registry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    cols = df.columns
    assert cols[:4] == ["area", "area_code", "time", "time_code"]
