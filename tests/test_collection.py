"""Landing and streaming once, pages of mixed sizes, pages without a language."""

import random

import pages as P
from pages import page, rows, tons
from statlake.operators.paging import landed_ranges, missing_ranges, plan_ranges
from statlake.plans.lake import land_responses, read_lake
from statlake.plans.tidy import tidy
from statlake.session import scratch_path
from statlake.sources.responses import class_rows, value_rows
from statlake.streaming.ingest import ingest_batch, read_observations, start_ingest


def test_doubled_pages_and_failures_land_once(spark, landed):
    base = scratch_path(spark, "t-doubled")
    good, bad = page(tons(1, 2)), page([], status=500)
    for _ in range(3):
        land_responses(landed(good, good, bad, bad, "<html/>", "<html/>", None, None), base)
    lake = read_lake(spark, base)
    assert sorted(r["value"] for r in rows(lake["observations"])) == ["1", "2"]
    assert lake["manifest"].count() == 1
    assert sorted(r["reason"] for r in rows(lake["failed"])) == ["parse_error", "parse_error", "server"]


def test_a_landing_of_known_pages_only(spark, landed):
    base = scratch_path(spark, "t-known")
    for _ in range(2):
        land_responses(landed(page(tons(1), lang=None)), base)  # no language: null is a value of the key
    assert read_lake(spark, base)["observations"].count() == 1


def _land(folder, name, text):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_stream_reads_nothing_of_its_target(spark):
    """The rows of earlier epochs may be gone: pages that came before still add nothing."""
    import shutil

    base = scratch_path(spark, "t-ledger").replace("file:", "")
    run = lambda: start_ingest(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt").awaitTermination()
    first, second = page(tons(1, 2), total=3, go_on=True), page(tons(3), start=3, total=3)
    _land(f"{base}/in", "1.json", first)
    _land(f"{base}/in", "2.json", first)  # doubled in one batch
    run()
    assert sorted(r["value"] for r in rows(read_observations(spark, f"{base}/out"))) == ["1", "2"]
    shutil.move(f"{base}/out", f"{base}/archive")
    _land(f"{base}/in", "3.json", second)
    _land(f"{base}/in", "4.json", first)  # again, after a later page
    run()
    assert sorted(r["value"] for r in rows(read_observations(spark, f"{base}/out"))) == ["3"]


def test_a_batch_cut_short_is_completed_by_the_same_call(spark, landed):
    import shutil

    base = scratch_path(spark, "t-cut").replace("file:", "")
    batch = landed(page(tons(1, 2)))
    ingest_batch(batch, f"{base}/out", f"{base}/left")
    shutil.move(f"{base}/out-ledger", f"{base}/lost")  # as if it had ended before the ledger was written
    ingest_batch(batch, f"{base}/out", f"{base}/left")
    assert sorted(r["value"] for r in rows(read_observations(spark, f"{base}/out"))) == ["1", "2"]


def test_pages_without_a_language_get_their_labels(spark, landed):
    bodies = landed(page(tons(5), lang=None), page(tons(7)))
    found = rows(tidy(value_rows(bodies), class_rows(bodies), keep_lineage=True).data)
    assert {(r["lang"], r["area"] is not None, r["cat01"] is not None) for r in found} == {(None, True, True), ("E", True, True)}


def test_ranges_of_mixed_pages(spark):
    rng, have, want = random.Random(8), [], {}
    for t in ("a", "b", None):
        total = rng.randrange(200, 400)
        covered = set()
        for _ in range(25):
            start, size, ok = rng.randrange(1, 420), rng.choice([1, 10, 50]), rng.random() < 0.8
            have.append((t, start, start + size - 1, ok))
            if ok:
                covered |= set(range(start, start + size))
        want[t] = (total, covered)
    have.append(("a", None, None, True))
    manifest = spark.createDataFrame(have, "stats_data_id string, from_number long, to_number long, ok boolean")
    targets = spark.createDataFrame([(t, n) for t, (n, _) in want.items()] + [("none", 30), ("empty", 0)], "stats_data_id string, total_number long")
    keys = ["stats_data_id"]
    got = {}
    for r in landed_ranges(manifest, keys, span=40).collect():
        got.setdefault(r[0], set()).update(range(r["from_number"], r["to_number"] + 1))
    assert got == {t: c for t, (_, c) in want.items()}
    for start, limit in ((1, None), (50, None), (50, 100), (1, 120)):
        gaps = missing_ranges(targets, manifest, keys, start, limit)
        missing, requests = {}, {}
        for r in gaps.collect():
            missing.setdefault(r[0], []).extend(range(r["from_number"], r["to_number"] + 1))
        for r in plan_ranges(gaps, 7, keys).collect():
            assert r["size"] <= 7
            requests.setdefault(r[0], []).extend(range(r["offset"], r["offset"] + r["size"]))
        last = lambda n: n if limit is None else min(n, start + limit - 1)  # noqa: E731, B023
        need = {t: [k for k in range(start, last(n) + 1) if k not in c] for t, (n, c) in (want | {"none": (30, set()), "empty": (0, set())}).items()}
        need = {t: k for t, k in need.items() if k}
        assert {t: sorted(k) for t, k in missing.items()} == need == {t: sorted(k) for t, k in requests.items()}


def test_geometry_options_and_argument_checks(spark, landed):
    import pytest

    from statlake.operators.quality import InvalidArgument

    bodies = landed(page(tons(5)))
    for wrong in ({"stats_data_id": "12x"}, {"stats_data_id": P.HARBOUR, "start_position": 0}, {"geometry": bodies, "geometry_areas": bodies}):
        with pytest.raises(InvalidArgument):
            tidy(value_rows(bodies), class_rows(bodies), **wrong)
