"""Union of polygons against areas on a raster and areas known by hand."""

import random

import pytest
from pyspark.sql import functions as F

from statlake.operators import geo

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def features(spark, rows):
    data = [(k, [[[tuple(map(float, p)) for p in ring] for ring in polygon] for polygon in polygons]) for k, polygons in rows]
    return spark.createDataFrame(data, f"area_code string, polygons {POLYGONS}")


def union(spark, rows):
    d = geo.dissolve(features(spark, rows), overlay=True)
    rings = F.flatten(F.col("polygons"))
    stitched = F.aggregate(rings, F.lit(0.0), lambda acc, r: acc + geo.ring_area2(r) / 2)
    return {r["area_code"]: (round(r["area"], 9), round(r["stitched"], 9)) for r in d.select("area_code", "area", stitched.alias("stitched")).collect()}


def test_known_areas(spark):
    half = [(0, 0), (1, 0), (0, 1), (0, 0)]
    rows = [
        ("over", [[box(0, 0, 1, 1)]]), ("over", [[box(0.5, 0, 1, 1)]]),  # half over each other
        ("junction", [[box(0, 0, 2, 1)]]), ("junction", [[box(0, 1, 1, 1)]]), ("junction", [[box(1, 1, 1, 1)]]),  # T-junctions
        ("same", [[box(0, 0, 1, 1)]]), ("same", [[box(0, 0, 1, 1)]]), ("same", [[box(0, 0, 1, 1)[::-1]]]),
        ("inside", [[box(0, 0, 3, 3)]]), ("inside", [[box(1, 1, 1, 1)]]),
        ("hole", [[box(0, 0, 3, 3), box(1, 1, 1, 1)]]), ("hole", [[box(1.5, 1, 0.5, 1)]]),
        ("cross", [[box(0, 1, 3, 1)]]), ("cross", [[box(1, 0, 1, 3)]]),
        ("apart", [[box(0, 0, 1, 1)], [box(5, 5, 2, 1)]]), ("corner", [[box(0, 0, 1, 1)]]), ("corner", [[box(1, 1, 1, 1)]]),
        ("slant", [[half]]), ("slant", [[[(1, 1), (0, 1), (1, 0), (1, 1)]]]), ("slant", [[[(0.5, 0.5), (1.5, 0.5), (0.5, 1.5), (0.5, 0.5)]]]),
        ("frame", [[box(0, 0, 3, 1)]]), ("frame", [[box(0, 2, 3, 1)]]), ("frame", [[box(0, 0, 1, 3)]]), ("frame", [[box(2, 0, 1, 3)]]),
    ]
    want = {"over": 1.5, "junction": 4, "same": 1, "inside": 9, "hole": 8.5, "cross": 5, "apart": 3, "corner": 2, "slant": 1.25, "frame": 8}
    assert union(spark, rows) == {k: (v, v) for k, v in want.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_boxes_equal_their_raster(spark, seed):
    rng, rows, cells = random.Random(seed), [], {}
    for k in ("a", "b", "c"):
        for _ in range(40):
            x, y, w, h = (rng.randrange(24) for _ in range(2)), None, rng.randrange(1, 9), rng.randrange(1, 9)
            x, y = x
            rows.append((k, [[box(x / 4, y / 4, w / 4, h / 4)]]))
            cells.setdefault(k, set()).update((x + i, y + j) for i in range(w) for j in range(h))
    want = {k: len(c) / 16 for k, c in cells.items()}
    assert union(spark, rows) == {k: (v, v) for k, v in want.items()}


def test_tessellation_needs_no_overlay(spark):
    rows = [("t", [[box(i, j, 1, 1)]]) for i in range(4) for j in range(4) if (i, j) != (1, 1)]
    plain = geo.dissolve(features(spark, rows)).first()
    assert union(spark, rows) == {"t": (15.0, 15.0)} and plain["area"] == 15


def test_no_features(spark):
    assert union(spark, []) == {}
