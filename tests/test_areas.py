"""Small areas: keys, dissolving, roll-ups, joins to data."""

import random

import pytest
from pages import rows
from pyspark.sql import functions as F

from statlake.operators import geo
from statlake.operators.hierarchy import axis_cycles, axis_hierarchy
from statlake.operators.quality import InvalidArgument
from statlake.plans.reference import UnknownCuratedTable, curated_tables, designated_cities, lookup_curated, lookup_curated_id, prefectures

PLOT = ("KEY_CODE string, PREF string, CITY string, PREF_NAME string, CITY_NAME string, S_NAME string, "
        "polygons array<array<array<struct<x:double,y:double>>>>")


def unit(x, y):
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    return [[[(float(x + a), float(y + b)) for a, b in corners]]]


def plots(spark, cells):
    """``{(x, y): (pref, city)}`` as one unit square each."""
    data = [(f"{p}{c}{k:04d}", p, c, f"pref {p}", f"city {p}{c}", f"plot {k}", unit(x, y)) for k, ((x, y), (p, c)) in enumerate(sorted(cells.items()))]
    return spark.createDataFrame(data, PLOT)


def shoelace(ring):
    return sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(ring, ring[1:], strict=False)) / 2


@pytest.mark.parametrize("seed", range(3))
def test_dissolved_rings_enclose_the_cells(spark, seed):
    rnd = random.Random(seed)
    cells = {(x, y): ("47", rnd.choice(["310", "311"])) for x in range(6) for y in range(6) if rnd.random() < 0.7}
    got = {r["area_code"]: r for r in rows(geo.boundaries(plots(spark, cells), "municipality", "ward"))}
    for city in ("310", "311"):
        mine = [k for k, v in cells.items() if v[1] == city]
        r = got[f"47{city}"]
        assert r["area"] == len(mine) and r["CITY_NAME"] == f"city 47{city}"
        assert sum(abs(shoelace(p[0])) - sum(abs(shoelace(h)) for h in p[1:]) for p in r["polygons"]) == len(mine)


def test_levels_of_dissolving(spark):
    cells = {(0, 0): ("46", "321"), (1, 0): ("46", "321"), (5, 5): ("46", "322")}
    codes = {level: {r["area_code"]: r["area"] for r in rows(geo.boundaries(plots(spark, cells), level, with_geometry=False))} for level in ("prefecture", "municipality", "small_area")}
    assert codes["prefecture"] == {"46000": 3.0} and codes["municipality"] == {"46321": 2.0, "46322": 1.0}
    assert sorted(codes["small_area"].values()) == [1.0] * 3
    for wrong in ({"areas": ["60"]}, {"areas": ["00"]}, {"year": 1890}):
        with pytest.raises(InvalidArgument):
            geo.boundaries(plots(spark, cells), **wrong)


def test_rings_with_holes_islands_and_single_shared_points(spark):
    frame = {(x, y): ("46", "330") for x in range(7) for y in range(7) if x in (0, 6) or y in (0, 6)}
    frame[3, 3] = ("46", "330")
    touching = {(20, 20): ("46", "331"), (21, 21): ("46", "331")}
    got = {r["area_code"]: r["polygons"] for r in rows(geo.boundaries(plots(spark, frame | touching), "municipality", "ward"))}
    assert sorted((len(p), abs(shoelace(p[0]))) for p in got["46330"]) == [(1, 1.0), (2, 49.0)]
    assert sorted(abs(shoelace(p[0])) for p in got["46331"]) == [1.0, 1.0]


def test_vertices_of_a_ring_in_order(spark):
    keyed = geo.keyed_small_areas(plots(spark, {(x, 0): ("46", "340") for x in range(4)}), "municipality", "ward")
    found = sorted(rows(geo.ring_vertices(geo.cancel_edges(geo.ring_edges(keyed)))), key=lambda r: r["seq"])
    assert len({str(r["ring_id"]) for r in found}) == 1 and abs(shoelace([*found, found[0]])) == 4.0


def test_rows_that_are_no_land_are_cleaned(spark):
    df = spark.createDataFrame([("461010001", "a", "8101"), ("461010002", "b", "8154"), ("46", "c", "8101"), ("461010003", None, "8101")], "KEY_CODE string, CITY_NAME string, HCODE string")
    assert "461010001" in {r["KEY_CODE"] for r in rows(geo.clean_boundary_rows(df))}
    assert "461010002" not in {r["KEY_CODE"] for r in rows(geo.clean_boundary_rows(df))}


def ward_of(spark):
    """A ward's code and its city's, from the fixed table of cities."""
    r = designated_cities(spark).orderBy(F.col("ward_min").desc()).first()
    return f"{r.ward_min:05d}", r.parent_code


def test_wards_count_towards_their_city(spark):
    ward, city = ward_of(spark)
    data = spark.createDataFrame([(ward, 2.0), (ward, 3.0), ("46399", 7.0), ("none", 1.0), (None, 5.0)], "area_code string, v double")
    for mode, want in (("both", {ward: 5.0, city: 5.0, "46399": 7.0, "none": 1.0, None: 5.0}), ("city", {city: 5.0, "46399": 7.0, "none": 1.0, None: 5.0}),
                       ("ward", {ward: 5.0, "46399": 7.0, "none": 1.0, None: 5.0})):
        assert {r["area_code"]: r["s"] for r in rows(geo.rollup_measure(data, [F.sum("v").alias("s")], mode=mode))} == want
    cells = {(0, 0): (ward[:2], ward[2:]), (1, 0): (ward[:2], "399")}
    names = {mode: {r["area_code"]: r["area"] for r in rows(geo.boundaries(plots(spark, cells), "municipality", mode, with_geometry=False))} for mode in ("both", "city", "ward")}
    assert names["both"] == {ward: 1.0, city: 1.0, f"{ward[:2]}399": 1.0}
    assert names["city"] == {city: 1.0, f"{ward[:2]}399": 1.0} and names["ward"] == {ward: 1.0, f"{ward[:2]}399": 1.0}


def test_geometry_joins_every_row(spark):
    bounds = geo.boundaries(plots(spark, {(0, 0): ("46", "350"), (4, 0): ("46", "351")}), "municipality")
    data = spark.createDataFrame([("46350", 1), ("46350", 2), ("46351", 3), ("46352", 4), (None, 5)], "area_code string, k int")
    joined, missing = geo.join_geometry(data, bounds)
    assert {r["k"]: r["polygons"] is not None for r in rows(joined)} == {1: True, 2: True, 3: True, 4: False, 5: False}
    assert [r["area_code"] for r in rows(missing)] == ["46352"]
    with pytest.raises(InvalidArgument):
        geo.join_geometry(data.drop("area_code"), bounds)


def test_level_is_inferred_and_prefectures_resolved(spark):
    def codes(*values):
        return spark.createDataFrame([(v,) for v in values], "area_code string")
    assert geo.infer_level(codes("46000", "05000")) == "prefecture"
    assert geo.infer_level(codes("46000", "46350")) == geo.infer_level(codes("46350").where("false")) == "municipality"
    found = {r["pref"]: r["valid"] for r in rows(geo.resolve_prefectures(codes("46000", "46350", "05201", "00000", "60001")))}
    assert found == {"46": True, "05": True, "00": False, "60": False}


def test_fixed_tables(spark):
    p = rows(prefectures(spark))
    assert sorted(int(r["code"]) for r in p) == list(range(1, 48)) and all(r["area_code"] == r["code"] + "000" for r in p)
    wards = sorted((r["ward_min"], r["ward_max"]) for r in rows(designated_cities(spark)))
    assert len(wards) == 21 and all(a <= b for a, b in wards) and all(b < c for (_, b), (c, _) in zip(wards, wards[1:], strict=False))
    known = {r["key"]: r["stats_data_id"] for r in rows(curated_tables(spark))}
    assert {k: lookup_curated_id(k) for k in known} == known
    for wrong, error in (("tide_tables", UnknownCuratedTable), (7, TypeError)):
        with pytest.raises(error):
            lookup_curated_id(wrong)
    asked = spark.createDataFrame([(k,) for k in [*known, "tide_tables"]], "key string")
    assert {r["key"]: r["status"] for r in rows(lookup_curated(asked))} == {**dict.fromkeys(known, "ok"), "tide_tables": "unknown"}


def tree(spark, links):
    return spark.createDataFrame([("t", "E", "area", c, p) for c, p in links], "stats_data_id string, lang string, axis string, code string, parent string")


def test_ancestors_at_any_depth(spark):
    got = {(r["code"], r["ancestor"]): r["depth"] for r in rows(axis_hierarchy(tree(spark, [("c0", None)] + [(f"c{k + 1}", f"c{k}") for k in range(40)])))}
    assert got == {(f"c{a}", f"c{b}"): a - b for a in range(41) for b in range(a)}


def test_cycles_are_reported_and_end(spark):
    links = tree(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("s", "s")])
    assert {(r["code"], r["length"]) for r in rows(axis_cycles(links))} == {("a", 3), ("b", 3), ("c", 3), ("s", 1)}
    assert {(r["code"], r["ancestor"]) for r in rows(axis_hierarchy(links))} == {("a", "b"), ("a", "c"), ("b", "c"), ("b", "a"), ("c", "a"), ("c", "b"), ("x", "a"), ("x", "b"), ("x", "c")}
