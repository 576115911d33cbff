"""Property checks against brute force on small random fixtures."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from statlake.functions.values import NUMERIC_PATTERN, split_value_annotation
from statlake.operators import geo

NUM = re.compile(NUMERIC_PATTERN)

cells = st.one_of(
    st.none(),
    st.text(alphabet=" \t0123456789.+-eEx*", max_size=8),
    st.sampled_from(["-", "***", "X", "…", "NaN", "Inf", "1d", "0x1", "", "  ", "１２"]),
)


def brute(raw):
    if raw is None or raw == "":
        return None, None
    if NUM.match(raw):
        return float(raw.strip()), None
    return None, raw


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(cells, min_size=1, max_size=60))
def test_value_split_matches_brute_force(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, value string")
    got = {r.i: (r.value, r.annotation) for r in split_value_annotation(df).collect()}
    assert got == {i: brute(r) for i, r in enumerate(raws)}


SA = ("KEY_CODE string, PREF string, CITY string, PREF_NAME string, CITY_NAME string, S_NAME string, "
      "polygons array<array<array<struct<x:double,y:double>>>>")


def sq(x, y):
    x, y = float(x), float(y)
    return [[[(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]]]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.tuples(st.integers(0, 5), st.integers(0, 5), st.sampled_from(["201", "202"])),
               min_size=1, max_size=25))
def test_dissolve_area_and_rings_match_cell_count(spark, cells3):
    # one city per grid cell (first city wins for a cell)
    by_cell = {}
    for x, y, c in sorted(cells3):
        by_cell.setdefault((x, y), c)
    rows = [(f"99{c}{i:04d}", "99", c, "県", f"市{c}", "町", sq(x, y)) for i, ((x, y), c) in enumerate(by_cell.items())]
    b = geo.boundaries(spark.createDataFrame(rows, SA), "municipality", "ward").collect()
    expect = {}
    for (_, _), c in by_cell.items():
        expect[f"99{c}"] = expect.get(f"99{c}", 0) + 1
    assert {r.area_code: r.area for r in b} == {k: float(v) for k, v in expect.items()}
    for r in b:
        total = 0.0
        for poly in r.polygons:
            for ring in poly:
                total += sum(ring[i].x * ring[i + 1].y - ring[i + 1].x * ring[i].y for i in range(len(ring) - 1)) / 2
        assert abs(total - r.area) < 1e-9


# ---------------------------------------------------------------------------
# flatten_json against a direct implementation of the five shape rules
# ---------------------------------------------------------------------------

import json  # noqa: E402

from statlake.sources.flatten import flatten_json  # noqa: E402


def rules_flatten(node, path=""):
    """Leaves as (path, text): keys joined by "_", leading "@" dropped, "$"
    takes the parent's name, array items numbered from 1, null kept, empty
    containers dropped; the root "$" is "value"."""
    out = []
    if isinstance(node, dict):
        for k, v in node.items():
            seg = None if k == "$" else (k[1:] if k.startswith("@") else k)
            out += rules_flatten(v, "_".join(p for p in (path, seg) if p))
    elif isinstance(node, list):
        for i, v in enumerate(node, start=1):
            out += rules_flatten(v, "_".join(p for p in (path, str(i)) if p))
    else:
        text = None if node is None else (("true" if node else "false") if isinstance(node, bool) else str(node))
        out.append((path or "value", text))
    return out


leaf = st.one_of(st.none(), st.booleans(), st.integers(-1000, 1000), st.text(alphabet="abcxyz", max_size=4))
tree = st.recursive(
    leaf,
    lambda kids: st.one_of(st.lists(kids, max_size=3),
                           st.dictionaries(st.sampled_from(["@id", "name", "$", "v"]), kids, max_size=3)),
    max_leaves=8,
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.sampled_from(["@id", "name", "$", "v"]), tree, min_size=1, max_size=3),
                min_size=1, max_size=8))
def test_flatten_json_matches_rules(spark, records):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "row_id int, record string")
    got = sorted((r.row_id, r.path, r.value) for r in flatten_json(df, max_depth=12).collect())
    want = sorted((i, p, v) for i, r in enumerate(records) for p, v in rules_flatten(r))
    assert got == want
