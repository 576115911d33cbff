"""Boundary geometry without a geometry library.

Polygons are ``array<array<array<struct<x,y>>>>`` (polygons -> rings ->
points; ring 0 of a polygon is its exterior).  Dissolving many small areas
into one area per code is done by *edge cancellation*:

1. every ring is closed and oriented (exterior counter-clockwise, holes
   clockwise) and exploded into directed edges;
2. edges are grouped by ``(area_code, undirected edge)`` and their
   directions summed: an edge shared by two neighbours cancels;
3. the surviving edges are the dissolved boundary.  Its area is a plain
   aggregate (shoelace sum), and the rings are stitched back together with
   distributed pointer jumping (``log2(ring length)`` self-joins) -- no
   group of edges is ever gathered into one task; only a finished ring
   (the output itself) becomes one row.

Exact when neighbours share vertices, as in one tessellation from one
source.  Repair is limited to closing rings and dropping repeated vertices.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.operators.decode import sized_broadcast
from statlake.operators.quality import InvalidArgument
from statlake.plans.reference import PREFECTURES, designated_wards
from statlake.session import cut_lineage

LEVELS = ("municipality", "prefecture", "small_area")
WATER_AREA_CODE = "8154"
PREFECTURE_CODES = [p[0] for p in PREFECTURES]


# ---------------------------------------------------------------------------
# Rows and keys
# ---------------------------------------------------------------------------

def clean_boundary_rows(df: DataFrame) -> DataFrame:
    """Drop placeholder rows (missing/short KEY_CODE, missing CITY_NAME) and
    water survey areas (HCODE 8154)."""
    ok = (
        F.col("KEY_CODE").isNotNull()
        & (F.length(F.col("KEY_CODE").cast("string")) >= 9)
        & F.col("CITY_NAME").isNotNull()
    )
    if "HCODE" in df.columns:
        ok = ok & (F.col("HCODE").isNull() | (F.col("HCODE").cast("string") != WATER_AREA_CODE))
    return df.where(F.coalesce(ok, F.lit(False)))


def boundary_key(level: str) -> Column:
    """Area code of a small-area row at the given level."""
    if level == "prefecture":
        return F.concat(F.substring("PREF", 1, 2), F.lit("000"))
    if level == "municipality":
        return F.concat(F.col("PREF"), F.col("CITY"))
    if level == "small_area":
        return F.col("KEY_CODE").cast("string")
    raise InvalidArgument(f"level must be one of {LEVELS}")


def name_columns(level: str, columns: list[str]) -> list[str]:
    if level == "prefecture":
        wanted = ["PREF_NAME"]
    elif level == "municipality":
        wanted = ["PREF_NAME", "CITY_NAME"]
    else:
        wanted = ["PREF_NAME", "CITY_NAME", "S_NAME"]
    return [c for c in wanted if c in columns]


def resolve_prefectures(codes: DataFrame, col: str = "area_code") -> DataFrame:
    """Distinct two-digit prefixes of the codes with ``valid`` against the 47
    prefectures (``00``, ``48`` and ``99`` are invalid)."""
    pref = F.substring(F.col(col).cast("string"), 1, 2)
    return (
        codes.select(pref.alias("pref")).where(F.col("pref").isNotNull()).distinct()
        .withColumn("valid", F.col("pref").isin(PREFECTURE_CODES))
    )


def level_of(col: str = "area_code") -> Column:
    """Aggregate expression: the geometry level implied by a set of codes."""
    c = F.col(col)
    all_pref = F.coalesce(F.bool_and(F.when(c.isNotNull(), c.endswith("000"))), F.lit(False))
    return F.when(all_pref, F.lit("prefecture")).otherwise(F.lit("municipality"))


def infer_level(data: DataFrame, col: str = "area_code") -> str:
    """``prefecture`` when every non-null code ends in ``000`` (and there is
    at least one), else ``municipality``.  One aggregate job."""
    row = data.where(F.col(col).isNotNull()).agg(
        F.coalesce(F.bool_and(F.col(col).endswith("000")), F.lit(False)).alias("p")
    ).first()
    return "prefecture" if row["p"] else "municipality"


# ---------------------------------------------------------------------------
# Rings and edges
# ---------------------------------------------------------------------------

def _pt(ring: Column, i: Column) -> Column:
    return F.get(ring, i)


def ring_area2(ring: Column) -> Column:
    """Twice the signed area of a closed ring (shoelace)."""
    return F.aggregate(
        F.sequence(F.lit(0), F.size(ring) - 2),
        F.lit(0.0),
        lambda acc, i: acc + (_pt(ring, i)["x"] * _pt(ring, i + 1)["y"]
                              - _pt(ring, i + 1)["x"] * _pt(ring, i)["y"]),
    )


def close_ring(ring: Column) -> Column:
    """Drop repeated consecutive vertices and close the ring."""
    dedup = F.filter(ring, lambda p, i: (i == 0) | (p != F.get(ring, i - 1)))
    return F.when(F.get(dedup, 0) != F.element_at(dedup, -1),
                  F.concat(dedup, F.array(F.get(dedup, 0)))).otherwise(dedup)


def ring_edges(features: DataFrame, key: str = "area_code", geom_col: str = "polygons") -> DataFrame:
    """Oriented directed edges ``(key, sx, sy, ex, ey)`` of every ring."""
    polys = features.select(key, F.posexplode(geom_col).alias("poly_idx", "poly"))
    rings = polys.select(key, F.posexplode("poly").alias("ring_idx", "ring"))
    rings = rings.withColumn("ring", close_ring(F.col("ring"))).where(F.size("ring") >= 4)
    a2 = ring_area2(F.col("ring"))
    flip = ((F.col("ring_idx") == 0) & (a2 < 0)) | ((F.col("ring_idx") > 0) & (a2 > 0))
    rings = rings.withColumn("ring", F.when(flip, F.reverse("ring")).otherwise(F.col("ring")))
    edges = rings.select(
        key,
        F.explode(F.transform(
            F.sequence(F.lit(0), F.size("ring") - 2),
            lambda i: F.struct(_pt(F.col("ring"), i).alias("s"), _pt(F.col("ring"), i + 1).alias("e")),
        )).alias("edge"),
    )
    return edges.select(
        key,
        F.col("edge.s.x").alias("sx"), F.col("edge.s.y").alias("sy"),
        F.col("edge.e.x").alias("ex"), F.col("edge.e.y").alias("ey"),
    ).where((F.col("sx") != F.col("ex")) | (F.col("sy") != F.col("ey")))


def cancel_edges(edges: DataFrame, key: str = "area_code") -> DataFrame:
    """Sum opposite directions of each undirected edge per key; keep the
    boundary (``w`` != 0) as directed edges.  ``|w| > 1`` means overlapping
    input polygons.  Partial aggregation: hot keys reduce map-side."""
    fwd = (F.col("sx") < F.col("ex")) | ((F.col("sx") == F.col("ex")) & (F.col("sy") < F.col("ey")))
    canon = edges.select(
        key,
        F.when(fwd, F.col("sx")).otherwise(F.col("ex")).alias("ax"),
        F.when(fwd, F.col("sy")).otherwise(F.col("ey")).alias("ay"),
        F.when(fwd, F.col("ex")).otherwise(F.col("sx")).alias("bx"),
        F.when(fwd, F.col("ey")).otherwise(F.col("sy")).alias("by"),
        F.when(fwd, F.lit(1)).otherwise(F.lit(-1)).alias("d"),
    )
    summed = canon.groupBy(key, "ax", "ay", "bx", "by").agg(F.sum("d").alias("w")).where(F.col("w") != 0)
    pos = F.col("w") > 0
    return summed.select(
        key,
        F.when(pos, F.col("ax")).otherwise(F.col("bx")).alias("sx"),
        F.when(pos, F.col("ay")).otherwise(F.col("by")).alias("sy"),
        F.when(pos, F.col("bx")).otherwise(F.col("ax")).alias("ex"),
        F.when(pos, F.col("by")).otherwise(F.col("ay")).alias("ey"),
        F.abs("w").alias("w"),
    )


def boundary_area(boundary: DataFrame, key: str = "area_code") -> DataFrame:
    """Area enclosed by directed boundary edges (planar units), plus an
    ``overlap`` flag for edges used more than once."""
    cross = F.col("sx") * F.col("ey") - F.col("ex") * F.col("sy")
    return boundary.groupBy(key).agg(
        (F.sum(cross * F.col("w")) / 2).alias("area"),
        F.max(F.col("w") > 1).alias("overlap"),
        F.count(F.lit(1)).alias("n_edges"),
    )


def polygon_area(features: DataFrame, key: str = "area_code", geom_col: str = "polygons") -> DataFrame:
    """Sum of the parts' areas per key (the dissolve invariant's other side)."""
    e = ring_edges(features, key, geom_col)
    cross = F.col("sx") * F.col("ey") - F.col("ex") * F.col("sy")
    return e.groupBy(key).agg((F.sum(cross) / 2).alias("parts_area"))


# ---------------------------------------------------------------------------
# Ring stitching by pointer jumping
# ---------------------------------------------------------------------------

def _rounds(edges: DataFrame, key: str) -> int:
    """Doubling rounds needed: log2 of the largest edge count of one key."""
    row = edges.groupBy(key).count().agg(F.max("count").alias("m")).first()
    m = row["m"] or 1
    return max(1, math.ceil(math.log2(max(m, 2)))) + 1


def _ckpt(df: DataFrame, i: int, every: int = 1) -> DataFrame:
    """Each doubling round self-joins its input, so without a cut the plan
    doubles per round."""
    return cut_lineage(df) if (i + 1) % every == 0 else df


def stitch_rings(boundary: DataFrame, key: str = "area_code") -> DataFrame:
    """Directed boundary edges -> closed rings ``(key, ring_id, ring, area)``
    (one array row per ring; see ``ring_vertices`` for the long form)."""
    rank = _ring_ranks(boundary, key)
    pts = rank.groupBy(key, "lab").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("r")).alias("o"),
                                             F.col("id.sx").alias("x"), F.col("id.sy").alias("y")))).alias("p"))
    ring = F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    out = pts.select(key, F.col("lab").alias("ring_id"), ring.alias("ring"))
    out = out.withColumn("ring", F.concat("ring", F.array(F.get(F.col("ring"), 0))))
    return out.withColumn("area", ring_area2(F.col("ring")) / 2)


def ring_vertices(boundary: DataFrame, key: str = "area_code") -> DataFrame:
    """Directed boundary edges -> ring vertices in long form
    ``(key, ring_id, seq, x, y)``: ``seq`` orders each ring (closing point
    implied).  Nothing is gathered per ring, so an area of any size stays
    spread over partitions."""
    rank = _ring_ranks(boundary, key)
    return rank.select(key, F.col("lab").alias("ring_id"), (-F.col("r")).alias("seq"),
                       F.col("id.sx").alias("x"), F.col("id.sy").alias("y"))


def _ring_ranks(boundary: DataFrame, key: str) -> DataFrame:
    """Per directed edge: ring label ``lab`` and ``r`` (descending ``r``
    walks the ring forward).

    Successor of an edge: the edge leaving its end vertex with the sharpest
    left turn (keeps rings that touch at a point apart).  Ring id and vertex
    order come from one pointer-doubling phase; lineage is cut by writing the
    state to the shared checkpoint folder every second round.
    """
    e = boundary.select(key, "sx", "sy", "ex", "ey")
    a, b = e.alias("a"), e.alias("b")
    cand = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}"))
                  & (F.col("a.ex") == F.col("b.sx")) & (F.col("a.ey") == F.col("b.sy")))
    dax, day = F.col("a.ex") - F.col("a.sx"), F.col("a.ey") - F.col("a.sy")
    dbx, dby = F.col("b.ex") - F.col("b.sx"), F.col("b.ey") - F.col("b.sy")
    turn = F.atan2(dax * dby - day * dbx, dax * dbx + day * dby)
    succ = cand.groupBy(F.col(f"a.{key}").alias(key), F.col("a.sx").alias("sx"), F.col("a.sy").alias("sy"),
                        F.col("a.ex").alias("ex"), F.col("a.ey").alias("ey")).agg(
        F.max_by(F.struct(F.col("b.ex").alias("x"), F.col("b.ey").alias("y")), turn).alias("n"))
    node = succ.select(
        key,
        F.struct("sx", "sy", "ex", "ey").alias("id"),
        F.struct(F.col("ex").alias("sx"), F.col("ey").alias("sy"),
                 F.col("n.x").alias("ex"), F.col("n.y").alias("ey")).alias("succ"),
    )
    rounds = _rounds(e, key)
    node = cut_lineage(node)

    # One doubling phase.  After round k every edge knows, for the window of
    # the next 2^k edges along its ring, the smallest edge id (``lab``) and
    # how many steps ahead it lies (``d``).  Once 2^k exceeds the ring length
    # ``lab`` is the ring id and ``d`` orders the ring: descending ``d`` walks
    # forward from the edge after the label edge to the label edge itself.
    st = node.select(key, "id", F.col("succ").alias("nxt"), F.col("id").alias("lab"),
                     F.lit(0).cast("long").alias("d"))
    for i in range(rounds):
        span = 1 << i
        j = st.select(F.col(key).alias("j_key"), F.col("id").alias("j_id"), F.col("nxt").alias("j_nxt"),
                      F.col("lab").alias("j_lab"), F.col("d").alias("j_d"))
        keep_own = F.col("lab") <= F.col("j_lab")
        st = st.join(j, (F.col(key) == F.col("j_key")) & (F.col("nxt") == F.col("j_id"))).select(
            key, "id",
            F.col("j_nxt").alias("nxt"),
            F.when(keep_own, F.col("lab")).otherwise(F.col("j_lab")).alias("lab"),
            F.when(keep_own, F.col("d")).otherwise(F.col("j_d") + F.lit(span)).alias("d"),
        )
        st = _ckpt(st, i, every=2) if i + 1 < rounds else st
    return st.select(key, "id", "lab", F.col("d").alias("r"))


def _hole_owners(rings: DataFrame, key: str) -> DataFrame:
    """``(h_key, hole_id, hole_ring, owner)``: each clockwise ring's owning
    exterior = the smallest counter-clockwise ring (same key) containing
    the hole's first vertex, by even-odd ray casting.

    The ray test needs only edges whose y-range spans the point, so edges
    and points are bucketed into horizontal bands (height ~ key extent /
    sqrt(edges)) and equi-joined on ``(key, band)``: a point meets the edges
    of its band, never every ring of its key."""
    ext = rings.where(F.col("area") > 0).select(key, "ring_id", "ring", "area")
    holes = rings.where(F.col("area") < 0).select(
        key, F.col("ring_id").alias("hole_id"), F.col("ring").alias("hole_ring"),
        F.get(F.col("ring"), 0)["x"].alias("px"), F.get(F.col("ring"), 0)["y"].alias("py"))
    edges = ext.select(
        key, F.col("ring_id").alias("ext_id"), F.col("area").alias("ext_area"),
        F.explode(F.transform(F.sequence(F.lit(0), F.size("ring") - 2),
                              lambda i: F.struct(_pt(F.col("ring"), i).alias("a"),
                                                 _pt(F.col("ring"), i + 1).alias("b")))).alias("e"),
    ).select(key, "ext_id", "ext_area", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"),
             F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by")).where(F.col("ay") != F.col("by"))
    lo, hi = F.least("ay", "by"), F.greatest("ay", "by")
    stats = edges.groupBy(key).agg(F.min(lo).alias("y0"), F.max(hi).alias("y1"), F.count(F.lit(1)).alias("n"))
    stats = stats.select(key, "y0", F.greatest((F.col("y1") - F.col("y0")) / F.greatest(F.sqrt("n"), F.lit(1.0)),
                                               F.lit(1e-12)).alias("h"))
    banded = edges.join(stats, key).withColumn(
        "band", F.explode(F.sequence(F.floor((lo - F.col("y0")) / F.col("h")),
                                     F.floor((hi - F.col("y0")) / F.col("h")))))
    pts = holes.join(stats, key).withColumn("band", F.floor((F.col("py") - F.col("y0")) / F.col("h")))
    m = pts.join(banded.drop("y0", "h"), [key, "band"])
    xint = (F.col("bx") - F.col("ax")) * (F.col("py") - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax")
    cross = m.where(((F.col("ay") > F.col("py")) != (F.col("by") > F.col("py"))) & (F.col("px") < xint))
    inside = (cross.groupBy(key, "hole_id", "ext_id", "ext_area").count()
              .where(F.col("count") % 2 == 1))
    owner = inside.groupBy(key, "hole_id").agg(F.min_by("ext_id", "ext_area").alias("owner"))
    return holes.join(owner, [key, "hole_id"]).select(
        F.col(key).alias("h_key"), "hole_id", "hole_ring", "owner")


def assemble_polygons(rings: DataFrame, key: str = "area_code") -> DataFrame:
    """Rings -> ``polygons`` per key: each counter-clockwise ring is an
    exterior; each clockwise ring becomes a hole of its owning exterior."""
    ext = rings.where(F.col("area") > 0).select(
        key, F.col("ring_id").alias("ext_id"), F.col("ring").alias("ext_ring"))
    owner = _hole_owners(rings, key)
    hole_sets = owner.groupBy("h_key", "owner").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("hole_id", "hole_ring"))),
                    lambda h: h["hole_ring"]).alias("holes"))
    poly = ext.join(hole_sets, (F.col(key) == F.col("h_key")) & (F.col("ext_id") == F.col("owner")), "left")
    empty = F.array().cast("array<array<struct<x:double,y:double>>>")
    poly = poly.select(key, "ext_id", F.concat(F.array("ext_ring"), F.coalesce("holes", empty)).alias("polygon"))
    return poly.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ext_id", "polygon"))), lambda p: p["polygon"]).alias("polygons"))


def dissolve(features: DataFrame, key: str = "area_code", geom_col: str = "polygons",
             with_geometry: bool = True, overlay: bool = False) -> DataFrame:
    """Union the polygons of every key: ``(key, area, overlap, n_edges[, polygons])``.

    ``overlay`` splits edges where they cross, overlap or end on one another
    (``operators.overlay``), for parts that are not one tessellation."""
    if overlay:
        from statlake.operators.overlay import union_boundary

        boundary = union_boundary(features, key, geom_col)
    else:
        boundary = cancel_edges(ring_edges(features, key, geom_col), key)
    if not with_geometry:
        return boundary_area(boundary, key)
    # The boundary feeds both the area aggregate and the iterative stitching:
    # materialise it once (reliable checkpoint) instead of recomputing it.
    boundary = cut_lineage(boundary, "boundary")
    area = boundary_area(boundary, key)
    polys = assemble_polygons(stitch_rings(boundary, key), key)
    return area.join(polys, key, "left")


# ---------------------------------------------------------------------------
# Levels, designated cities, boundaries
# ---------------------------------------------------------------------------

def _with_parent(keyed: DataFrame, code_col: str = "area_code") -> DataFrame:
    """Left-join each row's designated-city parent (null for other codes).
    The ward table is ~200 rows of fixed size, so it is broadcast."""
    wards = F.broadcast(designated_wards(keyed.sparkSession))
    return keyed.join(wards, F.col(code_col).try_cast("int") == F.col("ward_code_int"), "left")


def _rollup_codes(mode: str, code_col: str = "area_code") -> Column:
    """The codes a row counts towards: its own and/or its parent city's."""
    own, parent = F.col(code_col), F.col("parent_code")
    if mode == "both":
        # the row's own code always counts, a null one too; the parent where there is one
        return F.when(parent.isNull(), F.array(own)).otherwise(F.array(own, parent))
    if mode == "city":
        return F.array(F.coalesce(parent, own))
    return F.array(own)


def keyed_small_areas(small_areas: DataFrame, level: str = "municipality",
                      designated: str = "both") -> DataFrame:
    """Clean rows keyed by ``area_code`` at the level; at municipality level
    each designated-ward row also counts towards its parent city ("both"),
    or only towards it ("city").  One pass: no second scan, no union."""
    if level not in LEVELS:
        raise InvalidArgument(f"level must be one of {LEVELS}")
    if designated not in ("both", "ward", "city"):
        raise InvalidArgument('designated must be "both", "ward" or "city"')
    sa = clean_boundary_rows(small_areas).withColumn("area_code", boundary_key(level))
    if level != "municipality" or designated == "ward":
        return sa
    m = _with_parent(sa)
    cols = [c for c in sa.columns if c != "area_code"]
    out = m.select(*cols, "parent_code", "parent_name",
                   F.explode(_rollup_codes(designated)).alias("area_code"))
    if "CITY_NAME" in cols:
        out = out.withColumn("CITY_NAME", F.when(F.col("area_code") == F.col("parent_code"), F.col("parent_name"))
                             .otherwise(F.col("CITY_NAME")))
    return out.drop("parent_code", "parent_name")


def boundaries(small_areas: DataFrame, level: str = "municipality", designated: str = "both",
               areas: list[str] | None = None, with_geometry: bool = True,
               year: int | None = None, datum: str = "2000", overlay: bool = False) -> DataFrame:
    """Dissolved boundaries ``(area_code, <names>, area, polygons, srid)``.

    ``areas`` restricts by prefecture (partition pruning when the features
    are partitioned by ``pref``) and then keeps each requested code at its
    own granularity: two-digit codes keep whole prefectures, longer codes
    keep exactly that area.
    """
    from statlake.operators.quality import validate_boundary_year_datum

    if year is not None:
        validate_boundary_year_datum(year, datum)
    sa = small_areas
    if areas is not None:
        prefs = sorted({str(a)[:2] for a in areas})
        bad = [p for p in prefs if p not in PREFECTURE_CODES]
        if bad:
            raise InvalidArgument(f"not valid prefecture codes: {bad}")
        pref_col = "pref" if "pref" in sa.columns else "PREF"
        sa = sa.where(F.substring(F.col(pref_col), 1, 2).isin(prefs))
    keyed = keyed_small_areas(sa, level, designated)
    names = name_columns(level, keyed.columns)
    named = keyed.groupBy("area_code").agg(
        *[F.min_by(c, "KEY_CODE").alias(c) for c in names])
    geo = dissolve(keyed, "area_code", with_geometry=with_geometry, overlay=overlay)
    out = named.join(geo, "area_code", "left")
    srid = F.when(F.lit(str(datum)) == "2011", F.lit(6668)).otherwise(F.lit(4612))
    out = out.withColumn("srid", srid)
    if areas is not None:
        whole = [a for a in areas if len(str(a)) <= 2]
        exact = [a for a in areas if len(str(a)) > 2]
        keep = F.lit(False)
        if whole:
            keep = keep | F.substring("area_code", 1, 2).isin(whole)
        if exact:
            keep = keep | F.col("area_code").isin(exact)
        out = out.where(keep)
    return out


def rollup_measure(df: DataFrame, aggs: list[Column], code_col: str = "area_code",
                   mode: str = "both") -> DataFrame:
    """Aggregate a measure per area code and add designated-city parent rows
    (``both``), or count wards only towards their parent (``city``), or leave
    wards alone (``ward``).  One scan and one partial-aggregated shuffle: each
    row is exploded into the codes it counts towards (the ward -> parent
    match is an equi-join on the expanded ward list, fixed ~200 rows)."""
    if mode not in ("both", "ward", "city"):
        raise InvalidArgument('mode must be "both", "ward" or "city"')
    if mode == "ward":
        return df.groupBy(code_col).agg(*aggs)
    m = _with_parent(df, code_col)
    # Parent rows are appended, not merged: a parent code that also occurs as
    # an ordinary code in the data keeps two rows (the reference appends them).
    exploded = m.withColumn("__rollup_code", F.explode(_rollup_codes(mode, code_col)))
    is_parent = F.coalesce(F.col("__rollup_code") == F.col("parent_code"), F.lit(False))
    out = exploded.groupBy(F.col("__rollup_code").alias(code_col), is_parent.alias("__is_parent")).agg(*aggs)
    return out.drop("__is_parent")


def unmatched_codes(data: DataFrame, bnd: DataFrame, key: str = "area_code") -> DataFrame:
    """Distinct data codes with no boundary (left anti join)."""
    codes = data.select(key).where(F.col(key).isNotNull()).distinct()
    return codes.join(bnd.select(key).distinct(), key, "left_anti")


def _vertex_count(bnd: DataFrame, geom_col: str = "polygons") -> int:
    n = F.aggregate(F.coalesce(F.col(geom_col), F.array().cast("array<array<array<struct<x:double,y:double>>>>")),
                    F.lit(0), lambda acc, poly: acc + F.aggregate(poly, F.lit(0), lambda a, r: a + F.size(r)))
    row = bnd.agg(F.sum(n).alias("v"), F.count(F.lit(1)).alias("n")).first()
    return int(row["v"] or 0), int(row["n"] or 0)


def join_geometry(data: DataFrame, bnd: DataFrame, key: str = "area_code",
                  max_broadcast_vertices: int = 5_000_000,
                  max_broadcast_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """Attach geometry to every data row (left join, repeated per period)
    and return the codes without geometry.

    The boundary side is broadcast only when its total vertex count and
    row count are under the bounds; otherwise it is a shuffle join."""
    if key not in data.columns:
        raise InvalidArgument(f"data has no {key} column to join geometry on")
    geo_cols = [c for c in bnd.columns if c == key or c in ("polygons", "srid", "area")]
    g = bnd.select(*geo_cols)
    if "area" in geo_cols and "area" in data.columns:  # the decoded area axis keeps its name
        g = g.withColumnRenamed("area", "boundary_area")
    if "polygons" in g.columns:
        v, n = _vertex_count(g)
        if v <= max_broadcast_vertices and n <= max_broadcast_rows:
            g = F.broadcast(g)
    else:
        g = sized_broadcast(g, max_broadcast_rows)
    joined = data.join(g, key, "left")
    return joined, unmatched_codes(data, bnd, key)


def attach_geometry(data: DataFrame, small_areas: DataFrame, level: str = "auto",
                    designated: str = "both", year: int | None = None, datum: str = "2000",
                    key: str = "area_code", overlay: bool = False) -> tuple[DataFrame, DataFrame]:
    """The whole geometry join: infer the level from the data's codes, make the
    boundaries once (a table in the shared checkpoint folder), read only the prefectures those codes name (invalid prefixes such as the
    national ``00`` are skipped, not fatal), dissolve, join every data row,
    and return ``(joined, unmatched codes)``.  The prefecture list is at
    most one row per distinct two-digit prefix."""
    if key not in data.columns:
        raise InvalidArgument(f"data has no {key} column to join geometry on")
    if level == "auto":
        level = infer_level(data, key)
    prefs = [r["pref"] for r in resolve_prefectures(data, key).where("valid").collect()]
    bnd = boundaries(small_areas, level, designated, areas=prefs, year=year, datum=datum, overlay=overlay)
    return join_geometry(data, cut_lineage(bnd, "boundaries"), key)
