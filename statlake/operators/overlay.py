"""Union of polygons that overlap or meet anywhere, not only at shared vertices.

Edge cancellation (``geo.cancel_edges``) is exact for one tessellation.  Here
edges are first split where they cross, overlap or end on one another, and then a winding count
tells which of the pieces lie between inside and outside:

1. Edges used equally in both directions cancel; the rest carry how often they
   are used (``w``), so the winding number grows by ``w`` from their right to
   their left.
2. Every key gets a grid of its own, as many cells as edges.  Edges that touch
   one cell are compared and split at the points they share; pieces that
   coincide are added up.
3. The winding number right of each piece: that of its cell's lower left corner
   (running sums of the crossings along the grid line, cell by cell), plus what
   is crossed on the way from there to the middle of the piece inside the cell.
4. Pieces with nothing on the right and something on the left are the boundary.

All of it is joins and sums by (key, cell), so a key with a third of all edges spreads
over its cells; no group of edges is gathered.  Points closer than ``tolerance``
times the key's extent are the same point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.operators.geo import cancel_edges, ring_edges
from statlake.session import cut_lineage


def _grids(edges: DataFrame, key: str) -> DataFrame:
    """(key, x0, y0, cell): a grid over each key's edges."""
    side = lambda f, *c: f(*[F.least(*c) if f is F.min else F.greatest(*c)])
    box = edges.groupBy(key).agg(side(F.min, "sx", "ex").alias("x0"), side(F.min, "sy", "ey").alias("y0"),
                                 side(F.max, "sx", "ex").alias("x1"), side(F.max, "sy", "ey").alias("y1"), F.count("*").alias("n"))
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return box.select(key, "x0", "y0", extent.alias("extent"), (extent / F.greatest(F.floor(F.sqrt("n")), F.lit(1))).alias("cell"))


def _column(x: Column) -> Column:
    return F.floor((x - F.col("x0")) / F.col("cell")).cast("int")


def _line(y: Column) -> Column:
    return F.floor((y - F.col("y0")) / F.col("cell")).cast("int")


def _in_cells(edges: DataFrame, grids: DataFrame, key: str, tolerance: float) -> DataFrame:
    """Each edge in every cell (ci, cj) that it touches: for each column, the
    lines between the heights at which it enters and leaves."""
    slack = F.col("extent") * tolerance
    lo, hi = F.least("sx", "ex"), F.greatest("sx", "ex")
    e = edges.join(grids, key).withColumn("ci", F.explode(F.sequence(_column(lo - slack), _column(hi + slack))))
    left = F.greatest(lo, F.col("x0") + F.col("ci") * F.col("cell") - slack)
    right = F.least(hi, F.col("x0") + (F.col("ci") + 1) * F.col("cell") + slack)

    def height(x):
        return F.when(F.col("sx") == F.col("ex"), None).otherwise(
            F.col("sy") + (F.col("ey") - F.col("sy")) * (x - F.col("sx")) / (F.col("ex") - F.col("sx")))

    low, high = F.least("sy", "ey"), F.greatest("sy", "ey")
    inside = lambda y, other: F.least(F.greatest(F.coalesce(y, other), low), high)
    a, b = inside(height(left), low), inside(height(right), high)
    return e.withColumn("cj", F.explode(F.sequence(_line(F.least(a, b) - slack), _line(F.greatest(a, b) + slack))))


def _shared_points(cells: DataFrame, key: str, tolerance: float) -> DataFrame:
    """(key, id, px, py): points inside an edge where another one ends, crosses
    or begins to run along it."""
    a, b = cells.alias("a"), cells.select(key, "ci", "cj", *[F.col(c).alias(f"o_{c}") for c in ("id", "sx", "sy", "ex", "ey")]).alias("b")
    slack = F.col("extent") * tolerance
    apart = F.lit(False)
    for d in ("x", "y"):
        apart = apart | (F.least(f"s{d}", f"e{d}") > F.greatest(f"o_s{d}", f"o_e{d}") + slack) | (F.least(f"o_s{d}", f"o_e{d}") > F.greatest(f"s{d}", f"e{d}") + slack)
    met = a.join(b, [key, "ci", "cj"]).where((F.col("id") != F.col("o_id")) & ~apart)
    dx, dy = F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")
    length = F.sqrt(dx * dx + dy * dy)

    def on_edge(x, y):
        along = ((x - F.col("sx")) * dx + (y - F.col("sy")) * dy) / length
        off = F.abs((x - F.col("sx")) * dy - (y - F.col("sy")) * dx) / length
        return F.when((off <= slack) & (along > slack) & (along < length - slack), F.struct(x.alias("x"), y.alias("y")))

    # both edges of a crossing compute it from the one with the smaller id
    mine = F.col("id") < F.col("o_id")
    pick = lambda c: (F.when(mine, F.col(c)).otherwise(F.col(f"o_{c}")), F.when(mine, F.col(f"o_{c}")).otherwise(F.col(c)))
    (asx, bsx), (asy, bsy), (aex, bex), (aey, bey) = map(pick, ("sx", "sy", "ex", "ey"))
    ax, ay, bx, by = aex - asx, aey - asy, bex - bsx, bey - bsy
    turn = ax * by - ay * bx
    t = ((bsx - asx) * by - (bsy - asy) * bx) / F.nullif(turn, F.lit(0.0))
    u = ((bsx - asx) * ay - (bsy - asy) * ax) / F.nullif(turn, F.lit(0.0))
    step = F.pow(F.lit(2.0), F.floor(F.log2(slack)))  # a power of two: short binary fractions stay exact
    px, py = F.round((asx + t * ax) / step) * step, F.round((asy + t * ay) / step) * step
    ends = on_edge(F.col("o_sx"), F.col("o_sy")).isNotNull() | on_edge(F.col("o_ex"), F.col("o_ey")).isNotNull()
    a_len, b_len = F.sqrt(ax * ax + ay * ay), F.sqrt(bx * bx + by * by)
    inner = (t * a_len > slack) & ((1 - t) * a_len > slack) & (u * b_len > slack) & ((1 - u) * b_len > slack)
    crossing = F.when(inner & ~ends, F.struct(px.alias("x"), py.alias("y")))
    points = F.array_compact(F.array(on_edge(F.col("o_sx"), F.col("o_sy")), on_edge(F.col("o_ex"), F.col("o_ey")), crossing))
    return met.select(key, "id", F.explode(points).alias("p")).select(key, "id", F.col("p.x").alias("px"), F.col("p.y").alias("py")).distinct()


def _split(edges: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """Edges cut at their points; equal pieces added up, opposite ones cancelled."""
    dx, dy = F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")
    own = edges.select(key, "id", "w", "sx", "sy", "ex", "ey", F.explode(F.array(F.struct(F.col("sx").alias("x"), F.col("sy").alias("y")), F.struct(F.col("ex").alias("x"), F.col("ey").alias("y")))).alias("p"))
    cut = edges.join(points, [key, "id"]).select(key, "id", "w", "sx", "sy", "ex", "ey", F.struct(F.col("px").alias("x"), F.col("py").alias("y")).alias("p"))
    at = (F.col("p.x") - F.col("sx")) * dx + (F.col("p.y") - F.col("sy")) * dy
    order = Window.partitionBy(key, "id").orderBy("at", "p")
    pieces = own.unionByName(cut).withColumn("at", at).withColumn("next", F.lead("p").over(order)).where("next is not null and next <> p")
    return _added_up(pieces.select(key, "w", F.col("p.x").alias("sx"), F.col("p.y").alias("sy"), F.col("next.x").alias("ex"), F.col("next.y").alias("ey")), key)


def _added_up(edges: DataFrame, key: str) -> DataFrame:
    forward = (F.col("sx") < F.col("ex")) | ((F.col("sx") == F.col("ex")) & (F.col("sy") < F.col("ey")))
    first, last = F.struct(F.col("sx").alias("x"), F.col("sy").alias("y")), F.struct(F.col("ex").alias("x"), F.col("ey").alias("y"))
    one_way = edges.select(key, F.when(forward, first).otherwise(last).alias("a"), F.when(forward, last).otherwise(first).alias("b"), F.when(forward, F.col("w")).otherwise(-F.col("w")).alias("w"))
    summed = one_way.groupBy(key, "a", "b").agg(F.sum("w").alias("w")).where("w <> 0")
    s, e = F.when(F.col("w") > 0, F.col("a")).otherwise(F.col("b")), F.when(F.col("w") > 0, F.col("b")).otherwise(F.col("a"))
    return summed.select(key, s["x"].alias("sx"), s["y"].alias("sy"), e["x"].alias("ex"), e["y"].alias("ey"), F.abs("w").alias("w"))


def _winding_right(pieces: DataFrame, cells: DataFrame, grids: DataFrame, key: str) -> DataFrame:
    """(id, right): the winding number right of each piece."""
    # crossings of the grid lines, a hair above them
    low, high = F.least("sy", "ey"), F.greatest("sy", "ey")
    first, last = F.ceil((low - F.col("y0")) / F.col("cell")).cast("int") - 1, F.floor((high - F.col("y0")) / F.col("cell")).cast("int") + 1
    lines = pieces.where("sy <> ey").join(grids, key).withColumn("cj", F.explode(F.sequence(first, last))).withColumn("line", F.col("y0") + F.col("cj") * F.col("cell"))
    lines = lines.where((F.col("sy") <= F.col("line")) != (F.col("ey") <= F.col("line")))
    x = F.col("sx") + (F.col("ex") - F.col("sx")) * (F.col("line") - F.col("sy")) / (F.col("ey") - F.col("sy"))
    crossed = lines.withColumn("x", x).select(key, "cj", _column(F.col("x")).alias("ci"), "x", F.when(F.col("ey") > F.col("sy"), -F.col("w")).otherwise(F.col("w")).alias("step"))

    # middles, in the cell that holds them
    mid = pieces.join(grids, key).withColumns({"mx": (F.col("sx") + F.col("ex")) / 2, "my": (F.col("sy") + F.col("ey")) / 2})
    above = F.ceil((F.col("my") - F.col("y0")) / F.col("cell")).cast("int") - 1  # the last line below the middle: one that lies on a line belongs to the cell under it
    mid = mid.withColumns({"ci": _column(F.col("mx")), "cj": above}).withColumn("line", F.col("y0") + F.col("cj") * F.col("cell"))
    mid = mid.select(key, "ci", "cj", "id", "mx", "my", "line")

    by_cell = crossed.groupBy(key, "cj", "ci").agg(F.sum("step").alias("step")).unionByName(mid.select(key, "cj", "ci").distinct().withColumn("step", F.lit(0).cast("long")))
    by_cell = by_cell.groupBy(key, "cj", "ci").agg(F.sum("step").alias("step"))
    before = Window.partitionBy(key, "cj").orderBy("ci").rowsBetween(Window.unboundedPreceding, -1)
    corner = by_cell.select(key, "cj", "ci", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("corner"))

    along = mid.join(crossed, [key, "cj", "ci"]).where(F.col("x") < F.col("mx")).groupBy("id").agg(F.sum("step").alias("along"))
    others = cells.select(key, "ci", "cj", F.col("id").alias("o_id"), "sx", "sy", "ex", "ey", "w")
    y = F.col("sy") + (F.col("ey") - F.col("sy")) * (F.col("mx") - F.col("sx")) / (F.col("ex") - F.col("sx"))
    up = (mid.join(others, [key, "ci", "cj"]).where((F.col("id") != F.col("o_id")) & ((F.col("sx") < F.col("mx")) != (F.col("ex") < F.col("mx"))))
          .withColumn("y", y).where((F.col("y") > F.col("line")) & (F.col("y") < F.col("my")))
          .groupBy("id").agg(F.sum(F.when(F.col("ex") > F.col("sx"), F.col("w")).otherwise(-F.col("w"))).alias("up")))
    near = (F.coalesce("corner", F.lit(0)) + F.coalesce("along", F.lit(0)) + F.coalesce("up", F.lit(0)))  # below, or left of an upright piece
    found = mid.join(corner, [key, "ci", "cj"], "left").join(along, "id", "left").join(up, "id", "left").select("id", near.alias("near"))
    left_is_near = (F.col("ex") < F.col("sx")) | ((F.col("ex") == F.col("sx")) & (F.col("ey") > F.col("sy")))
    return pieces.join(found, "id").withColumn("right", F.when(left_is_near, F.col("near") - F.col("w")).otherwise(F.col("near")))


def _numbered(edges: DataFrame, name: str) -> DataFrame:
    return cut_lineage(edges.withColumn("id", F.monotonically_increasing_id()), name)


def union_boundary(features: DataFrame, key: str = "area_code", geom_col: str = "polygons", tolerance: float = 1e-9) -> DataFrame:
    """Directed boundary edges ``(key, sx, sy, ex, ey, w)`` (inside on the left) of
    the union of each key's polygons, wherever they overlap or touch.  A null key is a
    key of its own in ``geo.cancel_edges`` but none here: such rows are left out."""
    edges = _numbered(cancel_edges(ring_edges(features, key, geom_col), key).where(F.col(key).isNotNull()), "edges")
    points = _shared_points(_in_cells(edges, _grids(edges, key), key, tolerance), key, tolerance)
    pieces = _numbered(_split(edges, points, key), "pieces")
    grids = _grids(pieces, key)
    wound = _winding_right(pieces, _in_cells(pieces, grids, key, tolerance), grids, key)
    return wound.where((F.col("right") <= 0) & (F.col("right") + F.col("w") > 0)).select(key, "sx", "sy", "ex", "ey", F.lit(1).cast("long").alias("w"))
