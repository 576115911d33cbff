"""Totals over a code list's tree by interval labels.

A walk that enters every code, then its children, then leaves it, numbers the codes;
all codes below one are numbered in one interval.  The walk is a linked list
of enterings and leavings, whatever the depth.  A long one is ranked by rulers:
places drawn by a hash, one in ``RULER``; every place finds the next ruler by pointer
doubling, the rulers alone are ranked the same way, and a short list is doubled to its
end.  So the rows handled are the list's length times a small number, not times
its logarithm.  The total below a code is then the difference of two running sums, so
neither codes x depth pairs nor a range join is ever made.

The code list must be a tree: a code with two parents is an error.  A parent
that is not listed is a code of its own.  Codes on a cycle, and below one, hang on no root:
they get no label (``hierarchy.axis_cycles`` lists them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.operators.hierarchy import KEYS
from statlake.operators.quality import InvalidArgument
from statlake.session import cut_lineage

#: Codes whose running sum one task makes.
SPAN = 100_000
#: Longest list that is ranked without rulers, and places for one ruler.
SHORT, RULER = 1 << 20, 16


def _next_in_group(df: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """``df`` with ``next``: ``value`` of the row that follows by ``order`` in the group.

    Rows go to ranges of (group, order), so a group with very many rows is spread;
    the last row of a range looks up the first of its group in a later range."""
    spread = df.repartitionByRange(*[F.col(c) for c in (*group, order)]).withColumn("range", F.spark_partition_id())
    spread = cut_lineage(spread, "ranges")  # the ranges must not change between the two uses
    inside = F.lead(value).over(Window.partitionBy("range", *group).orderBy(order))
    firsts = spread.groupBy(*group, "range").agg(F.min_by(value, order).alias("first"))
    later = firsts.select(*group, "range", F.lead("first").over(Window.partitionBy(*group).orderBy("range")).alias("later"))
    return spread.withColumn("inside", inside).join(later, [*group, "range"]).withColumn("next", F.coalesce("inside", "later")).drop("inside", "later", "range")


def _name(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns))


def _nodes(classes: DataFrame) -> DataFrame:
    """(KEYS, code, tree, me, up): every code with its name and its parent's."""
    links = classes.where("code is not null").groupBy(*KEYS, "code").agg(F.min("parent").alias("parent"), F.max("parent").alias("other"))
    links = cut_lineage(links, "links")
    twice = links.where("parent <> other").select(*KEYS, "code").limit(1).collect()
    if twice:
        raise InvalidArgument(f"code {twice[0]['code']!r} of axis {twice[0]['axis']!r} has more than one parent")
    links = links.drop("other")
    unlisted = links.where("parent is not null").select(*KEYS, F.col("parent").alias("code")).distinct().withColumn("parent", F.lit(None).cast("string"))
    nodes = links.unionByName(unlisted).groupBy(*KEYS, "code").agg(F.max("parent").alias("parent"))
    keys = [F.col(k) for k in KEYS]
    return nodes.select(*KEYS, "code", _name(*keys).alias("tree"), _name(*keys, F.col("code")).alias("me"),
                        F.when(F.col("parent").isNotNull(), _name(*keys, F.col("parent").alias("code"))).alias("up"))


def _rounds(n: int) -> int:
    return max(1, math.ceil(math.log2(max(2, n)))) + 1


def _doubled(walk: DataFrame, n: int) -> DataFrame:
    """``_ranked`` of a short list, each place walking on to the end."""
    for _ in range(_rounds(n)):
        step = walk.select(F.col("id").alias("to"), F.col("next").alias("after"), F.col("ahead").alias("more"))
        walk = walk.join(step, F.col("next") == F.col("to"), "left").select(
            "id", F.col("after").alias("next"), (F.col("ahead") + F.coalesce("more", F.lit(0))).alias("ahead"))
        walk = cut_lineage(walk, "walk")
        if walk.where("next is not null").isEmpty():
            break
    return walk.where("next is null").select("id", "ahead")  # what is left is on a cycle


def _ranked(walk: DataFrame, depth: int = 0) -> DataFrame:
    """(id, ahead) of the places from which the list ends: the sum of ``ahead``
    from there on.  ``walk`` has (id, next, ahead), ``next`` null at an end;
    what is on a cycle or leads to one is left out."""
    n = walk.count()
    if n <= SHORT:
        return _doubled(walk, n)
    is_ruler = lambda c: F.pmod(F.xxhash64(c, F.lit(depth)), F.lit(RULER)) == 0
    there = F.col("next").isNull() | is_ruler("next")
    arrived, moving = walk.where(there), walk.where(~there)
    for _ in range(_rounds(n)):
        step = arrived.unionAll(moving).where(~is_ruler("id"))  # no one stops there
        step = step.select(F.col("id").alias("to"), F.col("next").alias("after"), F.col("ahead").alias("more"))
        moved = moving.join(step, F.col("next") == F.col("to")).select("id", F.col("after").alias("next"), (F.col("ahead") + F.col("more")).alias("ahead"))
        moved = cut_lineage(moved, "walk")
        arrived, moving = arrived.unionAll(moved.where(there)), moved.where(~there)
        if moving.isEmpty():
            break
    rulers = _ranked(cut_lineage(arrived.where(is_ruler("id")), "rulers"), depth + 1)
    behind = arrived.where("next is not null").join(rulers.select(F.col("id").alias("ruler"), F.col("ahead").alias("more")), F.col("next") == F.col("ruler"))
    ends = arrived.where("next is null").select("id", "ahead")
    return cut_lineage(ends.unionAll(behind.select("id", (F.col("ahead") + F.col("more")).alias("ahead"))), "ranked")


def interval_labels(classes: DataFrame) -> DataFrame:
    """(KEYS, code, first, last): the codes below a code, itself included, are
    those of its axis whose ``first`` lies between its ``first`` and ``last``."""
    # the walk goes by numbers, which are fixed once they are written
    named = cut_lineage(_nodes(classes).withColumn("no", F.monotonically_increasing_id()), "nodes")
    parents = named.select(F.col("me").alias("up"), F.col("no").alias("up_no"))
    linked = named.select("no", "code", "tree", "up").join(parents, "up", "left")
    places = linked.select("no", "code", "up_no", F.coalesce("up_no", F.lit(-1)).alias("under"), F.when(F.col("up_no").isNull(), F.col("tree")).otherwise("").alias("top_of"))
    siblings = cut_lineage(_next_in_group(places, ["under", "top_of"], "code", "no"), "siblings")
    child = siblings.where("up_no is not null").groupBy("up_no").agg(F.min_by("no", "code").alias("child"))
    enter, leave = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    enters = named.select("no").join(child, F.col("no") == F.col("up_no"), "left").select(
        enter("no").alias("id"), F.coalesce(enter("child"), leave("no")).alias("next"), F.lit(1).cast("long").alias("ahead"))
    leaves = siblings.select(leave("no").alias("id"), F.coalesce(enter("next"), leave("up_no")).alias("next"), F.lit(0).cast("long").alias("ahead"))
    ranked = _ranked(cut_lineage(enters.unionAll(leaves), "walk"))
    ranks = ranked.groupBy(F.shiftright("id", 1).alias("no")).agg(
        F.max(F.when(F.col("id") % 2 == 0, F.col("ahead"))).alias("from_here"), F.max(F.when(F.col("id") % 2 == 1, F.col("ahead"))).alias("behind")).dropna()
    out = named.select(*KEYS, "code", "tree", "no").join(ranks, "no")
    total = out.groupBy("tree").agg(F.max("from_here").alias("total"))
    return out.join(total, "tree").select(*KEYS, "code", (F.col("total") - F.col("from_here") + 1).alias("first"), (F.col("total") - F.col("behind")).alias("last"))


def _running(rows: DataFrame, sums: list[str]) -> DataFrame:
    """Running sums over ``first`` in each tree, span by span."""
    spans = rows.withColumn("span", F.floor((F.col("first") - 1) / SPAN))
    whole = spans.groupBy("tree", "span").agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.partitionBy("tree").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    start = whole.select("tree", "span", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"start_{c}") for c in sums])
    inside = Window.partitionBy("tree", "span").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    return spans.join(start, ["tree", "span"]).select("tree", "first", *[(F.sum(c).over(inside) + F.col(f"start_{c}")).alias(c) for c in sums])


def rollup_totals(labels: DataFrame, values: DataFrame, sums: list[str]) -> DataFrame:
    """(KEYS, code, n_codes, <sums>): totals of whole-number or decimal columns of
    ``values`` (KEYS, code, ...) over every code and all codes below it.

    Rows whose code has no label count nowhere."""
    for c in sums:
        if values.schema[c].dataType.typeName() in ("double", "float"):
            raise InvalidArgument(f"{c} must be a whole number or a decimal: differences of running sums must be exact")
    tree = _name(*[F.col(k) for k in KEYS])
    labels = cut_lineage(labels.withColumn("tree", tree), "labels")
    own = values.withColumn("tree", tree).groupBy("tree", "code").agg(*[F.sum(c).alias(c) for c in sums])
    at = labels.select("tree", "code", "first").join(own, ["tree", "code"], "left").select("tree", "first", *[F.coalesce(c, F.lit(0)).alias(c) for c in sums])
    running = cut_lineage(_running(at, sums), "running")
    upto = lambda side, place: running.select("tree", F.col("first").alias(place), *[F.col(c).alias(f"{side}_{c}") for c in sums])
    out = labels.withColumn("before", F.col("first") - 1).join(upto("to", "last"), ["tree", "last"]).join(upto("from", "before"), ["tree", "before"], "left")
    return out.select(*KEYS, "code", (F.col("last") - F.col("first") + 1).alias("n_codes"), *[(F.col(f"to_{c}") - F.coalesce(f"from_{c}", F.lit(0))).alias(c) for c in sums])
