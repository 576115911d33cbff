"""Walk the ``parent`` links of a code list.

The service only exposes ``level`` and ``parent``; this turns them into a
closure table ``(code, ancestor, depth)``.  Each round joins the frontier (the
pairs found last) to the parent links; rounds go on until the frontier is empty,
so neither depth nor rows are bounded.  A round's pairs are written to the
shared checkpoint folder, so plans stay short and a lost executor costs at most
one round.  A walk that comes back to its own code is a cycle: the pair is
reported once and not followed further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.session import cut_lineage

KEYS = ["stats_data_id", "lang", "axis"]


def _walk(classes: DataFrame) -> DataFrame:
    links = classes.select(*KEYS, "code", "parent").where("code is not null and parent is not null").distinct()
    links = cut_lineage(links, "links")
    up = links.select(*[F.col(k).alias(f"up_{k}") for k in KEYS], F.col("code").alias("up_code"), F.col("parent").alias("up_parent"))
    frontier = links.select(*KEYS, "code", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    found = frontier
    same = [F.col(k).eqNullSafe(F.col(f"up_{k}")) for k in KEYS]
    while True:
        open_ends = frontier.where("code <> ancestor")  # a closed cycle ends here
        step = open_ends.join(up, [*same, F.col("ancestor") == F.col("up_code")])
        step = step.select(*KEYS, "code", F.col("up_parent").alias("ancestor"), (F.col("depth") + 1).alias("depth")).distinct()
        # a pair met before is another way round: keep the shortest, do not walk it again
        known = found.select(*[F.col(k).alias(f"up_{k}") for k in KEYS], F.col("code").alias("old_code"), F.col("ancestor").alias("old_ancestor"))
        step = step.join(known, [*same, F.col("code") == F.col("old_code"), F.col("ancestor") == F.col("old_ancestor")], "left_anti")
        frontier = cut_lineage(step, "frontier")
        if frontier.isEmpty():
            return found
        found = found.unionByName(frontier)


def axis_hierarchy(classes: DataFrame) -> DataFrame:
    """Closure of the parent relation: one row per (code, ancestor)."""
    return _walk(classes).where("code <> ancestor")


def axis_cycles(classes: DataFrame) -> DataFrame:
    """Codes that are their own ancestor, with the length of the cycle."""
    return _walk(classes).where("code = ancestor").select(*KEYS, "code", F.col("depth").alias("length"))
