"""Connected components of a large link table, by alternating star contraction.

Links are ``(a, b)`` long pairs.  Each round points every node's larger
neighbours at its smallest one (large star) and then its smaller neighbours
(small star); minima are pre-aggregated and joined back, so a node with very
many links is never one task's group.  Before a round each task replaces its
links, ``CHUNK`` at a time, by stars that join the same nodes, which needs no
shuffle; then the stars of ``TOGETHER`` tasks are joined likewise.  Rounds end when all links
form stars; each is cut by a Parquet table in the shared checkpoint folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.session import cut_lineage


#: Links that a task looks at together.
CHUNK = 1 << 18
#: Tasks whose stars meet in one task before a round.
TOGETHER = 16


def _least_joined(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(a, b): each node that the links join to a smaller one, and the least."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(places[:len(a)].tolist(), places[len(a):].tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    root = np.array([find(x) for x in range(len(nodes))], np.int64)
    moved = root != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["a", "b"])


def _contracted(links: DataFrame, chunk: int) -> DataFrame:
    """Fewer links that join the same nodes: stars of each ``chunk`` of a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
            if held and (batch is None or sum(map(len, held)) >= chunk):
                yield _least_joined(*(np.concatenate([h.column(c).to_numpy() for h in held]) for c in ("a", "b")))
                held = []

    return cut_lineage(links.mapInArrow(work, "a long, b long"), "contracted")


def _are_stars(links: DataFrame) -> bool:
    """Whether every node is linked to one smaller node at most, and a node so
    linked has no larger one."""
    ends = links.select(F.col("a").alias("node"), F.lit(True).alias("up")).unionAll(links.select(F.col("b").alias("node"), F.lit(False).alias("up")))
    return ends.groupBy("node").agg(F.count_if("up").alias("ups"), F.count("*").alias("n")).filter("ups > 1 or (ups = 1 and n > 1)").isEmpty()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` has a > b. Large star links the larger neighbours of a node to
    the least of its neighbourhood, small star the smaller ones."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    moved = joined.filter("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionAll(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def connected(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(node, root)`` for every node that has a link; root is the least node
    of its component."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = cut_lineage(links, "links")
    while True:
        links = _contracted(links, chunk)
        links = _contracted(links.coalesce(math.ceil(links.rdd.getNumPartitions() / TOGETHER)), chunk)
        if _are_stars(links):
            break
        links = cut_lineage(_star(cut_lineage(_star(links, True), "large"), False), "small")
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
