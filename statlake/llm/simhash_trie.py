"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints: every text's word shingles are hashed (XXH64, seed 42); a bit is
set if it is set in over half the hashes.

Links (at most ``max_bits`` differing bits) are found on the *distinct*
fingerprints, so copies never form pairs.  The 64 bits are cut into
``max_bits + 2`` blocks; two linked fingerprints agree in at least two whole
blocks.  So for each pair of blocks a trie is built with these blocks' bits on
top, and its self-join may start at equal nodes below them: each such subtree is
one unit of work.  Inside it, node pairs are walked together from the top: the
differing bits so far go along, and a pair is pruned when they exceed the
budget.  A subtree pair with more than ``max_node`` fingerprints is first split
into the pairs of its children (eight bits deeper, pruned likewise) by joins, so
no task gets an unbounded group.  A task returns each fingerprint's local
component (a star), never all pairs; components across tasks are joined by
star contraction.

Defined results: null and empty texts have fingerprint 0, linked like any
other; rows with a null doc_id get the component of their fingerprint (null if
no member has an id); repeated rows repeat; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.components import connected
from statlake.llm.common import arrow_rows, free_name
from statlake.llm.worker import held, in_slices
from statlake.session import cut_lineage

#: Bits that a hot node goes deeper at a time.
STEP = 8


# ---- fingerprints -----------------------------------------------------------

def text_fingerprint(text: str | None, size: int) -> int:
    """The unsigned fingerprint of one text."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= size:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), 42)]
    else:
        line = b" ".join(found)
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = np.concatenate([[0], ends[:len(found) - size]]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts, (ends[size - 1:] - 1).tolist(), strict=True)]
    n = len(hashes)
    packed = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(n, 8)
    total = np.zeros(64, np.int64)
    for k in range(0, n, 4096):
        total += np.unpackbits(packed[k:k + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def simhash(text: Column, shingle: int) -> Column:
    """Fingerprint as a signed long with the same bits."""

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        def part(x):
            return pa.array(np.array([text_fingerprint(t, shingle) for t in x], np.uint64).view(np.int64))
        held(None)
        return in_slices(texts, part)

    return fingerprint(text)


# ---- the trie inside a task ---------------------------------------------------

def _blocks(count: int) -> list[int]:
    """Lengths of ``count`` blocks that make up 64 bits."""
    return [64 // count + (k < 64 % count) for k in range(count)]


def _orders(count: int) -> list[list[int]]:
    """For each pair of blocks, the blocks in trie order: that pair first."""
    return [[*pair, *(k for k in range(count) if k not in pair)] for pair in combinations(range(count), 2)]


def _permuted(fp: Column, order: list[int], lengths: list[int]) -> Column:
    """The bits of ``fp`` with its blocks in another order."""
    starts = np.concatenate([[0], np.cumsum(lengths)]).tolist()
    out, at = F.lit(0).cast("long"), 0
    for k in order:
        bits = F.shiftrightunsigned(fp, 64 - starts[k] - lengths[k]).bitwiseAND(F.lit((1 << lengths[k]) - 1))
        out = out.bitwiseOR(F.shiftleft(bits, 64 - at - lengths[k]))
        at += lengths[k]
    return out


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def walk(values: np.ndarray, pairs: np.ndarray, depth: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between positions of ``values`` (unsigned, sorted inside each node).

    ``pairs`` holds one node pair a row: lo and hi of one node, lo and hi of the
    other, bits that differ above ``depth``.  Goes down bit by bit; a pair over
    the budget is pruned, a pair of single fingerprints is settled at once, and
    a pair whose remaining bits fit the budget links all it holds by stars.
    """
    left, right = [], []
    for level in range(depth, 65):
        same = (pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] == pairs[:, 3])
        one = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        single = one & ~same
        a, b = pairs[single, 0], pairs[single, 2]
        hit = _popcount(values[a] ^ values[b]) <= max_bits
        left.append(a[hit])
        right.append(b[hit])
        covered = ~one & (pairs[:, 4] + (64 - level) <= max_bits)
        for lo_a, hi_a, lo_b, hi_b, _ in pairs[covered].tolist():
            everything = np.concatenate([np.arange(lo_a, hi_a), np.arange(lo_b, hi_b)])
            left.append(np.full(len(everything), lo_a))
            right.append(everything)
        pairs = pairs[~one & ~covered]
        if not len(pairs) or level == 64:
            break
        bit = ((values >> np.uint64(63 - level)) & np.uint64(1)).astype(np.int64)
        ones = np.concatenate([[0], np.cumsum(bit)])
        mid_a = pairs[:, 1] - (ones[pairs[:, 1]] - ones[pairs[:, 0]])
        mid_b = pairs[:, 3] - (ones[pairs[:, 3]] - ones[pairs[:, 2]])
        same = (pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] == pairs[:, 3])
        lo_a, hi_a, lo_b, hi_b, bits = pairs.T
        children = [np.stack([lo_a, mid_a, lo_b, mid_b, bits], 1), np.stack([mid_a, hi_a, mid_b, hi_b, bits], 1),
                    np.stack([lo_a, mid_a, mid_b, hi_b, bits + 1], 1),
                    np.stack([mid_a, hi_a, lo_b, mid_b, bits + 1], 1)[~same]]
        pairs = np.concatenate(children)
        pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3]) & (pairs[:, 4] <= max_bits)]
    return np.concatenate([np.empty(0, np.int64), *left]), np.concatenate([np.empty(0, np.int64), *right])


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position that each of ``n`` positions reaches by the links."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        np.minimum.at(now, root[a], least)
        np.minimum.at(now, root[b], least)
        while (jump := now[now]).tobytes() != now.tobytes():
            now = jump
        if (now == root).all():
            break
        root = now
    return root


def _link_tasks(batches: Iterator[pa.RecordBatch], max_bits: int, max_node: int) -> Iterator[pa.RecordBatch]:
    """Rows (task, depth, bits, second, key, fp) sorted by task, second and key;
    yields the stars of each task's links."""
    def linked(rows: pa.Table) -> pa.RecordBatch:
        task, depth, bits = (rows[c].to_numpy() for c in ("task", "depth", "bits"))
        fp, second = rows["fp"].to_numpy(), rows["second"].to_numpy()
        values = rows["key"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)  # undoes the shift that sorting needs
        starts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]]))
        ends = np.concatenate([starts[1:], [len(task)]])
        turn = np.concatenate([[0], np.cumsum(second)])
        cross = turn[ends] - turn[starts]
        mids = ends - cross
        top = bits[starts]
        pairs = np.where((cross > 0)[:, None], np.stack([starts, mids, mids, ends, top], 1),
                         np.stack([starts, ends, starts, ends, top], 1)).astype(np.int64)
        a, b = [], []
        load = np.cumsum((ends - starts) ** 2) // (4 * max_node * max_node)  # some tasks at a time bound the walk's memory
        depths = depth[starts]
        for key in np.unique(np.stack([load, depths], 1), axis=0):
            x, y = walk(values, pairs[(load == key[0]) & (depths == key[1])], int(key[1]), max_bits)
            a.append(x)
            b.append(y)
        root = local_roots(len(task), np.concatenate(a), np.concatenate(b))
        moved = np.flatnonzero(root != np.arange(len(task)))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], ["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.num_rows < 8 * max_node:
            continue
        task = held["task"].to_numpy()
        cut = int(np.argmax(task == task[-1]))  # the last task may go on
        if cut:
            yield linked(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield linked(held)


# ---- the distributed part -----------------------------------------------------

def _node(depth: str = "depth") -> Column:
    """The top ``depth`` bits of a key."""
    return F.expr(f"shiftrightunsigned(key, 64 - {depth})")


def _at_round(forest: DataFrame, turn: int) -> DataFrame:
    deep = forest.withColumn("depth", F.least(F.lit(64), F.col("start") + turn * STEP))
    return deep.withColumn("top", _node())


def _tasks(forest: DataFrame, max_bits: int, max_node: int) -> list[DataFrame]:
    """Node pairs (order, depth, top_a, top_b, bits) that fit into one task, by
    the round that reached them.

    ``forest`` has (order, start, key); a node is the rows of an order whose
    keys share the top ``depth`` bits.  The first pairs are the equal nodes just
    below the two shared blocks; pairs over ``max_node`` fingerprints a side
    become the pairs of their children.
    """
    alone = _at_round(forest, 0).groupBy("order", "depth", "top").count().filter("count > 1")
    pairs = alone.select("order", "depth", F.col("top").alias("top_a"), F.col("top").alias("top_b"),
                         F.lit(0).alias("bits"), F.col("count").alias("n_a"), F.col("count").alias("n_b"))
    out: list[DataFrame] = []
    while True:
        pairs = cut_lineage(pairs, "pairs")
        cold = F.col("n_a") + F.col("n_b") <= 2 * max_node
        out.append(pairs.filter(cold).drop("n_a", "n_b"))
        hot = pairs.filter(~cold)
        if hot.isEmpty():  # so at depth 64 at the latest: nodes are single fingerprints
            return out
        nodes = hot.select("order", F.col("top_a").alias("top")).unionAll(hot.select("order", F.col("top_b").alias("top"))).distinct()
        deeper = _at_round(forest, len(out)).select("order", F.col("depth").alias("below"), F.col("top").alias("child"), "key", "start")
        inside = _at_round(deeper, len(out) - 1).join(nodes, ["order", "top"], "left_semi")
        children = cut_lineage(inside.groupBy("order", "depth", "below", "top", "child").count(), "children")
        a = children.select("order", "depth", "below", F.col("top").alias("top_a"), F.col("child").alias("child_a"), F.col("count").alias("m_a"))
        b = children.select("order", F.col("top").alias("top_b"), F.col("child").alias("child_b"), F.col("count").alias("m_b"))
        apart = F.expr("bits + bit_count((child_a ^ child_b) & (shiftleft(1L, below - depth) - 1))").cast("int")
        pairs = (hot.select("order", "depth", "top_a", "top_b", "bits").join(a, ["order", "depth", "top_a"]).join(b, ["order", "top_b"])
                 .filter("top_a <> top_b or child_a <= child_b").withColumn("bits", apart)
                 .filter(F.col("bits") <= max_bits).filter("child_a <> child_b or m_a > 1")
                 .select("order", F.col("below").alias("depth"), F.col("child_a").alias("top_a"), F.col("child_b").alias("top_b"),
                         "bits", F.col("m_a").alias("n_a"), F.col("m_b").alias("n_b")))


def fingerprint_links(fps: DataFrame, max_bits: int = 4, max_node: int = 1024) -> DataFrame:
    """Links ``(a, b)`` that connect the same fingerprints as all pairs within
    ``max_bits`` do.  ``fps`` has one distinct long column ``fp``."""
    count = max_bits + 2
    lengths, orders = _blocks(count), _orders(count)
    each = F.array(*[F.struct(F.lit(k).alias("order"), F.lit(lengths[o[0]] + lengths[o[1]]).alias("start"),
                              _permuted(F.col("fp"), o, lengths).alias("key")) for k, o in enumerate(orders)])
    forest = fps.select("fp", F.explode(each).alias("at")).select("fp", "at.order", "at.start", "at.key")
    found = None
    for turn, tasks in enumerate(_tasks(forest, max_bits, max_node)):
        named = tasks.withColumn("task", F.xxhash64("order", "depth", "top_a", "top_b"))
        first = named.select("task", "order", "bits", F.col("top_a").alias("top"), F.lit(0).alias("second"))
        second = named.filter("top_a <> top_b").select("task", "order", "bits", F.col("top_b").alias("top"), F.lit(1).alias("second"))
        rows = _at_round(forest, turn).join(first.unionAll(second), ["order", "top"])
        found = rows if found is None else found.unionAll(rows)
    sortable = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))  # signed order of the unsigned key
    rows = found.select("task", "depth", "bits", "second", sortable.alias("key"), "fp")
    rows = rows.repartition("task").sortWithinPartitions("task", "second", "key")
    return rows.mapInArrow(lambda it: _link_tasks(it, max_bits, max_node), "a long, b long")


def near_duplicates(df: DataFrame, shingle: int = 4, max_bits: int = 4, text_col: str = "text", id_col: str = "doc_id",
                    max_node: int = 1024, fp_col: str = "fp", component_col: str = "component_id") -> DataFrame:
    """``df`` with its long fingerprint and the smallest id that its links reach."""
    arrow_rows(df)
    marked = df.withColumn(fp_col, simhash(F.col(text_col), shingle))
    ids = cut_lineage(marked.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("least")), "fingerprints")
    links = fingerprint_links(ids.select("fp"), max_bits, max_node)
    roots = ids.join(connected(links).select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("least").alias(component_col))
    named = roots.join(least, "root").select(F.col("fp").alias(fp_col), component_col)
    return marked.join(named, fp_col)


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(df: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each near-duplicate component: the one with the smallest
    doc_id (rows without an id: one of each fingerprint in a component that has
    no id at all); the columns of ``df``."""
    fp, comp = free_name(df, "fp"), free_name(df, "component_id")
    found = near_duplicates(df, shingle, max_bits, fp_col=fp, component_col=comp)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col(comp)))
    return kept.dropDuplicates([fp, "doc_id"]).select(*df.columns)
