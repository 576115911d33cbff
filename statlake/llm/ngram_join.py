"""N-gram Jaccard join by prefix trees.

A document's set holds its distinct word n-grams, in one global order: rare
first, by the counts of hash buckets over all documents (a vector of fixed
size), ties by hash.  Two sets of sizes x <= y with Jaccard similarity of at
least ``percent`` share ``need = ceil(percent (x + y) / (100 + percent))``
n-grams, so an n-gram of the smaller one's first ``x - need(x, x) + 1`` is among the
larger one's first ``y - ceil(percent y / 100) + 1``.

1. Equal sets are one class, known by a 64-bit digest; only classes are joined.
2. N-grams in the leading parts of two classes or more are the roots of the trees.
   Leading parts are a little longer than one shared n-gram needs: each n-gram more
   means one more that similar sets must share there, so classes with
   fewer shared ones drop out (twice, as roots drop out with them).  The others keep their leading part and a parity signature: a bit for
   each of ``SIGNATURE`` hash classes, set if their number in the set is odd.  Two
   signatures never differ in more bits than the sets differ in n-grams.
3. Dense groups are settled with as many checks as rows: each class is paired with
   three classes of each of its roots (the least by three hashes), and the trees
   of step 4 add, for each root, the closest pairs that join the groups so found.
4. Roots whose classes are not yet in one component: what follows the root in
   the leading parts of possible smaller sides is stored in a trie, and the
   larger sides walk it level by level, many at a time.  Sets with a common beginning
   share the overlap counted on it.  A subtree is left as soon as the overlap so far
   plus the lesser remaining length falls below need, its sizes do not fit or it
   lies within the walker's own component.  Pairs that reach an end and whose
   signatures do not differ too much are checked on the whole sets; a pair that
   shares an n-gram just before the root is left to that root.  A root with many
   classes is dealt out as a grid of blocks.

Every similar pair of different components meets in step 4, so none is lost; pairs
inside a component are not listed.

Defined results: null, empty and word-less texts have size 0, are linked with
nothing and form their own component; rows with equal ids keep their own sizes and
get the least component of their sets; a null id counts as no smallest id (null if no member
has one); an empty table gives an empty table.  Only the id and what is found are
returned, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlake.llm.bounded import bitmap, in_bitmap, sum_vectors, vector_rows
from statlake.llm.common import arrow_rows
from statlake.llm.components import connected
from statlake.llm.ngrams import Words, distinct, mix, per_slice, shingles, sort_each
from statlake.session import cut_lineage

#: Hash buckets whose counts give the global order.
BUCKETS = 1 << 20
CHUNKS = 64
#: Bits of the filter of root n-grams and of that of classes.
ROOT_BITS, CLASS_BITS = 27, 24
#: Bits of a set's parity signature.
SIGNATURE = 1024
#: N-grams after a root that go into its tree.
DEPTH = 24
#: Roots of each class whose trees settle dense groups.
FEW_ROOTS = 8
#: N-grams before a root that go with it, to leave a pair to its first root.
BEFORE = 8
#: Rows of each side in a block of a root's grid.
BLOCK = 1024
#: Pairs of a walker and a tree node that are looked at together.
WALK = 1 << 15


@dataclass(frozen=True)
class Rule:
    """At least ``percent`` Jaccard similarity of ``words``-word n-grams."""

    words: int = 4
    percent: int = 85

    def need(self, both):
        """Shared n-grams that sets with ``both`` n-grams together must have."""
        return -(-self.percent * both // (100 + self.percent))

    def most_apart(self, both):
        """N-grams that only one of two similar sets has, at most."""
        return both - 2 * self.need(both)

    def least_met(self, n):
        """N-grams that the leading parts of similar sets of ``n`` share at least."""
        return 1 + n // 50

    def lead(self, n):
        """Length of the leading part: a set whose part is as long, less all but one
        of those shared, could still share one n-gram with any similar set."""
        return n + (-self.percent * n // 100) + self.least_met(n)

    def smallest(self, n):
        """Size of the smallest set that can be similar to one of ``n``."""
        return -(-self.percent * n // 100)

    def holds(self, shared, both):
        return 100 * shared >= self.percent * (both - shared)

    def band(self, n: Column) -> Column:
        """Sizes of similar sets are in one band or in neighbouring ones."""
        return F.floor(F.log(n.cast("double")) / math.log(100 / (self.percent - 1))).cast("int")


def _digests(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One 64-bit digest of each set (0 for the empty one)."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(1)), dtype=np.uint64)))
    size = np.diff(edges).astype(np.uint64)
    return np.where(size > 0, mix((sums[edges[1:]] - sums[edges[:-1]]) ^ mix(size)) | np.uint64(1), np.uint64(0))


def _order_keys(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Rare first: nine bits for the bucket's count (logarithmic), then the hash."""
    return levels[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)] << np.uint64(54) | hashes >> np.uint64(10)


def _leads(hashes: np.ndarray, edges: np.ndarray, levels: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Order keys of the sets, each in order, and which are in a leading part."""
    keys = _order_keys(hashes, levels)
    sort_each(keys, edges)
    n = np.diff(edges)
    return keys, np.arange(len(keys)) - np.repeat(edges[:-1], n) < np.repeat(rule.lead(n), n)


def _signatures(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A row of bytes for each set, see step 2."""
    sets = len(edges) - 1
    place = np.repeat(np.arange(sets), np.diff(edges)) * SIGNATURE + (hashes >> np.uint64(22) & np.uint64(SIGNATURE - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=sets * SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8).reshape(sets, SIGNATURE), axis=1)


def _sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    found = Words(texts)
    return distinct(*shingles(found, words), len(texts))


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64), pa.int64())


def _classes_and_counts(docs: DataFrame, rule: Rule) -> DataFrame:
    """(id, n, class) of every row and, as further rows, the bucket counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)

        def rows(part: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
            hashes, edges = _sets(texts, rule.words)
            counts.__iadd__(np.bincount((hashes & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS))
            none = pa.nulls(len(texts))
            return pa.RecordBatch.from_arrays([part.column("id"), _longs(np.diff(edges)), _longs(_digests(hashes, edges)), none.cast(pa.int32()), none.cast(pa.binary())],
                                              ["id", "n", "class", "chunk", "counts"])

        yield from per_slice(batches, "text", rows)
        if counts.any():
            number, data = vector_rows(counts, CHUNKS)
            none = pa.nulls(CHUNKS, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, number, data], ["id", "n", "class", "chunk", "counts"])

    return docs.mapInArrow(work, "id long, n long, class long, chunk int, counts binary")


def _leading_rows(docs: DataFrame, rule: Rule, levels) -> DataFrame:
    """(key, class): the n-grams of the sets' leading parts."""

    def rows(part: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        hashes, edges = _sets(texts, rule.words)
        keys, lead = _leads(hashes, edges, levels.value, rule)
        return pa.RecordBatch.from_arrays([_longs(keys[lead]), _longs(np.repeat(_digests(hashes, edges), np.diff(edges))[lead])], ["key", "class"])

    return docs.select("text").mapInArrow(lambda b: per_slice(b, "text", rows), "key long, class long")


def _first_of_class(classes: np.ndarray, take: np.ndarray) -> np.ndarray:
    """``take`` without the further copies of a class in this slice."""
    first = np.zeros(len(classes), bool)
    first[np.unique(classes, return_index=True)[1]] = True
    return take & first


def _fronts(docs: DataFrame, rule: Rule, levels, roots) -> DataFrame:
    """(class, n, lead, signature) of the classes that may have a root, one row each."""

    def rows(part: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        hashes, edges = _sets(texts, rule.words)
        keys, lead = _leads(hashes, edges, levels.value, rule)
        classes, n = _digests(hashes, edges), np.diff(edges)
        shared = np.bincount(np.repeat(np.arange(len(n)), n)[lead][in_bitmap(roots.value, mix(keys[lead]))], minlength=len(n))
        take = _first_of_class(classes, (n > 0) & (shared >= rule.least_met(rule.smallest(n))))
        kept = lead & np.repeat(take, n)
        offsets = np.concatenate(([0], np.cumsum(rule.lead(n)[take])))
        signatures = _signatures(hashes, edges)
        return pa.RecordBatch.from_arrays([
            _longs(classes[take]), _longs(n[take]), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _longs(keys[kept])),
            pa.array([signatures[i].tobytes() for i in np.flatnonzero(take)], pa.binary())], ["class", "n", "lead", "signature"])

    found = docs.select("text").mapInArrow(lambda b: per_slice(b, "text", rows), "class long, n long, lead array<long>, signature binary")
    return found.dropDuplicates(["class"])


def _sets_of(docs: DataFrame, rule: Rule, wanted: DataFrame) -> DataFrame:
    """(class, values): all hashes, ascending, of the classes in ``wanted`` (and
    of a few more that its filter lets through), one row a class."""
    chosen = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "class", CLASS_BITS))

    def rows(part: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        hashes, edges = _sets(texts, rule.words)
        classes, n = _digests(hashes, edges), np.diff(edges)
        take = _first_of_class(classes, in_bitmap(chosen.value, classes) & (n > 0))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n[take]))), pa.int32()), _longs(hashes[np.repeat(take, n)]))
        return pa.RecordBatch.from_arrays([_longs(classes[take]), lists], ["class", "values"])

    return docs.select("text").mapInArrow(lambda b: per_slice(b, "text", rows), "class long, values array<long>").dropDuplicates(["class"])


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of signatures: at most the n-grams that only one set has."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def _signature_rows(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), SIGNATURE // 64)


def _alike(pairs: DataFrame, fronts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow them to be similar."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_signature_rows(batch.column(c)) for c in ("x", "y"))
            both = batch.column("both").to_numpy()
            yield batch.filter(pa.array(_apart(x, y) <= rule.most_apart(both))).select(["a", "b"])

    x = fronts.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("signature").alias("x"))
    y = fronts.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", (F.col("na") + F.col("nb")).alias("both")).mapInArrow(keep, "a long, b long")


def _checked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of classes that are similar, found on their whole sets."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                lo, hi = sorted((len(x), len(y)))
                keep.append(rule.holds(lo, lo + hi) and rule.holds(len(np.intersect1d(x, y, assume_unique=True)), lo + hi))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    x = sets.select(F.col("class").alias("a"), F.col("values").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("values").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(similar, "a long, b long")


# ---- the trees of a task ----------------------------------------------------


def _first_of(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For equal rows: a number of each row, and the first row of each number."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


class Forest:
    """Tries of the stored rows of many roots; level by level, nodes are numbered
    in the order of (parent, n-gram), so a node's children are consecutive."""

    def __init__(self, root: np.ndarray, n_roots: int, paths: np.ndarray, depth: np.ndarray, n: np.ndarray, rest: np.ndarray, label: np.ndarray):
        self.levels: list[dict[str, np.ndarray]] = []
        rows, at, count, d = np.arange(len(root)), root, n_roots, 0
        gram = np.zeros(n_roots, np.int32)
        while True:
            big = np.iinfo(np.int64).max
            level = {"gram": gram, "least": np.full(count, big), "most": np.zeros(count, np.int64), "rest": np.zeros(count, np.int64),
                     "label_lo": np.full(count, big), "label_hi": np.full(count, -big - 1)}
            for name, values, put in (("least", n, np.minimum), ("most", n, np.maximum), ("rest", rest, np.maximum), ("label_lo", label, np.minimum), ("label_hi", label, np.maximum)):
                put.at(level[name], at, values[rows])
            over = depth[rows] == d
            order = np.argsort(at[over], kind="stable")
            level["ends"], level["end_edges"] = rows[over][order], np.searchsorted(at[over][order], np.arange(count + 1))
            self.levels.append(level)
            rows, at = rows[~over], at[~over]
            if not len(rows):
                level["child_edges"] = np.zeros(count + 1, np.int64)
                return
            number, first = _first_of(at, paths[rows, d])
            level["child_edges"] = np.searchsorted(at[first], np.arange(count + 1))
            gram, at, count, d = paths[rows[first], d], number, len(first), d + 1


def _spread(edges: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, every number in [edges[at[i]], edges[at[i] + 1]): (i, number)."""
    size = edges[at + 1] - edges[at]
    who = np.repeat(np.arange(len(at)), size)
    return who, np.arange(len(who)) - np.repeat(np.cumsum(size) - size - edges[at], size)


def walk(forest: Forest, root: np.ndarray, paths: np.ndarray, depth: np.ndarray, n: np.ndarray, rest: np.ndarray, label: np.ndarray, cls: np.ndarray,
         stored: dict[str, np.ndarray], rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """(walker, stored row) of every pair that the bounds leave.

    The rows walk their root's tree together.  ``used`` counts a walker's and
    ``gone`` a path's n-grams behind them, ``shared`` the common ones, the root
    included; what lies behind the known part of a walker counts as possible."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    shared = np.ones(len(root), np.int64)
    todo = [(0, np.arange(len(root)), root, np.zeros(len(root), np.int64), np.zeros(len(root), np.int64), shared)]
    while todo:
        d, who, node, used, gone, shared = todo.pop()
        level = forest.levels[d]
        most_shared = shared + np.minimum(rest[who] - 1 - used, level["rest"][node] - 1 - gone)
        ok = (most_shared >= rule.need(n[who] + np.maximum(level["least"][node], -(-rule.percent * n[who] // 100))))
        ok &= (level["least"][node] <= n[who]) & (100 * level["most"][node] >= rule.percent * n[who])
        ok &= (level["label_lo"][node] != label[who]) | (level["label_hi"][node] != label[who])
        who, node, used, gone, shared = (x[ok] for x in (who, node, used, gone, shared))
        if not len(who):
            continue
        i, end = _spread(level["end_edges"], node)
        end = level["ends"][end]
        w = who[i]
        last = (shared[i] + np.minimum(rest[w] - 1 - used[i], stored["rest"][end] - 1 - gone[i]) >= rule.need(n[w] + stored["n"][end])) & (stored["label"][end] != label[w])
        last &= (stored["n"][end] < n[w]) | ((stored["n"][end] == n[w]) & (stored["class"][end] != cls[w]))
        found.append((w[last], end[last]))
        i, child = _spread(level["child_edges"], node)
        for a in range(0, len(i), WALK):
            part, kid = i[a:a + WALK], child[a:a + WALK]
            w, gram = who[part], forest.levels[d + 1]["gram"][kid]
            at = (paths[w] < gram[:, None]).sum(axis=1)  # beyond the known part the padding is larger than any n-gram
            known = at < depth[w]
            hit = known & (paths[w, np.minimum(at, paths.shape[1] - 1)] == gram)
            todo.append((d + 1, w, kid, np.where(hit, at + 1, at), gone[part] + known, shared[part] + hit))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _spanning(root: np.ndarray, a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Which pairs, the closest first, join labels that no earlier pair of their
    root has joined: fewer pairs than labels."""
    number, first = _first_of(np.concatenate((root, root)), np.concatenate((a, b)))
    parent = list(range(len(first)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    keep = []
    for i in np.argsort(apart, kind="stable").tolist():
        x, y = find(number[i]), find(number[i + len(a)])
        if x != y:
            parent[x] = y
            keep.append(i)
    return np.array(keep, np.int64)


def _meet_before(before: pa.ListArray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows ``x`` and ``y`` share one of the n-grams just before their
    root: then they meet at that root as well, with more in common."""
    starts, sizes = before.offsets.to_numpy()[:-1], np.diff(before.offsets.to_numpy())
    flat = np.append(before.values.to_numpy(), np.int64(-1))
    column = np.arange(BEFORE)

    def grid(rows: np.ndarray, none: int) -> np.ndarray:
        inside = column[None, :] < sizes[rows][:, None]
        return np.where(inside, flat[np.where(inside, starts[rows][:, None] + column[None, :], len(flat) - 1)], none)

    return (grid(x, -1)[:, :, None] == grid(y, -2)[:, None, :]).any(axis=(1, 2))


def _tree_pairs(table: pa.Table, rule: Rule, spanning: bool) -> pa.RecordBatch:
    """Pairs of classes left by the trees of whole blocks of roots; with
    ``spanning``, only as many as join their labels."""
    root = _first_of(*(table[c].to_numpy() for c in ("key", "band", "i", "j")))[0]
    lists = table["path"].combine_chunks()
    depth = np.minimum(np.diff(lists.offsets.to_numpy()), DEPTH).astype(np.int64)
    signatures = _signature_rows(table["signature"])
    lists_before = table["before"].combine_chunks()
    starts = lists.offsets.to_numpy()[:-1]
    beyond = np.iinfo(np.int32).max
    flat = np.append(lists.values.to_numpy(), np.int32(beyond))
    column = np.arange(max(1, int(depth.max(initial=0))))
    inside = column[None, :] < depth[:, None]
    paths = np.where(inside, flat[np.where(inside, starts[:, None] + column[None, :], len(flat) - 1)], np.int32(beyond))
    col = {c: table[c].to_numpy() for c in ("n", "rest", "label", "class")}
    store = np.flatnonzero(table["stored"].to_numpy(zero_copy_only=False))
    go = np.flatnonzero(~table["stored"].to_numpy(zero_copy_only=False))
    stored = {c: v[store] for c, v in col.items()}
    forest = Forest(root[store], int(root.max(initial=-1)) + 1, paths[store], depth[store], stored["n"], stored["rest"], stored["label"])
    w, s = walk(forest, root[go], paths[go], depth[go], col["n"][go], col["rest"][go], col["label"][go], col["class"][go], stored, rule)
    apart = np.concatenate([np.empty(0, np.int64), *(_apart(signatures[go[w[i:i + WALK]]], signatures[store[s[i:i + WALK]]]) for i in range(0, len(w), WALK))])
    near = apart <= rule.most_apart(col["n"][go][w] + stored["n"][s])
    w, s, apart = w[near], s[near], apart[near]
    if not spanning:
        earlier = np.concatenate([np.empty(0, bool), *(_meet_before(lists_before, go[w[i:i + WALK]], store[s[i:i + WALK]]) for i in range(0, len(w), WALK))])
        w, s = w[~earlier], s[~earlier]
    if spanning:
        kept = _spanning(root[go][w], col["label"][go][w], stored["label"][s], apart)
        w, s = w[kept], s[kept]
    a, b = col["class"][go][w], stored["class"][s]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.empty((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([_longs(np.ascontiguousarray(pairs[:, 0])), _longs(np.ascontiguousarray(pairs[:, 1]))], ["a", "b"])


def _whole_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """The rows, sorted by ``columns``, cut only between groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(c).to_numpy() for c in columns]
        same = np.all([v == v[-1] for v in values], axis=0)
        begin = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if begin:
            held.append(batch.slice(0, begin))
            # a group that began in an earlier batch ends here, or did there
            yield pa.Table.from_batches(held)
            held = []
        elif held and any(held[-1].column(c)[-1].as_py() != v[0] for c, v in zip(columns, values)):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _is_small(rule: Rule) -> Column:
    """Whether a row can be the smaller side of a pair that meets at its root."""
    return F.col("rest") >= F.ceil(F.lit(2 * rule.percent) * F.col("n") / (100 + rule.percent))


def _tree_candidates(rows: DataFrame, labels: DataFrame, fronts: DataFrame, rule: Rule, spanning: bool) -> DataFrame:
    """(a, b): pairs of classes with different labels that the trees leave.

    ``rows`` has (key, class, n, rest), ``labels`` the components so far."""
    is_small = _is_small(rule)
    rows = rows.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("root", "class")).drop("root")
    open_roots = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max(is_small).alias("small")).filter("lo <> hi and small").select("key")
    rows = rows.join(open_roots, "key")
    band = rule.band(F.col("n"))
    small = rows.filter(is_small).select("key", band.alias("band"), "class", "n", "rest", "label", F.lit(True).alias("stored"))
    large = rows.select("key", F.explode(F.array(band, band - 1)).alias("band"), "class", "n", "rest", "label", F.lit(False).alias("stored"))
    sizes = small.unionAll(large).groupBy("key", "band").agg(F.count_if("stored").alias("ns"), F.count_if(~F.col("stored")).alias("nl"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = sizes.filter("ns > 0 and nl > 0").select("key", "band", blocks("ns").alias("bs"), blocks("nl").alias("bl"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    grid = (small.join(sizes, ["key", "band"]).withColumns({"i": own("bs")}).withColumn("j", numbers("bl"))
            .unionByName(large.join(sizes, ["key", "band"]).withColumns({"j": own("bl")}).withColumn("i", numbers("bs"))))
    after = (F.col("n") - F.col("rest") + 2).cast("int")  # the place behind the root, counted from 1
    # 32 of an n-gram's 64 bits keep the order; two taken for one only loosen a bound
    path = F.transform(F.slice("lead", after, DEPTH), lambda k: F.shiftright(k, 32).cast("int"))
    before = F.slice("lead", F.greatest(after - (BEFORE + 1), F.lit(1)), F.least(after - 2, F.lit(BEFORE)))
    rows = grid.join(fronts.select("class", "lead", "signature"), "class").withColumns({"path": path, "before": before})
    order = ["key", "band", "i", "j"]
    dealt = rows.select(*order, "class", "n", "rest", "label", "stored", "path", "before", "signature").repartition(*order).sortWithinPartitions(*order)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, order):
            yield _tree_pairs(table, rule, spanning)

    return dealt.mapInArrow(pairs, "a long, b long").distinct()


# ---- the operator -----------------------------------------------------------


def _broadcast_levels(spark: SparkSession, counts: np.ndarray):
    counts = counts if len(counts) else np.zeros(BUCKETS, np.int64)
    return spark.sparkContext.broadcast(np.minimum(8 * np.log2(counts + 1.0), 511).astype(np.uint64))


def similar_classes(docs: DataFrame, rule: Rule, levels) -> DataFrame:
    """(a, b): links between classes that join all similar ones into components."""
    roots = _leading_rows(docs, rule, levels).groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
    roots = cut_lineage(roots.filter("lo <> hi").select("key"), "roots")
    mixed = roots.select(F.col("key").alias("raw")).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([_longs(mix(b.column(0).to_numpy().view(np.uint64)))], ["key"]) for b in batches), "key long")
    chosen = docs.sparkSession.sparkContext.broadcast(bitmap(mixed, "key", ROOT_BITS))
    fronts = cut_lineage(_fronts(docs, rule, levels, chosen), "fronts")
    rows = fronts.select("class", "n", F.posexplode("lead").alias("place", "key")).withColumn("rest", F.col("n") - F.col("place"))
    rows = rows.select("key", "class", "n", "rest").join(roots, "key").dropDuplicates(["key", "class"])
    smallest = F.ceil(F.lit(rule.percent) * F.col("n") / 100)
    for _ in range(2):
        shared = rows.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("key")
        rows = rows.join(shared, "key")
        enough = rows.groupBy("class", "n").agg(F.count("*").alias("met")).filter(F.col("met") >= 1 + F.floor(smallest / 50)).select("class")
        rows = cut_lineage(rows.join(enough, "class", "left_semi"), "rooted")
    rows = rows.filter(F.col("rest") >= smallest)  # where two similar sets can meet first

    firsts = [F.min(F.struct(F.xxhash64(F.lit(turn), "class").alias("h"), "class", "n", "rest")).alias(f"first{turn}") for turn in range(3)]
    centres = rows.groupBy("key").agg(F.max(_is_small(rule)).alias("small"), *firsts).filter("small").select("key", F.explode(F.array_distinct(F.array(
        *[F.struct(*[F.col(f"first{turn}")[c].alias(c) for c in ("class", "n", "rest")]) for turn in range(3)]))).alias("centre"))
    to = lambda c: F.col("centre")[c]
    enough = F.least("rest", to("rest")) * (100 + rule.percent) >= (F.col("n") + to("n")) * rule.percent
    stars = rows.join(centres, "key").filter((F.col("class") != to("class")) & enough)
    stars = stars.select(F.least("class", to("class")).alias("a"), F.greatest("class", to("class")).alias("b")).distinct()
    stars = cut_lineage(_alike(stars, fronts, rule), "stars")
    guessed = cut_lineage(connected(stars), "guessed")
    least = F.row_number().over(Window.partitionBy("class").orderBy(F.xxhash64("key")))
    few = rows.withColumn("turn", least).filter(F.col("turn") <= FEW_ROOTS).drop("turn")  # similar sets share their least n-grams as a rule
    first = cut_lineage(stars.unionAll(_tree_candidates(few, guessed, fronts, rule, spanning=True)).distinct(), "first")
    links = cut_lineage(_checked(first, _sets_of(docs, rule, _ends(first)), rule), "linked")
    labels = cut_lineage(connected(links), "labels")
    pairs = _tree_candidates(rows, labels, fronts, rule, spanning=False)
    pairs = cut_lineage(pairs.join(first, ["a", "b"], "left_anti"), "pairs")
    more = _checked(pairs, _sets_of(docs, rule, _ends(pairs)), rule)
    return cut_lineage(links.unionAll(more), "links")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()


def near_duplicates(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row: the size of its set and the
    least id that links reach."""
    arrow_rows(df, 4000)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    seen = cut_lineage(_classes_and_counts(docs, rule), "sets")
    levels = _broadcast_levels(df.sparkSession, sum_vectors(seen.filter("chunk is not null")))
    rows = seen.filter("chunk is null").select("id", "n", "class")
    roots = connected(similar_classes(docs, rule, levels))
    classes = rows.filter("n > 0").groupBy("class").agg(F.min("id").alias("first"))
    classes = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    classes = cut_lineage(classes, "classes")
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    found = classes.select("class", "root").join(least, "root").select("class", "component_id")
    return (rows.join(found, "class", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))
