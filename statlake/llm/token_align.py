"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

A text's tokens under A (byte-level BPE) and B (pieces with byte fallback) are
cut into groups at the byte offsets where tokens of both end; all A-B pairs of a
group's occurrences are links, and a pair's count is the number of documents
that hold it linked.

Identity-map fast path: ``same`` gives for each A id the B id with the same bytes.  A
group of one A and one B token has the same bytes on both sides, so it is an
entry of that map (unless B has a second id for these bytes), and the documents
that hold it are counted in vectors as long as A's vocabulary, added up
elementwise.  Only the pairs of irregular groups are shuffled: distinct per
slice of documents, summed by pair, and given back to the slices that hold them,
so that documents are dealt out once and a hot pair sends one row a slice.  Each A
id's best count is again a vector as long as the vocabulary.

Defined results: a null or empty text, or one whose tokens' bytes are not its
own (such as one with the mark that B writes for a space), has no tokens: zeros
and no groups.  Every row counts as a document, repeated rows too.  Only the id and what
is found are returned, so other columns cannot clash; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.bounded import sum_vectors, vector_rows
from statlake.llm.bpe_tree import byte_alphabet, read_vocab
from statlake.llm.common import arrow_rows
from statlake.llm.ngrams import slices, text_bytes
from statlake.llm.worker import held
from statlake.session import cut_lineage

#: How byte-level BPE cuts a text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The mark that stands for a space in pieces (fixed value).
MARK = "▁"
#: Text of the documents that share one slice of pair counts.
SLICE_TEXT = 8 << 20
#: Groups with more links than this are counted by distinct ids.
MANY_LINKS = 4096
CHUNKS = 16

ALIGNED = ("slice long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "same_ids array<int>, same_times array<long>, pairs array<long>, pair_times array<long>")


class Vocabularies:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, a_data: bytes, b_data: bytes):
        import sentencepiece
        import tiktoken

        spec = json.loads(a_data)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or model["type"] != "BPE":
            raise ValueError("tokenizer A must be byte-level BPE without a normalizer")
        ids = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(x >= y for x, y in zip(ids, ids[1:])):
            raise ValueError("ids of tokenizer A must follow its merge ranks")
        special = {t["content"] for t in spec["added_tokens"]}
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in model["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_data)
        self.size_a = 1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.size_b = self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for data, i in ranks.items():
            self.bytes_a[i] = data
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        b_id = {data: i for i, data in reversed([*enumerate(self.bytes_b)])}
        self.same = np.array([b_id.get(data, -1) if data else -1 for data in self.bytes_a], np.int64)
        # what each token adds to the groups' text: first of its group or not
        self.shown = [b"%s%d" % (sep, i) for seps, size in (((b";", b","), self.size_a), ((b"|", b","), self.size_b)) for sep in seps for i in range(size)]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [self.a.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) if t else np.empty(0, np.int64) for t in texts]
        b = [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)] if texts else []
        return a, b


def _vocabularies(shared) -> Vocabularies:
    """The worker's pair of tokenizers."""
    a_data, b_data = shared.value
    return held(("aligned", len(a_data), hash(a_data), hash(b_data)), lambda: Vocabularies(a_data, b_data))


def _bytes_differ(v: Vocabularies, texts: list[str], a: list[np.ndarray], b: list[np.ndarray], raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Which texts' tokens do not spell out a space and the text."""
    sizes = np.diff(edges) + 1
    bad = np.array([v.len_a[x].sum() != n or v.len_b[y].sum() != n for x, y, n in zip(a, b, sizes)], bool)
    bad |= sizes == 1
    for i in np.flatnonzero(~bad):
        want = b" " + raw[edges[i]:edges[i + 1]].tobytes()
        bad[i] = b"".join(map(v.bytes_b.__getitem__, b[i].tolist())) != want or b"".join(map(v.bytes_a.__getitem__, a[i].tolist())) != want
    return bad


def _times(key: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sum of their times."""
    if times is None:
        return np.unique(key, return_counts=True)
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(times, first) if len(first) else times


def _irregular_pairs(group: np.ndarray, na: np.ndarray, nb: np.ndarray, a0: np.ndarray, b0: np.ndarray, a: np.ndarray, b: np.ndarray, doc: np.ndarray,
                     size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, times) of the links of ``group``; small groups are
    spelled out, in large ones equal ids count together."""
    large = group[na[group] * nb[group] > MANY_LINKS]
    group = group[na[group] * nb[group] <= MANY_LINKS]
    links = na[group] * nb[group]
    which = np.repeat(np.arange(len(group)), links)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(links) - links, links)
    width = nb[group][which]
    pair = a[a0[group][which] + nth // width] * size_b + b[b0[group][which] + nth % width]
    docs, pairs, times = [doc[group][which]], [pair], [np.ones(len(pair), np.int64)]
    for g in large.tolist():
        x, tx = np.unique(a[a0[g]:a0[g] + na[g]], return_counts=True)
        y, ty = np.unique(b[b0[g]:b0[g] + nb[g]], return_counts=True)
        pairs.append((x[:, None] * size_b + y[None, :]).ravel())
        times.append((tx[:, None] * ty[None, :]).ravel())
        docs.append(np.full(len(pairs[-1]), doc[g]))
    return np.concatenate(docs), np.concatenate(pairs), np.concatenate(times)


def _lists(values: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, kind))


def _align(v: Vocabularies, texts: pa.Array) -> list[pa.Array]:
    """Columns n_a ... pair_times of ``ALIGNED`` for a slice of texts."""
    raw, edges = text_bytes(texts)
    strings = texts.to_pylist()
    n = len(strings)
    lists_a, lists_b = v.encode(strings)
    bad = _bytes_differ(v, strings, lists_a, lists_b, raw, edges)
    for i in np.flatnonzero(bad):
        lists_a[i] = lists_b[i] = np.empty(0, np.int64)
    n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (lists_a, lists_b))
    a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (lists_a, lists_b))
    end_a, end_b = np.cumsum(v.len_a[a]), np.cumsum(v.len_b[b])
    total = int(end_a[-1]) if len(end_a) else 0
    ends = np.zeros(total + 1, np.int8)
    ends[end_a] += 1
    ends[end_b] += 1
    shut_a, shut_b = ends[end_a] == 2, ends[end_b] == 2  # the last token of its group
    group_a, group_b = np.cumsum(shut_a) - shut_a, np.cumsum(shut_b) - shut_b
    groups = int(shut_a.sum())
    na, nb = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    a0, b0 = np.cumsum(na) - na, np.cumsum(nb) - nb
    doc = np.repeat(np.arange(n), n_a)[a0] if groups else np.empty(0, np.int64)
    n_groups = np.bincount(doc, minlength=n)
    n_links = np.bincount(doc, weights=(na * nb).astype(np.float64), minlength=n).astype(np.int64)

    # the text of the groups: A's tokens of a group, then B's
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + b0[group_a]] = a + np.where(a0[group_a] == np.arange(len(a)), 0, v.size_a)
    order[np.arange(len(b)) + (a0 + na)[group_b]] = b + 2 * v.size_a + np.where(b0[group_b] == np.arange(len(b)), 0, v.size_b)
    shown, at = v.shown.__getitem__, np.cumsum(n_a + n_b) - (n_a + n_b)
    digests = [hashlib.sha256(b"".join(map(shown, order[i:i + k].tolist()))[1:]).hexdigest() if k else "" for i, k in zip(at.tolist(), (n_a + n_b).tolist())]

    one = (na == 1) & (nb == 1)
    one[one] = v.same[a[a0[one]]] == b[b0[one]]
    regular = np.flatnonzero(one)
    same_key, same_times = _times(doc[regular] * v.size_a + a[a0[regular]])
    where, pair, times = _irregular_pairs(np.flatnonzero(~one), na, nb, a0, b0, a, b, doc, v.size_b)
    span = v.size_a * v.size_b
    pair_key, pair_times = _times(where * span + pair, times)
    # a pair of the identity map in an irregular group: counted once a document
    where, pair = pair_key // span, pair_key % span
    mapped = v.same[pair // v.size_b] == pair % v.size_b
    key = where * v.size_a + pair // v.size_b
    place = np.minimum(np.searchsorted(same_key, key), max(0, len(same_key) - 1))
    both = mapped & (same_key[place] == key) if len(same_key) else np.zeros(len(key), bool)
    np.add.at(same_times, place[both], pair_times[both])
    where, pair, pair_times = where[~both], pair[~both], pair_times[~both]

    rows = np.arange(n + 1)
    same_edges, pair_edges = np.searchsorted(same_key // v.size_a, rows), np.searchsorted(where, rows)
    return [*(pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, n_links)), pa.array(digests, pa.string()),
            _lists(same_key % v.size_a, same_edges, pa.int32()), _lists(same_times, same_edges, pa.int64()),
            _lists(pair, pair_edges, pa.int64()), _lists(pair_times, pair_edges, pa.int64())]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the rows' edges in them."""
    edges = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[edges[0]:edges[-1]] if len(column) else np.empty(0, np.int64), edges - edges[0]


@dataclass
class Counts:
    """Counts that are bounded by A's vocabulary: documents that hold each
    identity pair, and each A id's highest pair count."""

    same: np.ndarray
    best: np.ndarray


def aligned(df: DataFrame, shared, id_col: str, text_col: str) -> DataFrame:
    """A row for each row of ``df`` with its groups, digests and distinct links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabularies(shared)
        number, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                out = _align(v, texts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(texts), number, np.int64)), batch.column("id").slice(first, len(texts)), *out],
                                                 [c.split()[0] for c in ALIGNED.split(", ")])
                size += texts.nbytes
                if size > SLICE_TEXT:
                    number, size = number + 1, 0

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(work, ALIGNED)


def _same_counts(found: DataFrame, size_a: int) -> np.ndarray:
    """Documents that hold each identity pair in a regular group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size_a, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0))[0], minlength=size_a)
        number, data = vector_rows(total, CHUNKS)
        yield pa.RecordBatch.from_arrays([number, data], ["chunk", "counts"])

    got = sum_vectors(found.select("same_ids").mapInArrow(count, "chunk int, counts binary"))
    return got if len(got) else np.zeros(size_a, np.int64)


def _pair_counts(found: DataFrame, v: Vocabularies) -> tuple[DataFrame, Counts]:
    """(slice, pair, count) of the irregular pairs of each slice, and the vectors."""
    size_a, size_b, shared_same = v.size_a, v.size_b, v.same
    in_slices = found.select("slice", F.explode("pairs").alias("pair")).groupBy("slice", "pair").agg(F.count("*").alias("n"))
    in_slices = cut_lineage(in_slices, "slice-pairs")
    same = _same_counts(found, size_a)
    vectors = found.sparkSession.sparkContext.broadcast((shared_same, same))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, count = vectors.value
        for batch in batches:
            pair, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            a = pair // size_b
            mapped = to[a] == pair % size_b
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n + np.where(mapped, count[a], 0)), pa.array(a), pa.array(mapped)], ["pair", "count", "a", "mapped"])

    totals = in_slices.groupBy("pair").agg(F.sum("n").alias("n")).mapInArrow(whole, "pair long, count long, a long, mapped boolean")
    totals = cut_lineage(totals, "pair-counts")
    best = same.copy()
    for row in totals.groupBy("a").agg(F.max("count").alias("best")).toArrow().to_pylist():  # a row for each A id at most
        best[row["a"]] = max(best[row["a"]], row["best"])
    for row in totals.filter("mapped").select("a", "count").toArrow().to_pylist():  # likewise
        same[row["a"]] = row["count"]
    return in_slices.join(totals, "pair").select("slice", "pair", "count"), Counts(same, best)


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every row; see the module's text."""
    arrow_rows(df)
    a_data, b_data = read_vocab(a_path), read_vocab(b_path)
    v = Vocabularies(a_data, b_data)
    sc = df.sparkSession.sparkContext
    shared, size_b = sc.broadcast((a_data, b_data)), v.size_b
    found = cut_lineage(aligned(df, shared, id_col, text_col), "aligned")
    per_slice, counts = _pair_counts(found, v)
    vectors = sc.broadcast(counts)

    def scored(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        known = vectors.value
        order = np.argsort(pairs["pair"].to_numpy())
        pair, count = pairs["pair"].to_numpy()[order], pairs["count"].to_numpy()[order]
        docs = docs.combine_chunks()
        col = lambda name: docs[name].combine_chunks() if docs.num_rows else pa.array([], docs.schema.field(name).type)
        ids, edges = _flat(col("same_ids"))
        times = _flat(col("same_times"))[0]
        who = np.repeat(np.arange(docs.num_rows), np.diff(edges))
        ids2, edges2 = _flat(col("pairs"))
        times2 = _flat(col("pair_times"))[0]
        who2 = np.repeat(np.arange(docs.num_rows), np.diff(edges2))
        count2 = count[np.searchsorted(pair, ids2)] if len(ids2) else np.empty(0, np.int64)
        who, times, best = np.concatenate((who, who2)), np.concatenate((times, times2)), known.best[np.concatenate((ids, ids2 // size_b))]
        count = np.concatenate((known.same[ids], count2))
        n_best, total = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
        np.add.at(n_best, who, np.where(count == best, times, 0))
        np.add.at(total, who, times * count)
        return pa.table({id_col: docs["id"], **{c: docs[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": n_best, "count_sum": total, "groups_sha256": docs["groups_sha256"]})

    return (found.groupBy("slice").cogroup(per_slice.groupBy("slice"))
            .applyInArrow(scored, f"`{id_col}` long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
