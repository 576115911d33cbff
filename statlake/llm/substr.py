"""Substring dedup: seed and extend on winnowed anchors.

Seeds: of every ``length - seed + 1`` consecutive hashes of ``seed`` words the
least (ties: last) is an anchor, so a passage of ``length`` words has the same
anchor wherever it occurs, and each window of ``length`` words belongs to exactly
one anchor.  Documents are joined on their anchors; only anchors found in two or
more documents are extended: the words left and right of them are compared
through the windows that belong to the anchor (keyed by anchor and window hash,
128 bits together).  Matching windows that overlap make up the maximal repeats;
a word is removed if a window over it also starts in an earlier document.

Scale: every hot anchor or window is settled inside each task first and sends
one row on; what is settled is dealt out by document.  Groups are passed through
ordered windows that look one row back and ahead, never collected.  Texts are
shuffled once, and both joins use that exchange.

Defined results: null or empty text: no words, nothing removed; texts below
``length`` words lose nothing; rows with equal ids do not count as earlier than
each other; rows without an id come after all others, by a hash of their text;
an empty table gives an empty table; extra columns are dropped, the id and what
is found are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import arrow_rows
from statlake.llm.worker import held

_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xD6E8FEB86659FD93)
#: Text of a batch that is worked on at a time.
SLICE_BYTES = 8 << 20


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    import xxhash

    held(None)  # hashing a word anew takes less time than looking it up
    return np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(7)), np.uint64, len(found))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on (as far as there are any)."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _MIX + words[k:k + n]
    out = (out ^ (out >> np.uint64(31))) * _LAST
    return out ^ (out >> np.uint64(32))


def last_least(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the least (ties: last) of the ``size`` values from each place on,
    as far as there are so many; spans are doubled, the last two overlap."""
    best, span = np.arange(len(values)), 1
    while span < size:
        step = min(span, size - span)
        left, right = best[:-step], best[step:]
        best, span = np.where(values[right] <= values[left], right, left), span + step
    return best


class Grid:
    """Words of several texts in one row, with the anchor of each window."""

    def __init__(self, texts: list[str | None], length: int, seed: int):
        found = [split_words(t) for t in texts]
        sizes = np.array([len(w) for w in found], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        words = word_hashes(list(chain.from_iterable(found)))
        self.row = np.repeat(np.arange(len(texts)), sizes)
        ends = self.starts[1:][self.row] if len(self.row) else np.empty(0, np.int64)
        place = np.arange(len(words))
        self.window = np.flatnonzero(place + length <= ends)  # starts of windows
        self.gram = gram_hashes(words, seed)
        self.anchor = last_least(self.gram, length - seed + 1)[self.window] if len(self.window) else self.window
        self.words = words


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.unique([0, *np.searchsorted(size, np.arange(SLICE_BYTES, size[-1], SLICE_BYTES), "right"), batch.num_rows])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield pa.Table.from_batches([batch.slice(a, b - a)])


def _anchors(batches: Iterator[pa.RecordBatch], length: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Rows (text, doc) to (hash, doc, lone): each anchor of a document once.

    lone 0: not known to be shared; 1: shared, and stands for this task's other
    documents with the hash; above: shared, needs no comparison."""
    for part in _slices(batches):
        grid = Grid(part["text"].to_pylist(), length, seed)
        at = np.unique(grid.anchor)
        doc = part["doc"].to_numpy()[grid.row[at]]
        value = grid.gram[at].view(np.int64)
        order = np.lexsort((doc, value))
        value, doc = value[order], doc[order]
        if not len(value):
            continue
        fresh = np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])
        value, doc = value[fresh], doc[fresh]
        first = np.concatenate([[True], value[1:] != value[:-1]])
        group = np.cumsum(first) - 1
        shared = np.bincount(group)[group] > 1
        lone = np.where(~shared, 0, np.where(first, 1, 2 + (doc & 0xFFFF)))
        yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(doc), pa.array(lone.astype(np.int32))], ["hash", "doc", "lone"])


def _windows(batches: Iterator[pa.RecordBatch], length: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Rows (text, doc, rid, hashes) to (key, doc, rid, pos, n, h): runs of n
    windows from word pos on.  A run belongs to one shared anchor (key) and has
    its windows' hashes, or is already known to repeat an earlier document (h
    null, dealt out by document)."""
    kind = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("rid", pa.int32()), ("pos", pa.int32()), ("n", pa.int32()), ("h", pa.list_(pa.int64()))])
    for part in _slices(batches):
        grid = Grid(part["text"].to_pylist(), length, seed)
        lists = part["hashes"].combine_chunks()
        shared = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        edges = np.searchsorted(grid.row[grid.window], np.arange(part.num_rows + 1))
        own = grid.gram[grid.anchor].view(np.int64)
        hit = np.zeros(len(own), bool)
        for k in range(part.num_rows):
            a, b = edges[k], edges[k + 1]
            if a < b:
                hit[a:b] = np.isin(own[a:b], shared[ends[k]:ends[k + 1]])
        start, anchor = grid.window[hit], grid.anchor[hit]
        if not len(start):
            continue
        row = grid.row[start]
        doc, rid = part["doc"].to_numpy()[row], part["rid"].to_numpy()[row]
        key, h = own[hit], gram_hashes(grid.words, length)[start].view(np.int64)
        pos = (start - grid.starts[row]).astype(np.int32)
        order = np.lexsort((doc, h, key))
        first = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (h[order][1:] != h[order][:-1])])
        least = doc[order][np.flatnonzero(first)][np.cumsum(first) - 1]
        known = np.zeros(len(start), bool)
        known[order] = doc[order] > least
        for settled in (False, True):
            pick = np.flatnonzero(known == settled)
            if not len(pick):
                continue
            unit = row[pick] if settled else anchor[pick]  # both rise with the place
            edge = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (np.diff(start[pick]) != 1)]))
            ends = np.concatenate([edge, [len(pick)]])
            offsets = pa.array(ends, pa.int32())
            head = pick[edge]
            hashes = pa.nulls(len(head), pa.list_(pa.int64())) if settled else pa.ListArray.from_arrays(offsets, pa.array(h[pick]))
            yield pa.RecordBatch.from_arrays([pa.array(doc[head] if settled else key[head]), pa.array(doc[head]), pa.array(rid[head]),
                                              pa.array(pos[head]), pa.array(np.diff(ends).astype(np.int32)), hashes], schema=kind)


def _kept(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, rid, gone) to the kept words and their counts."""
    for batch in batches:
        out: list[tuple[int, int, str]] = []
        for text, rid, gone in zip(batch["text"], batch["rid"].to_pylist(), batch["gone"], strict=True):
            found = split_words(text.as_py())
            drop = np.zeros(len(found) + 1, np.int64)
            if gone.is_valid:
                rids, places = gone.values.field("rid").to_numpy(), gone.values.field("pos").to_numpy()
                places = np.unique(places[rids == rid])
                np.add.at(drop, places, 1)
                np.add.at(drop, places + length, -1)
            keep = np.cumsum(drop)[:-1] == 0
            rest = found if keep.all() else [w for w, k in zip(found, keep.tolist(), strict=True) if k]
            out.append((len(found), len(found) - len(rest), hashlib.sha256(b" ".join(rest)).hexdigest(), b" ".join(rest).decode("utf-8", "surrogatepass")))
        n, removed, digest, kept = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(df: DataFrame, length: int = 13, seed: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)`` for each row."""
    arrow_rows(df, 10_000)  # what repeats inside a batch is settled there
    blank = F.coalesce(F.col(text_col), F.lit(""))
    last = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(blank), 3)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), blank.alias("text"), F.hash(blank).alias("rid"),
                     F.coalesce(F.col(id_col).cast("long"), last).alias("doc"))
    anchors = docs.select("text", "doc").mapInArrow(lambda it: _anchors(it, length, seed), "hash long, doc long, lone int")
    beside = Window.partitionBy("hash", "apart").orderBy("doc")
    compared = (anchors.withColumn("apart", F.when(F.col("lone") > 1, F.col("lone")).otherwise(0))
                .withColumns({"before": F.lag("doc").over(beside), "behind": F.lead("doc").over(beside)}))
    shared = (compared.filter("lone > 0 or before is not null or behind is not null")
              .groupBy("doc").agg(F.collect_list("hash").alias("hashes")))  # at most a document's own anchors
    texts = docs.repartition("doc")
    # both joins ask for the same columns, so the exchange of the texts is reused
    seeds = texts.join(shared, "doc").select("doc_id", "text", "rid", "doc", "hashes")
    windows = seeds.mapInArrow(lambda it: _windows(it, length, seed), "key long, doc long, rid int, pos int, n int, h array<long>")
    of_run = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.struct((F.col("pos") + k).alias("pos"), F.get("h", k).alias("h")))
    each = windows.repartition("key").select("key", "doc", "rid", F.explode(of_run).alias("w")).select("key", "doc", "rid", "w.pos", "w.h")
    earliest = F.min("doc").over(Window.partitionBy("key", "h").orderBy("doc"))
    gone = (each.withColumn("earliest", earliest).filter("h is null or doc > earliest")
            .groupBy("doc").agg(F.collect_list(F.struct("rid", "pos")).alias("gone")))  # at most a document's own windows
    joined = texts.join(gone, "doc", "left").select("doc_id", "text", "rid", "doc", "gone")
    return joined.mapInArrow(lambda it: _kept(it, length), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
