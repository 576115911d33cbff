"""Words and n-grams of many texts at once, as 64-bit hashes in numpy arrays.

A word's hash is a polynomial over its bytes (A-Z as a-z), taken from running
sums over all bytes of a slice, then mixed; an n-gram's hash chains its words'
hashes.  Nothing here is per word or per text in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text of a batch that is worked on at a time.
SLICE_BYTES = 2 << 20
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all inputs."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, SLICE_BYTES), base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def slices(texts: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of about ``most_bytes`` of text each, nulls as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most_bytes, "right")))
        yield first, texts.slice(first, last - first)
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array without nulls, and the texts' edges in them."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8)[edges[0]:edges[-1]] if data is not None and len(texts) else np.empty(0, np.uint8)
    return whole, edges - (edges[0] if len(edges) else 0)


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table


def white_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


class Words:
    """The words of a slice of texts: ``hash``, ``text`` (row in the slice),
    ``start`` and ``end`` (bytes in ``data``, the lower-cased texts)."""

    def __init__(self, texts: pa.Array, white: bytes = WHITE):
        raw, self.edges = text_bytes(texts)
        self.data = lower_table()[raw]
        n = len(self.data)
        if n == 0:
            self.hash, self.text = np.empty(0, np.uint64), np.empty(0, np.int64)
            self.start = self.end = np.empty(0, np.int64)
            return
        inside = ~white_table(white)[raw]
        cut = np.zeros(n + 1, bool)  # a text begins here
        cut[self.edges] = True
        before = np.concatenate(([False], inside[:-1]))
        self.start = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.concatenate((inside[1:], [False]))
        self.end = np.flatnonzero(inside & (~after | cut[1:])) + 1
        up, down = _powers(n)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)))
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        self.text = np.searchsorted(self.edges, self.start, "right") - 1

    def word(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace")


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of sequences, given position by position."""
    h = mix(parts[0] + np.uint64(len(parts)))
    for p in parts[1:]:
        h = mix(h * np.uint64(0x2545F4914F6CDD1D) + p)
    return h


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``n`` words in a text, repeats included; a
    text with fewer words has one, its whole sequence, and one without has none."""
    count = len(words.hash)
    whole = np.arange(max(0, count - n + 1))
    whole = whole[words.text[whole] == words.text[whole + n - 1]] if len(whole) else whole
    texts, hashes = [words.text[whole]], [chain([words.hash[whole + i] for i in range(n)])]
    sizes = np.bincount(words.text, minlength=len(words.edges) - 1)
    firsts = np.cumsum(sizes) - sizes
    for k in range(1, n):
        short = np.flatnonzero(sizes == k)
        texts.append(short)
        hashes.append(chain([words.hash[firsts[short] + i] for i in range(k)]))
    return np.concatenate(texts), np.concatenate(hashes)


def sort_each(values: np.ndarray, edges: np.ndarray) -> None:
    """Sort the values between each two edges, in place."""
    for a, b in pairwise(edges.tolist()):
        values[a:b].sort()


def distinct(text: np.ndarray, value: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value), ordered, as values and the texts' edges in them."""
    order = np.argsort(text, kind="stable")
    text, value = text[order], value[order]
    sort_each(value, np.searchsorted(text, np.arange(n_texts + 1)))
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return value[new], np.searchsorted(text[new], np.arange(n_texts + 1))


def per_slice(batches: Iterator[pa.RecordBatch], column: str, work: Callable[[pa.RecordBatch, pa.Array], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``work(rows, texts)`` over slices of about ``SLICE_BYTES`` of text."""
    for batch in batches:
        for first, texts in slices(batch.column(column)):
            yield work(batch.slice(first, len(texts)), texts)
