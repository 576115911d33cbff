"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pre-token starts as one symbol per byte character (the last one carries the
end-of-word suffix).  The tree's leaves hold ``rank * n + position`` of each
adjacent pair (absent pairs: infinity), inner nodes the smaller child, so the
root is always the leftmost lowest-rank merge.  A merge updates three leaves in
O(log n); encoding ends when the root is infinite.  The trees of new pre-tokens
of like length are the rows of one matrix and advance together; very long ones
have a tree of their own.

The vocabulary file is read once on the driver and broadcast (its size is
checked against ``MAX_VOCAB_BYTES``), so executors need no local copy.  Each
Python worker keeps a bounded cache from words to ids, half of which goes at a time;
the decoded texts are joined from the ids by Arrow, a slice at a time.

Defined results: a null or empty text encodes to no ids and decodes to "";
extra columns are kept, repeated rows give repeated results, an empty table
gives an empty table.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import arrow_rows, free_name
from statlake.llm.worker import Recent, held, in_slices, no_cycles

#: A vocabulary file larger than this is refused rather than broadcast.
MAX_VOCAB_BYTES = 64 << 20
#: Words in each half of a worker's cache: some 25 MB a half.
CACHE_WORDS = 1 << 17
#: Longer words are not kept.
LONGEST_KEPT = 64

#: White space as the normalizer's pattern engine sees it (fixed value).
SPACE = r"\t-\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


NONE = float("inf")
#: Ids of two adjacent symbols make one key.
SHIFT = 24


def build(leaves: list) -> list:
    """Minimum segment tree: node 1 is the root, node len(leaves) + i leaf i."""
    n = len(leaves)
    node = [NONE] * n + leaves
    for i in range(n - 1, 0, -1):
        a, b = node[2 * i], node[2 * i + 1]
        node[i] = a if a < b else b
    return node


def update(node: list, i: int, value) -> None:
    """Set leaf ``i`` and the nodes above it, up to the first that stays."""
    i += len(node) >> 1
    node[i] = value
    while i > 1:
        other = node[i ^ 1]
        if other < value:
            value = other
        i >>= 1
        if node[i] == value:
            return
        node[i] = value


def merge_symbols(symbols: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """The symbols left when no adjacent pair can merge any more.

    ``merges`` maps ``left << SHIFT | right`` to (rank, merged symbol)."""
    n = len(symbols)
    if n < 2:
        return symbols
    if n == 2:
        pair = merges.get(symbols[0] << SHIFT | symbols[1])
        return symbols if pair is None else [pair[1]]
    symbols, find = list(symbols), merges.get
    leaves, a = [], symbols[0]
    for i in range(1, n):
        b = symbols[i]
        pair = find(a << SHIFT | b)
        leaves.append(NONE if pair is None else pair[0] * n + i - 1)
        a = b
    node = build(leaves)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (best := node[1]) != NONE:
        i = best % n
        j = after[i]
        symbols[i] = merged = merges[symbols[i] << SHIFT | symbols[j]][1]
        symbols[j] = -1
        after[i] = k = after[j]
        if j < n - 1:
            update(node, j, NONE)
        if k < n:
            before[k] = i
            pair = find(merged << SHIFT | symbols[k])
            update(node, i, NONE if pair is None else pair[0] * n + i)
        else:
            update(node, i, NONE)
        if (h := before[i]) >= 0:
            pair = find(symbols[h] << SHIFT | merged)
            update(node, h, NONE if pair is None else pair[0] * n + h)
    return [s for s in symbols if s >= 0]


#: Pre-tokens of at most this many bytes are merged many at a time.
MOST_SYMBOLS = 64
_NEVER = np.int64(1) << 40


class PairTable:
    """Merges as arrays: (left, right) -> rank, and rank -> merged symbol."""

    def __init__(self, merges: dict[int, tuple[int, int]]):
        keys = np.array(list(merges), np.int64)
        order = np.argsort(keys)
        ranks, self.merged = (np.array([m[i] for m in merges.values()], np.int64) for i in (0, 1))
        self.keys, self.ranks = keys[order], ranks[order]
        by_rank = np.zeros(int(ranks.max(initial=-1)) + 1, np.int64)
        by_rank[ranks] = self.merged
        self.merged = by_rank

    def leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Tree leaves ``rank * MOST_SYMBOLS + place`` of adjacent symbols."""
        key = left << SHIFT | right
        place = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        hit = self.keys[place] == key if len(self.keys) else np.zeros(key.shape, bool)
        return np.where(hit, self.ranks[place] * MOST_SYMBOLS + at if len(self.keys) else _NEVER, _NEVER)


def merge_rows(symbols: np.ndarray, sizes: np.ndarray, pairs: PairTable) -> np.ndarray:
    """``merge_symbols`` of many rows (padded to one width) together: a segment
    tree in each row of a matrix, node 1 the root.  Symbols merged away are -1."""
    rows, width = symbols.shape
    leaves = 1 << max(0, width - 2).bit_length()
    places = np.arange(width)
    symbols = np.where(places < sizes[:, None], symbols, -1)
    tree = np.full((rows, 2 * leaves), _NEVER)
    tree[:, leaves:leaves + width - 1] = np.where(places[1:] < sizes[:, None], pairs.leaf(symbols[:, :-1], symbols[:, 1:], places[:-1]), _NEVER)
    for i in range(leaves - 1, 0, -1):
        tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
    after, before = np.tile(places + 1, (rows, 1)), np.tile(places - 1, (rows, 1))
    row = np.flatnonzero(tree[:, 1] < _NEVER) if leaves > 1 else np.flatnonzero(tree[:, leaves] < _NEVER)
    while len(row):
        best = tree[row, 1]
        i = best % MOST_SYMBOLS
        j = after[row, i]
        k = after[row, j]
        merged = pairs.merged[best // MOST_SYMBOLS]
        symbols[row, i], symbols[row, j], after[row, i] = merged, -1, k
        more = k < sizes[row]
        before[row[more], k[more]] = i[more]
        right = np.full(len(row), _NEVER)
        right[more] = pairs.leaf(merged[more], symbols[row[more], k[more]], i[more])
        tree[row, leaves + i] = right
        inner = j < sizes[row] - 1
        tree[row[inner], leaves + j[inner]] = _NEVER
        h = before[row, i]
        left = h >= 0
        tree[row[left], leaves + h[left]] = pairs.leaf(symbols[row[left], h[left]], merged[left], h[left])
        for who, leaf in ((row, i), (row[inner], j[inner]), (row[left], h[left])):
            node = leaves + leaf
            for _ in range(leaves.bit_length() - 1):
                node = node >> 1
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
        row = row[tree[row, 1] < _NEVER]
    return symbols


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: Latin-1 printable
    bytes stand for themselves, the others for U+0100 onwards in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = {self.vocab[a] << SHIFT | self.vocab[b]: (rank, self.vocab[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.pre = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if "pattern" in p).replace(r"\s", SPACE))
        longest_first = sorted(self.special, key=len, reverse=True)
        self.pre_or_line = regex.compile(f"\n|{self.pre.pattern}")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self.space = regex.compile(f"[{SPACE}]+")
        self.odd_space = regex.compile("[\x1c-\x1f]")
        letters = byte_alphabet()
        self.pairs = PairTable(self.merges)
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.suffix] for c in letters]
        self.shown = pa.array([self.tokens.get(i) for i in range(max(self.tokens, default=-1) + 1)], pa.string())
        #: word or pre-token as written -> its ids as int32 bytes
        self.seen = Recent(CACHE_WORDS)
        letters = "".join(map(chr, range(ord("a"), ord("z") + 1)))
        self.one_token = self.pre.findall(letters * 2) == [letters * 2] and not any(map(str.isalpha, self.special))

    def split(self, text: str) -> list[str]:
        """Words between white space; no token crosses white space."""
        if self.odd_space.search(text):  # white space to str.split, not to the normalizer
            return [w for w in self.space.split(text) if w]
        return text.split()

    def normal(self, text: str) -> str:
        # letter by letter: a final capital sigma becomes the plain small one
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pre_tokens(self, words: list[str]) -> list[list[str]]:
        """Normalised pre-tokens (and special tokens, as they are) of each word;
        no word has white space in it, so many are cut as the lines of one text."""
        out: list = [None] * len(words)
        lines = []
        for i, word in enumerate(words):
            if self.one_token and word.isascii() and word.isalpha():
                out[i] = [word.lower()]
            elif self.cut and self.cut.search(word):
                out[i] = []
                for part in self.cut.split(word):
                    out[i] += [part] if part in self.special else self.pre.findall(self.normal(part))
            else:
                lines.append(i)
        found = self.pre_or_line.findall(self.normal("\n".join([words[i] for i in lines])))
        found.append("\n")
        begin = 0
        for i in lines:
            end = found.index("\n", begin)
            out[i] = found[begin:end]
            begin = end + 1
        return out

    def merge_tokens(self, tokens: list[str]) -> list[bytes]:
        """Each pre-token's ids as int32 bytes; tokens of like length go through
        one matrix of trees."""
        out: list = [None] * len(tokens)
        data = [t.encode("utf-8", "surrogatepass") for t in tokens]
        sizes = np.array(list(map(len, data)), np.int64)
        inner, last = np.array(self.inner, np.int64), np.array(self.last, np.int64)
        for i in np.flatnonzero(sizes > MOST_SYMBOLS).tolist():
            ids = merge_symbols([*map(self.inner.__getitem__, data[i][:-1]), self.last[data[i][-1]]], self.merges)
            out[i] = np.array(ids, np.int32).tobytes()
        for low, high in ((0, 1), (1, 2), (2, 3), (3, 5), (5, 9), (9, 17), (17, 33), (33, MOST_SYMBOLS)):
            group = np.flatnonzero((sizes > low) & (sizes <= high))
            for which in np.array_split(group, -(-len(group) // 8192)) if len(group) else ():
                raw = np.frombuffer(b"".join([data[i].ljust(high, b"\0") for i in which.tolist()]), np.uint8).reshape(len(which), high)
                symbols, size = inner[raw], sizes[which]
                symbols[np.arange(len(which)), size - 1] = last[raw[np.arange(len(which)), size - 1]]
                if high > 1:
                    symbols = merge_rows(symbols, size, self.pairs)
                kept = symbols >= 0
                packed, begin = symbols[kept].astype(np.int32).tobytes(), 0
                for i, end in zip(which.tolist(), (4 * np.cumsum(kept.sum(axis=1))).tolist()):
                    out[i] = packed[begin:end]
                    begin = end
        return out

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """The same of words as written, by word; all but very long ones are kept."""
        written = list(words)
        split = self.pre_tokens(written)
        known, new = {}, set()
        for t in set(chain.from_iterable(split)):
            got = self.seen.new.get(t)
            if got is None:
                got = self.seen.older(t)
            if got is not None:
                known[t] = got
            elif t in self.special:
                known[t] = np.int32(self.special[t]).tobytes()
            else:
                new.add(t)
        tokens = list(new)
        known.update(zip(tokens, self.merge_tokens(tokens)))
        out = {w: known[parts[0]] if len(parts) == 1 else b"".join([known[t] for t in parts]) for w, parts in zip(written, split)}
        for got in (known, out):
            for word, ids in got.items():
                if len(word) <= LONGEST_KEPT and word not in self.seen.new and word not in self.special:
                    self.seen.put(word, ids)
        return out

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as int32 bytes."""
        split = [self.split(t or "") for t in texts]
        found = [list(map(self.seen.new.get, words)) for words in split]
        missing = {w for words, got in zip(split, found) if None in got for w, g in zip(words, got) if g is None}
        learnt, unknown = {}, set()
        for w in missing:
            got = self.seen.older(w)
            if got is None:
                unknown.add(w)
            else:
                learnt[w] = got
        learnt |= self.learn(unknown)
        return [b"".join([learnt[w] if g is None else g for w, g in zip(words, got)] if None in got else got) for words, got in zip(split, found)]

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The text each list of ids stands for (null list: "")."""
        shown = pa.ListArray.from_arrays(ids.offsets, pc.take(self.shown, ids.values))
        return pc.fill_null(pc.binary_join(shown, " "), "")

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def _codec(data: bytes) -> WordBpe:
    return held(("word bpe", len(data), hash(data)), lambda: WordBpe(data))


def encode_batch(codec: WordBpe, texts: list[str | None]) -> pa.StructArray:
    with no_cycles():
        found = codec.encode_all(texts)
    offsets = np.cumsum([0, *map(len, found)]) // 4
    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))
    return pa.StructArray.from_arrays([ids, codec.decode_all(ids)], ["ids", "decoded"])


def read_vocab(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCAB_BYTES + 1)
    if len(data) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} has more than {MAX_VOCAB_BYTES} bytes")
    return data


def bpe_encode(df: DataFrame, vocab_path: str, text_col: str = "text",
               ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``df`` with each text's token ids and the text they decode to."""
    arrow_rows(df)
    shared = df.sparkSession.sparkContext.broadcast(read_vocab(vocab_path))

    @F.arrow_udf("ids array<int>, decoded string")
    def coded(texts: pa.Array) -> pa.Array:
        codec = _codec(shared.value)
        return in_slices(texts, lambda part: encode_batch(codec, part))

    out = free_name(df, "coded")
    return (df.withColumn(out, coded(F.col(text_col)))
            .withColumns({ids_col: F.col(out)["ids"], decoded_col: F.col(out)["decoded"]}).drop(out))


def bpe_decode(df: DataFrame, vocab_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text its id lists stand for (null list: "")."""
    arrow_rows(df)
    shared = df.sparkSession.sparkContext.broadcast(read_vocab(vocab_path))

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        codec = _codec(shared.value)
        return pa.array([codec.decode(x or ()) for x in ids.to_pylist()], pa.string())

    return df.withColumn(out_col, text(F.col(ids_col)))
