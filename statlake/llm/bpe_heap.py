"""Token counts by heap-and-linked-list byte-pair merging.

A segment of text starts as a doubly linked list of characters; a heap holds
the adjacent pairs whose concatenation is a piece.  The pair of best rank (ties:
leftmost) is popped again and again, stale heap entries are skipped, and each
merge pushes at most two new pairs: O(n log n).  The count is the number of
initial symbols minus the merges; a character that no piece holds counts once
per UTF-8 byte (byte fallback) and merges with nothing.  No id is emitted.

No piece has the space mark after another character and none holds a line
break, so the text is cut there and segments are counted once per worker
(bounded cache).

Defined results: a null or empty text has 0 tokens and 0 bytes; extra columns
are kept; repeated rows and empty tables need no care.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.bpe_tree import LONGEST_KEPT, read_vocab
from statlake.llm.common import arrow_rows
from statlake.llm.worker import Recent, held, in_slices

#: The mark that stands for a space inside pieces (fixed value).
MARK = "▁"
#: Segments in each half of a worker's cache.
CACHE_SEGMENTS = 1 << 18
SEGMENT = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceCounter:
    def __init__(self, data: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        ordinary = [i for i in range(model.get_piece_size())
                    if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in ordinary}
        inner = [p for p in self.rank if MARK in p.lstrip(MARK) or "\n" in p]
        if inner:
            raise ValueError(f"pieces across a cut, such as {inner[0]!r}")
        self.seen = Recent(CACHE_SEGMENTS)

    def merged(self, text: str) -> int:
        """Tokens of one segment, counted by merging."""
        n = len(text)
        part: list[str | None] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tokens = sum(1 if c in self.rank else len(c.encode("utf-8", "surrogatepass")) for c in part)
        heap = [(r, i, len(p)) for i in range(n - 1) if (r := self.rank.get(p := text[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            left = part[i]
            if left is None or (j := after[i]) >= n or len(left) + len(part[j]) != size:
                continue  # one side has been merged since
            part[i], part[j] = left + part[j], None
            tokens -= 1
            after[i] = nxt = after[j]
            if nxt < n:
                before[nxt] = i
                whole = part[i] + part[nxt]
                if (r := self.rank.get(whole)) is not None:
                    heapq.heappush(heap, (r, i, len(whole)))
            if (prev := before[i]) >= 0:
                whole = part[prev] + part[i]
                if (r := self.rank.get(whole)) is not None:
                    heapq.heappush(heap, (r, prev, len(whole)))
        return tokens

    def segment(self, text: str) -> int:
        got = self.seen.older(text)
        if got is None:
            got = self.merged(text)
            if len(text) <= LONGEST_KEPT:
                self.seen.put(text, got)
        return got

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        lines = (MARK + text.replace(" ", MARK)).split("\n")
        total, find = len(lines) - 1, SEGMENT.findall
        for line in lines:
            pieces = find(line)
            found = list(map(self.seen.new.get, pieces))
            if None in found:
                found = [self.segment(p) if got is None else got for p, got in zip(pieces, found)]
            total += sum(found)
        return total


def _counter(data: bytes) -> PieceCounter:
    return held(("piece counts", len(data), hash(data)), lambda: PieceCounter(data))


def token_counts(df: DataFrame, model_path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of each text."""
    arrow_rows(df)
    shared = df.sparkSession.sparkContext.broadcast(read_vocab(model_path))

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        counter = _counter(shared.value)
        return in_slices(texts, lambda part: pa.array([counter.count(t) for t in part], pa.int64()))

    return df.withColumn(out_col, count(F.col(text_col)))
