"""Phrase collocations by the stripes pattern.

A stripe belongs to a prefix (none, one, two or three words of a language) and
counts the words that follow it.  Tasks count stripes over large slices of
text, and stripes of one prefix are merged elementwise behind one shuffle by
prefix; stripes of the few prefixes that make up a thousandth of all words, and
the empty one, are cut into segments by the next word, so that no task gets all
of a hot prefix.  Everything comes out of this one structure: a phrase's count is its
entry in the stripe of its beginning, the totals of prefixes and rests are
entries of shorter stripes, and the largest extension of a phrase is the largest
entry of the stripes that it begins or ends.

Lengths are counted in turn: a phrase of n words can reach ``least`` only if its
first and last n - 1 words do, so each pass skips all others by a filter of fixed
size (false positives only cost space).  Words and phrases are known by 64-bit
hashes; the words of the phrases that are returned are read again at the end.

Only one-word extensions need a look: if a longer candidate holds a phrase often
enough, so does the candidate of one word more inside it.

Defined results: a null text is empty, a null language is ``und``; words and phrases
never span pieces or documents; repeated rows count again; an empty table gives an
empty table; other columns are not used and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.bounded import bitmap, in_bitmap
from statlake.llm.common import arrow_rows
from statlake.llm.ngrams import Words, slices, white_table
from statlake.session import cut_lineage

#: Between words, and between pieces (fixed values).
WORD_GAP, PIECE_GAP = b" \t", b".,;:!?\n\x0b\x0c\r"
#: Text that a task counts before it sends stripes on.
GATHER_BYTES = 8 << 20
#: Bits of the filters of phrases that reach the least count, and of words.
PHRASE_BITS, WORD_BITS = 27, 24
#: A prefix with over 1 / HOT of all words is cut into SEGMENTS; there are fewer than HOT.
HOT, SEGMENTS = 1024, 256


@dataclass(frozen=True)
class Rules:
    longest: int = 4
    least: int = 30
    #: A candidate goes if a longer one has this many percent of its count.
    subsumed: int = 80
    scale: int = 2_000_000
    top: int = 2000


# ---- phrase ids: Spark's xxhash64 of (prefix id, word id), in numpy ----------

_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return x << np.uint64(n) | x >> np.uint64(64 - n)


def _hash_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    h = (seed + _P5 + np.uint64(8)) ^ (_turn(value * _P2, 31) * _P1)
    h = _turn(h, 27) * _P1 + _P4
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    return h ^ h >> np.uint64(32)


def longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Ids of phrases from those of their beginnings and their last words."""
    return _hash_long(word, _hash_long(prefix, np.full(1, 42, np.uint64)))


def phrase_id(lang: Column, words: Column) -> Column:
    """The same from a language's id and a list of word ids."""
    return F.aggregate(words, lang, lambda so_far, w: F.xxhash64(so_far, w))


# ---- counting ---------------------------------------------------------------


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Slices of texts: their words, each word's language id, whether the next
    word continues its piece, and the rows."""
    gap, cut = WORD_GAP + PIECE_GAP, white_table(PIECE_GAP)
    for batch in batches:
        for first, texts in slices(batch.column("text")):
            found, part = Words(texts, gap), batch.slice(first, len(texts))
            piece = np.cumsum(cut[found.data])[found.start] if len(found.start) else np.empty(0, np.int64)
            goes_on = np.zeros(len(found.hash), bool)
            goes_on[:-1] = (found.text[1:] == found.text[:-1]) & (piece[1:] == piece[:-1])
            yield found, part.column("lang_id").to_numpy().view(np.uint64)[found.text], goes_on, part


def _stripes_of(size: int, word: np.ndarray, lang: np.ndarray, goes_on: np.ndarray, frequent: np.ndarray | None, hot: np.ndarray) -> pa.RecordBatch:
    at = np.arange(max(0, len(word) - size + 1))
    for i in range(size - 1):
        at = at[goes_on[at + i]]
    prefix = lang[at]
    if size > 1:
        rest = lang[at]
        for i in range(size - 1):
            prefix, rest = longer(prefix, word[at + i]), longer(rest, word[at + i + 1])
        may = in_bitmap(frequent, prefix) & in_bitmap(frequent, rest)
        at, prefix = at[may], prefix[may]
    follows = word[at + size - 1]
    _, first, count = np.unique(longer(prefix, follows), return_index=True, return_counts=True)
    prefix, follows = prefix[first], follows[first]
    in_segments = np.isin(prefix, hot) if size > 1 else np.ones(len(prefix), bool)
    segment = np.where(in_segments, 1 + (follows % np.uint64(SEGMENTS)).astype(np.int64), 0)
    order = np.lexsort((segment, prefix))
    prefix, segment, follows, count = prefix[order], segment[order], follows[order], count[order]
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (segment[1:] != segment[:-1])
    starts = np.flatnonzero(new)
    edges = pa.array(np.append(starts, len(prefix)), pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array(prefix[starts].view(np.int64)), pa.array(segment[starts], pa.int32()),
        pa.ListArray.from_arrays(edges, pa.array(follows.view(np.int64))), pa.ListArray.from_arrays(edges, pa.array(count, pa.int32()))], ["prefix", "segment", "next", "n"])


def _entries(docs: DataFrame, size: int, frequent, hot: np.ndarray, least: int) -> DataFrame:
    """(prefix, next, f): entries of at least ``least`` of the merged stripes
    whose phrases have ``size`` words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        held_bytes = 0
        bits = frequent.value if frequent is not None else None

        def flush() -> pa.RecordBatch:
            return _stripes_of(size, *(np.concatenate(x) for x in zip(*held)), bits, hot)

        for found, lang, goes_on, _ in _words(batches):
            held.append((found.hash, lang, goes_on))
            held_bytes += len(found.data)
            if held_bytes > GATHER_BYTES:
                yield flush()
                held, held_bytes = [], 0
        if held:
            yield flush()

    stripes = docs.mapInArrow(count, "prefix long, segment int, next array<long>, n array<int>").repartition("prefix", "segment")
    merged = stripes.select("prefix", "segment", F.inline(F.arrays_zip("next", "n"))).groupBy("prefix", "segment", "next").agg(F.sum("n").alias("f"))
    return merged.filter(F.col("f") >= least).select("prefix", "next", "f")


def frequent_phrases(docs: DataFrame, rules: Rules) -> DataFrame:
    """(id, lang_id, words, f): all phrases of 1 to ``longest`` words that occur
    ``least`` times in their language; ``docs`` has text, lang_id."""
    sc = docs.sparkSession.sparkContext
    langs = docs.select("lang_id").distinct().select(F.col("lang_id").alias("id"), "lang_id", F.array().cast("array<long>").alias("words"))
    shorter, found, bits, hot, total = langs, [], None, np.empty(0, np.uint64), 0
    for size in range(1, rules.longest + 1):
        entries = _entries(docs, size, bits, hot, rules.least)
        words = F.concat("words", F.array("next"))
        known = entries.join(shorter, entries["prefix"] == shorter["id"]).select("lang_id", words.alias("words"), "f")
        known = cut_lineage(known.select(phrase_id(F.col("lang_id"), F.col("words")).alias("id"), "lang_id", "words", "f"), f"phrases{size}")
        found.append(known)
        total = total or (known.agg(F.sum("f")).first()[0] or 0)
        share = known.filter(F.col("f") * HOT > total).select("id").toArrow()  # fewer than HOT rows
        hot = share["id"].to_numpy().view(np.uint64)
        bits = sc.broadcast(bitmap(known, "id", PHRASE_BITS))
        shorter = known.select("id", "lang_id", "words")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionAll(more)
    return whole


# ---- scores and subsumption -------------------------------------------------


def _best_cuts(candidates: DataFrame, counts: DataFrame, scale: int) -> DataFrame:
    """(id, score, l, r): the cut with the lowest score, ties to the shortest first part."""
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = candidates.select("id", "lang_id", "words", F.col("f").alias("a"), cut)
    cuts = cuts.select("id", "a", "k", phrase_id(F.col("lang_id"), F.slice("words", F.lit(1), F.col("k"))).alias("left_id"),
                       phrase_id(F.col("lang_id"), F.slice("words", F.col("k") + 1, F.size("words"))).alias("right_id"))
    left, right = counts.select(F.col("id").alias("left_id"), F.col("f").alias("l")), counts.select(F.col("id").alias("right_id"), F.col("f").alias("r"))
    scored = cuts.join(left, "left_id").join(right, "right_id").withColumn("score", F.expr(
        f"(cast({scale} as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    return scored.groupBy("id").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("id", F.col("cut.score").alias("score"), "cut.l", "cut.r")


def _largest_extensions(phrases: DataFrame) -> DataFrame:
    """(id, more): the largest count of a phrase that is one word longer, to
    either side."""
    longer_ones = phrases.filter(F.size("words") >= 3)
    cut = lambda first: phrase_id(F.col("lang_id"), F.slice("words", F.lit(first), F.size("words") - 1))
    return longer_ones.select(F.explode(F.array(cut(1), cut(2))).alias("id"), "f").groupBy("id").agg(F.max("f").alias("more"))


def _word_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(word, text) of the words in ``wanted``, and the number of words of each
    language in rows without a word: (lang_id, lang, n)."""
    chosen = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "word", WORD_BITS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "text", "lang_id", "lang", "n"]
        for found, lang, _, rows in _words(batches):
            hashes, first = np.unique(found.hash, return_index=True)
            take = in_bitmap(chosen.value, hashes)
            texts = [found.word(i) for i in first[take].tolist()]
            none = pa.nulls(len(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(hashes[take].view(np.int64)), pa.array(texts, pa.string()), none, none.cast(pa.string()), none], names)
            name = dict(zip(rows.column("lang_id").to_pylist(), rows.column("lang").to_pylist()))
            ids, count = np.unique(lang.view(np.int64), return_counts=True)
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none.cast(pa.string()), pa.array(ids), pa.array([name[i] for i in ids.tolist()], pa.string()), pa.array(count)], names)

    return docs.mapInArrow(read, "word long, text string, lang_id long, lang string, n long")


def collocations(df: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``
    phrases by score, count and phrase."""
    arrow_rows(df)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    docs = df.select(F.col(text_col).alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_id"))
    phrases = frequent_phrases(docs, rules)
    candidates = phrases.filter(F.size("words") >= 2)
    scored = candidates.join(_best_cuts(candidates, phrases, rules.scale), "id").join(_largest_extensions(phrases), "id", "left")
    scored = scored.filter(F.col("more").isNull() | (100 * F.col("more").cast("decimal(19,0)") < rules.subsumed * F.col("f").cast("decimal(19,0)")))
    best = Window.partitionBy("lang_id").orderBy(F.desc("score"), F.desc("f"))
    ahead = cut_lineage(scored.withColumn("place", F.rank().over(best)).filter(F.col("place") <= rules.top).select("id", "lang_id", "words", "f", "l", "r", "score"), "ahead")

    wanted = ahead.select(F.explode("words").alias("word")).distinct()
    read = cut_lineage(_word_texts(docs, wanted), "words")
    texts = read.filter("word is not null").select("word", "text").join(wanted, "word", "left_semi").dropDuplicates(["word"])
    spelled = (ahead.select("id", F.posexplode("words").alias("i", "word")).join(texts, "word").groupBy("id")
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]), " ").alias("phrase")))  # at most `longest` rows an id
    totals = read.filter("lang_id is not null").groupBy("lang_id", "lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = ahead.join(spelled, "id").join(totals, "lang_id").withColumnRenamed("f", "a")
    found = found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= rules.top)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
