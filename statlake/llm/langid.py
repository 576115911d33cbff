"""Language identification of mixed-language text.

Learning (in Spark): letter n-grams of the labelled sample's words are counted
per language in ``BUCKETS`` hash buckets (CRC-32), so the model's size is
``BUCKETS`` times the number of languages, whatever the corpus.  The sample is
bounded by ``sample_rows`` labelled rows, taken by a hash of the id; the scripts
each language is written in are learned with it.

Prediction: a word's script narrows its candidate languages; each candidate's
score is the mean-free log-likelihood of the word's n-grams; Viterbi over the
words of a text, with a penalty for each switch, labels spans.  The text's
language is the one with most letters (ties: first by name).  Its score is the
share of letters so labelled, less where they do not look like the language:
their log-likelihood a letter, against n-grams drawn at random, is compared with
what the language's own sample has, and below ``FULL`` of that the score falls in
proportion, to 0 for none.  Short texts are judged as if ``PRIOR_LETTERS`` letters
of the language stood beside them.  Letters of a script that no learned language
is written in count for no language.

Defined results: null text, or text without a letter: ``und`` and 0.0; no
labelled row at all: ``und`` for every text; a null id is never held out and
never learned from; repeated rows get equal results; extra columns stay.
"""

from __future__ import annotations

import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import arrow_rows, free_name, words
from statlake.llm.worker import held, in_slices

BUCKETS = 1 << 15
#: Share of the expected log-likelihood a letter from which nothing is taken off a score.
FULL = 0.5
PRIOR_LETTERS = 20
#: A classifier for more languages than this is refused (the labels are collected).
MAX_LANGUAGES = 1000
#: Words a worker remembers.
CACHE_WORDS = 1 << 16
#: Text that a worker labels at a time.
SLICE_BYTES = 1 << 20
#: First code point of each script's ranges (fixed values); "Latin" holds what is before the second.
SCRIPTS = ((0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
           (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
           (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
           (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
           (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1E00, "Latin"),
           (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"),
           (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "other"))
_STARTS = [s for s, _ in SCRIPTS]


def script_of(letter: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(letter)) - 1][1]


def letters_of(word: str) -> str:
    """The letters of a word, in lower case."""
    return word.lower() if word.isalpha() else "".join(filter(str.isalpha, word.lower()))


def features(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of lower-case words, and the word of each:
    two and three letters with the word's ends marked, and the whole word."""
    text = "".join([f"^{w}$" for w in found])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(found)), [len(w) + 2 for w in found])
    out = [np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in found), np.int64, len(found))]
    place = [np.arange(len(found))]
    mixed = points
    for n in (2, 3):
        mixed = mixed[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:]
        inside = word[:-(n - 1)] == word[n - 1:]
        out.append(((mixed[inside] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.int64) % BUCKETS)
        place.append(word[:-(n - 1)][inside])
    return np.concatenate(out), np.concatenate(place)


@dataclass(frozen=True)
class Model:
    """What is learned; it is broadcast and never changes."""

    languages: list[str]
    #: log-likelihood by bucket and language, less the mean over languages
    weight: np.ndarray
    #: script -> mask of the languages written in it
    scripts: dict[str, np.ndarray]
    #: that mean by bucket, over a bucket drawn at random, in nats
    mean: np.ndarray
    #: nats a letter of each language's sample, over buckets drawn at random
    expected: np.ndarray
    penalty: float = 12.0
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def spans(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        return reader(self).spans(texts)

    def predict(self, texts: list[str | None]) -> pa.StructArray:
        return reader(self).predict(texts)


def reader(model: Model) -> Reader:
    """The worker's reader of this model."""
    return held(("language", model.name), lambda: Reader(model))


class Reader:
    """Labels texts by a model, with bounded caches: place of a word as written
    and of its letters, and by place: scores, nats of the mean over languages, letter
    counts, and how many of them are in a learned script."""

    def __init__(self, model: Model):
        self.model = model
        self.languages, self.weight, self.scripts, self.penalty = model.languages, model.weight, model.scripts, model.penalty
        #: script -> positions of the languages not written in it
        self.others = {script: np.flatnonzero(~mask) for script, mask in model.scripts.items()}
        self.index: dict[str, int]
        self.bare: dict[str, int]
        self.forget()

    def forget(self) -> None:
        self.index, self.bare = {}, {}
        self.scores, self.mean = np.zeros((0, len(self.languages)), np.float32), np.zeros(0, np.float32)
        self.letters, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def known_letters(self, word: str) -> int:
        if max(word) < "\u0370":
            return len(word) if "Latin" in self.scripts else 0
        return sum(script_of(c) in self.scripts for c in word)

    def learn_words(self, found: list[str]) -> None:
        """Enter new words and their scores into the caches."""
        if len(self.index) > CACHE_WORDS:
            self.forget()
        new: list[str] = []
        for w in dict.fromkeys(found):
            if w in self.index:
                continue
            kept = letters_of(w)
            k = self.bare.get(kept)
            if k is None:
                k = self.bare[kept] = len(self.letters) + len(new)
                new.append(kept)
            self.index[w] = k
        if not new:
            return
        scores = np.zeros((len(new), len(self.languages)), np.float32)
        where, place = features(new)
        for j in range(len(self.languages)):
            scores[:, j] = np.bincount(place, self.weight[where, j], len(new))
        known = np.zeros(len(new), np.int64)
        for k, kept in enumerate(new):
            script = script_of(kept[0]) if kept else ""
            if script not in self.others:
                scores[k] = 0
                continue
            known[k] = self.known_letters(kept)
            if len(self.others[script]):
                scores[k, self.others[script]] = -1e4
        self.scores = np.concatenate([self.scores, scores])
        self.mean = np.concatenate([self.mean, np.bincount(place, self.model.mean[where], len(new)).astype(np.float32)])
        self.known = np.concatenate([self.known, known])
        self.letters = np.concatenate([self.letters, [len(w) for w in new]])

    def labels(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts' words in turn: their languages (positions) and places, and
        where each text begins and the last one ends."""
        found = [(t or "").split() for t in texts]
        edges = np.concatenate([[0], np.cumsum([len(w) for w in found])]).astype(np.int64)
        every = list(chain.from_iterable(found))
        if not every:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), edges
        places = list(map(self.index.get, every))
        if None in places:
            self.learn_words(every)
            places = list(map(self.index.__getitem__, every))
        flat = np.array(places, np.int64)
        return viterbi(self.scores, flat, edges, self.penalty), flat, edges

    def spans(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each text its words' languages (positions) and letter counts."""
        if not self.languages:
            sizes = [len((t or "").split()) for t in texts]
            return [np.zeros(n, np.int64) for n in sizes], [np.zeros(n, np.int64) for n in sizes]
        path, flat, edges = self.labels(texts)
        letters = self.letters[flat]
        return [path[a:b] for a, b in pairwise(edges)], [letters[a:b] for a, b in pairwise(edges)]

    def predict(self, texts: list[str | None]) -> pa.StructArray:
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        if self.languages and texts:
            path, flat, edges = self.labels(texts)
            n, count = len(texts), len(self.languages)
            text = np.repeat(np.arange(n), np.diff(edges))
            cell = text * count + path
            known = self.known[flat]
            total = np.bincount(text, self.letters[flat], n)
            mine = np.bincount(cell, known, n * count).reshape(n, count)
            nats = np.bincount(cell, np.where(known > 0, self.scores[flat, path] + self.mean[flat], 0), n * count).reshape(n, count)
            best = mine.argmax(axis=1)
            mine, nats, expected = mine[np.arange(n), best], nats[np.arange(n), best], self.model.expected[best]
            found = (nats + PRIOR_LETTERS * expected) / (mine + PRIOR_LETTERS)
            belief = np.where(expected > 0, np.clip(found / (FULL * np.maximum(expected, 1e-9)), 0, 1), 1)
            for k in np.flatnonzero(total):
                langs[k], scores[k] = self.languages[best[k]], float(belief[k] * (mine[k] / total[k]))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])


def viterbi(scores: np.ndarray, flat: np.ndarray, edges: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word; all texts advance together, longest first."""
    sizes = np.diff(edges)
    order = np.argsort(-sizes, kind="stable")
    first, length = edges[:-1][order], sizes[order]
    count = scores.shape[1]
    own = np.arange(count)
    came = np.empty((len(flat), count), np.int16)
    active = int(np.searchsorted(-length, 0, "left"))
    value = np.zeros((len(order), count), np.float32)
    value[:active] = scores[flat[first[:active]]]
    ends = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), "right")  # texts with more words than t
    for t in range(1, int(length[0])):
        active = int(ends[t])
        v = value[:active]
        at = first[:active] + t
        best = v.argmax(axis=1)
        top = v[np.arange(active), best][:, None] - penalty
        switch = top > v
        came[at] = np.where(switch, best[:, None], own)
        value[:active] = np.where(switch, top, v) + scores[flat[at]]
    path = np.empty(len(flat), np.int64)
    some = length > 0
    label = value.argmax(axis=1)
    last = first + length - 1
    path[last[some]] = label[some]
    for t in range(int(length[0]) - 1, 0, -1):
        active = int(ends[t])
        at = first[:active] + t
        path[at - 1] = came[at, path[at]]
    return path


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language and bucket of rows (lang, word, count)."""
    for batch in batches:
        for lang in batch["lang"].unique():
            rows = batch.filter(pc.equal(batch["lang"], lang))
            where, place = features(rows["word"].to_pylist())
            n = np.bincount(where, rows["count"].to_numpy()[place], BUCKETS)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["lang", "bucket", "n"])


def fold(id_col: Column) -> Column:
    """CRC-32 of the id as text, mod 3; fold 1 is held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample_rows: int = 20_000, penalty: float = 12.0, least_share: float = 0.01) -> Model:
    """Learn from at most about ``sample_rows`` labelled rows outside fold 1."""
    labelled = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(F.col(id_col)) != 1))
    total = labelled.count()
    if total > sample_rows:
        part = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30))
        labelled = labelled.filter(part < int((1 << 30) * sample_rows / total))
    letters = F.regexp_replace(F.lower("word"), r"[^\p{L}]+", "")
    counted = (labelled.select(F.col(lang_col).alias("lang"), F.explode(words(F.col(text_col))).alias("word"))
               .select("lang", letters.alias("word")).filter("word <> ''").groupBy("lang", "word").count())
    by_bucket = counted.mapInArrow(_bucket_counts, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    by_script = counted.groupBy("lang", F.ascii("word").alias("point")).agg(F.sum(F.col("count") * F.length("word")).alias("n"))
    starts = F.array(*[F.lit(s) for s, _ in SCRIPTS])
    by_script = by_script.groupBy("lang", F.size(F.filter(starts, lambda s: s <= F.col("point"))).alias("script")).agg(F.sum("n").alias("n"))
    scripts = by_script.collect()  # languages times scripts
    languages = sorted({r["lang"] for r in scripts})
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; at most {MAX_LANGUAGES}")
    place = {name: k for k, name in enumerate(languages)}
    counts = np.zeros((BUCKETS, len(languages)), np.float32)
    learned = by_bucket.toArrow()  # at most BUCKETS rows a language
    columns = [place[name] for name in learned["lang"].to_pylist()]
    counts[learned["bucket"].to_numpy(), np.array(columns, np.int64)] = learned["n"].to_numpy()
    weight = np.log(counts + 0.5) - np.log(counts.sum(axis=0) + 0.5 * BUCKETS)
    in_all = np.zeros(len(languages))
    for r in scripts:
        in_all[place[r["lang"]]] += r["n"]
    over = weight + np.log(BUCKETS)
    expected = (counts * over).sum(axis=0) / np.maximum(in_all, 1)
    mean = over.mean(axis=1) if languages else np.zeros(BUCKETS)
    weight -= weight.mean(axis=1, keepdims=True) if languages else 0
    masks: dict[str, np.ndarray] = {}
    shares: dict[tuple[str, str], float] = {}
    for r in scripts:
        key = (SCRIPTS[r["script"] - 1][1], r["lang"])
        shares[key] = shares.get(key, 0) + r["n"] / in_all[place[r["lang"]]]
    for (script, lang), share in shares.items():
        if share >= least_share:
            masks.setdefault(script, np.zeros(len(languages), bool))[place[lang]] = True
    return Model(languages, weight.astype(np.float32), masks, mean.astype(np.float32), expected.astype(np.float64), penalty)


def labelled(texts: pa.Array, model: Model) -> pa.Array:
    """``model.predict`` of a batch, a slice at a time."""
    return in_slices(texts, model.predict, SLICE_BYTES)


def predict(df: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``df`` with the language of each text and its score."""
    arrow_rows(df)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def language(texts: pa.Array) -> pa.Array:
        return labelled(texts, shared.value)

    out = free_name(df, "found")
    return df.withColumn(out, language(F.col(text_col))).withColumns({lang_col: F.col(out)["lang"], score_col: F.col(out)["score"]}).drop(out)


def keep_identified(df: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows whose text has one language, by a score of at least
    ``least_score``; the columns of ``df``."""
    lang, score = free_name(df, "lang_pred"), free_name(df, "score")
    found = predict(df, train(df), lang_col=lang, score_col=score)
    return found.filter((F.col(lang) != "und") & (F.col(score) >= least_score)).select(*df.columns)
