"""N-gram Jaccard join against all pairs of small tables."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from statlake.llm import ngram_join
from statlake.llm.ngrams import Words, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(rows, words):
    out = []
    for _, text in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if x]
        out.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    return out


def brute(rows, rule):
    """[(id, set size, least id reached)], sorted."""
    found = sets(rows, rule.words)
    group = list(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        shared, either = len(found[a] & found[b]), len(found[a] | found[b])
        if either and 100 * shared >= rule.percent * either and group[a] != group[b]:
            gone, stays = group[b], group[a]
            group = [stays if g == gone else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, len(s), least.get(g) if s else i) for (i, _), s, g in zip(rows, found, group)), key=str)


def joined(spark, rows, rule=ngram_join.Rule(), schema="doc_id long, text string"):
    return sorted(map(tuple, ngram_join.near_duplicates(spark.createDataFrame(rows, schema), rule).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("words,percent", [(4, 85), (2, 60)])
def test_links_equal_all_pairs(spark, monkeypatch, words, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)  # every root becomes a grid
    rng, rows = random.Random(words), []
    for group in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(30, 160))]
        rows += [edited(rng, base[:rng.randrange(len(base) * 8 // 10, len(base) + 1)], rng.randrange(6)) for _ in range(12)]
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [passage + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(k)) for k in (0, 0, 2, 3, 4, 5, 6, 7, 8, 9, 40)]
    rows += [f"{passage[:rng.randrange(90, len(passage))]}" for _ in range(10)]
    rows = [(i, t) for i, t in enumerate(rng.sample(rows, len(rows)))]
    rule = ngram_join.Rule(words, percent)
    assert joined(spark, rows, rule) == brute(rows, rule)


def test_dense_group_of_near_copies(spark):
    """No pair list: a chain of near copies is one component, far ends unlike."""
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[i:i + 100])) for i in range(20)] + [(100 + i, " ".join(words[:100] + [f"t{i}"])) for i in range(60)]
    assert joined(spark, rows) == brute(rows, ngram_join.Rule())


def test_exact_boundary(spark):
    """85 of 100 n-grams in common are enough, 84 are not."""
    common = [f"c{i}" for i in range(88)]
    rows = [(1, " ".join(common)), (2, " ".join(common + [f"a{i}" for i in range(15)])), (3, " ".join(common + [f"b{i}" for i in range(16)]))]
    got = {i: (n, c) for i, n, c in joined(spark, rows)}
    assert got == {1: (85, 1), 2: (100, 1), 3: (101, 3)}


def test_nulls_short_long_and_repeated_rows(spark):
    long = " ".join(f"w{i % 7001}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "one two three four"), (7, "one two three four"),
            (8, "Ünï one TWO three"), (9, "ünï one two three"), (None, "one two three four"), (None, None), (10, long), (11, long + " end"), (12, "x" * 400_000), (13, "x" * 400_000)]
    assert joined(spark, rows) == brute(rows, ngram_join.Rule())


def test_empty_table_and_clashing_columns(spark):
    assert joined(spark, []) == []
    df = spark.createDataFrame([(1, "a b c d", 5, "x"), (2, "a b c d", 6, "y")], "doc_id long, text string, n_shingles int, component_id string")
    assert sorted(map(tuple, ngram_join.near_duplicates(df).collect())) == [(1, 1, 1), (2, 1, 1)]


def test_word_hashes_follow_words():
    import pyarrow as pa

    texts = ["a b\tc", "", "B a", "ab", "ä Ä", "a\x1cb a b"]
    found = Words(pa.array(texts))
    words = [(i, w) for i, t in enumerate(texts) for w in re.split("[\x20\x09-\x0d]+", t.translate(LOWER)) if w]
    assert [(int(i), found.word(k)) for k, i in enumerate(found.text)] == words
    by_word = {}
    for (_, w), h in zip(words, found.hash.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    assert len(np.unique(shingles(found, 2)[1])) == len({("a", "b"), ("b", "c"), ("b", "a"), ("ab",), ("ä", "Ä"), ("a\x1cb", "a b")})
