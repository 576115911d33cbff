"""Collocations against a plain count."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from statlake.llm import collocations
from statlake.llm.collocations import Rules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, rules):
    out, total, count = [], Counter(), {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        f = count.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            f.update(tuple(w[i:i + n]) for n in range(1, rules.longest + 1) for i in range(len(w) - n + 1))
    for lang, f in count.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= rules.least}
        kept = []
        for p, a in good.items():
            score, k = min((rules.scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not any(100 * b >= rules.subsumed * a for q, b in good.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(kept)[:rules.top])]
    return sorted(out)


def result(spark, rows, rules, schema="text string, lang string"):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(map(tuple, collocations.collocations(df, rules).collect()))


def sentences(rng, n):
    words = ["the", "of", "new", "york", "city", "é", "x1", "a_b", "So", "\x1c", "ß", "und"]
    weights = [12, 9, 5, 5, 4, 2, 2, 1, 1, 1, 1, 1]
    for _ in range(n):
        text = " ".join(rng.choices(words, weights, k=rng.randrange(0, 40)))
        yield re.sub(" ", lambda m: rng.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", "\x0b"]), text)


@pytest.mark.parametrize("rules", [Rules(least=3, top=40), Rules(least=8), Rules(longest=3, least=2, subsumed=50, top=7)])
def test_equals_plain_count(spark, monkeypatch, rules):
    monkeypatch.setattr(collocations, "HOT", 20)  # the common words are cut into segments
    monkeypatch.setattr(collocations, "GATHER_BYTES", 500)
    rng = random.Random(rules.least)
    rows = [(t, rng.choice(["en", "de", None, "und"])) for t in sentences(rng, 200)] + [("New York city " * 20, "en")] * 3
    assert result(spark, rows, rules) == brute(rows, rules)


def test_edges(spark):
    rules = Rules(least=2, top=5)
    rows = [(None, "en"), ("", "en"), ("...", None), ("a b", "en"), ("a b", "en"), ("a\nb", "en"), ("a", "en"), ("b", "en"), ("w" * 400_000 + " end", "x"), ("w" * 400_000 + " END", "x"),
            ("lone " * 50_000, "y"), (None, None)]
    assert result(spark, rows, rules) == brute(rows, rules)
    assert result(spark, [], rules) == []


def test_other_columns_do_not_clash(spark):
    rows = [("a b. a b", "en", 1, "x", 2, 3)] * 3
    assert result(spark, rows, Rules(least=2), "text string, lang string, a int, phrase string, lang_id int, n int") == brute([r[:2] for r in rows], Rules(least=2))


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**18
    df = spark.createDataFrame([(1, 7, [1, 2], big)], "id long, lang_id long, words array<long>, f long")
    ids = df.select(collocations.phrase_id(F.col("lang_id"), F.array(F.lit(1).cast("long"))).alias("x"), collocations.phrase_id(F.col("lang_id"), F.array(F.lit(2).cast("long"))).alias("y")).first()
    counts = spark.createDataFrame([(ids["x"], big), (ids["y"], big + 1)], "id long, f long")
    got = collocations._best_cuts(df, counts, 2_000_000).first()
    assert (got["score"], got["l"], got["r"]) == (2_000_000 * big // (2 * big + 1), big, big + 1)


def test_phrase_ids_agree_with_spark(spark):
    rng = np.random.default_rng(1)
    prefix, word = (rng.integers(0, 2**64, 50, np.uint64) for _ in range(2))
    df = spark.createDataFrame([(int(p), int(w)) for p, w in zip(prefix.view(np.int64), word.view(np.int64))], "p long, w long")
    want = [r[0] for r in df.select(collocations.phrase_id(F.col("p"), F.array("w"))).collect()]
    assert collocations.longer(prefix, word).view(np.int64).tolist() == want
