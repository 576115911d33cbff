"""Each operator against a brute-force version, on edge cases and on the
smallest test table."""

import gc
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statlake.llm import bpe_heap, bpe_tree, components, cws, html_paths, langid, mixing, pii, quality_sketch, queries, simhash_trie, substr
from statlake.llm.components import connected

SF = "/root/testdata/sf0.001"
SPACE = re.compile("[\x20\x09-\x0d]+")
LINE = "we all know that the quick brown fox jumps over the lazy dog every single day of the long year"
TEXTS = [
    (0, "Mail a@b.co, call +1 (202) 555-0142 or see 10.0.0.255 and 300.1.1.1; card 4111 1111 1111 1111.", "en", "a"),
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "de", "b"),
    (4, LINE, "en", "a"), (5, LINE, "en", None), (6, LINE.upper(), "en", "b"), (7, "so " + LINE + " and more", "fr", "b"),
    (8, "x" * 5000, "en", "c"), (9, "Éa é ﬁ 日本 ▁x  y <|endoftext|> İΣς", None, "c"), (10, "7", "es", "c"),
    (11, " ".join(f"w{i % 37}" for i in range(3000)), "en", "a"), (12, "a@b.co_d@e.fg x@y x@y.z. ..@a.b 1.2.3.4.5.6.7.8 1.2.3.0256", "en", "a"),
    (13, "line one\nline one\n\nline two\nline one", "en", "a"), (14, "### *** %%% a b c d e f g h i j", "en", "a"),
    (7, "so " + LINE + " and more", "fr", "b"), (None, LINE, "en", "a"), (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def words(text):
    return [w for w in SPACE.split(text or "") if w]


# ---- 1, personal data

def brute_spans(text):
    text, out = text or "", []
    luhn = lambda d: sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    kinds = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
             "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
             "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(d := re.sub("[^0-9]", "", v)) <= 19 and luhn(d)),
             "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15)}
    for order, (kind, (pattern, good)) in enumerate(kinds.items()):
        out += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text) if good(m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


@pytest.mark.parametrize("table", ["docs", "small"])
def test_base_spans(table, request):
    df = request.getfixturevalue(table)
    for r in rows(df.select("text", pii.spans_text(pii.base_spans(F.coalesce("text", F.lit("")))).alias("found"))):
        assert r["found"] == brute_spans(r["text"])


def test_many_spans_keep_their_places(spark):
    text = " é ".join(f"m{i}@x.org" for i in range(1500))
    got = spark.createDataFrame([(text,)], "text string").select(pii.spans_text(pii.base_spans(F.col("text")))).first()[0]
    assert got == brute_spans(text)


def test_disclosing_terms_and_sanitised_text(spark):
    told = [f"Dr Zyx{'' if i else ','} number {i} writes from spy@corp.org today" for i in range(8)]
    other = [f"number {i} writes about nothing much today" for i in range(400)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate([*told, *other, "only zyx, is named here", None])], "doc_id long, text string, n_chars long")
    limits = pii.Disclosure(min_support=5)
    terms = {r["term"] for r in rows(pii.disclosing_terms(df.select("text"), limits))}
    assert {"zyx", "dr", "from"} <= terms and not terms & {"writes", "number", "today"}
    clean = {r["doc_id"]: r for r in rows(pii.sanitise(df, limits))}
    assert "spy@corp.org" not in clean[3]["text"] and "[EMAIL]" in clean[3]["text"]
    assert clean[408]["text"] == "only , is named here" and clean[408]["n_chars"] == len(clean[408]["text"])
    assert clean[20]["text"] == other[12] and clean[409]["text"] is None
    assert df.columns == pii.sanitise(df, limits).columns


def test_few_lines_lower_a_score_and_exclude_nothing(spark):
    plain = [f"number {i} writes about nothing much today" for i in range(4000)]
    beside = [f"write to ann{n}@corp.org about item {i}\nsincerely Qyl{n} in room {i}" for n, times in ((1, 1), (2, 2), (3, 3), (4, 4), (5, 5)) for i in range(times)]
    far = [f"write to ann6@corp.org about item {i}\nnothing\nsincerely Qyl6 in room {i}" for i in range(4)]
    df = spark.createDataFrame([(t,) for t in [*plain, *beside, *far]], "text string")
    got = {r["term"]: r["disclosure"] for r in rows(pii.disclosing_terms(df))}
    names = [got.get(f"qyl{n}", 0.0) for n in range(1, 7)]
    assert 0.9 <= names[2] < names[3] < 1 and names[4] == pytest.approx(1) and names[0] < 0.9 and names[5] == 0
    assert names[3] == pytest.approx(1 - 3 * (1 / 4 - 1 / 5) / math.log(df.select(F.sum(F.size(F.split("text", "\n")))).first()[0] / 8))
    assert "number" not in got and "sincerely" not in got


def test_overlapping_spans_are_replaced_once(spark):
    df = spark.createDataFrame([("card 4111111111111111 or +4111111111 1111 end",)], "text string")
    got = df.select(pii.sanitised(F.col("text"), pii.base_spans(F.col("text"))).alias("x")).first()[0]
    assert "4111" not in got and got.endswith(" end")


# ---- 2, near duplicates

def brute_fp(text, size=4):
    import xxhash

    found = [w.decode() for w in (text or "").encode().lower().split()]
    if not found:
        return 0
    parts = [found] if len(found) < size else [found[i:i + size] for i in range(len(found) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits):
    names = sorted(set(fps))
    root = {x: x for x in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return {x: find(x) for x in names}


@pytest.mark.parametrize("table", ["docs", "small"])
def test_simhash_components(table, request):
    df = request.getfixturevalue(table)
    got = rows(simhash_trie.near_duplicates(df, 4, 4))
    fps = [brute_fp(r["text"]) for r in got]
    comp = brute_components(fps, 4)
    least = {}
    for r, f in zip(got, fps, strict=True):
        if r["doc_id"] is not None:
            least[comp[f]] = min(least.get(comp[f], r["doc_id"]), r["doc_id"])
    assert len(got) == df.count()
    for r, f in zip(got, fps, strict=True):
        assert r["fp"] % (1 << 64) == f and r["component_id"] == least.get(comp[f])


def test_keep_one(docs, empty):
    kept = rows(simhash_trie.keep_one(docs))
    assert {r["doc_id"] for r in kept} >= {0, 1, 4} and not {r["doc_id"] for r in kept} & {2, 3, 5, 6}
    assert simhash_trie.keep_one(empty).count() == 0
    clash = docs.withColumns({"fp": F.lit(1), "component_id": F.lit(2)})
    assert simhash_trie.keep_one(clash).columns == clash.columns


def crowd():
    """Fingerprints around two centres, some in chains, and scattered ones."""
    import random

    rnd = random.Random(5)
    out = set()
    for _ in range(2):
        centre = rnd.getrandbits(64)
        for _ in range(400):
            out.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))))
    chain = rnd.getrandbits(64)
    for step in range(12):
        out.add(chain)
        chain ^= sum(1 << b for b in rnd.sample(range(64), 4))
    return sorted(out | {rnd.getrandbits(64) for _ in range(300)} | {0, 1, 15, 31, 2**64 - 1})


@pytest.mark.parametrize("max_node", [64, 1024])
def test_links_of_a_crowd_are_split_and_complete(spark, max_node):
    fps = crowd()
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash_trie.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, max_node)
    got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in rows(connected(links))}
    want = brute_components(fps, 4)
    groups = lambda m: sorted(sorted(x for x in fps if m.get(x, x) == r) for r in {m.get(x, x) for x in fps})
    assert groups(got) == groups(want)
    assert links.count() < 60 * len(fps)  # stars, not pairs


def test_connected_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 400), (3, 3)], "a long, b long")
    assert {r["node"]: r["root"] for r in rows(connected(links))} == {**{i: 1 for i in range(1, 201)}, 400: 400, 500: 400}


def test_connected_over_chunks(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(2200)] + [(7, 8)] * 50 + [(k, 9999) for k in range(0, 3000, 40)]
    parent = {x: x for p in pairs for x in p if p[0] != p[1]}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    for chunk in (1 << 18, 16):
        got = [(r["node"], r["root"]) for r in rows(connected(spark.createDataFrame(pairs, "a long, b long"), chunk))]
        assert sorted(got) == sorted((x, find(x)) for x in parent)


def test_connected_needs_no_rounds_for_few_links(spark, monkeypatch):
    def no_round(links, large):
        raise AssertionError("a round")

    monkeypatch.setattr(components, "_star", no_round)
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 200)], "a long, b long").repartition(8)
    assert {r["root"] for r in rows(connected(links))} == {1}


def test_links_become_stars_of_their_least_node():
    got = components._least_joined(np.array([5, 9, 7, 4]), np.array([7, 5, -2, 3])).to_pylist()
    assert sorted((r["a"], r["b"]) for r in got) == [(4, 3), (5, -2), (7, -2), (9, -2)]


# ---- 3, language

def test_language_held_out_accuracy(small):
    model = langid.train(small)
    found = rows(langid.predict(small, model))
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_spans_and_edges(small, docs, empty):
    model = langid.train(small)
    by = {r["lang"]: r["text"].split()[:40] for r in rows(small.filter("length(text) > 1000"))}
    path, _ = model.spans([" ".join([*by["en"], *by["es"]])])
    names = [model.languages[k] for k in path[0]]
    assert names[:30] == ["en"] * 30 and names[-30:] == ["es"] * 30
    found = {(r["doc_id"], r["text"]): r for r in rows(langid.predict(docs, model))}
    for i, t in ((1, None), (2, ""), (3, " \t\n "), (10, "7")):
        assert (found[i, t]["lang_pred"], found[i, t]["score"]) == ("und", 0.0)
    assert langid.keep_identified(empty).count() == 0
    assert {r["lang_pred"] for r in rows(langid.predict(docs, langid.train(empty)))} == {"und"}
    kept = langid.keep_identified(small.withColumns({"score": F.lit("x"), "lang_pred": F.lit(1)}))
    assert kept.count() >= 0.95 * small.count() and "score" in kept.columns


def test_foreign_scripts_and_gibberish_are_rejected(spark, small):
    import random

    rnd = random.Random(3)
    noise = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 10))) for _ in range(80))
    planted = ["Это обычный русский текст о погоде и природе. " * 3, "สวัสดีครับ ผมชื่อ ไทย " * 5, "日本語の文章です。" * 9, noise, "xqzt wvkj " * 30,
               "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. " * 2]
    docs = small.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(planted)], "doc_id long, text string, lang string"))
    found = {r["doc_id"]: r for r in rows(langid.predict(docs, langid.train(docs)))}
    kept = {r["doc_id"] for r in rows(langid.keep_identified(docs))}
    assert [found[-1 - k]["score"] for k in range(3)] == [0.0] * 3 and {found[-1 - k]["lang_pred"] for k in range(6)} <= {"de", "en", "es", "fr"}
    assert not any(-1 - k in kept for k in range(6)) and {r["doc_id"] for r in rows(small)} <= kept
    half = langid.train(small).predict(["the and that " * 20 + "погоде и природе " * 20]).to_pylist()[0]
    assert half["lang"] == "en" and 0.3 < half["score"] < 0.5


def test_labelling_holds_a_slice_at_a_time(small):
    model = langid.train(small)
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(3000)]
    texts = pa.array([" ".join(rng.choices(words, k=400)) for _ in range(1300)])
    model.predict([" ".join(words)])
    tracemalloc.start()
    try:
        langid.labelled(texts, model)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 25 << 20


def test_viterbi_against_all_paths():
    import itertools

    import numpy as np

    rnd = np.random.default_rng(3)
    scores = rnd.normal(size=(6, 3)).astype(np.float32)
    flat = np.array([0, 1, 2, 3, 4, 5, 2, 1])
    edges = np.array([0, 0, 5, 8])
    got = langid.viterbi(scores, flat, edges, 0.7)
    for a, b in ((0, 5), (5, 8)):
        value = lambda p: sum(scores[flat[a + k], p[k]] for k in range(b - a)) - 0.7 * sum(p[k] != p[k + 1] for k in range(b - a - 1))  # noqa: B023, E731
        best = max(value(p) for p in itertools.product(range(3), repeat=b - a))
        assert value(got[a:b]) == pytest.approx(best, abs=1e-4)


# ---- 4 and 10, tokenizers

@pytest.mark.parametrize("table", ["docs", "small"])
def test_token_counts(table, request):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.vocab_path("piece_bpe_32k.model"))
    df = request.getfixturevalue(table)
    for r in rows(bpe_heap.token_counts(df, queries.vocab_path("piece_bpe_32k.model"))):
        assert r["n_tokens"] == len(model.encode(r["text"] or ""))


@pytest.mark.parametrize("table", ["docs", "small"])
def test_bpe_round(table, request):
    from tokenizers import Tokenizer

    path = queries.vocab_path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    df = request.getfixturevalue(table)
    found = bpe_tree.bpe_decode(bpe_tree.bpe_encode(df, path), path, "ids", "again")
    for r in rows(found):
        want = model.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want
        assert r["decoded"] == r["again"] == model.decode(want, skip_special_tokens=False)


def test_words_are_encoded_without_collector_runs():
    codec = bpe_tree.WordBpe(bpe_tree.read_vocab(queries.vocab_path("word_bpe_49k.json")))
    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{i}," for k in range(676)) for i in range(20)]
    runs = []
    gc.callbacks.append(lambda phase, info: runs.append(phase))
    try:
        bpe_tree.encode_batch(codec, texts)
    finally:
        gc.callbacks.pop()
    assert len(runs) <= 2 and gc.isenabled()
    assert all(type(ids) is bytes for ids in codec.seen.new.values())


def test_many_words_are_cut_as_each_alone():
    codec = bpe_tree.WordBpe(bpe_tree.read_vocab(queries.vocab_path("word_bpe_49k.json")))
    words = ["don't", "\u0301a", "ΑΣ", "<|endoftext|>x", "a1b22", "İx's", "$$..!", "plain", "\u200b", "<|ENDOFTEXT|>"]
    assert codec.pre_tokens(words) == [codec.pre_tokens([w])[0] for w in words]
    assert codec.pre_tokens(["don't", "ΑΣ", "a1b22"]) == [["don", "'t"], ["ας".replace("ς", "σ")], ["a", "1", "b", "2", "2"]]


def test_segment_tree_takes_the_leftmost_lowest_rank():
    merges = {1 << bpe_tree.SHIFT | 1: (0, 2), 2 << bpe_tree.SHIFT | 2: (1, 3), 3 << bpe_tree.SHIFT | 1: (2, 4)}
    assert bpe_tree.merge_symbols([1] * 5, merges) == [4]
    assert bpe_tree.merge_symbols([1], merges) == [1]
    assert bpe_tree.merge_symbols([], merges) == []


# ---- 5, pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header class="site"><a href="/">Home</a></header><nav><ul><li>One<li>Two</ul></nav><div class="cookie-notice">We use cookies.</div>
<aside>See also</aside><article><header><h1>Title &amp; more</h1></header><p><b>First   part,<br>same block.<p>Second &lt;one&gt;&nbsp;here.</p>
<form><input value="x">Search</form><ul><li>item a<li>item b</ul><div class="ad">Buy!</div><section class="comments"><p>Nice!</p></section></article>
<footer>&copy; x</footer></body></html>"""


def test_page_extraction(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p>Just text. And more.</p><div class=ad>x</div>"), (5, "<nav>only menu</nav>"), (6, "no tags at all")], "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in rows(html_paths.extract_main_text(df))}
    assert got[1] == "Title & more\nFirst part, same block.\nSecond <one> here.\nitem a\nitem b"
    assert (got[2], got[3], got[4], got[5], got[6]) == ("", "", "Just text. And more.", "", "no tags at all")


def test_paths_without_an_article_mark():
    body = "".join(f"<div class=t><p>This is a long paragraph, number {i}, with several words and marks. It goes on.</p></div>" for i in range(9))
    links = "".join(f"<table><tr><td><a href=#>l{i}</a></table>" for i in range(30))
    assert html_paths.extract(f"<body>{links}{body}</body>").count("\n") == 8


PARAGRAPH = "<p>A paragraph with several words, some marks, and a second sentence. It goes on.</p>"


def test_score_decides_inside_the_article():
    items = "".join(f"<li><a href=#>other page {i}</a>" for i in range(80))
    cells = "".join(f"<tr><td>{i}<td>{i % 7}" for i in range(300))
    got = html_paths.extract(f"<article><h1><a href=/>Title</a></h1>{PARAGRAPH * 5}<ul>{items}</ul><table>{cells}</table><ol><li><a href=/>Source</a></ol></article>").split("\n")
    assert got[0] == "Title" and got[-1] == "Source" and len(got) == 1 + 5 + 600 + 1  # the long run of bare links is out, short blocks are not


def test_ordinary_class_and_id_words_drop_nothing():
    body = "\n".join(["A paragraph with several words, some marks, and a second sentence. It goes on."] * 3)
    for wrapper in ('class="content with-sidebar"', 'id="post" class="has-comments"', 'class="top-story"', 'class="header-layout"', 'class="main sidebar"'):
        assert html_paths.extract(f"<body><div {wrapper}>{PARAGRAPH * 3}<div class=ad>Buy now!</div></div></body>") == body
    parts = '<h2 id="side-effects">Effects</h2><h2 id="related-work">Work</h2><p class="notice-period">Period</p><section id="search-algorithms"><p>Search</p></section>'
    assert html_paths.extract(f"<article>{PARAGRAPH * 3}{parts}<div class=ad>Buy now!</div></article>") == body + "\nEffects\nWork\nPeriod\nSearch"


# ---- 6, repeated passages

def brute_repeats(table, length=13):
    first = {}
    for i, t in table:
        w = words(t)
        for k in range(len(w) - length + 1):
            key = tuple(w[k:k + length])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in table:
        w = words(t)
        gone = set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k:k + length])] < i:
                gone.update(range(k, k + length))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("table", ["docs", "small"])
def test_repeats(table, request):
    df = request.getfixturevalue(table).filter("doc_id is not null")
    got = substr.remove_repeats(df).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == brute_repeats([(r.doc_id, r.text) for r in df.collect()])


def test_repeats_across_partitions_and_edges(spark, docs, empty):
    import random

    rnd = random.Random(2)
    shared = [[f"s{rnd.randrange(30)}" for _ in range(rnd.randint(10, 40))] for _ in range(20)]
    table = [(i, " ".join(w for _ in range(rnd.randint(0, 4)) for w in [f"u{rnd.randrange(9999)}", *rnd.choice(shared)])) for i in range(150)]
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(7)
    got = substr.remove_repeats(df).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == brute_repeats(table)
    nulls = [r for r in rows(substr.remove_repeats(docs)) if r["doc_id"] is None]
    assert sorted(r["n_removed"] for r in nulls) == [0, len(words(LINE))]
    assert substr.remove_repeats(empty).count() == 0


# ---- 7, fingerprints

def brute_edited(table):
    order = sorted(table, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, then = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[:len(t) - third] + then[:third]).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("ranges", [10, 2000])
@pytest.mark.parametrize("table", ["docs", "small"])
def test_fingerprints(table, ranges, request, monkeypatch):
    monkeypatch.setattr(cws, "RANGE_ROWS", ranges)
    df = request.getfixturevalue(table)
    got = rows(cws.fingerprints(df))
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    want = brute_edited([(r.doc_id, r.text) for r in df.collect()])
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got], key=key) == sorted(want, key=key)
    for r in got:
        assert len(r["fingerprint"]) == 4 * cws.SAMPLES and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["fingerprint"] == r["edited_fingerprint"]:
            assert r["near_edited"] == 1


def test_collision_rate_is_generalised_jaccard(spark):
    a = Counter({f"t{i}": 1 + i % 4 for i in range(60)})
    b = Counter({f"t{i}": 1 + (i * 7) % 5 for i in range(25, 90)})
    texts = [" ".join(c.elements()) for c in (a, b, a, Counter())]
    found = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    pairs = found.select("k", F.lit(0).alias("side"), F.explode(F.split("text", " ")).alias("word")).filter("word <> ''")
    sig = {r["k"]: r["sig_0"] for r in rows(cws.signatures(pairs, ["k"], 1, 1024))}
    keys = a.keys() | b.keys()
    true = sum(min(a[x], b[x]) for x in keys) / sum(max(a[x], b[x]) for x in keys)
    rate = sum(x == y for x, y in zip(sig[0], sig[1], strict=True)) / 1024
    assert sig[0] == sig[2] and abs(rate - true) < 4 * math.sqrt(true * (1 - true) / 1024)


# ---- 8, mixing

def brute_targets(sizes, weights=(3, 1, 2), total=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = total * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not over:
            return out | {s: weight[s] * level for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("table", ["docs", "small"])
def test_mix(table, request):
    df = request.getfixturevalue(table)
    got = rows(mixing.mix(df))
    again = rows(mixing.mix(df.repartition(5)))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["copies"])
    assert [key(r) for r in sorted(got, key=key)] == [key(r) for r in sorted(again, key=key)]
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r["size"] == len(words(r["text"])) and 0 <= r["copies"] <= 2
        assert math.floor(r["rate"]) <= r["copies"] <= math.ceil(r["rate"])
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
    want = brute_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    if table == "small":
        for s in sizes:
            assert abs(taken[s] - want[s]) <= max(0.05 * want[s], min(r["size"] for r in got if r["source"] == s))


def test_mix_meets_the_dual(small):
    got = rows(mixing.mix(small))
    for source in {r["source"] for r in got}:
        mine = [r for r in got if r["source"] == source]
        assert sum(r["rate"] * r["size"] for r in mine) == pytest.approx(mine[0]["target"], rel=1e-6)


def test_resample(docs, empty):
    clash = docs.withColumns({"copies": F.lit(9), "size": F.lit("x"), "key": F.lit(1)})
    out = mixing.resample(clash)
    assert out.columns == clash.columns
    assert out.count() == sum(r["copies"] for r in rows(mixing.mix(docs)))
    assert mixing.resample(empty).count() == 0


# ---- 9, quality

def brute_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    hit = {k + j for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for j in range(5)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


@pytest.mark.parametrize("table", ["docs", "small"])
def test_quality_counts(table, request):
    df = request.getfixturevalue(table)
    got = rows(quality_sketch.judge(df.withColumn("again", F.col("text"))))
    assert len(got) == df.count()
    for r in got:
        want = brute_counts(r["again"])
        assert {k: r[k] for k in want} == want
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality_sketches_merge_and_judge(spark, empty):
    plain = [(i, f"this is a plain text of document {i} with some words that differ {i * 7} and {i * 13} end", "en", "a") for i in range(300)]
    junk = [(1000 + i, " ".join(f"w{i}{k}###" for k in range(30)), "en", "a") for i in range(5)]
    df = spark.createDataFrame(plain + junk, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in rows(quality_sketch.judge(df))}
    assert all(got[i] for i in range(300)) and not any(got[1000 + i] for i in range(5))
    measured = quality_sketch.measure(df)
    whole = {(r["ratio"], r["cell"]): r["n"] for r in rows(quality_sketch.sketches(measured, []))}
    parts = Counter()
    for part in (measured.filter("doc_id % 2 = 0"), measured.filter("doc_id % 2 = 1")):
        parts.update({(r["ratio"], r["cell"]): r["n"] for r in rows(quality_sketch.sketches(part, []))})
    assert whole == parts
    assert quality_sketch.judge(empty).count() == 0


def test_empty_tables(empty):
    assert pii.sanitise(empty).count() == 0
    assert simhash_trie.near_duplicates(empty).count() == 0
    assert cws.fingerprints(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert bpe_heap.token_counts(empty, queries.vocab_path("piece_bpe_32k.model")).count() == 0
    assert bpe_tree.bpe_encode(empty, queries.vocab_path("word_bpe_49k.json")).count() == 0
