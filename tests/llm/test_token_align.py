"""Cross-tokenizer alignment against a plain version with the two libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from statlake.llm import token_align
from statlake.llm.queries import vocab_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def brute(rows):
    """[(id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest)] by loops."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    tok_a = Tokenizer.from_file(vocab_path(A))
    tok_a.encode_special_tokens = True
    tok_b = sentencepiece.SentencePieceProcessor(model_file=vocab_path(B))
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    byte = {chr(b) if b in shown else chr(next(rest)): b for b in range(256)}
    bytes_a = lambda i: bytes(byte[c] for c in tok_a.id_to_token(i))
    bytes_b = lambda i: bytes([int(tok_b.id_to_piece(i)[3:5], 16)]) if tok_b.is_byte(i) else tok_b.id_to_piece(i).replace("▁", " ").encode()
    docs, holds = [], Counter()
    for _, text in rows:
        a = tok_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tok_b.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
            docs.append([])
            continue
        groups, ga, gb, ea, eb, j = [], [], [], 0, 0, 0
        for i in a:
            ga.append(i)
            ea += len(bytes_a(i))
            while eb < ea:
                gb.append(b[j])
                eb += len(bytes_b(b[j]))
                j += 1
            if eb == ea:
                groups.append((ga, gb))
                ga, gb = [], []
        docs.append(groups)
        holds.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in holds.items():
        best[x] = max(best[x], n)
    out = []
    for (i, _), groups in zip(rows, docs):
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(holds[p] == best[p[0]] for p in links),
                    sum(holds[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, token_align.align(df, vocab_path(A), vocab_path(B)).collect()), key=str)


ODD = ["", " ", "  two  spaces ", "a\nb\r\n\tc\x00d", "<|endoftext|> <s> </s> <unk> <0x41>", "▁mark", "x▁", "①ﬁ Ⅷ é é ﻿z 日本語のテキスト", "🙂🙃 👩‍👩‍👧", "don't I'll we've 'S",
       "12345 67 8,901", "aaaaaaaaaaaaaaaa", "ñandú ſtraße İΣς", " line   nbsp", "x y x y xyx yxy"]


def test_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(token_align, "SLICE_TEXT", 2000)  # several slices in a task
    rng = random.Random(5)
    syllables = ["tion", "the", "an", " ", "ñ", "qu", "xz", "1", ".", "\n", "é", "日", "ü", "ing", "Re", "  "]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 120)))) for i in range(150)]
    rows += [(7, rows[-1][1]), (7, rows[-1][1]), (None, rows[-1][1]), (None, None), (500, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(df) == brute(rows)


def test_documents_of_the_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_large_groups_count_by_distinct_ids(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD + ["qxzqxz" * 40, "日本" * 50, "ñé" * 60])]
    monkeypatch.setattr(token_align, "MANY_LINKS", 1)
    v = token_align.Vocabularies(*(token_align.read_vocab(vocab_path(x)) for x in (A, B)))
    import pyarrow as pa

    texts = pa.array([t for _, t in rows])
    few = token_align._align(v, texts)
    monkeypatch.setattr(token_align, "MANY_LINKS", 1 << 40)
    assert [x.to_pylist() for x in token_align._align(v, texts)] == [x.to_pylist() for x in few]


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 200_000, "ab1 " * 50_000])
def test_very_long_texts(spark, text):
    df = spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in token_align.align(df, vocab_path(A), vocab_path(B)).collect()}
    assert got[1]["n_a"] > 0 and got[1]["n_links"] >= got[1]["n_groups"] > 0


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert result(empty) == []
    df = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n_a int, slice string")
    assert result(df) == brute([(1, "a b")])
