"""The registered queries of the training-data operators.

Each applies one operator with production parameters to its whole table and
derives the contract's digest columns from the operator's outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.llm import bpe_heap, bpe_tree, collocations, cws, html_paths, langid, mixing, ngram_join, oracle, pii, quality_sketch, simhash_trie, substr, token_align
from statlake.llm.common import hex_digest, table


def vocab_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.KINDS], hex_digest(pii.spans_text(F.col("base_spans"))).alias("base_sha256"),
                        pii.spans_text(F.col("spans")).alias("spans"), pii.sanitised(F.coalesce("text", F.lit("")), F.col("spans")).alias("sanitised"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_trie.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash_trie.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs))
    held_out = F.coalesce(langid.fold(F.col("doc_id")) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe_heap.token_counts(docs, vocab_path("piece_bpe_32k.model"))
    return found.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                        (F.col("n_tokens") > 4096).alias("over_limit"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_paths.extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substr.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate", "copies")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_sketch.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def bpe_digests(found: DataFrame, *more: str) -> DataFrame:
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), hex_digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                        hex_digest(F.col("decoded")).alias("decoded_sha256"), *more)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(bpe_tree.bpe_encode(docs, vocab_path("word_bpe_49k.json")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), ngram_join.Rule(words=4, percent=85))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(table(spark, sf_dir, "documents").select("doc_id", "text"), vocab_path("byte_bpe_50k.json"), vocab_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_simhash, op3_langid, op4_token_count, op5_html, op6_substring, op7_fingerprint, op8_mixing, op9_quality, op10_bpe,
                                   op11_collocations, op12_ngram_join, op13_token_align)}

#: SQL cannot express the others; the tests hold them against brute force.
ORACLE: dict[str, str] = {"op6_substring": oracle.SUBSTRING, "op9_quality": oracle.QUALITY, "op11_collocations": oracle.COLLOCATIONS}
