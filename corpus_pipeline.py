"""A corpus pipeline of five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statlake.llm import bpe_tree, langid, mixing, pii, simhash_trie
from statlake.llm.common import table
from statlake.llm.queries import bpe_digests, vocab_path
from statlake.session import cut_lineage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; the classifier learns from this input."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each near-duplicate group."""
    return simhash_trie.keep_one(docs, shingle=4, max_bits=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text sanitised."""
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (not at all, once, twice)."""
    return mixing.resample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of them and of the decoded text."""
    return bpe_digests(bpe_tree.bpe_encode(docs, vocab_path("word_bpe_49k.json")), "lang", "source", "ids")


STAGES = [("language ID", language), ("SimHash near-dedup", near_duplicates), ("PII", personal_data),
          ("mixing sources to target weights", mixture), ("BPE encoding and decoding", encode)]

#: SQL cannot express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
