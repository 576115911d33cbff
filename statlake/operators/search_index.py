"""Keyword search over an inverted index of three-letter pieces.

The index lies beside the catalogue: a row for each different trigram of an
entry's text columns, in folders by trigram bucket.  A search reads only the
buckets of its terms' trigrams, intersects their entries and checks what is left on the
texts, so it finds exactly what a scan with ``search.keyword_predicate`` finds.  Terms
of fewer than three letters have no trigram; an alternative made of such terms only
cannot be narrowed and is looked up by a scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.operators.search import TEXT_COLUMNS, keyword_predicate, parse_keyword

BUCKETS = 64
LENGTH = 3


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def trigrams(text: Column) -> Column:
    """The different trigrams of a text, in lower case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    places = F.when(F.length(low) >= LENGTH, F.sequence(F.lit(1), F.length(low) - (LENGTH - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substr(low, i, F.lit(LENGTH))))


def write_index(catalog: DataFrame, path: str, text_cols: list[str] | None = None, id_col: str = "id") -> None:
    """Land the index of a catalogue's text columns."""
    cols = [c for c in (text_cols or TEXT_COLUMNS) if c in catalog.columns]
    grams = F.array_distinct(F.flatten(F.array(*[trigrams(F.col(c)) for c in cols])))
    rows = catalog.select(F.col(id_col).alias("entry"), F.explode(grams).alias("gram")).withColumn("bucket", _bucket(F.col("gram")))
    # a very common trigram is dealt out by its entries too
    (rows.repartition("bucket", F.pmod(F.xxhash64("entry"), F.lit(8))).sortWithinPartitions("bucket", "gram")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def _pieces(term: str) -> list[str]:
    term = term.lower()
    return sorted({term[i:i + LENGTH] for i in range(len(term) - LENGTH + 1)})


def candidates(spark: SparkSession, path: str, keyword: str) -> DataFrame | None:
    """(entry) that hold all trigrams of some alternative of the keyword; None
    if an alternative has no trigram, so that any entry may match."""
    index = spark.read.parquet(path)
    ways = []
    for terms in parse_keyword(keyword):
        grams = sorted({g for t in terms for g in _pieces(t)})
        if not grams:
            return None
        buckets = [r["b"] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(_bucket(F.col("g")).alias("b")).distinct().collect()]
        held = index.where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
        ways.append(held.groupBy("entry").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)).select("entry"))
    return reduce(DataFrame.unionAll, ways).distinct() if ways else None


def search_indexed(catalog: DataFrame, path: str, keyword: str, text_cols: list[str] | None = None, id_col: str = "id") -> DataFrame:
    """The rows of ``catalog`` that the keyword matches, found by the index."""
    found = candidates(catalog.sparkSession, path, keyword)
    if found is not None:
        catalog = catalog.join(found.withColumnRenamed("entry", id_col), id_col, "left_semi")
    return catalog.where(keyword_predicate(catalog, keyword, text_cols))
