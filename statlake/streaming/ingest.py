"""Exactly-once ingestion of newly landed response pages.

``readStream`` over the landing folder (one file = one page body, read as whole
text) -> each body parsed once -> a page ledger in the stream's keyed state
(``dropDuplicates`` on the page's identity) -> ``foreachBatch``, which writes
each epoch to a folder of its own.  The ledger is committed with the batch, so a page
that comes again, in any order or doubled in one batch, adds nothing; a
batch that is run again overwrites its own folder.  Neither needs the target: no
row of it is read and none of its folders is listed, so a batch costs what its pages cost.

Nulls are values of a key.  Pages that failed and pages without a table id or a
position go to the quarantine beside the target, once for each different body.  On
large lakes give the stream the RocksDB state store; the ledger has one short key
a page (at most 100,000 rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.model import OBSERVATION_SCHEMA
from statlake.plans.lake import read_if_there
from statlake.session import cut_lineage
from statlake.sources.responses import left_out, page_values, parsed_pages

LEDGER_SCHEMA = T.StructType([T.StructField("page", T.StringType())])


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Landed observations with the declared schema (partition values such
    as ``stats_data_id=0003000002`` stay strings)."""
    return spark.read.schema(OBSERVATION_SCHEMA).parquet(path).select(*[f.name for f in OBSERVATION_SCHEMA.fields])


def write_epoch(pages: DataFrame, epoch: int | str, target: str, quarantine: str) -> None:
    """Write the rows of new parsed pages, and what is left out, to the folders
    of ``epoch``; a second call for the same epoch replaces the first."""
    values = page_values(pages.where("keyed"))
    values.write.mode("overwrite").partitionBy("stats_data_id").parquet(f"{target}/epoch={epoch}")
    left_out(pages).write.mode("overwrite").parquet(f"{quarantine}/epoch={epoch}")


def _each_epoch(pages: DataFrame, epoch: int, target: str, quarantine: str) -> None:
    pages.persist()  # both writes use the batch's one parse
    try:
        write_epoch(pages, epoch, target, quarantine)
    finally:
        pages.unpersist()


def ingest_batch(bodies: DataFrame, target: str, quarantine: str) -> None:
    """The same for a batch that comes without a stream.

    The ledger is a table of page identities beside the target (one row a page).
    The epoch is named after the new pages and the ledger is written last, so
    a call that was cut short is completed by the same call.  Columns
    ``stats_data_id``, ``lang`` and ``query_fingerprint`` of ``bodies`` (from the
    landing layout) win over what the body says."""
    spark = bodies.sparkSession
    ledger = f"{target.rstrip('/')}-ledger"
    pages = cut_lineage(parsed_pages(bodies).dropDuplicates(["page"]), "batch")
    seen = read_if_there(spark, ledger, LEDGER_SCHEMA)
    if seen is not None:
        pages = cut_lineage(pages.join(seen.select("page"), "page", "left_anti"), "new-pages")
    name = pages.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("page")).alias("h")).first()
    if name["n"]:
        epoch = f"{name['n']}-{name['h'] & (1 << 64) - 1:016x}"
        write_epoch(pages, epoch, target, quarantine)
        pages.select("page").write.mode("overwrite").parquet(f"{ledger}/epoch={epoch}")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Pages that were left out: digest, reason, redacted message, body."""
    return spark.read.parquet(path).select("body_sha256", "reason", "error_msg", "body")


def start_ingest(spark: SparkSession, landing: str, target: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int = 2000,
                 identity: list[str] | None = None, quarantine: str | None = None):
    """Start the ingestion query; returns the ``StreamingQuery``.  Each
    micro-batch takes at most ``max_files_per_trigger`` landed pages.

    ``identity`` names the folder columns of the landing layout, such as
    ``stats_data_id=.../lang=E/``, for pages that do not name their table."""
    quarantine = quarantine or f"{target.rstrip('/')}-quarantine"
    reader = (spark.readStream.format("text").option("wholetext", True)
              .option("maxFilesPerTrigger", int(max_files_per_trigger)))
    if identity:
        reader = reader.schema("value string, " + ", ".join(f"`{c}` string" for c in identity))
    bodies = reader.load(landing).select(F.col("value").alias("body"), *(identity or []))
    pages = parsed_pages(bodies).dropDuplicates(["page"])
    writer = (
        pages.writeStream.foreachBatch(lambda df, epoch: _each_epoch(df, epoch, target, quarantine))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def land_pages(bodies: DataFrame, landing: str, page_col: str = "page_no") -> None:
    """Land page bodies one body per file (the layout of landed API
    responses): partitioning by the page number gives each page its own
    folder and file."""
    bodies.select(page_col, "body").write.mode("append").partitionBy(page_col).text(landing)
