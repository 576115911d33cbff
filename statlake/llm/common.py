"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII white-space characters.
ASCII_SPACE = "\x20\x09-\x0D"
WORD_SPLIT = f"[{ASCII_SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text (null: none), in order."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` has it
    inside a lambda."""
    return F.element_at(F.transform(F.array(value), lambda v: use(v)), 1)


def arrow_rows(df: DataFrame, rows: int = 1000) -> None:
    """Bound the Arrow batches of the session, and so what the Python workers and
    the executors' Arrow buffers hold at once; texts are kilobytes, not numbers."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def hex_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)
