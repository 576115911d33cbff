"""Session helpers.

AQE stays on, so Spark re-plans joins, coalesces shuffle partitions and splits
skewed partitions at runtime; ``get_spark`` starts local sessions with a small
number of shuffle partitions, a cluster's own setting is left alone.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "statlake", driver_memory: str = "16g") -> SparkSession:
    """Return the active session, or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = (
        SparkSession.builder.master(master or "local[*]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf_get(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - some session types raise on unset keys
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local master without
    one gets a private folder.  On a cluster each machine would write to its own
    disk, so an unset folder is an error there."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session
        sc = None
    current = None
    if sc is not None:
        current = sc.getCheckpointDir() or sc.getConf().get(_CKPT_KEY, None)
    current = current or _conf_get(spark, _CKPT_KEY)
    if not current:
        master = sc.master if sc is not None else _conf_get(spark, "spark.master") or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="statlake-ckpt-")
        if sc is None:
            spark.conf.set(_CKPT_KEY, current)
    if sc is not None:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    return current


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables."""
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def partitions_for(spark: SparkSession, rows: int, per_task: int = 500_000) -> Iterator[None]:
    """Raise the number of shuffle partitions so that a task gets some
    ``per_task`` of ``rows``, for jobs whose tasks sort what they get."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if math.ceil(rows / per_task) <= int(before):
        yield
        return
    spark.conf.set(key, str(math.ceil(rows / per_task)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df, name: str = "cut"):
    """Materialise ``df`` as parquet in the shared checkpoint folder and read
    it back: one computation (a reliable RDD checkpoint computes its input
    twice), lineage cut, and the data survives executor loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
