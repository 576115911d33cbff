"""Paging: row limits, start positions, page planning and resume.

Row order in a landed cube is ``(page_offset, pos)``.  Start position and limit
count the rows that are left after all filters, within each pull (table,
language, filter fingerprint).  Rows are counted per range of the order first and
numbered inside ranges, so no global window and no offset over everything is
planned; a small limit is cut in every task before the shuffle by pull, on
partitions of bounded size, as the cut sorts what a task has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.session import cut_lineage

PAGE_KEYS = ["stats_data_id", "lang", "query_fingerprint"]
MAX_RECORDS_PER_PAGE = 100_000  # the service's per-response cap
#: Larger top-k selections are numbered by ranges instead of merged in one task.
MAX_TOP_ROWS = 100_000


def row_number_col(page_offset: str = "page_offset", pos: str = "pos") -> Column:
    return F.col(page_offset) + F.col(pos)


def take_rows(df: DataFrame, limit: int | None = None, start_position: int = 1,
              order_by: list[str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Rows ``start_position`` (1-based) to ``start_position + limit - 1`` in
    source order of each pull.

    ``keys`` name a pull (default: those of ``PAGE_KEYS`` that are columns; an
    empty list numbers all rows together)."""
    if start_position < 1:
        raise ValueError("start_position counts from 1")
    if limit is not None and limit < 0:
        raise ValueError("limit must be a non-negative whole number")
    order = order_by or ["page_offset", "pos"]
    keys = [k for k in PAGE_KEYS if k in df.columns] if keys is None else keys
    if limit is None and start_position == 1:
        return df
    # beyond this many rows Spark plans no cut before the shuffle: a pull would meet in one task
    cut = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if limit is not None and start_position + limit <= (min(cut, MAX_TOP_ROWS) if keys else MAX_TOP_ROWS):
        last = start_position + limit - 1
        if keys:  # each task keeps the first rows of a pull before the shuffle
            number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            # a page file may hold very many rows: AQE cuts what is dealt out here to its advisory size
            return df.hint("rebalance", *order).withColumn("__row", number).where((F.col("__row") <= last) & (F.col("__row") >= start_position)).drop("__row")
        top = df.orderBy(*order).limit(last)  # distributed top-k
        return top.offset(start_position - 1) if start_position > 1 else top
    return _numbered(df, order, keys, start_position, limit)


def _numbered(df: DataFrame, order: list[str], keys: list[str], start: int, limit: int | None) -> DataFrame:
    """Rows by number: rows go to ranges of (keys, order); a range's first
    numbers follow from the counts of the ranges before it (one row a range
    and pull), the rest is a row number inside the range."""
    spread = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)]).withColumn("__range", F.spark_partition_id())
    spread = cut_lineage(spread, "ranges")  # the ranges must not change between the two uses
    counts = spread.groupBy("__range", *keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    last = F.lit(None) if limit is None else F.lit(start + limit - 1)
    wanted = counts.where(F.col("__before") + F.col("__n") >= start)
    if limit is not None:
        wanted = wanted.where(F.col("__before") < last)
    renamed = wanted.select(F.col("__range").alias("__r"), F.col("__before"), *[F.col(k).alias(f"__{k}") for k in keys])
    match = [F.col("__range") == F.col("__r"), *[F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]]
    number = F.row_number().over(Window.partitionBy("__range", *keys).orderBy(*order))
    rows = spread.join(renamed, match).withColumn("__row", F.col("__before") + number).where(F.col("__row") >= start)
    if limit is not None:
        rows = rows.where(F.col("__row") <= last)
    return rows.select(*df.columns)


def page_plan(first_pages: DataFrame, page_size: int = MAX_RECORDS_PER_PAGE,
              limit: int | None = None, start: int = 1,
              keys: list[str] | None = None) -> DataFrame:
    """Remaining page requests for many tables at once.

    Input: one row per table with ``total_number``, ``to_number`` and
    ``next_key`` from its first page.  Output: one row per further page,
    ``(keys..., offset, size)``; the last page is trimmed to the target.
    Tables whose first page is complete (no next key, or ``to >= target``)
    produce nothing -- the guard runs *before* ``sequence`` so it never sees
    reversed bounds.
    """
    keys = keys or [k for k in PAGE_KEYS if k in first_pages.columns]
    size = min(limit, page_size) if limit is not None else page_size
    target = F.col("total_number")
    if limit is not None:
        target = F.least(target, F.lit(start + limit - 1).cast("bigint"))
    todo = first_pages.withColumn("target_last", target).where(
        F.col("next_key").isNotNull()
        & F.col("to_number").isNotNull()
        & (F.col("to_number") < F.col("target_last"))
    )
    offsets = todo.select(
        *keys, "target_last",
        F.explode(
            F.sequence(F.col("to_number") + 1, F.col("target_last"), F.lit(size).cast("bigint"))
        ).alias("offset"),
    )
    return offsets.select(
        *keys, "offset",
        F.least(F.lit(size).cast("bigint"), F.col("target_last") - F.col("offset") + 1).alias("size"),
    )


def incomplete_tables(first_pages: DataFrame) -> DataFrame:
    """Tables the service stopped short on: no next key but ``to < total``
    (a silent truncation in the reference; flagged here)."""
    return first_pages.where(
        F.col("next_key").isNull() & (F.col("to_number") < F.col("total_number"))
    )


def missing_pages(plan: DataFrame, manifest: DataFrame, keys: list[str] | None = None,
                  offset_col: str = "offset") -> DataFrame:
    """Resume: planned pages not yet landed (left anti join on the page key).
    A page whose status says that it failed does not count as landed."""
    keys = keys or [k for k in PAGE_KEYS if k in plan.columns and k in manifest.columns]
    if "ok" in manifest.columns:
        manifest = manifest.where(F.col("ok"))
    elif "status_raw" in manifest.columns:
        manifest = manifest.where(F.col("status_raw").try_cast("int") == 0)
    landed = manifest.select(*keys, F.col(offset_col).alias("offset")).distinct()
    return plan.join(landed, on=[*keys, "offset"], how="left_anti")


def _islands(rows: DataFrame, by: list[str]) -> DataFrame:
    """Runs of ranges that touch or overlap within ``by``, as one range each."""
    order = Window.partitionBy(*by).orderBy("from_number", "to_number")
    reach = F.max("to_number").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(reach.isNull() | (F.col("from_number") > reach + 1), 1).otherwise(0)
    number = F.sum("__first").over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = rows.withColumn("__first", first).withColumn("__run", number)
    return runs.groupBy(*by, "__run").agg(F.min("from_number").alias("from_number"), F.max("to_number").alias("to_number")).drop("__run")


def landed_ranges(manifest: DataFrame, keys: list[str] | None = None, span: int = 10 * MAX_RECORDS_PER_PAGE) -> DataFrame:
    """Row ranges that are covered by landed pages, whatever their sizes:
    ``(keys..., from_number, to_number)``, one row for each unbroken range.

    Pages are merged inside spans of the row number first, so a table with very
    many pages is spread over tasks and only its spans' ranges meet in one."""
    keys = keys or [k for k in PAGE_KEYS if k in manifest.columns]
    if "ok" in manifest.columns:
        manifest = manifest.where(F.col("ok"))
    pages = manifest.select(*keys, "from_number", "to_number").where("from_number is not null and to_number >= from_number")
    pages = pages.withColumn("__span", F.floor(F.col("from_number") / span))
    return _islands(_islands(pages, [*keys, "__span"]).drop("__span"), keys)


def missing_ranges(targets: DataFrame, manifest: DataFrame, keys: list[str] | None = None, start: int = 1,
                   limit: int | None = None) -> DataFrame:
    """Rows still to be pulled: the gaps that landed pages of any size leave
    between ``start`` and each target's ``total_number`` (at most ``limit`` rows)."""
    keys = keys or [k for k in PAGE_KEYS if k in targets.columns and k in manifest.columns]
    last = F.col("total_number")
    if limit is not None:
        last = F.least(last, F.lit(start + limit - 1).cast("bigint"))
    wanted = targets.select(*keys, last.alias("__last")).where(F.col("__last") >= start).groupBy(*keys).agg(F.max("__last").alias("__last"))
    have = landed_ranges(manifest, keys).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("from_number").alias("__from"), F.col("to_number").alias("__to"))
    match = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    met = wanted.join(have, [*match, F.col("__from") <= F.col("__last"), F.col("__to") >= start], "left")
    order = Window.partitionBy(*keys).orderBy("__from")
    met = met.withColumns({"__before": F.lag("__to").over(order), "__next": F.lead("__from").over(order)})
    gap = lambda a, b: F.struct(a.alias("from_number"), b.alias("to_number"))
    begin = F.lit(start).cast("bigint")
    ahead = gap(F.greatest(F.coalesce(F.col("__before") + 1, begin), begin), F.least(F.coalesce(F.col("__from") - 1, F.col("__last")), F.col("__last")))
    behind = F.when(F.col("__from").isNotNull() & F.col("__next").isNull(), gap(F.col("__to") + 1, F.col("__last")))
    gaps = met.select(*keys, F.explode(F.array_compact(F.array(ahead, behind))).alias("g"))
    return gaps.select(*keys, "g.from_number", "g.to_number").where("from_number <= to_number")


def plan_ranges(ranges: DataFrame, page_size: int = MAX_RECORDS_PER_PAGE, keys: list[str] | None = None) -> DataFrame:
    """Page requests ``(keys..., offset, size)`` that fill ``missing_ranges``."""
    keys = keys or [k for k in PAGE_KEYS if k in ranges.columns]
    size = F.lit(page_size).cast("bigint")
    offsets = ranges.select(*keys, "to_number", F.explode(F.sequence("from_number", "to_number", size)).alias("offset"))
    return offsets.select(*keys, "offset", F.least(size, F.col("to_number") - F.col("offset") + 1).alias("size"))


def split_batches(plan: DataFrame, size: int, keys: list[str] | None = None,
                  order_col: str = "offset") -> DataFrame:
    """Number pending pages into batches of ``size`` per table (by position
    in offset order).  The window is per table, so it parallelises across
    tables and never gathers all pages in one task."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    keys = keys or [k for k in PAGE_KEYS if k in plan.columns]
    w = Window.partitionBy(*keys).orderBy(order_col)
    return plan.withColumn(
        "batch_id", F.floor((F.row_number().over(w) - 1) / F.lit(size)).cast("int")
    )
