"""Mixing sources to target weights by entropy balancing.

Each source's target of words is a share of the total by weight, capped at
``most_copies`` times its size, the excess reshared by weight (water filling,
solved in closed form over the sources).  Document rates are the ones nearest to
1 in relative entropy that meet the target without exceeding the cap:

    rate = min(most_copies, exp(lambda * size / mean size)),

with one multiplier a source from the convex dual.  Newton steps (kept inside a
bracket that is known to hold the root) run on Spark over a histogram of the
documents by source, size and hash slot, so a step's cost does not grow with the
documents' lengths and a source with a third of all rows is pre-aggregated.
Rates are rounded to whole copies by error diffusion along falling sizes, and
once more for what is left: a document takes the floor or the ceiling of its
rate, and a source's words end within about half of its smallest documents' size
of the target.

Defined results: null text: size 0, no copies needed (rate 1, nothing taken);
null sources are one source, last; an empty table gives an empty table; equal
rows are told apart by nothing, so any of them may take the extra copy; the
outcome depends on ids and sizes only, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import ASCII_SPACE, free_name
from statlake.session import cut_lineage

#: Weights of the sources in order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words of the mix, as a part of all words.
TOTAL = 1.5
MOST_COPIES = 2
#: Hash slots that split the documents of one source and size.
SLOTS = 64
NEWTON_STEPS = 80


def word_count(text: Column) -> Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{ASCII_SPACE}]++")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, total: float = TOTAL, most: int = MOST_COPIES) -> DataFrame:
    """``(key, source, source_size, target)`` from rows ``(key, source, size)``.

    The window without a partition is over sources, after aggregation."""
    by = sizes.groupBy("key").agg(F.first("source", ignorenulls=True).alias("source"), F.sum("size").alias("source_size"))
    by = cut_lineage(by, "sources")
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = by.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * most).withColumn("fill", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("level", (F.sum("source_size").over(everything) * total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                               / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))).over(everything)["level"]
    return ranked.select("key", "source", "source_size", F.coalesce(F.least("cap", F.col("weight") * level), "cap").alias("target"))


def _multipliers(classes: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """``(key, scale, step)``: the dual multiplier of each source, by Newton's
    method; one aggregation over the classes a step."""
    ln = math.log(most)
    start = (classes.filter("size > 0").groupBy("key").agg(F.min("size").alias("least"), (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"))
             .join(targets.select("key", "source_size", "target"), "key"))
    highest = ln * F.col("scale") / F.col("least")  # every document at the cap
    lowest = F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))) * F.col("scale") / F.col("least")
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    state = start.select("key", "scale", "target", F.when(full, highest).otherwise(0.0).alias("step"),
                         lowest.alias("low"), highest.alias("high"), full.alias("settled"))
    state = cut_lineage(state, "dual")
    slim = classes.filter("size > 0").groupBy("key", "size").agg(F.sum("n").alias("n"))
    slim = cut_lineage(slim, "dual-classes")
    for _ in range(NEWTON_STEPS):
        if state.filter("not settled").isEmpty():
            break
        x = F.col("size") / F.col("scale")
        rate = F.exp(F.least(F.col("step") * x, F.lit(ln)))
        words = F.col("n") * F.col("size")
        slope = F.when(F.col("step") * x < ln, words * x * rate).otherwise(0.0)
        at = slim.join(state, "key").groupBy("key").agg(F.sum(words * rate).alias("taken"), F.sum(slope).alias("slope"))
        both = state.join(at, "key")
        off = F.col("taken") - F.col("target")
        low = F.when(off < 0, F.greatest("low", "step")).otherwise(F.col("low"))
        high = F.when(off > 0, F.least("high", "step")).otherwise(F.col("high"))
        newton = F.col("step") - off / F.nullif(F.col("slope"), F.lit(0.0))
        settled = (F.abs(off) <= 1e-9 * F.col("target")) | F.col("settled") | (F.col("high") - F.col("low") <= 1e-15)
        both = both.withColumns({"new_low": low, "new_high": high, "newton": newton, "done": settled})
        inside = F.coalesce((F.col("newton") > F.col("new_low")) & (F.col("newton") < F.col("new_high")), F.lit(False))
        state = both.select("key", "scale", "target",
                            F.when(F.col("done"), F.col("step")).when(inside, F.col("newton")).otherwise((F.col("new_low") + F.col("new_high")) / 2).alias("step"),
                            F.col("new_low").alias("low"), F.col("new_high").alias("high"), F.col("done").alias("settled"))
        state = cut_lineage(state, "dual")
    return state.select("key", "scale", "step")


def _round_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of each class of one source (size, slot, n, rate)."""
    rows = rows.sort_values(["size", "slot"], ascending=[False, True], kind="stable")
    sizes, counts, rates = (rows[c].tolist() for c in ("size", "n", "rate"))
    wanted, taken, out = 0.0, 0, []
    for size, n, rate in zip(sizes, counts, rates, strict=True):
        wanted += size * n * rate
        out.append(min(math.ceil(rate) * n, max(math.floor(rate) * n, round((wanted - taken) / size))))
        taken += out[-1] * size
    for k, (size, n, rate) in enumerate(zip(sizes, counts, rates, strict=True)):  # what is left, by documents that can still go the other way
        step = min(math.ceil(rate) * n - out[k], max(math.floor(rate) * n - out[k], int((wanted - taken) / size + (0.5 if wanted > taken else -0.5))))
        out[k] += step
        taken += step * size
    return rows.assign(copies=out)[["key", "size", "slot", "n", "rate", "copies"]]


def mix(df: DataFrame, weights: Sequence[float] = WEIGHTS, total: float = TOTAL, most: int = MOST_COPIES,
        text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", carry: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``carry``) with size, source_size, target, rate
    and copies."""
    carry = list(df.columns if carry is None else carry)
    key, slot, place = (free_name(df, k) for k in ("key", "slot", "place"))
    marked = df.select(*carry, F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias(key), word_count(F.col(text_col)).alias("size"),
                       F.coalesce(F.pmod(F.xxhash64(id_col), F.lit(SLOTS)), F.lit(0)).cast("int").alias(slot),
                       F.col(id_col).alias(place))
    classes = marked.groupBy(F.col(key).alias("key"), "size", F.col(slot).alias("slot")).agg(F.count("*").alias("n"))
    classes = classes.withColumn("source", F.when(F.col("key") != "", F.expr("substring(key, 2)")))
    classes = cut_lineage(classes, "classes")
    targets = cut_lineage(source_targets(classes.select("key", "source", (F.col("n") * F.col("size")).alias("size")), weights, total, most), "targets")
    dual = _multipliers(classes, targets, most)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.round(F.least(F.lit(float(most)), F.exp(F.col("step") * F.col("size") / F.col("scale"))), 9))
    rated = classes.drop("source").join(dual, "key", "left").select("key", "size", "slot", "n", rate.alias("rate"))
    counted = rated.filter("size > 0").groupBy("key").applyInPandas(
        lambda x: _round_source(x), "key string, size long, slot int, n long, rate double, copies long")
    counted = counted.unionAll(rated.filter("size = 0").withColumn("copies", F.col("n")))
    counted = cut_lineage(counted.join(targets.select("key", "source_size", "target"), "key"), "copies")
    counted = counted.select(F.col("key").alias(key), "size", F.col("slot").alias(slot), "n", "rate", F.col("copies").alias("class_copies"), "source_size", "target")
    rank = F.row_number().over(Window.partitionBy(key, "size", slot).orderBy(F.xxhash64(place, F.lit(1)), place))
    joined = marked.join(counted.hint("merge"), [key, "size", slot])
    floor = F.floor("rate")
    copies = floor + F.when(rank <= F.col("class_copies") - floor * F.col("n"), 1).otherwise(0)
    return joined.select(*carry, "size", "source_size", "target", "rate", copies.alias("copies"))


def resample(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them."""
    wrapped = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), "doc_id", "source", "text")
    mixed = mix(wrapped, carry=["row"])
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.filter("copies > 0").select("row", F.explode(times).alias("copy")).select("row.*")
