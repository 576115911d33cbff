"""Quality rules with adaptive thresholds, in DataFrame operations only.

Ratios of each document (symbols to word characters, repeated lines to lines,
words in repeated windows to words, words to word characters) are sketched per
language and source: counts on a grid of ``GRID`` steps over [0, 1].  Such a
sketch is bounded, merges by adding counts, does not depend on the order of
merging, and gives every quantile within 1 / ``GRID``.  A group's thresholds are
its quartiles widened by a multiple of their distance (at least a slack); groups
with few documents use the merged sketch of their language, then of everything.
Documents are then filtered by joining the thresholds.

Defined results: null or empty text: no words, so ``base_failed``; null language
or source: a group of its own; repeated rows count as often as they occur; an
empty table gives an empty table; extra columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import free_name, let, words
from statlake.session import cut_lineage

GRID = 1000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
#: Ratio: (numerator, denominator).
RATIOS = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
          "repeats": ("n_repeat_words", "n_words"), "density": ("n_words", "word_chars")}


@dataclass(frozen=True)
class Rules:
    #: Fence beyond the quartiles, in distances between them.
    reach: float = 3.0
    #: Least fence of each ratio.
    slack: dict[str, float] = field(default_factory=lambda: {"symbols": 0.2, "dup_lines": 0.3, "repeats": 0.2, "density": 0.15})
    #: Ratios that are also judged from below.
    two_sided: tuple[str, ...] = ("density",)
    #: Documents a group needs for thresholds of its own.
    min_group: int = 100
    min_words: int = 10
    most_repeats: int = 20


def _repeat_words(found: Column, size: int = 5) -> Column:
    """Words in windows of ``size`` that occur at least twice in the text."""
    def of_windows(g):
        ranked = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def equal(s):
            return F.sort_array(F.filter(F.transform(s, lambda e, k: F.when(
                (F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"]), e["i"])), lambda i: i.isNotNull()))

        def covered(p):
            return F.aggregate(F.transform(p, lambda at, k: F.coalesce(F.least(F.get(p, k + 1) - at, F.lit(size)), F.lit(size))), F.lit(0), lambda a, v: a + v)
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(let(ranked, equal), covered))

    def of_hashes(h):
        at = F.sequence(F.lit(0), F.size(h) - size)
        return F.when(F.size(h) >= size, let(F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])), of_windows)).otherwise(F.lit(0))

    return let(F.transform(found, lambda w: F.xxhash64(w)), of_hashes)


def measure(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` without its text, with the counts of each."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = free_name(df, "found")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    n_lines = let(lines, lambda x: F.array(F.size(x), F.size(x) - F.size(F.array_distinct(x))))
    bare = F.length(F.translate(text, SPACES, ""))
    counted = df.withColumns({found: words(F.col(text_col)), "lines_": n_lines, "word_chars": bare.cast("long"),
                              "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")})
    return counted.withColumns({"n_words": F.size(found).cast("long"), "n_lines": F.get("lines_", F.lit(0)).cast("long"),
                                "n_dup_lines": F.get("lines_", F.lit(1)).cast("long"),
                                "n_repeat_words": _repeat_words(F.col(found)).cast("long")}).drop(found, "lines_", text_col)


def _grid(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.floor(F.col(top) * GRID / F.col(bottom)).cast("long")).otherwise(F.lit(0).cast("long"))


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """``(*groups, ratio, cell, n)``: the mergeable sketch of each ratio."""
    cells = F.array(*[F.struct(F.lit(k).alias("ratio"), _grid(k).alias("cell")) for k in RATIOS])
    return (measured.select(*groups, F.explode(cells).alias("at")).groupBy(*groups, F.col("at.ratio").alias("ratio"), F.col("at.cell").alias("cell"))
            .agg(F.count("*").alias("n")))


def fences(sketch: DataFrame, groups: list[str], rules: Rules) -> DataFrame:
    """``(*groups, n, {ratio}_low, {ratio}_high)`` from sketches, in grid cells."""
    part = Window.partitionBy(*groups, "ratio")
    upto = part.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumns({"below": F.sum("n").over(upto), "all": F.sum("n").over(part)})
    quartile = [F.min(F.when(F.col("below") * 4 >= F.col("all") * k, F.col("cell"))).alias(f"q{k}") for k in (1, 3)]
    by = ranked.groupBy(*groups, "ratio").agg(*quartile, F.max("all").alias("n"))
    slack = F.create_map(*[F.lit(x) for k, v in rules.slack.items() for x in (k, int(v * GRID))])
    wide = F.greatest((F.col("q3") - F.col("q1")) * rules.reach, slack[F.col("ratio")])
    by = by.withColumns({"low": F.col("q1") - wide, "high": F.col("q3") + wide})
    of = [F.max(F.when(F.col("ratio") == k, F.col(side))).alias(f"{k}_{side}") for k in RATIOS for side in ("low", "high")]
    return by.groupBy(*groups).agg(F.max("n").alias("n"), *of)


def judge(df: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``df`` without its text, with its counts, ``base_failed`` and ``kept``."""
    measured = cut_lineage(measure(df, text_col), "measured")
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in (lang_col, source_col))
    keyed = measured.withColumns({"lang_key": lang, "source_key": source})
    fine = cut_lineage(sketches(keyed, ["lang_key", "source_key"]), "sketches")
    coarse = fine.groupBy("lang_key", "ratio", "cell").agg(F.sum("n").alias("n"))  # sketches merge by addition
    whole = coarse.groupBy("ratio", "cell").agg(F.sum("n").alias("n"))
    names = [f"{k}_{side}" for k in RATIOS for side in ("low", "high")]
    a = fences(fine, ["lang_key", "source_key"], rules)
    b = fences(coarse, ["lang_key"], rules).select("lang_key", F.col("n").alias("n_b"), *[F.col(x).alias(f"b_{x}") for x in names])
    c = fences(whole, [], rules).first()  # one row of numbers
    levels = a.join(b, "lang_key")
    chosen = [F.when(F.col("n") >= rules.min_group, F.col(x)).when(F.col("n_b") >= rules.min_group, F.col(f"b_{x}")).otherwise(F.lit(c[x])).alias(x) for x in names]
    limits = cut_lineage(levels.select("lang_key", "source_key", *chosen), "limits")
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.most_repeats * F.col("n_words"))
    good = [_grid(k) <= F.col(f"{k}_high") for k in RATIOS] + [_grid(k) >= F.col(f"{k}_low") for k in rules.two_sided]
    joined = keyed.join(limits, ["lang_key", "source_key"])
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & reduce(and_, good)).drop("lang_key", "source_key", *names)
