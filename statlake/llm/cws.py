"""Document fingerprints by consistent weighted sampling, in DataFrame
operations only.

A text is the weighted set of its words (weight: how often).  For each of
``samples`` draws, every term gets r and c from Gamma(2, 1) and beta from
U(0, 1), all from hashes of the term and the draw, and with its weight w

    t = floor(ln w / r + beta),   ln a = ln c - r (t - beta + 1);

the term with the least a, with its t, is the draw's sample.  Two texts have the
same sample with probability equal to their generalised Jaccard similarity.  A
fingerprint holds 16 bits of each sample.

The draws are minima, so they are aggregated from exploded (term, draw) rows
inside the task that holds the document: texts are dealt out once, by ranges of
the id (for the neighbour's text that an edited text needs), and everything up to
the fingerprints stays in that layout.

Defined results: null or empty text, or text without a word: a fingerprint of
its own value (all ``ffff``); equal texts have equal fingerprints; rows with
equal ids are ordered by text; rows without an id come last; the only row of a
table is its own next document; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import hex_digest, words
from statlake.session import cut_lineage

#: Draws of a fingerprint.
SAMPLES = 32
#: Draws whose minima are kept side by side in one aggregation row.
WIDTH = 4
#: Rows that a range of ids should hold, and the most ranges (their bounds are a literal).
RANGE_ROWS, MOST_RANGES = 2000, 1 << 16


def _bits(value: Column, shift: int, width: int) -> Column:
    """A number in (0, 1) from ``width`` bits of a hash."""
    part = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part.cast("double") + 0.5) / float(1 << width)


def _draw(term: Column, draw: Column, log_weights: list[Column]) -> list[Column]:
    """For each weight the draw's value of the term: ln a in the upper 47 bits,
    16 bits of the sample below (null weight: null)."""
    first = F.xxhash64(term, draw)
    second = F.xxhash64(first)
    r = -F.log(_bits(first, 0, 21) * _bits(first, 21, 21))
    beta = _bits(first, 42, 22)
    log_c = F.log(-F.log(_bits(second, 0, 32) * _bits(second, 32, 32)))
    out = []
    for weight in log_weights:
        t = F.floor(weight / r + beta)
        log_a = log_c - r * (t - beta + 1)
        place = F.floor((F.greatest(F.least(log_a, F.lit(8190.0)), F.lit(-8190.0)) + 8192) * float(1 << 33))
        sample = first.bitwiseXOR(t * 40503).bitwiseAND(F.lit(0xFFFF))
        out.append(F.shiftleft(place, 16).bitwiseOR(sample))
    return out


def signatures(rows: DataFrame, keys: list[str], sides: int, samples: int = SAMPLES) -> DataFrame:
    """``(*keys, sig_0, .. )`` from ``(*keys, side, word)`` rows: for each side
    an array of ``samples`` 16-bit samples (null if it has no word)."""
    weights = [F.sum(F.when(F.col("side") == s, 1).otherwise(0)).alias(f"w{s}") for s in range(sides)]
    terms = rows.select(*keys, "side", F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(*weights)
    logs = [F.when(F.col(f"w{s}") > 0, F.log(f"w{s}")).alias(f"w{s}") for s in range(sides)]
    parts = terms.select(*keys, "term", *logs, F.explode(F.array(*map(F.lit, range(samples // WIDTH)))).alias("part"))
    least = []
    for k in range(WIDTH):
        values = _draw(F.col("term"), F.col("part") * WIDTH + k, [F.col(f"w{s}") for s in range(sides)])
        least += [F.min(v).alias(f"m{s}_{k}") for s, v in enumerate(values)]
    minima = parts.groupBy(*keys, "part").agg(*least)

    def side(s):
        packed = F.array(*[F.col(f"m{s}_{k}").bitwiseAND(F.lit(0xFFFF)).cast("int") for k in range(WIDTH)])
        ordered = F.array_sort(F.collect_list(F.when(F.col(f"m{s}_0").isNotNull(), F.struct("part", packed.alias("sig")))))
        flat = F.flatten(F.transform(ordered, lambda x: x["sig"]))
        return F.when(F.size(flat) > 0, flat).alias(f"sig_{s}")

    return minima.groupBy(*keys).agg(*[side(s) for s in range(sides)])


def fingerprint(sig: Column, samples: int = SAMPLES) -> Column:
    """Hex digits of the samples, four each."""
    digits = F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")), "")
    return F.coalesce(digits, F.lit("ffff" * samples))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples (both without words: 1, one of them: 0)."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / float(samples)
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(same)


def _range_of(df: DataFrame, id_col: str) -> Column:
    """Number of the id's range; bounds come from a sample of ids whose size is
    bounded and only decide where rows go."""
    n = df.count()
    ranges = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    if ranges == 1:
        return F.lit(0)
    part = min(1.0, 20 * ranges / n)
    ids = sorted(r[0] for r in df.select(id_col).filter(F.col(id_col).isNotNull())
                 .filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int(part * (1 << 30))).collect())
    bounds = sorted({ids[len(ids) * k // ranges] for k in range(1, ranges)}) if ids else []
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    value = F.col(id_col)
    coarse = F.size(F.filter(F.array(*map(F.lit, bounds[step - 1::step])), lambda b: b <= value))
    fine = F.size(F.filter(F.slice(F.array(*map(F.lit, bounds)), coarse * step + 1, F.lit(step)), lambda b: b <= value))
    return F.when(value.isNull(), F.lit(-1)).otherwise((coarse * step + fine).cast("int"))


def with_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(span, row, id, text, n_chars, edited, next_span, next_row)``: rows in
    falling order of ids, each with the text whose last third is replaced by the
    beginning of the next row's text (after the last: the first)."""
    rows = df.select(_range_of(df, id_col).alias("span"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = Window.partitionBy("span").orderBy(F.col("id").desc_nulls_last(), "text")
    ahead = rows.withColumns({"row": F.row_number().over(order), "after": F.lead("text").over(order)})
    tops = cut_lineage(ahead.filter("row = 1").select("span", F.col("text").alias("top")), "tops")  # a row for each range
    down = Window.orderBy(F.col("span").desc())
    first = F.first(F.struct("span", "top")).over(Window.orderBy(F.col("span").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follows = F.coalesce(F.lead(F.struct("span", "top")).over(down), first)
    tops = cut_lineage(tops.select("span", follows["span"].alias("top_span"), follows["top"].alias("top")), "follows")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    joined = ahead.join(tops, "span")
    then = F.coalesce("after", "top")
    return joined.select("span", "row", "id", "text", n.cast("long").alias("n_chars"),
                         F.concat(F.substring("text", F.lit(1), n - third), F.substring(then, F.lit(1), third)).alias("edited"),
                         F.when(F.col("after").isNull(), F.col("top_span")).otherwise(F.col("span")).alias("next_span"),
                         F.when(F.col("after").isNull(), F.lit(1)).otherwise(F.col("row") + 1).alias("next_row"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """A row for each of ``df``: id, n_chars, edited_sha256, fingerprints of the
    text and of the edited text, and the likeness to it and to the next row."""
    rows = with_edited(df, id_col, text_col)
    both = F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))
    found = (rows.select("span", "row", F.explode(both).alias("x")).select("span", "row", "x.side", F.explode(words(F.col("x.text"))).alias("word")))
    sigs = signatures(found, ["span", "row"], 2, samples)
    slim = rows.select("span", "row", "id", "n_chars", hex_digest(F.col("edited")).alias("edited_sha256"), "next_span", "next_row")
    own = cut_lineage(slim.join(sigs, ["span", "row"], "left"), "signatures")
    after = own.select(F.col("span").alias("next_span"), F.col("row").alias("next_row"), F.col("sig_0").alias("sig_next"))
    joined = own.join(after, ["next_span", "next_row"])
    return joined.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", fingerprint(F.col("sig_0"), samples).alias("fingerprint"),
                         fingerprint(F.col("sig_1"), samples).alias("edited_fingerprint"),
                         likeness(F.col("sig_0"), F.col("sig_1"), samples).alias("near_edited"),
                         likeness(F.col("sig_0"), F.col("sig_next"), samples).alias("near_next"))
