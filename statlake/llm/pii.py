"""Information-theoretic sanitisation, in DataFrame operations only.

Protected entities are e-mail addresses, IP addresses, payment cards and phone
numbers found by pattern.  How strongly a term reveals an entity is estimated
from co-occurrence in the corpus's lines:

    disclosure(t, e) = (PMI(t; e) - doubt) / IC(e)
    PMI = log N n(t, e) / (n(t) n(e)),   IC = log N / n(e)

with N lines, n(t) of which hold the term, n(e) hold the entity or are at most
``near_lines`` lines away from it, and n(t, e) do both.  PMI / IC is 1 when the
term occurs nowhere but beside the entity.  Few *different* lines behind a pair
(copies of a line count once there) lower its score: doubt is ``doubt`` * (1 /
lines - 1 / ``min_support``), nothing from ``min_support`` on; no pair is left
out.  A term above the threshold is generalised to its kind, above the higher
threshold removed, wherever it occurs.  As n(t) is at least n(t, e), a pair's
score is at most 1 - doubt / IC; pairs that cannot reach the threshold even so
are not counted over the corpus, which ships few rows and changes no result.

Patterns are written with possessive repeats and look-behinds that give the same
matches as the plain ones in linear time and without recursion.

Defined results: null or empty text: no span; repeated rows get equal spans; a
null id is allowed; an empty table gives an empty table; extra columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import free_name, let, words
from statlake.session import cut_lineage

_LOCAL = "[A-Za-z0-9._%+-]"
#: Kinds in output order, with the pattern of each and a cheap test for texts that may have one.
KINDS = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
TERM = "term"
#: Characters that do not belong to a term when they stand at its ends.
EDGES = ".,;:!?\"'()[]{}<>|*#$%&=+/\\-_~^`"
WORD = r"[^\x20\x09-\x0D]++"
_SPAN = "array<struct<start:int,ord:int,stop:int,kind:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Thresholds of the method."""

    generalise_at: float = 0.90
    remove_at: float = 0.97
    #: Different lines from which a pair's score is not lowered.
    min_support: int = 5
    #: Nats of doubt in a single line (the 95% bound), before what min_support lines leave.
    doubt: float = 3.0
    #: Lines before and after an entity's that count as beside it.
    near_lines: int = 1
    #: Tables of at most so many rows and bytes are broadcast, larger ones joined by shuffle.
    broadcast_rows: int = 50_000
    broadcast_bytes: int = 16 << 20


# ---- matches and their places ---------------------------------------------------

def _sums(values: Column, chunk: int = 256) -> Column:
    """Exclusive running sums of an int array, chunk by chunk."""
    def scan(x):
        return F.aggregate(x, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))

    def of_parts(parts):
        bases = scan(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, v: a + v)))
        return let(bases, lambda b: F.flatten(F.transform(parts, lambda p, i: let(F.get(b, i), lambda base: F.transform(
            F.slice(scan(p), F.lit(1), F.size(p)), lambda v: v + base)))))

    def of_values(x):
        cuts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / chunk).cast("int"))
        parts = F.transform(cuts, lambda c: F.slice(x, c * chunk + 1, F.lit(chunk)))
        return F.when(F.size(x) > 0, let(parts, of_parts)).otherwise(F.array().cast("array<int>"))

    return let(values, of_values)


def _located(text: Column, pattern: str) -> Column:
    """Matches with their places: array of (start, value), starts in code points."""
    def placed(found):
        def after(gaps):
            steps = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(gaps, i)))
            return F.zip_with(_sums(steps), F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(F.length(g).alias("gap"), m.alias("value"))),
                              lambda s, x: F.struct((s + x["gap"]).alias("start"), x["value"].alias("value")))
        return let(F.split(text, pattern, -1), after)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _luhn(value: Column) -> Column:
    digits = F.filter(F.split(F.reverse(F.translate(value, " -", "")), ""), lambda c: c != "")

    def worth(c, i):
        v = c.cast("int") * (1 + i % 2)
        return F.when(v > 9, v - 9).otherwise(v)
    return F.aggregate(F.transform(digits, worth), F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        def small(part):
            short = F.ltrim(part, F.lit("0"))
            return (F.length(short) < 4) & (F.when(F.length(short) < 4, F.coalesce(F.nullif(short, F.lit("")), F.lit("0")).cast("int")).otherwise(256) <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        count = F.length(F.translate(value, " -", ""))
        return count.between(12, 19) & F.when(count.between(12, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(value, "+ ().-", "")).between(9, 15)
    return F.lit(True)


def _may_have(text: Column, hint: str) -> Column:
    return F.contains(text, F.lit(hint)) if hint == "@" else F.rlike(text, F.lit(hint))


def base_spans(text: Column) -> Column:
    """All valid matches of the four kinds, by start and kind."""
    def found(order, kind, pattern):
        def span(m):
            return F.struct(m["start"].alias("start"), F.lit(order).alias("ord"), (m["start"] + F.length(m["value"])).alias("stop"), F.lit(kind).alias("kind"))
        return F.transform(F.filter(_located(text, pattern), lambda m: _valid(kind, m["value"])), span)

    none = F.array().cast(_SPAN)
    each = [F.when(_may_have(text, hint), found(order, kind, pattern)).otherwise(none).cast(_SPAN)
            for order, (kind, (pattern, hint)) in enumerate(KINDS.items())]
    return F.sort_array(F.concat(*each))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


# ---- disclosure -----------------------------------------------------------------

def term_of(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(EDGES)))


def _terms(text: Column) -> Column:
    return F.filter(F.array_distinct(F.transform(words(text), term_of)), lambda t: t != "")


def disclosing_terms(texts: DataFrame, limits: Disclosure = Disclosure(), text_col: str = "text") -> DataFrame:
    """``(term, disclosure)`` of the terms above the lower threshold.

    ``texts`` needs one text column."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    any_hint = reduce(or_, [_may_have(text, hint) for _, hint in KINDS.values()])

    def entities(line):
        def of_kind(kind, pattern):
            values = F.filter(F.regexp_extract_all(line, F.lit(pattern), F.lit(0)), lambda v: _valid(kind, v))
            return F.transform(values, lambda v: F.xxhash64(F.lit(kind), F.lower(v)))
        return F.array_distinct(F.concat(*[of_kind(kind, pattern) for kind, (pattern, _) in KINDS.items()]))

    def beside_entities(line, i):
        first = F.greatest(i - limits.near_lines, F.lit(0))
        near = F.array_distinct(F.flatten(F.slice("own", first + 1, i + limits.near_lines + 1 - first)))
        return F.struct(line.alias("line"), near.alias("entities"))

    blank = reduce(lambda line, pattern: F.regexp_replace(line, pattern, " "), [p for p, _ in KINDS.values()], F.col("at.line"))
    marked = (texts.filter(any_hint).select(F.split(text, "\n").alias("lines")).withColumn("own", F.transform("lines", entities))
              .filter(F.exists("own", lambda e: F.size(e) > 0))
              .select(F.explode(F.filter(F.transform("lines", beside_entities), lambda x: F.size(x["entities"]) > 0)).alias("at"))
              .select(F.xxhash64("at.line").alias("copy"), F.col("at.entities").alias("entities"), _terms(blank).alias("terms"))
              .select("copy", F.explode("entities").alias("entity"), "terms"))
    marked = cut_lineage(marked, "entity-lines")
    total = texts.select(F.coalesce(F.sum(F.length(text) - F.length(F.translate(text, "\n", "")) + 1), F.lit(0))).first()[0]
    content = F.log(F.lit(float(max(1, total))) / F.col("n_e"))
    doubt = limits.doubt * F.greatest(1 / F.col("support") - 1 / limits.min_support, F.lit(0.0))
    n_entity = marked.groupBy("entity").agg(F.count("*").alias("n_e")).filter(F.col("n_e") < total)
    beside = (marked.select("entity", "copy", F.explode("terms").alias("term")).groupBy("entity", "term", "copy").count()
              .groupBy("entity", "term").agg(F.sum("count").alias("n_et"), F.count("*").alias("support")))
    candidates = beside.join(n_entity, "entity").filter(1 - doubt / content >= limits.generalise_at)  # the most they can reach
    candidates = cut_lineage(candidates, "candidates")
    wanted = _small(candidates.select("term").distinct(), limits)
    line = F.explode(F.split(text, "\n")).alias("line")
    n_term = (texts.select(line).select(F.explode(_terms(F.col("line"))).alias("term")).join(wanted, "term")
              .groupBy("term").agg(F.count("*").alias("n_t")))
    informed = F.log(F.lit(float(max(1, total))) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    return (candidates.join(n_term, "term").groupBy("term").agg(F.max((informed - doubt) / content).alias("disclosure"))
            .filter(F.col("disclosure") >= limits.generalise_at))


def _small(df: DataFrame, limits: Disclosure) -> DataFrame:
    """``df``, written; broadcast if its rows and bytes, counted, are within the
    bounds."""
    df = cut_lineage(df, "small")
    width = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0))
    rows, size = df.limit(limits.broadcast_rows + 1).agg(F.count("*"), width).first()
    return F.broadcast(df) if rows <= limits.broadcast_rows and size <= limits.broadcast_bytes else df


def find_spans(df: DataFrame, limits: Disclosure = Disclosure(), text_col: str = "text", id_col: str = "doc_id",
               out_col: str = "spans", base_col: str = "base_spans") -> DataFrame:
    """``df`` with its base spans and all spans (kind ``term`` for those the
    method adds; a term inside a base span is not repeated)."""
    terms = cut_lineage(disclosing_terms(df.select(text_col), limits, text_col), "terms")
    key, mine = free_name(df, "row_key"), free_name(df, "row_terms")
    text = F.coalesce(F.col(text_col), F.lit(""))
    hit = (df.select(F.col(id_col).alias(key), F.explode(_terms(text)).alias("term")).join(_small(terms, limits), "term")
           .groupBy(key).agg(F.collect_set(F.struct("term", "disclosure")).alias(mine)))  # at most a text's own terms
    hit = _small(hit, limits)
    joined = df.join(hit, df[id_col].eqNullSafe(hit[key]), "left").drop(key)
    base = joined.withColumn(base_col, base_spans(text))

    def of_term(m):
        core = F.btrim(m["value"], F.lit(EDGES))
        at = m["start"] + F.length(m["value"]) - F.length(F.ltrim(m["value"], F.lit(EDGES)))
        known = F.get(F.filter(F.col(mine), lambda t: t["term"] == F.lower(core)), F.lit(0))
        kind = F.when(known["disclosure"] >= limits.remove_at, F.lit(TERM)).otherwise(F.lit(TERM + "_general"))
        return F.struct(at.alias("start"), F.lit(len(KINDS)).alias("ord"), (at + F.length(core)).alias("stop"),
                        F.when(known.isNotNull(), kind).alias("kind"))

    found = F.filter(F.transform(_located(text, WORD), of_term), lambda s: s["kind"].isNotNull())
    free = let(F.col(base_col), lambda taken: F.filter(found, lambda s: ~F.exists(taken, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))))
    extra = F.when(F.col(mine).isNotNull(), free).otherwise(F.array().cast(_SPAN)).cast(_SPAN)
    return base.withColumn(out_col, F.sort_array(F.concat(F.col(base_col), extra))).drop(mine)


def sanitised(text: Column, spans: Column) -> Column:
    """The text with base spans and general terms replaced by their kind and
    disclosing terms removed; overlapping spans count as the first of them."""
    merged = F.aggregate(spans, F.array().cast(_SPAN), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["stop"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.element_at(acc, -1)["ord"].alias("ord"),
            F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop"), F.element_at(acc, -1)["kind"].alias("kind")))))
        .otherwise(F.concat(acc, F.array(s))))

    def piece(m):
        shown = F.when(m["kind"] == TERM, F.lit("")).when(m["kind"] == TERM + "_general", F.lit("[TERM]")).otherwise(
            F.concat(F.lit("["), F.upper(m["kind"]), F.lit("]")))
        return shown

    def rebuilt(regions):
        pieces = F.transform(regions, lambda m, i: F.concat(
            F.substring(text, F.when(i > 0, F.get(regions, i - 1)["stop"]).otherwise(0) + 1,
                        m["start"] - F.when(i > 0, F.get(regions, i - 1)["stop"]).otherwise(0)), piece(m)))
        last = F.element_at(regions, -1)["stop"]
        return F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))

    return F.when(F.size(spans) > 0, let(merged, rebuilt)).otherwise(text)


def sanitise(df: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """``df`` with texts sanitised (``n_chars`` follows, where it is a column);
    the columns of ``df``."""
    spans, base = free_name(df, "spans"), free_name(df, "base_spans")
    found = find_spans(df, limits, out_col=spans, base_col=base)
    clean = found.withColumn("text", F.when(F.col("text").isNotNull(), sanitised(F.col("text"), F.col(spans))))
    if "n_chars" in df.columns:
        length = F.length("text").cast(df.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return clean.select(*df.columns)
