"""Main-text extraction by tag-path ratios.

A page's text nodes are grouped by their root-to-leaf tag path.  Each path sums
the text length and the punctuation of its nodes and their number; the text
ratio (characters a node) and the punctuation ratio are smoothed along the page,
so that a short block between long ones is lifted, fused by multiplication, and
paths whose fused score falls too far below the best one are dropped.  Paths
through elements that never hold the article (navigation, footers, forms,
scripts, ...) are out from the start, and if the page marks its article (by
``article`` elements, else ``main``), paths outside it are too.

Inside a marked article the score decides as well, relative to the article's own
paths, with the logarithm of the text ratio and a lower threshold: short blocks
(headings, cells, items) stay, long runs of bare links go.  A class, role or id that
tells of an advert, a notice, comments, ... sets its element apart as paths of
their own; they stay only if one of them scores at least as well as the best path
outside the element.

The tokenizer is forgiving: a new paragraph, list item or table cell closes the
open one with what hangs in it; unknown end tags are ignored; open tags end with
the page.

Defined results: null or empty html, and pages without content, give "";
repeated rows repeat; extra columns stay.
"""

from __future__ import annotations

import html
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import arrow_rows
from statlake.llm.worker import held, in_slices

#: Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object canvas annotation annotation-xml".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
NEVER = frozenset("head nav footer aside form script style noscript template textarea title iframe svg object canvas button select menu dialog annotation annotation-xml".split())
#: An open element of the key is closed by a start tag of the value.
CLOSED_BY = {"p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "tr": frozenset(["tr"]), "option": frozenset(["option"])}
#: Where the search for an element to close ends.
SCOPE = frozenset("article aside body div footer form header main nav ol section table td th ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that mark the article; the innermost kind on a page counts.
ARTICLE = {"main": 1, "article": 2}
#: Words that hint, as a class, a role or an element's id, at what is not the article (fixed values).
NOISE = regex.compile(r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|alert|popup|modal|menu|nav|navbar|navigation|"
                      r"breadcrumbs?|sidebar|side|footer|masthead|comment\w*|respond|disqus|share|sharing|social|related|recommend\w*|"
                      r"newsletter|subscribe|signup|login|search|pagination|pager|widget|toolbar|copyright|legal", regex.I)
#: Words that may stand beside a hint in a hyphened name (``ad-slot``, ``related-posts``); with any other
#: word (``side-effects``, ``with-sidebar``) the name is no hint (fixed values).
BESIDE = frozenset(("area bar block bottom box button buttons container content feed form group header inner item items left link links list main outer panel post posts "
                    "right section site slot stories story thread title top unit wrap wrapper zone page").split())
#: The same, but only outside the article (inside it a header holds its title).
OUTER_NOISE = regex.compile(r"header|top", regex.I)
TOKEN = regex.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
                      r"(?P<more>(?:[^>\"']|\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$))*+)(?:>|$)", regex.S)
ATTRIBUTE = regex.compile(r"""(?<![^\s"'/])(class|role|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", regex.I)
#: Elements whose id names their own text, such as a heading's.
OWN_TEXT = HEADINGS | {"p", "li", "a", "span", "td", "th", "dt", "dd"}
HYPHEN = regex.compile(r"[-_]")
SPACE = regex.compile(r"\s+")
PUNCTUATION = regex.compile(r"[.,;:!?…。，、；：！？]")


@dataclass
class Node:
    """A text block: its tag path, its text, the characters of it that are no
    link, whether it may be content, and the innermost element with a hint around
    it (0: none)."""

    path: str
    text: str
    plain: int
    allowed: bool
    in_article: int
    hint: int


class State(NamedTuple):
    """An open element, with what holds inside it."""

    name: str = ""
    allowed: bool = True
    in_article: int = 0
    hint: int = 0
    linked: bool = False


def tells(mark: str) -> bool:
    """Whether a class, role or id hints at what is not the article: a word of
    ``NOISE``, alone or hyphened with such words and those of ``BESIDE`` only."""
    if NOISE.fullmatch(mark):
        return True
    parts = [x for x in HYPHEN.split(mark.lower()) if x]
    return len(parts) > 1 and all(x in BESIDE or NOISE.fullmatch(x) for x in parts) and any(x not in BESIDE and NOISE.fullmatch(x) for x in parts)


def text_nodes(page: str, parents: list[int]) -> Iterator[Node]:
    """The page's blocks of text in order; inline elements do not cut a block.
    ``parents`` gets, for each element with a hint (from 1 on, in page order),
    the one around it."""
    stack: list[State] = []
    pieces: list[str] = []
    linked = 0
    where: tuple[str, State] = ("", State())
    parents[:] = [0]

    def state() -> tuple[str, State]:
        return "/".join(e.name for e in stack if e.name in BLOCK), stack[-1] if stack else State()

    def flush() -> Iterator[Node]:
        nonlocal pieces, linked
        text = SPACE.sub(" ", "".join(pieces)).strip()
        plain = max(0, len(text) - linked)
        pieces, linked = [], 0
        if text:
            yield Node(where[0], text, plain, where[1].allowed, where[1].in_article, where[1].hint)

    def take(part: str) -> None:
        nonlocal where, linked
        if not pieces:
            where = state()
        text = html.unescape(part)
        pieces.append(text)
        if stack and stack[-1].linked:
            linked += len(SPACE.sub(" ", text))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue  # inside raw text
        if m.start() > at:
            take(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name), None)
            if depth is not None:
                left = stack[depth - 1] if depth else State()
                if any(e.name in BLOCK for e in stack[depth:]) or (stack[-1].allowed, stack[-1].hint) != (left.allowed, left.hint):
                    yield from flush()
                del stack[depth:]
            continue
        if name == "br":
            take(" ")
            continue
        if name in BLOCK:
            yield from flush()
            for k in range(len(stack) - 1, -1, -1):
                if name in CLOSED_BY.get(stack[k].name, ()):
                    del stack[k:]
                    break
                if stack[k].name in SCOPE:
                    break
        if name in RAW:
            closing = regex.compile(rf"</{regex.escape(name)}\b[^>]*>?", regex.I).search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if name in VOID:
            continue
        top = stack[-1] if stack else State()
        marks = [x for v in ATTRIBUTE.finditer(m["more"] or "") if name not in OWN_TEXT or v[1].lower() != "id" for x in (v[2] or v[3] or v[4] or "").split()]
        article = ARTICLE.get(name, 0)
        keep = top.allowed and name not in NEVER and (top.in_article or name != "header")
        hint = top.hint
        if keep and not article and name not in ("html", "body") and any(tells(x) or not top.in_article and OUTER_NOISE.fullmatch(x) for x in marks):
            hint = len(parents)
            parents.append(top.hint)
        if (keep, hint) != (top.allowed, top.hint):
            yield from flush()
        linked_here = top.linked or name == "a" and not any(e.name in HEADINGS for e in stack)
        stack.append(State(name, keep, max(top.in_article, article), hint, linked_here))
    if at < len(page):
        take(page[at:])
    yield from flush()


def smooth(values: list[float], radius: int = 6, width: float = 2.0) -> list[float]:
    """Gaussian-weighted means over the neighbours in page order."""
    kernel = [math.exp(-k * k / (2 * width * width)) for k in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        near = [(kernel[k + radius], values[i + k]) for k in range(-radius, radius + 1) if 0 <= i + k < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def path_scores(nodes: list[Node], marked: bool) -> list[float]:
    """The fused score of each node's path; parts with a hint are scored apart."""
    length, plain, marks, count, zones = {}, {}, {}, {}, {}
    for i, n in enumerate(nodes):
        key = n.hint, n.path
        length[key] = length.get(key, 0) + len(n.text)
        plain[key] = plain.get(key, 0) + n.plain
        marks[key] = marks.get(key, 0) + len(PUNCTUATION.findall(n.text))
        count[key] = count.get(key, 0) + 1
        zones.setdefault(n.hint, []).append(i)
    fused = dict.fromkeys(count, 0.0)
    for hint, inside in zones.items():
        keys = [(hint, nodes[i].path) for i in inside]
        text_ratio = smooth([math.log1p(plain[k] / count[k]) if marked else length[k] / count[k] for k in keys])
        mark_ratio = smooth([((count[k] if marked else 1) + marks[k]) / count[k] for k in keys])
        for k, a, b in zip(keys, text_ratio, mark_ratio, strict=True):
            fused[k] += a * b / count[k]
    for k, n in count.items():
        fused[k] *= (plain[k] + n) / (length[k] + n)
    return [fused[n.hint, n.path] for n in nodes]


def refuted_hints(nodes: list[Node], scores: list[float], parents: list[int]) -> list[bool]:
    """For each element with a hint whether it and all such around it hold a path
    that scores at least as well as the best one outside it."""
    first, last, best = [len(nodes)] * len(parents), [-1] * len(parents), [0.0] * len(parents)
    for i, n in enumerate(nodes):
        first[n.hint], last[n.hint], best[n.hint] = min(first[n.hint], i), i, max(best[n.hint], scores[i])
    for h in range(len(parents) - 1, 0, -1):  # an element's number is above that of the one around it
        p = parents[h]
        first[p], last[p], best[p] = min(first[p], first[h]), max(last[p], last[h]), max(best[p], best[h])
    before, after = list(accumulate(scores, max, initial=0.0)), list(accumulate(reversed(scores), max, initial=0.0))[::-1]
    out = [True] * len(parents)
    for h in range(1, len(parents)):
        out[h] = out[parents[h]] and last[h] >= 0 and best[h] >= max(before[first[h]], after[last[h] + 1])
    return out


def extract(page: str | None, least: float = 0.02, least_marked: float = 0.001) -> str:
    """The blocks of the content paths, one a line."""
    parents: list[int] = []
    nodes = [n for n in text_nodes(page or "", parents) if n.allowed]
    marked = max((n.in_article for n in nodes), default=0)
    nodes = [n for n in nodes if n.in_article == marked]
    if not nodes:
        return ""
    scores = path_scores(nodes, marked > 0)
    believed = refuted_hints(nodes, scores, parents)
    floor = (least_marked if marked else least) * max(s for n, s in zip(nodes, scores, strict=True) if believed[n.hint])
    return "\n".join(n.text for n, s in zip(nodes, scores, strict=True) if believed[n.hint] and s >= floor)


def extract_main_text(df: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``df`` with the main text of each page."""
    arrow_rows(df)

    @F.arrow_udf("string")
    def main_text(pages: pa.Array) -> pa.Array:
        held(None)
        return in_slices(pages, lambda part: pa.array([extract(p) for p in part], pa.string()))

    return df.withColumn(out_col, main_text(F.col(html_col)))
