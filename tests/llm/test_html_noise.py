"""Planted pages: all kinds of noise beside an article, and a plain tree walk."""

from __future__ import annotations

import random

import pytest

from statlake.llm.html_paths import extract, tells

PARAGRAPH = "Rivers rise in the hills, join others on their way, and reach the sea at last. Towns grew where they could be crossed."
NOISE = {
    "menu": '<nav><ul><li><a href="/">Home</a></li></ul></nav>', "header": "<header><a href=/>Site name</a></header>", "footer": "<footer>Imprint</footer>",
    "sidebar": "<aside>Popular now</aside>", "notice": '<div class="cookie-banner">We use cookies.</div>', "advert": '<div class="ad-slot">Buy a boat!</div>',
    "form": "<form>Search <input></form>", "comments": '<div id="comments"><div class="comment-list"><p>Nice one!</p></div></div>',
    "related": '<div class="related-posts"><a href=/1>More rivers</a></div>', "share": '<div class="share-buttons"><a href=/2>Share</a></div>', "foot": '<div class="site-footer">Terms</div>',
}


@pytest.mark.parametrize("wrapper", ["article", "main", "div"])
@pytest.mark.parametrize("kind", NOISE)
def test_each_kind_of_noise_goes(wrapper, kind):
    body = "".join(f"<p>{i}. {PARAGRAPH}</p>" for i in range(4))
    inside, before = (NOISE[kind], "") if kind != "header" else ("", NOISE[kind])  # an article's own header holds its title
    page = f"<html><body>{before}<{wrapper}><h1>Rivers and towns</h1>{body}{inside}</{wrapper}></body></html>"
    want = ["Rivers and towns", *[f"{i}. {PARAGRAPH}" for i in range(4)]]
    got = extract(page).split("\n")
    assert [x for x in got if x not in want] == []
    assert [x for x in want[1:] if x not in got] == [] and (wrapper == "div" or got[0] == want[0])


def test_a_line_break_at_the_front_of_a_block():
    assert extract(f"<nav>Menu</nav><article><p><br>First {PARAGRAPH}</p><p>{PARAGRAPH}</p></article><footer><br>Copyright</footer>") == f"First {PARAGRAPH}\n{PARAGRAPH}"
    assert extract(f"<article><form>Name</form><br>Kept {PARAGRAPH}</article>") == f"Kept {PARAGRAPH}"


def test_the_innermost_article_counts():
    page = f"<main><article><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></article><div><p>Other stories of the day, and more of them. {PARAGRAPH}</p></div></main>"
    assert extract(page) == f"{PARAGRAPH}\n{PARAGRAPH}"


def test_text_of_formulas_stays():
    page = f"<article><p>Let <math><mi>x</mi><annotation encoding='t'>\\x</annotation></math> be a number.</p><p>{PARAGRAPH}</p></article>"
    assert extract(page) == f"Let x be a number.\n{PARAGRAPH}"


@pytest.mark.parametrize("mark,hint", [("comments", True), ("comment-list", True), ("ad-slot", True), ("cookie-banner", True), ("related_posts", True), ("site-footer", True),
                                       ("side-effects", False), ("related-work", False), ("notice-period", False), ("search-algorithms", False), ("with-sidebar", False), ("post-list", False), ("content", False)])
def test_names_that_hint(mark, hint):
    assert tells(mark) == hint


def test_headings_with_ordinary_ids_stay():
    parts = "".join(f'<h2 id="{i}">{t}</h2><p>{PARAGRAPH}</p>' for i, t in (("side-effects", "Effects"), ("related", "Related work"), ("notice", "Notice period"), ("search", "Search")))
    got = extract(f"<article>{parts}</article>").split("\n")
    assert got == [x for t in ("Effects", "Related work", "Notice period", "Search") for x in (t, PARAGRAPH)]


def walk(tree):
    """Plain tree walk: blocks outside elements that never hold the article."""
    name, noise, children = tree
    if noise:
        return []
    if isinstance(children, str):
        return [" ".join(children.split())] if children.strip() else []
    return [t for c in children for t in walk(c)]


def shown(tree):
    name, noise, children = tree
    inside = children if isinstance(children, str) else "".join(map(shown, children))
    return f"<{name}{noise or ''}>{inside}</{name.split()[0]}>"


def random_tree(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        words = " ".join(rng.choice("rivers towns hills sea bridges boats rain".split()) for _ in range(rng.randrange(12, 40)))
        return ("p", None, f"  {words}, \\n {words}. ")
    kids = [random_tree(rng, depth - 1) for _ in range(rng.randrange(2, 5))]
    return (rng.choice(["div", "section", "blockquote"]), None, kids)


@pytest.mark.parametrize("seed", range(200))
def test_random_articles_equal_a_tree_walk(seed):
    rng = random.Random(seed)
    tree = random_tree(rng, 3)
    blocks = [tree] if isinstance(tree[2], str) else list(tree[2])
    for name in rng.sample(["nav", "footer", "aside", "form"], 2):
        blocks.insert(rng.randrange(len(blocks) + 1), (name, " class=x", "Home | About us | Send"))
    whole = ("article", None, blocks)
    assert extract(f"<html><body><header>Site</header>{shown(whole)}<footer>End</footer></body></html>") == "\n".join(walk(whole))
