"""Anchors and word hashes of the substring operator."""

import numpy as np

from statlake.llm import substr, worker


def test_last_least_is_the_last_of_the_least():
    values = np.random.default_rng(5).integers(0, 6, 400).astype(np.uint64)
    for size in (1, 2, 3, 9, 16, 401):
        got = substr.last_least(values, size).tolist()
        assert got == [max(range(i, i + size), key=lambda k: (-int(values[k]), k)) for i in range(len(values) - size + 1)]


def test_word_hashes_keep_nothing():
    worker.held("another tool", list)
    words = [b"a", b"b", b"a", "wörd".encode()]
    got = substr.word_hashes(words).tolist()
    assert got[0] == got[2] and len(set(got)) == 3
    assert not worker._HELD


def test_anchors_of_a_passage_do_not_depend_on_its_place():
    passage = " ".join(f"w{i * 7 % 31}" for i in range(40))
    grid = substr.Grid([passage, "x y z " + passage, None, "too short"], 13, 5)
    first, second = (grid.anchor[grid.row[grid.window] == r] - grid.starts[r] for r in (0, 1))
    assert (first + 3).tolist() == second[3:].tolist()
