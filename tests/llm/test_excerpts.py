"""Excerpts of long benchmark items."""

import random

from daymatrix.llm import decontam


def text(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_excerpts_at_all_offsets():
    item = text(1, 70)
    index = decontam.Index([(1, item)])
    shortest = decontam.EXCERPT + decontam.EXCERPT_STRIDE - 1
    before, after = text(2, 40), text(3, 40)
    for start in range(len(item) - shortest):
        excerpt = item[start : start + shortest].strip()
        if len(excerpt) == shortest:
            assert [x[0] for x in index.find(f"{before} {excerpt} {after}")] == [1], start
    assert index.find(f"{before} {item[:30]} {after}") == []


def test_whole_segments_within_the_budget_are_still_found():
    item = text(4, 70)
    r = random.Random(4)
    edited = list(item)
    for i in r.sample(range(len(item)), len(item) // 12):
        edited[i] = "z"
    assert {x[0] for x in decontam.Index([(1, item)]).find("".join(edited))} == {1}
