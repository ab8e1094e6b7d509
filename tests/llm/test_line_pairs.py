"""Pairs of line sets compared at once give what they give one by one."""

import numpy as np

from linkloom.llm import line_dedup as D
from linkloom.llm.nodes import pair_alike


def test_distinct_and_pairs():
    rng = np.random.default_rng(3)
    lists = [rng.integers(0, 9, rng.integers(0, 30)).astype(np.uint64) for _ in range(300)]
    lists += [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
    flat, sizes = D._distinct(np.concatenate(lists), np.r_[0, np.cumsum([len(x) for x in lists])])
    where = np.r_[0, np.cumsum(sizes)]
    sets = [flat[a:b] for a, b in zip(where[:-1], where[1:])]
    assert all(np.array_equal(np.unique(x), y) for x, y in zip(lists, sets))
    pairs = np.r_[np.arange(0, 90, 2), np.arange(100, 302, 3)[:-1], 300]
    for percent in (50, 80, 100):
        want = [pair_alike(sets[i], sets[i + 1], percent) for i in pairs]
        assert D._pairs_alike(flat, where, pairs, percent).tolist() == want
    none = D._pairs_alike(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64), 80)
    assert none.tolist() == []
