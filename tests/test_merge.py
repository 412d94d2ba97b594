"""Rows of one natural key paired greedily: both ways to find partners against the plain rule."""

import numpy as np

from curaspark.operators import cdc


def ways():
    pair = cdc._pairing(["k", "a"], "id", "no")
    return {n: c.cell_contents for n, c in zip(pair.__code__.co_freevars, pair.__closure__)}


def plain(was, now):
    out, used = np.full(len(was), -1), set()
    for _, i, j in sorted((int((was[i] != now[j]).sum()), i, j) for i in range(len(was)) for j in range(len(now))):
        if out[i] < 0 and j not in used:
            out[i] = j
            used.add(j)
    return out


def test_partners_are_those_of_the_greedy_rule():
    rng, found = np.random.default_rng(7), ways()
    for _ in range(400):
        columns, values = rng.integers(1, 6), rng.integers(1, 5)
        was, now = (rng.integers(0, values, (rng.integers(1, 14), columns)) for _ in range(2))
        want = plain(was, now).tolist()
        assert found["by_rows"](was, now).tolist() == want
        assert found["by_subsets"](was, now).tolist() == want


def test_a_hot_key_of_many_rows_is_paired_by_the_index():
    rng = np.random.default_rng(3)
    was, now = (rng.integers(0, 40, (20000, 4)) for _ in range(2))
    got = ways()["by_subsets"](was, now)
    assert sorted(got.tolist()) == list(range(20000))
