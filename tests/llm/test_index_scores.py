"""Scores of many queries at once give the rows and digits of a search query by query."""

import numpy as np
import pytest

from cytolattice.llm import multiindex


def one_by_one(q, asked, open_, x, ids, k):
    out = []
    for i in range(len(q)):
        on = np.flatnonzero(open_[i] & (ids != asked[i]))
        s = (x[on] * q[i]).sum(axis=1)
        out += [(i, int(on[j]), float(s[j])) for j in np.lexsort((ids[on], -s))[:k]]
    return out


@pytest.mark.parametrize("kind", ["random", "tied", "huge", "few"])
def test_best_rows_equal_a_search_one_by_one(kind):
    rng = np.random.default_rng(6)
    n, m, k = (9 if kind == "few" else 700), 40, 20
    x, q = rng.normal(size=(n, 64)), rng.normal(size=(m, 64))
    if kind == "tied":
        x, q = np.round(x), np.round(q)
        x[100:400] = x[:300]
    if kind == "huge":
        x[:30] *= 1e200
        q[:5] *= 1e200
    ids, open_ = rng.permutation(n) * 5, rng.random((m, n)) < 0.5
    open_[3] = False
    asked = ids[rng.integers(0, n, m)]
    with np.errstate(all="ignore"):
        got = list(zip(*(v.tolist() for v in multiindex.best_rows(q, asked, open_, x, ids, k))))
        want = one_by_one(q, asked, open_, x, ids, k)
    assert repr(got) == repr(want) and got
