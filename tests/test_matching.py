"""One-to-one matches of equal and crowded shapes against a plain greedy choice."""

import random

import numpy as np
import pytest

from cytolattice.operators import matching as M, spatial as S

COLS = "id long, x0 double, x1 double, y0 double, y1 double"


def plain(candidates):
    used_a, used_b, out = set(), set(), []
    for frac, a, b in sorted(candidates, key=lambda c: (-c[0], c[1], c[2])):
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            out.append((a, b))
    return sorted(out)


def test_blocks_accept_only_pairs_of_the_greedy_choice():
    rng, found, wanted = random.Random(4), 0, 0
    for _ in range(400):
        n, m, ids = rng.randint(1, 7), rng.randint(1, 7), [list(range(60)), list(range(60))]
        for i in ids:
            rng.shuffle(i)
        a, b = ([sorted(i.pop() for _ in range(rng.randint(1, 5))) for _ in range(k)] for k, i in zip((n, m), ids))
        edges = [(f, g, rng.choice((1.0, 0.75, 0.5))) for f in range(n) for g in range(m) if rng.random() < 0.5]
        if not edges:
            continue
        want = plain([(v, i, j) for f, g, v in edges for i in a[f] for j in b[g]])
        for share in (1.0, 0.6):
            own_a, own_b = ([rng.random() < share for _ in range(k)] for k in (n, m))
            near = [e for e in edges if own_a[e[0]] or own_b[e[1]]]
            if near:
                got = M.sure_pairs(a, own_a, b, own_b, *(np.array(c) for c in zip(*near)))
                got = sorted((i, j) for _, _, i, j, _ in got)
                assert set(got) <= set(want) and (share < 1.0 or got == want)
                found, wanted = found + (share < 1.0) * len(got), wanted + (share < 1.0) * len(want)
    assert found > wanted / 5


def boxes(rng, n, copies, step):
    spots = [(step * rng.randint(0, 12), step * rng.randint(0, 12), rng.randint(2, 5)) for _ in range(n)]
    return [(i + n * c, float(x - r), float(x + r), float(y - r), float(y + r)) for c in range(copies) for i, (x, y, r) in enumerate(spots)]


@pytest.mark.parametrize("load,limit", [(None, None), (60, None), (300, 3)])
def test_copies_in_many_blocks_equal_the_sequential_choice(spark, load, limit):
    rng = random.Random(9)
    a, b = boxes(rng, 40, 5, 3), boxes(rng, 45, 4, 3)
    cands = []
    for i, *p in a:
        for j, *q in b:
            w, h = min(p[1], q[1]) - max(p[0], q[0]), min(p[3], q[3]) - max(p[2], q[2])
            frac = round(w * h / min((p[1] - p[0]) * (p[3] - p[2]), (q[1] - q[0]) * (q[3] - q[2])), 9) if w > 0 and h > 0 else 0.0
            if frac >= 0.2:
                cands.append((frac, i, j))
    got = S.greedy_overlap_match(spark.createDataFrame(a, COLS), spark.createDataFrame(b, COLS), 6.0, 0.2, load=load, limit=limit)
    assert sorted((r.a_id, r.b_id) for r in got.collect()) == plain(cands)


def test_copies_write_no_pair_each(spark, monkeypatch):
    """3,000 copies of each shape: nine million pairs of ids, but few pairs of lists."""
    a = [(i, 10.0 * (i % 2), 10.0 * (i % 2) + 12, 0.0, 10.0) for i in range(6000)]
    b = [(i, 10.0 * (i % 2) + 1, 10.0 * (i % 2) + 13, 0.0, 10.0) for i in range(5000)]
    sizes, settle = {}, S.settle

    def counted(df, name="settled"):
        out = settle(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(S, "settle", counted)
    monkeypatch.setattr(M, "settle", counted)
    got = S.greedy_overlap_match(spark.createDataFrame(a, COLS), spark.createDataFrame(b, COLS), 6.0, 0.2).collect()
    assert len(got) == 5000 and sizes["overlaps"] <= 64 and len({r.a_id for r in got}) == len({r.b_id for r in got}) == 5000


def test_no_shapes_no_pairs(spark):
    none = spark.createDataFrame([], COLS)
    some = spark.createDataFrame([(1, 0.0, 2.0, 0.0, 2.0), (2, 5.0, None, 0.0, 2.0)], COLS)
    assert S.greedy_overlap_match(none, some, 6.0, 0.2).collect() == S.greedy_overlap_match(some, none, 6.0, 0.2).collect() == []


def test_crowded_distinct_shapes_list_few_pairs(spark, monkeypatch):
    """400 shapes a side on 36 places, hardly two alike: no step lists a third of the pairs that one step lists, and the choice is the same."""
    rng = random.Random(5)

    def side():
        rows = []
        for i in range(400):
            x, y, h = 20.0 * rng.randint(0, 5), 20.0 * rng.randint(0, 5), 40 + rng.randint(0, 400) / 20
            v, diamond = 0.75 * h, i % 2
            ring = [(x - h, y), (x, y - v), (x + h, y), (x, y + v)] if diamond else None
            rows.append((i, x - h, x + h, y - v, y + v, ring))
        return spark.createDataFrame(rows, f"{COLS}, ring {S.RING}")

    a, b, sizes, settle = side(), side(), [], S.settle

    def counted(df, name="settled"):
        out = settle(df, name)
        sizes.extend([out.count()] if name == "overlaps" else [])
        return out

    monkeypatch.setattr(S, "settle", counted)
    rows = lambda few: sorted(tuple(r) for r in S.greedy_overlap_match(a, b, 200.0, 0.2, few=few).collect())
    whole = rows(1 << 40)
    every, sizes[:] = sizes[0], []
    assert rows(0) == whole and len(whole) > 350
    assert len(sizes) == 7 and max(sizes) < every / 3


def test_core_of_outlines(spark):
    """What lies beyond the sides of a diamond's core is the given share of it, or a little more."""
    df = spark.createDataFrame([([(-10.0, 0.0), (0.0, -5.0), (10.0, 0.0), (0.0, 5.0)],), (None,)], f"ring {S.RING}")
    got = [r[0] for r in df.select(S.core(df["ring"], 0.02)).collect()]
    assert tuple(got[0]) == pytest.approx((-8, 8, -4, 4), abs=1e-5) and got[0]["x0"] >= -8 and tuple(got[1]) == (None,) * 4
