import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytolattice.operators import chance as C
from cytolattice.operators import neighbours as N


def clustered(rng, n):
    """A spread, a dense spot, copies of one position and a far outlier."""
    xy = np.vstack([rng.uniform(0, 1000, (n, 2)), rng.normal(300, 2, (n // 2, 2)), np.full((40, 2), 500.0), [[9000.0, 4000.0]]])
    return np.round(xy, 1)


def brute(q, p, w, k):
    d2 = (q[:, None, 0] - p[:, 0]) ** 2 + (q[:, None, 1] - p[:, 1]) ** 2
    best = np.argsort(d2, axis=1, kind="stable")[:, :k]
    near = np.take_along_axis(d2, best, axis=1)
    return near[:, -1], np.sqrt(near).sum(axis=1), w[best].sum(axis=1)


@pytest.mark.parametrize("cap,crowd", [(16_384, 4), (60, 4), (60, 1)])
def test_sums_over_neighbours_are_exact_whatever_the_leaf_size(spark, monkeypatch, cap, crowd):
    monkeypatch.setattr(N, "CROWD", crowd)
    rng = np.random.default_rng(3)
    p = clustered(rng, 600)
    w = rng.integers(0, 2, len(p)).astype(float)
    q = np.vstack([p[::3], rng.uniform(-800, 1800, (150, 2))])
    pool = spark.createDataFrame(pd.DataFrame({"section": "s", "pid": np.arange(len(p)), "x": p[:, 0], "y": p[:, 1], "w": w}))
    queries = spark.createDataFrame(pd.DataFrame({"section": "s", "qid": np.arange(len(q)), "x": q[:, 0], "y": q[:, 1]}))
    for k in (1, 20) if crowd > 1 and cap > 60 else (20,):
        got = N.knn_summary(queries, pool, k, cap).toPandas().sort_values("qid")
        d2, reach, total = brute(q, p, w, k)
        assert len(got) == len(q) and (got.found == k).all() and (got.section == "s").all()
        assert np.array_equal(got.d2, d2) and np.allclose(got.reach, reach) and np.array_equal(got.total, total)
    few = N.knn_summary(queries.limit(5), pool.limit(7), 20, cap).toPandas()
    assert (few.found == 7).all() and few.d2.isna().all()


def turn(section, rot):
    own, prime = int(hashlib.md5(section.encode()).hexdigest()[:7], 16), 2147483647
    y = (((rot + 1) * 1_000_003 + own) % prime * 48_271 + 11) % prime
    sq = y * y % prime
    return 2 * math.pi * (sq * sq % prime * y % prime) / prime


@pytest.mark.parametrize("cap", [None, 60])
def test_rotations_match_brute_force_and_write_no_row_a_turn(spark, monkeypatch, cap):
    rng, rows = np.random.default_rng(4), []
    for name, n in (("s1", 700), ("s2", 14), ("s3", 8)):
        xy = np.round(rng.uniform(0, 1000, (n, 2)) ** 1.2)
        rows.append(pd.DataFrame({"section": name, "x": xy[:, 0], "y": xy[:, 1], "tagged": rng.random(n) < 0.3, "activity": rng.random(n) < 0.4}))
    pdf = pd.concat(rows, ignore_index=True).assign(region="LA")
    pdf["cell_id"] = np.arange(len(pdf))
    written = []

    def counted(df, name="settled", settle=N.settle):
        out = settle(df, name)
        written.append(out.count())
        return out

    for module in (C, N):
        monkeypatch.setattr(module, "settle", counted)
    got = C.rotation_null(spark.createDataFrame(pdf), 60, cap=cap).first()
    acts, far = [[] for _ in range(60)], 0
    for name, part in pdf.groupby("section"):
        if len(part) < 10:
            continue
        p, tag = part[["x", "y"]].to_numpy(float), part.tagged.to_numpy()
        mid, m = p.mean(axis=0), min(25, len(part) - 1)
        dx, dy = (p[tag] - mid).T
        for rot in range(60):
            th = turn("LA\u0001" + name, rot)
            q = np.column_stack([mid[0] + dx * math.cos(th) - dy * math.sin(th), mid[1] + dx * math.sin(th) + dy * math.cos(th)])
            acts[rot] += list(brute(q, p, part.activity.to_numpy(float), m)[2] / m)
    null, obs = np.array([np.mean(a) for a in acts]), pdf[pdf.tagged].activity.mean()
    assert (got.observed, got.null_mean, got.ratio) == pytest.approx((obs, null.mean(), obs / null.mean()))
    assert got.p == pytest.approx(((null >= obs - 1e-12).sum() + 1) / 61)
    if cap is None:
        assert max(written) <= len(pdf)            # a row per cell or fewer, where 60 turns of every tagged cell were written


def test_modelled_cells_are_written_once_and_narrow(spark):
    from cytolattice import session
    from cytolattice.plans import chance_queries as Q
    before = set(session._SETTLED.get(id(spark.sparkContext), []))
    rows = Q.modelled(spark, "/root/testdata/sf0.001")
    paths = [p for p in session._SETTLED[id(spark.sparkContext)] if p not in before]
    wide = [p for p in paths if "x1" in spark.read.parquet(p).columns]
    assert len(wide) == 1 and "animal" not in spark.read.parquet(wide[0]).columns and rows.where("region = '__ALL__'").count() > 0
