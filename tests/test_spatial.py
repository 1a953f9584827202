import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytolattice.operators import neighbours as N
from cytolattice.operators import pixels as P
from cytolattice.operators import spatial as S


def brute(q, p, k):
    out = {}
    for sec, part in q.groupby("section"):
        pool = p[p.section == sec].sort_values("pid")
        for r in part.itertuples():
            d2 = (pool.x.to_numpy() - r.x) ** 2 + (pool.y.to_numpy() - r.y) ** 2
            best = np.argsort(d2, kind="stable")[:k]
            out[r.qid] = list(pool.pid.to_numpy()[best])
    return out


@pytest.fixture(scope="module")
def clustered():
    """One crowded section: a dense knot, a wide spread, a spot holding a third of the points."""
    rng = np.random.default_rng(5)
    xy = np.vstack([rng.normal(500, 2, (500, 2)), rng.uniform(0, 1000, (300, 2)), np.tile([[900.0, 100.0]], (400, 1))])
    p = pd.DataFrame({"section": "a", "pid": np.arange(len(xy)), "x": xy[:, 0], "y": xy[:, 1], "w": 1.0})
    p = pd.concat([p, pd.DataFrame({"section": "b", "pid": [5000, 5001], "x": [1.0, 2.0], "y": [1.0, 2.0], "w": 0.0})])
    qx = np.vstack([xy[::9], rng.uniform(-200, 1300, (40, 2)), np.tile([[900.0, 100.0]], (60, 1))])
    q = pd.DataFrame({"section": "a", "qid": np.arange(len(qx)), "x": qx[:, 0], "y": qx[:, 1]})
    q = pd.concat([q, pd.DataFrame({"section": "b", "qid": [9001], "x": [1.6], "y": [1.6]})])
    return q, p


@pytest.mark.parametrize("cap,chunk", [(2048, 8192), (40, 50)])
def test_knn_is_exact_whatever_the_leaf_size(spark, clustered, monkeypatch, cap, chunk):
    q, p = clustered
    monkeypatch.setattr(N, "LEAF_CAP", cap)
    monkeypatch.setattr(N, "CHUNK", chunk)
    got = {r.qid: [e.pid for e in r.nn] for r in N.knn_join(spark.createDataFrame(q), spark.createDataFrame(p), 7).collect()}
    assert got == brute(q, p, 7)


def test_knn_with_one_far_outlier(spark, clustered, monkeypatch):
    q, p = clustered
    monkeypatch.setattr(N, "LEAF_CAP", 40)
    p = pd.concat([p, pd.DataFrame({"section": "a", "pid": [7000], "x": [4e5], "y": [-3e5], "w": 1.0})])
    q = pd.concat([q, pd.DataFrame({"section": "a", "qid": [9100], "x": [3e5], "y": [-2e5]})])
    got = {r.qid: [e.pid for e in r.nn] for r in N.knn_join(spark.createDataFrame(q), spark.createDataFrame(p), 7).collect()}
    assert got == brute(q, p, 7)


def test_orphans(spark):
    """36 blobs, 6 of them without a nucleus within 6 micrometres."""
    blobs = [("s", i, 10.0 * (i % 6) * 10, 10.0 * (i // 6) * 10) for i in range(36)]
    nuclei = [("s", i, x + 3.0, y) for i, (_, _, x, y) in enumerate(blobs) if i % 6 != 5]
    b = spark.createDataFrame(blobs, "section string, blob_id long, x double, y double")
    n = spark.createDataFrame(nuclei, "section string, cell_id long, x double, y double")
    assert tuple(N.nearest_within(b, n, 1.0, 6.0).first())[1:] == (6, 36)
    assert tuple(N.nearest_within(b, n.where("cell_id < 0"), 1.0, 6.0).first())[1:] == (36, 36)
    assert N.nearest_within(b.where("blob_id < 0"), n, 1.0, 6.0).count() == 0


def test_triangle_ring_and_split_tiles(spark):
    tri = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]
    shapes = spark.createDataFrame([("T", 0.0, 10.0, 0.0, 10.0, 50.0, tri), ("B", -5.0, 20.0, -5.0, 20.0, 625.0, None)] + [
        (f"far{i}", 15.0, 16.0, 15.0, 16.0, 1.0 + i, None) for i in range(9)],
        "region_id string, x0 double, x1 double, y0 double, y1 double, area double, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 8.0, 8.0), (3, 30.0, 1.0), (4, 15.5, 15.5)], "cell_id long, x double, y double")
    for limit in (None, 3):
        got = {r.cell_id: r.region_id for r in S.point_in_region(pts, shapes, 25.0, limit=limit).collect()}
        assert got == {1: "T", 2: "B", 3: None, 4: "far0"}
        # Equal point rows stay, and other columns may be maps.
        twice = pts.union(pts).withColumn("m", F.create_map(F.lit("k"), F.col("cell_id")))
        assert S.point_in_region(twice, shapes, 25.0, limit=limit).where("region_id = 'B'").count() == 2


def test_ring_area_and_centre(spark):
    ell = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]
    df = spark.createDataFrame([(ell,), (None,)], "ring array<struct<x:double,y:double>>")
    ring = F.col("ring")
    got = [tuple(r) for r in df.select(S.ring_area(ring), S.ring_centre(ring, "x"), S.ring_centre(ring, "y")).collect()]
    assert got[0] == pytest.approx((6.0, (4 * 2.0 + 2 * 0.5) / 6, (4 * 0.5 + 2 * 2.0) / 6)) and got[1] == (None, None, None)


def test_ring_overlap_needs_more_than_boxes(spark):
    tri = lambda *p: [tuple(map(float, v)) for v in p]
    df = spark.createDataFrame([(1, 0.0, 10.0, 0.0, 10.0, tri((0, 0), (10, 0), (0, 10))), (2, 5.0, 10.0, 5.0, 10.0, tri((10, 10), (9, 10), (10, 9))),
                                (3, 1.0, 3.0, 1.0, 3.0, tri((1, 1), (3, 1), (1, 3)))],
                               "shape_id long, x0 double, x1 double, y0 double, y1 double, ring array<struct<x:double,y:double>>")
    assert [tuple(r) for r in S.bbox_overlap_pairs(df, 4.0).collect()] == [(1, 3)]


def test_greedy_takes_best_pair_first(spark):
    cols = "id long, x0 double, x1 double, y0 double, y1 double"
    a = spark.createDataFrame([(1, 0.0, 10.0, 0.0, 10.0), (2, 4.0, 14.0, 0.0, 10.0)], cols)
    b = spark.createDataFrame([(7, 5.0, 15.0, 0.0, 10.0), (8, 2.0, 12.0, 0.0, 10.0)], cols)
    got = sorted((r.a_id, r.b_id) for r in S.greedy_overlap_match(a, b, 6.0, 0.3).collect())
    assert got == [(1, 8), (2, 7)]


def flood(mask):
    seen, out = set(), []
    for start in sorted(mask):
        if start in seen:
            continue
        todo, comp = [start], []
        seen.add(start)
        while todo:
            y, x = todo.pop()
            comp.append((y, x))
            for n in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if n in mask and n not in seen:
                    seen.add(n)
                    todo.append(n)
        out.append(len(comp))
    return sorted(out)


def test_blobs_follow_spirals(spark):
    rng = np.random.default_rng(2)
    mask = {(int(y), int(x)) for y, x in zip(*np.nonzero(rng.random((24, 24)) < 0.55))}
    snake = {(40 + r, c) for r in range(0, 20, 2) for c in range(20)} | {(41 + r, 19 if r % 4 == 0 else 0) for r in range(0, 18, 2)}
    df = spark.createDataFrame([("p", "c", y, x) for y, x in mask | snake], "section string, channel string, y int, x int")
    got = sorted(r["size"] for r in P.connected_blobs(df).collect())
    assert got == flood(mask | snake)


def test_single_tile_blends_to_itself(spark):
    rows = [("s", "c", "t", 5, 7, 6, 6, y, x, 10 * y + x) for y in range(6) for x in range(6)]
    df = spark.createDataFrame(rows, "section string, channel string, tile string, x0 int, y0 int, w int, h int, y int, x int, v int")
    got = {(r.y, r.x): r.v for r in P.feathered_blend(df, 3).collect()}
    assert got == {(7 + y, 5 + x): 10 * y + x for y in range(6) for x in range(6)}


def test_focus_prefers_texture(spark):
    rows = [("s", "c", z, y, x, 100 + (50 * ((x + y) % 2) if z == 1 else 0)) for z in (0, 1) for y in range(8) for x in range(8)]
    df = spark.createDataFrame(rows, "section string, channel string, z int, y int, x int, v int")
    assert P.sharpest_plane(P.focus_score(df, 1)).first().best_z == 1


def test_two_peaks_give_the_span(spark):
    counts = np.zeros(64)
    counts[8:13] = [20, 60, 100, 60, 20]
    counts[40:45] = [10, 25, 40, 25, 10]
    rows = [("s", "c", i, int(n)) for i, n in enumerate(counts)]
    h = spark.createDataFrame(rows, "section string, channel string, bin long, n long")
    r = P.span_ends(h, ["section", "channel"], 16, 3).first()
    assert (r.floor_peak, r.bright_peak) == (10 * 16, 42 * 16)
    flat = h.withColumn("n", F.lit(0).cast("long"))
    assert P.span_ends(flat, ["section", "channel"], 16, 3).first().floor_peak is None
