"""Totals of points per shape against brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cytolattice.operators import inshapes as I
from cytolattice.operators import shapeindex as X
from cytolattice.operators import spatial as S


def _inside(ring, x, y):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y):
            hit ^= x < (bx - ax) * (y - ay) / (by - ay) + ax
    return hit


def _world(spark):
    rng = np.random.default_rng(5)
    shapes = []
    for i in range(24):
        cx, cy, r = (float(rng.uniform(*b)) for b in ((0, 100), (0, 100), (2, 40)))
        ring = None if i % 3 == 0 else [(cx + r * (1 if j % 2 else 0.4) * float(np.cos(t)), cy + r * (1 if j % 2 else 0.4) * float(np.sin(t)))
                                         for j, t in enumerate(np.linspace(0, 2 * np.pi, 4 if i % 3 == 1 else 41)[:-1])]
        x0, x1, y0, y1 = (cx // 1 - 5, cx // 1 + 7, cy // 1 - 4, cy // 1 + r) if ring is None else (
            min(p[0] for p in ring), max(p[0] for p in ring), min(p[1] for p in ring), max(p[1] for p in ring))
        shapes += [(2 * i, f"R{i}", *map(float, (x0, x1, y0, y1)), ring), (2 * i + 1, f"R{i}", *map(float, (x0, x1, y0, y1)), ring)]
    points = [(["a", "b", None][k % 3], float(x), float(y), float(k)) for k, (x, y) in enumerate(rng.integers(0, 100, (700, 2)))]
    df = spark.createDataFrame(shapes, "shape_id long, roi_name string, x0 double, x1 double, y0 double, y1 double, ring array<struct<x:double,y:double>>")
    return shapes, points, df, spark.createDataFrame(points, "marker string, x double, y double, v double")


def _held(shape, p):
    _, _, x0, x1, y0, y1, ring = shape
    return x0 <= p[1] < x1 and y0 <= p[2] < y1 and (ring is None or _inside(ring, p[1], p[2]))


def test_counts_and_least_values_equal_brute_force(spark):
    shapes, points, df, pts = _world(spark)
    want, low = {}, {}
    for s in shapes:
        for p in points:
            if _held(s, p):
                want[s[0], p[0]] = want.get((s[0], p[0]), 0) + 1
                low[s[0]] = min(low.get(s[0], 1e9), p[3])
    for limit in (60, 4000):
        got = {(r.shape_id, r.marker): r.total for r in I.totals_in_shapes(pts, df, 3.0, by=["marker"], spots_limit=limit).collect()}
        assert got == want
        assert {r.shape_id: r.total for r in I.totals_in_shapes(pts, df, 3.0, least="v", spots_limit=limit).collect()} == low
    counts = {(r.shape_id, r.roi_name): r.n for r in S.count_in_shapes(pts, df, 3.0).collect()}
    assert counts == {(s[0], s[1]): sum(_held(s, p) for p in points) for s in shapes if any(_held(s, p) for p in points)}


def test_equal_shapes_are_tested_once(spark, monkeypatch):
    """400 copies of one box: the border test sees each border cell once."""
    seen = []
    whole = I._tested
    monkeypatch.setattr(I, "_tested", lambda spots, border, *rest: (seen.append(border.count()), whole(spots, border, *rest))[1])
    boxes = spark.range(400).select(F.col("id").alias("shape_id"), F.lit("R").alias("roi_name"), *[F.lit(v).alias(c) for c, v in (("x0", 1.5), ("x1", 9.5), ("y0", 1.5), ("y1", 9.5))])
    pts = spark.createDataFrame(pd.DataFrame({"x": [2.0, 5.0, 9.5, 9.0], "y": [2.0, 5.0, 5.0, 1.5]}))
    assert [r.n for r in S.count_in_shapes(pts, boxes, 1.0).select("n").distinct().collect()] == [3]
    assert seen and max(seen) <= 25


def test_no_shapes_and_no_points(spark):
    _, _, df, pts = _world(spark)
    assert S.count_in_shapes(pts, df.limit(0), 3.0, ["marker"]).count() == 0
    assert S.count_in_shapes(pts.limit(0), df, 3.0).count() == 0


def test_first_shape_lists_stop_behind_a_shape_that_holds_the_cell(spark):
    """600 boxes and outlines over one another: lists stay short, and the first shape of every point is still found."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(600):
        x, y, r = float(rng.integers(0, 60)), float(rng.integers(0, 60)), float(rng.integers(15, 40))
        ring = [(x + r, y), (x + 2 * r, y + r), (x + r, y + 2 * r), (x, y + r)] if i % 2 else None
        rows.append((i, "R", x, x + 2 * r, y, y + 2 * r, ring))
    points = [(k, float(a), float(b)) for k, (a, b) in enumerate(rng.integers(0, 140, (300, 2)))]
    df = spark.createDataFrame(rows, "shape_id long, roi_name string, x0 double, x1 double, y0 double, y1 double, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame(points, "cell_id long, x double, y double")
    for shapes, held in ((df, rows), (df.drop("ring"), [(*r[:6], None) for r in rows])):
        want = {p[0]: min((s[0] for s in held if _held(s, p)), default=None) for p in points}
        assert {r.cell_id: r.owner for r in S.first_owner_shape(pts, shapes, 40.0).collect()} == want
        lists = X.shape_index(shapes, 40.0, [], ["shape_id"], first=True)[0]
        whole = X.shape_index(shapes, 40.0, [], ["shape_id"])[0]
        longest = lambda t: t.agg(F.max(F.size("shapes"))).first()[0]
        assert longest(lists) <= X.FIRST < longest(whole)


def test_equal_boxes_are_compared_once(spark, monkeypatch):
    met, whole = [], S.meeting_boxes
    monkeypatch.setattr(S, "meeting_boxes", lambda a, b, *rest, **more: (met.append(a.count()), whole(a, b, *rest, **more))[1])
    boxes = spark.range(60).select(F.col("id").alias("shape_id"), *[F.when(F.col("id") % 3 == 0, F.lit(u)).otherwise(F.lit(v)).alias(c)
                                   for c, u, v in (("x0", 0.0, 5.0), ("x1", 10.0, 15.0), ("y0", 0.0, 5.0), ("y1", 10.0, 15.0))])
    got = sorted((r.first, r.second) for r in S.bbox_overlap_pairs(boxes, 4.0).select("first", "second").toLocalIterator())
    assert got == [(i, j) for i in range(60) for j in range(i + 1, 60)] and met == [2]


def test_equal_outlines_are_measured_once(spark, monkeypatch):
    sizes, whole = {}, S.settle
    monkeypatch.setattr(S, "settle", lambda df, name="settled": (lambda t: (sizes.__setitem__(name, t.count()), t)[1])(whole(df, name)))
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((4.0, 4.0), (8.0, 4.0), (8.0, 8.0), (4.0, 8.0))])
    pixels = spark.range(400).select(F.lit("s").alias("section"), F.lit("c").alias("channel"), (F.col("id") % 20).alias("x"), F.floor(F.col("id") / 20).alias("y"), F.lit(3.0).alias("v"))
    cells = lambda n: spark.range(n).select(F.lit("s").alias("section"), F.col("id").alias("cell_id"), ring.alias("ring"))
    one = S.outline_background(cells(1), pixels, 1.0, 2.0).collect()
    alone = sizes["bands"]
    many = S.outline_background(cells(50), pixels, 1.0, 2.0).collect()
    assert sizes["bands"] == alone and sorted(r.cell_id for r in many) == list(range(50))
    assert {tuple(r)[2:] for r in many} == {tuple(one[0])[2:]}
