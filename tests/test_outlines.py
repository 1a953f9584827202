"""Quad-tree covers, outline areas and crowded box joins against plain geometry."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytolattice.operators import outlines as O
from cytolattice.operators import shapeindex as X
from cytolattice.operators import spatial as S

RING = "array<struct<x:double,y:double>>"


def star(rng, cx, cy, r, n):
    """A wavy outline of n vertices around a point."""
    at = [2 * math.pi * i / n for i in range(n)]
    return [(cx + r * (0.4 + 0.6 * rng.random()) * math.cos(t), cy + r * (0.4 + 0.6 * rng.random()) * math.sin(t)) for t in at]


def inside(ring, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    return odd


def shape_row(name, ring):
    xs, ys = zip(*ring)
    return (name, f"roi{name % 3}", min(xs), max(xs), min(ys), max(ys), ring)


SHAPES = f"shape_id long, roi_name string, x0 double, x1 double, y0 double, y1 double, ring {RING}"


@pytest.fixture(scope="module")
def drawn():
    rng = random.Random(3)
    rings = [star(rng, rng.uniform(0, 900), rng.uniform(0, 900), rng.choice((20, 80, 400)), rng.choice((3, 8, 60, 400))) for _ in range(25)]
    rings.append([(-5000.0, -5000.0), (6000.0, -5000.0), (6000.0, 6000.0), (-5000.0, 6000.0)])
    rings.append([(0.0, 0.0), (512.0, 0.0), (512.0, 256.0), (256.0, 256.0), (256.0, 512.0), (0.0, 512.0)])      # edges on cell borders
    rows = [shape_row(i, r) for i, r in enumerate(rings)]
    rows.append((100, "roi0", 100.0, 700.0, 100.0, 300.0, None))
    points = [(i, rng.uniform(-100, 1000), rng.uniform(-100, 1000)) for i in range(1500)]
    points += [(2000 + i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (256, 256), (512, 0), (255, 300), (256, 300), (64, 128), (100, 100), (700, 200)])]
    want = {(c, r[0]) for c, x, y in points for r in rows
            if r[2] <= x < r[3] and r[4] <= y < r[5] and (r[6] is None or inside(r[6], x, y))}
    return rows, points, want


@pytest.mark.parametrize("tile,limit,edges", [(16.0, None, 16), (300.0, None, 2), (7.0, 5, 4)])
def test_points_in_outlines_equal_plain_test(spark, drawn, monkeypatch, tile, limit, edges):
    monkeypatch.setattr(X, "EDGE_LIMIT", edges)
    rows, points, want = drawn
    shapes, pts = spark.createDataFrame(rows, SHAPES), spark.createDataFrame(points, "cell_id long, x double, y double")
    got = [(r.cell_id, r.shape_id) for r in S.cells_in_shape(pts, shapes, tile, limit=limit).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    first = {r.cell_id: r.owner for r in S.first_owner_shape(pts, shapes, tile, limit=limit).collect()}
    assert first == {c: min((s for p, s in want if p == c), default=None) for c, _, _ in points}


def test_rows_of_a_shape_do_not_grow_with_its_area(spark):
    big = lambda r: spark.createDataFrame([(1, "r", -r, r, -r, r, None), (2, "r", -r, r, -r, r, [(-r, -r), (r, -r), (r, r), (-r, r)])], SHAPES)
    counts = [X.shape_cells(big(r), 10.0, [], ["shape_id"]).groupBy("shape.shape_id").count().orderBy("shape_id").collect() for r in (1e2, 1e4, 1e6)]
    assert all(c["count"] <= 40 for row in counts for c in row)
    rng = random.Random(1)
    ring = star(rng, 0.0, 0.0, 1e5, 4000)
    cover = X.outline_cover(*zip(*ring), 10.0)
    cells = [set() for _ in range(20)]
    for level, tx, ty, inner, *_ in cover:
        assert (tx, ty) not in cells[level + 5]
        cells[level + 5].add((tx, ty))
    assert max(len(c[6]) for c in cover) < 400 and sum(c[3] for c in cover) > 0


def test_levels_with_no_shapes_and_without_rings(spark):
    pts = spark.createDataFrame([(1, 5.0, 5.0)], "cell_id long, x double, y double")
    none = spark.createDataFrame([], SHAPES)
    assert S.cells_in_shape(pts, none, 10.0).collect() == [] and S.first_owner_shape(pts, none.drop("ring"), 10.0).first().owner is None
    boxes = spark.createDataFrame([(1, "a", 0.0, 9.0, 0.0, 9.0), (2, "b", -1e6, 1e6, -1e6, 1e6), (3, "c", 5.0, 5.0, 5.0, 5.0)], SHAPES.split(", ring")[0])
    assert sorted(r.shape_id for r in S.cells_in_shape(pts, boxes, 10.0).collect()) == [1, 2]


def sutherland(subject, clip):
    """Clipping of any ring by a convex counter-clockwise one."""
    out = subject
    for (ax, ay), (bx, by) in zip(clip, clip[1:] + clip[:1]):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        new = []
        for p, q in zip(out, out[1:] + out[:1]):
            if side(p) >= 0:
                new.append(p)
            if side(p) * side(q) < 0:
                t = side(p) / (side(p) - side(q))
                new.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        out = new
        if not out:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(out, out[1:] + out[:1]))) / 2


def test_intersection_area_equals_clipping(spark):
    rng = random.Random(7)
    pairs = []
    for _ in range(150):
        at = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 8)))
        convex = [(5 * math.cos(t) + rng.choice((0, 1, 6)), 5 * math.sin(t)) for t in at]
        dx = convex[0][0] - 5 * math.cos(at[0])
        convex = [(5 * math.cos(t) + dx, 5 * math.sin(t)) for t in at]
        pairs.append((star(rng, rng.uniform(-4, 8), rng.uniform(-4, 4), 6.0, rng.randint(3, 20)), convex))
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    fixed = [(square, square, 16.0), (square, [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)], 1.0),             # equal, nested
             (square, [(4.0, 0.0), (8.0, 0.0), (8.0, 4.0), (4.0, 4.0)], 0.0),                                   # sharing an edge
             (square, [(4.0, 4.0), (5.0, 4.0), (5.0, 5.0)], 0.0), (square, [(9.0, 9.0), (10.0, 9.0), (10.0, 10.0)], 0.0),
             (square, [(2.0, -1.0), (5.0, 2.0), (2.0, 5.0), (-1.0, 2.0)], 14.0), (square, square[::-1], 16.0),
             ([(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 3.0), (4.0, 3.0), (4.0, 4.0), (0.0, 4.0)], [(3.0, 0.5), (6.0, 0.5), (6.0, 3.5), (3.0, 3.5)], 1.0)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(pairs + fixed)], f"i int, a {RING}, b {RING}")
    got = [r.v for r in O.with_intersection_area(df, F.col("a"), F.col("b"), "v").orderBy("i").collect()]
    want = [sutherland(a, b) for a, b in pairs] + [f[2] for f in fixed]
    assert got == pytest.approx(want, abs=1e-6)
    assert O.with_intersection_area(spark.createDataFrame([(None, square)], f"a {RING}, b {RING}"), F.col("a"), F.col("b"), "v").first().v is None


def greedy(candidates):
    used_a, used_b, out = set(), set(), []
    for frac, a, b in sorted(candidates, key=lambda c: (-c[0], c[1], c[2])):
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            out.append((a, b, frac))
    return sorted(out)


def test_greedy_match_of_outlines(spark):
    rng = random.Random(11)

    def side(n):
        rows = []
        for i in range(n):
            x, y, h, v = rng.randint(0, 60), rng.randint(0, 60), rng.randint(2, 9), rng.randint(2, 9)
            kind = rng.choice(("diamond", "box", "null"))
            ring = [(x - h, y), (x, y - v), (x + h, y), (x, y + v)] if kind == "diamond" else [(x - h, y - v), (x + h, y - v), (x + h, y + v), (x - h, y + v)]
            ring = [(float(p), float(q)) for p, q in ring]
            rows.append((i, float(x - h), float(x + h), float(y - v), float(y + v), None if kind == "null" else ring, ring))
        return rows

    a, b = side(60), side(70)
    area = lambda r: abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r, r[1:] + r[:1]))) / 2
    cands = []
    for ra in a:
        for rb in b:
            frac = round(sutherland(ra[6], rb[6]) / min(area(ra[6]), area(rb[6])), 9)
            if frac >= 0.2:
                cands.append((frac, ra[0], rb[0]))
    frame = lambda rows: spark.createDataFrame([r[:6] for r in rows], f"id long, x0 double, x1 double, y0 double, y1 double, ring {RING}")
    for block in (None, 3):
        got = sorted((r.a_id, r.b_id, r.frac) for r in S.greedy_overlap_match(frame(a), frame(b), 5.0, 0.2, block=block).collect())
        assert [g[:2] for g in got] == [w[:2] for w in greedy(cands)] and [g[2] for g in got] == pytest.approx([w[2] for w in greedy(cands)])


@pytest.mark.parametrize("tile,block", [(1e6, 20), (10.0, None), (0.5, 7)])
def test_crowded_boxes_are_paired_once(spark, tile, block):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        x, y, w, h = rng.uniform(0, 40), rng.uniform(0, 40), rng.choice([0.1, 2.0, 30.0]), rng.choice([0.1, 2.0, 30.0])
        rows.append((i, float(x), float(x + w), float(y), float(y + h), int(i % 2)))
    rows += [(400 + i, 1.0, 2.0, 1.0, 2.0, 0) for i in range(40)] + [(500, 3.0, 3.0, 0.0, 40.0, 0)]
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[5] == b[5] and a[0] != 500 and b[0] != 500
                  and a[1] < b[2] and b[1] < a[2] and a[3] < b[4] and b[3] < a[4])
    df = spark.createDataFrame(rows, "shape_id long, x0 double, x1 double, y0 double, y1 double, z long")
    assert sorted((r.first, r.second) for r in S.bbox_overlap_pairs(df, tile, ["z"], block=block).select("first", "second").toLocalIterator()) == want


def test_no_join_key_of_crowded_boxes_is_over_the_bound(spark):
    boxes = spark.range(2000).select(F.col("id").alias("shape_id"), (F.col("id") * 0.01).alias("x0"), (F.col("id") * 0.01 + 0.005).alias("x1"), F.lit(0.0).alias("y0"), F.lit(100.0).alias("y1"))
    assert S.bbox_overlap_pairs(boxes, 1e9, block=100).count() == 0
    pairs = X.meeting_boxes(boxes, boxes, 1e9, [], "shape_id", block=100)
    keys = [line for line in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert any("_pa" in k and "_pb" in k for k in keys)


def test_background_around_an_outline(spark):
    rng = random.Random(4)
    ring = [(10.2, 10.1), (20.3, 10.4), (20.1, 14.2), (14.3, 14.1), (14.2, 20.3), (10.1, 20.2)]
    other = [(23.1, 9.2), (26.3, 9.1), (26.2, 13.3), (23.2, 13.4)]
    image = {(x, y): rng.randint(0, 100) for x in range(35) for y in range(35)}

    def far(r, x, y):
        best = 1e9
        for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1]):
            t = max(0.0, min(1.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            best = min(best, math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y))
        return best

    mids = {p: (p[0] + 0.5, p[1] + 0.5) for p in image}
    disc = [v for p, v in image.items() if inside(ring, *mids[p])]
    band = [v for p, v in image.items() if not inside(ring, *mids[p]) and 1.0 < far(ring, *mids[p]) <= 4.0 and not inside(other, *mids[p])]
    cells = spark.createDataFrame([("s", 1, ring), ("s", 2, other), ("s", 3, None)], f"section string, cell_id long, ring {RING}")
    pixels = spark.createDataFrame([("s", "c", x, y, v) for (x, y), v in image.items()], "section string, channel string, x int, y int, v int")
    got = {r.cell_id: r for r in S.outline_background(cells, pixels, 1.0, 3.0).collect()}
    assert set(got) == {1, 2} and got[1].raw_mean == pytest.approx(np.mean(disc)) and got[1].background == pytest.approx(np.mean(band))
    assert S.outline_background(cells, pixels, 100.0, 1.0).where("cell_id = 1").first().background is None


def test_settled_tables_are_cleared(spark):
    from cytolattice.session import _SETTLED, clear_settled, settle
    kept = dict(_SETTLED)
    _SETTLED.clear()
    t = settle(spark.range(3))
    assert t.count() == 3 and clear_settled(spark) == 1 and clear_settled(spark) == 0
    with pytest.raises(Exception):
        t.count()
    _SETTLED.update(kept)
