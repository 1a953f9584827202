"""Areas of intersection of outlines, as column expressions.

Between two neighbouring heights of vertices and crossings no edges cross, so the common width of two outlines is linear there: its value at the
middle height times the height of the slab is exact.  Touching, shared, collinear and nested outlines need no special case, since only
middle heights are looked at.  Rings are arrays of x/y vertices, closed implicitly, inside by the even-odd rule; they must not cross themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf


def box_ring(x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """A box as a ring."""
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])


def ring_edges(ring: Column) -> Column:
    """Edges as structs (ax, ay, bx, by)."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.transform(F.arrays_zip(ring.alias("a"), following.alias("b")), lambda e: F.struct(
        e["a"]["x"].alias("ax"), e["a"]["y"].alias("ay"), e["b"]["x"].alias("bx"), e["b"]["y"].alias("by")))


def _crossing_height(e: Column, f: Column) -> Column:
    """Height at which two edges cross; NULL if they are parallel or pass each other."""
    ex, ey, fx, fy = e["bx"] - e["ax"], e["by"] - e["ay"], f["bx"] - f["ax"], f["by"] - f["ay"]
    across = ex * fy - ey * fx
    dx, dy = f["ax"] - e["ax"], f["ay"] - e["ay"]
    t, u = (dx * fy - dy * fx) / F.nullif(across, F.lit(0.0)), (dx * ey - dy * ex) / F.nullif(across, F.lit(0.0))
    return F.when(t.between(-1e-9, 1 + 1e-9) & u.between(-1e-9, 1 + 1e-9), e["ay"] + t * ey)


def _common_width(a: Column, b: Column, y: Column) -> Column:
    """Length of the part of the line at height y that is inside both outlines."""
    def events(edges, tag):
        live = F.filter(edges, lambda e: (e["ay"] > y) != (e["by"] > y))
        return F.transform(live, lambda e: F.struct(((e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]).alias("x"), F.lit(tag).alias("tag")))

    start = F.struct(F.lit(0.0).alias("x"), F.lit(False).alias("a"), F.lit(False).alias("b"), F.lit(0.0).alias("width"))
    step = lambda s, e: F.struct(e["x"].alias("x"), (s["a"] != (e["tag"] == 0)).alias("a"), (s["b"] != (e["tag"] == 1)).alias("b"),
                                 (s["width"] + F.when(s["a"] & s["b"], e["x"] - s["x"]).otherwise(0.0)).alias("width"))
    return F.aggregate(F.array_sort(F.concat(events(a, 0), events(b, 1))), start, step, lambda s: s["width"])


def with_intersection_area(pairs: DataFrame, ring_a: Column, ring_b: Column, into: str) -> DataFrame:
    """``pairs`` with the area common to two outlines; NULL without either.  Edges and heights are made once a row, not once a slab."""
    heights = lambda ring: F.transform(ring, lambda p: p["y"])
    out = pairs.withColumn("_ya", heights(ring_a)).withColumn("_yb", heights(ring_b)).withColumn("_ea", ring_edges(ring_a)).withColumn("_eb", ring_edges(ring_b))
    crossings = F.flatten(F.transform("_ea", lambda e: F.transform("_eb", lambda f: _crossing_height(e, f))))
    out = out.withColumn("_y", F.concat("_ya", "_yb", F.filter(crossings, lambda y: y.isNotNull())))
    out = out.withColumn("_lo", F.greatest(F.array_min("_ya"), F.array_min("_yb"))).withColumn("_hi", F.least(F.array_max("_ya"), F.array_max("_yb")))
    out = out.withColumn("_y", F.array_sort(F.array_distinct(F.filter("_y", lambda y: y.between(F.col("_lo"), F.col("_hi"))))))
    n = F.greatest(F.size("_y") - 1, F.lit(0))
    out = out.withColumn("_slabs", F.arrays_zip(F.slice("_y", 1, n).alias("lo"), F.slice("_y", 2, n).alias("hi")))
    parts = F.transform("_slabs", lambda s: (s["hi"] - s["lo"]) * _common_width(F.col("_ea"), F.col("_eb"), (s["lo"] + s["hi"]) / 2))
    area = F.when(F.col("_ya").isNotNull() & F.col("_yb").isNotNull(), F.aggregate(parts, F.lit(0.0), lambda s, v: s + v))
    return out.withColumn(into, area).drop("_ya", "_yb", "_ea", "_eb", "_y", "_lo", "_hi", "_slabs")


def _area_below(lo, hi, dy, first, cut):
    """Area of each ring at x <= ``cut``: the integral of min(x, cut) dy along its edges, which go from ``lo`` to ``hi`` either way."""
    at = np.clip(cut, lo, hi)
    mean = np.where(hi > lo, ((lo + at) / 2 * (at - lo) + at * (hi - at)) / np.where(hi > lo, hi - lo, 1), lo) + np.minimum(cut - lo, 0)
    return np.abs(np.add.reduceat(dy * mean, first))


def _cut(x, y, first, size, share, steps=24):
    """An x of each ring with at least ``share`` of its area below, found by halving."""
    after = np.arange(len(x)) + 1
    after[first + size - 1] = first
    lo, hi, dy = np.minimum(x, x[after]), np.maximum(x, x[after]), y[after] - y
    low, high = np.minimum.reduceat(x, first), np.maximum.reduceat(x, first)
    start, wanted = low.copy(), share * _area_below(lo, hi, dy, first, np.repeat(high, size))
    for _ in range(steps):
        middle = (low + high) / 2
        less = _area_below(lo, hi, dy, first, np.repeat(middle, size)) <= wanted
        low, high = np.where(less, middle, low), np.where(less, high, middle)
    return np.where(wanted > 0, high, start)


def core(ring: Column, share: float) -> Column:
    """Struct (x0, x1, y0, y1): beyond each of them lies at least ``share`` of the outline's area; NULL without one."""
    @pandas_udf("x0 double, x1 double, y0 double, y1 double")
    def cuts(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        out = np.full((len(xs), 4), np.nan)
        on = np.flatnonzero([x is not None and len(x) > 0 for x in xs])
        if len(on):
            size = np.array([len(xs.iloc[i]) for i in on])
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            x, y = (np.concatenate([c.iloc[i] for i in on]).astype(float) for c in (xs, ys))
            x0, y0 = (np.minimum.reduceat(v, first) for v in (x, y))                          # near zero, for exactness
            x, y = x - np.repeat(x0, size), y - np.repeat(y0, size)
            out[on] = np.stack([x0 + _cut(x, y, first, size, share), x0 - _cut(-x, y, first, size, share),
                                y0 + _cut(y, x, first, size, share), y0 - _cut(-y, x, first, size, share)], axis=1)
        return pd.DataFrame(out, columns=["x0", "x1", "y0", "y1"])

    return cuts(F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"]))
