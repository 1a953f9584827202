"""Quad-tree covers of shapes and joins of boxes on cells.

Cells of level k are squares of side tile * 4^k.  A shape is listed in cells of the level at which it spans a few of them, however large
it is, so its rows do not grow with its area.  An outline's cells are split further while many of its edges pass through one:
a cell without an edge is inner (its points need no test) or left out, and a border cell carries only the edges that cross it.
To the right of a cell an outline matters only by the heights at which the parity of its edges changes there; most cancel. The test
within a cell therefore gives exactly the answer of the test against the whole outline.

A point looks its cell up once per level in use, by equi-joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from ..session import settle

RATIO, SPAN = 4, 4               # side ratio of levels; cells a shape may span at its top level
EDGE_LIMIT, DEPTH = 16, 4        # edges that make a cell split, levels below a shape's top level
LIST_LIMIT = 4096                # shapes one row of the index may list
FIRST = 32                       # shapes a cell may list before it is split, where only the first is wanted
BLOCK = 4096                     # boxes of one side that one join key may hold
COVER = ("array<struct<level:int,tx:long,ty:long,inner:boolean,odd:boolean,turns:array<double>,"
         "edges:array<struct<ax:double,ay:double,bx:double,by:double>>>>")


def level_of(extent: Column, tile: float, least: int | None = 0) -> Column:
    """Level at which an extent spans at most SPAN cells (and one more); ``least`` is the lowest level used."""
    k = F.ceil(F.log(float(RATIO), F.nullif(extent, F.lit(0.0)) / (SPAN * tile))).cast("int")
    return k if least is None else F.greatest(k, F.lit(least))


def side_of(level: Column, tile: float) -> Column:
    return F.pow(F.lit(float(RATIO)), level) * tile


def cell_of(v: Column, side: Column) -> Column:
    return F.floor(v / side)


# -- outlines --------------------------------------------------------------------------------------------------------

def _reduce(edges, turns, odd, cx0, cx1, cy0, cy1):
    """What is left of an outline for one cell: edges that cross it, heights in its band where the parity to its right changes, parity below them.

    ``edges`` (m, 4) and ``turns`` describe the outline for a band that holds the cell's.
    """
    odd ^= bool(np.count_nonzero(turns <= cy0) % 2)
    turns = turns[(turns > cy0) & (turns < cy1)]
    lo, hi = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    live = (hi > cy0) & (lo < cy1) & (hi > lo)
    edges, lo, hi = edges[live], lo[live], hi[live]
    slope = (edges[:, 2] - edges[:, 0]) / (edges[:, 3] - edges[:, 1])
    ends = np.stack([(np.clip(y, lo, hi) - edges[:, 1]) * slope + edges[:, 0] for y in (cy0, cy1)])
    slack = 1e-9 * (abs(cx0) + abs(cx1) + np.abs(edges).max(initial=0.0))
    right = ends.min(axis=0) > cx1 + slack
    crossing = ~right & (ends.max(axis=0) >= cx0 - slack)
    low, high = lo[right], hi[right]
    odd ^= bool(np.count_nonzero(low <= cy0) % 2)
    heights, times = np.unique(np.concatenate((turns, low[low > cy0], high[high < cy1])), return_counts=True)
    return edges[crossing], heights[times % 2 == 1], odd


def outline_cover(xs, ys, tile, least: int | None = 0):
    """Rows (level, tx, ty, inner, odd, turns, edges) of one closed outline; ``least`` is the lowest top level used."""
    points = np.stack([np.asarray(xs, float), np.asarray(ys, float)], axis=1)
    if len(points) < 3 or not np.isfinite(points).all():
        return []
    edges = np.concatenate((points, np.roll(points, -1, axis=0)), axis=1)
    (x0, y0), (x1, y1) = points.min(axis=0), points.max(axis=0)
    extent = max(x1 - x0, y1 - y0)
    top = int(np.ceil(np.log(extent / (SPAN * tile)) / np.log(RATIO))) if extent > 0 else 0
    top = top if least is None else max(least, top)
    side = tile * float(RATIO) ** top
    span = lambda lo, hi: range(int(np.floor(lo / side)), int(np.floor(hi / side)) + 1)
    waiting = [(top, tx, ty, edges, np.zeros(0), False) for tx in span(x0, x1) for ty in span(y0, y1)]
    out = []
    while waiting:
        level, tx, ty, near, turns, odd = waiting.pop()
        side = tile * float(RATIO) ** level
        near, turns, odd = _reduce(near, turns, odd, tx * side, (tx + 1) * side, ty * side, (ty + 1) * side)
        if not len(near) and not len(turns):
            if odd:
                out.append((level, tx, ty, True, True, [], []))
        elif len(near) > EDGE_LIMIT and level > top - DEPTH:
            waiting += [(level - 1, RATIO * tx + i, RATIO * ty + j, near, turns, odd) for i in range(RATIO) for j in range(RATIO)]
        else:
            out.append((level, tx, ty, False, odd, turns.tolist(), [dict(zip(("ax", "ay", "bx", "by"), e)) for e in near.tolist()]))
    return out


def children(level, tx, ty, odd, turns, edges, tile):
    """(row, tx, ty, inner) of the cells one level below border cells, given as arrays; cells outside are left out.

    ``edges`` holds four numbers an edge.  What describes a cell describes the cells below it, so rows need no new edges; a cell that
    no edge crosses and no bend of an edge to its right reaches lies on one side.
    """
    n, side = len(tx), tile * np.power(float(RATIO), level - 1.0)
    number = lambda lists, per: np.array([len(v) // per for v in lists], dtype=int)
    e = np.concatenate([np.asarray(v, float) for v in edges] or [np.zeros(0)]).reshape(-1, 4)
    t = np.concatenate([np.asarray(v, float) for v in turns] or [np.zeros(0)])
    at_e, at_t = np.repeat(np.arange(n), number(edges, 4)), np.repeat(np.arange(n), number(turns, 1))
    lo, hi, far = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3]), np.abs(e).max(axis=1, initial=0.0)
    slope = (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1])
    some = lambda rows, hit: np.bincount(rows, hit, minlength=n)
    out = []
    for i in range(RATIO):
        for j in range(RATIO):
            x, y = RATIO * tx + i, RATIO * ty + j
            x0, x1, y0, y1 = x * side, (x + 1) * side, y * side, (y + 1) * side
            slack = 1e-9 * (np.abs(x0) + np.abs(x1) + np.abs(y0) + np.abs(y1))
            es, a, b = slack[at_e] + 1e-9 * far, y0[at_e], y1[at_e]
            live = (hi > a - es) & (lo < b + es)
            ends = [(np.clip(v, lo, hi) - e[:, 1]) * slope + e[:, 0] for v in (a, b)]
            right = np.minimum(*ends) > x1[at_e] + es
            mixed = some(at_e, live & ((~right & (np.maximum(*ends) >= x0[at_e] - es)) | (right & ((lo > a - es) | (hi < b + es)))))
            mixed = mixed + some(at_t, (t > (y0 - slack)[at_t]) & (t < (y1 + slack)[at_t]))
            middle = (y0 + y1) / 2
            parity = odd + some(at_t, t <= middle[at_t]) + some(at_e, right & (lo <= middle[at_e]) & (hi > middle[at_e]))
            keep = np.nonzero((mixed > 0) | (parity % 2 == 1))[0]
            out.append((keep, x[keep], y[keep], (mixed == 0)[keep]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _outline_cells(ring: Column, tile: float) -> Column:
    names = ("level", "tx", "ty", "inner", "odd", "turns", "edges")

    @pandas_udf(COVER)
    def cover(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ys in batches:
            yield pd.Series([[dict(zip(names, r)) for r in outline_cover(x, y, tile)] for x, y in zip(xs, ys)], dtype=object)

    return cover(ring["x"], ring["y"])


def in_cell(s: Column, y: Column, x: Column) -> Column:
    """Even-odd test within a cell: parity to its right at height y, and the cell's own edges to the right of x."""
    def crosses(e):
        at = (e["bx"] - e["ax"]) * (y - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"]
        return ((e["ay"] > y) != (e["by"] > y)) & (x < at)
    hits = F.size(F.filter(s["edges"], crosses)) + F.size(F.filter(s["turns"], lambda t: t <= y)) + s["odd"].cast("int")
    return s["inner"] | (hits % 2 == 1)


# -- the index -------------------------------------------------------------------------------------------------------

def shape_cells(shapes: DataFrame, tile: float, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, level, tx, ty, shape): every cell of the cover of every shape, the shape as a struct with the ``order`` columns first."""
    body = [c for c in shapes.columns if c not in keys and c not in order and c != "ring"]
    held = lambda *more: F.struct(*order, *body, *more)
    span = lambda lo, hi: F.sequence(cell_of(F.col(lo), F.col("_side")), cell_of(F.col(hi), F.col("_side")))

    def boxed(rows, *more):
        rows = rows.withColumn("_level", F.coalesce(level_of(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), tile), F.lit(0)))
        rows = rows.withColumn("_side", side_of(F.col("_level"), tile))
        rows = rows.select(*keys, held(*more).alias("shape"), F.col("_level").alias("level"), "_side", "y0", "y1", F.explode(span("x0", "x1")).alias("tx"))
        return rows.select(*keys, "level", "tx", F.explode(span("y0", "y1")).alias("ty"), "shape")

    if "ring" not in shapes.columns:
        return boxed(shapes)
    whole = (F.lit(True).alias("inner"), F.lit(False).alias("odd"), F.array().cast("array<double>").alias("turns"),
             F.array().cast("array<struct<ax:double,ay:double,bx:double,by:double>>").alias("edges"))
    drawn = shapes.where("ring IS NOT NULL").select("*", F.explode(_outline_cells(F.col("ring"), tile)).alias("_c"))
    parts = [F.col(f"_c.{n}").alias(n) for n in ("inner", "odd", "turns", "edges")]
    drawn = drawn.select(*keys, F.col("_c.level").alias("level"), F.col("_c.tx").alias("tx"), F.col("_c.ty").alias("ty"), held(*parts).alias("shape"))
    return boxed(shapes.where("ring IS NULL"), *whole).unionByName(drawn)


def _first_only(rows: DataFrame, tile: float, keys: list[str], order: list[str]) -> DataFrame:
    """Cells with the shapes that can be the first for one of their points: those behind the first shape that holds the whole cell cannot.

    Cells left with more than FIRST shapes are split, down to DEPTH levels below.
    """
    spot, rank = [*keys, "level", "tx", "ty"], F.struct(*[F.col(f"shape.{c}") for c in order])
    s, ringed, done, cut = F.col("shape"), "edges" in rows.schema["shape"].dataType.fieldNames(), None, None
    for depth in range(DEPTH + 1):
        side = side_of(F.col("level"), tile)
        inner = (s["x0"] <= F.col("tx") * side) & (s["x1"] >= (F.col("tx") + 1) * side) & (s["y0"] <= F.col("ty") * side) & (s["y1"] >= (F.col("ty") + 1) * side)
        inner = inner & s["inner"] if ringed else inner
        best = settle(rows.where(inner).groupBy(*spot).agg(F.min(rank).alias("_first")), "first")
        cut = settle(rows.join(best, spot, "left").where(F.col("_first").isNull() | (rank <= F.col("_first"))).drop("_first"), "cover")
        long = settle(cut.groupBy(*spot).agg(F.count("*").alias("_n")).where(F.col("_n") > FIRST).drop("_n"), "long")
        if depth == DEPTH or long.isEmpty():
            break
        short = cut.join(long, spot, "left_anti")
        done = short if done is None else done.unionByName(short)
        open_ = cut.join(long, spot, "left_semi")
        if ringed:
            flat = F.flatten(F.transform(s["edges"], lambda e: F.array(e["ax"], e["ay"], e["bx"], e["by"])))
            kids = open_.withColumn("_c", F.explode(_children(F.col("level"), F.col("tx"), F.col("ty"), s["inner"], s["odd"], s["turns"], flat, tile)))
            kids = kids.withColumn("shape", s.withField("inner", F.col("_c.inner"))).withColumn("tx", F.col("_c.tx")).withColumn("ty", F.col("_c.ty")).drop("_c")
        else:
            kids = open_.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(RATIO * RATIO - 1))))
            kids = kids.withColumn("tx", F.col("tx") * RATIO + F.col("_c") % RATIO).withColumn("ty", F.col("ty") * RATIO + F.floor(F.col("_c") / RATIO)).drop("_c")
        side = side_of(F.col("level"), tile)
        meets = (s["x0"] <= (F.col("tx") + 1) * side) & (s["x1"] >= F.col("tx") * side) & (s["y0"] <= (F.col("ty") + 1) * side) & (s["y1"] >= F.col("ty") * side)
        rows = settle(kids.withColumn("level", (F.col("level") - 1).cast("int")).where(meets).select(*rows.columns), "cover")
    return cut if done is None else done.unionByName(cut)


def _children(level, tx, ty, inner, odd, turns, edges, tile: float) -> Column:
    """Cells one level below, as an array of structs (tx, ty, inner)."""
    @pandas_udf("array<struct<tx:long,ty:long,inner:boolean>>")
    def kids(level: pd.Series, tx: pd.Series, ty: pd.Series, inner: pd.Series, odd: pd.Series, turns: pd.Series, edges: pd.Series) -> pd.Series:
        odd = inner.to_numpy(dtype=bool) | odd.to_numpy(dtype=bool)
        at, x, y, whole = children(*[c.to_numpy() for c in (level, tx, ty)], odd, turns.to_numpy(), edges.to_numpy(), tile)
        out = [[] for _ in range(len(tx))]
        for i, a, b, w in zip(at.tolist(), x.tolist(), y.tolist(), whole.tolist()):
            out[i].append({"tx": a, "ty": b, "inner": w})
        return pd.Series(out, dtype=object)

    return kids(level, tx, ty, inner, odd, turns, edges)


def shape_index(shapes: DataFrame, tile: float, keys: list[str], order: list[str], limit: int | None = None,
                first: bool = False) -> tuple[DataFrame, list[int], bool]:
    """(written rows (keys, level, tx, ty, shapes[]) with the best first, levels in use, whether any list was split).

    With ``first``, lists hold only what can be the best shape of a point: of equal outlines the first, and nothing behind a shape that holds the cell.

    A cell that more than ``limit`` shapes reach is spread over several rows, so no list grows with the data; its points then
    meet several rows and their answers are merged.
    """
    limit = limit or LIST_LIMIT
    if first:
        form = [*keys, "x0", "x1", "y0", "y1", *(["ring"] if "ring" in shapes.columns else [])]
        rest = [c for c in shapes.columns if c not in form]
        shapes = shapes.groupBy(*form).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_s")).select(*form, "_s.*").select(*shapes.columns)
    rows = settle(shape_cells(shapes, tile, keys, order), "cover")
    if first:
        rows = settle(_first_only(rows, tile, keys, order), "cover")
    spot = [*keys, "level", "tx", "ty"]
    crowded = settle(rows.groupBy(*spot).agg(F.count("*").alias("_n")).where(F.col("_n") > limit), "crowded")
    split = not crowded.isEmpty()
    if split:
        rows = rows.join(crowded, spot, "left").withColumn(
            "_part", F.pmod(F.xxhash64("shape"), F.coalesce(F.ceil(F.col("_n") / limit), F.lit(1))))
        spot = [*spot, "_part"]
    lists = settle(rows.groupBy(*spot).agg(F.array_sort(F.collect_list("shape")).alias("shapes")).drop("_part"), "tiles")
    return lists, sorted(r[0] for r in lists.select("level").distinct().collect()), split        # one number a level


def look_up(points: DataFrame, lists: DataFrame, levels: list[int], tile: float, keys: list[str], test) -> DataFrame:
    """Points with ``hits``: the shapes of their cells that pass ``test``, best first; empty or NULL when none does."""
    out, found = points, []
    for i, level in enumerate(levels or [0]):
        side = F.lit(float(tile) * float(RATIO) ** level)
        out = out.withColumn("tx", cell_of(F.col("x"), side)).withColumn("ty", cell_of(F.col("y"), side))
        part = lists.where(F.col("level") == level).drop("level").withColumnRenamed("shapes", f"_shapes{i}")
        out = out.join(part, [*keys, "tx", "ty"], "left").drop("tx", "ty")
        found.append(F.filter(f"_shapes{i}", test))
    if len(found) == 1:
        hits = found[0]
    else:
        none = F.filter("_shapes0", lambda s: F.lit(False))
        hits = F.array_sort(F.flatten(F.filter(F.array(*found, none), lambda h: h.isNotNull())))
    return out.withColumn("hits", hits).drop(*[f"_shapes{i}" for i in range(len(found))])


# -- boxes that meet -------------------------------------------------------------------------------------------------

def meeting_boxes(a: DataFrame, b: DataFrame, tile: float, keys: list[str], box_id: str, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """Pairs (a_*, b_*) of rows of two tables whose boxes overlap with positive area, each once.

    Two boxes meet at the level of the larger one, in the cell of their overlap's lower corner.  Where more than ``block`` boxes of a table
    share a cell, they are dealt into blocks and every pair of blocks is a key of its own, so no key holds more than about
    ``block`` rows of either side.  Ids may repeat and boxes without area meet nothing.  With ``parts`` the keys are dealt into so many
    partitions whatever their bytes, for work on the pairs that costs far more than reading them.
    """
    def sized(df, tag):
        df = df.where("x0 < x1 AND y0 < y1").select(*keys, *[F.col(c).alias(f"{tag}_{c}") for c in df.columns if c not in keys])
        extent = F.greatest(F.col(f"{tag}_x1") - F.col(f"{tag}_x0"), F.col(f"{tag}_y1") - F.col(f"{tag}_y0"))
        return df.withColumn(f"_{tag}", level_of(extent, tile, None))

    left, right = sized(a, "a"), sized(b, "b")
    used = settle(left.select(F.col("_a").alias("level")).union(right.select("_b")).distinct(), "levels")
    levels = F.array(*[F.lit(r[0]) for r in used.orderBy("level").collect()]).cast("array<int>")          # one number a level

    def spread(df, tag):
        df = df.withColumn("level", F.explode(F.filter(levels, lambda k: k >= F.col(f"_{tag}")))).withColumn("_side", side_of(F.col("level"), tile))
        span = lambda c: F.sequence(cell_of(F.col(f"{tag}_{c}0"), F.col("_side")), cell_of(F.col(f"{tag}_{c}1"), F.col("_side")))
        return df.withColumn("tx", F.explode(span("x"))).withColumn("ty", F.explode(span("y"))).drop("_side")

    left, right, spot = spread(left, "a"), spread(right, "b"), [*keys, "level", "tx", "ty"]
    count = lambda df, ours: df.select(*spot, F.lit(int(ours)).alias("_x"), F.lit(int(not ours)).alias("_y"))
    need = lambda c: F.ceil(F.sum(c) / block).cast("int")
    crowded = settle(count(left, True).unionByName(count(right, False)).groupBy(*spot).agg(need("_x").alias("_na"), need("_y").alias("_nb"))
                     .where("_na > 0 AND _nb > 0 AND _na + _nb > 2"), "crowded")

    def dealt(df, tag, own, other):
        n, m = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        mine = F.pmod(F.xxhash64(*[f"{tag}_{c}" for c in (box_id, "x0", "x1", "y0", "y1")]), n).cast("int")
        out = df.join(crowded, spot, "left").withColumn(f"_p{tag}", mine)
        return out.withColumn("_pb" if tag == "a" else "_pa", F.explode(F.sequence(F.lit(0), m - 1))).drop("_na", "_nb")

    left, right = dealt(left, "a", F.col("_na"), F.col("_nb")), dealt(right, "b", F.col("_nb"), F.col("_na"))
    if parts:
        left, right = (df.repartition(parts, *spot, "_pa", "_pb") for df in (left, right))
    cx, cy, side = F.greatest("a_x0", "b_x0"), F.greatest("a_y0", "b_y0"), side_of(F.col("level"), tile)
    meet = ((F.greatest("_a", "_b") == F.col("level")) & (cx < F.least("a_x1", "b_x1")) & (cy < F.least("a_y1", "b_y1"))
            & (cell_of(cx, side) == F.col("tx")) & (cell_of(cy, side) == F.col("ty")))
    return left.join(right, [*spot, "_pa", "_pb"]).where(meet).drop("level", "tx", "ty", "_pa", "_pb", "_a", "_b")
