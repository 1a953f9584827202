"""Totals of points per shape without a row per containment.

Equal outlines are looked at once.  Every outline is covered by quad-tree cells (``shapeindex``); a cell wholly inside adds the cell's own total,
and a border cell is split while it holds many positions.  Only the positions of the last border cells are tested one by one, so the work
follows the outlines' borders and not the number of (point, shape) pairs.  Boxes count as outlines: the even-odd test of a box is half-open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .outlines import box_ring
from .shapeindex import RATIO, cell_of, children, outline_cover, side_of

SPOTS = 8192              # positions that make a border cell split
ENTRIES = 2048            # border cells of different shapes in one task group
BLOCK = 1 << 18           # (shape, position) tests of one array operation
ROUNDS = 12               # splits below a shape's top cells
BOX = ["x0", "x1", "y0", "y1"]
_CELL = "level int, tx long, ty long, inner boolean, odd boolean, turns array<double>, edges array<double>"


def _plain(df: DataFrame, names: list[str]) -> str:
    kinds = dict(df.dtypes)
    return "".join(f"`{c}` {kinds[c]}, " for c in names)


def _cover(classes: DataFrame, keys: list[str], tile: float) -> DataFrame:
    """(keys, gid, box, cell): the cells of every outline at its own top level and, where many edges meet, below."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = [(i, c[0], c[1], c[2], c[3], c[4], c[5], [v for e in c[6] for v in e.values()])
                   for i, (xs, ys) in enumerate(zip(part["_xs"], part["_ys"])) for c in outline_cover(xs, ys, tile, None)]
            cells = pd.DataFrame(out, columns=["_i", "level", "tx", "ty", "inner", "odd", "turns", "edges"])
            own = part.drop(columns=["_xs", "_ys"]).iloc[cells["_i"].to_numpy(dtype=int)].reset_index(drop=True)
            yield pd.concat([own, cells.drop(columns="_i")], axis=1)

    held = [*keys, "gid", *BOX]
    flat = classes.select(*held, F.transform("ring", lambda p: p["x"]).alias("_xs"), F.transform("ring", lambda p: p["y"]).alias("_ys"))
    return flat.mapInPandas(rows, _plain(classes, held) + _CELL)


def _split(border: DataFrame, keys: list[str], tile: float) -> DataFrame:
    """Border cells one level down; cells outside are left out."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if part.empty:
                continue
            at, tx, ty, inner = children(*[part[c].to_numpy() for c in ("level", "tx", "ty", "odd", "turns", "edges")], tile)
            kids = part.iloc[at].reset_index(drop=True)
            yield kids.assign(level=kids["level"] - 1, tx=tx, ty=ty, inner=inner)

    return border.mapInPandas(rows, border.schema)


def _inner_in_box(cells: DataFrame, tile: float) -> DataFrame:
    """A cell is inner only where the shape's own box holds it, too."""
    side = side_of(F.col("level"), tile)
    held = ((F.col("x0") <= F.col("tx") * side) & (F.col("x1") >= (F.col("tx") + 1) * side) & (F.col("y0") <= F.col("ty") * side) & (F.col("y1") >= (F.col("ty") + 1) * side))
    return cells.withColumn("_held", held).withColumn("odd", F.col("odd") | F.col("inner")).withColumn("inner", F.col("inner") & F.col("_held")).drop("_held")


def _spots_at(spots: DataFrame, levels: list[int], tile: float) -> DataFrame:
    """Positions once a level, with their cell."""
    out = spots.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels]))).withColumn("_side", side_of(F.col("level"), tile))
    return out.withColumn("tx", cell_of(F.col("x"), F.col("_side"))).withColumn("ty", cell_of(F.col("y"), F.col("_side"))).drop("_side")


def _padded(lists: pd.Series, per: int, fill: float) -> np.ndarray:
    """Lists of ``per`` numbers an item as one array (row, item, number)."""
    n = max((len(v) // per for v in lists), default=0)
    out = np.full((len(lists), n * per), fill)
    for row, v in zip(out, lists):
        row[:len(v)] = v
    return out.reshape(len(lists), n, per)


def _tested(spots: DataFrame, border: DataFrame, keys: list[str], by: list[str], least: bool) -> DataFrame:
    """(gid, by, total) from the positions of border cells, each tested against the cell's part of the outline."""
    kind = dict(spots.dtypes)["w"]

    def kernel(points: pd.DataFrame, shapes: pd.DataFrame) -> pd.DataFrame:
        if points.empty or shapes.empty:
            return pd.DataFrame({c: [] for c in ("gid", *by, "total")})
        px, py, w = (points[c].to_numpy() for c in ("x", "y", "w"))
        code, groups = (pd.factorize(pd.MultiIndex.from_frame(points[by]), use_na_sentinel=False) if by else (np.zeros(len(points), int), [()]))
        table = np.zeros((len(points), len(groups)))
        table[np.arange(len(points)), code] = 1 if least else w
        shapes = shapes.iloc[np.argsort(shapes["edges"].map(len).to_numpy(), kind="stable")]
        step, found = max(1, BLOCK // len(points)), []
        for s in range(0, len(shapes), step):
            part = shapes.iloc[s:s + step]
            hits = np.repeat(part["odd"].to_numpy(dtype=bool)[:, None], len(points), axis=1)
            for t in _padded(part["turns"], 1, np.inf)[..., 0].T:
                hits ^= t[:, None] <= py
            for ax, ay, bx, by_ in (e.T[:, :, None] for e in _padded(part["edges"], 4, np.nan).swapaxes(0, 1)):
                hits ^= ((ay > py) != (by_ > py)) & (px < (bx - ax) * (py - ay) / (by_ - ay) + ax)
            x0, x1, y0, y1 = (part[c].to_numpy(dtype=float)[:, None] for c in BOX)
            hits &= (px >= x0) & (px < x1) & (py >= y0) & (py < y1)
            totals = hits @ table
            at = np.nonzero(totals)
            if least:
                for k in range(len(groups)):
                    totals[:, k] = np.where(hits[:, code == k], w[code == k], np.inf).min(axis=1)
            found.append((part["gid"].to_numpy()[at[0]], at[1], totals[at]))
        gid, at, total = (np.concatenate(c) for c in zip(*found))
        out = pd.DataFrame({"gid": gid})
        for i, c in enumerate(by):
            out[c] = pd.Series([groups[k][i] for k in at], dtype=object)
        return out.assign(total=total.astype(w.dtype))

    cell = [*keys, "level", "tx", "ty"]
    load = settle(border.groupBy(*cell).agg(F.ceil(F.count("*") / ENTRIES).cast("int").alias("_parts")), "border-load")
    shapes = border.join(load, cell).withColumn("_part", F.pmod(F.xxhash64("gid"), F.col("_parts")).cast("int")).drop("_parts")
    points = spots.join(load, cell).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    fresh = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])
    on = [*cell, "_part"]
    return fresh(points).groupBy(*on).cogroup(fresh(shapes).groupBy(*on)).applyInPandas(kernel, f"gid long, {_plain(spots, by)}total {kind}")


def totals_in_shapes(points: DataFrame, shapes: DataFrame, tile: float, keys: list[str] | None = None, by: list[str] | None = None,
                     least: str | None = None, spots_limit: int | None = None) -> DataFrame:
    """Rows of ``shapes`` (all columns but the outline) with ``total`` per ``by``: number of points inside or, with ``least``, the least value of that column.

    ``shapes``: x0, x1, y0, y1 and optionally ring.  Shapes without a point have no row.
    """
    keys, by, limit = keys or [], by or [], spots_limit or SPOTS
    weight = F.min(F.col(least).cast("double")) if least else F.count("*")
    at = points.select(*keys, *by, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), *([least] if least else []))
    spots = settle(at.where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").groupBy(*keys, *by, "x", "y").agg(weight.alias("w")), "spots")
    box = box_ring(*[F.col(c).cast("double") for c in BOX])
    ring = F.coalesce(F.col("ring").cast("array<struct<x:double,y:double>>"), box) if "ring" in shapes.columns else box
    rows = settle(shapes.where("x0 < x1 AND y0 < y1").withColumn("ring", ring), "shapes")
    form = [*keys, *BOX, "ring"]
    classes = settle(rows.select(*form).distinct().withColumn("gid", F.monotonically_increasing_id()), "forms")
    parts = 4 * max(spots.sparkSession.sparkContext.defaultParallelism, 1)
    cells = settle(_inner_in_box(_cover(classes.repartition(parts), keys, tile), tile), "cover")
    cell, sums, last, round_ = [*keys, "level", "tx", "ty"], [], [], 0
    join_total = F.min("w") if least else F.sum("w")
    while True:
        levels = sorted(r[0] for r in cells.select("level").distinct().collect())          # one number a level
        if not levels:
            break
        sized = settle(_spots_at(spots, levels, tile).groupBy(*cell, *by).agg(join_total.alias("w"), F.count("*").alias("_n")), "cell-totals")
        whole = cells.where("inner").select(*cell, "gid").join(sized, cell)
        sums.append(settle(whole.groupBy("gid", *by).agg(join_total.alias("total")), "inner-totals"))
        size = sized.groupBy(*cell).agg(F.sum("_n").alias("_n"))
        border = settle(cells.where("NOT inner").join(size, cell), "border")
        done = F.col("_n") <= limit if round_ < ROUNDS else F.lit(True)
        last.append(border.where(done).drop("_n", "inner"))
        more = border.where(~done).drop("_n")
        if round_ == ROUNDS or more.isEmpty():
            break
        cells, round_ = settle(_inner_in_box(_split(more.select(*cells.columns).repartition(parts), keys, tile), tile), "cover"), round_ + 1
    out = None
    for part in last:
        out = part if out is None else out.unionByName(part)
    if out is None:
        return rows.drop("ring").join(spots.select(*[c for c in by], F.col("w").alias("total")), F.lit(False))
    out = settle(out, "border-cells")
    levels = sorted(r[0] for r in out.select("level").distinct().collect())                # one number a level
    found = [_tested(_spots_at(spots, levels, tile), out, keys, by, bool(least))] if levels else []
    every = None
    for part in [*sums, *found]:
        every = part if every is None else every.unionByName(part)
    totals = every.groupBy("gid", *by).agg((F.min("total") if least else F.sum("total")).alias("total"))
    members = rows.join(classes, form).drop("ring")
    return members.join(settle(totals, "totals"), "gid").drop("gid")
