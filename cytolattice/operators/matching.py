"""One-to-one matches of forms, best pair first, in blocks that do not wait for each other.

A form is a shape with the ids of all objects that have it.  A block holds every pair of its own forms; forms of other blocks are seen
where they meet one of these.  Since they have further pairs elsewhere, they may be taken at any time.  Going down the pairs in order, a
block keeps for each object whether it is surely free, perhaps free or surely taken, and accepts a pair whose sides are surely free.
What is left open goes through blocks with other borders.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle

LOAD = 1 << 19            # ids and pairs that one block may hold
LIST = 1024               # ids one form may hold; equal forms with more are several
FINEST = 12               # levels of blocks

TAKEN, PERHAPS, FREE = 0, 1, 2


def forms_of(shapes: DataFrame, limit: int | None = None) -> DataFrame:
    """Written forms of a side: id (of the form), its box and ring, ``ids`` in order."""
    form = [c for c in ("x0", "x1", "y0", "y1", "ring") if c in shapes.columns]
    shapes = shapes.where("x0 < x1 AND y0 < y1").select("id", *form)
    many = shapes.groupBy(*form).agg(F.count("*").alias("_n")).where(F.col("_n") > (limit or LIST))
    many = settle(many, "crowded")
    part = F.lit(0)
    if not many.isEmpty():
        same = [shapes[c].eqNullSafe(many[c]) for c in form]
        shapes = shapes.join(many, same, "left").select(*[shapes[c] for c in shapes.columns], "_n")
        part = F.pmod(F.xxhash64("id"), F.coalesce(F.ceil(F.col("_n") / (limit or LIST)), F.lit(1)))
    lists = shapes.groupBy(*form, part.alias("_part")).agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return settle(lists.drop("_part").withColumn("id", F.monotonically_increasing_id()), "forms")


class _Side:
    """Ids of the forms of one side in a block: their states, the first not taken and the first surely free one (-1: none)."""

    def __init__(self, ids, own):
        self.ids = ids
        self.state = [bytearray([FREE if o else PERHAPS]) * len(i) for i, o in zip(ids, own)]
        self.left = [0 if len(i) else -1 for i in ids]
        self.free = [0 if o and len(i) else -1 for i, o in zip(ids, own)]

    def after(self, form: int, at: int) -> int:
        """First id behind ``at`` that is not taken."""
        s = self.state[form]
        i, j = s.find(FREE, at + 1), s.find(PERHAPS, at + 1)
        return max(i, j) if i < 0 or j < 0 else min(i, j)

    def put(self, form: int, at: int, state: int) -> None:
        self.state[form][at] = state
        if at == self.free[form]:
            self.free[form] = self.state[form].find(FREE, at)
        if state == TAKEN and at == self.left[form]:
            self.left[form] = self.after(form, at)


def sure_pairs(a_ids, a_own, b_ids, b_own, pa, pb, frac):
    """(form, form, id, id, frac) of the pairs of a block that the greedy choice surely takes.

    Forms are given by their sorted ids and whether they are the block's own; pairs of forms by their numbers and fraction.
    """
    a, b, out = _Side(a_ids, a_own), _Side(b_ids, b_own), []
    order = np.argsort(-frac, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(frac[order])) + 1, len(order)).tolist() if len(order) else []
    pa, pb, values, start = pa[order].tolist(), pb[order].tolist(), frac[order].tolist(), 0
    for end in ends:
        near: dict[int, list[int]] = {}
        for i in range(start, end):
            f, g = pa[i], pb[i]
            if a.left[f] >= 0 and b.left[g] >= 0 and (a.free[f] >= 0 or b.free[g] >= 0):
                near.setdefault(f, []).append(g)
        value, start = values[start], end
        heap = [(a.ids[f][a.left[f]], f, a.left[f]) for f in near]
        heapq.heapify(heap)
        while heap:
            _, f, at = heapq.heappop(heap)
            first = min(((b.ids[g][b.left[g]], g) for g in near[f] if b.left[g] >= 0), default=None)
            if first is None:
                continue
            free = min(((b.ids[g][b.free[g]], g) for g in near[f] if b.free[g] >= 0), default=None)
            if a.state[f][at] == FREE:
                # It takes the first that is still free, so that one is taken afterwards whoever took it.
                a.put(f, at, PERHAPS if free is None else TAKEN)
                g = first[1]
                if first == free:
                    out.append((f, g, a.ids[f][at], first[0], value))
                    b.put(g, b.left[g], TAKEN)
                else:
                    if free is not None:
                        b.put(free[1], b.free[free[1]], PERHAPS)
                    b.put(g, b.left[g], TAKEN)
            elif free is not None:
                # If it was free, it took this one or one before.
                a.put(f, at, TAKEN)
                b.put(free[1], b.free[free[1]], PERHAPS)
            at = a.after(f, at) if free is not None else a.state[f].find(FREE, at + 1)
            if at >= 0:
                heapq.heappush(heap, (a.ids[f][at], f, at))
    return out


def _homes(forms: DataFrame, turn: int, load: int) -> DataFrame | None:
    """(side, form, home): the block of each form, split while it holds more than ``load``; None if one block holds all.

    ``forms``: side, form, x, y, load.  Later turns have other borders.
    """
    x0, x1, y0, y1, total = forms.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.sum("load")).first()
    if (total or 0) <= load:
        return None
    side = max(x1 - x0, y1 - y0) * (1 + 1e-9) or 1.0
    shift = turn * 0.6180339887 % 1
    wide = side * (2 if turn else 1)
    cell = lambda c, lo: F.floor((F.col(c) - (lo - shift * side)) / wide * F.pow(F.lit(2.0), F.col("level"))).cast("long")
    paths = forms.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(FINEST)))).withColumn("tx", cell("x", x0)).withColumn("ty", cell("y", y0))
    spot = ["level", "tx", "ty"]
    held = settle(paths.groupBy(*spot).agg(F.sum("load").alias("_held")).where((F.col("_held") <= load) | (F.col("level") == FINEST)), "blocks")
    best = paths.join(held, spot).groupBy("side", "form").agg(F.min(F.struct(*spot, "_held")).alias("_h"))
    # Forms of the finest blocks are dealt, as their middles may be one point.
    part = F.pmod(F.xxhash64("form", F.lit(turn)), F.ceil(F.col("_h._held") / load))
    # Blocks that share a number are one block.
    return settle(best.select("side", "form", F.xxhash64(*[F.col(f"_h.{c}") for c in spot], part).alias("home")), "homes")


def _sure(pairs: DataFrame, forms: DataFrame, homes: DataFrame | None, id_type: str) -> DataFrame:
    """(a, b, a_id, b_id, frac) of the pairs that are sure within their blocks."""
    if homes is None:
        here = F.lit(0).cast("long").alias("home")
        rows, members = pairs.select("a", "b", "frac", here), forms.select("side", "form", "ids", F.lit(True).alias("own"), here)
    else:
        of = lambda side, name: homes.where(F.col("side") == side).select(F.col("form").alias(side), F.col("home").alias(name))
        rows = pairs.join(of("a", "_ha"), "a").join(of("b", "_hb"), "b")
        rows = settle(rows.select("a", "b", "frac", F.explode(F.array_distinct(F.array("_ha", "_hb"))).alias("home")), "block-pairs")
        seen = rows.select(F.lit("a").alias("side"), F.col("a").alias("form"), "home").union(rows.select(F.lit("b"), "b", "home")).distinct()
        members = seen.join(forms.select("side", "form", "ids"), ["side", "form"]).join(homes.withColumnRenamed("home", "_own"), ["side", "form"])
        members = members.select("side", "form", "ids", (F.col("home") == F.col("_own")).alias("own"), "home")

    def run(block: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        sides = [members[members["side"] == s] for s in "ab"]
        at = [pd.Index(s["form"]).get_indexer(block[c]) for s, c in zip(sides, "ab")]
        held = [v for s in sides for v in ([i.tolist() for i in s["ids"]], s["own"].tolist())]
        got = pd.DataFrame(sure_pairs(*held, *at, block["frac"].to_numpy(dtype=float)), columns=["a", "b", "a_id", "b_id", "frac"])
        for side, c in zip(sides, "ab"):
            got[c] = side["form"].to_numpy()[got[c].to_numpy(dtype=int)]
        return got

    schema = f"a long, b long, a_id {id_type}, b_id {id_type}, frac double"
    members = members.withColumn("_block", F.col("home") + 0).drop("home")                 # a column of its own, not that of the pairs
    return settle(rows.groupBy("home").cogroup(members.groupBy("_block")).applyInPandas(run, schema), "matched")


def _best_of_both(pairs: DataFrame, forms: DataFrame) -> DataFrame:
    """The pairs of first ids that are the best of both their forms; there always is one."""
    head = lambda side: forms.where(F.col("side") == side).select(F.col("form").alias(side), F.element_at("ids", 1).alias(f"{side}_id"))
    rows = settle(pairs.join(head("a"), "a").join(head("b"), "b"), "heads")
    order = F.struct(-F.col("frac"), "a_id", "b_id")
    pa = rows.groupBy("a").agg(F.min_by(F.struct("b", "a_id", "b_id", "frac"), order).alias("m")).select("a", "m.*")
    pb = rows.groupBy("b").agg(F.min_by("a", order).alias("a"))
    return settle(pa.join(pb, ["a", "b"]).select("a", "b", "a_id", "b_id", "frac"), "matched")


def without_taken(forms: DataFrame, won: DataFrame, sides: str) -> DataFrame:
    """``forms`` without the ids that ``won`` has of these sides, and without forms that have none left."""
    taken = won.select(F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("form"), F.col(f"{s}_id").alias("id")) for s in sides])))
    taken = taken.groupBy("side", "form").agg(F.collect_list("id").alias("_taken"))
    forms = forms.join(taken, ["side", "form"], "left").withColumn(
        "ids", F.when(F.col("_taken").isNull(), F.col("ids")).otherwise(F.array_except("ids", "_taken"))).drop("_taken")
    return settle(forms.where(F.size("ids") > 0), "forms")


def greedy_pairs(pairs: DataFrame, a: DataFrame, b: DataFrame, load: int | None = None) -> DataFrame:
    """(a, b, a_id, b_id, frac) of the greedy choice among the ids of pairs of forms, by fraction, a_id and b_id.

    ``pairs``: a, b (ids of forms), frac.  ``a`` and ``b`` come from ``forms_of``.
    """
    load, id_type = load or LOAD, a.schema["ids"].dataType.elementType.simpleString()
    middle = [((F.col(f"{c}0") + F.col(f"{c}1")) / 2).alias(c) for c in "xy"]
    of = lambda df, side: df.select(F.lit(side).alias("side"), F.col("id").alias("form"), *middle, "ids")
    forms, done, turn = of(a, "a").unionByName(of(b, "b")), [], 0
    while not pairs.isEmpty():
        ends: Column = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("form")) for s in "ab"])
        degree = pairs.select(F.inline(ends)).groupBy("side", "form").agg(F.count("*").alias("load"))
        forms = settle(forms.join(degree, ["side", "form"]).withColumn("load", F.col("load") + F.size("ids")), "forms")
        homes = _homes(forms, turn, load)
        won = _sure(pairs, forms, homes, id_type)
        if won.isEmpty():
            won = _best_of_both(pairs, forms)
        done.append(won)
        if homes is None:
            break
        forms = without_taken(forms.drop("load"), won, "ab")
        for s in "ab":
            pairs = pairs.join(forms.where(F.col("side") == s).select(F.col("form").alias(s)), s, "left_semi")
        pairs, turn = settle(pairs.select("a", "b", "frac"), "overlaps"), turn + 1
    if not done:
        none = F.lit(None).cast(id_type)
        return pairs.select("a", "b", none.alias("a_id"), none.alias("b_id"), "frac")
    out = done[0]
    for won in done[1:]:
        out = out.unionByName(won)
    return out
