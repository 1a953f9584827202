"""Containment and overlap of regions, as equi-joins on tiles.

A shape has ``x0, x1, y0, y1`` and optionally ``ring`` (array of x/y vertices).  Each cell of a quad-tree cover (``shapeindex``) lists
the shapes that reach it; a point looks up one cell a level and tests only those, so cells are neither
shuffled nor multiplied when the index is small enough for Spark to broadcast.  ``tile`` is the smallest cell's side for boxes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import count_where
from ..session import settle, settle_alone
from .draws import SCRAMBLE, scramble
from .inshapes import totals_in_shapes
from .matching import forms_of, greedy_pairs, without_taken
from .outlines import box_ring, core, ring_edges, with_intersection_area
from .shapeindex import in_cell, look_up, meeting_boxes, shape_index


MEMBERS = 1024            # ids of equal boxes in one list
RING = "array<struct<x:double,y:double>>"
FEW = 1 << 21             # pairs of boxes that meet, up to which all are compared in one step
STEPS = (1.0, 0.9, 0.8, 0.65, 0.5, 0.35)                            # least fractions of the steps before
CROWD = 1 << 14           # boxes of one side that one join key may hold; a cell with more is repeated for every such part of the other side


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd test over the ring's edges."""
    n = F.size(ring)
    edges = F.arrays_zip(ring.alias("a"), F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1)).alias("b"))

    def crosses(e):
        a, b = e["a"], e["b"]
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return F.when((a["y"] > y) != (b["y"] > y), (x < at).cast("int")).otherwise(0)

    return F.aggregate(F.transform(edges, crosses), F.lit(0), lambda s, v: s + v) % 2 == 1


def _edge_sum(ring: Column, term) -> Column:
    """Sum of ``term(a, b, a x b)`` over the ring's edges."""
    nxt = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    edges = F.arrays_zip(ring.alias("a"), nxt.alias("b"))
    cross = lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]
    return F.aggregate(F.transform(edges, lambda e: term(e["a"], e["b"], cross(e["a"], e["b"]))), F.lit(0.0), lambda s, v: s + v)


def ring_area(ring: Column) -> Column:
    """Shoelace area; NULL without a ring."""
    return F.abs(_edge_sum(ring, lambda a, b, c: c)) / 2


def ring_centre(ring: Column, axis: str) -> Column:
    """Centroid of the area along one axis; NULL without a ring or without area."""
    twice = _edge_sum(ring, lambda a, b, c: c)
    return _edge_sum(ring, lambda a, b, c: (a[axis] + b[axis]) * c) / F.nullif(3 * twice, F.lit(0.0))


def contains(shape: Column, x: Column, y: Column, ring: bool) -> Column:
    """Half-open box first, then the exact ring when the shape has one."""
    box = (x >= shape["x0"]) & (x < shape["x1"]) & (y >= shape["y0"]) & (y < shape["y1"])
    if not ring:
        return box
    return box & (shape["ring"].isNull() | in_ring(shape["ring"], x, y))


def _lookup(points: DataFrame, lists: DataFrame, levels: list[int], tile: float, keys: list[str], ring: bool) -> DataFrame:
    """Points with ``hits``: the shapes that contain them, best first (empty or NULL when none reach)."""
    x, y = F.col("x"), F.col("y")

    def test(s):
        box = (x >= s["x0"]) & (x < s["x1"]) & (y >= s["y0"]) & (y < s["y1"])
        return box & in_cell(s, y, x) if ring else box

    return look_up(points, lists, levels, tile, keys, test)


def _best(points: DataFrame, shapes: DataFrame, tile: float, keys: list[str], order: list[str], ring: bool,
          limit: int | None = None) -> DataFrame:
    """Points with ``best``: the first containing shape in ``order``, or NULL.

    Where tiles were split, positions are looked up and merged, and points join their position's
    answer: equal point rows stay, and points may have columns of any type.
    """
    lists, levels, split = shape_index(shapes, tile, keys, order, limit, first=True)
    spot = [*keys, "x", "y"]
    rows = points.select(*spot).distinct() if split else points
    hit = _lookup(rows, lists, levels, tile, keys, ring).withColumn("best", F.get("hits", F.lit(0))).drop("hits")
    if not split:
        return hit
    merged = hit.groupBy(*spot).agg(F.min("best").alias("best")).select(*[F.col(c).alias(f"_at_{c}") for c in spot], "best")
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in spot]
    return points.join(merged, same, "left").select(*points.columns, "best")


def _prepare(shapes: DataFrame, area: bool = True) -> tuple[DataFrame, bool]:
    ring = "ring" in shapes.columns
    if area and "area" not in shapes.columns:
        box = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
        shapes = shapes.withColumn("area", F.coalesce(ring_area(F.col("ring")), box) if ring else box)
    return shapes, ring


def point_in_region(points: DataFrame, shapes: DataFrame, tile: float, keys: list[str] | None = None,
                    limit: int | None = None) -> DataFrame:
    """Smallest region holding each point; NULL when none does."""
    shapes, ring = _prepare(shapes)
    hit = _best(points, shapes, tile, keys or [], ["area", "region_id"], ring, limit)
    return hit.withColumn("region_id", F.col("best.region_id")).drop("best")


def first_owner_shape(points: DataFrame, shapes: DataFrame, tile: float, keys: list[str] | None = None,
                      limit: int | None = None) -> DataFrame:
    """First shape in drawing order (``shape_id``) that holds each point."""
    shapes, ring = _prepare(shapes, area=False)
    hit = _best(points, shapes, tile, keys or [], ["shape_id"], ring, limit)
    return hit.withColumn("owner", F.col("best.shape_id")).drop("best")


def exclusion_semi_join(points: DataFrame, shapes: DataFrame, tile: float, keys: list[str] | None = None,
                        limit: int | None = None) -> DataFrame:
    """``excluded`` is true for points inside any of the shapes."""
    shapes, ring = _prepare(shapes, area=False)
    order = ["shape_id"] if "shape_id" in shapes.columns else ["region_id"]
    hit = _best(points, shapes, tile, keys or [], order, ring, limit)
    return hit.withColumn("excluded", F.col("best").isNotNull()).drop("best")


def cells_in_shape(points: DataFrame, shapes: DataFrame, tile: float, keys: list[str] | None = None,
                   limit: int | None = None) -> DataFrame:
    """One row per (point, shape) containment; a point in two shapes counts in both."""
    keys = keys or []
    shapes, ring = _prepare(shapes, area=False)
    lists, levels, _ = shape_index(shapes, tile, keys, ["shape_id"], limit)
    hit = _lookup(points, lists, levels, tile, keys, ring)
    cols = points.columns
    return hit.select(*cols, F.explode("hits").alias("s")).select(*cols, "s.shape_id", "s.roi_name")


def count_in_shapes(points: DataFrame, shapes: DataFrame, tile: float, by: list[str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Points inside every shape as ``n``, per shape_id, roi_name and the points' ``by`` columns, without a row per containment."""
    shape = [*(keys or []), "shape_id", "roi_name"]
    rings = ["ring"] if "ring" in shapes.columns else []
    inside = totals_in_shapes(points, shapes.select(*shape, "x0", "x1", "y0", "y1", *rings), tile, keys, by)
    return inside.groupBy(*shape, *(by or [])).agg(F.sum("total").alias("n"))


def geometric_leaf(shapes: DataFrame, tile: float, keys: list[str] | None = None) -> DataFrame:
    """Regions into which no smaller region's centroid falls."""
    keys = keys or []
    shapes, ring = _prepare(shapes)
    middle = lambda c: (F.col(f"{c}0") + F.col(f"{c}1")) / 2
    centre = lambda c: F.coalesce(ring_centre(F.col("ring"), c), middle(c)) if ring else middle(c)
    own = shapes.select(*keys, F.col("area").alias("small_area"), centre("x").alias("x"), centre("y").alias("y"))
    rows = shapes.select(*keys, "region_id", "area", "x0", "x1", "y0", "y1", *(["ring"] if ring else []))
    held = totals_in_shapes(own.where("small_area IS NOT NULL"), rows, tile, keys, least="small_area")
    parents = held.where(F.col("area") > F.col("total")).select(*keys, "region_id").distinct()
    return shapes.select(*keys, "region_id").join(parents, keys + ["region_id"], "left_anti")


def leaf_annotations_only(shapes: DataFrame) -> DataFrame:
    """Regions that are nobody's parent."""
    parents = shapes.where(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("region_id")).distinct()
    return shapes.join(parents, "region_id", "left_anti")


def _segments_meet(p, q, r, s) -> Column:
    """Proper or touching intersection of segments pq and rs, by orientation signs."""
    turn = lambda a, b, c: F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))
    return (turn(p, q, r) != turn(p, q, s)) & (turn(r, s, p) != turn(r, s, q))


def rings_meet(a: Column, b: Column) -> Column:
    """Any edges cross, or one ring holds a vertex of the other."""
    def close(r):
        return F.arrays_zip(r.alias("p"), F.concat(F.slice(r, 2, F.size(r) - 1), F.slice(r, 1, 1)).alias("q"))
    edge = F.exists(close(a), lambda e: F.exists(close(b), lambda f: _segments_meet(e["p"], e["q"], f["p"], f["q"])))
    return edge | in_ring(a, b[0]["x"], b[0]["y"]) | in_ring(b, a[0]["x"], a[0]["y"])


def bbox_overlap_pairs(boxes: DataFrame, tile: float, keys: list[str] | None = None, box_id: str = "shape_id", block: int | None = None) -> DataFrame:
    """Unordered pairs of boxes that overlap with positive area, and of outlines that meet where both have one.

    Boxes meet in the one cell of their overlap's lower corner, so nothing has to be deduplicated; crowded cells are joined in
    pairs of blocks of ``block`` boxes.
    """
    keys = keys or []
    extra = ["ring"] if "ring" in boxes.columns else []
    form = [*keys, "x0", "x1", "y0", "y1", *extra]
    every = settle(boxes.select(*form, box_id).where("x0 < x1 AND y0 < y1"), "boxes")
    # Equal boxes are compared once; ids come back in lists of bounded length.
    size = every.groupBy(*form).agg(F.ceil(F.count("*") / MEMBERS).alias("_lists"))
    size = settle(size.withColumn("_form", F.monotonically_increasing_id()), "forms")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in form]
    lists = every.alias("l").join(size.alias("r"), same).select("r._form", "r._lists", F.col(f"l.{box_id}").alias("_id")).withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("_lists")))
    lists = settle(lists.groupBy("_form", "_part").agg(F.collect_list("_id").alias("_ids")), "members")
    f = size.drop("_lists")
    pairs = meeting_boxes(f, f, tile, keys, "_form", **({"block": block} if block else {})).where("a__form <= b__form")
    if extra:
        pairs = pairs.where(F.col("a_ring").isNull() | F.col("b_ring").isNull() | rings_meet(F.col("a_ring"), F.col("b_ring")))
    pairs = pairs.select(*keys, "a__form", "b__form")
    for t in "ab":
        pairs = pairs.join(lists.select(F.col("_form").alias(f"{t}__form"), F.col("_ids").alias(f"_{t}")), f"{t}__form")
    twins = F.col("a__form") == F.col("b__form")
    pairs = pairs.select(*keys, twins.alias("_twins"), F.explode("_a").alias("_i"), "_b").select(*keys, "_twins", "_i", F.explode("_b").alias("_j"))
    pairs = pairs.where((F.col("_i") < F.col("_j")) | (~F.col("_twins") & (F.col("_i") > F.col("_j"))))
    return pairs.select(*keys, F.least("_i", "_j").alias("first"), F.greatest("_i", "_j").alias("second"))


def shape_overlap_pairs(shapes: DataFrame, tile: float) -> DataFrame:
    """Overlapping shapes of one plane: their pooled counts count shared cells twice."""
    return bbox_overlap_pairs(shapes, tile, ["z"])


def double_by_containment(blobs: DataFrame, mask: DataFrame) -> DataFrame:
    """Blobs whose centroid's pixel is positive in the other channel's mask."""
    at = blobs.withColumn("px", F.floor("x").cast("long")).withColumn("py", F.floor("y").cast("long"))
    pos = mask.select("section", F.col("x").cast("long").alias("px"), F.col("y").cast("long").alias("py"))
    return at.join(pos, ["section", "px", "py"], "left_semi").drop("px", "py")


def ring_offsets(inner: float, outer: float) -> list[tuple[int, int]]:
    """Pixel offsets with inner < distance <= outer; a fixed list for a fixed ring."""
    reach = int(outer) + 1
    return [(dx, dy) for dx in range(-reach, reach + 1) for dy in range(-reach, reach + 1)
            if inner < (dx * dx + dy * dy) ** 0.5 <= outer]


def _around(cells: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    pts = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets])
    return cells.select("section", "cell_id", "x", "y", F.inline(pts)).select(
        "section", "cell_id", (F.floor("x") + F.col("dx")).cast("long").alias("px"),
        (F.floor("y") + F.col("dy")).cast("long").alias("py"))


def annulus_background(cells: DataFrame, pixels: DataFrame, radius: float, gap: float, width: float) -> DataFrame:
    """Cell mean minus the mean of a ring around it, pixels of other cells removed.

    Circles stand in for outlines.  Ring and disc are fixed offset lists, so the range join is an
    equi-join on pixel positions.  ``pixels``: section, channel, x, y, v.
    """
    disc = _around(cells, ring_offsets(-1.0, radius))
    ring = _around(cells, ring_offsets(radius + gap, radius + gap + width))
    covered = disc.select("section", "px", "py").distinct()
    clean = ring.join(covered, ["section", "px", "py"], "left_anti")
    px = pixels.select("section", "channel", F.col("x").cast("long").alias("px"), F.col("y").cast("long").alias("py"), "v")
    mean = lambda spots, name: (spots.join(px, ["section", "px", "py"]).groupBy("section", "cell_id", "channel")
                                .agg(F.avg("v").alias(name)))
    raw, bg = mean(disc, "raw_mean"), mean(clean, "background")
    return raw.join(bg, ["section", "cell_id", "channel"], "left").withColumn(
        "bgsub", F.col("raw_mean") - F.col("background"))


def _edge_distance2(edges: Column, x: Column, y: Column) -> Column:
    """Squared distance of a point to the nearest edge."""
    def to(e):
        dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
        t = F.coalesce(((x - e["ax"]) * dx + (y - e["ay"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        ex, ey = e["ax"] + t * dx - x, e["ay"] + t * dy - y
        return ex * ex + ey * ey
    return F.array_min(F.transform(edges, to))


def outline_background(cells: DataFrame, pixels: DataFrame, gap: float, width: float) -> DataFrame:
    """Cell mean minus the mean of a band around its outline, pixels inside any cell removed.

    ``cells``: section, cell_id, ring.  ``pixels``: section, channel, x, y, v; a pixel lies where its middle lies.  The band holds the pixels
    outside the outline that are farther than ``gap`` and at most ``gap + width`` from its nearest edge.  A cell meets the pixels of its own
    box and band only, so the work is that of an equi-join on pixel positions.  Without a pixel in the band the background is NULL.
    """
    reach = gap + width
    # Equal outlines of a section have one answer: they are measured once.
    every = settle(cells.where("ring IS NOT NULL").select("section", "cell_id", "ring").distinct(), "outlines")
    cells = settle(every.select("section", "ring").distinct().withColumn("cell_id", F.monotonically_increasing_id()), "forms")
    members = every.join(cells.withColumnRenamed("cell_id", "_form"), ["section", "ring"]).select(F.col("section").alias("_section"), "_form", F.col("cell_id").alias("_cell"))
    at = lambda c, f: f(F.transform("ring", lambda p: p[c]))
    spots = cells.where("ring IS NOT NULL").select("section", "cell_id", ring_edges(F.col("ring")).alias("_e"), *[
        F.floor(v).cast("long").alias(n) for n, v in (("_x0", at("x", F.array_min) - reach), ("_x1", at("x", F.array_max) + reach),
                                                      ("_y0", at("y", F.array_min) - reach), ("_y1", at("y", F.array_max) + reach))])
    spots = spots.withColumn("x", F.explode(F.sequence("_x0", "_x1"))).withColumn("y", F.explode(F.sequence("_y0", "_y1")))
    px, py = F.col("x") + 0.5, F.col("y") + 0.5
    crossed = F.filter("_e", lambda e: ((e["ay"] > py) != (e["by"] > py)) & (px < (e["bx"] - e["ax"]) * (py - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"]))
    spots = settle(spots.select("section", "cell_id", "x", "y", (F.size(crossed) % 2 == 1).alias("inside"), _edge_distance2(F.col("_e"), px, py).alias("_d2")), "bands")
    disc = spots.where("inside")
    band = spots.where(~F.col("inside") & (F.col("_d2") > gap * gap) & (F.col("_d2") <= reach * reach))
    clean = band.join(disc.select("section", "x", "y").distinct(), ["section", "x", "y"], "left_anti")
    flat = pixels.select("section", "channel", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "v")
    mean = lambda part, name: part.join(flat, ["section", "x", "y"]).groupBy("section", "cell_id", "channel").agg(F.avg("v").alias(name))
    out = mean(disc, "raw_mean").join(mean(clean, "background"), ["section", "cell_id", "channel"], "left")
    out = settle(out, "backgrounds").join(members, (F.col("section") == F.col("_section")) & (F.col("cell_id") == F.col("_form")))
    return out.select("section", F.col("_cell").alias("cell_id"), "channel", "raw_mean", "background", (F.col("raw_mean") - F.col("background")).alias("bgsub"))


BOX_LADDER = (150.0, 120.0, 100.0, 80.0, 60.0, 50.0, 40.0)          # micrometres, largest first
FIRST_ATTEMPTS, GROWTH = 64, 8


def _box_candidates(shapes: DataFrame, step: int, side: float, first: int, last: int, seed: int) -> DataFrame:
    """Attempts ``first`` to ``last`` at boxes of one side whose four corners lie inside their region."""
    ring = "ring" in shapes.columns
    own = F.conv(F.substring(F.md5(F.col("region_id").cast("string")), 1, 7), 16, 10).cast("long")
    tries = shapes.withColumn("attempt", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last - 1).cast("long"))))
    u = scramble((own + step * 104729 + F.col("attempt") * 1299709 + seed) % SCRAMBLE)
    tries = tries.withColumn("_u", u).withColumn("_w", scramble((F.col("_u") + 1) % SCRAMBLE))
    at = lambda c, draw: F.col(f"{c}0") + F.floor(F.greatest(F.col(f"{c}1") - F.col(f"{c}0") - side, F.lit(1.0)) * F.col(draw) / SCRAMBLE)
    tries = tries.withColumn("bx", at("x", "_u")).withColumn("by", at("y", "_w"))
    shape = F.struct("x0", "x1", "y0", "y1", *(["ring"] if ring else []))
    inside = F.lit(True)
    for dx, dy in ((0, 0), (1, 0), (0, 1), (1, 1)):
        inside = inside & contains(shape, F.col("bx") + dx * side, F.col("by") + dy * side, ring)
    return tries.where(inside).select("region_id", F.lit(step).alias("step"), "attempt", F.lit(float(side)).alias("side"), "bx", "by")


def random_boxes(shapes: DataFrame, sides: tuple[float, ...] = BOX_LADDER, per_region: int = 3, attempts: int = 3000, seed: int = 42) -> DataFrame:
    """Seeded square boxes fully inside each region, largest side first.

    Rejection sampling in rounds: only regions that still lack boxes try again, GROWTH times as often each time, up to ``attempts`` a side, then with
    the next side.  Draws depend on the region's id alone, so a region's boxes are those a sequential search would take.
    """
    shapes = settle(shapes.select("region_id", "x0", "x1", "y0", "y1", *(["ring"] if "ring" in shapes.columns else [])), "box-regions")
    order = W.partitionBy("region_id").orderBy("step", "attempt")
    taken = settle(_box_candidates(shapes, 0, 1.0, 0, 1, seed).where(F.lit(False)), "boxes")
    for step, side in enumerate(sides):
        # A box never fits where the side is not below both extents.
        first, size, fits = 0, FIRST_ATTEMPTS, shapes.where((F.col("x1") - F.col("x0") > side) & (F.col("y1") - F.col("y0") > side))
        while first < attempts:
            full = taken.groupBy("region_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= per_region)
            open_ = fits.join(full, "region_id", "left_anti")
            if open_.isEmpty():
                break
            last = min(attempts, first + size)
            got = taken.unionByName(_box_candidates(open_, step, side, first, last, seed))
            taken = settle(got.withColumn("box", F.row_number().over(order)).where(F.col("box") <= per_region).drop("box"), "boxes")
            first, size = last, GROWTH * size
    return taken.select("region_id", F.row_number().over(order).cast("long").alias("box"), "side", "bx", "by")


def count_in_boxes(boxes: DataFrame, points: DataFrame, tile: float) -> DataFrame:
    """Machine count per box and per square millimetre of it (side in micrometres)."""
    ids = boxes.withColumn("shape_id", F.concat_ws("/", "region_id", "box"))
    shapes = ids.select("shape_id", F.lit("").alias("roi_name"), F.col("bx").alias("x0"), (F.col("bx") + F.col("side")).alias("x1"),
                        F.col("by").alias("y0"), (F.col("by") + F.col("side")).alias("y1"))
    n = count_in_shapes(points.select("x", "y"), shapes, tile).select("shape_id", F.col("n").alias("machine"))
    out = ids.join(n, "shape_id", "left").withColumn("machine", F.coalesce("machine", F.lit(0)).cast("long"))
    return out.select("region_id", "box", "side", "bx", "by", "machine",
                      (F.col("machine") / (F.col("side") * F.col("side") / 1e6)).alias("machine_per_mm2"))


def _measured(df: DataFrame, ringed: bool, share: float) -> DataFrame:
    """Forms with ``area`` and the box beyond each side of which at least ``share`` of it lies (``core_x0`` to ``core_y1``)."""
    ends = ("x0", "x1", "y0", "y1")
    width = lambda c: F.col(f"{c}1") - F.col(f"{c}0")
    inner = {f"{c}{i}": F.col(f"{c}{i}") + (1 - 2 * i) * share * width(c) for c in "xy" for i in (0, 1)}
    if not ringed:
        return df.select("id", *ends, (width("x") * width("y")).alias("area"), *[inner[e].alias(f"core_{e}") for e in ends])
    ring = F.col("ring") if "ring" in df.columns else F.lit(None).cast(RING)
    out = df.select("id", *ends, ring.alias("ring")).withColumn("_core", core(F.col("ring"), share))
    own = lambda e: F.when(F.col("ring").isNull(), inner[e]).otherwise(F.col(f"_core.{e}"))
    out = out.select("id", *ends, "ring", F.coalesce(ring_area(F.col("ring")), width("x") * width("y")).alias("area"), *[own(e).alias(f"core_{e}") for e in ends])
    return settle(out, "measured")


def _overlaps(a: DataFrame, b: DataFrame, tile: float, min_frac: float, digits: int, block: int | None) -> DataFrame:
    """(a_id, b_id, frac): pairs with at least ``min_frac`` of the smaller area in common.  Only pairs with an outline are cut into slabs."""
    ringed, slack = "ring" in a.columns or "ring" in b.columns, 1e-6 + 0.5 * 10.0 ** -digits
    spark = a.sparkSession
    parts = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    j = meeting_boxes(*[_measured(df, ringed, 1 - min_frac + slack) for df in (a, b)], tile, [], "id", block or CROWD, parts)
    common = (F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")) * (F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0"))
    # The smaller outline without what may be missing lies in the box of the other; the boxes' common area bounds that of the outlines.
    within = lambda s, t: ((F.col(f"{t}_x0") <= F.col(f"{s}_core_x0")) & (F.col(f"{t}_x1") >= F.col(f"{s}_core_x1"))
                           & (F.col(f"{t}_y0") <= F.col(f"{s}_core_y0")) & (F.col(f"{t}_y1") >= F.col(f"{s}_core_y1")))
    j = j.where(((F.col("a_area") <= F.col("b_area")) & within("a", "b")) | ((F.col("a_area") > F.col("b_area")) & within("b", "a")))
    j = j.where(common >= (min_frac - slack) * F.least("a_area", "b_area"))
    if ringed:
        # Cut where they meet: a row costs far more than its bytes tell, and outlines of pairs are not shuffled.
        some = F.col("a_ring").isNotNull() | F.col("b_ring").isNotNull()
        for t in "ab":
            whole = F.coalesce(f"{t}_ring", box_ring(*[F.col(f"{t}_{c}") for c in ("x0", "x1", "y0", "y1")]))
            j = j.withColumn(f"_{t}", F.when(some, whole))
        j = with_intersection_area(j, F.col("_a"), F.col("_b"), "_common")
        common = F.coalesce("_common", common)
    frac = F.round(common / F.nullif(F.least("a_area", "b_area"), F.lit(0.0)), digits)
    # Written before the filter: pushed below it, the area would be computed anew for every comparison.
    return settle(j.select("a_id", "b_id", frac.alias("frac")), "overlaps").where((F.col("frac") >= min_frac) & (F.col("frac") > 0))


def _meetings(a: DataFrame, b: DataFrame, tile: float) -> float:
    """About how many pairs of boxes meet: products of their numbers in cells as wide as a box, one number."""
    wide = F.greatest(F.lit(float(tile)), *[F.avg(F.col(f"{c}1") - F.col(f"{c}0")) for c in "xy"]).alias("wide")
    wide = max(df.agg(wide).first()["wide"] for df in (a, b))
    cells = lambda df, n: df.select(*[F.floor(F.col(f"{c}0") / wide).alias(c) for c in "xy"]).groupBy("x", "y").agg(F.count("*").cast("double").alias(n))
    return cells(a, "n").join(cells(b, "m"), ["x", "y"]).agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0.0


def greedy_overlap_match(a: DataFrame, b: DataFrame, tile: float, min_frac: float, digits: int = 9, block: int | None = None,
                         load: int | None = None, limit: int | None = None, few: int | None = None) -> DataFrame:
    """One-to-one pairs of shapes, best overlap first: area in common over the smaller area.

    Both sides: id (one row each), x0, x1, y0, y1 and, for outlines, ring (NULL for a box).  Fractions are compared to ``digits`` digits, then
    by ids.  Equal shapes of a side are compared once, with at most ``limit`` ids a list; the choice is made in blocks of about ``load`` ids and pairs.
    While more than ``few`` pairs of boxes meet, only pairs of large fractions are listed: a choice among them is final, and shapes it takes
    have no pairs in the next, lower step.
    """
    a, b, found = forms_of(a, limit), forms_of(b, limit), []
    for least in [*(s for s in STEPS if s > min_frac), min_frac]:
        if least > min_frac and _meetings(a, b, tile) <= (FEW if few is None else few):
            continue
        pairs = lambda: _overlaps(a, b, tile, least, digits, block).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "frac")  # noqa: B023, E731
        won = settle_alone(a.sparkSession, lambda: greedy_pairs(pairs(), a, b, load), "matched")  # noqa: B023
        found.append(won.select("a_id", "b_id", "frac"))
        if least > min_frac:
            a, b = (without_taken(df.select(F.lit(s).alias("side"), F.col("id").alias("form"), *[c for c in df.columns if c != "id"]), won, s)
                    .drop("side").withColumnRenamed("form", "id") for df, s in ((a, "a"), (b, "b")))
    out = found[0]
    for won in found[1:]:
        out = out.unionByName(won)
    return out
