"""Queries on containment, overlap and neighbours."""

from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import hierarchy as H
from ..operators import markers as M
from ..operators import neighbours as N
from ..operators import rollup as R
from ..operators import spatial as S
from ..operators import tables as T
from .bindings import PANEL, table, view
from .cell_queries import cells, classed, stored_cells
from .registry import CTES, query, tidy

TILE = 2000.0
_IN = "x >= {s}.x0 AND x < {s}.x1 AND y >= {s}.y0 AND y < {s}.y1"
_IN_S = _IN.format(s="s")



def scrambled(expr):
    """SQL of the library's scramble."""
    y = f"((({expr}) * 48271 + 11) % 2147483647)"
    sq = f"(({y} * {y}) % 2147483647)"
    return f"((({sq} * {sq}) % 2147483647) * {y}) % 2147483647"


CTES["located"] = f"""SELECT c.*, (SELECT arg_min(s.region_id, struct_pack(a := (s.x1 - s.x0) * (s.y1 - s.y0), b := s.region_id)) FROM fx_shapes s
    WHERE c.x >= s.x0 AND c.x < s.x1 AND c.y >= s.y0 AND c.y < s.y1) AS region_id FROM classed c"""


def shapes(spark, d):
    return view(spark, d, "fx_shapes")


def drawn(spark, d):
    return view(spark, d, "fx_drawn")


def located(spark, d):
    return S.point_in_region(classed(spark, d), shapes(spark, d), TILE)


@query("point_in_region", "SELECT cell_id, region_id FROM located")
def point_in_region(spark, d):
    return tidy(S.point_in_region(cells(spark, d), shapes(spark, d), TILE).select("cell_id", "region_id"))


# Outlines: diamonds for odd shapes, rectangles for even ones.  Their edges pass between the cells' whole-numbered positions.
_OUTLINE = """SELECT shape_id AS region_id, x0 + 850.5::DOUBLE AS mx, y0 + 750.25::DOUBLE AS my, (850 - shape_id % 5 * 100)::DOUBLE AS h, 750::DOUBLE AS v,
    shape_id % 2 = 1 AS diamond FROM fx_drawn"""


def outlines(spark, d):
    s = drawn(spark, d).select(F.col("shape_id").alias("region_id"), (F.col("x0") + 850.5).alias("mx"), (F.col("y0") + 750.25).alias("my"),
                               (850 - F.col("shape_id") % 5 * 100).cast("double").alias("h"), F.lit(750.0).alias("v"))
    x0, x1, y0, y1 = F.col("mx") - F.col("h"), F.col("mx") + F.col("h"), F.col("my") - F.col("v"), F.col("my") + F.col("v")
    ring = lambda *at: F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in at])
    diamond = ring((x0, F.col("my")), (F.col("mx"), y0), (x1, F.col("my")), (F.col("mx"), y1))
    box = ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))
    return s.select("region_id", x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"),
                    F.when(F.col("region_id") % 2 == 1, diamond).otherwise(box).alias("ring"))


@query("point_in_outline", f"""WITH o AS ({_OUTLINE}), f AS (SELECT c.cell_id, arg_min(o.region_id, struct_pack(a := CASE WHEN diamond THEN 2 ELSE 4 END * h * v, b := o.region_id)) AS region_id
      FROM fx_cells c JOIN o ON CASE WHEN diamond THEN abs(c.x - mx) / h + abs(c.y - my) / v < 1 ELSE abs(c.x - mx) < h AND abs(c.y - my) < v END GROUP BY c.cell_id)
    SELECT c.cell_id, f.region_id FROM fx_cells c LEFT JOIN f ON f.cell_id = c.cell_id""")
def point_in_outline(spark, d):
    """Cells by the smallest outline that holds them; areas and containment are those of the outline, not of its box."""
    return S.point_in_region(cells(spark, d).select("cell_id", "x", "y"), outlines(spark, d), TILE).select("cell_id", "region_id")


@query("outline_leaf", f"""WITH o AS (SELECT *, CASE WHEN diamond THEN 2 ELSE 4 END * h * v AS area FROM ({_OUTLINE}))
    SELECT region_id FROM o b WHERE NOT EXISTS (SELECT 1 FROM o s WHERE s.area < b.area AND s.region_id <> b.region_id
      AND CASE WHEN b.diamond THEN abs(s.mx - b.mx) / b.h + abs(s.my - b.my) / b.v < 1 ELSE abs(s.mx - b.mx) < b.h AND abs(s.my - b.my) < b.v END)""")
def outline_leaf(spark, d):
    return S.geometric_leaf(outlines(spark, d), TILE)


@query("zero_leak", """SELECT section, count(*) FILTER (class <> 'Excluded') AS classified, count(*) FILTER (class <> 'Excluded' AND region_id IS NULL) AS unresolved,
    count(*) FILTER (class <> 'Excluded' AND region_id IS NOT NULL) AS own_total, 'PASS' AS status FROM located GROUP BY section""")
def zero_leak(spark, d):
    loc = located(spark, d)
    own = R.category_counts(loc.where("region_id IS NOT NULL"), PANEL, ["section", "region_id"])
    return tidy(H.zero_leak(loc, own, "anchor_count"))


@query("exclusion_semi_join", f"""SELECT section, count(*) FILTER (e) AS inside, count(*) AS n FROM (SELECT section, EXISTS (SELECT 1 FROM fx_shapes s
    WHERE s.region_id IN (SELECT acronym FROM fx_excluded) AND {_IN_S}) AS e FROM fx_cells) GROUP BY section""")
def exclusion_semi_join(spark, d):
    bad = shapes(spark, d).join(view(spark, d, "fx_excluded").withColumnRenamed("acronym", "region_id"), "region_id", "left_semi")
    hit = S.exclusion_semi_join(cells(spark, d).drop("excluded"), bad, TILE)
    return tidy(hit.groupBy("section").agg(E.count_where(F.col("excluded")).alias("inside"), F.count("*").alias("n")))


@query("geometric_leaf", """SELECT a.region_id FROM fx_shapes a WHERE NOT EXISTS (SELECT 1 FROM fx_shapes o WHERE (o.x1 - o.x0) * (o.y1 - o.y0) < (a.x1 - a.x0) * (a.y1 - a.y0)
    AND (o.x0 + o.x1) / 2 >= a.x0 AND (o.x0 + o.x1) / 2 < a.x1 AND (o.y0 + o.y1) / 2 >= a.y0 AND (o.y0 + o.y1) / 2 < a.y1)""")
def geometric_leaf(spark, d):
    return S.geometric_leaf(shapes(spark, d), TILE)


@query("leaf_annotations_only", "SELECT region_id, parent_id FROM fx_shapes WHERE region_id NOT IN (SELECT parent_id FROM fx_shapes WHERE parent_id IS NOT NULL)")
def leaf_annotations_only(spark, d):
    return S.leaf_annotations_only(shapes(spark, d)).select("region_id", "parent_id")


@query("cells_in_shape", f"SELECT shape_id, roi_name, count(*) AS n FROM fx_cells JOIN fx_drawn s ON {_IN_S} GROUP BY shape_id, roi_name")
def cells_in_shape(spark, d):
    return tidy(S.count_in_shapes(cells(spark, d).select("x", "y"), drawn(spark, d), 500.0))


@query("first_owner_shape", f"""SELECT owner, count(*) AS n FROM (SELECT (SELECT min(shape_id) FROM fx_drawn s WHERE {_IN_S}) AS owner FROM fx_cells) GROUP BY owner""")
def first_owner_shape(spark, d):
    return tidy(S.first_owner_shape(cells(spark, d), drawn(spark, d), 500.0).groupBy("owner").agg(F.count("*").alias("n")))


@query("bbox_overlap_pairs", """SELECT a.shape_id AS first, b.shape_id AS second FROM fx_drawn a JOIN fx_drawn b ON a.shape_id < b.shape_id
    AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1""")
def bbox_overlap_pairs(spark, d):
    return tidy(S.bbox_overlap_pairs(drawn(spark, d), 500.0))


@query("shape_overlap_pairs", """SELECT a.z, a.shape_id AS first, b.shape_id AS second FROM fx_drawn a JOIN fx_drawn b ON a.z = b.z AND a.shape_id < b.shape_id
    AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1""")
def shape_overlap_pairs(spark, d):
    return tidy(S.shape_overlap_pairs(drawn(spark, d), 500.0))


@query("marker_object_counts", f"SELECT shape_id, concat(marker, '_obj') AS marker, count(*) AS n FROM fx_objects JOIN fx_drawn s ON {_IN_S} GROUP BY shape_id, marker")
def marker_object_counts(spark, d):
    hit = S.count_in_shapes(view(spark, d, "fx_objects").select("marker", "x", "y"), drawn(spark, d), 500.0, ["marker"])
    return tidy(hit.select("shape_id", F.concat("marker", F.lit("_obj")).alias("marker"), "n"))


@query("overlap_share", f"""WITH s AS (SELECT shape_id, marker, count(*) AS in_shape FROM fx_objects JOIN fx_drawn s ON {_IN_S} GROUP BY shape_id, marker),
    t AS (SELECT marker, count(*) AS objects, CAST(floor(count(*) / 7) AS BIGINT) AS matched FROM fx_objects GROUP BY marker)
    SELECT shape_id, s.marker, in_shape, objects, matched, CAST(round(matched * (in_shape / objects)) AS BIGINT) AS share FROM s JOIN t ON t.marker = s.marker""")
def overlap_share(spark, d):
    obj = view(spark, d, "fx_objects")
    inside = S.count_in_shapes(obj.select("marker", "x", "y"), drawn(spark, d), 500.0, ["marker"]).select("shape_id", "marker", F.col("n").alias("in_shape"))
    totals = obj.groupBy("marker").agg(F.count("*").alias("objects"), F.floor(F.count("*") / 7).cast("long").alias("matched"))
    return tidy(T.overlap_share(inside, totals).select("shape_id", "marker", "in_shape", "objects", "matched", "share"))


_BX = "SELECT part AS id, x - r AS x0, x + r AS x1, y - r AS y0, y + r AS y1 FROM fx_objects WHERE marker = '{m}'"


def boxes(spark, d, marker):
    o = view(spark, d, "fx_objects").where(F.col("marker") == marker)
    return o.select(F.col("part").alias("id"), *[(F.col(c) + s * F.col("r")).alias(f"{c}{i}") for c in "xy" for i, s in ((0, -1), (1, 1))])


@query("greedy_overlap_match", f"""WITH a AS ({_BX.format(m='A')}), b AS ({_BX.format(m='R')}),
    c AS (SELECT a.id AS a_id, b.id AS b_id, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))
      / least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0)) AS frac FROM a JOIN b ON a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1),
    o AS (SELECT a_id, b_id, frac, row_number() OVER (ORDER BY frac DESC, a_id, b_id) AS rn FROM c WHERE frac >= 0.2),
    g AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS ua, CAST([] AS BIGINT[]) AS ub, FALSE AS hit
      UNION ALL SELECT o.rn, CASE WHEN NOT list_contains(ua, a_id) AND NOT list_contains(ub, b_id) THEN list_append(ua, a_id) ELSE ua END,
        CASE WHEN NOT list_contains(ua, a_id) AND NOT list_contains(ub, b_id) THEN list_append(ub, b_id) ELSE ub END,
        NOT list_contains(ua, a_id) AND NOT list_contains(ub, b_id) FROM g JOIN o ON o.rn = g.rn + 1)
    SELECT a_id, b_id, round(frac, 6) AS frac FROM g JOIN o ON o.rn = g.rn WHERE hit""")
def greedy_overlap_match(spark, d):
    return tidy(S.greedy_overlap_match(boxes(spark, d, "A"), boxes(spark, d, "R"), 200.0, 0.2))


# Object outlines: diamonds for odd parts, boxes for even ones.  The common width of two convex outlines is linear between the heights of their
# vertices and of the points where two of their sides meet, so the middle heights give its exact area.
_OL = """SELECT part AS id, x AS mx, y AS my, r AS h, r * 0.75 AS v, (part % 2)::DOUBLE AS d FROM fx_objects WHERE marker = '{m}'"""
_OG = f"""WITH a AS ({_OL.format(m='A')}), b AS ({_OL.format(m='R')}),
    j AS (SELECT a.id AS ia, b.id AS ib, a.mx AS ax, a.my AS ay, a.h AS ah, a.v AS av, a.d AS ad, b.mx AS bx, b.my AS "by", b.h AS bh, b.v AS bv, b.d AS bd,
      greatest(a.my - a.v, b.my - b.v) AS lo, least(a.my + a.v, b.my + b.v) AS hi FROM a JOIN b ON abs(a.mx - b.mx) < a.h + b.h AND abs(a.my - b.my) < a.v + b.v),
    s AS (SELECT unnest([-1, 1])::DOUBLE AS s), e AS (SELECT p.s AS p, q.s AS q, g.s AS g, k.s AS k FROM s p CROSS JOIN s q CROSS JOIN s g CROSS JOIN s k),
    cut AS (SELECT ia, ib, unnest([lo, hi, ay, "by"]) AS y FROM j UNION SELECT ia, ib,
      (bx + q * bh * (1 + bd * k * "by" / bv) - ax - p * ah * (1 + ad * g * ay / av)) / nullif(q * bh * bd * k / bv - p * ah * ad * g / av, 0) FROM j CROSS JOIN e),
    kept AS (SELECT j.*, y, lead(y) OVER (PARTITION BY cut.ia, cut.ib ORDER BY y) AS z FROM cut JOIN j ON j.ia = cut.ia AND j.ib = cut.ib WHERE y BETWEEN lo AND hi),
    mid AS (SELECT *, ah * (1 - ad * abs((y + z) / 2 - ay) / av) AS wa, bh * (1 - bd * abs((y + z) / 2 - "by") / bv) AS wb FROM kept WHERE z IS NOT NULL),
    c AS (SELECT ia AS a_id, ib AS b_id, round(sum((z - y) * greatest(least(ax + wa, bx + wb) - greatest(ax - wa, bx - wb), 0))
      / least(any_value((4 - 2 * ad) * ah * av), any_value((4 - 2 * bd) * bh * bv)), 9) AS frac FROM mid GROUP BY ia, ib),
    o AS (SELECT a_id, b_id, frac, row_number() OVER (ORDER BY frac DESC, a_id, b_id) AS rn FROM c WHERE frac >= 0.2),
    g AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS ua, CAST([] AS BIGINT[]) AS ub, FALSE AS hit
      UNION ALL SELECT o.rn, CASE WHEN NOT list_contains(ua, a_id) AND NOT list_contains(ub, b_id) THEN list_append(ua, a_id) ELSE ua END,
        CASE WHEN NOT list_contains(ua, a_id) AND NOT list_contains(ub, b_id) THEN list_append(ub, b_id) ELSE ub END,
        NOT list_contains(ua, a_id) AND NOT list_contains(ub, b_id) FROM g JOIN o ON o.rn = g.rn + 1)
    SELECT a_id, b_id, round(frac, 6) AS frac FROM g JOIN o ON o.rn = g.rn WHERE hit"""


def object_outlines(spark, d, marker):
    o = view(spark, d, "fx_objects").where(F.col("marker") == marker)
    x, y, h, v = F.col("x"), F.col("y"), F.col("r"), F.col("r") * 0.75
    ring = F.when(F.col("part") % 2 == 1, F.array(*[F.struct(p.alias("x"), q.alias("y")) for p, q in ((x - h, y), (x, y - v), (x + h, y), (x, y + v))]))
    return o.select(F.col("part").alias("id"), (x - h).alias("x0"), (x + h).alias("x1"), (y - v).alias("y0"), (y + v).alias("y1"), ring.alias("ring"))


@query("greedy_outline_match", _OG)
def greedy_outline_match(spark, d):
    """One-to-one matches of outlines by intersection area; a NULL ring is a box."""
    return tidy(S.greedy_overlap_match(object_outlines(spark, d, "A"), object_outlines(spark, d, "R"), 200.0, 0.2))


@query("cells_in_outline", f"""WITH o AS ({_OUTLINE}) SELECT region_id AS shape_id, count(*) AS n FROM fx_cells c JOIN o
    ON CASE WHEN diamond THEN abs(c.x - mx) / h + abs(c.y - my) / v < 1 ELSE abs(c.x - mx) < h AND abs(c.y - my) < v END GROUP BY region_id""")
def cells_in_outline(spark, d):
    """Cells in every outline, on a fine index: large outlines are listed in few cells of a higher level."""
    drawn_outlines = outlines(spark, d).withColumnRenamed("region_id", "shape_id").withColumn("roi_name", F.lit(""))
    hit = S.count_in_shapes(cells(spark, d).select("x", "y"), drawn_outlines, 50.0)
    return tidy(hit.select("shape_id", "n"))


_NN = """SELECT t.section, t.cell_id, p.activity, row_number() OVER (PARTITION BY t.cell_id ORDER BY (t.x - p.x) ** 2 + (t.y - p.y) ** 2, p.cell_id) AS rn,
    (t.x - p.x) ** 2 + (t.y - p.y) ** 2 AS d2 FROM flagged t JOIN flagged p ON p.section = t.section AND t.tagged AND NOT p.tagged"""


def flagged(spark, d):
    return M.role_flags(classed(spark, d), PANEL)


@query("knn_unlabelled", f"""SELECT section, cell_id, round(CASE WHEN count(*) = 50 THEN avg(activity::INT) END, 6) AS local_rate,
    round(CASE WHEN count(*) = 50 THEN sqrt(max(d2)) END, 6) AS kth_distance FROM ({_NN}) WHERE rn <= 50 GROUP BY section, cell_id""")
def knn_unlabelled(spark, d):
    return tidy(N.knn_unlabelled(flagged(spark, d), 50))


_SELF = """SELECT section, cell_id, CASE WHEN count(*) = 20 THEN avg(sqrt(d2)) END AS md FROM (
    SELECT a.section, a.cell_id, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS d2, row_number() OVER (PARTITION BY a.cell_id ORDER BY (a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.cell_id) AS rn
    FROM fx_cells a JOIN fx_cells b ON a.section = b.section AND a.cell_id <> b.cell_id) WHERE rn <= 20 GROUP BY section, cell_id"""


@query("knn_self", f"SELECT section, cell_id, round(md, 6) AS mean_distance FROM ({_SELF})")
def knn_self(spark, d):
    return tidy(N.knn_self(stored_cells(spark, d), 20))


@query("local_density", f"SELECT section, cell_id, round(coalesce(CASE WHEN md > 0 THEN 1 / md END, 0.0), 6) AS local_density FROM ({_SELF})")
def local_density(spark, d):
    return tidy(N.local_density(stored_cells(spark, d), 20))


_BLOB = "SELECT concat('A', 1995 + part % 7, '_s', 1 + part % 4) AS section, part * 3 + ascii(marker) % 3 AS blob_id, x, y FROM fx_objects"
_ND = f"""SELECT b.section, b.blob_id, 5.0 * sqrt(min((b.x - c.x) ** 2 + (b.y - c.y) ** 2)) AS dist FROM ({_BLOB}) b
    LEFT JOIN fx_cells c ON c.section = b.section GROUP BY b.section, b.blob_id"""


def blobs(spark, d):
    o = view(spark, d, "fx_objects")
    return o.select(F.concat(F.lit("A"), 1995 + F.col("part") % 7, F.lit("_s"), 1 + F.col("part") % 4).alias("section"),
                    (F.col("part") * 3 + F.ascii("marker") % 3).alias("blob_id"), "x", "y")


@query("nearest_within", f"SELECT section, count(*) FILTER (dist IS NULL OR dist > 600) AS orphans, count(*) AS blobs FROM ({_ND}) GROUP BY section")
def nearest_within(spark, d):
    return tidy(N.nearest_within(blobs(spark, d), cells(spark, d), 5.0, 600.0))


_ODS = ", ".join(f"round(100.0 * count(*) FILTER (dist IS NULL OR dist > {r}) / count(*), 6) AS orphan_pct_{r}" for r in (300, 450, 600, 800, 1200))


@query("orphan_radius_sweep", f"SELECT section, {_ODS}, count(*) AS blobs FROM ({_ND}) GROUP BY section")
def orphan_radius_sweep(spark, d):
    return tidy(N.orphan_radius_sweep(blobs(spark, d), cells(spark, d), 5.0, (300.0, 450.0, 600.0, 800.0, 1200.0)))


BOX_SIDES = (2500.0, 2000.0, 1800.0, 1500.0, 900.0, 600.0, 400.0)
_U = "((('0x' || substr(md5(region_id), 1, 7))::BIGINT + i * 104729 + attempt * 1299709 + 42) % 2147483647)"
_RB = f"""WITH c AS (SELECT *, {scrambled(_U)} AS u, {scrambled("((u + 1) % 2147483647)")} AS w
      FROM fx_shapes CROSS JOIN (SELECT unnest(range(0, {len(BOX_SIDES)})) AS i, unnest({list(BOX_SIDES)})::DOUBLE AS side) CROSS JOIN (SELECT unnest(range(0, 3000)) AS attempt)),
    p AS (SELECT *, x0 + floor(greatest(x1 - x0 - side, 1.0) * u / 2147483647) AS bx, y0 + floor(greatest(y1 - y0 - side, 1.0) * w / 2147483647) AS "by" FROM c),
    k AS (SELECT region_id, row_number() OVER (PARTITION BY region_id ORDER BY i, attempt) AS box, side, bx, "by" FROM p
      WHERE bx >= x0 AND bx + side < x1 AND "by" >= y0 AND "by" + side < y1 QUALIFY box <= 3)
    SELECT k.region_id, k.box, k.side, k.bx, k."by", count(c.cell_id) AS machine, round(count(c.cell_id) / (k.side * k.side / 1e6), 6) AS machine_per_mm2
    FROM k LEFT JOIN fx_cells c ON c.x >= bx AND c.x < bx + side AND c.y >= "by" AND c.y < "by" + side GROUP BY k.region_id, k.box, k.side, k.bx, k."by" """


@query("random_boxes", _RB)
def random_boxes(spark, d):
    return tidy(S.count_in_boxes(S.random_boxes(shapes(spark, d), BOX_SIDES), cells(spark, d), 500.0))


_SPOT = "SELECT concat('P', s_suppkey % 4) AS section, s_suppkey AS cell_id, CAST((s_suppkey * 37) % 64 AS BIGINT) AS x, CAST((s_suppkey * 29) % 64 AS BIGINT) AS y FROM supplier"


def spots(spark, d):
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(F.concat(F.lit("P"), k % 4).alias("section"), k.alias("cell_id"),
                                              ((k * 37) % 64).alias("x"), ((k * 29) % 64).alias("y"))


@query("annulus_background", f"""WITH s AS ({_SPOT}), p AS (SELECT DISTINCT section, x, y FROM fx_plane),
    cov AS (SELECT DISTINCT p.section, p.x, p.y FROM p JOIN s ON s.section = p.section AND sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2) <= 1),
    raw AS (SELECT s.section, s.cell_id, p.channel, avg(v) AS raw_mean FROM s JOIN fx_plane p ON p.section = s.section AND sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2) <= 1 GROUP BY ALL),
    bg AS (SELECT s.section, s.cell_id, p.channel, avg(v) AS background FROM s JOIN fx_plane p ON p.section = s.section AND sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2) > 2
        AND sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2) <= 4 WHERE NOT EXISTS (SELECT 1 FROM cov c WHERE c.section = p.section AND c.x = p.x AND c.y = p.y) GROUP BY ALL)
    SELECT raw.section, raw.cell_id, raw.channel, round(raw_mean, 6) AS raw_mean, round(background, 6) AS background, round(raw_mean - background, 6) AS bgsub
    FROM raw LEFT JOIN bg ON bg.section = raw.section AND bg.cell_id = raw.cell_id AND bg.channel = raw.channel""")
def annulus_background(spark, d):
    return tidy(S.annulus_background(spots(spark, d), view(spark, d, "fx_plane"), 1.0, 1.0, 2.0))


@query("outline_background", f"""WITH s AS ({_SPOT}), p AS (SELECT DISTINCT section, x, y FROM fx_plane),
    e AS (SELECT section, cell_id, x + unnest([-3.0, 0.0, 3.0, 0.0])::DOUBLE AS ax, y + unnest([0.0, -2.0, 0.0, 2.0])::DOUBLE AS ay, x + unnest([0.0, 3.0, 0.0, -3.0])::DOUBLE AS bx, y + unnest([-2.0, 0.0, 2.0, 0.0])::DOUBLE AS "by" FROM s),
    c AS (SELECT s.section, s.cell_id, p.x, p.y, abs(p.x + 0.5 - s.x) / 3.0 + abs(p.y + 0.5 - s.y) / 2.0 < 1 AS inside FROM s JOIN p ON p.section = s.section AND abs(p.x + 0.5 - s.x) < 7 AND abs(p.y + 0.5 - s.y) < 6),
    t AS (SELECT c.*, ax, ay, bx, "by", greatest(0, least(1, ((c.x + 0.5 - ax) * (bx - ax) + (c.y + 0.5 - ay) * ("by" - ay)) / ((bx - ax) ** 2 + ("by" - ay) ** 2))) AS u FROM c JOIN e ON e.section = c.section AND e.cell_id = c.cell_id),
    d AS (SELECT section, cell_id, x, y, any_value(inside) AS inside, sqrt(min((ax + u * (bx - ax) - x - 0.5) ** 2 + (ay + u * ("by" - ay) - y - 0.5) ** 2)) AS far FROM t GROUP BY 1, 2, 3, 4),
    raw AS (SELECT d.section, cell_id, channel, avg(v) AS raw_mean FROM d JOIN fx_plane f ON f.section = d.section AND f.x = d.x AND f.y = d.y WHERE inside GROUP BY 1, 2, 3),
    bg AS (SELECT d.section, cell_id, channel, avg(v) AS background FROM d JOIN fx_plane f ON f.section = d.section AND f.x = d.x AND f.y = d.y
      WHERE NOT inside AND far > 1.05 AND far <= 3.15 AND NOT EXISTS (SELECT 1 FROM d o WHERE o.inside AND o.section = d.section AND o.x = d.x AND o.y = d.y) GROUP BY 1, 2, 3)
    SELECT raw.section, raw.cell_id, raw.channel, round(raw_mean, 6) AS raw_mean, round(background, 6) AS background, round(raw_mean - background, 6) AS bgsub
    FROM raw LEFT JOIN bg ON bg.section = raw.section AND bg.cell_id = raw.cell_id AND bg.channel = raw.channel""")
def outline_background(spark, d):
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    ring = F.array(*[F.struct(p.alias("x"), q.alias("y")) for p, q in ((x - 3, y), (x, y - 2), (x + 3, y), (x, y + 2))])
    return tidy(S.outline_background(spots(spark, d).select("section", "cell_id", ring.alias("ring")), view(spark, d, "fx_plane"), 1.05, 2.1))


@query("double_by_containment", f"""WITH s AS ({_SPOT}) SELECT s.section, s.cell_id FROM s WHERE EXISTS (SELECT 1 FROM fx_plane p
    WHERE p.section = s.section AND p.channel = 'A' AND p.v >= 15000 AND p.x = s.x AND p.y = s.y)""")
def double_by_containment(spark, d):
    mask = view(spark, d, "fx_plane").where("channel = 'A' AND v >= 15000")
    return tidy(S.double_by_containment(spots(spark, d), mask).select("section", "cell_id"))
