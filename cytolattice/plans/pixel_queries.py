"""Queries on pixel tables."""

from pyspark.sql import functions as F

from ..operators import pixels as P
from ..operators import tables as T
from ..session import settle
from .bindings import table, view
from .registry import CTES, query, tidy
from .spatial_queries import _SPOT, spots

PL = ["section", "channel"]
_IN_ROI = "p.x >= s.x0 AND p.x < s.x1 AND p.y >= s.y0 AND p.y < s.y1"

CTES["fx_rois"] = """SELECT n_nationkey::BIGINT AS shape_id, concat('Q', n_nationkey % 3) AS roi_name, CAST(n_nationkey * 2 AS DOUBLE) AS x0, CAST(n_nationkey * 2 + 14 AS DOUBLE) AS x1,
    CAST(n_nationkey % 5 * 11 AS DOUBLE) AS y0, CAST(n_nationkey % 5 * 11 + 9 AS DOUBLE) AS y1 FROM nation"""
CTES["hist"] = """SELECT k.section, k.channel, b AS bin, b * 128 AS lo, coalesce(n, 0) AS n FROM (SELECT DISTINCT section, channel FROM fx_pixels) k CROSS JOIN (SELECT unnest(range(0, 512)) AS b)
    LEFT JOIN (SELECT section, channel, CAST(floor(v / 128) AS BIGINT) AS bin, count(*) AS n FROM fx_pixels GROUP BY 1, 2, 3) h ON h.section = k.section AND h.channel = k.channel AND h.bin = b"""
CTES["roi_hist"] = """SELECT k.section, k.channel, b AS bin, b * 128 AS lo, coalesce(n, 0) AS n FROM (SELECT DISTINCT section, channel FROM fx_plane p JOIN fx_rois s ON p.x >= s.x0 AND p.x < s.x1 AND p.y >= s.y0 AND p.y < s.y1) k
    CROSS JOIN (SELECT unnest(range(0, 512)) AS b) LEFT JOIN (SELECT section, channel, CAST(floor(v / 128) AS BIGINT) AS bin, count(*) AS n FROM fx_plane p JOIN fx_rois s
      ON p.x >= s.x0 AND p.x < s.x1 AND p.y >= s.y0 AND p.y < s.y1 GROUP BY 1, 2, 3) h ON h.section = k.section AND h.channel = k.channel AND h.bin = b"""


def _peak_ctes(src, tag):
    CTES[f"smooth_{tag}"] = f"SELECT *, sum(n) OVER (PARTITION BY section, channel ORDER BY bin ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) / 15.0::DOUBLE AS smooth FROM {src}"
    CTES[f"peaks_{tag}"] = f"""WITH r0 AS (SELECT *, CASE WHEN lag(smooth) OVER w = smooth THEN 0 ELSE 1 END AS nw FROM smooth_{tag} WINDOW w AS (PARTITION BY section, channel ORDER BY bin)),
      r1 AS (SELECT *, sum(nw) OVER (PARTITION BY section, channel ORDER BY bin) AS run FROM r0),
      r2 AS (SELECT section, channel, run, min(bin) AS s, max(bin) AS e, any_value(smooth) AS height FROM r1 GROUP BY section, channel, run),
      r3 AS (SELECT *, lag(height) OVER w AS l, lead(height) OVER w AS r FROM r2 WINDOW w AS (PARTITION BY section, channel ORDER BY run)),
      pk AS (SELECT section, channel, s, e, height FROM r3 WHERE l < height AND r < height),
      lb AS (SELECT p.section, p.channel, p.s, coalesce(max(b.bin), -1) AS lb FROM pk p LEFT JOIN smooth_{tag} b ON b.section = p.section AND b.channel = p.channel AND b.bin < p.s AND b.smooth > p.height GROUP BY 1, 2, 3),
      rb AS (SELECT p.section, p.channel, p.s, coalesce(min(b.bin), 512) AS rb FROM pk p LEFT JOIN smooth_{tag} b ON b.section = p.section AND b.channel = p.channel AND b.bin > p.e AND b.smooth > p.height GROUP BY 1, 2, 3),
      pr AS (SELECT p.section, p.channel, p.s, p.e, any_value(p.height) AS height, any_value(p.height) - greatest(min(b.smooth) FILTER (b.bin <= p.s), min(b.smooth) FILTER (b.bin >= p.e)) AS prominence
        FROM pk p JOIN lb ON lb.section = p.section AND lb.channel = p.channel AND lb.s = p.s JOIN rb ON rb.section = p.section AND rb.channel = p.channel AND rb.s = p.s
        JOIN smooth_{tag} b ON b.section = p.section AND b.channel = p.channel AND b.bin > lb.lb AND b.bin < rb.rb GROUP BY p.section, p.channel, p.s, p.e)
      SELECT pr.section, pr.channel, CAST(floor((s + e) / 2) AS BIGINT) AS bin, height, prominence FROM pr JOIN (SELECT section, channel, max(smooth) AS top FROM smooth_{tag} GROUP BY 1, 2) t
        ON t.section = pr.section AND t.channel = pr.channel WHERE prominence >= greatest(top * 0.02, 1.0)"""
    CTES[f"ends_{tag}"] = f"""SELECT k.section, k.channel, any_value(f.bin) * 128 AS floor_peak, arg_max(p.bin, struct_pack(h := p.height, b := -p.bin)) * 128 AS bright_peak
      FROM (SELECT DISTINCT section, channel FROM {src}) k LEFT JOIN (SELECT section, channel, min(bin) AS bin FROM peaks_{tag} GROUP BY 1, 2) f ON f.section = k.section AND f.channel = k.channel
      LEFT JOIN peaks_{tag} p ON p.section = k.section AND p.channel = k.channel AND p.bin > f.bin GROUP BY k.section, k.channel"""


_peak_ctes("hist", "img")
_peak_ctes("roi_hist", "roi")


def pixels(spark, d):
    return view(spark, d, "fx_pixels")


def plane(spark, d):
    return view(spark, d, "fx_plane")


def rois(spark, d):
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select(
        k.cast("long").alias("shape_id"), F.concat(F.lit("Q"), k % 3).alias("roi_name"), (k * 2).cast("double").alias("x0"), (k * 2 + 14).cast("double").alias("x1"),
        (k % 5 * 11).cast("double").alias("y0"), (k % 5 * 11 + 9).cast("double").alias("y1"))


def hist(spark, d):
    return settle(P.intensity_histogram(pixels(spark, d), PL), "hist")


def roi_hist(spark, d):
    return settle(P.roi_histogram(plane(spark, d), rois(spark, d), 16.0), "roi-hist")


@query("intensity_histogram", "SELECT section, channel, bin, lo, n FROM hist")
def intensity_histogram(spark, d):
    return tidy(hist(spark, d))


@query("roi_histogram", "SELECT section, channel, bin, lo, n FROM roi_hist")
def roi_histogram(spark, d):
    return tidy(roi_hist(spark, d))


@query("smooth_histogram", "SELECT section, channel, bin, lo, n, round(smooth, 6) AS smooth FROM smooth_img")
def smooth_histogram(spark, d):
    return tidy(P.smooth_histogram(hist(spark, d), PL, 15))


@query("local_peaks", "SELECT section, channel, bin, round(height, 6) AS height, round(prominence, 6) AS prominence FROM peaks_img")
def local_peaks(spark, d):
    return tidy(P.local_peaks(P.smooth_histogram(hist(spark, d), PL, 15), PL))


_SPAN = "CASE WHEN bright_peak > floor_peak THEN CAST(floor(floor_peak + {f} * (bright_peak - floor_peak) + 0.5) AS BIGINT) END"


@query("span_threshold", f"""SELECT section, channel, floor_peak, bright_peak, {_SPAN.format(f=0.25)} AS chosen, f AS frac, {_SPAN.format(f='f')} AS threshold
    FROM ends_img CROSS JOIN (SELECT unnest([0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50])::DOUBLE AS f)""")
def span_threshold(spark, d):
    return tidy(P.span_threshold(P.span_ends(hist(spark, d), PL, 128, 15), PL))


@query("resolve_cut", f"""SELECT i.section, i.channel, image_cut, roi_cut, CAST(9000 AS BIGINT) AS absolute_cut, roi_cut AS chosen,
    image_cut IS NOT NULL AND roi_cut IS NOT NULL AND greatest(image_cut, roi_cut) / greatest(least(image_cut, roi_cut), 1) > 1.5 AS disagree
    FROM (SELECT section, channel, {_SPAN.format(f=0.25)} AS image_cut FROM ends_img) i LEFT JOIN (SELECT section, channel, {_SPAN.format(f=0.25)} AS roi_cut FROM ends_roi) r
    ON r.section = i.section AND r.channel = i.channel""")
def resolve_cut(spark, d):
    img, roi = (P.span_ends(h, PL, 128, 15) for h in (hist(spark, d), roi_hist(spark, d)))
    return tidy(P.resolve_cut(img, roi, PL, "roi_span", 0.25, 9000.0))


@query("robust_pixel_cut", """WITH m AS (SELECT section, channel, median(v) AS med, count(*) AS n FROM fx_pixels GROUP BY 1, 2),
    s AS (SELECT p.section, p.channel, any_value(n) AS n, any_value(med) AS med, median(abs(v - med)) AS mad FROM fx_pixels p JOIN m ON m.section = p.section AND m.channel = p.channel GROUP BY 1, 2)
    SELECT section, channel, n, round(med, 6) AS median, round(mad, 6) AS mad, round(med + 1.0 * (CAST(1.4826 AS DOUBLE) * mad), 6) AS cut FROM s""")
def robust_pixel_cut(spark, d):
    return tidy(P.robust_pixel_cut(pixels(spark, d), PL, 1.0))


CTES["otsu"] = """SELECT section, channel, arg_max(v, struct_pack(a := var, b := -v))::BIGINT AS otsu FROM (
    SELECT section, channel, v, n::DOUBLE * (tn - n) * (s / n - (ts - s) / (tn - n)) ** 2 AS var FROM (
      SELECT section, channel, v, sum(c) OVER w AS n, sum(c * v) OVER w AS s, sum(c) OVER a AS tn, sum(c * v) OVER a AS ts
      FROM (SELECT section, channel, v, count(*) AS c FROM fx_plane GROUP BY 1, 2, 3) WINDOW w AS (PARTITION BY section, channel ORDER BY v), a AS (PARTITION BY section, channel))
    WHERE tn > n) GROUP BY section, channel"""


@query("otsu_threshold", "SELECT section, channel, otsu FROM otsu")
def otsu_threshold(spark, d):
    return tidy(P.otsu_threshold(plane(spark, d), PL))


_AREA = f"""SELECT s.shape_id, s.roi_name, p.channel, any_value(c.cut) AS cut, count(*) AS n_px, count(*) FILTER (v >= cut) AS n_pos, sum(v)::DOUBLE AS intden, sum(v) FILTER (v >= cut) AS sp
    FROM fx_plane p JOIN fx_rois s ON {_IN_ROI} LEFT JOIN (SELECT 'A' AS channel, 20000 AS cut UNION ALL SELECT 'R', 30000) c ON c.channel = p.channel GROUP BY s.shape_id, s.roi_name, p.channel"""


def areas(spark, d):
    cuts = plane(spark, d).select("channel").distinct().where("channel IN ('A', 'R')").withColumn(
        "cut", F.when(F.col("channel") == "A", 20000).otherwise(30000))
    return P.area_intensity(plane(spark, d), rois(spark, d), cuts, 16.0, 0.5)


@query("area_intensity", f"""SELECT shape_id, roi_name, channel, cut::BIGINT AS cut, n_px, round(n_px * 2.5e-7::DOUBLE, 6) AS roi_area_mm2, round(CASE WHEN cut IS NOT NULL THEN n_pos * 2.5e-7::DOUBLE END, 6) AS pos_area_mm2,
    round(CASE WHEN cut IS NOT NULL THEN n_pos / n_px END, 6) AS area_frac, round(intden / n_px, 6) AS mean, round(CASE WHEN n_pos > 0 THEN sp / n_pos END, 6) AS mean_pos, intden FROM ({_AREA})""")
def area_intensity(spark, d):
    return tidy(areas(spark, d))


@query("area_pool_rollup", f"""SELECT roi_name, channel, count(*) AS n_shapes, round(sum(n_px) * 0.25::DOUBLE, 6) AS roi_area_mm2, round(sum(CASE WHEN cut IS NOT NULL THEN n_pos END) * 0.25::DOUBLE, 6) AS pos_area_mm2,
    sum(intden) AS intden, CAST(sum(n_px) AS BIGINT) AS blob_count, round(sum(CASE WHEN cut IS NOT NULL THEN n_pos END) / sum(n_px), 6) AS area_frac FROM ({_AREA}) GROUP BY roi_name, channel""")
def area_pool_rollup(spark, d):
    """A channel without a cut keeps its area and density; its positive area is NULL."""
    rows = areas(spark, d).withColumn("blob_count", F.col("n_px"))
    rows = rows.withColumn("roi_area_mm2", F.col("roi_area_mm2") * 1e6).withColumn("pos_area_mm2", F.col("pos_area_mm2") * 1e6)
    return tidy(T.area_pool_rollup(rows, ["roi_name", "channel"]))


@query("crop_coverage", """SELECT section, channel, CAST(floor(y / 16) AS BIGINT) AS ty, CAST(floor(x / 16) AS BIGINT) AS tx, round(avg((v > 20000)::INT), 6) AS frac_above, count(*) AS n FROM fx_plane GROUP BY 1, 2, 3, 4""")
def crop_coverage(spark, d):
    return tidy(P.crop_coverage(plane(spark, d), PL, 16, 20000.0))


@query("coverage_verdict", """SELECT section, channel, ty, tx, CASE WHEN f >= 0.96 THEN 'flooded' WHEN f >= 0.90 THEN 'high' WHEN f >= 0.60 THEN 'typical' WHEN f >= 0.25 THEN 'low' ELSE 'restrictive' END AS verdict
    FROM (SELECT section, channel, CAST(floor(y / 16) AS BIGINT) AS ty, CAST(floor(x / 16) AS BIGINT) AS tx, avg((v > 20000)::INT) AS f FROM fx_plane GROUP BY 1, 2, 3, 4)""")
def coverage_verdict(spark, d):
    from ..functions import coverage_band
    return tidy(P.crop_coverage(plane(spark, d), PL, 16, 20000.0).select(*PL, "ty", "tx", coverage_band("frac_above").alias("verdict")))


_TILES = """WITH e AS (SELECT section, channel, max(y) + 1 AS h, max(x) + 1 AS w, least(12, max(y) + 1, max(x) + 1) AS s FROM fx_plane GROUP BY 1, 2),
    o AS (SELECT *, unnest(range(0, w - s + 1, s // 2)) AS tx FROM (SELECT *, unnest(range(0, h - s + 1, s // 2)) AS ty FROM e)),
    c AS (SELECT o.section, o.channel, s, ty, tx, avg((v > 15000)::INT) AS score FROM o JOIN fx_plane p ON p.section = o.section AND p.channel = o.channel AND p.y >= ty AND p.y < ty + s AND p.x >= tx AND p.x < tx + s
      AND (p.y - ty) % 2 = 0 AND (p.x - tx) % 2 = 0 GROUP BY ALL HAVING avg((v > 15000)::INT) > 0.5),
    r AS (SELECT *, row_number() OVER (PARTITION BY section, channel ORDER BY score, ty, tx) - 1 AS r, count(*) OVER (PARTITION BY section, channel) AS m FROM c),
    p AS (SELECT section, channel, CASE WHEN i = k - 1 THEN m - 1 ELSE round_even(i * ((m - 1) / greatest(k - 1, 1)), 0)::BIGINT END AS r
      FROM (SELECT *, unnest(range(0, k)) AS i FROM (SELECT DISTINCT section, channel, m, least(4 * 6, m) AS k FROM r))),
    t AS (SELECT r.*, row_number() OVER (PARTITION BY r.section, r.channel ORDER BY r.r DESC) AS k FROM r JOIN p ON p.section = r.section AND p.channel = r.channel AND p.r = r.r),
    g(section, channel, k, taken) AS (SELECT section, channel, 0::BIGINT, [{'k': 0::BIGINT, 'y': -1000::BIGINT, 'x': -1000::BIGINT}] FROM e
      UNION ALL SELECT g.section, g.channel, t.k, CASE WHEN len(taken) <= 6 AND len([q FOR q IN taken IF abs(q.y - ty) < 2 * s AND abs(q.x - tx) < 2 * s]) = 0
        THEN list_append(taken, {'k': t.k, 'y': ty, 'x': tx}) ELSE taken END FROM g JOIN t ON t.section = g.section AND t.channel = g.channel AND t.k = g.k + 1),
    f AS (SELECT section, channel, arg_max(taken, k) AS taken FROM g GROUP BY 1, 2),
    n AS (SELECT t.section, t.channel, ty, tx, score, row_number() OVER (PARTITION BY t.section, t.channel ORDER BY list_contains([q.k FOR q IN taken], t.k) DESC, t.k) AS place FROM t JOIN f ON f.section = t.section AND f.channel = t.channel)
    SELECT e.section, e.channel, coalesce(place, 1) AS place, coalesce(ty, (h - s) // 2)::BIGINT AS y, coalesce(tx, (w - s) // 2)::BIGINT AS x, round(score, 6) AS score
    FROM e LEFT JOIN n ON n.section = e.section AND n.channel = e.channel WHERE coalesce(place, 1) <= 6"""


@query("spread_tiles", _TILES)
def spread_tiles(spark, d):
    return tidy(P.spread_tiles(plane(spark, d), PL, 12, 15000.0, 6, every=2))


@query("tissue_bbox", """WITH m AS (SELECT p.section, p.channel, min(floor(y / 4)) AS y0, max(floor(y / 4)) AS y1, min(floor(x / 4)) AS x0, max(floor(x / 4)) AS x1 FROM fx_plane p JOIN otsu o ON o.section = p.section AND o.channel = p.channel
      WHERE y % 4 = 0 AND x % 4 = 0 AND v > otsu GROUP BY 1, 2),
    f AS (SELECT section, channel, y0 * 4 AS y0, least(64, (y1 + 1) * 4) AS y1, x0 * 4 AS x0, least(64, (x1 + 1) * 4) AS x1 FROM m)
    SELECT section, channel, greatest(0, y0 - round_even(0.1::DOUBLE * (y1 - y0), 0))::BIGINT AS y0, least(64, y1 + round_even(0.1::DOUBLE * (y1 - y0), 0))::BIGINT AS y1,
      greatest(0, x0 - round_even(0.1::DOUBLE * (x1 - x0), 0))::BIGINT AS x0, least(64, x1 + round_even(0.1::DOUBLE * (x1 - x0), 0))::BIGINT AS x1 FROM f""")
def tissue_bbox(spark, d):
    p = plane(spark, d)
    return tidy(P.tissue_bbox(p, P.otsu_threshold(p, PL), PL, 4, 64, 64, 10.0))


# ---- stacks and tiles -------------------------------------------------------------------------------
CTES["stack"] = "SELECT section, channel, z, y, x, max(v) AS v FROM fx_pixels GROUP BY 1, 2, 3, 4, 5"
CTES["focus"] = """WITH s AS (SELECT * FROM stack WHERE y % 2 = 0 AND x % 2 = 0)
    SELECT c.section, c.channel, c.z, var_pop(coalesce(l.v, c.v) + coalesce(r.v, c.v) + coalesce(u.v, c.v) + coalesce(b.v, c.v) - 4 * c.v) AS focus FROM s c
    LEFT JOIN s l ON l.section = c.section AND l.channel = c.channel AND l.z = c.z AND l.y = c.y AND l.x = c.x - 2 LEFT JOIN s r ON r.section = c.section AND r.channel = c.channel AND r.z = c.z AND r.y = c.y AND r.x = c.x + 2
    LEFT JOIN s u ON u.section = c.section AND u.channel = c.channel AND u.z = c.z AND u.x = c.x AND u.y = c.y - 2 LEFT JOIN s b ON b.section = c.section AND b.channel = c.channel AND b.z = c.z AND b.x = c.x AND b.y = c.y + 2
    GROUP BY c.section, c.channel, c.z"""


def stack(spark, d):
    return pixels(spark, d).groupBy("section", "channel", "z", "y", "x").agg(F.max("v").alias("v"))


@query("focus_score", "SELECT section, channel, z::BIGINT AS z, round(focus, 2) AS focus FROM focus")
def focus_score(spark, d):
    return tidy(P.focus_score(stack(spark, d), 2), 2)


@query("max_projection", """WITH b AS (SELECT section, arg_max(z, struct_pack(f := focus, z := -z)) AS best_z FROM focus WHERE channel = 'A' GROUP BY section)
    SELECT k.section, k.channel, k.y::BIGINT AS y, k.x::BIGINT AS x, max(v)::BIGINT AS v FROM stack k JOIN b ON b.section = k.section
    WHERE (channel = 'A' AND z = best_z) OR channel <> 'A' GROUP BY 1, 2, 3, 4""")
def max_projection(spark, d):
    s = stack(spark, d)
    return tidy(P.max_projection(s, "A", settle(P.sharpest_plane(P.focus_score(s, 2)))))


CTES["tiled"] = """SELECT channel, section AS tile_section, concat('T', z) AS tile, z, y % 24 AS y, x % 24 AS x, max(v) AS v FROM fx_pixels GROUP BY 1, 2, 3, 4, 5, 6"""
_WT = "least(0.001::DOUBLE + 0.999::DOUBLE * least(least({i}, 23 - {i}) / 6, 1.0), 0.001::DOUBLE + 0.999::DOUBLE * least(least({j}, 23 - {j}) / 6, 1.0))"


def tiled(spark, d):
    t = pixels(spark, d).groupBy("channel", "section", "z", (F.col("y") % 24).alias("y"), (F.col("x") % 24).alias("x")).agg(F.max("v").alias("v"))
    return t.withColumn("tile", F.concat(F.lit("T"), "z")).withColumn("w", F.lit(24)).withColumn("h", F.lit(24)).withColumn(
        "x0", F.col("z") * 16).withColumn("y0", F.col("z") % 2 * 10)


@query("feathered_blend", f"""WITH t AS (SELECT tile_section AS section, channel, (z % 2) * 10 + y AS gy, z * 16 + x AS gx, v, {_WT.format(i='y', j='x')} AS w FROM tiled)
    SELECT section, channel, gy::BIGINT AS y, gx::BIGINT AS x, least(greatest(round_even(round(sum(w * v) / sum(w), 9), 0), 0), 65535)::BIGINT AS v, count(*) AS tiles FROM t GROUP BY 1, 2, 3, 4""")
def feathered_blend(spark, d):
    return tidy(P.feathered_blend(tiled(spark, d), 6))


# Gaussian of sigma 1 over offsets -4..4, borders reflected, along x and then along y of the 24 x 24 tiles.
_REFLECT = "CASE WHEN {c} + o < 0 THEN -({c} + o) - 1 WHEN {c} + o > 23 THEN 47 - ({c} + o) ELSE {c} + o END"
CTES["ff"] = f"""WITH m AS (SELECT channel, tile_section, tile, avg(v) AS m FROM tiled GROUP BY 1, 2, 3 HAVING avg(v) > 1e-6),
    f AS (SELECT t.channel, t.y, t.x, median(v / m) AS f FROM tiled t JOIN m ON m.channel = t.channel AND m.tile_section = t.tile_section AND m.tile = t.tile GROUP BY 1, 2, 3),
    k AS (SELECT o, exp(-0.5 * o * o) / sum(exp(-0.5 * o * o)) OVER () AS g FROM (SELECT unnest(range(-4, 5)) AS o)),
    r AS (SELECT a.channel, a.y, a.x, sum(g * b.f) AS f FROM f a CROSS JOIN k JOIN f b ON b.channel = a.channel AND b.y = a.y AND b.x = {_REFLECT.format(c="a.x")} GROUP BY 1, 2, 3),
    c AS (SELECT a.channel, a.y, a.x, sum(g * b.f) AS f FROM r a CROSS JOIN k JOIN r b ON b.channel = a.channel AND b.x = a.x AND b.y = {_REFLECT.format(c="a.y")} GROUP BY 1, 2, 3)
    SELECT c.channel, y, x, c.f / l AS field FROM c JOIN (SELECT channel, avg(f) AS l FROM c GROUP BY channel) a ON a.channel = c.channel"""


def field(spark, d):
    t = tiled(spark, d).withColumn("tile", F.concat_ws("/", "section", "tile"))
    return P.flat_field(t.select("channel", "tile", "y", "x", "v", "h", "w"), 1.0)


@query("flat_field", "SELECT channel, y::BIGINT AS y, x::BIGINT AS x, round(field, 6) AS field FROM ff")
def flat_field(spark, d):
    return tidy(field(spark, d))


@query("shading_correct", """SELECT t.channel, tile_section AS section, tile, t.y::BIGINT AS y, t.x::BIGINT AS x, least(greatest(round_even(round(v / field, 9), 0), 0), 65535)::BIGINT AS corrected
    FROM tiled t JOIN ff ON ff.channel = t.channel AND ff.y = t.y AND ff.x = t.x""")
def shading_correct(spark, d):
    out = P.shading_correct(tiled(spark, d), settle(field(spark, d)))
    return tidy(out.select("channel", "section", "tile", "y", "x", "corrected"))


# ---- blobs ---------------------------------------------------------------------------------------------
CTES["mask"] = "SELECT section, channel, y::BIGINT AS y, x::BIGINT AS x, y::BIGINT * 16777216 + x AS id FROM fx_plane WHERE v >= 25000"
CTES["reach"] = """SELECT section, channel, id, id AS r FROM mask UNION SELECT q.section, q.channel, q.id, n.id AS r FROM reach q JOIN mask m ON m.section = q.section AND m.channel = q.channel AND m.id = q.r
    JOIN mask n ON n.section = m.section AND n.channel = m.channel AND ((n.y = m.y AND abs(n.x - m.x) = 1) OR (n.x = m.x AND abs(n.y - m.y) = 1))"""
CTES["comp"] = "SELECT section, channel, blob, count(*) AS size, avg(id % 16777216) AS cx, avg(id // 16777216) AS cy FROM (SELECT section, channel, id, min(r) AS blob FROM reach GROUP BY 1, 2, 3) GROUP BY 1, 2, 3"


def mask(spark, d):
    return plane(spark, d).where("v >= 25000")


@query("connected_blobs", "SELECT section, channel, blob // 16777216 AS blob_y, blob % 16777216 AS blob_x, size, round(cx, 6) AS cx, round(cy, 6) AS cy FROM comp WHERE size >= 2")
def connected_blobs(spark, d):
    found = P.connected_blobs(mask(spark, d), 2)
    return tidy(found.select("section", "channel", F.col("blob.y").alias("blob_y"), F.col("blob.x").alias("blob_x"), "size", "cx", "cy"))


@query("blob_stats", """WITH s AS (SELECT section, channel, size, row_number() OVER (PARTITION BY section, channel ORDER BY size) - 1 AS i, count(*) OVER (PARTITION BY section, channel) AS n FROM comp)
    SELECT section, channel, any_value(n) AS blob_count, round(max(size) FILTER (i = floor(0.5 * (n - 1) + 0.5)) * 0.25::DOUBLE, 6) AS blob_median_um2,
      round(max(size) FILTER (i = floor(0.9 * (n - 1) + 0.5)) * 0.25::DOUBLE, 6) AS blob_p90_um2, max(size) FILTER (i = floor(0.5 * (n - 1) + 0.5)) <= 2 AS speckle FROM s GROUP BY section, channel""")
def blob_stats(spark, d):
    return tidy(P.blob_stats(P.connected_blobs(mask(spark, d)), 0.5))


CTES["omask"] = "SELECT p.section, p.channel, y::BIGINT AS y, x::BIGINT AS x, y::BIGINT * 16777216 + x AS id FROM fx_plane p JOIN otsu o ON o.section = p.section AND o.channel = p.channel WHERE v > otsu"
CTES["oreach"] = CTES["reach"].replace("reach", "oreach").replace("mask", "omask")


@query("orphan_blob_ratio", f"""WITH l AS (SELECT section, channel, id, min(r) AS blob FROM oreach GROUP BY 1, 2, 3), s AS (SELECT DISTINCT section, y * 16777216 + x AS id FROM ({_SPOT})),
    b AS (SELECT l.section, l.channel, blob, count(*) AS size, count(s.id) AS hits FROM l LEFT JOIN s ON s.section = l.section AND s.id = l.id GROUP BY 1, 2, 3 HAVING count(*) >= 3)
    SELECT section, channel, count(*) FILTER (hits = 0) AS orphans, count(*) AS blobs FROM b GROUP BY 1, 2""")
def orphan_blob_ratio(spark, d):
    p = plane(spark, d)
    return tidy(P.orphan_blob_ratio(p, settle(P.otsu_threshold(p, PL)), spots(spark, d), 3))
