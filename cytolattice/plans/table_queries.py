"""Queries on gates, the reference table, hand counts, calibration, manual shapes and datasets."""

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import gates as G
from ..operators import markers as M
from ..operators import rollup as R
from ..operators import tables as T
from ..session import scratch_path, settle
from ..sources import writers as S
from .bindings import BANDS, K, PANEL, table, view
from .cell_queries import LADDER, _AT_K_OUT, _COND, cells, classed, stored_cells
from .region_queries import closure
from .registry import query, tidy

GATE_BANDS = replace(BANDS, k_values=LADDER, advisory=("ventricle_density", "k_swing_pp"))


def raw(spark, d):
    return view(spark, d, "fx_raw_regions")


def ref(spark, d):
    return S.keep_last(view(spark, d, "fx_reference"), ["config_tag", "slice", "region", "marker", "class"], "seq")


# ---- gates ------------------------------------------------------------------------------------
_MODE5 = """SELECT section, bin * 5 + 2.5::DOUBLE AS mode FROM (SELECT section, least(floor(v / 5), ceil((least(mx, 600.0) + 5) / 5) - 2) AS bin, count(*) AS n
      FROM (SELECT section, nucleus_area_um2 AS v, max(nucleus_area_um2) OVER (PARTITION BY section) AS mx FROM fx_cells WHERE nucleus_area_um2 > 0)
      WHERE v <= (ceil((least(mx, 600.0) + 5) / 5) - 1) * 5 GROUP BY section, bin)
    QUALIFY row_number() OVER (PARTITION BY section ORDER BY n DESC, bin) = 1"""
_RD = """SELECT section, acronym, CAST(sum(cnt) AS BIGINT) AS cnt, sum(area_mm2) AS area_mm2, sum(cnt) / sum(area_mm2) AS density
    FROM fx_raw_regions GROUP BY section, acronym"""
_SEC = "SELECT DISTINCT section FROM fx_raw_regions"
_WM = f"""SELECT s.section, max(density) FILTER (acronym IN ('cc', 'int', 'fiber tracts')) AS v, avg(density) FILTER (acronym = 'Isocortex') AS cortex
    FROM ({_SEC}) s LEFT JOIN ({_RD}) r ON r.section = s.section GROUP BY s.section"""
_GREY = f"""SELECT s.section, median(density) AS med, count(density) AS present, count(*) FILTER (density BETWEEN 1600 AND 5800) AS in_band,
    stddev_pop(density) / avg(density) AS cv FROM ({_SEC}) s LEFT JOIN (SELECT * FROM ({_RD}) WHERE acronym IN
    ('Isocortex', 'CA1', 'CA3', 'DG', 'TH', 'HY', 'STR', 'MB')) r ON r.section = s.section GROUP BY s.section"""
_PF = "CASE WHEN {c} IS NULL THEN 'N/A' WHEN {c} THEN 'PASS' ELSE 'FLAG' END"


def _pf(cond):
    return _PF.format(c=f"({cond})")


_G = {
    "nucleus_area_peak_um2": f"SELECT section, mode AS value, {_pf('mode BETWEEN 25 AND 150')} AS status, FALSE AS advisory FROM ({_MODE5})",
    "k_swing_pp": f"""SELECT section, (max(rate) - min(rate)) * 100 AS value, {_pf('(max(rate) - min(rate)) * 100 <= 10')} AS status, TRUE AS advisory
        FROM (SELECT section, CASE WHEN denom > 0 THEN numer / denom END AS rate FROM ({_COND})) GROUP BY section""",
    "white_matter_density": f"""SELECT section, v AS value, CASE WHEN v IS NULL THEN 'N/A' WHEN coalesce(v > 1.6 * cortex, FALSE) AND coalesce(cortex > 0, FALSE)
        THEN 'FLAG' ELSE 'PASS' END AS status, FALSE AS advisory FROM ({_WM})""",
    "ventricle_density": f"""SELECT s.section, max(density) AS value, 'N/A' AS status, TRUE AS advisory FROM ({_SEC}) s
        LEFT JOIN (SELECT * FROM ({_RD}) WHERE acronym = 'VS') r ON r.section = s.section GROUP BY s.section""",
    "grey_density_median": f"SELECT section, med AS value, {_pf('med BETWEEN 1600 AND 5800')} AS status, TRUE AS advisory FROM ({_GREY})",
    "grey_contrast_cv": f"""SELECT section, CASE WHEN present >= 3 THEN cv END AS value,
        {_pf('CASE WHEN present >= 3 THEN cv END >= 0.08')} AS status, TRUE AS advisory FROM ({_GREY})""",
    "total_density": f"""SELECT s.section, density AS value, {_pf('density BETWEEN 2800 AND 4600')} AS status, FALSE AS advisory FROM ({_SEC}) s
        LEFT JOIN (SELECT * FROM ({_RD}) WHERE acronym = 'root') r ON r.section = s.section""",
}


def _one(g):
    return f"SELECT section, '{g}' AS gate, round(value, 6) AS value, status, advisory FROM ({_G[g]})"


@query("gate_area_peak", _one("nucleus_area_peak_um2"))
def gate_area_peak(spark, d):
    return tidy(G.gate_area_peak(cells(spark, d), GATE_BANDS))


@query("gate_k_stability", _one("k_swing_pp"))
def gate_k_stability(spark, d):
    return tidy(G.gate_k_stability(stored_cells(spark, d), PANEL, GATE_BANDS, "fos", "tdt"))


@query("gate_white_matter", _one("white_matter_density"))
def gate_white_matter(spark, d):
    return tidy(G.gate_white_matter(raw(spark, d), GATE_BANDS))


@query("gate_ventricle", _one("ventricle_density"))
def gate_ventricle(spark, d):
    return tidy(G.gate_ventricle(raw(spark, d), GATE_BANDS))


@query("gate_grey_density", _one("grey_density_median"))
def gate_grey_density(spark, d):
    return tidy(G.gate_grey_density(raw(spark, d), GATE_BANDS))


@query("gate_grey_contrast", _one("grey_contrast_cv"))
def gate_grey_contrast(spark, d):
    return tidy(G.gate_grey_contrast(raw(spark, d), GATE_BANDS))


@query("gate_total_density", _one("total_density"))
def gate_total_density(spark, d):
    return tidy(G.gate_total_density(raw(spark, d), GATE_BANDS))


_ROWS = " UNION ALL ".join(_one(g).replace("round(value, 6) AS value", "value") for g in G.GATES)
_TABLE_COLS = ", ".join(
    f"round(max(value) FILTER (gate = '{g}'), 6) AS {g}, coalesce(max(status) FILTER (gate = '{g}'), 'N/A') AS {g}_status" for g in G.GATES)


def gate_table_df(spark, d):
    return G.gate_table(G.gate_rows(stored_cells(spark, d), raw(spark, d), PANEL, GATE_BANDS, "fos", "tdt"))


_OVERALL = """CASE WHEN bool_or(status = 'FLAG' AND NOT advisory) THEN 'FLAG' ELSE 'PASS' END"""


@query("gate_table", f"""SELECT section, {_TABLE_COLS}, {_OVERALL} AS overall,
    coalesce(string_agg(CASE WHEN status = 'FLAG' AND NOT advisory THEN gate END, ', ' ORDER BY gate), '') AS flagged FROM ({_ROWS}) GROUP BY section""")
def gate_table(spark, d):
    return tidy(gate_table_df(spark, d))


_VIEW_COLS = ", ".join(
    f"concat(coalesce(format('{{:,.1f}}', max(value) FILTER (gate = '{g}')), 'n/a'), ' (', coalesce(max(status) FILTER (gate = '{g}'), 'N/A'), ')') AS {g}" for g in G.GATES)


@query("gate_summary_view", f"SELECT section, {_VIEW_COLS}, {_OVERALL} AS overall FROM ({_ROWS}) GROUP BY section")
def gate_summary_view(spark, d):
    return G.gate_summary_view(gate_table_df(spark, d))


@query("density_matrix", f"""WITH p AS (SELECT section, max(density) FILTER (acronym = 'Isocortex') AS isocortex, max(density) FILTER (acronym = 'cc') AS cc,
      max(density) FILTER (acronym = 'int') AS int_, max(density) FILTER (acronym = 'fiber tracts') AS fiber_tracts, max(density) FILTER (acronym = 'VS') AS vs
      FROM ({_RD}) WHERE acronym IN ('Isocortex', 'cc', 'int', 'fiber tracts', 'VS') GROUP BY section)
    SELECT section, round(isocortex, 6) AS isocortex, round(cc, 6) AS cc, round(int_, 6) AS "int", round(fiber_tracts, 6) AS fiber_tracts,
      round(vs, 6) AS vs, round((SELECT avg(isocortex) * 1.6 FROM p), 6) AS limit_line FROM p""")
def density_matrix(spark, d):
    return tidy(G.density_matrix(raw(spark, d), BANDS))


@query("histogram_mode", """SELECT section, floor(nucleus_area_um2 / 10) * 10.0::DOUBLE AS mode, count(*) AS mode_count,
    any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY section) AS n FROM fx_cells) GROUP BY section, floor(nucleus_area_um2 / 10)
    QUALIFY row_number() OVER (PARTITION BY section ORDER BY count(*) DESC, floor(nucleus_area_um2 / 10)) = 1""")
def histogram_mode(spark, d):
    return tidy(G.histogram_mode(cells(spark, d), ["section"], "nucleus_area_um2", 10.0, midpoint=False))


@query("area_stats", """WITH b AS (SELECT animal, floor(nucleus_area_um2 / 10) * 10.0::DOUBLE AS b, count(*) AS c FROM fx_cells GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY animal ORDER BY count(*) DESC, b) = 1),
    m AS (SELECT animal, avg(nucleus_area_um2) AS mu, count(*) AS n, quantile_cont(nucleus_area_um2, 0.25) AS q1, median(nucleus_area_um2) AS md,
      quantile_cont(nucleus_area_um2, 0.75) AS q3 FROM fx_cells GROUP BY animal),
    s AS (SELECT c.animal, avg((nucleus_area_um2 - mu) ** 3) / (avg((nucleus_area_um2 - mu) ** 2) ** 1.5) AS skew FROM fx_cells c JOIN m ON m.animal = c.animal GROUP BY c.animal)
    SELECT m.animal, b AS peak_start, b + 10 AS peak_end, c AS peak_count, round(md, 6) AS median, round(q1, 6) AS q1, round(q3, 6) AS q3,
      round(q3 - q1, 6) AS iqr, round(skew, 6) AS skew, n FROM m JOIN b ON b.animal = m.animal JOIN s ON s.animal = m.animal""")
def area_stats(spark, d):
    return tidy(G.area_stats(cells(spark, d), ["animal"]))


@query("region_density", f"SELECT section, acronym, cnt, round(area_mm2, 6) AS area_mm2, round(density, 6) AS density FROM ({_RD})")
def region_density(spark, d):
    return tidy(R.region_density(raw(spark, d)))


# ---- reference table ------------------------------------------------------------------------------
@query("keep_last", "SELECT seq, config_tag, slice, region, marker, cnt FROM ref")
def keep_last(spark, d):
    return tidy(ref(spark, d).select("seq", "config_tag", "slice", "region", "marker", "cnt"))


_STATS = """SELECT config_tag, marker, class, hemisphere, region, count(density) AS n_slices, avg(density) AS mean_density,
    stddev_samp(density) AS sd_density, min(density) AS min_density, max(density) AS max_density, CAST(sum(cnt) AS BIGINT) AS total_count
    FROM ref {w} GROUP BY config_tag, marker, class, hemisphere, region HAVING count(density) >= {m}"""


@query("reference_stats", f"""SELECT config_tag, marker, class, hemisphere, region, n_slices, round(mean_density, 6) AS mean_density,
    round(sd_density, 6) AS sd_density, round(min_density, 6) AS min_density, round(max_density, 6) AS max_density, total_count,
    round(sd_density / mean_density, 6) AS cv FROM ({_STATS.format(w='WHERE is_leaf', m=3)})""")
def reference_stats(spark, d):
    return tidy(T.reference_stats(ref(spark, d), True, 3))


_FLAG = f"""SELECT r.config_tag, r.marker, r.class, r.hemisphere, r.region, r.density, mean_density, sd_density,
    (r.density - mean_density) / sd_density AS z, n_slices FROM ref r JOIN ({_STATS.format(w="WHERE slice <> 'S3'", m=2)}) b
    ON b.config_tag = r.config_tag AND b.marker = r.marker AND b.class = r.class AND b.hemisphere = r.hemisphere AND b.region = r.region
    WHERE r.slice = 'S3' AND sd_density > 0 AND abs((r.density - mean_density) / sd_density) > 0.5"""
_FLAG_OUT = """config_tag, marker, class, hemisphere, region, round(density, 6) AS density, round(mean_density, 6) AS mean_density,
    round(sd_density, 6) AS sd_density, round(z, 6) AS z, n_slices"""


@query("flag_slice_outliers", f"SELECT {_FLAG_OUT} FROM ({_FLAG})")
def flag_slice_outliers(spark, d):
    return tidy(T.flag_slice_outliers(ref(spark, d), "S3", 0.5))


@query("outliers_by_abs_z", f"SELECT {_FLAG_OUT} FROM ({_FLAG}) f ORDER BY abs(f.z) DESC, config_tag, marker, class, hemisphere, region")
def outliers_by_abs_z(spark, d):
    return tidy(T.outliers_by_abs_z(T.flag_slice_outliers(ref(spark, d), "S3", 0.5)))


@query("upsert_by_image", """SELECT slice, count(*) AS n, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
    WITH r AS (SELECT concat(slice, '_', CASE WHEN seq % 4 = 0 THEN cnt % 5 ELSE cnt % 9 END) AS slice, cnt, seq % 4 = 0 AS fresh FROM fx_reference)
    SELECT slice, cnt FROM r WHERE NOT fresh AND slice NOT IN (SELECT slice FROM r WHERE fresh)
    UNION ALL SELECT slice, cnt FROM r WHERE fresh) GROUP BY slice""")
def upsert_by_image(spark, d):
    """A quarter of the rows is newer; part of the earlier images comes again."""
    fresh = F.col("seq") % 4 == 0
    image = F.concat("slice", F.lit("_"), F.when(fresh, F.col("cnt") % 5).otherwise(F.col("cnt") % 9))
    rows = view(spark, d, "fx_reference").select(image.alias("slice"), "cnt", fresh.alias("fresh"))
    base = scratch_path(spark, "upsert")
    S.upsert_table(rows.where("NOT fresh").drop("fresh"), "slice", f"{base}/1")
    S.upsert_table(rows.where("fresh").drop("fresh"), "slice", f"{base}/2", f"{base}/1")
    return tidy(spark.read.parquet(f"{base}/2").groupBy("slice").agg(F.count("*").alias("n"), F.sum("cnt").alias("cnt")))


@query("config_tag", """SELECT concat('settings_hash', settings_hash, '_pixel_um', pixel_um, '_marker', marker) AS config_tag, count(*) AS n FROM fx_roi_counts GROUP BY 1""")
def config_tag(spark, d):
    rows = view(spark, d, "fx_roi_counts")
    return tidy(T.config_tag(rows, ["settings_hash", "pixel_um", "marker"]).groupBy("config_tag").agg(F.count("*").alias("n")))


@query("settings_hash", """SELECT md5(concat_ws('|', concat('pixel_um=', pixel_um), concat('marker=', marker),
    concat('threshold=', CASE WHEN marker = 'F' THEN cnt::VARCHAR ELSE '' END))) AS settings_hash, count(*) AS n FROM fx_roi_counts GROUP BY 1""")
def settings_hash(spark, d):
    rows = view(spark, d, "fx_roi_counts").select(
        "pixel_um", "marker", F.when(F.col("marker") == "F", "absolute").otherwise("image_span").alias("mode"), F.col("cnt").alias("threshold"))
    return tidy(T.settings_hash(rows, ["pixel_um", "marker"], "mode", "threshold").groupBy("settings_hash").agg(F.count("*").alias("n")))


# ---- hand counts ---------------------------------------------------------------------------------------
_POOL = """SELECT region, count(*) AS boxes, CAST(sum(machine) AS BIGINT) AS machine, CAST(sum(human) AS BIGINT) AS human,
    sum(side_um * side_um / 1e6) AS area_mm2 FROM fx_handcount WHERE human IS NOT NULL GROUP BY region"""


def sheet(spark, d):
    return view(spark, d, "fx_handcount")


@query("handcount_pool", f"SELECT region, boxes, machine, human, round(area_mm2, 6) AS area_mm2 FROM ({_POOL})")
def handcount_pool(spark, d):
    return tidy(T.handcount_pool(sheet(spark, d)))


@query("handcount_pending", "SELECT region FROM (SELECT concat(region, ' ', box % 3) AS region, human FROM fx_handcount) GROUP BY region HAVING count(human) = 0")
def handcount_pending(spark, d):
    return T.handcount_pending(sheet(spark, d).withColumn("region", F.concat("region", F.lit(" "), F.col("box") % 3)))


_HV = f"""SELECT *, CASE WHEN human > 0 THEN machine / human END AS ratio, CASE WHEN machine > 0 AND human > 0 THEN sqrt(1.0 / machine + 1.0 / human) END AS rel_se,
    machine / area_mm2 AS machine_per_mm2, human / area_mm2 AS human_per_mm2 FROM ({_POOL})"""
_HV_OUT = f"""SELECT region, boxes, machine, human, round(area_mm2, 6) AS area_mm2, round(ratio, 6) AS ratio, round(rel_se, 6) AS rel_se,
    round(machine_per_mm2, 6) AS machine_per_mm2, round(human_per_mm2, 6) AS human_per_mm2,
    CASE WHEN human = 0 AND machine = 0 THEN 'both found none' WHEN human = 0 THEN 'over-detecting: none by eye' WHEN ratio >= 1.5 THEN 'over-detecting'
         WHEN ratio <= 0.67 THEN 'under-detecting' WHEN machine + human < 40 THEN 'agrees at this resolution' ELSE 'agrees' END AS verdict FROM ({_HV})"""


@query("handcount_verdict", _HV_OUT)
def handcount_verdict(spark, d):
    return tidy(T.handcount_verdict(T.handcount_pool(sheet(spark, d)), BANDS))


@query("handcount_wm_ratio", f"""WITH v AS ({_HV}), n AS (SELECT min(n_name) FILTER (n_nationkey = 7) AS cx FROM nation),
    b AS (SELECT machine_per_mm2 AS m0, human_per_mm2 AS h0 FROM v JOIN n ON region = cx),
    r AS (SELECT region, CASE WHEN m0 > 0 THEN machine_per_mm2 / m0 END AS m, CASE WHEN h0 > 0 THEN human_per_mm2 / h0 END AS h, coalesce(ratio >= 1.5, FALSE) AS o
      FROM v CROSS JOIN b WHERE region IN (SELECT n_name FROM nation WHERE n_nationkey IN (1, 2, 5, 8, 9)))
    SELECT region, round(m, 6) AS machine_ratio, round(h, 6) AS human_ratio, o AS over_detecting,
      CASE WHEN h > 1.6 THEN 'tissue exceeds band' WHEN m > 1.6 THEN 'machine exceeds band' ELSE 'inside band' END AS band FROM r""")
def handcount_wm_ratio(spark, d):
    names = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    v = T.handcount_verdict(T.handcount_pool(sheet(spark, d)), BANDS)
    return tidy(T.handcount_ratio_to(v, names.where("n_nationkey IN (1, 2, 5, 8, 9)"), names.where("n_nationkey = 7"), BANDS.white_matter_ratio_max))


@query("carry_prior_human", """SELECT n.region, n.box, n.machine, o.human AS prior_human FROM fx_handcount n
    LEFT JOIN (SELECT region, box + box % 2 * 1000000 AS box, human FROM fx_handcount WHERE human IS NOT NULL) o ON o.region = n.region AND o.box = n.box""")
def carry_prior_human(spark, d):
    s = sheet(spark, d)
    return tidy(T.carry_prior_human(s.select("region", "box", "machine"), s.withColumn("box", F.col("box") + F.col("box") % 2 * 1000000)))


# ---- calibration -----------------------------------------------------------------------------------------
_CAL = """SELECT slice, floor_peak, bright_peak, bright_peak - floor_peak AS span, threshold,
    CASE WHEN bright_peak > floor_peak THEN (threshold - floor_peak) / (bright_peak - floor_peak) END AS f FROM fx_calibration"""


@query("calibration_summary", f"""SELECT slice, floor_peak, bright_peak, span, threshold, round(f, 4) AS achieved_frac,
    CASE WHEN f BETWEEN 0.10 AND 0.45 THEN 'PASS' ELSE 'FLAG' END AS status FROM ({_CAL})""")
def calibration_summary(spark, d):
    return tidy(T.calibration_summary(view(spark, d, "fx_calibration")))


@query("robust_series_outliers", f"""WITH l AS (SELECT slice, unnest(['floor', 'bright_peak', 'span']) AS metric, unnest([floor_peak, bright_peak, span]) AS v FROM ({_CAL})),
    m AS (SELECT metric, median(v) AS med FROM l GROUP BY metric), s AS (SELECT l.metric, any_value(med) AS med, median(abs(v - med)) AS mad FROM l JOIN m ON m.metric = l.metric GROUP BY l.metric)
    SELECT slice, l.metric, round((v - med) / (CAST(1.4826 AS DOUBLE) * mad), 2) AS robust_z FROM l JOIN s ON s.metric = l.metric
    WHERE mad > 0 AND abs((v - med) / (CAST(1.4826 AS DOUBLE) * mad)) > 1.5""")
def robust_series_outliers(spark, d):
    return tidy(T.robust_series_outliers(T.calibration_summary(view(spark, d, "fx_calibration")), 1.5))


@query("review_spread", f"""SELECT round(min(f), 6) AS lo, round(max(f), 6) AS hi, count(f) AS n, round(max(f) - min(f), 6) AS spread,
    CASE WHEN count(f) < 2 THEN 'too few' WHEN max(f) - min(f) <= 0.10 THEN 'tight' ELSE 'wide' END AS verdict FROM ({_CAL})""")
def review_spread(spark, d):
    return tidy(T.review_spread(view(spark, d, "fx_calibration")))


_OVERLAP = """SELECT acronym AS region, CASE WHEN tagged_n > 0 AND activity_n > 0 THEN d::DOUBLE * n / (tagged_n::DOUBLE * activity_n) END AS v FROM (
    SELECT acronym, count(*) AS n, count(*) FILTER (tagged) AS tagged_n, count(*) FILTER (activity) AS activity_n, count(*) FILTER (tagged AND activity) AS d
    FROM flagged WHERE {w} GROUP BY acronym)"""


def _overlap(spark, d, cond):
    f = M.role_flags(classed(spark, d), PANEL).where(cond)
    a = f.groupBy(F.col("acronym").alias("region")).agg(
        F.count("*").alias("n"), E.count_where(F.col("tagged")).alias("t"), E.count_where(F.col("activity")).alias("a"),
        E.count_where(F.col("tagged") & F.col("activity")).alias("dd"))
    return a.select("region", E.above_chance("n", "t", "a", "dd").alias("v"))


_TWO = f"WITH a AS ({_OVERLAP.format(w=chr(39) + 'A1998' + chr(39) + ' > animal')}), b AS ({_OVERLAP.format(w='animal >= ' + chr(39) + 'A1998' + chr(39))})"


@query("shared_regions", f"{_TWO} SELECT a.region, round(a.v, 6) AS value_a, round(b.v, 6) AS value_b FROM a JOIN b ON b.region = a.region WHERE a.v IS NOT NULL AND b.v IS NOT NULL")
def shared_regions(spark, d):
    return tidy(T.shared_regions(_overlap(spark, d, "animal < 'A1998'"), _overlap(spark, d, "animal >= 'A1998'"), "v"))


@query("average_rank", f"""WITH a AS ({_OVERLAP.format(w='TRUE')}) SELECT region, round(v, 2) AS v,
    rank() OVER (ORDER BY round(v, 2)) + (count(*) OVER (PARTITION BY round(v, 2)) - 1) / 2.0::DOUBLE AS "rank" FROM a WHERE v IS NOT NULL""")
def average_rank(spark, d):
    rows = _overlap(spark, d, "true").where("v IS NOT NULL").select("region", F.round("v", 2).alias("v"))
    return tidy(T.average_rank(rows, [], "v"))


@query("rank_agreement", f"""{_TWO}, s AS (SELECT a.region, a.v AS va, b.v AS vb FROM a JOIN b ON b.region = a.region WHERE a.v IS NOT NULL AND b.v IS NOT NULL),
    r AS (SELECT rank() OVER (ORDER BY va) + (count(*) OVER (PARTITION BY va) - 1) / 2.0 AS ra, rank() OVER (ORDER BY vb) + (count(*) OVER (PARTITION BY vb) - 1) / 2.0 AS rb FROM s)
    SELECT count(*) AS n_shared, round(1 - 6 * sum((ra - rb) ** 2) / (count(*)::DOUBLE * (count(*)::DOUBLE * count(*) - 1)), 6) AS spearman FROM r""")
def rank_agreement(spark, d):
    return tidy(T.rank_agreement(settle(_overlap(spark, d, "animal < 'A1998'")), settle(_overlap(spark, d, "animal >= 'A1998'")), "v"))


# ---- manual shapes ------------------------------------------------------------------------------------------
def roi(spark, d):
    return view(spark, d, "fx_roi_counts")


@query("column_prefix", """SELECT marker, CASE WHEN marker = 'O' THEN marker ELSE concat(marker, '+') END AS prefix, count(*) AS n FROM fx_roi_counts GROUP BY 1, 2""")
def column_prefix(spark, d):
    rows = roi(spark, d).groupBy("marker").agg(F.count("*").alias("n"))
    return tidy(rows.select("marker", T.column_prefix(F.col("marker"), F.concat("marker", F.lit("+")), "O").alias("prefix"), "n"))


_ANCH = "CASE WHEN marker = 'P' THEN 'independent-overlap' ELSE 'nucleus-anchored' END"


def _anchored(spark, d):
    return roi(spark, d).withColumn("anchoring", F.when(F.col("marker") == "P", "independent-overlap").otherwise("nucleus-anchored"))


@query("anchoring_filter", f"SELECT image, marker, CAST(sum(cnt) AS BIGINT) AS cnt FROM fx_roi_counts WHERE {_ANCH} = 'nucleus-anchored' GROUP BY image, marker")
def anchoring_filter(spark, d):
    return tidy(T.anchoring_filter(_anchored(spark, d), "nucleus-anchored").groupBy("image", "marker").agg(F.sum("cnt").alias("cnt")))


@query("anchoring_split", f"SELECT {_ANCH} AS anchoring, marker, CAST(sum(cnt) AS BIGINT) AS cnt FROM fx_roi_counts GROUP BY 1, 2")
def anchoring_split(spark, d):
    return tidy(T.anchoring_split(_anchored(spark, d)))


_WIDE = """SELECT project, image, roi_name, settings_hash, area_mm2, CAST(sum(cnt) FILTER (marker = 'O') AS BIGINT) AS "O_count", CAST(sum(cnt) FILTER (marker = 'F') AS BIGINT) AS "F_count",
    sum(cnt / area_mm2) FILTER (marker = 'O') AS od, sum(cnt / area_mm2) FILTER (marker = 'F') AS fd, min(pixel_um) AS pixel_um
    FROM fx_roi_counts GROUP BY project, image, roi_name, settings_hash, area_mm2"""


@query("attach_provenance", f"""SELECT project, image, roi_name, settings_hash, round(area_mm2, 6) AS area_mm2, "O_count", "F_count",
    round(od, 6) AS "O_density", round(fd, 6) AS "F_density", round(pixel_um, 6) AS pixel_um FROM ({_WIDE})""")
def attach_provenance(spark, d):
    keys = ["project", "image", "roi_name", "settings_hash", "area_mm2"]
    rows = roi(spark, d).withColumn("col", F.col("marker")).withColumn("density", E.ratio("cnt", "area_mm2"))
    return tidy(T.attach_provenance(T.roi_wide(rows, keys, ["O", "F"]), rows, keys, ["pixel_um"]))


@query("provenance_groups", """SELECT settings_hash, count(DISTINCT image) AS n_images,
    concat(array_to_string(list_sort(list_distinct(list(image)))[1:4], ', '), CASE WHEN count(DISTINCT image) > 4 THEN '  ...' ELSE '' END) AS images,
    CASE WHEN count(DISTINCT pixel_um) = 1 THEN min(pixel_um)::VARCHAR ELSE concat('<', count(DISTINCT pixel_um), ' values>') END AS pixel_um,
    CASE WHEN count(DISTINCT marker) = 1 THEN min(marker) ELSE concat('<', count(DISTINCT marker), ' values>') END AS marker FROM fx_roi_counts GROUP BY settings_hash""")
def provenance_groups(spark, d):
    return tidy(T.provenance_groups(roi(spark, d), ["pixel_um", "marker"]))


@query("describe_split", """WITH l AS (SELECT DISTINCT 'pixel_um' AS field, pixel_um::VARCHAR AS v FROM fx_roi_counts UNION SELECT DISTINCT 'marker', marker FROM fx_roi_counts
      UNION SELECT DISTINCT 'roi_name', roi_name FROM fx_roi_counts)
    SELECT field, CASE WHEN field = 'pixel_um' THEN 'GEOMETRY' ELSE 'setting' END AS tag, count(*) AS n_values,
      concat(array_to_string(list_sort(list(v))[1:5], ', '), CASE WHEN count(*) > 5 THEN '  ...' ELSE '' END) AS shown FROM l GROUP BY field HAVING count(*) > 1""")
def describe_split(spark, d):
    return tidy(T.describe_split(roi(spark, d), ["pixel_um", "marker", "roi_name"], ("pixel_um", "n_z_planes", "anchor_channel")))


_ACQ = """SELECT image, min(pixel_um) * (1 + min(cnt) % 4) AS p, min(pixel_um) * 1.5 AS s, 2.0 + min(cnt) AS a, 0.3 * min(cnt) AS e, count(DISTINCT marker) AS z FROM fx_roi_counts GROUP BY image"""


@query("acquisition_advisories", f"""WITH v AS (SELECT image, round(10.0 / p, 1) AS nucleus_px, round(s / p, 2) AS sigma_px, round(a / (p * p), 0) AS min_area_px, round(e / p, 2) AS expansion_px, z FROM ({_ACQ})),
    t AS (SELECT *, concat_ws(' | ', CASE WHEN nucleus_px < 5 THEN concat('nucleus spans ', nucleus_px, ' px: pixel-limited') WHEN nucleus_px < 10 THEN concat('nucleus spans ', nucleus_px, ' px: below acquisition floor') END,
      CASE WHEN sigma_px < 0.8 THEN concat('sigma of ', sigma_px, ' px is below one pixel') WHEN sigma_px > 6 THEN concat('sigma of ', sigma_px, ' px merges nuclei') END,
      CASE WHEN min_area_px < 6 THEN concat('min area of ', min_area_px, ' px admits noise') END, CASE WHEN expansion_px > 0 AND expansion_px < 1 THEN concat('expansion of ', expansion_px, ' px is near empty') END,
      CASE WHEN z > 1 THEN concat(z, ' Z-planes') END) AS x FROM v)
    SELECT image, nucleus_px, sigma_px, min_area_px, expansion_px, CASE WHEN x = '' THEN '-' ELSE x END AS advisories FROM t""")
def acquisition_advisories(spark, d):
    images = roi(spark, d).groupBy("image").agg(
        (F.min("pixel_um") * (1 + F.min("cnt") % 4)).alias("pixel_um"), (F.min("pixel_um") * 1.5).alias("sigma_um"), (2.0 + F.min("cnt")).alias("min_area_um2"),
        (0.3 * F.min("cnt")).alias("cell_expansion_um"), F.count_distinct("marker").alias("n_z_planes"))
    return tidy(T.acquisition_advisories(images, fine_floor=True).select("image", "nucleus_px", "sigma_px", "min_area_px", "expansion_px", "advisories"))


_DR = """SELECT shape_id, z, CASE WHEN shape_id % 4 = 0 THEN roi_name WHEN shape_id % 4 = 1 THEN ' ' END AS nm FROM fx_drawn"""


@query("auto_name_shapes", f"""SELECT shape_id, z, CASE WHEN trim(coalesce(nm, '')) = '' THEN concat('ROI_', sum(CASE WHEN trim(coalesce(nm, '')) = '' THEN 1 ELSE 0 END)
    OVER (PARTITION BY z ORDER BY shape_id)) ELSE nm END AS name FROM ({_DR})""")
def auto_name_shapes(spark, d):
    s = view(spark, d, "fx_drawn").select("shape_id", "z", F.when(F.col("shape_id") % 4 == 0, F.col("roi_name")).when(F.col("shape_id") % 4 == 1, " ").alias("name"))
    return tidy(T.auto_name_shapes(s, ["z"], "shape_id"))


@query("counts_with_area", """WITH c AS (SELECT project, image, roi_name, CAST(sum(cnt) FILTER (marker = 'F') AS BIGINT) AS "F_count" FROM (SELECT *  REPLACE (CASE WHEN marker = 'O' AND image >= 'I3' THEN concat(image, 'c') ELSE image END AS image) FROM fx_roi_counts) GROUP BY 1, 2, 3),
    a AS (SELECT project, image, roi_name, sum(area_mm2) FILTER (marker = 'O') AS "O_pos_area_mm2", sum(area_mm2) FILTER (marker = 'F') AS "F_pos_area_mm2" FROM (SELECT *  REPLACE (CASE WHEN image < 'I2' THEN concat(image, 'a') ELSE image END AS image) FROM fx_roi_counts) GROUP BY 1, 2, 3)
    SELECT coalesce(c.project, a.project) AS project, coalesce(c.image, a.image) AS image, coalesce(c.roi_name, a.roi_name) AS roi_name, "F_count",
      round("O_pos_area_mm2", 6) AS "O_pos_area_mm2", round("F_pos_area_mm2", 6) AS "F_pos_area_mm2", round(CASE WHEN "O_pos_area_mm2" > 0 THEN "F_count" / "O_pos_area_mm2" END, 6) AS "F_per_O_area",
      round(CASE WHEN "O_pos_area_mm2" > 0 THEN "F_pos_area_mm2" / "O_pos_area_mm2" END, 6) AS "F_area_per_O_area"
    FROM c FULL JOIN a ON a.project = c.project AND a.image = c.image AND a.roi_name = c.roi_name""")
def counts_with_area(spark, d):
    keys, r = ["project", "image", "roi_name"], roi(spark, d)
    renamed = lambda when, end: r.withColumn("image", F.when(F.expr(when), F.concat("image", F.lit(end))).otherwise(F.col("image")))
    counts = renamed("marker = 'O' AND image >= 'I3'", "c").groupBy(*keys).agg(F.sum(F.when(F.col("marker") == "F", F.col("cnt"))).cast("long").alias("F_count"))
    area = renamed("image < 'I2'", "a").groupBy(*keys).agg(*[F.sum(F.when(F.col("marker") == m, F.col("area_mm2"))).alias(f"{m}_pos_area_mm2") for m in "OF"])
    return tidy(T.counts_with_area(counts, area, keys, ["F"], "O"))


@query("shape_pool_rollup", """WITH s AS (SELECT project, roi_name, image AS shape_id, sum(area_mm2) AS area_mm2, CAST(sum(cnt) AS BIGINT) AS anchor FROM fx_roi_counts GROUP BY 1, 2, 3)
    SELECT CASE WHEN grouping(shape_id) = 1 THEN 'pooled' ELSE 'shape' END AS scope, project, roi_name, shape_id, count(*) AS n_shapes, round(sum(area_mm2), 6) AS area_mm2,
      CAST(sum(anchor) AS BIGINT) AS anchor, round(sum(anchor) / sum(area_mm2), 6) AS anchor_density FROM s GROUP BY GROUPING SETS ((project, roi_name, shape_id), (project, roi_name))""")
def shape_pool_rollup(spark, d):
    s = roi(spark, d).groupBy("project", "roi_name", F.col("image").alias("shape_id")).agg(F.sum("area_mm2").alias("area_mm2"), F.sum("cnt").alias("anchor"))
    return tidy(T.shape_pool_rollup(s.withColumn("_shape", F.col("shape_id")), ["project"], ["anchor"]))


# ---- parameter resolution --------------------------------------------------------------------------------------
_OVR = """SELECT n_nationkey AS ordinal, concat('I', n_nationkey % 5) AS match_key, CASE WHEN n_nationkey % 2 = 0 THEN 'absolute' END AS mode,
    CASE WHEN n_nationkey % 2 = 1 THEN 0.3::DOUBLE END AS span_frac, CASE WHEN n_nationkey % 2 = 0 THEN (1000 + n_nationkey)::DOUBLE END AS absolute
    FROM nation WHERE n_nationkey % 5 IN (2, 4)"""


def _overrides(spark, d):
    k = F.col("n_nationkey")
    return table(spark, d, "nation").where(k % 5 % 2 == 0).where(k % 5 != 0).select(
        k.alias("ordinal"), F.concat(F.lit("I"), k % 5).alias("match_key"), F.when(k % 2 == 0, "absolute").alias("mode"),
        F.when(k % 2 == 1, 0.3).alias("span_frac"), F.when(k % 2 == 0, (1000 + k).cast("double")).alias("absolute"))


@query("threshold_override", f"""WITH o AS ({_OVR}), i AS (SELECT DISTINCT image FROM fx_roi_counts),
    h AS (SELECT i.image, o.* FROM i LEFT JOIN o ON contains(i.image, o.match_key) QUALIFY row_number() OVER (PARTITION BY i.image ORDER BY ordinal) = 1)
    SELECT image, match_key, coalesce(mode, 'span_fraction') AS mode, coalesce(span_frac, 0.25::DOUBLE) AS span_frac, coalesce(absolute, 0.0::DOUBLE) AS absolute FROM h""")
def threshold_override(spark, d):
    return tidy(T.threshold_override(roi(spark, d).select("image").distinct(), _overrides(spark, d),
                                     {"mode": "span_fraction", "span_frac": 0.25, "absolute": 0.0}))


@query("settings_resolve", """WITH b AS (SELECT n_nationkey AS ordinal, CASE WHEN n_nationkey < 5 THEN concat('I', n_nationkey * 11) ELSE concat('I', n_nationkey % 5 + 1) END AS match_key, concat('block', n_nationkey) AS block
      FROM nation WHERE n_nationkey < 8), i AS (SELECT DISTINCT image FROM fx_roi_counts)
    SELECT i.image, coalesce((SELECT b.block FROM b WHERE b.match_key = i.image), (SELECT arg_min(b.block, b.ordinal) FROM b WHERE contains(i.image, b.match_key))) AS block FROM i""")
def settings_resolve(spark, d):
    k = F.col("n_nationkey")
    blocks = table(spark, d, "nation").where(k < 8).select(
        k.alias("ordinal"), F.concat(F.lit("I"), F.when(k < 5, k * 11).otherwise(k % 5 + 1)).alias("match_key"), F.concat(F.lit("block"), k).alias("block"))
    return T.settings_resolve(roi(spark, d).select("image").distinct(), blocks)


@query("marker_token_match", """SELECT declared, column_name FROM (SELECT DISTINCT event_type AS column_name FROM events) c
    JOIN (SELECT DISTINCT upper(event_type) AS declared FROM events WHERE event_type <> 'click') d ON lower(d.declared) = lower(c.column_name)""")
def marker_token_match(spark, d):
    ev = table(spark, d, "events").select("event_type").distinct()
    want = ev.where("event_type <> 'click'").select(F.upper("event_type").alias("declared"))
    return ev.withColumnRenamed("event_type", "column_name").join(want, F.lower("declared") == F.lower("column_name"))


# ---- datasets -------------------------------------------------------------------------------------------------
_DS = f"""WITH md AS (SELECT animal, bin * 5 + 2.5::DOUBLE AS area_modal_um2 FROM (SELECT animal, least(floor(v / 5), ceil((least(mx, 300.0) + 5) / 5) - 2) AS bin, count(*) AS n
        FROM (SELECT animal, nucleus_area_um2 AS v, max(nucleus_area_um2) OVER (PARTITION BY animal) AS mx FROM flagged) WHERE v <= (ceil((least(mx, 300.0) + 5) / 5) - 1) * 5 GROUP BY animal, bin)
        QUALIFY row_number() OVER (PARTITION BY animal ORDER BY n DESC, bin) = 1),
      th AS (SELECT split_part(section, '_', 1) AS animal, count(*) AS n_sections, median(med + sd) AS threshold_med,
        CASE WHEN count(*) > 1 AND min(med + sd) > 0 THEN max(med + sd) / min(med + sd) END AS threshold_spread FROM stats WHERE marker = 'tdt' GROUP BY 1),
      b AS (SELECT animal, count(*) AS n_cells, 100.0 * avg(tagged::INT) AS tagged_pct, 100.0 * avg(activity::INT) AS activity_pct FROM flagged GROUP BY animal),
      pv AS (SELECT animal, 1 - avg(tagged::INT) AS p, count(*) AS n FROM flagged GROUP BY animal),
      o AS (SELECT f.animal, anchor_mean AS v, row_number() OVER (PARTITION BY f.animal ORDER BY anchor_mean) - 1 AS rn, (n - 1) * p AS h FROM flagged f JOIN pv ON pv.animal = f.animal),
      c AS (SELECT animal, max(v) FILTER (rn = floor(h)) + (max(v) FILTER (rn = ceil(h)) - max(v) FILTER (rn = floor(h))) * (any_value(h) - floor(any_value(h))) AS cut FROM o GROUP BY animal),
      fl AS (SELECT f.animal, avg(activity::INT) FILTER (anchor_mean > cut) / avg(activity::INT) AS floor FROM flagged f JOIN c ON c.animal = f.animal GROUP BY f.animal),
    ct AS (SELECT animal, count(*) AS control_n, CASE WHEN count(*) > 200 THEN avg(activity::INT) FILTER (tagged) / nullif(avg(activity::INT), 0) END AS control_above_chance
      FROM flagged WHERE acronym IN (SELECT descendant FROM closure WHERE ancestor = 'ASIA') GROUP BY animal)
    SELECT b.animal AS dataset, n_cells, tagged_pct, activity_pct, n_sections, threshold_spread, threshold_med, area_modal_um2, floor, 'ASIA' AS control_region, coalesce(control_n, 0) AS control_n, control_above_chance
    FROM b LEFT JOIN ct ON ct.animal = b.animal JOIN md ON md.animal = b.animal JOIN th ON th.animal = b.animal JOIN fl ON fl.animal = b.animal"""


def descriptor(spark, d):
    from ..operators import chance as C
    f = settle(M.role_flags(classed(spark, d), PANEL).withColumn("dataset", F.col("animal")))
    cuts = M.robust_threshold(stored_cells(spark, d), PANEL).where("marker = 'tdt'").select(
        E.slice_identity("section")["animal"].alias("dataset"), "threshold")
    modal = G.histogram_mode(f, ["dataset"], "nucleus_area_um2", 5.0, F.least(F.col("_max"), F.lit(300.0)))
    floor = C.anchor_floor(f, ["dataset"]).select("dataset", F.col("anchor_floor").alias("floor"))
    asia = closure(spark, d).where("ancestor = 'ASIA'").select(F.col("descendant").alias("acronym"))
    return T.dataset_descriptor(f, cuts, modal, floor, "ASIA", asia)


@query("dataset_descriptor", f"""SELECT dataset, n_cells, round(tagged_pct, 6) AS tagged_pct, round(activity_pct, 6) AS activity_pct, n_sections,
    round(threshold_spread, 6) AS threshold_spread, round(threshold_med, 6) AS threshold_med, area_modal_um2, round(floor, 6) AS floor,
    control_region, control_n, round(control_above_chance, 6) AS control_above_chance FROM ({_DS})""")
def dataset_descriptor(spark, d):
    return tidy(descriptor(spark, d))


@query("dataset_verdict", f"""WITH ds AS ({_DS}), e AS (SELECT *, 0.46 + (right(dataset, 1)::INT % 3) * 0.004 AS pixel_um, right(dataset, 1)::INT % 2 AS k,
      CASE WHEN right(dataset, 1)::INT % 3 > 0 THEN control_above_chance END AS control FROM ds),
    p AS (SELECT a.dataset AS first, b.dataset AS second, a.control * b.control <> 0 AS own, abs(a.pixel_um - b.pixel_um) / greatest(a.pixel_um, b.pixel_um) > 0.02
        OR abs(a.area_modal_um2 - b.area_modal_um2) / greatest(a.area_modal_um2, b.area_modal_um2) > 0.25 AS geom,
      abs(a.n_cells - b.n_cells) / greatest(a.n_cells, b.n_cells) > 0.30 AS dens, a.k <> b.k AS sens FROM e a JOIN e b ON right(b.dataset, 4)::INT IN (right(a.dataset, 4)::INT + 1, right(a.dataset, 4)::INT + 2))
    SELECT first, second, unnest(['absolute counts', 'positive share', 'raw conditional', 'above chance', 'above chance over own control', 'rank order']) AS metric,
      unnest([CASE WHEN geom OR dens THEN 'do not compare' ELSE 'usable' END, CASE WHEN geom OR sens THEN 'weak' ELSE 'usable' END, CASE WHEN sens THEN 'weak' ELSE 'usable' END,
        CASE WHEN geom OR dens OR sens THEN 'weak' ELSE 'usable' END, CASE WHEN own THEN 'usable' ELSE 'needs a control region' END, 'usable']) AS weight FROM p""")
def dataset_verdict(spark, d):
    last = F.substring("dataset", -1, 1).cast("int")
    desc = settle(descriptor(spark, d)).withColumn("pixel_um", 0.46 + (last % 3) * 0.004).withColumn("k", last % 2)
    desc = desc.withColumn("control_above_chance", F.when(last % 3 > 0, F.col("control_above_chance")))
    year = F.substring("dataset", 2, 4).cast("int")
    later = F.explode(F.array(*[F.concat(F.lit("A"), (year + i).cast("string")) for i in (1, 2)]))
    return T.dataset_verdict(desc, desc.select(F.col("dataset").alias("first"), later.alias("second")))


@query("dataset_issues", f"""WITH e AS (SELECT *, 0.46 + (right(dataset, 1)::INT % 3) * 0.004 AS pixel_um, CASE WHEN right(dataset, 1)::INT <> 6 THEN 2.0 + (right(dataset, 1)::INT % 2) * 0.1 END AS sigma_um,
      (right(dataset, 1)::INT % 4)::DOUBLE AS expansion_um FROM ({_DS})),
    p AS (SELECT a.dataset AS first, b.dataset AS second, unnest(['pixel size', 'sigma', 'cell expansion', 'modal nucleus area']) AS parameter, unnest([0.02, 0.01, 0.01, 0.25])::DOUBLE AS most,
      unnest([a.pixel_um, a.sigma_um, a.expansion_um, a.area_modal_um2])::DOUBLE AS u, unnest([b.pixel_um, b.sigma_um, b.expansion_um, b.area_modal_um2])::DOUBLE AS v FROM e a JOIN e b ON a.dataset < b.dataset)
    SELECT first, second, parameter, CASE WHEN u * v <> 0 THEN '!' ELSE '?' END AS severity, round(CASE WHEN u * v <> 0 THEN 100 * abs(u - v) / greatest(abs(u), abs(v)) END, 6) AS gap_percent
    FROM p WHERE coalesce(u * v = 0, TRUE) OR abs(u - v) / greatest(abs(u), abs(v)) > most""")
def dataset_issues(spark, d):
    last = F.substring("dataset", -1, 1).cast("int")
    desc = settle(descriptor(spark, d)).withColumn("pixel_um", 0.46 + (last % 3) * 0.004)
    desc = desc.withColumn("sigma_um", F.when(last != 6, 2.0 + (last % 2) * 0.1)).withColumn("expansion_um", (last % 4).cast("double"))
    names = desc.select(F.col("dataset").alias("first"))
    return T.dataset_issues(desc, names.join(names.withColumnRenamed("first", "second"), F.col("first") < F.col("second")))


@query("plateau_diff", """SELECT a.section, n_first, n_second, round(100.0 * abs(n_first - n_second) / n_first, 6) AS pct_diff FROM
    (SELECT section, CAST(sum(cnt) AS BIGINT) AS n_first FROM fx_raw_regions WHERE acronym = 'root' GROUP BY section) a JOIN
    (SELECT section, CAST(sum(cnt + cnt % 7) AS BIGINT) AS n_second FROM fx_raw_regions WHERE acronym = 'root' GROUP BY section) b ON b.section = a.section""")
def plateau_diff(spark, d):
    root = raw(spark, d).where("acronym = 'root'")
    return tidy(T.plateau_diff(root, root.withColumn("cnt", F.col("cnt") + F.col("cnt") % 7)))


@query("tuning_readout", f"""WITH g AS (SELECT round(avg(v) FILTER (g = 1), 2) AS area_peak, round(avg(v) FILTER (g = 2), 1) AS total_density, count(DISTINCT section) AS slices FROM (
      SELECT section, value AS v, 1 AS g FROM ({_G['nucleus_area_peak_um2']}) UNION ALL SELECT section, value, 2 FROM ({_G['total_density']}))),
    r AS (SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(target_n) / sum(n), 4) AS target_frac, round(sum(condition_n) / sum(n), 4) AS condition_frac FROM ({_AT_K_OUT}))
    SELECT * FROM g CROSS JOIN r""")
def tuning_readout(spark, d):
    return tidy(T.tuning_readout(gate_table_df(spark, d), M.region_readout_at_k(stored_cells(spark, d), PANEL, "fos", "tdt", K)))


def _renamed(animal, end):
    """Stems; those of one animal have a name that the other side lacks."""
    return F.when(F.col("animal") == animal, F.concat("section", F.lit(end))).otherwise(F.col("section")).alias("stem")


@query("export_pairing", """SELECT coalesce(c.section, r.section) AS stem, c.n AS cell_rows, r.n AS region_rows,
    CASE WHEN r.n IS NULL THEN 'no regions' WHEN c.n IS NULL THEN 'no cells' ELSE 'paired' END AS status
    FROM (SELECT CASE WHEN animal = 'A1996' THEN concat(section, 'c') ELSE section END AS section, count(*) AS n FROM fx_cells GROUP BY 1) c
    FULL JOIN (SELECT CASE WHEN animal = 'A1998' THEN concat(section, 'r') ELSE section END AS section, count(DISTINCT acronym) AS n FROM fx_cells GROUP BY 1) r ON r.section = c.section""")
def export_pairing(spark, d):
    c = cells(spark, d)
    a = c.groupBy(_renamed("A1996", "c")).agg(F.count("*").alias("n_rows"))
    b = c.groupBy(_renamed("A1998", "r")).agg(F.count_distinct("acronym").alias("n_rows"))
    return tidy(T.export_pairing(a, b))


@query("stem_difference", """WITH a AS (SELECT DISTINCT CASE WHEN animal = 'A1996' THEN concat(section, 'c') ELSE section END AS stem FROM fx_cells), b AS (SELECT DISTINCT CASE WHEN animal = 'A1998' THEN concat(section, 'r') ELSE section END AS stem FROM fx_cells)
    SELECT stem, 'only_first' AS side FROM a WHERE stem NOT IN (SELECT stem FROM b) UNION ALL SELECT stem, 'only_second' FROM b WHERE stem NOT IN (SELECT stem FROM a)
    UNION ALL SELECT stem, 'both' FROM a WHERE stem IN (SELECT stem FROM b)""")
def stem_difference(spark, d):
    c = cells(spark, d)
    return T.stem_difference(c.select(_renamed("A1996", "c")), c.select(_renamed("A1998", "r")))
