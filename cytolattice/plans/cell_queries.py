"""Queries on cells: cuts, classes, k sweeps, predicates."""

from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import markers as M
from ..operators import rollup as R
from ..session import settle
from .bindings import BANDS, K, PANEL, table, view
from .registry import query, tidy

KS = [0.55, 1.0, 1.45]
LADDER = (0.5, 0.75, 1.0)
_POS = "{m}_bgsub >= {m}_med + {k} * {m}_sd"


def cells(spark, d):
    return view(spark, d, "fx_cells")


def stored_cells(spark, d):
    """The cells written once, as an export would be; operators that pass over them repeatedly read this."""
    return settle(cells(spark, d), "cells")


def classed(spark, d):
    return M.classify_cells(stored_cells(spark, d), PANEL)


def bridge(spark, d):
    """Named groups of acronyms, from the tree's parents and two hand-made overlaps."""
    edges = view(spark, d, "fx_edges").where(F.col("parent").isNotNull() & (F.col("parent") != "root"))
    return settle(edges.select(F.col("parent").alias("region"), "acronym").unionByName(
        edges.select(F.concat(F.lit("G_"), F.substring("acronym", 1, 1)).alias("region"), "acronym")), "bridge")


BRIDGE_SQL = """SELECT parent AS region, acronym FROM fx_edges WHERE parent IS NOT NULL AND parent <> 'root'
    UNION ALL SELECT concat('G_', left(acronym, 1)), acronym FROM fx_edges WHERE parent IS NOT NULL AND parent <> 'root'"""


def p(m, k):
    return _POS.format(m=m, k=k)


@query("robust_threshold", """SELECT section, marker, n, round(med, 6) AS median, round(mad, 6) AS mad,
    round(sd, 6) AS robust_sd, CAST(1.0 AS DOUBLE) AS k, round(med + 1.0 * sd, 6) AS threshold FROM stats""")
def robust_threshold(spark, d):
    return tidy(M.robust_threshold(stored_cells(spark, d), PANEL))


@query("classify_cells", "SELECT cell_id, section, class FROM classed")
def classify_cells(spark, d):
    return tidy(classed(spark, d).select("cell_id", "section", "class"))


@query("threshold_selfcheck", """
    WITH pos AS (SELECT m.section, m.marker, count(*) FILTER (v >= med + 1.0 * sd) AS n_pos
      FROM meas m JOIN stats s ON m.section = s.section AND m.marker = s.marker GROUP BY m.section, m.marker)
    SELECT s.section, s.marker, n, round(med, 6) AS median, round(sd, 6) AS robust_sd, round(med + 1.0 * sd, 6) AS threshold,
      round(n_pos / n, 6) AS positive_fraction,
      CASE WHEN med + sd <= 0 THEN 'CHECK: cut not above background' WHEN n_pos = 0 THEN 'CHECK: nothing positive'
           WHEN n_pos / n > 0.5 THEN 'CHECK: more than half positive' ELSE 'PASS' END AS verdict
    FROM stats s JOIN pos p ON s.section = p.section AND s.marker = p.marker""")
def threshold_selfcheck(spark, d):
    return tidy(M.threshold_selfcheck(stored_cells(spark, d), PANEL))


_SWEEP = """WITH ks AS (SELECT unnest([0.55, 1.0, 1.45])::DOUBLE AS k)
    SELECT m.section, '__section__' AS region, m.marker, k, round(med + k * sd, 6) AS threshold,
      count(*) FILTER (v >= med + k * sd) AS count, round(100.0 * count(*) FILTER (v >= med + k * sd) / count(*), 6) AS pct
    FROM meas m JOIN stats s ON m.section = s.section AND m.marker = s.marker CROSS JOIN ks
    GROUP BY m.section, m.marker, k, med, sd"""


@query("k_sweep", f"""WITH bridge AS ({BRIDGE_SQL}), ks AS (SELECT unnest([0.55, 1.0, 1.45])::DOUBLE AS k),
    long AS (SELECT section, '__section__' AS region, marker, v FROM meas
      UNION ALL SELECT m.section, b.region, m.marker, m.v FROM meas m JOIN bridge b ON m.acronym = b.acronym)
    SELECT m.section, m.region, m.marker, k, round(med + k * sd, 6) AS threshold,
      count(*) FILTER (v >= med + k * sd) AS count, round(100.0 * count(*) FILTER (v >= med + k * sd) / count(*), 6) AS pct
    FROM long m JOIN stats s ON m.section = s.section AND m.marker = s.marker CROSS JOIN ks
    GROUP BY m.section, m.region, m.marker, k, med, sd""")
def k_sweep(spark, d):
    c = stored_cells(spark, d)
    return tidy(M.k_sweep(c, PANEL, KS).unionByName(M.k_sweep(c, PANEL, KS, bridge(spark, d))))


@query("sink_ksweep_tidy", _SWEEP)
def sink_ksweep_tidy(spark, d):
    from ..sources import writers as S
    from ..session import scratch_path
    path = scratch_path(spark, "ksweep")
    S.write_csv(M.k_sweep(stored_cells(spark, d), PANEL, KS), path)
    back = spark.read.csv(path, header=True, schema="section string, region string, marker string, k double, "
                                                    "threshold double, count bigint, pct double")
    return tidy(back)


@query("region_group_bridge", f"""WITH bridge AS ({BRIDGE_SQL})
    SELECT section, region, count(*) AS n FROM fx_cells c JOIN bridge b ON c.acronym = b.acronym
    WHERE NOT excluded GROUP BY section, region""")
def region_group_bridge(spark, d):
    return tidy(cells(spark, d).where(~F.col("excluded")).join(bridge(spark, d), "acronym")
                .groupBy("section", "region").agg(F.count("*").alias("n")))


@query("k_whiskers", f"""WITH bridge AS ({BRIDGE_SQL}),
    a AS (SELECT section, region, count(*) AS n, count(*) FILTER ({p('tdt', 1.0)}) AS n_mid,
      count(*) FILTER ({p('tdt', 1.45)}) AS n_strict, count(*) FILTER ({p('tdt', 0.55)}) AS n_lenient
      FROM cells_s c JOIN bridge b ON c.acronym = b.acronym WHERE NOT excluded GROUP BY section, region)
    SELECT *, round(100.0 * n_mid / n, 6) AS pct_mid, round(100.0 * n_strict / n, 6) AS pct_strict,
      round(100.0 * n_lenient / n, 6) AS pct_lenient FROM a""")
def k_whiskers(spark, d):
    return tidy(M.k_whiskers(stored_cells(spark, d), PANEL, KS, "tdt", bridge(spark, d)))


@query("marker_summary", """WITH ks AS (SELECT unnest([0.55, 1.0, 1.45])::DOUBLE AS k)
    SELECT m.section, m.marker, k, any_value(s.n) AS n, round(any_value(med), 6) AS median, round(any_value(mad), 6) AS mad,
      round(any_value(sd), 6) AS robust_sd, round(any_value(med + k * sd), 6) AS threshold,
      count(*) FILTER (v >= med + k * sd) AS n_pos, round(count(*) FILTER (v >= med + k * sd) / count(*), 6) AS frac_pos
    FROM meas m JOIN stats s ON m.section = s.section AND m.marker = s.marker CROSS JOIN ks GROUP BY m.section, m.marker, k""")
def marker_summary(spark, d):
    return tidy(M.marker_summary(stored_cells(spark, d), PANEL, KS))


@query("section_threshold_join", f"""SELECT section, count(*) AS n, count(*) FILTER ({p('fos', 1.0)}) AS fos_pos,
    count(*) FILTER ({p('tdt', 1.0)}) AS tdt_pos FROM cells_s WHERE NOT excluded GROUP BY section""")
def section_threshold_join(spark, d):
    rows = M.with_stats(stored_cells(spark, d), PANEL).where(~F.col("excluded"))
    return tidy(rows.groupBy("section").agg(
        F.count("*").alias("n"), *[E.count_where(M.positive_at(m, K)).alias(f"{m}_pos") for m in ("fos", "tdt")]))


_COND = """WITH ks AS (SELECT unnest([0.5, 0.75, 1.0])::DOUBLE AS k)
    SELECT section, k, count(*) FILTER (tdt_bgsub >= tdt_med + k * tdt_sd AND fos_bgsub >= fos_med + k * fos_sd) AS numer,
      count(*) FILTER (tdt_bgsub >= tdt_med + k * tdt_sd) AS denom FROM cells_s CROSS JOIN ks WHERE NOT excluded
    GROUP BY section, k"""


@query("conditional_rate", f"SELECT section, k, numer, denom, round(CASE WHEN denom > 0 THEN numer / denom END, 6) AS rate FROM ({_COND})")
def conditional_rate(spark, d):
    return tidy(M.conditional_rate(stored_cells(spark, d), PANEL, "fos", "tdt", list(LADDER)))


def _bands():
    from dataclasses import replace
    return replace(BANDS, k_values=LADDER)


@query("k_stability_swing", f"""SELECT section, round((max(rate) - min(rate)) * 100, 6) AS value,
    CASE WHEN max(rate) IS NULL THEN 'N/A' WHEN (max(rate) - min(rate)) * 100 <= 10 THEN 'PASS' ELSE 'FLAG' END AS status
    FROM (SELECT section, k, CASE WHEN denom > 0 THEN numer / denom END AS rate FROM ({_COND})) GROUP BY section""")
def k_stability_swing(spark, d):
    return tidy(M.k_stability(stored_cells(spark, d), PANEL, "fos", "tdt", _bands()))


@query("k_stability_matrix", f"""WITH r AS (SELECT section, k, CASE WHEN denom > 0 THEN 100.0 * numer / denom END AS rate FROM ({_COND})),
    w AS (SELECT section, max(rate) FILTER (k = 0.5) AS k_0_5, max(rate) FILTER (k = 0.75) AS k_0_75, max(rate) FILTER (k = 1) AS k_1,
      max(rate) - min(rate) AS s FROM r GROUP BY section)
    SELECT section, round(k_0_5, 6) AS k_0_5, round(k_0_75, 6) AS k_0_75, round(k_1, 6) AS k_1, round(s, 6) AS swing_pp,
      CASE WHEN s <= 10 THEN 'PASS' ELSE 'FLAG' END AS stable FROM w""")
def k_stability_matrix(spark, d):
    return tidy(M.k_stability_matrix(stored_cells(spark, d), PANEL, "fos", "tdt", _bands()))


@query("section_counts_at_k", f"""SELECT section, count(*) AS total, count(*) FILTER (excluded) AS excluded_n,
    count(*) FILTER (NOT excluded AND {p('fos', 1.0)}) AS fos_pos, count(*) FILTER (NOT excluded AND {p('tdt', 1.0)}) AS tdt_pos,
    count(*) FILTER (NOT excluded AND {p('fos', 1.0)} AND {p('tdt', 1.0)}) AS double_pos FROM cells_s GROUP BY section""")
def section_counts_at_k(spark, d):
    return tidy(M.section_counts_at_k(stored_cells(spark, d), PANEL, K))


_AT_K = f"""SELECT section, acronym, count(*) AS n, count(*) FILTER (NOT excluded) AS t_n,
    count(*) FILTER (NOT excluded AND {p('fos', 1.0)}) AS target_n, count(*) FILTER (NOT excluded AND {p('tdt', 1.0)}) AS condition_n,
    count(*) FILTER (NOT excluded AND {p('fos', 1.0)} AND {p('tdt', 1.0)}) AS double_n FROM cells_s GROUP BY section, acronym"""
_AT_K_OUT = f"""WITH r AS ({_AT_K}), b AS (SELECT section, sum(target_n) / sum(t_n) AS baseline FROM r GROUP BY section)
    SELECT r.section, acronym, n, target_n, CASE WHEN t_n > 0 THEN target_n / t_n END AS target_frac, baseline AS baseline_frac,
      condition_n, double_n, CASE WHEN condition_n > 0 THEN double_n / condition_n END AS reactivation_raw,
      CASE WHEN condition_n > 0 AND baseline > 0 THEN double_n / condition_n / baseline END AS enrichment
    FROM r JOIN b ON r.section = b.section"""


@query("region_readout_at_k", f"""SELECT section, acronym, n, target_n, round(target_frac, 6) AS target_frac,
    round(baseline_frac, 6) AS baseline_frac, condition_n, double_n, round(reactivation_raw, 6) AS reactivation_raw,
    round(enrichment, 6) AS enrichment FROM ({_AT_K_OUT})""")
def region_readout_at_k(spark, d):
    return tidy(M.region_readout_at_k(stored_cells(spark, d), PANEL, "fos", "tdt", K))


@query("rank_by_evidence", f"""SELECT acronym, round(avg(target_frac), 6) AS mean_value, CAST(sum(n) AS BIGINT) AS n
    FROM ({_AT_K_OUT}) GROUP BY acronym HAVING sum(n) >= 200 ORDER BY avg(target_frac) DESC NULLS LAST, acronym LIMIT 15""")
def rank_by_evidence(spark, d):
    return tidy(R.rank_by_evidence(M.region_readout_at_k(stored_cells(spark, d), PANEL, "fos", "tdt", K), "target_frac"))


@query("series_totals", f"""WITH r AS (SELECT section, count(*) AS total, count(*) FILTER (excluded) AS excluded_n,
      count(*) FILTER (NOT excluded AND {p('fos', 1.0)}) AS fos_pos, count(*) FILTER (NOT excluded AND {p('tdt', 1.0)}) AS tdt_pos,
      count(*) FILTER (NOT excluded AND {p('fos', 1.0)} AND {p('tdt', 1.0)}) AS double_pos FROM cells_s GROUP BY section)
    SELECT CAST(sum(total) AS BIGINT) AS total, CAST(sum(excluded_n) AS BIGINT) AS excluded_n, CAST(sum(fos_pos) AS BIGINT) AS fos_pos,
      CAST(sum(tdt_pos) AS BIGINT) AS tdt_pos, CAST(sum(double_pos) AS BIGINT) AS double_pos,
      round(avg(double_pos / tdt_pos), 6) AS rate_mean, round(min(double_pos / tdt_pos), 6) AS rate_min,
      round(max(double_pos / tdt_pos), 6) AS rate_max FROM r""")
def series_totals(spark, d):
    c = stored_cells(spark, d)
    return tidy(R.series_totals(M.section_counts_at_k(c, PANEL, K), M.conditional_rate(c, PANEL, "fos", "tdt", [K])))


_ROLL_N = "SELECT acronym, count(*) AS n_rollup FROM fx_cells WHERE acronym NOT IN (SELECT r_name FROM region WHERE r_regionkey = 0) GROUP BY acronym"


@query("k_split_counts", f"""WITH rn AS ({_ROLL_N}), ks AS (SELECT unnest([0.55, 1.0, 1.45])::DOUBLE AS k),
    a AS (SELECT acronym, k, count(*) AS n, count(*) FILTER (tdt_bgsub >= tdt_med + k * tdt_sd) AS tagged_n,
      count(*) FILTER (fos_bgsub >= fos_med + k * fos_sd) AS activity_n,
      count(*) FILTER (tdt_bgsub >= tdt_med + k * tdt_sd AND fos_bgsub >= fos_med + k * fos_sd) AS double_n
      FROM cells_s CROSS JOIN ks WHERE NOT excluded GROUP BY acronym, k)
    SELECT a.acronym, n, k, tagged_n, activity_n, double_n, round(100.0 * tagged_n / n, 6) AS tagged_pct,
      round(100.0 * activity_n / n, 6) AS activity_pct,
      round(CASE WHEN tagged_n > 0 AND activity_n > 0 THEN (double_n::DOUBLE * n) / (tagged_n::DOUBLE * activity_n) END, 6) AS overlap
    FROM a JOIN rn ON a.acronym = rn.acronym AND a.n = rn.n_rollup""")
def k_split_counts(spark, d):
    c = stored_cells(spark, d)
    from .bindings import table
    gone = table(spark, d, "region").where("r_regionkey = 0").select(F.col("r_name").alias("acronym"))
    roll = (c.join(gone, "acronym", "left_anti").groupBy("acronym")
            .agg(F.count("*").alias("N_rollup")))
    return tidy(M.k_split_counts(c, PANEL, KS, K, roll))


@query("detector_gate_counts", """WITH a AS (SELECT sum(area_mm2) AS t FROM fx_region_area)
    SELECT section, count(*) AS n, count(*) FILTER (fos_bgsub >= 5000) AS first_n, count(*) FILTER (tdt_bgsub >= 250) AS second_n,
      count(*) FILTER (fos_bgsub >= 5000 AND tdt_bgsub >= 250) AS double_n,
      round(CASE WHEN count(*) FILTER (tdt_bgsub >= 250) > 0 THEN count(*) FILTER (fos_bgsub >= 5000 AND tdt_bgsub >= 250)
        / count(*) FILTER (tdt_bgsub >= 250) END, 6) AS ratio, round(count(*) / any_value(t), 6) AS density
    FROM fx_cells CROSS JOIN a GROUP BY section""")
def detector_gate_counts(spark, d):
    return tidy(M.detector_gate_counts(cells(spark, d), "fos_bgsub", "tdt_bgsub",
                                       {"fos_bgsub": 5000.0, "tdt_bgsub": 250.0}, view(spark, d, "fx_region_area")))


@query("reclassify_by_scope", """WITH m1 AS (SELECT section, acronym, median(fos_bgsub) AS fm, median(tdt_bgsub) AS tm
      FROM fx_cells GROUP BY section, acronym),
    m2 AS (SELECT c.section, c.acronym, any_value(fm) AS fm, any_value(tm) AS tm,
      CAST(1.4826 AS DOUBLE) * median(abs(fos_bgsub - fm)) AS fs, CAST(1.4826 AS DOUBLE) * median(abs(tdt_bgsub - tm)) AS ts
      FROM fx_cells c JOIN m1 ON c.section = m1.section AND c.acronym = m1.acronym GROUP BY c.section, c.acronym),
    k AS (SELECT c.*, fos_bgsub >= fm + 1.0 * fs AS f, tdt_bgsub >= 300.0 AS t FROM fx_cells c
      JOIN m2 ON c.section = m2.section AND c.acronym = m2.acronym)
    SELECT section, acronym, CASE WHEN f AND t THEN 'Double+' WHEN f THEN 'fos+' WHEN t THEN 'tdt+' ELSE 'Negative' END AS class,
      count(*) AS n FROM k GROUP BY ALL""")
def reclassify_by_scope(spark, d):
    from ..config import Marker, Panel
    panel = Panel(markers=(Marker("fos", "nuclear"), Marker("tdt", "whole-cell", absolute=300.0)), k_robust=K)
    out = M.reclassify_by_scope(stored_cells(spark, d), panel, ("section", "acronym"))
    return tidy(out.groupBy("section", "acronym", "class").agg(F.count("*").alias("n")))


@query("classifiable", """SELECT section, 'fos' AS marker, count(*) AS n FROM fx_cells WHERE NOT excluded GROUP BY section
    UNION ALL SELECT section, 'tdt', count(*) FROM fx_cells WHERE NOT excluded GROUP BY section""")
def classifiable(spark, d):
    c = cells(spark, d)
    parts = [M.classifiable(c, m).groupBy("section").agg(F.count("*").alias("n")).withColumn("marker", F.lit(m))
             for m in PANEL.names]
    return tidy(parts[0].unionByName(parts[1]))


@query("joint_classifiable", "SELECT section, acronym, count(*) AS n FROM fx_cells WHERE NOT excluded GROUP BY section, acronym")
def joint_classifiable(spark, d):
    return tidy(M.joint_classifiable(cells(spark, d), PANEL).groupBy("section", "acronym").agg(F.count("*").alias("n")))


@query("role_flags", "SELECT section, tagged, activity, count(*) AS n FROM flagged GROUP BY section, tagged, activity")
def role_flags(spark, d):
    return tidy(M.role_flags(classed(spark, d), PANEL).groupBy("section", "tagged", "activity").agg(F.count("*").alias("n")))


@query("inspect_band", """SELECT section, CASE WHEN tdt_bgsub > 100 AND tdt_bgsub <= 200 THEN concat(class, ': InspectBand')
    ELSE class END AS class, count(*) AS n FROM classed GROUP BY ALL""")
def inspect_band(spark, d):
    return tidy(M.inspect_band(classed(spark, d), "tdt_bgsub", 100.0, 200.0).groupBy("section", "class").agg(F.count("*").alias("n")))


@query("crop_cells", "SELECT cell_id, section, x, y FROM fx_cells WHERE NOT excluded AND y >= 1024 AND y < 1536 AND x >= 2048 AND x < 2560")
def crop_cells(spark, d):
    return tidy(M.crop_cells(cells(spark, d), "fos", 1024.0, 2048.0, 512.0).select("cell_id", "section", "x", "y"))


@query("dense_tiles", f"""SELECT section, CAST(floor(y / 512) AS BIGINT) * 512.0::DOUBLE AS y0, CAST(floor(x / 512) AS BIGINT) * 512.0::DOUBLE AS x0,
    count(*) AS positives FROM cells_s WHERE NOT excluded AND {p('tdt', 1.0)} GROUP BY section, floor(y / 512), floor(x / 512)
    QUALIFY row_number() OVER (PARTITION BY section ORDER BY count(*) DESC, floor(y / 512), floor(x / 512)) <= 6""")
def dense_tiles(spark, d):
    return tidy(M.dense_tiles(stored_cells(spark, d), PANEL, "tdt", K, 512.0, 6))


@query("category_counts", """SELECT section, acronym, count(*) FILTER (class <> 'Excluded') AS anchor_count,
    count(*) FILTER (class IN ('fos+', 'Double+')) AS fos_pos_count, count(*) FILTER (class IN ('tdt+', 'Double+')) AS tdt_pos_count,
    count(*) FILTER (class = 'Double+') AS double_count FROM classed GROUP BY section, acronym""")
def category_counts(spark, d):
    return tidy(R.category_counts(classed(spark, d), PANEL, ["section", "acronym"]))


@query("class_breakdown", """WITH b AS (SELECT section, count(*) AS total, count(*) FILTER (class = 'Excluded') AS excluded_n,
      count(*) FILTER (class = 'Negative') AS negative_n, count(*) FILTER (class = 'Double+') AS double_n,
      count(*) FILTER (class = 'fos+') AS fos_only_n, count(*) FILTER (class = 'tdt+') AS tdt_only_n,
      count(*) FILTER (class <> 'Excluded') AS classified_n FROM classed GROUP BY section)
    SELECT *, round(100.0 * negative_n / classified_n, 6) AS negative_pct, round(100.0 * double_n / classified_n, 6) AS double_pct,
      round(100.0 * fos_only_n / classified_n, 6) AS fos_only_pct, round(100.0 * tdt_only_n / classified_n, 6) AS tdt_only_pct,
      fos_only_n + double_n AS fos_total_n, tdt_only_n + double_n AS tdt_total_n,
      round(CASE WHEN fos_only_n + double_n > 0 THEN double_n / (fos_only_n + double_n) END, 6) AS double_per_fos,
      round(CASE WHEN tdt_only_n + double_n > 0 THEN double_n / (tdt_only_n + double_n) END, 6) AS double_per_tdt FROM b""")
def class_breakdown(spark, d):
    return tidy(R.class_breakdown(classed(spark, d), PANEL, ["section"]))


@query("class_rollup_per_region", """SELECT acronym, count(*) FILTER (class = 'Excluded') AS excluded_n,
    count(*) FILTER (class = 'Negative') AS negative_n, count(*) FILTER (class = 'fos+') AS fos_pos_n,
    count(*) FILTER (class = 'tdt+') AS tdt_pos_n, count(*) FILTER (class = 'Double+') AS double_pos_n FROM classed GROUP BY acronym""")
def class_rollup_per_region(spark, d):
    return tidy(R.class_rollup_per_region(classed(spark, d), PANEL))


@query("density_by_region", """SELECT c.acronym, n_nuclei, round(area_mm2, 6) AS area_mm2, round(n_nuclei / area_mm2, 6) AS density_per_mm2
    FROM (SELECT acronym, count(*) AS n_nuclei FROM fx_cells GROUP BY acronym) c
    JOIN (SELECT acronym, sum(area_mm2) AS area_mm2 FROM fx_region_area GROUP BY acronym) a ON a.acronym = c.acronym""")
def density_by_region(spark, d):
    return tidy(R.density_by_region(cells(spark, d), view(spark, d, "fx_region_area")))


@query("double_tagged_ratio", """SELECT CASE WHEN grouping(acronym) = 1 THEN '__all__' ELSE acronym END AS acronym,
    count(*) FILTER (class = 'Double+') AS n_double, count(*) FILTER (class = 'tdt+') AS n_tagged,
    round(CASE WHEN count(*) FILTER (class = 'tdt+') > 0 THEN count(*) FILTER (class = 'Double+') / count(*) FILTER (class = 'tdt+') END, 6) AS ratio,
    round(CASE WHEN count(*) FILTER (class IN ('tdt+', 'Double+')) > 0 THEN count(*) FILTER (class = 'Double+')
      / count(*) FILTER (class IN ('tdt+', 'Double+')) END, 6) AS coexpression FROM classed GROUP BY ROLLUP (acronym)""")
def double_tagged_ratio(spark, d):
    return tidy(R.double_tagged_ratio(classed(spark, d), "tdt"))


@query("control_rate", """WITH t AS (SELECT list(n_name) AS l FROM nation WHERE n_nationkey < 6),
    a AS (SELECT count(*) FILTER (acronym LIKE 'NATION_1%') AS prefix_n,
      count(*) FILTER (acronym LIKE 'NATION_1%' AND class IN ('fos+', 'Double+')) AS prefix_pos,
      count(*) FILTER (list_contains(l, acronym)) AS list_n,
      count(*) FILTER (list_contains(l, acronym) AND class IN ('fos+', 'Double+')) AS list_pos FROM classed CROSS JOIN t)
    SELECT *, round(CASE WHEN prefix_n > 0 THEN prefix_pos / prefix_n END, 6) AS prefix_rate,
      round(CASE WHEN list_n > 0 THEN list_pos / list_n END, 6) AS list_rate FROM a""")
def control_rate(spark, d):
    from .bindings import table
    tracts = table(spark, d, "nation").where("n_nationkey < 6").select(F.col("n_name").alias("acronym"))
    return tidy(R.control_rate(classed(spark, d), "fos", "NATION_1", tracts))


@query("marker_only_rates", """WITH o AS (SELECT sum(CASE WHEN r > 45 THEN 1 ELSE 0 END) / count(*) AS v FROM fx_objects),
    c AS (SELECT count(*) FILTER (class = 'Double+') AS dd, count(*) FILTER (class IN ('tdt+', 'Double+')) AS t FROM classed)
    SELECT 'object rate' AS quantity, round(v, 6) AS value FROM o UNION ALL SELECT 'anchored rate', round(dd / t, 6) FROM c
    UNION ALL SELECT 'anchored tagged', t::DOUBLE FROM c UNION ALL SELECT 'anchored double', dd::DOUBLE FROM c""")
def marker_only_rates(spark, d):
    objects = view(spark, d, "fx_objects").groupBy("marker").agg(
        F.count("*").alias("object_n"), E.count_where(F.col("r") > 45).alias("double_n"))
    return tidy(R.marker_only_rates(objects, classed(spark, d), "tdt"))


@query("k_set_union", """SELECT k, count(*) AS sources FROM (SELECT round(0.5 + i * 0.25, 6)::DOUBLE AS k FROM range(0, 7) t(i)
    UNION ALL SELECT DISTINCT round(l_quantity::DOUBLE / 20, 6) FROM lineitem) GROUP BY k""")
def k_set_union(spark, d):
    """A ladder and the cut levels that a table of settings names."""
    named = table(spark, d, "lineitem").select((F.col("l_quantity").cast("double") / 20).alias("k"))
    return tidy(M.build_k_set(named, 0.5, 2.0, 0.25))


@query("split_hemisphere_label", """SELECT CASE WHEN lower(region) LIKE 'left: %' THEN 'Left' WHEN lower(region) LIKE 'right: %' THEN 'Right' ELSE '' END AS hemi,
    split_part(region, ': ', -1) AS acronym, count(*) AS n FROM fx_reference GROUP BY ALL""")
def split_hemisphere_label(spark, d):
    return tidy(view(spark, d, "fx_reference").groupBy(
        E.hemisphere_of("region").alias("hemi"), E.acronym_of("region").alias("acronym")).agg(F.count("*").alias("n")))


@query("section_label", """SELECT DISTINCT concat(section, '_MIP.ome.tiff - ', section, '__id1__percell_export.tsv') AS file, section AS label FROM fx_cells""")
def section_label(spark, d):
    name = F.concat("section", F.lit("_MIP.ome.tiff - "), "section", F.lit("__id1__percell_export.tsv"))
    return cells(spark, d).select("section").distinct().select(
        name.alias("file"), E.section_of_file(name).alias("label"))


@query("slice_identity", """SELECT section, animal, concat('s', split_part(section, '_s', 2)) AS slice_id,
    'M5' AS declared_animal, section AS declared_slice_id, count(*) AS n FROM fx_cells GROUP BY section, animal""")
def slice_identity(spark, d):
    a, b = E.slice_identity("section"), E.slice_identity("section", "M5")
    return tidy(cells(spark, d).groupBy("section").agg(F.count("*").alias("n")).select(
        "section", a["animal"].alias("animal"), a["slice_id"].alias("slice_id"),
        b["animal"].alias("declared_animal"), b["slice_id"].alias("declared_slice_id"), "n"))


@query("union_sections", """SELECT section, acronym, count(*) AS n, CAST(sum(cnt) AS BIGINT) AS exported FROM (
    SELECT section, acronym, NULL AS cnt FROM fx_cells UNION ALL SELECT section, acronym, cnt FROM fx_raw_regions) GROUP BY section, acronym""")
def union_sections(spark, d):
    """Sections of both exports under each other."""
    both = R.union_frames([cells(spark, d).select("section", "acronym"), view(spark, d, "fx_raw_regions").select("section", "acronym", "cnt")])
    return tidy(both.groupBy("section", "acronym").agg(F.count("*").alias("n"), F.sum("cnt").alias("exported")))


@query("section_sample", """SELECT cell_id, section, class FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY (cell_id * 48271 + 11) % 2147483647, cell_id) AS rn
    FROM classed WHERE class <> 'Excluded') WHERE rn <= 5""")
def section_sample(spark, d):
    return tidy(M.section_sample(classed(spark, d).where(F.col("class") != "Excluded"), 5).select("cell_id", "section", "class"))
