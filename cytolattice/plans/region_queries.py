"""Queries on the region tree, section read-outs and subject roll-ups."""

from pyspark.sql import Window as W, functions as F

from ..functions import exprs as E
from ..operators import hierarchy as H
from ..operators import markers as M
from ..operators import rollup as R
from ..session import settle
from .bindings import PANEL, table, view
from .cell_queries import cells, classed
from .registry import query, tidy

COUNTS = PANEL.count_columns


def edges(spark, d):
    return view(spark, d, "fx_edges")


def closure(spark, d):
    return H.ontology_closure(edges(spark, d))


def excluded(spark, d):
    return view(spark, d, "fx_excluded")


def region_rows(spark, d):
    """Region table: counts per section, hemisphere and acronym with the region's area."""
    counts = R.category_counts(classed(spark, d), PANEL, ["animal", "section", "hemisphere", "acronym"])
    area = view(spark, d, "fx_region_area")
    return settle(counts.join(area, ["acronym", "hemisphere"]), "region-rows")


def readout(spark, d):
    cl = closure(spark, d)
    out = H.region_readout(region_rows(spark, d), cl, excluded(spark, d), PANEL, edges(spark, d))
    return out.withColumn("animal", E.slice_identity("section")["animal"])


def animals(spark, d):
    return R.animal_rollup(readout(spark, d).withColumn("project", F.lit("p1")), PANEL)


def animal_metrics(spark, d):
    rows = R.n_source_select(animals(spark, d), PANEL, "anchor")
    return R.engram_metrics(rows, PANEL)


METRICS_SQL = """round(CASE WHEN n > 0 THEN tdt_pos_count / n END, 6) AS tagging_rate,
    round(CASE WHEN n > 0 THEN fos_pos_count / n END, 6) AS activity_rate,
    round(CASE WHEN tdt_pos_count > 0 THEN double_count / tdt_pos_count END, 6) AS reactivation_rate,
    round(CASE WHEN fos_pos_count > 0 THEN double_count / fos_pos_count END, 6) AS reverse_rate,
    round(CASE WHEN tdt_pos_count > 0 AND fos_pos_count > 0 THEN (double_count * n) / (tdt_pos_count::DOUBLE * fos_pos_count) END, 6) AS overlap_above_chance,
    round(CASE WHEN n - tdt_pos_count - fos_pos_count + double_count > 0 AND double_count > 0 AND tdt_pos_count > double_count
      AND fos_pos_count > double_count AND n > 0 THEN log2((double_count::DOUBLE * (n - tdt_pos_count - fos_pos_count + double_count))
      / ((tdt_pos_count - double_count)::DOUBLE * (fos_pos_count - double_count))) END, 6) AS log2_odds_ratio,
    round(CASE WHEN n - tdt_pos_count - fos_pos_count + double_count >= 0 AND n > 0 THEN
      log2(((double_count + 0.5::DOUBLE) * (n - tdt_pos_count - fos_pos_count + double_count + 0.5::DOUBLE))
      / ((tdt_pos_count - double_count + 0.5::DOUBLE) * (fos_pos_count - double_count + 0.5::DOUBLE))) END, 6) AS log2_odds_ratio_hc,
    round(CASE WHEN tdt_pos_count + fos_pos_count - double_count > 0 THEN double_count / (tdt_pos_count + fos_pos_count - double_count) END, 6) AS jaccard"""
DENS_SQL = ", ".join(f"round({c} / area_mm2, 6) AS {c.replace('_count', '_density')}" for c in COUNTS)
COUNT_SQL = ", ".join(COUNTS)
NAMES = ["tagging_rate", "activity_rate", "reactivation_rate", "reverse_rate", "overlap_above_chance",
         "log2_odds_ratio", "log2_odds_ratio_hc", "jaccard"]


@query("flagship", f"""SELECT animal, region, hemisphere, level, n_slices, round(area_mm2, 6) AS area_mm2, {COUNT_SQL},
    round(n, 6) AS "N", {METRICS_SQL} FROM animal_metrics""")
def flagship(spark, d):
    """Cuts, classes, region counts, frontier roll-up, subject pooling and the metric family in one plan."""
    return tidy(animal_metrics(spark, d).select("animal", "region", "hemisphere", "level", "n_slices", "area_mm2",
                                                *COUNTS, "N", *NAMES))


@query("ontology_closure", "SELECT ancestor, descendant, CAST(distance AS BIGINT) AS distance FROM closure")
def ontology_closure(spark, d):
    return tidy(closure(spark, d))


@query("exclude_regions", "SELECT acronym, count(*) AS n FROM fx_cells WHERE acronym NOT IN (SELECT acronym FROM exclc) GROUP BY acronym")
def exclude_regions(spark, d):
    return tidy(H.exclude_regions(cells(spark, d), closure(spark, d), excluded(spark, d))
                .groupBy("acronym").agg(F.count("*").alias("n")))


@query("frontier_leaves", "SELECT section, acronym FROM frontier")
def frontier_leaves(spark, d):
    return H.frontier_leaves(region_rows(spark, d).select("section", "acronym"), closure(spark, d))


@query("included_leaves", "SELECT section, region, leaf FROM pairs")
def included_leaves(spark, d):
    return H.included_leaves(region_rows(spark, d), closure(spark, d), excluded(spark, d), edges(spark, d))


@query("level_of_region", """SELECT DISTINCT p.section, p.region, CASE WHEN f.acronym IS NULL THEN 'summary' ELSE 'leaf' END AS level
    FROM pairs p LEFT JOIN frontier f ON f.section = p.section AND f.acronym = p.region""")
def level_of_region(spark, d):
    rows, cl = region_rows(spark, d), closure(spark, d)
    pairs = H.included_leaves(rows, cl, excluded(spark, d), edges(spark, d))
    return H.level_of_region(pairs, H.frontier_leaves(rows, cl))


@query("region_readout", f"""SELECT section, region, hemisphere, level, round(area_mm2, 6) AS area_mm2, {COUNT_SQL}, {DENS_SQL},
    round(CASE WHEN fos_pos_count > 0 THEN double_count / fos_pos_count END, 6) AS p_tdt_given_fos,
    round(CASE WHEN tdt_pos_count > 0 THEN double_count / tdt_pos_count END, 6) AS p_fos_given_tdt FROM readout""")
def region_readout(spark, d):
    return tidy(readout(spark, d).drop("animal"))


@query("ancestor_rollup", """SELECT r.section, c.ancestor AS region, CAST(sum(anchor_count) AS BIGINT) AS anchor_count,
    CAST(sum(fos_pos_count) AS BIGINT) AS fos_pos_count, CAST(sum(tdt_pos_count) AS BIGINT) AS tdt_pos_count,
    CAST(sum(double_count) AS BIGINT) AS double_count FROM region_rows r JOIN closure c ON c.descendant = r.acronym
    GROUP BY r.section, c.ancestor""")
def ancestor_rollup(spark, d):
    return tidy(H.ancestor_rollup(region_rows(spark, d), closure(spark, d), COUNTS))


@query("zero_leak_from_csv", """SELECT slice, config_tag, marker, class,
    CAST(coalesce(sum(cnt) FILTER (is_leaf), 0) AS BIGINT) AS leaf_sum, max(cnt) FILTER (NOT is_leaf) AS root_count,
    CASE WHEN max(cnt) FILTER (NOT is_leaf) IS NULL THEN 'SKIP'
         WHEN coalesce(sum(cnt) FILTER (is_leaf), 0) = max(cnt) FILTER (NOT is_leaf) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM ref GROUP BY slice, config_tag, marker, class""")
def zero_leak_from_csv(spark, d):
    from ..sources.writers import keep_last
    ref = keep_last(view(spark, d, "fx_reference"), ["config_tag", "slice", "region", "marker", "class"], "seq")
    return tidy(H.zero_leak_from_rows(ref))


@query("frontier_coverage", """WITH full_rows AS (SELECT section, hemisphere, acronym, anchor_count FROM region_rows
      UNION ALL SELECT section, hemisphere, 'root', sum(anchor_count) FROM region_rows GROUP BY section, hemisphere)
    SELECT r.section, r.hemisphere, CAST(coalesce(sum(anchor_count) FILTER (f.acronym IS NOT NULL AND r.acronym NOT IN (SELECT acronym FROM exclc)), 0) AS BIGINT) AS frontier_n,
      CAST(coalesce(sum(anchor_count) FILTER (r.acronym = 'root'), 0) AS BIGINT) AS root_n,
      round(100.0 * coalesce(sum(anchor_count) FILTER (f.acronym IS NOT NULL AND r.acronym NOT IN (SELECT acronym FROM exclc)), 0)
        / sum(anchor_count) FILTER (r.acronym = 'root'), 1) AS coverage_pct
    FROM full_rows r LEFT JOIN frontier f ON f.section = r.section AND f.acronym = r.acronym GROUP BY r.section, r.hemisphere""")
def frontier_coverage(spark, d):
    rows = region_rows(spark, d).select("section", "hemisphere", "acronym", "anchor_count")
    root = rows.groupBy("section", "hemisphere").agg(F.sum("anchor_count").alias("anchor_count")).withColumn("acronym", F.lit("root"))
    return tidy(H.frontier_coverage(rows.unionByName(root), closure(spark, d), excluded(spark, d), "anchor_count", "root"))


@query("warn_empty_regions", """SELECT c.acronym AS region FROM closure k JOIN (SELECT acronym, count(*) FILTER (class <> 'Excluded') AS n
    FROM classed GROUP BY acronym) c ON k.descendant = c.acronym WHERE k.distance = 0 AND n = 0""")
def warn_empty_regions(spark, d):
    roll = R.category_counts(classed(spark, d), PANEL, ["acronym"]).withColumnRenamed("acronym", "region")
    return H.warn_empty_regions(roll, "anchor_count")


@query("division_of", """SELECT e.acronym, (SELECT arg_min(ancestor, distance) FROM closure c WHERE c.descendant = e.acronym
    AND c.ancestor IN (SELECT r_name FROM region WHERE r_regionkey < 3)) AS division FROM fx_edges e""")
def division_of(spark, d):
    div = table(spark, d, "region").where("r_regionkey < 3").select(F.col("r_name").alias("acronym"))
    return H.division_of(closure(spark, d), div)


@query("label_presence_mask", """SELECT e.acronym, coalesce(bit_or(CASE project WHEN 'early' THEN 1 WHEN 'late' THEN 2 WHEN 'set aside' THEN 4 END), 0)::BIGINT AS mask,
    count(*) FILTER (project = 'early') AS n_0, count(*) FILTER (project = 'late') AS n_1, count(*) FILTER (project = 'set aside') AS n_2
    FROM fx_edges e LEFT JOIN (SELECT acronym, CASE WHEN excluded THEN 'set aside' WHEN animal < 'A1995' THEN 'early' ELSE 'late' END AS project
      FROM fx_cells) c ON c.acronym = e.acronym GROUP BY e.acronym""")
def label_presence_mask(spark, d):
    """Three projects made of all cells."""
    project = F.when(F.col("excluded"), "set aside").when(F.col("animal") < "A1995", "early").otherwise("late")
    return tidy(H.label_presence_mask(cells(spark, d).select("acronym", project.alias("project")), edges(spark, d), ["early", "late", "set aside"]))


@query("focus_sets", """WITH roots AS (SELECT 'west' AS focus, r_name AS acronym FROM region WHERE r_regionkey < 2
      UNION ALL SELECT 'odd', n_name FROM nation WHERE n_nationkey % 2 = 1 UNION ALL SELECT 'odd', r_name FROM region WHERE r_regionkey = 4)
    SELECT DISTINCT focus, descendant AS acronym FROM roots JOIN closure ON ancestor = acronym""")
def focus_sets(spark, d):
    reg, nat = table(spark, d, "region"), table(spark, d, "nation")
    roots = (reg.where("r_regionkey < 2").select(F.lit("west").alias("focus"), F.col("r_name").alias("acronym"))
             .unionByName(nat.where("n_nationkey % 2 = 1").select(F.lit("odd").alias("focus"), F.col("n_name").alias("acronym")))
             .unionByName(reg.where("r_regionkey = 4").select(F.lit("odd").alias("focus"), F.col("r_name").alias("acronym"))))
    return H.focus_sets(closure(spark, d), roots)


_TERMS = """SELECT concat('term ', n_regionkey) AS term, CASE WHEN n_regionkey = 0 THEN 'collision' ELSE 'synonym' END AS kind,
      list(n_name) AS members, list(CASE WHEN n_nationkey % 5 = 0 THEN n_name ELSE concat('Alias ', n_nationkey % 7) END) AS also
    FROM nation GROUP BY n_regionkey"""


@query("term_resolution", f"""WITH terms AS ({_TERMS}),
    keys AS (SELECT term, term AS key FROM terms UNION ALL
      SELECT term, a FROM (SELECT term, kind, unnest(also) AS a FROM terms) WHERE kind = 'collision' OR a NOT IN (SELECT acronym FROM fx_edges)),
    k2 AS (SELECT term, lower(replace(key, ' ', '')) AS lookup FROM keys)
    SELECT k.term, k.lookup, (SELECT string_agg(m, ',' ORDER BY m) FROM (SELECT DISTINCT unnest(members) AS m FROM terms t WHERE t.term = k.term)) AS members,
      count(DISTINCT k.term) OVER (PARTITION BY k.lookup) > 1 AS clash FROM k2 k""")
def term_resolution(spark, d):
    nat = table(spark, d, "nation")
    also = F.when(F.col("n_nationkey") % 5 == 0, F.col("n_name")).otherwise(F.concat(F.lit("Alias "), F.col("n_nationkey") % 7))
    terms = nat.groupBy("n_regionkey").agg(F.collect_list("n_name").alias("members"), F.collect_list(also).alias("also")).select(
        F.concat(F.lit("term "), "n_regionkey").alias("term"),
        F.when(F.col("n_regionkey") == 0, "collision").otherwise("synonym").alias("kind"), "members", "also")
    return H.term_resolution(terms, edges(spark, d))


@query("confusable_groups", """SELECT left(acronym, 8) AS grp, count(DISTINCT acronym) AS n, string_agg(DISTINCT acronym, ',' ORDER BY acronym) AS members
    FROM fx_edges WHERE acronym IN (SELECT acronym FROM fx_cells) GROUP BY left(acronym, 8) HAVING count(DISTINCT acronym) >= 2""")
def confusable_groups(spark, d):
    groups = cells(spark, d).select(F.substring("acronym", 1, 8).alias("grp"), "acronym").distinct()
    return tidy(H.confusable_groups(groups, edges(spark, d)))


@query("unknown_labels", """SELECT lab AS acronym, count(*) AS n FROM (SELECT CASE WHEN cell_id % 3 = 0 THEN concat(acronym, '?') ELSE acronym END AS lab FROM fx_cells)
    WHERE lab NOT IN (SELECT acronym FROM fx_edges) GROUP BY lab""")
def unknown_labels(spark, d):
    lab = F.when(F.col("cell_id") % 3 == 0, F.concat("acronym", F.lit("?"))).otherwise(F.col("acronym"))
    return tidy(H.unknown_labels(cells(spark, d).select(lab.alias("acronym")), edges(spark, d)))


@query("atlas_availability", """SELECT coalesce(e.acronym, c.acronym) AS acronym, e.acronym IS NOT NULL AS in_first, c.acronym IS NOT NULL AS in_second
    FROM fx_edges e FULL JOIN (SELECT DISTINCT acronym FROM fx_cells WHERE NOT excluded) c ON c.acronym = e.acronym""")
def atlas_availability(spark, d):
    return H.atlas_availability(edges(spark, d), cells(spark, d).where(~F.col("excluded")).select("acronym"))


@query("classifiable_n", """SELECT c.animal, p.section, p.region, count(*) AS n_classifiable FROM pairs p
    JOIN fx_cells c ON c.section = p.section AND c.acronym = p.leaf WHERE NOT excluded GROUP BY c.animal, p.section, p.region""")
def classifiable_n(spark, d):
    pairs = H.included_leaves(region_rows(spark, d), closure(spark, d), excluded(spark, d), edges(spark, d))
    return tidy(R.classifiable_n(M.joint_classifiable(cells(spark, d), PANEL), pairs))


_CN = """SELECT c.animal, p.region, count(*) AS n_classifiable FROM pairs p
    JOIN fx_cells c ON c.section = p.section AND c.acronym = p.leaf WHERE NOT excluded AND c.fos_bgsub >= 0 GROUP BY c.animal, p.region"""
_WITH_N = f"""SELECT a.*, CASE WHEN a.hemisphere = 'both' THEN q.n_classifiable END AS n_classifiable
    FROM animals a LEFT JOIN ({_CN}) q ON q.animal = a.animal AND q.region = a.region"""


def with_classifiable_n(spark, d):
    rows, cl = region_rows(spark, d), closure(spark, d)
    pairs = H.included_leaves(rows, cl, excluded(spark, d), edges(spark, d))
    # A value below the background is no measure.
    c = cells(spark, d).withColumn("fos_bgsub", F.when(F.col("fos_bgsub") >= 0, F.col("fos_bgsub")))
    joint = M.joint_classifiable(c, PANEL)
    return R.attach_classifiable_n(animals(spark, d), R.classifiable_n(joint, pairs))


@query("attach_classifiable_n", f"SELECT animal, region, hemisphere, anchor_count, n_classifiable FROM ({_WITH_N})")
def attach_classifiable_n(spark, d):
    return tidy(with_classifiable_n(spark, d).select("animal", "region", "hemisphere", "anchor_count", "n_classifiable"))


@query("n_source_select", f"""SELECT animal, region, hemisphere, coalesce(n_classifiable, anchor_count)::DOUBLE AS "N",
    CASE WHEN n_classifiable IS NULL THEN 'anchor_count' ELSE 'classifiable' END AS "N_source" FROM ({_WITH_N})""")
def n_source_select(spark, d):
    return tidy(R.n_source_select(with_classifiable_n(spark, d), PANEL).select("animal", "region", "hemisphere", "N", "N_source"))


@query("n_source_split", f"""SELECT animal, count(n_classifiable) AS classifiable_rows, count(*) - count(n_classifiable) AS anchor_rows,
    round(avg(CASE WHEN anchor_count > 0 THEN n_classifiable / anchor_count END), 6) AS mean_ratio FROM ({_WITH_N}) GROUP BY animal""")
def n_source_split(spark, d):
    return tidy(R.n_source_split(R.n_source_select(with_classifiable_n(spark, d), PANEL)))


@query("animal_rollup", f"""SELECT animal, region, hemisphere, level, n_slices, 'p1' AS projects, round(area_mm2, 6) AS area_mm2,
    {COUNT_SQL}, {DENS_SQL} FROM animals""")
def animal_rollup(spark, d):
    return tidy(animals(spark, d))


@query("engram_metrics", f"""SELECT animal, region, hemisphere, {METRICS_SQL} FROM animal_metrics""")
def engram_metrics(spark, d):
    return tidy(animal_metrics(spark, d).select("animal", "region", "hemisphere", *NAMES))


@query("pool_same_animal", f"""WITH p AS (SELECT CASE WHEN animal < 'A1998' THEN 'early' ELSE 'late' END AS animal, region, hemisphere,
      CAST(sum(anchor_count) AS BIGINT) AS anchor_count, CAST(sum(fos_pos_count) AS BIGINT) AS fos_pos_count,
      CAST(sum(tdt_pos_count) AS BIGINT) AS tdt_pos_count, CAST(sum(double_count) AS BIGINT) AS double_count,
      sum(area_mm2) AS area_mm2, CAST(sum(n_slices) AS BIGINT) AS n_slices, string_agg(animal, ',' ORDER BY animal) AS projects,
      CAST(sum(anchor_count) AS DOUBLE) AS n FROM animals GROUP BY 1, 2, 3)
    SELECT animal, region, hemisphere, {COUNT_SQL}, n_slices, projects, round(area_mm2, 6) AS area_mm2, n AS "N", {DENS_SQL}, {METRICS_SQL} FROM p""")
def pool_same_animal(spark, d):
    rows = R.n_source_select(animals(spark, d), PANEL, "anchor").withColumn("projects", F.col("animal"))
    rows = rows.withColumn("animal", F.when(F.col("animal") < "A1998", "early").otherwise("late"))
    return tidy(R.pool_same_animal(rows, PANEL))


@query("stack_animals", """SELECT animal, region, hemisphere, anchor_count, fos_pos_count, round(CASE WHEN n > 0 THEN fos_pos_count / n END, 6) AS activity_rate
    FROM animal_metrics""")
def stack_animals(spark, d):
    """Two animal sets with different panels, stacked on the shared markers."""
    from ..config import Marker, Panel
    one = Panel(markers=(Marker("fos", "nuclear"),))
    both = animal_metrics(spark, d)
    a = both.where(F.col("animal") < "A1998")
    b = both.where(F.col("animal") >= "A1998").select("animal", "region", "hemisphere", "anchor_count", "fos_pos_count", "activity_rate")
    out = R.stack_animals([a, b], [PANEL, one], on_intersection=True)
    return tidy(out.select("animal", "region", "hemisphere", "anchor_count", "fos_pos_count", "activity_rate"))


@query("marker_set_check", """SELECT markers, count(*) AS projects FROM (SELECT p, string_agg(DISTINCT m, ',' ORDER BY m) AS markers FROM (SELECT user_id % 7 AS p,
    CASE WHEN user_id % 7 >= 5 AND event_type = 'click' THEN 'tap' ELSE event_type END AS m FROM events) GROUP BY p) GROUP BY markers""")
def marker_set_check(spark, d):
    other = (F.col("user_id") % 7 >= 5) & (F.col("event_type") == "click")
    ev = table(spark, d, "events").select((F.col("user_id") % 7).alias("project"), F.when(other, "tap").otherwise(F.col("event_type")).alias("marker"))
    return tidy(R.marker_set_check(ev))


@query("apply_groups", """SELECT CASE WHEN right(animal, 1) IN ('5', '7', '9', '1') THEN 'odd' ELSE 'even' END AS grp, region, count(*) AS n
    FROM animals GROUP BY 1, 2""")
def apply_groups(spark, d):
    return tidy(grouped_animals(spark, d).groupBy("grp", "region").agg(F.count("*").alias("n")))


def grouped_animals(spark, d):
    rows = settle(animal_metrics(spark, d), "animals")
    mapping = rows.select("animal").distinct().withColumn(
        "grp", F.when(F.substring("animal", -1, 1).isin("5", "7", "9", "1"), "odd").otherwise("even"))
    return R.apply_groups(rows, mapping)


@query("finite_usable", """SELECT animal, region, hemisphere, tdt_pos_count > 0 AND fos_pos_count > 0 AND anchor_count > 0 AS usable FROM animals""")
def finite_usable(spark, d):
    return R.finite_usable(animal_metrics(spark, d), ["overlap_above_chance"], "anchor_count").select(
        "animal", "region", "hemisphere", "usable")


@query("select_animal", "SELECT region, hemisphere, anchor_count FROM animals WHERE animal = 'A1997'")
def select_animal(spark, d):
    return tidy(R.select_animal(animals(spark, d), "A1997").select("region", "hemisphere", "anchor_count"))


@query("dapi_fractions", """SELECT animal, region, hemisphere, round(CASE WHEN anchor_count > 0 THEN tdt_pos_count / anchor_count END, 6) AS tagged_per_anchor,
    round(CASE WHEN anchor_count > 0 THEN fos_pos_count / anchor_count END, 6) AS activity_per_anchor,
    round(CASE WHEN anchor_count > 0 THEN double_count / anchor_count END, 6) AS double_per_anchor FROM animals""")
def dapi_fractions(spark, d):
    rows = R.n_source_select(animals(spark, d), PANEL, "anchor")
    return tidy(R.dapi_fractions(rows, PANEL).select("animal", "region", "hemisphere", "tagged_per_anchor",
                                                     "activity_per_anchor", "double_per_anchor"))


@query("evidence_flag", """SELECT animal, region, hemisphere, double_count, double_count < 30 AS below_min, double_count < 50 AS thin FROM animals""")
def evidence_flag(spark, d):
    return tidy(R.evidence_flag(animals(spark, d), "double_count").select("animal", "region", "hemisphere", "double_count", "below_min", "thin"))


@query("enrichment_band", """WITH e AS (SELECT animal, region, hemisphere, CASE WHEN tdt_pos_count > 0 AND fos_pos_count > 0 AND double_count > 0
      THEN log2(double_count::DOUBLE * anchor_count / (tdt_pos_count::DOUBLE * fos_pos_count)) END AS l FROM animals)
    SELECT animal, region, hemisphere, CASE WHEN l IS NULL OR abs(l) <= 0.05 THEN 'neutral' WHEN l > 0 THEN 'above' ELSE 'below' END AS band FROM e""")
def enrichment_band(spark, d):
    return R.enrichment(animal_metrics(spark, d)).select("animal", "region", "hemisphere", "band")


@query("advisory_band", """SELECT animal, region, CASE WHEN anchor_count = 0 THEN '' WHEN tdt_pos_count / anchor_count < 0.10 THEN 'below'
    WHEN tdt_pos_count / anchor_count > 0.14 THEN 'above' ELSE 'inside' END AS band FROM animals WHERE hemisphere = 'both'""")
def advisory_band(spark, d):
    rows = animals(spark, d).where(F.col("hemisphere") == "both")
    return rows.select("animal", "region", E.fraction_band(E.ratio("tdt_pos_count", "anchor_count"), 0.10, 0.14).alias("band"))


@query("hemisphere_asymmetry", """WITH p AS (SELECT animal, region, max(CASE WHEN hemisphere = 'L' AND tdt_pos_count > 0 THEN double_count / tdt_pos_count END) AS l,
      max(CASE WHEN hemisphere = 'R' AND tdt_pos_count > 0 THEN double_count / tdt_pos_count END) AS r FROM animals GROUP BY animal, region)
    SELECT animal, region, round(l, 6) AS left_value, round(r, 6) AS right_value, round(CASE WHEN l + r > 0 THEN abs(l - r) / ((l + r) / 2) END, 6) AS asymmetry,
      coalesce(CASE WHEN l + r > 0 THEN abs(l - r) / ((l + r) / 2) > 0.25 END, FALSE) AS flagged FROM p WHERE l IS NOT NULL AND r IS NOT NULL""")
def hemisphere_asymmetry(spark, d):
    return tidy(R.hemisphere_asymmetry(animal_metrics(spark, d), "reactivation_rate"))


@query("slice_spread", """WITH r AS (SELECT * FROM readout WHERE hemisphere = 'both' AND tdt_pos_count > 0),
    p AS (SELECT animal, region, sum(double_count) / sum(tdt_pos_count) AS pooled_rate, avg(double_count / tdt_pos_count) AS mean_of_sections FROM r GROUP BY animal, region)
    SELECT r.animal, r.region, section, round(double_count / tdt_pos_count, 6) AS rate, round(pooled_rate, 6) AS pooled_rate,
      round(mean_of_sections, 6) AS mean_of_sections FROM r JOIN p ON p.animal = r.animal AND p.region = r.region""")
def slice_spread(spark, d):
    return tidy(R.slice_spread(readout(spark, d), "tdt_pos_count"))


_OV = "CASE WHEN tdt_pos_count > 0 AND fos_pos_count > 0 THEN double_count::DOUBLE * anchor_count / (tdt_pos_count::DOUBLE * fos_pos_count) END"


@query("rank_regions", f"""SELECT region, round({_OV}, 6) AS overlap_above_chance FROM animals
    WHERE animal = 'A1997' AND hemisphere = 'both' ORDER BY {_OV} DESC NULLS LAST, region LIMIT 20""")
def rank_regions(spark, d):
    rows = R.select_animal(animal_metrics(spark, d), "A1997").where(F.col("hemisphere") == "both")
    return tidy(R.rank_regions(rows, ["overlap_above_chance", "reactivation_rate", "tagging_rate"]).select("region", "overlap_above_chance"))


@query("region_panels_order", f"""SELECT animal, region, round({_OV}, 6) AS overlap_above_chance FROM animals
    WHERE hemisphere = 'both' ORDER BY {_OV} DESC NULLS LAST, animal, region""")
def region_panels_order(spark, d):
    return tidy(R.region_panels_order(animal_metrics(spark, d), "overlap_above_chance").select("animal", "region", "overlap_above_chance"))


@query("group_comparison_order", f"""WITH g AS (SELECT CASE WHEN right(animal, 1) IN ('5', '7', '9', '1') THEN 'odd' ELSE 'even' END AS grp, region, {_OV} AS v
      FROM animals WHERE hemisphere = 'both' AND NOT (region LIKE 'A%' AND right(animal, 1) NOT IN ('5', '7', '9', '1'))),
    s AS (SELECT region, max(v) FILTER (grp = 'even') AS key, max(v) AS best, bool_or(grp = 'even') AS in_first FROM g GROUP BY region)
    SELECT region, row_number() OVER (ORDER BY in_first, CASE WHEN NOT in_first THEN region END DESC NULLS LAST, key NULLS LAST, region) AS place,
      round(key, 6) AS sort_key, round(best, 6) AS best, in_first FROM s""")
def group_comparison_order(spark, d):
    """Some regions are left out of the first group, so that the later one adds them."""
    rows = grouped_animals(spark, d).where(F.col("hemisphere") == "both").where(~(F.col("region").startswith("A") & (F.col("grp") == "even")))
    return tidy(R.group_comparison_order(rows, "overlap_above_chance", ["even", "odd"]))


@query("sink_wide_pivots", f"""WITH m AS (SELECT region, concat(CASE WHEN right(animal, 1) IN ('5', '7', '9', '1') THEN 'odd' ELSE 'even' END, ':', animal) AS label,
      {_OV} AS v FROM animals WHERE hemisphere = 'both')
    SELECT region, count(v) AS filled, round(sum(v), 6) AS total, count(DISTINCT label) AS labels FROM m GROUP BY region""")
def sink_wide_pivots(spark, d):
    """Write every pivot, read one back and fold its columns so that the shape stays fixed."""
    from ..session import scratch_path
    from ..sources import writers as S
    path = scratch_path(spark, "wide")
    rows = grouped_animals(spark, d).select("grp", "animal", "region", "hemisphere", "anchor_density", "overlap_above_chance")
    S.write_wide_pivots(rows, path)
    back = spark.read.csv(f"{path}/wide__overlap_above_chance", header=True)
    vals = [F.col(f"`{c}`").cast("double") for c in back.columns if c != "region"]
    filled = sum(F.when(v.isNotNull(), 1).otherwise(0) for v in vals)
    total = sum(F.coalesce(v, F.lit(0.0)) for v in vals)
    return tidy(back.select("region", filled.cast("long").alias("filled"),
                            F.when(filled > 0, total).alias("total"), F.lit(len(vals)).cast("long").alias("labels")))


@query("sink_long", f"""SELECT animal, region, hemisphere, {COUNT_SQL}, round({_OV}, 6) AS overlap_above_chance FROM animals""")
def sink_long(spark, d):
    from ..session import scratch_path
    from ..sources import writers as S
    path = scratch_path(spark, "long")
    S.write_long(animal_metrics(spark, d), path)
    back = spark.read.csv(path, header=True)
    return tidy(back.select("animal", "region", "hemisphere", *[F.col(c).cast("long").alias(c) for c in COUNTS],
                            F.col("overlap_above_chance").cast("double").alias("overlap_above_chance")))
