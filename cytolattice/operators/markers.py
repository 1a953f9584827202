"""Robust marker cuts, cell classes and everything that varies the multiplier k.

Cells carry ``excluded`` (boolean), ``acronym`` and one ``<marker>_bgsub`` column per declared
marker.  A cut belongs to a (section, marker): it is derived there and only applied in regions.
Every k of a sweep is a conditional sum in one pass, so a sweep never multiplies the cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import GateBands, Panel
from ..functions import (ROBUST_SCALE, above_chance, count_where, dbl, finite, in_band, ratio, verdict)
from ..session import settle
from .quantiles import grouped_mad

SECTION_ROW = "__section__"


def classifiable(cells: DataFrame, marker: str) -> DataFrame:
    """Not excluded and a finite measure."""
    return cells.where(~F.col("excluded") & finite(f"{marker}_bgsub"))


def joint_condition(panel: Panel) -> Column:
    return reduce(lambda a, b: a & b, [finite(m.measure) for m in panel.markers], ~F.col("excluded"))


def joint_classifiable(cells: DataFrame, panel: Panel) -> DataFrame:
    """Classifiable for every declared marker at once."""
    return cells.where(joint_condition(panel))


def long_measures(cells: DataFrame, panel: Panel, keys: list[str]) -> DataFrame:
    """(keys, marker, value) rows of the classifiable population, per marker."""
    args = ", ".join(f"'{m.name}', {m.measure}" for m in panel.markers)
    rows = (cells.where(~F.col("excluded"))
            .select(*keys, *[dbl(m.measure).alias(m.measure) for m in panel.markers])
            .select(*keys, F.expr(f"stack({len(panel.markers)}, {args}) AS (marker, value)")))
    return rows.where(finite("value"))


def robust_threshold(cells: DataFrame, panel: Panel, k: float | None = None,
                     keys: tuple[str, ...] = ("section",)) -> DataFrame:
    """median + k * 1.4826 * MAD per key and marker, with the statistics behind it."""
    keys = list(keys)
    stats = grouped_mad(long_measures(cells, panel, keys), keys + ["marker"], "value")
    ks = F.coalesce(*[F.when(F.col("marker") == m.name, F.lit(float(panel.k_for(m.name, k))))
                      for m in panel.markers])
    sd = F.lit(ROBUST_SCALE) * F.col("mad")
    return stats.select(*keys, "marker", F.col("n").cast("long").alias("n"), "median", "mad",
                        sd.alias("robust_sd"), ks.alias("k"),
                        (F.col("median") + ks * sd).alias("threshold"))


def widen(cuts: DataFrame, panel: Panel, keys: tuple[str, ...] = ("section",),
          fields: tuple[str, ...] = ("threshold",)) -> DataFrame:
    """One row per key with ``<marker>_<field>`` columns."""
    picks = [F.max(F.when(F.col("marker") == m, F.col(f))).alias(f"{m}_{f}")
             for m in panel.names for f in fields]
    return cuts.groupBy(*keys).agg(*picks)


def with_stats(cells: DataFrame, panel: Panel, keys: tuple[str, ...] = ("section",)) -> DataFrame:
    """Cells with ``<marker>_median``, ``<marker>_robust_sd`` and ``<marker>_n`` of their section."""
    wide = widen(robust_threshold(cells, panel, 0.0, keys), panel, keys, ("median", "robust_sd", "n"))
    return cells.join(settle(wide), list(keys), "left")


def cut_at(marker: str, k) -> Column:
    return F.col(f"{marker}_median") + F.lit(float(k)) * F.col(f"{marker}_robust_sd")


def positive_at(marker: str, k, strict: bool = False) -> Column:
    """The measure reaches the cut; ``strict`` needs it above.  NULL measures are not positive."""
    v, cut = dbl(f"{marker}_bgsub"), cut_at(marker, k)
    return F.coalesce(v > cut if strict else v >= cut, F.lit(False))


def class_from_flags(panel: Panel, flags: dict[str, Column], excluded: Column) -> Column:
    n_pos = reduce(lambda a, b: a + b, [f.cast("int") for f in flags.values()])
    out = F.when(excluded, "Excluded")
    if panel.emit_double:
        out = out.when(n_pos >= 2, "Double+")
    for name, flag in flags.items():
        out = out.when(flag, f"{name}+")
    return out.otherwise("Negative")


def classify_cells(cells: DataFrame, panel: Panel, k: float | None = None,
                   keys: tuple[str, ...] = ("section",)) -> DataFrame:
    """Compound class per cell from per-section cuts; exclusion wins."""
    cuts = widen(robust_threshold(cells, panel, k, keys), panel, keys)
    joined = cells.join(settle(cuts), list(keys), "left")
    flags = {m.name: F.coalesce(dbl(m.measure) >= F.col(f"{m.name}_threshold"), F.lit(False))
             for m in panel.markers}
    return joined.withColumn("class", class_from_flags(panel, flags, F.col("excluded")))


def reclassify_by_scope(cells: DataFrame, panel: Panel, scope: tuple[str, ...],
                        k: float | None = None) -> DataFrame:
    """Cuts per image or per ROI; a marker's absolute cut wins.  No exclusion class here."""
    cuts = widen(robust_threshold(cells.withColumn("excluded", F.lit(False)), panel, k, scope), panel, scope)
    joined = cells.join(settle(cuts), list(scope), "left")
    flags = {}
    for m in panel.markers:
        cut = F.lit(float(m.absolute)) if m.absolute is not None else F.col(f"{m.name}_threshold")
        flags[m.name] = F.coalesce(dbl(m.measure) >= cut, F.lit(False))
    return joined.withColumn("class", class_from_flags(panel, flags, F.lit(False)))


def role_flags(cells: DataFrame, panel: Panel) -> DataFrame:
    """Boolean tagged / activity from the class; Double+ is both.  Needs coordinates."""
    roles = panel.roles()
    return (cells.where((F.col("class") != "Excluded") & F.col("x").isNotNull() & F.col("y").isNotNull())
            .withColumn("tagged", F.col("class").isin(f"{roles.tagged}+", "Double+"))
            .withColumn("activity", F.col("class").isin(f"{roles.activity}+", "Double+")))


def inspect_band(cells: DataFrame, measure: str, low: float, high: float) -> DataFrame:
    """Append a tag to the class of cells with low < value <= high."""
    hit = (dbl(measure) > F.lit(low)) & (dbl(measure) <= F.lit(high))
    return cells.withColumn("class", F.when(hit, F.concat("class", F.lit(": InspectBand")))
                            .otherwise(F.col("class")))


def threshold_selfcheck(cells: DataFrame, panel: Panel, k: float | None = None) -> DataFrame:
    """n, median, robust SD, cut, positive fraction and a verdict per section and marker."""
    cuts = robust_threshold(cells, panel, k)
    pos = (long_measures(cells, panel, ["section"])
           .join(settle(cuts.select("section", "marker", "threshold")), ["section", "marker"])
           .groupBy("section", "marker").agg(count_where(F.col("value") >= F.col("threshold")).alias("n_pos")))
    frac = ratio("n_pos", "n")
    text = (F.when(F.col("threshold").isNull(), "CHECK: no data")
            .when(F.col("threshold") <= 0, "CHECK: cut not above background")
            .when(frac.isNull() | (frac <= 0), "CHECK: nothing positive")
            .when(frac > 0.5, "CHECK: more than half positive").otherwise("PASS"))
    return cuts.join(pos, ["section", "marker"], "left").select(
        "section", "marker", "n", "median", "robust_sd", "threshold",
        frac.alias("positive_fraction"), text.alias("verdict"))


def marker_summary(cells: DataFrame, panel: Panel, ks: list[float]) -> DataFrame:
    """n, median, MAD, robust SD, cut, positives and positive share per section, marker and k."""
    sweep = k_sweep(cells, panel, ks)
    stats = robust_threshold(cells, panel, 0.0).select("section", "marker", "n", "median", "mad", "robust_sd")
    return sweep.join(stats, ["section", "marker"]).select(
        "section", "marker", "k", "n", "median", "mad", "robust_sd", "threshold",
        F.col("count").alias("n_pos"), ratio("count", "n").alias("frac_pos"))


def build_k_set(configured: DataFrame, k_min: float, k_max: float, k_step: float) -> DataFrame:
    """Every k of a ladder joined with those configured (column ``k``, nulls ignored); distinct to 1e-6, with the
    number of sources that name it."""
    steps = max(int(round((k_max - k_min) / k_step)) + 1, 1)
    ladder = configured.sparkSession.range(steps).select((F.lit(float(k_min)) + F.col("id") * F.lit(float(k_step))).alias("k"))
    own = configured.select(F.round(F.col("k").cast("double"), 6).alias("k")).where("k IS NOT NULL").distinct()
    return ladder.select(F.round("k", 6).alias("k")).unionByName(own).groupBy("k").agg(F.count("*").alias("sources"))


def k_sweep(cells: DataFrame, panel: Panel, ks: list[float], bridge: DataFrame | None = None) -> DataFrame:
    """threshold, count and percent per section (and per bridged region group), marker and k."""
    stats = robust_threshold(cells, panel, 0.0).select("section", "marker", "median", "robust_sd")
    keys = ["section"] + (["region"] if bridge is not None else [])
    rows = long_measures(cells if bridge is None else cells.join(bridge, "acronym"),
                         panel, keys)
    rows = rows.join(settle(stats), ["section", "marker"])
    group = keys + ["marker", "median", "robust_sd"]
    cut = [F.col("median") + F.lit(float(k)) * F.col("robust_sd") for k in ks]
    agg = rows.groupBy(*group).agg(F.count("*").alias("n"),
                                   *[count_where(F.col("value") >= c).alias(f"_c{i}") for i, c in enumerate(cut)])
    items = F.array(*[F.struct(F.lit(float(k)).alias("k"), cut[i].alias("threshold"),
                               F.col(f"_c{i}").alias("count")) for i, k in enumerate(ks)])
    region = F.col("region") if bridge is not None else F.lit(SECTION_ROW)
    out = agg.select("section", region.alias("region"), "marker", "n", F.inline(items))
    return out.select("section", "region", "marker", "k", "threshold", "count",
                      F.coalesce(100.0 * ratio("count", "n"), F.lit(0.0)).alias("pct"))


def k_whiskers(cells: DataFrame, panel: Panel, ks: list[float], marker: str, bridge: DataFrame) -> DataFrame:
    """Middle, strict (largest k) and lenient (smallest k) counts and percents per section and group."""
    ordered = sorted(ks)
    lo, mid, hi = ordered[0], ordered[len(ordered) // 2], ordered[-1]
    one = with_stats(cells, panel).where(~F.col("excluded") & finite(f"{marker}_bgsub"))
    agg = (one.join(bridge, "acronym").groupBy("section", "region").agg(
        F.count("*").alias("n"),
        *[count_where(positive_at(marker, k)).alias(f"n_{tag}")
          for tag, k in (("mid", mid), ("strict", hi), ("lenient", lo))]))
    return agg.select("section", "region", "n", "n_mid", "n_strict", "n_lenient",
                      *[(100.0 * ratio(f"n_{t}", "n")).alias(f"pct_{t}") for t in ("mid", "strict", "lenient")])


def conditional_rate(cells: DataFrame, panel: Panel, target: str, condition: str, ks: list[float],
                     keys: tuple[str, ...] = ("section",)) -> DataFrame:
    """P(target+ | condition+) on the joint population, cuts from each marker's own population."""
    rows = joint_classifiable(with_stats(cells, panel), panel)
    aggs = []
    for i, k in enumerate(ks):
        c, t = positive_at(condition, k), positive_at(target, k)
        aggs += [count_where(c).alias(f"_d{i}"), count_where(c & t).alias(f"_n{i}")]
    items = F.array(*[F.struct(F.lit(float(k)).alias("k"), F.col(f"_n{i}").alias("numer"),
                               F.col(f"_d{i}").alias("denom")) for i, k in enumerate(ks)])
    out = rows.groupBy(*keys).agg(*aggs).select(*keys, F.inline(items))
    return out.withColumn("rate", ratio("numer", "denom"))


def k_stability(cells: DataFrame, panel: Panel, target: str, condition: str,
                bands: GateBands) -> DataFrame:
    """Swing of the conditional rate over the k ladder, in percentage points, with a verdict."""
    rates = conditional_rate(cells, panel, target, condition, list(bands.k_values))
    swing = (F.max("rate") - F.min("rate")) * 100.0
    return rates.groupBy("section").agg(swing.alias("value")).withColumn(
        "status", verdict(F.col("value") <= F.lit(bands.swing_max_pp)))


def k_stability_matrix(cells: DataFrame, panel: Panel, target: str, condition: str,
                       bands: GateBands) -> DataFrame:
    """One percent column per k, swing and PASS / FLAG per section."""
    rows = joint_classifiable(with_stats(cells, panel), panel)
    aggs, names = [], []
    for k in bands.k_values:
        name = "k_" + f"{k:g}".replace(".", "_")
        c, t = positive_at(condition, k), positive_at(target, k)
        aggs.append((100.0 * ratio(count_where(c & t), count_where(c))).alias(name))
        names.append(F.col(name))
    wide = rows.groupBy("section").agg(*aggs)
    swing = F.greatest(*names) - F.least(*names)
    return (wide.withColumn("swing_pp", swing)
            .withColumn("stable", F.when(F.col("swing_pp") <= bands.swing_max_pp, "PASS").otherwise("FLAG")))


def section_counts_at_k(cells: DataFrame, panel: Panel, k: float) -> DataFrame:
    """Total, excluded, positives per marker and all-marker positives per section."""
    rows = with_stats(cells, panel)
    flags = {m: ~F.col("excluded") & finite(f"{m}_bgsub") & positive_at(m, k) for m in panel.names}
    aggs = [F.count("*").alias("total"), count_where(F.col("excluded")).alias("excluded_n")]
    aggs += [count_where(f).alias(f"{m}_pos") for m, f in flags.items()]
    if panel.emit_double:
        aggs.append(count_where(reduce(lambda a, b: a & b, flags.values())).alias("double_pos"))
    return rows.groupBy("section").agg(*aggs)


def region_readout_at_k(cells: DataFrame, panel: Panel, target: str, condition: str, k: float) -> DataFrame:
    """Per section and region: positives, fraction, section baseline, raw and enriched co-labelling."""
    rows = (with_stats(cells, panel)
            .withColumn("_t", ~F.col("excluded") & finite(f"{target}_bgsub"))
            .withColumn("_c", ~F.col("excluded") & finite(f"{condition}_bgsub"))
            .withColumn("_tp", F.col("_t") & positive_at(target, k))
            .withColumn("_cp", F.col("_c") & positive_at(condition, k)))
    region = rows.groupBy("section", "acronym").agg(
        F.count("*").alias("n"), count_where(F.col("_t")).alias("t_n"),
        count_where(F.col("_tp")).alias("target_n"), count_where(F.col("_cp")).alias("condition_n"),
        count_where(F.col("_cp") & F.col("_t")).alias("denom"),
        count_where(F.col("_cp") & F.col("_tp")).alias("double_n"))
    base = region.groupBy("section").agg(ratio(F.sum("target_n"), F.sum("t_n")).alias("baseline"))
    raw = ratio("double_n", "denom")
    return region.join(base, "section").select(
        "section", "acronym", "n", "target_n", ratio("target_n", "t_n").alias("target_frac"),
        F.col("baseline").alias("baseline_frac"), "condition_n", "double_n", raw.alias("reactivation_raw"),
        ratio(raw, "baseline").alias("enrichment"))


def k_split_counts(cells: DataFrame, panel: Panel, ks: list[float], locked_k: float,
                   rollup_n: DataFrame) -> DataFrame:
    """Joint counts per region and k with section cuts; regions off the roll-up's N are dropped.

    ``rollup_n`` holds (acronym, N).  Regions match literally.
    """
    roles = panel.roles()
    rows = joint_classifiable(with_stats(cells, panel), panel)
    aggs = []
    for i, k in enumerate(ks):
        t, a = positive_at(roles.tagged, k), positive_at(roles.activity, k)
        aggs += [count_where(t).alias(f"_t{i}"), count_where(a).alias(f"_a{i}"), count_where(t & a).alias(f"_d{i}")]
    items = F.array(*[F.struct(F.lit(float(k)).alias("k"), F.col(f"_t{i}").alias("tagged_n"),
                               F.col(f"_a{i}").alias("activity_n"), F.col(f"_d{i}").alias("double_n"))
                      for i, k in enumerate(ks)])
    out = rows.groupBy("acronym").agg(F.count("*").alias("n"), *aggs)
    kept = out.join(rollup_n, "acronym").where(F.col("n") == F.col("N_rollup"))
    return (kept.select("acronym", "n", F.inline(items))
            .withColumn("tagged_pct", 100.0 * ratio("tagged_n", "n"))
            .withColumn("activity_pct", 100.0 * ratio("activity_n", "n"))
            .withColumn("overlap", above_chance("n", "tagged_n", "activity_n", "double_n")))


def detector_gate_counts(cells: DataFrame, first: str, second: str, cuts: dict[str, float],
                         area: DataFrame) -> DataFrame:
    """Positives of two stored (measure, cut) pairs, their overlap, and density over the summed area."""
    a = F.coalesce(dbl(first) >= F.lit(float(cuts[first])), F.lit(False))
    b = F.coalesce(dbl(second) >= F.lit(float(cuts[second])), F.lit(False))
    counts = cells.groupBy("section").agg(
        F.count("*").alias("n"), count_where(a).alias("first_n"), count_where(b).alias("second_n"),
        count_where(a & b).alias("double_n"))
    total = area.agg(F.sum("area_mm2").alias("total_area_mm2")).scalar()
    return counts.withColumn("total_area_mm2", total).select(
        "section", "n", "first_n", "second_n", "double_n",
        ratio("double_n", "second_n").alias("ratio"), ratio("n", "total_area_mm2").alias("density"))


def crop_cells(cells: DataFrame, marker: str, y: float, x: float, size: float) -> DataFrame:
    """Classifiable cells in a half-open window."""
    return classifiable(cells, marker).where(
        (F.col("y") >= y) & (F.col("y") < y + size) & (F.col("x") >= x) & (F.col("x") < x + size))


def dense_tiles(cells: DataFrame, panel: Panel, marker: str, k: float, size: float, n: int) -> DataFrame:
    """For each section the n tiles with most positives at k."""
    pos = classifiable(with_stats(cells, panel), marker).where(positive_at(marker, k))
    tiles = pos.groupBy("section", F.floor(F.col("y") / size).alias("ty"), F.floor(F.col("x") / size).alias("tx")).agg(F.count("*").alias("positives"))
    best = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("positives"), "ty", "tx"))
    return (tiles.withColumn("rn", best).where(F.col("rn") <= n)
            .select("section", (F.col("ty") * F.lit(float(size))).alias("y0"), (F.col("tx") * F.lit(float(size))).alias("x0"), "positives"))


def section_sample(cells: DataFrame, n: int) -> DataFrame:
    """n cells of each section by a repeatable draw on their ids."""
    draw = (F.col("cell_id") * 48271 + 11) % 2147483647
    rank = F.row_number().over(Window.partitionBy("section").orderBy(draw, "cell_id"))
    return cells.withColumn("rn", rank).where(F.col("rn") <= n).drop("rn")
