"""Quality gates: one aggregate and a verdict row (section, gate, value, status, advisory)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..config import GateBands, Panel
from ..functions import count_where, dbl, finite, in_band, ratio, verdict
from . import markers
from .rollup import region_density

GATES = ("nucleus_area_peak_um2", "k_swing_pp", "white_matter_density", "ventricle_density",
         "grey_density_median", "grey_contrast_cv", "total_density")


def histogram_mode(df: DataFrame, keys: list[str], value: str, width: float, cap: Column | None = None,
                   midpoint: bool = True) -> DataFrame:
    """Most populated bin per key; ties go to the lowest bin.

    ``cap`` is an upper limit evaluated on the group's maximum (``_max``): bins reach the first
    edge at or past it, values beyond the last edge fall out, and the last bin is closed.
    Counts are summed per (key, bin) first, so only bins are ranked.
    """
    v = dbl(value)
    rows = df.where(finite(value)).select(*keys, v.alias("_v"))
    bins = rows.groupBy(*keys, F.floor(F.col("_v") / width).alias("_bin")).agg(
        F.count("*").alias("_n"), F.max("_v").alias("_bmax"),
        count_where(F.col("_v") == F.floor(F.col("_v") / width) * width).alias("_edge"))
    if cap is not None:
        w = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(1))
        bins = bins.withColumn("_max", F.max("_bmax").over(w))
        edges = F.ceil((cap + F.lit(width)) / width)            # number of edges from 0
        last = edges - 2                                        # index of the last bin
        # Values exactly on the closing edge belong to the last bin; anything beyond drops out.
        bins = (bins.withColumn("_last", last)
                .withColumn("_keep", F.when(F.col("_bin") <= F.col("_last"), F.col("_n"))
                            .when(F.col("_bin") == F.col("_last") + 1, F.col("_edge")).otherwise(0))
                .withColumn("_bin", F.least("_bin", "_last")))
        bins = bins.groupBy(*keys, "_bin").agg(F.sum("_keep").alias("_n"))
    shift = width / 2.0 if midpoint else 0.0
    best = F.max_by(F.struct("_bin", "_n"), F.struct("_n", -F.col("_bin")))
    return (bins.groupBy(*keys).agg(best.alias("_b"), F.sum("_n").cast("long").alias("n"))
            .select(*keys, (F.col("_b._bin") * F.lit(float(width)) + F.lit(shift)).alias("mode"),
                    F.col("_b._n").cast("long").alias("mode_count"), "n"))


def _row(df: DataFrame, gate: str, ok: Column, advisory: bool, bands: GateBands) -> DataFrame:
    flag = advisory or gate in bands.advisory
    return df.select("section", F.lit(gate).alias("gate"), dbl("value").alias("value"),
                     verdict(ok).alias("status"), F.lit(flag).alias("advisory"))


def gate_area_peak(cells: DataFrame, bands: GateBands) -> DataFrame:
    cap = F.least(F.col("_max"), F.lit(bands.area_peak_max * 4))
    mode = histogram_mode(cells.where(dbl("nucleus_area_um2") > 0), ["section"], "nucleus_area_um2",
                          bands.area_bin_width, cap)
    return _row(mode.withColumn("value", F.col("mode")), "nucleus_area_peak_um2",
                in_band("value", bands.area_peak_min, bands.area_peak_max), False, bands)


def gate_k_stability(cells: DataFrame, panel: Panel, bands: GateBands, target: str, condition: str) -> DataFrame:
    swing = markers.k_stability(cells, panel, target, condition, bands)
    return _row(swing, "k_swing_pp", F.col("value") <= bands.swing_max_pp, False, bands)


def _named(raw: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Density of each named region per section; the named list bounds the rows of a section."""
    return region_density(raw.where(F.col("acronym").isin(*names))).where(F.col("density").isNotNull())


def _sections(raw: DataFrame) -> DataFrame:
    return raw.select("section").distinct()


def gate_white_matter(raw: DataFrame, bands: GateBands) -> DataFrame:
    """Worst tract against the cortex mean."""
    d = _named(raw, bands.white_matter + bands.cortex)
    agg = d.groupBy("section").agg(
        F.max(F.when(F.col("acronym").isin(*bands.white_matter), F.col("density"))).alias("value"),
        F.avg(F.when(F.col("acronym").isin(*bands.cortex), F.col("density"))).alias("cortex"))
    agg = _sections(raw).join(agg, "section", "left")
    over = F.coalesce(F.col("value") > F.lit(bands.white_matter_ratio_max) * F.col("cortex"), F.lit(False)) & (
        F.coalesce(F.col("cortex") > 0, F.lit(False)))
    if bands.white_matter_abs_max is not None:
        over = over | (F.col("value") > bands.white_matter_abs_max)
    return _row(agg, "white_matter_density", F.when(F.col("value").isNotNull(), ~over), False, bands)


def gate_ventricle(raw: DataFrame, bands: GateBands) -> DataFrame:
    """Worst ventricle; only reported while there is no band."""
    agg = _sections(raw).join(_named(raw, bands.ventricle).groupBy("section").agg(F.max("density").alias("value")),
                              "section", "left")
    ok = (F.lit(None).cast("boolean") if bands.ventricle_max is None
          else F.col("value") <= bands.ventricle_max)
    return _row(agg, "ventricle_density", ok, bands.ventricle_max is None, bands)


def grey_stats(raw: DataFrame, bands: GateBands) -> DataFrame:
    """Per section: median, population CV, regions present and regions in band."""
    d = _named(raw, bands.grey)
    agg = d.groupBy("section").agg(
        F.median("density").alias("median"), F.count("*").alias("present"),
        count_where(in_band("density", bands.grey_min, bands.grey_max)).alias("in_band"),
        ratio(F.stddev_pop("density"), F.avg("density")).alias("cv"))
    return _sections(raw).join(agg, "section", "left")


def gate_grey_density(raw: DataFrame, bands: GateBands) -> DataFrame:
    s = grey_stats(raw, bands).withColumn("value", F.col("median"))
    return _row(s, "grey_density_median", in_band("value", bands.grey_min, bands.grey_max), True, bands)


def gate_grey_contrast(raw: DataFrame, bands: GateBands) -> DataFrame:
    s = grey_stats(raw, bands).withColumn("value", F.when(F.col("present") >= 3, F.col("cv")))
    return _row(s, "grey_contrast_cv", F.col("value") >= bands.grey_cv_min, True, bands)


def gate_total_density(raw: DataFrame, bands: GateBands) -> DataFrame:
    """Density of the root row.  The classification decides, else the acronym, per section."""
    by_class = F.trim(F.coalesce(F.col("classification"), F.lit(""))) == bands.root_classification \
        if "classification" in raw.columns else F.lit(False)
    by_name = F.lower("acronym") == bands.root_acronym
    agg = raw.groupBy("section").agg(
        F.max(by_class).alias("_has"), *[F.sum(F.when(c, F.col(x))).alias(f"_{x}_{t}")
                                        for t, c in (("c", by_class), ("n", by_name)) for x in ("cnt", "area_mm2")])
    pick = lambda x: F.when(F.col("_has"), F.col(f"_{x}_c")).otherwise(F.col(f"_{x}_n"))
    out = agg.withColumn("value", ratio(pick("cnt"), pick("area_mm2")))
    return _row(out, "total_density", in_band("value", bands.total_min, bands.total_max), False, bands)


def gate_rows(cells: DataFrame, raw: DataFrame, panel: Panel, bands: GateBands,
              target: str, condition: str) -> DataFrame:
    parts = [gate_area_peak(cells, bands), gate_k_stability(cells, panel, bands, target, condition),
             gate_white_matter(raw, bands), gate_ventricle(raw, bands), gate_grey_density(raw, bands),
             gate_grey_contrast(raw, bands), gate_total_density(raw, bands)]
    return reduce(DataFrame.unionByName, parts)


def gate_table(rows: DataFrame) -> DataFrame:
    """One row per section: value and status per gate, overall FLAG if a blocking gate flags.

    A section without an input keeps its row; its missing gates read N/A.
    """
    aggs = []
    for g in GATES:
        hit = F.col("gate") == g
        aggs += [F.max(F.when(hit, F.col("value"))).alias(g),
                 F.coalesce(F.max(F.when(hit, F.col("status"))), F.lit("N/A")).alias(f"{g}_status")]
    blocking = (F.col("status") == "FLAG") & ~F.col("advisory")
    return rows.groupBy("section").agg(
        *aggs, F.when(F.max(blocking), "FLAG").otherwise("PASS").alias("overall"),
        F.concat_ws(", ", F.array_sort(F.collect_set(F.when(blocking, F.col("gate"))))).alias("flagged"))


def gate_summary_view(table: DataFrame) -> DataFrame:
    """'value (STATUS)' text per gate."""
    text = [F.concat(F.coalesce(F.format_number(g, 1), F.lit("n/a")), F.lit(" ("), F.col(f"{g}_status"), F.lit(")")).alias(g)
            for g in GATES]
    return table.select("section", *text, "overall")


def density_matrix(raw: DataFrame, bands: GateBands) -> DataFrame:
    """Section x region densities and the white-matter limit line."""
    names = bands.cortex + bands.white_matter + bands.ventricle
    d = _named(raw, names)
    piv = d.groupBy("section").agg(*[
        F.max(F.when(F.col("acronym") == n, F.col("density"))).alias(n.replace(" ", "_").lower()) for n in names])
    cortex = [F.col(n.replace(" ", "_").lower()) for n in bands.cortex]
    mean = sum(cortex) / len(cortex)
    limit = piv.agg((F.avg(mean) * bands.white_matter_ratio_max).alias("limit_line"))
    return piv.withColumn("limit_line", limit.scalar())


def area_stats(cells: DataFrame, keys: list[str], width: float = 10.0) -> DataFrame:
    """Modal bin start, quartiles, IQR, population skewness and n."""
    from .quantiles import grouped_quantiles
    mode = histogram_mode(cells, keys, "nucleus_area_um2", width, midpoint=False)
    q = grouped_quantiles(cells, keys, "nucleus_area_um2", [0.25, 0.5, 0.75], ["q1", "median", "q3"]).drop("n")
    sk = cells.where(finite("nucleus_area_um2")).groupBy(*keys).agg(F.skewness("nucleus_area_um2").alias("skew"))
    return (mode.join(q, keys).join(sk, keys)
            .select(*keys, F.col("mode").alias("peak_start"), (F.col("mode") + width).alias("peak_end"),
                    F.col("mode_count").alias("peak_count"), "median", "q1", "q3",
                    (F.col("q3") - F.col("q1")).alias("iqr"), "skew", "n"))
