"""Queries that write assay files from the tables, read them back with the readers, and ingest streams."""

from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import markers as M
from ..operators import rollup as R
from ..session import scratch_path, settle
from ..sources import readers as RD
from ..sources import writers as S
from ..streaming.ingest import ingest_all
from .bindings import PANEL, table, view
from .cell_queries import cells, classed
from .region_queries import COUNT_SQL, COUNTS, edges, region_rows
from .registry import query, tidy


def stem(section, suffix):
    return F.concat(section, F.lit("_MIP.ome.tiff - "), section, F.lit(f"__id1__{suffix}"))


def write_stems(df, path, section="section", suffix="percell_export.tsv", sep="\t"):
    """One folder per section, named like the section's export."""
    out = df.withColumn("stem", stem(F.col(section), suffix))
    out.write.partitionBy("stem").option("header", True).option("sep", sep).csv(path)
    return path


def export_cells(spark, d):
    c = classed(spark, d)
    region = F.when(F.col("cell_id") % 50 == 0, None).otherwise(F.concat("hemisphere", F.lit(": "), "acronym"))
    return c.select("section", F.when(F.col("class") != "Negative", F.col("class")).alias("class"), region.alias("region_label"), "nucleus_area_um2",
                    F.col("x").alias("centroid_x_px"), F.col("y").alias("centroid_y_px"), "anchor_mean",
                    F.when(F.col("cell_id") % 40 == 0, F.lit("n/a")).otherwise(F.col("fos_bgsub").cast("string")).alias("fos_bgsub"), "tdt_bgsub", "cell_id")


@query("scan_cells", """SELECT section, class, CASE WHEN cell_id % 50 = 0 THEN '(no region)' ELSE acronym END AS acronym, count(*) AS n,
    count(*) FILTER (cell_id % 40 <> 0) AS fos_n, round(sum(tdt_bgsub), 6) AS tdt_sum FROM classed GROUP BY 1, 2, 3""")
def scan_cells(spark, d):
    path = write_stems(export_cells(spark, d), scratch_path(spark, "percell"))
    back = RD.scan_cells(spark, path)
    return tidy(back.groupBy("section", "class", "acronym").agg(F.count("*").alias("n"), F.count("fos_bgsub").alias("fos_n"),
                                                                F.sum("tdt_bgsub").alias("tdt_sum")))


@query("scan_roi_cells", """SELECT concat(section, '_MIP.ome.tiff - ', section) AS image, count(*) AS n, count(*) FILTER (cell_id % 40 <> 0) AS fos_n FROM fx_cells GROUP BY section""")
def scan_roi_cells(spark, d):
    path = write_stems(export_cells(spark, d), scratch_path(spark, "roi-percell"))
    return tidy(RD.scan_roi_cells(spark, path).groupBy("image").agg(F.count("*").alias("n"), F.count("fos_bgsub").alias("fos_n")))


@query("scan_region_table", f"SELECT section, hemisphere, acronym, acronym <> 'ASIA' AS is_leaf, round(area_mm2, 6) AS area_mm2, {COUNT_SQL} FROM region_rows")
def scan_region_table(spark, d):
    rows = region_rows(spark, d).drop("animal").withColumn("is_leaf", F.when(F.col("acronym") == "ASIA", "False").otherwise("True"))
    whole = rows.where("hemisphere = 'Left' AND acronym = 'ASIA'").withColumn("hemisphere", F.lit(None).cast("string"))           # a container row, to be dropped
    path = write_stems(rows.unionByName(whole), scratch_path(spark, "region-table"), suffix="region_table.tsv")
    return tidy(RD.scan_region_table(spark, path, PANEL).select("section", "hemisphere", "acronym", "is_leaf", "area_mm2", *COUNTS))


@query("scan_raw_regions", """SELECT section, acronym, hemisphere, cnt, round(area_mm2, 6) AS area_mm2, round(cnt / area_mm2, 3) AS density FROM fx_raw_regions""")
def scan_raw_regions(spark, d):
    r = view(spark, d, "fx_raw_regions").select(
        "section", F.col("acronym").alias("Name"), F.concat("hemisphere", F.lit(": "), "acronym").alias("Classification"),
        (F.col("area_mm2") * 1e6).alias("Area um^2"), F.col("cnt").alias("Num Detections"))
    path = write_stems(r, scratch_path(spark, "raw-regions"), suffix="_regions.tsv")
    back = RD.scan_raw_regions(spark, path, "anchor")
    return tidy(back.select("section", "acronym", "hemisphere", "cnt", "area_mm2", F.round("density", 3).alias("density")))


_REF = "SELECT config_tag, slice, region, marker, class, hemisphere, is_leaf, cnt, seq AS ingest FROM ref"


@query("scan_combined_reference", _REF)
def scan_combined_reference(spark, d):
    ref = view(spark, d, "fx_reference").withColumnRenamed("seq", "ingest")
    path = scratch_path(spark, "reference")
    S.write_csv(ref.withColumn("is_leaf", F.initcap(F.col("is_leaf").cast("string"))), path)
    return tidy(RD.scan_combined_reference(spark, path).select("config_tag", "slice", "region", "marker", "class", "hemisphere", "is_leaf", "cnt", "ingest"))


@query("sink_append_reference", """SELECT marker, count(*) AS n, CAST(sum(cnt) AS BIGINT) AS cnt, CAST(sum(ingest) AS BIGINT) AS ingest FROM (
    SELECT unnest(['anchor', 'fos', 'tdt']) AS marker, unnest([anchor_count, fos_pos_count, tdt_pos_count]) AS cnt, CASE WHEN hemisphere = 'Left' THEN 1 ELSE 2 END AS ingest FROM region_rows) GROUP BY marker""")
def sink_append_reference(spark, d):
    path, rows = scratch_path(spark, "append"), region_rows(spark, d)
    cats = {"anchor": "anchor_count", "fos": "fos_pos_count", "tdt": "tdt_pos_count"}
    for i, side in enumerate(("Left", "Right"), start=1):
        S.append_reference(S.region_rows_to_reference(rows.where(F.col("hemisphere") == side), cats), path, i)
    return tidy(spark.read.parquet(path).groupBy("marker").agg(F.count("*").alias("n"), F.sum("cnt").alias("cnt"), F.sum("ingest").alias("ingest")))


@query("sink_cells", """SELECT section, count(*) AS n, round(sum(CASE WHEN animal = 'A1997' THEN 2 * tdt_bgsub ELSE tdt_bgsub END), 6) AS tdt_sum,
    count(*) FILTER (animal = 'A1997') AS rewritten FROM fx_cells GROUP BY section""")
def sink_cells(spark, d):
    """A second write replaces only the sections it brings."""
    path, c = scratch_path(spark, "cells"), cells(spark, d)
    S.write_sections(S.cells_to_sink(c).withColumn("pass", F.lit(1)), path, ["animal", "section"])
    S.write_sections(S.cells_to_sink(c.where("animal = 'A1997'").withColumn("tdt_bgsub", 2 * F.col("tdt_bgsub"))).withColumn("pass", F.lit(2)), path, ["animal", "section"])
    return tidy(spark.read.parquet(path).groupBy("section").agg(
        F.count("*").alias("n"), F.sum("tdt_bgsub").alias("tdt_sum"), E.count_where(F.col("pass") == 2).alias("rewritten")))


@query("sink_region_table", f"SELECT section, hemisphere, acronym, round(area_mm2, 6) AS area_mm2, {COUNT_SQL} FROM region_rows")
def sink_region_table(spark, d):
    path = scratch_path(spark, "regions")
    S.write_sections(region_rows(spark, d), path, ["section"])
    return tidy(spark.read.parquet(path).select("section", "hemisphere", "acronym", "area_mm2", *COUNTS))


@query("sink_atlas_cells", """SELECT class, count(*) AS n, round(sum(x), 3) AS x_um, round(sum(y), 3) AS y_um, round(sum(x + y), 3) AS z_um FROM classed GROUP BY class""")
def sink_atlas_cells(spark, d):
    path = scratch_path(spark, "atlas")
    c = classed(spark, d).select("class", (F.col("x") / 1000).alias("x_mm"), (F.col("y") / 1000).alias("y_mm"), ((F.col("x") + F.col("y")) / 1000).alias("z_mm"),
                                 "fos_bgsub", "tdt_bgsub", F.col("acronym").alias("region_label"))
    S.write_csv(S.atlas_cells(c), path, "\t")
    back = spark.read.option("sep", "\t").option("header", True).csv(path)
    return tidy(back.groupBy("class").agg(F.count("*").alias("n"), *[
        F.round(F.sum(F.col(f"atlas_{a}_um").cast("double")), 3).alias(f"{a}_um") for a in "xyz"]))


@query("scan_ontology", """SELECT e.acronym, e.parent, concat('name ', e.acronym) AS name, (SELECT max(distance) FROM closure c WHERE c.descendant = e.acronym)::BIGINT AS depth FROM fx_edges e""")
def scan_ontology(spark, d):
    """The tree nested into one document and flattened again."""
    e = edges(spark, d)
    data = lambda c: F.struct(F.col(c).alias("acronym"), F.concat(F.lit("name "), F.col(c)).alias("name"))
    leaf = e.groupBy("parent").agg(F.collect_list(F.struct(data("acronym").alias("data"))).alias("children"))
    mid = e.where("parent = 'root'").join(leaf.withColumnRenamed("parent", "acronym"), "acronym", "left")
    top = mid.groupBy().agg(F.collect_list(F.struct(data("acronym").alias("data"), "children")).alias("children"))
    doc = top.select(F.struct(F.struct(F.lit("root").alias("acronym"), F.lit("name root").alias("name")).alias("data"), "children").alias("root"))
    path = scratch_path(spark, "ontology")
    doc.coalesce(1).write.json(path)
    return tidy(RD.scan_ontology(spark, path).select("acronym", "parent", "name", "depth"))


@query("scan_calibration", """SELECT slice, floor_peak AS floor, bright_peak, bright_peak - floor_peak AS span, threshold, unnest([0.1, 0.25])::DOUBLE AS frac,
    unnest([CAST(floor(floor_peak + 0.1 * (bright_peak - floor_peak) + 0.5) AS BIGINT), CAST(floor(floor_peak + 0.25 * (bright_peak - floor_peak) + 0.5) AS BIGINT)]) AS sweep_threshold FROM fx_calibration""")
def scan_calibration(spark, d):
    from ..operators.pixels import java_round
    c = view(spark, d, "fx_calibration")
    sweep = F.array(*[F.struct(F.lit(f).alias("frac"), java_round(E.span_cut("floor_peak", "bright_peak", f)).alias("threshold")) for f in (0.1, 0.25)])
    doc = c.select(F.concat(F.lit("img - "), "slice").alias("image"), F.lit("anchor").alias("anchor_channel"), F.lit("span_fraction").alias("mode"),
                   F.lit(0.25).alias("span_frac"), F.col("floor_peak").alias("floor"), "bright_peak", "threshold", sweep.alias("sweep"))
    path = scratch_path(spark, "calibration")
    doc.write.json(path)
    return tidy(RD.scan_calibration(spark, path).select(
        "slice", "floor", "bright_peak", "span", "threshold", F.inline("sweep").alias("frac", "sweep_threshold")))


@query("scan_thresholds", "SELECT slice AS image, 'span_fraction' AS mode, threshold::DOUBLE AS threshold, threshold % 2 = 0 AS override FROM fx_calibration")
def scan_thresholds(spark, d):
    c = view(spark, d, "fx_calibration").select(
        F.col("slice").alias("image"), F.lit("anchor").alias("anchor_channel"), F.lit("span_fraction").alias("mode"), F.lit(0.25).alias("span_frac"), "threshold",
        F.when(F.col("threshold") % 2 == 0, "True").otherwise("no").alias("override"))
    path = scratch_path(spark, "thresholds")
    S.write_csv(c, path, "\t")
    return tidy(RD.scan_thresholds(spark, path).select("image", "mode", "threshold", "override"))


@query("scan_roi_counts", "SELECT project, count(*) AS n, CAST(sum(cnt) AS BIGINT) AS cnt FROM fx_roi_counts GROUP BY project")
def scan_roi_counts(spark, d):
    return _roi(spark, d, "cnt", "cnt", "long")


@query("scan_roi_area", "SELECT project, count(*) AS n, round(sum(area_mm2), 6) AS area_mm2 FROM fx_roi_counts GROUP BY project")
def scan_roi_area(spark, d):
    return _roi(spark, d, "area_mm2", "area_mm2", "double")


def _roi(spark, d, value, name, kind):
    base, rows = scratch_path(spark, "roi"), view(spark, d, "fx_roi_counts")
    # One write for all projects; two more are configured but have no file yet.
    S.write_csv(rows.withColumn("no", F.substring("project", 1, 1)).drop("project").repartition("no"), base, by=["no"])
    back = RD.scan_roi_tables(spark, {str(i): f"{base}/no={i}" for i in range(1, 8)})
    names = rows.select("project", F.substring("project", 1, 1).alias("no")).distinct()
    back = back.withColumnRenamed("project", "no").join(names, "no")
    return tidy(back.groupBy("project").agg(F.count("*").alias("n"), F.sum(F.col(value).cast(kind)).alias(name)))


@query("scan_handcounts", "SELECT region, box, side_um, machine, human FROM fx_handcount")
def scan_handcounts(spark, d):
    sheet = view(spark, d, "fx_handcount")
    base = scratch_path(spark, "handcounts")
    S.write_csv(sheet, f"{base}/S1__handcount.tsv", "\t")
    S.write_csv(sheet.where("box <= 3"), f"{base}/S1__handcount.new.tsv", "\t")
    return tidy(RD.scan_handcounts(spark, f"{base}/*"))


@query("scan_group_map", "SELECT DISTINCT animal, CASE WHEN animal = 'A1996' THEN 'override' WHEN animal < 'A1998' THEN 'early' ELSE 'late' END AS grp FROM fx_cells")
def scan_group_map(spark, d):
    m = cells(spark, d).select("animal").distinct().withColumn("group", F.when(F.col("animal") < "A1998", "early").otherwise("late"))
    path = scratch_path(spark, "groups")
    S.write_csv(m, path)
    return RD.scan_group_map(spark, path, {"A1996": "override"})


@query("stream_ingest_sections", """WITH k AS (SELECT * FROM fx_reference QUALIFY row_number() OVER (PARTITION BY config_tag, slice, region, marker, class ORDER BY seq DESC) = 1)
    SELECT slice, count(*) AS n, CAST(sum(cnt) AS BIGINT) AS cnt, max(seq) AS last_seq FROM k GROUP BY slice""")
def stream_ingest_sections(spark, d):
    """All rows in three deliveries, with a compaction after two; each key keeps its last write."""
    ref = view(spark, d, "fx_reference")
    base = scratch_path(spark, "stream")
    out = None
    for i in range(3):
        ref.where(F.col("seq") % 3 == i).write.mode("append").parquet(f"{base}/in")
        out = ingest_all(spark, f"{base}/in", ref.schema, f"{base}/table", f"{base}/ckpt", "slice",
                         ["config_tag", "slice", "region", "marker", "class"], "seq", compact_every=2)
    return tidy(out.groupBy("slice").agg(F.count("*").alias("n"), F.sum("cnt").alias("cnt"), F.max("seq").alias("last_seq")))
