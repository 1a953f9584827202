"""Readers of the assay's flat files.  Everything is read as text and cast, so no pass infers types.

A path may be one file per section or a folder so named; the section comes from the path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..config import Panel
from ..functions import NO_REGION, acronym_of, hemisphere_of, nan_to_null, ratio, section_of_file, truthy
from ..session import settle

CELL_COLUMNS = ("class", "region_label", "nucleus_area_um2", "centroid_x_px", "centroid_y_px")


def _text(spark: SparkSession, paths, sep: str) -> DataFrame:
    df = spark.read.option("header", True).option("sep", sep).csv(paths)
    return df.withColumn("_path", F.url_decode(F.col("_metadata.file_path")))


def _need(df: DataFrame, columns, what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}; found {df.columns}")


def _number(name: str):
    return nan_to_null(F.expr(f"try_cast(`{name}` AS DOUBLE)")).alias(name)


def _stem(suffix: str):
    """Path element that carries the export's suffix."""
    return F.regexp_extract("_path", rf"([^/=]+){suffix}", 1)


def scan_cells(spark: SparkSession, paths) -> DataFrame:
    """Per-cell exports: section from the name, default class and region, numeric measures."""
    df = _text(spark, paths, "\t")
    _need(df, CELL_COLUMNS, "per-cell export")
    numbers = [c for c in df.columns if c.endswith("_bgsub")] + [
        c for c in ("nucleus_area_um2", "centroid_x_px", "centroid_y_px", "anchor_mean") if c in df.columns]
    rest = [c for c in df.columns if c not in numbers + ["class", "region_label", "section", "acronym", "excluded", "_path", "stem"]]
    label = F.coalesce("region_label", F.lit(NO_REGION))
    cls = F.coalesce("class", F.lit("Negative"))
    return df.select(section_of_file(_stem("__percell_export")).alias("section"), cls.alias("class"), label.alias("region_label"),
                     acronym_of(label).alias("acronym"), (cls == "Excluded").alias("excluded"), *rest, *[_number(c) for c in numbers])


def scan_roi_cells(spark: SparkSession, paths) -> DataFrame:
    """The manual route's cells; ``image`` is the name before the entry id."""
    path = F.url_decode(F.col("_metadata.file_path"))
    raw = spark.read.option("header", True).option("sep", "\t").csv(paths)
    numbers = [c for c in raw.columns if c.endswith("_bgsub") or c.endswith("_px") or c.endswith("_um2")]
    rest = [c for c in raw.columns if c not in numbers + ["stem"]]
    return raw.select(F.regexp_extract(path, r"([^/=]+?)__id\d+__percell_export", 1).alias("image"), *rest, *[_number(c) for c in numbers])


def scan_region_table(spark: SparkSession, paths, panel: Panel) -> DataFrame:
    """Left / Right rows only; every declared count column must exist."""
    df = _text(spark, paths, "\t")
    _need(df, ["hemisphere", "acronym", "area_mm2", *panel.count_columns], "region table")
    side = F.trim(F.coalesce("hemisphere", F.lit("")))
    return df.where(side.isin("Left", "Right")).select(
        section_of_file(_stem("__region_table")).alias("section"), side.alias("hemisphere"), F.trim("acronym").alias("acronym"),
        truthy("is_leaf").alias("is_leaf"), _number("area_mm2"), *[F.expr(f"try_cast({c} AS BIGINT)").alias(c) for c in panel.count_columns])


def scan_raw_regions(spark: SparkSession, paths, anchor: str) -> DataFrame:
    """Detector rows: the anchor's count column, else all detections; area in mm2, density."""
    df = _text(spark, paths, "\t")
    _need(df, ["Name", "Classification", "Area um^2"], "detector table")
    name = next((c for c in (f"Num {anchor}", "Num Detections") if c in df.columns), None)
    if name is None:
        raise ValueError(f"no count column for {anchor}; found {df.columns}")
    cls = F.coalesce("Classification", F.lit(""))
    side = F.when(cls.contains(": "), F.split(cls, ": ")[0]).otherwise("")
    out = df.select(section_of_file(_stem("_regions")).alias("section"), F.trim("Name").alias("acronym"), cls.alias("classification"),
                    side.alias("hemisphere"), (F.expr("try_cast(`Area um^2` AS DOUBLE)") / 1e6).alias("area_mm2"),
                    F.expr(f"try_cast(`{name}` AS DOUBLE)").cast("long").alias("cnt"))
    return out.withColumn("density", ratio("cnt", "area_mm2"))


def scan_combined_reference(spark: SparkSession, paths) -> DataFrame:
    """Growing tidy table, last write wins.  Recency is the ``ingest`` column the sink writes."""
    from .writers import keep_last
    df = _text(spark, paths, ",")
    _need(df, ["config_tag", "slice", "region", "marker", "class", "ingest"], "combined reference")
    df = df.select("config_tag", "slice", "region", F.coalesce("hemisphere", F.lit("")).alias("hemisphere"), truthy("is_leaf").alias("is_leaf"),
                   "marker", "class", F.expr("try_cast(cnt AS BIGINT)").alias("cnt"), _number("density"), F.expr("try_cast(ingest AS BIGINT)").alias("ingest"))
    return keep_last(df, ["config_tag", "slice", "region", "marker", "class"], "ingest")


NODE = "data struct<acronym:string, name:string, id:string, color_hex_triplet:string>, children array<string>"


def scan_ontology(spark: SparkSession, path: str) -> DataFrame:
    """Nested nodes to (acronym, parent, name, depth, color), to any depth.

    Children stay JSON text until their level is read, so no schema limits the tree.  A level is
    written once; the walk ends with the first level without nodes.
    """
    doc = spark.read.option("wholetext", True).text(path)
    level = doc.select(F.from_json("value", "root string")["root"].alias("node"), F.lit(None).cast("string").alias("parent"))
    parts, depth = [], 0
    while True:
        read = settle(level.select(F.from_json("node", NODE).alias("n"), "parent").where("n IS NOT NULL").select("n.*", "parent"), "tree")
        parts.append(read.where("data.acronym IS NOT NULL").select(
            "data.acronym", "parent", F.coalesce("data.name", "data.acronym").alias("name"), F.lit(depth).alias("depth"),
            F.col("data.color_hex_triplet").alias("color")))
        level = read.select(F.explode("children").alias("node"), F.coalesce("data.acronym", "parent").alias("parent"))
        depth += 1
        if level.isEmpty():
            return reduce(DataFrame.unionByName, parts)


CALIBRATION = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("image", "anchor_channel", "mode")], T.StructField("span_frac", T.DoubleType()),
    *[T.StructField(c, T.LongType()) for c in ("floor", "bright_peak", "span", "threshold")],
    T.StructField("sweep", T.ArrayType(T.StructType([T.StructField("frac", T.DoubleType()), T.StructField("threshold", T.LongType())]))),
    T.StructField("histogram", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("lo", "hi", "count")])))])


def scan_calibration(spark: SparkSession, paths) -> DataFrame:
    """One document per section; a document without its required keys is an error when it is read."""
    df = spark.read.schema(CALIBRATION).json(paths)
    need = ("image", "anchor_channel", "mode", "floor", "bright_peak", "threshold")
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in need])
    df = df.withColumn("image", F.when(bad, F.raise_error(F.lit("calibration lacks a required key")).cast("string")).otherwise(F.col("image")))
    return df.withColumn("slice", F.element_at(F.split("image", " - "), -1)).withColumn(
        "span", F.coalesce("span", F.col("bright_peak") - F.col("floor")))


def scan_thresholds(spark: SparkSession, paths) -> DataFrame:
    df = _text(spark, paths, "\t")
    return df.select("image", "anchor_channel", "mode", _number("span_frac"), _number("threshold"), truthy("override").alias("override"))


def scan_roi_tables(spark: SparkSession, projects: dict[str, str]) -> DataFrame | None:
    """Combined manual-shape tables of several projects, whose columns may differ; missing files are skipped."""
    parts = []
    for name, path in projects.items():
        try:
            parts.append(spark.read.option("header", True).csv(path).withColumn("project", F.lit(name)))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_handcounts(spark: SparkSession, paths) -> DataFrame:
    """Tally sheets; machine-only reruns (``.new``) are left out, blank counts stay NULL."""
    df = _text(spark, paths, "\t").where(~F.col("_path").contains("__handcount.new"))
    whole = lambda c: F.expr(f"try_cast(try_cast(trim(`{c}`) AS DOUBLE) AS BIGINT)").alias(c)
    return df.select(F.trim("region").alias("region"), whole("box"), _number("side_um"), whole("machine"), whole("human"))


def scan_group_map(spark: SparkSession, path: str | None, pairs: dict[str, str] | None = None) -> DataFrame:
    """animal, group rows; explicit pairs win over the file."""
    own = spark.createDataFrame(sorted((pairs or {}).items()), "animal string, grp string")
    if path is None:
        return own
    df = spark.read.option("header", True).csv(path)
    _need(df, ["animal", "group"], "group map")
    return df.select("animal", F.col("group").alias("grp")).join(own, "animal", "left_anti").unionByName(own)
