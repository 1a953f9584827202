"""Region tree operators.  A tree is an edge table (acronym, parent) and its closure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import Panel
from ..functions import count_where, ratio, verdict
from ..session import settle

HEMISPHERES = ("Left", "Right")


def ontology_closure(edges: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance), self pairs included, of a tree of any depth.

    Every region holds its path upwards and where it goes on.  A round appends the path that begins there, so paths double and the rounds grow with
    the logarithm of the depth.  Paths that go on after as many steps as there are regions lie above a cycle, which is an error.
    """
    paths = edges.select(F.col("acronym").alias("node"), F.array("acronym").alias("path"), F.col("parent").alias("next")).distinct()
    length, nodes = 1, None
    while True:
        onward = paths.select(F.col("node").alias("next"), F.col("path").alias("_more"), F.col("next").alias("_next"))
        more = F.when(F.col("next").isNotNull(), F.coalesce("_more", F.array("next")))
        paths = settle(paths.join(onward, "next", "left").select(
            "node", F.concat("path", F.coalesce(more, F.slice("path", 1, 0))).alias("path"), F.col("_next").alias("next")), "paths")
        length *= 2
        going = paths.where("next IS NOT NULL")
        if going.isEmpty():
            break
        nodes = nodes or edges.select("acronym").union(edges.select("parent")).distinct().count()
        if length > nodes:
            looped = [r[0] for r in going.orderBy("node").limit(3).collect()]
            raise ValueError(f"the region tree has a cycle above {', '.join(map(str, looped))}")
    up = paths.select("node", F.posexplode("path").alias("distance", "ancestor")).select("ancestor", F.col("node").alias("descendant"), "distance")
    return settle(up.distinct(), "closure")


def excluded_closure(closure: DataFrame, excluded: DataFrame) -> DataFrame:
    """Excluded acronyms and all they contain; an unknown acronym excludes itself."""
    below = closure.join(excluded.select(F.col("acronym").alias("ancestor")), "ancestor")
    return settle(below.select(F.col("descendant").alias("acronym")).union(excluded.select("acronym")).distinct(), "excluded")


def exclude_regions(rows: DataFrame, closure: DataFrame, excluded: DataFrame) -> DataFrame:
    return rows.join(excluded_closure(closure, excluded), "acronym", "left_anti")


def frontier_leaves(present: DataFrame, closure: DataFrame) -> DataFrame:
    """Present (section, acronym) pairs without a present strict descendant."""
    below = present.select("section", F.col("acronym").alias("descendant"))
    strict = closure.where(F.col("distance") > 0).select("ancestor", "descendant")
    covered = (below.join(strict, "descendant")
               .select("section", F.col("ancestor").alias("acronym")).distinct())
    return present.select("section", "acronym").distinct().join(covered, ["section", "acronym"], "left_anti")


def included_leaves(present: DataFrame, closure: DataFrame, excluded: DataFrame,
                    regions: DataFrame | None = None) -> DataFrame:
    """(section, region, leaf): frontier leaves at or below each region, exclusions removed."""
    leaves = exclude_regions(frontier_leaves(present, closure), closure, excluded)
    pairs = (leaves.withColumnRenamed("acronym", "leaf")
             .join(closure.select(F.col("ancestor").alias("region"),
                                                  F.col("descendant").alias("leaf")), "leaf"))
    if regions is None:
        pairs = pairs.where(F.col("region") == F.col("leaf"))
    else:
        pairs = pairs.join(regions.select(F.col("acronym").alias("region")), "region")
    return pairs.select("section", "region", "leaf")


def level_of_region(pairs: DataFrame, frontier: DataFrame) -> DataFrame:
    """'leaf' when the region itself is on the section's frontier, else 'summary'."""
    flag = frontier.select("section", F.col("acronym").alias("region"), F.lit("leaf").alias("_l"))
    return (pairs.select("section", "region").distinct().join(flag, ["section", "region"], "left")
            .select("section", "region", F.coalesce("_l", F.lit("summary")).alias("level")))


def region_readout(region_rows: DataFrame, closure: DataFrame, excluded: DataFrame, panel: Panel,
                   regions: DataFrame | None = None) -> DataFrame:
    """Section x region x {L, R, both}: sums over frontier leaves, then densities and ratios.

    ``region_rows`` holds section, hemisphere, acronym, area_mm2 and the panel's count columns.
    Parent rows are never read; ``both`` is recomputed from sums and always present.
    """
    rows = region_rows.where(F.col("hemisphere").isin(*HEMISPHERES))
    present = rows.select("section", "acronym").distinct()
    pairs = included_leaves(present, closure, excluded, regions)
    counts = panel.count_columns
    sums = [F.sum("area_mm2").alias("area_mm2")] + [F.sum(c).cast("long").alias(c) for c in counts]
    joined = rows.withColumnRenamed("acronym", "leaf").join(pairs, ["section", "leaf"])
    agg = (joined.groupingSets([["section", "region", "hemisphere"], ["section", "region"]],
                               "section", "region", "hemisphere").agg(*sums))
    side = F.when(F.col("hemisphere").isNull(), "both").otherwise(F.substring("hemisphere", 1, 1))
    empty = (F.col("area_mm2") <= 0) & (sum(F.col(c) for c in counts) == 0)
    agg = agg.withColumn("hemisphere", side).where((F.col("hemisphere") == "both") | ~empty)
    level = level_of_region(pairs, frontier_leaves(present, closure))
    agg = agg.join(level, ["section", "region"])
    out = ["section", "region", "hemisphere", "level", F.round("area_mm2", 6).alias("area_mm2")]
    for c in counts:
        out += [c, ratio(c, "area_mm2").alias(c.replace("_count", "_density"))]
    if panel.emit_double:
        a, b = panel.names[:2]
        out += [ratio("double_count", f"{a}_pos_count").alias(f"p_{b}_given_{a}"),
                ratio("double_count", f"{b}_pos_count").alias(f"p_{a}_given_{b}")]
    return agg.select(*out)


def ancestor_rollup(own: DataFrame, closure: DataFrame, counts: list[str]) -> DataFrame:
    """Each region's own bucket plus those of all it contains, per section."""
    up = closure.select("ancestor", F.col("descendant").alias("acronym"))
    return (own.join(up, "acronym").groupBy("section", F.col("ancestor").alias("region"))
            .agg(*[F.sum(c).cast("long").alias(c) for c in counts]))


def zero_leak(cells: DataFrame, own: DataFrame, anchor_count: str) -> DataFrame:
    """Own counts + unresolved cells must equal the classified cells of each section."""
    cls = cells.where(~F.col("excluded")).groupBy("section").agg(
        F.count("*").alias("classified"), count_where(F.col("region_id").isNull()).alias("unresolved"))
    total = own.groupBy("section").agg(F.sum(anchor_count).cast("long").alias("own_total"))
    out = cls.join(total, "section", "left").withColumn("own_total", F.coalesce("own_total", F.lit(0).cast("long")))
    return out.withColumn("status", F.when(F.col("own_total") + F.col("unresolved") == F.col("classified"), "PASS")
                          .otherwise("FAIL"))


def zero_leak_from_rows(ref: DataFrame) -> DataFrame:
    """Sum of leaf counts against the largest non-leaf count; SKIP without non-leaf rows."""
    agg = ref.groupBy("slice", "config_tag", "marker", "class").agg(
        F.coalesce(F.sum(F.when(F.col("is_leaf"), F.col("cnt"))), F.lit(0)).cast("long").alias("leaf_sum"),
        F.max(F.when(~F.col("is_leaf"), F.col("cnt"))).cast("long").alias("root_count"))
    return agg.withColumn("status", F.when(F.col("root_count").isNull(), "SKIP")
                          .when(F.col("leaf_sum") == F.col("root_count"), "PASS").otherwise("FAIL"))


def frontier_coverage(region_rows: DataFrame, closure: DataFrame, excluded: DataFrame,
                      anchor_count: str, root: str) -> DataFrame:
    """Share of the root row's anchor count that the included frontier leaves hold."""
    rows = region_rows.where(F.col("hemisphere").isin(*HEMISPHERES))
    leaves = exclude_regions(frontier_leaves(rows.select("section", "acronym"), closure), closure, excluded)
    part = (rows.join(leaves.withColumn("_leaf", F.lit(True)), ["section", "acronym"], "left")
            .groupBy("section", "hemisphere").agg(
                F.coalesce(F.sum(F.when(F.col("_leaf"), F.col(anchor_count))), F.lit(0)).cast("long").alias("frontier_n"),
                F.coalesce(F.sum(F.when(F.col("acronym") == root, F.col(anchor_count))), F.lit(0)).cast("long").alias("root_n")))
    return part.withColumn("coverage_pct", F.round(100.0 * ratio("frontier_n", "root_n"), 1))


def warn_empty_regions(rollup: DataFrame, anchor_count: str) -> DataFrame:
    """Regions whose roll-up holds no anchor cell."""
    return rollup.where(F.col(anchor_count) == 0).select("region").distinct()


def division_of(closure: DataFrame, divisions: DataFrame) -> DataFrame:
    """Nearest ancestor-or-self that is a division root; NULL when there is none."""
    hit = (closure.join(divisions.select(F.col("acronym").alias("ancestor")), "ancestor")
           .groupBy("descendant").agg(F.min_by("ancestor", "distance").alias("division")))
    every = closure.where(F.col("distance") == 0).select("descendant")
    return every.join(hit, "descendant", "left").select(F.col("descendant").alias("acronym"), "division")


def label_presence_mask(labels: DataFrame, edges: DataFrame, projects: list[str]) -> DataFrame:
    """Bit mask of the projects a structure was observed in, and its own cell count per project."""
    bit = F.coalesce(*[F.when(F.col("project") == p, F.lit(i)) for i, p in enumerate(projects)])
    seen = labels.groupBy("acronym").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("mask"),
        *[count_where(F.col("project") == p).alias(f"n_{i}") for i, p in enumerate(projects)])
    out = edges.select("acronym").join(seen, "acronym", "left")
    return out.select("acronym", *[F.coalesce(c, F.lit(0).cast("long")).alias(c)
                                   for c in ["mask"] + [f"n_{i}" for i in range(len(projects))]])


def focus_sets(closure: DataFrame, roots: DataFrame) -> DataFrame:
    """(focus, acronym): named root sets expanded to all members; unknown roots drop out."""
    return (closure.join(roots.select("focus", F.col("acronym").alias("ancestor")), "ancestor")
            .select("focus", F.col("descendant").alias("acronym")).distinct())


def term_resolution(terms: DataFrame, edges: DataFrame) -> DataFrame:
    """Terms to members.

    ``terms`` holds term, kind, members[], also[].  Unknown members drop out; an alias that is
    itself an acronym drops out unless the kind is 'collision'; ``clash`` marks lookup keys
    claimed by more than one term.
    """
    known = (edges.select("acronym").distinct())
    members = (terms.select("term", F.explode("members").alias("acronym")).join(known, "acronym")
               .groupBy("term").agg(F.array_sort(F.collect_set("acronym")).alias("m")))
    alias = terms.select("term", "kind", F.explode_outer("also").alias("acronym"))
    alias = alias.where(F.col("acronym").isNotNull()).join(
        known.withColumn("_real", F.lit(True)), "acronym", "left")
    alias = alias.where(F.col("_real").isNull() | (F.col("kind") == "collision")).select("term", F.col("acronym").alias("key"))
    keys = (terms.select("term", F.col("term").alias("key")).union(alias)
            .join(members.select("term"), "term", "left_semi")
            .withColumn("lookup", F.lower(F.regexp_replace("key", " ", ""))))
    clash = keys.groupBy("lookup").agg((F.count_distinct("term") > 1).alias("clash"))
    return (keys.join(clash, "lookup").join(members, "term")
            .select("term", "lookup", F.concat_ws(",", "m").alias("members"), "clash"))


def confusable_groups(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """Groups with at least two acronyms that exist."""
    good = groups.join(edges.select("acronym").distinct(), "acronym")
    return (good.groupBy("grp").agg(F.count_distinct("acronym").alias("n"),
                                    F.concat_ws(",", F.array_sort(F.collect_set("acronym"))).alias("members"))
            .where(F.col("n") >= 2))


def unknown_labels(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels absent from the tree, with their row counts."""
    counts = labels.groupBy("acronym").agg(F.count("*").alias("n"))
    return counts.join(edges.select("acronym"), "acronym", "left_anti")


def atlas_availability(edges: DataFrame, other: DataFrame) -> DataFrame:
    """Which structures exist in either of two trees."""
    a = edges.select("acronym", F.lit(True).alias("_a")).distinct()
    b = other.select("acronym", F.lit(True).alias("_b")).distinct()
    both = a.join(b, "acronym", "full")
    return both.select("acronym", F.coalesce("_a", F.lit(False)).alias("in_first"),
                       F.coalesce("_b", F.lit(False)).alias("in_second"))
