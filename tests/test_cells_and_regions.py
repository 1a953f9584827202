import math

import pytest
from pyspark.sql import functions as F

from cytolattice.config import Marker, Panel
from cytolattice.functions import exprs as E
from cytolattice.operators import hierarchy as H
from cytolattice.operators import markers as M
from cytolattice.operators import rollup as R

ONE = Panel(markers=(Marker("tdt", "whole-cell"),), anchor="dapi")
TWO = Panel(markers=(Marker("fos", "nuclear"), Marker("tdt", "whole-cell")), anchor="dapi", k_robust=1.0)
EDGES = [("root", None), ("grey", "root"), ("HPF", "grey"), ("CA1", "HPF"), ("DG", "HPF"), ("DG-mo", "DG"), ("DG-sg", "DG"),
         ("AMY", "grey"), ("LA", "AMY"), ("BLA", "AMY"), ("CEA", "AMY")]
LEAVES = [("CA1", "Left", 1.0, 100, 20, 10, 5), ("CA1", "Right", 1.0, 80, 16, 8, 4), ("DG-mo", "Left", 0.5, 40, 8, 4, 2),
          ("DG-mo", "Right", 0.5, 30, 6, 3, 1), ("DG-sg", "Left", 0.2, 0, 0, 0, 0), ("DG-sg", "Right", 0.2, 0, 0, 0, 0),
          ("LA", "Left", 0.3, 50, 25, 15, 10), ("LA", "Right", 0.3, 40, 20, 12, 8), ("BLA", "Left", 0.4, 60, 12, 6, 3),
          ("BLA", "Right", 0.4, 45, 9, 5, 2)]


@pytest.fixture(scope="module")
def tree(spark):
    edges = spark.createDataFrame(EDGES, "acronym string, parent string")
    return edges, H.ontology_closure(edges), spark.createDataFrame([("DG-sg",), ("VS",)], "acronym string")


@pytest.fixture(scope="module")
def rows(spark):
    wrong = [(a, h, 9.999999, 0, 0, 0, 0) for a in ("HPF", "DG", "AMY", "grey") for h in ("Left", "Right")]
    root = [("root", h, 99.0, sum(x[3] for x in LEAVES if x[1] == h), 0, 0, 0) for h in ("Left", "Right")]
    cols = "acronym string, hemisphere string, area_mm2 double, dapi_count long, tdt_pos_count long, fos_pos_count long, double_count long"
    return spark.createDataFrame(LEAVES + wrong + root, cols).withColumn("section", F.lit("s1"))


def readout(rows, tree, panel=TWO, names=("LA", "BLA", "HPF", "CA1", "DG", "ZZZ")):
    edges, closure, excl = tree
    want = rows.sparkSession.createDataFrame([(n,) for n in names], "acronym string")
    return {(r.region, r.hemisphere): r for r in H.region_readout(rows, closure, excl, panel, want).collect()}


def test_rollup_ignores_wrong_parent_rows(rows, tree):
    got = readout(rows, tree)
    assert got["HPF", "L"].dapi_count == 140 and got["HPF", "L"].area_mm2 == pytest.approx(1.5)
    assert got["DG", "L"].dapi_count == 40 and got["DG", "L"].area_mm2 == pytest.approx(0.5)
    assert got["LA", "L"].dapi_count == 50 and got["CA1", "L"].dapi_count == 100
    assert got["LA", "L"].level == "leaf" and got["HPF", "L"].level == "summary"
    assert got["HPF", "both"].dapi_count == got["HPF", "L"].dapi_count + got["HPF", "R"].dapi_count
    assert got["HPF", "both"].dapi_density == pytest.approx(got["HPF", "both"].dapi_count / got["HPF", "both"].area_mm2)
    assert not any(k[0] in ("DG-sg", "ZZZ") for k in got)


def test_conditional_ratios(rows, tree):
    la = readout(rows, tree)["LA", "L"]
    assert la.p_fos_given_tdt == pytest.approx(0.4) and la.p_tdt_given_fos == pytest.approx(2 / 3)


def test_single_marker_has_no_pair_columns(rows, tree):
    got = readout(rows, tree, ONE)["LA", "L"].asDict()
    assert not any(c.startswith(("fos", "double", "p_")) for c in got)


def test_coverage_is_full(rows, tree):
    _, closure, excl = tree
    assert {r.coverage_pct for r in H.frontier_coverage(rows, closure, excl, "dapi_count", "root").collect()} == {100.0}


def test_metrics_pool_then_recompute(spark):
    rows = spark.createDataFrame([("m", "LA", "both", 100, 8, 4, 2, 1.0, "p", "s1", "leaf"), ("m", "LA", "both", 900, 100, 64, 37, 2.0, "p", "s2", "leaf")],
                                 "animal string, region string, hemisphere string, dapi_count long, tdt_pos_count long, fos_pos_count long, "
                                 "double_count long, area_mm2 double, project string, section string, level string")
    r = R.engram_metrics(R.n_source_select(R.animal_rollup(rows, TWO), TWO, "anchor"), TWO).first()
    assert (r.tdt_pos_count, r.fos_pos_count, r.double_count, r.n_slices) == (108, 68, 39, 2)
    assert r.reactivation_rate == pytest.approx(39 / 108) and r.reactivation_rate != pytest.approx((2 / 8 + 37 / 100) / 2)
    assert r.overlap_above_chance == pytest.approx(39 * 1000 / (108 * 68))


@pytest.mark.parametrize("n,t,a,d,null_or,null_hc", [(0, 0, 0, 0, True, True), (10, 2, 3, 2, True, False), (10, 8, 8, 1, True, True), (50, 10, 12, 5, False, False)])
def test_odds_ratio_edges(spark, n, t, a, d, null_or, null_hc):
    m = E.overlap_metrics(F.lit(n), F.lit(t), F.lit(a), F.lit(d))
    r = spark.range(1).select(*[c.alias(k) for k, c in m.items()]).first()
    assert (r.log2_odds_ratio is None) == null_or and (r.log2_odds_ratio_hc is None) == null_hc
    if n == 0:
        assert all(v is None for v in r)
    if not null_hc:
        want = math.log2((d + .5) * (n - t - a + d + .5) / ((t - d + .5) * (a - d + .5)))
        assert r.log2_odds_ratio_hc == pytest.approx(want)


def test_roles_never_follow_position():
    r = TWO.roles()
    assert (r.tagged, r.activity) == ("tdt", "fos")
    assert Panel(markers=(Marker("a", "nuclear", role="tagged"), Marker("b", "nuclear", role="activity"))).roles().tagged == "a"
    with pytest.raises(ValueError):
        Panel(markers=(Marker("a", "nuclear"), Marker("b", "nuclear"))).roles()
    with pytest.raises(ValueError):
        TWO.roles(tagged="nope")


def test_classes_use_section_cuts_and_ties_are_positive(spark):
    rows = [(i, "s1", float(i), 1.0, i == 9) for i in range(10)]
    cells = spark.createDataFrame(rows, "cell_id long, section string, fos_bgsub double, tdt_bgsub double, excluded boolean").withColumn("acronym", F.lit("LA"))
    got = {r.cell_id: r["class"] for r in M.classify_cells(cells, TWO).collect()}
    # fos over 0..8: median 4, MAD 2, cut 4 + 2.9652; tdt is constant, so its cut is 1 and all reach it.
    assert got[9] == "Excluded" and got[6] == "tdt+" and got[7] == "Double+" and got[0] == "tdt+"
    strict = cells.where("cell_id = 0").withColumns({"tdt_median": F.lit(1.0), "tdt_robust_sd": F.lit(0.0)})
    assert strict.select(M.positive_at("tdt", 3, strict=True)).first()[0] is False


def test_stack_requires_equal_markers(spark):
    df = spark.createDataFrame([("a", 1)], "animal string, tdt_pos_count int")
    with pytest.raises(ValueError):
        R.stack_animals([df, df], [ONE, TWO])


def test_group_map_must_cover(spark):
    df = spark.createDataFrame([("a",), ("b",)], "animal string")
    with pytest.raises(ValueError):
        R.apply_groups(df, spark.createDataFrame([("a", "x")], "animal string, grp string"))
    assert {r.grp for r in R.apply_groups(df, None).collect()} == {"unassigned"}


def test_leak_passes_then_fails(spark):
    base = [("s", "c", "m", "m+", True, 3), ("s", "c", "m", "m+", True, 4), ("s", "c", "m", "m+", False, 7)]
    cols = "slice string, config_tag string, marker string, class string, is_leaf boolean, cnt long"
    assert H.zero_leak_from_rows(spark.createDataFrame(base, cols)).first().status == "PASS"
    assert H.zero_leak_from_rows(spark.createDataFrame(base[1:], cols)).first().status == "FAIL"
    assert H.zero_leak_from_rows(spark.createDataFrame(base[:2], cols)).first().status == "SKIP"


def test_span_rule_and_labels(spark):
    r = spark.range(1).select(
        E.span_cut(F.lit(162), F.lit(2268)).alias("cut"), E.span_fraction(F.lit(700), F.lit(162), F.lit(2268)).alias("f"),
        E.span_cut(F.lit(9), F.lit(9)).alias("none"), E.span_fraction(F.lit(1), F.lit(5), F.lit(9), clamp=True).alias("out"),
        E.acronym_of(F.lit("left: CA1")).alias("acr"), E.hemisphere_of(F.lit("Right: CA1")).alias("side"),
        E.section_of_file(F.lit("x.tiff - m_s2__id7__percell_export.tsv")).alias("sec"), E.safe_file_name(F.lit('a<b>:c"/')).alias("safe")).first()
    assert abs(r.cut - 688.5) <= 1 and r.f == pytest.approx(0.2555, abs=1e-4) and r.none is None and r.out is None
    assert (r.acr, r.side, r.sec, r.safe) == ("CA1", "Right", "m_s2", "abc")
