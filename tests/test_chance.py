import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytolattice.config import Marker, Panel
from cytolattice.operators import chance as C
from cytolattice.operators import neighbours as N
from cytolattice.session import settle, shared_dir

PANEL = Panel(markers=(Marker("fos", "nuclear"), Marker("tdt", "whole-cell")))


def section(rng, n, name, lift=1.0, gradient=False):
    """Cells on a square; activity may follow a gradient that tagging shares, or the tag itself."""
    x, y = rng.uniform(0, 1000, n), rng.uniform(0, 1000, n)
    base = np.where(x > 500, 0.5, 0.05) if gradient else np.full(n, 0.2)
    tagged = rng.random(n) < (np.where(x > 500, 0.25, 0.03) if gradient else 0.15)
    act = rng.random(n) < np.clip(base * np.where(tagged, lift, 1.0), 0, 1)
    return pd.DataFrame({"section": name, "x": x, "y": y, "tagged": tagged, "activity": act, "anchor_mean": rng.normal(100, 10, n),
                         "tdt_bgsub": rng.gamma(2, 50, n) + 200 * tagged, "fos_bgsub": rng.gamma(2, 50, n) + 200 * act,
                         "nucleus_area_um2": rng.gamma(9, 5, n), "acronym": "LA", "excluded": False})


@pytest.fixture(scope="module")
def make(spark):
    def build(seed, n=900, sections=3, **kw):
        rng = np.random.default_rng(seed)
        pdf = pd.concat([section(rng, n, f"s{i}", **kw) for i in range(sections)], ignore_index=True)
        pdf["cell_id"] = np.arange(len(pdf))
        return pdf, spark.createDataFrame(pdf).withColumn("region", F.lit("LA"))
    return build


def test_independent_labels_sit_at_one(make):
    _, df = make(1, n=4000, sections=1)
    assert C.above_chance_by(df, ["region"]).first().above_chance == pytest.approx(1, abs=0.25)
    assert C.shuffled_control(df, ["region"]).first().shuffled == pytest.approx(1, abs=0.25)
    assert C.anchor_floor(df, ["region"]).first().anchor_floor == pytest.approx(1, abs=0.25)


def test_gradient_inflates_naive_not_local(make):
    _, df = make(2, n=1500, gradient=True)
    naive = C.naive_ratio(df, ["region"]).first().naive
    sec = C.local_sections(df, 50)
    loc = C.local_chance(sec).first()
    assert naive > 1.25 and loc.above_chance_local == pytest.approx(1, abs=0.15) and loc.n_sections == 3
    ci = C.bootstrap_sections(sec, 200).first()
    assert ci.ci_lo <= loc.above_chance_local <= ci.ci_hi
    rot = C.rotation_null(df, 5).first()
    assert 0 < rot.p <= 1 and rot.null_mean > 0


def test_planted_effect_is_recovered(make):
    _, df = make(3, lift=2.0)
    assert 1.6 < C.local_chance(C.local_sections(df, 50)).first().above_chance_local < 2.5


def numpy_fit(x, y, l2=1e-4):
    xd = np.hstack([np.ones((len(x), 1)), x])
    b = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-xd @ b))
        g = xd.T @ (p - y) + 2 * l2 * np.r_[0, b[1:]]
        h = (xd * (p * (1 - p))[:, None]).T @ xd + 2 * l2 * np.diag([0, 1, 1, 1])
        b -= np.linalg.solve(h, g)
    return b


def test_fitted_expectation_matches_numpy(make):
    pdf, df = make(4, n=600, lift=2.0)
    dens = N.local_density(df, 20)
    rows = C.covariates(df.join(dens.select("cell_id", "local_density"), "cell_id"), "tdt_bgsub")
    got = C.fitted_expectation(rows).first()
    p = rows.select("x1", "x2", "x3", "tagged", "activity").toPandas()
    neg, pos = p[~p.tagged], p[p.tagged]
    mu, sd = neg[["x1", "x2", "x3"]].mean().to_numpy(), neg[["x1", "x2", "x3"]].std(ddof=0).to_numpy()
    b = numpy_fit((neg[["x1", "x2", "x3"]].to_numpy() - mu) / sd, neg.activity.to_numpy(float))
    z = (pos[["x1", "x2", "x3"]].to_numpy() - mu) / sd
    want = (1 / (1 + np.exp(-(b[0] + z @ b[1:])))).mean()
    assert got.expected == pytest.approx(want, rel=1e-6) and got.observed == pytest.approx(pos.activity.mean())
    val = C.validate_extrapolation(rows, "tdt_bgsub", minimum=500, tail=20).first()
    assert val.holdout_n > 20 and 0.5 < val.pred_over_actual < 2
    table = C.chance_compare(rows, k=20, n_rot=2, n_boot=50).first()
    assert table.n_cells == len(p) and table.fitted == pytest.approx(got.ratio)
    over = C.expected_overlap(rows).first()
    assert over.above_chance_fitted == pytest.approx(got.ratio) and over.ci_lo < over.above_chance_fitted < over.ci_hi


def test_comparison_leaves_its_rows_and_a_row_a_region(spark, make):
    _, df = make(8, n=1200, lift=2.0)
    dens = N.local_density(df, 20)
    rows = settle(C.covariates(df.join(dens.select("cell_id", "local_density"), "cell_id"), "tdt_bgsub"))
    before = set(os.listdir(shared_dir(spark)))
    out = C.chance_compare(rows, k=20, n_rot=2, n_boot=50)
    left = [n for n in set(os.listdir(shared_dir(spark))) - before if os.path.exists(f"{shared_dir(spark)}/{n}/_SUCCESS")]
    assert [n.rsplit("-", 1)[0] for n in left if spark.read.parquet(f"{shared_dir(spark)}/{n}").count() > 1] == ["compare"]
    assert out.count() == 1 and C.chance_compare(rows, k=20, n_rot=2, n_boot=50, written=True).collect() == out.collect()


def test_the_whole_project_is_compared_beside_its_regions(make):
    pdf, df = make(6, n=2400, lift=2.0)
    dens = N.local_density(df, 20)
    cells = C.covariates(df.join(dens.select("cell_id", "local_density"), "cell_id"), "tdt_bgsub")
    halves = cells.withColumn("region", F.when(F.col("x") < 500, "left").otherwise("right"))
    got = {r.region: r for r in C.chance_compare(C.with_whole_project(halves, cells), k=20, n_rot=2, n_boot=50).collect()}
    alone = C.chance_compare(cells.withColumn("region", F.lit(C.WHOLE)), k=20, n_rot=2, n_boot=50).first()
    assert set(got) == {"left", "right", C.WHOLE}
    whole, p = got[C.WHOLE], cells.select("tagged", "activity").toPandas()
    assert whole.n_cells == got["left"].n_cells + got["right"].n_cells == len(p)
    assert whole.naive == pytest.approx(p.activity[p.tagged].mean() / p.activity.mean())
    for name in ("naive", "local", "fitted", "anchor_floor", "rotation", "rotation_p"):
        assert whole[name] == pytest.approx(alone[name]) if alone[name] is not None else whole[name] is None


def test_k_sweep_keeps_strictness_and_undefined_points(make):
    _, df = make(5, n=6000, lift=2.0)
    got = {r.k: r for r in C.k_vs_chance(df, PANEL, (0.5, 2.0, 60.0)).collect()}
    assert got[60.0].tagged_n == 0 and got[60.0].above_chance is None and got[60.0].anchor_floor is None
    assert got[0.5].shuffled == pytest.approx(1, abs=0.15) and got[2.0].above_chance > 1.2
    assert C.k_vs_chance_verdict(C.k_vs_chance(df, PANEL, (0.5, 2.0))).first().verdict in ("RISES", "FLAT", "FALLS")


def test_binomial_interval_matches_resampling(spark):
    rng = np.random.default_rng(0)
    n, p = 240, 0.3
    t = spark.createDataFrame([("r", n, p, 1.0)], "region string, tagged_n long, observed double, local_chance double")
    r = C.bootstrap_cells(t).first()
    sim = np.percentile(rng.binomial(n, p, 200_000) / n, [2.5, 97.5])
    assert (r.ci_lo, r.ci_hi) == pytest.approx(tuple(sim), abs=1.01 / n)
