import numpy as np
import pandas as pd
import pytest

from cytolattice.operators import quantiles as Q


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    hot = pd.DataFrame({"g": "hot", "v": np.concatenate([rng.lognormal(size=30_000), np.full(9_000, 1.25)])})
    cold = pd.DataFrame({"g": [f"c{i % 7}" for i in range(210)], "v": rng.integers(0, 9, 210).astype(float)})
    one = pd.DataFrame({"g": ["one"], "v": [4.5]})
    pdf = pd.concat([hot, cold, one])
    return pdf, spark.createDataFrame(pdf)


def test_quantiles_match_numpy_on_skewed_groups(frame):
    pdf, df = frame
    probs = [0.0, 0.25, 0.5, 0.975, 1.0]
    got = {r.g: r for r in Q.grouped_quantiles(df, ["g"], "v", probs, list("abcde")).collect()}
    for g, part in pdf.groupby("g"):
        want = np.percentile(part["v"], [100 * p for p in probs])
        assert np.allclose([got[g][c] for c in "abcde"], want), g
        assert got[g].n == len(part)


def test_coarse_sketch_still_exact(frame, monkeypatch):
    """The bracket only bounds the work; a rough sketch gives the same answer."""
    pdf, df = frame
    monkeypatch.setattr(Q, "SKETCH_ACCURACY", 50)
    monkeypatch.setattr(Q, "BRACKET", 2 / 50)
    got = {r.g: r.m for r in Q.grouped_quantiles(df, ["g"], "v", [0.5], ["m"]).collect()}
    assert np.allclose([got[g] for g in sorted(got)], pdf.groupby("g")["v"].median().sort_index())


def test_mad_and_global_quantile(frame):
    pdf, df = frame
    mad = {r.g: r.mad for r in Q.grouped_mad(df, ["g"], "v").collect()}
    for g, part in pdf.groupby("g"):
        assert mad[g] == pytest.approx(np.median(np.abs(part["v"] - part["v"].median())))
    assert Q.grouped_quantiles(df, [], "v", [0.9], ["p"]).first().p == pytest.approx(pdf["v"].quantile(0.9))


def test_per_key_probability(spark, frame):
    pdf, df = frame
    want = spark.createDataFrame([("hot", 0.87), ("c1", 0.5), ("one", 0.3)], "g string, prob double")
    got = {r.g: r.cut for r in Q.ranked_values(df, ["g"], "v", want).collect()}
    for g, p in (("hot", 0.87), ("c1", 0.5), ("one", 0.3)):
        assert got[g] == pytest.approx(pdf[pdf.g == g]["v"].quantile(p))


def test_histogram_quantiles(spark):
    rows = spark.createDataFrame([("a", 1, 3), ("a", 5, 2), ("a", 9, 1)], "g string, v int, c int")
    r = Q.histogram_quantiles(rows, ["g"], "v", "c", [0.5, 0.9], ["m", "p"]).first()
    assert (r.m, r.p) == pytest.approx((np.percentile([1, 1, 1, 5, 5, 9], 50), np.percentile([1, 1, 1, 5, 5, 9], 90)))
