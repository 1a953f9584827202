"""Site and path posteriors against plain sums, on sparse sites taken from URLs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytolattice.llm import siteprior as S


def test_hosts_and_paths_of_urls(spark):
    urls = ["http://a.Example.com/en/825?page=2&ref=x", "https://u:p@m.b.net:8080/en#top", "https://c.org", "ftp://d.org/x/y/z/", "no url", None, "http://e.org?x=/q", "http://f.org//a//b"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string").orderBy("i").select(
        S.host_of(F.col("url")).alias("h"), S.path_of(F.col("url")).alias("p"), S.path_of(F.col("url"), 2).alias("pp")).collect()
    assert [tuple(r) for r in rows] == [("a.example.com", "en", "en/825"), ("m.b.net", "en", "en"), ("c.org", None, None), ("d.org", "x", "x/y"), (None, None, None),
                                        (None, None, None), ("e.org", None, None), ("f.org", "a", "a/b")]


def plain_scores(sites, paths, odds):
    """The posterior of every document by loops over groups."""
    p = 1 / (1 + np.exp(-odds))
    n_all, mean = len(p), p.mean()

    def weight(groups, priors):
        n = np.array([len(g) for g in groups])
        m, sq = np.array([p[g].mean() for g in groups]), np.array([(p[g] ** 2).sum() for g in groups])
        within = (sq - n * m * m).sum() / max(n_all - len(groups), 1)
        between = ((n * (m - priors) ** 2).sum() - len(groups) * within) / n_all
        return within / between if between > within / S.NEVER_OVER else S.NEVER_OVER

    of = lambda keys: {k: np.flatnonzero([x == k for x in keys]) for k in dict.fromkeys(keys)}
    by_site, by_path = of(sites), of(list(zip(sites, paths)))
    k_site = weight(list(by_site.values()), np.full(len(by_site), mean))
    site_mean = {s: (p[g].sum() + k_site * mean) / (len(g) + k_site) for s, g in by_site.items()}
    without = lambda s, i: (p[by_site[s]].sum() - p[i] + k_site * mean) / (len(by_site[s]) - 1 + k_site)
    k_path = weight(list(by_path.values()), np.array([site_mean[s] for s, _ in by_path]))
    out = np.empty(n_all)
    for (s, _), g in by_path.items():
        for i in g:
            q = np.clip((p[g].sum() - p[i] + k_path * without(s, i)) / (len(g) - 1 + k_path), 1e-6, 1 - 1e-6)
            out[i] = 1 / (1 + np.exp(-(odds[i] + np.log(q / (1 - q)) - np.log(mean / (1 - mean)))))
    return out


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_sparse_sites_shrink_as_plain_sums_say(spark, monkeypatch, spread):
    rng = np.random.default_rng(3)
    sizes = [1] * 25 + [3] * 20 + [1000]
    urls = [f"http://s{i}.org/{'ab'[rng.integers(2)]}/{j}" for i, m in enumerate(sizes) for j in range(m)]
    lean = np.repeat(rng.normal(0, spread, len(sizes)), sizes)
    odds = np.round(lean + rng.normal(0, 1, len(urls)), 6)
    docs = spark.createDataFrame([(i, str(o), u) for i, (o, u) in enumerate(zip(odds.tolist(), urls))], "doc_id long, text string, url string")
    docs = docs.withColumn("host", S.host_of(F.col("url"))).withColumn("path", S.path_of(F.col("url")))
    monkeypatch.setattr(S, "with_evidence", lambda df, models, text="text": df.withColumn("quality_odds", F.col("text").cast("double")))
    got = {r.doc_id: r.quality for r in S.site_scores(docs, {"quality": None}, "host", "path").collect()}
    hosts, parts = [u.split("/")[2] for u in urls], [u.split("/")[3] for u in urls]
    want = plain_scores(hosts, parts, odds)
    assert [got[i] for i in range(len(urls))] == pytest.approx(list(want), rel=1e-9)
    if spread:      # a site of one document says nothing about it beyond the global prior; a large one does
        own = 1 / (1 + np.exp(-odds))
        assert np.abs(want - own)[:25].max() < 1e-9 and np.abs(want - own)[-1000:].mean() > 0.005
