"""Quality and toxicity of documents: a text classifier under hierarchical empirical Bayes priors of sites.

A logistic model over hashed words and a few measures of style gives each document its own evidence, the probability p.
Sites (hosts) and paths within them gather the evidence of their documents by grouped sums.  A site's posterior mean is
(n * mean + k * global mean) / (n + k), a path's the same with its site's posterior as the prior; k, the weight of the
prior in documents, is estimated from the spread between the sites (or paths) by moments, so sparse sites shrink to the global prior and
sites that do not differ more than chance have no say.  A document's score is its own log-odds plus those of its path's
posterior, both without the document itself, over the global ones.

The classifier is fitted on at most ``SAMPLE`` labelled documents, those with the smallest hashes of their id; all sums run over all
documents.  Null and empty texts have no words and score by bias and prior; null sites and paths are groups of their own; null
labels are not used; repeated labels of a document count as often as they are there; equal rows get equal scores; without labels every score is 0.5;
an empty table gives an empty table; columns named like the results are replaced.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from ..session import settle
from .text import lowered_words, slices

SAMPLE, WORDS, STYLE, SLICE_CHARS = 8000, 1 << 16, 8, 800_000
NEVER_OVER, SCREEN = 1e6, 60.0


def features_of(texts):
    """(row, column, value) of the hashed words and the style measures of some texts.

    Words count once a text; style columns follow the words.
    """
    words = [lowered_words(t) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    row = np.repeat(np.arange(len(texts)), n)
    columns, rows, values = [], [], []
    distinct = np.zeros(len(texts))
    if len(row):
        coded = pa.array([x for w in words for x in w], pa.large_binary()).dictionary_encode()
        bare = np.array([zlib.crc32(w.strip(b".,;:!?\"'()")) % WORDS for w in coded.dictionary.to_pylist()], np.int64)
        pairs = np.unique(row * WORDS + bare[coded.indices.to_numpy()])
        rows.append(pairs // WORDS)
        columns.append(pairs % WORDS)
        distinct = np.bincount(pairs // WORDS, minlength=len(texts)).astype(float)
        values.append(np.ones(len(pairs)))
    style = np.zeros((len(texts), STYLE))
    for i, (t, w) in enumerate(zip(texts, words)):
        if w:
            size, lines = len(t), t.count("\n") + 1
            symbols = sum(t.count(c) for c in "#*$%&|<>{}[]=_~^\\/")
            style[i] = (np.log1p(len(w)) / 5, 3 * distinct[i] / len(w), sum(c.isupper() for c in t) / size * 2, symbols / len(w),
                        sum(c.isdigit() for c in t) / size * 5, (size / len(w)) / 10, t.count("!") / len(w), lines / len(w) * 10)
    style = np.clip(style, 0, 3)
    at, column = np.nonzero(style)
    return (np.concatenate([*rows, at]).astype(np.int64), np.concatenate([*columns, WORDS + column]).astype(np.int64),
            np.concatenate([*values, style[at, column]]))


def fit_logistic(row, column, value, y, rounds=300, decay=2.0):
    """Weights and bias (last) of a logistic model, by averaged gradients scaled per column; classes weigh alike."""
    w = np.zeros(WORDS + STYLE + 1)
    n = len(y)
    if n == 0 or y.min() == y.max():
        return w
    # Screening by chi-square: a word takes part if its classes differ far more than chance among all words allows.
    yes, both = np.bincount(column, y[row], minlength=len(w)), np.bincount(column, minlength=len(w))
    a, b, c, d = yes + 0.5, both - yes + 0.5, y.sum() - yes + 0.5, n - y.sum() - (both - yes) + 0.5
    sure = (a * d - b * c) ** 2 * (a + b + c + d) / ((a + b) * (c + d) * (a + c) * (b + d)) >= SCREEN
    sure[WORDS:] = True
    on = sure[column]
    row, column, value = row[on], column[on], value[on]
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    seen = np.full(len(w), 1e-8)
    for _ in range(rounds):
        z = np.bincount(row, value * w[column], minlength=n) + w[-1]
        miss = weight * (y - 1 / (1 + np.exp(-z))) / n
        g = np.bincount(column, value * miss[row], minlength=len(w))
        g[-1] = miss.sum()
        g -= decay * w / n
        seen = 0.9 * seen + 0.1 * g * g
        w += 0.05 * g / np.sqrt(seen + 1e-12)
    return w


def fit_classifiers(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", names=("quality", "toxic"), sample: int = SAMPLE):
    """One weight vector for each label column."""
    marked = labels.where(" AND ".join(f"`{n}` IS NOT NULL" for n in (doc_id, *names)))
    marked = marked.select(F.col(f"`{doc_id}`").alias("id"), *[F.col(f"`{n}`").cast("double").alias(n) for n in names])
    picked = marked.orderBy(F.xxhash64("id"), "id", *names).limit(sample)
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(picked), "id")

    def features(batches):
        for pdf in batches:
            for start, stop in slices(pdf["text"].tolist(), SLICE_CHARS):
                part = pdf.iloc[start:stop]
                row, column, value = features_of(part["text"].tolist())
                cut = np.searchsorted(row, np.arange(len(part) + 1)) if (np.diff(row) >= 0).all() else None
                for i in range(len(part)):
                    on = slice(cut[i], cut[i + 1]) if cut is not None else row == i
                    yield pd.DataFrame({"id": [part["id"].iloc[i]], **{n: [part[n].iloc[i]] for n in names},
                                        "columns": [column[on].astype(np.int32).tobytes()], "values": [value[on].astype(np.float32).tobytes()]})

    schema = "id long, " + ", ".join(f"{n} double" for n in names) + ", columns binary, values binary"
    found = sorted(texts.mapInPandas(features, schema).collect(), key=lambda r: (r["id"], r["columns"]))
    column = [np.frombuffer(r["columns"], np.int32) for r in found]
    row = np.repeat(np.arange(len(found)), [len(c) for c in column])
    flat = (np.concatenate(column).astype(np.int64), np.concatenate([np.frombuffer(r["values"], np.float32) for r in found]).astype(float)) if found else ([], [])
    return {n: fit_logistic(row, *flat, np.array([r[n] > 0 for r in found], float)) for n in names}


def with_evidence(docs: DataFrame, models: dict, text: str = "text") -> DataFrame:
    """``docs`` with the log-odds of each model, ``<name>_odds``."""
    names = list(models)
    # Sent as they are: words that the sample never held have weight 0.
    weights = np.array([models[n] for n in names], np.float32)

    @pandas_udf(T.StructType([T.StructField(f"{n}_odds", T.DoubleType()) for n in names]))
    def odds(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            out = np.zeros((len(texts), len(names)))
            for start, stop in slices(texts, SLICE_CHARS):
                row, column, value = features_of(texts[start:stop])
                for i, w in enumerate(weights):
                    out[start:stop, i] = np.bincount(row, value * w[column], minlength=stop - start) + w[-1]
            yield pd.DataFrame(np.clip(out, -20, 20), columns=[f"{n}_odds" for n in names])

    return docs.withColumn("_odds", odds(F.col(f"`{text}`"))).select("*", "_odds.*").drop("_odds")


def host_of(url) -> Column:
    """Host of a URL in lower case, without user and port; NULL if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def path_of(url, depth: int = 1) -> Column:
    """The first ``depth`` parts of a URL's path below its host, without query and fragment; NULL if there is no such part."""
    parts = F.filter(F.split(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1), "/"), lambda p: p != "")
    return F.when(F.size(parts) >= 1, F.array_join(F.slice(parts, 1, depth), "/"))


def prior_weight(n, total, squares, prior):
    """Documents that the prior counts for: within-group variance over between-group variance, by moments.

    Columns of a table of groups; ``prior`` is each group's prior mean.  Aggregates, so they give one row.
    """
    within = F.sum(squares - total * total / n) / F.greatest(F.sum(n) - F.count("*"), F.lit(1))
    between = (F.sum(n * F.pow(total / n - prior, 2)) - F.count("*") * within) / F.sum(n)
    return F.when(between > within / NEVER_OVER, within / between).otherwise(F.lit(NEVER_OVER))


def site_scores(docs: DataFrame, models: dict, site: str = "source", path: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, site, path, and for each model ``<name>_evidence`` (text alone) and ``<name>`` (with the site's prior)."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{site}`").alias("site"), F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text"))
    rows = settle(with_evidence(rows, models).drop("text"), "evidence")
    out = rows
    for name in models:
        p = 1 / (1 + F.exp(-F.col(f"{name}_odds")))
        paths = settle(rows.groupBy("site", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("q")), "paths")
        sites = paths.groupBy("site").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
        all_ = sites.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
        mean = min(max((all_["s"] or 0) / (all_["n"] or 1), 1e-6), 1 - 1e-6)
        k_site = sites.agg(prior_weight(F.col("n"), F.col("s"), F.col("q"), F.lit(mean)).alias("k")).first()["k"] or NEVER_OVER
        sites = sites.select("site", F.col("n").alias("site_n"), F.col("s").alias("site_s"), ((F.col("s") + k_site * mean) / (F.col("n") + k_site)).alias("site_mean"))
        paths = paths.alias("p").join(sites.alias("t"), F.col("p.site").eqNullSafe(F.col("t.site"))).select("p.*", "site_n", "site_s", "site_mean")
        k_path = paths.agg(prior_weight(F.col("n"), F.col("s"), F.col("q"), F.col("site_mean")).alias("k")).first()["k"] or NEVER_OVER
        table = settle(paths.select(F.col("site").alias("_site"), F.col("path").alias("_path"), F.col("n").alias("_n"), F.col("s").alias("_s"), "site_n", "site_s"), "posteriors")
        out = out.join(table, out["site"].eqNullSafe(table["_site"]) & out["path"].eqNullSafe(table["_path"]))
        # Neither level counts the document itself, or a site of one document would hear its own evidence twice.
        site = (F.col("site_s") - p + k_site * mean) / (F.col("site_n") - 1 + k_site)
        q = F.greatest(F.least((F.col("_s") - p + k_path * site) / (F.col("_n") - 1 + k_path), F.lit(1 - 1e-6)), F.lit(1e-6))
        odds = F.col(f"{name}_odds") + F.log(q / (1 - q)) - float(np.log(mean / (1 - mean)))
        out = out.withColumn(f"{name}_evidence", p).withColumn(name, 1 / (1 + F.exp(-odds))).drop("_site", "_path", "_n", "_s", "site_n", "site_s")
    return out.drop(*[f"{n}_odds" for n in models])
