"""Nearest neighbours by inner product through an inverted multi-index.

The two halves of a vector are quantised separately; a cell is a pair of centroids, one of each half.  A query orders
the centroids of each half by its inner product with them and pops pairs from a heap by their sum, best first, until the cells popped
hold enough vectors; the vectors in these cells are then scored exactly and the best are kept.

Centroids are fitted on a bounded sample (``SAMPLE`` rows with the smallest hashes of their id); every row is indexed.
Cells are dealt out in buckets of about ``BUCKET`` rows; a fuller cell is cut into as many buckets as it needs.  Queries come in
blocks of about ``QUERY_BLOCK``, and a task scores one bucket for one block, so no task holds more than both.  Only the numbers of rows in cells, ``centroids`` squared of them, go to the driver.  Of vectors that are
equal in all components only the ``k + 1`` smallest ids can be among a query's nearest, so only these are kept: nothing
else is dropped.

Null vectors, zero vectors, vectors of another length than the most common one and vectors with null or non-finite components take no
part, as query or candidate; ties go to the smaller id; repeated ids are candidates of their own, save that a
query is not its own neighbour; an empty table gives an empty table; extra columns are not read.
"""

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import settle

SAMPLE, CENTROIDS, ROUNDS, BUCKET, QUERY_BLOCK, SHARE, LEAST_CANDIDATES = 20_000, 64, 12, 4096, 8192, 0.5, 2000
QUERIES_AT_ONCE = 128


def nearest_centroid(x, centroids):
    """Index of the nearest centroid of each row."""
    return np.argmin((centroids**2).sum(axis=1) - 2 * x @ centroids.T, axis=1)


def fit_centroids(x, k, rounds, rng):
    """k-means of the rows; fewer rows than k give fewer centroids."""
    x = np.unique(x, axis=0)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest_centroid(x, centroids)
        n = np.bincount(near, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        centroids = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centroids)
    return centroids


def cells_for(query, books, counts, enough):
    """Cells in the order of their centroids' summed inner product with the query, until they hold ``enough`` rows."""
    half = books[0].shape[1]
    scores = [b @ q for b, q in zip(books, (query[:half], query[half:]))]
    orders = [np.argsort(-s, kind="stable").tolist() for s in scores]
    sums = [s[o].tolist() for s, o in zip(scores, orders)]
    (first, other), second = sums, len(books[1])
    heap, got, out = [(-(first[0] + other[0]), 0, 0)], 0, []
    while heap and got < enough:
        _, i, j = heap[0]
        cell = orders[0][i] * second + orders[1][j]
        n = counts.get(cell, 0)
        if n:
            out.append(cell)
            got += n
        if j + 1 < second:
            heapq.heapreplace(heap, (-(first[i] + other[j + 1]), i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (-(first[i + 1] + other[0]), i + 1, 0))
    return out


def best_rows(q, asked, open_, x, ids, k):
    """(query, row, score) of each query's ``k`` best rows among those that ``open_`` allows, by score and then id; never a row of its own id.

    A matrix product picks the rows that can be among the best, with slack for its rounding; their scores are summed component by component.
    """
    rough = q @ x.T
    allowed = open_ & (asked[:, None] != ids)
    near = allowed
    if len(ids) > k and np.isfinite(rough).all():
        rough[~allowed] = -np.inf
        kth = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
        slack = 8 * x.shape[1] * np.finfo(float).eps * np.sqrt((q**2).sum(axis=1)) * np.sqrt((x**2).sum(axis=1).max()) + np.finfo(float).tiny
        near = allowed & (rough >= (kth - slack)[:, None])
    query, row = np.nonzero(near)
    score = (x[row] * q[query]).sum(axis=1)
    order = np.lexsort((ids[row], -score, query))
    query, row, score = query[order], row[order], score[order]
    n = np.bincount(query, minlength=len(q))
    first = np.arange(len(query)) - (np.cumsum(n) - n)[query] < k
    return query[first], row[first], score[first]


def buckets_of(counts, size):
    """{cell: (first bucket, buckets)}: neighbouring cells share a bucket, a full cell has several of its own."""
    out, bucket, load = {}, 0, 0
    for cell in sorted(counts):
        n = counts[cell]
        if load and load + n > size:
            bucket, load = bucket + 1, 0
        need = max(1, math.ceil(n / size))
        out[cell] = (bucket, need)
        if need > 1:
            bucket, load = bucket + need, 0
        else:
            load += n
    return out


def sound_vectors(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v) of vectors that take part, components as doubles."""
    v = F.col("v")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    plain = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    plain = settle(plain.where(v.isNotNull() & F.coalesce(fine, F.lit(False))), "vectors")
    sizes = plain.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    return plain.where(F.size("v") == (sizes["n"] if sizes else 0))


def nearest(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS,
            share: float = SHARE, least: int = LEAST_CANDIDATES, sample: int = SAMPLE, bucket: int = BUCKET, block: int = QUERY_BLOCK, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for rows whose id column ``id`` meets ``is_query``.

    A query looks at cells holding ``share`` of the distinct vectors, and ``least`` of them at least.
    """
    spark = vectors.sparkSession
    sound = sound_vectors(vectors, vec_id, vector)
    schema = "query_id long, rank int, vec_id long, score double"
    train = np.array([r["v"] for r in sound.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()], np.float64)
    if not len(train):
        return spark.createDataFrame([], schema)
    half, rng = train.shape[1] // 2, np.random.default_rng(seed)
    books = [fit_centroids(train[:, :half], centroids, ROUNDS, rng), fit_centroids(train[:, half:], centroids, ROUNDS, rng)]
    second = len(books[1])

    def matrix(column):
        return np.array(column.tolist(), np.float64)

    def assign(batches):
        for pdf in batches:
            if len(pdf):
                x = matrix(pdf["v"])
                yield pdf.assign(cell=nearest_centroid(x[:, :half], books[0]) * second + nearest_centroid(x[:, half:], books[1]))

    equal = Window.partitionBy("v").orderBy("id")
    index = sound.withColumn("copy", F.row_number().over(equal)).where(F.col("copy") <= k + 1).drop("copy")
    index = settle(index.mapInPandas(assign, "id long, v array<double>, cell long"), "index")
    counts = {r["cell"]: r["count"] for r in index.groupBy("cell").count().collect()}
    total, places = sum(counts.values()), buckets_of(counts, bucket)
    enough = max(min(least, total), math.ceil(share * total))

    def home(batches):
        for pdf in batches:
            where = np.array([places[c] for c in pdf["cell"]]).reshape(-1, 2)
            yield pdf.assign(bucket=where[:, 0] + pdf["id"].to_numpy() % where[:, 1], query=False, cells=None)

    def visit(batches):
        for pdf in batches:
            rows = []
            for query_id, v in zip(pdf["id"], pdf["v"]):
                by = {}
                for cell in cells_for(np.asarray(v), books, counts, enough):
                    first, n = places[cell]
                    for b in range(first, first + n):
                        by.setdefault(b, []).append(cell)
                rows += [(query_id, v, b, cells) for b, cells in by.items()]
            yield pd.DataFrame(rows, columns=["id", "v", "bucket", "cells"]).assign(cell=-1, query=True)

    asked = sound.where(is_query)
    blocks = max(1, math.ceil(asked.count() / block))
    layout = "id long, v array<double>, cell long, bucket long, query boolean, cells array<long>"
    # A query belongs to one block by its row; every block meets each bucket once.
    every = index.mapInPandas(home, layout).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    own = asked.mapInPandas(visit, layout).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    rows = every.unionByName(own)

    def score(pdf):
        entries, queries = pdf[~pdf["query"]].sort_values(["cell", "id"]), pdf[pdf["query"]]
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []})]
        if len(entries) and len(queries):
            x, ids = matrix(entries["v"]), entries["id"].to_numpy()
            names, name = np.unique(entries["cell"], return_inverse=True)
            for start in range(0, len(queries), QUERIES_AT_ONCE):
                part = queries.iloc[start:start + QUERIES_AT_ONCE]
                looked = np.array([np.isin(names, cells) for cells in part["cells"]])
                asked = part["id"].to_numpy()
                query, row, found = best_rows(matrix(part["v"]), asked, looked[:, name], x, ids, k)
                out.append(pd.DataFrame({"query_id": asked[query], "vec_id": ids[row], "score": found}))
        return pd.concat(out[1:] or out)

    found = rows.groupBy("bucket", "block").applyInPandas(score, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
