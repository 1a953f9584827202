"""Shards on a consistent-hash ring with virtual nodes and bounded loads; DataFrame functions only.

Every shard owns several points of a ring of hashes.  A row belongs to the first point clockwise of its key's hash.
Shards have a bounded load; rows over a full shard's bound go on clockwise to the next point whose shard has room.
What flows where depends only on the number of rows of each point, a table of ``n_shards * points`` rows at most, so
the walk is done on that table, and it and the list of arcs are the only broadcasts, bounded by
the number of points; rows then find their place by their rank within their point.  With the tight bound
(the mean, rounded up for as many shards as needed and down for the others) row counts differ by one at most; rows of shards below
their bound never move, which is what limits the movement.

Null ids hash like any other value; rows with one id are told apart by their text's size and check sum; equal rows are
interchangeable; null texts count as empty; an empty table gives an empty table; extra columns are not read.
"""

import math

from pyspark.sql import DataFrame, functions as F

from ..session import settle

POINTS, ROWS_A_PART, CELL_BITS = 64, 65_536, 10


def ring(spark, n_shards: int, points: int) -> DataFrame:
    """(position, shard) of all points in ring order."""
    return (spark.range(n_shards * points).select((F.col("id") % n_shards).cast("int").alias("shard"), F.floor(F.col("id") / n_shards).alias("copy"))
            .select(F.xxhash64(F.lit("point"), "shard", "copy").alias("position"), "shard").orderBy("position", "shard"))


def arcs_by_cell(positions):
    """[(cell, low, high, point)]: the arc of hashes of each point, cut at the borders of equal cells of the ring.

    A hash belongs to the first point at or after it; past the last comes the first.
    """
    least, most, width = -(1 << 63), (1 << 63) - 1, 64 - CELL_BITS
    arcs, low = [], least
    for point, high in enumerate(positions):
        if high >= low:
            arcs.append((low, high, point))
            low = high + 1
    if low <= most:
        arcs.append((low, most, 0))
    return [(cell, max(a, cell << width), min(b, ((cell + 1) << width) - 1), point)
            for a, b, point in arcs for cell in range(a >> width, (b >> width) + 1)]


def walk(counts, owner, bounds):
    """[(point, first rank, end rank, shard, slot of the first)] for rows flowing clockwise; lists of bounded length.

    ``counts`` has the rows of each point, ``owner`` its shard, ``bounds`` the greatest load of each shard.  In each round
    every point offers its waiting rows to its shard, in ring order; what finds no room waits at the next point.
    """
    room, filled, out = list(bounds), [0] * len(bounds), []
    waiting = [[(p, 0, n)] if n else [] for p, n in enumerate(counts)]
    while any(waiting):
        onward = [[] for _ in counts]
        for point, runs in enumerate(waiting):
            shard = owner[point]
            for home, first, end in runs:
                taken = min(room[shard], end - first)
                if taken:
                    out.append((home, first, first + taken, shard, filled[shard]))
                    room[shard] -= taken
                    filled[shard] += taken
                if first + taken < end:
                    onward[(point + 1) % len(counts)].append((home, first + taken, end))
        waiting = onward
    return out


def ring_shards(docs: DataFrame, n_shards: int, doc_id: str = "doc_id", text: str = "text", points: int = POINTS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 bytes of the text plus 8.  Slots are gapless from 0 in each shard.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    id_ = F.col(f"`{doc_id}`")
    places = ring(spark, n_shards, points).collect()
    arcs = F.broadcast(spark.createDataFrame(arcs_by_cell([r["position"] for r in places]), "cell long, low long, high long, point long"))
    rows = settle(docs.select(id_.alias("doc_id"), (F.length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")), "sizes")
    n = rows.count()
    parts = max(1, math.ceil(n / (ROWS_A_PART * len(places))))
    keyed = rows.withColumn("hash", F.xxhash64("doc_id")).withColumn("cell", F.shiftright("hash", 64 - CELL_BITS))
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", "size", F.lit(1)), F.lit(parts)))
    keyed = keyed.join(arcs, (keyed["cell"] == arcs["cell"]) & (F.col("hash") >= F.col("low")) & (F.col("hash") <= F.col("high"))).drop("cell", "low", "high")
    sizes = keyed.groupBy("point", "part").agg(F.count("*").alias("n"))
    by_point = {r["point"]: r["n"] for r in sizes.groupBy("point").agg(F.sum("n").alias("n")).collect()}
    counts, owner = [by_point.get(p, 0) for p in range(len(places))], [r["shard"] for r in places]
    natural = [sum(c for c, s in zip(counts, owner) if s == shard) for shard in range(n_shards)]
    more = set(sorted(range(n_shards), key=lambda s: (-natural[s], s))[:n % n_shards])
    runs = walk(counts, owner, [n // n_shards + (s in more) for s in range(n_shards)])
    runs = F.broadcast(spark.createDataFrame(runs, "point long, first long, end long, shard int, base long"))
    inner = "partition by point, part order by hash, doc_id, text_crc32, size"
    ranked = keyed.withColumn("rank", F.expr(f"row_number() over ({inner}) - 1"))
    before = sizes.select("point", "part", F.expr("coalesce(sum(n) over (partition by point order by part rows between unbounded preceding and 1 preceding), 0)").alias("before"))
    ranked = ranked.join(before, ["point", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    found = ranked.join(runs, (ranked["point"] == runs["point"]) & (ranked["rank"] >= runs["first"]) & (ranked["rank"] < runs["end"]))
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"))
