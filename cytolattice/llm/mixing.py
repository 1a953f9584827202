"""Mixing of sources to target weights over fixed-length blocks of words.

The words of each source are laid end to end and cut into blocks.  An output shard has a fixed number of slots; how
many of them each source gets is a multinomial draw, taken given the sources' totals (a multivariate hypergeometric
draw, split along a binary tree of shards, so that any task computes its shards alone and the totals meet the
targets).  Slot t of a source maps to a block through a pseudorandom permutation of the source's block numbers, a new
one each time the source is used up; blocks are then joined by number with the documents that lie in them.

A null source is a source, the last one; null and empty texts have no words and are never taken; repeated rows are
documents of their own and, being equal, may swap their places; an empty table gives an empty table; columns named
like the results are replaced.  The driver holds the list of sources with their sizes, never rows.
"""

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import settle
from .text import row_key

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS, SHARD_SLOTS, MAX_USES, ROWS_A_BUCKET, SEED = 128, 4096, 3, 4096, 11
BROADCAST_SOURCES = 10_000
DRAWN_SLOTS = 10**9


def targets(sizes, weights=(1, 2, 3), most=MAX_USES):
    """Target of each source: weights repeat, all sizes are shared, none gets over ``most`` times its size."""
    total, w = float(sum(sizes)), [weights[i % len(weights)] for i in range(len(sizes))]
    out, capped = [0.0] * len(sizes), set()
    while True:
        free = total - sum(float(most * sizes[i]) for i in capped)
        shares = sum(w[i] for i in range(len(sizes)) if i not in capped)
        over = {i for i in range(len(sizes)) if i not in capped and free * w[i] > most * sizes[i] * shares}
        if not over:
            break
        capped |= over
    for i in range(len(sizes)):
        out[i] = float(most * sizes[i]) if i in capped else free * w[i] / shares
    return out


def permuted(index, n, key):
    """Pseudorandom permutation of range(n) at ``index``; arrays, one permutation for each (n, key)."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    key = key.astype(np.int64).view(np.uint64)

    def rounds(x, half, low, key):
        left, right = x >> half, x & low
        for i in range(4):
            f = (right + np.uint64(i + 1)) * np.uint64(0x9E3779B97F4A7C15) + key
            f = (f ^ (f >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(29))) & low)
        return (left << half) | right

    x = rounds(index.astype(np.uint64), half, low, key)
    while True:
        out = np.flatnonzero(x >= n.astype(np.uint64))
        if not len(out):
            return x.astype(np.int64)
        x[out] = rounds(x[out], half[out], low[out], key[out])


def half_of(left, wanted, rng):
    """How many of ``left`` slots of each source go to a range of shards with ``wanted`` slots; sums to ``wanted``.

    A draw without replacement.  Ranges with more slots than the generator takes (10^9) are split in proportion, with
    the broken slots dealt at random; the draw's relative deviation there is below 1e-4.
    """
    total = int(left.sum())
    if total < DRAWN_SLOTS:
        return rng.multivariate_hypergeometric(left, wanted, method="marginals")
    whole = [int(n) * wanted // total for n in left]
    broken = np.array([int(n) * wanted % total / total for n in left])
    missing = wanted - sum(whole)
    if missing:
        # As many distinct sources with a broken slot as are missing, likelier the larger the rest.
        order = np.argsort(np.where(broken > 0, rng.random(len(left)) ** (1 / np.maximum(broken, 1e-12)), -1))[::-1]
        for i in order[:missing]:
            whole[i] += 1
    return np.array(whole, np.int64)


def shard_counts(shard, shards, totals, slots, seed):
    """(first slot, slots) of each source in one shard; the same whoever asks.

    ``totals`` are the sources' slots; shards but the last have ``slots`` slots.  Walks the tree of shard ranges.
    """
    low, high, left = 0, shards, np.array(totals, np.int64)
    first = np.zeros(len(left), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        inner = half_of(left, int(min(left.sum(), (middle - low) * slots)), rng)
        if shard < middle:
            high, left = middle, inner
        else:
            low, first, left = middle, first + inner, left - inner
    return first, left


def source_table(rows: DataFrame, weights=(1, 2, 3), block_words: int = BLOCK_WORDS):
    """[(source, size, target, blocks, slots)] by code point, null last."""
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(((r["source"], r["size"]) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
    wanted = targets([n for _, n in found], weights)
    out = []
    for (name, size), target in zip(found, wanted):
        blocks = math.ceil(size / block_words)
        out.append((name, size, target, blocks, min(MAX_USES * blocks, round(blocks * target / size)) if size else 0))
    return out


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights=(1, 2, 3), block_words: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS, seed: int = SEED, keep: bool = True) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target``, ``taken`` (words) and ``parts``.

    ``parts`` lists what the mix takes: (use, first word, end word, shard).  With ``keep`` false only the id, the source
    and the results are carried, and the texts are read once.
    """
    spark = docs.sparkSession
    carried = docs.drop("size", "source_size", "target", "taken", "parts")
    if not keep:
        carried = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{source}`"), F.col(f"`{text}`"))
    size = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    light = settle(carried.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"), size.alias("size"), row_key(carried).alias("key"),
                                  F.monotonically_increasing_id().alias("_row")), "sizes")
    sources = source_table(light, weights, block_words)
    shards = max(1, math.ceil(sum(s[4] for s in sources) / shard_slots))
    names = spark.createDataFrame([(i, *s, zlib.crc32(repr(s[0]).encode()) + seed) for i, s in enumerate(sources)],
                                  "number int, source string, source_size long, target double, blocks long, slots long, seed long")
    if len(sources) <= BROADCAST_SOURCES:
        names = F.broadcast(names)
    # Places of the documents among their source's words: running sums in buckets, then over the buckets' totals.
    buckets = max(1, math.ceil(light.count() / ROWS_A_BUCKET))
    dealt = (light.join(names.select("number", "source"), light["source"].eqNullSafe(names["source"])).drop("source")
             .withColumn("bucket", F.pmod(F.xxhash64("id", "key", F.lit(seed)), F.lit(buckets))))
    inner = "partition by number, bucket order by id, key, size, _row rows between unbounded preceding and 1 preceding"
    within = dealt.withColumn("before", F.expr(f"coalesce(sum(size) over ({inner}), 0)"))
    ahead = dealt.groupBy("number", "bucket").agg(F.sum("size").alias("total")).withColumn(
        "base", F.expr("coalesce(sum(total) over (partition by number order by bucket rows between unbounded preceding and 1 preceding), 0)"))
    laid = within.join(ahead.drop("total"), ["number", "bucket"]).select("_row", "number", "size", (F.col("base") + F.col("before")).alias("at"))
    b = F.lit(block_words)
    lying = (laid.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / b), F.floor((F.col("at") + F.col("size") - 1) / b))))
             .select("number", "block", "_row", F.greatest(F.lit(0), F.col("block") * b - F.col("at")).alias("first"),
                     F.least("size", (F.col("block") + 1) * b - F.col("at")).alias("end")))
    totals = [s[4] for s in sources]

    uses = [F.xxhash64("seed", F.lit(use).cast("long")) for use in range(MAX_USES)]
    keys = {r["number"]: list(r["keys"]) for r in names.select("number", F.array(*uses).alias("keys")).collect()}      # a row a source
    blocks, keys = np.array([s[3] for s in sources], np.int64), np.array([keys[i] for i in range(len(sources))], np.int64).reshape(-1, MAX_USES)

    def draws(batches):
        # Drawn and mapped to blocks in one pass: every function in a stage has Python workers of its own.
        for pdf in batches:
            for shard in pdf["id"]:
                first, n = shard_counts(int(shard), shards, totals, shard_slots, seed)
                if not n.any():
                    continue
                number = np.repeat(np.arange(len(n)), n)
                t = np.arange(len(number)) + np.repeat(first - (np.cumsum(n) - n), n)
                use = t // blocks[number]
                block = permuted(t % blocks[number], blocks[number], keys[number, use])
                yield pd.DataFrame({"number": number.astype(np.int32), "shard": shard, "use": use, "block": block})

    # Spark takes the shards' numbers for the size of all their slots and would broadcast these through the driver.
    slots = spark.range(shards).mapInPandas(draws, "number int, shard long, use long, block long").hint("merge")
    parts = (lying.join(slots, ["number", "block"]).groupBy("_row")
             .agg(F.sum(F.col("end") - F.col("first")).alias("taken"), F.sort_array(F.collect_list(F.struct("use", "first", "end", "shard"))).alias("parts")))
    named = names.select("number", "source_size", "target")
    told = laid.select("_row", "number", "size").join(named, "number").drop("number").join(parts, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    told = light.select("_row", "id", "key", *(["source"] * (not keep))).join(told, "_row")
    if not keep:
        return told.select(F.col("id").alias(doc_id), F.col("source").alias(source), "size", "source_size", "target", "taken", "parts")
    # Equal rows have one name; they are told apart by their number among their equals, on both sides.  The numbers are
    # compared by two inequalities so that rows stay where the window has dealt them.
    told = told.withColumn("_copy", F.expr("row_number() over (partition by key order by _row)")).drop("id", "_row").withColumnRenamed("key", "_told")
    keyed = carried.withColumn("_key", row_key(carried))
    keyed = keyed.withColumn("_copy_no", F.row_number().over(Window.partitionBy("_key").orderBy("_key")))
    same = (keyed["_key"] == told["_told"]) & (keyed["_copy_no"] >= told["_copy"]) & (keyed["_copy_no"] <= told["_copy"])
    return keyed.join(told, same).drop("_told", "_copy", "_copy_no", "_key")


def mixed_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", **how) -> DataFrame:
    """The mixed corpus: one row for each run of neighbouring words of a document that one use takes.

    Rows have the documents' columns; ``text`` is the run, cut at word borders, and ``n_chars`` its code points.  A
    document taken as a whole keeps its text as it is.
    """
    columns, spaces = docs.columns, "\x20\x09\x0a\x0b\x0c\x0d"
    mixed, whole = mix(docs, text, **how).where("taken > 0"), F.col(f"`{text}`")
    # Neighbouring parts of one use are one run: from a part that none precedes to the next that none follows.
    apart = lambda p, q: (p["use"] != q["use"]) | (p["end"] != q["first"])
    at = lambda i: F.element_at("parts", i.cast("int"))
    starts = F.filter("parts", lambda p, i: F.when(i == 0, True).otherwise(apart(at(F.greatest(i, F.lit(1))), p)))
    ends = F.filter("parts", lambda p, i: F.when(i == F.size("parts") - 1, True).otherwise(apart(p, at(F.least(i + 2, F.size("parts"))))))
    mixed = mixed.withColumn("_runs", F.arrays_zip(F.transform(starts, lambda p: p["first"]).alias("first"), F.transform(ends, lambda p: p["end"]).alias("end")))
    some = F.exists("_runs", lambda r: (r["first"] > 0) | (r["end"] < F.col("size")))
    mixed = mixed.withColumn("_words", F.when(some, F.regexp_extract_all(whole, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)))).withColumn("_run", F.explode("_runs"))
    first, end = F.col("_run.first"), F.col("_run.end")
    cut = F.rtrim(F.array_join(F.slice("_words", (first + 1).cast("int"), (end - first).cast("int")), ""), F.lit(spaces))
    mixed = mixed.withColumn("_run", F.when((first == 0) & (end == F.col("size")), whole).otherwise(cut))
    return mixed.withColumn(text, F.col("_run")).withColumn(n_chars, F.length("_run").cast("long")).select(*columns)
