"""Packing of pieces into sequences of bounded length by a grouping genetic algorithm.

A gene is a whole bin.  Crossover injects well-filled bins of one parent into the other, removes the receiver's bins
that share a piece with them, and puts the pieces so displaced back by best fit, largest first.  Pieces are dealt to
blocks of bounded size; each block is evolved on several islands, which are separate tasks with their own random
numbers, and between epochs the best packing of an island migrates to the next island of its block.  After the
epochs the pieces of badly filled bins leave their blocks and are dealt to fewer blocks for another round, so what a
block cannot fill alone is filled across blocks.

Pieces of exactly the capacity are sequences of their own; longer ones are an error of the caller and raise.  A null or
non-positive length takes an empty place: it is treated as length 0.  Repeated rows are packed one by one; ties do
not matter; an empty table gives an empty table; columns named like the results are replaced.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import settle

BLOCK, ISLANDS, EPOCHS, ROUNDS = 16_384, 2, 2, 2
POPULATION, GENERATIONS = 4, 6


def best_fit(lengths, items, bins, fills, capacity):
    """Put ``items`` (largest first) into the fullest bin with room, else a new one; ``bins`` and ``fills`` change."""
    room, mask = [[] for _ in range(capacity + 1)], 0
    for b, fill in enumerate(fills):
        if fill < capacity:
            room[capacity - fill].append(b)
            mask |= 1 << (capacity - fill)
    for i in items:
        size = lengths[i]
        ahead = mask >> size
        if ahead:
            r = size + (ahead & -ahead).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, len(fills)
            fills.append(0)
        bins[i] = b
        fills[b] += size
        if r > size:
            room[r - size].append(b)
            mask |= 1 << (r - size)


def packed(lengths, order, capacity):
    """Bins of a best-fit packing in the given order."""
    bins, fills = np.zeros(len(lengths), np.int32), []
    best_fit(lengths.tolist(), order.tolist(), bins, fills, capacity)
    return bins


def fitness(lengths, bins, capacity):
    """Fewer bins first, then the mean square fill."""
    fills = np.bincount(bins, weights=lengths)
    return -len(fills), float(np.square(fills / capacity).mean()) if len(fills) else 0.0


def crossover(lengths, giver, taker, capacity, rng):
    """A child of two packings: bins of ``giver`` go whole into ``taker``."""
    fills = np.bincount(giver, weights=lengths)
    good = fills >= np.quantile(fills, 0.5)
    chosen = good & (rng.random(len(fills)) < rng.uniform(0.05, 0.3))
    moved = chosen[giver]
    hit = np.zeros(int(taker.max()) + 1, bool)
    hit[taker[moved]] = True
    # Besides the bins that share pieces, some of the worst are opened, so that displaced pieces meet new partners.
    taken_fill = np.bincount(taker, weights=lengths)
    hit |= (taken_fill < capacity) & (taken_fill <= np.quantile(taken_fill, 0.15)) & (rng.random(len(hit)) < 0.5)
    displaced = hit[taker] & ~moved
    stay = ~hit[taker] & ~moved
    names = np.full(len(hit), -1, np.int64)
    names[np.flatnonzero(~hit)] = np.arange((~hit).sum())
    given = np.full(len(fills), -1, np.int64)
    given[np.flatnonzero(chosen)] = np.arange(chosen.sum()) + (~hit).sum()
    child = np.zeros(len(lengths), np.int32)
    child[stay], child[moved] = names[taker[stay]], given[giver[moved]]
    total = int((~hit).sum() + chosen.sum())
    filled = np.bincount(child[stay | moved], weights=lengths[stay | moved], minlength=total).astype(np.int64).tolist()
    items = np.flatnonzero(displaced)
    items = items[np.lexsort((rng.random(len(items)), -lengths[items]))]
    best_fit(lengths.tolist(), items.tolist(), child, filled, capacity)
    return np.unique(child, return_inverse=True)[1].astype(np.int32)


def evolve(lengths, population, capacity, rng, size, generations):
    """The population after some generations, best first."""
    if not population:
        population = [packed(lengths, np.argsort(-lengths, kind="stable"), capacity)]
    while len(population) < size:
        noisy = lengths * rng.uniform(0.9, 1.1, len(lengths))
        population.append(packed(lengths, np.argsort(-noisy, kind="stable"), capacity))
    scored = sorted(((fitness(lengths, p, capacity), p) for p in population), key=lambda x: x[0], reverse=True)
    bound = -math.ceil(lengths.sum() / capacity)
    for _ in range(generations):
        if scored[0][0][0] == bound:
            break
        a, b = rng.choice(len(scored), 2, replace=False)
        child = crossover(lengths, scored[a][1], scored[b][1], capacity, rng)
        scored = sorted([*scored, (fitness(lengths, child, capacity), child)], key=lambda x: x[0], reverse=True)[:size]
    return [p for _, p in scored[:size]]


STATE = "block long, island int, items binary, lengths binary, packings array<binary>, bins int, square double"


def _row(block, island, items, lengths, population, capacity):
    least, square = fitness(lengths, population[0], capacity) if len(lengths) else (0, 0.0)
    return {"block": block, "island": island, "items": items, "lengths": lengths.astype(np.int32).tobytes(),
            "packings": [p.tobytes() for p in population], "bins": -least, "square": square}


def evolve_blocks(items: DataFrame, capacity: int, n_blocks: int, seed: int, block: int, islands: int, epochs: int,
                  population: int, generations: int) -> DataFrame:
    """Best packing of each block: STATE rows.  ``items`` has ``item`` and ``length``."""
    dealt = items.select(F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(n_blocks)).alias("block"), "item", "length",
                         F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))

    def found(pdf):
        pdf = pdf.sort_values("item")
        b, i = int(pdf["block"].iloc[0]), int(pdf["island"].iloc[0])
        lengths = pdf["length"].to_numpy(np.int64)
        people = evolve(lengths, [], capacity, np.random.default_rng([seed, b % (1 << 32), i, 0]), population, generations)
        return pd.DataFrame([_row(b, i, pdf["item"].to_numpy(np.int64).tobytes(), lengths, people, capacity)])

    def go_on(epoch):
        def step(pdf):
            home = pdf[pdf["home"]].iloc[0]
            lengths = np.frombuffer(home["lengths"], np.int32).astype(np.int64)
            people = [np.frombuffer(p, np.int32) for ps in pdf.sort_values("home", ascending=False)["packings"] for p in ps]
            b, i = int(home["block"]), int(home["island"])
            people = evolve(lengths, people, capacity, np.random.default_rng([seed, b % (1 << 32), i, epoch]), population, generations)
            return pd.DataFrame([_row(b, i, home["items"], lengths, people, capacity)])
        return step

    state = settle(dealt.groupBy("block", "island").applyInPandas(found, STATE), "islands")
    for epoch in range(1, epochs):
        # The elite of each island migrates to the next one of its block.
        guests = (state.withColumn("island", F.pmod(F.col("island") + 1, F.lit(islands))).withColumn("packings", F.slice("packings", 1, 1))
                  .withColumn("items", F.lit(None).cast("binary")).withColumn("lengths", F.lit(None).cast("binary")))
        met = state.withColumn("home", F.lit(True)).union(guests.withColumn("home", F.lit(False)))
        state = settle(met.groupBy("block", "island").applyInPandas(go_on(epoch), STATE), "islands")
    best = state.groupBy("block").agg(F.min(F.struct("bins", -F.col("square"), "island")).alias("best"))
    return state.join(best.select("block", F.col("best.island").alias("island")), ["block", "island"], "left_semi")


def placed(state: DataFrame, capacity: int, round_no: int) -> DataFrame:
    """(item, length, sequence_id, offset, fill) of the best packings."""
    def rows(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                items, lengths = np.frombuffer(r.items, np.int64), np.frombuffer(r.lengths, np.int32).astype(np.int64)
                bins = np.frombuffer(r.packings[0], np.int32)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(lengths[order])
                sorted_bins = bins[order]
                head = np.concatenate(([True], sorted_bins[1:] != sorted_bins[:-1]))[:len(order)]
                base = np.maximum.accumulate(np.where(head, ends - lengths[order], 0))
                fill = np.bincount(bins, weights=lengths).astype(np.int64)
                yield pd.DataFrame({"item": items[order], "length": lengths[order], "offset": ends - lengths[order] - base, "fill": fill[sorted_bins],
                                    "sequence_id": (np.int64(round_no) << 56) + (np.int64(r.block) << 24) + sorted_bins})

    return state.select("block", "items", "lengths", "packings").mapInPandas(rows, "item long, length long, offset long, fill long, sequence_id long")


def pack(pieces: DataFrame, length: str = "length", capacity: int = 1024, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS,
         rounds: int = ROUNDS, population: int = POPULATION, generations: int = GENERATIONS, seed: int = 7) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: gapless places in sequences of at most ``capacity``.

    In all rounds but the last the bins that are not full to 1 % give their pieces to the next round.
    """
    size = F.greatest(F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0)), F.lit(0))
    kept = settle(pieces.drop("sequence_id", "offset").select("*", F.monotonically_increasing_id().alias("_item")), "pieces")
    longest = kept.agg(F.max(size)).first()[0] or 0
    if longest > capacity:
        raise ValueError(f"a piece of length {longest} is over the capacity {capacity}")
    open_ = kept.select(F.col("_item").alias("item"), size.alias("length")).where(F.col("length") < capacity)
    done = None
    for round_no in range(rounds):
        count = open_.count()
        if count == 0:
            break
        last = round_no == rounds - 1 or count <= block
        state = evolve_blocks(open_, capacity, math.ceil(count / block), seed + round_no, block, islands, epochs, population, generations)
        found = settle(placed(state, capacity, round_no), "placed")
        full = found if last else found.where(F.col("fill") * 100 >= capacity * 99)
        done = full if done is None else done.union(full)
        if last:
            break
        open_ = found.where(F.col("fill") * 100 < capacity * 99).select("item", "length")
    alone = kept.where(size >= capacity).select("*", (-1 - F.col("_item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if done is None:
        return alone.drop("_item")
    places = done.select(F.col("item").alias("_item"), "sequence_id", "offset")
    return alone.unionByName(kept.where(size < capacity).join(places, "_item")).drop("_item")
