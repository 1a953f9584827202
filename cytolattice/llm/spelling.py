"""Spelling variants: words of a vocabulary one edit apart, and the form each of them stands for.

Bloom-guided neighbourhoods: every word's deletions and substitutions are generated and probed against blocked Bloom
filters of the vocabulary, sharded by word length and broadcast.  Only the edits that a filter lets through are shuffled,
to an exact join with the vocabulary that removes false positives.  An insertion is the mirror of the other word's
deletion, and a substitution is generated from the word with the smaller letter only, so each pair is found once.

The filters take ``FILTER_BITS`` bits a word.  At most ``FILTER_BYTES`` of them are broadcast at a time; a larger vocabulary
is probed in several passes, each with its own blocks.  The edits are exact at any size: a filter only saves shuffling.

Null and empty texts have no words; a null ``doc_id`` counts as empty text.  Repeated rows count again.  Ties for the most
frequent near word go to the smaller word in code-point order.  A word of any length is taken whole.  An empty table gives
an empty result, and further columns are not read.
"""

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_CHARS, LEAST_COUNT, FORM_RATIO = 6, 5, 5
FILTER_BITS, FILTER_BYTES, BLOCK_WORDS, PROBES = 16, 64 << 20, 8, 7
LONGEST_SHARD, CHUNK_BLOCKS, WORDS_PER_TASK, EDITS_AT_ONCE = 64, 4096, 20_000, 1 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def letter_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): every maximal run of letters of every text, A-Z in lower case."""
    runs = F.regexp_extract_all(F.translate(F.col(f"`{text}`"), UPPER, LOWER), F.lit(RUN), F.lit(0))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode(runs).alias("run"))


def slipped(doc_id: Column, run: Column, every: int) -> Column:
    """The run, or the run without one letter where ``every`` divides the checksum of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(words: DataFrame, word: str = "word", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; counts are combined before the shuffle."""
    of = words.select(F.col(f"`{word}`").alias("word")).where(F.length("word") >= least_chars)
    return of.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# -- hashes of words and of their edits ------------------------------------------------------------------------------

def _powers(length):
    steps = np.full(length, STEP, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _mixed(h):
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def code_points(words):
    """Matrix of the code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def word_hashes(codes):
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def deletions(codes):
    """(row, position, hash) of the different results of deleting one letter."""
    terms = codes * _powers(codes.shape[1])
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = terms.sum(axis=1, dtype=np.uint64)[:, None] - before - terms
    new = np.ones(codes.shape, bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    row, at = np.nonzero(new)
    return row, at, before[row, at] + after[row, at] * BACK


def substitutions(codes, alphabet, start, stop):
    """(row, position, letter number, hash) of putting a greater letter at positions ``start`` to ``stop``."""
    part = codes[:, start:stop]
    row, at, letter = np.nonzero(alphabet[None, None, :] > part[:, :, None])
    powers = _powers(codes.shape[1])[start:stop]
    return row, at + start, letter, word_hashes(codes)[row] + (alphabet[letter] - part[row, at]) * powers[at]


# -- filters ---------------------------------------------------------------------------------------------------------

def shard_of(length):
    """Filters are sharded by length; words of ``LONGEST_SHARD`` letters or more share one."""
    return min(length, LONGEST_SHARD)


def block_of(mixed, blocks):
    return ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def _bits(mixed):
    second = _mixed(mixed ^ STEP)
    return ((second >> np.uint64(9 * k)) & np.uint64(511) for k in range(PROBES))


def chunk_bits(mixed, blocks, chunk):
    """The blocks of one chunk of a filter, as bytes."""
    out = np.zeros(min(CHUNK_BLOCKS, blocks - chunk * CHUNK_BLOCKS) * BLOCK_WORDS, np.uint64)
    base = (block_of(mixed, blocks) - np.uint64(chunk * CHUNK_BLOCKS)) * np.uint64(BLOCK_WORDS)
    for bit in _bits(mixed):
        np.bitwise_or.at(out, base + (bit >> np.uint64(6)), np.uint64(1) << (bit & np.uint64(63)))
    return out.tobytes()


class Filters:
    """Chunks of the filters of all lengths that one pass holds; edits of other chunks count as absent in this pass."""

    def __init__(self, blocks: dict[int, int], chunks: dict[tuple[int, int], bytes]):
        self.blocks, self.parts, self.starts = blocks, {}, {}
        for shard in {s for s, _ in chunks}:
            numbers = range(-(-blocks[shard] // CHUNK_BLOCKS))
            here = [np.frombuffer(chunks[shard, c], np.uint64) if (shard, c) in chunks else np.zeros(0, np.uint64) for c in numbers]
            sizes = np.cumsum([0] + [len(x) for x in here])
            self.parts[shard] = np.concatenate(here)
            self.starts[shard] = np.where([len(x) > 0 for x in here], sizes[:-1], -1)

    def hits(self, length, hashes):
        """Numbers of the hashes that may belong to a word of that length."""
        shard = shard_of(length)
        if shard not in self.parts:
            return np.zeros(0, np.int64)
        mixed, words = _mixed(hashes), self.parts[shard]
        block = block_of(mixed, self.blocks[shard]).astype(np.int64)
        start = self.starts[shard][block // CHUNK_BLOCKS]
        at = np.flatnonzero(start >= 0)
        base, left = start[at] + block[at] % CHUNK_BLOCKS * BLOCK_WORDS, mixed[at]
        for k in range(PROBES):
            bit = (_mixed(left ^ STEP) >> np.uint64(9 * k)) & np.uint64(511)
            ok = (words[base + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
            at, base, left = at[ok], base[ok], left[ok]
        return at


def filtered_edits(words, alphabet, filters):
    """(number of the word, edit) for the edits of words of one length that the filters let through."""
    length = len(words[0])
    rows = max(1, EDITS_AT_ONCE // (length * max(len(alphabet), 1)))
    columns = max(1, EDITS_AT_ONCE // max(len(alphabet), 1))
    for first in range(0, len(words), rows):
        part = words[first:first + rows]
        codes = code_points(part)
        row, at, hashes = deletions(codes)
        for i in filters.hits(length - 1, hashes):
            word = part[row[i]]
            yield first + row[i], word[:at[i]] + word[at[i] + 1:]
        for start in range(0, length, columns):
            row, at, letter, hashes = substitutions(codes, alphabet, start, start + columns)
            for i in filters.hits(length, hashes):
                word = part[row[i]]
                yield first + row[i], word[:at[i]] + chr(int(alphabet[letter[i]])) + word[at[i] + 1:]


def by_length(words):
    """(length, numbers of the words of that length)."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


# -- the operator ----------------------------------------------------------------------------------------------------

def _passes(chunks: list[tuple[int, int, int]], most: int) -> list[list[tuple[int, int]]]:
    """Chunks (shard, number, bytes) dealt into passes of at most ``most`` bytes (one chunk at least)."""
    passes, held = [[]], 0
    for shard, chunk, size in chunks:
        if held and held + size > most:
            passes.append([])
            held = 0
        passes[-1].append((shard, chunk))
        held += size
    return passes


def near_pairs(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words of a written vocabulary (word, n) that one edit turns into each other, once."""
    spark = vocab.sparkSession
    shard = F.least(F.length("word"), F.lit(LONGEST_SHARD))
    counts = {r["shard"]: r["m"] for r in vocab.groupBy(shard.alias("shard")).agg(F.count("*").alias("m")).collect()}   # one row a length
    alphabet = np.array(sorted(ord(r[0]) for r in vocab.select(F.explode(F.split("word", "")).alias("c")).distinct()
                               .where("c <> ''").collect()), np.uint64)                                                 # one row a letter
    blocks = {s: -(-m * FILTER_BITS // (64 * BLOCK_WORDS)) for s, m in counts.items()}
    chunks = [(s, c, min(CHUNK_BLOCKS, b - c * CHUNK_BLOCKS) * BLOCK_WORDS * 8) for s, b in sorted(blocks.items()) for c in range(-(-b // CHUNK_BLOCKS))]

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["word"].tolist()
            for length, numbers in by_length(words):
                mixed = _mixed(word_hashes(code_points([words[i] for i in numbers])))
                chunk = block_of(mixed, blocks[shard_of(length)]) // np.uint64(CHUNK_BLOCKS)
                yield pd.DataFrame({"shard": shard_of(length), "chunk": chunk.astype(np.int64), "h": mixed.view(np.int64)})

    def filled(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        bits = chunk_bits(group["h"].to_numpy().view(np.uint64), blocks[key[0]], int(key[1]))
        return pd.DataFrame({"shard": [key[0]], "chunk": [key[1]], "bits": [bits]})

    parts = 1 + sum(counts.values()) // WORDS_PER_TASK
    spread = vocab.repartition(parts, "word")
    bits = settle(spread.mapInPandas(hashed, "shard int, chunk long, h long").groupBy("shard", "chunk")
                  .applyInPandas(filled, "shard int, chunk long, bits binary"), "filters")
    found = []
    for held in _passes(chunks, filter_bytes):
        wanted = spark.createDataFrame([(s, c) for s, c in held] or [(-1, -1)], "shard int, chunk long")
        rows = bits.join(wanted, ["shard", "chunk"], "left_semi").collect()                  # at most filter_bytes
        filters = spark.sparkContext.broadcast(Filters(blocks, {(r["shard"], r["chunk"]): bytes(r["bits"]) for r in rows}))

        def probed(batches: Iterator[pa.RecordBatch], filters=filters) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
                for _, numbers in by_length(words):
                    hits = list(filtered_edits([words[i] for i in numbers], alphabet, filters.value))
                    at = numbers[np.array([i for i, _ in hits], np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in at], pa.string()), pa.array(n[at], pa.int64()),
                                                      pa.array([e for _, e in hits], pa.string())], ["a", "a_n", "word"])

        edits = spread.mapInArrow(probed, "a string, a_n long, word string")
        found.append(settle(edits.join(vocab, "word").select("a", "a_n", F.col("word").alias("b"), F.col("n").alias("b_n")), "near"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs


def followed(forms: DataFrame) -> DataFrame:
    """(word, root): the last word reached from ``word`` by its form, the form's form and so on.

    A form is several times as frequent as its word, so a chain has as many steps as the logarithm of the largest count, and doubling
    over written tables takes the logarithm of that.
    """
    step = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settle(step.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                F.col("further").isNotNull().alias("moved")), "roots")
        step = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            return step


def variant_groups(vocab: DataFrame, ratio: int = FORM_RATIO, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of a vocabulary (word, n) of distinct words."""
    vocab = settle(vocab.select("word", "n"), "vocabulary")
    pairs = near_pairs(vocab, filter_bytes)
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(pairs.select("b", "a", "a_n"))
    best = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    taken = -F.col("best.n") >= ratio * F.col("n")
    formed = settle(vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.word")).alias("form"), F.when(taken, -F.col("best.n")).alias("form_n")), "forms")
    roots = followed(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
