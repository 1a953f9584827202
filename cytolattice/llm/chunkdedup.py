"""Substring dedup by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text; a chunk ends where its low bits are zero, so borders depend on the
last few bytes alone and come back to step after an insertion.  Chunks are named by the upper half of a 128-bit digest.  Of equal
chunks the first (by doc_id, row and place) stays, every other is a copy; neighbouring copies of a document are joined to runs.
A passage's first and last chunk hold foreign text too and match nothing, so both ends of a run are then compared with the first copy's
text, character by character, and moved outwards as far as they agree.  Spans of ``min_words`` words or more are reported or cut out.

To the right a run grows by less than one chunk, since both texts are in step there; to the left by ``CONTEXT`` code points
at most, which covers what chunks of ordinary words take to come into step.  Runs of less than half of ``min_words`` words in
whole chunks are not compared.  Texts are chunked once, into a written table that also fixes the row numbers.

Null and empty texts have no chunks; null ids come last in the order; equal rows are documents of their own, so the
second one is a copy; ties are broken by place; an empty table gives an empty table; columns named like the results are
replaced by ``without_copies`` and ignored by ``copied_spans``; spans of one document may overlap at their moved ends.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from ..session import settle
from .text import parts

LEAST, MASK_BITS, MOST, MIN_WORDS, GEAR_BYTES, CONTEXT = 12, 5, 256, 16, 16, 300
CHUNKS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("words", T.IntegerType()),
                                   T.StructField("high", T.LongType())]))
SPACE, BEGIN = re.compile(r"[\x20\t-\r]"), re.compile(r"(?:^|(?<=[\x20\t-\r]))[^\x20\t-\r]")


def gear_table():
    """A fixed pseudorandom 32-bit number for each byte."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 9) for b in range(256)], np.uint32)


def gear_hashes(raw, table):
    """Rolling hash after each byte: sum of table[byte] << distance over the last GEAR_BYTES bytes, doubled up."""
    h, step = table[raw], 1
    while step < GEAR_BYTES:
        moved = np.zeros_like(h)
        moved[step:] = h[:-step] << np.uint32(step)
        h = h + moved
        step *= 2
    return h


def chunk_ends(raw, table, least=LEAST, mask_bits=MASK_BITS, most=MOST):
    """Byte offsets of chunk ends, the last one the length; never inside a character."""
    n = len(raw)
    if n == 0:
        return []
    # Bits that see all GEAR_BYTES bytes, so that one byte alone does not decide.
    mask = np.uint32(((1 << mask_bits) - 1) << (GEAR_BYTES - mask_bits))
    starts = np.append((raw[1:] & 0xC0) != 0x80, True)  # the next byte begins a character
    places = np.flatnonzero(((gear_hashes(raw, table) & mask) == 0) & starts) + 1
    places, out, at, k = places.tolist(), [], 0, 0
    while at < n:
        while k < len(places) and places[k] < at + least:
            k += 1
        end = places[k] if k < len(places) else n
        if end > at + most:
            end = at + most
            while end < n and not starts[end - 1]:
                end += 1
        at = min(end, n)
        out.append(at)
    return out


def chunks_of(text, table):
    """(no, start, end, words, digest) of a text; places are code points, words those that begin in the chunk."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    ends = chunk_ends(raw, table)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begun = np.concatenate(([0], np.cumsum(~space & np.concatenate(([True], space[:-1])))))
    cuts = np.array([0, *ends])
    p, w, digest = points[cuts].tolist(), np.diff(begun[cuts]).tolist(), xxhash.xxh3_128_intdigest
    view, signed = memoryview(data), lambda x: x - (1 << 64) if x >> 63 else x
    out = []
    for i, end in enumerate(ends):
        d = digest(view[cuts[i]:end])
        out.append({"no": i, "start": p[i], "end": p[i + 1], "words": w[i], "high": signed(d >> 64), "low": signed(d & ((1 << 64) - 1))})
    return out


def chunk_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: Column | None = None) -> DataFrame:
    """(row, doc_id, text, chunks) of texts that have any, written once; ``row`` numbers the rows of ``docs``."""
    @pandas_udf(CHUNKS)
    def chunks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = gear_table()
        for batch in batches:
            for part in parts(batch, 200):
                yield pd.Series([chunks_of(t, table) if t else [] for t in part], dtype=object)

    named = docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return settle(named.withColumn("chunks", chunks("text")).where(F.size("chunks") > 0), "chunks")


def agreement(own, other):
    """Number of leading characters that two strings share."""
    n = min(len(own), len(other))
    if own[:n] == other[:n]:
        return n
    return next(i for i in range(n) if own[i] != other[i])


def moved_end(own, other, left):
    """(code points, words that begin there) by which an end moves outwards.

    ``own`` and ``other`` run outwards from the border: to the left they are reversed; to the right they start with the last character inside.
    """
    k = agreement(own, other)
    stretch, before = (own[:k + 1][::-1], len(own) > k) if left else (own[:k], True)
    began = len(BEGIN.findall(stretch)) - (1 if before and stretch and not SPACE.match(stretch) else 0)
    return k if left else max(k - 1, 0), max(began, 0)


def contexts(table: DataFrame, ends: DataFrame, width: int = CONTEXT) -> DataFrame:
    """(row, no, left, at, context) for the left or right border of each chunk in ``ends`` (row, no, left)."""
    wanted = ends.distinct().groupBy("row").agg(F.collect_list(F.struct("no", "left")).alias("ends"))

    def placed(e):
        return F.struct(e["no"].alias("no"), e["left"].alias("left"), F.get("starts", F.when(e["left"], e["no"]).otherwise(e["no"] + 1)).alias("at"))

    # The starts of all chunks and the last one's end; nothing else of the chunks is read or shuffled.
    texts = table.select("row", "text", F.concat("chunks.start", F.array(F.char_length("text"))).alias("starts"))
    asked = texts.join(wanted, "row").select("row", "text", F.transform("ends", placed).alias("ends"))

    @pandas_udf("array<struct<no: int, left: boolean, at: int, context: string>>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, places in batches:
            for ts, es in zip(parts(texts, 100), parts(places, 100)):
                yield pd.Series([[{**e, "context": t[max(e["at"] - width, 0):e["at"]][::-1] if e["left"] else t[e["at"] - 1:e["at"] + width]} for e in ends]
                                 for t, ends in zip(ts, es)], dtype=object)

    return asked.select("row", F.inline(cut("text", "ends")))


def copied_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, within: bool = False) -> DataFrame:
    """One row per span of copies: doc_id, row, start, end (code points), n_words, n_chunks, first_doc_ids.

    ``first_doc_ids`` are the documents that keep the chunks.  ``row`` numbers the rows of ``docs``.  With ``within`` a
    chunk whose first copy lies in the document itself counts too; without, only what repeats across documents.
    """
    table = chunk_table(docs, doc_id, text)
    return spans_of(table, min_words, within)


def spans_of(table: DataFrame, min_words: int = MIN_WORDS, within: bool = False) -> DataFrame:
    """Spans of copies in a table of chunks."""
    each = (table.select("row", "doc_id", F.posexplode("chunks").alias("no", "chunk"))
            .select("row", "doc_id", "no", "chunk.words", F.col("chunk.high").alias("digest")))
    # Most chunks occur once: counts of digests alone are combined first, and only chunks met again go further.
    repeated = each.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    again = settle(each.join(repeated, "digest", "left_semi"), "repeated")
    firsts = again.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "no")).alias("first"))
    other = F.col("row") != F.col("first.row")
    copies = again.join(firsts, "digest").where(other | (F.col("no") != F.col("first.no")) if within else other)
    # Neighbouring copies: number minus rank is constant in a run.  A document's own chunks bound the window.
    runs = (copies.withColumn("run", F.expr("no - row_number() over (partition by row order by no)")).groupBy("row", "run")
            .agg(F.first("doc_id").alias("doc_id"), F.min("no").alias("a"), F.max("no").alias("b"), F.sum("words").alias("words"), F.count("*").alias("n_chunks"),
                 F.array_sort(F.collect_set("first.doc_id")).alias("first_doc_ids"), F.min_by("first", "no").alias("head"), F.max_by("first", "no").alias("tail"))
            .where(F.col("words") >= min_words // 2))
    runs = settle(runs.select("row", "doc_id", "a", "b", "words", "n_chunks", "first_doc_ids", F.col("head.row").alias("head_row"), F.col("head.no").alias("head_no"),
                              F.col("tail.row").alias("tail_row"), F.col("tail.no").alias("tail_no")), "runs")
    end = lambda row, no, left: F.struct(F.col(row).alias("row"), F.col(no).alias("no"), F.lit(left).alias("left"))
    ends = runs.select(F.inline(F.array(end("row", "a", True), end("row", "b", False), end("head_row", "head_no", True), end("tail_row", "tail_no", False))))
    around = settle(contexts(table, ends), "contexts")

    def side(left, row, no, *names):
        picked = around.where(F.col("left") == left)
        return picked.select(F.col("row").alias(row), F.col("no").alias(no), *[F.col(n).alias(m) for n, m in names])

    spans = (runs.join(side(True, "head_row", "head_no", ("context", "other_left")), ["head_row", "head_no"])
             .join(side(False, "tail_row", "tail_no", ("context", "other_right")), ["tail_row", "tail_no"])
             .join(side(True, "row", "a", ("at", "start"), ("context", "own_left")), ["row", "a"])
             .join(side(False, "row", "b", ("at", "end"), ("context", "own_right")), ["row", "b"]))

    @pandas_udf("struct<n: int, words: int>")
    def moved(own: pd.Series, other: pd.Series, left: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([moved_end(*x) for x in zip(own, other, left)], columns=["n", "words"])

    spans = spans.withColumn("l", moved("own_left", "other_left", F.lit(True))).withColumn("r", moved("own_right", "other_right", F.lit(False)))
    return (spans.select("doc_id", "row", (F.col("start") - F.col("l.n")).cast("long").alias("start"), (F.col("end") + F.col("r.n")).cast("long").alias("end"),
                         (F.col("words") + F.col("l.words") + F.col("r.words")).alias("n_words"), "n_chunks", "first_doc_ids")
            .where(F.col("n_words") >= min_words))


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, within: bool = False) -> DataFrame:
    """The documents with their copied spans cut out of the text."""
    number, cuts = (next(n for n in (f"_{name}{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for name in ("row", "cuts"))
    kept = settle(docs.withColumn(number, F.monotonically_increasing_id()), "documents")
    spans = spans_of(chunk_table(kept, doc_id, text, F.col(number)), min_words, within)
    places = spans.groupBy(F.col("row").alias(number)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts))

    @pandas_udf(T.StringType())
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, places in batches:
            for ts, ps in zip(parts(texts), parts(places)):
                out = []
                for t, p in zip(ts, ps):
                    at, kept_text = 0, []
                    for c in p if p is not None and t else ():
                        kept_text.append(t[at:c["start"]])
                        at = max(at, c["end"])
                    out.append("".join(kept_text) + t[at:] if t else t)
                yield pd.Series(out, dtype=object)

    return kept.join(places, number, "left").withColumn(text, cut(F.col(f"`{text}`"), F.col(cuts))).select(*[f"`{n}`" for n in docs.columns])
