"""Quality rules from repeated substrings: a suffix array over the words of each text.

The suffix array of many texts is built at once by prefix doubling (ranks hold the text, so no repeat crosses
texts).  The deepest longest-common-prefix interval around a suffix gives the longest substring that starts there
and occurs again in its text; the union of these spans is the repeated part.  A text is rejected when the repeated
part, or the longest repeat, is over its limit.

Null and empty texts have no words: all counts are 0 and the base rule rejects them.  Ties do not exist (a row is
judged by its own text alone), repeated rows get equal results, an empty table gives an empty table, and a column
that already has the result's name is replaced.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .text import SPACES, slices, words_of

MIN_WORDS, MAX_COVERED_PERCENT, MAX_LONGEST = 10, 30, 100
SLICE_CHARS = 800_000
SYMBOLS = b"#*$%&|<>"

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_cover", "longest_repeat")
MEASURES = T.StructType([T.StructField(n, T.LongType()) for n in FIELDS])


def longest_repeats(symbols, text_no):
    """For each position the length of the longest substring that starts there and occurs again in the same text.

    ``symbols`` are small integers, ``text_no`` the non-decreasing number of the text of each position.
    """
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    last = np.searchsorted(text_no, text_no, side="right")
    key = text_no.astype(np.int64) * (int(symbols.max()) + 1) + symbols
    order = np.argsort(key, kind="stable")
    rank, sizes = np.empty(n, np.int64), _starts(key[order])
    rank[order] = sizes
    levels, step = [rank.copy()], 1
    active = order[_shared(sizes)]
    while active.size:
        follow = active + step
        inside = follow < last[active]
        second = np.where(inside, rank[np.minimum(follow, n - 1)] + 1, 0)
        old = rank[active]
        key = old * (n + 1) + second
        by = np.argsort(key, kind="stable")
        active, key, old = active[by], key[by], old[by]
        starts = _starts(key)
        rank[active] = old + starts - _starts(old)
        active = active[_shared(starts)]
        step *= 2
        levels.append(rank.copy())
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    # Longest common prefix of neighbours in the suffix array, from the ranks of each doubled length.
    lcp, live = np.zeros(n, np.int64), np.arange(n - 1)
    same = levels[0][suffixes[:-1]] == levels[0][suffixes[1:]]
    live = live[same]
    a, b, got = suffixes[live], suffixes[live + 1], np.zeros(len(live), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ok = (a < n) & (b < n)
        ranks, x, y = levels[level], np.minimum(a, n - 1), np.minimum(b, n - 1)
        ok &= (ranks[x] == ranks[y]) & (a != b)
        jump = np.where(ok, 1 << level, 0)
        got += jump
        a, b = a + jump, b + jump
    lcp[live] = got
    deepest = np.maximum(lcp, np.concatenate(([0], lcp[:-1])))
    out = np.empty(n, np.int64)
    out[suffixes] = deepest
    return out


def _starts(sorted_keys):
    """Index of the first element of each run of equal keys, for every element."""
    head = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    return np.maximum.accumulate(np.where(head, np.arange(len(sorted_keys)), 0))


def _shared(starts):
    """True where a run has more than one element."""
    alone = starts == np.arange(len(starts))
    return ~(alone & np.concatenate((alone[1:], [True])))


def covered(repeats, least):
    """True for positions inside the union of the repeated spans of at least ``least`` symbols."""
    n = len(repeats)
    at = np.flatnonzero(repeats >= least)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + repeats[at], -1)
    return np.cumsum(edge[:-1]) > 0


def measure_texts(texts, min_words):
    """One row of FIELDS for each text."""
    out = np.zeros((len(texts), len(FIELDS)), np.int64)
    for start, stop in slices(texts, SLICE_CHARS):
        words = [words_of(t) for t in texts[start:stop]]
        counts = np.array([len(w) for w in words], np.int64)
        rows = out[start:stop]
        rows[:, 0] = counts
        for row, text in zip(rows, texts[start:stop]):
            if text:
                raw = text.encode()
                row[1] = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
                row[2] = len(raw) - len(raw.translate(None, SYMBOLS))
                lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
                row[3] = len(lines) - len(set(lines))
        flat = [x for w in words for x in w]
        if not flat:
            continue
        symbols = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        text_no = np.repeat(np.arange(stop - start), counts)
        repeats = longest_repeats(symbols, text_no)
        for column, least in ((4, 3), (5, min_words)):
            rows[:, column] = np.bincount(text_no, weights=covered(repeats, least), minlength=stop - start)
        filled = counts > 0
        rows[filled, 6] = np.maximum.reduceat(repeats, (np.cumsum(counts) - counts)[filled])
    return out


def measure_repetition(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, into: str = "repetition") -> DataFrame:
    """``docs`` with a struct of FIELDS: base counts, words inside repeats of ``min_words`` words or more, longest repeat."""
    @pandas_udf(MEASURES)
    def measures(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(measure_texts(batch.tolist(), min_words), columns=list(FIELDS))

    return docs.withColumn(into, measures(F.col(f"`{text}`")))


def quality_verdict(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, max_covered: int = MAX_COVERED_PERCENT,
                    max_longest: int = MAX_LONGEST, into: str = "repetition") -> DataFrame:
    """``docs`` with the struct ``into``: the measures, ``base_failed``, ``long_repeat`` and ``kept``.

    ``max_covered`` is in percent of the words, ``max_longest`` in words.
    """
    m = measure_repetition(docs, text, min_words, into)
    f = lambda n: F.col(f"`{into}`.{n}")
    failed = (f("n_words") < 50) | (100 * f("n_repeat_words") > 50 * f("n_words"))
    long = f("longest_repeat") > max_longest
    kept = ~failed & ~long & (100 * f("repeat_cover") <= max_covered * f("n_words"))
    return m.withColumn(into, F.struct(*[f(n).alias(n) for n in FIELDS], failed.alias("base_failed"),
                                       long.alias("long_repeat"), kept.alias("kept")))


def drop_repetitive(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, with their own columns."""
    name = "_repetition"
    return quality_verdict(docs, into=name, **limits).where(F.col(f"{name}.kept")).drop(name)
