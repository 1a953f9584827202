"""Periodic runs of words, by longest common extensions on suffix trees.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends.  Every run is found from a
Lyndon root: at each position the longest Lyndon word under the order of symbols and under the reversed order is a candidate
(its end is the next smaller suffix), and two longest common extensions, one to the right on the suffix tree of the words and one to
the left on that of their reversal, tell how far its period reaches.  Both trees are built by Ukkonen's algorithm;
an extension is the string depth of a lowest common ancestor, found in constant time as a range minimum over the Euler tour.

A run of at least max(24, 3 q) words repeats every group of eight words in it elsewhere in the text.  Trees are therefore
built only over stretches of words whose groups of eight all occur twice or more; a run that counts lies in one such stretch and is maximal
there, so no run is lost, whatever the text's length.  Memory is a constant times the longest such stretch.

Null and empty texts have no words and no runs.  Ties for the greatest exponent go to the smallest start, then period.  Rows are
judged by their own text, so repeated rows get equal results; an empty table gives an empty table, and a column that already has
the result's name is replaced.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .text import parts, slices, words_of

LEAST_WORDS, LEAST_PERIODS, GRAM = 24, 3, 8
SLICE_CHARS = 800_000
BLOCK = 16
MIX = np.uint64(0x9E3779B97F4A7C15)
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("kept_text", T.StringType())])


# -- suffix tree -----------------------------------------------------------------------------------------------------

class SuffixTree:
    """Ukkonen's suffix tree of a list of positive integers, closed by the symbol 0 that is smaller than all others."""

    def __init__(self, symbols):
        text = [*symbols, 0]
        n = len(text)
        width = max(text) + 1
        # Node 0 is the root.  An edge belongs to its lower node; a leaf's edge ends with the text.
        first, last, link, edge = [0], [0], [0], {}
        node, at, length, waiting = 0, 0, 0, 0
        for i in range(n):
            symbol, waiting, newest = text[i], waiting + 1, 0
            while waiting:
                if length == 0:
                    at = i
                key = node * width + text[at]
                child = edge.get(key)
                if child is None:
                    edge[key] = len(first)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    if newest:
                        link[newest] = node
                        newest = 0
                else:
                    span = (last[child] if last[child] < i + 1 else i + 1) - first[child]
                    if length >= span:
                        node, at, length = child, at + span, length - span
                        continue
                    head = first[child]
                    if text[head + length] == symbol:
                        length += 1
                        if newest:
                            link[newest] = node
                        break
                    fork = len(first)
                    edge[key] = fork
                    first += (head, i)
                    last += (head + length, n)
                    link += (0, 0)
                    edge[fork * width + symbol] = fork + 1
                    first[child] = head + length
                    edge[fork * width + text[head + length]] = child
                    if newest:
                        link[newest] = fork
                    newest = fork
                waiting -= 1
                if node == 0 and length:
                    length -= 1
                    at = i - waiting + 1
                elif node:
                    node = link[node]
        self.n, self.width = n, width
        keys = np.fromiter(edge.keys(), np.int64, len(edge))
        self.child = np.fromiter(edge.values(), np.int64, len(edge))
        self.parent, self.symbol = keys // width, keys % width
        self.span = np.minimum(np.array(last), n) - np.array(first)

    def tour(self, descending=False):
        """Euler tour with children in ascending or descending order of symbols, 0 first: (nodes, their string depths)."""
        symbol = np.where(self.symbol == 0, 0, self.width - self.symbol) if descending else self.symbol
        order = np.lexsort((symbol, self.parent))
        children = self.child[order].tolist()
        stops = np.searchsorted(self.parent[order], np.arange(len(self.span)), side="right")
        begins = np.concatenate(([0], stops[:-1])).tolist()
        stops, span = stops.tolist(), self.span.tolist()
        nodes, depths, path, deep = [], [], [0], [0]
        while path:
            node = path[-1]
            nodes.append(node)
            depths.append(deep[-1])
            nth = begins[node]
            if nth < stops[node]:
                begins[node] = nth + 1
                below = children[nth]
                path.append(below)
                deep.append(deep[-1] + span[below])
            else:
                path.pop()
                deep.pop()
        return np.array(nodes, np.int64), np.array(depths, np.int64)

    def leaves(self, nodes, depths):
        """Places of the suffixes' leaves in a tour, by suffix; a leaf is met once and its depth tells its suffix."""
        leaf = np.ones(len(self.span), bool)
        leaf[self.parent] = False
        at = np.flatnonzero(leaf[nodes])
        out = np.empty(self.n, np.int64)
        out[self.n - depths[at]] = at
        return out


class Extensions:
    """Longest common extensions of pairs of suffixes in constant time each: range minima over an Euler tour.

    Minima are kept from each block's ends inwards and over powers of two of whole blocks, so memory is linear.
    """

    def __init__(self, tree):
        nodes, depths = tree.tour()
        self.leaf = tree.leaves(nodes, depths)
        blocks = -(-len(depths) // BLOCK)
        grid = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        grid[:len(depths)] = depths
        grid = grid.reshape(blocks, BLOCK)
        self.flat = grid.ravel()
        self.down = np.minimum.accumulate(grid, axis=1).ravel()
        self.up = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [grid.min(axis=1)]
        while 2 * (1 << (len(self.levels) - 1)) <= blocks:
            half = 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(self.levels[-1][:-half], self.levels[-1][half:]))

    def of(self, a, b):
        """Common prefix lengths of suffixes a and b (arrays, a != b)."""
        x, y = self.leaf[a], self.leaf[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        out = np.empty(len(x), np.int64)
        left, right = x // BLOCK, y // BLOCK
        near = np.flatnonzero(left == right)
        for step in range(BLOCK):
            place = np.minimum(x[near] + step, y[near])
            out[near] = self.flat[place] if step == 0 else np.minimum(out[near], self.flat[place])
        far = np.flatnonzero(left != right)
        out[far] = np.minimum(self.up[x[far]], self.down[y[far]])
        gap = right[far] - left[far] - 1
        level = np.zeros(len(far), np.int64)
        level[gap > 0] = np.log2(gap[gap > 0]).astype(np.int64)
        for k in range(len(self.levels)):
            here = np.flatnonzero((gap > 0) & (level == k))
            at = far[here]
            table = self.levels[k]
            out[at] = np.minimum(out[at], np.minimum(table[left[at] + 1], table[right[at] - (1 << k)]))
        return out


def lyndon_ends(ranks):
    """End of the longest Lyndon word at each position: the next suffix of smaller rank (the closing suffix is the smallest)."""
    out, waiting = [0] * len(ranks), []
    for i, rank in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > rank:
            out[waiting.pop()] = i
        waiting.append(i)
    return out


def all_runs(symbols):
    """Sorted array of (start, length, period) of every run (length of two periods or more) of a sequence of positive integers."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    forward = SuffixTree(symbols)
    right, left = Extensions(forward), Extensions(SuffixTree(symbols[::-1]))
    starts, periods = [], []
    for descending in (False, True):
        ranks = np.empty(n + 1, np.int64)
        leaf = right.leaf if not descending else forward.leaves(*forward.tour(True))
        ranks[np.argsort(leaf)] = np.arange(n + 1)
        ends = np.array(lyndon_ends(ranks.tolist())[:n])
        starts.append(np.arange(n))
        periods.append(ends - np.arange(n))
    start, period = np.concatenate(starts), np.concatenate(periods)
    begin = start - left.of(n - start, n - start - period)
    end = start + period + right.of(start, start + period)
    found = np.stack([begin, end - begin, period], axis=1)
    return np.unique(found[end - begin >= 2 * period], axis=0)


# -- texts -----------------------------------------------------------------------------------------------------------

def repeating_stretches(symbols, text_no):
    """(start, stop) of the maximal stretches of ``LEAST_WORDS`` symbols or more whose groups of GRAM symbols all occur twice or more in their text."""
    n = len(symbols) - GRAM + 1
    if n <= 0:
        return []
    grams = text_no[:n].astype(np.uint64) * MIX
    for k in range(GRAM):
        grams = (grams ^ symbols[k:k + n].astype(np.uint64)) * MIX
        grams ^= grams >> np.uint64(29)
    whole = text_no[:n] == text_no[GRAM - 1:]
    order = np.argsort(grams, kind="stable")
    sorted_grams = grams[order]
    same = sorted_grams[1:] == sorted_grams[:-1]
    twice = np.zeros(n, bool)
    twice[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
    twice &= whole
    edge = np.diff(np.concatenate(([False], twice, [False])).astype(np.int8))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + GRAM - 1
    # The last groups of a text are not whole, so a stretch never reaches into the next text.
    long = stops - starts >= LEAST_WORDS
    return list(zip(starts[long].tolist(), stops[long].tolist()))


def runs_of_words(symbols):
    """Runs of at least max(LEAST_WORDS, LEAST_PERIODS periods) in one stretch."""
    _, dense = np.unique(symbols, return_inverse=True)
    found = all_runs((dense + 1).tolist())
    return found[found[:, 1] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * found[:, 2])]


def runs_of_texts(words):
    """For lists of words one array of (start, length, period) each."""
    counts = np.array([len(w) for w in words], np.int64)
    flat = [x for w in words for x in w]
    out = [np.zeros((0, 3), np.int64)] * len(words)
    if not flat:
        return out
    symbols = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    text_no = np.repeat(np.arange(len(words)), counts)
    first = np.cumsum(counts) - counts
    for start, stop in repeating_stretches(symbols, text_no):
        found = runs_of_words(symbols[start:stop])
        if len(found):
            no = text_no[start]
            found = found + np.array([start - first[no], 0, 0])
            out[no] = np.concatenate((out[no], found))
    return [f[np.lexsort((f[:, 2], f[:, 0]))] for f in out]


def kept_words(words, runs):
    """The words left when of every run only its first period stays."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def repeated_tail(words, a, p):
    """Each word from number ``a`` on becomes the original word a + (i - a) % p."""
    n = len(words)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a] if p > 0 else words


def find_runs(docs: DataFrame, text: str = "text", into: str = "periodic", tail: tuple[Column, Column] | None = None) -> DataFrame:
    """``docs`` with a struct: number of words, the runs as (start, length, period) by start and period, and the text collapsed to one
    period of each run, its words joined by one space.

    ``tail`` = (first, divisor) integer columns makes a test pattern before the search: from word a = first % n on, the text repeats its
    1 + (n - a) // divisor words from a on.  A null or 0 divisor leaves the text as it is.
    """
    @pandas_udf(FOUND)
    def found(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, firsts, divisors in batches:
            results = []
            texts, firsts, divisors = texts.tolist(), firsts.tolist(), divisors.tolist()
            for start, stop in slices(texts, SLICE_CHARS):
                words = [words_of(t) for t in texts[start:stop]]
                for i in range(stop - start):
                    if words[i] and divisors[start + i] > 0:
                        a = firsts[start + i] % len(words[i])
                        words[i] = repeated_tail(words[i], a, 1 + (len(words[i]) - a) // divisors[start + i])
                for w, runs in zip(words, runs_of_texts(words)):
                    results.append((len(w), [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()], b" ".join(kept_words(w, runs)).decode()))
            yield pd.DataFrame(results, columns=["n_words", "runs", "kept_text"])

    first, divisor = tail or (F.lit(0), F.lit(0))
    whole = F.coalesce(divisor, F.lit(0)).cast("long")
    return docs.withColumn(into, found(F.col(f"`{text}`"), F.coalesce(first, F.lit(0)).cast("long"), whole))


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equal ones the first.  Null without runs."""
    greater = lambda x, y: y["length"] * x["period"] > x["length"] * y["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda x, y: F.when(greater(x, y), y).otherwise(x))
