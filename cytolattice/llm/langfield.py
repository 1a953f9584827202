"""Language of words and texts by a linear-chain conditional random field.

The nodes are the words of a text that hold a letter; their labels are the languages.  A word's potentials are sums of learned weights of
its prefixes and suffixes of one to three letters, its letter groups of one to four, and the word itself (the lexicon).  Neighbouring
words share a learned transition.  Forward-backward gives each word's probabilities of languages; a text's language is the
one with most expected words, so passages in another language are told from the text around them.

Weights are fitted by gradient steps on the likelihood of whole label sequences.  Labelled texts hold one language each, so the training sequences
are spliced from passages of different texts, of one to ``PASSAGE`` words: the transitions are those of code-switched text.
The fit takes at most ``SAMPLE_TEXTS`` labelled texts, and of each at most ``SAMPLE_PASSAGES`` passages spread over the whole text.

Null texts and texts without a letter are ``und`` with score 0, as are all when nothing is labelled.  Ties go to the smaller label.
Rows are judged by their own text, so repeated rows get equal results; texts of any length are taken whole; an empty table gives an empty table, and
columns named like the results are replaced.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .text import slices

UNKNOWN = "und"
SAMPLE_TEXTS, SAMPLE_PASSAGES, PASSAGE, SEQUENCE_WORDS = 3000, 3, 40, 120
BUCKETS, GRAMS, AFFIXES, SLOTS = 1 << 18, 4, 3, 64
ROUNDS, BATCH, RATE, SHRINK = 4, 64, 0.15, 1e-6
SLICE_CHARS, BLOCK_WORDS = 800_000, 256
LANGUAGE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _classes():
    """For every code point: 0 space, 1 other, 2 letter."""
    kinds = np.ones(0x110000, np.int8)
    kinds[[0x20, *range(0x09, 0x0E)]] = 0
    kinds[[c for c in range(0x110000) if chr(c).isalpha()]] = 2
    return kinds


def letter_words(texts):
    """(codes, starts, stops, text numbers) of the words with a letter, in lower case letter by letter; starts count in the joined texts."""
    joined = "\n".join(t or "" for t in texts)
    lowered = joined.lower()
    if len(lowered) != len(joined):                       # a few letters have a longer lower case
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in joined)
    codes = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    kinds = _classes()[codes]
    edge = np.diff(np.concatenate(([0], (kinds > 0).astype(np.int8), [0])))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters = np.concatenate(([0], np.cumsum(kinds == 2)))
    with_letter = letters[stops] > letters[starts]
    starts, stops = starts[with_letter], stops[with_letter]
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    return codes, starts, stops, np.searchsorted(ends, starts, side="right")


def word_hashes(codes, starts, stops):
    """One hash for each word."""
    lengths = stops - starts
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(int(lengths.max()), MIX), dtype=np.uint64)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.add.reduceat(codes[np.repeat(starts, lengths) + place].astype(np.uint64) * powers[place], np.cumsum(lengths) - lengths)


def features(codes, starts, stops):
    """(word number, bucket) of all features of all words, as two arrays."""
    lengths = stops - starts
    words, buckets = [], []

    def put(no, kind, hashes):
        h = (hashes ^ np.uint64(kind)) * MIX
        words.append(no)
        buckets.append(((h ^ (h >> np.uint64(29))) * MIX >> np.uint64(40)).astype(np.int64) % BUCKETS)

    every = np.arange(len(starts))
    inside = np.repeat(every, lengths)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at, left = starts[inside] + place, lengths[inside] - place
    values = codes.astype(np.uint64)
    gram = np.zeros(len(at), np.uint64)
    for k in range(GRAMS):
        whole = left > k
        at, left, inside, place, gram = at[whole], left[whole], inside[whole], place[whole], gram[whole]
        gram = (gram + values[at + k]) * MIX
        put(inside, 10 + k, gram)
        if k < AFFIXES:
            put(inside[place == 0], 20 + k, gram[place == 0])
            put(inside[left == k + 1], 30 + k, gram[left == k + 1])
    put(every, 40, word_hashes(codes, starts, stops))
    return np.concatenate(words) if words else np.zeros(0, np.int64), np.concatenate(buckets) if buckets else np.zeros(0, np.int64)


def word_scores(weights, codes, starts, stops):
    """Log potentials of every word and label: the mean of the weights of its features, times the root of their number."""
    no, bucket = features(codes, starts, stops)
    out = np.stack([np.bincount(no, weights=weights[bucket, y], minlength=len(starts)) for y in range(weights.shape[1])], axis=1)
    count = np.bincount(no, minlength=len(starts))
    return out / np.sqrt(np.maximum(count, 1))[:, None], no, bucket, count


def marginals(scores, first, begin, step):
    """Probabilities of labels by forward-backward over sequences laid end to end.

    ``first`` marks the first word of each sequence, ``begin`` and ``step`` are log potentials.  A first word's matrix forgets what was
    before it, so all sequences are one chain of matrices; blocks of it are multiplied in step, then joined, so no loop runs over words.
    Returns (probabilities, expected transitions, log of the partition function of all).
    """
    n, k = scores.shape
    top = scores.max(axis=1, keepdims=True)
    emit = np.exp(scores - top)
    move, enter = np.exp(step - step.max()), np.exp(begin - begin.max())
    size = int(min(BLOCK_WORDS, max(1, n)))
    blocks = -(-n // size)
    pad = blocks * size - n
    emit = np.concatenate((emit, np.ones((pad, k)))).reshape(blocks, size, k)
    fresh = np.concatenate((first, np.ones(pad, bool))).reshape(blocks, size)

    def matrices(t):
        return np.where(fresh[:, t, None, None], enter[None, None, :], move[None]) * emit[:, t, None, :]

    product = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(size):
        product = product @ matrices(t)
        product = product / product.sum(axis=(1, 2), keepdims=True)
    state = np.full((blocks, k), 1.0 / k)
    ending = np.ones((blocks, k))
    for b in range(1, blocks):
        state[b] = state[b - 1] @ product[b - 1]
        state[b] /= state[b].sum()
    for b in range(blocks - 2, -1, -1):
        ending[b] = product[b + 1] @ ending[b + 1]
        ending[b] /= ending[b].sum()
    forward = np.empty((blocks, size, k))
    scale = np.empty((blocks, size))
    for t in range(size):
        state = (np.where(fresh[:, t, None], enter[None], state @ move)) * emit[:, t]
        scale[:, t] = state.sum(axis=1)
        state = state / scale[:, t, None]
        forward[:, t] = state
    backward = np.empty((blocks, size, k))
    for t in range(size - 1, -1, -1):
        backward[:, t] = ending
        ahead = ending * emit[:, t]
        ending = np.where(fresh[:, t, None], (ahead @ enter)[:, None], ahead @ move.T)
        ending = ending / ending.sum(axis=1, keepdims=True)
    forward, backward, emit = (x.reshape(-1, k)[:n] for x in (forward, backward, emit))
    both = forward * backward
    both /= both.sum(axis=1, keepdims=True)
    later = np.flatnonzero(~first)
    pairs = forward[later - 1][:, :, None] * move[None] * (emit[later] * backward[later])[:, None, :]
    expected = (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if len(later) else np.zeros((k, k))
    log_z = np.log(scale.reshape(-1)[:n]).sum() + top.sum() + first.sum() * begin.max() + (~first).sum() * step.max()
    return both, expected, log_z


# -- fitting ---------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class LanguageField:
    """Labels in order, weights of feature buckets, and the log potentials of first labels and of transitions."""

    labels: tuple[str, ...]
    weights: np.ndarray
    begin: np.ndarray
    step: np.ndarray


def splice(passages, random):
    """Training sequences: passages (text, label) in random order, joined until a sequence has ``SEQUENCE_WORDS`` words."""
    out, words = [[]], 0
    for i in random.permutation(len(passages)):
        out[-1].append(passages[i])
        words += len(passages[i][0].split())
        if words >= SEQUENCE_WORDS:
            out.append([])
            words = 0
    return [s for s in out if s]


def fit_passages(passages, labels, rounds=ROUNDS, seed=42):
    """The field of most likelihood over spliced passages, by adaptive gradient steps."""
    k, random = len(labels), np.random.default_rng(seed)
    weights, begin, step = np.zeros((BUCKETS, k)), np.zeros(k), np.zeros((k, k))
    sums = [np.full((BUCKETS, k), 1e-8), np.full(k, 1e-8), np.full((k, k), 1e-8)]
    number = {y: i for i, y in enumerate(labels)}
    for _ in range(rounds):
        sequences = splice(passages, random)
        for start in range(0, len(sequences), BATCH):
            batch = sequences[start:start + BATCH]
            pieces = [p for s in batch for p in s]
            codes, starts, stops, piece = letter_words([p[0] for p in pieces])
            if not len(starts):
                continue
            truth = np.array([number[p[1]] for p in pieces])[piece]
            sequence = np.repeat(np.arange(len(batch)), [len(s) for s in batch])[piece]
            first = np.concatenate(([True], sequence[1:] != sequence[:-1]))
            scores, no, bucket, count = word_scores(weights, codes, starts, stops)
            found, expected, _ = marginals(scores, first, begin, step)
            gap = -found
            gap[np.arange(len(truth)), truth] += 1
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[:-1][~first[1:]], truth[1:][~first[1:]]), 1)
            used, place = np.unique(bucket, return_inverse=True)
            share = gap / np.sqrt(count)[:, None]
            steps = np.stack([np.bincount(place, weights=share[no, y], minlength=len(used)) for y in range(k)], axis=1) - SHRINK * weights[used]
            sums[0][used] += steps ** 2
            weights[used] += RATE * steps / np.sqrt(sums[0][used])
            for value, gain, total in ((begin, gap[first].sum(axis=0), sums[1]), (step, seen - expected, sums[2])):
                total += gain ** 2
                value += RATE * gain / np.sqrt(total)
    return LanguageField(tuple(labels), weights, begin, step)


def passages_of(text, seed):
    """At most ``SAMPLE_PASSAGES`` passages of whole words, their places and lengths drawn over the whole text."""
    words = text.split()
    if not words:
        return []
    random = np.random.default_rng(seed)
    out = []
    for _ in range(SAMPLE_PASSAGES):
        start = int(random.integers(len(words)))
        out.append(" ".join(words[start:start + 1 + int(random.integers(PASSAGE))]))
    return out


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = SAMPLE_TEXTS) -> LanguageField:
    """The field fitted on a sample of at most ``most`` of the given labelled texts, evenly over the languages.

    The sample is drawn by a hash of the text, so it depends neither on row order nor on ids; repeated rows weigh no more.
    Every language is learned; with more than ``most`` languages, one text of each of the ``most`` that have most texts.
    """
    labelled = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    top = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()
    if not top:
        return LanguageField((), np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros((0, 0)))
    each = max(1, most // len(top))

    @pandas_udf(T.ArrayType(T.StringType()))
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([passages_of(t, zlib.crc32(t.encode("utf-8", "surrogatepass"))) for t in texts])

    spans = labelled.select("lang", F.xxhash64("text", "lang").alias("h"), cut("text").alias("passages"))
    # The first of each slot of hashes, then the first of these: no task sees more than twice the sample of a language.
    first = lambda df, keys, n: df.withColumn("no", F.row_number().over(Window.partitionBy(*keys).orderBy("h"))).where(F.col("no") <= n)
    spans = spans.withColumn("slot", F.pmod("h", F.lit(SLOTS)))
    picked = first(first(spans.dropDuplicates(["lang", "h"]), ["lang", "slot"], -(-2 * each // SLOTS)), ["lang"], each)
    wanted = {r["lang"] for r in top}
    passages = [(p, r["lang"]) for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["h"])) if r["lang"] in wanted for p in r["passages"]]
    return fit_passages(passages, sorted(wanted))


# -- prediction ------------------------------------------------------------------------------------------------------

def label_texts(texts, field):
    """(start, stop, text number, probabilities) of the words with a letter of a few texts; starts count in their text."""
    codes, starts, stops, text_no = letter_words(texts)
    if not len(starts) or not field.labels:
        return starts, stops, text_no, np.zeros((len(starts), len(field.labels)))
    first = np.concatenate(([True], text_no[1:] != text_no[:-1]))
    _, heads, each = np.unique(word_hashes(codes, starts, stops), return_index=True, return_inverse=True)      # a word is scored once
    scores, *_ = word_scores(field.weights, codes, starts[heads], stops[heads])
    found, _, _ = marginals(scores[each], first, field.begin, field.step)
    begins = np.concatenate(([0], np.cumsum([len(t or "") + 1 for t in texts])))[text_no]
    return starts - begins, stops - begins, text_no, found


def _shared(docs: DataFrame, field: LanguageField):
    return docs.sparkSession.sparkContext.broadcast(field)         # BUCKETS weights a language


def predict_language(docs: DataFrame, field: LanguageField, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct of the text's language and its share of the expected words."""
    shared = _shared(docs, field)

    @pandas_udf(LANGUAGE)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, langs, scores = batch.tolist(), [], []
            for start, stop in slices(values, SLICE_CHARS):
                _, _, text_no, found = label_texts(values[start:stop], shared.value)
                labels = shared.value.labels
                sums = np.stack([np.bincount(text_no, weights=found[:, y], minlength=stop - start) for y in range(len(labels))], axis=1) if labels else np.zeros((stop - start, 1))
                total = sums.sum(axis=1)
                best = sums.argmax(axis=1)
                langs += [labels[b] if t > 0 else UNKNOWN for b, t in zip(best, total)]
                scores += np.clip(np.where(total > 0, sums.max(axis=1) / np.where(total > 0, total, 1), 0.0), 0, 1).tolist()
            yield pd.DataFrame({"lang": pd.Series(langs, dtype=object), "score": pd.Series(scores, dtype=float)})

    return docs.withColumn(into, predicted(F.col(f"`{text}`")))


def language_spans(docs: DataFrame, field: LanguageField, text: str = "text", into: str = "languages") -> DataFrame:
    """``docs`` with the passages of each text by language: runs of words of the same most probable label, in code points, with their mean probability."""
    shared = _shared(docs, field)

    @pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values, out = batch.tolist(), []
            for start, stop in slices(values, SLICE_CHARS):
                begins, ends, text_no, found = label_texts(values[start:stop], shared.value)
                rows = [[] for _ in range(stop - start)]
                if len(begins) and shared.value.labels:
                    label, best = found.argmax(axis=1), found.max(axis=1)
                    heads = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (text_no[1:] != text_no[:-1]))))
                    tails = np.concatenate((heads[1:], [len(label)]))
                    means = np.add.reduceat(best, heads) / (tails - heads)
                    for h, t, mean in zip(heads, tails, means):
                        rows[text_no[h]].append({"start": int(begins[h]), "end": int(ends[t - 1]), "lang": shared.value.labels[label[h]], "score": float(mean)})
                out += rows
            yield pd.Series(out, dtype=object)

    return docs.withColumn(into, spans(F.col(f"`{text}`")))


def held_out(doc_id: Column) -> Column:
    """True for a quarter of the ids, by checksum; they are kept out of the fit.  A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2
