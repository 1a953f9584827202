"""Personal data by a skip-chain conditional random field.

Base rules give emails, addresses, cards and phone numbers.  The field's nodes are the words that hold a digit or
an ``@``; all other words are observed as outside.  Neighbouring nodes share a chain potential; nodes of equal text, and nodes
that end in the same seven digits, share skip potentials with their next occurrence however far away.  Weights are fitted by
pseudo-likelihood on the base rules' own findings in a bounded sample of documents, and on copies of these in which findings are repeated in
another writing beside unrelated numbers of that writing; base findings are then
fixed, and loopy belief propagation over a whole document labels the other nodes, so that a number
found in one place is also found where it is written in another way.  Added spans never touch base spans.

Null and empty texts have no spans.  Rows are judged by their own text, so ties and repeated rows do not matter; an
empty table gives an empty table and a model that adds nothing; columns named like the results are replaced.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .text import parts

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, FEATURES, SURE, PERTURBED = 2000, 4096, 0.95, 3
OUTSIDE, LABELS = 0, 5
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))

# Fixed patterns of the base rules, written so that each is linear in the text.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MARK, SPACE = re.compile("[0-9@]"), re.compile("[ \t-\r]")


def luhn(digits):
    """The check sum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def base_spans(text):
    """(kind number, start, end) of the base rules, by start and then kind."""
    if not text:
        return []
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def marked_words(text):
    """(start, end) of the words that hold a digit or an ``@``, in one pass."""
    out, m = [], MARK.search(text)
    while m:
        start, end = m.start(), SPACE.search(text, m.start())
        low = out[-1][1] if out else 0
        while start > low and text[start - 1] not in " \t\n\x0b\x0c\r":
            start -= 1
        out.append((start, end.start() if end else len(text)))
        m = MARK.search(text, out[-1][1])
    return out


def plausible(kind, s):
    """Whether an added span can be of its kind at all."""
    digits = sum(c.isdigit() and c.isascii() for c in s)
    if kind == 0:
        return 0 < s.find("@") < len(s) - 1
    if kind == 1:
        return bool(IP.fullmatch(s)) and all(len(p) <= 3 and int(p) <= 255 for p in s.split("."))
    plain = not re.search(r"[^0-9 ().+-]", s)
    return plain and (12 <= digits <= 19 and luhn(re.sub("[^0-9]", "", s)) if kind == 2 else 7 <= digits <= 15)


class Graph:
    """Nodes of one text with their features, edges and base labels."""

    def __init__(self, text, spans, features=FEATURES):
        found = marked_words(text)
        words = [text[a:b] for a, b in found]
        bare = [w.rstrip(".,;:!?\"')]").lstrip("\"'[") for w in words]
        self.spans = [(a + w.find(x), a + w.find(x) + len(x)) for (a, _), w, x in zip(found, words, bare)]
        self.n = len(found)
        digits = [re.sub("[^0-9]", "", w) for w in words]
        self.shapes = [re.sub("[^\\W\\d_]+", "a", re.sub("[0-9]", "9", re.sub("[0-9]{5,}", lambda m: f"<{min(len(m[0]), 20)}>", x))) for x in bare]
        self.left, self.right, chain = [], [], []
        for i in range(1, self.n):
            if 0 < found[i][0] - found[i - 1][1] <= 2:
                chain.append((i - 1, i))
        near = {b: a for a, b in chain} | {-1 - a: b for a, b in chain}
        same, tail, self.skip = {}, {}, []
        for i in range(self.n):
            for seen, key in ((same, bare[i].lower()), (tail, digits[i][-7:] if len(digits[i]) >= 7 else None)):
                if key and key in seen and (not self.skip or self.skip[-1] != (seen[key], i)):
                    self.skip.append((seen[key], i))
                if key:
                    seen[key] = i
        self.chain = chain
        self.hashed = []
        for i in range(self.n):
            before = self.shapes[near[i]] if i in near else "-"
            after = self.shapes[near[-1 - i]] if -1 - i in near else "-"
            names = (f"s{self.shapes[i][:24]}", f"d{min(len(digits[i]), 20)}", f"@{'@' in words[i]}", f"p{before[:12]}", f"n{after[:12]}",
                     f"l{len(digits[i]) >= 12 and luhn(digits[i])}", f"c{sum(c.isalpha() for c in bare[i]) > 0}.{bare[i].count('.')}")
            self.hashed.append([zlib.crc32(x.encode()) % features for x in names])
        self.known = np.ones(self.n, bool)
        self.base, k = np.zeros(self.n, np.int64), 0
        for kind, start, end in spans:
            while k and k < self.n and found[k][1] > start:
                k -= 1
            while k < self.n and found[k][1] <= start:
                k += 1
            j = k
            while j < self.n and found[j][0] < end:
                if not self.base[j]:
                    self.base[j] = kind + 1
                j += 1


def training_graphs(text, perturb=True):
    """Graphs to learn from: the text with its base labels, and a perturbed copy in which findings are repeated in another writing.

    What the base rules leave out is no proof of being outside when it shares a skip edge with a finding: such nodes are unknown.  In the copy,
    a phone is repeated without its sign and a card in dotted groups, labelled like the finding; beside each stands a number of the same writing that
    ends otherwise, labelled outside.  Only the skip edge tells the two apart, so its weight is learned from them.
    """
    spans = base_spans(text)
    graph = Graph(text, spans)
    for a, b in graph.skip:
        for x, y in ((a, b), (b, a)):
            if graph.base[x] and not graph.base[y]:
                graph.known[y] = False
    out = [graph]
    more, labels = "", {}
    for kind, start, end in spans if perturb else []:
        digits = re.sub("[^0-9]", "", text[start:end])
        if kind < 2 or len(re.sub("[^0-9]", "", text[start:end].split()[-1])) < 7 or len(labels) >= 2 * PERTURBED:
            continue
        other = f"{digits[:-7]}{(int(digits[-7:]) + 1 + zlib.crc32(digits.encode()) % 9_999_999) % 10_000_000:07d}"
        for number, label in ((digits, kind + 1), (other, OUTSIDE)):
            written = number[-10:] if kind == 3 else ".".join(number[i:i + 4] for i in range(0, len(number), 4))
            more += " said to be"
            labels[len(text) + len(more) + 1] = label
            more += f" {written}"
    if labels:
        copy = Graph(text + more, base_spans(text + more))
        copy.known = np.array([a < len(text) and k for (a, _), k in zip(copy.spans, np.concatenate((graph.known, np.ones(copy.n, bool))))], bool)
        for i, (a, _) in enumerate(copy.spans):
            if a in labels and (not copy.base[i] or labels[a] != OUTSIDE):
                copy.base[i], copy.known[i] = labels[a], True
        out.append(copy)
    return out


def fit(graphs, rounds=400, rate=2.0, decay=3e-4):
    """(unary FEATURES x LABELS, chain, skip) by pseudo-likelihood on the base labels."""
    unary, chain, skip = np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    unary[:, OUTSIDE] = 0.2  # without evidence a word is outside
    graphs = [g for g in graphs if g.n]
    if not graphs:
        return unary, chain, skip
    base = np.cumsum([0] + [g.n for g in graphs])
    hashed = np.array([h for g in graphs for h in g.hashed])
    y = np.concatenate([g.base for g in graphs])
    shift = lambda name: np.array([(a + o, b + o) for g, o in zip(graphs, base) for a, b in getattr(g, name)], np.int64).reshape(-1, 2)
    ce, se, n = shift("chain"), shift("skip"), len(y)
    target, known = np.eye(LABELS)[y], np.concatenate([g.known for g in graphs])[:, None]
    for step in range(rounds):
        score = unary[hashed].sum(axis=1)
        np.add.at(score, ce[:, 1], chain[y[ce[:, 0]]])
        np.add.at(score, ce[:, 0], chain[:, y[ce[:, 1]]].T)
        both = skip + skip.T
        np.add.at(score, se[:, 1], both[y[se[:, 0]]])
        np.add.at(score, se[:, 0], both[y[se[:, 1]]])
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        miss = known * (target - p / p.sum(axis=1, keepdims=True)) / np.sqrt(n)
        gu, gc, gs = np.zeros_like(unary), np.zeros_like(chain), np.zeros_like(skip)
        np.add.at(gu, hashed.ravel(), np.repeat(miss, hashed.shape[1], axis=0))
        np.add.at(gc, y[ce[:, 0]], miss[ce[:, 1]])
        np.add.at(gc.T, y[ce[:, 1]], miss[ce[:, 0]])
        np.add.at(gs, y[se[:, 0]], miss[se[:, 1]])
        np.add.at(gs, y[se[:, 1]], miss[se[:, 0]])
        pace = rate / np.sqrt(1 + step / 50)
        unary += pace * (gu / np.sqrt(n) * 20 - decay * unary)
        chain += pace * (gc / np.sqrt(n) * 4 - decay * chain)
        skip += pace * (gs / np.sqrt(n) * 4 - decay * skip)
    return unary, chain, skip


def beliefs(graph, model, rounds=30, damping=0.5):
    """Label marginals of the nodes by loopy sum-product messages; base labels are fixed."""
    unary, chain, skip = model
    local = unary[np.array(graph.hashed)].sum(axis=1)
    fixed = np.flatnonzero(graph.base)
    local[fixed, graph.base[fixed]] += 1e3
    both = skip + skip.T
    edges = [(a, b, chain) for a, b in graph.chain] + [(a, b, both) for a, b in graph.skip]
    if edges:
        source = np.array([a for a, b, _ in edges] + [b for a, b, _ in edges])
        sink = np.array([b for a, b, _ in edges] + [a for a, b, _ in edges])
        pair = np.array([m for _, _, m in edges] + [m.T for _, _, m in edges])
        m = len(edges)
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        sent = np.zeros((2 * m, LABELS))
        for _ in range(rounds):
            total = local.copy()
            np.add.at(total, sink, sent)
            x = (total[source] - sent[back])[:, :, None] + pair
            top = x.max(axis=1, keepdims=True)
            new = (top + np.log(np.exp(x - top).sum(axis=1, keepdims=True)))[:, 0]
            new -= new.max(axis=1, keepdims=True)
            new = damping * sent + (1 - damping) * new
            moved, sent = np.abs(new - sent).max(), new
            if moved < 1e-4:
                break
        np.add.at(local, sink, sent)
    local -= local.max(axis=1, keepdims=True)
    p = np.exp(local)
    return p / p.sum(axis=1, keepdims=True)


def all_spans(text, model, sure=SURE):
    """(kind number, start, end, base) of a text, by start and then kind."""
    spans = base_spans(text)
    out = [(*s, True) for s in spans]
    graph = Graph(text, spans) if text and MARK.search(text) else None
    if graph is None or (graph.base > 0).all():
        return out
    p = beliefs(graph, model)
    label = np.where(p.max(axis=1) >= sure, p.argmax(axis=1), OUTSIDE)
    linked, run = set(graph.chain), None
    added = []
    for i in np.flatnonzero((label != OUTSIDE) & (graph.base == 0)):
        if run and run[2] == i - 1 and (i - 1, i) in linked and run[0] == label[i] - 1:
            added[-1] = (added[-1][0], added[-1][1], graph.spans[i][1])
        else:
            added.append((int(label[i]) - 1, *graph.spans[i]))
        run = (label[i] - 1, None, i)
    taken, k = sorted((s, e) for _, s, e in spans), 0
    for kind, start, end in added:
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if plausible(kind, text[start:end]) and (k == len(taken) or taken[k][0] >= end):
            out.append((kind, start, end, False))
    return sorted(out, key=lambda s: (s[1], s[0]))


def fit_personal_data(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS):
    """Weights from at most ``sample_docs`` documents that hold a digit or an ``@``, picked by a hash of their text.

    Executors make the features; the driver gets those of the sample only.
    """
    t = F.col(f"`{text}`")
    found = docs.select(t.alias("text"), F.xxhash64(t).alias("pick")).where(F.col("text").rlike("[0-9@]"))
    cut = found.select("pick").distinct().orderBy("pick").limit(sample_docs).agg(F.max("pick")).first()[0]
    if cut is None:
        return fit([])

    def features(batches):
        for pdf in batches:
            for text_, pick in zip(pdf["text"], pdf["pick"]):
                for copy, g in enumerate(training_graphs(text_)):
                    yield pd.DataFrame([{"pick": pick, "copy": copy, "hashed": np.array(g.hashed, np.int32).tobytes(), "base": g.base.tobytes(), "known": g.known.tobytes(),
                                         "chain": np.array(g.chain, np.int64).tobytes(), "skip": np.array(g.skip, np.int64).tobytes()}])

    rows = (found.where(F.col("pick") <= cut).mapInPandas(features, "pick long, copy int, hashed binary, base binary, known binary, chain binary, skip binary")
            .dropDuplicates(["pick", "copy"]).orderBy("pick", "copy").collect())
    return fit([_read_back(r) for r in rows])


def _read_back(row):
    g = Graph("", [])
    g.base = np.frombuffer(row["base"], np.int64)
    g.n, g.known = len(g.base), np.frombuffer(row["known"], bool)
    g.hashed = np.frombuffer(row["hashed"], np.int32).reshape(g.n, -1).tolist() if g.n else []
    g.chain = np.frombuffer(row["chain"], np.int64).reshape(-1, 2).tolist()
    g.skip = np.frombuffer(row["skip"], np.int64).reshape(-1, 2).tolist()
    return g


def find_personal_data(docs: DataFrame, model, text: str = "text", into: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end, base) in code points, end exclusive, by start and then kind."""
    @pandas_udf(SPANS)
    def spans(batch: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in all_spans(t, model)] for t in batch], dtype=object)

    return docs.withColumn(into, spans(F.col(f"`{text}`")))


def masked(text, spans):
    """The text with each span replaced by its kind; spans that overlap are replaced as one."""
    out, done = [], 0
    for kind, start, end, _ in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def mask_personal_data(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", model=None) -> DataFrame:
    """The documents with their personal data replaced by the kind in brackets; ``n_chars`` follows."""
    model = model or fit_personal_data(docs, text)

    @pandas_udf(T.StringType())
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for part in parts(batch):
                yield pd.Series([masked(t, all_spans(t, model)) if t else t for t in part], dtype=object)

    return docs.withColumn(text, mask(F.col(f"`{text}`"))).withColumn(n_chars, F.length(F.col(f"`{text}`")).cast("long")).select(*docs.columns)
