"""Spelling variants, languages and periodic runs against brute force, planted cases and edge cases."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytolattice.llm import langfield, runs, spelling

DOCS = "doc_id long, text string, lang string"


# -- spelling --------------------------------------------------------------------------------------------------------

def plain_vocabulary(rows, every=199, least_chars=6, least_count=5):
    counts = {}
    for doc_id, text in rows:
        word = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                word += c.lower() if c.isascii() else c
            elif word:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
                if every and h % every == 0:
                    word = word[:h % len(word)] + word[h % len(word) + 1:]
                counts[word] = counts.get(word, 0) + 1
                word = ""
    return {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(vocab):
    near = {w: [x for x in vocab if one_edit(w, x)] for w in vocab}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-vocab[x], x))
            if vocab[best] >= 5 * vocab[w]:
                form[w] = best
    out = {}
    for w, n in vocab.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), vocab.get(form.get(w)))
    return out


def told(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.fixture(scope="module")
def spelled():
    random.seed(3)
    base = ["gläserne", "harbour", "colours", "abbbba", "straßen", "Ècrivain", "x" * 70]
    rows = []
    for i in range(400):
        words = []
        for _ in range(12):
            w = random.choice(base)
            for _ in range(random.choice((0, 0, 0, 1, 1, 2))):
                at = random.randrange(len(w))
                w = random.choice((w[:at] + w[at + 1:], w[:at] + random.choice("abé") + w[at:], w[:at] + random.choice("abé") + w[at + 1:]))
            words.append(w)
        rows.append((i, random.choice((", ", " ", "7")).join(words)))
    return rows + [(None, "Harbour harbour"), (5, None), (6, ""), (7, "..."), (8, rows[0][1]), (0, rows[0][1])]


def test_spelling_equals_brute_force(spark, spelled):
    docs = spark.createDataFrame([(d, t, "extra") for d, t in spelled], "doc_id long, text string, word string")
    found = spelling.letter_runs(docs).select(spelling.slipped(F.col("doc_id"), F.col("run"), 199).alias("word"))
    vocab = {r["word"]: r["n"] for r in spelling.vocabulary(found).collect()}
    assert vocab == plain_vocabulary(spelled) and len(vocab) > 60
    assert told(spelling.variant_groups(spark.createDataFrame(list(vocab.items()), "word string, n long"))) == plain_groups(vocab)


def test_spelling_in_many_passes(spark, spelled):
    vocab = plain_vocabulary(spelled, every=0, least_count=1)
    table = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert told(spelling.variant_groups(table, filter_bytes=64)) == plain_groups(vocab)


def test_chains_ties_and_empty_tables(spark):
    vocab = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zzzzzz": 9, "zzzzzy": 45, "zzzzzx": 45}
    got = told(spelling.variant_groups(spark.createDataFrame(list(vocab.items()), "word string, n long")))
    assert got["aaaaaa"] == ("aaaaab", "aaabbb", 5, 1, 25) and got["zzzzzz"] == ("zzzzzx", "zzzzzx", 9, 2, 45)
    empty = spark.createDataFrame([], DOCS)
    words = spelling.letter_runs(empty).select(F.col("run").alias("word"))
    assert spelling.variant_groups(spelling.vocabulary(words)).collect() == []


def test_filters_have_no_false_negatives():
    random.seed(1)
    words = sorted({"".join(random.choice("abcdé") for _ in range(9)) for _ in range(3000)})
    mixed = spelling._mixed(spelling.word_hashes(spelling.code_points(words)))
    blocks = -(-len(words) * spelling.FILTER_BITS // 512)
    filters = spelling.Filters({9: blocks}, {(9, 0): spelling.chunk_bits(mixed, blocks, 0)})
    assert len(filters.hits(9, spelling.word_hashes(spelling.code_points(words)))) == len(words)
    others = ["".join(random.choice("fghij") for _ in range(9)) for _ in range(20000)]
    assert len(filters.hits(9, spelling.word_hashes(spelling.code_points(others)))) < 200
    codes = spelling.code_points(["abbac"])
    row, at, hashes = spelling.deletions(codes)
    assert {(int(i), int(h)) for i, h in zip(at, hashes)} == {
        (i, int(spelling.word_hashes(spelling.code_points([w]))[0])) for i, w in ((0, "bbac"), (1, "abac"), (3, "abbc"), (4, "abba"))}


# -- languages -------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("block", [1, 3, 256])
def test_marginals_equal_enumeration(monkeypatch, block):
    monkeypatch.setattr(langfield, "BLOCK_WORDS", block)
    rng = np.random.default_rng(block)
    for _ in range(8):
        lengths, k = rng.integers(1, 5, size=rng.integers(1, 4)), 3
        scores, begin, step = rng.normal(size=(lengths.sum(), k)) * 2, rng.normal(size=k), rng.normal(size=(k, k))
        first = np.zeros(len(scores), bool)
        first[np.cumsum(lengths) - lengths] = True
        found, moves, log_z = langfield.marginals(scores, first, begin, step)
        want, want_moves, want_z, at = np.zeros_like(scores), np.zeros((k, k)), 0.0, 0
        for m in lengths:
            total, here, pairs = 0.0, np.zeros((m, k)), np.zeros((k, k))
            for y in itertools.product(range(k), repeat=int(m)):
                weight = np.exp(begin[y[0]] + sum(scores[at + i, y[i]] for i in range(m)) + sum(step[y[i], y[i + 1]] for i in range(m - 1)))
                total += weight
                for i in range(m):
                    here[i, y[i]] += weight
                for i in range(m - 1):
                    pairs[y[i], y[i + 1]] += weight
            want[at:at + m], want_z, at = here / total, want_z + np.log(total), at + m
            want_moves += pairs / total
        assert np.allclose(found, want) and np.allclose(moves, want_moves) and np.isclose(log_z, want_z)


ENGLISH, GERMAN = "the house of my brother is near that river and it was cold".split(), "das haus von meinem bruder liegt nahe dem fluss und es war kalt".split()


@pytest.fixture(scope="module")
def bilingual(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(w) for _ in range(rng.randint(5, 60))), y) for i in range(300) for y, w in ((("en", ENGLISH), ("de", GERMAN))[i % 2],)]
    docs = spark.createDataFrame(rows, DOCS)
    return docs, langfield.fit_languages(docs)


def test_languages_are_told_and_transitions_are_learned(bilingual):
    docs, field = bilingual
    assert field.labels == ("de", "en") and field.step[0, 0] > field.step[0, 1] and field.step[1, 1] > field.step[1, 0]
    rows = langfield.predict_language(docs, field).collect()
    assert all(r["language"]["lang"] == r["lang"] and 0.5 < r["language"]["score"] <= 1 for r in rows)


def test_code_switching_within_a_text(spark, bilingual):
    _, field = bilingual
    text = " ".join(ENGLISH + GERMAN + ENGLISH)
    spans = langfield.language_spans(spark.createDataFrame([(1, text, "x")], DOCS), field).first()["languages"]
    assert [(s["lang"], text[s["start"]:s["end"]].split()) for s in spans] == [("en", ENGLISH), ("de", GERMAN), ("en", ENGLISH)]


def test_a_word_of_neither_language_follows_its_neighbours(spark, bilingual):
    _, field = bilingual
    rows = [(1, " ".join(ENGLISH[:6] + ["qqq"] + ENGLISH[6:]), ""), (2, " ".join(GERMAN[:6] + ["qqq"] + GERMAN[6:]), "")]
    got = {r["doc_id"]: [s["lang"] for s in r["languages"]] for r in langfield.language_spans(spark.createDataFrame(rows, DOCS), field).collect()}
    assert got == {1: ["en"], 2: ["de"]}


def test_language_edge_cases(spark, bilingual):
    docs, field = bilingual
    long = " ".join(GERMAN * 20000)
    rows = [(1, None, None), (2, "", "en"), (3, "12 34 !!", "en"), (4, long, None), (4, long, None), (None, "İİ the house", None)]
    odd = spark.createDataFrame(rows, DOCS).withColumn("language", F.lit(7))
    got = [(r["doc_id"], r["language"]["lang"]) for r in langfield.predict_language(odd, field).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (None, "en")], key=str)
    assert langfield.predict_language(docs.limit(0), field).collect() == []
    none = langfield.fit_languages(docs.where("lang = 'xx'"))
    assert none.labels == () and {r["language"]["lang"] for r in langfield.predict_language(docs, none).collect()} == {"und"}
    assert langfield.language_spans(docs.limit(1), none).first()["languages"] == []
    ids = spark.range(50).select("id", langfield.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in ids)


def test_the_fit_depends_on_texts_alone(spark, bilingual):
    docs, field = bilingual
    again = langfield.fit_languages(docs.withColumn("doc_id", -F.col("doc_id")).repartition(5, "text").union(docs))
    assert np.array_equal(field.weights, again.weights) and np.array_equal(field.step, again.step)


# -- runs ------------------------------------------------------------------------------------------------------------

def plain_runs(s):
    """All runs by comparing every position with the one a period further."""
    n, out = len(s), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            part = s[i:j + q]
            if j - i >= q and not any(all(x == y for x, y in zip(part, part[p:])) for p in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out)


def test_all_runs_equal_brute_force():
    random.seed(2)
    for _ in range(600):
        letters = random.randint(1, 4)
        s = [random.randint(1, letters) for _ in range(random.randint(0, 40))]
        s = (s[:random.randint(1, 6)] * 20)[:len(s)] if random.random() < 0.3 else s
        assert [tuple(r) for r in runs.all_runs(s).tolist()] == plain_runs(s)


def test_extensions_equal_comparison():
    random.seed(4)
    s = [random.randint(1, 2) for _ in range(300)]
    pairs = np.array([(a, b) for a in range(301) for b in range(301) if a != b and (a + b) % 7 == 0])
    got = runs.Extensions(runs.SuffixTree(s)).of(pairs[:, 0], pairs[:, 1])
    for (a, b), length in zip(pairs, got):
        k = 0
        while a + k < 300 and b + k < 300 and s[a + k] == s[b + k]:
            k += 1
        assert k == length


def plain_row(doc_id, text):
    words = (text or "").split() if not (text or "").strip() else [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    numbers = {w: i + 1 for i, w in enumerate(dict.fromkeys(words))}
    found = sorted(((s, m, q) for s, m, q in plain_runs([numbers[w] for w in words]) if m >= max(24, 3 * q)), key=lambda r: (r[0], r[2]))
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_runs_query_equals_brute_force(spark, tmp_path):
    from cytolattice.llm.queries import op13_runs
    rng = random.Random(8)
    rows = []
    for i in range(300):
        part = [rng.choice(("alpha", "beta", "gamma", "dé lta")) for _ in range(rng.randint(1, 12))]
        middle = (part * 40)[:rng.randint(20, 90)]
        rows.append((i, rng.choice((" ", "\n", " \t")).join([str(rng.randint(0, 9)) for _ in range(rng.randint(0, 30))] + middle + ["end"] * rng.randint(0, 30))))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, "a " * 50), (7, rows[7][1]), (7, rows[7][1])]
    spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, periodic int").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in op13_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_row(d, t) for d, t in rows), key=str)
    assert sum(r[1] for r in got) > 250


def test_runs_of_a_long_text_and_of_none(spark):
    rng = random.Random(9)
    head, period = [str(rng.random()) for _ in range(3000)], [str(rng.random()) for _ in range(700)]
    text = " ".join(head + period * 30 + head)
    row = runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["periodic"]
    assert [tuple(r) for r in row["runs"]] == [(3000, 21000, 700)] and row["kept_text"] == " ".join(head + period + head)
    assert runs.find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
