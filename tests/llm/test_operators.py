"""Operators on small tables with nulls, empty and long texts, ties, repeated rows, extra columns and no rows."""

import pytest
from pyspark.sql import functions as F

from cytolattice.llm import chunkdedup, graysim, lineblocks, mixing, multiindex, packing, repetition, ringshards, siteprior, skipchain, tokens

PROSE = " ".join(f"w{i * 7919 % 1009}x{i}" for i in range(120))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, sequence_id string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, PROSE), (2, PROSE), (2, PROSE), (None, None), (4, ""), (5, "mail a@b.cd now"), (6, "of " * 500), (7, PROSE * 40), (None, PROSE + " tail end")]
    return spark.createDataFrame([(i, t, None if i == 5 else "en", None if i == 6 else "s", 0, "x", "y") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality(docs, none):
    rows = repetition.quality_verdict(docs).select("doc_id", "repetition.*").collect()
    assert [(r["n_words"], r["kept"]) for r in rows if r["doc_id"] in (1, 4, 6)] == [(120, True), (0, False), (500, False)]
    assert repetition.drop_repetitive(docs).columns == docs.columns and repetition.drop_repetitive(none).count() == 0


def test_near_copies(docs, none):
    got = {(r["doc_id"], r["component_id"]) for r in graysim.near_components(docs).collect()}
    assert {(1, 1), (2, 1), (4, 4), (None, 4), (6, 6)} <= got
    left = graysim.drop_near_copies(docs)
    ids = [r["doc_id"] for r in left.collect()]
    assert left.columns == docs.columns and ids.count(1) == 1 and 2 not in ids and 4 in ids
    assert graysim.drop_near_copies(none).count() == 0 and graysim.near_components(none).count() == 0


def test_personal_data(docs, none):
    text = {r["doc_id"]: r["text"] for r in skipchain.mask_personal_data(docs).collect()}
    assert text[5] == "mail [EMAIL] now" and text[4] == "" and text[1] == PROSE
    assert skipchain.mask_personal_data(none).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix(docs, block_words=16).collect()
    assert len(rows) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(got - target) <= 32 for target, got in by.values())
    mixed = mixing.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    assert mixed.agg(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0] == sum(r["taken"] for r in rows)
    assert mixing.mix(docs, keep=False).count() == docs.count() and mixing.mixed_documents(none).count() == 0


def test_packing(docs, none):
    pieces = tokens.token_pieces(docs)
    rows = packing.pack(pieces).orderBy("sequence_id", "offset").collect()
    assert len(rows) == pieces.count() and all(len(r["ids"]) == 4 * r["length"] for r in rows)
    end = {}
    for r in rows:
        assert r["offset"] == end.get(r["sequence_id"], 0)
        end[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(end.values()) <= 1024 and packing.pack(tokens.token_pieces(none)).count() == 0


def test_shards(docs, none):
    rows = ringshards.ring_shards(docs, 4).collect()
    loads = {}
    for r in rows:
        loads.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == docs.count() and all(sorted(s) == list(range(len(s))) for s in loads.values())
    assert max(map(len, loads.values())) - min(map(len, loads.values())) <= 1 and len(loads) == 4
    assert ringshards.ring_shards(none, 4).count() == 0


def test_chunk_copies(docs, none):
    rows = chunkdedup.copied_spans(docs).collect()
    assert sorted(r["doc_id"] for r in rows if r["n_words"] >= 100 and r["doc_id"] == 2) == [2, 2] and not [r for r in rows if r["doc_id"] in (1, 4, 5)]
    assert chunkdedup.without_copies(docs).columns == docs.columns and chunkdedup.copied_spans(none).count() == 0


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, None, "<p>Some text that is here</p>")], "page_id long, url string, html string")
    assert [r["text"] for r in lineblocks.extract_main_text(pages).orderBy("page_id").collect()] == ["", "", "Some text that is here"]


def test_site_prior(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    rows = siteprior.site_scores(docs, siteprior.fit_classifiers(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r["quality"] <= 1 and r["toxic_evidence"] == 0.5 for r in rows)
    assert siteprior.site_scores(none, siteprior.fit_classifiers(none, labels)).count() == 0


def test_neighbours(spark):
    nan = float("nan")
    rows = [(i, [float(i % 7 - 3), float(i % 5 - 2), 1.0, float(i % 3)]) for i in range(60)] + [(60, None), (61, [0.0] * 4), (62, [nan, 1.0, 1.0, 1.0]), (63, [1.0, None, 1.0, 1.0]), (64, [1.0])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    plain = sorted(map(tuple, multiindex.nearest(t, F.col("id") % 20 == 0, k=5).collect()))
    assert plain == sorted(map(tuple, multiindex.nearest(t, F.col("id") % 20 == 0, k=5, bucket=7, block=1).collect()))
    got = {}
    for r in multiindex.nearest(t, F.col("id") % 20 == 0, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in (0, 20, 40):
        v = rows[q][1]
        want = sorted(((-sum(a * b for a, b in zip(v, x)), i) for i, x in rows[:60] if i != q))[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    assert multiindex.nearest(t.limit(0), F.col("id") % 20 == 0).count() == 0


def test_near_copies_follow_the_shingle_sets(spark, monkeypatch):
    def words(name, n):
        return [f"{name}{i * 7919 % 10007}" for i in range(n)]

    texts, links = [], {}
    for c in range(40):
        own, base = words(f"c{c}q", 200), words(f"b{c}z", 204)
        for other in (base, base[:178] + own[:26], base[:184] + own[:20]):  # similarity 1, 0.77 and 0.82 to the base
            texts.append(other)
        links[3 * c + 2] = 3 * c
    shingles = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in texts]
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(shingles[i] & shingles[j]) >= 4 * len(shingles[i] | shingles[j]):
                parent = [parent[j] if x == parent[i] else x for x in parent]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    want = sorted({min(i for i in range(len(texts)) if parent[i] == p) for p in parent})
    assert sorted(r["doc_id"] for r in graysim.drop_near_copies(docs).collect()) == want
    monkeypatch.setattr(graysim, "PART", 2)  # components of several parts
    assert sorted(r["doc_id"] for r in graysim.drop_near_copies(docs).collect()) == want
