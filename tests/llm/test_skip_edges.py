"""The skip edges of the personal data field: they alone tell a repeated number from an unrelated one."""

import itertools
import random

import numpy as np

from cytolattice.llm import skipchain as S


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        tail, lead = rng.randint(2_000_000, 9_999_999), rng.randint(200, 999)
        words = ["the", "order", "of", "last", "week", str(rng.randint(1, 2030)), f"v{rng.randint(1, 9)}.{rng.randint(0, 9)}"]
        rng.shuffle(words)
        out.append((f"{' '.join(words)} call +1 {lead} {tail} today or write to a{lead}@mail.example.com", lead, tail))
    return out


def model():
    return S.fit([g for t, *_ in texts(400, 1) for g in S.training_graphs(t)])


def without_skips(text, fitted):
    """Spans added when the graph has no skip edges."""
    graph = S.Graph(text, S.base_spans(text))
    graph.skip = []
    p = S.beliefs(graph, fitted)
    return [graph.spans[i] for i in range(graph.n) if not graph.base[i] and p[i].max() >= S.SURE and p[i].argmax() != S.OUTSIDE]


def test_hidden_repeats_are_found_by_skip_edges_alone():
    fitted, found, bare, wrong, n = model(), 0, 0, 0, 0
    for text, lead, tail in texts(200, 2):
        other = f"{lead}{(tail + 1234567) % 8_000_000 + 1_000_000}"
        if other.endswith(str(tail)):
            continue
        whole = f"{text} and then more words came {lead}{tail} but also {other} was said"
        at, off = whole.index(f"{lead}{tail}"), whole.index(other)
        added = [(s, e) for _, s, e, base in S.all_spans(whole, fitted) if not base]
        n += 1
        found += (at, at + 10) in added
        wrong += any(s < off + len(other) and e > off for s, e in added)
        bare += any(s <= at < e for s, e in without_skips(whole, fitted))
    assert n > 150 and found >= 0.95 * n and bare <= 0.05 * n and wrong <= 0.02 * n


def test_base_spans_stay_and_plain_numbers_are_left_alone():
    fitted = model()
    for text, *_ in texts(60, 3):
        spans = S.all_spans(text, fitted)
        assert [s[:3] for s in spans if s[3]] == S.base_spans(text) and all(s[3] for s in spans)


def test_beliefs_on_a_tree_equal_enumeration():
    rng = np.random.default_rng(1)
    fitted = (rng.normal(size=(S.FEATURES, S.LABELS)) * 0.3, rng.normal(size=(S.LABELS, S.LABELS)), rng.normal(size=(S.LABELS, S.LABELS)))
    graph = S.Graph("11 22 33 and a 44", [])
    assert graph.chain == [(0, 1), (1, 2)] and graph.n == 4
    graph.skip = [(1, 3)]
    graph.base[2] = 2
    got = S.beliefs(graph, fitted, rounds=200)
    unary, both = fitted[0][np.array(graph.hashed)].sum(axis=1), fitted[2] + fitted[2].T
    want = np.zeros((4, S.LABELS))
    for y in itertools.product(range(S.LABELS), repeat=4):
        if y[2] == 2:
            w = np.exp(sum(unary[i, y[i]] for i in range(4)) + fitted[1][y[0], y[1]] + fitted[1][y[1], y[2]] + both[y[1], y[3]])
            for i in range(4):
                want[i, y[i]] += w
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-3)


def test_repeats_of_findings_are_unknown_in_training():
    graph, copy = S.training_graphs("call +1 234 5678901 or 2345678901 now")
    known = {graph.spans[i]: bool(graph.known[i]) for i in range(graph.n)}
    assert known[(23, 33)] is False and known[(12, 19)] is True
    assert copy.n == graph.n + 2 and copy.base[-2] == 4 and copy.base[-1] == S.OUTSIDE and copy.known[-2:].all()
