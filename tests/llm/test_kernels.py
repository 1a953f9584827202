"""Kernels against brute force."""

import random
import re

import numpy as np
import pytest

from cytolattice.llm import chunkdedup, graysim, lineblocks, mixing, multiindex, packing, repetition, ringshards, skipchain, tokens


def test_longest_repeats_match_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randrange(25))] for _ in range(rng.randrange(1, 5))]
        want = []
        for t in texts:
            for i in range(len(t)):
                most = 0
                for j in range(len(t)):
                    k = 0
                    while i != j and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                        k += 1
                    most = max(most, k)
                want.append(most)
        flat = np.array([x for t in texts for x in t], np.int64)
        assert repetition.longest_repeats(flat, np.repeat(np.arange(len(texts)), [len(t) for t in texts])).tolist() == want


def test_index_finds_all_links():
    rng = np.random.default_rng(0)
    for _ in range(15):
        x = []
        for v in rng.integers(0, 2**63, 4, dtype=np.uint64).tolist() * 12:
            for _ in range(rng.integers(0, 5)):
                v ^= 1 << int(rng.integers(64))
            x.append(v)
        x = np.unique(np.array(x, np.uint64))
        want, found = np.arange(len(x)), np.arange(len(x))
        a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
        graysim.forest(a, b, want)
        for block in graysim.STRICT.blocks:
            graysim.forest(np.arange(len(x)), graysim.linked_classes([x], block, 2), found)
        for _ in range(6):
            want, found = want[want], found[found]
        assert (want == found).all()


def test_base_spans_match_plain_patterns():
    plain = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    rng = random.Random(3)
    for _ in range(5000):
        s = "".join(rng.choice("a1.@+- ()2_%555a.1") for _ in range(rng.randrange(1, 40)))
        want = []
        for kind, p in enumerate(plain):
            for m in re.finditer(p, s):
                d = re.sub("[^0-9]", "", m[0])
                if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m[0].split(".")) or kind == 2 and 12 <= len(d) <= 19 and skipchain.luhn(d)
                        or kind == 3 and 9 <= len(d) <= 15):
                    want.append((kind, *m.span()))
        assert skipchain.base_spans(s) == sorted(want, key=lambda x: (x[1], x[0]))


def test_field_adds_a_phone_that_the_base_rule_drops():
    texts = [f"call +1 ({i:03d}) 555-{i * 7 % 10000:04d} or write a{i}@mail.example.com about 12{i} things" for i in range(200, 400)]
    model = skipchain.fit([skipchain.Graph(t, skipchain.base_spans(t)) for t in texts])
    text = "call +1 (132) 555-1352 190.137.223.20 today"
    assert skipchain.base_spans(text) == [(1, 23, 37)]
    assert (3, 5, 22, False) in skipchain.all_spans(text, model)
    assert skipchain.all_spans("version 2.0 of 1999", model) == []


def test_permutation_and_shard_counts():
    for n in (1, 2, 3, 100):
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 7))) == list(range(n))
    totals, done = [100, 0, 3000, 77], np.zeros(4, int)
    shards = -(-sum(totals) // 64)
    for s in range(shards):
        first, n = mixing.shard_counts(s, shards, totals, 64, 3)
        assert (first == done).all()
        done += n
    assert done.tolist() == totals
    assert mixing.targets([100, 1, 50]) == pytest.approx([74.0, 3.0, 74.0 + 0.0], abs=40)
    assert sum(mixing.targets([100, 1, 50])) == pytest.approx(151)


def test_huge_totals_are_split_whole():
    totals, slots, shards = [3 * 10**9, 1, 0, 1_500_000_123, 7], 4096, 0
    shards = -(-sum(totals) // slots)
    rng = np.random.default_rng(1)
    for wanted in (0, 1, sum(totals) // 2, sum(totals)):
        got = mixing.half_of(np.array(totals), wanted, rng)
        assert got.sum() == wanted and (got >= 0).all() and (got <= totals).all()
    picked = [mixing.shard_counts(s, shards, totals, slots, 3) for s in (0, 1, shards // 2, shards - 1)]
    assert [int(n.sum()) for _, n in picked] == [slots] * 3 + [sum(totals) - slots * (shards - 1)]
    assert (picked[0][0] + picked[0][1] == picked[1][0]).all() and (picked[-1][0] + picked[-1][1] == totals).all()


def test_packing_is_near_the_bound_and_crossover_keeps_items():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1024, 2000)
    a = packing.evolve(lengths, [], 1024, rng, 4, 5)
    assert np.bincount(a[0], weights=lengths).max() <= 1024
    assert len(np.unique(a[0])) <= 1.03 * -(-lengths.sum() // 1024)
    child = packing.crossover(lengths, a[0], a[1], 1024, rng)
    assert len(child) == 2000 and np.bincount(child, weights=lengths).max() <= 1024 and (np.bincount(child) > 0).all()


def test_chunks_cover_the_text_and_resist_insertion():
    table = chunkdedup.gear_table()
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdéfg") for _ in range(rng.randrange(1, 9))) for _ in range(400))
    chunks = chunkdedup.chunks_of(text, table)
    assert chunks[0]["start"] == 0 and chunks[-1]["end"] == len(text) and all(a["end"] == b["start"] for a, b in zip(chunks, chunks[1:]))
    assert sum(c["words"] for c in chunks) == len(text.split())
    moved = {(c["high"], c["low"]) for c in chunkdedup.chunks_of("new words in front " + text, table)}
    assert sum((c["high"], c["low"]) in moved for c in chunks) >= len(chunks) - 4


def test_ring_walk_fills_to_the_bounds():
    runs = ringshards.walk([10, 0, 5, 1], [0, 1, 0, 1], [8, 8])
    loads = [0, 0]
    for _, a, b, shard, base in runs:
        assert base == loads[shard]
        loads[shard] += b - a
    assert loads == [8, 8]


def test_cells_come_in_order_of_their_sums():
    rng = np.random.default_rng(1)
    books = [rng.normal(size=(5, 3)), rng.normal(size=(4, 3))]
    q = rng.normal(size=6)
    counts = {c: 1 for c in range(20)}
    sums = [books[0][c // 4] @ q[:3] + books[1][c % 4] @ q[3:] for c in multiindex.cells_for(q, books, counts, 20)]
    assert len(sums) == 20 and sums == sorted(sums, reverse=True)


def test_main_text():
    page = ("<html><head><title>T</title><script>var x='</p>';</script></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav>"
            "<div class='ad'>Buy this now, it is a very good thing to have at home</div><h2>Title &amp; more</h2><p>First  paragraph, long enough to be\nan article.<p>Be.</p>"
            "<div id='comments'><p>Great article, thank you very much for all of it</p></div><footer>&copy; us</footer>")
    assert lineblocks.main_text(page) == "Title & more\n\nFirst paragraph, long enough to be an article.\n\nBe."
    assert lineblocks.main_text(None) == lineblocks.main_text("") == lineblocks.main_text("<nav>only a menu</nav>") == ""
    for bad in ("<" * 5000, "<a " * 5000, "<div>" * 5000 + "</p>" * 5000, "<!--" * 5000, "<title>" * 5000):
        lineblocks.main_text(bad)


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer
    own, encode = Tokenizer.from_file(tokens.public_vocabulary()[0]), tokens.encoder(*tokens.public_vocabulary())
    for t in ("", "Héllo  wörld\n\n 123", "a<|endoftext|>b", "x" * 3000, "  \t\n ", "日本語 text"):
        assert list(encode(t)) == own.encode(t, add_special_tokens=False).ids


def test_exact_classes_match_brute_force():
    rng = random.Random(8)
    for _ in range(40):
        sets = []
        for _ in range(rng.randrange(1, 25)):
            x = set(rng.choice(sets)) if sets and rng.random() < 0.7 else {rng.randrange(2**63) for _ in range(rng.randrange(12))}
            x ^= {rng.randrange(2**63) for _ in range(rng.randrange(3))}
            sets.append(set(rng.sample(sorted(x), max(0, len(x) - rng.randrange(3)))))
        arrays = [np.array(sorted(x), np.uint64) for x in sets]
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] & sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
        want = np.arange(len(sets))
        graysim.forest(np.array([i for i, _ in pairs], int), np.array([j for _, j in pairs], int), want)
        assert (graysim.exact_classes(arrays, (4, 5)) == want).all()


def test_main_text_outside_a_marked_teaser():
    body = "".join(f"<div>Paragraph {i} of the body, which is long enough to be text of the article.</div>" for i in range(4))
    text = lineblocks.main_text(f"<body><article><p>Teaser.</p></article><nav><p>1</p><p>2</p><p>3</p></nav>{body}<main><p>End.</p></main></body>")
    assert text.startswith("Teaser.") and text.endswith("End.") and text.count("Paragraph") == 4


def test_main_text_keeps_short_parts_and_linked_lines():
    long = "".join(f"<p>{'Sentence of the first part. ' * 20}{i}</p>" for i in range(8))
    link = "<p><a href=x>Link</a></p>"
    page = f"<body><h2><a href=y>Heading</a></h2>{long}<li><a href=z>Item</a></li><p>{'More of it. ' * 5}</p>{link * 3}<p>{'The closing part. ' * 36}</p></body>"
    text = lineblocks.main_text(page)
    assert text.startswith("Heading\n\n") and "\n\nItem\n\n" in text and text.endswith("The closing part.")


def test_main_text_in_wrappers_with_telling_names():
    text = "".join(f"<p>Paragraph {i} of the text, which is long enough to be an article.</p>" for i in range(3))
    for name in ("page has-sidebar", "no-comments", "with-header", "entry-header", "search", "comments"):
        assert lineblocks.main_text(f"<div class='{name}'><article>{text}</article></div>").count("Paragraph") == 3
        assert lineblocks.main_text(f"<div class='{name}'>{text}</div>").count("Paragraph") == 3
    assert lineblocks.main_text(f"<form id=f><main>{text}</main></form>").count("Paragraph") == 3
    page = f"<article>{text}<figure><math><mi>x</mi></math><figcaption>Caption</figcaption></figure></article><div class='related'><article>Card</article></div><div id='cookie-banner'>Cookies</div>"
    got = lineblocks.main_text(page)
    assert "x" in got and "Caption" in got and "Card" not in got and "Cookies" not in got
