"""Runs of the mixed corpus are cut without Python workers, which added up beyond an executor's memory."""

import random
import re
from collections import Counter

from cytolattice.llm import mixing


def runs_of(row):
    cuts = []
    for p in row.parts:
        if cuts and cuts[-1][0] == p.use and cuts[-1][2] == p.first:
            cuts[-1][2] = p.end
        else:
            cuts.append([p.use, p.first, p.end])
    spans = [m.span() for m in re.finditer("[^\x20\x09-\x0d]+", row.text)]
    return [row.text if (a, b) == (0, row.size) else row.text[spans[a][0]:spans[b - 1][1]] for _, a, b in cuts]


def test_runs_are_cut_at_words_in_one_pass_of_python(spark):
    rng = random.Random(3)
    words = lambda n: "".join(rng.choice("aé\U0001f600 b") * rng.randint(1, 3) + rng.choice((" ", "\n\n", "\t \x0b", "\r\n\x0c")) for _ in range(n))
    rows = [(i, rng.choice(("", " \n")) + words(rng.randint(0, 90)), "en", f"s{i % 3}", 0) for i in range(60)] + [(60, None, "en", "s0", 0), (61, words(2000), "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.mixed_documents(docs, block_words=16)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and plan.count("MapInPandas") >= 1
    got = Counter((r.doc_id, r.text, r.n_chars) for r in mixed.collect())
    want = [(r.doc_id, t, len(t)) for r in mixing.mix(docs, block_words=16).where("taken > 0").collect() for t in runs_of(r)]
    assert got == Counter(want) and len(want) > 100
