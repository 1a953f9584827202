"""Pairs at the wanted similarity whose first fingerprints share no block are found through the second family."""

import random

import pytest

from cytolattice.llm import graysim


def pair(seed):
    """Two texts of 49 words with one other word in the middle: 40 of 50 shingles in common."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(49)]
    return " ".join(words), " ".join([*words[:24], f"x{seed}", *words[25:]])


@pytest.mark.parametrize("count", [0, 40])
def test_links_without_a_common_block_are_not_lost(spark, count):
    # Of 120,000 such pairs these two share no block of the first family.
    texts = [t for seed in (47930, 54986, *range(count)) for t in pair(seed)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in graysim.drop_near_copies(docs).select("doc_id").collect()) == list(range(0, len(texts), 2))
