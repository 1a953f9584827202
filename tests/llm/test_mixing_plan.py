"""The slots of a mix grow with the corpus: they are shuffled and never broadcast through the driver."""

import re

from cytolattice.llm import mixing


def under_broadcasts(plan):
    """Lines of a plan that lie under a BroadcastExchange."""
    at, out = None, []
    for line in plan.splitlines():
        found = re.search(r"[A-Za-z]", line)
        depth = found.start() if found else 0
        if at is not None and depth <= at:
            at = None
        if at is not None:
            out.append(line)
        elif "BroadcastExchange" in line:
            at = depth
    return out


def test_slots_are_not_broadcast(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 90), f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    plan = mixing.mix(docs, keep=False)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and re.search(r"SortMergeJoin \[number#\d+, block#\d+", plan)
    assert under_broadcasts(plan) and not [line for line in under_broadcasts(plan) if "MapInPandas" in line]
