"""Exact grouped quantiles that never hold one group's values in one task.

A bounded-memory sketch brackets each wanted quantile.  A second pass counts, per group, the
rows below, between and above the brackets and the distinct values inside them; ranks then
follow from cumulative counts.  Only the thin bracket (about 2e-4 of a group) is ever ordered,
so a group holding a third of all rows stays cheap and the result is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import settle

SKETCH_ACCURACY = 20_000
BRACKET = 2.0 / SKETCH_ACCURACY


def _pick(rank: Column) -> Column:
    """Value at a zero-based rank, from rows that hold a run of ranks [lo, hi)."""
    inside = (F.col("_lo") <= rank) & (rank < F.col("_hi"))
    value = (F.when(F.col("_min") == F.col("_max"), F.col("_min"))
             .when(rank == F.col("_lo"), F.col("_min"))
             .when(rank == F.col("_hi") - 1, F.col("_max"))
             .otherwise(F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")))
    return F.max(F.when(inside, value))


def _interpolate(runs: DataFrame, keys: list[str], probs: list[float], names: list[str]) -> DataFrame:
    """``runs`` has keys, n (group size), _gap, _min, _max, _cnt; one run of ranks per row."""
    order = W.partitionBy(*keys).orderBy(F.col("_gap"), F.col("_min"), F.col("_max"))
    runs = (runs.withColumn("_hi", F.sum("_cnt").over(order.rowsBetween(W.unboundedPreceding, 0)))
            .withColumn("_lo", F.col("_hi") - F.col("_cnt")))
    picks, out = [], []
    for i, (p, name) in enumerate(zip(probs, names)):
        h = (F.col("n") - 1) * F.lit(float(p))
        picks += [_pick(F.floor(h)).alias(f"_a{i}"), _pick(F.ceil(h)).alias(f"_b{i}")]
        out.append((F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (h - F.floor(h))).alias(name))
    grouped = runs.groupBy(*keys, "n").agg(*picks)
    return grouped.select(*keys, "n", *out)


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                      names: list[str] | None = None) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` per ``keys``; NULL values are ignored."""
    if not keys:
        whole = df.withColumn("_all", F.lit(1))
        return grouped_quantiles(whole, ["_all"], value, probs, names).drop("_all")
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    probs = [probs[i] for i in order]
    names = [(names or [f"q{i}" for i in range(len(probs))])[i] for i in order]
    v = F.col(value).cast("double")
    data = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    ps = [min(max(p + s, 0.0), 1.0) for p in probs for s in (-BRACKET, BRACKET)]
    sketch = data.groupBy(*keys).agg(
        F.count("_v").alias("n"),
        F.percentile_approx("_v", [float(p) for p in ps], SKETCH_ACCURACY).alias("_q"))
    sketch = sketch.select(*keys, "n", *[F.col("_q")[i].alias(f"_p{i}") for i in range(len(ps))])
    small = settle(sketch)
    joined = data.join(small, keys)
    pairs = [(F.col(f"_p{2 * i}"), F.col(f"_p{2 * i + 1}")) for i in range(len(probs))]
    inside = reduce(lambda a, b: a | b, [(F.col("_v") >= lo) & (F.col("_v") <= hi) for lo, hi in pairs])
    gap = reduce(lambda a, b: a + b, [(F.col("_v") > hi).cast("int") for _, hi in pairs])
    runs = (joined.withColumn("_gap", 2 * gap + F.when(inside, 1).otherwise(0))
            .withColumn("_bin", F.when(inside, F.col("_v")))
            .groupBy(*keys, "n", "_gap", "_bin")
            .agg(F.count("*").alias("_cnt"), F.min("_v").alias("_min"), F.max("_v").alias("_max")))
    return _interpolate(runs, keys, probs, names)


def histogram_quantiles(counts: DataFrame, keys: list[str], value: str, weight: str,
                        probs: list[float], names: list[str]) -> DataFrame:
    """The same quantiles from (value, weight) rows, for values with a bounded domain."""
    total = counts.groupBy(*keys).agg(F.sum(weight).alias("n"))
    v = F.col(value).cast("double")
    runs = counts.groupBy(*keys, v.alias("_min")).agg(F.sum(weight).alias("_cnt"))
    runs = (runs.join(settle(total), keys)
            .withColumn("_max", F.col("_min")).withColumn("_gap", F.lit(0)))
    return _interpolate(runs, keys, probs, names)


def grouped_mad(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """n, median and raw MAD (median of absolute deviations) per group."""
    med = settle(grouped_quantiles(df, keys, value, [0.5], ["median"]))
    dev = (df.where(F.col(value).isNotNull()).join(med.drop("n"), keys)
           .select(*keys, F.abs(F.col(value) - F.col("median")).alias("_dev")))
    mad = grouped_quantiles(dev, keys, "_dev", [0.5], ["mad"])
    return med.join(mad.drop("n"), keys)


def sums_before(rows: DataFrame, keys: list[str], order: list[str], amount: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over the rows of the same keys that come before in ``order``.

    Rows are cut into as many ranges of (keys, order) as the session has shuffle partitions; a range is ordered by
    itself and starts at the total of the ranges before it, so a group of any size is spread over tasks.  Rows must
    differ in (keys, order) and keys must not be null.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(rows.repartitionByRange(ranges, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(*keys, "_range").agg(F.sum(amount).alias("_total"))
    earlier = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    starts = settle(totals.select(*keys, "_range", F.coalesce(
        F.sum("_total").over(earlier(W.partitionBy(*keys).orderBy("_range"))), F.lit(0)).alias("_start")), "starts")
    own = F.coalesce(F.sum(amount).over(earlier(W.partitionBy(*keys, "_range").orderBy(*order))), F.lit(0))
    return ranged.join(starts, [*keys, "_range"]).withColumn(name, F.col("_start") + own).drop("_range", "_start")


def ranked_values(df: DataFrame, keys: list[str], value: str, wanted: DataFrame) -> DataFrame:
    """Quantile per key where each key asks for its own probability (``wanted``: keys, prob).

    An equi-depth ladder from one sketch gives the rung pair around the wanted rank; only values
    between the two rungs are counted by value, and ranked range by range.
    """
    rungs = 512
    v = F.col(value).cast("double")
    data = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    ladder = data.groupBy(*keys).agg(
        F.count("_v").alias("n"),
        F.percentile_approx("_v", [i / rungs for i in range(rungs + 1)], SKETCH_ACCURACY).alias("_q"))
    lo = F.greatest(F.floor((F.col("prob") - BRACKET) * rungs), F.lit(0)).cast("int")
    hi = F.least(F.ceil((F.col("prob") + BRACKET) * rungs), F.lit(rungs)).cast("int")
    bounds = settle(ladder.join(wanted, keys).select(
        *keys, "n", "prob", F.get("_q", lo).alias("_p0"), F.get("_q", hi).alias("_p1")))
    inside = (F.col("_v") >= F.col("_p0")) & (F.col("_v") <= F.col("_p1"))
    gap = 2 * (F.col("_v") > F.col("_p1")).cast("int") + F.when(inside, 1).otherwise(0)
    runs = (data.join(bounds, keys).withColumn("_gap", gap).withColumn("_bin", F.when(inside, F.col("_v")))
            .groupBy(*keys, "n", "prob", "_gap", "_bin")
            .agg(F.count("*").alias("_cnt"), F.min("_v").alias("_min"), F.max("_v").alias("_max")))
    runs = sums_before(runs, keys, ["_gap", "_min", "_max"], "_cnt", "_lo").withColumn("_hi", F.col("_lo") + F.col("_cnt"))
    h = (F.col("n") - 1) * F.col("prob")
    out = runs.groupBy(*keys, "n", "prob").agg(_pick(F.floor(h)).alias("_a"), _pick(F.ceil(h)).alias("_b"))
    return out.select(*keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * (h - F.floor(h))).alias("cut"))
