"""Co-labelling against chance: analytic, shuffled, anchor, local, rotated and fitted baselines.

Cells carry boolean ``tagged`` and ``activity``.  Draws are modular arithmetic on ids, so they do
not depend on partitioning and can be repeated in SQL.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..config import Panel
from ..functions import above_chance, count_where, dbl, finite, ratio
from ..session import settle, settle_alone
from . import logit, markers
from .draws import SCRAMBLE as PRIME, STEP, scramble as mix
from .gridsearch import inside, summaries
from .quantiles import grouped_quantiles

HALF, LOW = 1 << 32, 1 << 12
TURNS = 4


def with_draw(rows: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Rows with a keyed permutation of their 64-bit ids: halves ``_hi`` and ``_lo`` of 32 bits, and ``_d``, the first 52 bits as a double.

    A Feistel network is one to one whatever its round function, so distinct ids never get equal halves.
    """
    v = F.col(id_col).cast("long")
    rows = rows.withColumn("_hi", F.shiftrightunsigned(v, 32)).withColumn("_lo", v.bitwiseAND(F.lit(HALF - 1)))
    for turn in range(TURNS):
        y = (F.col("_lo") % PRIME * F.lit(STEP).cast("long") + F.lit(1_000_003 * (TURNS * seed + turn + 1)).cast("long")) % PRIME
        rows = (rows.withColumn("_y", y).withColumn("_new", F.col("_hi").bitwiseXOR((F.col("_y") * F.col("_y")) % PRIME))
                .withColumn("_hi", F.col("_lo")).withColumn("_lo", F.col("_new")))
    return rows.withColumn("_d", (F.col("_hi") * LOW * 256 + F.floor(F.col("_lo") / LOW)).cast("double")).drop("_y", "_new")


def flag(c: str) -> Column:
    return F.col(c).cast("int")


def chance_counts(cells: DataFrame, keys: list[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(
        F.count("*").alias("n"), count_where(F.col("tagged")).alias("tagged_n"),
        count_where(F.col("activity")).alias("activity_n"),
        count_where(F.col("tagged") & F.col("activity")).alias("double_n"))


def above_chance_by(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(D*N)/(T*A) per key; NULL on an empty marginal."""
    c = chance_counts(cells, keys)
    return c.withColumn("above_chance", above_chance("n", "tagged_n", "activity_n", "double_n"))


def naive_ratio(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Mean activity in tagged cells over mean activity."""
    c = chance_counts(cells, keys)
    return c.select(*keys, ratio(ratio("double_n", "tagged_n"), ratio("activity_n", "n")).alias("naive"))


def quantile_cut(cells: DataFrame, keys: list[str], value: str, prevalence: DataFrame) -> DataFrame:
    """Value at quantile 1 - prevalence per key, prevalence differing per key.

    The rank sought differs per key, so the keys' prevalences are bracketed by one sketch per key
    and resolved by counting, like every other quantile here.
    """
    from .quantiles import ranked_values
    return ranked_values(cells, keys, value, prevalence)


def anchor_floor(cells: DataFrame, keys: list[str], minimum: int = 200) -> DataFrame:
    """The naive ratio for an anchor pseudo-marker of the tagged set's prevalence."""
    base = cells.groupBy(*keys).agg(
        F.avg(flag("tagged")).alias("_p"), F.avg(flag("activity")).alias("_base"),
        F.count(F.when(finite("anchor_mean"), 1)).alias("_ok"))
    base = settle(base)
    want = base.where((F.col("_p") > 0) & (F.col("_p") < 1)).select(*keys, (1 - F.col("_p")).alias("prob"))
    cut = settle(quantile_cut(cells, keys, "anchor_mean", want))
    hit = (cells.join(cut, keys).where(dbl("anchor_mean") > F.col("cut"))
           .groupBy(*keys).agg(F.avg(flag("activity")).alias("_hit")))
    out = base.join(hit, keys, "left").join(cut, keys, "left")
    return out.select(*keys, "cut", F.when(F.col("_ok") >= minimum, ratio("_hit", "_base")).alias("anchor_floor"))


# ---- shuffled labels ------------------------------------------------------------------------

def _share(t, n) -> Column:
    """Probability whose rank lies half-way between the t-th and the next value."""
    return F.least((dbl(t) - 0.5) / F.greatest(dbl(n) - 1, F.lit(1.0)), F.lit(1.0))


def shuffled_control(cells: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """Above-chance after permuting the tagged labels.

    A permutation makes the tagged set a random subset of its size: the T cells with the lowest
    draws.  The T-th draw is found as a quantile of the draws' first 52 bits, so nothing is sorted globally; the few cells that
    share those bits with it are put in order by the rest, then by id.
    """
    c = settle(chance_counts(cells, keys), "counts")
    rows = with_draw(cells.select(*keys, "cell_id", "activity"), "cell_id", seed)
    want = c.where((F.col("tagged_n") > 0) & (F.col("activity_n") > 0)).select(*keys, _share("tagged_n", "n").alias("prob"))
    cut = settle(quantile_cut(rows, keys, "_d", want), "draws")
    drawn = rows.join(cut, keys)
    low = F.col("_d") < F.col("cut")
    hit = settle(drawn.groupBy(*keys).agg(count_where(low).alias("_below"), count_where(low & F.col("activity")).alias("_hit")), "below")
    tied = drawn.where(F.col("_d") == F.col("cut")).withColumn(
        "_no", F.row_number().over(W.partitionBy(*keys).orderBy("_hi", "_lo", "cell_id", "activity")))
    more = (tied.join(hit, keys).join(c.select(*keys, "tagged_n"), keys).where(F.col("_no") <= F.col("tagged_n") - F.col("_below"))
            .groupBy(*keys).agg(count_where(F.col("activity")).alias("_more")))
    out = c.join(hit, keys, "left").join(more, keys, "left")
    return out.select(*keys, "n", "tagged_n", "activity_n", above_chance(
        "n", "tagged_n", "activity_n", F.col("_hit") + F.coalesce("_more", F.lit(0))).alias("shuffled"))


# ---- k against chance -------------------------------------------------------------------------

K_LADDER = (1.5, 2.0, 2.5, 3.0, 4.0, 5.0, 7.0, 10.0)


def k_vs_chance(cells: DataFrame, panel: Panel, ks: tuple[float, ...] = K_LADDER, strict: bool = True,
                seed: int = 0) -> DataFrame:
    """Pooled sweep: counts, above-chance, shuffled control and anchor floor at each k.

    Cuts come from the pooled values; positivity is strict by default.  A handful of per-k
    numbers (cuts and counts) travels through the driver, never rows.
    """
    roles = panel.roles()
    t, a = f"{roles.tagged}_bgsub", f"{roles.activity}_bgsub"
    rows = cells.where(finite(t) & finite(a)).withColumn("_all", F.lit("all")).withColumn("excluded", F.lit(False))
    stats = {r.marker: r for r in markers.robust_threshold(rows, panel, 0.0, ("_all",)).collect()}
    rows = with_draw(rows, "cell_id", seed)

    def above(col_name, marker, k):
        cut = F.lit(stats[marker]["median"]) + F.lit(float(k)) * F.lit(stats[marker]["robust_sd"])
        return dbl(col_name) > cut if strict else dbl(col_name) >= cut

    pos = {k: (above(t, roles.tagged, k), above(a, roles.activity, k)) for k in ks}
    first = rows.agg(F.count("*").alias("n"), F.count(F.when(finite("anchor_mean"), 1)).alias("ok"),
                     *[count_where(pos[k][0]).alias(f"t{i}") for i, k in enumerate(ks)]).first()
    live = [i for i, _ in enumerate(ks) if 0 < first[f"t{i}"] < first["n"]]
    n = first["n"]
    floor_cut, draw_cut, last = {}, {}, {}
    if live:
        got = grouped_quantiles(rows.where(finite("anchor_mean")), [], "anchor_mean",
                                [1 - first[f"t{i}"] / n for i in live], [f"c{i}" for i in live]).first()
        floor_cut = {i: got[f"c{i}"] for i in live} if first["ok"] >= 200 else {}
        got = grouped_quantiles(rows, [], "_d", [min((first[f"t{i}"] - 0.5) / max(n - 1, 1), 1.0) for i in live],
                                [f"c{i}" for i in live]).first()
        draw_cut = {i: got[f"c{i}"] for i in live}
        # A cut that is itself a draw is shared by several cells: they are put in order by the draws' last bits.
        same = rows.where(F.col("_d").isin([float(v) for v in draw_cut.values()])).select("_d", "_hi", "_lo").collect()
        below = rows.agg(*[count_where(F.col("_d") < F.lit(v)).alias(f"b{i}") for i, v in draw_cut.items()]).first() if same else {}
        last = {i: sorted((r["_hi"], r["_lo"]) for r in same if r["_d"] == v)[:first[f"t{i}"] - below[f"b{i}"]][-1:]
                for i, v in draw_cut.items() if same}
    aggs = [F.count("*").alias("n")]
    false = F.lit(False)
    for i, k in enumerate(ks):
        tp, ap = pos[k]
        pseudo = finite("anchor_mean") & (dbl("anchor_mean") > F.lit(floor_cut[i])) if i in floor_cut else false
        drawn = F.col("_d") < F.lit(draw_cut[i]) if i in draw_cut else (F.lit(True) if first[f"t{i}"] == n else false)
        for hi, lo in last.get(i, []):
            drawn = drawn | ((F.col("_d") == F.lit(draw_cut[i])) & (F.struct("_hi", "_lo") <= F.struct(F.lit(hi).alias("_hi"), F.lit(lo).alias("_lo"))))
        aggs += [count_where(tp).alias(f"t{i}"), count_where(ap).alias(f"a{i}"), count_where(tp & ap).alias(f"d{i}"),
                 count_where(drawn & ap).alias(f"s{i}"), count_where(pseudo).alias(f"p{i}"), count_where(pseudo & ap).alias(f"q{i}")]
    items = F.array(*[F.struct(
        F.lit(float(k)).alias("k"), F.col(f"t{i}").alias("tagged_n"), F.col(f"a{i}").alias("activity_n"),
        F.col(f"d{i}").alias("double_n"), above_chance("n", f"t{i}", f"a{i}", f"s{i}").alias("shuffled"),
        above_chance("n", f"p{i}", f"a{i}", f"q{i}").alias("anchor_floor")) for i, k in enumerate(ks)])
    out = rows.agg(*aggs).select("n", F.inline(items))
    ac = above_chance("n", "tagged_n", "activity_n", "double_n")
    return out.select("k", "n", "tagged_n", "activity_n", "double_n",
                      (100.0 * ratio("tagged_n", "n")).alias("tagged_pct"), (100.0 * ratio("activity_n", "n")).alias("activity_pct"),
                      (100.0 * ratio("double_n", "tagged_n")).alias("reactivation_pct"), ac.alias("above_chance"),
                      "shuffled", "anchor_floor", ratio(ac, "anchor_floor").alias("real_over_floor"))


def k_vs_chance_verdict(sweep: DataFrame) -> DataFrame:
    """STOP / FALLS / RISES / FLAT from the first and last k, and whether the floor rises too."""
    ok = sweep.where(F.col("above_chance").isNotNull())
    s = ok.agg(F.count("*").alias("points"), F.min_by("above_chance", "k").alias("lo"), F.max_by("above_chance", "k").alias("hi"),
               F.max(F.abs(F.col("shuffled") - 1.0)).alias("off"), F.min_by("anchor_floor", "k").alias("floor_lo"),
               F.max_by("anchor_floor", "k").alias("floor_hi"))
    text = (F.when(F.col("points") < 2, "too few points").when(F.col("off") > 0.15, "STOP")
            .when(F.col("hi") < F.col("lo") * 0.8, "FALLS").when(F.col("hi") > F.col("lo") * 1.2, "RISES").otherwise("FLAT"))
    return s.select("points", "lo", "hi", text.alias("verdict"),
                    F.coalesce(F.col("floor_hi") > F.col("floor_lo") * 1.2, F.lit(False)).alias("floor_rises"))


# ---- local baseline -------------------------------------------------------------------------------

def region_members(cells: DataFrame, members: DataFrame | None, minimum: int = 500) -> DataFrame:
    """Cells with the ``region`` they serve.

    With ``members`` (region, acronym) a region takes the cells of all its members; without, each
    acronym of at least ``minimum`` cells stands for itself.
    """
    if members is not None:
        return cells.join(settle(members, "members"), "acronym")
    big = settle(cells.groupBy("acronym").agg(F.count("*").alias("_n")).where(F.col("_n") >= minimum).select("acronym"))
    return cells.join(big, "acronym").withColumn("region", F.col("acronym"))


def local_sections(rows: DataFrame, k: int, cap: int | None = None, written: bool = False) -> DataFrame:
    """Per region and section: tagged n, observed and local activity; unusable sections drop out.  ``written``: rows come from a written table."""
    from .neighbours import knn_unlabelled
    rows = rows.select("region", "section", "cell_id", "x", "y", "tagged", "activity")
    rows = rows if written else settle(rows, "region-cells")
    keyed = rows.withColumn("section", F.concat_ws("\u0001", "region", "section"))
    near = knn_unlabelled(keyed, k, cap).where(F.col("local_rate").isNotNull())
    part = F.split(F.col("section"), "\u0001")
    loc = near.groupBy(part[0].alias("region"), part[1].alias("section")).agg(F.avg("local_rate").alias("local_rate"))
    obs = rows.where("tagged").groupBy("region", "section").agg(F.count("*").alias("tagged_n"), F.avg(flag("activity")).alias("observed"))
    return settle(obs.join(loc, ["region", "section"]), "local-sections")


def local_chance(sections: DataFrame) -> DataFrame:
    """Sections pooled by tagged cells: observed, local chance and their ratio per region."""
    n = F.sum("tagged_n")
    return sections.groupBy("region").agg(
        F.count("*").alias("n_sections"), n.cast("long").alias("tagged_n"),
        (F.sum(F.col("observed") * F.col("tagged_n")) / n).alias("observed"),
        (F.sum(F.col("local_rate") * F.col("tagged_n")) / n).alias("local_chance"),
        ratio(F.sum(F.col("observed") * F.col("tagged_n")), F.sum(F.col("local_rate") * F.col("tagged_n"))).alias("above_chance_local"))


def local_chance_order(table: DataFrame) -> DataFrame:
    return table.orderBy(F.col("above_chance_local").desc_nulls_last(), "region")


def bootstrap_sections(sections: DataFrame, n_boot: int = 1000, seed: int = 0, minimum: int = 3) -> DataFrame:
    """2.5 / 97.5 percentiles of the ratio over resampled sections, per region.

    Each replicate draws as many sections as the region has; replicates are generated rows over
    the small section table.
    """
    w = W.partitionBy("region")
    ranked = sections.withColumn("_i", F.row_number().over(w.orderBy("section")) - 1).withColumn("_s", F.count("*").over(w))
    ranked = ranked.where(F.col("_s") >= minimum)
    slots = ranked.select("region", "_s", F.col("_i").alias("_slot"),
                          F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("_b"))
    base = mix(((F.col("_b") + 1).cast("long") * 1_000_003 + F.col("_slot") * 7919 + seed) % PRIME)
    picks = slots.select("region", "_b", (base % F.col("_s")).cast("int").alias("_i"))
    j = picks.join(ranked.select("region", "_i", "tagged_n", "observed", "local_rate"), ["region", "_i"])
    reps = j.groupBy("region", "_b").agg(ratio(F.sum(F.col("observed") * F.col("tagged_n")),
                                               F.sum(F.col("local_rate") * F.col("tagged_n"))).alias("r"))
    q = reps.where(F.col("r").isNotNull()).groupBy("region").agg(F.percentile("r", F.array(F.lit(0.025), F.lit(0.975))).alias("q"))
    return q.select("region", F.col("q")[0].alias("ci_lo"), F.col("q")[1].alias("ci_hi"), F.lit("section-level").alias("ci_scheme"))


@F.pandas_udf(T.StructType([T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType())]))
def _binomial_interval(n: pd.Series, p: pd.Series) -> pd.DataFrame:
    """2.5 / 97.5 percent points of a binomial share: what resampling 0/1 cells converges to."""
    lo, hi = [], []
    for size, share in zip(n, p):
        if not size or share is None or math.isnan(share):
            lo.append(None), hi.append(None)
            continue
        if share <= 0 or share >= 1:
            lo.append(float(share)), hi.append(float(share))
            continue
        size = int(size)
        sd = math.sqrt(size * share * (1 - share))
        a, b = max(0, int(size * share - 9 * sd - 9)), min(size, int(size * share + 9 * sd + 9))
        k = np.arange(a, b + 1, dtype=float)
        step = np.log((size - k[:-1]) / (k[:-1] + 1)) + math.log(share / (1 - share))
        logs = np.concatenate([[0.0], np.cumsum(step)])
        pmf = np.exp(logs - logs.max())
        cdf = np.cumsum(pmf / pmf.sum())
        lo.append(float(k[np.searchsorted(cdf, 0.025)]) / size)
        hi.append(float(k[min(np.searchsorted(cdf, 0.975), len(k) - 1)]) / size)
    return pd.DataFrame({"lo": lo, "hi": hi})


def bootstrap_cells(table: DataFrame, baseline: str = "local_chance") -> DataFrame:
    """Within-section interval: tagged cells resampled, divided by the baseline.

    Resampling n 0/1 cells is a binomial draw on (n, p), so its percentiles are computed, not drawn.
    """
    q = _binomial_interval(dbl("tagged_n"), dbl("observed"))
    out = table.withColumn("_q", q)
    return out.select("region", "tagged_n", "observed", baseline, ratio("_q.lo", baseline).alias("ci_lo"),
                      ratio("_q.hi", baseline).alias("ci_hi"), F.lit("cell-level: within-section precision only").alias("ci_scheme"))


def local_table(rows: DataFrame, k: int, n_boot: int = 1000, seed: int = 0, minimum: int = 3, cap: int | None = None, written: bool = False) -> DataFrame:
    """The local read-out of every region in ``rows``, with an interval and the scheme it comes from.

    Sections are resampled where at least ``minimum`` are usable, tagged cells where there are fewer, and the scheme says so.
    A region without a usable section keeps its row: no sections, no tagged cells, NULL values and the scheme ``n/a``.
    """
    sections = local_sections(rows, k, cap, written)
    table = settle(rows.select("region").distinct().join(local_chance(sections), "region", "left"), "local")
    table = table.withColumn("n_sections", F.coalesce("n_sections", F.lit(0))).withColumn("tagged_n", F.coalesce("tagged_n", F.lit(0)))
    wide = bootstrap_sections(sections, n_boot, seed, minimum).select("region", F.col("ci_lo").alias("_lo"), F.col("ci_hi").alias("_hi"))
    out = table.join(wide, "region", "left").withColumn("_q", _binomial_interval(dbl("tagged_n"), dbl("observed")))
    many = F.col("n_sections") >= minimum
    few = F.concat(F.lit("cell-level ("), F.col("n_sections"), F.lit(" section(s) -- WITHIN-section precision only)"))
    scheme = F.when(many, "section-level").when(F.col("tagged_n") > 0, few).otherwise("n/a")
    bound = lambda side: F.when(many, F.col(f"_{side}")).otherwise(ratio(f"_q.{side}", "local_chance"))
    return out.select(*table.columns, bound("lo").alias("ci_lo"), bound("hi").alias("ci_hi"), scheme.alias("ci_scheme"))


# ---- rotation ---------------------------------------------------------------------------------------

RINGS = 64                # rings across a section's side, by distance from its centroid
TURN_CAP = 65_536         # points of a leaf that turned cells visit: a cell is turned once in every leaf that its ring crosses
TURN_CHUNK = 4096         # tagged cells turned in one task group
TURN_RIM = 0.25           # turned cells also land outside their section, where circles are wide


def _turned(leaves: DataFrame, mid: DataFrame, tagged: DataFrame, n_rot: int, seed: int, near: int) -> tuple[DataFrame, DataFrame]:
    """(tagged cells per leaf that some turn may bring them to, what each leaf has to know).

    A turn keeps the distance from the centroid, so a leaf needs the cells of the rings that its box crosses; boxes at the section's
    end reach to infinity.
    """
    # Sections turn independently: the draw starts from the section's name.
    own = F.conv(F.substring(F.md5("section"), 1, 7), 16, 10).cast("long")
    angle = lambda rot: 2 * F.pi() * mix(((rot + 1).cast("long") * 1_000_003 + own + seed) % PRIME) / F.lit(float(PRIME))
    turns = F.sequence(F.lit(0), F.lit(n_rot - 1))
    wide = F.col("_side") / F.pow(F.lit(2.0), F.col("level"))
    last = F.pow(F.lit(2.0), F.col("level")) - 1
    ends, near_, far = {}, {}, {}
    for c in "xy":
        lo, hi = F.col(f"_{c}0") + F.col(f"c{c}") * wide, F.col(f"_{c}0") + (F.col(f"c{c}") + 1) * wide
        ends[c] = (F.when(F.col(f"c{c}") == 0, float("-inf")).otherwise(lo), F.when(F.col(f"c{c}") == last, float("inf")).otherwise(hi))
        near_[c] = F.greatest(ends[c][0] - F.col(f"_c{c}"), F.col(f"_c{c}") - ends[c][1], F.lit(0.0))
        far[c] = F.greatest(F.abs(F.col(f"_c{c}") - ends[c][0]), F.abs(ends[c][1] - F.col(f"_c{c}")))
    ring, sliver = F.col("_side") / RINGS, 1e-9
    # No cell is farther from the centroid than twice the section's side.
    inner = F.floor((F.hypot(near_["x"], near_["y"]) * (1 - sliver) - sliver * F.col("_side")) / ring)
    outer = F.floor((F.least(F.hypot(far["x"], far["y"]), 2 * F.col("_side")) * (1 + sliver) + sliver * F.col("_side")) / ring)
    known = leaves.join(mid, "section")
    rings = known.select("_id", "section", F.explode(F.sequence(inner.cast("long"), outer.cast("long"))).alias("_ring"))
    heads = known.select("_id", F.concat("_see", F.array(*[F.col(c).cast("double") for c in ("level", "cx", "cy", "_x0", "_y0", "_side", "_cx", "_cy")], F.least(F.lit(near), F.col("_n") - 1).cast("double")),
                                         F.transform(turns, lambda r: F.cos(angle(r))), F.transform(turns, lambda r: F.sin(angle(r)))).alias("head"))
    dx, dy = F.col("x") - F.col("_cx"), F.col("y") - F.col("_cy")
    cells = (tagged.join(mid, "section").join(leaves.select("section", "_side").distinct(), "section")
             .select("section", "cell_id", dx.alias("dx"), dy.alias("dy"), F.floor(F.hypot(dx, dy) / ring).alias("_ring")))
    return cells.join(rings, ["section", "_ring"]).select("_id", "cell_id", "dx", "dy"), settle(heads, "heads")


def _turn(head: np.ndarray, cells: pd.DataFrame, points: pd.DataFrame, n_rot: int) -> pd.DataFrame:
    """Sums per turn over the turned cells that land in a leaf, and by themselves those whose circle leaves what it sees."""
    level, cx, cy, x0, y0, side, mx, my, m = head[8:17]
    cos, sin = head[17:17 + n_rot], head[17 + n_rot:]
    dx, dy, ids = (cells[c].to_numpy() for c in ("dx", "dy", "cell_id"))
    n, m = 2 ** int(level), int(m)
    rots, whos, xs, ys = [], [], [], []
    at = lambda v, origin: np.clip(np.floor((v - origin) / side * n), 0, n - 1)
    # The leaf's box with a sliver of slack, open where the section ends; what it holds is then put to the leaf's own rule.
    ends = [(-np.inf if c == 0 else o + (c / n - 1e-9) * side, np.inf if c == n - 1 else o + ((c + 1) / n + 1e-9) * side) for c, o in ((cx, x0), (cy, y0))]
    for rot in range(n_rot):
        x, y = mx + dx * cos[rot] - dy * sin[rot], my + dx * sin[rot] + dy * cos[rot]
        who = np.flatnonzero((x >= ends[0][0]) & (x <= ends[0][1]) & (y >= ends[1][0]) & (y <= ends[1][1]))
        rots.append(np.full(len(who), rot)), whos.append(who), xs.append(x[who]), ys.append(y[who])
    rot, who, x, y = (np.concatenate(v) for v in (rots, whos, xs, ys))
    own = (at(x, x0) == cx) & (at(y, y0) == cy)
    rot, who, x, y = rot[own], who[own], x[own], y[own]
    found, d2, _, total = summaries(x, y, *[points[c].to_numpy() for c in ("x", "y", "w")], m, distances=False)
    shut = inside(x, y, d2, head[:4], head[4:8])
    n_shut = np.bincount(rot[shut], minlength=n_rot)
    some, far = np.flatnonzero(n_shut), np.flatnonzero(~shut)
    whole = pd.DataFrame({"rot": some, "cell_id": pd.array([None] * len(some), dtype="Int64"), "x": np.nan, "y": np.nan,
                          "act": np.bincount(rot[shut], weights=total[shut], minlength=n_rot)[some] / m, "n": n_shut[some]})
    rest = pd.DataFrame({"rot": rot[far], "cell_id": pd.array(ids[who[far]], dtype="Int64"), "x": x[far], "y": y[far], "act": 0.0, "n": 0})
    out = pd.concat([f for f in (whole, rest) if len(f)], ignore_index=True) if len(whole) or len(rest) else whole
    out.insert(0, "_id", cells["_id"].iloc[0])
    return out


def rotation_null(cells: DataFrame, n_rot: int = 200, near: int = 25, seed: int = 0, cap: int | None = None, written: bool = False) -> DataFrame:
    """Tagged points rotated about their section's centroid; activity of the nearest cells there.

    Cells carry ``region``.  One angle per section and rotation.  A section needs ten cells.  Rates equal up to
    rounding (1e-12) count as equal.  Cells are turned inside the tasks that hold the points they may land among, and only sums per
    turn are written.  ``written``: cells come from a written table.
    """
    from .neighbours import knn_join, limited, visits, wide_leaves
    rows = cells.select("region", F.concat_ws("\u0001", "region", "section").alias("section"), "cell_id", dbl("x").alias("x"),
                        dbl("y").alias("y"), "tagged", "activity")
    rows = rows if written else settle(rows, "rotate")
    mid = rows.groupBy("region", "section").agg(F.avg("x").alias("_cx"), F.avg("y").alias("_cy"), F.count("*").alias("_n"),
                                                 count_where(F.col("tagged")).alias("_t"))
    mid = settle(mid.where((F.col("_n") >= 10) & (F.col("_t") > 0)))
    pool = limited(rows.join(mid.select("section"), "section", "left_semi").select(
        "section", F.col("cell_id").alias("pid"), "x", "y", F.col("activity").cast("double").alias("w")), near)
    extent, leaves, levels, seen = wide_leaves(pool, max(cap or TURN_CAP, 2 * near), TURN_RIM)
    tagged = rows.where("tagged").select("section", F.col("cell_id").cast("long").alias("cell_id"), "x", "y")
    q, heads = _turned(leaves, mid.drop("region"), tagged, n_rot, seed, near)
    out = visits(settle(q, "rings"), seen, heads, TURN_CHUNK, ["cell_id"], lambda head, left, right: _turn(head, left, right, n_rot),
                 "_id long, rot int, cell_id long, x double, y double, act double, n long", spread_all=True)
    out = settle(out, "turned").join(leaves.select("_id", "section"), "_id").join(mid.select("section", "region", "_n"), "section")
    sums = out.where("cell_id IS NULL").select("region", "rot", "act", "n")
    # Query ids carry the rotation so that one search serves all rotations.
    far = out.where("cell_id IS NOT NULL").select("section", F.concat_ws("/", "rot", "cell_id").alias("qid"), "x", "y")
    if not far.isEmpty():
        nn = knn_join(far, pool, near, cap).join(mid.select("section", "region", "_n"), "section")
        m = F.least(F.lit(near), F.col("_n") - 1).cast("int")
        act = F.aggregate(F.slice("nn", F.lit(1), m), F.lit(0.0), lambda s, e: s + e["w"]) / m
        sums = sums.unionByName(nn.select("region", F.substring_index("qid", "/", 1).cast("int").alias("rot"), act.alias("act"), F.lit(1).cast("long").alias("n")))
    null = sums.groupBy("region", "rot").agg((F.sum("act") / F.sum("n")).alias("null_rate"))
    obs = rows.where("tagged").groupBy("region").agg(F.avg(flag("activity")).alias("observed"))
    out = null.join(obs, "region").groupBy("region", "observed").agg(
        F.avg("null_rate").alias("null_mean"), count_where(F.col("null_rate") >= F.col("observed") - 1e-12).alias("_ge"), F.count("*").alias("_r"))
    return out.select("region", "observed", "null_mean", ratio("observed", "null_mean").alias("ratio"),
                      ((F.col("_ge") + 1) / (F.col("_r") + 1)).alias("p"))


# ---- fitted expectation -----------------------------------------------------------------------------------

COVARIATES = ("x1", "x2", "x3")
WHOLE = "__ALL__"           # the region of all cells
COMPARED = ("region", "section", "cell_id", "x", "y", "tagged", "activity", "anchor_mean", *COVARIATES)      # columns that chance_compare reads


def covariates(cells: DataFrame, tagged_measure: str) -> DataFrame:
    """log1p of tagged intensity, local density and nucleus area (negatives clipped to zero)."""
    clip = lambda c: F.log1p(F.greatest(dbl(c), F.lit(0.0)))
    return (cells.where(finite(tagged_measure) & finite("nucleus_area_um2"))
            .withColumn("x1", clip(tagged_measure)).withColumn("x2", F.log1p(dbl("local_density")))
            .withColumn("x3", clip("nucleus_area_um2")))


def with_whole_project(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Region rows and, as region ``WHOLE``, every cell once."""
    return rows.unionByName(cells.withColumn("region", F.lit(WHOLE)).select(*rows.columns))


def fitted_expectation(rows: DataFrame, minimum: int = 200, written: bool = False) -> DataFrame:
    """Observed against fitted activity of tagged cells; the model sees only not-tagged cells.

    ``rows``: region, tagged, activity, x1..x3 (see ``covariates``).  A region without tagged cells or with fewer than ``minimum`` others
    keeps its row with NULL values; ``converged`` tells whether its fit came to rest.  ``written``: rows come from a written table.
    """
    rows = rows.select("region", "tagged", "activity", *COVARIATES)
    rows = rows if written else settle(rows, "covariates")
    size = settle(rows.groupBy("region").agg(count_where(~F.col("tagged")).alias("_neg"), count_where(F.col("tagged")).alias("n_tagged")), "sizes")
    usable = size.where((F.col("_neg") >= minimum) & (F.col("n_tagged") > 0)).select("region")
    scale, model = logit.fit_logistic(rows.where("NOT tagged").join(usable, "region", "left_semi"), "region", "activity", COVARIATES)
    pos = logit.predict(rows.where("tagged"), scale, model, "region", COVARIATES)
    out = pos.groupBy("region", "converged").agg(F.avg(flag("activity")).alias("observed"), F.avg("probability").alias("expected"))
    return (size.join(out, "region", "left").withColumn("ratio", ratio("observed", "expected"))
            .select("region", "n_tagged", "observed", "expected", "ratio", "converged"))


def validate_extrapolation(rows: DataFrame, measure: str, holdout: float = 0.10, minimum: int = 1000, tail: int = 50) -> DataFrame:
    """Fit below the upper intensity quantile of not-tagged cells, compare above it.

    Regions with too few cells, or too few above the quantile, keep their row with NULL values.
    """
    rows = settle(rows.select("region", "tagged", "activity", dbl(measure).alias("_m"), *COVARIATES), "validated")
    neg = rows.where("NOT tagged")
    cut = settle(grouped_quantiles(neg, ["region"], "_m", [1 - holdout], ["cut"]).where(F.col("n") >= minimum).drop("n"), "cuts")
    both = neg.join(cut, "region")
    hi = both.where(F.col("_m") > F.col("cut"))
    enough = settle(hi.groupBy("region").agg(F.count("*").alias("_n")).where(F.col("_n") >= tail).select("region"), "enough")
    lo = both.where(F.col("_m") <= F.col("cut")).join(enough, "region", "left_semi")
    scale, model = logit.fit_logistic(lo, "region", "activity", COVARIATES)
    out = logit.predict(hi.drop("cut"), scale, model, "region", COVARIATES).groupBy("region", "converged").agg(
        F.count("*").alias("holdout_n"), F.avg("probability").alias("predicted"), F.avg(flag("activity")).alias("actual"))
    return (rows.select("region").distinct().join(out, "region", "left").withColumn("pred_over_actual", ratio("predicted", "actual"))
            .select("region", "holdout_n", "predicted", "actual", "pred_over_actual", "converged"))


def expected_overlap(rows: DataFrame, minimum: int = 500) -> DataFrame:
    """Per region of at least ``minimum`` cells: n, observed, expected, fitted and naive ratios, resampled interval.

    A region whose expectation cannot be fitted keeps its counts and naive ratio.
    """
    size = rows.groupBy("region").agg(F.count("*").alias("n_cells"))
    keep = settle(size.where(F.col("n_cells") >= minimum), "kept")
    used = settle(rows.join(keep.select("region"), "region", "left_semi").select("region", "tagged", "activity", *COVARIATES), "used")
    fit = fitted_expectation(used, written=True).withColumnRenamed("ratio", "above_chance_fitted")
    out = keep.join(fit, "region", "left").join(naive_ratio(used, ["region"]).withColumnRenamed("naive", "above_chance_naive"), "region", "left")
    out = out.withColumn("_q", _binomial_interval(dbl("n_tagged"), dbl("observed")))
    return out.select("region", "n_cells", "n_tagged", "observed", "expected", "above_chance_fitted", "above_chance_naive",
                      ratio("_q.lo", "expected").alias("ci_lo"), ratio("_q.hi", "expected").alias("ci_hi"), "converged")


def chance_compare(rows: DataFrame, k: int = 100, n_rot: int = 200, n_boot: int = 200, min_cells: int = 500,
                   min_tagged: int = 30, cap: int | None = None, written: bool = False) -> DataFrame:
    """One row per region with every baseline.  Small regions are removed before the searches.

    Each baseline is written by itself and leaves one row a region, not the tables it was made from.  ``written``: rows come from a written table.
    """
    size = rows.groupBy("region").agg(F.count("*").alias("n_cells"), count_where(F.col("tagged")).alias("n_tagged"))
    keep = settle(size.where((F.col("n_cells") >= min_cells) & (F.col("n_tagged") >= min_tagged)), "kept")
    used = rows.join(keep.select("region"), "region", "left_semi").select(*COMPARED)
    used = used if written else settle(used, "compare")
    parts = (lambda: naive_ratio(used, ["region"]),
             lambda: local_table(used, k, n_boot, cap=cap, written=True).select("region", F.col("above_chance_local").alias("local"), "ci_lo", "ci_hi"),
             lambda: fitted_expectation(used, written=True).select("region", F.col("ratio").alias("fitted")),
             lambda: anchor_floor(used, ["region"]).select("region", "anchor_floor"),
             lambda: rotation_null(used, n_rot, cap=cap, written=True).select("region", F.col("ratio").alias("rotation"), F.col("p").alias("rotation_p")))
    out = keep
    for part in parts:
        out = out.join(settle_alone(rows.sparkSession, part, "baseline"), "region", "left")
    return out.select("region", "n_cells", "n_tagged", "naive", "local", "fitted", "anchor_floor", "rotation", "rotation_p", "ci_lo", "ci_hi")
