"""Operators that work in rounds over written tables: fits, draws, trees, boxes, blobs, tiles, the delivery store."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytolattice.operators import chance as C
from cytolattice.operators import hierarchy as H
from cytolattice.operators import logit as L
from cytolattice.operators import pixels as P
from cytolattice.operators import spatial as S
from cytolattice.operators import tables as T
from cytolattice.streaming import ingest as I


# -- fits ------------------------------------------------------------------------------------------------------------

def numpy_fit(x, y, l2=1e-4):
    design, b = np.hstack([np.ones((len(x), 1)), x]), np.zeros(4)
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ b))
        g = design.T @ (p - y) + 2 * l2 * np.r_[0, b[1:]]
        h = (design * (p * (1 - p))[:, None]).T @ design + 2 * l2 * np.diag([0, 1, 1, 1])
        b = b - np.linalg.solve(h, g)
    return b


def test_many_fits_at_once_equal_numpy(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for g in range(12):
        n = 60 + 40 * g
        x = rng.normal(size=(n, 3)) * [1.0, 20.0, 0.1] + [0.0, 100.0, g]
        if g == 3:
            x[:, 2] = 7.0                                                             # a covariate without spread
        z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1.0)
        y = rng.random(n) < 1 / (1 + np.exp(-(0.3 * g - 2 + z @ [1.0, -0.5, 0.2])))
        rows += [(f"g{g}", bool(v), *map(float, r)) for v, r in zip(y, x)]
        want[f"g{g}"] = numpy_fit(z, y.astype(float))
    rows += [("none", False, float(i), float(i * i % 7), 1.0) for i in range(50)]      # no positive case: the intercept runs away
    df = spark.createDataFrame(rows, "region string, activity boolean, x1 double, x2 double, x3 double")
    _, model = L.fit_logistic(df, "region", "activity", ("x1", "x2", "x3"))
    got = {r.region: r for r in model.collect()}
    for g, b in want.items():
        assert got[g].converged and [got[g].b0, got[g].b1, got[g].b2, got[g].b3] == pytest.approx(list(b), abs=1e-6)
    _, short = L.fit_logistic(df, "region", "activity", ("x1", "x2", "x3"), rounds=3)
    flags = {r.region: r.converged for r in short.collect()}
    assert len(flags) == 13 and not flags["none"]
    _, empty = L.fit_logistic(df.where("region = 'x'"), "region", "activity", ("x1", "x2", "x3"))
    assert empty.collect() == []


def test_regions_that_cannot_be_fitted_keep_their_rows(spark):
    rng = np.random.default_rng(1)
    rows = [("big", bool(rng.random() < 0.2), bool(rng.random() < 0.3), *map(float, rng.normal(size=3)), float(rng.random())) for _ in range(1500)]
    rows += [("small", i % 2 == 0, i % 3 == 0, 1.0, 2.0, 3.0, 0.5) for i in range(40)] + [("untagged", False, i % 3 == 0, float(i), 2.0, 3.0, 0.5) for i in range(600)]
    df = spark.createDataFrame(rows, "region string, tagged boolean, activity boolean, x1 double, x2 double, x3 double, m double")
    fit = {r.region: r for r in C.fitted_expectation(df).collect()}
    assert fit["big"].converged and fit["big"].ratio > 0 and fit["small"].expected is None and fit["small"].n_tagged == 20 and fit["untagged"].n_tagged == 0
    over = {r.region: r for r in C.expected_overlap(df).collect()}
    assert set(over) == {"big", "untagged"} and over["untagged"].above_chance_fitted is None and over["big"].ci_lo < over["big"].above_chance_fitted < over["big"].ci_hi
    val = {r.region: r for r in C.validate_extrapolation(df, "m").collect()}
    assert set(val) == {"big", "small", "untagged"} and val["big"].holdout_n > 50 and val["small"].holdout_n is None
    both = C.with_whole_project(df, df.drop("region"))
    assert both.where(F.col("region") == C.WHOLE).count() == len(rows)


def test_local_table_names_its_scheme(spark):
    rng = np.random.default_rng(3)
    rows, ids = [], itertools.count()
    for region, sections, n, tag in (("wide", 4, 200, 0.2), ("narrow", 2, 200, 0.2), ("bare", 3, 100, 0.0), ("thin", 1, 8, 0.5)):
        for s in range(sections):
            rows += [(region, f"s{s}", next(ids), float(rng.uniform(0, 100)), float(rng.uniform(0, 100)), bool(rng.random() < tag), bool(rng.random() < 0.3)) for _ in range(n)]
    df = spark.createDataFrame(rows, "region string, section string, cell_id long, x double, y double, tagged boolean, activity boolean")
    got = {r.region: r for r in C.local_table(df, 20, 100).collect()}
    assert got["wide"].ci_scheme == "section-level" and got["wide"].ci_lo <= got["wide"].above_chance_local <= got["wide"].ci_hi
    assert got["narrow"].ci_scheme == "cell-level (2 section(s) -- WITHIN-section precision only)" and got["narrow"].ci_lo < got["narrow"].ci_hi
    for name in ("bare", "thin"):
        assert (got[name].ci_scheme, got[name].n_sections, got[name].tagged_n, got[name].above_chance_local, got[name].ci_lo) == ("n/a", 0, 0, None, None)


# -- draws -----------------------------------------------------------------------------------------------------------

def test_draws_of_far_ids_never_tie(spark):
    ids = [i + k * C.PRIME for i in range(50) for k in (0, 1, 5, 2 ** 31)] + [-1, -2, 2 ** 63 - 1, -2 ** 63]
    got = C.with_draw(spark.createDataFrame([(i,) for i in ids], "id long"), "id", 7).collect()
    assert len({(r._hi, r._lo) for r in got}) == len(ids) and all(0 <= r._hi < 2 ** 32 and 0 <= r._lo < 2 ** 32 and r._d == r._hi * 2 ** 20 + r._lo // 4096 for r in got)


@pytest.mark.parametrize("turns", [4, 0])
def test_shuffled_labels_are_exactly_as_many(spark, monkeypatch, turns):
    """Without a turn all draws share their first bits, so the last ones decide."""
    monkeypatch.setattr(C, "TURNS", turns)
    rows = [("s", i, i % 5 == 0, (i * 7) % 3 == 0, float(i)) for i in range(3000)] + [("t", i, i % 2 == 0, i % 3 == 0, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "section string, cell_id long, tagged boolean, activity boolean, anchor_mean double")
    draws = {r.cell_id: (r._hi, r._lo) for r in C.with_draw(df.select("cell_id").distinct(), "cell_id", 0).collect()}
    got = {r.section: r.shuffled for r in C.shuffled_control(df, ["section"]).collect()}
    for section in "st":
        part = [r for r in rows if r[0] == section]
        t, a = sum(r[2] for r in part), sum(r[3] for r in part)
        low = sorted(part, key=lambda r: draws[r[1]])[:t]
        assert got[section] == pytest.approx(sum(r[3] for r in low) * len(part) / (t * a))


# -- trees -----------------------------------------------------------------------------------------------------------

def test_closure_of_a_deep_chain_and_of_a_cycle(spark):
    chain = [(f"n{i}", f"n{i + 1}" if i < 299 else None) for i in range(300)] + [("leaf", "n0"), ("stray", "absent")]
    got = {(r.ancestor, r.descendant): r.distance for r in H.ontology_closure(spark.createDataFrame(chain, "acronym string, parent string")).collect()}
    want = {(f"n{j}", f"n{i}"): j - i for i in range(300) for j in range(i, 300)} | {(f"n{j}", "leaf"): j + 1 for j in range(300)}
    assert got == want | {("leaf", "leaf"): 0, ("stray", "stray"): 0, ("absent", "stray"): 1}
    with pytest.raises(ValueError, match="cycle"):
        H.ontology_closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", None)], "acronym string, parent string"))


# -- boxes -----------------------------------------------------------------------------------------------------------

def test_boxes_fall_back_to_smaller_sides(spark):
    ring = "array<struct<x:double,y:double>>"
    rows = [("wide", 0.0, 1000.0, 0.0, 1000.0, None), ("thin", 0.0, 1000.0, 0.0, 55.0, None), ("none", 0.0, 30.0, 0.0, 30.0, None),
            ("tri", 0.0, 400.0, 0.0, 400.0, [(0.0, 0.0), (400.0, 0.0), (0.0, 400.0)])]
    shapes = spark.createDataFrame(rows, f"region_id string, x0 double, x1 double, y0 double, y1 double, ring {ring}")
    boxes = S.random_boxes(shapes).collect()
    sides = {name: [r.side for r in sorted(boxes, key=lambda r: r.box) if r.region_id == name] for name in ("wide", "thin", "none", "tri")}
    assert sides["wide"] == [150.0] * 3 and sides["thin"] == [50.0] * 3 and sides["none"] == [] and len(sides["tri"]) == 3
    for r in boxes:
        if r.region_id == "tri":
            assert r.bx + r.by + 2 * r.side <= 400
    again = S.random_boxes(shapes.repartition(3)).collect()
    assert sorted(map(tuple, boxes)) == sorted(map(tuple, again))
    assert S.random_boxes(shapes.limit(0)).collect() == [] and S.random_boxes(shapes, sides=()).collect() == []


# -- pixels ----------------------------------------------------------------------------------------------------------

def plain_blobs(pixels):
    left, out = set(pixels), []
    while left:
        part, stack = set(), [min(left)]
        while stack:
            p = stack.pop()
            if p in left:
                left.remove(p)
                part.add(p)
                stack += [(p[0] + 1, p[1]), (p[0] - 1, p[1]), (p[0], p[1] + 1), (p[0], p[1] - 1)]
        out.append((min(part), len(part)))
    return sorted(out)


@pytest.mark.parametrize("block", [3, 256])
def test_blobs_cross_blocks_and_far_columns(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    rng = random.Random(5)
    far = 1 << 40
    pixels = {(y, x + far) for y in range(-20, 20) for x in range(30) if rng.random() < 0.55}
    pixels |= {(50, x) for x in range(40)} | {(y, 39) for y in range(50, 70)} | {(70, x) for x in range(40)}     # one long hook
    rows = [("s", "c", y, x) for y, x in pixels]
    df = spark.createDataFrame(rows + rows[:9], "section string, channel string, y long, x long")
    got = sorted(((r.blob.y, r.blob.x), r.size) for r in P.connected_blobs(df).collect())
    assert got == plain_blobs(pixels)
    assert P.connected_blobs(df.limit(0)).collect() == []


def test_gaussian_field_equals_numpy_and_falls_back_to_ones(spark):
    rng = np.random.default_rng(2)
    tiles = rng.uniform(1, 100, (5, 9, 7)) * np.array([1, 3, 2, 1, 5])[:, None, None]
    rows = [("A", f"t{t}", y, x, float(tiles[t, y, x])) for t in range(5) for y in range(9) for x in range(7)]
    rows += [("A", "dark", y, x, 0.0) for y in range(9) for x in range(7)] + [("B", "dark", y, x, 0.0) for y in range(2) for x in range(2)]
    rows += [("C", "t0", 0, 0, 5.0), ("C", "t1", 0, 0, 5.0), ("C", "t1", 1, 0, 9.0)]
    got = {(r.channel, r.y, r.x): r.field for r in P.flat_field(spark.createDataFrame(rows, "channel string, tile string, y int, x int, v double"), 1.5).collect()}
    raw = np.median([t / t.mean() for t in tiles], axis=0)
    w = P.gaussian_weights(1.5)
    assert len(w) == 13
    for axis in (1, 0):
        raw = np.apply_along_axis(lambda v: np.convolve(np.pad(v, 6, mode="symmetric"), w, mode="valid"), axis, raw)
    raw /= raw.mean()
    assert [got["A", y, x] for y in range(9) for x in range(7)] == pytest.approx(list(raw.ravel()), rel=1e-9)
    assert all(v == 1.0 for k, v in got.items() if k[0] in "BC") and len(got) == 63 + 4 + 2


def test_field_of_tiles_with_missing_pixels_has_their_size(spark):
    rng = np.random.default_rng(3)
    tiles = rng.uniform(1, 100, (2, 8, 6))
    kept = np.zeros((2, 8, 6), dtype=bool)
    kept[0, 1:6, 0:3] = kept[1, 0:7, 1:3] = True
    rows = [("A", f"t{t}", int(y), int(x), float(tiles[t, y, x]), 8, 6) for t, y, x in np.argwhere(kept)]
    got = {(r.y, r.x): r.field for r in P.flat_field(spark.createDataFrame(rows, "channel string, tile string, y int, x int, v double, h int, w int"), 1.0).collect()}
    norm = np.where(kept, tiles / np.array([tiles[t][kept[t]].mean() for t in range(2)])[:, None, None], np.nan)
    some = kept.any(axis=0)
    field = np.array([[np.nanmedian(norm[:, y, x]) if some[y, x] else 0.0 for x in range(6)] for y in range(8)])
    for axis in (1, 0):
        field = np.where(some, np.apply_along_axis(lambda v: np.convolve(np.pad(v, 4, mode="symmetric"), P.gaussian_weights(1.0), mode="valid"), axis, field), 0.0)
    want = field / field[some].mean()
    assert set(got) == {(int(y), int(x)) for y, x in np.argwhere(some)} and all(v == pytest.approx(want[k], rel=1e-9) for k, v in got.items())


def test_histogram_loses_no_value(spark):
    df = spark.createDataFrame([("s", "c", v) for v in (0, 99, 100, 129, 130, 999, -4, None)], "section string, channel string, v int")
    for bins in (7, 10, 13):
        h = P.intensity_histogram(df, ["section", "channel"], bins, 130).collect()
        assert len(h) == bins and sum(r.n for r in h) == 7


def plain_tiles(image, n, size, low, every):
    h, w = image.shape
    size = min(size, h, w)
    step = max(size // 2, 1)
    cands = sorted((float((image[y:y + size:every, x:x + size:every] > low).mean()), y, x) for y in range(0, h - size + 1, step) for x in range(0, w - size + 1, step))
    cands = [c for c in cands if c[0] > 0.5]
    if not cands:
        return [((h - size) // 2, (w - size) // 2)]
    tried = [cands[int(round(i))] for i in np.linspace(0, len(cands) - 1, num=min(4 * n, len(cands)))][::-1]
    out = []
    for separate in (True, False):
        for _, y, x in tried:
            if len(out) < n and (y, x) not in out and (not separate or all(abs(y - b) >= 2 * size or abs(x - a) >= 2 * size for b, a in out)):
                out.append((y, x))
    return out


@pytest.mark.parametrize("shape,size,n", [((60, 90), 10, 5), ((60, 90), 7, 40), ((20, 20), 64, 3), ((40, 40), 12, 3)])
def test_spread_tiles_equal_a_sequential_choice(spark, shape, size, n):
    rng = np.random.default_rng(size)
    image = rng.integers(0, 100, shape) + (np.arange(shape[1]) * 40 // shape[1])[None, :]
    if shape == (40, 40):
        image[:] = 0
    rows = [("s", "c", y, x, int(image[y, x])) for y in range(shape[0]) for x in range(shape[1])]
    df = spark.createDataFrame(rows, "section string, channel string, y int, x int, v int")
    got = [(r.y, r.x) for r in P.spread_tiles(df, ["section", "channel"], size, 50.0, n, every=2).orderBy("place").collect()]
    assert got == plain_tiles(image, n, size, 50.0, 2)


# -- names and deliveries --------------------------------------------------------------------------------------------

def test_substring_overrides_of_any_number(spark):
    rng = random.Random(6)
    names = sorted({"".join(rng.choice("abc_") for _ in range(rng.randint(1, 12))) for _ in range(200)})
    keys = ["", "a", "ab", "abc", "cab_", "c_a_b", "zzzz"] + ["".join(rng.choice("abc_") for _ in range(rng.randint(1, 7))) for _ in range(120)]
    rng.shuffle(keys)
    pats = spark.createDataFrame(list(enumerate(keys)) + [(999, None)], "ordinal long, match_key string")
    imgs = spark.createDataFrame([(x,) for x in names] + [("",), (None,)], "image string")
    got = {(r.image, r.ordinal) for r in T.substring_matches(imgs, pats, "image", "match_key").collect()}
    assert got == {(x, i) for x in [*names, ""] for i, k in enumerate(keys) if k in x}
    block = T.settings_resolve(imgs, pats.withColumn("block", F.concat(F.lit("b"), "ordinal")))
    want = {}
    for x in [*names, ""]:
        hits = [(k != x, i) for i, k in enumerate(keys) if k and k in x]
        want[x] = f"b{min(hits)[1]}" if hits else None
    assert {r.image: r.block for r in block.collect()} == want | {None: None}
    over = T.threshold_override(imgs, spark.createDataFrame([(2, "a", "x", None, 1.0), (1, "ab", None, 0.5, None)],
                                                            "ordinal long, match_key string, mode string, span_frac double, absolute double"), {"mode": "m", "span_frac": 0.1, "absolute": 0.0})
    for r in over.collect():
        want = ("ab", "m", 0.5, 0.0) if "ab" in (r.image or "") else ("a", "x", 0.1, 1.0) if "a" in (r.image or "") else (None, "m", 0.1, 0.0)
        assert (r.match_key, r.mode, r.span_frac, r.absolute) == want


@pytest.mark.parametrize("files,every", [(1, 2), (3, 1), (None, 100)])
def test_store_does_not_depend_on_batches(spark, tmp_path, files, every):
    schema, key = "section string, region string, seq long, n long", ["section", "region"]
    source, target, ckpt = (str(tmp_path / d) for d in ("in", "store", "ckpt"))
    assert I.read_store(spark, schema, target, key, "seq").count() == 0 and I.compact(spark, schema, target, "section", key, "seq") == -1
    rng, rows, out = random.Random(1), [], None
    for wave in range(3):
        for _ in range(3):
            part = [(f"s{rng.randint(0, 2)}", rng.choice(["r0", "r1", None]), rng.randint(0, 30), rng.randint(0, 99)) for _ in range(5)]
            rows += part
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        out = I.ingest_all(spark, source, schema, target, ckpt, "section", key, "seq", files, every)
        best = {}
        for s, r, q, n in rows:
            best.setdefault((s, r), []).append((q, n))
        got = {(r.section, r.region): (r.seq, r.n) for r in out.collect()}
        assert set(got) == set(best) and all(got[k][0] == max(v)[0] and got[k] in v for k, v in best.items())
    before = sorted(map(str, out.collect()))
    done = I.committed(spark, target)
    last = I.compact(spark, schema, target, "section", key, "seq")
    assert last >= done and I.committed(spark, target) == last
    assert sorted(map(str, I.read_store(spark, schema, target, key, "seq").collect())) == before
    # A batch played again after the compaction changes nothing, nor does a base without a commit.
    again = spark.createDataFrame([("s9", "r9", 1, 1)], schema)
    again.write.mode("overwrite").partitionBy("section").parquet(f"{target}/batches/batch={last}")
    again.write.mode("overwrite").partitionBy("section").parquet(f"{target}/base/through={last + 50}")
    assert sorted(map(str, I.read_store(spark, schema, target, key, "seq").collect())) == before
