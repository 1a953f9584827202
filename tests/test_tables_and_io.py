import json

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cytolattice.config import GateBands, Marker, Panel
from cytolattice.operators import gates as G
from cytolattice.operators import tables as T
from cytolattice.session import scratch_path
from cytolattice.sources import readers as RD
from cytolattice.sources import writers as S
from cytolattice.streaming.ingest import ingest_all

BANDS = GateBands()


def test_handcounts(spark):
    sheet = spark.createDataFrame([("cc", 1, 100.0, 30, 28), ("cc", 2, 100.0, 28, 28), ("cc", 3, 100.0, 99, None), ("VS", 1, 80.0, 4, 0), ("TH", 1, 80.0, 4, None)],
                                  "region string, box int, side_um double, machine long, human long")
    got = {r.region: r for r in T.handcount_verdict(T.handcount_pool(sheet), BANDS).collect()}
    assert got["cc"].machine == 58 and got["cc"].ratio == pytest.approx(58 / 56) and got["cc"].verdict == "agrees"
    assert got["VS"].ratio is None and got["VS"].verdict.startswith("over-detecting")
    assert [r.region for r in T.handcount_pending(sheet).collect()] == ["TH"]


def test_calibration_series_outlier(spark):
    rows = [(f"s{i}", 100 + i, 2000 + 10 * i, 600) for i in range(6)] + [("odd", 900, 2030, 1200)]
    summary = T.calibration_summary(spark.createDataFrame(rows, "slice string, floor_peak long, bright_peak long, threshold long"))
    assert {(r.slice, r.metric) for r in T.robust_series_outliers(summary).collect()} == {("odd", "floor"), ("odd", "span")}


def test_histogram_mode_drops_beyond_last_edge(spark):
    bands = replace(BANDS, area_peak_max=10.0)         # cap at 40
    df = spark.createDataFrame([("s", 7.0)] * 3 + [("s", 8.0)] + [("s", 500.0)] * 9 + [("s", 12.0)] * 4, "section string, nucleus_area_um2 double")
    assert G.gate_area_peak(df, bands).first().value == 7.5


def test_gates_flag_flooded_and_strict(spark):
    def rows(dens, cc):
        names = [("root", 1.0), ("cc", cc)] + [(a, 1.0 + 0.1 * i) for i, a in enumerate(BANDS.grey)]
        return [("s", n, "", int(dens * f * 10), 10.0) for n, f in names]
    def read(data):
        return spark.createDataFrame(data, "section string, acronym string, classification string, cnt long, area_mm2 double")
    bands = replace(BANDS, advisory=())
    ok, high = read(rows(3500, 1.3)), read(rows(5100, 1.3))
    assert G.gate_total_density(ok, bands).first().status == "PASS" and G.gate_total_density(high, bands).first().status == "FLAG"
    assert G.gate_white_matter(read(rows(3500, 2.0)), bands).first().status == "FLAG"
    assert G.gate_ventricle(ok, bands).first().status == "N/A"
    assert G.gate_grey_contrast(ok, bands).first().status == "PASS"
    assert G.gate_grey_contrast(read(rows(3500, 1.0)[:4]), bands).first().status == "N/A"


def test_upsert_and_keep_last(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "image string, n int")
    new = spark.createDataFrame([("b", 9)], "image string, n int")
    wide = new.withColumn("extra", F.lit("x"))
    base = scratch_path(spark, "upsert")
    assert not S.upsert_table(old, "image", f"{base}/1") and S.upsert_table(new, "image", f"{base}/2", f"{base}/1")
    assert {tuple(r) for r in spark.read.parquet(f"{base}/2").collect()} == {("a", 1), ("b", 9)}
    assert not S.upsert_table(wide, "image", f"{base}/3", f"{base}/2")
    assert spark.read.parquet(f"{base}/3").count() == 1 and spark.read.parquet(f"{base}/2").count() == 2
    with pytest.raises(ValueError):
        S.upsert(old, wide, "image")
    log = spark.createDataFrame([("k", 1, "old"), ("k", 3, "new"), ("j", 2, "only")], "key string, seq int, v string")
    assert {r.v for r in S.keep_last(log, ["key"], "seq").collect()} == {"new", "only"}


def test_unmeasured_parameters_are_issues(spark):
    desc = spark.createDataFrame([("a", 0.5, 30.0, 100, 2.0, 1), ("b", 0.5, 30.0, 101, 2.5, 1), ("c", None, 30.0, 100, None, 1)],
                                 "dataset string, pixel_um double, area_modal_um2 double, n_cells long, control_above_chance double, k long")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c")], "first string, second string")
    got = {(r.second, r.metric): r.weight for r in T.dataset_verdict(desc, pairs).collect()}
    assert {w for (s, _), w in got.items() if s == "b"} == {"usable"} and len(got) == 12
    assert got["c", "absolute counts"] == "do not compare" and got["c", "raw conditional"] == got["c", "rank order"] == "usable"
    assert got["c", "above chance over own control"] == "needs a control region"


def test_missing_columns_are_errors(spark):
    path = scratch_path(spark, "bad")
    S.write_csv(spark.range(1).withColumn("class", F.lit("x")), path, "\t")
    with pytest.raises(ValueError):
        RD.scan_cells(spark, path)
    with pytest.raises(ValueError):
        RD.scan_region_table(spark, path, Panel(markers=(Marker("tdt", "whole-cell"),)))


def test_calibration_requires_keys(spark):
    path = scratch_path(spark, "cal")
    spark.createDataFrame([("img - s1", 3)], "image string, floor long").write.json(path)
    with pytest.raises(Exception):
        RD.scan_calibration(spark, path).collect()


def test_stream_replay_is_idempotent(spark):
    base = scratch_path(spark, "stream")
    schema = "slice string, k string, v long, seq long"
    spark.createDataFrame([("a", "x", 1, 1), ("a", "x", 2, 2), ("b", "x", 5, 3)], schema).write.mode("append").parquet(f"{base}/in")
    args = (spark, f"{base}/in", schema, f"{base}/t")
    later = [("a", "y", 7, 4), ("b", "x", 6, 5)]
    first = {(r.slice, r.v) for r in ingest_all(*args, f"{base}/c1", "slice", ["slice", "k"], "seq").collect()}
    again = {(r.slice, r.v) for r in ingest_all(*args, f"{base}/c2", "slice", ["slice", "k"], "seq").collect()}
    assert first == again == {("a", 2), ("b", 5)}
    # Rows not sent again stay, and one batch gives what two gave.
    spark.createDataFrame(later, schema).write.mode("append").parquet(f"{base}/in")
    two = {(r.slice, r.k, r.v) for r in ingest_all(*args, f"{base}/c1", "slice", ["slice", "k"], "seq").collect()}
    one = {(r.slice, r.k, r.v) for r in ingest_all(spark, f"{base}/in", schema, f"{base}/t1", f"{base}/c3", "slice", ["slice", "k"], "seq").collect()}
    assert one == two == {("a", "x", 2), ("a", "y", 7), ("b", "x", 6)}


def test_ontology_of_any_depth(spark):
    node = None
    for i in range(20, 0, -1):
        node = {"data": {"acronym": f"n{i}"}, "children": [node] if node else []}
    path = scratch_path(spark, "deep")
    spark.createDataFrame([(json.dumps({"root": node}),)], "value string").write.text(path)
    rows = {r.acronym: (r.parent, r.depth) for r in RD.scan_ontology(spark, path).collect()}
    assert len(rows) == 20 and rows["n1"] == (None, 0) and rows["n20"] == ("n19", 19)


def test_long_order():
    assert S.long_order(["x_rate", "anchor_density", "anchor_count", "N", "region", "animal"]) == [
        "animal", "region", "anchor_count", "N", "anchor_density", "x_rate"]


def test_stems_are_compared_without_joining_their_rows(spark, capsys):
    a = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "stem string")
    b = spark.createDataFrame([("y",), ("z",), ("z",), (None,)], "stem string")
    got = T.stem_difference(a, b)
    assert sorted(map(tuple, got.collect()), key=str) == [("x", "only_first"), ("y", "both"), ("z", "only_second"), (None, "both")]
    got.explain()
    assert "Join" not in capsys.readouterr().out
