"""A spread of registered queries beside their SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")
NAMES = ("flagship", "k_sweep", "region_readout", "gate_table", "reference_stats", "point_in_region", "knn_unlabelled",
         "k_vs_chance", "local_peaks", "area_intensity", "flat_field", "scan_cells", "stream_ingest_sections", "greedy_overlap_match",
         "greedy_outline_match", "cells_in_outline", "outline_background", "random_boxes", "spread_tiles", "connected_blobs", "shuffled_control", "local_chance",
         "fitted_expectation", "threshold_override", "handcount_verdict", "dataset_issues", "union_sections", "group_comparison_order")


def norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    cell = lambda v: "~" if v is None else f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, DIR)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(cur.fetchall(), cols)


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
