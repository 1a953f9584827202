"""Assay-shaped views over the test tables.

The texts are shared by Spark and the SQL oracle; ``{table}`` names an input table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..config import GateBands, Marker, Panel

K = 1.0
PANEL = Panel(markers=(Marker("fos", "nuclear"), Marker("tdt", "whole-cell")), k_robust=K)

VIEWS = {
    "fx_cells": """
        SELECT o_orderkey AS cell_id, concat('A', year(o_orderdate)) AS animal,
               concat('A', year(o_orderdate), '_s', quarter(o_orderdate)) AS section,
               CASE WHEN o_custkey % 2 = 0 THEN 'Left' ELSE 'Right' END AS hemisphere,
               CASE WHEN o_custkey % 11 = 0 THEN r_name ELSE n_name END AS acronym,
               CASE WHEN n_nationkey IN (3, 17) THEN TRUE ELSE FALSE END AS excluded,
               CAST((o_custkey * 7919 + o_orderkey * 31) % 10007 AS DOUBLE) AS x,
               CAST((o_orderkey * 104729) % 10007 AS DOUBLE) AS y,
               CAST(20 + (o_orderkey * 31) % 230 AS DOUBLE) AS nucleus_area_um2,
               o_totalprice AS anchor_mean, c_acctbal AS fos_bgsub, o_totalprice / 1000 AS tdt_bgsub
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
             JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_edges": """
        SELECT n_name AS acronym, r_name AS parent FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
        UNION ALL SELECT r_name, 'root' FROM {region}
        UNION ALL SELECT 'root', CAST(NULL AS VARCHAR(10))""",
    "fx_excluded": "SELECT n_name AS acronym FROM {nation} WHERE n_nationkey IN (3, 17)",
    "fx_region_area": """
        SELECT n_name AS acronym, h.hemisphere, CAST(1.0 + n_nationkey / 10.0 AS DOUBLE) AS area_mm2
        FROM {nation} CROSS JOIN (SELECT 'Left' AS hemisphere UNION ALL SELECT 'Right') h
        UNION ALL
        SELECT r_name, h.hemisphere, CAST(10 AS DOUBLE) AS area_mm2
        FROM {region} CROSS JOIN (SELECT 'Left' AS hemisphere UNION ALL SELECT 'Right') h""",
    "fx_shapes": """
        SELECT n_name AS region_id, concat('ROW', CAST(floor(n_nationkey / 5) AS BIGINT)) AS parent_id,
               CAST((n_nationkey % 5) * 2000 AS DOUBLE) AS x0, CAST((n_nationkey % 5) * 2000 + 2000 AS DOUBLE) AS x1,
               CAST(floor(n_nationkey / 5) * 2000 AS DOUBLE) AS y0,
               CAST(floor(n_nationkey / 5) * 2000 + 2000 AS DOUBLE) AS y1
        FROM {nation}
        UNION ALL SELECT DISTINCT concat('ROW', CAST(floor(n_nationkey / 5) AS BIGINT)), 'ALL',
               CAST(0 AS DOUBLE), CAST(10000 AS DOUBLE),
               CAST(floor(n_nationkey / 5) * 2000 AS DOUBLE), CAST(floor(n_nationkey / 5) * 2000 + 2000 AS DOUBLE)
        FROM {nation}
        UNION ALL SELECT 'ALL', CAST(NULL AS VARCHAR(10)), CAST(0 AS DOUBLE), CAST(10004 AS DOUBLE),
               CAST(0 AS DOUBLE), CAST(10004 AS DOUBLE)""",
    "fx_drawn": """
        SELECT CAST(s_suppkey AS BIGINT) AS shape_id, concat('R', s_suppkey % 10) AS roi_name,
               CAST((s_suppkey * 997) % 9000 AS DOUBLE) AS x0, CAST((s_suppkey * 997) % 9000 + 1700 AS DOUBLE) AS x1,
               CAST((s_suppkey * 613) % 9000 AS DOUBLE) AS y0, CAST((s_suppkey * 613) % 9000 + 1500 AS DOUBLE) AS y1,
               CAST(s_suppkey % 3 AS BIGINT) AS z
        FROM {supplier}""",
    "fx_pixels": """
        SELECT concat('P', l_suppkey % 4) AS section, l_returnflag AS channel, l_linenumber AS z,
               CAST(l_partkey % 64 AS INT) AS y, CAST(floor(l_suppkey / 4) % 64 AS INT) AS x,
               CAST(floor(l_extendedprice / 2) AS INT) AS v
        FROM {lineitem}""",
    "fx_plane": """
        SELECT section, channel, y, x, max(v) AS v FROM (
          SELECT concat('P', l_suppkey % 4) AS section, l_returnflag AS channel,
                 CAST(l_partkey % 64 AS INT) AS y, CAST(floor(l_suppkey / 4) % 64 AS INT) AS x,
                 CAST(floor(l_extendedprice / 2) AS INT) AS v
          FROM {lineitem}) p GROUP BY section, channel, y, x""",
    "fx_reference": """
        SELECT event_id AS seq, concat('c', user_id % 3) AS config_tag, concat('S', user_id % 20) AS slice,
               concat(CASE WHEN event_id % 2 = 0 THEN 'Left: R' ELSE 'Right: R' END, event_id % 7) AS region,
               CASE WHEN event_id % 2 = 0 THEN 'Left' ELSE 'Right' END AS hemisphere,
               event_id % 7 < 6 AS is_leaf, event_type AS marker, concat(event_type, '+') AS class,
               CAST(floor(value) AS BIGINT) AS cnt, value AS density
        FROM {events}""",
    "fx_handcount": """
        SELECT n_name AS region, s_suppkey AS box, CAST(100 + 10 * (s_suppkey % 5) AS DOUBLE) AS side_um,
               CAST(floor(abs(s_acctbal) / 100) AS BIGINT) AS machine,
               CASE WHEN s_suppkey % 6 = 0 THEN NULL
                    ELSE greatest(CAST(floor(abs(s_acctbal) / 100) AS BIGINT) + s_suppkey % 9 - 4, 0) END AS human
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "fx_calibration": """
        SELECT concat('S', user_id % 20) AS slice, CAST(floor(min(value) * 100) AS BIGINT) AS floor_peak,
               CAST(floor(max(value) * 100) AS BIGINT) AS bright_peak,
               CAST(floor(avg(value) * 200) AS BIGINT) AS threshold
        FROM {events} GROUP BY user_id % 20""",
    "fx_roi_counts": """
        SELECT o_orderpriority AS project, concat('I', o_custkey % 50) AS image, n_name AS roi_name,
               o_orderstatus AS marker, concat('h', o_custkey % 3) AS settings_hash,
               CAST(0.5 + (o_custkey % 3) * 0.1 AS DOUBLE) AS pixel_um,
               count(*) AS cnt, CAST(1.0 + n_nationkey / 10.0 AS DOUBLE) AS area_mm2
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
        GROUP BY o_orderpriority, o_custkey % 50, n_name, o_orderstatus, o_custkey % 3, n_nationkey""",
    "fx_raw_regions": """
        SELECT concat('S', o_custkey % 9) AS section,
               CASE n_nationkey WHEN 0 THEN 'Isocortex' WHEN 1 THEN 'cc' WHEN 2 THEN 'int'
                    WHEN 4 THEN 'fiber tracts' WHEN 5 THEN 'VS' WHEN 6 THEN 'CA1' WHEN 7 THEN 'CA3'
                    WHEN 8 THEN 'DG' WHEN 9 THEN 'TH' WHEN 10 THEN 'HY' WHEN 11 THEN 'STR' WHEN 12 THEN 'MB'
                    WHEN 13 THEN 'root' ELSE n_name END AS acronym,
               CASE WHEN o_custkey % 2 = 0 THEN 'Left' ELSE 'Right' END AS hemisphere,
               count(*) AS cnt, CAST(0.004 + n_nationkey * 0.0003 AS DOUBLE) AS area_mm2
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
        GROUP BY o_custkey % 9, n_nationkey, n_name, o_custkey % 2""",
    "fx_objects": """
        SELECT l_partkey AS part, l_returnflag AS marker,
               CAST(min(l_suppkey * 37 % 500) * 20 AS DOUBLE) AS x, CAST(max(l_partkey * 13 % 500) * 20 AS DOUBLE) AS y,
               CAST(20 + max(l_quantity) AS DOUBLE) AS r
        FROM {lineitem} GROUP BY l_partkey, l_returnflag""",
}

BANDS = GateBands()

_TABLE = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in set(_TABLE.findall(text))})


def oracle_view(name: str) -> str:
    return _TABLE.sub(r"\1", VIEWS[name])
