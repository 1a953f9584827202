"""Registered queries: a name, a Spark callable and, where SQL can say it, the oracle text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .bindings import VIEWS, oracle_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

K = "1.0"

# Shared pieces of the oracle texts, pulled in by name.
CTES: dict[str, str] = {
    "meas": """SELECT animal, section, acronym, 'fos' AS marker, fos_bgsub AS v FROM fx_cells WHERE NOT excluded
        UNION ALL SELECT animal, section, acronym, 'tdt', tdt_bgsub FROM fx_cells WHERE NOT excluded""",
    "med0": "SELECT section, marker, count(*) AS n, median(v) AS med FROM meas GROUP BY section, marker",
    "stats": """SELECT m.section, m.marker, any_value(d.n) AS n, any_value(d.med) AS med,
        median(abs(m.v - d.med)) AS mad, CAST(1.4826 AS DOUBLE) * median(abs(m.v - d.med)) AS sd
        FROM meas m JOIN med0 d ON m.section = d.section AND m.marker = d.marker GROUP BY m.section, m.marker""",
    "statsw": """SELECT section, max(CASE WHEN marker = 'fos' THEN med END) AS fos_med,
        max(CASE WHEN marker = 'fos' THEN sd END) AS fos_sd, max(CASE WHEN marker = 'tdt' THEN med END) AS tdt_med,
        max(CASE WHEN marker = 'tdt' THEN sd END) AS tdt_sd FROM stats GROUP BY section""",
    "cells_s": "SELECT c.*, w.fos_med, w.fos_sd, w.tdt_med, w.tdt_sd FROM fx_cells c JOIN statsw w ON c.section = w.section",
    "classed": """SELECT *, CASE WHEN excluded THEN 'Excluded'
        WHEN fos_bgsub >= fos_med + 1.0 * fos_sd AND tdt_bgsub >= tdt_med + 1.0 * tdt_sd THEN 'Double+'
        WHEN fos_bgsub >= fos_med + 1.0 * fos_sd THEN 'fos+' WHEN tdt_bgsub >= tdt_med + 1.0 * tdt_sd THEN 'tdt+'
        ELSE 'Negative' END AS class FROM cells_s""",
    "flagged": """SELECT *, class IN ('tdt+', 'Double+') AS tagged, class IN ('fos+', 'Double+') AS activity
        FROM classed WHERE class <> 'Excluded'""",
    "closure": """SELECT acronym AS ancestor, acronym AS descendant, 0 AS distance FROM fx_edges
        UNION ALL SELECT e.parent, c.descendant, c.distance + 1 FROM closure c JOIN fx_edges e ON e.acronym = c.ancestor
        WHERE e.parent IS NOT NULL""",
    "exclc": "SELECT DISTINCT descendant AS acronym FROM closure WHERE ancestor IN (SELECT acronym FROM fx_excluded)",
    "region_rows": """SELECT c.animal, c.section, c.hemisphere, c.acronym, any_value(a.area_mm2) AS area_mm2,
        count(*) FILTER (class <> 'Excluded') AS anchor_count,
        count(*) FILTER (class IN ('fos+', 'Double+')) AS fos_pos_count,
        count(*) FILTER (class IN ('tdt+', 'Double+')) AS tdt_pos_count,
        count(*) FILTER (class = 'Double+') AS double_count
        FROM classed c JOIN fx_region_area a ON a.acronym = c.acronym AND a.hemisphere = c.hemisphere
        GROUP BY c.animal, c.section, c.hemisphere, c.acronym""",
    "present": "SELECT DISTINCT section, acronym FROM region_rows",
    "frontier": """SELECT p.section, p.acronym FROM present p WHERE NOT EXISTS (
        SELECT 1 FROM present q JOIN closure c ON c.descendant = q.acronym
        WHERE q.section = p.section AND c.ancestor = p.acronym AND c.distance > 0)""",
    "pairs": """SELECT f.section, c.ancestor AS region, f.acronym AS leaf FROM frontier f
        JOIN closure c ON c.descendant = f.acronym WHERE f.acronym NOT IN (SELECT acronym FROM exclc)""",
    "readout0": """SELECT r.section, p.region, r.hemisphere AS hs, sum(r.area_mm2) AS area_mm2,
        CAST(sum(r.anchor_count) AS BIGINT) AS anchor_count, CAST(sum(r.fos_pos_count) AS BIGINT) AS fos_pos_count,
        CAST(sum(r.tdt_pos_count) AS BIGINT) AS tdt_pos_count, CAST(sum(r.double_count) AS BIGINT) AS double_count
        FROM region_rows r JOIN pairs p ON r.section = p.section AND r.acronym = p.leaf
        GROUP BY GROUPING SETS ((r.section, p.region, r.hemisphere), (r.section, p.region))""",
    "readout": """SELECT split_part(r.section, '_', 1) AS animal, r.section, r.region,
        CASE WHEN hs IS NULL THEN 'both' ELSE left(hs, 1) END AS hemisphere,
        CASE WHEN EXISTS (SELECT 1 FROM frontier f WHERE f.section = r.section AND f.acronym = r.region)
             THEN 'leaf' ELSE 'summary' END AS level,
        area_mm2, anchor_count, fos_pos_count, tdt_pos_count, double_count FROM readout0 r""",
    "animals": """SELECT animal, region, hemisphere, sum(area_mm2) AS area_mm2,
        CAST(sum(anchor_count) AS BIGINT) AS anchor_count, CAST(sum(fos_pos_count) AS BIGINT) AS fos_pos_count,
        CAST(sum(tdt_pos_count) AS BIGINT) AS tdt_pos_count, CAST(sum(double_count) AS BIGINT) AS double_count,
        min(level) AS level, count(DISTINCT section) AS n_slices FROM readout GROUP BY animal, region, hemisphere""",
    "animal_metrics": """SELECT *, CAST(anchor_count AS DOUBLE) AS n FROM animals""",
    "ref": """SELECT * FROM fx_reference QUALIFY row_number() OVER (
        PARTITION BY config_tag, slice, region, marker, class ORDER BY seq DESC) = 1""",
}


def _names() -> dict[str, str]:
    return {**{v: oracle_view(v) for v in VIEWS}, **CTES}


def oracle(body: str) -> str:
    """Prefix ``body`` with every shared piece it mentions, in dependency order."""
    known, order, seen = _names(), [], set()

    def visit(text: str, self_name: str = ""):
        for name in known:
            if name not in seen and name != self_name and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(known[name], name)
                order.append(name)

    visit(body)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({known[n]})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH RECURSIVE {parts},\n{body[5:]}"
    return f"WITH RECURSIVE {parts}\n{body}"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn
    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, integers as BIGINT: the shape both engines are compared in."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)
