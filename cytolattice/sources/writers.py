"""Sinks: truncate-and-write per section, append with an ingest sequence, upsert, pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import PAIR_METRICS, mm_to_um, nan_to_null

MAX_COLUMNS = 5_000
IDENTITY = ("grp", "animal", "region", "level", "hemisphere", "n_slices", "projects", "N_source")


def write_csv(df: DataFrame, path: str, sep: str = ",", by: list[str] | None = None) -> None:
    """CSV with a header, a folder per value of ``by``; NULL becomes an empty cell."""
    out = df.write.mode("overwrite").option("header", True).option("sep", sep)
    (out.partitionBy(*by) if by else out).csv(path)


def write_sections(df: DataFrame, path: str, by: list[str], table_format: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (the truncate rule per section)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).format(table_format).save(path))


def cells_to_sink(df: DataFrame) -> DataFrame:
    """Undefined measures leave as empty cells."""
    return df.select(*[nan_to_null(f.name).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def append_reference(df: DataFrame, path: str, ingest: int) -> None:
    """Append region x category rows with their ingest sequence, the recency the readers need."""
    df.withColumn("ingest", F.lit(ingest)).write.mode("append").parquet(path)


def region_rows_to_reference(region_rows: DataFrame, categories: dict[str, str]) -> DataFrame:
    """Wide region rows to one row per (region, marker); ``categories`` maps marker to count column."""
    args = ", ".join(f"'{m}', {c}" for m, c in categories.items())
    long = region_rows.select("section", "hemisphere", "acronym", "area_mm2",
                              F.expr(f"stack({len(categories)}, {args}) AS (marker, cnt)"))
    return long.withColumn("density", F.when(F.col("area_mm2") > 0, F.col("cnt") / F.col("area_mm2")))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace all earlier rows with the same key; other rows stay.

    Both need the same columns: ``upsert_table`` sets a table with others aside.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def upsert_table(new: DataFrame, key: str, path: str, earlier: str | None = None) -> bool:
    """Write the next version of a table to ``path``: the one at ``earlier`` with ``new`` upserted.

    An earlier table with other columns is set aside: it stays where it is, and the new version
    holds ``new`` alone.  True if the two were merged.
    """
    old = new.sparkSession.read.parquet(earlier) if earlier else None
    merge = old is not None and set(old.columns) == set(new.columns)
    (upsert(old, new, key) if merge else new).write.parquet(path)
    return merge


def long_order(columns: list[str]) -> list[str]:
    """Identity, then counts, then densities, then metrics."""
    ident = [c for c in IDENTITY if c in columns]
    counts = [c for c in columns if c in ("area_mm2", "N") or c.endswith("_count")]
    dens = [c for c in columns if c.endswith("_density")]
    rest = [c for c in columns if c not in ident + counts + dens]
    return ident + counts + dens + rest


def write_long(df: DataFrame, path: str) -> None:
    write_csv(df.select(*long_order(df.columns)), path)


def wide_pivot(df: DataFrame, metric: str, labels: list[str]) -> DataFrame:
    """Rows are regions, one column per ``group:animal`` label in the given order."""
    return df.groupBy("region").pivot("label", labels).agg(F.first(metric, ignorenulls=True))


def wide_pivots(df: DataFrame, hemisphere: str = "both") -> dict[str, DataFrame]:
    """One pivot per density and metric column.  Labels are columns, so their number is checked."""
    sub = df.where(F.col("hemisphere") == hemisphere)
    label = F.concat_ws(":", "grp", "animal") if "grp" in df.columns else F.col("animal")
    sub = sub.withColumn("label", label)
    labels = [r.label for r in sub.select("label").distinct().orderBy("label").limit(MAX_COLUMNS + 1).collect()]
    if len(labels) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} animals do not fit a wide table; use the long one")
    metrics = [c for c in df.columns if c.endswith("_density") or c in ("tagging_rate", "activity_rate") + PAIR_METRICS]
    names = [f"wide__{m}" for m in metrics]
    if len(set(names)) != len(names):
        raise ValueError("two metrics share a file name")
    return {n: wide_pivot(sub, m, labels) for n, m in zip(names, metrics)}


def write_wide_pivots(df: DataFrame, path: str, hemisphere: str = "both") -> list[str]:
    pivots = wide_pivots(df, hemisphere)
    for name, piv in pivots.items():
        write_csv(piv, f"{path}/{name}")
    return sorted(pivots)


def atlas_cells(df: DataFrame) -> DataFrame:
    """Atlas coordinates from millimetres to micrometres."""
    return df.select("class", mm_to_um("x_mm").alias("atlas_x_um"), mm_to_um("y_mm").alias("atlas_y_um"),
                     mm_to_um("z_mm").alias("atlas_z_um"), "fos_bgsub", "tdt_bgsub", "region_label")


def keep_last(df: DataFrame, key: list[str], seq: str) -> DataFrame:
    """Last write wins per key, by ingest sequence."""
    w = W.partitionBy(*key).orderBy(F.desc(seq))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
