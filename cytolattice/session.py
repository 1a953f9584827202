"""Session helpers: the shared folder, settled intermediate tables and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


#: Paths of settled tables by session, until ``clear_settled``.
_SETTLED: dict[int, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current.removeprefix("file:")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="spark-cytolattice-")
    sc.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, used between the rounds of an iteration."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write a result once to the shared folder and read it back.

    The plan above it starts from a file scan, survives lost executors and is computed once.
    Its size is known, so a join broadcasts it only when it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _SETTLED.setdefault(id(spark.sparkContext), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_alone(spark: SparkSession, build: Callable[[], DataFrame], name: str = "settled") -> DataFrame:
    """Write what ``build`` returns and delete the tables settled on the way, which nothing else may read."""
    paths = _SETTLED.setdefault(id(spark.sparkContext), [])
    before = len(paths)
    out = settle(build(), name)
    passing = paths[before:-1]
    del paths[before:-1]
    _delete(spark, passing)
    return out


def _delete(spark: SparkSession, paths: list[str]) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        at = hadoop(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_settled(spark: SparkSession) -> int:
    """Delete the tables settled so far in this session and return their number; results that still read them must be consumed first."""
    done = _SETTLED.pop(id(spark.sparkContext), [])
    _delete(spark, done)
    return len(done)
