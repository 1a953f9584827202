"""Section exports arriving as files, kept as a store: the last write per key wins.

Layout below the target: ``batches/batch=N`` holds one delivery each and is overwritten when a batch is played again; ``base/through=N`` holds one
row per key of all batches up to N; ``commits/through=N`` is written last and makes a base count.  A read takes the newest
committed base and only the batches after it, so it does not rank every delivery ever made.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import LongType, StructType

COMPACT_EVERY = 8            # batches after which ``ingest_all`` makes a new base


def _schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or an empty one if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def committed(spark: SparkSession, target: str) -> int:
    """Number of the last batch in the newest committed base; -1 without one."""
    last = _read(spark, f"{target}/commits", StructType().add("through", LongType())).agg(F.max("through")).first()[0]
    return -1 if last is None else last


def stream_sections(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, section: str,
                    files_per_batch: int | None = None):
    """Put every file not seen yet into the store, then stop; a batch that is played again replaces itself."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def deliver(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").partitionBy(section).parquet(f"{target}/batches/batch={number}")

    return (reader.parquet(source).writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _latest(rows: DataFrame, key: list[str], seq: str) -> DataFrame:
    """One row per key: of the greatest ``seq``, and of equal ones of the greatest row hash, so that batching does not matter."""
    order = W.partitionBy(*key).orderBy(F.desc(seq), F.desc(F.xxhash64(*rows.columns)))
    return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def read_store(spark: SparkSession, schema: StructType | str, target: str, key: list[str], seq: str, through: int | None = None) -> DataFrame:
    """The store's rows, one per key; with ``through`` only up to that batch.

    Rows of the base whose key was not delivered again are passed on without a shuffle, as long as the new keys are few enough
    for Spark to broadcast.
    """
    schema = _schema(schema)
    done = committed(spark, target)
    new = _read(spark, f"{target}/batches", StructType(list(schema.fields)).add("batch", LongType())).where(F.col("batch") > done)
    new = new if through is None else new.where(F.col("batch") <= through)
    new = new.select(*schema.names)
    if done < 0:
        return _latest(new, key, seq)
    base = _read(spark, f"{target}/base/through={done}", schema).select(*schema.names)
    again = new.select(*key).distinct()
    same = [base[k].eqNullSafe(again[k]) for k in key]
    return base.join(again, same, "left_anti").unionByName(_latest(base.join(again, same, "left_semi").unionByName(new), key, seq))


def compact(spark: SparkSession, schema: StructType | str, target: str, section: str, key: list[str], seq: str) -> int:
    """Make a base of all batches delivered so far and commit it; returns its last batch.

    A base left by a run that ended before its commit is not read, and is written anew.
    """
    fields = StructType(list(_schema(schema).fields)).add("batch", LongType())
    last = _read(spark, f"{target}/batches", fields).agg(F.max("batch")).first()[0]
    if last is None or last <= committed(spark, target):
        return committed(spark, target)
    read_store(spark, schema, target, key, seq, last).write.mode("overwrite").partitionBy(section).parquet(f"{target}/base/through={last}")
    spark.range(1).write.mode("overwrite").parquet(f"{target}/commits/through={last}")
    return last


def ingest_all(spark: SparkSession, source: str, schema, target: str, checkpoint: str, section: str,
               key: list[str], seq: str, files_per_batch: int | None = None, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Run the stream to completion, compact if ``compact_every`` batches came since the last base, and read the store.

    The result is the same however the deliveries fall into batches; rows not sent again stay.
    """
    stream_sections(spark, source, schema, target, checkpoint, section, files_per_batch).awaitTermination()
    fields = StructType(list(_schema(schema).fields)).add("batch", LongType())
    last = _read(spark, f"{target}/batches", fields).agg(F.max("batch")).first()[0]
    if last is not None and last - committed(spark, target) >= compact_every:
        compact(spark, schema, target, section, key, seq)
    return read_store(spark, schema, target, key, seq)
