"""Micro-batch runs of the batch operators over folders that files keep landing in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_parquet(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 1_000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def ingest(
    stream: DataFrame, process: Callable[[DataFrame], DataFrame], table: str, checkpoint: str, source: str | Column = "id"
) -> None:
    """Processes what has landed and stops; `process` is the same function a batch run uses.

    Each micro-batch overwrites its own folders, so a batch that is run again after a
    failure replaces its rows instead of adding them twice. Beside the rows, the batch keeps
    the keys of its documents (`source`, as the rows hold it): one that gives no rows any
    more counts too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{table}/rows/batch_id={batch_id}")
        keys = batch.select((F.col(source) if isinstance(source, str) else source).alias("source")).distinct()
        keys.write.mode("overwrite").parquet(f"{table}/keys/batch_id={batch_id}")

    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_ingested(spark: SparkSession, table: str, schema: T.StructType, source: str = "id") -> DataFrame:
    """Of each document only what its newest batch made of it; rows of older batches are stale.

    `source` names the document key in the rows. Keys are narrow and combined before
    the shuffle; rows are shuffled only where the keys are too many to broadcast.
    """
    batch = T.StructField("batch_id", T.LongType())
    rows = spark.read.schema(T.StructType([*schema.fields, batch])).parquet(f"{table}/rows")
    keys = spark.read.parquet(f"{table}/keys")
    newest = keys.groupBy(F.col("source").alias("_source")).agg(F.max("batch_id").cast("bigint").alias("_batch"))
    same = F.col(source).eqNullSafe(F.col("_source")) & (F.col("batch_id") == F.col("_batch"))
    return rows.join(newest, same, "left_semi").drop("batch_id")


def latest_keys(files: DataFrame, source: str, ts: str, key: str) -> DataFrame:
    """(source, key, ts) of the newest file per source; ties go to the higher key.

    Fixed-size state per source, combined before any shuffle, batch or stream.
    """
    newest = F.max(F.struct(F.col(ts).alias("ts"), F.col(key).alias("key"))).alias("newest")
    return files.groupBy(source).agg(newest).select(source, F.col("newest.key").alias(key), F.col("newest.ts").alias(ts))


def latest_per_source(files: DataFrame, source: str, ts: str, key: str) -> DataFrame:
    """The whole newest row per source.

    The newest keys are found without the text; only their rows are then read in full.
    """
    return files.join(latest_keys(files, source, ts, key).select(key), key, "left_semi")


#: After so many batches the changes of a tracked table are merged into one.
MERGE_EVERY = 16


def track_latest(
    stream: DataFrame, source: str, ts: str, key: str, table: str, checkpoint: str, merge_every: int = MERGE_EVERY
) -> None:
    """Keeps a table of the newest file per source up to date with what has landed.

    The state of a source is one (ts, key), kept by the stream; a batch writes only the sources it
    touched, into a folder of its own, which a batch that runs again replaces. Every `merge_every`
    batches the changes so far become one table, so a read never meets more folders than that. A file
    that lands late and is older than what is known changes nothing.
    """
    spark = stream.sparkSession

    def add(touched: DataFrame, batch_id: int) -> None:
        touched.write.mode("overwrite").parquet(f"{table}/changed/batch_id={batch_id}")
        if (batch_id + 1) % merge_every == 0:
            _tracked(spark, table, source, ts, key).write.mode("overwrite").parquet(f"{table}/merged/upto={batch_id}")

    (
        latest_keys(stream, source, ts, key)
        .writeStream.outputMode("update")
        .foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _tracked(spark: SparkSession, table: str, source: str, ts: str, key: str) -> DataFrame:
    rows = spark.read.parquet(f"{table}/changed")
    try:
        merged = spark.read.parquet(f"{table}/merged")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return latest_keys(rows, source, ts, key)
    last = merged.agg(F.max("upto")).first()[0]
    later = rows.where(F.col("batch_id") > last).drop("batch_id")
    return latest_keys(merged.where(F.col("upto") == last).drop("upto").unionByName(later), source, ts, key)


def read_tracked(spark: SparkSession, table: str, source: str, ts: str, key: str) -> DataFrame:
    """(source, key, ts) after the last batch: the newest merged table and the changes since."""
    return _tracked(spark, table, source, ts, key)
