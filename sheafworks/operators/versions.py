"""Snapshots: manifests, fingerprints, diffs and reads at a version."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.readers import read_binary_files


def row_hash(*columns: str | Column) -> Column:
    """MD5 over the values, in order; a null is marked, so (null, a) and (a, null) differ."""
    values = (F.col(c) if isinstance(c, str) else c for c in columns)
    return F.md5(F.concat_ws("|", *(F.coalesce(v.cast("string"), F.lit("\0")) for v in values)))


def file_manifest(spark: SparkSession, path: str, dataset: str, version: str, pattern: str = "*") -> DataFrame:
    """One row per file: logical path below `path`, physical path, length, MD5 of the bytes."""
    files = read_binary_files(spark, path, pattern)
    # What follows the root, taken literally: a nested folder of the same name stays in the path.
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/") + "/"
    logical = F.expr("substring(path, locate(root, path) + length(root))")
    files = files.withColumn("root", F.lit(root))
    return files.select(
        F.lit(dataset).alias("dataset"),
        F.lit(version).alias("version"),
        logical.alias("logical_path"),
        F.col("path").alias("physical_path"),
        "length",
        F.md5("content").alias("md5"),
    )


def table_manifest(df: DataFrame, dataset: str, version: str, key: str, content: Column) -> DataFrame:
    """One row per key: the same shape for tables whose rows are the unit of change."""
    return df.select(
        F.lit(dataset).alias("dataset"),
        F.lit(version).alias("version"),
        F.col(key).alias("logical_path"),
        content.alias("md5"),
    )


def snapshot_diff(before: DataFrame, after: DataFrame, key: str = "logical_path", content: str = "md5") -> DataFrame:
    """(key, status): added, removed, changed or same. A null content is a value like any other."""
    old = before.select(key, F.col(content).alias("_old"), F.lit(True).alias("_was"))
    new = after.select(key, F.col(content).alias("_new"), F.lit(True).alias("_is"))
    status = (
        F.when(F.col("_was").isNull(), "added")
        .when(F.col("_is").isNull(), "removed")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "same")
        .otherwise("changed")
    )
    return old.join(new, key, "full").select(key, status.alias("status"))


def has_changed(diff: DataFrame) -> DataFrame:
    """One row: did anything change, and how many rows of each status."""
    names = ("added", "removed", "changed", "same")
    return diff.agg(*(F.count_if(F.col("status") == n).alias(n) for n in names)).withColumn(
        "is_changed", F.col("added") + F.col("removed") + F.col("changed") > 0
    )


def dataset_fingerprint(df: DataFrame, content: Column) -> DataFrame:
    """One row that changes with any row, not with row order: count and sum of 60-bit hashes.

    Partial sums are merged, so nothing is sorted or collected.
    """
    number = F.conv(F.substring(content, 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("hash_sum"),
    )


def at_version(manifest: DataFrame, dataset: str, version: str) -> DataFrame:
    """The manifest rows of one named version."""
    return manifest.where((F.col("dataset") == dataset) & (F.col("version") == version))


def read_version(manifest: DataFrame, dataset: str, version: str, store: DataFrame, content: str = "md5") -> DataFrame:
    """The content a version refers to: its manifest rows joined to the store by hash.

    A manifest row whose content is not in the store is an error; `missing_content` lists them.
    """
    wanted = at_version(manifest, dataset, version)
    lost = F.raise_error(F.concat(F.lit("no content for "), F.coalesce("logical_path", F.lit("a null path"))))
    found = wanted.join(store.withColumn("_stored", F.lit(True)), content, "left")
    return found.where(F.when(F.col("_stored").isNull(), lost.cast("boolean")).otherwise(True)).drop("_stored")


def missing_content(
    manifest: DataFrame, dataset: str, version: str, store: DataFrame, content: str = "md5"
) -> DataFrame:
    """The manifest rows of a version whose content the store does not hold."""
    return at_version(manifest, dataset, version).join(store, content, "left_anti")


def store_files(spark: SparkSession, path: str, store: str, pattern: str = "*") -> None:
    """Adds the files below a folder to a store of contents: rows (md5, length, content) by hash prefix.

    A content that is there already, from another file or an earlier version, is not stored again.
    Files are hashed where they are read; of equal ones the hashes meet, not the contents.
    """
    files = read_binary_files(spark, path, pattern).select("path", "length", F.md5("content").alias("md5"))
    one = files.groupBy("md5").agg(F.min("path").alias("path"))
    if _holds(spark, store):
        one = one.join(spark.read.parquet(store).select("md5"), "md5", "left_anti")
    rows = read_binary_files(spark, path, pattern).join(one, "path").select("md5", "length", "content")
    rows.withColumn("prefix", _prefix("md5")).write.mode("append").partitionBy("prefix").parquet(store)


def _prefix(content: str) -> Column:
    return F.substring(content, 1, 2)


def _holds(spark: SparkSession, store: str) -> bool:
    try:
        return bool(spark.read.parquet(store).columns)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def read_files_at(spark: SparkSession, manifest: DataFrame, dataset: str, version: str, store: str) -> DataFrame:
    """(logical_path, content) of the files of a version, out of a store that `store_files` filled.

    The manifest meets the store by hash and prefix, so no path goes through the driver, and folders
    without a wanted prefix are not opened. A version without rows and a content that is gone are
    errors.
    """
    wanted = at_version(manifest, dataset, version)
    if wanted.isEmpty():
        raise ValueError(f"{dataset} has no version {version}")
    held = spark.read.parquet(store).select("prefix", "md5", "content").withColumn("_stored", F.lit(True))
    lost = F.raise_error(F.concat(F.lit("no content for "), F.coalesce("logical_path", F.lit("a null path"))))
    found = wanted.withColumn("prefix", _prefix("md5")).join(held, ["prefix", "md5"], "left")
    return found.where(F.when(F.col("_stored").isNull(), lost.cast("boolean")).otherwise(True)).select(
        "logical_path", "content"
    )


def lineage_edge(dataset: str, version: str, source: str, source_version: str) -> Column:
    """Which version of which dataset a dataset was built from."""
    return F.struct(
        F.lit(dataset).alias("dataset"),
        F.lit(version).alias("version"),
        F.lit(source).alias("source_dataset"),
        F.lit(source_version).alias("source_data_version"),
    )


def upstream(edges: DataFrame) -> DataFrame:
    """(dataset, version, source_dataset, source_data_version, depth): all a dataset was built from.

    `edges` has a row for each version and what it was built from directly, as `lineage_edge` makes
    them. Rounds of joins follow them; `depth` is the least number of steps. Each round is written
    once, and what is known is not followed again, so circles end. A source that very many are built
    from is one row of `edges` for each of its own sources, so rounds meet it by a broadcast or a skew
    join, never by pairs.
    """
    spark = edges.sparkSession
    node, source = ["dataset", "version"], ["source_dataset", "source_data_version"]
    edges = edges.select(*node, *source).distinct()
    step = edges.select(*(F.col(c).alias(f"_{c}") for c in node), *source)
    known = _written(edges.withColumn("depth", F.lit(1)), spark)
    newest = known
    while not newest.isEmpty():
        further = newest.select(*node, *(F.col(c).alias(f"_at_{c}") for c in source), "depth")
        ends = [F.col(f"_at_{s}").eqNullSafe(F.col(f"_{n}")) for s, n in zip(source, node)]
        found = further.join(step, ends).select(*node, *source, (F.col("depth") + 1).alias("depth")).distinct()
        newest = _written(found.join(known.select(*node, *source), [*node, *source], "left_anti"), spark)
        known = known.union(newest)
    return known


def _written(df: DataFrame, spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "lineage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
