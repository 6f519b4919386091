"""Readers with explicit schemas. All return plain DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .images import image_sizes

CORRUPT = "_corrupt_record"

QUESTION_SCHEMA = "question string, expected_answer string, key_concepts string"
CAPTION_SCHEMA = "image string, caption string"
CHAT_SCHEMA = "image string, conversations array<struct<`from`: string, value: string>>"


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """A CSV table with a header row.

    Big files are split among tasks. `multi_line` is for text with line breaks inside
    quotes; then a file is one task, so such data should come in files of bounded size.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Files that hold one JSON array each. A file is one task; use lines for big data."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines where broken records are kept in `_corrupt_record` instead of failing.

    Files that cannot be read at all are skipped as well; `unread_files` lists them.
    """
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .json(path)
    )


def read_text_files(spark: SparkSession, path: str, suffix: str = ".md", tolerant: bool = False) -> DataFrame:
    """(path, text), one row per file whose name ends in `suffix`, at any depth.

    An unreadable folder is an error. With `tolerant`, single files that vanish or are
    broken are skipped; `unread_files` lists them.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .option("ignoreCorruptFiles", tolerant)
        .option("ignoreMissingFiles", tolerant)
        .text(path, wholetext=True)
    )
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, content), one row per file."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.select("path", "length", "content")


def read_image_sizes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(image, width, height) of the image files below a folder, from their header bytes.

    Broken ones are left out; `unread_files` lists them from the column `path`, which comes last.
    """
    sizes = image_sizes(read_binary_files(spark, path, pattern))
    return sizes.select(F.element_at(F.split("path", "/"), -1).alias("image"), "width", "height", "path")


def unread_files(spark: SparkSession, path: str, read: DataFrame, pattern: str = "*") -> DataFrame:
    """(path, length) of the files below a folder of which `read` (column `path`) holds no row.

    The listing reads no content. An empty file gives no row either and is not listed.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
        .where("length > 0")
    )

    def bare(column: Column) -> Column:
        # One reader gives file:///a, another file:/a.
        return F.regexp_replace(column, "^([a-z0-9+.-]+):/+", "$1:/")

    seen = read.select(bare(F.col("path")).alias("_seen")).distinct()
    return listed.join(seen, bare(F.col("path")) == F.col("_seen"), "left_anti")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """The hand-kept evaluation questions."""
    return read_csv(spark, path, QUESTION_SCHEMA, multi_line=True)


def rejects(df: DataFrame) -> Column:
    """True for records that did not parse."""
    return F.col(CORRUPT).isNotNull()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Gives CPU-heavy work all cores when the input comes in too few pieces.

    A table with at least one scan task per core is returned as it is, so on large data
    there is no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
