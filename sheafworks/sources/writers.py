"""Sinks. Each writes a folder; `mode` decides what happens to an earlier one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Header, no index column, text exactly as it is (Spark would trim it)."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_splits(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """One folder per split; readers of one split never open the other."""
    df.write.mode(mode).partitionBy(split).parquet(path)


def write_json_splits(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """Nested rows as JSON lines, one folder per split."""
    df.write.mode(mode).partitionBy(split).json(path)


def write_text_documents(
    df: DataFrame, path: str, group: str, text: str = "text", rows_per_file: int = 10_000, mode: str = "overwrite"
) -> None:
    """Text lines in one folder per group; files are bounded so a big group gets many."""
    out = df.select(F.col(group), F.col(text).alias("value"))
    out.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(group).text(path)


def write_entities(df: DataFrame, path: str, repo: str = "repo", mode: str = "overwrite") -> None:
    """One row per entity with its file name and text, in one folder per repository."""
    df.write.mode(mode).partitionBy(repo).parquet(path)


def write_metadata(document: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row document of one JSON string column, as a single text file."""
    document.coalesce(1).write.mode(mode).text(path)
