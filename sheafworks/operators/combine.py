"""Renaming, tagging and stacking of source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_schema(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames and keeps the named columns, in the order given."""
    return df.select(*(F.col(f"`{old}`").alias(new) for old, new in names.items()))


def union_tagged(sources: dict[int, DataFrame], tag: str) -> DataFrame:
    """Stacks the sources by column name, each with its constant tag."""
    tagged = [df.withColumn(tag, F.lit(value)) for value, df in sources.items()]
    return reduce(lambda left, right: left.unionByName(right), tagged)


def decode(code: str | Column, names: dict[int, str]) -> Column:
    """Code to label through a literal map; unknown codes give null."""
    column = F.col(code) if isinstance(code, str) else code
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.element_at(F.create_map(*pairs), column)
