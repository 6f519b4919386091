"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_array(df: DataFrame, keep: list[str], array: Column, position: str, value: str) -> DataFrame:
    """One row per element with its 0-based position; empty arrays give no row.

    The outer form is used on purpose: for the plain form the optimizer adds a filter on
    the size of the array below the generator, which works out the array again twice.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    return rows.where(F.col(position).isNotNull())


def explode_structs(df: DataFrame, keep: list[str], array: Column, fields: list[str]) -> DataFrame:
    """One row per struct of the array, its fields as columns."""
    rows = explode_array(df, keep, array, "_place", "_item")
    return rows.select(*keep, *(F.col(f"_item.{f}").alias(f) for f in fields))
