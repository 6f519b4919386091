"""Exact, reproducible samples and splits.

Sizes are exact and the chosen rows depend on seed and key alone, not on file layout or
the number of tasks. Choosing is a filter against a cut point, not a sort of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import before_cut, cut_point, hash_bucket, hash_rank_key, range_bucket, with_position


def _floor_share(fraction: float):
    return lambda total: F.floor(total * F.lit(float(fraction)))


def _rounded_share(fraction: float):
    return lambda total: F.bround(total * F.lit(float(fraction)), 0).cast("bigint")


def _chosen(df: DataFrame, key: str, seed: int, wanted) -> Column:
    digest = hash_rank_key(key, seed)
    order = {"digest": digest, "key": F.col(key)}
    cut = cut_point(df, hash_bucket(digest), order, wanted, lambda level: hash_bucket(digest, level))
    return before_cut(df, cut, order)


def sample_exact(df: DataFrame, key: str, fraction: float, seed: int = 42, rounding: str = "floor") -> DataFrame:
    """floor(N*fraction) rows ("floor") or N*fraction rounded half to even ("round").

    `key` must be unique. A fraction of 1 or more returns the input as it is.
    """
    if fraction >= 1.0:
        return df
    wanted = {"floor": _floor_share, "round": _rounded_share}[rounding](fraction)
    return df.where(_chosen(df, key, seed, wanted))


def split_shuffled(
    df: DataFrame,
    key: str,
    fraction: float,
    seed: int = 42,
    names: tuple[str, str] = ("train", "val"),
    column: str = "split",
) -> DataFrame:
    """Marks floor(N*fraction) random rows as the first split and the rest as the second."""
    chosen = _chosen(df, key, seed, _floor_share(fraction))
    return df.withColumn(column, F.when(chosen, names[0]).otherwise(names[1]))


def split_by_order(
    df: DataFrame,
    key: str,
    fraction: float,
    names: tuple[str, str] = ("train", "test"),
    column: str = "split",
) -> DataFrame:
    """Marks the first floor(N*fraction) rows in key order; no shuffle of the rows."""
    order = {"key": F.col(key)}
    first = before_cut(df, cut_point(df, range_bucket(df, key), order, _floor_share(fraction)), order)
    return df.withColumn(column, F.when(first, names[0]).otherwise(names[1]))


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first min(n, N) rows in key order (a top-n, never a full sort)."""
    return df.orderBy(key).limit(n)


def global_row_index(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    return with_position(df, key, name)
