"""Attach small results to big rows without a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

MAX_LOOKUP_ROWS = 10_000


def scalar_map(small: DataFrame, key: Column, value: Column, max_rows: int = MAX_LOOKUP_ROWS) -> Column:
    """A map column {key: value} built by a scalar subquery over `small`.

    The subquery runs once and its result is a literal for the tasks, so the big side is
    neither shuffled nor joined. Its size is checked where it is built: more than
    `max_rows` entries fail the query with a message instead of growing without limit.
    """
    entries = small.select(F.struct(key.alias("key"), value.alias("value")).alias("entry"))
    bounded = F.when(
        F.count(F.lit(1)) <= max_rows, F.map_from_entries(F.collect_list("entry"))
    ).otherwise(F.raise_error(F.lit(f"lookup table exceeds {max_rows} rows; join it instead")))
    # Only one row past the limit is ever collected.
    return entries.limit(max_rows + 1).agg(bounded.alias("entries")).scalar()


def as_local(small: DataFrame, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """A small result, worked out once and held as a local table that is safe to broadcast.

    At most `max_rows` + 1 rows ever reach the driver; more than `max_rows` is an error.
    """
    rows = small.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        raise ValueError(f"lookup table exceeds {max_rows} rows; join it instead")
    return small.sparkSession.createDataFrame(rows, small.schema)


def settled(result: DataFrame, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """A result worked out once: a broadcast local table, or beyond `max_rows` a written one to join."""
    rows = result.limit(max_rows + 1).toArrow()
    if rows.num_rows <= max_rows:
        return F.broadcast(result.sparkSession.createDataFrame(rows, result.schema))
    path = scratch_path(result.sparkSession, "settled")
    result.write.parquet(path)
    return result.sparkSession.read.parquet(path)


def single_row(one: DataFrame, missing: str) -> Column:
    """The only row of `one` as a struct column; no row is an error with the given message."""
    row = one.select(F.struct(*one.columns).alias("row")).scalar()
    return F.coalesce(row, F.raise_error(F.lit(missing)))
