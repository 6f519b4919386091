"""Exact ranks and cut points over tables too big for one sorted partition.

Rows are put into order-preserving buckets; the bucket counts say which bucket holds a
wanted rank and what rank each bucket starts at. Only bucket counts (a bounded table)
are ever windowed as a whole. Bucket bounds decide balance, never the result.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .lookup import settled

HASH_BUCKETS = 65_536
ROWS_PER_BUCKET = 1_000_000
SAMPLED_KEYS_PER_BUCKET = 16
#: Range bounds that are compared in two levels; more are searched by halving.
LITERAL_BOUNDS = 4_096
#: Sixteen-bit levels of a digest that are used.
MAX_LEVELS = 4


def hash_rank_key(key: str | Column, seed: int) -> Column:
    """The seeded random order of a key: the same on every engine, layout and retry."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))


def hash_bucket(digest: Column, level: int = 0) -> Column:
    """Sixteen bits of a digest: 65,536 buckets of equal expected size, and as many in each of them."""
    return F.conv(F.substring(digest, 4 * level + 1, 4), 16, 10).cast("int")


def range_bucket(df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> Column:
    """Order-preserving buckets of about `rows_per_bucket` rows for a unique order key.

    Their number grows with the rows. The bounds come from a sample of the key column and are fixed
    as constants of the plan, so every pass and every retried task sees the same buckets. Up to
    LITERAL_BOUNDS of them each row compares in two levels; more are one array (a key for each million
    rows, so 8 MB for 10^12 rows of a number), which each row searches by halving.
    """
    total = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    buckets = max(-(-total // rows_per_bucket), min(cores, total // SAMPLED_KEYS_PER_BUCKET))
    if buckets <= 1:
        return F.lit(0)
    keys = df.select(F.col(key).alias("key")).where(F.col(key).isNotNull())
    if buckets > LITERAL_BOUNDS:
        return _searched_bucket(keys, key, total, buckets)
    fraction = min(1.0, buckets * SAMPLED_KEYS_PER_BUCKET / total)
    sample = sorted(row[0] for row in keys.sample(fraction, seed=7).collect())
    step = max(1, len(sample) // buckets)
    bounds = sample[step::step]
    if not bounds:
        return F.lit(0)
    # Two levels of bounds: the coarse ones choose which fine ones are compared.
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    coarse = F.lit([group[0] for group in groups[1:]]) if len(groups) > 1 else None
    if coarse is None:
        return F.size(F.filter(F.lit(bounds), lambda bound: bound <= F.col(key)))
    group = F.size(F.filter(coarse, lambda bound: bound <= F.col(key)))
    fine = F.get(F.array(*(F.lit(g) for g in groups)), group)
    return group * width + F.size(F.filter(fine, lambda bound: bound <= F.col(key)))


def _searched_bucket(keys: DataFrame, key: str, total: int, buckets: int) -> Column:
    """The number of bounds up to the key, found by halving in one sorted constant array."""
    kind = dict(keys.dtypes)["key"]
    sample = keys.sample(min(1.0, buckets / total), seed=7).distinct().select(F.col("key").cast("string"))
    found = sample.toArrow().column("key").to_pylist()
    if not found:
        return F.lit(0)
    # One string constant, which the optimizer folds: far smaller a plan than a literal for each bound.
    bounds = F.sort_array(F.from_json(F.lit(json.dumps(found)), "array<string>").cast(f"array<{kind}>"))
    steps = [1 << k for k in reversed(range(len(found).bit_length()))]

    def halve(place: Column, step: Column) -> Column:
        # Beyond the last bound the element is null, which is no step.
        return F.when(F.get(bounds, place + step - 1) <= F.col(key), place + step).otherwise(place)

    return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), halve)


def _bucket_starts(df: DataFrame, bucket: Column) -> DataFrame:
    """(bucket, rows, start, total): one row per bucket, so one for about a million rows."""
    counts = df.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    in_order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.select(
        "bucket",
        "rows",
        F.coalesce(F.sum("rows").over(in_order), F.lit(0)).alias("start"),
        F.sum("rows").over(everything).alias("total"),
    )


def cut_point(
    df: DataFrame,
    bucket: Column,
    order: dict[str, Column],
    wanted: Callable[[Column], Column],
    finer: Callable[[int], Column] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Row | None:
    """The order key of the last of the first n rows; None when n is 0.

    `wanted` gives n from the total row count. Two small jobs over the key columns find
    it: one counts buckets, one ranks the keys of the one bucket that holds the cut. One
    row each comes back, and the caller gets a constant to compare with, so every later
    use of the split sees the same cut and no rows are shuffled or joined for it. A null
    key comes first. Rows on both sides of the cut that share a key are an error, as no
    comparison could part them. With `finer(level)` a bucket of more than `rows_per_bucket` rows is
    counted again in buckets of its own before its keys are ranked.
    """
    part, target, level = df, wanted(F.col("total")), 0
    while True:
        starts = _bucket_starts(part, bucket)
        hit = (
            starts.where((F.col("start") < target) & (target <= F.col("start") + F.col("rows")))
            .select("bucket", "rows", (target - F.col("start")).alias("offset"))
            .first()
        )
        if hit is None:
            return None
        part = part.where(bucket.eqNullSafe(F.lit(hit["bucket"])))
        level += 1
        if finer is None or hit["rows"] <= rows_per_bucket or level == MAX_LEVELS:
            break
        bucket, target = finer(level), F.lit(hit["offset"])
    keys = part.select(*(c.alias(name) for name, c in order.items()))
    place = F.row_number().over(Window.orderBy(*order))
    around = F.col("_place").between(hit["offset"], hit["offset"] + 1)
    found = keys.withColumn("_place", place).where(around).orderBy("_place").drop("_place").collect()
    if len(found) == 2 and found[0] == found[1]:
        raise ValueError("rows on both sides of the cut share a key; the key must be unique")
    return found[0]


def before_cut(df: DataFrame, cut: Row | None, order: dict[str, Column]) -> Column:
    """True for the first n rows in order, false for the rest."""
    if cut is None:
        return F.lit(False)
    types = dict(df.select(*(c.alias(name) for name, c in order.items())).dtypes)
    limits = {name: F.lit(cut[name]).cast(types[name]) for name in order}
    chosen = F.lit(True)
    for name in reversed(order):
        value, limit = order[name], limits[name]
        # Nulls come first: they are below every value, and nothing is below them.
        below = limit.isNotNull() & F.coalesce(value < limit, value.isNull())
        chosen = below | (value.eqNullSafe(limit) & chosen)
    return chosen


def with_position(df: DataFrame, key: str, name: str = "position", bucket: Column | None = None) -> DataFrame:
    """Adds the 0-based place of each row in the order of a unique key.

    One shuffle by bucket; each bucket is ranked alone and moved by its start. The starts (a row for
    about a million rows) travel to every task up to HASH_BUCKETS rows; more are written and joined
    by bucket, as the ranked rows already lie, so that the rows are not shuffled again.
    """
    bucket = range_bucket(df, key) if bucket is None else bucket
    starts = settled(_bucket_starts(df, bucket).select(F.col("bucket").alias("_bucket"), "start"), HASH_BUCKETS)
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    # Exploded, for the optimizer else carries the bucket's expression over to the side of the starts.
    ranked = df.select("*", F.explode(F.array(bucket)).alias("_bucket")).withColumn("_within", within)
    return (
        ranked.join(starts, "_bucket")
        .withColumn(name, F.col("start") + F.col("_within") - 1)
        .select(*df.columns, name)
    )
