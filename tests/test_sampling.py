import hashlib

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sheafworks.operators import ordering as O
from sheafworks.operators import sampling as S


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(997).select((F.col("id") * 7919 % 100003).alias("k"), (F.col("id") % 5).alias("v")).cache()


def hashed(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def test_exact_sizes_and_choice(rows):
    keys = [r["k"] for r in rows.collect()]
    for fraction in (0.0, 0.001, 0.3, 0.5, 0.999):
        for rounding, n in (("floor", int(997 * fraction)), ("round", round(997 * fraction))):
            got = {r["k"] for r in S.sample_exact(rows, "k", fraction, rounding=rounding).collect()}
            assert got == set(hashed(keys)[:n])


def test_full_fraction_is_a_no_op(rows):
    assert S.sample_exact(rows, "k", 1.0) is rows


def test_layout_does_not_matter(rows):
    one = {r["k"] for r in S.sample_exact(rows.coalesce(1), "k", 0.4).collect()}
    many = {r["k"] for r in S.sample_exact(rows.repartition(13), "k", 0.4).collect()}
    assert one == many
    assert one != {r["k"] for r in S.sample_exact(rows, "k", 0.4, seed=7).collect()}


def test_split_is_disjoint_and_complete(rows):
    split = S.split_shuffled(rows, "k", 0.8)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"train": int(997 * 0.8), "val": 997 - int(997 * 0.8)}


def test_split_does_not_move_rows(rows):
    plan = plan_of(S.split_shuffled(rows, "k", 0.8))
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_hot_bucket_gives_the_same_answer(rows):
    """All rows in one bucket: slower, never different."""
    order = {"key": F.col("k")}
    cut = O.cut_point(rows, F.lit(0), order, lambda total: F.floor(total * 0.25))
    keys = sorted(r["k"] for r in rows.collect())
    assert cut["key"] == keys[int(997 * 0.25) - 1]


@pytest.mark.parametrize("per_bucket", [1, 10, 100, 10_000])
def test_range_buckets_keep_order(rows, per_bucket):
    bucket = O.range_bucket(rows, "k", per_bucket)
    pairs = [(r["k"], r["b"]) for r in rows.select("k", bucket.alias("b")).collect()]
    pairs.sort()
    assert all(a[1] <= b[1] for a, b in zip(pairs, pairs[1:]))
    placed = O.with_position(rows, "k", bucket=bucket)
    got = sorted((r["k"], r["position"]) for r in placed.collect())
    assert [p for _, p in got] == list(range(997))


def test_position_of_text_keys(spark):
    df = spark.range(500).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("name"))
    placed = O.with_position(df, "name", bucket=O.range_bucket(df, "name", 20))
    got = {r["name"]: r["position"] for r in placed.collect()}
    assert got == {name: i for i, name in enumerate(sorted(got))}


def test_split_by_order_and_first(rows):
    keys = sorted(r["k"] for r in rows.collect())
    train = {r["k"] for r in S.split_by_order(rows, "k", 0.8).where("split = 'train'").collect()}
    assert train == set(keys[: int(997 * 0.8)])
    assert [r["k"] for r in S.first_n(rows, "k", 10).collect()] == keys[:10]
    assert S.first_n(rows, "k", 5000).count() == 997


def test_one_null_key_keeps_the_size_and_shared_keys_at_the_cut_fail(spark):
    import pytest

    from sheafworks.operators import sampling

    df = spark.createDataFrame([(None,), *((i,) for i in range(9))], "k int")
    split = {r["k"]: r["split"] for r in sampling.split_by_order(df, "k", 0.8).collect()}
    assert [split[k] for k in (None, *range(9))] == ["train"] * 8 + ["test"] * 2
    assert sampling.sample_exact(df, "k", 0.3).count() == 3
    nulls = spark.createDataFrame([(None,)] * 3 + [(i,) for i in range(7)], "k int")
    assert sampling.split_by_order(nulls, "k", 0.8).where("split = 'train'").count() == 8
    with pytest.raises(ValueError, match="unique"):
        sampling.split_by_order(nulls, "k", 0.2)
    with pytest.raises(ValueError, match="unique"):
        sampling.sample_exact(spark.createDataFrame([(1,)] * 10, "k int"), "k", 0.3)


@pytest.mark.parametrize("starts", [3, 65_536])
def test_bounds_are_searched_when_there_are_many(spark, rows, monkeypatch, starts):
    monkeypatch.setattr(O, "LITERAL_BOUNDS", 2)
    monkeypatch.setattr(O, "HASH_BUCKETS", starts)
    names = rows.select(F.when(F.col("k") > 3, F.concat(F.lit("f"), F.col("k").cast("string"))).alias("k"))
    names = names.where("k is not null").unionByName(spark.createDataFrame([(None,)], "k string"))
    for df in (rows, names):
        bucket = O.range_bucket(df, "k", 5)
        placed = O.with_position(df.select("k"), "k", bucket=bucket)
        got = {r["k"]: r["position"] for r in placed.collect()}
        keys = sorted((k for k in got if k is not None))
        wanted = [None, *keys] if None in got else keys
        assert got == {k: i for i, k in enumerate(wanted)}
        assert df.select(bucket.alias("b")).distinct().count() > 50
        order = {"key": F.col("k")}
        cut = O.cut_point(df, bucket, order, lambda total: F.floor(total * 0.25))
        assert cut["key"] == wanted[len(wanted) // 4 - 1]


def test_large_hash_buckets_are_counted_again(rows):
    digest = O.hash_rank_key("k", 42)
    order = {"digest": digest, "key": F.col("k")}
    wanted = lambda total: F.floor(total * 0.3)
    plain = O.cut_point(rows, F.lit(0), order, wanted)
    coarse = F.substring(digest, 1, 1)
    found = O.cut_point(rows, coarse, order, wanted, lambda level: F.substring(digest, level + 1, 1), rows_per_bucket=2)
    assert found == plain
