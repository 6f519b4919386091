import json
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafworks.operators import combine, profile
from sheafworks.plans import datasets


def test_describe_values_with_a_hot_value_and_nulls(spark):
    rng = np.random.default_rng(0)
    data = {"a": list(rng.normal(size=1001)), "b": [1.5] * 700 + list(rng.normal(size=300)), "c": [3.0], "d": []}
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "k string, value double").repartition(4)
    got = {r["k"]: r for r in profile.describe_values(df, ["k"]).collect()}
    for k in "abc":
        assert got[k]["n"] == len(data[k])
        assert got[k]["median"] == pytest.approx(statistics.median(data[k]), abs=0)
        assert got[k]["mean"] == pytest.approx(np.mean(data[k]))
    assert got["a"]["std"] == pytest.approx(np.std(data["a"], ddof=1))
    assert got["c"]["std"] is None
    assert got["d"]["n"] == 0 and got["d"]["median"] is None
    population = {r["k"]: r["std"] for r in profile.describe_values(df, ["k"], population=True).collect()}
    assert population["a"] == pytest.approx(np.std(data["a"]))


@pytest.mark.parametrize("cells", [4, 4096])
def test_median_over_many_passes(spark, monkeypatch, cells):
    monkeypatch.setattr(profile, "CELLS", cells)
    monkeypatch.setattr(profile, "POWER_CELLS", min(cells, 64))
    rng = np.random.default_rng(1)
    data = {
        "even": [float(i * 37 % 20_000) for i in range(20_000)],
        "odd": [float(i * 37 % 20_001) for i in range(20_001)],
        "scales": [float(s * 10.0**e) for e in range(-300, 300) for s in (-1, 1)] + [0.0, -0.0, 0.0],
        "far": [1e300, -1e300, float("inf"), float("-inf"), *rng.normal(size=1000)],
        "close": list(1 + np.arange(999) * 2.0**-52),
        "ends": [float("-inf")] * 5 + [float("inf")] * 4,
        "small": [5e-324, 1e-323, -5e-324],
        "two": [1.0, 2.0],
        "same": [7.0] * 50,
    }
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("same", float("nan")), (None, 3.0)]
    df = spark.createDataFrame(rows, "k string, value double").repartition(4)
    got = {r["k"]: r["median"] for r in profile.describe_values(df, ["k"]).collect()}
    assert got == {k: statistics.median(v) for k, v in data.items()} | {None: 3.0}


def test_median_search_broadcasts_and_ranks_cells_only(spark):
    from conftest import plan_of

    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.rand(3).alias("value"))
    plan = plan_of(profile.describe_values(df, ["k"]))
    assert "percentile" not in plan and "CartesianProduct" not in plan


def test_describe_values_without_keys(spark):
    df = spark.range(10).select(F.col("id").alias("value"))
    assert profile.describe_values(df, []).first()["median"] == 4.5


def test_describe_counts(spark):
    rows = [("t", n) for n in [1, 1, 2, 9, 9, 9]] + [("v", 4)]
    df = spark.createDataFrame(rows, "split string, n int")
    got = {r["split"]: r for r in profile.describe_counts(df, ["split"], ["n"]).collect()}
    assert got["t"]["median"] == 5.5 and got["t"]["std"] == pytest.approx(np.std([1, 1, 2, 9, 9, 9], ddof=1))
    assert got["v"]["std"] is None and got["v"]["min"] == got["v"]["max"] == 4


def test_counts_histogram_and_decode(spark):
    df = spark.createDataFrame([(0,), (2,), (2,)], "label int")
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id int, name string")
    dense = profile.dense_histogram(df, "label", names, "id", "name")
    assert {r["name"]: r["n"] for r in dense.collect()} == {"a": 1, "b": 0, "c": 2}
    assert [tuple(r) for r in profile.value_counts(df, "label", by="frequency").collect()] == [(2, 2), (0, 1)]
    assert [r[0] for r in df.select(combine.decode("label", {0: "red"})).collect()] == ["red", None, None]


def test_corpus_stats_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "text string")
    row = profile.corpus_stats(empty, "text").first()
    assert row["total_files"] == 0 and row["average_lines"] == 0.0 and row["total_size_bytes"] == 0


def test_standardized_features_have_mean_0_std_1(spark):
    df = spark.range(1000).select((F.col("id") * 3.0).alias("a"), F.lit(5.0).alias("c"))
    scaled = profile.standardize(df, ["a", "c"], profile.feature_stats(df, ["a", "c"]))
    row = scaled.agg(F.avg("a").alias("m"), F.stddev_samp("a").alias("s"), F.count("c").alias("n")).first()
    assert row["m"] == pytest.approx(0, abs=1e-12) and row["s"] == pytest.approx(1) and row["n"] == 0


def test_table_metadata(spark):
    one = spark.createDataFrame([(1.0, 5), (2.0, 6)], "acid double, quality int")
    two = spark.createDataFrame([(4.0, 6)], "acid double, quality int")
    df = datasets.tagged_table({0: one, 1: two}, "kind")
    text = datasets.table_metadata(df, "n", "s", "quality", "kind", {0: "red", 1: "white"}).first()[0]
    doc = json.loads(text)
    assert doc["summary"]["quality_distribution"] == {"5": 1, "6": 2}
    assert doc["summary"]["kind_distribution"] == {"red": 2, "white": 1}
    assert doc["summary"]["num_features"] == 2 and doc["schema"]["target"]["range"] == [5, 6]
    assert doc["statistics"]["features"]["acid"]["median"] == 2.0
    assert doc["statistics"]["target"]["median"] == 6.0


def test_text_label_metadata(spark):
    rows = [(i, f"word {'x ' * i}", "joy" if i % 3 else "fear") for i in range(20)]
    raw = spark.createDataFrame(rows, "id int, Sentence string, Label string")
    df = datasets.labelled_text(raw, {"Sentence": "text", "Label": "label"}, "id", 0.5)
    doc = json.loads(datasets.text_label_metadata(df, "n", "s").first()[0])
    assert doc["splits"]["train"]["num_samples"] == 8 and doc["splits"]["val"]["num_samples"] == 2
    assert doc["schema"]["features"]["label"]["classes"] == sorted({r["label"] for r in df.collect()})
    assert set(doc["metrics"]["train"]) >= {"char_length_mean", "word_count_median"}


def test_tensor_metadata(spark):
    rows = [("a", i, [[i, 255], [0, 0]], i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "shard string, idx int, image array<array<smallint>>, label smallint")
    splits = datasets.tensor_splits({"train": df, "val": df.where("idx < 5")}, ["shard", "idx"], 0.6)
    counts = {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()}
    assert counts == {"train": 6, "val": 3}
    doc = json.loads(datasets.tensor_metadata(splits, "n", "s", ["even", "odd", "never"]).first()[0])
    assert doc["schema"]["shape"] == [2, 2]
    assert doc["splits"]["train"]["class_distribution"]["never"] == 0
    assert doc["metrics"]["train"]["pixel_max"] == 1.0
    pixels = [p / 255 for r in splits.where("split = 'train'").collect() for line in r["image"] for p in line]
    assert doc["metrics"]["train"]["pixel_std"] == pytest.approx(np.std(pixels))
    assert doc["metrics"]["train"]["pixel_median"] == pytest.approx(np.median(pixels))


def test_counts_of_fractions_and_of_large_numbers(spark):
    from sheafworks.operators import profile

    df = spark.createDataFrame([(0.5,), (1.5,), (2.9,), (None,)], "x double")
    row = profile.describe_counts(df, [], ["x"]).first()
    assert (row["metric"], row["n"], row["min"], row["max"], row["median"]) == ("x", 3, 0.5, 2.9, 1.5)
    assert abs(row["mean"] - 4.9 / 3) < 1e-12 and abs(row["std"] - 1.2055427546683415) < 1e-12
    big = spark.createDataFrame([(10**15 + i,) for i in (1, 2, 3)], "x bigint")
    row = profile.describe_counts(big, [], ["x"]).first()
    assert (row["std"], row["median"], row["max"]) == (1.0, 10**15 + 2, 10**15 + 3)


def test_more_groups_than_a_broadcast_takes(spark):
    from sheafworks.operators import profile

    df = spark.range(20_002).selectExpr("id % 10001 k", "cast(id as double) value")
    rows = profile.describe_values(df, ["k"]).collect()
    assert len(rows) == 10_001
    assert all(r["median"] == r["k"] + 5_000.5 and r["n"] == 2 for r in rows)


def test_moments_are_the_mean_and_std_of_the_statistics(spark):
    from sheafworks.operators import profile

    df = spark.createDataFrame([(1.0, None), (4.0, 2.0), (float("nan"), 2.5)], "a double, `b c` double")
    wanted = {r["feature"]: (r["mean"], r["std"]) for r in profile.feature_stats(df, ["a", "b c"]).collect()}
    assert {r["feature"]: (r["mean"], r["std"]) for r in profile.moments(df, ["a", "b c"]).collect()} == wanted
