import re

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sheafworks.operators import search
from sheafworks.operators.embedding import HashingModel, embed


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    data += [(60 + i, data[i][1]) for i in range(10)]  # exact copies
    data += [(70, [0.0] * 8), (71, None)]
    return spark.createDataFrame(data, "id bigint, embedding array<double>").repartition(5).cache()


def by_hand(vectors, k, skip_same):
    rows = [(r["id"], np.array(r["embedding"])) for r in vectors.collect() if r["embedding"] and any(r["embedding"])]
    out = set()
    for q, a in rows:
        scored = []
        for i, b in rows:
            if skip_same and i == q:
                continue
            scored.append((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 6), i))
        out |= {(q, i, rank + 1, -s + 0.0) for rank, (s, i) in enumerate(sorted(scored)[:k])}
    return out


def as_set(df):
    return {(r["query_id"], r["neighbour_id"], r["rank"], round(r["score"], 6)) for r in df.collect()}


@pytest.mark.parametrize("skip_same", [True, False])
def test_topk_is_exact_with_ties(vectors, skip_same):
    assert as_set(search.topk_cosine(vectors, vectors, 4, skip_same=skip_same)) == by_hand(vectors, 4, skip_same)


def test_tiles_give_the_same(vectors, monkeypatch):
    monkeypatch.setattr(search, "QUERIES_PER_TILE", 20)
    monkeypatch.setattr(search, "CORPUS_PER_TILE", 25)
    tiled = search.topk_cosine(vectors, vectors, 4, skip_same=True, max_broadcast_bytes=0)
    assert "FlatMapCoGroupsInPandas" in plan_of(tiled) and "CartesianProduct" not in plan_of(tiled)
    assert as_set(tiled) == by_hand(vectors, 4, True)


def test_k_above_corpus_size(vectors):
    few = vectors.where("id < 3")
    assert as_set(search.topk_cosine(few, few, 10)) == by_hand(few, 10, False)


def test_text_ids_and_no_queries(spark, vectors):
    named = vectors.select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("id"), "embedding")
    assert search.topk_cosine(named, named.where("false"), 2).count() == 0
    got = search.topk_cosine(named, named.where("id = 'v3'"), 2, skip_same=True).collect()
    assert got[0]["neighbour_id"] == "v63" and got[0]["score"] == 1.0


def test_corpus_is_not_shuffled(vectors):
    plan = plan_of(search.topk_cosine(vectors, vectors, 3))
    below = plan[plan.index("MapInPandas") :].split("InMemoryTableScan")[0]
    assert "Exchange" not in below and "WindowGroupLimit" in plan


def test_recall(spark):
    exact = spark.createDataFrame([(1, 2), (1, 3)], "query_id int, neighbour_id int")
    found = spark.createDataFrame([("a", 1, 2), ("a", 1, 9), ("b", 1, 2)], "version string, query_id int, neighbour_id int")
    got = {r["version"]: r["recall"] for r in search.recall_at_k(found, exact).collect()}
    assert got == {"a": 0.5, "b": 1.0}


def test_embedding_keeps_columns_and_batches(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "id int, text string")
    rows = {r["id"]: r["embeddings"] for r in embed(df, dim=16).collect()}
    model = HashingModel(16)
    assert rows[1] == pytest.approx(list(model(["a b a"])[0])) and np.linalg.norm(rows[1]) == pytest.approx(1)
    assert rows[2] == rows[3] == [0.0] * 16

    def load():
        def model(texts):
            return np.full((len(texts), 2), len(texts), dtype=np.float32)

        return model

    sizes = embed(spark.range(20).select(F.lit("x").alias("text")).coalesce(1), model_name="sizes", load=load, batch_size=8)
    assert sorted(r["embeddings"][0] for r in sizes.collect()) == [4.0] * 4 + [8.0] * 16


def test_model_runs_once_per_row(spark):
    df = embed(spark.range(5).select(F.lit("x y").alias("text")), dim=4)
    used_twice = df.where(F.col("embeddings").isNotNull()).select(F.size("embeddings"), "embeddings")
    assert plan_of(used_twice).count("ArrowEvalPython") == 1


def test_many_equal_rows_within_a_small_budget(spark, monkeypatch):
    import numpy as np

    from sheafworks.operators import search

    rng = np.random.default_rng(3)
    rows = np.repeat(rng.normal(size=(20, 4)), 50, axis=0)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    ids = rng.permutation(1_000)
    queries, query_ids = rows[::37], ids[::37]
    for budget in (search.SCORE_BYTES, 8 * 1_024 * 64, 8 * 16):
        monkeypatch.setattr(search, "SCORE_BYTES", budget)
        got = search._candidates(query_ids, queries, ids, rows, 7, True)
        assert (got.groupby("query_id").size() == 7).all()
        for q, own in zip(queries, query_ids):
            scores = np.round(rows @ q, 6) + 0.0
            best = sorted((-s, i) for s, i in zip(scores, ids) if i != own)[:7]
            part = got[got["query_id"] == own]
            assert sorted((-s, i) for s, i in zip(part["score"], part["neighbour_id"])) == best


def test_tiles_follow_the_length_of_vectors(spark, monkeypatch):
    from sheafworks.operators import search

    monkeypatch.setattr(search, "TILE_BYTES", 8 * 4 * 10)
    rows = [(i, [float((i * j) % 7 + 1) for j in (1, 2, 3, 5)]) for i in range(45)]
    df = spark.createDataFrame(rows, "id int, embedding array<double>")
    whole = sorted(map(tuple, search.topk_cosine(df, df, 3).collect()))
    assert sorted(map(tuple, search.topk_cosine(df, df, 3, max_broadcast_bytes=0).collect())) == whole


def test_single_precision_only_rules_out(monkeypatch):
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(6_000, 16))
    # Groups of rows that single precision cannot tell apart, and equal ones.
    rows[:600] = np.repeat(rows[:20], 30, axis=0) * (1 + rng.normal(size=(600, 16)) * 1e-6)
    rows[600:1_200] = np.repeat(rows[600:603], 200, axis=0)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    ids = rng.permutation(6_000)
    monkeypatch.setattr(search, "SCORE_BYTES", 8 * 1_024 * 500)
    scored = []
    exact = search._exact
    monkeypatch.setattr(search, "_exact", lambda *a: scored.append(len(a[4])) or exact(*a))
    some = np.r_[0:40, 600:640, 2_000:2_400]
    got = search._candidates(ids[some], rows[some], ids, rows, 5, True)
    assert 0 < sum(scored) < len(some) * len(rows) // 20
    scores = np.round(rows[some] @ rows.T, search.SCORE_DECIMALS) + 0.0
    for n, own in enumerate(ids[some]):
        best = sorted((-s, i) for s, i in zip(scores[n], ids) if i != own)[:5]
        part = got[got["query_id"] == own]
        assert list(zip(-part["score"], part["neighbour_id"])) == best


def test_enough_tile_pairs_for_all_cores(spark, monkeypatch):
    monkeypatch.setattr(search, "LEAST_IN_TILE", 5)
    rows = [(i, [float((i * j) % 11 + 1) for j in (1, 2, 3)]) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, embedding array<double>")
    tiled = search.topk_cosine(df, df, 3, max_broadcast_bytes=0)
    plan = tiled._jdf.queryExecution().optimizedPlan().toString()
    side = int((search.PAIRS_PER_CORE * spark.sparkContext.defaultParallelism) ** 0.5) + 1
    assert re.findall(r"xxhash64\(id#\d+, 42\), (\d+)\)", plan) == [str(min(side, 18))] * 2
    assert sorted(map(tuple, tiled.collect())) == sorted(map(tuple, search.topk_cosine(df, df, 3).collect()))


def test_exact_neighbours_are_searched_for_once(spark, monkeypatch):
    from sheafworks.plans import catalog

    searches = []
    topk = search.topk_cosine
    monkeypatch.setattr(search, "topk_cosine", lambda *a, **b: searches.append(1) or topk(*a, **b))
    plan = plan_of(catalog.retrieval_recall_by_version(spark, "/root/testdata/sf0.001"))
    assert len(searches) == 2 and plan.count("MapInPandas") == 1


def test_known_tokens_are_looked_up_without_a_call(monkeypatch):
    model, asked = HashingModel(16), []
    bucket = HashingModel.bucket
    monkeypatch.setattr(HashingModel, "bucket", lambda self, token: asked.append(token) or bucket(self, token))
    first = model(["a b a", "b c"])
    assert asked == ["a", "b", "c"] and (model(["a b a", "b c"]) == first).all() and len(asked) == 3
