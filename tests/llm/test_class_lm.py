"""Sweeps, look-up and estimator of the class-based model against plain versions."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest

from sheafworks.llm import class_lm


def _words(texts):
    """Counts and, for each word, its rank as the model ranks them (None ends a text)."""
    return collections.Counter(w for t in texts for w in [*t.split(), None])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    names = [f"{k}{i}" for k in "abcd" for i in range(40)]
    weights = [1 / (1 + i % 40) for i in range(len(names))]
    order = {"a": "b", "b": "c", "c": "d", "d": "a"}
    out = []
    for _ in range(60):
        kind, text = rng.choice("abcd"), []
        for _ in range(rng.randrange(1, 60)):
            text.append(rng.choices([n for n in names if n[0] == kind], [w for n, w in zip(names, weights, strict=True) if n[0] == kind])[0])
            kind = order[kind] if rng.random() < 0.9 else rng.choice("abcd")
        out.append(" ".join(text))
    return [*out, "", "once_only_1 once_only_2 once_only_3"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("size", [0, 1, 7, 5000])
def test_known_words_are_found_at_their_rank(size):
    rng = np.random.default_rng(2)
    words = np.unique(rng.integers(0, 2**64 - 1, size, np.uint64))
    crowded = words[: size // 2] >> np.uint64(40)  # all in the same list
    words = rng.permutation(np.unique(np.append(words, crowded)))
    known = class_lm.Known(words, np.ones(len(words), np.int64))
    other = rng.integers(0, 2**64 - 1, 3000, np.uint64)
    tokens = rng.permutation(np.concatenate([words, other, [class_lm.END]]))
    place = {int(w): i for i, w in enumerate(words)}
    assert known.place(tokens).tolist() == [place.get(int(t), len(words)) for t in tokens]


def test_numbers_come_back_from_planes():
    values = np.array([0, 1, 255, 256, 70_000, 2**31, 2**32 - 1])
    assert class_lm._from_planes(class_lm._planes(values), len(values)).tolist() == values.tolist()


def test_probabilities_sum_to_one_for_any_number_of_known_words(docs, texts):
    """The same estimator with all words known, with some, and with none beyond the head."""
    for known in (8, 30, 1000):
        model, rest = class_lm.train(docs, head=8, known=known, classes=5)
        rest = rest.collect()
        assert len(rest) + len(model.classes.known.words) + 1 == model.types == len(_words(texts))
        assert sum(model.sizes) == model.tokens - len(texts)
        end = model.moves[:, -1] * model.emits[-1]
        seen = np.zeros(model.classes.total)
        for k, n in [*zip(model.classes.of, model.classes.known.counts, strict=True), *((r["class"], r.n) for r in rest)]:
            assert k < 5
            seen += model.moves[:, k] * (n - model.discount) / model.sizes[k]
        assert np.allclose(seen + end + model.unseen, 1)
        assert model.unseen.min() > 0


def test_a_sweep_moves_each_word_to_its_best_class(docs, texts):
    """Against a plain walk: move one word, count the class bigrams anew, take the largest likelihood."""
    model, _ = class_lm.train(docs, head=6, known=60, classes=4, sweeps=0)
    chosen = model.classes
    total = chosen.total
    grid = class_lm.neighbour_counts(docs, chosen, total)
    moved = class_lm.sweep(docs, chosen, grid)

    def h(x):
        return x * math.log(x) if x > 1 else 0.0

    hashes = {}
    for t in texts:
        for w in t.split():
            hashes[w] = int(class_lm._tokens(class_lm.pa.array([w]))[0][0])
    place = {int(h): i for i, h in enumerate(chosen.known.words)}
    rank = {w: place.get(x) for w, x in hashes.items()}

    def classes(of):
        for t in texts:
            yield [total - 1, *(total - 2 if rank[w] is None else of[rank[w]] for w in t.split()), total - 1]

    plain = np.zeros((total, total), np.int64)
    for row in classes(chosen.of):
        np.add.at(plain, (row[:-1], row[1:]), 1)
    assert (plain == grid).all()
    checked = 0
    for w, r in rank.items():
        if r is None or any(a == b == w for t in texts for a, b in zip(t.split(), t.split()[1:], strict=False)):
            continue  # a word that follows itself counts as a neighbour of its class so far
        value = []
        for k in range(total - 2):
            of = chosen.of.copy()
            of[r] = k
            table = np.zeros((total, total), np.int64)
            for row in classes(of):
                np.add.at(table, (row[:-1], row[1:]), 1)
            value.append(sum(map(h, table.ravel())) - sum(map(h, table.sum(0))) - sum(map(h, table.sum(1))))
        # Where a word stands on both sides of the same class cell the two parts are added one by one.
        assert value[moved.of[r]] >= max(value) - 2.0
        checked += value[moved.of[r]] >= max(value) - 1e-6
    assert checked >= 40


def test_sweeps_over_all_known_words_raise_the_likelihood(spark):
    """More than 2,048 words, in an order that only the words beyond the head show."""
    rng = random.Random(5)
    kinds = [[f"{k}{i}" for i in range(1500)] for k in "xyz"]
    texts = [" ".join(rng.choice(kinds[i % 3]) for i in range(150)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)

    def score(known, sweeps):
        model, counts = class_lm.train(docs, known=known, classes=8, sweeps=sweeps)
        return class_lm.score_documents(docs, model, counts).groupBy().sum("score").first()[0]

    placed, swept, tail = score(10_000, 0), score(10_000, 2), score(3000, 2)
    assert swept > placed
    assert tail < 0 and tail > placed - abs(placed) * 0.1
