"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from sheafworks.llm import queries, runs
from sheafworks.llm.common import Words


def brute(words, least_words=24, power=3):
    """(start, length, period) of every maximal stretch, by trying every period."""
    best = {}
    for q in range(1, len(words) // power + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least_words, power * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def periodic(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        kind = rng.random()
        if kind < 0.4:
            words += [rng.choice("abc") for _ in range(rng.randint(1, 40))]
        elif kind < 0.8:
            unit = [rng.choice("ab") for _ in range(rng.randint(1, 15))]
            words += (unit * 200)[: rng.randint(5, 120)]
        else:
            words += words[: rng.randint(0, len(words))]
    return words


@pytest.mark.parametrize("least_words,power", [(24, 3), (6, 2), (10, 4)])
def test_runs_of_many_texts(least_words, power):
    rng = random.Random(least_words)
    for _ in range(60):
        texts = [periodic(rng) for _ in range(rng.randint(1, 6))]
        found = runs.runs_of_texts(Words(pa.array([" ".join(t) for t in texts])), least_words, power)
        assert [found.get(k, []) for k in range(len(texts))] == [brute(t, least_words, power) for t in texts]


def test_least_common_prefix():
    assert runs.shared_words(24, 3) == 16
    assert runs.shared_words(6, 2) == 3


def test_positions_keep_order_over_blocks():
    rng = random.Random(2)
    numbers = rng.sample(range(100_000), 5000)
    held, known = runs.Positions(numbers[0]), {numbers[0]}
    for number in numbers[1:]:
        before, after = held.add(number)
        if rng.random() < 0.02:
            assert before == max((k for k in known if k < number), default=None)
            assert after == min((k for k in known if k > number), default=None)
        known.add(number)
    assert list(held) == sorted(known) and held.size == 5000


def test_one_word_over_and_over_is_one_run():
    found = runs.runs_of_texts(Words(pa.array(["a " * 50_000, "", None, "b c " * 3000])))
    assert found == {0: [(0, 50_000, 1)], 3: [(0, 6000, 2)]}


def edited(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = edited(doc_id, text)
    found = brute(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query_on_nulls_ties_and_repeated_rows(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i if i % 8 else None, " \n".join(periodic(rng))) for i in range(150)]
    rows += [(7, None), (8, ""), (9, " \t\n"), (10, "x " * 24), (11, "é é\x85 " * 30), rows[1], rows[1]]
    table = spark.createDataFrame([(d, t, 3, [1], "z") for d, t in rows], "doc_id long, text string, n int, runs array<int>, h string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op13_kruskal_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((expected(d, t) for d, t in rows), key=repr)
    assert any(r[1] > 1 for r in got)


def test_empty_table_and_texts(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert runs.digests(runs.find_runs(runs.with_repeats(nothing), keep_text=False)).collect() == []
    one = spark.createDataFrame([(1, "go " * 30 + "on")], "doc_id long, text string")
    row = runs.find_runs(one).first()
    assert (row["n_words"], row["collapsed"]) == (31, "go on")
    assert [tuple(r) for r in row["runs"]] == [(0, 30, 1)]
