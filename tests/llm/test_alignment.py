"""Alignment of two tokenizers against loops over all token pairs."""

import collections
import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from sheafworks.llm import alignment, queries


@pytest.fixture(scope="module")
def both():
    return alignment.pair(alignment.vocabulary_path(), alignment.pieces_path())


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(alignment.vocabulary_path())
    tokenizer.encode_special_tokens = True
    return tokenizer


def spans(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends], ends, strict=False))


def brute(both, plain, rows):
    names = {i: t for t, i in plain.get_vocab().items()}
    letters = alignment._byte_letters()
    counts, held = collections.Counter(), []
    for doc_id, text in rows:
        text = text or ""
        a = plain.encode(" " + text, add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in names[i]) for i in a]
        b_bytes = [both._piece(i) for i in b]
        if b"".join(a_bytes) != b" " + text.encode() or b"".join(b_bytes) != b" " + text.encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        cuts = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        groups = []
        for start, end in zip([0, *cuts], cuts, strict=False):
            own_a = ",".join(str(i) for i, (s, e) in zip(a, a_spans, strict=True) if start <= s and e <= end)
            own_b = ",".join(str(i) for i, (s, e) in zip(b, b_spans, strict=True) if start <= s and e <= end)
            groups.append(f"{own_a}|{own_b}")
        links = [
            (i, j)
            for i, (s, e) in zip(a, a_spans, strict=True)
            for j, (t, f) in zip(b, b_spans, strict=True)
            if s < f and t < e
        ]
        counts.update(set(links))
        held.append((doc_id, len(a), len(b), groups, links))
    most = collections.Counter()
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    return [
        (
            d, a, b, len(groups), len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links),
            ";".join(groups),
        )
        for d, a, b, groups, links in held
    ]


def make(rng):
    pool = ["the ", "ing", "日本語", "  ", "\n", "\t", "é", "<|endoftext|>", "<s>", "<0x41>", "naïve ", "🙂", " ", "a", "0123"]
    pool += ["\x00", "don't ", "ß", "ﬁ", "\r\n", "and", "tokenizer", "ñ"]
    rows = [(i if i % 7 else None, "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows += [(3, None), (4, ""), (5, " "), (6, "word " * 300), (7, "▁ is not kept"), (8, "▁"), (9, "aaaa" * 200)]
    return rows + rows[1:4]


@pytest.mark.parametrize("slice_bytes", [1, 3000, 1 << 24])
def test_groups_and_counts(spark, both, plain, slice_bytes):
    rows = make(random.Random(3))
    table = spark.createDataFrame([(d, t, 1, "p") for d, t in rows], "doc_id long, text string, slice int, pair string")
    got = [tuple(r) for r in alignment.align_documents(table, slice_bytes=slice_bytes).collect()]
    wanted = brute(both, plain, rows)
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert sum(r[1] > 0 for r in got) > 100


def test_query_digests(spark, both, plain, tmp_path):
    rows = make(random.Random(4))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_interval_coalescing(spark, str(tmp_path)).collect()]
    wanted = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute(both, plain, rows)]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_a_third_of_all_rows_equal(spark, both, plain):
    rows = [(None, "the same text")] * 40 + [(i, f"text {i} of its own") for i in range(80)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in alignment.align_documents(table).collect()]
    assert sorted(got, key=repr) == sorted(brute(both, plain, rows), key=repr)


def test_empty_table_and_no_tokens(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(nothing).collect() == []
    bare = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.align_documents(bare).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_packing_of_numbers():
    for values in ([], [0], [5, 0, 4_000_000_000]):
        assert alignment.unpack(alignment.pack(np.array(values, np.int64))).tolist() == values
