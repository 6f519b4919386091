"""Each operator against a brute-force version on small tables with nulls, ties and repeated rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from sheafworks.llm import (
    bpe,
    class_lm,
    common,
    fingerprints,
    line_dedup,
    ngram_join,
    packing,
    quality_rules,
    sharding,
    substring_dedup,
    toxicity,
)
from sheafworks.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, n_words string, kept int"


def words(text):
    return WORD.findall(text or "")


def make(rng, n=60):
    """Texts with shared runs, repeated lines and rows, null and empty ones."""
    vocabulary = ["a", "B", "ccé", "#d", "the"] + [f"w{i}" for i in range(40)]
    line = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 14))) for _ in range(25)]
    rows = [(i if i % 9 else None, "\n".join(rng.choice(line) for _ in range(rng.randint(0, 9)))) for i in range(n)]
    rows += [(3, None), (4, ""), (5, " \n\t"), rows[1], rows[1], (900, rows[2][1].upper()), (901, "x " * 300)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(d, t, f"h{(d or 0) % 3}" if d else None, "clash", 1) for d, t in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    return make(random.Random(7))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [(1, "x")]).where("doc_id = 0")


def same(got, wanted):
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_word_hashes_name_words(rows, block, monkeypatch):
    monkeypatch.setattr(common, "BLOCK_BYTES", block)
    np.seterr(over="ignore")
    found = common.Words(pa.array([t for _, t in rows]))
    names = {}
    for i, (_, text) in enumerate(rows):
        own = found.hashes[0][found.bounds[i] : found.bounds[i + 1]]
        for word, value in zip(words(text), own, strict=True):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


# 1


def test_tree_joins_equal_whole_encoding():
    path = bpe.vocabulary_path()
    coder = bpe.encoder(path)
    rng = random.Random(1)
    parts = ["a", "th", " ", "  ", "\n", "'s", "'", "12", "!", "<|endoftext|>", "<|endo", "é", "日本", "😀", "ab" * 90]
    for _ in range(250):
        some = rng.sample(parts, rng.randint(1, 6))
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 150)))
        wanted = coder.slow.encode(text, add_special_tokens=False).ids
        assert coder.encode(text).tolist() == wanted
        assert bpe.encode_long(coder, text, rng.choice([1, 3, 40]), rng.choice([2, 8, 64])).tolist() == wanted
        assert coder.decode(np.array(wanted, np.int64)) == coder.slow.decode(wanted, skip_special_tokens=False)


def test_encode_documents(spark, docs, rows, nothing):
    path = bpe.vocabulary_path()
    coder = bpe.encoder(path)
    got = bpe.encode_documents(docs, path, bpe.token_ids, bpe.IDS_SCHEMA, piece_chars=50)
    wanted = [(d, coder.slow.encode(t or "", add_special_tokens=False).ids, t or "") for d, t in rows]
    same([tuple(r) for r in got.collect()], wanted)
    back = bpe.decode_documents(got.select("ids"), path).select("decoded").collect()
    same([r[0] for r in back], [t or "" for _, t in rows])
    assert bpe.encode_documents(nothing, path, bpe.digests, bpe.DIGEST_SCHEMA).count() == 0


# 2


def test_fingerprints(spark, docs, rows, nothing, monkeypatch):
    got = fingerprints.add_fingerprints(docs).select("text", "fingerprint").collect()
    by_text = collections.defaultdict(set)
    for text, found in got:
        by_text[text or ""].add(found)
    assert all(len(v) == 1 for v in by_text.values()) and by_text[""] == {""}
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    monkeypatch.setattr(fingerprints, "MAX_BOUNDS", 4)
    once = list({d: (d, t) for d, t in rows}.values())
    got = fingerprints.compare_with_edits(table(spark, once)).collect()
    order = sorted(once, key=lambda r: (r[0] is None, -(r[0] or 0)))
    wanted = []
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        wanted.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    same([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], wanted)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.compare_with_edits(docs).count() == len(rows)
    assert fingerprints.compare_with_edits(nothing).count() == 0


def test_anchors_do_not_depend_on_context():
    np.seterr(over="ignore")
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh é") for _ in range(3000))
    one, two = fingerprints.fingerprint_arrays(pa.array([text, "prefix " + text]))
    assert fingerprints.likeness(one, one) == 1.0
    assert fingerprints.likeness(one, two) > 0.9
    assert (fingerprints.from_string(fingerprints.to_string(one)) == one).all()


# 3


def test_shards(spark, docs, rows, nothing):
    got = sharding.shard_documents(docs, 4, 64).collect()
    same([(r.doc_id, r.size) for r in got], [(d, len((t or "").encode()) + 1) for d, t in rows])
    assert all(r.text_crc32 >= 0 for r in got)
    places = collections.defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert sharding.shard_documents(nothing, 4, 64).count() == 0


def test_rebalance_moves_slots_only_to_the_new_shard(spark, tmp_path):
    sizes = [(i, 1000 + i % 7, 1) for i in range(512)]
    old = sharding.first_map(sizes, 8, 512)
    new = sharding.rebalance(old, sizes, 9, 512)
    assert {new[s] for s in old if old[s] != new[s]} == {8}
    load = collections.Counter()
    for slot, size, _ in sizes:
        load[new[slot]] += size
    assert max(load.values()) < 1.05 * min(load.values())
    store = sharding.SlotMap(spark, str(tmp_path))
    store.write(1, old, sizes)
    store.write(2, new, sizes)
    assert store.owners(1) == old and store.owners(2) == new


# 4


def measures(text):
    text = text or ""
    w = words(text)
    count = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeated = {p for i in range(len(w) - 4) if count[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_measures(docs, rows, nothing):
    got = quality_rules.document_verdicts(docs).collect()
    same([(r.doc_id, *(r[m] for m in quality_rules.MEASURES)) for r in got], [(d, *measures(t)) for d, t in rows])
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    assert quality_rules.document_verdicts(nothing).count() == 0
    assert quality_rules.stage(docs).columns == docs.columns


def test_failed_host_takes_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(30))
    data = [(i, "short" if i < 95 else good, "bad") for i in range(100)]
    data += [(100 + i, "short" if i < 3 else good, f"h{i % 5}") for i in range(400)] + [(1000, good, None)]
    got = quality_rules.document_verdicts(spark.createDataFrame(data, "doc_id long, text string, source string"))
    kept = {r.doc_id for r in got.where("kept").collect()}
    assert kept == {*range(103, 500), 1000}


# 5


def test_packing(docs, rows, nothing):
    path = bpe.vocabulary_path()
    coder = bpe.encoder(path)
    got = packing.pack_documents(docs, path, capacity=64, group=50).collect()
    wanted = []
    for d, t in rows:
        ids, start = np.append(coder.encode(t or ""), 2).astype("<u4"), 0
        for k, length in enumerate(packing.cut_lengths(len(ids), 64)):
            wanted.append((d, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            start += length
    same([tuple(r)[:5] for r in got], wanted)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack_documents(nothing, path).count() == 0


def test_sum_of_squares_wastes_little():
    lengths = np.sort(np.random.default_rng(1).integers(1, 1025, 4000))[::-1]
    bins, _ = packing.sum_of_squares(lengths, 1024)
    assert bins.max() + 1 <= 1.01 * -(-lengths.sum() // 1024)


# 6


def test_class_lm(spark, docs, rows, nothing):
    train = docs.where(common.id_remainder(7) != 2)
    model, counts = class_lm.train(train, head=20, known=30, classes=4)
    got = class_lm.score_documents(docs, model, counts).collect()
    tokens = [(d, words((t or "").translate(LOWER)) + [None]) for d, t in rows]
    c = collections.Counter()
    for d, t in tokens:
        if zlib.crc32(str("" if d is None else d).encode()) % 7 != 2:
            c.update(t)
    n, v = sum(c.values()), len(c)
    wanted = [
        (d, len(t), sum(c[x] > 0 for x in t), round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), 6)) for d, t in tokens
    ]
    same([(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got], wanted)
    assert model.tokens == n and all(r.score < 0 for r in got)
    assert np.allclose(model.moves.sum(1), 1)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    empty, counts = class_lm.train(nothing)
    assert class_lm.score_documents(nothing, empty, counts).count() == 0
    assert class_lm.score_documents(docs, empty, counts).count() == len(rows)


def test_every_training_word_has_a_class_by_its_neighbours(spark):
    rng = random.Random(6)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "ab"]
    turn = [["the"], kinds[0] + ["a0"] * 20, ["is"], kinds[1] + ["b0"] * 20]
    texts = [" ".join(rng.choice(own) for _ in range(20) for own in turn) for _ in range(40)]
    docs = spark.createDataFrame([*enumerate(texts), (90, "the zzz a1 b1 b2 is"), (90, "the zzz a1 b1 b2 is")], "doc_id long, text string")
    train = docs.where("doc_id < 90")
    model, counts = class_lm.train(train, head=4, known=20, classes=4)
    np.seterr(over="ignore")
    names = [w for k in kinds for w in k] + ["the", "is", "zzz"]
    hashes = dict(zip(names, common.Words(pa.array(names), lower=True).hashes[0], strict=True))
    own = {r.word: r["class"] for r in counts.collect()}
    known = dict(zip(model.classes.known.words.tolist(), model.classes.of.tolist(), strict=True))
    of = {w: known.get(int(h), own.get(int(h.astype(np.int64)))) for w, h in hashes.items()}
    assert None not in [of[w] for k in kinds for w in k]
    first, second = ({of[w] for w in k} for k in kinds)
    assert not first & second
    # The scores are those of a plain walk through the text.
    c = collections.Counter(w for t in texts for w in t.split())
    place = {int(h): i for i, h in enumerate(model.classes.known.words)}
    rare = model.classes.total - 2
    for r in class_lm.score_documents(docs, model, counts).where("doc_id in (3, 90)").collect():
        text, before, score = texts[3] if r.doc_id == 3 else "the zzz a1 b1 b2 is", rare + 1, 0
        for w in [*text.split(), None]:
            k = rare + 1 if w is None else rare if of[w] is None else of[w]
            base = ((c[w] if w else len(texts)) + 1) / (model.tokens + model.types + 1)
            at = None if w is None else place.get(int(hashes[w]))
            if w is None or at is not None:
                p = model.moves[before, k] * model.emits[-1 if w is None else at]
            else:
                p = model.moves[before, k] * (c[w] - model.discount) / model.sizes[k] if c[w] else model.unseen[before]
            score += math.log10(model.mix * p + (1 - model.mix) * base)
            before = k
        assert abs(score - r.score) < 1e-6


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(3)
    counts = rng.poisson(2, (22, 22)).astype(np.int64)
    counts[:10, 10:20] += 20

    def likelihood(of):
        grid = np.zeros((6, 6))
        of = np.append(of, [4, 5])
        np.add.at(grid, (of[:, None], of[None, :]), counts)
        h = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return h(grid) - h(grid.sum(0)) - h(grid.sum(1))

    steps = [likelihood(class_lm.exchange(counts, 4, sweeps)) for sweeps in range(4)]
    assert steps == sorted(steps) and steps[-1] > steps[0]


# 7


@pytest.mark.parametrize(("size", "bits"), [(35, None), (4, 10), (3, 20)])
def test_repeated_windows(docs, rows, size, bits):
    count = collections.Counter()
    for _, t in rows:
        w = words(t)
        count.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    wanted = []
    for d, t in rows:
        w = words(t)
        gone = {p for i in range(len(w) - size + 1) if count[tuple(w[i : i + size])] > 1 for p in range(i, i + size)}
        wanted.append((d, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    got = substring_dedup.remove_repeats(docs, size, bits)
    same([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()], wanted)


def test_no_rows_no_repeats(nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_with_one_id_and_equal_32_bit_hashes_stay_apart(spark, doc_id):
    clean = "clean3460 other3460 text3460"
    rows = [(doc_id, t) for t in (clean, "p q r s t u v w24640", "p q r s t u v x")]
    got = substring_dedup.remove_repeats(table(spark, rows), 3)
    same([r.kept for r in got.collect()], [clean, "w24640", "x"])


def test_a_hot_window_sends_few_places():
    class Full:
        value = [bytes([255]) * 32]

    n = 500
    batch = pa.record_batch(
        [pa.array(["a b c d"] * n), pa.array(range(n), pa.int64()), pa.array([1] * n, pa.int32())], ["text", "kd", "kt"]
    )
    rows = [r for b in substring_dedup._candidates(4, 8, Full)(iter([batch])) for r in b.to_pylist()]
    places = [[r["kd"], *(m["kd"] for m in r["more"] or [])] for r in rows]
    assert sorted(sum(places, [])) == list(range(n))
    assert len({(r["w1"], r["w2"]) for r in rows}) == len(rows) == 2
    assert min(map(len, places)) == substring_dedup.SENT


# 8


def components(rows, size=5, percent=80):
    sets = []
    for _, t in rows:
        w = words((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    low = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [(d, len(sets[i]), low[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)], [find(i) for i in root]


@pytest.mark.parametrize("block", [4, 2048])
def test_components(spark, rows, block):
    rng = random.Random(4)
    near = list(rows)
    for g in range(4):
        base = [f"v{rng.randint(0, 50)}" for _ in range(60)]
        for i in range(15):
            base = list(base)
            base[rng.randrange(60)] = f"u{i}"
            near.append((2000 + 100 * g + i, " ".join(base)))
    got = ngram_join.component_ids(table(spark, near), block=block).collect()
    same([tuple(r) for r in got], components(near)[0])
    kept = ngram_join.one_of_each(table(spark, near), block=block).collect()
    blank = sum(not words(t) for _, t in near)
    assert len(kept) == blank + len({g for (_, t), g in zip(near, components(near)[1], strict=True) if words(t)})


def test_no_rows_no_components(nothing):
    assert ngram_join.component_ids(nothing).count() == 0


# 9


def test_toxicity(spark, nothing):
    rng = random.Random(5)
    clean = ["river", "stone", "green", "walk", "paper", "music", "table"]
    texts = [(i, " ".join(rng.choice(clean) for _ in range(30)) + (" you vile scumbag" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame([*texts, (None, None), (9999, ""), texts[0]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.held_out_scores(docs, labels).collect()
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert held and all(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert {r.score for r in toxicity.held_out_scores(docs, labels.where("doc_id < 0")).collect()} == {0.5}
    assert toxicity.held_out_scores(nothing, labels).count() == 0


def test_toxicity_rows_of_one_id_count_once_in_the_sample(spark):
    """A third of the rows share a labelled id: the regression's sample has one row of them, the largest."""
    texts = [(i, f"you rotten grub {i % 9}" if i % 4 == 0 else f"a calm day {i % 9}") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    once = spark.createDataFrame(texts, "doc_id long, text string")
    many = spark.createDataFrame(texts + [texts[4]] * 100, "doc_id long, text string").repartition(5)
    plain, repeated = (toxicity.held_out_scores(t, labels).distinct().collect() for t in (once, many))
    assert len(repeated) == len(plain) == 200
    assert all((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in repeated)


# 10


def kept_lines(rows, least=20):
    holders = collections.defaultdict(set)
    key = lambda line: line.strip(common.SPACES).translate(LOWER)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = []
        for line in lines:
            own = holders[key(line)]
            last = max((x for x in own if x is not None), default=None)
            if len(key(line)) < least or len(own) < 3 or d == last:
                stay.append(line)
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@pytest.mark.parametrize(("batches", "fanout"), [(1, 4), (5, 2)])
def test_lines(docs, rows, batches, fanout):
    got = line_dedup.drop_repeated_lines(docs, 20, 3, batches, fanout).collect()
    same([(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got], kept_lines(rows))


def test_no_rows_no_lines(nothing):
    assert line_dedup.drop_repeated_lines(nothing).count() == 0


# The pipeline, and native plans


def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    line = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(12)) for _ in range(60)]
    data = [(i, "\n".join(rng.sample(line, 5)), "en", f"s{i % 3}", 0) for i in range(40)]
    data += [(100, data[7][1], "en", "s0", 0), (101, "too short", "en", "s1", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(d, t) for d, t, *_ in data if not (measures(t)[0] < 10 or 100 * measures(t)[4] > 20 * measures(t)[0])]
    rows = [(d, t) for d, _, _, t in kept_lines(rows)]
    names = [c[2] for c in components(rows)[0]]
    rows = [(d, t) for (d, t), low in zip(rows, names, strict=True) if d == low or not words(t)]
    count = collections.Counter(tuple(words(t)[i : i + 35]) for _, t in rows for i in range(len(words(t)) - 34))
    coder, wanted = bpe.encoder(bpe.vocabulary_path()), []
    for d, t in rows:
        w = words(t)
        gone = {p for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for p in range(i, i + 35)}
        text = " ".join(x for p, x in enumerate(w) if p not in gone)
        wanted.append((d, 0, len(coder.encode(text)) + 1))
    got = corpus_pipeline.run(spark, str(tmp_path))
    same([(r.doc_id, r.piece, r.length) for r in got.collect()], wanted)
    assert len(corpus_pipeline.STAGES) == 5


def test_native_operators_run_no_python(docs):
    from conftest import plan_of

    for df in (quality_rules.document_verdicts(docs), line_dedup.drop_repeated_lines(docs), sharding.shard_documents(docs, 4, 64)):
        plan = plan_of(df)
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_stages_carry_columns_of_any_name(spark, rows):
    """Own columns, named like those the operators work with, come through all stages but the last."""
    names = ["n_words", "kept", "n_removed", "n_lines", "_text", "_kd", "_kt", "_key", "_best", "_copy", "_pos", "_id", "lang"]
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    long = " ".join(f"word{i}" for i in range(60))
    data = rows + [(2000 + i, f"{long} own{i} and so on\nline of its own {i}") for i in range(4)]
    data = [(d, t, f"h{(d or 0) % 3}", 7, *(f"{n} {k}" for n in names)) for k, (d, t) in enumerate(data)]
    docs = spark.createDataFrame(data, schema)
    given = {tuple(r[4:]): r for r in data}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.write_once(stage(spark, docs, ""), scratch_path(spark, "carried"))
        assert docs.columns == ["doc_id", "text", "source", "n_chars", *names], name
        found = docs.collect()
        assert found
        for row in found:
            was = given[tuple(row[4:])]
            assert (row["doc_id"], row["source"]) == (was[0], was[2]), name
        if name in ("line_dedup", "substring_dedup"):
            assert all(r["n_chars"] == len(r["text"] or "") for r in found), name


def test_places_of_equal_rows_are_kept_once(spark):
    text = " ".join(f"w{i % 50}" for i in range(60))
    docs = spark.createDataFrame([(None, text)] * 300 + [(i, text) for i in range(150)], "doc_id long, text string")
    found = substring_dedup.repeated_windows(docs, 35).collect()
    assert max(len(r["starts"]) for r in found) <= 26


def test_blocks_of_few_bytes_link_the_same(spark, rows, monkeypatch):
    docs = table(spark, [(d, f"{t or ''} {t or ''} tail {i % 3}") for i, (d, t) in enumerate(rows)])
    wanted = sorted(map(tuple, ngram_join.component_ids(docs).collect()), key=repr)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 600)
    assert sorted(map(tuple, ngram_join.component_ids(docs).collect()), key=repr) == wanted
