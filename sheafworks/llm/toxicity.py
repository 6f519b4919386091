"""Character n-gram linear classifier with naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of its lower-case characters. Each is scaled by
the log ratio of its document frequencies in both classes, counted over all labelled training
rows; a logistic regression on the scaled features is fitted to a bounded sample of these rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import id_remainder, join_hashes, mix64, share, shared, slices, text_of, write_once
from .fingerprints import _code_points

SIZES = (3, 4, 5)
BITS = 18
#: A feature in fewer labelled documents has no weight.
MIN_DOCS = 3
#: The logistic regression is fitted to at most so many labelled rows.
SAMPLE = 2000
#: Label tables of up to so many rows (16 bytes each) travel to all tasks; larger ones are joined.
LOCAL_LABELS = 2_000_000
BLOCKS = 16


def features(texts: pa.Array, bits: int = BITS) -> list[np.ndarray]:
    """The distinct feature numbers of each text, ascending; none for an empty or null one."""
    lower = pa.array([(t or "").lower() for t in texts.to_pylist()], pa.large_string())
    points, bounds = _code_points(lower)
    single = mix64(points.astype(np.uint64) + np.uint64(1))
    grams, run = [], single
    for n in range(2, max(SIZES) + 1):
        run = join_hashes(run[:-1], single[n - 1 :]) if len(run) else run
        if n in SIZES:
            grams.append((n, (run >> np.uint64(64 - bits)).astype(np.int32)))
    seen = np.zeros(1 << bits, bool)
    found = []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        for n, gram in grams:
            seen[gram[begin : max(begin, end - n + 1)]] = True
        own = np.flatnonzero(seen)
        seen[own] = False
        found.append(own.astype(np.int32))
    return found


def _count(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        counts = np.zeros((2, 1 << bits), np.int64)
        rows = np.zeros(2, np.int64)
        for part in slices(batches):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False)
            for own, label in zip(features(part.column("text"), bits), toxic, strict=True):
                counts[int(label), own] += 1
                rows[int(label)] += 1
        if rows.any():
            blocks = counts.reshape(2 * BLOCKS, -1)
            yield pa.record_batch(
                [
                    pa.array(range(2 * BLOCKS), pa.int32()),
                    pa.array([x.tobytes() for x in blocks], pa.binary()),
                    pa.array([int(rows[k // BLOCKS]) if k % BLOCKS == 0 else 0 for k in range(2 * BLOCKS)], pa.int64()),
                ],
                ["block", "counts", "n"],
            )

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    rows: dict[int, int] = {}
    for batch in batches:
        for block, counts, n in zip(*(batch.column(c).to_pylist() for c in ("block", "counts", "n")), strict=True):
            own = np.frombuffer(counts, np.int64)
            total[block] = total[block] + own if block in total else own
            rows[block] = rows.get(block, 0) + n
    yield pa.record_batch(
        [
            pa.array(list(total), pa.int32()),
            pa.array([x.tobytes() for x in total.values()], pa.binary()),
            pa.array([rows[k] for k in total], pa.int64()),
        ],
        ["block", "counts", "n"],
    )


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = np.array([self.weights[own].sum(dtype=np.float64) for own in features(texts, self.bits)]) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_ratios(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per feature log((1 + toxic docs) / (2 + toxic rows)) less that of the other class; 0 if rare."""
    rate = (counts + 1) / (rows[:, None] + 2)
    return np.where(counts.sum(0) >= MIN_DOCS, np.log(rate[1] / rate[0]), 0.0)


def fit_weights(
    ratios: np.ndarray, docs: list[np.ndarray], toxic: np.ndarray, steps: int = 60, rate: float = 0.3, ridge: float = 0.01
) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled features by AdaGrad; both classes weigh the same.

    Deterministic; a class without rows has no say.
    """
    docs = [own[ratios[own] != 0] for own in docs]
    w, b = np.zeros(len(ratios)), 0.0
    if not docs:
        return w, b
    size = np.array([len(own) for own in docs])
    flat, row = np.concatenate(docs), np.repeat(np.arange(len(docs)), size)
    value = ratios[flat]
    weight = np.where(toxic > 0, 0.5 / max(toxic.sum(), 1), 0.5 / max((1 - toxic).sum(), 1))
    w2, b2 = np.full(len(ratios), 1e-6), 1e-6
    for _ in range(steps):
        z = np.bincount(row, value * w[flat], len(docs)) + b
        slip = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic) * weight
        gw = np.bincount(flat, value * slip[row], len(ratios)) + ridge * w
        w2 += gw * gw
        b2 += slip.sum() ** 2
        w -= rate * gw / np.sqrt(w2)
        b -= rate * slip.sum() / np.sqrt(b2)
    return w, float(b)


def train(documents: DataFrame, labels: DataFrame, bits: int = BITS, sample: int = SAMPLE) -> Model:
    """Fits the model to the texts of `documents` (doc_id, text) that `labels` (doc_id, toxic) marks.

    An id labelled more than once counts as toxic if any label says so; labels without a text,
    null ids and null labels are left out. Without labels the model gives 0.5. Counts cover all
    labelled rows; the regression takes the `sample` rows with the smallest id hashes.
    """
    spark = documents.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    known = known.agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = write_once(known, scratch_path(spark, "labels"))
    if known.count() <= LOCAL_LABELS:
        known = F.broadcast(known)
    texts = documents.select("doc_id", text_of().alias("text")).join(known, "doc_id")
    parts = texts.select("text", "toxic").mapInArrow(_count(bits), "block int, counts binary, n long")
    summed = parts.repartition(2 * BLOCKS, "block").mapInArrow(_add, "block int, counts binary, n long")
    counts, rows = np.zeros((2 * BLOCKS, (1 << bits) // BLOCKS)), np.zeros(2)
    for block, own, n in summed.collect():  # two numbers for each feature
        counts[block] = np.frombuffer(own, np.int64)
        rows[block // BLOCKS] += n
    ratios = log_ratios(counts.reshape(2, -1), rows)
    chosen = documents.select("doc_id").join(known, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = spark.createDataFrame(chosen.toArrow(), chosen.schema)
    few = documents.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")

    def own_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for part in slices(batches):
            found = [own.tobytes() for own in features(part.column("text"), bits)]
            yield pa.record_batch([part.column("doc_id"), part.column("toxic"), pa.array(found, pa.binary())], ["doc_id", "toxic", "own"])

    kind = dict(few.dtypes)["doc_id"]
    got = few.mapInArrow(own_features, f"doc_id {kind}, toxic int, own binary")
    # Rows that share an id count once; tasks combine theirs, so that `sample` rows reach the driver.
    got = got.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("own").alias("own")).toArrow()
    kept = sorted(got.to_pylist(), key=lambda r: r["doc_id"])
    weights, bias = fit_weights(ratios, [np.frombuffer(r["own"], np.int32) for r in kept], np.array([r["toxic"] for r in kept], float))
    return Model((weights * ratios).astype(np.float32), bias, bits)


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row of (doc_id, text); a null text scores as the empty one."""
    held = share(documents.sparkSession, model)  # one number for each feature
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        fitted: Model = shared(held)
        for part in slices(batches):
            found = fitted.scores(part.column("text"))
            yield pa.record_batch([part.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return documents.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def held_out_scores(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted; rows with crc32(id) mod 3 = 1 teach nothing."""
    model = train(documents, labels.where(id_remainder(3) != 1))
    scored = score_documents(documents, model)
    return scored.select(
        "doc_id",
        (id_remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
