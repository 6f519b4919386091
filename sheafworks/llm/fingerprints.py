"""Document fingerprints from closed syncmers.

A run of K characters is chosen when the smallest hash among its runs of S characters stands at
its first or last place. The choice looks at these K characters only, so a run is chosen in every
text that has it, wherever it stands: an anchor. A fingerprint holds the anchors with the smallest
hashes and their positions; two fingerprints are compared by the anchors they share in one order.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import join_hashes, mix64, slices, sliding_min, text_buffer, text_of, write_once

K, S = 16, 8
#: Anchors in a fingerprint.
ANCHORS = 64
#: Rows in one range of ids, and ranges told apart by collected bounds.
RANGE_ROWS = 512
MAX_BOUNDS = 8192
#: Equal steps between two bounds at most; the table of ranges that travels to all tasks has
#: MAX_BOUNDS * MAX_STEPS rows at most, and beyond that ranges hold more rows (their sort spills).
MAX_STEPS = 16

_LOWEST = -(2**63)


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets of the texts in them)."""
    data, offsets = text_buffer(texts)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    starts = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return points, starts[offsets]


def _syncmers(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, position) of all closed syncmers."""
    if len(points) < K:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    power = mix64(points.astype(np.uint64) + np.uint64(1))
    step, inner = 1, None
    while step < K:
        power = join_hashes(power[:-step], power[step:])
        step *= 2
        inner = power if step == S else inner
    edge = K - S
    least = sliding_min(inner, edge + 1)
    chosen = np.flatnonzero((least == inner[: len(least)]) | (least == inner[edge : edge + len(least)]))
    text = np.searchsorted(bounds, chosen, "right") - 1
    whole = chosen + K <= bounds[text + 1]
    chosen, text = chosen[whole], text[whole]
    return text, power[chosen] >> np.uint64(32), chosen - bounds[text]


def fingerprint_arrays(texts: pa.Array, anchors: int = ANCHORS) -> list[np.ndarray]:
    """For each text its anchors, rows (hash, position) with rising 32-bit hashes.

    A text without a syncmer has one anchor, its own hash; an empty or null one has none.
    """
    points, bounds = _code_points(texts)
    text, value, place = _syncmers(points, bounds)
    n = len(bounds) - 1
    count = np.bincount(text, minlength=n)
    # Long texts: most anchors are far above the smallest ones and need not be sorted.
    limit = np.minimum(2.0**32, 2.0**32 * 4 * anchors / np.maximum(count, 1))
    some = value < limit[text]
    ends, order = _sorted_anchors(text[some], value[some], place[some], n)
    got = [order[ends[i] : ends[i + 1]] for i in range(n)]
    for i in range(n):
        if len(got[i]) < anchors and count[i] > 4 * anchors:
            own = text == i
            got[i] = _sorted_anchors(np.zeros(count[i], np.int64), value[own], place[own], 1)[1]
        got[i] = got[i][:anchors]
        if not len(got[i]) and bounds[i + 1] > bounds[i]:
            raw = points[bounds[i] : bounds[i + 1]].tobytes()
            got[i] = np.array([[int.from_bytes(blake2b(raw, digest_size=4).digest(), "big"), 0]], np.int64)
    return got


def _sorted_anchors(text, value, place, n) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text in rising order, each at its first position."""
    order = np.lexsort((place, value, text))
    text, value, place = text[order], value[order], place[order]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    text = text[keep]
    return np.searchsorted(text, np.arange(n + 1)), np.stack([value[keep].astype(np.int64), place[keep]], 1)


def to_string(anchors: np.ndarray) -> str:
    """Sixteen hexadecimal digits an anchor: eight of the hash, eight of the position."""
    return anchors.astype(">u4").tobytes().hex()


def from_string(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").reshape(-1, 2).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray, anchors: int = ANCHORS) -> float:
    """The estimated share of common anchors that stand in one order, 0 to 1.

    Among the smallest hashes of both texts together, those in both give the Jaccard estimate J;
    only those in the longest common order count. The result is 2 J / (1 + J), the share of the
    mean text. Two empty fingerprints are alike (1); an empty one is unlike any other (0).
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    first = dict(a.tolist())
    second = dict(b.tolist())
    union = sorted(first.keys() | second.keys())
    if len(a) >= anchors or len(b) >= anchors:
        union = union[:anchors]
    common = sorted((first[h], second[h]) for h in union if h in first and h in second)
    chain: list[int] = []
    for _, at in common:
        k = bisect_left(chain, at)
        chain[k : k + 1] = [at]
    share = len(chain) / len(union)
    return 2 * share / (1 + share)


def add_fingerprints(documents: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each text as a string; equal texts have equal ones, empty ones ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for part in slices(batches, text):
            found = [to_string(x) for x in fingerprint_arrays(part.column(text))]
            yield part.append_column(name, pa.array(found, pa.string()))

    kept = documents.drop(name) if name in documents.columns else documents
    kinds = ", ".join(f"`{n}` {kind}" for n, kind in kept.dtypes)
    return kept.mapInArrow(run, f"{kinds}, `{name}` string")


def _range_of(key: Column, bounds: list[int], parts: int) -> Column:
    """The number of a key's range: a binary search over the bounds, then equal steps inside."""
    if not bounds:
        return F.lit(0).cast("long")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    held = F.lit(bounds)

    def step(at: Column, jump: Column) -> Column:
        there = at + jump
        return F.when((there <= len(bounds)) & (F.get(held, F.least(there, F.lit(len(bounds))) - 1) <= key), there).otherwise(at)

    coarse = F.aggregate(F.lit(steps), F.lit(0), step).cast("long")
    if parts == 1:
        return coarse
    low, high = F.get(held, (coarse - 1).cast("int")), F.get(held, coarse.cast("int"))
    share = (key.cast("double") - low) / F.greatest(high.cast("double") - low, F.lit(1.0))
    fine = F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * parts), F.lit(0)), F.lit(parts - 1))
    return coarse * parts + fine.cast("long")


def with_next_text(documents: DataFrame) -> DataFrame:
    """(doc_id, text, next_text) in descending doc_id; the last row is followed by the first.

    Null texts are empty; null ids come last; rows that share an id follow each other by text hash.
    Ids are dealt into ranges (approximate quantiles of the id, never a part of the result), each
    range is sorted by itself, and the first row of each is also given to the end of the range
    before it. Texts are shuffled once.
    """
    rows = documents.select("doc_id", text_of().alias("text"))
    rows = rows.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)))
    total = rows.count()
    ranges = max(1, -(-total // RANGE_ROWS))
    parts = min(MAX_STEPS, -(-ranges // MAX_BOUNDS))
    coarse = min(MAX_BOUNDS, -(-ranges // parts))
    bounds: list[int] = []
    if coarse > 1:
        marks = [i / coarse for i in range(1, coarse)]
        bounds = sorted(set(rows.agg(F.percentile_approx("_key", marks, 10 * MAX_BOUNDS)).first()[0]))
    rows = rows.withColumn("_range", _range_of(F.col("_key"), bounds, parts)).withColumn("_kt", F.xxhash64("text"))
    tops = rows.groupBy("_range").agg(F.max(F.struct("_key", "_kt")).alias("_top"))
    # One row for each range, whatever the number of documents in it.
    order = Window.orderBy("_range")
    ends = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select("_range", "_top", F.coalesce(F.lead("_range").over(order), F.min("_range").over(ends)).alias("_give"))
    tops = write_once(tops, scratch_path(documents.sparkSession, "ranges"))
    tops = F.broadcast(tops.select(F.col("_range").alias("_own"), "_top", "_give"))
    # Expressions on both sides: from plain columns the optimizer would infer a filter that repeats
    # the binary search on the small side, where its input is missing.
    marked = rows.join(tops, F.col("_range") + 1 == F.col("_own") + 1, "left")
    top = F.struct("_key", "_kt") == F.col("_top")
    own = F.struct(F.col("_range").alias("range"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("_give").alias("range"), F.lit(1).alias("guest"))
    marked = marked.select("doc_id", "text", "_key", "_kt", F.inline(F.when(top, F.array(own, guest)).otherwise(F.array(own))))
    place = Window.partitionBy("range").orderBy("guest", F.desc("_key"), F.desc("_kt"))
    return marked.withColumn("next_text", F.lead("text").over(place)).where("guest = 0").select("doc_id", "text", "next_text")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    np.seterr(over="ignore")
    for part in slices(batches):
        texts, following = part.column("text").to_pylist(), part.column("next_text").to_pylist()
        edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
        own = fingerprint_arrays(part.column("text"))
        other = fingerprint_arrays(pa.array(edited, pa.large_string()))
        after = fingerprint_arrays(part.column("next_text"))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([to_string(x) for x in own], pa.string()),
                pa.array([to_string(x) for x in other], pa.string()),
                pa.array([likeness(x, y) for x, y in zip(own, other, strict=True)], pa.float64()),
                pa.array([likeness(x, y) for x, y in zip(own, after, strict=True)], pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def compare_with_edits(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    The edited text has its last floor(n_chars / 2) code points replaced by as many of the next
    document's first ones, or by all of them if they are fewer. No rows: no rows; one row is its
    own next.
    """
    kind = dict(documents.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_next_text(documents).mapInArrow(_compare, schema)
