"""Removal of repeated passages: a count-min prefilter, then exact grouping.

A window is `size` consecutive words of one text. Every word covered by a window whose word
sequence also starts anywhere else goes.

First pass: each task counts into a count-min sketch, and the sketches are merged cell by cell.
What is counted for a window is its anchor, the smallest hash among its runs of (size + 1) // 2
words. Equal windows have equal anchors at different places, so the merged count of the anchor
is never below the count of the window, and neighbouring windows share most anchors, which makes
the sketch about ten times emptier than one of all windows.

Second pass: windows whose estimate is 2 or more, and only they, are grouped exactly by a
96-bit hash of their words. A sketch that is too small lets more windows pass; it loses none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, join_hashes, mix64, shielded, signed, sliding_max, sliding_min, slices, text_of, window_hashes
from .sketch import build, maybe_repeated

#: Windows held by one task before they are handed on.
HELD = 1 << 19
#: Places of one window that a task sends to where the window is grouped; it deals out the rest by itself.
SENT = 4
DEPTH = 2
#: The largest sketch: 2^30 cells a row, 256 MB of bits for both rows.
MAX_BITS = 30

_PLACE = pa.struct([("kd", pa.int64()), ("kt", pa.int64()), ("pos", pa.int32())])
_WINDOWS = pa.schema(
    [("w1", pa.int64()), ("w2", pa.int32()), *((f.name, f.type) for f in _PLACE), ("more", pa.list_(_PLACE))]
)


def _anchors(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words of the windows, their anchors)."""
    first = words.window_starts(size)
    if not len(first):
        return first, np.empty(0, np.uint64)
    grams = window_hashes(words.hashes[0], (size + 1) // 2)
    return first, sliding_min(grams, size - (size + 1) // 2 + 1)[first]


def _anchor_places(words: Words, size: int) -> np.ndarray:
    """The anchors at each place where a window has one; never too few."""
    first, anchors = _anchors(words, size)
    if not len(first):
        return anchors
    short = (size + 1) // 2
    span = size - short + 1
    grams = window_hashes(words.hashes[0], short)
    # A gram is an anchor if it equals the largest of the minima of the windows around it.
    best = np.zeros(len(grams) + 2 * (span - 1), np.uint64)
    best[first + span - 1] = anchors
    top = sliding_max(best, span)[: len(grams)]
    return grams[(top == grams) & (top > 0)]


def _sketched(size: int):
    return lambda part: _anchor_places(Words(part.column("text")), size)


def sketch_bits(documents: DataFrame, text: str = "text") -> int:
    """About ten cells for each anchor, from the bytes of all texts."""
    total = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return min(MAX_BITS, max(10, math.ceil(math.log2(total / 8 + 1))))


def _candidates(size: int, bits: int, sketch):
    """Windows estimated repeated, grouped inside the task: one row for each different window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        rows = sketch.value
        held: list[tuple[np.ndarray, ...]] = []
        for part in slices(batches):
            words = Words(part.column("text"), seeds=(1, 2))
            first, anchors = _anchors(words, size)
            first = first[maybe_repeated(anchors, rows, bits)]
            if not len(first):
                continue
            text = np.searchsorted(words.bounds, first, "right") - 1
            kd, kt = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[text] for c in ("kd", "kt"))
            w1, w2 = (window_hashes(h, size)[first] for h in words.hashes)
            pos = (first - words.bounds[text]).astype(np.int32)
            held.append((w1, (w2 >> np.uint64(32)).astype(np.uint32).view(np.int32), kd, kt, pos))
            if sum(len(h[0]) for h in held) > HELD:
                yield out(held)
                held = []
        if held:
            yield out(held)

    def out(held) -> pa.RecordBatch:
        w1, w2, *place = map(np.concatenate, zip(*held, strict=True))
        order = np.lexsort((w2, w1))
        w1, w2, place = w1[order], w2[order], [x[order] for x in place]
        first = np.append(True, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]))
        # The task alone knows that a window with many places repeats: all but SENT of them go to a
        # key of their own, so the group of a window in very many texts stays small.
        own = np.flatnonzero(first)
        count = np.diff(np.append(own, len(w1)))
        cut = own[count > 2 * SENT] + SENT
        if len(cut):
            length = count[count > 2 * SENT] - SENT
            far = np.repeat(cut, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            place_key = mix64(place[0][cut].astype(np.int64).view(np.uint64)) + place[2][cut].astype(np.uint64)
            w1[far] = np.repeat(join_hashes(w1[cut], place_key), length)
            first[cut] = True
        head, rest = np.flatnonzero(first), np.flatnonzero(~first)
        # One place stands in the row, further ones of the same window in a list.
        ends = np.searchsorted(rest, np.append(head, len(w1))).astype(np.int32)
        alone = ends[1:] == ends[:-1]
        others = pa.StructArray.from_arrays([pa.array(x[rest]) for x in place], fields=list(_PLACE))
        offsets = pa.array(ends, mask=np.append(alone, False))
        columns = [pa.array(signed(w1[head])), pa.array(w2[head]), *(pa.array(x[head]) for x in place)]
        return pa.record_batch([*columns, pa.ListArray.from_arrays(offsets, others)], schema=_WINDOWS)

    return run


def _cut(size: int, keep_text: bool):
    """Kept text, its hash and the word counts from the text and its repeated windows."""
    fields = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string() if keep_text else pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            found: dict[str, list] = {name: [] for name, _ in fields}
            for text, at in zip(batch.column("_text"), batch.column("_pos"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                words, removed = raw.split(), 0
                if at.is_valid and len(words) >= size:
                    edge = np.zeros(len(words) + 1, np.int32)
                    starts = np.unique(at.values.to_numpy())
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + size, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed = int(gone.sum())
                    stay = np.flatnonzero(~gone).tolist()
                    kept = b" ".join([words[i] for i in stay])
                else:
                    kept = b" ".join(words)
                found["n_words"].append(len(words))
                found["n_removed"].append(removed)
                found["kept"].append(kept.decode() if keep_text else sha256(kept).digest())
            names = [n for n in batch.schema.names if n not in ("_text", "_pos")]
            columns = [batch.column(n) for n in names] + [pa.array(found[n], t) for n, t in fields]
            yield pa.RecordBatch.from_arrays(columns, names + [n for n, _ in fields])

    return run


def _keys(text: str | Column) -> tuple[Column, Column]:
    """Id and text hash; 64 bits of the text, as all rows with a null or the same id share the first."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), F.xxhash64(text)


def repeated_windows(documents: DataFrame, size: int = 35, bits: int | None = None) -> DataFrame:
    """(kd, kt, starts): for each text, by id and text hash, the first words of its repeated windows.

    A window in many texts is first grouped inside each task. A task sends at most 2 * SENT places
    of a window (for each half million windows) to where the window is grouped; further places are
    known to be repeated and travel under keys of their own. Texts with no repeated window give no
    row; equal rows have the same places, which are kept once.
    """
    spark = documents.sparkSession
    texts = documents.select(text_of().alias("text"), F.col("doc_id"))
    bits = sketch_bits(texts) if bits is None else bits
    # At most 256 MB of bits, whatever the data.
    sketch = spark.sparkContext.broadcast(build(texts.select("text"), _sketched(size), bits, DEPTH))
    kd, kt = _keys("text")
    schema = "w1 long, w2 int, kd long, kt long, pos int, more array<struct<kd:long,kt:long,pos:int>>"
    rows = texts.select("text", kd.alias("kd"), kt.alias("kt")).mapInArrow(_candidates(size, bits, sketch), schema)
    n = 1 + F.coalesce(F.when(F.col("more").isNotNull(), F.size("more")), F.lit(0))
    total = F.sum(n).over(Window.partitionBy("w1", "w2"))
    places = F.concat(F.array(F.struct("kd", "kt", "pos")), F.coalesce("more", F.array().cast("array<struct<kd:bigint,kt:bigint,pos:int>>")))
    repeated = rows.withColumn("_all", total).where("_all > 1").select(F.inline(places))
    return repeated.groupBy("kd", "kt").agg(F.collect_set("pos").alias("starts"))


def remove_repeats(
    documents: DataFrame, size: int = 35, bits: int | None = None, keep_text: bool = True
) -> DataFrame:
    """Adds n_words, n_removed and `kept`: the words left, joined by one space (or, without
    `keep_text`, the SHA-256 of that text as binary).

    Words are runs of [^\\x20\\x09-\\x0D] and stay as they are. A null or empty text has no words
    and an empty `kept`; a text of fewer than `size` words loses none. Two rows with the same
    text lose every word that a window covers. Windows that overlap themselves (a word repeated
    over and over) count as starting elsewhere. All other columns, clashing names apart from the
    three added ones, pass through; null ids are allowed.
    """
    added = ("n_words", "n_removed", "kept")
    others = [c for c in documents.columns if c not in added]
    kd, kt = _keys(text_of())
    found = repeated_windows(documents, size, bits).select(
        F.col("kd").alias("_kd"), F.col("kt").alias("_kt"), F.col("starts").alias("_pos")
    )
    left = documents.select(*others, text_of().alias("_text"), kd.alias("_kd"), kt.alias("_kt"))
    both = left.join(found, ["_kd", "_kt"], "left").select(*others, "_text", "_pos")
    if not keep_text:
        others = [c for c in others if c != "text"]
        both = both.drop("text") if "text" in both.columns else both
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name in others)
    kept = "string" if keep_text else "binary"
    return both.mapInArrow(_cut(size, keep_text), f"{kinds}, n_words long, n_removed long, kept {kept}")


def stage(documents: DataFrame) -> DataFrame:
    """The documents with the words of repeated passages gone; the words left are joined by one space.

    Columns of any other names stay as they are; n_chars follows the text.
    """
    return shielded(documents, lambda docs: remove_repeats(docs).withColumn("text", F.col("kept")))
