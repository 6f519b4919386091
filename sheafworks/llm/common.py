"""Word splitting and hashing of text batches with numpy, and small Spark helpers."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\f\r"
#: Text bytes worked on at a time inside a task.
SLICE_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a concatenation from the hashes of its two parts; order matters."""
    return mix64(left * _ODD + right)


def _byte_values(seed: int, lower: bool) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD + np.uint64(seed))
    if lower:
        values[65:91] = values[97:123]
    return values


_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


class Words:
    """The words of a run of texts: hashes, byte positions and where each text's words begin.

    `hashes[k]` are the word hashes under seed k; `bounds[d]:bounds[d + 1]` are the words of
    text d.
    """

    def __init__(self, texts: pa.Array, seeds: tuple[int, ...] = (1,), lower: bool = False):
        data, offsets = text_buffer(texts)
        self.data, self.offsets = data, offsets
        parts: list[list[np.ndarray]] = [[] for _ in seeds]
        starts: list[np.ndarray] = []
        for begin, end in _blocks(data, offsets):
            block = data[begin:end]
            first, count, places, inner = _word_places(block, offsets, begin)
            starts.append(first + begin)
            for out, seed in zip(parts, seeds, strict=True):
                out.append(_hash_words(block, first, count, places, inner, seed, lower))
        self.starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
        self.hashes = [np.concatenate(p) if p else np.empty(0, np.uint64) for p in parts]
        self.bounds = np.searchsorted(self.starts, offsets)

    def window_starts(self, size: int) -> np.ndarray:
        """First words of all windows of `size` words that lie in one text."""
        inside = np.ones(len(self.starts), bool)
        for back in range(1, size):
            last = self.bounds[1:] - back
            inside[last[last >= self.bounds[:-1]]] = False
        return np.flatnonzero(inside)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offsets of its values; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of bounded size that cut no word (a longer single word stays whole)."""
    begin, size = 0, len(data)
    while begin < size:
        end = min(begin + BLOCK_BYTES, size)
        if end < size:
            spaces = np.flatnonzero(_SPACE[data[begin:end]])
            text = offsets[np.searchsorted(offsets, end, "right") - 1]
            cut = max(begin + int(spaces[-1]) + 1 if len(spaces) else begin, int(text))
            while cut <= begin:
                step = _SPACE[data[end : end + BLOCK_BYTES]]
                following = offsets[np.searchsorted(offsets, end, "left")]
                hit = np.flatnonzero(step)
                stop = min(end + int(hit[0]) if len(hit) else size + 1, int(following))
                cut = stop if stop <= end + len(step) else begin
                end += len(step)
            end = cut
        yield begin, end
        begin = end


def _word_places(block, offsets, begin):
    solid = ~_SPACE[block]
    head = solid.copy()
    head[1:] &= ~solid[:-1]
    own = offsets[np.searchsorted(offsets, begin, "left") : np.searchsorted(offsets, begin + len(block), "left")] - begin
    head[own[solid[own]]] = True
    places = np.flatnonzero(solid)
    first = np.flatnonzero(head)
    order = np.searchsorted(places, first)
    count = np.diff(np.append(order, len(places)))
    inner = np.arange(len(places)) - np.repeat(order, count)
    return first, count, places, inner


def _hash_words(block, first, count, places, inner, seed, lower):
    if not len(first):
        return np.empty(0, np.uint64)
    powers = np.full(int(count.max()) + 1, 0xD6E8FEB86659FD93 + 2 * seed, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = _byte_values(seed, lower)[block[places]] * powers[inner]
    return mix64(np.add.reduceat(values, np.cumsum(count) - count) + count.astype(np.uint64))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` consecutive hashes, built by doubling."""
    have = max(0, len(hashes) - size + 1)
    out, done, step, power = None, 0, 1, hashes
    while done < size:
        if size & step:
            part = power[done : done + have]
            out = part if out is None else join_hashes(out, part)
            done += step
        step *= 2
        if done < size:
            power = join_hashes(power[: -step // 2], power[step // 2 :]) if len(power) > step // 2 else power[:0]
    return out


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each run of `size` consecutive values."""
    return _sliding(values, size, np.minimum)


def sliding_max(values: np.ndarray, size: int) -> np.ndarray:
    return _sliding(values, size, np.maximum)


def _sliding(values, size, best):
    have = len(values) - size + 1
    if have <= 0:
        return values[:0]
    step = 1
    while step * 2 <= size:
        values = best(values[:-step], values[step:])
        step *= 2
    return best(values[:have], values[size - step : size - step + have])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of bounded text bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return np.ascontiguousarray(values).view(np.int64)


def text_of(column: str | Column = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8")) % modulus


def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcasts an object of this package's classes; executors need no copy of the package.

    Only objects of a fixed largest size are shared.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(held: Broadcast):
    """The object behind `share`."""
    return pickle.loads(held.value)


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: the lineage ends there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shielded(documents: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `work` makes of the documents, with columns of any other names carried past it unchanged.

    `work` sees doc_id, text and the others under names that no operator uses; it may drop rows and
    change the text. n_chars, where there is one, is the length of the text that comes out.
    """
    names = {c: c if c in ("doc_id", "text") else f"_own{i}" for i, c in enumerate(documents.columns)}
    out = work(documents.select(*(F.col(f"`{c}`").alias(own) for c, own in names.items())))
    columns = [F.col(own).alias(c) for c, own in names.items() if c != "n_chars"]
    out = out.select(*columns, *([F.length("text").cast("long").alias("n_chars")] if "n_chars" in names else []))
    return out.select(*(F.col(f"`{c}`") for c in documents.columns))
