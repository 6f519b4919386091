"""Count-min sketches of 64-bit hashes, built in parts and merged. Estimates are never too low.

Where only "once" and "twice or more" matter (`build`), the merged sketch is one bit for each cell
and row. `build_counts` keeps one row of cells that count to 255.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mix64, slices

#: Hashes held by one task before they are handed on.
HELD = 1 << 19
#: Each row of the sketch is cut into so many shards of cells.
SHARDS = 32

_CELLS = pa.schema([("shard", pa.int32()), ("cells", pa.binary())])
_ONES = pa.schema([("shard", pa.int32()), ("many", pa.binary())])


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix64(hashes + np.uint64(row + 1)) >> np.uint64(64 - bits)).astype(np.uint32)


def _pack(cells: np.ndarray, bits: int) -> bytes:
    """Sorted cells of a shard: how many lie in each block of 65,536, then their lower halves."""
    blocks = max(1, (1 << (bits - 5)) >> 16)
    return np.bincount(cells >> np.uint32(16), minlength=blocks).astype(np.uint32).tobytes() + cells.astype(np.uint16).tobytes()


def _unpack(packed: bytes, bits: int) -> np.ndarray:
    blocks = max(1, (1 << (bits - 5)) >> 16)
    count = np.frombuffer(packed, np.uint32, blocks)
    high = np.repeat(np.arange(blocks, dtype=np.uint32) << np.uint32(16), count)
    return high + np.frombuffer(packed, np.uint16, offset=4 * blocks)


def _part(hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int, depth: int):
    """The sketch of one task: the sorted cells of each shard, a cell met again comes twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        held: list[np.ndarray] = []
        for part in slices(batches):
            held.append(hashes_of(part))
            if sum(map(len, held)) > HELD:
                yield out(np.concatenate(held))
                held = []
        if held:
            yield out(np.concatenate(held))

    def out(hashes: np.ndarray) -> pa.RecordBatch:
        shards, cells = [], []
        for row in range(depth):
            values = np.sort(_cells(hashes, row, bits))
            keep = np.ones(len(values), bool)
            keep[2:] = values[2:] != values[:-2]
            values = values[keep]
            edges = np.searchsorted(values >> np.uint32(bits - 5), np.arange(SHARDS + 1))
            for k in range(SHARDS):
                if edges[k] < edges[k + 1]:
                    shards.append(row * SHARDS + k)
                    cells.append(_pack(values[edges[k] : edges[k + 1]] & np.uint32((1 << (bits - 5)) - 1), bits))
        return pa.record_batch([pa.array(shards, pa.int32()), pa.array(cells, pa.binary())], schema=_CELLS)

    return run


def _merge(bits: int):
    """Adds up the parts of a shard one after the other; memory is that of the shard's cells."""
    width = 1 << (bits - 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, cells in zip(batch.column("shard").to_pylist(), batch.column("cells"), strict=True):
                count = counts.setdefault(shard, np.zeros(width, np.uint8))
                at = _unpack(cells.as_py(), bits)
                again = at[1:][at[1:] == at[:-1]]
                count[at] = np.minimum(count[at] + 1, 2)
                count[again] = 2
        for shard, count in counts.items():
            many = np.packbits(count > 1).tobytes()
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([many], pa.binary())], schema=_ONES)

    return run


def build(
    texts: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int, depth: int
) -> list[bytes]:
    """The merged sketch of what `hashes_of` makes of batches of `texts` (with a column text).

    Its size is depth * 2^bits bits whatever the data; it is all that comes to the driver.
    """
    if not 8 <= bits <= 32:
        raise ValueError("a sketch has 2^8 to 2^32 cells a row")
    each = texts.mapInArrow(_part(hashes_of, bits, depth), "shard int, cells binary")
    parts = min(depth * SHARDS, max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = each.repartition(parts, "shard").mapInArrow(_merge(bits), "shard int, many binary")
    size = (1 << bits) // 8 // SHARDS
    rows = [bytearray(size * SHARDS) for _ in range(depth)]
    for shard, many in merged.toLocalIterator():
        at = shard % SHARDS * size
        rows[shard // SHARDS][at : at + size] = many
    return [bytes(row) for row in rows]


def _count_part(hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int):
    """One task's counts, as the cells of each shard and a count of up to 255 for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(hashes_of(batch))
            if sum(map(len, held)) > HELD:
                yield out(np.concatenate(held))
                held = []
        if held:
            yield out(np.concatenate(held))

    def out(hashes: np.ndarray) -> pa.RecordBatch:
        cells, n = np.unique(_cells(hashes, 0, bits), return_counts=True)
        n = np.minimum(n, 255).astype(np.uint8)
        edges = np.searchsorted(cells >> np.uint32(bits - 5), np.arange(SHARDS + 1))
        parts = [(k, cells[a:b].tobytes(), n[a:b].tobytes()) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]
        return pa.record_batch(
            [
                pa.array([k for k, _, _ in parts], pa.int32()),
                pa.array([c for _, c, _ in parts], pa.binary()),
                pa.array([n for _, _, n in parts], pa.binary()),
            ],
            ["shard", "cells", "counts"],
        )

    return run


def _merge_counts(bits: int):
    width = 1 << (bits - 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("shard", "cells", "counts")), strict=True):
                own = total.setdefault(shard, np.zeros(width, np.uint8))
                at = np.frombuffer(cells, np.uint32) & np.uint32(width - 1)
                more = own[at].astype(np.uint16) + np.frombuffer(counts, np.uint8)
                own[at] = np.minimum(more, 255).astype(np.uint8)
        for shard, own in total.items():
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["shard", "many"])

    return run


def build_counts(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> bytes:
    """One byte for each of 2^bits cells: the estimated count, 255 for more; the size is fixed by `bits`."""
    if not 8 <= bits <= 28:
        raise ValueError("a sketch of counts has 2^8 to 2^28 cells")
    each = rows.mapInArrow(_count_part(hashes_of, bits), "shard int, cells binary, counts binary")
    parts = min(SHARDS, max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = each.repartition(parts, "shard").mapInArrow(_merge_counts(bits), "shard int, many binary")
    size = (1 << bits) // SHARDS
    found = bytearray(1 << bits)
    for shard, many in merged.toLocalIterator():
        found[shard * size : (shard + 1) * size] = many
    return bytes(found)


def estimated(hashes: np.ndarray, counts: bytes, bits: int) -> np.ndarray:
    return np.frombuffer(counts, np.uint8)[_cells(hashes, 0, bits)]


def maybe_repeated(hashes: np.ndarray, rows: list[bytes], bits: int) -> np.ndarray:
    """True where the estimated count is two or more."""
    found = np.ones(len(hashes), bool)
    for k, row in enumerate(rows):
        cells = _cells(hashes, k, bits)
        bit = np.frombuffer(row, np.uint8)[cells >> np.uint32(3)] >> (np.uint32(7) - (cells & np.uint32(7))).astype(np.uint8)
        found &= (bit & 1) == 1
    return found
