"""Sum-of-squares packing of tokenized documents into sequences of fixed capacity.

Pieces are dealt into groups of bounded size by a hash; each group is packed by one task. There
the pieces come in order of falling length, and each goes to the open bin where the sum of the
squared counts of open bins for each residual gap becomes smallest; a bin is opened when none has
room. A group wastes a few bins at its end, less than one in a thousand.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .bpe import encoder
from .common import slices, text_of, write_once

CAPACITY = 1024
#: What ends each document, in the query's contract.
END_ID = 2
#: Pieces packed by one task.
GROUP = 65_536

PIECE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
_PIECE = pa.list_(
    pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
)
PACKED = "doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n tokens: all full but the first."""
    pieces = -(-n // capacity)
    return [n - capacity * (pieces - 1)] + [capacity] * (pieces - 1) if n else []


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for part in slices(batches):
            rows = []
            for text in part.column("text").to_pylist():
                ids = np.append(coder.encode(text), end_id).astype("<u4")
                start, row = 0, []
                for k, length in enumerate(cut_lengths(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    row.append({"piece": k, "start": start, "length": length, "ids_crc32": crc})
                    start += length
                rows.append(row)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, _PIECE)], ["doc_id", "pieces"])

    return run


def pieces_of(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each row of (doc_id, text); null text is empty.

    A document is its tokens and `end_id`; only one longer than `capacity` is cut.
    """
    kind = dict(documents.dtypes)["doc_id"]
    texts = documents.select("doc_id", text_of().alias("text"))
    rows = texts.mapInArrow(_pieces(path, capacity, end_id), f"doc_id {kind}, pieces {PIECE}")
    return rows.select("doc_id", F.inline("pieces"))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, in the order given."""
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, length in enumerate(lengths.tolist()):
        gaps = count[length:capacity]
        # What the sum changes by when a bin of gap g becomes one of gap g - length.
        after = 2 * count[: capacity - length] + 1
        after[:1] = 0
        change = np.where(gaps > 0, after - 2 * gaps + 1, np.iinfo(np.int64).max)
        best = int(change.argmin()) if len(change) else 0
        if len(change) and gaps[best] > 0:
            gap = length + best
            count[gap] -= 1
            own = open_bins[gap].pop()
        else:
            gap, own = capacity, made
            made += 1
        bins[i], offsets[i] = own, capacity - gap
        if gap > length:
            count[gap - length] += 1
            open_bins[gap - length].append(own)
    return bins, offsets


def _pack_group(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        )
        bins, offsets = sum_of_squares(table.column("length").to_numpy(), capacity)
        group = table.column("_group").to_numpy()
        table = table.drop_columns(["_group"])
        return table.append_column("sequence_id", pa.array((group << 32) + bins)).append_column(
            "offset", pa.array(offsets)
        )

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    Full pieces and copies under ids of their own are dealt out like any other, so no document or copy
    is a hot group. Rows that are equal in id, place and tokens meet in one group. No rows: no rows.
    """
    pieces = write_once(pieces, scratch_path(pieces.sparkSession, "pieces"))
    groups = max(1, -(-pieces.count() // group))
    # The CRC and the place deal out repeated ids.
    dealt = pieces.withColumn("_group", F.expr(f"pmod(xxhash64(doc_id, piece, start, ids_crc32), {groups})"))
    kind = dict(pieces.dtypes)["doc_id"]
    return dealt.groupBy("_group").applyInArrow(_pack_group(capacity), PACKED.format(kind=kind))


def pack_documents(
    documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP
) -> DataFrame:
    """Pieces of all documents with their sequence and place; see `pieces_of` and `pack_pieces`."""
    return pack_pieces(pieces_of(documents, path, capacity, end_id), capacity, group)
