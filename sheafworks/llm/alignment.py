"""Alignment of two tokenizers' tokens by interval coalescing, with corpus-wide link counts.

Both tokenizers cut the same bytes. All tokens of both are sorted by their start (lexsort), the
largest end so far is kept (maximum.accumulate), and a group ends where a token starts at or beyond
it: there both tokenizers end a token. Inside a group every A token is linked with the B tokens
whose bytes it overlaps.

How many documents hold a pair of ids linked is a count over the corpus. Tasks put documents into
slices of bounded text bytes. A slice has a list of its different pairs, and a document holds places
in that list, so what is shuffled for the counts is one row for each slice and pair, not one for
each document and pair. The counts go back to the slices by the same key, and the documents of a
slice meet the counts of its pairs in one group of bounded size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .bpe import _OLD, Encoder, _byte_letters, vocabulary_path
from .common import slices, text_of, write_once

PIECES = "piece_bpe_32k.model"
#: Text bytes of the documents that share a list of pairs (one document at least).
SLICE_TEXT_BYTES = 24 << 20


def pieces_path(name: str = PIECES) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pair:
    """Both tokenizers: A is byte-level BPE, B sentence pieces, which add a leading space."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = Encoder(a_path)
        self.a.slow.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        named = {i: t for t, i in self.a.slow.get_vocab(with_added_tokens=False).items()}
        # The name of a special token is never met as a token here, so its own letters will do.
        self.a_bytes = [
            bytes(letters[c] for c in named[i]) if i in named else self.a.bytes[i] for i in range(len(self.a.bytes))
        ]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        # Ids as text with the mark that may follow: A's "," and "|", then B's "," and ";".
        self.b_names = 2 * len(self.a_bytes)
        self.names = [f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"]
        self.names += [f"{i}{mark}" for i in range(len(self.b_bytes)) for mark in ",;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def a_ids(self, text: str) -> list[int]:
        if text.isascii() or not _OLD.search(text):
            return self.a.fast.encode_ordinary(text)
        return self.a.slow.encode(text, add_special_tokens=False).ids

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """(A ids, B ids) of each text; none of either where a tokenizer does not keep the bytes."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1) if texts else [], strict=True):
            a = self.a_ids(" " + text) if text else []
            whole = b" " + text.encode()
            keeps = b"".join(map(self.a_bytes.__getitem__, a)) == whole and b"".join(
                map(self.b_bytes.__getitem__, b)
            ) == whole
            out.append((a, b) if keeps else ([], []))
        return out


def pair(a_path: str, b_path: str) -> Pair:
    """One pair of tokenizers for each pair of files and worker process."""
    held = sys.__dict__.setdefault("_sheafworks_pairs", {})
    if (a_path, b_path) not in held:
        held[a_path, b_path] = Pair(a_path, b_path)
    return held[a_path, b_path]


class Coalesced:
    """Groups and links of the tokens of a run of texts.

    `a` and `b` are the ids, one text after the other; `a_group` and `b_group` their groups, counted
    on over the texts; `link_a` and `link_b` the places of linked tokens.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a, self.b = a, b
        a_ends, b_ends = np.cumsum(a_lengths[a]), np.cumsum(b_lengths[b])
        starts = np.concatenate([a_ends - a_lengths[a], b_ends - b_lengths[b]])
        kind = np.repeat(np.array([1, 0], np.int8), [len(a), len(b)])
        order = np.lexsort((kind, starts))  # a B token before the A token that starts with it
        starts, kind = starts[order], kind[order]
        reach = np.maximum.accumulate(np.concatenate([a_ends, b_ends])[order])
        breaks = np.append(True, starts[1:] >= reach[:-1])[: len(starts)]
        group = np.cumsum(breaks) - 1
        is_a = kind == 1
        self.a_group, self.b_group = group[is_a], group[~is_a]
        self.groups = int(breaks.sum())
        # An A token overlaps the B tokens from the last that starts no later than it, to the last
        # that starts before the next A token (the next A token starts where this one ends).
        at = np.flatnonzero(is_a)
        before = np.cumsum(~is_a)[at]
        together = (starts[at] == starts[at - 1]) & ~is_a[at - 1] if len(at) else np.empty(0, bool)
        first = before - 1
        until = np.append((before - together)[1:], len(b))[: len(at)]
        count = until - first
        self.link_a = np.repeat(np.arange(len(a)), count)
        self.link_b = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - first, count)

    def names(self, pair: Pair, a_bounds: np.ndarray, b_bounds: np.ndarray) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` for each text: groups in order, A ids before B ids."""
        per_a = np.bincount(self.a_group, minlength=self.groups)
        per_b = np.bincount(self.b_group, minlength=self.groups)
        after_b, after_a = np.cumsum(per_b) - per_b, np.cumsum(per_a)
        name = np.empty(len(self.a) + len(self.b), np.int64)
        name[np.arange(len(self.a)) + after_b[self.a_group]] = 2 * self.a + _lasts(self.a_group)
        name[np.arange(len(self.b)) + after_a[self.b_group]] = pair.b_names + 2 * self.b + _lasts(self.b_group)
        held, bounds = pair.names, (a_bounds + b_bounds).tolist()
        return [
            "".join(map(held.__getitem__, name[s:e].tolist()))[:-1] for s, e in zip(bounds, bounds[1:], strict=False)
        ]


def _lasts(group: np.ndarray) -> np.ndarray:
    return np.append(group[1:] != group[:-1], True)[: len(group)].astype(np.int64)


def _bounds(lists: list[list[int]]) -> np.ndarray:
    return np.cumsum([0, *map(len, lists)])


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.asarray(x, np.int64) for x in lists]) if lists else np.empty(0, np.int64)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in few bytes."""
    raw = values.astype("<u4").tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(held: bytes) -> np.ndarray:
    count = int.from_bytes(held[:4], "little")
    return np.frombuffer(pa.decompress(held[4:], 4 * count, codec="zstd", asbytes=True), "<u4").astype(np.int64)


class Slice:
    """Documents that share a list of pairs."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.bytes = 0

    def add(self, pair: Pair, doc_ids: list, texts: list[str], keep_groups: bool) -> None:
        tokens = pair.tokens(texts)
        a_lists, b_lists = [a for a, _ in tokens], [b for _, b in tokens]
        a_bounds, b_bounds = _bounds(a_lists), _bounds(b_lists)
        found = Coalesced(_flat(a_lists), _flat(b_lists), pair.a_lengths, pair.b_lengths)
        names = found.names(pair, a_bounds, b_bounds)
        owner = np.repeat(np.arange(len(texts)), np.diff(a_bounds))
        last = np.append(found.a_group, -1)[a_bounds[1:] - 1]
        groups = np.where(np.diff(a_bounds) > 0, last - np.append(found.a_group, 0)[a_bounds[:-1]] + 1, 0)
        link_owner = owner[found.link_a]
        links = np.bincount(link_owner, minlength=len(texts))
        pairs, place = np.unique(found.a[found.link_a] << 32 | found.b[found.link_b], return_inverse=True)
        held, count = np.unique(link_owner * max(len(pairs), 1) + place, return_counts=True)
        document, place = np.divmod(held, max(len(pairs), 1))
        self.parts.append((pairs, np.searchsorted(document, np.arange(len(texts) + 1)), place, count))
        for k, doc_id in enumerate(doc_ids):
            digest = names[k] if keep_groups else sha256(names[k].encode()).hexdigest() if names[k] else ""
            self.rows.append((doc_id, len(a_lists[k]), len(b_lists[k]), int(groups[k]), int(links[k]), digest))
        self.bytes += sum(map(len, texts))

    def batches(self, number: int, doc_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        pairs = np.unique(np.concatenate([p for p, *_ in self.parts])) if self.parts else np.empty(0, np.int64)
        documents = np.zeros(len(pairs), np.int64)
        packed = []
        for own, bounds, place, count in self.parts:
            place = np.searchsorted(pairs, own)[place]
            documents += np.bincount(place, minlength=len(pairs))
            for s, e in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                # Places rise, so their steps are small numbers.
                packed.append(pack(np.concatenate([np.diff(place[s:e], prepend=0), count[s:e]])))
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * 6
        n = len(self.rows)
        arrays = [pa.array([number] * n, pa.int64()), pa.array(columns[0], doc_type)]
        arrays += [pa.array(c, pa.int64()) for c in columns[1:5]]
        arrays += [pa.array(columns[5], pa.string()), pa.array(packed, pa.binary())]
        arrays += [pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, COLUMNS)
        arrays = [pa.array([number], pa.int64())] + [pa.nulls(1, array.type) for array in arrays[1:8]]
        arrays += [pa.array([pairs], pa.list_(pa.int64())), pa.array([documents], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, COLUMNS)


COLUMNS = ["slice", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "pairs", "documents"]
_KEPT = "n_a long, n_b long, n_groups long, n_links long, groups string"


def slice_documents(
    documents: DataFrame, a_path: str, b_path: str, keep_groups: bool, slice_bytes: int
) -> DataFrame:
    """One row for each document with its packed links, and one for each slice with its pairs."""
    doc_type = documents.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    kind = dict(documents.dtypes)["doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        number, held = TaskContext.get().partitionId() << 32, Slice()
        for part in slices(batches):
            held.add(both, part.column("doc_id").to_pylist(), part.column("text").to_pylist(), keep_groups)
            if held.bytes >= slice_bytes:
                yield from held.batches(number, doc_type)
                number, held = number + 1, Slice()
        if held.rows:
            yield from held.batches(number, doc_type)

    rows = documents.select("doc_id", text_of().alias("text"))
    schema = f"slice long, doc_id {kind}, {_KEPT}, links binary, pairs array<long>, documents array<long>"
    return rows.mapInArrow(work, schema)


def pair_counts(sliced: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slice, pair) rows, and for each pair of ids its documents and whether A has no better one."""
    held = sliced.where("pairs is not null").select("slice", F.expr("inline(arrays_zip(pairs, documents))"))
    # One exchange serves the sums and the way back.
    held = held.withColumnRenamed("pairs", "pair").repartition("pair")
    total = held.groupBy("pair").agg(F.sum("documents").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.expr("shiftright(pair, 32)")))
    return held, total.select("pair", "count", (F.col("count") == most).alias("best"))


def align_documents(
    documents: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    keep_groups: bool = True,
    slice_bytes: int = SLICE_TEXT_BYTES,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups for each document.

    A encodes a space and the text, B the text, to which it adds the space; strings of special tokens
    are plain text. `groups` is `a1,a2|b1;a3|b2,b3` in ids, or its SHA-256 in hex without
    `keep_groups`. A pair's count is the number of documents (rows) that hold it linked; `count_sum`
    adds the counts over the links of a document, `n_best` is how many of them have the highest count
    of their A id. Texts that are null, empty or not kept byte for byte by a tokenizer have no
    tokens: zeros and ''. Rows with the same id and text are documents of their own. Other columns
    are not read. A task holds one slice, or one longer text, at a time.
    """
    spark = documents.sparkSession
    kind = dict(documents.dtypes)["doc_id"]
    sliced = slice_documents(documents, a_path or vocabulary_path(), b_path or pieces_path(), keep_groups, slice_bytes)
    # Slices are numbered by task, so the table is written once before it is read twice.
    sliced = write_once(sliced, scratch_path(spark, "aligned"))
    held, counts = pair_counts(sliced)
    known = held.select("slice", "pair").join(counts, "pair").withColumnRenamed("slice", "of_slice")
    rows = sliced.where("pairs is null").drop("pairs", "documents")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def score(own: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs.column("pair").to_numpy())
        count, best = pairs.column("count").to_numpy()[order], pairs.column("best").to_numpy()[order]
        sums, bests = [], []
        for links in own.column("links").to_pylist():
            place, times = np.split(unpack(links), 2)
            place = np.cumsum(place)
            sums.append(int((count[place] * times).sum()))
            bests.append(int(times[best[place]].sum()))
        own = own.append_column("n_best", pa.array(bests, pa.int64()))
        return own.append_column("count_sum", pa.array(sums, pa.int64())).select(names)

    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return rows.groupBy("slice").cogroup(known.groupBy("of_slice")).applyInArrow(score, schema)
