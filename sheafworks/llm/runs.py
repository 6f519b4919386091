"""Periodic runs of words: suffix classes united by falling common prefix.

A run is a stretch of consecutive words with smallest period q that is at least `least_words` and
`least_power` * q words long and that no neighbouring word extends. With s its first word, the
suffixes at s and s + q share length - q words, and no suffix between them shares as many: so when
classes of suffixes are united by falling length of the common prefix, as Kruskal's method unites
trees, s and s + q become neighbours in the ordered position set of their class at that length.
Each union therefore looks at the newly adjacent positions alone. Two that are p apart and share
l >= p words lie in a run of period p, which ends l words after the later one; the smallest first
position seen for a period and an end is the start of the run.

No pair with a shorter common prefix than `shared_words` can start a run, so only words in windows
of that size which return in the same text are worked on.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, join_hashes, slices, text_of, window_hashes

#: Shortest run in words, and in periods.
LEAST_WORDS = 24
LEAST_POWER = 3

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def shared_words(least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER) -> int:
    """The least number of words that the suffixes at a run's start and one period on share."""
    return min(max(least_words - q, (least_power - 1) * q) for q in range(1, least_words + 1))


class Positions:
    """An ordered set of positions in blocks, so that adding to a large one moves few."""

    WIDTH = 512

    def __init__(self, first: int):
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, at: int) -> tuple[int | None, int | None]:
        """Adds a position and returns its neighbours before and after."""
        blocks = self.blocks
        k = max(bisect_right(self.heads, at) - 1, 0)
        block = blocks[k]
        i = bisect_right(block, at)
        before = block[i - 1] if i else (blocks[k - 1][-1] if k else None)
        after = block[i] if i < len(block) else (blocks[k + 1][0] if k + 1 < len(blocks) else None)
        block.insert(i, at)
        self.heads[k] = block[0]
        self.size += 1
        if len(block) > 2 * self.WIDTH:
            blocks.insert(k + 1, block[self.WIDTH :])
            self.heads.insert(k + 1, block[self.WIDTH])
            del block[self.WIDTH :]
        return before, after


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 1 in the order of the keys; equal keys share one."""
    order = np.argsort(key, kind="stable")
    held = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.append(True, held[1:] != held[:-1]))
    return rank


def _suffix_order(symbols: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of all suffixes, and how many symbols each shares with the one before it.

    Symbol `last[i]` ends the stretch of symbol i and is found nowhere else. Windows are ranked by
    doubling; the ranks of each window size are kept, and common prefixes are put together from them.
    """
    levels, step, here = [_dense(symbols)], 1, np.arange(len(symbols))
    while int(levels[-1].max()) < len(symbols):
        rank, at = levels[-1], here + step
        after = np.where(at <= last, rank[np.minimum(at, len(rank) - 1)], 0)
        levels[-1] = rank.astype(np.int32)
        levels.append(_dense(rank * (len(rank) + 1) + after))
        step *= 2
    order = np.argsort(levels[-1])
    one, two = order[:-1], order[1:]
    shared = np.zeros(len(one), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        shared += np.where(levels[k][one + shared] == levels[k][two + shared], 1 << k, 0)
    return order, shared


def _returning(words: Words, size: int) -> np.ndarray:
    """First words of the windows that occur again in their text, in order."""
    starts = words.window_starts(size)
    if not len(starts):
        return starts
    text = np.searchsorted(words.bounds, starts, "right") - 1
    key = join_hashes(window_hashes(words.hashes[0], size)[starts], text.astype(np.uint64))
    order = np.argsort(key)
    same = np.diff(key[order]) == 0
    return np.sort(starts[order[np.append(same, False) | np.append(False, same)]])


def unite(order: np.ndarray, shared: np.ndarray, origin: np.ndarray, least: int, least_words: int, least_power: int):
    """Runs as {(period, end): start}, ends exclusive, from classes united by falling common prefix.

    `shared[t]` is what suffixes `order[t]` and `order[t + 1]` have in common; `origin` gives their
    word numbers.
    """
    place = origin[order].tolist()
    root = list(range(len(place)))
    sets: dict[int, Positions] = {}
    runs: dict[tuple[int, int], int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def seed(first: int, second: int, common: int) -> None:
        period = second - first
        if common >= (least_power - 1) * period and common + period >= least_words:
            key = (period, second + common)
            if first < runs.get(key, first + 1):
                runs[key] = first

    edges = np.flatnonzero(shared >= least)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    for edge, common in zip(edges.tolist(), shared[edges].tolist(), strict=True):
        a, b = find(edge), find(edge + 1)
        large, small = sets.pop(a, None), sets.pop(b, None)
        if (large.size if large else 1) < (small.size if small else 1):
            a, b, large, small = b, a, small, large
        root[b] = a
        large = large or Positions(place[a])
        joining = list(small) if small else [place[b]]
        earlier = None
        for at, later in zip(joining, [*joining[1:], None], strict=True):
            before, after = large.add(at)
            if before is not None and before != earlier:
                seed(before, at, common)
            if after is not None and (later is None or after < later):
                seed(at, after, common)
            earlier = at
        sets[a] = large
    return runs


def runs_of_texts(
    words: Words, least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER
) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of all runs by number of the text, in order of start and period."""
    least = shared_words(least_words, least_power)
    starts = _returning(words, least)
    if not len(starts):
        return {}
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + least, -1)
    covered = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    text = np.searchsorted(words.bounds, covered, "right") - 1
    # Each stretch of covered words of one text gets an end symbol of its own.
    cut = np.append((np.diff(covered) > 1) | (np.diff(text) > 0), True)
    stretch = np.cumsum(np.append(0, cut[:-1]))
    _, symbol = np.unique(join_hashes(words.hashes[0][covered], text.astype(np.uint64)), return_inverse=True)
    place = np.arange(len(covered)) + stretch
    ends = np.flatnonzero(cut) + np.arange(1, int(cut.sum()) + 1)
    symbols = np.empty(len(covered) + len(ends), np.int64)
    symbols[place] = symbol
    symbols[ends] = int(symbol.max()) + 1 + np.arange(len(ends))
    origin = np.full(len(symbols), -1, np.int64)
    origin[place] = covered
    last = np.empty(len(symbols), np.int64)
    last[place] = ends[stretch]
    last[ends] = ends
    order, shared = _suffix_order(symbols, last)
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (period, end), start in sorted(unite(order, shared, origin, least, least_words, least_power).items()):
        number = int(np.searchsorted(words.bounds, start, "right")) - 1
        out.setdefault(number, []).append((start - int(words.bounds[number]), end - start, period))
    return {number: sorted(found, key=lambda r: (r[0], r[2])) for number, found in out.items()}


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def find_runs(
    documents: DataFrame, least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER, keep_text: bool = True
) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period in words) and collapsed for each document.

    `collapsed` is the text without the words that a run holds after its first period, joined by one
    space; without `keep_text` its SHA-256 (binary) instead. A text is worked on whole, where it is
    read: nothing is shuffled, and a task holds some megabytes of text or one longer text at a time.
    Null and empty texts, and texts without words, have no runs and an empty `collapsed`; rows with
    the same id and text give equal rows; other columns are not read. Words are told apart by hashes
    of 64 bits.
    """
    kind = dict(documents.dtypes)["doc_id"]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text")
            found = runs_of_texts(Words(texts), least_words, least_power)
            count, runs, kept = [], [], []
            for number, text in enumerate(texts.to_pylist()):
                words = text.encode().split()
                own = found.get(number, [])
                left = b" ".join(collapse(words, own) if own else words)
                count.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                kept.append(left.decode() if keep_text else sha256(left).digest())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(count, pa.int64()),
                    pa.array(runs, pa.list_(run)),
                    pa.array(kept, pa.string() if keep_text else pa.binary()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = documents.select("doc_id", text_of().alias("text"))
    collapsed = "string" if keep_text else "binary"
    return rows.mapInArrow(work, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed {collapsed}")


def with_repeats(documents: DataFrame) -> DataFrame:
    """doc_id and text, where one text in ten is made periodic from some word on.

    With h the crc32 of the id as text and g = floor(h / 10): if h % 10 = 0, the words from number
    a = g % n on repeat the first p = 1 + floor((n - a) / (3 + g % 8)) of them. Other texts stay; a
    null id counts as the empty text.
    """
    h = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    rows = documents.select("doc_id", text_of().alias("text"), h.alias("h"))
    words = F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    rows = rows.select("doc_id", "text", F.expr("h div 10").alias("g"), F.when(F.col("h") % 10 == 0, words).alias("words"))
    rows = rows.select("*", F.coalesce(F.size("words"), F.lit(0)).alias("n"))
    rows = rows.select("*", F.when(F.col("n") > 0, F.expr("g % n").cast("int")).alias("a"))
    rows = rows.select("*", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)").alias("p"))
    again = F.expr("transform(sequence(0, n - a - 1), i -> words[a + i % p])")
    made = F.concat_ws(" ", F.concat(F.slice("words", F.lit(1), F.col("a")), again))
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the one with most periods, and digests, from what `find_runs` gives."""
    better = "x.length * y.period > y.length * x.period"
    best = F.expr(
        f"aggregate(runs, cast(null as {RUN}), (y, x) -> case when y is null or {better} then x else y end)"
    )  # runs are in order of start and period, so the first of equal ones stays
    lines = "concat_ws('', transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')))"
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.lower(F.hex("collapsed")).alias("collapsed_sha256"),
    )
