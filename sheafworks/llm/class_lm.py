"""Brown's class-based bigram model with exchange clustering.

P(word | word before) = P(class | class before) * P(word | class), mixed with an add-one unigram.
All training words are counted and clustered. The `HEAD` most frequent are clustered by exchange on
the driver, as a start. Then tasks sum the neighbours' classes of each word and move it to the class
that makes the likelihood of the class bigrams largest: in a first sweep the other words up to
`KNOWN`, in `sweeps` more all words up to `KNOWN`, each with a rebuilt grid of class bigrams, in the
last one all the rest, whose class counts in the grid too. Words of one sweep move at the same time.
Every word has its count less a discount, and an unseen word has what the discounts of a class leave.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import Words, share, shared, signed, slices, text_of, write_once

#: Words that exchange moves on the driver, words with count and class in every task (10 MB), the
#: fewest classes: more than 262,144 different words make it the cube root of their number.
HEAD, KNOWN, CLASSES = 2048, 262_000, 64
SWEEPS = 6
#: Blocks of known words in a sweep, by rank; numbers of a gain table held at a time.
BLOCKS, GAINS = 1024, 1 << 22
#: Bits of a word's hash by which it is looked up.
LOOKUP = 20
#: Weight of the class model against the unigram; what is added to each class transition.
MIX, ADDED = 0.9, 0.1
END = np.uint64(0x5EED0F7E57E4D000)
#: Tokens counted by one task before they are handed on.
HELD = 4 << 20
ROW_BLOCK = 64


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with END after each text, bounds)."""
    words = Words(texts, lower=True)
    n = len(words.bounds) - 1
    return np.insert(words.hashes[0], words.bounds[1:], END), words.bounds + np.arange(n + 1)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    np.seterr(over="ignore")
    held: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch([pa.array(signed(word)), pa.array(n.astype(np.int64))], ["word", "n"])

    for part in slices(batches):
        held.append(_tokens(part.column("text"))[0])
        if sum(map(len, held)) > HELD:
            yield out()
            held = []
    if held:
        yield out()


class Known:
    """The most frequent words in order of count: END, if there, is none of them."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.words, self.counts = words, counts
        self.begin: np.ndarray | None = None

    def _prepare(self) -> None:
        order = np.argsort(self.words)
        ordered = self.words[order]
        many = np.bincount((ordered >> np.uint64(64 - LOOKUP)).astype(np.int64), minlength=1 << LOOKUP)
        self.begin = (np.cumsum(many) - many).astype(np.int32)
        self.longest = int(many.max())
        # The lists end in words that are found nowhere.
        self.sorted = np.append(ordered, np.full(self.longest, END))
        self.order = np.append(order, np.full(self.longest, len(order))).astype(np.int32)

    def __getstate__(self) -> dict:
        return {"words": self.words, "counts": self.counts, "begin": None}

    def place(self, tokens: np.ndarray) -> np.ndarray:
        """Rank of each token; len(words) for END and others."""
        if self.begin is None:
            self._prepare()
        if not len(self.words):
            return np.zeros(len(tokens), np.int64)
        at = self.begin[tokens >> np.uint64(64 - LOOKUP)]
        rank = self.order[at].astype(np.int64)
        left = np.flatnonzero(self.sorted[at] != tokens)
        rank[left] = len(self.words)
        for step in range(1, self.longest):
            here = at[left] + step
            hit = self.sorted[here] == tokens[left]
            rank[left[hit]] = self.order[here[hit]]
            left = left[~hit]
        return rank


def _pair_counts(held, size: int):
    """Counts of neighbours (a, b) of one text, as sparse blocks of rows; `held` ranks tokens 0 to size - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        rank = shared(held)
        total = np.zeros(size * size, np.int64)
        pairs: list[np.ndarray] = []
        for part in slices(batches):
            tokens, bounds = _tokens(part.column("text"))
            own = rank(tokens)
            before = np.empty_like(own)
            before[1:] = own[:-1]
            before[bounds[:-1]] = size - 1  # a text begins after an end
            pairs.append(before * size + own)
            if sum(map(len, pairs)) > len(total):
                total += np.bincount(np.concatenate(pairs), minlength=len(total))
                pairs = []
        if pairs:
            total += np.bincount(np.concatenate(pairs), minlength=len(total))
        yield _pair_batch(_pair_rows(total, size))

    return run


def _pair_rows(total: np.ndarray, size: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    where = np.flatnonzero(total)
    edges = np.searchsorted(where, np.arange(0, size * size + ROW_BLOCK * size, ROW_BLOCK * size))
    return [(k, where[a:b], total[where[a:b]]) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]


def _pair_batch(rows) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array([k for k, _, _ in rows], pa.int32()),
            pa.array([p.astype(np.int64).tobytes() for _, p, _ in rows], pa.binary()),
            pa.array([n.astype(np.int64).tobytes() for _, _, n in rows], pa.binary()),
        ],
        ["block", "pairs", "counts"],
    )


def _add_pairs(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "counts")), strict=True):
                own = total.setdefault(block, np.zeros(ROW_BLOCK * size, np.int64))
                own[np.frombuffer(pairs, np.int64) - block * ROW_BLOCK * size] += np.frombuffer(counts, np.int64)
        rows = [(k, np.flatnonzero(n) + k * ROW_BLOCK * size, n[n > 0]) for k, n in total.items()]
        yield _pair_batch(rows)

    return run


def neighbour_counts(texts: DataFrame, rank, size: int) -> np.ndarray:
    """The size x size table of neighbours in all texts; the last row and column are the end of a text."""
    held = share(texts.sparkSession, rank)
    return _sum_pairs(texts.select("text").mapInArrow(_pair_counts(held, size), _PAIRS), size)


_PAIRS = "block int, pairs binary, counts binary"


def _sum_pairs(each: DataFrame, size: int) -> np.ndarray:
    """The table whose blocks of rows, as tasks have counted them, are in (block, pairs, counts)."""
    blocks = -(-size // ROW_BLOCK)
    table = np.zeros(size * size, np.int64)
    for _, pairs, counts in each.repartition(blocks, "block").mapInArrow(_add_pairs(size), _PAIRS).toLocalIterator():
        table[np.frombuffer(pairs, np.int64)] = np.frombuffer(counts, np.int64)
    return table.reshape(size, size)


def exchange(table: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of all words but the last two of a neighbour table (others and the end keep their own).

    Word by word, each goes to the class that makes the likelihood of the class bigrams largest;
    it ends when a sweep moves no word.
    """
    words = len(table) - 2
    total = classes + 2
    of = np.append(np.arange(words) % classes, [classes, classes + 1])
    grid = np.zeros((total, total))
    np.add.at(grid, (of[:, None], of[None, :]), table)
    left, right = grid.sum(1), grid.sum(0)

    def h(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            own = of[w]
            after = np.bincount(of, table[w], total)
            before = np.bincount(of, table[:, w], total)
            loop = float(table[w, w])
            after[own] -= loop
            before[own] -= loop
            n_after, n_before = after.sum() + loop, before.sum() + loop
            grid[own] -= after
            grid[:, own] -= before
            grid[own, own] -= loop
            left[own] -= n_after
            right[own] -= n_before
            rows, columns = grid[:classes], grid[:, :classes].T
            gain = (h(rows + after) - h(rows)).sum(1) + (h(columns + before) - h(columns)).sum(1)
            diagonal = np.arange(classes)
            stay = grid[diagonal, diagonal]
            gain += h(stay + after[:classes] + before[:classes] + loop) - h(stay)
            gain -= h(stay + after[:classes]) - h(stay) + h(stay + before[:classes]) - h(stay)
            gain -= h(left[:classes] + n_after) - h(left[:classes]) + h(right[:classes] + n_before) - h(right[:classes])
            best = int(gain.argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            of[w] = best
            moved += best != own
            grid[best] += after
            grid[:, best] += before
            grid[best, best] += loop
            left[best] += n_after
            right[best] += n_before
        if not moved:
            break
    return of[:words]


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


class Gains:
    """What a word adds to the likelihood of the class bigrams in each class, from its neighbours' classes.

    A neighbour f is the class before the word, or `total` plus the class after it.
    """

    def __init__(self, grid: np.ndarray):
        grid = grid.astype(float)
        self.total, self.classes = len(grid), len(grid) - 2
        self.near = np.vstack([grid[:, : self.classes], grid[: self.classes].T])
        self.h_near = _h(self.near)
        self.one = _h(self.near + 1) - self.h_near
        self.sums = [grid.sum(1)[: self.classes], grid.sum(0)[: self.classes]]

    def best(self, first: np.ndarray, f: np.ndarray, n: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The class of each word; its neighbours (f, n) begin at `first`, `own` is its class so far, or -1."""
        ends = np.append(first[1:], len(f))
        out, begin = np.empty(len(first), np.int32), 0
        while begin < len(first):
            end = max(begin + 1, int(np.searchsorted(ends, first[begin] + GAINS // self.classes, "right")))
            rows = slice(first[begin], ends[end - 1])
            out[begin:end] = self._best(first[begin:end] - first[begin], f[rows], n[rows], own[begin:end])
            begin = end
        return out

    def _best(self, first, f, n, own) -> np.ndarray:
        add = self.one[f]
        many = np.flatnonzero(n > 1)
        add[many] = _h(self.near[f[many]] + n[many, None]) - self.h_near[f[many]]
        gain = np.add.reduceat(add, first)
        size = np.add.reduceat(np.where(f >= self.total, n, 0), first)
        sizes, at = np.unique(size, return_inverse=True)
        for s in self.sums:
            gain -= (_h(s + sizes[:, None]) - _h(s))[at]
        here = np.flatnonzero(own >= 0)
        if len(here):  # what a word gives to its own class is in the grid already
            mine = np.repeat(np.maximum(own, 0), np.diff(np.append(first, len(f))))
            stay = np.add.reduceat(self.h_near[f, mine] - _h(np.maximum(self.near[f, mine] - n, 0)), first)[here]
            for s in self.sums:
                stay -= _h(s[own[here]]) - _h(np.maximum(s[own[here]] - size[here], 0))
            gain[here, own[here]] = stay + 1e-9
        return gain.argmax(1)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n, first)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers with their lowest bytes first, then their next ones, compressed."""
    return pa.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _from_planes(data: bytes, size: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, size).T).view("<u4").ravel().astype(np.int64)


def _neighbours(tokens: np.ndarray, own: np.ndarray, bounds: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes before and after each token: the end of a text, as a rule, is its last token."""
    before = np.append(total - 1, own[:-1])
    before[bounds[:-1]] = total - 1
    return before, np.append(own[1:], total - 1)


def _features(held, low: int):
    """(block, size, keys, counts): neighbours' classes of the known words from rank `low`, summed inside the task.

    Ranks are dealt to `BLOCKS` blocks in turn; a key is a word's number in its block times 2 total, plus f.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        chosen: ClassOf = shared(held)
        total, rest = chosen.total, len(chosen.known.words)
        room = -(-rest // BLOCKS) * 2 * total
        raw: list[np.ndarray] = []
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def out() -> pa.RecordBatch:
            edges = np.searchsorted(keys, np.arange(BLOCKS + 1) * room)
            used = [(k, a, b) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]
            columns = [
                pa.array([k for k, _, _ in used], pa.int32()),
                pa.array([b - a for _, a, b in used], pa.int32()),
                pa.array([_planes(np.diff(keys[a:b] - k * room, prepend=0)) for k, a, b in used], pa.binary()),
                pa.array([_planes(counts[a:b]) for _, a, b in used], pa.binary()),
            ]
            return pa.record_batch(columns, ["block", "size", "keys", "counts"])

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, n = np.unique(np.concatenate(raw), return_counts=True)
            return _summed(np.append(keys, key), np.append(counts, n)) if len(keys) else (key, n)

        for part in slices(batches):
            tokens, bounds = _tokens(part.column("text"))
            place = chosen.known.place(tokens)
            before, after = _neighbours(tokens, chosen.at(tokens, place), bounds, total)
            here = np.flatnonzero((place >= low) & (place < rest))
            at = place[here] % BLOCKS * room + place[here] // BLOCKS * (2 * total)
            raw += [at + before[here], at + after[here] + total]
            if sum(map(len, raw)) > HELD // 2:
                keys, counts = merged()
                raw = []
                if len(keys) > HELD // 2:
                    yield out()
                    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        if raw:
            keys, counts = merged()
        if len(keys):
            yield out()

    return run


def _move(held):
    """(rank, class) of the words of each block; the rows of a block come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, grid = shared(held)
        gains, total = Gains(grid), chosen.total
        room = -(-len(chosen.known.words) // BLOCKS) * 2 * total
        now, sums = -1, np.zeros(room, np.int64)

        def placed() -> pa.RecordBatch:
            keys = np.flatnonzero(sums)
            number = keys // (2 * total)
            first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            rank = number[first] * BLOCKS + now
            own = np.where(chosen.of[rank] < gains.classes, chosen.of[rank], -1)
            best = gains.best(first, keys % (2 * total), sums[keys], own)
            return pa.record_batch([pa.array(rank.astype(np.int32)), pa.array(best)], ["rank", "class"])

        for batch in batches:
            for i in range(batch.num_rows):
                block, size, keys, counts = (batch.column(c)[i].as_py() for c in ("block", "size", "keys", "counts"))
                if block != now:
                    if now >= 0:
                        yield placed()
                    now, sums = block, np.zeros(room, np.int64)
                sums[np.cumsum(_from_planes(keys, size))] += _from_planes(counts, size)
        if now >= 0:
            yield placed()

    return run


def sweep(texts: DataFrame, chosen: ClassOf, grid: np.ndarray, low: int = 0) -> ClassOf:
    """The classes after each known word from rank `low` has moved to its best class in `grid`, all at the same time."""
    spark = texts.sparkSession
    each = texts.select("text").mapInArrow(_features(share(spark, chosen), low), "block int, size int, keys binary, counts binary")
    each = each.repartition("block").sortWithinPartitions("block")
    moved = each.mapInArrow(_move(share(spark, (chosen, grid))), "rank int, class int").toArrow()
    of = chosen.of.copy()
    of[moved.column("rank").to_numpy()] = moved.column("class").to_numpy()
    return ClassOf(chosen.known, of, chosen.total)


def _tail_rows(held):
    """Rows of the words beyond the known ones, and the pair counts of all classes, of which they make one.

    (word, near) for each time such a word stands somewhere, near being the class before it times
    `total` plus the class after it; (word, other) where two of them meet; (block, pairs, counts).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        chosen: ClassOf = shared(held)
        total = chosen.total
        table = np.zeros(total * total, np.int64)
        for part in slices(batches):
            tokens, bounds = _tokens(part.column("text"))
            own = chosen(tokens)
            before, after = _neighbours(tokens, own, bounds, total)
            table += np.bincount(before * total + own, minlength=len(table))
            tail = own == total - 2
            here, both = np.flatnonzero(tail), np.flatnonzero(tail[:-1] & tail[1:])
            yield _filled(
                word=pa.array(signed(tokens[np.append(here, both)])),
                other=pa.concat_arrays([pa.nulls(len(here), pa.int64()), pa.array(signed(tokens[both + 1]))]),
                near=pa.concat_arrays([pa.array((before * total + after)[here].astype(np.int32)), pa.nulls(len(both), pa.int32())]),
            )
        batch = _pair_batch(_pair_rows(table, total))
        yield _filled(**{c: batch.column(c) for c in batch.schema.names})

    return run


_ROWS = {"word": pa.int64(), "other": pa.int64(), "near": pa.int32(), "block": pa.int32(), "pairs": pa.binary(), "counts": pa.binary()}


def _filled(**columns: pa.Array) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.record_batch([columns[c] if c in columns else pa.nulls(size, t) for c, t in _ROWS.items()], list(_ROWS))


def _place_tail(held):
    """(word, n, class) from (word, near), which come sorted by word; then pair counts of these words with known ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(shared(held))
        total = gains.total
        rare, table = total - 2, np.zeros(total * total, np.int64)
        kept = None

        def placed(word, near) -> pa.RecordBatch:
            number = np.cumsum(np.append(False, word[1:] != word[:-1]))
            before, after = near // total, near % total
            key, n = np.unique(np.append(number, number) * (2 * total) + np.append(before, after + total), return_counts=True)
            owner = key // (2 * total)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = gains.best(first, key % (2 * total), n, np.full(len(first), -1))
            own = best[number].astype(np.int64)
            for pair, at in ((before * total + own, before), (own * total + after, after)):
                table[:] += np.bincount(pair[at != rare], minlength=len(table))
            size = len(first)
            columns = [pa.array(word[np.flatnonzero(np.append(True, word[1:] != word[:-1]))]), pa.array(np.bincount(number)), pa.array(best)]
            columns += [pa.nulls(size, t) for t in (pa.int32(), pa.binary(), pa.binary())]
            return pa.record_batch(columns, ["word", "n", "class", "block", "pairs", "counts"])

        for batch in batches:
            rows = [batch.column(c).to_numpy().astype(np.int64) for c in ("word", "near")]
            if kept is not None:
                rows = [np.append(a, b) for a, b in zip(kept, rows, strict=True)]
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            kept = [r[cut:] for r in rows]
            if cut:
                yield placed(*(r[:cut] for r in rows))
        if kept is not None:
            yield placed(*kept)
        batch = _pair_batch(_pair_rows(table, total))
        columns = [pa.nulls(batch.num_rows, t) for t in (pa.int64(), pa.int64(), pa.int32())]
        yield pa.record_batch([*columns, *batch.columns], ["word", "n", "class", "block", "pairs", "counts"])

    return run


def _place_rest(texts: DataFrame, chosen: ClassOf) -> tuple[DataFrame, np.ndarray]:
    """(word, n, class) of all words that `chosen` has no class for, and the whole table of class neighbours."""
    spark, total = texts.sparkSession, chosen.total
    schema = f"word long, other long, near int, {_PAIRS}"
    found = texts.select("text").mapInArrow(_tail_rows(share(spark, chosen)), schema)
    found = write_once(found, scratch_path(spark, "contexts"))
    pairs = _sum_pairs(found.where("block is not null").select("block", "pairs", "counts"), total)
    alone = found.where("near is not null").select("word", "near").repartition("word").sortWithinPartitions("word")
    placed = alone.mapInArrow(_place_tail(share(spark, pairs)), f"word long, n long, class int, {_PAIRS}")
    placed = write_once(placed, scratch_path(spark, "classes"))
    pairs[total - 2] = pairs[:, total - 2] = 0
    pairs += _sum_pairs(placed.where("block is not null").select("block", "pairs", "counts"), total)
    of = placed.where("word is not null").select("word", "n", "class")
    left = of.select("word", F.col("class").alias("left"))
    right = of.select(F.col("word").alias("other"), F.col("class").alias("right"))
    both = found.where("other is not null").select("word", "other").join(right, "other").join(left, "word")
    for a, b, n in both.groupBy("left", "right").count().collect():
        pairs[a, b] += n
    return of, pairs


@dataclass
class Rank:
    """Ranks tokens of the head; then come all others and the end."""

    known: Known
    head: int

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        place = np.minimum(self.known.place(tokens), self.head)
        place[tokens == END] = self.head + 1
        return place


@dataclass
class ClassOf:
    """The class of each token; the last two are the words not known here and the end."""

    known: Known
    of: np.ndarray
    total: int

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        return self.at(tokens, self.known.place(tokens))

    def at(self, tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
        own = np.append(self.of, self.total - 2)[place]
        own[tokens == END] = self.total - 1
        return own


@dataclass
class Model:
    classes: ClassOf
    moves: np.ndarray  # P(class | class before)
    emits: np.ndarray  # P(word | class) of the known words, then of the end
    base: np.ndarray  # add-one unigram of the same
    tokens: int
    types: int
    sizes: np.ndarray  # tokens of each class
    unseen: np.ndarray  # P(an unseen word | class before)
    discount: float
    mix: float


def _most_frequent(counts: DataFrame, known: int) -> tuple[Known, dict[str, int]]:
    """The `known` words of largest count, and sums over all words.

    Counts are first summed by sixteenths of powers of two, so that only words that may be among
    them are ranked.
    """
    end = F.col("word") == int(END.astype(np.int64))
    cells = counts.groupBy(F.floor(F.log2("n") * 16).cast("int").alias("cell")).agg(
        F.sum("n").alias("tokens"),
        F.count(F.lit(1)).alias("types"),
        F.sum(F.when(end, F.col("n")).otherwise(0)).alias("ends"),
        F.min("n").alias("least"),
    )
    cells = sorted(cells.collect(), reverse=True)
    above = np.cumsum([r["types"] for r in cells])
    at = int(np.searchsorted(above, known + 1))
    least = cells[at]["least"] if at < len(cells) else 0
    top = counts.where(~end & (F.col("n") >= least)).orderBy(F.desc("n"), "word").limit(known).toArrow()
    sums = {c: sum(r[c] for r in cells) for c in ("tokens", "types", "ends")}
    sums |= {c: sum(r["types"] for r in cells if r["least"] == n) for c, n in (("once", 1), ("twice", 2))}
    return Known(top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()), sums


def train(
    texts: DataFrame, head: int = HEAD, known: int = KNOWN, classes: int | None = None, sweeps: int = 1
) -> tuple[Model, DataFrame]:
    """(model, counts) from a table with a column text; counts is (word, n, class) of the training
    words beyond the known ones, whose counts and classes the model has.

    What is in the model has the fixed size `known`; the counts stay a table in the shared folder. A
    word that follows itself counts as a neighbour of its class so far. Without texts there are no
    words and a single class, and each token has the probability of an unseen one.
    """
    spark = texts.sparkSession
    texts = texts.select(text_of().alias("text"))
    counts = texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    best, sums = _most_frequent(write_once(counts, scratch_path(spark, "word-counts")), known)
    head = min(head, len(best.words))
    classes = max(CLASSES, int(np.ceil(np.cbrt(sums["types"])))) if classes is None else classes
    classes = max(1, min(classes, head))
    total = classes + 2
    table = neighbour_counts(texts, Rank(best, head), head + 2)
    of = exchange(table, classes).astype(np.int64)
    chosen = ClassOf(best, np.append(of, np.full(len(best.words) - head, classes)), total)
    if len(best.words) > head:
        ends = np.append(of, [classes, classes + 1])
        grid = np.zeros((total, total), np.int64)
        np.add.at(grid, (ends[:, None], ends[None, :]), table)
        chosen = sweep(texts, chosen, grid, head)
        for _ in range(sweeps):
            chosen = sweep(texts, chosen, neighbour_counts(texts, chosen, total))
    rest, pairs = _place_rest(texts, chosen)
    size, types = np.bincount(chosen.of, best.counts, total), np.bincount(chosen.of, minlength=total)
    for c, n, words in rest.groupBy("class").agg(F.sum("n"), F.count(F.lit(1))).collect():
        size[c] += n
        types[c] += words
    discount = sums["once"] / (sums["once"] + 2 * sums["twice"]) if sums["once"] else 0.5
    moves = (pairs + ADDED) / (pairs.sum(1, keepdims=True) + ADDED * total)
    if types.any():  # what comes after an unseen word is the mean over all words
        moves[total - 2] = types @ moves / types.sum()
    left = np.where(size > 0, discount * types / np.maximum(size, 1), 1.0)
    left[total - 1] = 0  # the end is no word
    emits = np.append((best.counts - discount) / np.maximum(size[chosen.of], 1), 1.0)
    base = (np.append(best.counts, sums["ends"]) + 1) / (sums["tokens"] + sums["types"] + 1)
    model = Model(chosen, moves, emits, base, sums["tokens"], sums["types"], size, moves @ left, discount, MIX)
    return model, rest


_TAIL = pa.list_(pa.struct([("word", pa.int64()), ("at", pa.int64())]))


def _score(held):
    """For each text: what its known words add, and its other words with where they stand.

    `at` has the number among these words of the text, the class before (that of unknown words if
    one is before) and the rank of the next word (one more than that of the end if it is unknown).
    What a known word adds after another word is added with that word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        model: Model = shared(held)
        size, rare = len(model.classes.known.words), model.classes.total - 2
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            tokens, bounds = _tokens(part.column("text"))
            place = model.classes.known.place(tokens)
            own = model.classes.at(tokens, place)
            before = np.empty_like(own)
            before[1:] = own[:-1]
            before[bounds[:-1]] = model.classes.total - 1
            text = np.repeat(np.arange(part.num_rows), np.diff(bounds))
            here = own != rare
            at = np.minimum(place[here], size)  # `size` is the end
            plain = model.base[at]
            mixed = model.mix * model.moves[before[here], own[here]] * model.emits[at] + (1 - model.mix) * plain
            mixed[before[here] == rare] = 1
            sums = [np.bincount(text[here], np.log10(x), part.num_rows) for x in (plain, mixed)]
            known = np.bincount(text[here & ((own != rare + 1) | (model.tokens > 0))], minlength=part.num_rows)
            tail = np.flatnonzero(~here)
            ends = np.searchsorted(text[tail], np.arange(part.num_rows + 1)).astype(np.int32)
            number = np.arange(len(tail)) - ends[text[tail]]
            after = np.where(here[(tail + 1) % len(here)], np.minimum(place[(tail + 1) % len(here)], size), size + 1)
            at = number << 32 | before[tail].astype(np.int64) << 18 | after
            rows = pa.StructArray.from_arrays([pa.array(signed(tokens[tail])), pa.array(at)], ["word", "at"])
            columns = [part.column("doc_id"), pa.array(np.arange(part.num_rows) + row)]
            row += part.num_rows
            columns += [pa.array(np.diff(bounds)), pa.array(known.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1])]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), rows))
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "row", "n_tokens", "known", "base_sum", "score_sum", "tail"]
            )

    return run


def _score_tail(held):
    """(row, t_known, t_base, t_score) from the words that stand in order of row and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared(held)
        rare, end = model.classes.total - 2, len(model.classes.known.words)
        of = np.append(model.classes.of, [rare + 1])
        last = None
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in ("row", "at", "n", "class")])
            skip = last is not None
            if skip:
                rows = np.hstack([last, rows])
            if rows.shape[1] <= skip:
                continue
            last = rows[:, -1:]
            row, at, n, own = rows
            before, after = (at >> 18) & 0x3FFF, at & 0x3FFFF
            before = np.where(before == rare, np.append(rare, own[:-1]), before)
            plain = (n + 1) / float(model.tokens + model.types + 1)
            seen = model.moves[before, own] * (n - model.discount) / np.maximum(model.sizes[own], 1)
            score = np.log10(model.mix * np.where(n > 0, seen, model.unseen[before]) + (1 - model.mix) * plain)
            known = after <= end
            to = np.minimum(after, end)
            follow = model.mix * model.moves[own, of[to]] * model.emits[to] + (1 - model.mix) * model.base[to]
            score += np.where(known, np.log10(follow), 0)
            row, n, plain, score = (x[int(skip) :] for x in (row, n, plain, score))
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            sums = [np.add.reduceat(x, first) for x in ((n > 0).astype(np.int64), np.log10(plain), score)]
            yield pa.record_batch([pa.array(x) for x in (row[first], *sums)], ["row", "t_known", "t_base", "t_score"])

    return run


def score_documents(documents: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of each row of (doc_id, text); null text: empty.

    Known words are scored where the text is read, and the rows numbered. The others meet their counts and
    classes in a join by word, a key that no rare word makes hot, and return by the number of their row.
    """
    spark = documents.sparkSession
    held = share(spark, model)
    kind = dict(documents.dtypes)["doc_id"]
    texts = documents.select("doc_id", text_of().alias("text"))
    schema = (
        f"doc_id {kind}, row long, n_tokens long, known long, base_sum double, score_sum double, "
        "tail array<struct<word:long,at:long>>"
    )
    parts = write_once(texts.mapInArrow(_score(held), schema), scratch_path(spark, "scores"))
    tail = parts.select("row", F.inline("tail")).join(counts, "word", "left")
    rare = model.classes.total - 2
    tail = tail.select("row", "at", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("class", F.lit(rare)).cast("long").alias("class"))
    tail = tail.repartition("row").sortWithinPartitions("row", "at")
    sums = tail.mapInArrow(_score_tail(held), "row long, t_known long, t_base double, t_score double")
    sums = sums.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("t_known", "t_base", "t_score")))
    both = parts.drop("tail").join(sums, "row", "left")
    return both.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("t_known", F.lit(0))).alias("n_known"),
        (F.col("base_sum") + F.coalesce("t_base", F.lit(0.0))).alias("base_score"),
        (F.col("score_sum") + F.coalesce("t_score", F.lit(0.0))).alias("score"),
    )
