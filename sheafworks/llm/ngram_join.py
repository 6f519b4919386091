"""Set similarity join on word n-grams with signature trees.

1. Each text becomes its set of n-gram hashes. Texts with equal sets are one class, named by a
   128-bit hash of the set; copies are never compared.
2. A set that has a partner of Jaccard similarity t shares at least t of its own n-grams with it.
   A merged count-min sketch (never too low) tells which n-grams may be in another set; classes
   with fewer than t shared ones can have no partner and leave here.
3. The sets left meet through the first (1 - t) of their n-grams, rarest first: two similar sets
   have at least one of these in common. Sets joined by such n-grams, directly or through others,
   are a cluster; there is no link between clusters.
4. Sets of a cluster are compared inside tasks of bounded size with signature trees: a leaf holds
   a set's hashed bitmap and size, an inner node the OR of its children and their range of sizes.
   Two trees are walked at once; a pair of nodes is left when sizes are too far apart, when the
   largest possible overlap is too small, or when all below is already one component.
5. A cluster bigger than a task is cut into blocks. All blocks meet the first block; then only
   sets outside the largest component met so far are compared with the rest of the cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import Words, join_hashes, mix64, shielded, slices, text_of, window_hashes, write_once
from .components import connected_components
from .sketch import build, build_counts, estimated, maybe_repeated

#: Sets in one block of a cluster, and bytes of their n-grams; a task holds two blocks.
BLOCK = 2048
BLOCK_BYTES = 32 << 20
FANOUT = 16
BITMAP_BITS = 4096
#: Pairs looked at together while walking the trees.
FRONT = 2048
MAX_BITS = 31
#: The largest sketch of counts: 2^26 cells, 64 MB.
MAX_COUNT_BITS = 26


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct n-gram hashes of each text in ascending order.

    A text with fewer than `size` words, but any, has one n-gram: all its words.
    """
    words = Words(texts, lower=True)
    n = np.diff(words.bounds)
    first = words.window_starts(size)
    grams = window_hashes(words.hashes[0], size)[first] if len(first) else np.empty(0, np.uint64)
    text = np.searchsorted(words.bounds, first, "right") - 1
    for length in range(1, size):
        short = np.flatnonzero(n == length)
        if len(short):
            at = words.bounds[:-1][short]
            whole = np.full(len(short), length, np.uint64)
            for k in range(length):
                whole = join_hashes(whole, words.hashes[0][at + k])
            grams, text = np.append(grams, whole), np.append(text, short)
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    grams, text = grams[keep], text[keep]
    return grams, np.searchsorted(text, np.arange(len(n) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
    return total[bounds[1:]] - total[bounds[:-1]]


def _set_names(grams: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A 128-bit hash of each set; None for the empty one."""
    n = np.diff(bounds).astype(np.uint64)
    pair = np.stack([mix64(_sums(mix64(grams + np.uint64(s)), bounds) + n) for s in (11, 29)], 1).astype(">u8")
    return [pair[i].tobytes() if n[i] else None for i in range(len(n))]


def _name_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for part in slices(batches):
            grams, bounds = shingle_sets(part.column("text"), size)
            others = [n for n in part.schema.names if n != "text"]
            columns = [part.column(n) for n in others]
            columns += [pa.array(np.diff(bounds)), pa.array(_set_names(grams, bounds), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "n_shingles", "node"])

    return run


def _shared_sets(size: int, percent: int, bits: int, sketch):
    """The sets of which at least `percent` may be found elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for part in slices(batches):
            grams, bounds = shingle_sets(part.column("text"), size)
            n = np.diff(bounds)
            shared = _sums(maybe_repeated(grams, sketch.value, bits).astype(np.uint64), bounds).astype(np.int64)
            names = _set_names(grams, bounds)
            chosen: dict[bytes, bytes] = {}
            for i in np.flatnonzero((100 * shared >= percent * n) & (n > 0)).tolist():
                chosen.setdefault(names[i], grams[bounds[i] : bounds[i + 1]].tobytes())
            yield pa.record_batch(
                [pa.array(list(chosen), pa.binary()), pa.array(list(chosen.values()), pa.binary())], ["node", "grams"]
            )

    return run


def _all_grams(batch: pa.RecordBatch) -> np.ndarray:
    held = [np.frombuffer(g.as_buffer(), np.uint64) for g in batch.column("grams")]
    return np.concatenate(held) if held else np.empty(0, np.uint64)


def _leading(percent: int, bits: int, counts):
    """The first n-grams of each set, as many as a partner may lack and one more, rarest first.

    Rare means a low estimated count among the sets; any order is right as long as it is the same
    for all sets. An n-gram whose estimate is 1 is in no other set and is not handed on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch in batches:
            nodes, grams = [], []
            for node, held in zip(batch.column("node"), batch.column("grams"), strict=True):
                own = np.frombuffer(held.as_buffer(), np.uint64)
                often = estimated(own, counts.value, bits)
                lead = np.lexsort((own, often))[: len(own) - -(-percent * len(own) // 100) + 1]
                lead = lead[often[lead] > 1]
                nodes += [node.as_py()] * len(lead)
                grams.append(own[lead].view(np.int64))
            flat = np.concatenate(grams) if grams else np.empty(0, np.int64)
            yield pa.record_batch([pa.array(nodes, pa.binary()), pa.array(flat)], ["node", "gram"])

    return run


class SignatureTree:
    """Sets in a given order, with bitmaps, sizes and collision counts of all levels.

    Level 0 are the sets; node i of level k + 1 covers nodes FANOUT * i to FANOUT * (i + 1) - 1
    of level k. The overlap of two sets is at most the bits they share plus the n-grams of the
    smaller count that fell on a bit already set.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        size = np.array([len(s) for s in sets])
        bits = np.zeros((len(sets), BITMAP_BITS // 8), np.uint8)
        for i, own in enumerate(sets):
            at = np.bincount((own % np.uint64(BITMAP_BITS)).astype(np.int64), minlength=BITMAP_BITS) > 0
            bits[i] = np.packbits(at)
        bitmap = bits.view(np.uint64)
        over = size - np.bitwise_count(bitmap).sum(1, dtype=np.int64)
        self.levels = [(bitmap, size, size, over)]
        while len(self.levels[-1][0]) > 1:
            bitmap, low, high, over = self.levels[-1]
            at = np.arange(0, len(bitmap), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bitmap, at),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(over, at),
                )
            )

    def may_link(self, level: int, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        bitmap, low, high, over = self.levels[level]
        close = (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
        found = np.flatnonzero(close)
        x, y = x[found], y[found]
        most = np.bitwise_count(bitmap[x] & bitmap[y]).sum(1, dtype=np.int64) + np.minimum(over[x], over[y])
        # overlap >= p/100 * union  <=>  overlap * (100 + p) >= p * (sum of sizes)
        close[found] = most * (100 + percent) >= percent * (low[x] + low[y])
        return close

    def links(self, percent: int) -> list[tuple[int, int]]:
        """Links that join all sets of each component; walks the tree against itself."""
        root = np.arange(len(self.sets))
        found: list[tuple[int, int]] = []
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        while stack:
            level, x, y = stack.pop()
            if len(x) > FRONT:
                stack.append((level, x[FRONT:], y[FRONT:]))
                x, y = x[:FRONT], y[:FRONT]
            if level not in spans:
                spans[level] = self._spans(root, level)
            low, high = spans[level]
            apart = (low[x] != high[x]) | (low[y] != high[y]) | (low[x] != low[y])
            x, y = x[apart], y[apart]
            hit = self.may_link(level, x, y, percent)
            x, y = x[hit], y[hit]
            if not len(x):
                continue
            if level:
                stack.append((level - 1, *self._children(level - 1, x, y)))
                continue
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                if root[i] != root[j] and similar(self.sets[i], self.sets[j], percent):
                    root[root == max(root[i], root[j])] = min(root[i], root[j])
                    found.append((i, j))
                    spans = {}
        return found

    def _spans(self, root: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        low = high = root
        for _ in range(level):
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        return low, high

    def _children(self, level: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.arange(FANOUT)
        left = np.repeat(x[:, None] * FANOUT + step, FANOUT, axis=1).ravel()
        right = np.tile(y[:, None] * FANOUT + step, (1, FANOUT)).ravel()
        n = len(self.levels[level][0])
        # A node meets itself only to reach its children; sets do not meet themselves.
        keep = (left < n) & (right < n) & (left < right if level == 0 else left <= right)
        return left[keep], right[keep]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for ascending distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _tree_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("n", "ascending"), ("node", "ascending")])
        nodes = table.column("node").to_pylist()
        sets = [np.frombuffer(g.as_buffer(), np.uint64) for g in table.column("grams")]
        pairs = SignatureTree(sets).links(percent)
        return pa.table(
            {
                "a": pa.array([nodes[i] for i, _ in pairs], pa.binary()),
                "b": pa.array([nodes[j] for _, j in pairs], pa.binary()),
            }
        )

    return run


def _compare(sets: DataFrame, dealt: DataFrame, percent: int) -> DataFrame:
    """Links found in each group (cluster of it `task`) of at most two blocks; `dealt` has the keys."""
    groups = sets.join(dealt.select("task", "cluster", "node"), "node")
    groups = groups.select("task", "cluster", "node", "grams", F.length("grams").alias("n"))
    return groups.groupBy("task").applyInArrow(_tree_links(percent), "a binary, b binary")


def linked_classes(documents: DataFrame, size: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """(node, root): the component of each class of equal sets that has a link to another class.

    `documents` has a text column. See `component_ids` for what a link is.
    """
    spark = documents.sparkSession
    texts = documents.select(text_of().alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MAX_BITS, max(10, math.ceil(math.log2(total / 3 + 1))))
    hashes_of = lambda part: shingle_sets(part.column("text"), size)[0]
    # At most 256 MB of bits, whatever the data.
    sketch = spark.sparkContext.broadcast(build(texts, hashes_of, bits, 1))
    shared = texts.mapInArrow(_shared_sets(size, percent, bits, sketch), "node binary, grams binary")
    sets = write_once(shared.dropDuplicates(["node"]), scratch_path(spark, "sets"))

    total = sets.agg(F.sum(F.length("grams"))).first()[0] or 0
    bits = min(MAX_COUNT_BITS, max(10, math.ceil(math.log2(total / 2 + 1))))
    # At most 64 MB, whatever the data.
    counts = spark.sparkContext.broadcast(build_counts(sets.select("grams"), _all_grams, bits))
    lead = sets.mapInArrow(_leading(percent, bits, counts), "node binary, gram long")
    hubs = lead.groupBy("gram").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    meets = lead.join(hubs, "gram").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    clusters = connected_components(meets).withColumnRenamed("root", "cluster")
    clusters = write_once(clusters, scratch_path(spark, "clusters"))

    # Which set goes to which tasks is settled on keys; the n-grams are moved to the tasks once.
    placed = _placed(sets, clusters, block)
    weight = placed.where("blocks = 1").agg(F.count(F.lit(1)), F.sum("bytes")).first()
    groups = max(1, -(-weight[0] // block), -(-(weight[1] or 0) // BLOCK_BYTES))
    small = placed.where("blocks = 1")
    small = small.withColumn("task", F.concat_ws(":", F.lit("s"), F.expr(f"pmod(xxhash64(cluster), {groups})")))
    big = placed.where("blocks > 1")
    # The first block goes to every task of its cluster, the others to their own.
    first = F.when(F.col("block") == 0, F.sequence(F.lit(1), F.col("blocks") - 1)).otherwise(F.array("block"))
    big = big.withColumn("other", F.explode(first))
    big = big.withColumn("task", F.concat_ws(":", F.lit("b"), F.hex("cluster"), "other"))
    links = _compare(sets, small.unionByName(big.drop("other")), percent)
    links = write_once(links, scratch_path(spark, "links"))
    rest = _outside_largest(placed.where("blocks > 1"), links)
    if rest is not None:
        links = links.union(_compare(sets, rest, percent))
    return connected_components(links)


def _placed(sets: DataFrame, clusters: DataFrame, block: int) -> DataFrame:
    """(node, bytes, cluster, blocks, block): a table of keys with the block of each set in its cluster.

    A block has about `block` sets or BLOCK_BYTES of n-grams, whichever is less.
    """
    keys = clusters.join(sets.select("node", F.length("grams").alias("bytes")), "node")
    most = F.greatest(F.count(F.lit(1)) / block, F.sum("bytes") / BLOCK_BYTES)
    sizes = keys.groupBy("cluster").agg(F.ceil(most).cast("int").alias("blocks"))
    placed = keys.join(sizes, "cluster").withColumn("block", F.expr("pmod(xxhash64(node), blocks)").cast("int"))
    return write_once(placed, scratch_path(sets.sparkSession, "placed"))


def _outside_largest(members: DataFrame, links: DataFrame) -> DataFrame | None:
    """Sets of big clusters that are not in the cluster's largest component, and the sets they must still meet, by task.

    None if there are none. Each such set meets the whole cluster, so what is dealt out grows
    with (sets outside / block) * (sets of the cluster), not with the square of the cluster.
    """
    if members.isEmpty():
        return None
    roots = connected_components(links)
    own = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counted = own.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("cluster").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    out = own.join(best, "cluster").where("root <> main").select("cluster", "node", "bytes", "blocks")
    out = write_once(out, scratch_path(members.sparkSession, "outside"))
    if out.isEmpty():
        return None
    most = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("bytes") / BLOCK_BYTES)
    tiles = out.groupBy("cluster").agg(F.ceil(most).cast("int").alias("tiles"))
    outside = out.join(tiles, "cluster")
    outside = outside.withColumn("tile", F.expr("pmod(xxhash64(1, node), tiles)").cast("int"))
    outside = outside.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = members.join(tiles, "cluster").withColumn("other", F.col("block"))
    every = every.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    columns = ["cluster", "node", "tile", "other"]
    both = outside.select(*columns).unionByName(every.select(*columns)).distinct()
    return both.withColumn("task", F.concat_ws(":", F.lit("r"), F.hex("cluster"), "tile", "other"))


def classify(documents: DataFrame, size: int = 5, percent: int = 80, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows, classes), both tables in the shared folder.

    rows: doc_id, kt (a hash of the text), n_shingles and node, the class, of each row; node is null
    for texts without words. classes: node, least (smallest doc_id), copies and root, the component.
    """
    spark = documents.sparkSession
    texts = documents.select("doc_id", F.xxhash64(text_of()).alias("kt"), text_of().alias("text"))
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, kt long, n_shingles long, node binary"
    rows = write_once(texts.mapInArrow(_name_sets(size), schema), scratch_path(spark, "names"))
    classes = rows.where("node is not null").groupBy("node")
    classes = classes.agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    roots = linked_classes(documents, size, percent, block)
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rows, write_once(classes, scratch_path(spark, "classes"))


def component_ids(documents: DataFrame, size: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of `documents` (doc_id, text).

    Words are runs of [^\\x20\\x09-\\x0D] with A-Z in lower case; a text's set holds its distinct
    runs of `size` words, or all its words as one if there are fewer. Two texts are linked when
    100 * intersection >= percent * union. component_id is the smallest doc_id that links lead to.
    A null, empty or blank text has no set, no link, and its own doc_id as component. Equal rows
    and ids used twice are fine; a null id is nobody's smallest, so a component of null ids only
    has null. Other columns are not looked at.
    """
    rows, classes = classify(documents, size, percent, block)
    linked = classes.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("members"))
    # Classes of one text need no answer: their component is their own id.
    answers = classes.join(linked.where("members > 1"), "root").select("node", "component_id")
    alone = F.coalesce("component_id", "doc_id")
    return rows.join(answers, "node", "left").select("doc_id", "n_shingles", alone.alias("component_id"))


def one_of_each(documents: DataFrame, size: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest doc_id stays.

    Ties go by text hash; of equal rows one stays. Null ids come after all others. Texts without
    words all stay. Columns of any other names stay as they are.
    """
    return shielded(documents, lambda docs: _one_of_each(docs, size, percent, block))


def _one_of_each(documents: DataFrame, size: int, percent: int, block: int) -> DataFrame:
    columns = documents.columns
    rows, classes = classify(documents, size, percent, block)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "kt")
    best = rows.join(classes.select("node", "root"), "node").groupBy("root").agg(F.min(order).alias("best"))
    best = best.select(F.col("best.doc_id").alias("_id"), F.col("best.kt").alias("_best")).distinct()
    left = documents.withColumn("_kt", F.xxhash64(text_of()))
    both = left.join(best, (F.col("_kt") == F.col("_best")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    copy = F.row_number().over(Window.partitionBy("_kt", "doc_id").orderBy(F.lit(0)))
    worded = text_of().rlike(r"[^\x20\x09-\x0D]")
    return both.withColumn("_copy", copy).where(~worded | (F.col("_best").isNotNull() & (F.col("_copy") == 1))).select(*columns)
