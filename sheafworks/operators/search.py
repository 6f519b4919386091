"""Exact nearest neighbours by cosine similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Queries are sent to every task up to this size; beyond it both sides are tiled.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Most rows and bytes of vectors on each side of a tile; bytes of scores worked on at a time.
QUERIES_PER_TILE = 131_072
CORPUS_PER_TILE = 131_072
TILE_BYTES = 64 * 1024 * 1024
SCORE_BYTES = 32 * 1024 * 1024
# Pairs of tiles wanted for each core, while a tile has so many rows at least.
PAIRS_PER_CORE = 8
LEAST_IN_TILE = 16_384

# Scores are rounded before ranking so that equal vectors tie; ties go to the lower id.
SCORE_DECIMALS = 6


def _unit_rows(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1 and a mask of the rows that have a direction."""
    usable = vectors.notna().to_numpy()
    if not usable.any():
        return np.zeros((0, 0)), usable
    matrix = np.stack(vectors[usable].to_list()).astype(np.float64)
    length = np.sqrt((matrix * matrix).sum(axis=1))
    usable[usable] = length > 0
    return matrix[length > 0] / length[length > 0, None], usable


def _top(pairs: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = pairs.sort_values(["query_id", "score", "neighbour_id"], ascending=[True, False, True])
    return ordered.groupby("query_id", sort=False).head(k)


def _candidates(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, skip_same: bool
) -> pd.DataFrame:
    """The best k rows of each query; of equal scores the lower ids.

    Works on blocks of queries and rows, so the scores in memory stay within SCORE_BYTES.
    """
    by_id = np.argsort(ids, kind="stable")
    ids, rows = _lowest_copies(ids[by_id], rows[by_id], k + skip_same)
    wide = min(len(rows), max(4 * k, SCORE_BYTES // 8 // 1_024))
    high = max(1, SCORE_BYTES // 8 // max(1, wide))
    near, own_near = rows.astype(np.float32), queries.astype(np.float32)
    found = []
    for q0 in range(0, len(queries) if len(rows) else 0, high):
        part = slice(q0, q0 + high)
        found.append(_best_of_rows(query_ids[part], queries[part], own_near[part], ids, rows, near, k, skip_same, wide))
    if not found:
        return pd.DataFrame({"query_id": query_ids[:0], "neighbour_id": ids[:0], "score": np.zeros(0)})
    return pd.concat(found) if len(found) > 1 else found[0]


def _lowest_copies(ids: np.ndarray, rows: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (in id order) without those that come after `keep` equal ones, which lose every tie to them."""
    if len(rows) <= keep or rows.shape[1] == 0:
        return ids, rows
    as_bytes = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel()
    _, kind = np.unique(as_bytes, return_inverse=True)
    order = np.argsort(kind, kind="stable")
    first = np.flatnonzero(np.diff(kind[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    kept = np.sort(order[place < keep])
    return (ids, rows) if len(kept) == len(ids) else (ids[kept], rows[kept])


def _best_of_rows(
    query_ids: np.ndarray,
    queries: np.ndarray,
    queries_near: np.ndarray,
    ids: np.ndarray,
    rows: np.ndarray,
    rows_near: np.ndarray,
    k: int,
    skip_same: bool,
    wide: int,
) -> pd.DataFrame:
    """The best k of all rows (in id order) for one block of queries.

    Products in single precision only rule out: a pair is scored exactly unless it is below the k-th best
    so far by more than they can be wrong. For vectors of length 1 that is (dim + 2) / 2**24 a product,
    and rounding moves a score by half a unit.
    """
    slack = (rows.shape[1] + 8) * 2.0**-23 + 10.0**-SCORE_DECIMALS
    bar = np.full(len(queries), -np.inf, dtype=np.float32)
    best = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    waiting, n_waiting = [best], 0
    for r0 in range(0, len(rows), wide):
        scores = queries_near @ rows_near[r0 : r0 + wide].T
        if r0 == 0 and scores.shape[1] > k + skip_same:
            head = scores[:, : max(1_024, 4 * (k + skip_same))]
            bar = np.partition(head, -(k + skip_same), axis=1)[:, -(k + skip_same)] - np.float32(slack)
        above = np.flatnonzero(scores >= bar[:, None])
        if len(above) > max(scores.size // 16, 2 * k * len(queries)):
            pairs = _block(query_ids, queries, ids[r0 : r0 + wide], rows[r0 : r0 + wide], k, skip_same)
        else:
            pairs = _exact(query_ids, queries, ids[r0 : r0 + wide], rows[r0 : r0 + wide], above, skip_same)
        waiting.append((pairs[0], pairs[1] + r0, pairs[2]))
        n_waiting += len(pairs[0])
        if n_waiting >= 2 * k * len(queries) or r0 + wide >= len(rows):
            best = _best_pairs(waiting, k)
            waiting, n_waiting = [best], 0
            counts = np.bincount(best[0], minlength=len(queries))
            full = counts >= k
            last = np.cumsum(counts) - 1
            bar[full] = np.maximum(bar[full], (best[2][last[full]] - slack).astype(np.float32))
    q, c, score = best
    return pd.DataFrame({"query_id": query_ids[q], "neighbour_id": ids[c], "score": score})


def _exact(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, pairs: np.ndarray, skip_same: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of some pairs, as places in the block; `pairs` are places in the flat block."""
    q, c = np.divmod(pairs, len(rows))
    if skip_same:
        other = query_ids[q] != ids[c]
        q, c = q[other], c[other]
    step = max(1, SCORE_BYTES // 32 // max(1, rows.shape[1]))
    scores = [np.einsum("ij,ij->i", queries[q[i : i + step]], rows[c[i : i + step]]) for i in range(0, len(q), step)]
    return q, c, np.round(np.concatenate(scores) if scores else np.zeros(0), SCORE_DECIMALS) + 0.0


def _best_pairs(parts: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k pairs of each query, by query, falling score and place of the row."""
    q, c, score = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((c, -score, q))
    q = q[order]
    first = np.flatnonzero(np.diff(q, prepend=-1))
    place = np.arange(len(q)) - np.repeat(first, np.diff(first, append=len(q)))
    order = order[place < k]
    return q[place < k], c[order], score[order]


def _block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, skip_same: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the best k of one block whose rows are in id order, with all pairs scored."""
    scores = np.round(queries @ rows.T, SCORE_DECIMALS) + 0.0
    if skip_same:
        scores[query_ids[:, None] == ids[None, :]] = -np.inf
    keep = np.isfinite(scores)
    if scores.shape[1] > k:
        bar = np.partition(scores, -k, axis=1)[:, -k][:, None]
        above, level = scores > bar, scores == bar
        room = k - above.sum(axis=1, keepdims=True)
        keep &= above | (level & (np.cumsum(level, axis=1, dtype=np.int32) <= room))
    q, c = np.nonzero(keep)
    return q, c, scores[q, c]


def _rank(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbour_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def topk_cosine(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    corpus_id: str = "id",
    query_id: str = "id",
    corpus_vector: str = "embedding",
    query_vector: str = "embedding",
    skip_same: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """(query_id, neighbour_id, score, rank) of the k most similar corpus rows per query.

    Each task scores its part of the corpus in Arrow batches and passes on k rows per
    query, so pairs are never materialised and the corpus is not shuffled. When the
    queries are too big to send to every task, both sides are cut into tiles by a hash of
    the id and each tile pair is scored alone. Vectors of length 0 have no direction and
    are left out. `skip_same` leaves out the row with the query's own id.
    """
    c = corpus.select(F.col(corpus_id).alias("id"), F.col(corpus_vector).alias("vector"))
    q = queries.select(F.col(query_id).alias("id"), F.col(query_vector).alias("vector"))
    size = q.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dim")).first()
    id_type = c.schema["id"].dataType.simpleString()
    schema = f"query_id {q.schema['id'].dataType.simpleString()}, neighbour_id {id_type}, score double"
    if size["n"] * size["dim"] * 8 <= max_broadcast_bytes:
        return _rank(_against_broadcast(c, q, k, skip_same, schema), k)
    return _rank(_tiled(c, q, k, size["n"], size["dim"], skip_same, schema), k)


def _against_broadcast(corpus: DataFrame, queries: DataFrame, k: int, skip_same: bool, schema: str) -> DataFrame:
    known = queries.toPandas()
    units, usable = _unit_rows(known["vector"])
    shared = corpus.sparkSession.sparkContext.broadcast((known["id"].to_numpy()[usable], units))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, query_rows = shared.value
        best, held = None, []
        for batch in chain(batches, [None]):
            if batch is not None and len(query_rows):
                rows, mask = _unit_rows(batch["vector"])
                if len(rows):
                    held.append((batch["id"].to_numpy()[mask], rows))
            # Arrow batches are small; many are scored at once, or most of the time would go into merging.
            if held and (batch is None or sum(rows.nbytes for _, rows in held) >= TILE_BYTES):
                ids, rows = (np.concatenate(column) for column in zip(*held))
                found = _candidates(query_ids, query_rows, ids, rows, k, skip_same)
                best, held = found if best is None else _top(pd.concat([best, found]), k), []
        if best is not None:
            yield best

    return corpus.mapInPandas(score, schema)


def _tiled(
    corpus: DataFrame, queries: DataFrame, k: int, n_queries: int, dim: int, skip_same: bool, schema: str
) -> DataFrame:
    """Each row is sent once per tile of the other side, so tiles are as large as memory allows."""
    fit = max(1, TILE_BYTES // (8 * max(1, dim)))
    n_rows = corpus.count()
    # Enough pairs of tiles for all cores, or the last ones would run alone.
    side = math.isqrt(PAIRS_PER_CORE * corpus.sparkSession.sparkContext.defaultParallelism) + 1
    q_tiles = max(1, -(-n_queries // min(QUERIES_PER_TILE, fit)), min(side, n_queries // LEAST_IN_TILE))
    c_tiles = max(1, -(-n_rows // min(CORPUS_PER_TILE, fit)), min(side, n_rows // LEAST_IN_TILE))

    def tiles(df: DataFrame, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(own_count)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        query_rows, q_mask = _unit_rows(left["vector"])
        rows, c_mask = _unit_rows(right["vector"])
        if len(query_rows) == 0 or len(rows) == 0:
            return pd.DataFrame({"query_id": [], "neighbour_id": [], "score": []})
        return _candidates(left["id"].to_numpy()[q_mask], query_rows, right["id"].to_numpy()[c_mask], rows, k, skip_same)

    left = tiles(queries, "q_tile", q_tiles, "c_tile", c_tiles).groupBy("q_tile", "c_tile")
    right = tiles(corpus, "c_tile", c_tiles, "q_tile", q_tiles).groupBy("q_tile", "c_tile")
    return left.cogroup(right).applyInPandas(score, schema)


def recall_at_k(found: DataFrame, exact: DataFrame, version: str = "version") -> DataFrame:
    """Share of each version's neighbours that are among the exact ones.

    `found` holds (version, query_id, neighbour_id), `exact` (query_id, neighbour_id).
    """
    hits = found.join(
        exact.select("query_id", "neighbour_id", F.lit(1).alias("hit")), ["query_id", "neighbour_id"], "left"
    )
    return hits.groupBy(version).agg(
        F.count(F.lit(1)).alias("retrieved"),
        F.count("hit").alias("relevant"),
        (F.count("hit") / F.count(F.lit(1))).alias("recall"),
    )
