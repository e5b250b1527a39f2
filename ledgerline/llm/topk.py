"""Exact top-k by inner product: columnar branch-and-bound over integer vectors.

Queries and candidates are dealt into tiles of bounded bytes. Inside a tile vectors lie dimension by dimension, those of most
energy first, and candidates from long to short. Scores build up block of dimensions by block; after each block a (query,
candidate) pair stays only if its score so far plus the most that the remaining blocks can add (the sum of the products of the
blocks' lengths, by Cauchy and Schwarz) reaches that query's k-th best score. While many pairs are left, the candidates that
some query still needs are compacted; when few are left, the pairs themselves. Every query starts with the k-th best score it
has in a seed of vectors, found before; each tile returns at most k rows per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import prepare, saved

#: Bytes of a tile's candidates and queries, vectors of the seed, candidates and queries looked at together, dimensions of a block.
CANDIDATE_BYTES, QUERY_BYTES, SEEDS, PANEL, GROUP, BLOCK = 1 << 23, 1 << 21, 4_096, 2_048, 64, 8
#: Share of a panel's pairs from which on they are no longer multiplied as a rectangle.
FEW = 0.25
SCALE = 1024


def integer_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(1024 x) of every component. Without an id, a vector, or with a null or non-finite component: left out.

    Components of 2^52 and more, whose products no 64-bit score holds, are left out too. Repeated rows stay.
    """
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < 2.0**52))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    kept = df.where(F.col("vec_id").isNotNull()).where(F.coalesce(usable, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))


def _columns(lists: pa.ListArray) -> np.ndarray:
    """One row per dimension."""
    n = len(lists)
    flat = lists.flatten().to_numpy()
    return np.ascontiguousarray(flat.reshape(n, -1).T) if n else flat.reshape(0, 0)


def _lengths(columns: np.ndarray) -> np.ndarray:
    """Length of each block of each vector, one row per block."""
    return np.sqrt(np.add.reduceat(columns.astype(np.float64) ** 2, np.arange(0, len(columns), BLOCK), axis=0))


def _reaches(score: np.ndarray, rest: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Whether score and rest may come up to the floor, with room for rounding."""
    most = score.astype(np.float64) + rest
    return most + 1 + 1e-9 * (np.abs(most) + rest) >= floor


def _panel(own, cand, q_len, c_len, floor, counts):
    """Pairs (query, candidate, score) of a panel that come up to their query's floor; all others are proved not to."""
    every = np.arange(cand.shape[1])
    if not len(own):
        pairs = np.repeat(np.arange(own.shape[1]), len(every)), np.tile(every, own.shape[1])
        return *pairs, np.zeros(len(pairs[0]), own.dtype)
    alive = np.flatnonzero(_reaches(np.zeros(1), q_len.T @ c_len, floor[:, None]).any(axis=0))
    score, pairs = np.zeros((own.shape[1], len(alive)), own.dtype), None
    for block, d in enumerate(range(0, len(own), BLOCK)):
        if pairs is None:
            score = score + own[d : d + BLOCK].T @ cand[d : d + BLOCK, alive]
            counts[0] += score.size
            stay = _reaches(score, q_len[block + 1 :].T @ c_len[block + 1 :, alive], floor[:, None])
            if not stay.size or stay.mean() < FEW:
                q, c = np.nonzero(stay)
                pairs, score = (q, alive[c]), score[q, c]
            elif not (some := stay.any(axis=0)).all():
                alive, score = alive[some], score[:, some]
        else:
            q, c = pairs
            score = score + (own[d : d + BLOCK, q] * cand[d : d + BLOCK, c]).sum(axis=0)
            counts[0] += len(q)
            stay = _reaches(score, (q_len[block + 1 :, q] * c_len[block + 1 :, c]).sum(axis=0), floor[q])
            pairs, score = (q[stay], c[stay]), score[stay]
    if pairs is None:
        q, c = np.nonzero(_reaches(score, np.zeros(1), floor[:, None]))
        pairs, score = (q, alive[c]), score[q, c]
    return *pairs, score


def _best(score: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    if score.dtype == object:
        return np.array(sorted(range(len(score)), key=lambda i: (-score[i], names[i]))[:k], np.int64)
    return np.lexsort((names, -score))[:k]


def search(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int, floors=None, counts=None):
    """The best ``k`` of the tile for each query: score, then smaller id; rows (query id, id, score).

    ``queries`` and ``candidates`` hold one vector per column. ``floors`` are scores that a query's k-th best in all reaches (-inf:
    none known); rows below them may be missing. ``counts`` receives the number of (query, candidate, block) multiplied. No queries
    or candidates: no rows. A score beyond 64 bits is left out after the best were chosen.
    """
    counts = [0] if counts is None else counts
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, len(queries))
    # doubles add whole numbers below 2^53 exactly; beyond that integers, and beyond those Python's
    kind = np.float64 if most < 2.0**53 else np.int64 if most < 2.0**63 else object
    energy = (candidates.astype(np.float64) ** 2).sum(axis=1)
    by_energy = np.argsort(-energy, kind="stable")
    long_first = np.argsort(-(candidates.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    queries, candidates, ids = queries[by_energy], candidates[np.ix_(by_energy, long_first)], ids[long_first]
    if floors is None or kind is object:
        floors = np.full(len(query_ids), -np.inf)
    close = np.lexsort(queries[: min(4, len(queries))][::-1]) if len(queries) else np.arange(len(query_ids))
    found = []
    for g in range(0, len(query_ids), GROUP):
        at = close[g : g + GROUP]
        own, own_ids, floor = queries[:, at].astype(kind), query_ids[at], floors[at].astype(np.float64)
        q_len = _lengths(own) if len(own) else own
        best_score, best_id = [np.empty(0, kind)] * len(at), [np.empty(0, np.int64)] * len(at)
        for p in range(0, len(ids), PANEL):
            panel, names = candidates[:, p : p + PANEL], ids[p : p + PANEL]
            q, c, score = _panel(own, panel.astype(kind), q_len, _lengths(panel) if len(panel) else panel, floor, counts)
            other = names[c] != own_ids[q]
            q, c, score = q[other], c[other], score[other]
            order = np.argsort(q, kind="stable")
            q, c, score = q[order], c[order], score[order]
            starts = np.searchsorted(q, np.arange(len(at) + 1))
            for i in np.unique(q).tolist():
                part = slice(starts[i], starts[i + 1])
                scores, near = np.concatenate((best_score[i], score[part])), np.concatenate((best_id[i], names[c[part]]))
                keep = _best(scores, near, k)
                best_score[i], best_id[i] = scores[keep], near[keep]
                if len(keep) == k and kind is not object:
                    floor[i] = max(floor[i], float(best_score[i][-1]))
        for i, query_id in enumerate(own_ids.tolist()):
            found.extend((query_id, int(n), int(x)) for n, x in zip(best_id[i], best_score[i]) if -(2**63) <= int(x) < 2**63)
    return found


def _tile(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            rows = search(
                _columns(left.column("v").combine_chunks()), left.column("vec_id").to_numpy(),
                _columns(right.column("v").combine_chunks()), right.column("vec_id").to_numpy(), k,
                left.column("floor").to_numpy(),
            )
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    return run


def _tiled(queries: DataFrame, candidates: DataFrame, rows: int, columns: int, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of every tile; each query meets each candidate once, those of other length never."""
    width = F.size("v").alias("width")
    queries = queries.select(
        "vec_id", "v", "floor", width, F.pmod("place", F.lit(rows)).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("col"),
    )
    candidates = candidates.select(  # columns of its own: both sides may be read from one table
        F.col("vec_id").alias("vec_id"), F.col("v").alias("v"), width, F.pmod("place", F.lit(columns)).cast("int").alias("col"),
        F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row"),
    )
    keys = ["width", "row", "col"]
    return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(_tile(k), "query_id long, vec_id long, score long")


def _ranked(found: DataFrame) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))


def top_k(df: DataFrame, is_query, k: int = 10, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query over every other vector, ties to the
    smaller id, fewer if there are fewer; no rows from an empty table. Vectors of different length are not compared. All rows of an
    id take part: those of a query's id pool their scores and are not compared with each other.

    Every vector meets every query once: tiles are (block of candidates, block of queries), blocks are dealt by a hash of id and
    place, and their number follows the bytes, so a tile's size grows neither with the table nor with the vectors' length. The seed
    is the share of the rows, about ``SEEDS``, whose hash says so; it only gives the queries their first floors.
    """
    prepare(df.sparkSession)
    dealt = F.xxhash64("vec_id", F.monotonically_increasing_id()).alias("place")  # rows of one id go apart; written, so it stays
    vectors = saved(integer_vectors(df, vector).select("vec_id", "v", dealt), "vectors")
    sizes = vectors.select(F.lit(1).alias("n"), (8 * F.size("v")).alias("bytes"), is_query.alias("asked"))
    total, held, asked = sizes.agg(F.sum("n"), F.sum("bytes"), F.sum(F.when(F.col("asked"), F.col("bytes")))).first()
    columns, rows = (held or 0) // CANDIDATE_BYTES + 1, (asked or 0) // QUERY_BYTES + 1
    nothing = F.lit(float("-inf"))
    queries = vectors.where(is_query)
    seeds = vectors.where(F.pmod(F.xxhash64("place"), F.lit((total or 0) // SEEDS + 1)) == 0)
    first = _ranked(_tiled(queries.withColumn("floor", nothing), seeds, rows, 1, k)).where(F.col("rank") == k)
    first = saved(first.select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor")), "floors")
    queries = queries.join(first, "vec_id", "left").withColumn("floor", F.coalesce("floor", nothing))
    found = _ranked(_tiled(queries, vectors, rows, columns, k)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
