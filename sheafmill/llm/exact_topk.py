"""Exact top-k search by integer inner product, with multi-resolution segment statistics.

A vector's segments have a mean and a deviation. For two vectors, ``L * ((mean - mean)**2 + (dev - dev)**2)``
summed over segments of length L is a lower bound of their squared distance, and so, with both lengths
known, gives an upper bound of the inner product. Bounds are taken with few long segments first and
with more and shorter ones for what survives; only the last survivors are compared exactly. A query's
threshold is its k-th best exact score so far; rows are taken by descending length, so it rises early.

Blocks of queries meet blocks of rows by key; a pair of blocks returns its best few per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .vectors import candidates, matrix, queries, ranked, usable

SCALE = 256
QUERY_BLOCK = 2048
ROW_BLOCK = 32_768
STEP = 1024
SEGMENTS = (1, 4, 16)
LONG = 2**63 - 1


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each scaled by the root of its length."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, max(1, x.shape[1])))
    out = []
    for p in parts:
        if len(p):
            root = np.sqrt(len(p))
            out += [x[:, p].mean(1) * root, x[:, p].std(1) * root]
    return np.stack(out, 1) if out else np.zeros((len(x), 1))


def best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, id and score of the ``k`` best rows of each query, ties to smaller ids; values are whole numbers."""
    width = max(1, rows.shape[1])
    most = max([0.0, *(float(abs(m).max()) for m in (queries, rows) if m.size)])
    if most * most * width >= 2.0**53:
        return _best_large(queries, rows, ids, k)
    square = (rows * rows).sum(1)
    order = np.lexsort([ids, -square])
    rows, ids, square = rows[order], ids[order], square[order]
    own_square = (queries * queries).sum(1)
    levels = [(statistics(queries, s), statistics(rows, s)) for s in SEGMENTS]
    scores = np.full((len(queries), k), -np.inf)
    named = np.full((len(queries), k), LONG)
    slack = 1e-6 * (1 + np.sqrt(own_square)[:, None] * np.sqrt(square.max(initial=0.0)))
    for at in range(0, len(rows), STEP):
        some = slice(at, at + STEP)
        both = own_square[:, None] + square[None, some]
        alive = np.ones(both.shape, bool)
        for q, r in levels:  # coarse to fine
            r = r[some]
            active = np.flatnonzero(alive.any(1))
            if not len(active):
                break
            lower = ((q[active] ** 2).sum(1)[:, None] + (r**2).sum(1)[None, :] - 2 * q[active] @ r.T)
            upper = (both[active] - lower) / 2 + slack[active]
            alive[active] &= upper >= scores[active, -1:]
        active = np.flatnonzero(alive.any(1))
        if not len(active):
            continue
        exact = np.where(alive[active], queries[active] @ rows[some].T, -np.inf)
        if len(exact[0]) > k:
            place = np.argpartition(-exact, k - 1, axis=1)[:, :k]
            edge = np.take_along_axis(exact, place, 1).min(1)
            tied = (exact >= edge[:, None]).sum(1) > k
        else:
            place, tied = np.broadcast_to(np.arange(exact.shape[1]), exact.shape), np.zeros(len(active), bool)
        own_ids = ids[some]
        for n, q in enumerate(active):
            p = np.flatnonzero(exact[n] >= edge[n]) if tied[n] else place[n]
            p = p[exact[n, p] >= scores[q, -1]]
            if len(p):
                value, name = np.append(scores[q], exact[n, p]), np.append(named[q], own_ids[p])
                keep = np.lexsort([name, -value])[:k]
                scores[q], named[q] = value[keep], name[keep]
    who, place = np.nonzero(scores > -np.inf)
    return who, named[who, place], scores[who, place].astype(np.int64)


def _best_large(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same where doubles are not exact: whole numbers of any size, scores held to the range of a long."""
    whole = [[int(v) for v in r] for r in rows]
    who, named, scores = [], [], []
    for n, q in enumerate(queries):
        q = [int(v) for v in q]
        all_scores = sorted((-max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(q, r)))), i) for r, i in zip(whole, ids.tolist()))
        for s, i in all_scores[:k]:
            who.append(n)
            named.append(i)
            scores.append(-s)
    return np.array(who, np.int64), np.array(named, np.int64), np.array(scores, np.int64)


def search(df: DataFrame, id_col: str, vec_col: str, wanted: Column, k: int = 5, scale: int = SCALE, query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score long)``: the ``k`` highest integer inner products of each query.

    Components become ``floor(scale * x)``. ``wanted`` picks the queries among the rows ``(vec_id, vec)``. A
    query's own id is no candidate. Rows with a null id or vector or components that are null or not finite
    take no part; short vectors are filled up with zeros; repeated rows count once. Components and
    scores beyond the range of a long are held to it. Ids are taken to name one vector each. An empty table
    gives an empty result.
    """
    rows = usable(df, id_col, vec_col, nonzero=False)
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double")))
    reps, members = queries(rows, wanted)
    pool = candidates(rows, k)
    n_rows, n_queries = rows.count(), reps.count()
    row_blocks, query_blocks = max(1, -(-n_rows // row_block)), max(1, -(-n_queries // query_block))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = pool.select(deal("vec_id", row_blocks).alias("i"), every(query_blocks).alias("j"), "vec_id", "vec")
    right = reps.select(every(row_blocks).alias("i"), deal("rep", query_blocks).alias("j"), "rep", "vec")

    def compare(there: pa.Table, here: pa.Table) -> pa.Table:
        who, ids, scores = best(matrix(here.column("vec")), matrix(there.column("vec")), there.column("vec_id").to_numpy(), k + 1) if there.num_rows and here.num_rows else (np.empty(0, np.int64),) * 3
        return pa.table({"rep": here.column("rep").to_numpy()[who], "vec_id": ids, "score": scores})

    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(compare, "rep long, vec_id long, score long")
    return ranked(found, members, k)
