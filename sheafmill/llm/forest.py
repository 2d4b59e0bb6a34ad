"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Trees are fitted on a sample of at most ``sample_rows`` vectors; every vector is then put into one leaf of
each tree. A vector gets one more component that brings all to one length, so that a large inner product
is a small angle. A node splits at the median of the projections on a random direction, the difference
of two sampled vectors.

Neighbouring leaves of a tree share a shelf, which one task compares: it returns the few best of each query over all
leaves that the query visits there.

A query searches all trees through one priority queue. A node's priority is the sum of the query's signed
distances from the splits on its path; the best node of any tree is opened next, until the leaves taken
hold ``budget`` rows. The rows of these leaves are compared exactly, in double precision, leaf by leaf.

``budget`` is fitted: for ``PROBES`` queries the true neighbours are found by brute force, and the
smallest budget is taken that reaches ``recall`` over them. Isotropic vectors need a large share of the
rows, vectors with structure far less.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import spread, stored
from .vectors import candidates, matrix, queries, ranked, usable

TREES = 12
LEAF_ROWS = 800
SAMPLE_ROWS = 20_000
LEAST_SAMPLE = 16
#: Rows of a shelf.
SHELF_ROWS = 65_536
PROBES = 200
RECALL = 0.95


@dataclass
class Tree:
    """Nodes ``i`` split by ``directions[i]`` at ``cuts[i]``; children below zero are leaves, ``~leaf``."""

    directions: np.ndarray
    cuts: np.ndarray
    low: list[int]
    high: list[int]
    leaves: int
    root: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.directions.T - self.cuts
        at = np.full(len(x), self.root)
        low, high = np.array(self.low + [0]), np.array(self.high + [0])
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            at[inner] = np.where(margin[inner, node] >= 0, high[node], low[node])
        return ~at


def grow(x: np.ndarray, leaf: int, random: np.random.Generator) -> Tree:
    directions, cuts, low, high, leaves = [], [], [], [], 0

    def split(own: np.ndarray) -> int:
        nonlocal leaves
        if len(own) > leaf:
            for _ in range(3):  # a pair of copies gives no direction
                a, b = x[random.choice(own, 2, replace=False)]
                d = a - b if (a != b).any() else random.normal(size=x.shape[1])
                d = d / np.linalg.norm(d)
                at = x[own] @ d
                cut = float(np.median(at))
                if 0 < int((at < cut).sum()) < len(own):
                    node = len(cuts)
                    directions.append(d)
                    cuts.append(cut)
                    low.append(0)
                    high.append(0)
                    low[node], high[node] = split(own[at < cut]), split(own[at >= cut])
                    return node
        leaves += 1
        return ~(leaves - 1)

    root = split(np.arange(len(x)))
    return Tree(np.array(directions).reshape(len(cuts), x.shape[1]), np.array(cuts), low, high, leaves, root)


def visit(trees: list[Tree], query: np.ndarray) -> Iterator[tuple[int, int]]:
    """``(tree, leaf)`` of all trees, best first, through one queue."""
    margins = [(t.directions @ query - t.cuts).tolist() for t in trees]
    heap = [(0.0, n, t.root) for n, t in enumerate(trees)]
    heapq.heapify(heap)
    while heap:
        cost, n, node = heapq.heappop(heap)
        if node < 0:
            yield n, ~node
            continue
        margin = margins[n][node]
        heapq.heappush(heap, (cost + margin, n, trees[n].low[node]))
        heapq.heappush(heap, (cost - margin, n, trees[n].high[node]))


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component, so that all rows have the length ``longest``."""
    rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0.0))
    return np.hstack([x, rest[:, None]])


def _exact(queries: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each query the places and scores of its ``k`` best rows; the scores do not depend on what else is compared."""
    for at in range(0, len(queries), 512):
        rough = queries[at : at + 512] @ x.T
        for n, row in enumerate(rough, at):
            if len(row) > k:
                least = np.partition(row, -k)[-k]
                own = np.flatnonzero(row >= least - 1e-9 * max(1.0, abs(least)))
            else:
                own = np.arange(len(row))
            score = (queries[n] * x[own]).sum(1)
            order = np.lexsort([ids[own], -score])[:k]
            yield n, own[order], score[order]


def brute(rows: DataFrame, reps: np.ndarray, k: int) -> DataFrame:
    """``(query, vec_id, score, vec)``: the ``k`` best of each query in each task; ``reps`` are few queries."""
    kind = rows.schema["vec"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids = part.column("vec_id").to_numpy()
            for n, own, score in _exact(reps, matrix(part.column("vec")), ids, k):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), n)), pa.array(ids[own]), pa.array(score), part.column("vec").take(pa.array(own))], ["query", "vec_id", "score", "vec"])

    return rows.mapInArrow(run, f"query long, vec_id long, score double, vec {kind}")


def _budget(trees: list[Tree], sizes: dict[tuple[int, int], int], rows: DataFrame, reps: DataFrame, longest: float, k: int, recall: float) -> int:
    """The fewest rows that must be compared for the recall, over the probing queries."""
    probes = matrix(pa.array([r.vec for r in reps.orderBy(F.xxhash64("rep")).limit(PROBES).collect()]))
    found = brute(rows, probes, k)
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    truth = found.withColumn("rank", best).where(F.col("rank") <= k).select("query", "vec").toPandas()
    needed = []
    for n, own in truth.groupby("query"):
        x = lengthened(np.array(own["vec"].tolist(), float), longest)
        leaf = np.stack([t.leaf_of(x) for t in trees], 1)
        missing = set(range(len(x)))
        inside: dict[tuple[int, int], list[int]] = {}
        for i, places in enumerate(leaf.tolist()):
            for t, at in enumerate(places):
                inside.setdefault((t, at), []).append(i)
        taken = 0
        for place in visit(trees, np.append(probes[n], 0.0)):
            taken += sizes.get(place, 0)
            for i in inside.get(place, ()):
                if i in missing:
                    missing.discard(i)
                    needed.append(taken)
            if not missing:
                break
    return int(np.quantile(needed, recall)) if needed else 0


def _shelves(sizes: dict[tuple[int, int], int]) -> dict[tuple[int, int], tuple[int, int]]:
    """First shelf of each leaf and how many it is spread over: neighbouring leaves share one, a large leaf has several."""
    out, tree, shelf, rows = {}, -1, -1, 0
    for place in sorted(sizes):
        blocks = -(-sizes[place] // SHELF_ROWS)
        if place[0] != tree:
            tree, shelf, rows = place[0], 0, 0
        elif rows + sizes[place] > SHELF_ROWS:
            shelf, rows = shelf + 1, 0
        out[place] = shelf, blocks
        shelf, rows = shelf + blocks - 1, rows + sizes[place] if blocks == 1 else SHELF_ROWS
    return out


def search(df: DataFrame, id_col: str, vec_col: str, wanted: Column, k: int = 20, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
           sample_rows: int = SAMPLE_ROWS, recall: float = RECALL, budget: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each query, by inner product.

    ``wanted`` picks the queries among the rows ``(vec_id, vec)``. A query's own id is no candidate. Rows
    with a null id or vector, a zero vector or components that are null or not finite take no part; short
    vectors are filled up with zeros; repeated rows count once. Ids are taken to name one vector each. An
    empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col, nonzero=True)
    reps, members = queries(rows, wanted)
    pool = stored(candidates(rows, k), "candidates")
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, longest = pool.agg(F.count("*"), F.sqrt(F.max(squares))).first()
    if not total:
        return ranked(pool.select(F.col("vec_id").alias("rep"), "vec_id", F.lit(0.0).alias("score")), members, k)
    longest = float(longest) * (1 + 1e-9)
    sample = lengthened(matrix(pa.array([r.vec for r in pool.orderBy(F.xxhash64(F.lit(1), "vec_id")).limit(sample_rows).collect()])), longest)
    random = np.random.default_rng(17)
    leaf = max(LEAST_SAMPLE, int(leaf_rows * len(sample) / total))
    forest = [grow(sample, leaf, random) for _ in range(trees)]
    kind = pool.schema["vec"].dataType.simpleString()

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = lengthened(matrix(part.column("vec")), longest)
            for n, tree in enumerate(forest):
                at, rows = np.unique(tree.leaf_of(x), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), pa.array(at.astype(np.int32)), pa.array(rows)], ["tree", "leaf", "n"])

    counted = pool.mapInArrow(leaves, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n"))
    sizes = {(r.tree, r.leaf): r["n"] for r in counted.collect()}
    if budget is None:
        budget = _budget(forest, sizes, pool, reps, longest, k, recall)
    shelves = _shelves(sizes)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x, ids = lengthened(matrix(part.column("vec")), longest), part.column("vec_id").to_numpy()
            for n, tree in enumerate(forest):
                leaf = tree.leaf_of(x)
                shelf = np.array([shelves[n, at][0] for at in leaf.tolist()], np.int64)
                spread_over = np.array([shelves[n, at][1] for at in leaf.tolist()], np.int64)
                shelf += (ids * 0x9E3779B1 >> 7) % spread_over
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), n, np.int32)), pa.array(shelf), pa.array(leaf.astype(np.int32)), part.column("vec_id"), part.column("vec")], ["tree", "shelf", "leaf", "vec_id", "vec"])

    index = pool.mapInArrow(put, f"tree int, shelf long, leaf int, vec_id long, vec {kind}")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = matrix(part.column("vec"))
            for a in range(0, len(x), 256):
                who, tree, shelf, taken_leaves = [], [], [], []
                for n in range(a, min(a + 256, len(x))):
                    taken, there = 0, {}
                    for place in visit(forest, np.append(x[n], 0.0)):
                        if place in shelves:
                            first, blocks = shelves[place]
                            for s in range(first, first + blocks):
                                there.setdefault((place[0], s), []).append(place[1])
                        taken += sizes.get(place, 0)
                        if taken >= budget and taken > k:
                            break
                    for (t, s), own in there.items():
                        who.append(n)
                        tree.append(t)
                        shelf.append(s)
                        taken_leaves.append(own)
                who = pa.array(who, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(shelf, pa.int64()), pa.array(taken_leaves, pa.list_(pa.int32())), part.column("rep").take(who), part.column("vec").take(who)], ["tree", "shelf", "leaves", "rep", "vec"])

    asked = spread(reps).mapInArrow(ask, f"tree int, shelf long, leaves array<int>, rep long, vec {kind}")

    def compare(there: pa.Table, here: pa.Table) -> pa.Table:
        none = np.empty(0, np.int64)
        who, ids, scores = [none], [none], [np.empty(0)]
        if there.num_rows and here.num_rows:
            leaf = there.column("leaf").to_numpy()
            order = np.argsort(leaf, kind="stable")
            leaf, own, x = leaf[order], there.column("vec_id").to_numpy()[order], matrix(there.column("vec"))[order]
            rep, q = here.column("rep").to_numpy(), matrix(here.column("vec"))
            lists = here.column("leaves").combine_chunks()
            asks, wanted = np.repeat(np.arange(len(rep)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
            for at in np.unique(leaf):
                a, b = np.searchsorted(leaf, at), np.searchsorted(leaf, at, side="right")
                visitors = asks[wanted == at]
                for n, places, score in _exact(q[visitors], x[a:b], own[a:b], k + 1):
                    who.append(np.full(len(places), rep[visitors[n]]))
                    ids.append(own[a:b][places])
                    scores.append(score)
        who, ids, scores = map(np.concatenate, (who, ids, scores))
        order = np.lexsort([ids, -scores, who])
        who, ids, scores = who[order], ids[order], scores[order]
        best = np.arange(len(who)) - np.searchsorted(who, who) <= k
        return pa.table({"rep": who[best], "vec_id": ids[best], "score": scores[best]})

    keys = ["tree", "shelf"]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(compare, "rep long, vec_id long, score double")
    return ranked(found.dropDuplicates(["rep", "vec_id"]), members, k)
