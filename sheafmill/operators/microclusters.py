"""Rows summed up in a bounded number of micro-clusters, and minimum-variance merging of these.

A micro-cluster keeps how many rows it holds, their sum, the row that opened it (its anchor) and how far from that the farthest
one lies. Distinct rows stay apart as long as there are no more than the stated number; then rows within a distance share one,
and the distance grows until they are few enough. Summaries merge by the same step, over tasks and over groups of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .blocks import squared_distances

BATCH = 512
SCHEMA = "grp string, n long, anchor array<double>, total array<double>, reach double"


class Summary:
    """Micro-clusters of one group: ``most`` at most."""

    def __init__(self, most: int):
        self.most, self.within = most, 0.0
        self.n, self.anchor, self.total, self.reach = np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0)

    def add(self, n: np.ndarray, anchor: np.ndarray, total: np.ndarray, reach: np.ndarray) -> None:
        """Rows, or micro-clusters of another summary."""
        if not len(self.n):
            self.anchor, self.total = np.zeros((0, anchor.shape[1])), np.zeros((0, anchor.shape[1]))
        for at in range(0, len(n), BATCH):
            self._join(*(a[at : at + BATCH] for a in (n, anchor, total, reach)))
            while len(self.n) > self.most:
                self._widen()

    def _join(self, n: np.ndarray, anchor: np.ndarray, total: np.ndarray, reach: np.ndarray) -> None:
        left = np.arange(len(n))
        if len(self.n):
            far = squared_distances(anchor, self.anchor)
            to, far = far.argmin(1), np.sqrt(far.min(1))
            near = far <= self.within
            self._take(to[near], n[near], total[near], far[near] + reach[near])
            left = left[~near]
        opened = []
        while len(left):
            first, rest = left[0], left[1:]
            far = np.sqrt(squared_distances(anchor[rest], anchor[first : first + 1]))[:, 0]
            near = far <= self.within
            own = rest[near]
            opened.append((n[first] + n[own].sum(), anchor[first], total[first] + total[own].sum(0), max(reach[first], (far[near] + reach[own]).max(initial=0.0))))
            left = rest[~near]
        if opened:
            self.n = np.append(self.n, [o[0] for o in opened])
            self.anchor, self.total = (np.concatenate([held, np.stack([o[k] for o in opened])]) for held, k in ((self.anchor, 1), (self.total, 2)))
            self.reach = np.append(self.reach, [o[3] for o in opened])

    def _take(self, to: np.ndarray, n: np.ndarray, total: np.ndarray, reach: np.ndarray) -> None:
        np.add.at(self.n, to, n)
        np.add.at(self.total, to, total)
        np.maximum.at(self.reach, to, reach)

    def _widen(self) -> None:
        """A larger distance: twice the last, or that to the nearest other of every tenth of some."""
        some = self.anchor[:: max(1, len(self.n) // BATCH)]
        far = squared_distances(some, self.anchor)
        far[far == 0] = np.inf
        self.within = max(2 * self.within, float(np.sqrt(np.quantile(far.min(1), 0.1))))
        held = self.n, self.anchor, self.total, self.reach
        self.n, self.reach = np.zeros(0, np.int64), np.zeros(0)
        self.anchor, self.total = self.anchor[:0], self.total[:0]
        for at in range(0, len(held[0]), BATCH):
            self._join(*(a[at : at + BATCH] for a in held))


def summarise(df: DataFrame, col: str, most: int, group: str | None = None) -> DataFrame:
    """``(grp, n, anchor, total, reach)``: at most ``most`` micro-clusters of every group's rows in ``col``.

    Without a group all rows are one, named by the empty text. Tasks sum up their own rows; the summaries of some
    tasks are merged, then those of all.
    """
    named = F.col(group).cast("string") if group else F.lit("")
    rows = df.select(named.alias("grp"), F.col(col).cast("array<double>").alias("anchor")).where(F.col("anchor").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Summary] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.array(batch.column("grp").to_pylist(), object)
            anchor = batch.column("anchor").flatten().to_numpy().reshape(batch.num_rows, -1)
            plain = "n" not in batch.schema.names
            n = np.ones(len(names), np.int64) if plain else batch.column("n").to_numpy()
            total = anchor if plain else batch.column("total").flatten().to_numpy().reshape(anchor.shape)
            reach = np.zeros(len(names)) if plain else batch.column("reach").to_numpy()
            for name in set(names.tolist()):
                own = np.flatnonzero(names == name)
                held.setdefault(name, Summary(most)).add(n[own], anchor[own], total[own], reach[own])
        for name, s in held.items():
            columns = [pa.array([name] * len(s.n), pa.string()), pa.array(s.n), pa.array(list(s.anchor), pa.list_(pa.float64())), pa.array(list(s.total), pa.list_(pa.float64())), pa.array(s.reach)]
            yield pa.RecordBatch.from_arrays(columns, ["grp", "n", "anchor", "total", "reach"])

    parts = cut_lineage(rows.mapInArrow(run, SCHEMA).withColumn("task", F.spark_partition_id()))
    groups = int(np.ceil(np.sqrt(max(1, parts.rdd.getNumPartitions()))))
    some = parts.repartition(groups, F.col("task") % groups).drop("task").mapInArrow(run, SCHEMA)
    return cut_lineage(some.coalesce(1).mapInArrow(run, SCHEMA))


def ward(n: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """Cluster of each weighted point: those of least growth in variance merge, by nearest-neighbour chains, until ``k`` are left."""
    m, size = len(n), n.astype(float)
    cost = squared_distances(centres, centres) * (size[:, None] * size[None, :] / (size[:, None] + size[None, :]))
    np.fill_diagonal(cost, np.inf)
    alive, chain, merges = np.ones(m, bool), [], []
    while len(merges) < m - 1:
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            a = chain[-1]
            b = int(np.argmin(cost[a]))
            if len(chain) > 1 and cost[a, chain[-2]] <= cost[a, b]:
                break
            chain.append(b)
        a, b = sorted(chain[-2:])
        del chain[-2:]
        merges.append((cost[a, b], a, b))
        grown = ((size[a] + size) * cost[a] + (size[b] + size) * cost[b] - size * cost[a, b]) / (size[a] + size[b] + size)
        size[a] += size[b]
        alive[b] = False
        grown[~alive] = np.inf
        grown[a] = np.inf
        cost[a], cost[:, a] = grown, grown
        cost[b], cost[:, b] = np.inf, np.inf
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for _, a, b in sorted(merges)[: max(0, m - k)]:
        root[find(b)] = find(a)
    heads = [find(x) for x in range(m)]
    order = {h: c for c, h in enumerate(sorted(set(heads), key=lambda h: tuple(centres[h])))}
    return np.array([order[h] for h in heads], np.int64)


def nearest(df: DataFrame, col: str, centres: np.ndarray, values: np.ndarray, out: str) -> DataFrame:
    """``df`` with the value of the nearest of some centres, which are broadcast."""
    shared = df.sparkSession.sparkContext.broadcast((centres, values))

    def run(points: pa.Array) -> pa.Array:
        centres, values = shared.value
        x = points.flatten().to_numpy().reshape(len(points), -1)
        found = [values[squared_distances(x[a : a + BATCH], centres).argmin(1)] for a in range(0, len(x), BATCH)]
        return pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())

    return df.withColumn(out, F.arrow_udf(run, "long")(F.col(col).cast("array<double>")))


def agglomerate(df: DataFrame, col: str, k: int, out: str = "cluster", most: int = 2_000) -> DataFrame:
    """``df`` with the cluster of each row by minimum-variance (Ward) merging.

    With no more than ``most`` distinct rows these are what merges: plain Ward linkage. Beyond that it starts from
    ``most`` micro-clusters, and a row belongs to the cluster of the nearest.
    """
    found = summarise(df, col, most).collect()  # at most ``most`` rows
    if not found:
        return df.withColumn(out, F.lit(None).cast("long"))
    n = np.array([r["n"] for r in found])
    centres = np.array([r["total"] for r in found])/ n[:, None]
    order = np.lexsort(centres.T[::-1])  # ties do not depend on tasks
    n, centres = n[order], centres[order]
    return nearest(df, col, centres, ward(n, centres, k), out)
