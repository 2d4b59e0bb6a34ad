"""Lloyd's steps of many sets of centres over the same points.

Points that fit a task (``LOCAL_VALUES``) are sent to as many tasks as there are cores, and each runs some sets to their end. More points
are passed over with all sets that still move together: a pass brings back their sums, numbers and costs, so the number of jobs
is that of the longest run alone. Both ways take the same steps: equal points are one with a weight, points are dealt and ordered by
their values, and sums are added up by partition, so a result depends neither on how the input is cut nor on what else is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import microclusters
from .blocks import DIRECT_WIDTH, squared_distances

#: Points that are packed into a block, so that a block's distances to a set stay in a core's cache.
BLOCK_ROWS = 2_000
#: Values that a task holds to run sets to their end (128 MB).
LOCAL_VALUES = 16_000_000
#: Bytes of sums that the driver reads in a pass at most.
PASS_BYTES = 64 << 20


@dataclass
class Summary:
    k: int
    trainingCost: float  # noqa: N815


@dataclass
class Centres:
    """A fitted set of centres; the cost is that of the last step's start, as Spark's own model states it."""

    values: np.ndarray
    summary: Summary
    steps: int

    def transform(self, points: DataFrame) -> DataFrame:
        """``points`` with the number of each one's nearest centre as ``prediction``."""
        found = microclusters.nearest(points, "points", self.values, np.arange(len(self.values)), "prediction")
        return found.withColumn("prediction", F.col("prediction").cast("int"))


def _block(x: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points, their weights and squared lengths."""
    weights = np.frombuffer(n)
    points = np.frombuffer(x).reshape(len(weights), -1)
    return points, weights, (points * points).sum(1)


def _sums(block: tuple[np.ndarray, np.ndarray, np.ndarray], centres: np.ndarray) -> np.ndarray:
    """A row per centre: the sum of its points, their number and what they cost."""
    x, n, lengths = block
    if x.shape[1] <= DIRECT_WIDTH:
        far = squared_distances(x, centres)
    else:
        far = x @ (-2.0 * centres.T)
        far += (centres * centres).sum(1)
        far += lengths[:, None]
    best, row = far.argmin(1), np.arange(len(x))
    marks = np.zeros(far.shape)
    marks[row, best] = n
    costs = np.bincount(best, np.maximum(far[row, best], 0.0) * n, len(centres))
    return np.column_stack([marks.T @ x, marks.sum(0), costs])


def _moved(centres: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, float, float]:
    """The centres after a step, the square of the longest way that one went, and the cost before."""
    count = sums[:, -2]
    moved = np.where(count[:, None] > 0, sums[:, :-2] / np.maximum(count, 1)[:, None], centres)
    return moved, float(((moved - centres) ** 2).sum(1).max()), float(sums[:, -1].sum())


def run(points: DataFrame, col: str, starts: list[np.ndarray], ks: list[int], max_iter: int, tolerance: float = 1e-4, local_values: int = LOCAL_VALUES) -> list[Centres]:
    """What each of ``starts`` comes to: until no centre moves by more than ``tolerance``, ``max_iter`` steps at most. Centres without points stay."""
    spark = points.sparkSession
    sets = [np.array(s, float) for s in starts]
    costs, steps, active = [0.0] * len(sets), [0] * len(sets), [n for n, s in enumerate(sets) if len(s)]
    if not active or not max_iter:
        return [Centres(s, Summary(k, c), 0) for s, k, c in zip(sets, ks, costs)]
    width, cores = sets[active[0]].shape[1], spark.sparkContext.defaultParallelism
    parts = max(1, min(cores, PASS_BYTES // (8 * (width + 2) * sum(map(len, sets)))))
    rows = points.select(F.col(col).cast("array<double>").alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    shift = np.array(rows.agg(F.min("x")).first()[0], float)  # one of the points: distances keep their digits far from the origin
    sets = [s - shift if len(s) else s for s in sets]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column("x").flatten().to_numpy().reshape(part.num_rows, -1) - shift
                values = x.tobytes(), part.column("n").to_numpy().astype(float).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], ["x", "n"])

    # partition and place are in the upper and lower bits
    blocks = rows.repartition(parts, "x").sortWithinPartitions("x").mapInArrow(packed, "x binary, n binary").withColumn("at", F.monotonically_increasing_id()).persist()
    size = blocks.agg(F.sum(F.octet_length("x").cast("long"))).first()[0] or 0
    if size <= 8 * local_values:
        tasks = min(cores, len(active))
        # large sets first, each to the next task
        turns = [sorted(active, key=lambda n: -len(sets[n]))[t::tasks] for t in range(tasks)]
        shared = spark.sparkContext.broadcast([[(n, sets[n]) for n in turn] for turn in turns])

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, task = [], None
            for batch in batches:
                for own, at, x, n in zip(*(batch.column(c).to_pylist() for c in ("task", "at", "x", "n"))):
                    task = own
                    held.append((at, _block(x, n)))
            held.sort(key=lambda b: b[0])
            for number, centres in [] if task is None else shared.value[task]:
                cost, step = 0.0, 0
                while step < max_iter:
                    by_part: dict[int, np.ndarray] = {}
                    for at, block in held:
                        own = _sums(block, centres)
                        by_part[at >> 33] = by_part[at >> 33] + own if at >> 33 in by_part else own
                    centres, far, cost = _moved(centres, sum(by_part.values()))
                    step += 1
                    if far <= tolerance**2:
                        break
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([centres.tobytes()], pa.binary()), pa.array([cost]), pa.array([step], pa.int32())], ["n", "centres", "cost", "steps"])

        sent = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartitionById(tasks, "task")
        for r in sent.mapInArrow(whole, "n int, centres binary, cost double, steps int").collect():
            sets[r["n"]], costs[r["n"]], steps[r["n"]] = np.frombuffer(r["centres"]).reshape(-1, width), r["cost"], r["steps"]
        active = []
    while active:
        shared = spark.sparkContext.broadcast([sets[n] for n in active])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, part = None, 0
            for batch in batches:
                for at, x, n in zip(*(batch.column(c).to_pylist() for c in ("at", "x", "n"))):
                    block = _block(x, n)
                    own = [_sums(block, centres) for centres in shared.value]  # noqa: B023
                    held, part = own if held is None else [a + b for a, b in zip(held, own)], at >> 33
            if held is not None:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.concatenate(held).tobytes()], pa.binary())], ["part", "sums"])

        found = sorted(blocks.mapInArrow(added, "part int, sums binary").collect(), key=lambda r: r["part"])
        sums, at, moving = sum(np.frombuffer(r["sums"]) for r in found).reshape(-1, width + 2), 0, []
        shared.destroy()
        for n in active:
            some = slice(at, at + len(sets[n]))
            at += len(sets[n])
            sets[n], far, costs[n] = _moved(sets[n], sums[some])
            steps[n] += 1
            if far > tolerance**2 and steps[n] < max_iter:
                moving.append(n)
        active = moving
    blocks.unpersist()
    return [Centres(s + shift if len(s) else s, Summary(k, c), t) for s, k, c, t in zip(sets, ks, costs, steps)]
