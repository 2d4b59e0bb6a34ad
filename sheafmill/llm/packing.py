"""Packing of tokenised documents into as few sequences as possible, by bin completion.

Only the number of pieces of each length decides a packing, and there are no more lengths than the
capacity. So the driver gets one row per length, completes bins on these counts, and each filling is
used as often as the counts allow. Pieces then find their place by their rank within their length.

A bin starts with the largest length left. A branch-and-bound search completes it: the best-fit filling
is the incumbent; larger pieces are tried before smaller ones; a branch that cannot waste less than the
incumbent is pruned; an exact filling ends the search. Where bins that are completed one by one need more
sequences than the lower bound, a second search goes back over them: it branches over the
undominated fillings of each bin and is pruned by the waste that all bins together may have. ``nodes``
bounds the effort of a search, never the rows: the incumbent stands then.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import bpe
from .common import spread, stored, text_slices

CAPACITY = 2048
SEARCH_NODES = 20_000
#: Parts of the waste left to a bin that are accepted, one plan each.
EASE = (0.0, 0.5, 1.0, 2.0, 4.0, 8.0)
BUCKET_ROWS = 20_000
#: Fillings of a bin that are looked at where whole bins are searched. It bounds effort at every size alike: the best plan so far stands.
BIN_FILLINGS = 200
#: Bins of one filling that are taken back one by one; of more, half are taken back at a time.
FEW_BINS = 4


def pieces(df: DataFrame, id_col: str, text_col: str, path: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32[, ids])`` of every row: its ids and ``end_id``, cut only beyond ``capacity``.

    A null or empty text is the single id ``end_id``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(path)
        for part in text_slices(batches, text_col, bpe.SLICE_BYTES):
            ids, offsets = model.encode(part.column(text_col).to_pylist())
            row, piece, start, length, crc, cut = [], [], [], [], [], []
            for n, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                own = np.append(ids[a:b], end_id).astype("<u4")
                for at in range(0, len(own), capacity):
                    some = own[at : at + capacity]
                    row.append(n)
                    piece.append(at // capacity)
                    start.append(at)
                    length.append(len(some))
                    crc.append(zlib.crc32(some.tobytes()))
                    if keep_ids:
                        cut.append(some.astype(np.int32))
            columns = [part.column(id_col).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, pa.array(cut, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


class _Lengths:
    """Counts by length, with the largest length left that is no larger than a given one."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.count = [0] * (capacity + 1)
        for size, n in counts.items():
            self.count[size] += n
        self.down = [s if self.count[s] else -1 for s in range(capacity + 1)]

    def copy(self) -> _Lengths:
        return _Lengths({s: n for s, n in enumerate(self.count) if n}, len(self.count) - 1)

    def at_most(self, size: int) -> int:
        """0 if there is none."""
        path = []
        while size > 0 and not self.count[size]:
            path.append(size)
            size = size - 1 if self.down[size] < 0 or self.down[size] >= size else self.down[size]
        for s in path:
            self.down[s] = size
        return max(size, 0)


def complete(lengths: _Lengths, room: int, nodes: int = SEARCH_NODES, allowed: float = 0) -> list[int]:
    """Lengths that fill ``room``, each available often enough, with a waste within ``allowed`` or else the least found."""
    best: list[int] = []
    left = room
    used: dict[int, int] = {}
    size = lengths.at_most(left)
    while size:  # best fit: the largest that fits, again and again
        take = min(left // size, lengths.count[size])
        best += [size] * take
        left -= size * take
        size = lengths.at_most(min(left, size - 1)) if left else 0
    least = left
    below = np.cumsum(np.arange(len(lengths.count)) * np.array(lengths.count))
    frames: list[list[int]] = []  # lengths that are taken, and how often
    left, size = room, lengths.at_most(room)
    while least > allowed and nodes > 0:
        nodes -= 1
        if size and left - below[size] < least:  # else all that is smaller cannot waste less
            take = min(left // size, lengths.count[size])
            frames.append([size, take])
            left -= size * take
            if left < least:
                best, least = [s for s, k in frames for _ in range(k)], left
            size = lengths.at_most(min(left, size - 1))
            continue
        while frames and not frames[-1][1]:
            frames.pop()
        if not frames:
            break
        frames[-1][1] -= 1
        left += frames[-1][0]
        size = lengths.at_most(min(left, frames[-1][0] - 1))
    return best


def fillings(lengths: _Lengths, room: int, allowed: int, steps: list[int]) -> Iterator[dict[int, int]]:
    """All fillings of ``room`` that waste ``allowed`` or less and that no exchange dominates, those of larger pieces first.

    ``steps`` holds the steps left to the whole search.

    A filling is dominated where a piece left over fits in beside it, or in place of one or two smaller ones of it together.
    """
    below = np.cumsum(np.arange(len(lengths.count)) * np.array(lengths.count))
    frames: list[list[int]] = []
    left, size = room, lengths.at_most(room)
    while steps[0] > 0:
        steps[0] -= 1
        if size and left - below[size] <= allowed:
            take = min(left // size, lengths.count[size])
            frames.append([size, take])
            left -= size * take
            size = lengths.at_most(min(left, size - 1))
            continue
        if left <= allowed:
            used = {s: k for s, k in frames if k}
            if not _dominated(lengths, used, left):
                yield used
        while frames and not frames[-1][1]:
            frames.pop()
        if not frames:
            return
        frames[-1][1] -= 1
        left += frames[-1][0]
        size = lengths.at_most(min(left, frames[-1][0] - 1))


def _dominated(lengths: _Lengths, used: dict[int, int], waste: int) -> bool:
    def spare(least: int, most: int) -> bool:
        size = lengths.at_most(min(most, len(lengths.count) - 1))
        while size >= max(least, 1):
            if used.get(size, 0) < lengths.count[size]:
                return True
            size = lengths.at_most(size - 1)
        return False

    sizes = list(used)
    pairs = {a + b for n, a in enumerate(sizes) for b in sizes[n:] if a != b or used[a] > 1}
    return spare(1, waste) or any(spare(s + 1, s + waste) for s in sizes) or any(spare(p, p + waste) for p in pairs)


def improved(counts: dict[int, int], capacity: int, sequences: int, nodes: int) -> list[tuple[dict[int, int], int]] | None:
    """Fillings of ``sequences`` bins, with the bins of each, that use every piece once, or None where the search finds none within ``nodes`` steps.

    Bins are filled one after the other around the largest piece left, each filling in as many bins as pieces and waste allow. One that
    leads nowhere is taken back, a bin or half of its bins at a time, and the next one is tried. All bins together may waste no more than the sequences leave.
    Steps are taken by fillings, not by bins, so that repeating all pieces does not lengthen the search.
    """
    lengths, steps = _Lengths(counts, capacity), [nodes]
    waste = sequences * capacity - sum(s * n for s, n in counts.items())
    stack: list[tuple[Iterator[dict[int, int]], dict[int, int], int]] = []

    def change(filling: dict[int, int], by: int) -> int:
        for s, k in filling.items():
            lengths.count[s] += by * k
        return by * (capacity - sum(s * k for s, k in filling.items()))

    def bin_of_largest(but: dict[int, int]) -> Iterator[dict[int, int]]:
        size = max((s for s, n in enumerate(lengths.count) if n), default=0)
        lengths.count[size] -= 1
        found = list(islice(fillings(lengths.copy(), capacity - size, waste, steps), BIN_FILLINGS))
        lengths.count[size] += 1
        found.sort(key=lambda f: -sum(s * k for s, k in f.items()))
        for f in found:
            if (whole := {**f, size: f.get(size, 0) + 1}) != but:
                yield whole

    stack.append((bin_of_largest({}), {}, 0))
    while stack and steps[0] > 0:
        turn, taken, bins = stack[-1]
        steps[0] -= 1
        fewer = bins - 1 if bins <= FEW_BINS else bins // 2
        if bins:
            waste += change(taken, bins - fewer)
            sequences += bins - fewer
            stack[-1] = (turn, taken, fewer)
        if bins > 1:  # with fewer bins of it, others come next
            stack.append((bin_of_largest(taken), {}, 0))
            continue
        filling = next(turn, None)
        if filling is None:
            stack.pop()
            continue
        own = capacity - sum(s * k for s, k in filling.items())
        bins = min(sequences, *(lengths.count[s] // k for s, k in filling.items()), *([waste // own] if own else []))
        waste += change(filling, -bins)
        sequences -= bins
        stack[-1] = (turn, filling, bins)
        if not any(lengths.count):
            return [(f, n) for _, f, n in stack if n]
        if sequences:
            stack.append((bin_of_largest({}), {}, 0))
    return None


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer: pieces over half need a sequence each, and only smaller ones fill what they leave."""
    sizes = np.array(sorted(counts), np.int64)
    n = np.array([counts[s] for s in sorted(counts)], np.int64)
    best = -(-int((sizes * n).sum()) // capacity)
    half = capacity / 2
    for small in range(1, capacity // 2 + 1):
        alone, large, rest = sizes > capacity - small, (sizes > half) & (sizes <= capacity - small), (sizes >= small) & (sizes <= half)
        over = int((sizes * n)[rest].sum() - ((capacity - sizes) * n)[large].sum())
        best = max(best, int(n[alone].sum() + n[large].sum()) + max(0, -(-over // capacity)))
    return best


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> list[tuple[dict[int, int], int]]:
    """Fillings ``({length: how many}, sequences)`` that together use every piece once.

    Bins are completed several times, with more or less of the waste that the lower bound leaves to a
    bin taken as good enough, and the fewest sequences win. Exact fillings use up small pieces early;
    where waste can be afforded, they are better kept for the last bins. Where the lower bound is not
    reached, a search over the fillings of all bins tries to do with fewer, at any number of sequences.
    """
    least, best, fewest = least_sequences(counts, capacity), [], None
    for ease in EASE:
        made = _complete_all(counts, capacity, nodes, least, ease)
        if fewest is None or sum(t for _, t in made) < fewest:
            best, fewest = made, sum(t for _, t in made)
        if fewest <= least:
            break
    least = min(least, fewest)
    while fewest > least:  # by halves, so that the tries do not grow with the sequences
        middle = (least + fewest) // 2
        made = improved(counts, capacity, middle, 10 * nodes)
        if made is None:
            least = middle + 1
        else:
            best, fewest = made, middle
    return best


def _complete_all(counts: dict[int, int], capacity: int, nodes: int, least: int, ease: float) -> list[tuple[dict[int, int], int]]:
    lengths, out = _Lengths(counts, capacity), []
    waste, bins = least * capacity - sum(s * n for s, n in counts.items()), least
    while size := lengths.at_most(capacity):
        lengths.count[size] -= 1
        rest = complete(lengths, capacity - size, nodes, ease * max(0, waste) / max(1, bins))
        lengths.count[size] += 1
        filling: dict[int, int] = {}
        for s in [size, *rest]:
            filling[s] = filling.get(s, 0) + 1
        times = min(lengths.count[s] // k for s, k in filling.items())
        for s, k in filling.items():
            lengths.count[s] -= k * times
        waste, bins = waste - times * (capacity - size - sum(rest)), bins - times
        out.append((filling, times))
    return out


def place(cut: DataFrame, id_col: str, capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``; ``cut`` has ``id_col, piece, start, length, ids_crc32`` and must not change between reads.

    Ranks within a length come from counts by (length, hash bucket): no length is sorted in one task.
    """
    spark = cut.sparkSession
    counts = {r.length: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    fillings = plan(counts, capacity, nodes)
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequences = 0
    for filling, times in fillings:
        offset = 0
        for size, k in filling.items():
            table.setdefault(size, []).append((used.get(size, 0), sequences, k, offset))
            used[size] = used.get(size, 0) + k * times
            offset += size * k
        sequences += times
    lookup = {size: np.array(rows, np.int64) for size, rows in table.items()}

    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))
    keyed = cut.withColumn("bucket", F.pmod(F.xxhash64(id_col, "piece"), F.lit(buckets)))
    ranked = keyed.withColumn("n", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(id_col, "piece", "start", "ids_crc32")))
    sizes = keyed.groupBy("length", "bucket").agg(F.count("*").alias("rows"))
    before = sizes.select("length", "bucket", (F.sum("rows").over(Window.partitionBy("length").orderBy("bucket")) - F.col("rows")).alias("before"))
    ranked = ranked.join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("n") - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            length, rank = part.column("length").to_numpy(), part.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                own, rows = length == size, lookup[int(size)]
                at = np.searchsorted(rows[:, 0], rank[own], side="right") - 1
                first, base, k, shift = rows[at].T
                step = rank[own] - first
                sequence[own], offset[own] = base + step // k, shift + step % k * size
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    names = [id_col, "piece", "start", "length", "ids_crc32"]
    kind = cut.schema[id_col].dataType.simpleString()
    return ranked.select(*names, "rank").mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(df: DataFrame, id_col: str, text_col: str, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every row with its place; an empty table gives an empty result.

    Rows with equal ids are packed as rows of their own. Pieces are written to the shared folder once,
    without their ids, so that counts, ranks and places agree even if an executor is lost.
    """
    return place(stored(pieces(spread(df.select(id_col, text_col)), id_col, text_col, path, capacity), "pieces"), id_col, capacity)


def sequences(placed: DataFrame, cut: DataFrame, id_col: str) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences themselves, at most one capacity of ids in a group.

    ``cut`` is the table of pieces with their ids; ``id_col`` must be unique there.
    """
    joined = placed.select(id_col, "piece", "sequence_id", "offset").join(cut.select(id_col, "piece", "ids"), [id_col, "piece"])
    listed = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return listed.select("sequence_id", F.flatten("parts.ids").alias("ids"))
