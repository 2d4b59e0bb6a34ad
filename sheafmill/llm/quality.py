"""Quality classifier: a linear SVM over n-gram indicators scaled by Naive Bayes log-count ratios.

Indicators: words and word pairs in lower case, the same of word shapes (runs of capitals, small letters,
digits and signs), and triples of "this word repeats the one before". They are hashed to ``2 ** BITS``
features. The classifier is fitted on a bounded sample of the labelled training rows, drawn by a hash of
the id: log-count ratios on about ``ratio_rows`` of them (all, if there are fewer), the hinge-loss model by
dual coordinate descent, in one task, on about ``fit_rows`` of those. A part of the latter is kept from the
fit and turns margins into probabilities. The sampled ids are broadcast, so no text is shuffled.

Every text is read whole. A null or empty text has the constant feature alone and so a score like any other.
Rows of ``labels`` without a label, or with ids that no document has, take no part; repeated rows count
as often as they occur.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import id_hash, spread, stored, text_slices

BITS = 18
BLOCKS = 64
RATIO_ROWS = 100_000
FIT_ROWS = 10_000
CUT = 0.3
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
KNOWN_CHUNKS = 150_000
#: Bytes of text whose features are made at a time: some 40 times as much memory for a moment.
SLICE = 2 << 20

_SHAPE = bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_known: dict[bytes, int] = {}
_hashes: list[array] = [array("Q"), array("Q")]


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Scrambled 64-bit values, another function for each salt."""
    x = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def forget() -> None:
    """Give the cache of known chunks back; a worker may take another stage next."""
    _known.clear()
    _hashes[:] = [array("Q"), array("Q")]


def indicators(texts: list[str | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The features of all texts in one array, each once per text, and the offsets of each text. Feature 0 is on in all."""
    if len(_known) > KNOWN_CHUNKS:
        forget()
    order, counts = array("q"), []
    for text in texts:
        chunks = text.encode("utf-8").split() if text else ()
        counts.append(len(chunks))
        for chunk in chunks:
            at = _known.get(chunk)
            if at is None:
                at = _known[chunk] = len(_known)
                _hashes[0].append(xxhash.xxh64_intdigest(chunk.lower()))
                _hashes[1].append(xxhash.xxh64_intdigest(_RUN.sub(rb"\1", chunk.translate(_SHAPE))))
            order.append(at)
    at = np.frombuffer(order, np.int64) if len(order) else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    pair, triple = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
    keys = [np.arange(len(texts), dtype=np.int64) << bits]
    mask = np.uint64((1 << bits) - 1)
    streams = []
    for n, known in enumerate(_hashes):
        h = np.array(known, np.uint64)[at] if len(at) else np.empty(0, np.uint64)
        streams.append((_mixed(h, 2 * n + 1), doc))
        streams.append((_mixed(_mixed(h[:-1], 11) + h[1:], 2 * n + 2)[pair], doc[1:][pair]))
    if len(at) > 3:
        same = ((at[1:] == at[:-1]) & pair).astype(np.uint64)
        code = same[:-2] * np.uint64(4) + same[1:-1] * np.uint64(2) + same[2:]
        inside = doc[3:] == doc[:-3]
        streams.append((_mixed(code, 7)[inside], doc[3:][inside]))
    for h, where in streams:
        keys.append(where << bits | np.maximum(h & mask, np.uint64(1)).astype(np.int64))
    every = np.unique(np.concatenate(keys))
    return (every & ((1 << bits) - 1)).astype(np.int32), np.searchsorted(every, np.arange(len(texts) + 1, dtype=np.int64) << bits)


@dataclass
class Model:
    """``weights`` of the features, ``ratios`` that scale them, and the line from margins to log-odds."""

    weights: np.ndarray
    ratios: np.ndarray
    slope: float
    shift: float
    bits: int = BITS

    def margins(self, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.add.reduceat(self.ratios[features].astype(np.float64) ** 2, offsets[:-1]))
        return np.add.reduceat((self.weights * self.ratios)[features].astype(np.float64), offsets[:-1]) / norm

    def scores(self, texts: list[str | None]) -> np.ndarray:
        line = self.slope * self.margins(*indicators(texts, self.bits)) + self.shift
        return 1 / (1 + np.exp(-np.clip(line, -500, 500)))


def descend(features: np.ndarray, offsets: np.ndarray, labels: np.ndarray, ratios: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights of the hinge-loss model by dual coordinate descent; rows of unit length, so the step is the gradient itself."""
    weights = np.zeros(len(ratios))
    rows = []
    for a, b in zip(offsets, offsets[1:]):
        own = features[a:b]
        x = ratios[own].astype(np.float64)
        rows.append((own, x / np.sqrt(x @ x)))
    sign = np.where(labels > 0, 1.0, -1.0)
    dual = np.zeros(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            own, x = rows[i]
            new = min(max(dual[i] - (sign[i] * (weights[own] @ x) - 1), 0.0), cost)
            if step := new - dual[i]:
                dual[i] = new
                weights[own] += step * sign[i] * x
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights


def calibrate(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic line through smoothed labels, by Newton steps."""
    up, down = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    line = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        grad = x.T @ (p - target) + 1e-3 * line
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        line -= np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return float(line[0]), float(line[1])


def training_rows(id_col: str) -> Column:
    """Rows that labels may be learnt from: CRC-32 of the id as text is no multiple of 5."""
    return id_hash(id_col) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, ratio_rows: int = RATIO_ROWS, fit_rows: int = FIT_ROWS, bits: int = BITS) -> Model:
    """A model from the labelled training rows.

    Each task adds up its counts by feature and passes on its rows of the sample, in one pass over the
    texts. The driver gets ``2 ** bits`` counts and weights.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & training_rows(id_col)).select(id_col, F.col(label_col).cast("int").alias("label"))
    rows = max(1, known.count())
    place, whole = F.pmod(F.xxhash64(F.lit(5), id_col), F.lit(1 << 30)), 1 << 30
    known = known.where(place < int(min(1.0, ratio_rows / rows) * whole))
    texts = docs.where(training_rows(id_col)).select(id_col, text_col).join(F.broadcast(known), id_col)
    texts = texts.select(F.col(text_col).alias("text"), "label", (place < int(min(1.0, fit_rows / rows) * whole)).alias("drawn"))
    size = 1 << bits
    width = size // BLOCKS

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.int64)
        seen = [0, 0]
        for part in text_slices(batches, "text", SLICE):
            features, offsets = indicators(part.column("text").to_pylist(), bits)
            label = (part.column("label").to_numpy() > 0).astype(int)
            per_row = np.repeat(label, np.diff(offsets))
            for k in (0, 1):
                counts[k] += np.bincount(features[per_row == k], minlength=size)
                seen[k] += int((label == k).sum())
            drawn = np.flatnonzero(part.column("drawn").to_numpy(zero_copy_only=False))
            if len(drawn):
                rows = [features[offsets[i] : offsets[i + 1]] for i in drawn]
                yield batch([-1] * len(drawn), label[drawn].tolist(), rows, [None] * len(drawn))
        forget()
        if sum(seen):
            yield batch([BLOCKS, *range(BLOCKS)], [0] * (BLOCKS + 1), [seen[:1], *counts[0].reshape(BLOCKS, width)], [seen[1:], *counts[1].reshape(BLOCKS, width)])

    def batch(block: list, label: list, first: list, second: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(label, pa.int32()), pa.array(first, pa.list_(pa.int64())), pa.array(second, pa.list_(pa.int64()))], ["block", "label", "first", "second"])

    gathered = stored(texts.mapInArrow(gather, "block int, label int, first array<bigint>, second array<bigint>"), "quality")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for part in batches:
            for block, a, b in zip(part.column("block").to_pylist(), part.column("first"), part.column("second")):
                own = sums.setdefault(block, [0, 0])
                own[0], own[1] = own[0] + a.values.to_numpy(), own[1] + b.values.to_numpy()
        for block, (a, b) in sums.items():
            yield batch([block], [0], [a], [b])

    totals = gathered.where("block >= 0").repartition(BLOCKS, "block").mapInArrow(add, gathered.schema).collect()
    counts = np.zeros((2, size))
    rows = np.zeros(2)
    for r in totals:
        if r.block == BLOCKS:
            rows[:] = r.first[0], r.second[0]
        else:
            counts[:, r.block * width : (r.block + 1) * width] = r.first, r.second
    if not rows.all():  # one class or none: nothing to tell apart
        sure = 0.5 if not rows.any() else float(rows[1] > 0)
        return Model(np.zeros(size), np.eye(1, size)[0], 0.0, (sure - 0.5) * 20, bits)
    ratios = log_ratios(counts, rows)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, label = [], []
        for part in batches:
            label += part.column("label").to_pylist()
            rows += [x.values.to_numpy().astype(np.int32) for x in part.column("first")]
        order = sorted(range(len(rows)), key=lambda i: (len(rows[i]), rows[i].tobytes(), label[i]))  # whatever order they came in
        rows, label = [rows[i] for i in order], np.array([label[i] for i in order])
        held = np.arange(len(rows)) % 5 == 0

        def flat(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            some = [rows[i] for i in np.flatnonzero(which)]
            return np.concatenate([*some, np.empty(0, np.int32)]), np.concatenate([[0], np.cumsum([len(r) for r in some])]).astype(np.int64)

        weights = descend(*flat(~held), label[~held], ratios)
        slope, shift = calibrate(Model(weights, ratios, 1, 0, bits).margins(*flat(held)), label[held]) if held.any() else (1.0, 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()]), pa.array([slope]), pa.array([shift])], ["weights", "slope", "shift"])

    sample = gathered.where("block = -1").select("label", "first")
    found = sample.coalesce(1).mapInArrow(train, "weights array<double>, slope double, shift double").first()
    return Model(np.array(found.weights), ratios, found.slope, found.shift, bits)


def log_ratios(counts: np.ndarray, rows: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of how much commoner a feature is among rows of label 1; 0 where it never was seen. The constant feature has 1."""
    share = rows / rows.sum()
    low, high = ((counts[k] + smoothing * share[k]) / (rows[k] + smoothing * share[k]) for k in (0, 1))
    ratios = np.where(counts.sum(0) > 0, np.log(high / low), 0.0)
    ratios[0] = 1.0
    return ratios


def score(docs: DataFrame, id_col: str, text_col: str, model: Model, cut: float = CUT, keep: list[str] = ()) -> DataFrame:
    """``(id_col, *keep, held_out, score, predicted)`` for every row; a null id is not held out."""
    taken = [id_col, *(c for c in keep if c != id_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text, SLICE):
            p = model.scores(part.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*(part.column(f"kept {n}") for n in range(len(taken))), part.column("held out"), pa.array(p), pa.array((p >= cut).astype(np.int32))], [*(f"kept {n}" for n in range(len(taken))), "held out", "score", "predicted"])
        forget()

    text = f"kept {taken.index(text_col)}" if text_col in taken else "scored text"  # a text that is kept is sent once
    chosen = [*(F.col(c).alias(f"kept {n}") for n, c in enumerate(taken)), F.coalesce(~training_rows(id_col), F.lit(False)).alias("held out")]
    chosen += [F.col(text_col).alias(text)] if text_col not in taken else []
    kinds = [f"`kept {n}` {docs.schema[c].dataType.simpleString()}" for n, c in enumerate(taken)]
    found = docs.select(*chosen).mapInArrow(run, ", ".join([*kinds, "`held out` boolean, score double, predicted int"]))
    return found.select(*(F.col(f"kept {n}").alias(c) for n, c in enumerate(taken)), F.col("held out").alias("held_out"), "score", "predicted")
