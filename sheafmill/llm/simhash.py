"""SimHash fingerprints, linked by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within ``radius`` bits agree in some segment but for
``radius // segments`` bits, so each segment value enumerates its small Hamming ball, fetches the
fingerprints with such a value from the segment's table, and verifies the complete distance in the join
itself. Of the two that differ in a segment only the one with the smaller value probes, so a pair is
fetched once per segment.

Exact copies share a fingerprint and are merged before anything is probed. Only the texts are read by
Python; the index is a join on (segment, value), whose hot values Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.components import connected_components
from ..session import cut_lineage
from .common import spread, stored, text_slices

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
SEGMENTS = 2


def _majority(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes."""
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for texts of any length
        some = hashes[at : at + (1 << 16)]
        set_in += np.unpackbits(some.view(np.uint8), bitorder="little").reshape(len(some), 64).sum(0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


def shingle_hashes(text: str | None, shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle, repeats included; of the whole sequence if it is shorter, of nothing without words."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.empty(0, np.dtype("<u8"))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], np.dtype("<u8"))


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64 bits; bit i is 1 if it is set in over half of the shingles' hashes, repeats included."""
    return _majority(shingle_hashes(text, shingle, seed))


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE_WORDS, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``(id_col, bits long)`` and the columns to keep for every row; a null text or one without words has 0."""
    carried = [id_col, *(keep or [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            bits = np.array([fingerprint(t, shingle, seed) for t in part.column(text_col).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(bits.view(np.int64))], [*carried, "bits"])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in carried)
    return df.select(*carried, text_col).mapInArrow(run, f"{kinds}, bits long")


def _segment(k: int, segments: int) -> tuple[int, int]:
    """First bit and width of a segment."""
    first = 64 * k // segments
    return first, 64 * (k + 1) // segments - first


def links(distinct: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """``(src, dst)`` for every two different values of ``bits`` that differ in ``radius`` bits or fewer."""
    values, probes = [], []
    for k in range(segments):
        first, width = _segment(k, segments)
        mask = (1 << width) - 1
        value = F.shiftrightunsigned("bits", first).bitwiseAND(F.lit(mask))
        flips = [sum(1 << b for b in c) for n in range(radius // segments + 1) for c in combinations(range(width), n)]
        ball = F.filter(F.transform(F.array(*map(F.lit, flips)), lambda m: value.bitwiseXOR(m.cast("long"))), lambda p: p >= value)  # noqa: B023
        values.append(F.struct(F.lit(k).alias("segment"), value.alias("value")))
        probes.append(F.transform(ball, lambda p: F.struct(F.lit(k).alias("segment"), p.alias("value"))))  # noqa: B023
    table = distinct.select(F.col("bits").alias("dst"), F.explode(F.array(*values)).alias("s")).select("dst", "s.*")
    asked = distinct.select(F.col("bits").alias("src"), F.explode(F.concat(*probes)).alias("s")).select("src", "s.*")
    near = (table.segment == asked.segment) & (table.value == asked.value)
    near &= (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius) & (F.col("src") != F.col("dst"))
    return asked.join(table, near).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def near_duplicates(
    df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE_WORDS, radius: int = RADIUS, segments: int = SEGMENTS, keep: list[str] | None = None
) -> DataFrame:
    """``(id_col, bits, component, component_id)`` and the columns to keep, for every row.

    ``component_id`` is the smallest id reachable over links, its own included; ``component`` a fingerprint that
    names the group, also where ids repeat.

    Rows with equal ids are rows of their own. A null id never is a component's id unless it has no other.
    An empty table gives an empty result.
    """
    prints = stored(fingerprints(spread(df.select(id_col, *(keep or []), text_col)), id_col, text_col, shingle, keep=keep), "simhash")
    distinct = cut_lineage(prints.groupBy("bits").agg(F.min(id_col).alias("least")))
    components = connected_components(links(distinct, radius, segments))
    named = distinct.join(components.select(F.col("id").alias("bits"), "component"), "bits", "left")
    named = cut_lineage(named.withColumn("component", F.coalesce("component", "bits")))
    smallest = cut_lineage(named.groupBy("component").agg(F.min("least").alias("component_id")))
    by_bits = cut_lineage(named.join(smallest, "component").select("bits", "component", "component_id"))
    return prints.join(by_bits, "bits").select(id_col, *(keep or []), "bits", "component", "component_id")
