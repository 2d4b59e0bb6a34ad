"""Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of an incremental (LZ78) dictionary: each phrase is the longest known one and one code
point more. Texts that would compress well together have many phrases in common, so the phrase set is hashed and its
smallest hashes are kept; two such signatures estimate the Jaccard similarity of the sets. The dictionary
starts anew every ``SPAN`` code points, which bounds what a text of any length holds in memory.

``edited_pairs`` compares each document with an edit of it and with the next document. Documents meet
their successor in one shuffle of compressed texts: ids are dealt to ranges of about equal size, and the first row of a
range is also sent to the one before it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import spread, text_slices

SIZE = 128
SPAN = 1 << 20
RANGE_BYTES = 8 << 20
#: Ranges at most, which is what the driver holds; with more text ranges get larger. A range is read as a stream, whatever its size.
MOST_RANGES = 20_000
LETTER_BITS = 21
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2^64, for ``SPAN`` code points: 16 MB a worker."""
    steps = (BASE, np.uint64(pow(int(BASE), -1, 1 << 64)))
    up, down = (np.concatenate([np.ones(1, np.uint64), np.full(SPAN, s)]).cumprod(dtype=np.uint64) for s in steps)
    return up, down


def _parse(text: str, known: dict[int, int], node: int) -> int:
    """Phrases of ``text`` added to ``known``, which has ``(phrase, code point)`` to phrase; goes on within phrase ``node``."""
    get, new = known.get, len(known)
    for letter in map(ord, text):
        at = node + letter
        below = get(at)
        if below is None:
            new += 1
            known[at] = new << LETTER_BITS
            node = 0
        else:
            node = below
    return node


def _smallest(known: dict[int, int], text: str, size: int) -> np.ndarray:
    """The smallest hashes of the phrases, which stand in ``text`` one after the other; a rest that is known adds none."""
    parent = np.concatenate([[0], np.fromiter(known, np.int64, len(known)) >> LETTER_BITS])
    length = np.ones(len(parent), np.int64)
    length[0] = 0
    while parent.any():  # lengths add up along ever longer leaps towards the root
        length, parent = length + length[parent], parent[parent]
    ends = np.cumsum(length)
    letters = np.frombuffer(text[: int(ends[-1])].encode("utf-32-le"), "<u4").astype(np.uint64)
    up, down = _powers()
    # a phrase's value is the sum of its scrambled letters times rising powers of BASE, a difference of sums over the text
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_mixed(letters + np.uint64(1)) * up[: len(letters)], out=sums[1:])
    starts = ends[:-1]
    value = (sums[ends[1:]] - sums[starts]) * down[starts] + up[length[1:]]
    return np.unique((_mixed(value) >> np.uint64(32)).astype(np.uint32))[:size]


def _merged(parts: list[np.ndarray], size: int) -> np.ndarray:
    return np.unique(np.concatenate(parts))[:size] if parts else np.empty(0, np.uint32)


def signature(text: str | None, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest hashes of the phrase set, ascending; all of them if there are fewer, none for an empty text."""
    return _signatures(text or "", None, None, size)[0]


def _signatures(text: str, cut: int | None, rest: str | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of ``text``, and of ``text[:cut] + rest``; what stands before the cut is parsed once."""
    own: list[np.ndarray] = []
    edited: list[np.ndarray] = []
    for a in range(0, len(text), SPAN):
        b = min(a + SPAN, len(text))
        known: dict[int, int] = {}
        if cut is not None and a < cut < b:
            node = _parse(text[a:cut], known, 0)
            forked = known.copy()
            _parse(text[cut:b], known, node)
            room = SPAN - (cut - a)
            _parse(rest[:room], forked, node)
            edited.append(_smallest(forked, text[a:cut] + rest[:room], size))
            rest = rest[room:]
        else:
            _parse(text[a:b], known, 0)
        part = _smallest(known, text[a:b], size)
        own.append(part)
        if cut is not None and b <= cut:
            edited.append(part if b - a == SPAN or not rest else _smallest_of(text[a:b] + rest[: SPAN - (b - a)], size))
            if b - a < SPAN:
                rest = rest[SPAN - (b - a) :]
    edited += [_smallest_of(rest[a : a + SPAN], size) for a in range(0, len(rest or ""), SPAN)]
    return _merged(own, size), _merged(edited, size)


def _smallest_of(text: str, size: int) -> np.ndarray:
    known: dict[int, int] = {}
    _parse(text, known, 0)
    return _smallest(known, text, size)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Share of the smallest hashes of both sets together that are in both: 1 for two empty sets, exact for small ones."""
    both = np.unique(np.concatenate([a, b]))[:size]
    return float(np.isin(both, a, assume_unique=True)[np.isin(both, b, assume_unique=True)].sum() / len(both)) if len(both) else 1.0


def printed(found: np.ndarray) -> str:
    """Eight hexadecimal digits a hash."""
    return found.astype(">u4").tobytes().hex()


def fingerprints(df: DataFrame, id_col: str, text_col: str, size: int = SIZE) -> DataFrame:
    """``(id_col, fingerprint)`` for every row; that of a null or empty text is the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            prints = [printed(signature(t, size)) for t in part.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(prints, pa.string())], [id_col, "fingerprint"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def _key(doc_id: int | None, tie: int) -> tuple[bool, int, int]:
    """The order of documents, ascending: rows without an id first."""
    return doc_id is not None, doc_id or 0, tie


def _splits(rows: DataFrame, ranges: int) -> list[tuple[bool, int, int]]:
    """At most ``ranges - 1`` keys that part the rows into about equal ranges; an id of many rows is parted by its texts' hashes."""
    shares = [n / ranges for n in range(1, ranges)]
    ids = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 5 * ranges)).alias("q")).first()["q"] if shares else None
    found = []
    for doc_id, often in sorted(Counter(ids or []).items()):
        found += [_key(doc_id, -(1 << 63) + (n << 64) // often) for n in range(often)]
    return found


def edited_pairs(df: DataFrame, id_col: str, text_col: str, size: int = SIZE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document beside its edit and its successor.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for every row. In the edit the last half of the
    code points is replaced by the first as many (or all) of the next document, by descending id; the first follows the
    last, and a single row follows itself. Rows of one id are ordered by XXH64 of their texts, descending; rows without an
    id come last. A null text is empty; empty texts are wholly alike. An empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = spread(rows).withColumn("tie", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    spark = df.sparkSession
    splits = _splits(rows, min(MOST_RANGES, max(spark.sparkContext.defaultParallelism, total // range_bytes + 1)))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            best: dict[int, tuple] = {}
            for key in map(_key, part.column("doc_id").to_pylist(), part.column("tie").to_pylist()):
                at = bisect_right(splits, key)
                if at not in best or key > best[at]:
                    best[at] = key
            at, keys = list(best), list(best.values())
            columns = [pa.array(at, pa.int32()), pa.array([k[0] for k in keys], pa.bool_()), *(pa.array([k[n] for k in keys], pa.int64()) for n in (1, 2))]
            yield pa.RecordBatch.from_arrays(columns, ["at", "named", "id", "tie"])

    first = rows.select("doc_id", "tie").mapInArrow(heads, "at int, named boolean, id long, tie long")
    first = first.groupBy("at").agg(F.max(F.struct("named", "id", "tie")).alias("key")).collect()  # one row a range
    filled = sorted((r["at"] for r in first), reverse=True)
    place = {at: n for n, at in enumerate(filled)}
    before = {tuple(r["key"]): (place[r["at"]] - 1) % len(filled) for r in first}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for part in text_slices(batches, "text"):
            out: list[tuple] = []
            for doc_id, text, tie in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "tie"))):
                key, packed = _key(doc_id, tie), pack(text.encode("utf-8"))
                out.append((place[bisect_right(splits, key)], False, doc_id, tie, packed))
                if key in before:
                    out.append((before[key], True, doc_id, tie, packed))
            kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], kinds[n]) for n in range(5)], ["range", "ahead", "doc_id", "tie", "packed"])

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        doc: tuple | None = None  # the last document read: its id and text
        open_row: tuple | None = None  # the row before it, which lacks near_next, and its signature

        def closed(own: np.ndarray) -> list[tuple]:
            return [(*open_row[0], likeness(open_row[1], own, size))] if open_row else []

        for part in batches:
            out: list[tuple] = []
            for ahead, doc_id, packed in zip(*(part.column(c).to_pylist() for c in ("ahead", "doc_id", "packed"))):
                if ahead and doc is None:
                    continue  # a repeated row, sent ahead once more
                text = unpack(packed).decode("utf-8")
                if doc is not None:
                    half = len(doc[1]) // 2
                    cut, rest = len(doc[1]) - half, text[:half]
                    own, edited = _signatures(doc[1], cut, rest, size)
                    out += closed(own)
                    sha = hashlib.sha256((doc[1][:cut] + rest).encode("utf-8")).hexdigest()
                    open_row = ((doc[0], len(doc[1]), sha, printed(own), printed(edited), likeness(own, edited, size)), own)
                doc = (doc_id, text)
                if ahead:
                    out += closed(signature(text, size))
                    doc = open_row = None
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], kinds[n]) for n in range(7)], names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    sent = rows.mapInArrow(send, "range int, ahead boolean, doc_id long, tie long, packed binary").repartitionById(max(1, len(filled)), F.col("range"))
    return sent.sortWithinPartitions("ahead", F.desc_nulls_last("doc_id"), F.desc("tie")).mapInArrow(compare, schema)
