"""Removal of repeated passages, by super-k-mers.

A window is ``window`` consecutive words. Its minimiser is the smallest hash among its ``gram``-word
sequences; consecutive windows that share it travel as one packed string of words to the minimiser's
bucket. A bucket sorts its windows, compares equal hashes word by word, and finds the smallest document of
each. A window is repeated if that document comes before its own.

What keeps buckets even:
* word sequences that make up a large share of any slice of text (at most ``1 / HOT_SHARE`` per slice, kept
  by their total) rank behind all others, so a common line does not draw the windows around it;
* a string that occurs in several documents of a slice goes to its bucket once, for the smallest of
  them: in the others all its windows are repeated, whatever the bucket says.
A bucket that is still large is sorted in several passes, each over a share of the window hashes.

The strings of a slice that go to the same bucket are compressed together, and repeats found in the slice
travel with them, so the texts are read three times and only moved once as strings and once to meet
their repeats.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import numbers, spread, text_slices

WINDOW = 13
GRAM = 2
HOT_SHARE = 20_000
HOT_LEAST = 50
SLICE = 6 << 20
ZSTD_LEVEL = 3
#: Bytes of packed words in a bucket, and in one of its passes.
BUCKET_BYTES = 6 << 20
PASS_WORDS = 3_000_000
LAST_ID = np.iinfo(np.int64).max  # where an id is null

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words:
    """The words of some texts: the document of each, its hash, and the words joined by one space."""

    def __init__(self, texts: list[bytes | None]):
        known = numbers()
        order, counts, parts = array("i"), [], []
        for text in texts:
            words = text.split() if text else ()
            counts.append(len(words))
            order.extend(map(known.__getitem__, words))
            if words:
                parts.append(b" ".join(words))
        at = np.frombuffer(order, np.int32) if len(order) else np.empty(0, np.int32)
        keys = list(known)
        self.doc = np.repeat(np.arange(len(texts)), counts)
        self.first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.hash = np.array([xxhash.xxh64_intdigest(w) for w in keys], np.uint64)[at] if keys else np.empty(0, np.uint64)
        sizes = np.array([len(w) for w in keys], np.int64)[at] if keys else np.empty(0, np.int64)
        self.stop = np.cumsum(sizes + 1) - 1
        self.start = self.stop - sizes
        self.joined = b" ".join(parts)

    def grams(self, gram: int) -> np.ndarray:
        """Hash of the ``gram`` words from each position on, across documents too."""
        n = max(0, len(self.hash) - gram + 1)
        h = np.zeros(n, np.uint64)
        for k in range(gram):
            h = _mixed(h * _A + self.hash[k : k + n])
        return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def hot_grams(docs: DataFrame, text_col: str, gram: int) -> tuple[np.ndarray, int]:
    """Hashes of common word sequences, ``HOT_SHARE`` at most, and the bytes of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for part in text_slices(batches, text_col, SLICE):
            words = _Words(part.column(text_col).cast(pa.binary()).to_pylist())
            total += len(words.joined)
            hashes, counts = np.unique(words.grams(gram), return_counts=True)
            hot = counts >= max(HOT_LEAST, len(words.hash) // HOT_SHARE)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[hot].view(np.int64)), pa.array(counts[hot])], ["hash", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["hash", "n"])

    rows = docs.select(text_col).mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).orderBy(F.col("hash").isNull().desc(), F.desc("n"), "hash").limit(HOT_SHARE + 1).collect()
    total = sum(r.n for r in rows if r.hash is None)
    return np.sort(np.array([r.hash for r in rows if r.hash is not None], np.int64).view(np.uint64)), total


def _packed(strings: list[bytes], counts: np.ndarray, ids: np.ndarray, keys: np.ndarray, places: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    """Strings of ``counts`` words with the document, its key and the first window of each."""
    body = [struct.pack("<q", len(strings)), ids.astype("<i8").tobytes(), keys.astype("<u4").tobytes(), places.astype("<i4").tobytes(), counts.astype("<i4").tobytes()]
    return press.compress(b"".join([*body, b" ".join(strings)]))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Ids, keys, places, counts, and the words of all strings."""
    body = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<q", body)
    parts = [np.frombuffer(body, kind, n, 8 + n * at) for kind, at in (("<i8", 0), ("<u4", 8), ("<i4", 12), ("<i4", 16))]
    return *parts, body[8 + 20 * n :].split(b" ")


_COLUMNS = ["bucket", "blob", "id", "key", "first", "last"]
_SCHEMA = "bucket long, blob binary, id long, key long, first int, last int"


def _rows(bucket: list, blob: list, id_: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    kinds = pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((bucket, blob, id_, key, first, last), kinds)], _COLUMNS)


def super_kmers(words: _Words, window: int, gram: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each run of windows of a document with one minimiser, and the minimiser."""
    n = len(words.hash) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    rank = words.grams(gram)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, rank), len(hot) - 1)
        rank = rank >> np.uint64(1) | (hot[at] == rank).astype(np.uint64) << np.uint64(63)
    least = _sliding_min(rank, window - gram + 1)
    inside = words.doc[:n] == words.doc[window - 1 :]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    new = np.concatenate([[True], (np.diff(starts) > 1) | (least[starts[1:]] != least[starts[:-1]]) | (words.doc[starts[1:]] != words.doc[starts[:-1]])])
    first = starts[new]
    last = starts[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]
    return first, last, least[first]


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    odd = _B | np.uint64(1)
    up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x)])) for x in (odd, np.uint64(pow(int(odd), -1, 1 << 64))))
    return up, down


def repeated_in(ids: np.ndarray, words: np.ndarray, window: int, counts: np.ndarray) -> np.ndarray:
    """For each window of the strings (word numbers, ``counts`` words each): does it start in a smaller document too?

    ``ids`` is the document of each string. The result has a place for each word; the last
    ``window - 1`` of a string begin no window and are false.
    """
    n = len(words)
    string = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    begins = np.arange(n) <= (ends - window)[string]
    power, back = _powers(1 << max(16, n.bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(words.astype(np.uint64) + _A) * power[:n])])
    at = np.flatnonzero(begins)
    out = np.zeros(n, bool)
    if not len(at):
        return out
    hashes = (sums[at + window] - sums[at]) * back[at]
    passes = -(-len(at) // PASS_WORDS)
    for turn in range(passes):
        own = at if passes == 1 else at[hashes % np.uint64(passes) == turn]
        key = hashes if passes == 1 else hashes[hashes % np.uint64(passes) == turn]
        order = np.argsort(key)  # the order among equal hashes does not matter
        own, key = own[order], key[order]
        same = key[1:] == key[:-1]
        close = np.flatnonzero(same)
        for k in range(window):  # equal hashes are equal windows only if every word agrees
            if (words[own[close] + k] != words[own[close + 1] + k]).any():
                order = np.lexsort([words[own + j] for j in range(window)])
                own = own[order]
                same = np.logical_and.reduce([words[own[1:] + j] == words[own[:-1] + j] for j in range(window)])
                break
        group = np.concatenate([[True], ~same])
        least = np.minimum.reduceat(ids[string[own]], np.flatnonzero(group)) if len(own) else own
        out[own] = least[np.cumsum(group) - 1] < ids[string[own]]
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last position of each run of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, slice_bytes: int = SLICE) -> DataFrame:
    """``(id, key, first, last)``: windows ``first`` to ``last`` of a document also start in one with a smaller id.

    ``docs`` has ``id long, key long, text``; a null id counts as larger than any other.
    """
    spark = docs.sparkSession
    hot, size = hot_grams(docs, "text", gram)
    buckets = max(16, -(-3 * size // BUCKET_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
        for part in text_slices(batches, "text", slice_bytes):
            words = _Words(part.column("text").cast(pa.binary()).to_pylist())
            id_ = np.array([LAST_ID if i is None else i for i in part.column("id").to_pylist()], np.int64)
            key = part.column("key").to_numpy().astype(np.uint32)
            first, last, least = super_kmers(words, window, gram, hot)
            doc = words.doc[first]
            place = first - words.first[doc]
            order = np.lexsort([first, key[doc], id_[doc]])
            seen: dict[bytes, int] = {}
            joined, begin, end = words.joined, words.start[first].tolist(), words.stop[last + window - 1].tolist()
            owner = id_[doc].tolist()
            strings: list = [None] * len(first)
            sent, told = [], []
            for r in order.tolist():
                string = joined[begin[r] : end[r]]
                if seen.setdefault(string, owner[r]) == owner[r]:
                    strings[r] = string
                    sent.append(r)
                else:
                    told.append(r)
            if told:
                t = np.array(told)
                yield _rows((_mixed(id_[doc[t]].view(np.uint64)) % np.uint64(buckets)).astype(np.int64), [None] * len(t), id_[doc[t]], key[doc[t]].astype(np.int64), place[t].astype(np.int32), (place[t] + last[t] - first[t]).astype(np.int32))
            if sent:
                s = np.array(sent)
                bucket = (_mixed(least[s]) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                s, bucket = s[by], bucket[by]
                cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(s)]
                blobs = [_packed([strings[i] for i in s[a:b]], (last - first)[s[a:b]] + window, id_[doc[s[a:b]]], key[doc[s[a:b]]], place[s[a:b]], press) for a, b in zip(cuts, cuts[1:])]
                none = [None] * len(blobs)
                yield _rows(bucket[cuts[:-1]], blobs, none, none, none, none)

    def settle(blobs: list[bytes]) -> pa.RecordBatch | None:
        known = numbers()
        parts, order = [], []
        for blob in blobs:
            *numeric, words = _unpacked(blob)
            parts.append(numeric)
            order.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        del known
        id_, key, place, count = map(np.concatenate, zip(*parts))
        count = count.astype(np.int64)
        first, last = _runs(repeated_in(id_, np.concatenate(order), window, count))
        if not len(first):
            return None
        ends = np.cumsum(count)
        string = np.searchsorted(ends, first, side="right")
        base = place[string] - (ends - count)[string]
        none = [None] * len(first)
        return _rows([0] * len(first), none, id_[string], key[string].astype(np.int64), (first + base).astype(np.int32), (last + base).astype(np.int32))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for part in batches:
            told = part.filter(pc.is_null(part.column("blob")))
            if told.num_rows:
                yield told
            sent = part.filter(pc.is_valid(part.column("blob")))
            for bucket, blob in zip(sent.column("bucket").to_pylist(), sent.column("blob")):
                if bucket != now and blobs:
                    if found := settle(blobs):
                        yield found
                    blobs = []
                now = bucket
                blobs.append(blob.as_py())
        if blobs and (found := settle(blobs)):
            yield found

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(buckets, 4 * spark.sparkContext.defaultParallelism), -(-buckets // 8))
    moved = docs.mapInArrow(cut, _SCHEMA).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return moved.mapInArrow(gather, _SCHEMA).select("id", "key", "first", "last")


def dedup(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, gram: int = GRAM, keep_untouched: bool = False, slice_bytes: int = SLICE) -> DataFrame:
    """``df`` with the words that remain, joined by one space, in ``text_col``, and ``n_words``, ``n_removed`` long.

    A word goes if it is covered by a window that also starts in a document with a smaller id; windows
    are judged on the input. Rows with equal ids are one document: they never remove each other's words. A
    null id counts as larger than any other. A null text has no words and becomes the empty text, as does
    one of white space. ``slice_bytes`` of text are cut into strings at a time, which bounds memory and does not change results. With ``keep_untouched`` a text that loses no word keeps its own white space. Columns of ``df`` that are named like the two counts are replaced.
    """
    rest = [c for c in df.columns if c not in (text_col, "n_words", "n_removed")]
    held = spread(df.select(F.struct(*rest).alias("rest"), F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST_ID))).alias("id"), F.col(text_col).alias("text")))
    held = held.withColumn("key", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    found = repeats(held.select("id", "key", "text"), window, gram, slice_bytes)
    found = found.groupBy("id", "key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    joined = held.join(found, ["id", "key"], "left").select("rest", "text", "spans")
    kind = joined.schema["rest"].dataType.simpleString()

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            texts, words, removed = [], [], []
            for text, spans in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("spans").to_pylist()):
                own = text.split() if text else []
                words.append(len(own))
                if spans:
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, [s["first"] for s in spans], 1)
                    np.add.at(edge, [s["last"] + window for s in spans], -1)
                    keep = np.cumsum(edge)[:-1] == 0
                    removed.append(len(own) - int(keep.sum()))
                    own = [own[i] for i in np.flatnonzero(keep)]
                else:
                    removed.append(0)
                texts.append((text or b"") if keep_untouched and not spans else b" ".join(own))
            yield pa.RecordBatch.from_arrays([part.column("rest"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(words, pa.int64()), pa.array(removed, pa.int64())], ["rest", "text", "n_words", "n_removed"])

    done = joined.mapInArrow(strip, f"rest {kind}, text string, n_words long, n_removed long")
    columns = [F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in df.columns if c not in ("n_words", "n_removed")]
    return done.select(*columns, "n_words", "n_removed")
