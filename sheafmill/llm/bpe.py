"""BPE encoding and decoding over an index of pair occurrences.

The distinct words of a slice of a partition are laid out as one list of symbols. An index maps each
mergeable pair to all its positions; a heap holds the active ranks. The lowest rank is applied to all
its positions from left to right, and only the lists of the pairs beside a merge are updated. Words
do not touch each other, so taking one rank everywhere gives each word the merges it would get alone;
where a merge makes a pair of a still lower rank, the rest of the list waits until that one is done.

Nulls and empty texts have no tokens. Texts are never cut; a text of any length is one row of a slice.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import numbers, spans, text_slices

#: Distinct chunks and words kept between slices of a partition; the cache starts anew beyond that, with the same results.
CACHE_CHUNKS = 250_000
#: Text that shares one index; a longer text is an index of its own.
SLICE_BYTES = 8 << 20
#: Lists of fewer positions are merged one by one.
FEW = 8
#: Latin letters that have one lower-case form, in a composed text, whatever stands beside them.
LATIN = "\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f"
PLAIN = re.compile(f"[!-~{LATIN}]+")
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + n for n, b in enumerate(rest)}


class PairIndexBpe:
    """A tokenizer file's BPE model. The file's own normaliser and splitter are used on text beyond Latin letters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.rank_of: dict[int, int] = {}
        self.rules: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rules.append((self.vocab[a], self.vocab[b], self.vocab[a + b]))
            self.rank_of.setdefault(self.vocab[a] << 20 | self.vocab[b], rank)
        self.keys = np.sort(np.fromiter(self.rank_of, np.int64, len(self.rank_of)))
        self.key_ranks = np.array([self.rank_of[k] for k in self.keys.tolist()], np.int64)
        lowest: dict[int, int] = {}  # of the rules that a symbol takes part in
        for rank, (a, b, _) in enumerate(self.rules):
            lowest.setdefault(a, rank)
            lowest.setdefault(b, rank)
        #: Rules whose product can make a pair of a lower rank; their positions are taken one by one.
        self.disturbing = {rank for rank, (_, _, new) in enumerate(self.rules) if lowest.get(new, rank) < rank}
        library = Tokenizer.from_file(path)
        self.normalise, self.presplit = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.strings: dict[int, str] = {i: s for s, i in [*self.vocab.items(), *self.special.items()]}
        self.bytes = byte_letters()
        letters = {s for s in self.vocab if len(s) == 1 and s + self.suffix in self.vocab}
        self.plain = {c: self.vocab[c] for c in letters}
        self.final = {c: self.vocab[c + self.suffix] for c in letters}
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.chunks = numbers()
        self.word_ids, self.word_ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.chunk_ids, self.chunk_ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def pieces(self, text: str) -> list[str]:
        """The words, in byte-level letters, of a text without special tokens and ASCII white space."""
        if text.isascii() and text.isprintable():
            return PIECES.findall(text.lower())
        if PLAIN.fullmatch(text):
            return [p.encode().decode("latin-1").translate(self.bytes) for p in PIECES.findall(text.lower())]
        return [piece for piece, _ in self.presplit(self.normalise(text))] if text else []

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in one array, all words merged together through the pair index, and each word's end."""
        if not all(map(self.plain.__contains__, letters := "".join(words))):
            words = ["".join(c for c in w if c in self.plain) for w in words]
            letters = "".join(words)
        lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lengths)
        last, first = ends[lengths > 0] - 1, (ends - lengths)[lengths > 0]
        symbols = np.fromiter(map(self.plain.__getitem__, letters), np.int64, len(letters))
        symbols[last] = [self.final[w[-1]] for w in words if w]
        following, before = np.arange(1, len(letters) + 1), np.arange(-1, len(letters) - 1)
        following[last] = before[first] = -1
        merged = self._merge(symbols, following, before).astype(np.int32)
        left = np.concatenate([[0], np.cumsum(merged >= 0)])
        return merged[merged >= 0], left[ends]

    def _merge(self, symbols: np.ndarray, following: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Apply active ranks in ascending order; long lists of positions as arrays, short ones singly."""
        where: dict[int, list] = {}
        active: list[int] = []

        def add(ranks: np.ndarray, places: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
            for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
                if rank not in where:
                    where[rank] = []
                    heapq.heappush(active, rank)
                where[rank].append(places[a:b])

        def pairs_at(lefts: np.ndarray) -> None:
            keys = symbols[lefts] << 20 | symbols[following[lefts]]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            if hit.any():
                add(self.key_ranks[at[hit]], lefts[hit])

        pairs_at(np.flatnonzero(following >= 0))
        views = memoryview(symbols), memoryview(following), memoryview(before)
        while active:
            rank = heapq.heappop(active)
            if rank not in where:
                continue
            parts = where.pop(rank)
            places = np.concatenate([np.atleast_1d(p) for p in parts]) if len(parts) > 1 else np.atleast_1d(parts[0])
            a, b, new = self.rules[rank]
            if len(places) < FEW or a == b or rank in self.disturbing:
                self._merge_singly(rank, np.sort(places).tolist(), views, where, active)
                continue
            i = places[symbols[places] == a]
            j = following[i]
            held = (j >= 0) & (symbols[j] == b)
            i, j = np.unique(i[held]), None
            if not len(i):
                continue
            j = following[i]
            k = following[j]
            symbols[i], symbols[j], following[i] = new, -1, k
            more = k >= 0
            before[k[more]] = i[more]
            left = before[i]
            if len(lefts := np.concatenate([i[more], left[left >= 0]])):
                pairs_at(lefts)
        return symbols

    def _merge_singly(self, rank: int, places: list[int], views: tuple, where: dict[int, list], active: list[int]) -> None:
        symbols, following, before = views
        rank_of = self.rank_of.get
        a, b, new = self.rules[rank]
        for done, i in enumerate(places, 1):
            j = following[i]
            if j < 0 or symbols[i] != a or symbols[j] != b:
                continue  # an earlier merge took one of the two
            symbols[i], symbols[j] = new, -1
            following[i] = k = following[j]
            lowest = rank
            if k >= 0:
                before[k] = i
            for left in (i, before[i]):
                if left >= 0 and (right := following[left]) >= 0:
                    made = rank_of(symbols[left] << 20 | symbols[right])
                    if made is not None:
                        if made in where:
                            where[made].append(left)
                        else:
                            where[made] = [left]
                            heapq.heappush(active, made)
                        lowest = min(lowest, made)
            if lowest < rank:
                if done < len(places):  # a pair of a lower rank goes first
                    where.setdefault(rank, []).extend(places[done:])
                    heapq.heappush(active, rank)
                return

    def _learn(self, fresh: list[bytes]) -> None:
        """Add the ids of new chunks to the cache; a special token is a word of its own."""
        known, new, plan, counts = self.words, [], [], []
        whole = b" ".join(fresh).decode("utf-8")  # no chunk holds a space
        special = any(map(whole.__contains__, self.special))
        for text in whole.split(" "):
            if special and any(map(text.__contains__, self.special)):
                found = [x for part in self.split_special.split(text) for x in ([part] if part in self.special else self.pieces(part))]
            elif text.isascii() and text.isalpha():
                found = (text.lower(),)
            else:
                found = self.pieces(text)
            for word in found:
                at = known.get(word)
                if at is None:
                    at = known[word] = len(known)
                    new.append(word)
                plan.append(at)
            counts.append(len(found))
        if new:
            ids, ends = self.encode_words(["" if w in self.special else w for w in new])
            for n, word in enumerate(new):
                if word in self.special:
                    ids, ends = np.insert(ids, ends[n], self.special[word]), ends + (np.arange(len(new)) >= n)
            self.word_ids = np.concatenate([self.word_ids, ids])
            self.word_ends = np.concatenate([self.word_ends, self.word_ends[-1] + ends])
        at = np.array(plan, np.int64)
        lengths = self.word_ends[at + 1] - self.word_ends[at]
        after = np.concatenate([[0], np.cumsum(lengths)])
        self.chunk_ids = np.concatenate([self.chunk_ids, self.word_ids[spans(self.word_ends[at], lengths)]])
        self.chunk_ends = np.concatenate([self.chunk_ends, self.chunk_ends[-1] + after[np.cumsum(counts)]])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of each text in it.

        White space separates words before anything else can join them, so each chunk between ASCII
        white space is encoded once and its ids are gathered wherever it occurs.
        """
        if len(self.chunks) > CACHE_CHUNKS:
            self._forget()
        known, before, order, counts = self.chunks, len(self.chunks), array("i"), []
        for text in texts:
            chunks = text.encode("utf-8").split() if text else ()
            counts.append(len(chunks))
            order.extend(map(known.__getitem__, chunks))
        if len(known) > before:
            self._learn(list(islice(known, before, None)))
        at = np.frombuffer(order, np.int32) if len(order) else np.empty(0, np.int32)
        starts, lengths = self.chunk_ends.take(at), np.diff(self.chunk_ends).take(at)
        after = np.concatenate([[0], np.cumsum(lengths)])
        offsets = after[np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])]
        return self.chunk_ids[spans(starts, lengths)], offsets

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a space, special tokens included; ids that the file lacks are skipped."""
        try:
            return " ".join(map(self.strings.__getitem__, ids))
        except KeyError:
            return " ".join(self.strings[i] for i in ids if i in self.strings)


@lru_cache(maxsize=2)
def load(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def encode(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """``(id_col, ids array<int>)`` for every row; a null or empty text has an empty array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for part in text_slices(batches, text_col, SLICE_BYTES):
            ids, offsets = bpe.encode(part.column(text_col).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column(id_col), lists], [id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(df: DataFrame, id_col: str, ids_col: str, path: str) -> DataFrame:
    """``(id_col, text)`` for every row of ids; null or empty ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for part in batches:
            texts = [bpe.decode([i for i in ids if i is not None]) if ids else "" for ids in part.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(texts, pa.string())], [id_col, "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """Encode, then decode what was encoded, in one pass: ``(id_col, n_tokens, ids_sha256, decoded_sha256)``.

    The digests are of the decimal ids joined by a space, and of the decoded text in UTF-8.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        number = {i: str(i) for i in bpe.strings}
        for part in text_slices(batches, text_col, SLICE_BYTES):
            ids, offsets = bpe.encode(part.column(text_col).to_pylist())
            coded, decoded = [], []
            for a, b in zip(offsets, offsets[1:]):
                own = ids[a:b].tolist()
                coded.append(hashlib.sha256(" ".join(map(number.__getitem__, own)).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(np.diff(offsets)), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
