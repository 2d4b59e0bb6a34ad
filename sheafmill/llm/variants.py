"""Spelling variants, found over pivotal grams.

Bigrams are ordered from rare to frequent. A word's prefix are its three rarest bigrams by place, with whatever is as
frequent as the last of them; its pivots are two disjoint bigrams of the prefix, the rarest pair, chosen by
dynamic programming. One edit spoils at most one of two disjoint bigrams, so of two words that are
one edit apart, that whose prefix ends earlier in the order has a pivot in the prefix of the other. Pivots are therefore
looked up among prefixes only, within the places that one edit can move them to, and the words of a
match are verified.

An edit falls into one region of the word, such as a pivot or what lies between the two. All before and after that region
is untouched, and so is a pivot beside it. The index key is that bigram with some letters from both ends of the word and its
length, for the places, ends and lengths that an edit of the region leaves: the sharpest limit on places, so that the words
of a rare bigram do not meet each other all.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import spread, stored, text_slices

SPOILT = 31
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
PREFIX = 3
#: Distinct words that a task counts at a time.
HELD_WORDS = 200_000
#: Words whose keys are sent together.
BATCH_WORDS = 2_000


@cache
def _pattern(least: int) -> re.Pattern:
    return re.compile(f"[a-zÀ-ÿ]{{{least},}}")


def runs(text: str, least: int = 1) -> Counter:
    """The maximal runs of ``least`` letters or more, only A-Z lower-cased, with their counts."""
    return Counter(_pattern(least).findall(text.encode().lower().decode()))


def spoilt(run: str, doc_id: int | None, every: int = SPOILT) -> str:
    """The run without one letter where ``every`` divides CRC-32 of ``<doc_id>:<run>``; a missing id is written as nothing."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(df: DataFrame, id_col: str, text_col: str, every: int = SPOILT, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of the words of all texts with ``least_letters`` letters or more that occur ``least_count`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def send() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for part in text_slices(batches, text_col):
            for doc_id, text in zip(part.column(id_col).to_pylist(), part.column(text_col).to_pylist()):
                for run, n in runs(text or "", least_letters).items():
                    word = spoilt(run, doc_id, every)
                    if len(word) >= least_letters:
                        held[word] += n
            if len(held) >= HELD_WORDS:
                yield send()
        if held:
            yield send()

    rows = spread(df.select(F.col(id_col).cast("long").alias(id_col), text_col))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Bigrams of the distinct words from rare to frequent, ties by code points.

    Words have 90 letters, so there are 8,100 bigrams at most: the size of what the driver collects and tasks are sent.
    """
    pairs = F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))
    counts = words.select(F.explode(F.array_distinct(pairs)).alias("gram")).groupBy("gram").count().collect()
    return {r["gram"]: n for n, r in enumerate(sorted(counts, key=lambda r: (r["count"], r["gram"])))}


def prefix_and_pivots(word: str, ranks: dict[str, int], size: int = PREFIX) -> tuple[list[int], tuple[int, int], int]:
    """Places of the prefix bigrams, of the two pivots among them, and the rank at which the prefix ends."""
    rank = [ranks[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(rank)[size - 1]
    places = [i for i, r in enumerate(rank) if r <= last]
    best, pair, one = None, None, None  # one: the rarest prefix bigram that ends before the place in turn
    waiting = []
    for i in places:
        while waiting and waiting[0] <= i - 2:
            j = waiting.pop(0)
            one = j if one is None or rank[j] < rank[one] else one
        if one is not None and (best is None or rank[one] + rank[i] < best):
            best, pair = rank[one] + rank[i], (one, i)
        waiting.append(i)
    return places, pair, last


def ends(length: int, least: int = LEAST_LETTERS) -> tuple[tuple[int, int], ...]:
    """How many letters from the front and the back a word of this length shows in its keys.

    Whichever letter of a word one longer or shorter is edited, the others have one of these pairs on its two sides.
    """
    if max(length - 1, least) < 7:
        return (1, 0), (0, 1)
    if length <= 9:
        return (5, 0), (3, 2), (2, 3), (0, 5)
    return ((6, 0), (3, 3), (0, 6)) if length <= 12 else ((8, 0), (4, 4), (0, 8))


@cache
def questions(n: int, first: int, second: int, length: int, least: int = LEAST_LETTERS) -> tuple[tuple[int, int, int], ...]:
    """``(front, back, pivot)`` of the keys by which a word of ``n`` letters finds those of ``length`` letters.

    Every edit lies in one of the regions that the two pivots make. A region is halved until some pair of ends lies outside
    it; the pivot is one outside too, rather one that the ends do not show already.
    """
    found, regions = set(), [(0, first), (first, first + 2), (first + 2, second), (second, second + 2), (second + 2, n)]
    while regions:
        a, b = regions.pop()
        if a == b and 0 < a < n:
            continue  # what is put in between two regions lies at the end of either
        fit = [(max(0, min(x, p + 2) - p) + max(0, p + 2 - max(n - y, p)), x, y, p) for x, y in ends(length, least) if x <= a and y <= n - b for p in (first, second) if p + 2 <= a or p >= b]
        if fit:
            found.add(min(fit)[1:])
        else:
            regions += [(a, (a + b) // 2), ((a + b) // 2, b)]
    return tuple(sorted(found))


def _key(gram: str, front: str, back: str, length: int) -> int:
    return xxhash.xxh64_intdigest(f"{gram} {front} {back} {length}") - (1 << 63)


def near_words(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """``(word, near, near_n)``, both ways, of the words ``(word, n)`` that differ in exactly one letter put in, left out or replaced."""
    ranks = gram_ranks(words)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_WORDS):
                part = batch.slice(at, BATCH_WORDS)
                keys, asks, whose, lasts = [], [], [], []
                for k, word in enumerate(part.column("word").to_pylist()):
                    places, (a, b), last = prefix_and_pivots(word, ranks)
                    n = len(word)
                    shown = {_key(g, word[:x], word[n - y :], n) for g in {word[i : i + 2] for i in places} for x, y in ends(n, least)}
                    asked = {_key(word[p : p + 2], word[:x], word[n - y :], m) for m in (n - 1, n, n + 1) if m >= least for x, y, p in questions(n, a, b, m, least)}
                    keys += shown
                    keys += asked
                    asks += [False] * len(shown) + [True] * len(asked)
                    whose += [k] * (len(shown) + len(asked))
                    lasts += [last] * (len(shown) + len(asked))
                taken = [part.column(c).take(pa.array(whose, pa.int32())) for c in ("word", "n")]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(asks, pa.bool_()), *taken, pa.array(lasts, pa.int32())], ["key", "asks", "word", "n", "last"])

    index = stored(words.mapInArrow(send, "key long, asks boolean, word string, n long, last int"), "grams")
    table = index.where("NOT asks").select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("last").alias("near_last"))
    asked = index.where("asks").drop("asks")
    close = (F.col("last") <= F.col("near_last")) & (F.col("word") != F.col("near"))
    found = asked.join(table, (asked["key"] == table["key"]) & close & (F.levenshtein("word", "near", 1) == 1))
    there = F.struct(F.col("word"), F.col("near"), F.col("near_n"))
    back = F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.select(F.explode(F.array(there, back)).alias("p")).select("p.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``, of which each form has many times the count: leaps double until nothing moves."""
    leaps = stored(forms.select("word", F.col("form").alias("root")), "leaps")
    while True:
        onward = leaps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = leaps.join(onward, "root", "left")
        leaps = stored(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "leaps")
        if leaps.where("moved").isEmpty():
            return leaps.drop("moved")
        leaps = leaps.drop("moved")


def variants(
    df: DataFrame, id_col: str, text_col: str, every: int = SPOILT, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of all texts.

    Words are the maximal runs of Latin letters (A-Z, a-z and the block from U+00C0 to U+00FF), lower-cased in A-Z, one in ``every`` of
    them with a letter lost. A word's form is its most frequent near word (ties: the first in code-point order), if that has ``ratio`` times
    the word's count at least (``least_letters`` is 4 at least); its root is where following forms ends. Null and empty texts have no words; rows with a null
    id count like others; repeated rows count as often as they stand. An empty table gives an empty result.
    """
    words = stored(word_counts(df, id_col, text_col, every, least_letters, least_count), "words")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near")))
    told = near_words(words, least_letters).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    told = words.join(told, "word", "left").withColumn("best", F.when(F.col("best.near_n") >= ratio * F.col("n"), F.col("best")))
    told = stored(told.select("word", F.col("best.near").alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near_n").alias("form_n")), "forms")
    rooted = roots(told.where("form IS NOT NULL").select("word", "form"))
    return told.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
