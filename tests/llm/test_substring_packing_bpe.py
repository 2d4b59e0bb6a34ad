"""Substring dedup, BPE and packing against brute force and the tokenizers library."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sheafmill.llm import bpe, common, packing, queries, substring

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def documents():
    t = pq.read_table(f"{SF}/documents.parquet")
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def brute_dedup(rows, window=13):
    """rows: (id, text); equal ids are one document, a null id is larger than any other."""
    key = lambda i: float("inf") if i is None else i
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            first[tuple(w[k : k + window])] = min(key(i), first.get(tuple(w[k : k + window]), float("inf")))
    out = []
    for i, w in split:
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < key(i):
                keep[k : k + window] = [False] * window
        out.append((i, len(w), len(w) - sum(keep), b" ".join(x for x, y in zip(w, keep) if y).decode()))
    return sorted(out, key=str)


def test_substring_query(spark):
    got = sorted(tuple(r) for r in queries.op1_substring(spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    want = sorted((i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in brute_dedup(documents().items()))
    assert got == want


@pytest.mark.parametrize("passes", [3_000_000, 20])
def test_substring_odd_rows(odd_documents, monkeypatch, passes):
    monkeypatch.setattr(substring, "PASS_WORDS", passes)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    found = substring.dedup(odd_documents, "doc_id", "text")
    assert found.columns == ["doc_id", "text", "id", "n_words", "n_removed"]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in found.collect()), key=str) == brute_dedup(rows)
    assert substring.dedup(odd_documents.where("false"), "doc_id", "text").count() == 0


def test_windows_with_equal_hashes_are_compared_word_by_word(monkeypatch):
    monkeypatch.setattr(substring, "_mixed", lambda x: np.zeros_like(x))  # all windows collide
    words = np.array([1, 2, 3, 4, 9, 1, 2, 3, 4, 8], np.int32)
    flags = substring.repeated_in(np.array([1, 2]), words, 3, np.array([5, 5]))
    assert flags.tolist() == [False] * 5 + [True, True, False, False, False]


def test_hot_grams_change_nothing(spark, monkeypatch):
    line = " ".join(f"w{k}" for k in range(14))
    rows = [(i, f"{line} own{i} " + " ".join(f"t{(i * 7 + k) % 40}" for k in range(20))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(substring, "HOT_LEAST", 5)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in substring.dedup(docs, "doc_id", "text").collect()), key=str)
    assert got == brute_dedup(rows)


def test_bpe_query(spark):
    got = {r.doc_id: r for r in queries.op2_bpe(spark, SF).collect()}
    docs = documents()
    assert set(got) == set(docs)
    for i, text in docs.items():
        ids = library_ids(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aAbßéÉİΣς'’sS 1²\n\x1c\x85　<|>endoftext"), st.characters(codec="utf-8")), max_size=60))
def test_bpe_any_text(text):
    model = bpe.load(PATH)
    ids, offsets = model.encode([text, None, "", "<|endoftext|>x" + text])
    assert ids[: offsets[1]].tolist() == library_ids(text)
    assert offsets[1] == offsets[2] == offsets[3]
    assert ids[offsets[3] :].tolist() == library_ids("<|endoftext|>x" + text)
    assert model.decode(ids[: offsets[1]].tolist()) == LIBRARY.decode(library_ids(text), skip_special_tokens=False)


@pytest.mark.parametrize("few", [0, 10**9])
def test_bpe_lists_and_single_merges_agree(few, monkeypatch):
    monkeypatch.setattr(bpe, "FEW", few)
    texts = [*documents().values(), "hahahahahaha lalalalala aaaaaaaaaaa"]
    ids, offsets = bpe.PairIndexBpe(PATH).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library_ids(t) for t in texts]


def test_bpe_frames(spark, odd_documents):
    coded = bpe.encode(odd_documents.select("doc_id", "text", "id"), "doc_id", "text", PATH)
    assert sorted(map(str, ((r.doc_id, r.ids) for r in coded.collect()))) == sorted(str((r.doc_id, library_ids(r.text))) for r in odd_documents.collect())
    texts = bpe.decode(coded, "doc_id", "ids", PATH)
    assert sorted(map(str, ((r.doc_id, r.text) for r in texts.collect()))) == sorted(str((r.doc_id, LIBRARY.decode(library_ids(r.text), skip_special_tokens=False))) for r in odd_documents.collect())
    assert bpe.round_trip(odd_documents.where("false"), "doc_id", "text", PATH).count() == 0


def check_packing(rows, texts, capacity=2048):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for i, text in texts:
        ids = np.array([*library_ids(text), 0], "<u4")
        for start in range(0, len(ids), capacity):
            some = ids[start : start + capacity]
            want[i, start // capacity, start, len(some), zlib.crc32(some.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(bins), sum(r.length for r in rows)


def least_bins(sizes, capacity):
    """No packing has fewer: pieces over half need a bin each, and only smaller ones fill what they leave."""
    best = -(-sum(sizes) // capacity)
    for small in range(1, capacity // 2 + 1):
        alone = [s for s in sizes if s > capacity - small]
        large = [s for s in sizes if capacity / 2 < s <= capacity - small]
        rest = sum(s for s in sizes if small <= s <= capacity / 2)
        best = max(best, len(alone) + len(large) + max(0, -(-(rest - (len(large) * capacity - sum(large))) // capacity)))
    return best


def test_packing_query(spark):
    rows = queries.op3_packing(spark, SF).collect()
    bins, _ = check_packing(rows, documents().items())
    assert bins == least_bins([r.length for r in rows], 2048)


def test_packing_odd_rows(odd_documents):
    rows = packing.pack(odd_documents, "doc_id", "text", PATH).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in odd_documents.collect()])
    assert packing.pack(odd_documents.where("false"), "doc_id", "text", PATH).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "some words " * (i + 1)) for i in range(40)], "doc_id long, text string")
    cut = packing.pieces(docs, "doc_id", "text", PATH, keep_ids=True).cache()
    placed = packing.place(cut.drop("ids"), "doc_id")
    found = packing.sequences(placed, cut, "doc_id").collect()
    assert sorted(t for r in found for t in r.ids) == sorted(t for i in range(40) for t in [*library_ids("some words " * (i + 1)), 0])


def fewest(sizes, capacity):
    """Fewest bins, by trying all ways."""
    best = [len(sizes)]

    def go(n, bins):
        if len(bins) >= best[0]:
            return
        if n == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[n] <= capacity:
                bins[k] += sizes[n]
                go(n + 1, bins)
                bins[k] -= sizes[n]
        go(n + 1, [*bins, sizes[n]])

    go(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_plan_against_all_packings(sizes):
    made = packing.plan(dict(Counter(sizes)), 20)
    used = Counter()
    for filling, times in made:
        assert sum(s * k for s, k in filling.items()) <= 20
        for s, k in filling.items():
            used[s] += k * times
    assert used == Counter(sizes)
    assert sum(t for _, t in made) == fewest(sorted(sizes, reverse=True), 20)


@pytest.mark.parametrize("counts", [{3: 1, 2: 5000}, {1000: 3, 2: 4000, 3: 1}, {1: 9000, 2: 7000, 3: 5000}, {2048: 2, 1: 1}, {}, {1: 1}])
def test_plan_of_very_short_texts(counts):
    made = packing.plan(counts)
    used = Counter()
    for filling, times in made:
        assert sum(s * k for s, k in filling.items()) <= 2048
        used.update({s: k * times for s, k in filling.items()})
    assert used == counts and sum(t for _, t in made) == -(-sum(s * n for s, n in counts.items()) // 2048)


def test_search_goes_back_over_bins():
    counts = dict(Counter([7, 7, 6, 6, 5, 5, 5, 4, 4, 4, 4, 3]))  # three bins of 20, if the right pieces meet
    assert packing.improved(counts, 20, 3, 10**5) and packing.improved(counts, 20, 2, 10**5) is None
    lengths = packing._Lengths({9: 1, 6: 1, 4: 2, 3: 1}, 20)
    found = list(packing.fillings(lengths, 10, 10, [10**5]))
    assert {9: 1} in found and {6: 1, 4: 1} in found and {3: 1, 6: 1} not in found  # 3 and 6 give way to 4 and 6


@pytest.mark.parametrize("counts, capacity", [({10: 4, 9: 4, 6: 2}, 24), ({5: 1, 14: 4, 6: 4}, 29), ({4: 2, 19: 3, 10: 2, 9: 4}, 22)])
def test_bins_are_searched_at_any_number(counts, capacity):
    many = {s: n * 3000 for s, n in counts.items()}
    made = packing.plan(many, capacity)
    used = Counter()
    for filling, times in made:
        assert sum(s * k for s, k in filling.items()) <= capacity and times > 0
        used.update({s: k * times for s, k in filling.items()})
    least = packing.least_sequences(many, capacity)
    one_by_one = min(sum(t for _, t in packing._complete_all(many, capacity, packing.SEARCH_NODES, least, ease)) for ease in packing.EASE)
    assert used == many and least <= sum(t for _, t in made) < one_by_one


def test_passages_do_not_depend_on_how_much_is_cut_at_a_time(spark):
    rng = np.random.default_rng(9)
    part = [f"p{k}" for k in rng.integers(0, 50, 30)]
    rows = [(i, " ".join([*(f"w{k}" for k in rng.integers(0, 900, 40)), *part[i % 5 :]])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = [sorted(map(tuple, substring.dedup(docs, "doc_id", "text", slice_bytes=n).select("doc_id", "text", "n_removed").collect())) for n in (6 << 20, 300)]
    assert found[0] == found[1]
    assert sum(r[2] for r in found[0]) > 0


def test_numbers_follow_first_look_ups_and_the_cache_learns_new_chunks_only(monkeypatch):
    known = common.numbers()
    assert list(map(known.__getitem__, [b"x", b"y", b"x", b"z"])) == [0, 1, 0, 2] and list(known) == [b"x", b"y", b"z"]
    model, learnt = bpe.PairIndexBpe(PATH), []
    learn = model._learn
    monkeypatch.setattr(model, "_learn", lambda fresh: (learnt.append(fresh), learn(fresh)))
    texts = [["Plain words, plain"], ["words <|endoftext|>x PLAIN d'abc \u00c9t\u00e9"], [None, "", "plain words"], ["plain"]]
    for some in texts:
        ids, offsets = model.encode(some)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library_ids(t) for t in some]
    assert [len(fresh) for fresh in learnt] == [3, 5]


def test_joined_words_match_their_places():
    texts = [b" a  bb a", None, b"", b"\t", b"ccc a\n"]
    words = substring._Words(texts)
    assert words.joined == b"a bb a ccc a" and words.doc.tolist() == [0, 0, 0, 4, 4]
    assert [words.joined[a:b] for a, b in zip(words.start, words.stop)] == [b"a", b"bb", b"a", b"ccc", b"a"]
