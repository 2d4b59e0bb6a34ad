"""Spelling variants, phrase fingerprints and the prefix trie against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafmill.llm import lz_prints, prefix_trie, queries, variants

SF = "/root/testdata/sf0.001"
LONG = 1 << 64


# --- spelling variants -----------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(docs, ratio=10):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            counts[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 31 == 0 else word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        for n in (-1, 0, 1):
            near[w] += [v for v in by_length.get(len(w) + n, []) if one_edit(w, v)]
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), words[w], len(near[w]), words.get(form.get(w))) for w in words)


def test_variants_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op11_variants(spark, SF).collect())) == brute_variants(docs)


def test_variants_chains_crowds_and_odd_rows(spark, odd_documents):
    crowd = [f"wordform{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]  # all but one or two letters alike
    texts = ["abababab " * 900, "abababa " * 40, "Abababac " * 300, "abababad " * 25, "abababaf " * 2, "abababadx " * 2, "aaaaaaaa aaaaaaa " * 5, " ".join(crowd) + " ", " ".join(crowd[:40])]
    texts += ["straßen× Étésété étésété straßenx " * 3, "chained " * 1100, "chainedq " * 100, "chainedqq " * 9, "\U0001d400chainedİ", None, "", "short words only"]
    docs = [(i if i % 5 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").unionByName(odd_documents.select("doc_id", "text"))
    rows = [tuple(r) for r in df.collect()]
    got = sorted(map(tuple, variants.variants(df, "doc_id", "text").collect()))
    assert got == brute_variants(rows)
    assert any(r[2] not in (r[0], r[1]) for r in got)  # a chain of two forms


def test_variants_clashing_names_and_empty_table(spark, odd_documents):
    clash = odd_documents.withColumns({"word": F.lit("x"), "key": F.lit(1), "near": F.lit("y"), "n": F.lit(2)})
    assert clash.count() and variants.variants(clash, "doc_id", "text").columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert variants.variants(odd_documents.where("false"), "doc_id", "text").count() == 0


def test_pivots_are_disjoint_and_rarest():
    rng = np.random.default_rng(3)
    letters = list("abcde")
    words = ["".join(rng.choice(letters, rng.integers(7, 14))) for _ in range(500)]
    grams = sorted({w[i : i + 2] for w in words for i in range(len(w) - 1)})
    ranks = dict(zip(grams, rng.permutation(len(grams)).tolist()))
    for w in words:
        places, (a, b), last = variants.prefix_and_pivots(w, ranks)
        rank = [ranks[w[i : i + 2]] for i in range(len(w) - 1)]
        assert last == sorted(rank)[2] and places == [i for i, r in enumerate(rank) if r <= last]
        pairs = [(rank[i] + rank[j]) for i in places for j in places if j >= i + 2]
        assert b >= a + 2 and {a, b} <= set(places) and rank[a] + rank[b] == min(pairs)


@pytest.mark.parametrize("least", [4, 7])
def test_near_words_of_few_letters(spark, least):
    rng = np.random.default_rng(least)
    words = sorted({"".join(rng.choice(list("abc"), rng.integers(least, least + 9))) for _ in range(700)} | {"ab" * n for n in range(4, 9)} | {"a" * n for n in range(least, 15)})
    words += [w[:3] + "z" + w[3:] for w in words[::5]]
    got = {(r.word, r.near) for r in variants.near_words(spark.createDataFrame([(w, 1) for w in set(words)], "word string, n long"), least).collect()}
    assert got == {(a, b) for a in set(words) for b in set(words) if abs(len(a) - len(b)) <= 1 and a != b and one_edit(a, b)}


# --- phrase fingerprints ---------------------------------------------------------------------


def scrambled(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % LONG
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % LONG
    return x ^ (x >> 31)


def brute_print(text, span):
    phrases, base = set(), 0x9E3779B97F4A7C15
    for a in range(0, len(text), span):
        known, start, end = set(), a, min(len(text), a + span)
        for j in range(a + 1, end + 1):
            if text[start:j] not in known:
                known.add(text[start:j])
                start = j
        phrases |= known
    powers = [1]
    for _ in range(max(map(len, phrases), default=0)):
        powers.append(powers[-1] * base % LONG)
    values = [(sum(scrambled(ord(c) + 1) * powers[i] for i, c in enumerate(p)) + powers[len(p)]) % LONG for p in phrases]
    return sorted({scrambled(v) >> 32 for v in values})[:128]


def brute_likeness(a, b):
    both = sorted(set(a) | set(b))[:128]
    return len([h for h in both if h in a and h in b]) / len(both) if both else 1.0


def brute_edits(docs):
    docs = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for n, (doc_id, text) in enumerate(docs):
        after = docs[(n + 1) % len(docs)][1] or ""
        text = text or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        own, edited, following = (brute_print(t, lz_prints.SPAN) for t in (text, edit, after))
        shown = ["".join(f"{h:08x}" for h in p) for p in (own, edited)]
        yield doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest(), *shown, brute_likeness(own, edited), brute_likeness(own, following)


def test_prints_query_over_many_ranges(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(brute_edits([(r.doc_id, r.text) for r in df.collect()]))
    assert sorted(map(tuple, lz_prints.edited_pairs(df, "doc_id", "text", range_bytes=10_000).collect())) == want
    assert sorted(map(tuple, queries.op12_lz_prints(spark, SF).collect())) == want
    assert np.mean([r[5] for r in want]) > 2 * np.mean([r[6] for r in want])


def test_prints_of_odd_rows(spark, odd_documents):
    df = odd_documents.dropDuplicates(["doc_id"]).withColumns({"tie": F.lit(1), "range": F.lit(2), "ahead": F.lit("x")})
    got = sorted(map(tuple, lz_prints.edited_pairs(df, "doc_id", "text").collect()), key=str)
    assert got == sorted(brute_edits([(r.doc_id, r.text) for r in df.collect()]), key=str)
    assert lz_prints.edited_pairs(df.where("false"), "doc_id", "text").count() == 0
    one = lz_prints.edited_pairs(df.where("doc_id = 1"), "doc_id", "text").collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_prints_of_repeated_rows_and_one_hot_id(spark):
    texts = [f"text number {i} of one id " * (i % 7) for i in range(300)]
    df = spark.createDataFrame([(5, t) for t in texts] + [(5, texts[3])] * 20 + [(9, "before"), (1, "after"), (None, None)], "doc_id long, text string")
    rows = lz_prints.edited_pairs(df, "doc_id", "text", range_bytes=500).collect()
    assert Counter(r.doc_id for r in rows) == {5: 320, 9: 1, 1: 1, None: 1}
    same = [r for r in rows if r.doc_id == 5 and r.n_chars == len(texts[3])]
    assert len({r.fingerprint for r in same if r.fingerprint == lz_prints.printed(lz_prints.signature(texts[3]))}) == 1
    assert sum(r.near_next == 1.0 and r.n_chars == len(texts[3]) for r in rows) >= 20


@pytest.mark.parametrize("span", [7, 64, 1 << 20])
def test_prints_of_texts_longer_than_a_dictionary(monkeypatch, span):
    monkeypatch.setattr(lz_prints, "SPAN", span)
    lz_prints._powers.cache_clear()
    rng = np.random.default_rng(span)
    for n in (0, 1, 2, 6, 7, 8, 13, 14, 15, 63, 64, 65, 128, 129, 500):
        text = "".join(rng.choice(list("abcé\U0001d400"), n))
        rest = "".join(rng.choice(list("abx"), n // 2))
        cut = n - n // 2
        for other in (rest, rest[:3], ""):
            own, edited = lz_prints._signatures(text, cut, other, 128)
            assert own.tolist() == brute_print(text, span) and edited.tolist() == brute_print(text[:cut] + other, span)
    lz_prints._powers.cache_clear()


def test_print_of_a_very_long_text():
    text = "a" * 3_000_000 + "b" * 10 + "xyz" * 200_000
    assert lz_prints.printed(lz_prints.signature(text)) == lz_prints.printed(lz_prints.signature(text))
    assert lz_prints.likeness(lz_prints.signature(text), lz_prints.signature(text + "q")) > 0.9


# --- prefix trie -----------------------------------------------------------------------------


def brute_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, tie, (role, text)))
    turns = {c: [v[3] for v in sorted(own)] for c, own in convs.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c > 0 else -1)
        whole[c] = turns.get(base, [])[:h] + own[h:]
    members, children = {}, {}
    for c, own in whole.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    for node in sorted(members, key=len):
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums, out = {}, []
    for node in sorted(members, key=len, reverse=True):
        below = [sums[n] for n in children.get(node, [])]
        last = len(node[-1][1]) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(members[node]) - 1) * last)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(below), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rng = np.random.default_rng(5)
    rows = [(int(c), int(t), ["user", "assistant"][t % 2], f"turn {t} kind {rng.integers(2)}") for c in rng.integers(-250, 450, 120) for t in range(rng.integers(1, 8))]
    rows += [(7, None, None, None), (7, None, "user", ""), (None, 1, "user", "lost"), (8, 1, "user", "same"), (8, 1, "user", "same"), (100, 0, "", "a:b"), (9, 0, "us", "er"), (10, 0, "use", "r")]
    rows += [(c, t, "user", "copy") for c in range(500, 560) for t in range(4)]
    return rows + [(c, t, "user", f"deep {t}" if t < 90 else f"{c} {t}") for c in (1000, 1007) for t in range(100)]


@pytest.mark.parametrize("sketch", [{}, {"cells": 1, "most_bits": 10}])
def test_trie_with_wide_and_narrow_sketch(spark, sketch):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"depth": F.lit("x"), "part": F.lit(1), "length": F.lit(2.0)})
    assert sorted(map(tuple, prefix_trie.trie(df, **sketch).collect()), key=str) == brute_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], kind)).count() == 0
    lone = [c for c in range(101, 140) if zlib.crc32(str(c).encode()) % 6 >= 1]
    rows = [(c, 0, "user", "hello") for c in lone]  # their base is absent and their only turn is left out
    assert sorted(map(tuple, prefix_trie.trie(spark.createDataFrame(rows, kind)).collect())) == brute_trie(rows) and len(brute_trie(rows)) == 1


def test_ends_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    ids = [(d, 1, 2, c) for d in range(3) for c in range(d, 3000, d + 1)]
    got = {r.depth: r.ends_sha256 for r in prefix_trie.ends_hashes(spark.createDataFrame(ids, "depth long, p1 long, p2 long, conv_id long").repartition(5)).collect()}
    assert got == {d: hashlib.sha256(",".join(str(c) for c in range(d, 3000, d + 1)).encode()).hexdigest() for d in range(3)}


def test_screen_never_loses_a_shared_prefix(spark):
    prefixes = prefix_trie.rebuilt(spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    seen = Counter((r.p1, r.p2) for r in prefixes.collect() if r.depth)
    for r in prefix_trie.screened(prefixes).where("depth > 0").collect():
        assert r.shared or seen[r.p1, r.p2] == 1
