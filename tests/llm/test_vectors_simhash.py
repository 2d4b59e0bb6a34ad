"""Vector searches, SimHash and near-copy groups against brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from sheafmill.llm import exact_topk, forest, queries, simhash

SF = "/root/testdata/sf0.001"


def embeddings():
    t = pq.read_table(f"{SF}/embeddings.parquet")
    return np.array(t["vec_id"].to_pylist()), np.array(t["embedding"].to_pylist(), float)


def test_forest_query(spark):
    ids, x = embeddings()
    got: dict = {}
    for r in queries.op4_forest(spark, SF).collect():
        got.setdefault(r.query_id, []).append(r)
    asked, hits = ids[ids % 20 == 0], 0
    assert set(got) == set(asked.tolist())
    for q in asked.tolist():
        rows = sorted(got[q], key=lambda r: r["rank"])
        score = (x[ids == q][0] * x).sum(1)
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert all(abs(r.score - score[ids == r.vec_id][0]) < 1e-12 and r.vec_id != q for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        others = np.flatnonzero(ids != q)
        best = others[np.lexsort([ids[others], -score[others]])[:20]]
        hits += len({r.vec_id for r in rows} & set(ids[best].tolist()))
    assert hits >= 0.9 * 20 * len(asked)


def odd_vectors(spark):
    rows = [(i, [float(i % 7), 1.0, -0.5 * (i % 3)], "c") for i in range(60)]
    rows += [(100, None, "c"), (101, [0.0, 0.0, 0.0], "c"), (102, [1.0, None, 1.0], "c"), (103, [float("nan"), 1.0, 1.0], "c"), (104, [float("inf"), 1.0, 1.0], "c"), (None, [9.0, 9.0, 9.0], "c"), (40, [float(40 % 7), 1.0, -0.5 * (40 % 3)], "c"), (200, [2.0], "c")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, vec string")


def brute(rows, wanted, k, score):
    kept = {i: np.array((v + [0.0] * 3)[:3]) for i, v in rows}
    out = []
    for q in sorted(kept):
        if wanted(q):
            order = sorted((-score(kept[q], v), i) for i, v in kept.items() if i != q)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(order[:k], 1)]
    return out


def usable(df, zero):
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect() if r.vec_id is not None and r.embedding is not None and all(v is not None and np.isfinite(v) for v in r.embedding)]
    return [(i, v) for i, v in rows if zero or any(v)]


def test_forest_ties_copies_and_odd_rows(spark):
    df = odd_vectors(spark)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in forest.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=7, recall=1.0).collect())
    want = brute(usable(df, False), lambda q: q % 20 == 0, 7, lambda a, b: float((a * b).sum()))
    assert got == want
    assert forest.search(df.where("false"), "vec_id", "embedding", F.lit(True)).count() == 0
    few = forest.search(df.where("vec_id in (1, 20)"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=7)
    assert [(r.query_id, r.vec_id) for r in few.collect()] == [(20, 1)]


def test_forest_large_leaves_are_spread(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHELF_ROWS", 16)
    ids, x = embeddings()
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in forest.search(df, "vec_id", "embedding", F.col("vec_id") % 100 == 0, k=5, budget=10**9).collect()}
    want = set()
    for q in ids[ids % 100 == 0]:
        score = x @ x[ids == q][0]
        others = np.flatnonzero(ids != q)
        want |= {(int(q), int(ids[i])) for i in others[np.lexsort([ids[others], -score[others]])[:5]]}
    assert got == want


def test_exact_query(spark):
    ids, x = embeddings()
    whole = np.floor(256 * x).astype(np.int64)
    want = []
    for q in ids[ids % 50 == 0]:
        score = whole @ whole[ids == q][0]
        others = np.flatnonzero(ids != q)
        want += [(int(q), n, int(ids[i]), int(score[i])) for n, i in enumerate(others[np.lexsort([ids[others], -score[others]])[:5]], 1)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in queries.op5_exact_topk(spark, SF).collect())
    assert got == sorted(want)


@pytest.mark.parametrize("blocks", [(2048, 32_768), (2, 7)])
def test_exact_ties_and_odd_rows(spark, blocks):
    df = odd_vectors(spark)
    found = exact_topk.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=4, query_block=blocks[0], row_block=blocks[1])
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    rows = [(i, [float(np.floor(256 * c)) for c in v]) for i, v in usable(df, True)]
    assert got == brute(rows, lambda q: q % 20 == 0, 4, lambda a, b: int((a * b).sum()))
    assert exact_topk.search(df.where("false"), "vec_id", "embedding", F.lit(True)).count() == 0


def test_exact_large_values_fall_back():
    rows = np.array([[2.0**40, 1.0], [2.0**40, 2.0], [-(2.0**62), 0.0]])
    who, named, score = exact_topk.best(np.array([[2.0**20, 3.0]]), rows, np.array([5, 6, 7]), 3)
    assert named.tolist() == [6, 5, 7] and score.tolist() == [2**60 + 6, 2**60 + 3, -(2**63)]


def test_bounds_hold():
    rng = np.random.default_rng(2)
    q, r = rng.integers(-200, 200, (5, 19)).astype(float), rng.integers(-200, 200, (40, 19)).astype(float)
    for segments in (1, 4, 16):
        a, b = exact_topk.statistics(q, segments), exact_topk.statistics(r, segments)
        lower = ((a[:, None] - b[None]) ** 2).sum(2)
        assert (lower <= ((q[:, None] - r[None]) ** 2).sum(2) + 1e-6).all()


def plain_print(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + words]), 42) for i in range(max(1, len(w) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, linked):
    """Smallest id reachable, for (id, print)s; a null id counts only where nothing else does."""
    left, out = list(range(len(prints))), [None] * len(prints)
    while left:
        todo, seen = [left[0]], {left[0]}
        while todo:
            a = todo.pop()
            for b in left:
                if b not in seen and linked(prints[a][1], prints[b][1]):
                    seen.add(b)
                    todo.append(b)
        least = min((prints[i][0] for i in seen if prints[i][0] is not None), default=None)
        for i in seen:
            out[i] = least
        left = [i for i in left if i not in seen]
    return out


def test_simhash_query(spark):
    t = pq.read_table(f"{SF}/documents.parquet")
    prints = [(i, plain_print(x, 3)) for i, x in zip(t["doc_id"].to_pylist(), t["text"].to_pylist())]
    components = grouped(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.op8_simhash(spark, SF).collect())
    assert got == sorted((i, f"{p:016x}", c) for (i, p), c in zip(prints, components))


def test_simhash_odd_rows(odd_documents):
    rows = [(r.doc_id, plain_print(r.text, 3)) for r in odd_documents.collect()]
    want = [(i, p, c) for (i, p), c in zip(rows, grouped(rows, lambda a, b: (a ^ b).bit_count() <= 3))]
    got = [(r.doc_id, r.bits & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(odd_documents, "doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(odd_documents.where("false"), "doc_id", "text").count() == 0


@pytest.mark.parametrize("radius, segments", [(3, 2), (3, 4), (4, 2)])
def test_index_finds_every_pair(spark, radius, segments):
    rng = np.random.default_rng(radius * 10 + segments)
    base = rng.integers(0, 2**63, 12, dtype=np.int64)
    values = {int(b) ^ sum(1 << int(p) for p in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(12)}
    values = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    found = {(r.src, r.dst) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "bits long"), radius, segments).collect()}
    assert found == {(a, b) for n, a in enumerate(values) for b in values[n + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
