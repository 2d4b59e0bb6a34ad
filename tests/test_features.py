import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sheafmill.functions.fixed_values import ENGLISH_STOP_WORDS
from sheafmill.operators import embed, features, labels, latent, scaling, selection, splits, tfidf, vectors
from sheafmill.plans import catalog

TEXTS = [
    "Welder on ships for nine winters, aluminium hulls and steel hulls, night shifts",
    "Baker of rye bread, oven work before dawn, rye flour and spelt flour",
    "Ship fitter, steel hulls, dry dock work on night shifts, crème brûlée crème",
    "HR clerk keeping leave records and pay slips for dock staff",
    "Welder, steel hulls and aluminium masts, dry dock work",
    "Head of HR, pay slips and leave records for bakery staff",
    "",
    "HR trainee, leave records, pay slips and dock staff rosters",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "HR" if "HR" in t else "IT", "train" if i < 6 else "test") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (8, None, "IT", "test")], "doc_id int, text string, cls string, split string")


def terms_of(text):
    words = [w for w in re.findall(r"\b\w\w+\b", (text or "").lower()) if w not in set(ENGLISH_STOP_WORDS)]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_tfidf(train, every, n):
    tf, df = Counter(), Counter()
    for t in train:
        tf.update(terms_of(t))
        df.update(set(terms_of(t)))
    vocab = sorted(sorted((w for w in tf if df[w] >= 2), key=lambda w: (-tf[w], w))[:n])
    rows = []
    for t in every:
        counts = Counter(w for w in terms_of(t) if w in set(vocab))
        w = np.array([(1 + math.log(counts[v])) * (math.log((1 + len(train)) / (1 + df[v])) + 1) if counts[v] else 0.0 for v in vocab])
        rows.append(w / np.linalg.norm(w) if w.any() else w)
    return vocab, np.array(rows)


def dense(df, id_col, col, width):
    out = {}
    for r in df.select(id_col, col).collect():
        row = np.zeros(width)
        row[r[1]["indices"]] = r[1]["values"]
        out[r[0]] = row
    return np.array([out[k] for k in sorted(out)])


@pytest.mark.parametrize("n", [8000, 7])
def test_tfidf(spark, docs, n):
    rows = tfidf.with_terms(docs, "text", "terms")
    model = tfidf.fit_tfidf(rows.where("split = 'train'"), "terms", n)
    vocab, expected = brute_tfidf(TEXTS[:6], [*TEXTS, None], n)
    assert model.terms == vocab
    got = dense(model.transform(rows, "terms", "flat"), "doc_id", "flat", model.width)
    assert np.allclose(got, expected, atol=1e-12)
    zero = vectors.zero_rows(model.transform(rows, "terms", "flat"), "flat").first()
    assert (zero.zero_rows, zero.total) == ((~expected.any(1)).sum(), 9)


def test_empty_vocabulary(spark, docs):
    rows = tfidf.with_terms(docs.where("doc_id = 0"), "text", "terms")
    model = tfidf.fit_tfidf(rows, "terms", 10)
    assert model.width == 0 and model.transform(rows, "terms", "f").first().f["values"] == []


def random_rows(spark, n=60, width=12, seed=0):
    rng = np.random.default_rng(seed)
    data = np.where(rng.random((n, width)) < 0.4, rng.random((n, width)) * 3, 0.0)
    rows = [(i, f"c{i % 3}", [int(j) for j in np.flatnonzero(x)], [float(v) for v in x[x != 0]]) for i, x in enumerate(data)]
    df = spark.createDataFrame(rows, "id int, cls string, i array<int>, v array<double>").repartition(4)
    return data, df.select("id", "cls", vectors.sparse(width, F.col("i"), F.col("v")).alias("row"))


def test_chi2(spark):
    data, df = random_rows(spark)
    onehot = np.eye(3)[np.arange(60) % 3]
    observed = onehot.T @ data
    expected = np.outer(onehot.mean(0), data.sum(0))
    scores = ((observed - expected) ** 2 / expected).sum(0)
    got = {r.feature: r.score for r in selection.chi2_scores(df, "row", "cls").collect()}
    assert all(abs(got[j] - scores[j]) < 1e-9 for j in range(12))
    kept = selection.fit_chi2(df, "row", "cls", 12, 5)
    assert kept == sorted(np.argsort(scores, kind="stable")[-5:])
    cut = df.withColumn("row", selection.take_columns(F.col("row"), kept, 12))
    assert np.allclose(dense(cut, "id", "row", 5), data[:, kept])
    assert selection.fit_chi2(df, "row", "cls", 12, 99) == list(range(12))
    assert selection.fit_chi2(df, "row", "cls", 14, 14) == list(range(14))


def test_hstack_and_non_negative(spark):
    data, df = random_rows(spark)
    both = df.withColumn("b", vectors.hstack([(F.col("row"), 12), (vectors.from_array(F.array(F.lit(-1.0), F.lit(2.0)), 2), 2), (F.col("row"), 12)]))
    got = dense(both, "id", "b", 26)
    assert np.allclose(got[:, :12], data) and np.allclose(got[:, 14:], data) and (got[:, 13] == 2).all()
    clean = both.withColumn("b", vectors.non_negative(F.col("b"))).first().b
    assert 12 not in clean["indices"] and min(clean["values"]) > 0


def test_as_vectors(spark):
    data, df = random_rows(spark, 5)
    out = {r.id: r.row for r in vectors.as_vectors(df, ["row"]).collect()}
    assert all(np.allclose(out[i].toArray(), data[i]) for i in range(5)) and isinstance(out[0], type(Vectors.sparse(1, [], [])))


@pytest.mark.parametrize("k", [1, 4])
def test_svd(spark, k):
    data, df = random_rows(spark)
    model = latent.fit_svd(df, "row", 12, k)
    u, s, vt = np.linalg.svd(data, full_matrices=False)
    assert np.allclose(model.singular_values, s[:k], rtol=1e-6)
    assert np.allclose(np.abs((model.components * vt[:k].T).sum(0)), 1.0, atol=1e-6)
    share = (data @ vt[:k].T).var(0).sum() / data.var(0).sum()
    assert abs(model.explained_variance - share) < 1e-6
    points = {r.id: r.p for r in model.transform(df, "row", "p").collect()}
    assert np.allclose([points[i] for i in range(60)], data @ model.components)
    unit = model.transform(df, "row", "p", unit_rows=True).first().p
    assert abs(np.linalg.norm(unit) - 1) < 1e-9


def test_svd_blocks_and_clamp(spark, monkeypatch):
    data, df = random_rows(spark)
    whole = latent.fit_svd(df, "row", 12, 3)
    monkeypatch.setattr(latent, "BLOCK_CELLS", 40)
    assert np.allclose(latent.fit_svd(df, "row", 12, 3).singular_values, whole.singular_values)
    assert latent.fit_svd(df, "row", 12, 128, clamp=True).size == 11
    with pytest.raises(ValueError):
        latent.fit_svd(df, "row", 12, 128)


def test_svd_reads_the_rows_once(spark, monkeypatch):
    """Up to ``GRAM_WIDTH`` columns the rows are read in one pass; by one pass a product it is the same."""
    data, df = random_rows(spark)
    passes = []
    whole = latent._summed
    monkeypatch.setattr(latent, "_summed", lambda parts: passes.append(1) or whole(parts))
    once = latent.fit_svd(df, "row", 12, 5)
    assert len(passes) == 1
    monkeypatch.setattr(latent, "BLOCK_CELLS", 40)
    blocks = latent.fit_svd(df.repartition(3), "row", 12, 5)
    monkeypatch.setattr(latent, "GRAM_WIDTH", 0)
    again = latent.fit_svd(df, "row", 12, 5)
    assert len(passes) == 2 + 6
    for other in (blocks, again):
        assert np.allclose(once.components, other.components, atol=1e-6) and np.allclose(once.singular_values, other.singular_values)
        assert abs(once.explained_variance - other.explained_variance) < 1e-9


def test_standard(spark):
    data = np.random.default_rng(1).random((30, 3))
    data[:, 1] = 4.0
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(data)], "id int, x array<double>")
    model = scaling.fit_standard(df, "x")
    got = {r.id: r.z for r in df.select("id", model.transform(F.col("x")).alias("z")).collect()}
    expected = (data - data.mean(0)) / np.where(data.std(0) > 0, data.std(0), 1)
    assert np.allclose([got[i] for i in range(30)], expected)


def section_rows(spark):
    words = {
        "IT": (["python", "machine learning", "data"], ["developer", "cloud", "year"], ["bachelor", "computer"]),
        "HR": (["recruitment", "employee", "hr"], ["manager", "hr", "year"], ["master", "business"]),
    }
    rows = []
    for i in range(24):
        c = "IT" if i % 2 else "HR"
        s, e, d = words[c]
        rows.append((i, TEXTS[i % 6], s[: 2 + i % 2], e, d, i % 9, "phd" if i % 3 else "masters", 3, c, [float(i), float(i % 5)]))
    df = spark.createDataFrame(
        rows,
        "doc_id int, text string, skills_tokens array<string>, experience_tokens array<string>, education_tokens array<string>, "
        "years_experience int, degree_level string, num_skills int, cls string, emb array<double>",
    )
    return splits.stratified_split(df, "doc_id", "cls")


def test_all_modes(spark):
    rows = section_rows(spark)
    fitted, table = features.fit_features(rows, "text", "cls", ["doc_id", "cls", "split"], ["emb"], latent_components=3)
    assert list(fitted.widths) == ["flat", "section", "hybrid", "semantic", "combined"]
    assert fitted.widths["hybrid"] == fitted.widths["flat"] + fitted.widths["section"] + 6
    assert fitted.widths["semantic"] == 10 and fitted.widths["combined"] == fitted.widths["flat"] + 10
    again = fitted.transform(rows, ["doc_id"])
    for mode, width in fitted.widths.items():
        assert table.select(F.max(F.col(mode)["size"])).first()[0] == width
        assert np.allclose(dense(table, "doc_id", mode, width), dense(again, "doc_id", mode, width))
    without, _ = features.fit_features(rows, "text", "cls", ["doc_id", "cls", "split"], latent_components=3)
    assert list(without.widths) == ["flat", "section", "hybrid"]


def test_section_terms_split_tokens_again(spark):
    rows = features.with_section_terms(section_rows(spark)).where("cls = 'IT'").first()
    assert rows["_skills_terms"][:3] == ["python", "machine", "learning"] and "machine learning" in rows["_skills_terms"]


def test_encoder(spark):
    def make():
        def predict(texts):
            return np.array([[len(t), t == "empty"] for t in texts], dtype="float64")

        return predict

    rows = section_rows(spark).withColumn("education_tokens", F.lit(None).cast("array<string>"))
    out, cols = embed.encode_documents(rows, "text", make)
    row = out.where("doc_id = 0").first()
    assert row.text_emb == [float(len(TEXTS[0])), 0.0] and row.education_emb == [5.0, 1.0]
    model = embed.fit_semantic(out.where("split = 'train'"), cols, "text")
    assert model.width == 16 and model.transform(out).count() == 24


def test_labels(spark):
    rows = section_rows(spark)
    model = labels.fit_labels(rows, "cls")
    back = labels.decode_labels(model.transform(rows), model, "label", "again")
    assert model.labels == ["HR", "IT"] and back.where("cls <> again").isEmpty()
    with pytest.raises(Exception):
        model.transform(rows.withColumn("cls", F.lit("new"))).collect()
    weights = {r.cls: r.weight for r in labels.with_balanced_weights(rows.where("doc_id < 9"), "cls").collect()}
    assert weights == {"HR": 9 / (2 * 5), "IT": 9 / (2 * 4)}


def _reads_tables(df):
    return "FileScan" in df._jdf.queryExecution().executedPlan().toString()


def test_feature_queries_parse_profiles_once(spark, tmp_path):
    customers = spark.range(1, 61).selectExpr("id AS c_custkey", "concat('S', id % 2) AS c_mktsegment", "id % 25 AS c_nationkey", "CAST(id AS DOUBLE) AS c_acctbal")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    for name in ("fea_4_section_tfidf", "fea_5_section_stack", "fea_8_hybrid_stack"):
        made = catalog.QUERIES[name](spark, str(tmp_path))
        assert made.count() > 0
        assert not _reads_tables(made), name  # no pass after the first goes back to the pages


def test_feature_queries_weigh_documents_once(spark, tmp_path):
    texts = [(n, " ".join(f"word{(n * k) % 17}" for k in range(1, 12)), "ab"[n % 2]) for n in range(40)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("fea_7_latent_branch", "fea_12_chi2_scores", "fea_12_chi2_selected"):
        made = catalog.QUERIES[name](spark, str(tmp_path))
        assert made.count() > 0
        assert not _reads_tables(made), name


def test_term_counts_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    rows = [["a", "b", "a"], None, [], ["a", None, None], ["c"], ["b", "c", "d e", "a"]] * 5
    want = {("a", 20, 15), ("b", 10, 10), ("c", 10, 10), ("d e", 5, 5), (None, 10, 5)}
    for slice_terms, held, part_rows in ((1_000_000, 500_000, 4_000), (3, 2, 1)):
        monkeypatch.setattr(tfidf, "SLICE_TERMS", slice_terms)
        monkeypatch.setattr(tfidf, "HELD_TERMS", held)
        monkeypatch.setattr(tfidf, "PART_ROWS", part_rows)
        found = tfidf.term_counts(spark.createDataFrame([(r,) for r in rows], "terms array<string>").coalesce(2), "terms")
        assert {tuple(r) for r in found.collect()} == want
        assert part_rows > 1 or found.rdd.getNumPartitions() == 30
