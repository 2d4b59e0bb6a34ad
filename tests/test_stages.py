import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafmill.operators import classify
from sheafmill.plans import stages, views
from sheafmill.sources import documents, stored

SF = "/root/testdata/sf0.001"


def test_csv_aliases_and_ids(spark, tmp_path):
    path = tmp_path / "docs.csv"
    path.write_text('Resume_Text , resume_html,CATEGORY,extra\n"a ""quoted"",\ntext",<p>x</p>,IT,1\nplain,,HR,2\nlast,<b>,HR,3\n')
    df = documents.load_documents(spark, str(path))
    rows = df.orderBy("ID").collect()
    assert df.columns == ["ID", "Resume_str", "Resume_html", "Category", "extra"]
    assert [(r.ID, r.Resume_str, r.Resume_html) for r in rows] == [(0, 'a "quoted",\ntext', "<p>x</p>"), (1, "plain", None), (2, "last", "<b>")]
    with pytest.raises(FileNotFoundError):
        documents.load_documents(spark, str(tmp_path / "none.csv"))
    assert dict(documents.load_table(spark, str(path)).dtypes)["extra"] == "int"


def test_damaged_rows_go_to_quarantine(spark, tmp_path):
    path = tmp_path / "docs.csv"
    path.write_text('ID,Resume_str,Resume_html,Category\n1,"a, ""b""\nc",<p>,IT\n2,short\n3,x,y,HR,more\nfour,x,y,HR\n5,fine,,HR\n')
    good = documents.load_documents(spark, str(path), str(tmp_path / "bad"))
    assert [tuple(r) for r in good.orderBy("ID").collect()] == [(1, 'a, "b"\nc', "<p>", "IT"), (5, "fine", None, "HR")]
    bad = documents.damaged(spark, str(tmp_path / "bad")).collect()
    assert sorted(r.record for r in bad) == ["2,short", "3,x,y,HR,more", "four"] and all(r.file.endswith("docs.csv") for r in bad)
    assert documents.load_documents(spark, str(path)).count() == 5


def test_report_is_measured_while_writing(spark, tmp_path):
    pages = views.profiles(spark, SF)
    pages.select(F.col("doc_id").alias("id"), F.col("exp_src").alias("resume_text"), F.col("html").alias("Resume_html"), "category").write.parquet(str(tmp_path / "docs"))
    parsed, report = stages.parse_and_report(spark, str(tmp_path / "docs"), str(tmp_path / "work"))
    for name, again in stages.parsing_report(parsed).items():
        assert report[name].schema.simpleString() == again.schema.simpleString()
        assert sorted(map(str, report[name].collect())) == sorted(map(str, again.collect())), name


def test_dense_ids_over_many_pieces(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("v")).repartition(7).write.parquet(str(tmp_path / "t"))
    out = documents.with_dense_ids(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(r.ID for r in out.collect()) == list(range(1000))


def test_splits_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], "train"), (2, ["b"], "val")], "id int, t array<string>, split string")
    documents.save_splits(df, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError):
        documents.load_splits(spark, str(tmp_path / "s"))
    documents.save_splits(df.unionByName(df.withColumn("split", F.lit("test"))), str(tmp_path / "s"))
    assert documents.load_splits(spark, str(tmp_path / "s")).where("split = 'val'").first().t == ["b"]
    with pytest.raises(FileNotFoundError):
        documents.load_splits(spark, str(tmp_path / "none"))


def test_all_stages(spark, tmp_path):
    work, source = str(tmp_path / "work"), str(tmp_path / "docs.parquet")
    pages = views.profiles(spark, SF)
    text = F.concat_ws(" ", "skills_src", "exp_src", "edu_src")
    pages.select(F.col("doc_id").alias("id"), text.alias("resume_text"), F.col("html").alias("Resume_html"), "category").write.parquet(source)
    assert stages.run_predict(spark, work) is None
    parsed = stages.run("parsing", spark, source, work)
    assert parsed.count() == 150 and "Resume_html" not in parsed.columns
    report = stages.parsing_report(parsed)
    assert report["coverage"].first().total == 150 and report["classes"].count() == 5
    sizes = dict(flat_terms=200, section_terms=100, n_columns=150, latent_components=4, svd_iterations=1)
    vecs = views.vecs(spark, SF)
    table = stages.run("features", spark, None, work, sizes=sizes, embeddings=(vecs, "vec_id", ["embedding"]))
    widths = stages.load_features(spark, work)[1]
    assert list(widths) == ["flat", "section", "hybrid", "semantic", "combined"]
    assert table.first()["hybrid"].size == widths["hybrid"]
    assert stages.run_predict(spark, work) is None

    def encoder():
        return lambda texts: np.array([[float(len(t)), 1.0] for t in texts.tolist()])

    firms = views.read_table(spark, SF, "supplier").select(F.col("s_name").alias("phrase"), F.lit("ORG").alias("type"))
    stages.run("features", spark, None, work, sizes=sizes, make_predict_fn=encoder, gazetteer=firms)
    found = stages.load_features(spark, work)[1]
    assert found["semantic"] == 4 * 2 + 10
    assert stored.load_feature_set(spark, f"{work}/feature_set").semantic.with_entities
    stages.run("features", spark, None, work, sizes=sizes, embeddings=(vecs, "vec_id", ["embedding"]))
    clustering = dict(n_components=5, k_range=(2, 4), n_init=1, n_clusters=3, eps_range=(1.0,), n_iter=1)
    mined = stages.run("mining", spark, None, work, clustering=clustering, mining_options=dict(min_support=0.1))
    assert mined["clustering"].count() == 8 and mined["rules"].count() > 0 and mined["central"].count() > 0
    small = {"RandomForest": {"numTrees": 3, "maxDepth": 3}, "LinearSVC": {"maxIter": 3}}
    chosen = classify.get_classifiers(sizes=small, grids={"RandomForest": [{}], "LinearSVC": [{"C": 1.0}]})
    chosen.pop("HistGBT_sklearn")
    results, _, models = stages.run_classification(spark, work, chosen, modes=["flat", "combined"])
    assert results.count() == 4 and len(models) == 4
    again = stages.run("predict", spark, None, work)
    key = lambda r: (r["mode"], r["classifier"], round(r["macro_f1"], 9))
    assert sorted(map(key, again.collect())) == sorted(map(key, results.collect()))
    for name in ("association_rules_top", "clustering_comparison", "classification_comparison", "confusion_matrix", "comparison_macro_f1"):
        assert stored.exists(spark, f"{work}/results/{name}")
    fitted = stored.load_feature_set(spark, f"{work}/feature_set")
    fresh = fitted.transform(parsed.join(vecs.select(F.col("vec_id").alias("ID"), F.col("embedding").cast("array<double>")), "ID"), ["ID"])
    assert fresh.count() == 150
    with pytest.raises(ValueError):
        stages.run("nothing", spark, None, work)
