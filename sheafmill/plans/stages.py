"""The stages of a full run. Each reads and writes tables below one work folder.

    run("all", spark, "/data/documents.csv", "/data/work")
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.entities import with_entity_counts
from ..functions.fixed_values import DEGREE_CODES
from ..functions.html import coverage_measures, section_coverage, with_sections
from ..functions.text import degree_histogram, token_measures, token_statistics, with_section_attributes
from ..operators import classify, cluster, embed, features, graph, labels, metrics, mining, splits
from ..session import cut_lineage
from ..sources import documents, stored

log = logging.getLogger(__name__)

STAGES = ("parsing", "features", "mining", "classification", "predict", "all")
ID, TEXT, HTML, CLASS = "ID", "Resume_str", "Resume_html", "Category"


def run_parsing(
    spark: SparkSession, source: str, work: str, test_size: float = 0.15, val_size: float = 0.15, seed: int = 42, lemmas: DataFrame | None = None
) -> DataFrame:
    """Documents to section texts, tokens, attributes and a split; stored by split.

    The source is read twice: once for ids and classes, from which the split thresholds are found,
    and once for the texts. The page source is dropped after the walk. Damaged rows of a CSV file go to ``quarantine``.
    ``lemmas`` is a dictionary to look words up in (see ``with_section_attributes``).
    """
    return parse_and_report(spark, source, work, test_size, val_size, seed, lemmas)[0]


def parse_and_report(
    spark: SparkSession, source: str, work: str, test_size: float = 0.15, val_size: float = 0.15, seed: int = 42, lemmas: DataFrame | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The parse stage with the report of ``parsing_report``: measured while the table is written, so nothing is read for it."""
    raw = documents.load_documents(spark, source, f"{work}/quarantine")
    keys = cut_lineage(raw.select(ID, CLASS))
    parted = splits.stratified_split(raw, ID, CLASS, test_size, val_size, seed, keys)
    parsed = with_section_attributes(with_sections(parted, HTML).drop(HTML), lemmas, ID)
    levels = [F.count_if(F.col("degree_level") == level).alias(f"degree_{level}") for level in DEGREE_CODES]
    covered, counted = coverage_measures(), token_measures()
    seen = Observation("parsing")
    tokens = [c.alias(f"tokens_{n}") for n, c in enumerate(counted)]
    documents.save_splits(parsed.observe(seen, *covered, *tokens, *levels), f"{work}/parsed")
    found = seen.get
    blank = parsed.limit(0)
    coverage, statistics = section_coverage(blank).schema, token_statistics(blank).schema
    degrees = [(level, found[f"degree_{level}"]) for level in DEGREE_CODES if found[f"degree_{level}"]]
    report = {
        "classes": splits.class_distribution(keys, CLASS),
        "coverage": spark.createDataFrame([tuple(found[f.name] for f in coverage)], coverage),
        "tokens": spark.createDataFrame([tuple(found[f"tokens_{n}"] for n in range(len(counted)))], statistics),
        "degrees": spark.createDataFrame(degrees, "degree_level string, n long"),
    }
    return documents.load_splits(spark, f"{work}/parsed"), report


def parsing_report(parsed: DataFrame) -> dict[str, DataFrame]:
    """Class distribution, section coverage, token statistics and degrees of a parsed table."""
    return {
        "classes": splits.class_distribution(parsed, CLASS),
        "coverage": section_coverage(parsed),
        "tokens": token_statistics(parsed),
        "degrees": degree_histogram(parsed),
    }


def run_features(
    spark: SparkSession, work: str, embeddings: tuple[DataFrame, str, list[str]] | None = None, make_predict_fn: Callable | None = None,
    gazetteer: DataFrame | None = None, **sizes
) -> DataFrame:
    """Feature table of all modes, fitted on the training split.

    ``embeddings`` is a table with its id and vector columns, ``make_predict_fn`` an encoder for
    all documents (see ``embed.encode_documents``); without both the semantic and combined modes are left out.
    A document that the table lacks is an error: none is dropped. With a ``gazetteer`` (``phrase``, ``type``) the entity counts are
    columns nine and ten of the handcrafted numbers. Embeddings are joined or computed once and the result is stored, so that the passes of the
    fit read single columns of it. ``sizes`` are the size parameters of ``fit_features``.
    """
    rows = documents.load_splits(spark, f"{work}/parsed")
    encoder = labels.fit_labels(rows.where(F.col("split") == "train").select(CLASS), CLASS)
    rows = encoder.transform(rows)
    if gazetteer is not None:
        rows = with_entity_counts(rows, ID, TEXT, gazetteer)
    names = None
    if embeddings is not None:
        table, table_id, names = embeddings
        vectors = table.groupBy(F.col(table_id).alias(ID)).agg(*(F.min(F.col(c).cast("array<double>")).alias(c) for c in names))
        joined = embed.require_embeddings(rows.join(vectors, ID, "left"), names)
        rows = stored.write_stage(joined, f"{work}/parsed_with_embeddings")
    elif make_predict_fn is not None:
        encoded, names = embed.encode_documents(rows, TEXT, make_predict_fn)
        rows = stored.write_stage(encoded, f"{work}/parsed_with_embeddings")
    fitted, table = features.fit_features(rows, TEXT, "label", [ID, "label", "split"], names, with_entities=gazetteer is not None, **sizes)
    stored.save_feature_set(spark, fitted, f"{work}/feature_set")
    encoder.write().overwrite().save(f"{work}/label_encoder")
    stored.write_stage(table, f"{work}/features")
    return load_features(spark, work)[0]


def load_features(spark: SparkSession, work: str) -> tuple[DataFrame, dict[str, int]]:
    """The stored feature table as vectors, with the width of each mode."""
    widths = stored.load_feature_set(spark, f"{work}/feature_set").widths
    return stored.read_features(spark, f"{work}/features", list(widths)), widths


def run_mining(
    spark: SparkSession, work: str, top_n: int = 200, min_support: float = 0.05, min_cooccurrence: int = 5,
    clustering: dict | None = None, **sizes,
) -> dict[str, DataFrame]:
    """Rules, co-occurrence graph and clustering over the parsed table; all results are stored."""
    parsed = documents.load_splits(spark, f"{work}/parsed")
    items = cut_lineage(parsed.select("skills_tokens"))
    out = {}
    rules = mining.association_rules(mining.frequent_itemsets(mining.transactions(items, "skills_tokens", top_n, keep=[]), min_support))
    mining.save_rules(rules, f"{work}/results/association_rules_top")
    out["rules"] = rules
    edges = cut_lineage(graph.graph_edges(graph.pair_counts(items, "skills_tokens", top_n), min_cooccurrence))
    out["edges"] = edges
    out["nodes"] = graph.graph_nodes(edges, items, "skills_tokens")
    out["central"] = graph.degree_centrality(edges, 20)
    if not edges.isEmpty():
        stored.save_results(graph.view_nodes(edges, 50), f"{work}/results/graph_nodes")
        stored.save_results(graph.view_edges(edges, 50), f"{work}/results/graph_edges")
    if not stored.exists(spark, f"{work}/features"):
        run_features(spark, work, **sizes)
    widths = load_features(spark, work)[1]
    train = spark.read.parquet(f"{work}/features").where(F.col("split") == "train")
    table, planes = cluster.run_all_clustering(
        train, ID, "label", {m: widths[m] for m in ("flat", "section")}, **(clustering or {})
    )
    out["clustering"] = cut_lineage(table)
    stored.save_results(out["clustering"], f"{work}/results/clustering_comparison")
    for mode, plane in planes.items():
        stored.save_results(plane, f"{work}/results/plane_{mode}", single=False)
    return out


def run_classification(spark: SparkSession, work: str, classifiers: dict[str, classify.Classifier] | None = None, modes: list[str] | None = None, use_smote: bool = True):
    """Select, fit and test all classifiers on all modes; models, scores and the best row are stored."""
    rows, widths = load_features(spark, work)
    widths = {m: w for m, w in widths.items() if modes is None or m in modes}
    results, predictions, models = classify.compare_feature_sets(
        rows, widths, classifiers or classify.get_classifiers(), ID, "label", use_smote
    )
    stored.save_models(models, f"{work}/models")
    _save_scores(work, results, predictions)
    return results, predictions, models


def _save_scores(work: str, results: DataFrame, predictions: DataFrame) -> None:
    results = cut_lineage(results)
    stored.save_results(results, f"{work}/results/classification_comparison")
    predictions.write.mode("overwrite").parquet(f"{work}/results/predictions")
    best = metrics.best_by_metric(results, "macro_f1").first()
    own = predictions.where((F.col("mode") == best["mode"]) & (F.col("classifier") == best["classifier"]))
    classes = [r.label for r in own.select("label").union(own.select("prediction")).distinct().orderBy("label").collect()]
    stored.save_results(metrics.confusion_matrix(own, "label", "prediction", classes), f"{work}/results/confusion_matrix")
    for metric in ("macro_f1", "accuracy"):
        stored.save_results(metrics.metric_table(results, metric), f"{work}/results/comparison_{metric}")


def run_predict(spark: SparkSession, work: str) -> DataFrame | None:
    """Score the test rows with stored models; without features or models a message and nothing."""
    if not stored.exists(spark, f"{work}/features"):
        log.warning("no features at %s; run the stages parsing and features first", work)
        return None
    models = stored.load_models(spark, f"{work}/models")
    if not models:
        return None
    rows, widths = load_features(spark, work)
    predictions, results = classify.score_models(rows, widths, models, ID)
    if results is None:
        return None
    _save_scores(work, results, predictions)
    return results


def run(
    stage: str, spark: SparkSession, source: str | None, work: str, sizes: dict | None = None, classifiers: dict | None = None,
    clustering: dict | None = None, mining_options: dict | None = None, embeddings=None, reuse_features: bool = False,
    reuse_models: bool = False, make_predict_fn: Callable | None = None, gazetteer: DataFrame | None = None, lemmas: DataFrame | None = None,
):
    """Run one stage or all of them. Stored features and models are used again only on request.

    ``embeddings``, ``make_predict_fn`` and ``gazetteer`` as in ``run_features``, ``lemmas`` as in ``run_parsing``.
    """
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}; one of {', '.join(STAGES)}")
    every, out = stage == "all", None
    if every or stage == "parsing":
        out = run_parsing(spark, source, work, lemmas=lemmas)
    if stage == "features" or (every and not (reuse_features and stored.exists(spark, f"{work}/features"))):
        out = run_features(spark, work, embeddings, make_predict_fn, gazetteer, **(sizes or {}))
    if every or stage == "mining":
        out = run_mining(spark, work, clustering=clustering, **(mining_options or {}), **(sizes or {}))
    if every or stage == "classification":
        if reuse_models and stored.exists(spark, f"{work}/models"):
            out = run_predict(spark, work)
        else:
            out = run_classification(spark, work, classifiers)
    if stage == "predict":
        out = run_predict(spark, work)
    return out
