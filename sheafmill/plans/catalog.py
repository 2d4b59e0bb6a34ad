"""The named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import MaxAbsScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window, functions as F

from ..functions import entities, handcrafted, html, text
from ..operators import (
    classify, cluster, dbscan, embed, features, graph, labels, latent, metrics, microclusters, mining, resample, scaling, selection,
    silhouette, splits, tfidf, vectors,
)
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import documents, stored
from . import stages, views

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r6(col, name=None):
    col = F.col(col) if isinstance(col, str) else col
    rounded = F.round(col, 6)
    return rounded.alias(name) if name else rounded


def rounded(df):
    """All double columns to six digits."""
    return df.select(*[r6(n, n) if t == "double" else F.col(n) for n, t in df.dtypes])


# --- text over HTML pages -------------------------------------------------------------------


@query
def txt_1_section_rows(spark, d):
    return html.section_rows(views.profiles(spark, d), "doc_id", "html").select("doc_id", "ord", "sec_id", "title")


@query
def txt_2_title_category(spark, d):
    rows = html.section_rows(views.profiles(spark, d), "doc_id", "html")
    return rows.where(F.col("title").isNotNull()).groupBy("title", "category").agg(F.count("*").alias("n"))


@query
def txt_3_id_category(spark, d):
    rows = html.section_rows(views.profiles(spark, d), "doc_id", "html")
    return rows.where("title IS NULL AND sec_id IS NOT NULL").select("doc_id", "ord", "category")


@query
def txt_4_squeeze_spaces(spark, d):
    return views.docs(spark, d).select("doc_id", text.squeeze_spaces(F.col("text")).alias("text"))


@query
def txt_5_without_title(spark, d):
    rows = html.section_rows(views.profiles(spark, d), "doc_id", "html")
    return rows.where(F.col("title").isNotNull()).select("doc_id", "category", "text")


@query
def txt_6_joined_sections(spark, d):
    parsed = html.with_sections(views.profiles(spark, d).select("doc_id", "html"), "html")
    return parsed.select("doc_id", "experience_text", "other_text")


@query
def txt_7_page_fallback(spark, d):
    pages = html.with_sections(views.read_table(spark, d, "pages").select("page_id", "html"), "html")
    return pages.select(
        "page_id",
        "skills_text",
        (F.length("other_text") > 0).alias("has_text"),
        F.col("other_text").contains("track(0)").alias("has_script"),
        F.col("other_text").contains("margin:0").alias("has_style"),
    )


@query
def txt_8_section_columns(spark, d):
    parsed = html.with_sections(views.profiles(spark, d).select("doc_id", "html"), "html")
    return parsed.select("doc_id", "skills_text", "experience_text", "education_text", "other_text")


@query
def txt_9_coverage(spark, d):
    parsed = html.with_sections(views.profiles(spark, d).select("doc_id", "html"), "html")
    return rounded(html.section_coverage(parsed))


@query
def txt_10_clean(spark, d):
    return views.docs(spark, d).select("doc_id", text.clean_text(F.col("text")).alias("clean"))


@query
def txt_11_words(spark, d):
    tokens = text.word_tokens(F.col("text"), stop_words=[])
    return views.docs(spark, d).select("doc_id", text.tokens_to_text(tokens).alias("words"))


@query
def txt_12_words_without_stops(spark, d):
    return views.docs(spark, d).select("doc_id", text.tokens_to_text(text.word_tokens(F.col("text"))).alias("words"))


@query
def txt_13_lemmas(spark, d):
    return views.docs(spark, d).select("doc_id", text.tokens_to_text(text.section_tokens(F.col("text"))).alias("words"))


@query
def txt_13_lemma_table(spark, d):
    """Dictionary lemmas: the dictionary holds the part-name words and their plural-like forms."""
    names = views.read_table(spark, d, "benchmark").select(F.explode(text.word_tokens(F.col("text"))).alias("form"))
    lemmas = names.distinct().select("form", F.expr("substring(form, 1, 3)").alias("lemma"))
    tokens = views.docs(spark, d).select("doc_id", text.word_tokens(F.col("text")).alias("words"))
    out = text.lemmatise_with_table(tokens, "doc_id", "words", lemmas)
    return out.select("doc_id", text.tokens_to_text(F.col("words")).alias("words"))


@query
def txt_14_skill_synonyms(spark, d):
    return views.profiles(spark, d).select("doc_id", F.array_join(text.skill_tokens(F.col("skills_src")), "|").alias("skills"))


@query
def txt_15_item_sets(spark, d):
    items = text.item_set(text.skill_tokens(F.col("skills_src")))
    return views.profiles(spark, d).select("doc_id", F.array_join(items, "|").alias("items"))


@query
def txt_16_section_tokens(spark, d):
    return views.profiles(spark, d).select(
        "doc_id",
        text.tokens_to_text(text.section_tokens(F.col("exp_src"))).alias("experience"),
        text.tokens_to_text(text.section_tokens(F.col("edu_src"))).alias("education"),
    )


@query
def txt_17_years(spark, d):
    return views.profiles(spark, d).select("doc_id", text.years_experience(F.col("exp_src")).alias("years"))


@query
def txt_18_degree(spark, d):
    return views.profiles(spark, d).select("doc_id", text.degree_level(F.col("edu_src")).alias("degree"))


@query
def txt_18_degree_in_documents(spark, d):
    return views.docs(spark, d).select("doc_id", text.degree_level(F.col("text")).alias("degree"))


@query
def txt_19_item_count(spark, d):
    tokens = views.section_table(spark, d)
    return tokens.select("doc_id", "num_skills")


@query
def txt_20_section_attributes(spark, d):
    return views.section_table(spark, d).select(
        "doc_id",
        F.array_join("skills_tokens", "|").alias("skills"),
        F.array_join("experience_tokens", "|").alias("experience"),
        F.array_join("education_tokens", "|").alias("education"),
        "years_experience",
        "degree_level",
        "num_skills",
    )


@query
def txt_21_token_statistics(spark, d):
    return rounded(text.token_statistics(views.section_table(spark, d)))


@query
def txt_21_degree_histogram(spark, d):
    return text.degree_histogram(views.section_table(spark, d))


@query
def txt_22_seniority(spark, d):
    return views.profiles(spark, d).select("doc_id", text.seniority(F.col("exp_src")).alias("seniority"))


@query
def txt_23_tokens_to_text(spark, d):
    return views.baskets(spark, d).select("order_id", text.tokens_to_text(F.col("names")).alias("text"))


@query
def txt_24_encoder_input(spark, d):
    """Whole texts; messages without text become the filler word."""
    rows = views.read_table(spark, d, "conversations")
    return rows.select("conv_id", "turn", text.encoder_input(F.col("text")).alias("text"))


# --- splits, labels, sets -------------------------------------------------------------------


@query
def spl_1_split(spark, d):
    return splits.stratified_split(views.docs(spark, d).select("doc_id", "category"), "doc_id", "category")


@query
def spl_1_split_events(spark, d):
    rows = views.read_table(spark, d, "events").select("event_id", "event_type")
    return splits.stratified_split(rows, "event_id", "event_type", test_size=0.2, val_size=0.1, seed=7)


@query
def spl_2_folds(spark, d):
    return splits.stratified_folds(views.docs(spark, d).select("doc_id", "category"), "doc_id", "category")


@query
def spl_3_class_distribution(spark, d):
    return rounded(splits.class_distribution(views.docs(spark, d), "category"))


@query
def spl_4_distinct_classes(spark, d):
    return splits.distinct_classes(views.docs(spark, d), "category")


@query
def set_1_union_of_splits(spark, d):
    parted = splits.stratified_split(views.docs(spark, d).select("doc_id", "category"), "doc_id", "category")
    parts = [parted.where(F.col("split") == s) for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("doc_id", "category")


@query
def set_2_train_and_val(spark, d):
    parted = splits.stratified_split(views.docs(spark, d).select("doc_id", "category"), "doc_id", "category")
    return parted.where(F.col("split").isin("train", "val")).groupBy("category").agg(F.count("*").alias("n"))


@query
def set_4_item_intersection(spark, d):
    rows = mining.transactions(views.baskets(spark, d), "names", top_n=10, keep=["order_id"])
    return rows.select("order_id", F.array_join("items", "|").alias("items"))


@query
def lbl_1_encoded(spark, d):
    rows = views.docs(spark, d).select("doc_id", "category")
    model = labels.fit_labels(rows, "category")
    return labels.decode_labels(model.transform(rows), model, "label", "decoded")


@query
def res_2_class_weights(spark, d):
    return rounded(labels.with_balanced_weights(views.judged(spark, d), "label").select("doc_id", "label", "weight"))


# --- item sets, rules, graph ----------------------------------------------------------------


@query
def min_1_top_items(spark, d):
    return mining.top_items(views.baskets(spark, d), "names", 30)


@query
def min_2_transactions(spark, d):
    rows = mining.transactions(views.baskets(spark, d), "names", top_n=40, keep=["order_id"])
    return rows.select("order_id", F.array_join("items", "|").alias("items"))


@query
def min_2_one_hot(spark, d):
    baskets = views.baskets(spark, d)
    items = [r.item for r in mining.top_items(baskets, "words", 5).collect()]
    wide = mining.one_hot(mining.transactions(baskets, "words", 5, keep=["order_id"]), "order_id", items)
    return wide.select("order_id", *[F.col(c).alias(f"item_{i}") for i, c in enumerate(items)])


@query
def min_3_frequent_itemsets(spark, d):
    sets = mining.frequent_itemsets(mining.transactions(views.baskets(spark, d), "words", 200), 0.05)
    return sets.select(F.array_join("items", "|").alias("items"), "freq", r6("support", "support"))


def _word_rules(spark, d):
    sets = mining.frequent_itemsets(mining.transactions(views.baskets(spark, d), "words", 200), 0.05)
    return mining.association_rules(sets, 1.0)


@query
def min_4_rules(spark, d):
    return _word_rules(spark, d).select(
        F.array_join("antecedents", "|").alias("antecedents"),
        F.array_join("consequents", "|").alias("consequents"),
        r6("lift", "lift"),
    )


@query
def min_5_rule_measures(spark, d):
    rules = _word_rules(spark, d)
    sides = [F.array_join(c, "|").alias(c) for c in ("antecedents", "consequents")]
    return rules.select(*sides, *[r6(m, m) for m in mining.RULE_MEASURES])


@query
def min_6_sorted_rules(spark, d):
    rules = mining.sorted_rules(_word_rules(spark, d))
    return rules.select(
        F.array_join("antecedents", "|").alias("antecedents"), F.array_join("consequents", "|").alias("consequents"), r6("lift", "lift"), r6("confidence", "confidence"),
    )


@query
def min_7_rules_by_category(spark, d):
    rules = mining.rules_by_category(views.baskets(spark, d), "words", "category", 5, 100, 0.1)
    return rules.select(
        "category",
        F.array_join("antecedents", "|").alias("antecedents"),
        F.array_join("consequents", "|").alias("consequents"),
        *[r6(m, m) for m in ("support", "confidence", "lift")],
    )


@query
def snk_4_top_rules(spark, d):
    report = mining.top_rules(_word_rules(spark, d), 50)
    return rounded(report)


def _name_edges(spark, d):
    return graph.graph_edges(graph.pair_counts(views.baskets(spark, d), "names", 200), 5)


@query
def coo_1_pairs(spark, d):
    return graph.pair_counts(views.baskets(spark, d), "names", 50)


@query
def coo_2_edges(spark, d):
    return _name_edges(spark, d)


@query
def coo_3_nodes(spark, d):
    return graph.graph_nodes(_name_edges(spark, d), views.baskets(spark, d), "names")


@query
def coo_4_degree_centrality(spark, d):
    edges = graph.graph_edges(graph.pair_counts(views.baskets(spark, d), "names", 200), 5)
    return rounded(graph.degree_centrality(edges, 20))


@query
def coo_5_view_nodes(spark, d):
    return graph.view_nodes(_name_edges(spark, d), 25)


@query
def coo_5_view_edges(spark, d):
    return rounded(graph.view_edges(_name_edges(spark, d), 25))


# --- scores ---------------------------------------------------------------------------------


@query
def eva_1_classification_metrics(spark, d):
    return rounded(metrics.classification_metrics(views.judged(spark, d), "label", "quality"))


@query
def eva_1_metrics_by_group(spark, d):
    rows = views.read_table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("grp"), F.col("l_returnflag").alias("t"), F.expr("substring(l_linestatus, 1, 1)").alias("p")
    )
    return rounded(metrics.classification_metrics(rows, "t", "p", ["grp"]))


@query
def eva_2_confusion_matrix(spark, d):
    return metrics.confusion_matrix(views.judged(spark, d), "label", "quality", [0, 1, 2, 3])


@query
def eva_3_metric_table(spark, d):
    rows = views.read_table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("classifier"), F.col("o_orderstatus").alias("mode"), "o_totalprice"
    )
    results = rows.groupBy("classifier", "mode").agg(r6(F.max("o_totalprice"), "macro_f1"))
    return metrics.metric_table(results, "macro_f1", ["F", "O", "P"])


@query
def eva_5_6_cluster_agreement(spark, d):
    return rounded(metrics.cluster_agreement(views.judged(spark, d), "quality", "toxic"))


@query
def eva_5_6_agreement_by_group(spark, d):
    rows = views.read_table(spark, d, "lineitem").select("l_linestatus", "l_returnflag", F.col("l_linenumber") % 4)
    rows = rows.toDF("grp", "u_label", "v_label")
    return rounded(metrics.cluster_agreement(rows, "u_label", "v_label", ["grp"]))


@query
def cls_11_best_row(spark, d):
    rows = views.read_table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("classifier"), F.col("o_orderstatus").alias("mode"), "o_totalprice"
    )
    return metrics.best_by_metric(rows.groupBy("classifier", "mode").agg(r6(F.max("o_totalprice"), "macro_f1")))


# --- features -------------------------------------------------------------------------------


def _split_docs(spark, d):
    """All documents with their terms and their split."""
    rows = tfidf.with_terms(views.docs(spark, d), "text", "terms")
    return splits.stratified_split(rows, "doc_id", "category")


def _train(df):
    return df.where(F.col("split") == "train")


def _flat(spark, d, max_features=8000):
    rows = _split_docs(spark, d)
    model = tfidf.fit_tfidf(_train(rows), "terms", max_features)
    return model, model.transform(rows, "terms", "flat")


def _stored_flat(spark, d):
    """The model and the stored weights of all documents, for what reads them more than once."""
    model, rows = _flat(spark, d)
    return model, cut_lineage(rows.select("doc_id", "category", "split", "flat"))


def _named_entries(df, keys, col, terms):
    """Entries under their term instead of their number."""
    names = df.sparkSession.createDataFrame(list(enumerate(terms)), "feature int, term string")
    return vectors.entries(df, keys, col).join(names, "feature").drop("feature")


@query
def fea_1_terms(spark, d):
    return tfidf.with_terms(views.docs(spark, d), "text", "terms").select(
        "doc_id", F.array_join("terms", "|").alias("terms")
    )


@query
def fea_2_vocabulary(spark, d):
    return tfidf.vocabulary(_train(_split_docs(spark, d)), "terms", 8000)


@query
def fea_3_tfidf_weights(spark, d):
    model, rows = _flat(spark, d)
    return _named_entries(rows, ["doc_id"], "flat", model.terms).select("doc_id", "term", r6("value", "weight"))


SECTIONS = ["skills", "experience", "education"]


def _split_profiles(spark, d):
    """All profiles with their sections and their split, stored: their pages are parsed once, whatever is fitted on them."""
    keys = views.profiles(spark, d).select("doc_id", "category")
    return cut_lineage(splits.stratified_split(views.section_table(spark, d), "doc_id", "category", keys=keys))


def _sections(spark, d):
    return features.with_section_terms(_split_profiles(spark, d))


@query
def fea_4_section_tfidf(spark, d):
    rows = _sections(spark, d)
    out = None
    for s in SECTIONS:
        model = tfidf.fit_tfidf(_train(rows), f"_{s}_terms", 3000)
        part = _named_entries(model.transform(rows, f"_{s}_terms", "w"), ["doc_id"], "w", model.terms)
        part = part.select("doc_id", F.lit(s).alias("section"), "term", r6("value", "weight"))
        out = part if out is None else out.unionByName(part)
    return out


def _summary(df, *cols):
    """Width, stored entries and length of feature rows."""
    stats = []
    for c in cols:
        stats += [
            F.col(c)["size"].alias(f"{c}_width"),
            F.size(F.col(c)["values"]).alias(f"{c}_entries"),
            r6(F.sqrt(F.aggregate(F.col(c)["values"], F.lit(0.0), lambda a, v: a + v * v)), f"{c}_length"),
        ]
    return df.select("doc_id", "split", *stats)


@query
def fea_5_section_stack(spark, d):
    rows = _sections(spark, d)
    model = features.fit_section(_train(rows), "full_text")
    return _summary(model.transform(rows), "section")


def _gazetteer(spark, d):
    places = views.read_table(spark, d, "nation").select(F.col("n_name").alias("phrase"), F.lit("GPE").alias("type"))
    firms = views.read_table(spark, d, "supplier").select(F.col("s_name").alias("phrase"), F.lit("ORG").alias("type"))
    return places.unionByName(firms)


@query
def txt_25_entity_counts(spark, d):
    return entities.entity_counts(views.section_table(spark, d), "doc_id", "full_text", _gazetteer(spark, d))


@query
def fea_6_handcrafted(spark, d):
    rows = entities.with_entity_counts(views.section_table(spark, d), "doc_id", "full_text", _gazetteer(spark, d))
    numbers = rows.withColumn("hc", handcrafted.handcrafted("full_text", with_entities=True))
    names = handcrafted.BASE_NAMES + handcrafted.ENTITY_NAMES
    return numbers.select("doc_id", *[F.col("hc")[i].alias(n) for i, n in enumerate(names)])


@query
def fea_7_latent_branch(spark, d):
    model, rows = _stored_flat(spark, d)
    svd = latent.fit_svd(_train(rows), "flat", model.width, 128, clamp=True)
    points = svd.transform(rows, "flat", "latent", unit_rows=True)
    return points.select(
        "doc_id", F.size("latent").alias("dims"),
        r6(F.sqrt(F.aggregate("latent", F.lit(0.0), lambda a, v: a + v * v)), "length"),
        F.lit(svd.explained_variance).alias("explained_variance"),
    )


@query
def fea_7_directions(spark, d):
    """Products of each two of the 50 directions of the vector table: 1 with itself, 0 with another."""
    rows = views.vecs(spark, d).withColumn("row", vectors.from_array(F.col("embedding"), 64))
    directions = latent.fit_svd(rows, "row", 64, 50).components
    products = directions.T @ directions
    found = [(i, j, float(products[i, j])) for i in range(50) for j in range(50)]
    return spark.createDataFrame(found, "i int, j int, product double").withColumn("product", F.round(F.col("product") + 0.0, 6) + 0.0)


@query
def fea_7_whole_rank(spark, d):
    """On as many directions as columns a row keeps its length, and all variance is explained."""
    rows = views.vecs(spark, d).withColumn("row", vectors.from_array(F.col("embedding"), 64))
    svd = latent.fit_svd(rows, "row", 64, 64)
    length = F.sqrt(F.aggregate("points", F.lit(0.0), lambda a, v: a + v * v))
    return svd.transform(rows, "row", "points").select("vec_id", r6(length, "length"), F.lit(round(svd.explained_variance, 6)).alias("explained_variance"))


@query
def fea_8_hybrid_stack(spark, d):
    rows = _split_profiles(spark, d)
    _, table = features.fit_features(rows, "full_text", "category", ["doc_id", "category", "split"])
    return _summary(table, "flat", "section", "hybrid")


def _embedded(spark, d, rows):
    """All rows, each with the vector whose number is its id modulo the vectors."""
    vecs = views.vecs(spark, d)
    keyed = rows.withColumn("_vec", F.col("doc_id") % vecs.count())
    return embed.require_embeddings(embed.with_embeddings(keyed, "_vec", vecs, "vec_id", "embedding", "emb").drop("_vec"), ["emb"])


@query
def fea_15_all_modes(spark, d):
    """All five feature sets of all profiles."""
    rows = _embedded(spark, d, _split_profiles(spark, d))
    _, table = features.fit_features(rows, "full_text", "category", ["doc_id", "category", "split"], ["emb"])
    return _summary(table, "flat", "section", "hybrid", "semantic", "combined")


@query
def fea_9_embedding_join(spark, d):
    joined = embed.with_embeddings(views.docs(spark, d).select("doc_id", "category"), "doc_id", views.vecs(spark, d), "vec_id", "embedding", "emb")
    return joined.select("doc_id", F.size("emb").alias("dims"), r6(F.aggregate("emb", F.lit(0.0), lambda a, v: a + v), "total"))


@query
def fea_10_standardised(spark, d):
    rows = views.vecs(spark, d)
    model = scaling.fit_standard(rows, "embedding")
    scaled = rows.select("vec_id", F.posexplode(model.transform(F.col("embedding").cast("array<double>"))).alias("i", "v"))
    return scaled.select("vec_id", "i", r6("v", "value"))


def _semantic(spark, d):
    """Profiles with their ten numbers and embedding, and the semantic set fitted on the training rows."""
    rows = entities.with_entity_counts(views.section_table(spark, d), "doc_id", "full_text", _gazetteer(spark, d))
    rows = cut_lineage(_embedded(spark, d, splits.stratified_split(rows, "doc_id", "category")))
    return rows, embed.fit_semantic(_train(rows), ["emb"], "full_text", with_entities=True)


@query
def fea_10_semantic_features(spark, d):
    rows, fitted = _semantic(spark, d)
    return _summary(fitted.transform(rows), "semantic")


@query
def fea_11_combined(spark, d):
    """Flat terms beside the semantic set of all profiles."""
    rows, fitted = _semantic(spark, d)
    rows = tfidf.with_terms(fitted.transform(rows), "full_text", "terms")
    model = tfidf.fit_tfidf(_train(rows), "terms", 8000)
    flat = model.transform(rows, "terms", "flat")
    both = features.combined(F.col("flat"), model.width, F.col("semantic"), fitted.width)
    return _summary(flat.withColumn("combined", both), "combined")


@query
def fea_12_chi2_scores(spark, d):
    model, rows = _stored_flat(spark, d)
    names = spark.createDataFrame(list(enumerate(model.terms)), "feature int, term string")
    scores = selection.chi2_scores(_train(rows), "flat", "category")
    return scores.join(names, "feature").select("term", r6("score", "score"))


@query
def fea_12_chi2_selected(spark, d):
    model, rows = _stored_flat(spark, d)
    kept = selection.fit_chi2(_train(rows), "flat", "category", model.width, 4000)
    chosen = rows.withColumn("flat", selection.take_columns(F.col("flat"), kept, model.width))
    named = _named_entries(chosen, ["doc_id"], "flat", [model.terms[i] for i in kept])
    return named.select("doc_id", "term", r6("value", "weight"))


@query
def fea_13_max_abs(spark, d):
    vec = views.vecs(spark, d).select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    scaled = MaxAbsScaler(inputCol="v", outputCol="s").fit(vec).transform(vec)
    return scaled.select("vec_id", F.posexplode(vector_to_array("s")).alias("i", "v")).select("vec_id", "i", r6("v", "value"))


@query
def fea_14_non_negative(spark, d):
    rows = views.vecs(spark, d).withColumn("row", vectors.non_negative(vectors.from_array(F.col("embedding"), 64)))
    return vectors.entries(rows, ["vec_id"], "row").select("vec_id", F.col("feature").alias("i"), r6("value", "value"))


@query
def fea_16_zero_rows(spark, d):
    _, rows = _flat(spark, d)
    return vectors.zero_rows(_train(rows), "flat")


# --- resampling, classifiers ----------------------------------------------------------------


def _small_flat(spark, d, terms=300):
    """Flat features of the judged documents with their four-way class."""
    rows = tfidf.with_terms(views.docs(spark, d), "text", "terms").join(views.judged(spark, d), "doc_id")
    rows = splits.stratified_split(rows.select("doc_id", "label", "terms"), "doc_id", "label")
    model = tfidf.fit_tfidf(_train(rows), "terms", terms)
    return model.width, cut_lineage(model.transform(rows, "terms", "flat").select("doc_id", "label", "split", "flat"))


@query
def res_1_smote_counts(spark, d):
    width, rows = _small_flat(spark, d)
    grown = resample.smote(_train(rows), "doc_id", "label", "flat", width)
    return grown.groupBy("label").agg(F.count("*").alias("n"), F.count_if("synthetic").alias("n_synthetic"))


@query
def res_1_smote_rows(spark, d):
    """Synthetic embeddings: classes of the vector table raised to the largest, all rows with all values."""
    rows = views.vecs(spark, d).select("vec_id", "label", vectors.from_array(F.col("embedding"), 64).alias("row"))
    grown = resample.smote(rows, "vec_id", "label", "row", 64)
    return grown.select("vec_id", "label", "synthetic", F.posexplode("row.values").alias("i", "value")).withColumn("value", r6("value"))


def _lang_task(spark, d, terms=300):
    """Language of all documents from flat features."""
    rows = _split_docs(spark, d)
    model = tfidf.fit_tfidf(_train(rows), "terms", terms)
    label = labels.fit_labels(_train(rows), "category")
    flat = label.transform(model.transform(rows, "terms", "flat"))
    return classify.Task(cut_lineage(flat.select("doc_id", "label", "split", "flat")), "flat", model.width)


def _fit_one(spark, d, name):
    task = _lang_task(spark, d, 8000)
    return classify.train_and_evaluate(task, classify.get_classifiers()[name], {}, task.part("train"), task.part("test"))[1]


@query
def cls_1_random_forest(spark, d):
    return _fit_one(spark, d, "RandomForest")


@query
def cls_2_boosted_trees(spark, d):
    return _fit_one(spark, d, "HistGBT_sklearn")


@query
def cls_3_linear_svm(spark, d):
    return _fit_one(spark, d, "LinearSVC")


def _ranked(spark, d, name):
    """Predicted classes of all orders by a classifier of default size, fitted on four fifths of them."""
    rows = cut_lineage(views.ranked_orders(spark, d))
    task = classify.Task(rows, "flat", 4, "o_orderkey")
    model = classify.train(task, classify.get_classifiers()[name], {}, task.part("train"), use_smote=False)
    predicted = classify.predict(task, name, model, task.part("train", "test"))
    return predicted.select("o_orderkey", F.col("prediction").cast("int").alias("predicted"))


@query
def cls_1_forest_known_answer(spark, d):
    return _ranked(spark, d, "RandomForest")


@query
def cls_2_boosting_known_answer(spark, d):
    return _ranked(spark, d, "HistGBT_sklearn")


@query
def cls_3_svm_known_answer(spark, d):
    """Six classes of line items, each told by two of seven columns together."""
    rows = cut_lineage(views.flagged_lines(spark, d))
    task = classify.Task(rows, "flat", 7, "line")
    model = classify.train(task, classify.get_classifiers()["LinearSVC"], {}, task.part("train"), use_smote=False)
    predicted = classify.predict(task, "LinearSVC", model, task.part("train", "test"))
    return predicted.select("line.*", F.col("prediction").cast("int").alias("predicted"))


@query
def cls_8_selected_and_tested(spark, d):
    results, _, _ = classify.run_all_classifiers(_lang_task(spark, d), classify.get_classifiers())
    return rounded(results)


# --- clusters -------------------------------------------------------------------------------


@query
def eva_4_silhouette(spark, d):
    return rounded(silhouette.silhouette(views.vecs(spark, d), "vec_id", "embedding", "label"))


@query
def clu_1_reduced(spark, d):
    rows = views.vecs(spark, d).withColumn("row", vectors.from_array(F.col("embedding"), 64))
    reduced, svd = cluster.reduce_dimensions(rows, "row", 64, "reduced", 50)
    return reduced.select("vec_id", F.size("reduced").alias("dims"), F.lit(svd.explained_variance).alias("explained_variance"))


@query
def clu_2_kmeans_sweep(spark, d):
    found = cluster.run_kmeans(views.vecs(spark, d), "vec_id", "embedding", "label")
    return rounded(cluster.results_table(spark, found).select("k", "silhouette", "nmi", "ari"))


@query
def clu_3_hierarchical(spark, d):
    found = cluster.run_hierarchical(views.vecs(spark, d), "vec_id", "embedding", "label", 24)
    return rounded(cluster.results_table(spark, [found]).select("method", "k", "silhouette", "nmi", "ari"))


@query
def clu_3_ward_known_groups(spark, d):
    """Customers by nation, far apart, and balance: as many clusters as nations, each named by its first customer."""
    place = F.array(F.col("c_nationkey") * 100.0, F.col("c_acctbal") / 10_000)
    rows = views.read_table(spark, d, "customer").select("c_custkey", "c_nationkey", place.alias("place"))
    found = microclusters.agglomerate(rows, "place", rows.select("c_nationkey").distinct().count())
    first = found.groupBy("cluster").agg(F.min("c_custkey").alias("first_of_cluster"))
    return found.join(first, "cluster").select("c_custkey", "first_of_cluster")


@query
def clu_4_dbscan(spark, d):
    return dbscan.dbscan(views.vecs(spark, d), "vec_id", "embedding", 1.2)


@query
def clu_4_dbscan_customers(spark, d):
    """Customers on the plane of nation and balance: many points, small neighbourhoods, hot columns."""
    rows = views.read_table(spark, d, "customer").select(
        "c_custkey", F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal") / 1000).alias("xy")
    )
    return dbscan.dbscan(rows, "c_custkey", "xy", 0.5)


SWEEP = (1.05, 1.1, 1.15, 1.2, 1.25)


@query
def clu_4_dbscan_sweep(spark, d):
    found = cluster.run_dbscan(views.vecs(spark, d), "vec_id", "embedding", "label", SWEEP)
    return rounded(cluster.results_table(spark, found).select("eps", "n_clusters", "n_noise", "silhouette", "nmi", "ari"))


def _segments(spark, d):
    """Customers at a place per market segment, far from the others, and a little off it by balance."""
    names = F.array(*map(F.lit, views.SEGMENTS))
    number = F.array_position(names, F.col("c_mktsegment")).cast("double")
    place = F.array(number * 100, F.pow(number, F.lit(2)) * 100, F.col("c_acctbal") / 10_000)
    return views.read_table(spark, d, "customer").select("c_custkey", "c_mktsegment", place.alias("place"))


@query
def clu_5_best_k(spark, d):
    """The number of clusters of five far groups."""
    found = cluster.run_kmeans(_segments(spark, d), "c_custkey", "place", "c_mktsegment", range(3, 8))
    return spark.createDataFrame([(cluster.best_k(found),)], "k int")


@query
def clu_6_comparison(spark, d):
    """All sweeps of all methods, at the sizes they have by default."""
    rows = views.vecs(spark, d).withColumn("row", vectors.from_array(F.col("embedding"), 64))
    table, _ = cluster.run_all_clustering(rows, "vec_id", "label", {"row": 64})
    return rounded(table)


@query
def clu_7_plane(spark, d):
    """The clusters of five far groups on the plane: each customer's first cluster mate, and whether mates are near there."""
    plane = cluster.plane(_segments(spark, d), "c_custkey", "place", "c_mktsegment", 5)
    of_cluster = Window.partitionBy("cluster")
    near = (F.max("x").over(of_cluster) - F.min("x").over(of_cluster) < 10) & (F.max("y").over(of_cluster) - F.min("y").over(of_cluster) < 10)
    return plane.select("c_custkey", F.min("c_custkey").over(of_cluster).alias("first_of_cluster"), near.alias("near"))


# --- stored tables, models, stages ----------------------------------------------------------


def _folder(spark):
    """A fresh folder beside the checkpoints, on storage that all executors reach."""
    return f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"


def _documents_csv(spark, d):
    """The documents as a CSV folder, with quotes and line ends in their texts."""
    path = f"{_folder(spark)}.csv"
    rows = views.docs(spark, d).select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("resume_text"), "category")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return path


@query
def src_1_csv_documents(spark, d):
    read = documents.load_documents(spark, _documents_csv(spark, d))
    return read.select(F.col("ID").alias("doc_id"), F.md5("Resume_str").alias("text_md5"), F.col("Category").alias("category"))


@query
def src_1_damaged_csv(spark, d):
    """Customers as CSV lines of which some lack or have too many values, or have no number: good and damaged rows told apart."""
    path = f"{_folder(spark)}.csv"
    fields = F.concat_ws(",", "c_custkey", F.concat(F.lit('"'), "c_name", F.lit('"')), "c_mktsegment")
    line = F.when(F.col("c_custkey") % 10 == 3, F.concat_ws(",", "c_custkey", "c_name")).when(F.col("c_custkey") % 10 == 5, F.concat(fields, F.lit(",extra")))
    line = line.when(F.col("c_custkey") % 10 == 7, F.concat(F.lit("x"), fields)).otherwise(fields)
    rows = views.read_table(spark, d, "customer").select(F.lit(1).alias("part"), "c_custkey", line.alias("value"))
    head = spark.createDataFrame([(0, -1, "ID,Resume_str,Category")], "part int, c_custkey long, value string")
    rows.unionByName(head).coalesce(1).sortWithinPartitions("part", "c_custkey").select("value").write.text(path)
    quarantine = _folder(spark)
    good = documents.load_documents(spark, path, quarantine)
    good = good.select(F.col("ID").alias("c_custkey"), F.col("Resume_str").alias("name"), F.col("Category").alias("segment"), F.lit(None).cast("string").alias("record"))
    bad = documents.damaged(spark, quarantine).select(F.lit(None).cast("long").alias("c_custkey"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("segment"), "record")
    return good.unionByName(bad)


@query
def src_2_canonical_columns(spark, d):
    pages = views.read_table(spark, d, "pages")
    return documents.canonical_columns(pages.select(F.col("page_id").alias(" Id "), F.col("html").alias("RESUME_HTML"), "url"))


@query
def src_3_dense_ids(spark, d):
    return documents.with_dense_ids(views.read_table(spark, d, "customer").select("c_custkey", "c_name"), "row_id")


@query
def src_4_second_table(spark, d):
    """Suppliers as CSV, read with their types."""
    path = f"{_folder(spark)}.csv"
    views.read_table(spark, d, "supplier").write.option("header", True).csv(path)
    return documents.load_table(spark, path)


@query
def snk_3_result_files(spark, d):
    """A result table as one file, and one of a row per customer as several, read back."""
    one, many = f"{_folder(spark)}.csv", f"{_folder(spark)}.csv"
    customers = views.read_table(spark, d, "customer")
    stored.save_results(customers.groupBy("c_mktsegment").agg(F.count("*").alias("n")), one)
    stored.save_results(customers.select("c_custkey", "c_mktsegment").repartition(3), many, single=False)
    counts = documents.load_table(spark, one)
    return documents.load_table(spark, many).join(counts, "c_mktsegment")


@query
def snk_1_src_5_stored_splits(spark, d):
    path = _folder(spark)
    documents.save_splits(splits.stratified_split(views.docs(spark, d).select("doc_id", "category"), "doc_id", "category"), path)
    return documents.load_splits(spark, path)


@query
def snk_2_src_6_stored_features(spark, d):
    """A feature table written, read back as vectors, and scaled by its largest values."""
    rows = views.vecs(spark, d).select("vec_id", vectors.from_array(F.col("embedding"), 64).alias("row"))
    path = _folder(spark)
    stored.write_stage(rows, path)
    back = stored.read_features(spark, path, ["row"])
    scaled = MaxAbsScaler(inputCol="row", outputCol="s").fit(back).transform(back)
    return scaled.select("vec_id", F.posexplode(vector_to_array("s")).alias("i", "v")).select("vec_id", "i", r6("v", "value"))


@query
def snk_5_src_7_cls_10_stored_models(spark, d):
    """Models stored, loaded by key and scored on the test rows."""
    task = _lang_task(spark, d)
    chosen = classify.get_classifiers()
    path = _folder(spark)
    stored.save_models({f"flat_{n}": classify.train(task, c, {}, task.part("train", "val")) for n, c in chosen.items()}, path)
    _, scores = classify.score_models(task.rows, {"flat": task.width}, stored.load_models(spark, path))
    return rounded(scores)


@query
def cls_9_set_3_feature_sets(spark, d):
    """Two feature sets of the profiles side by side, at their full sizes, with forests and linear machines: results in one table."""
    rows = _split_profiles(spark, d)
    encoder = labels.fit_labels(_train(rows), "category")
    fitted, table = features.fit_features(encoder.transform(rows), "full_text", "label", ["doc_id", "label", "split"])
    widths = {m: fitted.widths[m] for m in ("flat", "section")}
    chosen = {n: c for n, c in classify.get_classifiers().items() if n != "HistGBT_sklearn"}
    results, _, _ = classify.compare_feature_sets(cut_lineage(table), widths, chosen)
    return rounded(results)


def _parsed(spark, d, lemmas=None):
    """The profiles written as a table, the work folder, and what the parse stage made of them."""
    path = _folder(spark)
    pages = views.profiles(spark, d)
    whole = F.concat_ws(" ", "skills_src", "exp_src", "edu_src")
    stored.write_stage(pages.select(F.col("doc_id").alias("id"), whole.alias("Resume_Text"), F.col("html").alias("resume_html"), "category"), f"{path}/source")
    return path, *stages.parse_and_report(spark, f"{path}/source", path, lemmas=lemmas)


@query
def pip_1_parse_with_dictionary(spark, d):
    """The parse stage with a dictionary: words of an even length are known, by their first three letters."""
    texts = F.explode(F.array("skills_src", "exp_src", "edu_src"))
    words = views.profiles(spark, d).select(texts.alias("t")).select(F.explode(text.word_tokens(F.col("t"))).alias("form")).distinct()
    lemmas = words.where(F.length("form") % 2 == 0).select("form", F.substring("form", 1, 3).alias("lemma"))
    _, parsed, _ = _parsed(spark, d, lemmas)
    lists = {s: F.array_join(f"{s}_tokens", "|").alias(f"{s}_words") for s in ("experience", "education")}
    return parsed.select(F.col("ID").alias("doc_id"), *lists.values())


@query
def pip_1_report(spark, d):
    """What the parse stage observed while it wrote: section coverage and token statistics."""
    _, _, report = _parsed(spark, d)
    return rounded(report["coverage"].join(report["tokens"], "total"))


@query
def pip_1_report_degrees(spark, d):
    _, _, report = _parsed(spark, d)
    return report["degrees"]


@query
def pip_2_feature_stage(spark, d):
    """The feature stage at its full sizes, with entities and embeddings: the flat and section sets of all profiles."""
    path, _, _ = _parsed(spark, d)
    vecs = views.vecs(spark, d)
    n = vecs.count()
    ids = views.read_table(spark, d, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % n).alias("vec_id"))
    table = ids.join(vecs.select("vec_id", "embedding"), "vec_id").select("id", "embedding")
    made = stages.run("features", spark, None, path, embeddings=(table, "id", ["embedding"]), gazetteer=_gazetteer(spark, d))
    open_rows = {m: vectors.open_row(made, m) for m in ("flat", "section", "semantic")}
    rows = made.select(F.col("ID").alias("doc_id"), "split", *(r.alias(m) for m, r in open_rows.items()))
    lengths = [r6(F.sqrt(F.aggregate(F.col(m)["values"], F.lit(0.0), lambda a, v: a + v * v)), f"{m}_length") for m in open_rows]
    return rows.select("doc_id", "split", *(F.size(F.col(m)["values"]).alias(f"{m}_entries") for m in open_rows), *lengths)


@query
def pip_1_parse_stage(spark, d):
    """Documents written as a table, then the whole parse stage over it."""
    _, parsed, _ = _parsed(spark, d)
    return parsed.select(
        F.col("ID").alias("doc_id"), F.col("Category").alias("category"), "split", "experience_text", "education_text",
        F.array_join("skills_tokens", "|").alias("skills"), "years_experience", "degree_level",
    )
