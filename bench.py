"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sheafmill.plans.catalog import QUERIES  # noqa: E402
from sheafmill.session import local_session  # noqa: E402

HEADLINE = [
    "txt_8_section_columns",
    "txt_13_lemmas",
    "txt_20_section_attributes",
    "txt_25_entity_counts",
    "spl_1_split",
    "spl_2_folds",
    "min_1_top_items",
    "min_3_frequent_itemsets",
    "min_5_rule_measures",
    "coo_1_pairs",
    "coo_4_degree_centrality",
    "fea_2_vocabulary",
    "fea_3_tfidf_weights",
    "fea_6_handcrafted",
    "fea_7_latent_branch",
    "fea_12_chi2_scores",
    "res_1_smote_counts",
    "cls_1_random_forest",
    "cls_3_linear_svm",
    "clu_2_kmeans_sweep",
    "clu_4_dbscan",
    "eva_1_metrics_by_group",
    "eva_4_silhouette",
    "eva_5_6_agreement_by_group",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    QUERIES["eva_5_6_agreement_by_group"](spark, sf_dir).collect()  # start the engine outside the timing
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
