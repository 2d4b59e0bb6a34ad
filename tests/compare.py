"""Run registered queries beside their SQL on the same tables and compare all values.

    python tests/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


#: Queries that SQL cannot state, and the test that holds their operator to brute force, known answers or a round trip.
BRUTE = {
    "fea_7_latent_branch": "test_features.py::test_svd",
    "fea_8_hybrid_stack": "test_features.py::test_all_modes",
    "fea_15_all_modes": "test_features.py::test_all_modes",
    "cls_1_random_forest": "test_classifiers.py::test_best_cell_is_the_purest_split",
    "cls_2_boosted_trees": "test_classifiers.py::test_first_round_of_stumps",
    "cls_3_linear_svm": "test_classifiers.py::test_machines_reach_the_minimum",
    "cls_8_selected_and_tested": "test_models.py::test_compare_save_and_predict",
    "cls_9_set_3_feature_sets": "test_models.py::test_compare_save_and_predict",
    "snk_5_src_7_cls_10_stored_models": "test_models.py::test_compare_save_and_predict",
    "clu_1_reduced": "test_models.py::test_reduced_shape",
    "clu_2_kmeans_sweep": "test_models.py::test_clusterings_of_two_blobs",
    "clu_3_hierarchical": "test_models.py::test_agglomerate_rows_copies_and_many_rows",
    "clu_6_comparison": "test_models.py::test_clusterings_of_two_blobs",
    "op2_bpe": "llm/test_substring_packing_bpe.py::test_bpe_query",
    "op3_packing": "llm/test_substring_packing_bpe.py::test_plan_against_all_packings",
    "op4_forest": "llm/test_vectors_simhash.py::test_forest_query",
    "op6_mixing": "llm/test_text_models.py::test_mixing_query",
    "op8_simhash": "llm/test_vectors_simhash.py::test_simhash_query",
    "op9_html": "llm/test_text_models.py::test_pages_query",
    "op10_quality": "llm/test_text_models.py::test_quality_query",
    "op11_variants": "llm/test_variants_prints_trie.py::test_variants_query",
    "op12_lz_prints": "llm/test_variants_prints_trie.py::test_prints_query_over_many_ranges",
    "pipeline": "llm/test_text_models.py::test_pipeline",
}


def held_to(name: str) -> str | None:
    """The test named for a query without SQL, if there is one of that name."""
    file, _, test = BRUTE.get(name, "").partition("::")
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), file)
    return BRUTE[name] if test and os.path.exists(path) and f"def {test}(" in open(path, encoding="utf-8").read() else None


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value + 0.0:.9g}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """(ok, message) of one query."""
    start = time.time()
    df = query(spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    columns, got = table(df.columns, rows)
    if sql is None:
        test = held_to(name)
        return bool(rows) and test is not None, f"{len(rows)} rows, no SQL, see {test}, {took:.1f}s"
    start = time.time()
    result = con.execute(sql)
    want_columns, want = table([d[0] for d in result.description], result.fetchall())
    took_sql = time.time() - start
    if columns != want_columns:
        return False, f"columns {columns} != {want_columns}"
    if got != want:
        odd = [(a, b) for a, b in zip(got, want) if a != b][:2]
        return False, f"{len(got)} vs {len(want)} rows; first differences {str(odd)[:700]}"
    return True, f"{len(got)} rows, {took:.1f}s, sql {took_sql:.1f}s"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from sheafmill.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(sf_dir)
    oracle, bad = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        try:
            ok, message = compare(spark, con, name, query, oracle.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            ok, message = False, f"{type(error).__name__}: {str(error)[:900]}"
        print("ok  " if ok else "FAIL", name, message, flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
