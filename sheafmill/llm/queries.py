"""The registered query of each operator: production parameters, whole tables, whole results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, exact_topk, forest, html_main, lz_prints, mixing, packing, prefix_trie, quality, simhash, substring, variants, warc
from .common import read
from .oracles import ORACLE_SQL  # noqa: F401


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), "doc_id", "text", word_bpe_path())


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), "doc_id", "text", word_bpe_path())


def op4_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20)


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(read(spark, sf_dir, "documents"), "doc_id", "text")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return warc.round_trip(pages, "page_id", "url", "html").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(read(spark, sf_dir, "pages"), "page_id", "url", "html")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return quality.score(docs, "doc_id", "text", model)


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(read(spark, sf_dir, "documents"), "doc_id", "text")


def op12_lz_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_prints.edited_pairs(read(spark, sf_dir, "documents"), "doc_id", "text")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring": op1_substring,
    "op2_bpe": op2_bpe,
    "op3_packing": op3_packing,
    "op4_forest": op4_forest,
    "op5_exact_topk": op5_exact_topk,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_simhash": op8_simhash,
    "op9_html": op9_html,
    "op10_quality": op10_quality,
    "op11_variants": op11_variants,
    "op12_lz_prints": op12_lz_prints,
    "op13_prefix_trie": op13_prefix_trie,
}
