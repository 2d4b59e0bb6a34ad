"""A corpus pipeline of four stages: quality filter, near-duplicate removal, passage removal, packing.

Each stage takes ``(spark, docs, sf_dir)``. The first three return documents with the columns they came with; the last
returns the packed pieces. ``run`` writes every stage's result as Parquet to the shared folder and reads it
again for the next, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheafmill.llm import packing, quality, simhash, substring
from sheafmill.llm.common import read, stored
from sheafmill.llm.queries import word_bpe_path
from sheafmill.session import cut_lineage

#: Bytes of text that a task of the third stage cuts at a time; results do not depend on it.
SLICE = 3 << 20


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (fitted on the labelled training rows among ``docs``) does not reject.

    Null and empty texts have a score like any other.
    """
    model = quality.fit(docs, read(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    scored = quality.score(docs, "doc_id", "text", model, keep=docs.columns)
    return scored.where("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id, and of the smallest text hash among equal ids.

    Groups are those of the SimHash operator. Rows without an id stay only where no row of their group has one. Repeated
    rows stay once; unlike texts under one id are documents of their own.
    """
    rows = docs.withColumn("_text_hash", F.xxhash64("text"))
    found = simhash.near_duplicates(rows, "doc_id", "text", keep=["_text_hash"])
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col("_text_hash").alias("hash"))
    stays = cut_lineage(found.groupBy("component").agg(F.min(order).alias("s")).select("s.*"))
    kept = rows.join(stays, rows["doc_id"].eqNullSafe(stays["id"]) & (rows["_text_hash"] == stays["hash"]), "left_semi")
    repeated = found.groupBy("doc_id", "_text_hash").count().where("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["doc_id", "_text_hash"])
    return kept.select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words and more that also begin in one with a smaller id.

    ``n_chars`` is counted anew where it is an integer column. A document with nothing left stays, with the
    empty text; one with nothing removed keeps its text as it is.
    """
    found = substring.dedup(docs, "doc_id", "text", keep_untouched=True, slice_bytes=SLICE)
    columns = [F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return found.select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place, at most 2,048 tokens a sequence."""
    return packing.pack(docs, "doc_id", "text", word_bpe_path())


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("passages", passages), ("packing", pack)]

#: The classifier, fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
