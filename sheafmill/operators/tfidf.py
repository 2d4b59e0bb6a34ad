"""TF-IDF over word and bigram terms, fitted on training rows and applied row by row."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import ENGLISH_STOP_WORDS
from . import vectors

#: Terms that a task counts at a time, distinct ones it holds, and rows for each partition of the sums; counts do not depend on them.
SLICE_TERMS, HELD_TERMS, PART_ROWS = 1_000_000, 500_000, 4_000
WORD = r"[\p{L}\p{N}_]{2,}"


def with_terms(df: DataFrame, text_col: str, out: str, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """Add lower-cased words of two or more letters without stop words, followed by their bigrams."""
    stop = list(stop_words)
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    if stop:
        words = F.filter(words, lambda w: ~w.isin(stop))
    named = df.withColumn("_words", words)
    pairs = F.greatest(F.size("_words") - 1, F.lit(0))
    bigrams = F.zip_with(F.slice("_words", 1, pairs), F.slice("_words", 2, pairs), lambda a, b: F.concat(a, F.lit(" "), b))
    return named.withColumn(out, F.concat("_words", bigrams)).drop("_words")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(term, tf, df)`` of some million terms at a time, added up while at most ``HELD_TERMS`` are distinct."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.list_value_length(batch.column(0)).fill_null(0).to_numpy()
        cut = np.cumsum(lengths, dtype=np.int64) // SLICE_TERMS
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(lengths)]
        for a, b in zip(edges, edges[1:]):
            coded = batch.column(0).slice(a, b - a).flatten().dictionary_encode(null_encoding="encode")
            code, n = coded.indices.to_numpy(), len(coded.dictionary)
            row = np.repeat(np.arange(b - a, dtype=np.int64), lengths[a:b])
            tf, df = np.bincount(code, minlength=n), np.bincount(np.unique(row * n + code) % max(n, 1), minlength=n)
            held.append(pa.table({"term": coded.dictionary, "tf": tf, "df": df}))
            size += n
            if size > HELD_TERMS:
                held = [_added(held)]
                size = held[0].num_rows
                if size > HELD_TERMS // 2:
                    yield from held.pop().to_batches()
                    size = 0
    if held:
        yield from _added(held).to_batches()


def _added(held: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(held).group_by("term", use_threads=False).aggregate([("tf", "sum"), ("df", "sum")])
    return both.select(["term", "tf_sum", "df_sum"]).rename_columns(["term", "tf", "df"])


def term_counts(df: DataFrame, terms_col: str, n_rows: int | None = None) -> DataFrame:
    """``(term, tf, df)``: occurrences and documents of each term.

    Tasks count a bounded number of distinct terms before they hand them on, and no (document, term) pairs are
    shuffled. The sums are dealt to more partitions than usual where ``n_rows`` (counted if not given) are many, so that
    what a task holds does not grow with the rows.
    """
    n_rows = df.count() if n_rows is None else n_rows
    counted = df.select(F.col(terms_col).alias("terms")).mapInArrow(_counted, "term string, tf long, df long")
    parts = -(-n_rows // PART_ROWS)
    if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        counted = counted.repartition(parts, "term")
    return counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def vocabulary(df: DataFrame, terms_col: str, max_features: int, min_df: int = 2, n_rows: int | None = None) -> DataFrame:
    """The ``max_features`` most frequent terms found in at least ``min_df`` rows; ties by term."""
    kept = term_counts(df, terms_col, n_rows).where(F.col("df") >= min_df)
    return kept.orderBy(F.desc("tf"), "term").limit(max_features)


@dataclass
class TfidfModel:
    """Sorted terms and their inverse document frequencies."""

    terms: list[str]
    idf: list[float]
    n_docs: int

    @property
    def width(self) -> int:
        return len(self.terms)

    def transform(self, df: DataFrame, terms_col: str, out: str) -> DataFrame:
        """Add a feature row of ``(1 + ln tf) * idf`` weights, scaled to length one.

        Terms are counted inside each row against the broadcast vocabulary: no shuffle.
        """
        if not self.terms:
            return df.withColumn(out, vectors.sparse(0, F.array(), F.array()))
        counter = CountVectorizerModel.from_vocabulary(self.terms, terms_col, "_counts", minTF=1.0)
        counted = counter.transform(df).withColumn("_counts", F.unwrap_udt("_counts"))
        idf = vectors.number_list(self.idf)
        weigh = lambda v, i: (F.log(v) + 1) * F.get(idf, i)
        counted = counted.withColumn("_w", F.zip_with("_counts.values", "_counts.indices", weigh))
        # the length is repeated beside the weights: inside the lambda it would be computed per entry
        length = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda a, w: a + w * w))
        scaled = F.zip_with("_w", F.array_repeat(length, F.size("_w")), lambda w, n: w / n)
        row = vectors.sparse(self.width, F.col("_counts.indices"), scaled)
        return counted.withColumn(out, row).drop("_counts", "_w")


def fit_tfidf(
    train: DataFrame, terms_col: str, max_features: int = 8000, min_df: int = 2, n_docs: int | None = None
) -> TfidfModel:
    """Fit on training rows. Only the vocabulary, at most ``max_features`` terms, reaches the driver."""
    n_docs = train.count() if n_docs is None else n_docs
    rows = sorted((r.term, r.df) for r in vocabulary(train, terms_col, max_features, min_df, n_docs).collect())
    return TfidfModel([t for t, _ in rows], [math.log((1 + n_docs) / (1 + d)) + 1 for _, d in rows], n_docs)
