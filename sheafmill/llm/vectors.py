"""Rows, copies and final ranks for the two vector searches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import spread, stored


def usable(df: DataFrame, id_col: str, vec_col: str, nonzero: bool) -> DataFrame:
    """``(vec_id long, vec)`` of rows with an id and finite components only; short vectors are filled up with zeros.

    ``nonzero`` leaves out zero vectors too.
    """
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = spread(df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(F.col(id_col).isNotNull() & vec.isNotNull() & finite))
    if nonzero:
        kept = kept.where(F.exists("vec", lambda x: x != 0))
    kept = stored(kept, "vectors")
    least, most = kept.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if least != most:
        zeros = F.transform(F.sequence(F.lit(1), F.lit(most) - F.size("vec")), lambda _: F.lit(0).cast(kept.schema["vec"].dataType.elementType))
        kept = kept.withColumn("vec", F.when(F.size("vec") < most, F.concat("vec", zeros)).otherwise(F.col("vec")))
    return kept


def candidates(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with at most ``k + 1`` copies of a vector, those of the smallest ids.

    Equal vectors have equal scores and ties go to smaller ids, so no query's ``k`` best, itself left
    out, hold any other. The limit is applied in each task before anything is shuffled.
    """
    copies = F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))
    return rows.withColumn("copy", copies).where(F.col("copy") <= k + 1).drop("copy").dropDuplicates(["vec", "vec_id"])


def queries(rows: DataFrame, wanted: Column) -> tuple[DataFrame, DataFrame]:
    """Distinct query vectors ``(rep, vec)``, and the queries ``(query_id, rep)`` that have them."""
    asked = rows.where(wanted)
    reps = stored(asked.groupBy("vec").agg(F.min("vec_id").alias("rep")), "queries")
    members = asked.join(reps, "vec").select(F.col("vec_id").alias("query_id"), "rep").distinct()
    return reps, members


def ranked(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` from ``(rep, vec_id, score)``, which has the ``k + 1`` best of each rep."""
    order = [F.desc("score"), F.asc("vec_id")]
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("rep").orderBy(*order))).where(F.col("rank") <= k + 1).drop("rank")
    own = members.join(best, "rep").where(F.col("vec_id") != F.col("query_id"))
    own = own.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return own.select("query_id", "rank", "vec_id", "score")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors of a column as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(flat.flatten(), dtype=np.float64)
    return values.reshape(len(flat), -1) if len(flat) else np.empty((0, 0))
