"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

SLICE_BYTES = 4 << 20


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later jobs start from storage."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text, one row at least; rows are never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()], dtype=np.int64)
        piece = np.cumsum(sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def numbers() -> defaultdict:
    """A dictionary that numbers keys from 0 on as they are first looked up, without a step of Python for a known one."""
    return defaultdict(count().__next__)


def id_hash(column: str) -> Column:
    """CRC-32 of the id as decimal text, as the contracts' hold-out rules use it."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Narrow input dealt to all cores when it comes in fewer pieces; a large table stays as it comes."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
