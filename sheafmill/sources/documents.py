"""Readers for labelled document tables and their splits."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import checked_broadcast
from ..functions.fixed_values import HEADER_ALIASES

CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
SPLITS = ("train", "val", "test")
DAMAGE = "_damaged_record"


def _read(spark: SparkSession, path: str, what: str, infer: bool) -> DataFrame:
    try:
        if str(path).rstrip("/").endswith((".csv", ".csv.gz")):
            return spark.read.options(**CSV_OPTIONS, inferSchema=infer).csv(str(path))
        return spark.read.parquet(str(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{what} not found at {path}; put a CSV file or Parquet table there or give its path") from None


def canonical_columns(df: DataFrame) -> DataFrame:
    """Known header spellings renamed; other columns stay as they are."""
    names = {c: HEADER_ALIASES[c.strip().lower()] for c in df.columns if c.strip().lower() in HEADER_ALIASES}
    return df.withColumnsRenamed(names)


def with_dense_ids(df: DataFrame, out: str = "ID") -> DataFrame:
    """Add 0, 1, 2, ... in file order as the first column of a file scan.

    The rows of each piece of a file are counted (no column is read for that), and a piece starts
    at the count of all pieces before it. The rows themselves are not moved.
    """
    piece = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    marked = df.select("*", *piece, F.monotonically_increasing_id().alias("_m"))
    sizes = marked.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_m").alias("_first"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    numbered = marked.join(checked_broadcast(starts), ["_file", "_block"])
    return numbered.select((F.col("_start") + F.col("_m") - F.col("_first")).cast("bigint").alias(out), *df.columns)


def load_documents(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """Labelled documents with ``ID``, ``Resume_str``, ``Resume_html`` and ``Category``.

    CSV columns are read as text, without a pass to infer types; ``ID`` becomes a whole number and
    is made up where it is missing. With a ``quarantine`` folder, damaged rows of a CSV file (see ``damaged``) are left out
    and written there; made-up numbers count them too.
    """
    raw = _read(spark, path, "Document table", infer=False)
    named, whole = canonical_columns(raw), None
    if quarantine is not None and str(path).rstrip("/").endswith((".csv", ".csv.gz")):
        raw, whole = _with_damage(spark, path, raw), F.col(DAMAGE).isNull()
        named = canonical_columns(raw)
    if "ID" not in named.columns:
        named = canonical_columns(with_dense_ids(raw))
    if whole is not None:
        number = F.col("ID").cast("string").rlike(r"^\s*-?[0-9]+\s*$")
        broken = named.where(~whole | ~F.coalesce(number, F.lit(False)))
        broken.select(F.input_file_name().alias("file"), F.coalesce(F.col(DAMAGE), F.col("ID").cast("string")).alias("record")).write.mode("overwrite").parquet(quarantine)
        named = named.where(whole & number).drop(DAMAGE)
    return named.withColumn("ID", F.col("ID").cast("bigint"))


def _with_damage(spark: SparkSession, path: str, plain: DataFrame) -> DataFrame:
    """The rows of a CSV file with the text of those that have too few or too many values in ``DAMAGE``."""
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in plain.columns), T.StructField(DAMAGE, T.StringType())])
    return spark.read.options(**CSV_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=DAMAGE, enforceSchema=True).schema(schema).csv(str(path))


def damaged(spark: SparkSession, quarantine: str) -> DataFrame:
    """``(file, record)`` of the rows that did not fit: with too few or too many values, or, where the file has ids, with none that is a number."""
    return spark.read.parquet(quarantine)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A second table with its columns as found."""
    return _read(spark, path, "Table", infer=True)


def save_splits(df: DataFrame, path: str) -> None:
    """One folder per split; token arrays keep their type."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    """All splits as one table; filtering on ``split`` reads that folder only."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no splits at {path}; run the parsing stage first") from None
    found = {r.split for r in df.select("split").distinct().collect()}
    missing = [s for s in SPLITS if s not in found]
    if missing:
        raise FileNotFoundError(f"split {missing[0]} is missing in {path}; run the parsing stage first")
    return df
