"""Feature rows as plain columns.

A feature row is a struct with the fields Spark ML stores for a vector (``type, size, indices,
values``). Kept as a struct it stays open to column expressions - scaling, slicing and stacking
are projections on one row, with no join and no Python - and it is Parquet-compatible with the
vector type, so a stored feature table reads back as vectors without conversion.
"""

from __future__ import annotations

import json

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T


def sparse(size: int, indices: Column, values: Column) -> Column:
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        indices.cast("array<int>").alias("indices"),
        values.cast("array<double>").alias("values"),
    )


def from_array(values: Column, size: int) -> Column:
    """Feature row of a full array of ``size`` numbers."""
    return sparse(size, F.sequence(F.lit(0), F.lit(size - 1)), values)


def number_list(values, kind: str = "double") -> Column:
    """A long constant array; it reaches the plan as one folded literal."""
    return F.from_json(F.lit(json.dumps([v for v in values])), f"array<{kind}>")


def open_row(df: DataFrame, col: str) -> Column:
    """The feature row of ``col`` as a struct with indices, also where it is an ML vector or a full one."""
    row = F.col(col) if df.schema[col].dataType.typeName() == "struct" else F.unwrap_udt(col)
    full = F.when(F.size(row["values"]) > 0, F.sequence(F.lit(0), F.size(row["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    return F.struct(F.when(row["type"] == 1, full).otherwise(row["indices"]).alias("indices"), row["values"].alias("values"))


def _shifted(indices: Column, offset: int) -> Column:
    return F.transform(indices, lambda i: i + F.lit(offset)) if offset else indices


def hstack(parts: list[tuple[Column, int]]) -> Column:
    """Feature rows side by side; each part is given with its width."""
    indices, values, offset = [], [], 0
    for row, width in parts:
        indices.append(_shifted(row["indices"], offset))
        values.append(row["values"])
        offset += width
    return sparse(offset, F.concat(*indices), F.concat(*values))


def entries(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Long form ``(keys..., feature, value)`` of the stored entries."""
    pairs = F.explode(F.arrays_zip(F.col(col)["indices"].alias("i"), F.col(col)["values"].alias("v")))
    return df.select(*keys, pairs.alias("e")).select(*keys, F.col("e.i").alias("feature"), F.col("e.v").alias("value"))


def non_negative(row: Column) -> Column:
    """Negative entries become zero and zero entries are dropped."""
    kept = F.filter(F.arrays_zip(row["indices"].alias("i"), row["values"].alias("v")), lambda e: e["v"] > 0)
    return F.struct(
        row["type"].alias("type"),
        row["size"].alias("size"),
        F.transform(kept, lambda e: e["i"]).alias("indices"),
        F.transform(kept, lambda e: e["v"]).alias("values"),
    )


def zero_rows(df: DataFrame, col: str) -> DataFrame:
    """Number of rows without any non-zero entry."""
    empty = ~F.exists(F.col(col)["values"], lambda v: v != 0)
    return df.agg(F.count_if(empty).alias("zero_rows"), F.count("*").alias("total"))


def as_vectors(df: DataFrame, cols: list[str]) -> DataFrame:
    """Feature rows as ML vectors.

    The fields already have the storage layout of a vector, so whole Arrow batches are handed
    through under the vector type; no row is rebuilt.
    """
    fields = [T.StructField(f.name, VectorUDT(), f.nullable) if f.name in cols else f for f in df.schema.fields]

    def relabel(batches):
        yield from batches

    return df.mapInArrow(relabel, T.StructType(fields))


def vector_schema(schema: T.StructType, cols: list[str]) -> T.StructType:
    """Read schema under which stored feature rows come back as ML vectors."""
    return T.StructType([T.StructField(f.name, VectorUDT(), True) if f.name in cols else f for f in schema.fields])
