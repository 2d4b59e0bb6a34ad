"""Stratified splits and folds with exact class quotas and no sort of a whole class.

Rows are ranked inside their class by ``md5(seed, id)``. Instead of sorting a class (one class can
hold much of the table), the cut points of its ranking are found first: counts per hash prefix
tell which prefix a quota ends in, and only the rows of that prefix are ranked. What is left is a
small table of thresholds per class, and every row finds its part by comparing its own hash.
The wide rows are therefore never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checked_broadcast, cut_lineage

HASH_PREFIX = 4  # hex digits: 65,536 prefixes per class


def hash_rank_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def class_counts(df: DataFrame, class_col: str) -> DataFrame:
    known = df.where(F.col(class_col).isNotNull())
    return known.groupBy(F.col(class_col).alias("cls")).agg(F.count("*").alias("n"))


EVERY = "1"  # constant key of the windows over the class table, which has one row per class


def _largest_remainder(classes: DataFrame, size: str, n_draws: Column, out: str) -> DataFrame:
    """Add the share of each class in ``n_draws`` rows by largest remainder, ties by class name."""
    every = Window.partitionBy(F.lit(EVERY))
    exact = F.col(size) / F.sum(size).over(every) * n_draws
    shared = classes.withColumn("_exact", exact).withColumn("_base", F.floor("_exact"))
    by_rest = every.orderBy(F.desc(F.col("_exact") - F.col("_base")), F.asc("cls"))
    missing = n_draws - F.sum("_base").over(every)
    extra = F.when(F.row_number().over(by_rest) <= missing, 1).otherwise(0)
    return shared.withColumn(out, (F.col("_base") + extra).cast("bigint")).drop("_exact", "_base")


def split_quotas(counts: DataFrame, test_size: float, val_size: float) -> DataFrame:
    """Rows of each class for test and validation: ``(cls, n, n_test, n_val)``.

    Sizes follow the usual two-step split: test first, then validation as the fraction
    ``val / (1 - test)`` of what remains; both sizes are rounded up.
    """
    every = Window.partitionBy(F.lit(EVERY))
    remaining = lambda c, fraction: F.sum(c).over(every) - F.ceil(F.sum(c).over(every) * F.lit(float(fraction)))
    sized = counts.withColumn("_draws", remaining("n", test_size))
    sized = _largest_remainder(sized, "n", F.col("_draws"), "_rest")
    sized = sized.withColumn("_draws", remaining("_rest", val_size / (1 - test_size)))
    sized = _largest_remainder(sized, "_rest", F.col("_draws"), "_train")
    return sized.select(
        "cls", "n", (F.col("n") - F.col("_rest")).alias("n_test"), (F.col("_rest") - F.col("_train")).alias("n_val")
    )


def fold_quotas(counts: DataFrame, n_splits: int) -> DataFrame:
    """Sizes ``(cls, n, parts[k])`` of each class in each fold.

    Classes are laid end to end in name order and dealt to the folds in turn, so that folds and
    the classes in them differ by at most one row.
    """
    before = F.sum("n").over(Window.partitionBy(F.lit(EVERY)).orderBy("cls")) - F.col("n")
    dealt = [
        (F.floor((F.col("start") + F.col("n") - 1 - i) / n_splits) - F.floor((F.col("start") - 1 - i) / n_splits)).cast(
            "bigint"
        )
        for i in range(n_splits)
    ]
    return counts.withColumn("start", before).select("cls", "n", F.array(*dealt).alias("parts"))


def rank_thresholds(df: DataFrame, id_col: str, class_col: str, quotas: DataFrame, seed: int) -> DataFrame:
    """``(cls, bounds)``: for each running total of ``quotas.parts`` the key of the row it ends at.

    A quota ending before the first row has the bound ``''``, which no key reaches.
    """
    keyed = df.select(
        F.col(class_col).alias("cls"), hash_rank_key(id_col, seed).alias("h"), F.col(id_col).cast("string").alias("rid")
    )
    keyed = keyed.withColumn("prefix", F.substring("h", 1, HASH_PREFIX))
    ends = quotas.select("cls", F.posexplode("parts").alias("part", "size")).withColumn(
        "upto", F.sum("size").over(Window.partitionBy("cls").orderBy("part"))
    )
    per_prefix = keyed.groupBy("cls", "prefix").agg(F.count("*").alias("n"))
    running = per_prefix.withColumn("hi", F.sum("n").over(Window.partitionBy("cls").orderBy("prefix")))
    running = running.select("cls", "prefix", (F.col("hi") - F.col("n")).alias("lo"), "hi")
    # one prefix for each (class, part): its rows alone are ranked
    holding = running.join(ends, "cls").where((F.col("upto") > F.col("lo")) & (F.col("upto") <= F.col("hi")))
    holding = checked_broadcast(holding)
    ranked = keyed.join(holding.select("cls", "prefix").distinct(), ["cls", "prefix"]).withColumn(
        "rn", F.row_number().over(Window.partitionBy("cls", "prefix").orderBy("h", "rid"))
    )
    cuts = holding.join(ranked, ["cls", "prefix"]).where(F.col("rn") == F.col("upto") - F.col("lo"))
    cuts = cuts.select("cls", "part", F.concat("h", F.lit(" "), "rid").alias("bound"))
    return (
        ends.join(cuts, ["cls", "part"], "left")
        .groupBy("cls")
        .agg(F.array_sort(F.collect_list(F.struct("part", F.coalesce("bound", F.lit("")).alias("bound")))).alias("b"))
        .select("cls", F.col("b.bound").alias("bounds"))
    )


def assign_parts(
    df: DataFrame, id_col: str, class_col: str, quotas: DataFrame, seed: int, out: str, keys: DataFrame | None = None
) -> DataFrame:
    """Add the index of the part each row falls into (the number of bounds below its key).

    ``keys`` is a narrow stored copy of id and class for finding the thresholds, where reading
    ``df`` again is dear.

    The thresholds have one row per class and are broadcast after a count, so the wide side stays
    where it is. Rows without a class get no part (null).
    """
    bounds = checked_broadcast(rank_thresholds(df if keys is None else keys, id_col, class_col, quotas, seed))
    key = F.concat(hash_rank_key(id_col, seed), F.lit(" "), F.col(id_col).cast("string"))
    part = F.size(F.filter("_bounds", lambda b: b < F.col("_key")))
    return (
        df.withColumn("_key", key)
        .join(bounds.select(F.col("cls").alias("_cls"), F.col("bounds").alias("_bounds")), F.col(class_col) == F.col("_cls"), "left")
        .withColumn(out, F.when(F.col("_bounds").isNotNull(), part))
        .drop("_key", "_cls", "_bounds")
    )


def stratified_split(
    df: DataFrame, id_col: str, class_col: str, test_size: float = 0.15, val_size: float = 0.15, seed: int = 42,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add ``split`` (``train``, ``val`` or ``test``), stratified by class, exact and repeatable.

    Rows without a class are training rows. ``keys`` as in ``assign_parts``.
    """
    counts = class_counts(df if keys is None else keys, class_col)
    quotas = split_quotas(cut_lineage(counts), test_size, val_size)
    quotas = quotas.select("cls", F.array("n_test", "n_val").alias("parts"))
    parted = assign_parts(df, id_col, class_col, quotas, seed, "_part", keys)
    names = F.when(F.col("_part") == 0, "test").when(F.col("_part") == 1, "val").otherwise("train")
    return parted.withColumn("split", names).drop("_part")


def stratified_folds(df: DataFrame, id_col: str, class_col: str, n_splits: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` in ``0 .. n_splits-1``, stratified by class, exact and repeatable.

    Rows without a class are spread by hash.
    """
    quotas = fold_quotas(cut_lineage(class_counts(df, class_col)), n_splits).select("cls", "parts")
    spread = F.pmod(F.crc32(hash_rank_key(id_col, seed)), F.lit(n_splits)).cast("int")
    # the last bound closes the last fold, so the parts are 0 .. n_splits-1
    return assign_parts(df, id_col, class_col, quotas, seed, "fold").withColumn("fold", F.coalesce("fold", spread))


def cv_folds(folded: DataFrame, n_splits: int = 5):
    """Yield ``(fold, train rows, validation rows)`` of a table with a ``fold`` column."""
    for fold in range(n_splits):
        yield fold, folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)


def class_distribution(df: DataFrame, class_col: str) -> DataFrame:
    """Count and percent of each class, with the smallest and largest class size."""
    counts = df.groupBy(class_col).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(EVERY))
    return counts.select(
        class_col,
        "n",
        (F.col("n") * 100.0 / F.sum("n").over(every)).alias("pct"),
        F.min("n").over(every).alias("min_class"),
        F.max("n").over(every).alias("max_class"),
    ).orderBy(F.desc("n"), class_col)


def distinct_classes(df: DataFrame, class_col: str) -> DataFrame:
    return df.agg(F.countDistinct(class_col).alias("n_classes"))
