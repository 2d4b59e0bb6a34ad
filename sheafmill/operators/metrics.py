"""Scores of classifications and clusterings, all from one contingency table.

``pair_table`` is the only step that reads the rows; what follows works on one row per pair of
labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

METRICS = ["accuracy", "macro_f1", "balanced_accuracy", "macro_precision", "macro_recall"]


def pair_table(df: DataFrame, left: str, right: str, by: list[str] | None = None) -> DataFrame:
    """``(by..., u, v, n)``: rows for each combination of two label columns."""
    by = by or []
    return df.groupBy(*by, F.col(left).alias("u"), F.col(right).alias("v")).agg(F.count("*").alias("n"))


def classification_metrics(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy, macro F1, balanced accuracy, macro precision and recall, for each ``by`` group.

    Macro means run over the classes in truth or prediction, balanced accuracy over those in the
    truth; a division by zero counts as 0.
    """
    by = by or []
    pairs = pair_table(df, truth, prediction, by)
    sides = pairs.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("u").alias("c"), F.col("n").alias("t"), F.lit(0).cast("bigint").alias("p")),
                F.struct(F.col("v").alias("c"), F.lit(0).cast("bigint").alias("t"), F.col("n").alias("p")),
            )
        ).alias("s"),
        F.when(F.col("u") == F.col("v"), F.col("n")).otherwise(0).alias("hit"),
    )
    per_class = sides.groupBy(*by, F.col("s.c").alias("c")).agg(
        F.sum("s.t").alias("t"),
        F.sum("s.p").alias("p"),
        F.sum(F.when(F.col("s.t") > 0, F.col("hit")).otherwise(0)).alias("tp"),
    )
    rate = lambda num, den: F.coalesce(num / F.nullif(den, F.lit(0)), F.lit(0.0))
    scored = per_class.withColumns(
        {
            "precision": rate(F.col("tp"), F.col("p")),
            "recall": rate(F.col("tp"), F.col("t")),
            "f1": rate(2 * F.col("tp"), F.col("t") + F.col("p")),
        }
    )
    return scored.groupBy(*by).agg(
        (F.sum("tp") / F.sum("t")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.avg(F.when(F.col("t") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
    )


def confusion_matrix(df: DataFrame, truth: str, prediction: str, labels: list) -> DataFrame:
    """One row per true label, one column ``pred_<label>`` per predicted label; absent pairs are 0."""
    wide = df.groupBy(F.col(truth).alias("truth")).agg(
        *[F.count_if(F.col(prediction) == x).alias(f"pred_{x}") for x in labels]
    )
    rows = df.sparkSession.createDataFrame([(x,) for x in labels], "truth " + df.schema[truth].dataType.simpleString())
    return rows.join(wide, "truth", "left").na.fill(0)


def metric_table(results: DataFrame, metric: str, modes: list[str] | None = None) -> DataFrame:
    """Classifier by mode table of one metric."""
    grouped = results.groupBy("classifier")
    return (grouped.pivot("mode", modes) if modes else grouped.pivot("mode")).agg(F.first(metric))


def best_by_metric(results: DataFrame, metric: str = "macro_f1") -> DataFrame:
    return results.orderBy(F.desc(metric), "mode", "classifier").limit(1)


def cluster_agreement(df: DataFrame, truth: str, cluster: str, by: list[str] | None = None) -> DataFrame:
    """``nmi`` and ``ari`` between a truth and a cluster column, for each ``by`` group.

    NMI uses the arithmetic mean of the entropies. Two labelings with one class each agree fully.
    """
    by = by or []
    pairs = pair_table(df, truth, cluster, by)
    text = lambda c: F.col(c).cast("string")
    keys = F.array(
        F.struct(F.lit("u").alias("kind"), text("u").alias("x"), F.lit(None).cast("string").alias("y")),
        F.struct(F.lit("v").alias("kind"), F.lit(None).cast("string").alias("x"), text("v").alias("y")),
        F.struct(F.lit("uv").alias("kind"), text("u").alias("x"), text("v").alias("y")),
    )
    margins = pairs.select(*by, "n", F.explode(keys).alias("k")).groupBy(*by, "k.kind", "k.x", "k.y")
    margins = margins.agg(F.sum("n").cast("double").alias("m"))
    of = lambda kind, expr: F.sum(F.when(F.col("kind") == kind, expr).otherwise(0.0))
    nlogn = F.col("m") * F.log("m")
    two = F.col("m") * (F.col("m") - 1) / 2
    sums = margins.groupBy(*by).agg(
        of("uv", F.col("m")).alias("total"),
        of("u", nlogn).alias("lu"),
        of("v", nlogn).alias("lv"),
        of("uv", nlogn).alias("luv"),
        of("u", two).alias("a"),
        of("v", two).alias("b"),
        of("uv", two).alias("same"),
        F.count_if(F.col("kind") == "u").alias("ku"),
        F.count_if(F.col("kind") == "v").alias("kv"),
    )
    total = F.col("total")
    entropy = lambda c: F.log(total) - F.col(c) / total
    mutual = entropy("lu") + entropy("lv") - entropy("luv")
    nmi = mutual / F.nullif((entropy("lu") + entropy("lv")) / 2, F.lit(0.0))
    expected = F.col("a") * F.col("b") / F.nullif(total * (total - 1) / 2, F.lit(0.0))
    ari = (F.col("same") - expected) / F.nullif((F.col("a") + F.col("b")) / 2 - expected, F.lit(0.0))
    one_side = (F.col("ku") == 1) | (F.col("kv") == 1)
    both = (F.col("ku") == 1) & (F.col("kv") == 1)
    return sums.select(
        *by,
        F.when(both, 1.0).when(one_side, 0.0).otherwise(F.greatest(nmi, F.lit(0.0))).alias("nmi"),
        F.coalesce(ari, F.lit(1.0)).alias("ari"),
    )
