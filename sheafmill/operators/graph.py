"""Item co-occurrence graph as an edge table ``(src, dst, weight)`` with ``src < dst``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .mining import item_frequencies, transactions


def pair_counts(df: DataFrame, items_col: str, top_n: int = 200) -> DataFrame:
    """Rows in which two of the top items occur together.

    The pairs of a row come out of its own sorted item array, so no self-join is needed. A row
    holds at most ``top_n`` items after the cut, and there are at most ``top_n^2/2`` different
    pairs, which the map-side aggregate folds before anything is shuffled.
    """
    items = transactions(df, items_col, top_n, keep=[])
    heads = items.select("items", F.posexplode("items").alias("i", "src"))
    pairs = heads.select("src", F.explode(F.slice("items", F.col("i") + 2, F.size("items"))).alias("dst"))
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("weight"))


def graph_edges(pairs: DataFrame, min_weight: int = 5) -> DataFrame:
    return pairs.where(F.col("weight") >= min_weight)


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id"))


def graph_nodes(edges: DataFrame, df: DataFrame, items_col: str) -> DataFrame:
    """``(id, frequency)`` of the nodes that have an edge, with the number of rows they occur in."""
    freq = item_frequencies(df, items_col).select(F.col("item").alias("id"), F.col("n").alias("frequency"))
    return freq.join(_ends(edges).distinct(), "id", "left_semi")


def degrees(edges: DataFrame) -> DataFrame:
    return _ends(edges).groupBy("id").agg(F.count("*").alias("degree"))


def degree_centrality(edges: DataFrame, top_n: int = 30) -> DataFrame:
    """The ``top_n`` nodes by ``degree / (nodes - 1)``."""
    deg = degrees(edges)
    n_nodes = deg.agg(F.count("*")).scalar()
    share = F.when(n_nodes <= 1, 1.0).otherwise(F.col("degree") / (n_nodes - 1))
    return deg.select("id", share.alias("centrality")).orderBy(F.desc("centrality"), "id").limit(top_n)


def _top_nodes(edges: DataFrame, top_n: int) -> DataFrame:
    return degrees(edges).orderBy(F.desc("degree"), "id").limit(top_n)


def view_nodes(edges: DataFrame, top_n: int = 50) -> DataFrame:
    """Nodes of the drawn subgraph with their size."""
    return _top_nodes(edges, top_n).select("id", "degree", (F.col("degree") * 30).alias("node_size"))


def view_edges(edges: DataFrame, top_n: int = 50) -> DataFrame:
    """Edges between the top nodes with their width, relative to the heaviest of them."""
    top = _top_nodes(edges, top_n).select("id")
    kept = edges.join(top.withColumnRenamed("id", "src"), "src", "left_semi")
    kept = kept.join(top.withColumnRenamed("id", "dst"), "dst", "left_semi")
    heaviest = kept.agg(F.max("weight")).scalar()
    return kept.select("src", "dst", "weight", (F.col("weight") / heaviest * 3).alias("edge_width"))
