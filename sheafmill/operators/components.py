"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage

#: A rest of at most so many links (1 MB) is finished by one task; the components are the same either way.
LAST_LINKS = 50_000


def connected_components(edges: DataFrame, last_links: int = LAST_LINKS) -> DataFrame:
    """``(id, component)`` with the smallest id of the component, for edges ``(src, dst)``.

    The graph shrinks in each round: a node merges into whichever of itself and its neighbours comes
    first in that round's random order, edges are renamed and repeated ones and loops go. A star ends in
    one or two rounds and a path loses a fixed share of its nodes, so rounds grow with the logarithm
    of the graph and the rows of all rounds together with its size. What is joined in a round is written to
    the checkpoint folder first, so both sides of a join come straight from a shuffle and Spark can split
    the rows of a hub. Null ends and loops are left out.
    """
    links = cut_lineage(_ordered(edges.select("src", "dst")))
    kind = links.schema["src"].dataType.simpleString()
    steps: list[DataFrame] = []
    while links.count() > last_links:
        turn = len(steps)
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("id"))  # noqa: E731, B023
        sides = links.select(F.explode(F.array(F.struct(F.col("src").alias("u"), order("dst").alias("v")), F.struct(F.col("dst").alias("u"), order("src").alias("v")))).alias("s"))
        first = sides.groupBy("s.u").agg(F.min("s.v").alias("v"))
        merged = cut_lineage(first.select("u", F.least(order("u"), F.col("v"))["id"].alias("p")))
        steps.append(merged)
        a, b = merged.select(F.col("u").alias("src"), F.col("p").alias("a")), merged.select(F.col("u").alias("dst"), F.col("p").alias("b"))
        links = cut_lineage(_ordered(links.join(a, "src").join(b, "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    steps.append(links.coalesce(1).mapInArrow(_finish, f"u {kind}, p {kind}"))
    labels = steps[0].select(F.col("u").alias("id"), F.col("p").alias("label"))
    for merged in steps[1:]:
        named = labels.join(merged, F.col("label") == F.col("u"), "left")
        labels = cut_lineage(named.select("id", F.coalesce("p", "label").alias("label")))
    least = labels.groupBy("label").agg(F.min("id").alias("component"))
    return labels.join(cut_lineage(least), "label").select("id", "component")


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, smaller end first."""
    return links.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).where("src < dst").distinct()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest node of the component of each node of a few links."""
    root: dict = {}
    kind = None

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for part in batches:
        kind = part.schema.field(0).type
        for a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            root.setdefault(a, a)
            root.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([find(n) for n in nodes], kind)], ["u", "p"])
