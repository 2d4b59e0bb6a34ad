"""Conversation prefix trie, screened by a count-min sketch of prefix digests.

Every conversation is rebuilt on the first turns of another (``rebuilt``), and every prefix of a rebuilt
conversation has a digest: the exclusive or of 128 hash bits of each (place, turn), so that prefixes are running
aggregates and no text is shuffled. A count-min sketch counts the prefixes; it never counts too low, so an
estimate of one proves a prefix to be a singleton. Singletons below singletons are whole nodes already and are
emitted where they stand. Only prefixes that may be shared are grouped by digest; a prefix that the sketch takes
for shared by mistake is a group of one there, so the sketch steers work and never results.

Sums over subtrees need no walk of the tree. Below some depth ``r`` a conversation is the smallest member of each
of its nodes. Summed over a node's members, the code points from the node down to depth ``r - 1`` are the
tokens its subtree saves, and the members that end in a childless node of their own are its leaves.

Conversations of any length are spread over tasks: turns are sorted by range, and the running values at the
end of a partition, two rows each, are carried into the next.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import id_hash, spread, stored

GROUP = 100
HEADS = 6
#: Sketch: rows, cells a prefix in each row, and cells of a row at most (32 MB of bits a row are broadcast). Beyond
#: 33 million prefixes cells are shared more often, and more prefixes are grouped that need not be.
ROWS = 2
CELLS = 8
MOST_BITS = 28
BLOCK_BITS = 20
#: Cells that a task holds before it sends them, and ids in a piece of a list of ends.
HELD_CELLS = 2_000_000
PIECE_IDS = 50_000
KEY = ["depth", "p1", "p2"]


def turn_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv_id, turn, t, chars)``: ``t`` is the MD5 of role and text, in which the role's length comes first."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.char_length(by).cast("string"), F.lit(":"), by, said).cast("binary")))
    rows = df.where(F.col(conv).isNotNull())
    return rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("t"), F.char_length(said).cast("long").alias("chars"))


def _edges(rows: DataFrame, ends: DataFrame, *sums: Column) -> DataFrame:
    """``(part, conv_id, ...)``: sums over the earlier parts of conversations that begin or end a part; two rows a part."""
    at_edge = rows.join(F.broadcast(ends), "part").where("conv_id = low OR conv_id = high")
    return cut_lineage(at_edge.groupBy("part", "conv_id").agg(*sums))


def rebuilt(df: DataFrame, conv: str, turn: str, role: str, text: str, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """One row per prefix of every rebuilt conversation, the empty one included.

    ``(conv_id, depth, p1, p2, q1, q2, before, chars, length)``: the prefix's digest, that of its parent, the code points
    before its last turn and in it, and the turns of the whole conversation. Conversation ``c`` has the first ``h`` turns of ``c - c % group``
    (``h`` is CRC-32 of the decimal ``c`` modulo ``heads``) and its own turns after its first ``h``. Turns are ordered by
    ``turn``, null first; equal turns by their MD5, which makes repeated rows turns of their own. Rows without a
    conversation are left out.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = spread(df.select(conv, turn, role, text))
    ranged = turn_rows(rows, conv, turn, role, text).repartitionByRange(parts, "conv_id", "turn", "t")
    rows = stored(ranged.withColumn("part", F.spark_partition_id()), "turns")
    ends = cut_lineage(rows.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")))

    inside = Window.partitionBy("part", "conv_id").orderBy(F.asc_nulls_first("turn"), "t")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = _edges(rows, ends, F.count("*").alias("n")).select("part", "conv_id", F.sum("n").over(earlier).alias("carried"))
    placed = rows.join(F.broadcast(carried), ["part", "conv_id"], "left")
    placed = placed.withColumn("pos", F.row_number().over(inside) + F.coalesce("carried", F.lit(0))).drop("carried")
    placed = stored(placed, "placed")

    def lane(n: int, pos: str) -> Column:
        return F.xxhash64(F.lit(n), F.col(pos).cast("long"), F.col("t"))

    down = Window.partitionBy("conv_id").orderBy("pos")
    first = placed.where((F.col("pos") < heads) & (F.col("conv_id") % group == 0)).withColumns({"l1": lane(1, "pos"), "l2": lane(2, "pos")})
    first = first.withColumns({"p1": F.bit_xor("l1").over(down), "p2": F.bit_xor("l2").over(down), "upto": F.sum("chars").over(down)})
    head = F.struct(
        F.col("pos").alias("depth"), "p1", "p2", F.col("p1").bitwiseXOR(F.col("l1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("l2")).alias("q2"),
        (F.col("upto") - F.col("chars")).alias("before"), "chars",
    )
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(head)).alias("heads"))  # heads - 1 entries at most

    convs = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": id_hash("conv_id") % heads}).join(first, "base", "left")
    taken = F.least(F.col("h"), F.coalesce(F.size("heads"), F.lit(0))).cast("int")
    convs = convs.withColumn("heads", F.when(taken > 0, F.slice("heads", 1, taken)))
    convs = convs.withColumn("m", F.when(F.col("heads").isNull(), 0).otherwise(F.size("heads")).cast("long"))
    last = F.when(F.col("m") > 0, F.element_at("heads", -1))
    zero = F.lit(0).cast("long")
    convs = cut_lineage(
        convs.select(
            "conv_id", "h", "m", "heads", F.coalesce(last["p1"], zero).alias("x1"), F.coalesce(last["p2"], zero).alias("x2"),
            F.coalesce(last["before"] + last["chars"], zero).alias("x_chars"), (F.col("m") + F.greatest(F.col("n") - F.col("h"), zero)).alias("length"),
        )
    )

    own = placed.join(convs.drop("heads"), "conv_id").where(F.col("pos") > F.col("h")).withColumn("depth", F.col("pos") - F.col("h") + F.col("m"))
    own = stored(own.withColumns({"l1": lane(1, "depth"), "l2": lane(2, "depth")}).drop("t", "h", "m"), "own")
    totals = _edges(own, ends, F.bit_xor("l1").alias("e1"), F.bit_xor("l2").alias("e2"), F.sum("chars").alias("e_chars"))
    totals = totals.select(
        "part", "conv_id", F.bit_xor("e1").over(earlier).alias("e1"), F.bit_xor("e2").over(earlier).alias("e2"), F.sum("e_chars").over(earlier).alias("e_chars")
    )
    inside = Window.partitionBy("part", "conv_id").orderBy("pos")
    own = own.join(F.broadcast(totals), ["part", "conv_id"], "left")
    for n in "12":
        whole = F.bit_xor(f"l{n}").over(inside).bitwiseXOR(F.coalesce(f"e{n}", zero)).bitwiseXOR(F.col(f"x{n}"))
        own = own.withColumn(f"p{n}", whole).withColumn(f"q{n}", F.col(f"p{n}").bitwiseXOR(F.col(f"l{n}")))
    own = own.withColumn("before", F.sum("chars").over(inside) - F.col("chars") + F.coalesce("e_chars", zero) + F.col("x_chars"))

    names = ["conv_id", "depth", "p1", "p2", "q1", "q2", "before", "chars", "length"]
    top = convs.select("conv_id", F.explode("heads").alias("e"), "length").select("conv_id", "e.*", "length").withColumn("depth", F.col("depth").cast("long"))
    roots = convs.select("conv_id", *(zero.alias(c) for c in names[1:-1]), "length")
    return own.select(names).unionByName(top.select(names)).unionByName(roots)


def _cells(p1: np.ndarray, p2: np.ndarray, bits: int) -> np.ndarray:
    """The cells of each prefix, one row of the sketch after the other."""
    return np.stack([(p.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) + (row << bits) for row, p in enumerate((p1, p2))])


def _pack(cells: np.ndarray, twice: np.ndarray) -> bytes:
    return zlib.compress(np.diff((cells << 1) | twice, prepend=0).astype("<u4").tobytes(), 1)


def sketch(prefixes: DataFrame, bits: int) -> np.ndarray:
    """Which of the ``ROWS`` x ``2 ** bits`` cells hold two prefixes or more, as packed bits: ``ROWS * 2 ** bits / 8`` bytes.

    Tasks send the cells that they meet, once each, as packed blocks; a block's counts are added in one place.
    """
    block = min(BLOCK_BITS, bits)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def send() -> Iterator[pa.RecordBatch]:
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            of = cells >> block
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(edges, edges[1:]):
                packed = _pack(cells[a:b] & ((1 << block) - 1), (counts[a:b] > 1).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([int(of[a])], pa.int32()), pa.array([packed], pa.binary())], ["block", "cells"])
            held.clear()

        for part in batches:
            held.append(_cells(*(part.column(c).to_numpy() for c in ("p1", "p2")), bits).ravel())
            if sum(map(len, held)) >= HELD_CELLS:
                yield from send()
        if sum(map(len, held)):
            yield from send()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(1 << block, np.uint8)

        def done() -> pa.RecordBatch:
            bitmap = zlib.compress(np.packbits(counts > 1).tobytes(), 1)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bitmap], pa.binary())], ["block", "bitmap"])

        for part in batches:
            for of, packed in zip(part.column("block").to_pylist(), part.column("cells").to_pylist()):
                if of != now:
                    if now is not None:
                        yield done()
                    now, counts = of, np.zeros(1 << block, np.uint8)
                entries = np.cumsum(np.frombuffer(zlib.decompress(packed), "<u4").astype(np.int64))
                at = entries >> 1
                counts[at] = np.minimum(counts[at] + 1 + (entries & 1).astype(np.uint8), 2)
        if now is not None:
            yield done()

    sent = prefixes.select("p1", "p2").mapInArrow(tally, "block int, cells binary")
    tasks = max(1, min(int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions")), ROWS << (bits - block)))
    blocks = sent.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(add, "block int, bitmap binary")
    out = np.zeros((ROWS << bits) // 8, np.uint8)
    for r in blocks.collect():  # no more than the bits themselves
        start = (r["block"] << block) // 8
        bitmap = np.frombuffer(zlib.decompress(r["bitmap"]), np.uint8)
        out[start : start + len(bitmap)] = bitmap
    return out


def screened(prefixes: DataFrame, cells: int = CELLS, most_bits: int = MOST_BITS) -> DataFrame:
    """``prefixes`` with ``shared`` and ``parent_shared``: false where the sketch proves a single occurrence; roots count as shared."""
    n = prefixes.where("depth > 0").count()
    bits = min(max(10, int(np.ceil(np.log2(max(1, n * cells))))), most_bits)
    bitmap = prefixes.sparkSession.sparkContext.broadcast(sketch(prefixes.where("depth > 0"), bits))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = bitmap.value

        def several(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
            at = _cells(p1, p2, bits)
            return ((twice[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)

        for part in batches:
            depth, p1, p2, q1, q2 = (part.column(c).to_numpy() for c in ("depth", "p1", "p2", "q1", "q2"))
            flags = [pa.array((depth == 0) | several(p1, p2)), pa.array((depth <= 1) | several(q1, q2))]
            yield pa.RecordBatch.from_arrays([*part.columns, *flags], [*part.schema.names, "shared", "parent_shared"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema)
    return prefixes.mapInArrow(mark, f"{kinds}, shared boolean, parent_shared boolean")


def ends_hashes(ends: DataFrame) -> DataFrame:
    """``(depth, p1, p2, ends_sha256)`` of ``(depth, p1, p2, conv_id)``: SHA-256 of the ascending ids, comma-joined.

    A node's ids are sorted and joined in pieces by range, wherever they fall; one task then only runs the
    digest over a node's pieces, one in memory at a time.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            key = [part.column(c).to_numpy() for c in KEY]
            ids = part.column("conv_id").to_numpy()
            new = np.flatnonzero(np.any([np.diff(k) != 0 for k in key], axis=0)) + 1
            edges = np.unique(np.concatenate([[0], new, np.arange(0, len(ids), PIECE_IDS), [len(ids)]])).tolist()
            pieces = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(edges, edges[1:])]
            at = edges[:-1]
            yield pa.RecordBatch.from_arrays([*(pa.array(k[at]) for k in key), pa.array(ids[at]), pa.array(pieces, pa.string())], [*KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = state = None
        for part in batches:
            done = []
            for *key, ids in zip(*(part.column(c).to_pylist() for c in (*KEY, "ids"))):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            yield _rows(done)
        if now is not None:
            yield _rows([(*now, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in done], kinds[n]) for n in range(4)], [*KEY, "ends_sha256"])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ends.repartitionByRange(parts, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(join, "depth long, p1 long, p2 long, first long, ids string")
    whole = pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first")
    return whole.mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", cells: int = CELLS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``rebuilt``).

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``. A null role or text is the
    empty one. A table without conversations has no node. Other columns of ``df`` are not read.
    """
    prefixes = stored(rebuilt(df, conv, turn, role, text), "prefixes")
    marked = stored(screened(prefixes, cells, most_bits), "screened")
    shared = marked.where("shared")
    nodes = shared.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("depth") == F.col("length")).alias("n_ends"),
        *(F.min(c).alias(c) for c in ("q1", "q2", "before", "chars")),
    )
    nodes = stored(nodes, "nodes")

    # the depth from which a conversation is the smallest member of its nodes, and the code points above it
    heads = marked.where("NOT shared AND parent_shared")
    own = nodes.select("conv_id", "depth", "before", (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"))
    own = own.unionByName(heads.select("conv_id", "depth", "before", F.lit(1).cast("long").alias("leaf")))
    over = shared.where("depth = length").select("conv_id", (F.col("depth") + 1).alias("depth"), (F.col("before") + F.col("chars")).alias("before"), F.lit(0).cast("long").alias("leaf"))
    own = own.unionByName(over).groupBy("conv_id").agg(F.min("depth").alias("r"), F.min("before").alias("above"), F.max("leaf").alias("leaf"))

    told = shared.select(*KEY, "conv_id", "before", "length").join(stored(own, "own_depths"), "conv_id")
    child = (F.col("r") <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))
    sums = told.groupBy(*KEY).agg(
        F.count_if(child).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum(F.greatest(F.col("above") - F.col("before"), F.lit(0))).alias("saved_tokens")
    )
    ends = ends_hashes(shared.where("depth = length").select(*KEY, "conv_id"))
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    whole = nodes.join(sums, KEY).join(ends, KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nobody))

    ended = F.col("depth") == F.col("length")
    single = {
        "n_convs": F.lit(1).cast("long"), "n_children": F.when(ended, 0).otherwise(1).cast("long"), "n_leaves": F.lit(1).cast("long"), "saved_tokens": F.lit(0).cast("long"),
        "ends_sha256": F.when(ended, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nobody),
    }
    names = ["conv_id", "depth", "parent_conv_id", *single]
    top = nodes.where("depth = 0").select(F.col("conv_id").alias("root"))  # one row at most
    below = whole.select("conv_id", "depth", "q1", "q2", *single).unionByName(heads.withColumns(single).select("conv_id", "depth", "q1", "q2", *single))
    below = stored(below, "below")
    high = below.where("depth <= 1").crossJoin(F.broadcast(top)).withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.col("root")))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    deep = below.where("depth > 1").join(parents, ["depth", "q1", "q2"], "left")
    deep = deep.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "conv_id"))  # else the parent is a proven singleton
    tails = marked.where("NOT shared AND NOT parent_shared").withColumns(single).withColumn("parent_conv_id", F.col("conv_id"))
    return high.select(names).unionByName(deep.select(names)).unionByName(tails.select(names))
