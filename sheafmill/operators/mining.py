"""Frequent item sets and association rules over ``items ARRAY<STRING>`` rows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

MAX_RULE_ITEMS = 20
#: Candidates of one size that are counted on bit rows; beyond it FP-growth finds all sets, which keeps them distributed.
MAX_CANDIDATES = 1 << 18
#: Cells (items x rows) that are packed into bits at a time.
PACKED_CELLS = 1 << 24

RULE_MEASURES = [
    "antecedent_support", "consequent_support", "support", "confidence", "lift", "representativity",
    "leverage", "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski",
]


def item_frequencies(df: DataFrame, items_col: str) -> DataFrame:
    """``(item, n)``: number of rows holding each item; counted once per row."""
    return df.select(F.explode(F.array_distinct(items_col)).alias("item")).groupBy("item").agg(F.count("*").alias("n"))


def top_items(df: DataFrame, items_col: str, top_n: int = 300) -> DataFrame:
    """The ``top_n`` most frequent items, ties by item."""
    return item_frequencies(df, items_col).orderBy(F.desc("n"), "item").limit(top_n)


def _top_array(df: DataFrame, items_col: str, top_n: int) -> Column:
    """The top items as one array value (a scalar subquery of at most ``top_n`` items)."""
    return top_items(df, items_col, top_n).agg(F.collect_list("item")).scalar()


def transactions(df: DataFrame, items_col: str, top_n: int = 300, keep: list[str] | None = None) -> DataFrame:
    """Rows with ``items`` cut down to the top items, sorted; rows without any stay, as empty sets."""
    keep = keep or [c for c in df.columns if c != items_col]
    found = F.array_intersect(F.coalesce(items_col, F.array().cast("array<string>")), _top_array(df, items_col, top_n))
    return df.select(*keep, F.sort_array(F.coalesce(found, F.array().cast("array<string>"))).alias("items"))


def one_hot(trans: DataFrame, id_col: str, items: list[str]) -> DataFrame:
    """Wide boolean form of transactions, for a given bounded list of items."""
    return trans.select(id_col, *[F.array_contains("items", i).alias(i) for i in items])


def frequent_itemsets(trans: DataFrame, min_support: float, partitions: int | None = None) -> DataFrame:
    """``(items, freq, n_rows, support)`` of all item sets with support >= ``min_support``.

    Rows become bits, one row of bits for each frequent item, and sets are counted size by size: a task ands the bits
    of its rows and sends one number per candidate, so what is shuffled does not grow with the rows. A candidate is a
    set whose every smaller part is frequent. Should one size have more than ``MAX_CANDIDATES``, Spark's FP-growth
    finds all sets instead; they are the same. Rows and bits go to the checkpoint folder, since each size reads them,
    and so does the result, because the rule step reads it three times.
    """
    rows = cut_lineage(trans.select("items"))
    n_rows, filled = rows.agg(F.count("*"), F.count("items")).first()
    least = math.ceil(min_support * filled)
    found = _counted_sets(rows, least)
    if found is None:
        groups = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sets = FPGrowth(itemsCol="items", minSupport=min_support, numPartitions=groups).fit(rows).freqItemsets
    else:
        sets = rows.sparkSession.createDataFrame(found, "items array<string>, freq long")
    return cut_lineage(
        sets.select(
            F.array_sort("items").alias("items"),
            F.col("freq"),
            F.lit(n_rows).cast("bigint").alias("n_rows"),
            (F.col("freq") / F.lit(n_rows)).alias("support"),
        )
    )


def _counted_sets(rows: DataFrame, least: int) -> pa.Table | None:
    """``(items, freq)`` of all sets in at least ``least`` rows; nothing where a size has too many candidates."""
    single = item_frequencies(rows, "items").where((F.col("n") >= least) & F.col("item").isNotNull()).orderBy("item").limit(MAX_CANDIDATES + 2).collect()
    names, sets, freqs = [r["item"] for r in single], [], [r["n"] for r in single]
    if len(names) * (len(names) - 1) // 2 > MAX_CANDIDATES:
        return None
    known = [(n,) for n in range(len(names))]
    sets += known
    bits = cut_lineage(rows.mapInArrow(_packer(names), "bits array<binary>")) if len(names) > 1 else rows
    while tried := _candidates(known):
        if len(tried) > MAX_CANDIDATES:
            return None
        counts = bits.mapInArrow(_counter(tried), "candidate long, n long").groupBy("candidate").agg(F.sum("n").alias("n"))
        kept = sorted(tuple(r) for r in counts.where(F.col("n") >= least).collect())
        known = [tried[at] for at, _ in kept]
        sets += known
        freqs += [n for _, n in kept]
    return pa.table({"items": pa.array([[names[n] for n in own] for own in sets], pa.list_(pa.string())), "freq": pa.array(freqs, pa.int64())})


def _candidates(known: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Sets of one more item whose parts are all in ``known``, which is sorted; one more than ``MAX_CANDIDATES`` at most."""
    seen, out = set(known), []
    for head, same in groupby(known, lambda s: s[:-1]):
        for a, b in combinations([s[-1] for s in same], 2):
            if all((*head[:n], *head[n + 1 :], a, b) in seen for n in range(len(head))):
                out.append((*head, a, b))
                if len(out) > MAX_CANDIDATES:
                    return out
    return out


def _packer(names: list[str]):
    """Rows of items to rows of bits: one binary per name with a bit for each row of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names, pa.string())
        step = max(64, PACKED_CELLS // len(names))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                lists = batch.column(0).slice(at, step)
                code = pc.index_in(lists.flatten(), known).fill_null(-1).to_numpy()
                row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0).to_numpy())
                cells = np.zeros((len(names), -(-len(lists) // 64) * 64), bool)
                cells[code[code >= 0], row[code >= 0]] = True
                yield pa.RecordBatch.from_arrays([pa.array([[b.tobytes() for b in np.packbits(cells, axis=1)]], pa.list_(pa.binary()))], ["bits"])

    return run


def _counter(tried: list[tuple[int, ...]]):
    """Rows of bits to ``(candidate, n)``: the task's rows that hold all items of each candidate, which are in order."""
    heads = [(head, [(at, s[-1]) for at, s in same]) for head, same in groupby(enumerate(tried), lambda e: e[1][:-1])]
    groups = [(list(head), same[0][0], [last for _, last in same]) for head, same in heads]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tried), np.int64)
        for batch in batches:
            for own in batch.column(0):
                words = np.frombuffer(b"".join(own.as_py()), np.uint64).reshape(len(own), -1)
                for head, at, last in groups:
                    both = words[last] & np.bitwise_and.reduce(words[head], axis=0)
                    total[at : at + len(last)] += np.bitwise_count(both).sum(1, dtype=np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["candidate", "n"])

    return run


def rule_measures(s_a: Column, s_c: Column, s: Column) -> list[Column]:
    """All rule measures from the supports of antecedent, consequent and both together."""
    conf = s / s_a
    leverage = s - s_a * s_c
    zhang_base = F.greatest(s * (1 - s_a), s_a * (s_c - s))
    cert_base = 1 - s_c
    return [
        s_a.alias("antecedent_support"),
        s_c.alias("consequent_support"),
        s.alias("support"),
        conf.alias("confidence"),
        (conf / s_c).alias("lift"),
        F.lit(1.0).alias("representativity"),
        leverage.alias("leverage"),
        F.when(conf >= 1, F.lit(float("inf"))).otherwise(cert_base / F.nullif(1 - conf, F.lit(0.0))).alias("conviction"),
        F.when(zhang_base == 0, 0.0).otherwise(leverage / F.nullif(zhang_base, F.lit(0.0))).alias("zhangs_metric"),
        (s / (s_a + s_c - s)).alias("jaccard"),
        F.when(cert_base == 0, 0.0).otherwise((conf - s_c) / F.nullif(cert_base, F.lit(0.0))).alias("certainty"),
        ((conf + s / s_c) / 2).alias("kulczynski"),
    ]


def _picked(items: Column, mask: Column, bit: int) -> Column:
    return F.filter(items, lambda x, i: _bit(mask, i) == bit)


def _bit(mask: Column, i: Column) -> Column:
    return F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1))


def association_rules(
    itemsets: DataFrame, min_lift: float = 1.0, max_len: int | None = None, by: list[str] | None = None
) -> DataFrame:
    """Every split of every frequent item set into antecedent and consequent, with lift >= ``min_lift``.

    The supports of both sides come from two equi-joins on the item arrays: each side of a
    frequent set is frequent itself. ``by`` names columns that keep separate rule bases apart.
    """
    by = by or []
    longest = itemsets.agg(F.max(F.size("items"))).first()[0] or 0
    if max_len is not None:
        itemsets_for_rules = itemsets.where(F.size("items") <= max_len)
    else:
        itemsets_for_rules = itemsets
        if longest > MAX_RULE_ITEMS:
            raise ValueError(
                f"an item set of {longest} items has 2^{longest} rules; give max_len or a higher min_support"
            )
    whole = itemsets_for_rules.where(F.size("items") >= 2).select(*by, "items", F.col("support").alias("s"))
    masks = F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("items")) - 2)
    split = whole.select(*by, "items", "s", F.explode(masks).alias("mask"))
    split = split.select(
        *by,
        "s",
        _picked(F.col("items"), F.col("mask"), 1).alias("antecedents"),
        _picked(F.col("items"), F.col("mask"), 0).alias("consequents"),
    )
    base = itemsets.select(*by, "items", "support")
    ante = base.withColumnsRenamed({"items": "antecedents", "support": "s_a"})
    cons = base.withColumnsRenamed({"items": "consequents", "support": "s_c"})
    rules = split.join(ante, [*by, "antecedents"]).join(cons, [*by, "consequents"])
    measured = rules.select(*by, "antecedents", "consequents", *rule_measures(F.col("s_a"), F.col("s_c"), F.col("s")))
    return measured.where(F.col("lift") >= min_lift)


def _sides() -> list[Column]:
    return [F.array_join(F.array_sort("antecedents"), ", "), F.array_join(F.array_sort("consequents"), ", ")]


def sorted_rules(rules: DataFrame) -> DataFrame:
    """By lift, largest first; ties by confidence, support and the item names."""
    return rules.orderBy(F.desc("lift"), F.desc("confidence"), F.desc("support"), *_sides())


def mine_rules(trans: DataFrame, min_support: float = 0.05, min_lift: float = 1.0, max_len: int | None = None) -> DataFrame:
    return sorted_rules(association_rules(frequent_itemsets(trans, min_support), min_lift, max_len))


def top_rules(rules: DataFrame, n: int = 50) -> DataFrame:
    """The rule report: the first ``n`` rules with both sides as comma-joined, sorted names."""
    ante, cons = _sides()
    return sorted_rules(rules).limit(n).select(ante.alias("antecedents"), cons.alias("consequents"), *RULE_MEASURES)


def save_rules(rules: DataFrame, path: str, n: int = 50) -> bool:
    """Write the rule report as one CSV file with a header; nothing is written without rules."""
    report = cut_lineage(top_rules(rules, n))
    if report.isEmpty():
        return False
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return True


def largest_categories(df: DataFrame, category_col: str, n: int) -> DataFrame:
    counts = df.groupBy(category_col).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), category_col).limit(n)


def rules_by_category(
    df: DataFrame, items_col: str, category_col: str, top_categories: int = 5, top_n: int = 100,
    min_support: float = 0.1, min_lift: float = 1.0,
) -> DataFrame:
    """Rules of each of the largest categories on its own support base; categories without rules are absent.

    At most ``top_categories`` runs, each over the rows of one category in parallel.
    """
    parts = None
    baskets = cut_lineage(df.select(F.col(category_col).alias(category_col), F.col(items_col).alias(items_col)))
    for row in largest_categories(baskets, category_col, top_categories).select(category_col).collect():
        rows = baskets.where(F.col(category_col).eqNullSafe(F.lit(row[0])))
        sets = frequent_itemsets(transactions(rows, items_col, top_n), min_support)
        rules = association_rules(sets, min_lift).withColumn("category", F.lit(row[0]))
        parts = rules if parts is None else parts.unionByName(rules)
    if parts is None:
        sets = frequent_itemsets(transactions(baskets, items_col, top_n), min_support)
        parts = association_rules(sets, min_lift).withColumn("category", F.lit(None).cast(df.schema[category_col].dataType)).limit(0)
    return parts
