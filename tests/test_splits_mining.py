from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sheafmill.operators import graph, mining, splits
from sheafmill.sources.stored import exists

ITEMS = ["oak", "elm", "ash", "fir tree", "yew", "pine"]
# basket n holds the items whose number divides n or n + 1, and "oak" in most of them
BASKETS = [
    (["oak"] * (n % 4 != 3) + [item for k, item in enumerate(ITEMS[1:], 2) if n % k == 0 or (n + 1) % k == 0], "NORTH" if n % 3 else "SOUTH")
    for n in range(1, 13)
] + [(["yew", "oak", "yew"], "SOUTH"), (None, "SOUTH")]


@pytest.fixture(scope="module")
def baskets(spark):
    rows = [(i, t, c) for i, (t, c) in enumerate(BASKETS)]
    return spark.createDataFrame(rows, "id int, items array<string>, category string")


def test_split_sizes(spark):
    df = spark.range(20).select(F.col("id").alias("ID"), F.when(F.col("id") < 10, "A").otherwise("B").alias("Category"))
    out = splits.stratified_split(df, "ID", "Category", 0.2, 0.2).collect()
    assert Counter(r.split for r in out) == {"train": 12, "val": 4, "test": 4}
    assert Counter((r.Category, r.split) for r in out)[("A", "test")] == 2
    again = splits.stratified_split(df.repartition(5), "ID", "Category", 0.2, 0.2).collect()
    assert {r.ID: r.split for r in out} == {r.ID: r.split for r in again}


def test_split_hot_class_and_missing_class(spark):
    cls = F.when(F.col("id") % 100 == 0, None).when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "b").otherwise("c")
    df = spark.range(5000).select("id", cls.alias("k"))
    out = splits.stratified_split(df, "id", "k")
    counts = Counter((r.k, r.split) for r in out.collect())
    assert out.count() == 5000 and counts[(None, "train")] == 50
    # ceil(0.15 * 4950) = 743 test rows and ceil(0.15/0.85 * 4207) = 743 validation rows
    assert sum(v for (k, s), v in counts.items() if s == "test") == 743
    assert sum(v for (k, s), v in counts.items() if s == "val") == 743
    assert abs(counts[("hot", "test")] - 0.15 * 3450) <= 1


def test_folds(spark):
    df = spark.range(10).select(F.col("id").alias("ID"), F.when(F.col("id") < 5, "A").otherwise("B").alias("Category"))
    folded = splits.stratified_folds(df, "ID", "Category", 5)
    for fold, train, val in splits.cv_folds(folded, 5):
        assert (train.count(), val.count()) == (8, 2)
        assert val.select("Category").distinct().count() == 2


def test_top_items_and_transactions(spark, baskets):
    assert mining.top_items(baskets, "items", 5).count() == 5
    trans = mining.transactions(baskets, "items", 5, keep=["id"])
    rows = {r.id: r["items"] for r in trans.collect()}
    counts = Counter(item for t, _ in BASKETS for item in set(t or []))
    top = set(sorted(counts, key=lambda item: (-counts[item], item))[:5])
    assert rows == {i: sorted(set(t or []) & top) for i, (t, _) in enumerate(BASKETS)}
    for r in mining.one_hot(trans, "id", ["oak", "elm"]).collect():
        assert (r["oak"], r["elm"]) == ("oak" in rows[r.id], "elm" in rows[r.id])


def brute_sets(min_support):
    sets = [set(t or []) for t, _ in BASKETS]
    items = sorted(set().union(*sets))
    out = {}
    for size in range(1, 5):
        for c in combinations(items, size):
            n = sum(set(c) <= s for s in sets)
            if n >= min_support * len(sets):
                out[c] = n / len(sets)
    return out


def test_rules_against_all_subsets(spark, baskets):
    sets = mining.frequent_itemsets(mining.transactions(baskets, "items", 50, keep=[]), 0.15)
    expected = brute_sets(0.15)
    got = {tuple(r["items"]): r.support for r in sets.collect()}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-12 for k in got)
    rules = {(tuple(r.antecedents), tuple(r.consequents)): r for r in mining.association_rules(sets, 1.0).collect()}
    n = 0
    for whole, s in expected.items():
        for size in range(1, len(whole)):
            for a in combinations(whole, size):
                c = tuple(x for x in whole if x not in a)
                lift = s / expected[a] / expected[c]
                if lift >= 1.0:
                    n += 1
                    assert abs(rules[(a, c)].lift - lift) < 1e-9
    assert n == len(rules) > 10


def test_sets_are_counted_without_sending_rows(spark, baskets, monkeypatch):
    """FP-growth, whose shuffle grows with the rows, is only for more candidates than one size may have."""
    rows = spark.createDataFrame([(None,), ([],)], "items array<string>").unionByName(mining.transactions(baskets, "items", 50).select("items").repartition(3))

    def found(support):
        return sorted((tuple(r["items"]), r.freq, r.n_rows, r.support) for r in mining.frequent_itemsets(rows, support).collect())

    with monkeypatch.context() as patched:
        patched.setattr(mining, "FPGrowth", None)
        patched.setattr(mining, "PACKED_CELLS", 1)
        counted = {support: found(support) for support in (0.05, 0.15, 0.4, 1.0)}
    assert len(counted[0.05]) > len(counted[0.15]) > 10 and not counted[1.0]
    for most in (0, 9):
        monkeypatch.setattr(mining, "MAX_CANDIDATES", most)
        assert {support: found(support) for support in counted} == counted
    assert mining.frequent_itemsets(rows.where("false"), 0.1).count() == 0


def test_higher_support_gives_no_more_rules(spark, baskets):
    trans = mining.transactions(baskets, "items", 20, keep=[])
    assert mining.mine_rules(trans, 0.5).count() <= mining.mine_rules(trans, 0.2).count()


# Published rows: supports of antecedent, consequent and both, then the measures from confidence on.
PUBLISHED = [
    (0.05877616747181964, 0.06239935587761675, 0.05112721417069243),
    (0.06481481481481481, 0.05837359098228664, 0.05112721417069243),
]
PUBLISHED_MEASURES = [
    (0.8698630136986302, 13.94025629695095, 1.0, 0.047459619179495954, 7.204720739045683, 0.9862322598896694,
     0.7298850574712643, 0.8612021150826096, 0.8446089262041538),
    (0.7888198757763976, 13.513300492610838, 1.0, 0.047343740681099776, 4.458877995642703, 0.9901769704529507,
     0.7094972067039107, 0.7757283332315398, 0.8323409723709574),
]


def test_published_measures(spark):
    df = spark.createDataFrame(PUBLISHED, "a double, c double, s double")
    rows = df.select(*mining.rule_measures(F.col("a"), F.col("c"), F.col("s"))).collect()
    for row, expected in zip(rows, PUBLISHED_MEASURES):
        assert all(abs(x - y) < 1e-12 for x, y in zip(tuple(row)[3:], expected))


def test_measures_at_the_edges(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.5), (1.0, 1.0, 1.0)], "a double, c double, s double")
    rows = df.select(*mining.rule_measures(F.col("a"), F.col("c"), F.col("s"))).collect()
    assert rows[0].conviction == float("inf") and rows[1].zhangs_metric == 0.0 and rows[1].certainty == 0.0


def test_rules_by_category_and_report(spark, baskets, tmp_path):
    rules = mining.rules_by_category(baskets, "items", "category", 5, 100, 0.4)
    assert {r.category for r in rules.select("category").distinct().collect()} <= {"NORTH", "SOUTH"}
    sets = mining.frequent_itemsets(mining.transactions(baskets, "items", 20, keep=[]), 0.2)
    assert mining.save_rules(mining.association_rules(sets), str(tmp_path / "rules"))
    back = spark.read.option("header", True).csv(str(tmp_path / "rules"))
    assert back.columns[:2] == ["antecedents", "consequents"] and back.count() <= 50
    assert not mining.save_rules(mining.association_rules(sets, 100.0), str(tmp_path / "none"))
    assert not exists(spark, str(tmp_path / "none"))


def test_rules_of_unnamed_and_no_categories(spark):
    rows = spark.createDataFrame([(["a", "b"], None), (["a", "b"], None), (["a"], "x")], "items array<string>, category string")
    found = mining.rules_by_category(rows, "items", "category", 1, 10, 0.5)
    assert found.where("category is null").count() == found.count() > 0
    assert mining.rules_by_category(rows.where("false"), "items", "category").count() == 0


def test_long_item_sets_are_refused(spark):
    sets = spark.createDataFrame([([f"i{k:02d}" for k in range(21)], 0.5)], "items array<string>, support double")
    with pytest.raises(ValueError):
        mining.association_rules(sets)


def test_graph(spark, baskets):
    pairs = graph.pair_counts(baskets, "items", 20)
    counted = Counter()
    for t, _ in BASKETS:
        counted.update(combinations(sorted(set(t or [])), 2))
    assert {(r.src, r.dst): r.weight for r in pairs.collect()} == dict(counted)
    edges = graph.graph_edges(pairs, 2)
    assert edges.where("weight < 2").isEmpty() and edges.count() >= graph.graph_edges(pairs, 5).count()
    top = graph.degree_centrality(edges, 5).collect()
    assert len(top) <= 5 and top[0].centrality >= top[-1].centrality
    nodes = {r.id: r.frequency for r in graph.graph_nodes(edges, baskets, "items").collect()}
    assert nodes["oak"] == sum("oak" in (t or []) for t, _ in BASKETS)
    view = graph.view_edges(edges, 3).collect()
    assert max(r.edge_width for r in view) == 3.0
    assert graph.degree_centrality(edges.where("weight > 99"), 5).count() == 0
