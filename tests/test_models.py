import math
import threading
import types

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import Observation, functions as F

from sheafmill.operators import blocks, classify, cluster, components, dbscan, lloyd, metrics, microclusters, neighbours, ordering, resample, silhouette, vectors
from sheafmill.sources import stored


def points_table(spark, data, extra=None, parts=4):
    rows = [(i, x.tolist(), *( [int(extra[i])] if extra is not None else [])) for i, x in enumerate(data)]
    return spark.createDataFrame(rows, "id int, x array<double>" + (", label int" if extra is not None else "")).repartition(parts)


def brute_dbscan(data, eps, min_points=5):
    near = np.sqrt(((data[:, None] - data[None]) ** 2).sum(2)) <= eps
    core = near.sum(1) >= min_points
    labels, n = np.full(len(data), -1), 0
    for i in range(len(data)):
        if not core[i] or labels[i] != -1:
            continue
        todo = [i]
        labels[i] = n
        while todo:
            p = todo.pop()
            for q in np.flatnonzero(near[p]):
                if labels[q] == -1:
                    labels[q] = n
                    if core[q]:
                        todo.append(q)
        n += 1
    return labels


@pytest.mark.parametrize("size", [None, 8])
@pytest.mark.parametrize("dims, eps, spread", [(2, 0.35, 3.0), (6, 1.2, 1.5), (2, 5.0, 1.0), (2, 0.01, 5.0)])
def test_dbscan(spark, monkeypatch, dims, eps, spread, size):
    if size:
        monkeypatch.setattr(dbscan, "block_rows", lambda width: size)
    rng = np.random.default_rng(dims)
    data = np.concatenate([rng.normal(c * spread, 0.5, (30, dims)) for c in range(3)] + [np.tile([[9.0] * dims], (25, 1))])
    rng.shuffle(data)
    got = {r.id: r.cluster for r in dbscan.dbscan(points_table(spark, data), "id", "x", eps).collect()}
    assert [got[i] for i in range(len(data))] == brute_dbscan(data, eps).tolist()


@pytest.mark.parametrize("eps", [3.0, 4.0, 5.0, 6.0, 8.0])
def test_dbscan_in_fifty_dimensions(spark, monkeypatch, eps):
    monkeypatch.setattr(dbscan, "block_rows", lambda width: 40)
    rng = np.random.default_rng(50)
    data = np.concatenate([rng.normal(0, 0.6, (60, 50)) + c * 4.0 for c in range(4)] + [rng.normal(0, 4, (20, 50))])
    told = Observation("met")
    got = {r.id: r.cluster for r in dbscan.dbscan(points_table(spark, data), "id", "x", eps, observation=told).collect()}
    assert [got[i] for i in range(len(data))] == brute_dbscan(data, eps).tolist()
    blocks = len(data) / 40
    assert told.get["pairs"] < 0.8 * (2 * blocks) ** 2  # cells far from each other do not meet


@pytest.mark.parametrize("parts", [2, 2000])
def test_dbscan_in_tiles_of_few_blocks_gives_all_eps_at_once(spark, monkeypatch, parts):
    monkeypatch.setattr(dbscan, "block_rows", lambda width: 8)
    monkeypatch.setattr(dbscan, "GROUP_VALUES", 8 * 3 * 5)
    monkeypatch.setattr(dbscan, "MOST_PARTS", parts)
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(c * 3.0, 0.7, (60, 3)) for c in range(3)] + [np.tile([[3.2, 3.0, 3.1]], (9, 1))])
    eps, seen = [0.4, 0.9, 4.0], []
    tiles = dbscan._tiles
    monkeypatch.setattr(dbscan, "_tiles", lambda meeting, per: seen.append((meeting, per, tiles(meeting, per))) or seen[0][2])
    got = {r.id: r[1:] for r in dbscan.dbscans(points_table(spark, data), "id", "x", eps).collect()}
    for n, e in enumerate(eps):
        assert [got[i][n] for i in range(len(data))] == brute_dbscan(data, e).tolist()
    meeting, per, (needed, count) = seen[0]
    blocks = meeting.where("a = b").count()
    groups = -(-blocks // per)
    assert per == 5 and count <= groups * (groups + 1) / 2
    assert needed.count() <= blocks * groups < 2 * meeting.count()  # each pair of blocks sent both


def test_dbscan_empty(spark):
    assert dbscan.dbscan(spark.createDataFrame([], "id int, x array<double>"), "id", "x", 1.0).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (200, 200)]
    edges = spark.createDataFrame(chain, "src bigint, dst bigint").repartition(5)
    got = {r.id: r.component for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    assert all(r.n == r.k for r in ordering.number_rows(df, "k", "n").collect())


def brute_silhouette(data, lab):
    dist = np.sqrt(((data[:, None] - data[None]) ** 2).sum(2))
    scores = []
    for i in range(len(data)):
        same = (lab == lab[i]) & (np.arange(len(data)) != i)
        if not same.any():
            scores.append(0.0)
            continue
        a = dist[i, same].mean()
        b = min(dist[i, lab == c].mean() for c in set(lab) - {lab[i]})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_distances_of_narrow_rows_are_those_of_their_differences():
    rng = np.random.default_rng(4)
    a, b = (rng.random((30, 3)) + [1e3, 1e6, 0] for _ in range(2))
    assert (blocks.squared_distances(a, b) == ((a[:, None] - b[None]) ** 2).cumsum(2)[:, :, -1]).all()


def test_silhouette_of_a_single_piece_is_spread(spark):
    rows = spark.createDataFrame([(i, [float(i), i % 3 * 9.0], i % 3) for i in range(60)], "id int, x array<double>, label int").coalesce(1)
    found = silhouette.silhouette(rows, "id", "x", "label")
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
    assert abs(found.first().silhouette - silhouette.silhouette(rows.repartition(5), "id", "x", "label").first().silhouette) < 1e-12


def test_all_starts_of_a_sweep_give_what_each_gives(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=3) + i % 4 * 6).tolist(), i % 4) for i in range(80)]
    points = cluster._points(spark.createDataFrame(rows, "id int, x array<double>, label int"), "id", "x", "label").persist()
    found = cluster.fit_kmeans_all(points, [2, 4], n_init=3)
    assert [m.summary.k for m in found] == [2, 4]
    assert [m.summary.trainingCost for m in found] == [cluster.fit_kmeans(points, k, 3).summary.trainingCost for k in (2, 4)]


@pytest.mark.parametrize("dims, off", [(3, 0.0), (20, 1000.0)])
def test_steps_are_those_of_spark_in_one_task_and_in_passes(spark, dims, off):
    rng = np.random.default_rng(dims)
    data = rng.normal(size=(5000, dims)) + off
    data[4000:] = data[:1000]
    points = cluster._points(points_table(spark, data, np.zeros(5000, int)), "id", "x", "label").persist()
    first = [KMeans(k=k, seed=3, maxIter=0).fit(points).clusterCenters() for k in (2, 7)]
    alone, passes, one = lloyd.run(points, "points", first, [2, 7], 300), lloyd.run(points, "points", first, [2, 7], 300, local_values=0), lloyd.run(points, "points", first[1:], [7], 300)
    for k, a, b in zip((2, 7), alone, passes):
        want = KMeans(k=k, seed=3, maxIter=300).fit(points)
        assert (a.values == b.values).all() and a.summary == b.summary and a.steps == b.steps > 1
        assert np.allclose(a.values, want.clusterCenters(), atol=1e-8) and abs(a.summary.trainingCost / want.summary.trainingCost - 1) < 1e-9
        assert a.transform(points).select("id", "prediction").exceptAll(want.transform(points).select("id", "prediction")).count() == 0
    assert (one[0].values == alone[1].values).all() and one[0].summary == alone[1].summary
    assert [m.steps for m in lloyd.run(points, "points", first, [2, 7], 1)] == [1, 1]


def test_silhouette(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(60, 3)) + 1000  # far from the origin, where expanded squares would cancel
    data[40:] = data[20:40]  # copies
    lab = np.array([0] * 20 + [1] * 19 + [2] + [0] * 20)
    df = points_table(spark, data, lab)
    found = silhouette.silhouette(df, "id", "x", "label").first()
    assert abs(found.silhouette - brute_silhouette(data, lab)) < 1e-6 and found.error == 0
    assert silhouette.silhouette(df.where("label = 1"), "id", "x", "label").first().silhouette is None


@pytest.mark.parametrize("anchors", [60, 300, 1200])
def test_silhouette_stays_within_its_error(spark, anchors):
    rng = np.random.default_rng(8)
    lab = rng.integers(0, 3, 900)
    data = rng.normal(size=(900, 2)) * 0.3 + lab[:, None] * [[2.0, 1.0]]
    found = silhouette.silhouette(points_table(spark, data, lab).repartition(5), "id", "x", "label", anchors).first()
    off = abs(found.silhouette - brute_silhouette(data, lab))
    assert off <= found.error + 1e-9 and found.error < 2 and off < (0.05 if anchors == 60 else 0.01)


def test_silhouette_is_exact_however_many_rows(spark):
    rng = np.random.default_rng(9)
    data, lab, other = rng.normal(size=(700, 12)), rng.integers(0, 4, 700), rng.integers(-1, 250, 700)
    data[600:], lab[600:650] = data[:100], lab[:50]
    found = silhouette.silhouette(points_table(spark, data, lab), "id", "x", "label", 60).first()  # far more distinct rows than that
    assert abs(found.silhouette - brute_silhouette(data, lab)) < 1e-9 and found.error == 0
    rows = [(x.tolist(), int(a), int(b)) for x, a, b in zip(data, lab, other)]
    df = spark.createDataFrame(rows, "x array<double>, a int, b int").repartition(3)
    both = {r.clustering: r.silhouette for r in silhouette.silhouettes(df, "x", ["a", "b"], noise=True).collect()}
    kept = other >= 0
    assert abs(both[0] - brute_silhouette(data, lab)) < 1e-9 and abs(both[1] - brute_silhouette(data[kept], other[kept])) < 1e-9


def brute_ward(data, weight, k):
    groups = [[i] for i in range(len(data))]
    while len(groups) > k:
        best = None
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                (a, ca), (b, cb) = ((weight[g].sum(), np.average(data[g], axis=0, weights=weight[g])) for g in (groups[i], groups[j]))
                cost = a * b / (a + b) * ((ca - cb) ** 2).sum()
                if best is None or cost < best[0]:
                    best = cost, i, j
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("k", [1, 3, 8, 40])
def test_ward_like_merging_the_closest_pair(k):
    rng = np.random.default_rng(k)
    data, weight = rng.normal(size=(40, 3)), rng.integers(1, 5, 40)
    found = microclusters.ward(weight, data, k)
    assert {frozenset(np.flatnonzero(found == c).tolist()) for c in set(found.tolist())} == brute_ward(data, weight, k)


def test_agglomerate_rows_copies_and_many_rows(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(50, 2)).round(2)
    data = np.concatenate([data, data[:20], data[:5]])
    got = {r.id: r.cluster for r in microclusters.agglomerate(points_table(spark, data), "x", 6).collect()}
    of_distinct, at = np.unique(data, axis=0, return_inverse=True)
    want = brute_ward(of_distinct, np.bincount(at), 6)
    assert {frozenset(at[i] for i in got if got[i] == c) for c in set(got.values())} == want
    many = np.concatenate([rng.normal(0, 0.4, (1500, 4)) + 6 * c for c in range(5)])
    got = {r.id: r.cluster for r in microclusters.agglomerate(points_table(spark, many, parts=7), "x", 5, most=60).collect()}
    assert all(len({got[i] for i in range(c * 1500, (c + 1) * 1500)}) == 1 for c in range(5)) and len(set(got.values())) == 5
    assert microclusters.agglomerate(points_table(spark, data).where("id < 0"), "x", 3).count() == 0


def test_micro_clusters_keep_sums_and_reach(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(3000, 3))
    found = microclusters.summarise(points_table(spark, data, parts=6), "x", 50).collect()
    assert len(found) <= 50 and sum(r.n for r in found) == 3000 and np.allclose(sum(np.array(r.total) for r in found), data.sum(0))
    near = np.sqrt(((data[:, None] - np.array([r.anchor for r in found])[None]) ** 2).sum(2))
    assert (near <= np.array([r.reach for r in found]) + 1e-9).any(1).all()


def test_reduced_shape(spark):
    data = np.random.default_rng(0).random((100, 200))
    df = points_table(spark, data).withColumn("row", vectors.from_array(F.col("x"), 200))
    reduced, _ = cluster.reduce_dimensions(df, "row", 200, "r", 5)
    got = np.array([r.r for r in reduced.collect()])
    assert got.shape == (100, 5) and np.allclose(got.mean(0), 0) and np.allclose(got.std(0), 1)


def blobs(spark):
    rng = np.random.default_rng(0)
    data = np.concatenate([rng.normal(0, 0.5, (50, 10)), rng.normal(10, 0.5, (50, 10))])
    return points_table(spark, data, np.repeat([0, 1], 50))


def test_clusterings_of_two_blobs(spark):
    df = blobs(spark)
    found = cluster.run_kmeans(df, "id", "x", "label", (2, 3), n_init=3)
    assert found[0]["silhouette"] > 0.5 and found[0]["nmi"] > 0.8 and cluster.best_k(found) == 2
    assert cluster.run_hierarchical(df, "id", "x", "label", 2)["ari"] == 1.0
    sweep = cluster.run_dbscan(df, "id", "x", "label", (0.1, 5.0))
    assert (sweep[0]["n_clusters"], sweep[0]["n_noise"], sweep[0]["silhouette"], sweep[0]["nmi"]) == (0, 100, -1.0, 0.0)
    assert (sweep[1]["n_clusters"], sweep[1]["n_noise"], sweep[1]["nmi"]) == (2, 0, 1.0)
    plane = cluster.plane(df, "id", "x", "label", 2, n_init=1)
    assert plane.columns == ["id", "x", "y", "cluster", "label"] and plane.count() == 100


def knn(data, lab, k):
    out = {}
    for i in range(len(data)):
        d = np.sqrt(((data - data[i]) ** 2).sum(1))
        d[(lab != lab[i]) | (np.arange(len(data)) == i)] = np.inf
        out[i] = [int(j) for j in np.argsort(d, kind="stable")[:k]]
    return out


def feature_rows(spark, data, lab):
    df = points_table(spark, data, lab)
    return df.select("id", "label", vectors.from_array(F.col("x"), data.shape[1]).alias("row"))


@pytest.mark.parametrize("size", [16, 1000])
def test_neighbours_are_exact(spark, monkeypatch, size):
    rng = np.random.default_rng(5)
    data, lab = rng.random((150, 4)), np.array([0] * 90 + [1] * 30 + [2] * 30)
    data[40:70] = data[3]  # a crowd of copies
    monkeypatch.setattr(neighbours, "block_rows", lambda width: size)
    monkeypatch.setattr(neighbours, "VISITORS", 1)
    rows = feature_rows(spark, data, lab).withColumn("ask", F.lit(True))
    got = {r.id: r.neighbours for r in neighbours.nearest_in_group(rows, "id", "label", "row", "ask", 4, 3).collect()}
    assert got == knn(data, lab, 3)


def test_neighbours_of_sparse_rows_odd_groups_and_few_that_ask(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "block_rows", lambda width: 8)
    rng = np.random.default_rng(1)
    data = rng.random((60, 5)) * (rng.random((60, 5)) < 0.4)
    df = points_table(spark, data, np.arange(60) % 2)
    kept = F.filter(F.arrays_zip(F.sequence(F.lit(0), F.lit(4)).alias("i"), F.col("x").alias("v")), lambda e: e["v"] != 0)
    rows = df.withColumn("e", kept).select(F.col("id"), F.when(F.col("label") == 1, "b").alias("g"), vectors.sparse(5, F.col("e.i"), F.col("e.v")).alias("row"), (F.col("id") % 3 == 0).alias("ask"))
    got = {r.id: r.neighbours for r in neighbours.nearest_in_group(rows, "id", "g", "row", "ask", 5, 4).collect()}
    want = knn(data, np.arange(60) % 2, 4)
    assert got == {i: want[i] for i in range(0, 60, 3)}  # the group without a name is a group
    alone = neighbours.nearest_in_group(rows.where("id = 3"), "id", "g", "row", "ask", 5, 4)
    assert alone.count() == 0


def test_rows_in_clumps_visit_few_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "block_rows", lambda width: 100)
    rng = np.random.default_rng(2)
    data = np.concatenate([rng.normal(0, 0.2, (150, 3)) + c * 10 for c in range(20)])
    rows = feature_rows(spark, data, np.zeros(3000, int)).withColumn("ask", F.lit(True))
    told = Observation("moved")
    got = {r.id: r.neighbours for r in neighbours.nearest_in_group(rows, "id", "label", "row", "ask", 3, 5, told).collect()}
    assert got == knn(data, np.zeros(3000), 5)
    assert told.get["visits"] < 8 * 3000  # all blocks would be 30 or more a row


def test_rows_move_once_to_each_host_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "block_rows", lambda width: 4)
    rng = np.random.default_rng(11)
    data, lab = rng.normal(size=(400, 12)), np.repeat([0, 1], [250, 150])  # all distances are much alike
    rows = feature_rows(spark, data, lab).withColumn("ask", F.lit(True))
    told = Observation("hosts")
    got = {r.id: r.neighbours for r in neighbours.nearest_in_group(rows, "id", "label", "row", "ask", 12, 5, told).collect()}
    assert got == knn(data, lab, 5)
    assert told.get["visits"] <= 400 * 20  # nearly all of 75 and 125 blocks are visited


def test_rows_that_visit_many_blocks_are_sent_in_frames_of_bounded_size(monkeypatch):
    monkeypatch.setattr(neighbours, "MOVED_VALUES", 1000)
    rows = pd.DataFrame({"id": [7, 8], "indices": [np.arange(99)] * 2, "values": [np.ones(99)] * 2})
    row, block = np.repeat([0, 1], 500), np.tile(np.arange(500), 2)
    frames = list(neighbours._sent(rows, row, block % 3, block))
    assert max(len(f) for f in frames) <= 11
    sent = pd.concat(frames)
    assert sent["id"].tolist() == [7] * 500 + [8] * 500
    assert (sent["block"].to_numpy() == block).all() and (sent["cell"].to_numpy() == block % 3).all()


def test_smote(spark):
    rng = np.random.default_rng(7)
    lab = np.array([0] * 40 + [1] * 13 + [2] * 9)
    data = rng.random((62, 3)) + lab[:, None] * 10
    grown = resample.smote(feature_rows(spark, data, lab), "id", "label", "row", 3).collect()
    assert all(sum(r.label == c for r in grown) == 40 for c in range(3))
    assert sum(not r.synthetic for r in grown) == 62
    near = knn(data, lab, 5)
    for r in grown:
        if r.synthetic:
            base, point = data[r.id], np.array(r.row["values"])
            # on the segment from its base to one of the five nearest of the class
            off = [np.linalg.norm(np.cross(point - base, data[o] - base)) for o in near[r.id]]
            assert min(off) < 1e-9 and lab[r.id] == r.label


def test_between_sparse_rows(spark):
    row = lambda i, v: (0, 6, i, v)
    kind = "a struct<type: tinyint, size: int, indices: array<int>, values: array<double>>, b struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    df = spark.createDataFrame([(row([0, 3], [1.0, 2.0]), row([3, 5], [4.0, 8.0])), (row([], []), row([1], [1.0]))], kind)
    got = df.select(resample.between(F.col("a"), F.col("b"), F.lit(0.25)).alias("r")).collect()
    assert [(r.r.indices, r.r["values"]) for r in got] == [([0, 3, 5], [0.75, 2.5, 2.0]), ([1], [0.25])]


def test_smote_clamp(spark):
    data, lab = np.random.default_rng(8).random((13, 3)), np.array([0] * 10 + [1] * 3)
    grown = resample.smote(feature_rows(spark, data, lab), "id", "label", "row", 3).collect()
    assert sum(r.label == 1 for r in grown) == 10  # three rows: two neighbours each
    single = resample.smote(feature_rows(spark, data[:11], lab[:11]), "id", "label", "row", 3)
    assert single.count() == 11  # one row has no neighbour: nothing is added


SIZES = {"RandomForest": {"numTrees": 5, "maxDepth": 4}, "HistGBT_sklearn": {"maxIter": 2, "maxDepth": 2}, "LinearSVC": {"maxIter": 5}}
SMALL = {"RandomForest": [{"numTrees": 3}, {"numTrees": 5}], "HistGBT_sklearn": [{}], "LinearSVC": [{"C": 1.0}, {"C": 2.0}]}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(90):
        x = rng.random(6)
        x[i % 3] += 1.0
        rows.append((i, float(i % 3), "train" if i < 60 else "val" if i < 75 else "test", x.tolist()))
    df = spark.createDataFrame(rows, "doc_id int, label double, split string, x array<double>")
    return df.select("doc_id", "label", "split", vectors.from_array(F.col("x"), 6).alias("flat"), vectors.from_array(F.col("x"), 6).alias("section"))


def test_roster():
    assert list(classify.get_classifiers("cpu")) == ["RandomForest", "HistGBT_sklearn", "LinearSVC"]
    assert list(classify.get_classifiers("gpu")) == ["HistGBT"] and len(classify.get_classifiers("both")) == 4
    assert [len(classify.GRIDS[n]) for n in ("RandomForest", "HistGBT_sklearn", "HistGBT", "LinearSVC")] == [2, 4, 2, 3]
    known = classify.get_classifiers("both")
    assert not known["HistGBT"].resample and not known["HistGBT_sklearn"].resample and known["LinearSVC"].resample
    with pytest.raises(ValueError):
        classify.get_classifiers("tpu")


def test_grid_points_are_fitted_side_by_side(spark, monkeypatch):
    together, order = threading.Barrier(2, timeout=30), []

    class Grid(classify.Classifier):
        def estimator(self, params):
            return types.SimpleNamespace(fit=lambda rows: order.append(params["n"]) if params["n"] == 0 else together.wait())

    scores = types.SimpleNamespace(asDict=lambda: {"macro_f1": 0.5, "balanced_accuracy": 0.5, "accuracy": 0.5})
    monkeypatch.setattr(classify, "predict", lambda *a: None)
    monkeypatch.setattr(classify.metrics, "classification_metrics", lambda *a: types.SimpleNamespace(first=lambda: scores))
    rows = spark.createDataFrame([(1, 0.0, "train", 1.0)], "doc_id int, label double, split string, flat double")
    found = classify.select_params(classify.Task(rows, "flat", 1), Grid("x", None, {}, [{"n": n} for n in range(3)], False, False))
    assert found[0] == {"n": 0} and order == [0]


def test_best_of_keeps_the_first_tie():
    low, high = {"macro_f1": 0.5, "balanced_accuracy": 0.9, "accuracy": 0.9}, {"macro_f1": 0.6, "balanced_accuracy": 0.1, "accuracy": 0.1}
    assert classify.best_of([({"a": 1}, low), ({"a": 2}, high), ({"a": 3}, dict(high))])[0] == {"a": 2}


def test_compare_save_and_predict(spark, table, tmp_path):
    chosen = classify.get_classifiers(sizes=SIZES, grids=SMALL)
    results, predictions, models = classify.compare_feature_sets(table, {"flat": 6}, chosen)
    rows = results.collect()
    assert len(rows) == 3 and all(r.used_validation and 0 <= r.macro_f1 <= 1 for r in rows)
    assert {r.classifier: r.selected_params for r in rows}["HistGBT_sklearn"] == "{}"
    assert predictions.count() == 45 and {p.prediction for p in predictions.collect()} <= {0.0, 1.0, 2.0}
    assert sorted(models) == ["flat_HistGBT_sklearn", "flat_LinearSVC", "flat_RandomForest"]
    assert max(r.macro_f1 for r in rows) > 0.7
    stored.save_models({**models, "flat_Unknown": models["flat_RandomForest"]}, str(tmp_path / "m"))
    loaded = stored.load_models(spark, str(tmp_path / "m"))
    again, scores = classify.score_models(table, {"flat": 6}, {**loaded, "other_LinearSVC": loaded["flat_LinearSVC"]})
    key = lambda p: (p.classifier, p.doc_id, p.prediction)
    assert sorted(map(key, again.collect())) == sorted(map(key, predictions.collect()))
    assert {r.classifier: round(r.macro_f1, 9) for r in scores.collect()} == {r.classifier: round(r.macro_f1, 9) for r in rows}
    assert stored.load_models(spark, str(tmp_path / "missing")) == {}


def test_without_validation(spark, table):
    rows = table.where("split <> 'val'")
    chosen = {"RandomForest": classify.get_classifiers(sizes=SIZES)["RandomForest"]}
    results, _, _ = classify.run_all_classifiers(classify.Task(rows, "flat", 6), chosen, use_smote=False)
    row = results.first()
    assert not row.used_validation and row.selected_params == "{}" and math.isnan(row.selection_macro_f1)


def test_flat_and_section(spark, table):
    chosen = {"RandomForest": classify.get_classifiers(sizes=SIZES, grids=SMALL)["RandomForest"]}
    results, flat, section = classify.compare_flat_and_section(table, {"flat": 6, "section": 6}, chosen)
    assert results.count() == 2 and flat.count() == section.count() == 15


def test_metrics(spark):
    perfect = spark.createDataFrame([(float(i % 3), float(i % 3)) for i in range(30)], "t double, p double")
    assert all(v == 1.0 for v in metrics.classification_metrics(perfect, "t", "p").first())
    constant = perfect.withColumn("p", F.lit(0.0))
    assert metrics.classification_metrics(constant, "t", "p").first().macro_f1 < 0.5
    # a predicted class that is not in the truth counts in the macro means, not in balanced accuracy
    odd = spark.createDataFrame([(0, 0), (0, 0), (1, 2)], "t int, p int")
    row = metrics.classification_metrics(odd, "t", "p").first()
    assert (row.balanced_accuracy, round(row.macro_recall, 6), round(row.macro_f1, 6)) == (0.5, 0.333333, 0.333333)
    matrix = [tuple(r) for r in metrics.confusion_matrix(odd, "t", "p", [0, 1, 2]).orderBy("truth").collect()]
    assert matrix == [(0, 2, 0, 0), (1, 0, 0, 1), (2, 0, 0, 0)]


def test_agreement_edges(spark):
    same = spark.createDataFrame([(0, 5)] * 4, "a int, b int")
    assert tuple(metrics.cluster_agreement(same, "a", "b").first()) == (1.0, 1.0)
    one_side = spark.createDataFrame([(0, 0), (1, 0)], "a int, b int")
    assert tuple(metrics.cluster_agreement(one_side, "a", "b").first()) == (0.0, 0.0)
    swapped = spark.createDataFrame([(0, 1), (0, 1), (1, 0)], "a int, b int")
    assert [round(x, 12) for x in metrics.cluster_agreement(swapped, "a", "b").first()] == [1.0, 1.0]
