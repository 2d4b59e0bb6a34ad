"""Connected components of stars, paths and mixed graphs, with and without the last step in one task."""

import random

import pytest

from sheafmill.operators.components import connected_components


def expected(links):
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("last_links", [0, 50_000])
def test_star_path_and_clusters(spark, last_links):
    links = [(5000, i) for i in range(1, 900)] + [(10_000 + i, 10_001 + i) for i in range(120)]
    rng = random.Random(4)
    links += [(20_000 + rng.randrange(150), 20_000 + rng.randrange(150)) for _ in range(110)]
    links = [(a, b) for a, b in links if a != b]
    edges = spark.createDataFrame(links + links[:30], "src long, dst long")
    got = {r.id: r.component for r in connected_components(edges, last_links).collect()}
    assert got == expected(links)


def test_loops_nulls_and_nothing(spark):
    edges = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "src int, dst int")
    assert connected_components(edges).count() == 0
