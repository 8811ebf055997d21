"""Connected components against a plain union-find."""

import random

from brisa.llm.components import components


def _plain(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def test_paths_hubs_and_random_graphs(spark):
    rng = random.Random(1)
    order = rng.sample(range(1000, 1060), 60)
    edges = list(zip(order, order[1:]))  # a long path in random order of ids
    edges += [(-5, i) for i in range(200)] + [(7, 7), (3, -5), (-5, 3)]  # a hub, a loop, repeated edges
    edges += [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(110)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = _plain([e for e in edges if e[0] != e[1]])
    assert got == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
