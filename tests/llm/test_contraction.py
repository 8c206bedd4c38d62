import random

import numpy as np
import pytest

from attemptlog.llm import components, contraction

EDGE = "a1 long, a2 long, b1 long, b2 long"


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a1, a2, b1, b2 in edges:
        parent[find((a1, a2))] = find((b1, b2))
    found = {}
    for x in list(parent):
        found.setdefault(find(x), set()).add(x)
    return sorted(sorted(g) for g in found.values())


def grouped(rows):
    found = {}
    for r in rows:
        found.setdefault((r.r1, r.r2), set()).add((r.n1, r.n2))
    # A group is named by one of its own.
    assert all(root in nodes for root, nodes in found.items())
    assert sum(map(len, found.values())) == len(rows)
    return sorted(sorted(g) for g in found.values())


def node(i):
    return (i * 2654435761 % (1 << 62)) - (1 << 61), i % 3


def graph(kind):
    rnd = random.Random(5)
    if kind == "chain":
        pairs = [(i, i + 1) for i in range(700)]
        rnd.shuffle(pairs)
    elif kind == "star":
        pairs = [(0, i) for i in range(1, 3000)]
    elif kind == "clique":
        pairs = [(i, j) for i in range(60) for j in range(i)]
    elif kind == "loops":
        pairs = [(1, 1), (2, 2), (2, 3), (3, 2), (2, 3)]
    else:
        pairs = [(rnd.randrange(900), rnd.randrange(900)) for _ in range(600)]
    return [(*node(a), *node(b)) for a, b in pairs]


@pytest.mark.parametrize("held", [1 << 20, 7])
@pytest.mark.parametrize("kind", ["chain", "star", "clique", "loops", "random"])
def test_components(spark, monkeypatch, kind, held):
    monkeypatch.setattr(contraction, "HELD", held)
    edges = graph(kind)
    df = spark.createDataFrame(edges, EDGE).repartition(7)
    assert grouped(contraction.components(df).collect()) == brute(edges)


def test_both_ways_agree(spark):
    edges = graph("random")
    df = spark.createDataFrame([e for e in edges if e[:2] != e[2:]], EDGE)
    assert grouped(contraction.components(df).collect()) == grouped(components.components(df).collect())


def test_no_edges(spark):
    assert contraction.components(spark.createDataFrame([], EDGE)).collect() == []


def test_groups_in_a_task():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        u, v = rng.integers(0, n, n), rng.integers(0, n, n)
        root = contraction.groups(u, v, n)
        assert (root[u] == root[v]).all() and (root <= np.arange(n)).all() and (root[root] == root).all()
        want = brute([(int(a), 0, int(b), 0) for a, b in zip(u, v)])
        assert len(set(root.tolist())) == len(want) + n - len({x for g in want for x in g})
