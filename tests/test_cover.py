"""Betweenness of networks with a small cover: one part at any size, nodes that agree are one class."""

import random

import numpy as np
import pytest

from loanlake.operators import betweenness as paths


def adjacent(spark, links):
    both = [(a, b, w) for a, b, w in links] + [(b, a, w) for a, b, w in links]
    return spark.createDataFrame(both, "node string, neighbour string, weight double")


def scores(table):
    return {r["node"]: r["betweenness"] for r in table.collect()}


def two_sides(rng, nodes, hubs):
    return [(f"o{i}", f"s{j}", float(rng.randrange(1, 4))) for i in range(nodes) for j in rng.sample(range(hubs), rng.randrange(1, 4))]


def test_a_large_network_with_a_small_cover_is_one_part(spark, monkeypatch):
    links = adjacent(spark, two_sides(random.Random(1), 60, 5))
    every_source = {k: pytest.approx(v) for k, v in scores(paths.betweenness(links, part_nodes=20)).items()}

    def refused(*_):
        raise AssertionError("dealt into parts")

    monkeypatch.setattr(paths, "WHOLE_NODES", 30)
    monkeypatch.setattr(paths, "PART_NODES", 20)
    monkeypatch.setattr(paths, "_in_parts", refused)
    assert scores(paths.betweenness(links)) == every_source


def test_shares_of_classes(monkeypatch):
    """A step over the links of classes against one over every node's."""
    rng = np.random.default_rng(4)
    k, n = 4, 90
    rows = [(i, j, float(w)) for i in range(k, n) for j, w in zip(rng.permutation(k)[: rng.integers(1, 4)], rng.integers(1, 3, 3), strict=False)]
    i, j, w = (np.array(x) for x in zip(*rows, strict=True))
    edges = paths._Edges(np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([w, w]))
    cell = paths._Cell.of_one_part(0, k, n, edges)
    cell.find_paths()
    dist, ways = np.ascontiguousarray(cell.dist.T), np.ascontiguousarray(cell.paths.T)
    classes, counts, number = paths._classes(edges, k)
    assert counts.sum() == n - k and len(counts) < (n - k) / 2 and (number >= 0).all()
    expected = np.zeros((k, n))
    for a in range(k, n):
        here = np.flatnonzero(i == a)
        for v in range(n):
            reach = dist[j[here], v] + w[here]
            amount = np.where(reach == reach.min(), ways[j[here], v], 0.0)
            if v != a and np.isfinite(reach.min()) and amount.sum():
                np.add.at(expected[:, v], j[here], amount / amount.sum())
    for size in (1, 50, 250_000):
        monkeypatch.setattr(paths, "SHARE_VALUES", size)
        got = np.concatenate([paths._shares(edges, dist[:, v : v + 37], ways[:, v : v + 37], v) for v in range(0, n, 37)], 1)
        assert got == pytest.approx(expected)
