import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlake.llm import binary_codes as bc


def frame(spark, rows):
    data = [(i, v, l, 5, "x") for i, v, l in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, n_links long, other string")


def brute_force(rows, threshold=0.98):
    usable = [(i, np.array(v, np.float32).astype(float), l) for i, v, l in rows if i is not None and l is not None and bc.unit(v) is not None]
    links, parent = {}, {i: i for i, *_ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, v, l) in enumerate(usable):
        for j, w, m in usable[:a]:
            if l == m and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= threshold:
                links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return links, {i: root(i) for i in parent}


@pytest.mark.parametrize("seed", [0, 1])
def test_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(bc, "BLOCK", 32)
    rng = np.random.default_rng(seed)
    rows = []
    for center in range(6):
        base = rng.standard_normal(64)
        for noise in (0.0, 0.05, 0.12, 0.14, 0.16, 0.3):
            for _ in range(8):
                v = base / np.linalg.norm(base) + noise * rng.standard_normal(64) / 8
                rows.append((len(rows), [float(x) for x in np.float32(v * rng.uniform(0.5, 9))], center % 2))
    rows += [(len(rows) + k, [float(x) for x in np.float32(rng.standard_normal(64))], 0) for k in range(100)]
    links, parts = brute_force(rows)
    got = {r["id"]: r for r in bc.near_vectors(spark, frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (links.get(i, 0), parts[i], parts[i] == i)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [], 0), (8, [0.0] * 3, 0),
        (9, [1.0, None, 3.0], 0), (10, [1.0, math.nan, 3.0], 0), (11, [math.inf, 2.0, 3.0], 0), (12, [1.0, 2.0], 0),
        (None, v, 0), (13, [-1.0, -2.0, -3.0], 0),
    ]
    got = {r["id"]: r for r in bc.near_vectors(spark, frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert [got[i]["n_links"] for i in (1, 2, 3)] == [2, 2, 2]
    assert [got[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(4, 14))
    assert got[None]["n_links"] == 0 and got[None]["kept"]


def test_empty_table(spark):
    assert bc.near_vectors(spark, frame(spark, [])).collect() == []


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    turned = bc.rotations(64, bc.KEYS * bc.KEY_BITS)
    assert np.allclose(turned[:, :64] @ turned[:, :64].T, np.eye(64))
    u = rng.standard_normal((400, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = u + 0.3 * rng.standard_normal((400, 64)) / 8
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    code, factor = bc.code_and_factor(u, turned)
    found, deviation = bc.estimates(code, factor, w @ turned[:, :64])
    true = (u * w).sum(1)
    error = (np.diag(found) - true) / (deviation * np.sqrt(1 - true * true))
    assert abs(error.mean()) < 0.2 and 0.7 < error.std() < 1.3 and np.abs(error).max() < bc.DEVIATIONS


def test_recall_of_the_keys():
    """Pairs at the threshold share a key but for a few in ten million."""
    rng = np.random.default_rng(4)
    turned = bc.rotations(64, bc.KEYS * bc.KEY_BITS)
    u = rng.standard_normal((3000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    side = rng.standard_normal((3000, 64))
    side -= (side * u).sum(1, keepdims=True) * u
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    w = 0.98 * u + math.sqrt(1 - 0.98**2) * side
    same = bc.keys_of(u, turned) == bc.keys_of(w, turned)
    assert same.any(1).all()
    assert abs(same.mean() - (1 - math.acos(0.98) / math.pi) ** bc.KEY_BITS) < 0.02
