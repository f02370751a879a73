"""Hard negatives against a loop over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlake.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, rank string, anchor long, size double"


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v, "old", -1, 0.5) for i, label, v in rows], SCHEMA)


def by_loops(rows, every, low=80, k=5):
    usable = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.setdefault(i, []).append((str(label), [math.floor(256 * x) for x in v]))
    usable = {i: min(found) for i, found in usable.items()}
    out = set()
    for a, (label, v) in usable.items():
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, own == label) for i, (own, w) in usable.items() if i != a and len(w) == len(v)]
        scored.sort()
        for less, p, _ in [x for x in scored if x[2]][:k]:
            window = [(n, i) for n, i, same in scored if not same and 100 * n <= low * less and n >= less][:k]
            out |= {(a, p, rank, i, -less, -n) for rank, (n, i) in enumerate(window, 1)}
    return out


def mined(spark, rows, every, **more):
    found = hard_negatives.hard_negatives(spark, frame(spark, rows), F.col("id") % every == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(count, labels, size, seed, coarse=False):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        label = 0 if draw.random() < 0.4 else draw.randrange(labels)
        v = [draw.choice([-0.25, 0.0, 0.25]) if coarse else draw.gauss(0, 0.3) for _ in range(size)]
        rows.append((i, label, v))
    return rows


@pytest.mark.parametrize("coarse", [False, True])
def test_matches_loops(spark, coarse, monkeypatch):
    """Many ties where vectors are coarse; small blocks, so that slots meet again after the tasks."""
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "ROWS", 20)
    rows = random_rows(260, 4, 6, 3, coarse)
    rows = [(i, label, np.float32(v).tolist()) for i, label, v in rows]
    expected = by_loops(rows, 5)
    assert len(expected) > 200
    assert mined(spark, rows, 5) == expected


def test_odd_rows(spark):
    """Nulls anywhere, non-finite parts, empty vectors, other lengths, repeated rows and ids, negative and huge scores."""
    rows = [
        (0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [0.5, 0.5]), (2, 2, [0.5, 0.25]), (3, 2, [0.46875, 0.0]),
        (4, None, [0.5, 0.5]), (None, 1, [0.5, 0.5]), (5, 1, None), (6, 1, [0.5, None]), (7, 2, [float("nan"), 0.5]),
        (8, 2, [float("inf"), 0.5]), (9, 2, [0.5]), (10, 1, []), (11, 1, []), (12, 2, []), (20, 3, [-1.0, 0.0]),
        (21, 3, [1.0, 0.0]), (22, 2, [0.5, 0.25]), (30, 9, [0.25, 0.25]), (2, 1, [0.5, 0.5]),
    ]
    expected = by_loops(rows, 10)
    assert {r[0] for r in expected} >= {0, 10} and mined(spark, rows, 10) == expected
    huge = [(0, 1, [3e38, 0.0]), (1, 1, [3e38, 0.0]), (2, 2, [3e38, 0.0])]
    assert mined(spark, huge, 1) == set()  # their scores do not fit


def test_large_scores_are_exact(spark):
    """Scores above 2^53 are computed in whole numbers."""
    rows = [(0, 1, [360_000.0, 1.0]), (1, 1, [360_000.0, 1.0]), (2, 2, [360_000.0, 0.99609375]), (3, 2, [360_000.0, 0.9921875])]
    assert mined(spark, rows, 10) == by_loops(rows, 10) != set()


def test_empty_and_parameters(spark):
    assert mined(spark, [], 1) == set()
    rows = random_rows(80, 3, 4, 8, True)
    assert mined(spark, rows, 4, low=50, positives=2, negatives=2) == by_loops(rows, 4, 50, 2)
