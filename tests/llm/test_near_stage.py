"""The near-duplicate stage of the pipeline against all pairs at 0.8."""

import random

import corpus_pipeline
from test_near_duplicates import shingles
from text_fixtures import documents, words  # noqa: F401


def test_stage_takes_copies_from_a_similarity_of_four_fifths(spark, documents, words):
    rng = random.Random(9)
    rows, between = [], 0
    for length in (44, 46, 50, 55, 60, 64, 80):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
            copy = list(base)
            copy[length // 2] = "other"
            rows += [(len(rows), " ".join(base), "a"), (len(rows) + 1, " ".join(copy), "a")]
    expected = []
    for k in range(0, len(rows), 2):
        a, b = (shingles(words(text)) for _, text, _ in rows[k : k + 2])
        both, either = len(a & b), len(a | b)
        between += 80 * either <= 100 * both < 85 * either
        expected += [k] if 100 * both >= 80 * either else [k, k + 1]
    assert between >= 9
    kept = corpus_pipeline.near_duplicates(spark, documents(rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == expected
