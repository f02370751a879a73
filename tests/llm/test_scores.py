"""The suffix tree and the toxicity classifier."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from loanlake.llm import ftrl
from loanlake.llm import suffix_tree as tree
from text_fixtures import documents, held_out, odd_rows, words  # noqa: F401


def brute_force_base(rows, words, held_out):
    counts = Counter()
    for d, t, *_ in rows:
        if d is not None and not held_out(d, 10):
            counts.update([*words(t), None])
    total = sum(counts.values())
    scale = total + 0.1 * (len(counts) + 1)
    out = []
    for _, t, *_ in rows:
        tokens = [*words(t), None]
        out.append((len(tokens), sum(counts[w] > 0 for w in tokens), total, sum(math.log10((counts[w] + 0.1) / scale) for w in tokens)))
    return out


def chained(rng, n, length=80):
    """Texts of two languages; words follow their predecessor."""
    rows = []
    for k in range(n):
        side = k % 2
        text = [f"{'xy'[side]}{rng.randrange(30)}" for _ in range(length)]
        for j in range(1, length):
            if rng.random() < 0.5:
                text[j] = text[j - 1] + "z" if not text[j - 1].endswith("z") else text[j]
        rows.append((k, " ".join(text), "a"))
    return rows


def test_base_scores(spark, documents, odd_rows, words, held_out, monkeypatch):
    monkeypatch.setattr(tree, "KNOWN", 400)
    rows = chained(random.Random(0), 60) + [(100 + k, r[1], r[2]) for k, r in enumerate(odd_rows)] + odd_rows
    got = tree.score_documents(spark, documents(rows)).collect()
    expected = brute_force_base(rows, words, held_out)
    key = lambda x: (x[0], x[1], x[2], round(x[3], 5))
    found = [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got]
    assert sorted(map(key, found)) == sorted(map(key, expected))
    assert all(r["held_out"] == (r["doc_id"] is None or held_out(r["doc_id"], 10)) and math.isfinite(r["score"]) for r in got)


def test_contexts_help_on_held_out_texts(spark, documents):
    got = tree.score_documents(spark, documents(chained(random.Random(1), 600))).collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 30 and all(r["score"] > r["base_score"] + 0.1 * r["n_tokens"] for r in held)


def test_no_structure_means_base_scores(spark, documents):
    rng = random.Random(2)
    rows = [(k, " ".join(f"w{rng.randrange(40)}" for _ in range(100)), "a") for k in range(200)]
    for r in tree.score_documents(spark, documents(rows)).collect():
        assert abs(r["score"] - r["base_score"]) < 0.05 * r["n_tokens"]


def test_probabilities_sum_to_one(spark, documents):
    docs = documents(chained(random.Random(3), 400)).selectExpr("CAST(text AS binary) AS text")
    grown, _ = tree.grow(spark, docs, tree.Scratch(spark, "t"))
    assert [len(c.keys) > 0 for c in grown.contexts] == [True, True]
    symbols = np.arange(grown.end + 1)
    for depth in (0, 1, 2):
        for context in [0] if not depth else range(0, len(grown.contexts[depth - 1].keys), 7):
            probs = grown.prob(depth, np.full(len(symbols), context), symbols)
            # Unused numbers stand for no word and have no probability.
            assert abs(probs.sum() - 1) < 1e-6 and (probs >= 0).all()


def test_scores_follow_the_longest_kept_context(spark, documents):
    """Line by line against a plain walk over the same tree."""
    rows = chained(random.Random(4), 300)
    docs = documents(rows).selectExpr("CAST(text AS binary) AS text")
    grown, _ = tree.grow(spark, docs, tree.Scratch(spark, "t"))
    texts = [t.lower().encode().split() for _, t, _ in rows[:5]]
    line = grown.symbols(tree._ranks(grown, texts)[0])
    got = grown.gains(line)
    index = [{int(c): k for k, c in enumerate(level.keys)} for level in grown.contexts]
    for at in range(1, len(line)):
        expected = 0.0
        for depth in (2, 1):
            if at < depth or (depth == 2 and line[at - 1] == grown.end):
                continue
            packed = 0
            for s in line[at - depth : at]:
                packed = (packed << tree.BITS) | int(s)
            if packed in index[depth - 1]:
                p = grown.prob(depth, np.array([index[depth - 1][packed]]), line[at : at + 1])[0]
                expected = math.log10(p / grown.root[line[at]])
                break
        assert got[at - 1] == pytest.approx(expected)


def test_all_that_passes_the_tests_decides(spark, documents, monkeypatch):
    """Scores do not depend on how much of the tree is broadcast."""
    rows = chained(random.Random(8), 300)
    whole = {r["doc_id"]: r["score"] for r in tree.score_documents(spark, documents(rows)).collect()}
    for contexts, entries in ((100_000, 30), (7, 400_000), (7, 30), (0, 0)):
        for name, limit in (("CONTEXTS", contexts), ("ENTRIES", entries)):
            for prefix in ("MAX", "HELD"):
                monkeypatch.setattr(tree, f"{prefix}_{name}", limit, raising=False)
        got = tree.score_documents(spark, documents(rows)).collect()
        assert len(got) == len(rows)
        assert all(r["score"] == pytest.approx(whole[r["doc_id"]], abs=1e-6) for r in got)


def test_places():
    rng = np.random.default_rng(7)
    keys = np.unique(rng.integers(0, 2**45, 5000))
    places = tree.Places(keys)
    values = np.concatenate([keys[::3], rng.integers(0, 2**45, 2000)])
    index = {int(k): i for i, k in enumerate(keys)}
    assert places.find(values).tolist() == [index.get(int(v), -1) for v in values]
    assert tree.Places(np.empty(0, np.int64)).find(values[:3]).tolist() == [-1] * 3


def test_empty_tables(spark, documents):
    assert tree.score_documents(spark, documents([])).collect() == []
    alone = tree.score_documents(spark, documents([(None, "held out only", "a")])).collect()
    assert alone[0]["train_tokens"] == 0 and alone[0]["base_score"] == alone[0]["score"] == 0.0


def toxic_corpus(rng, n=900):
    plain, rude = [f"w{k}" for k in range(400)], ["idiot", "scum", "moron", "loser"]
    rows, labels = [], []
    for k in range(n):
        text = [rng.choice(plain) for _ in range(60)]
        toxic = k % 5 == 0
        for _ in range(3 if toxic else 0):
            text[rng.randrange(60)] = rng.choice(rude) + rng.choice(["", "!", ",", "###"])
        rows.append((k, " ".join(text), "a"))
        labels.append((k, int(toxic)))
    return rows, labels


def test_learner_against_plain_loops():
    """Weights after some steps, coordinate by coordinate."""
    rng = np.random.default_rng(3)
    bits, drawn = 6, [np.unique(rng.integers(0, 64, 9)).astype(np.int32) for _ in range(400)]
    steps = [(at, float(at[0] < 6)) for at in drawn]
    learner = ftrl.Learner(bits)
    z, n = [0.0] * 65, [0.0] * 65

    def weight(k):
        l1 = 0.0 if k == 64 else ftrl.L1
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((ftrl.BETA + math.sqrt(n[k])) / ftrl.ALPHA + ftrl.L2)

    for at, label in steps:
        learner.learn(at, label)
        own = [*at.tolist(), 64]
        w = {k: weight(k) for k in own}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for k in own:
            rate = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / ftrl.ALPHA
            z[k] += g - rate * w[k]
            n[k] += g * g
    assert learner.weights(np.arange(65)) == pytest.approx([weight(k) for k in range(65)])
    assert any(learner.weights(np.arange(64)))


def test_features_are_words_stems_and_pairs():
    """Equal words, neighbours and skips give equal numbers wherever they stand; each counts once."""
    some, more = (set(ftrl.features(t).tolist()) for t in (b"Alpha beta gamma", b"x alpha, BETA gamma! alpha beta gamma"))
    assert some < more and len(ftrl.features(b"Alpha beta gamma")) == len(some)
    assert len(some) == 3 + 2 + 2 + 1  # words, stems of alpha and gamma, neighbours, a pair with a word between
    assert not len(ftrl.features(b"")) and not len(ftrl.features(None)) and not len(ftrl.features(b" .,! "))


def test_held_out_accuracy(spark, documents, held_out):
    rows, labels = toxic_corpus(random.Random(5))
    marks = spark.createDataFrame([(d, 1, t, "x") for d, t in labels if d % 3], "doc_id long, quality int, toxic int, text string")
    docs = documents(rows)
    weights = ftrl.fit(spark, docs, marks)
    assert 0 < (weights != 0).sum() < 2000
    truth = dict(labels)
    scored = ftrl.score(spark, docs, weights).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    held = [(truth[r["doc_id"]], r["score"] >= 0.5) for r in scored if held_out(r["doc_id"], 5)]
    assert np.mean([a == b for a, b in held]) > 0.97
    kept = ftrl.drop_toxic(spark, docs, marks)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored if r["score"] < 0.5}


def test_labels_of_the_held_out_fold_are_not_used(spark, documents, held_out):
    rows, labels = toxic_corpus(random.Random(6), 300)
    frame = lambda flip: spark.createDataFrame(
        [(d, (1 - t) if flip and held_out(d, 5) else t) for d, t in labels], "doc_id long, toxic int"
    )
    assert (ftrl.fit(spark, documents(rows), frame(False)) == ftrl.fit(spark, documents(rows), frame(True))).all()


def test_odd_rows(spark, documents, odd_rows):
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 1), (4, 0), (5, 0), (99, 1)], "doc_id long, toxic int")
    docs = documents(odd_rows)
    scored = ftrl.score(spark, docs, ftrl.fit(spark, docs, labels)).collect()
    assert len(scored) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in scored)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in ftrl.score(spark, docs, ftrl.fit(spark, docs, none)).collect()} == {0.5}
    assert ftrl.score(spark, documents([]), ftrl.fit(spark, docs, none)).collect() == []
