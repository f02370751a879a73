import random

import numpy as np
import pytest

from loanlake.llm import hyperminhash as hm
from text_fixtures import documents, odd_rows, words  # noqa: F401


def shingles(words):
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def brute_force(rows, words):
    """Component of every id by comparing all pairs."""
    sets = {}
    for d, t, *_ in rows:
        if d is not None:
            sets.setdefault(d, set()).update(shingles(words(t)))
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {d: root(d) for d in sets}, {d: len(s) for d, s in sets.items()}


def family(rng, base, n, edits):
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        yield copy


@pytest.mark.parametrize(("seed", "low"), [(0, 512), (1, 512), (2, 24), (3, 24)])
def test_against_all_pairs(spark, documents, words, monkeypatch, seed, low):
    """Families of edited copies around the threshold; with few low hashes most pairs go to the full sets."""
    monkeypatch.setattr(hm, "LOW", low)
    monkeypatch.setattr(hm, "BLOCK", 16)
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for length, n, edits in ((150, 60, 7), (40, 30, 2), (9, 20, 1), (400, 25, 14)):
        base = [rng.choice(vocabulary) for _ in range(length)]
        rows += [(len(rows) + k, " ".join(c), "a") for k, c in enumerate(family(rng, base, n, edits))]
    rng.shuffle(rows)
    expected, sizes = brute_force(rows, words)
    got = hm.near_duplicates(spark, documents(rows)).collect()
    assert {r["id"]: r["component_id"] for r in got} == expected
    assert all(r["n_shingles"] == sizes[r["id"]] and r["kept"] == (r["id"] == expected[r["id"]]) for r in got)


def test_odd_rows(spark, documents, odd_rows, words):
    got = hm.near_duplicates(spark, documents(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    by_id = {r["id"]: r for r in got}
    assert by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == 0
    assert all(by_id[d]["component_id"] == d for d in (1, 2, 3, 4, 5, 6, 7))
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    kept = hm.keep_one_of_each(spark, documents(odd_rows))
    assert kept.columns == documents(odd_rows).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]


def test_empty_table(spark, documents):
    assert hm.near_duplicates(spark, documents([])).collect() == []
    assert hm.keep_one_of_each(spark, documents([])).collect() == []


def test_copies_of_any_case_are_one(spark, documents):
    rows = [(k, "The SAME five word text again" if k % 2 else "the same\tfive  word text again", "a") for k in range(40)]
    got = hm.near_duplicates(spark, documents(rows)).collect()
    assert {r["component_id"] for r in got} == {0}


def test_estimate_is_close():
    rng = np.random.default_rng(0)
    errors = []
    for share in (0.5, 0.7, 0.85, 0.95):
        for _ in range(40):
            pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
            both = int(4000 * share)
            rest = (4000 - both) // 2
            a = np.unique(np.concatenate([pool[:both], pool[both : both + rest]]))
            b = np.unique(np.concatenate([pool[:both], pool[both + rest :]]))
            x, y = hm.registers(a)[None], hm.registers(b)[None]
            found, used = hm.estimate(x, y, np.array([len(a)]), np.array([len(b)]))
            errors.append((found[0] - share) / np.sqrt(share * (1 - share) / used[0]))
    assert abs(np.mean(errors)) < 0.3 and np.max(np.abs(errors)) < 5


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 400, 100)).astype(np.uint64) for _ in range(30)]
    got = hm.common_counts(sets[:12], sets)
    assert all(got[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist())) for i in range(12) for j in range(30))
