"""The operators made of column expressions: quotations, mixing, weak supervision."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loanlake.llm import mixing, quotations
from loanlake.llm import weak_supervision as weak
from text_fixtures import documents, odd_rows, words  # noqa: F401

# --- quotations ---------------------------------------------------------------------------


def messages(spark, rows):
    return spark.createDataFrame([(*r, "x", 9) for r in rows], "conv_id long, turn long, role string, text string, body string, depth int")


def brute_force_replies(rows):
    """Parents, bodies and positions by plain loops."""
    norm = lambda s: " ".join(s.lower().split())
    parsed, said = {}, defaultdict(list)
    for c, t, r, text in rows:
        lines = []
        for line in (text or "").split("\n"):
            marks = re.match(r"[ \t]*(?:>[ \t]*)+", line)
            lines.append((marks[0].count(">") if marks else 0, norm(line[marks.end():] if marks else line), line))
        parsed[c, t] = (r, lines)
        for level, content, _ in lines:
            if level == 0 and content:
                said[content].append((c, t))
    out = {}
    for (c, t), (r, lines) in parsed.items():
        own, linked, outside = [], 0, []
        for level, content, _ in lines:
            if level and content:
                inside = [u for d, u in said[content] if d == c]
                first = min(((d, u) for d, u in said[content] if d != c), default=None)
                if inside and min(inside) < t:
                    linked += 1
                    if level == 1:
                        own.append(min(inside))
                elif first:
                    linked += 1
                    outside.append(first[0])
        before = [u for d, u in parsed if d == c and u < t]
        parent = max(own) if own else max(before, default=None)
        body = "\n".join(line for level, _, line in lines if level == 0).strip(" \t\n\x0b\f\r")
        out[c, t] = [r, body, sum(level > 0 for level, _, _ in lines), max(level for level, _, _ in lines), linked, parent, min(outside, default=None)]
    depth = {}
    for c, t in sorted(out):
        parent = out[c, t][5]
        depth[c, t] = 0 if parent is None else depth[c, parent] + 1
    for c in {c for c, _ in out}:
        order = sorted((t for d, t in out if d == c), key=lambda t: (depth[c, t], t))
        for k, t in enumerate(order, 1):
            out[c, t] += [depth[c, t], k]
    return out


@pytest.mark.parametrize(("seed", "block"), [(0, 4096), (1, 3), (2, 2)])
def test_replies_against_loops(spark, monkeypatch, seed, block):
    monkeypatch.setattr(quotations, "BLOCK", block)
    rng = random.Random(seed)
    rows = []
    for c in range(12):
        told = []
        for t in sorted(rng.sample(range(20), rng.randint(1, 9))):
            lines = [rng.choice(["Yes.", f"Line {rng.randrange(40)}  of\ttext", f"own {c} {t} {k}"]) for k in range(rng.randint(0, 4))]
            for _ in range(rng.randint(0, 3)):
                marks = rng.choice(["> ", ">", ">> ", "> > ", " >\t"])
                source = rng.choice(told) if told and rng.random() < 0.7 else f"LINE {rng.randrange(40)} of text"
                lines.insert(rng.randint(0, len(lines)), marks + source)
            rows.append((c, t, "user", "\n".join(lines)))
            told += [x for x in lines if x and ">" not in x]
    expected = brute_force_replies(rows)
    got = quotations.reply_order(spark, messages(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        found = [r["role"], r["body"], r["n_quoted"], r["max_level"], r["n_linked"], r["parent_turn"], r["quoted_conv"], r["depth"], r["position"]]
        assert found == expected[r["conv_id"], r["turn"]]


def test_odd_messages(spark):
    rows = [
        (1, 1, "user", None), (1, 1, "user", None), (1, 2, None, ""), (None, 3, "user", "> a"), (2, None, "user", "b"), (1, 9, "user", ">"),
        (3, 1, "user", "> b\n>> a\nlong " * 3000),
    ]
    got = quotations.reply_order(spark, messages(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sorted(r["position"] for r in got if r["conv_id"] == 1) == [1, 2, 3, 4]
    assert all((r["parent_turn"], r["depth"], r["position"]) == (None, 0, 1) for r in got if r["conv_id"] is None or r["turn"] is None)
    assert quotations.reply_order(spark, messages(spark, [])).collect() == []


# --- mixing -------------------------------------------------------------------------------


def brute_force_targets(sizes):
    """Share by weight, stop at twice the source, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    rest, closed = 1.5 * sum(sizes.values()), set()
    while rest > 1e-9 and len(closed) < len(names):
        unit = rest / sum(weight[s] for s in names if s not in closed)
        for s in names:
            if s not in closed:
                target[s] += unit * weight[s]
        rest = 0.0
        for s in names:
            if target[s] > 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
            if target[s] >= 2 * sizes[s]:
                closed.add(s)
    return target


def mix_rows(seed):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", None, "src10", "src2"]
    rows = [(k, " ".join("w" for _ in range(rng.randrange(60))), rng.choice(["b"] * 5 + sources)) for k in range(500)]
    return rows + [(1000, "w " * 4000, "a"), (1001, None, "b"), (1002, "", None)]


@pytest.mark.parametrize(("seed", "blocks"), [(0, 4096), (1, 64), (2, 7)])
def test_targets_and_taken_words(spark, documents, words, seed, blocks):
    rows = mix_rows(seed)
    got = mixing.allocate(spark, documents(rows), blocks=blocks).collect()
    assert len(got) == len(rows)
    sizes, source = Counter(), {}
    for d, t, s in rows:
        sizes[s] += len(words(t))
        source[d] = s
    target, taken = brute_force_targets(sizes), Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(p["words"] for p in r["passes"])
        assert len({p["epoch"] for p in r["passes"]}) == len(r["passes"])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    again = mixing.allocate(spark, documents(list(reversed(rows))).repartition(5), blocks=blocks).collect()
    assert sorted((r["doc_id"], r["taken"], str(r["passes"])) for r in again) == sorted((r["doc_id"], r["taken"], str(r["passes"])) for r in got)


def test_quotas_are_split_exactly(spark):
    passes = spark.createDataFrame([(s, r) for s, n in (("sa", 100), ("sb", 7), ("n", 21)) for r in range(1, n + 1)], "__key string, rank long")
    got = mixing.split_quotas(passes, 3, 5).collect()
    assert sorted((r["__key"], r["rank"]) for r in got) == sorted((r["__key"], r["rank"]) for r in passes.collect())
    per_shard = Counter(r["shard"] for r in got)
    assert set(per_shard) == set(range(8)) and max(per_shard.values()) - min(per_shard.values()) <= 1


def test_shards_hold_the_quotas_of_the_tree(spark, documents):
    """Every pass of a document lies in one shard, and the shards are as large as the tree splits them."""
    rows = [(k, " ".join("w" for _ in range(20)), f"s{k % 3}") for k in range(600)]
    got = mixing.allocate(spark, documents(rows), blocks=64, levels=2).collect()
    shards = Counter(p["shard"] for r in got for p in r["passes"])
    words = Counter()
    for r in got:
        for p in r["passes"]:
            words[p["shard"]] += p["words"]
    assert set(shards) == {0, 1, 2, 3} and sum(words.values()) == sum(r["taken"] for r in got)
    assert max(words.values()) < 1.5 * min(words.values())


def test_splits_follow_the_hypergeometric_distribution(spark):
    """Mean and variance of one half's quota over many seeds."""
    passes = spark.createDataFrame([("sa", r) for r in range(1, 13)] + [("sb", r) for r in range(1, 9)], "__key string, rank long").cache()
    left = [mixing.split_quotas(passes, 1, seed).filter("shard = 0 AND __key = 'sa'").count() for seed in range(40)]
    mean = sum(left) / len(left)
    variance = sum((x - mean) ** 2 for x in left) / len(left)
    assert abs(mean - 6) < 0.6 and 0.5 < variance < 2.4  # 6 and 1.26


def test_mixed_documents(spark, documents):
    rows = mix_rows(3)
    docs = documents(rows)
    mixed = mixing.mixed_documents(spark, docs)
    assert mixed.columns == docs.columns
    taken = {r["doc_id"]: r for r in mixing.allocate(spark, docs).collect()}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    for d, r in taken.items():
        assert copies[d] == sum(2 * p["words"] >= r["size"] for p in r["passes"])


def test_odd_documents(spark, documents, odd_rows):
    got = mixing.allocate(spark, documents(odd_rows)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.allocate(spark, documents([])).collect() == []
    assert mixing.mixed_documents(spark, documents([])).collect() == []
    nothing = mixing.allocate(spark, documents([(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in nothing] == [(0, 0, 0.0)] * 2


# --- weak supervision ---------------------------------------------------------------------


def brute_force_statistics(text, word=re.compile(r"[^\x20\x09-\x0D]+")):
    text = text or ""
    found = word.findall(text)
    windows = [tuple(found[k : k + 8]) for k in range(len(found) - 7)]
    counts, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(k, k + 8))
    lines = [line for line in text.split("\n") if word.search(line)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def junk(rng, k):
    words = [rng.choice(["the", "of", "and", f"word{rng.randrange(900)}", f"thing{rng.randrange(900)}"]) for _ in range(rng.randint(40, 200))]
    kind = k % 4
    if kind == 1:
        return " ".join(w + rng.choice(["%%%", "###", "&&&"]) + "zzz" for w in words), False
    if kind == 2:
        return "\n".join(" ".join(words[:30]).upper() + "!!" for _ in range(4)), False
    return " ".join(words[:20]) + "\n" + " ".join(words[20:]), True


def test_statistics_against_loops(spark, documents, odd_rows):
    rng = random.Random(1)
    rows = [(10 + k, junk(rng, k)[0], "a") for k in range(40)]
    repeated = " ".join(["a b c d e f g h i j"] * 3)
    rows += [(60, repeated, "a"), (61, "x " * 9, "a"), (62, "x " * 15, "a"), (63, " ".join(map(str, range(8))), "a"), (64, "a\n\na\n \na", "a")] + odd_rows
    got = weak.quality_verdicts(spark, documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        found = tuple(r[c] for c in weak.STATISTICS)
        assert found == brute_force_statistics(r["text"])
        assert r["base_failed"] == (found[0] < 20 or 100 * found[4] > 30 * found[0])
        assert not (r["base_failed"] and r["kept"])


def test_verdicts_find_junk(spark, documents):
    rng = random.Random(2)
    made = [junk(rng, k) for k in range(400)]
    got = weak.quality_verdicts(spark, documents([(k, t, "a") for k, (t, _) in enumerate(made)]), carry=["doc_id"]).collect()
    assert sum(r["kept"] == made[r["doc_id"]][1] for r in got) >= 396


def test_clean_corpora_stay(spark, documents):
    rng = random.Random(3)
    rows = [(k, junk(rng, 0)[0], "a") for k in range(100)]
    assert all(r["kept"] for r in weak.quality_verdicts(spark, documents(rows)).collect())


def test_accuracies_are_found():
    """Votes drawn from known accuracies give posteriors that know the classes."""
    rng = random.Random(4)
    patterns, truth = Counter(), Counter()
    for _ in range(4000):
        good = rng.random() < 0.8
        votes = tuple(0 if rng.random() < 0.3 else (1 if (rng.random() < a) == good else -1) for a in (0.95, 0.9, 0.85, 0.8))
        patterns[votes] += 1
        truth[votes, good] += 1
    prior, weights = weak.fit_accuracies(sorted(patterns.items()))
    right = sum(truth[v, weak.posterior_odds(v, prior, weights) >= 0] for v in patterns)
    assert right / 4000 > 0.93 and abs(prior - 1.386) < 0.35
    assert weights[0][1] > weights[3][1] > 0 > weights[3][-1] > weights[0][-1]


def test_keep_quality(spark, documents, odd_rows):
    docs = documents(odd_rows + [(70 + k, junk(random.Random(k), 0)[0], "a") for k in range(5)])
    kept = weak.keep_quality(spark, docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {70, 71, 72, 73, 74}
    assert weak.keep_quality(spark, documents([])).collect() == []


def test_no_python_in_the_plans(spark, documents):
    docs = documents(mix_rows(0)[:50])
    talk = messages(spark, [(1, 1, "user", "a"), (1, 2, "user", "> a\nb")])
    for df in (mixing.mixed_documents(spark, docs), weak.quality_verdicts(spark, docs), quotations.reply_order(spark, talk)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert F is not None
