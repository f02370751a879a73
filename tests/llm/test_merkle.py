"""The manifest against loops over lists, and proofs against tampering."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loanlake.llm import common, merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path int, root double"


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row)


def tree(nodes):
    """The root of a list of digests and the runs above every leaf."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        for path, place in zip(paths, places, strict=True):
            path.append((runs[place // 16], place % 16))
        places, nodes = [p // 16 for p in places], [digest(r) for r in runs]
    return (nodes[0] if nodes else None), paths


def by_loops(rows, tampered):
    first = lambda x: (x is not None, x if x is not None else 0)
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for name in names:
        own = sorted(by_source[name], key=lambda r: (first(r[0]), leaf_of(r)))
        done[name] = own, *tree([leaf_of(r) for r in own])
    root, above = tree([done[n][1] for n in names])
    out = []
    for name, up in zip(names, above, strict=True):
        own, subroot, paths = done[name]
        for row, path in zip(own, paths, strict=True):
            full, changed = path + up, list(row)
            if tampered(row[0]) and row[4] is not None:
                changed[4] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])
            node = leaf_of(changed)
            for run, place in full:
                node = digest([*run[:place], node, *run[place + 1 :]])
            proof = digest(x for run, place in full for k, x in enumerate(run) if k != place)
            out.append((row[0], leaf_of(row), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def built(spark, rows):
    frame = spark.createDataFrame([(*r, "old", 1, 2.0) for r in rows], SCHEMA)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(changed, common.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    found = merkle.manifest(spark, frame, fields=FIELDS, by="source", order="doc_id", claims={"text": text})
    assert found.columns == ["doc_id", "source", "leaf", "subroot", "root", "path", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.drop("source", "path").collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [16, 17], [1, 2, 15, 33, 256, 257], [5] * 20])
def test_matches_loops(spark, sizes):
    draw = random.Random(4)
    rows = [
        (k * 100_000 + draw.randrange(1000) * 1000 + i, f"s{k}", draw.choice(["en", "es"]), i, f"Some TEXT {i} é" if i % 3 else "no capitals")
        for k, size in enumerate(sizes)
        for i in range(size)
    ]
    draw.shuffle(rows)
    assert built(spark, rows) == by_loops(rows, tampered)


def test_several_blocks_and_rollups(spark, monkeypatch):
    """Blocks of one digit, so that a tree of 300 needs three rollups; the full block size beyond 4,096 leaves."""
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", "en", 1, f"Text {i}") for i in range(450)]
    expected = by_loops(rows, tampered)
    monkeypatch.setattr(merkle, "DIGITS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    assert built(spark, rows) == expected
    monkeypatch.undo()
    rows = [(i, "hot", "en", 1, "T") for i in range(4200)]
    assert built(spark, rows) == by_loops(rows, tampered)


def test_odd_rows(spark):
    """Null in every column, empty and long texts, repeated rows and ids, a null source beside an empty one, no digits of a name lost."""
    rows = [
        (None, None, None, None, None), (None, "a", "en", 1, "X"), (1, "a", "en", None, ""), (1, "a", "en", None, ""),
        (1, "a", "es", None, ""), (2, "", None, 3, "B" * 300_000), (3, None, "en", 3, "\U0001f600É\x00Z"), (-7, "é", "en", 1, "A:-"),
        (4, "Z", "en", 1, None), (5, "z", "en", 1, "-"), (10**17, "a", "en", 1, "LAST"),
    ]
    got = built(spark, rows)
    assert got == by_loops(rows, tampered) and len(got) == len(rows)


def test_empty(spark):
    assert built(spark, []) == []


def test_claims_are_found(spark):
    """A changed field, a swapped pair and a changed id all miss the root; true claims reach it."""
    rows = spark.createDataFrame([(i, "a", "en", 1, f"t{i}", None, None, None) for i in range(40)], SCHEMA)
    for name, claim, wrong in (
        ("text", F.lit("t3"), 39), ("n_chars", F.when(F.col("doc_id") == 7, 2).otherwise(F.col("n_chars")), 1), ("lang", F.col("lang"), 0),
    ):
        found = merkle.manifest(spark, rows, fields=FIELDS, by="source", order="doc_id", claims={name: claim})
        assert found.filter("NOT verified").count() == wrong
    whole = merkle.manifest(spark, rows, fields=FIELDS, by="source", order="doc_id")
    assert whole.filter("verified").count() == 40 and whole.select("root").distinct().count() == 1


def test_one_exchange_for_a_rollup(spark):
    """The digits of a block are grouped away without another exchange."""
    nodes = spark.range(100).select(
        (F.col("id") % 2).cast("string").alias("tree"), (F.col("id") % 2 + 50).alias("m"), F.floor(F.col("id") / 2).alias("rank"),
        F.lit("x").alias("hash"), F.struct("id").alias("item"),
    )
    plan = merkle._blocks(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_query_reads_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r[c] for c in FIELDS) for r in docs.collect()]
    found = queries.QUERIES["op12_merkle_manifest"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, found.collect()), key=str) == by_loops(rows, tampered)
