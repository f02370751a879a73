import random

import pytest
from pyspark.sql import functions as F

from loanlake.llm import common
from text_fixtures import held_out, odd_rows, words  # noqa: F401


def test_words_match_the_pattern(spark, odd_rows, words):
    df = spark.createDataFrame([(k, r[1]) for k, r in enumerate(odd_rows)], "k long, t string")
    got = {r["k"]: r["w"] for r in df.select("k", common.words(common.lower_ascii(F.col("t"))).alias("w")).collect()}
    for k, row in enumerate(odd_rows):
        assert got[k] == words(row[1])


def test_remainder(spark, held_out):
    df = spark.createDataFrame([(k,) for k in [*range(50), None]], "id long")
    for row in df.select("id", common.crc_remainder(F.col("id"), 10).alias("r")).collect():
        assert (row["r"] == 0) == (row["id"] is None or held_out(row["id"], 10))


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    rng = random.Random(seed)
    nodes = rng.sample(range(10_000), 60)
    chain = list(zip(nodes[:25], nodes[1:26], strict=True)) if seed else []
    links = chain + [(rng.choice(nodes), rng.choice(nodes)) for _ in range(18)]
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in common.components(common.Scratch(spark, "t"), frame).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


def test_no_links(spark):
    frame = spark.createDataFrame([], "a long, b long")
    assert common.components(common.Scratch(spark, "t"), frame).count() == 0


def test_scratch_is_shared_and_dropped(spark):
    scratch = common.Scratch(spark, "t")
    stored = scratch.store(spark.range(5))
    assert spark.sparkContext.getCheckpointDir() in scratch.root and stored.count() == 5
    scratch.drop(stored)
    with pytest.raises(Exception):
        spark.read.parquet(stored._scratch_path).count()
