"""Pairs of the one-mode projections: neither ordered where no order is kept nor dealt once per block."""

import random
from collections import defaultdict

import pyarrow as pa
import pytest
from conftest import SMALL

from loanlake.operators import network
from loanlake.plans import file_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_the_network_report_do_not_order_pairs(spark):
    assert "rangepartitioning(weight#" not in plan(file_queries.network_tables(spark, SMALL))
    links = spark.createDataFrame([("a", "s", 1.0), ("b", "s", 2.0), ("c", "s", 5.0)], "originator_key string, sponsor_key string, weight double")
    ordered, plain = (network.projections(links, ordered=x)["originator_projection"].collect() for x in (True, False))
    assert [r["weight"] for r in ordered] == [3.5, 3.0, 1.5] and sorted(ordered) == sorted(plain)


def plain_pairs(links):
    by_hub = defaultdict(list)
    for u, hub, w in links:
        by_hub[hub].append((u, w))
    pairs = defaultdict(float)
    for members in by_hub.values():
        for u, w in members:
            for v, x in members:
                if u < v:
                    pairs[u, v] += (w + x) / 2
    return dict(pairs)


@pytest.mark.parametrize("square, block", [(1, 8), (3, 8), (32, 8), (32, 1000)])
def test_blocks_that_meet_in_squares(spark, monkeypatch, square, block):
    rng = random.Random(7)
    links = [(f"o{i}", f"s{j}", float(rng.randrange(9))) for i in range(120) for j in rng.sample(range(6), 3)]
    table = spark.createDataFrame(links, "originator_key string, sponsor_key string, weight double")
    monkeypatch.setattr(network, "SQUARE", square)
    got = network.projection(table, block=block).collect()
    assert {(r["source"], r["target"]): r["weight"] for r in got} == pytest.approx(plain_pairs(links))
    assert len(got) == len({(r["source"], r["target"]) for r in got})


def test_a_block_is_not_copied_for_every_other_block(spark, monkeypatch):
    def copies(side):
        def run(batches):
            for batch in batches:
                names = pa.array(["x"] * batch.num_rows)
                yield pa.RecordBatch.from_arrays([names, names, pa.array([1.0] * batch.num_rows)], ["source", "target", "weight"])

        return run

    monkeypatch.setattr(network, "_meet", copies)
    links = spark.range(4000).selectExpr("concat('o', id) AS originator_key", "concat('s', id % 4) AS sponsor_key", "1.0D AS weight")
    # 400 blocks, which were copied 400 times each.
    assert network.projection(links, block=10).count() < 400 * 40
