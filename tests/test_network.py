"""Network operators against plain loops on small graphs."""

import heapq
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from loanlake import schemas as s
from loanlake.operators import network
from loanlake.operators.betweenness import betweenness
from loanlake.plans.reports import network_tables

COLUMNS = (
    f"`{s.YEAR}` smallint, `{s.ORIG_NO}` int, `{s.ORIG}` string, `{s.SPONSOR_NO}` int, `{s.SPONSOR}` string, "
    f"`{s.AMOUNT}` bigint"
)


def loans(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def edge_frame(spark, links):
    """Merged edges from (originator, sponsor, weight)."""
    return spark.createDataFrame(links, "originator_key string, sponsor_key string, weight double")


def random_links(seed, originators=9, sponsors=6, p=0.4, weights=(1, 2, 3)):
    rnd = random.Random(seed)
    return [
        (f"o{i}", f"s{j}", float(rnd.choice(weights)))
        for i in range(originators)
        for j in range(sponsors)
        if rnd.random() < p
    ]


def test_edges(spark):
    rows = [
        (2020, 1, "A", 9, "S", 100), (2021, 1, "A", 9, "S", 300), (2021, 1, "A", 9, "S", None),
        (2021, None, "B", None, "T", 50), (2021, 2, "C", 9, None, 1), (2021, 3, None, 9, "S", 1),
    ]
    got = rows_of(network.ranked_edges(network.edges(loans(spark, rows))))
    assert got == [
        ("1", "A", 1, "9", "S", 9, 3, 400, 200.0, 200.0, 2020, 2021),
        ("originator:B", "B", None, "sponsor:T", "T", None, 1, 50, 50.0, 50.0, 2021, 2021),
    ]
    assert network.edges(loans(spark, rows), min_loans=2).count() == 1
    assert [r["loan_count"] for r in network.edges(loans(spark, rows), start_year=2021).collect() if r[s.ORIG_NO]] == [2]
    assert network.edges(loans(spark, rows), end_year=2019).count() == 0


def test_renamed_pair_is_one_edge(spark):
    rows = [(2020, 1, "A", 9, "S", 100)] * 3 + [(2021, 1, "A LLC", 9, "S", 200)]
    table = network.edges(loans(spark, rows))
    assert table.count() == 2
    merged = network.graph_edges(table).first()
    assert (merged["loan_count"], merged["weight"], merged["total_volume"], merged["avg_loan_amount"]) == (4, 4.0, 500, 125.0)
    assert network.graph_edges(table, edge_merge="last").first()["weight"] == 1.0
    assert network.graph_edges(table, weight_col="total_volume").first()["weight"] == 500.0
    with pytest.raises(ValueError):
        network.graph_edges(table, edge_merge="x")
    labels = {(r["side"], r["key"]): r["label"] for r in network.vertices(table).collect()}
    assert labels == {("originator", "1"): "A", ("sponsor", "9"): "S"}


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 2), (3, 1), (4, 3)])
@pytest.mark.parametrize("side", ["originator", "sponsor"])
def test_projection(spark, seed, block, side):
    links = random_links(seed)
    u, hub = (0, 1) if side == "originator" else (1, 0)
    expected = {}
    for a, b in combinations(links, 2):
        if a[hub] == b[hub]:
            pair = tuple(sorted((a[u], b[u])))
            expected[pair] = expected.get(pair, 0) + (a[2] + b[2]) / 2
    got = {(r["source"], r["target"]): r["weight"] for r in network.projection(edge_frame(spark, links), side, block=block).collect()}
    assert got == pytest.approx(expected)


def test_projection_shuffles_no_pairs_of_a_dense_network(spark):
    """Blocks of nodes return each pair once; the pairs of every hub were shuffled and added before."""
    got = network.projection(edge_frame(spark, random_links(5)))
    assert "HashAggregate" not in got._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]


@pytest.mark.parametrize("side", ["originator", "sponsor"])
def test_projection_paths_agree(spark, monkeypatch, side):
    """Sparse and dense paths, several groups of hubs, edges that come twice, weights that are missing."""
    links = [(f"{u}\u00e9" if u[-1] == "3" else u, v, None if v == "s1" else w) for u, v, w in random_links(7, 14, 11, p=0.3)]
    table = edge_frame(spark, links + links[:9])
    monkeypatch.setattr(network, "DENSE", 1e9)
    expected = sorted(rows_of(network.projection(table, side, block=4)))
    monkeypatch.setattr(network, "DENSE", 0.0)
    assert sorted(rows_of(network.projection(table, side, block=4))) == expected
    monkeypatch.setattr(network, "HUB_GROUP", 3)
    assert sorted(rows_of(network.projection(table, side, block=5))) == expected
    assert rows_of(network.projection(table.limit(0), side)) == []


@pytest.mark.parametrize("seed, k, seeds, block", [(1, 3, 4, 1024), (2, 5, 2, 2), (3, 1, 30, 1), (4, 10**4, 5, 3)])
@pytest.mark.parametrize("side", ["originator", "sponsor"])
def test_heaviest_pairs(spark, seed, k, seeds, block, side):
    """As the first rows of all pairs, with and without a bound from the seeds."""
    links = [(u, v, w + 1000.0 * (u[-1] == "1")) for u, v, w in random_links(seed)]
    table = edge_frame(spark, links)
    expected = network.projection(table, side).orderBy(F.desc("weight"), "source", "target").limit(k)
    assert rows_of(network.heaviest_pairs(table, k, side, seeds=seeds, block=block)) == rows_of(expected)


def test_heaviest_pairs_form_few_pairs(spark):
    """A hub of 2,000 light and 20 heavy members: none of two million light pairs is formed."""
    light, heavy = ([(f"{n}{i}", "hub", w + i) for i in range(m)] for n, m, w in (("l", 2000, 1.0), ("h", 20, 1e6)))
    found = network.heaviest_pairs(edge_frame(spark, light + heavy), 3, seeds=20)
    assert rows_of(found)[0] == ("h18", "h19", 1e6 + 18.5)
    listed = found._jdf.queryExecution().optimizedPlan().toString()
    assert "whole" in listed and ">= " in listed
    with pytest.raises(Exception, match="negative weight"):
        network.heaviest_pairs(edge_frame(spark, [("a", "n", -1.0), ("b", "n", 1.0)]), 1).collect()
    assert rows_of(network.heaviest_pairs(edge_frame(spark, [("a", "n", 1.0)]).limit(0), 3)) == []


def test_projection_example(spark):
    got = network.projection(edge_frame(spark, [("u", "n", 2.0), ("v", "n", 4.0)]))
    assert rows_of(got) == [("u", "v", 3.0)]
    with pytest.raises(ValueError):
        network.projection(edge_frame(spark, [("u", "n", 2.0)]), "x")


def all_paths_betweenness(links):
    """Betweenness by counting: for every pair, shortest paths through every node."""
    graph = {}
    for a, b, w in links:
        graph.setdefault(a, {})[b] = w
        graph.setdefault(b, {})[a] = w
    nodes = sorted(graph)
    dist, count = {}, {}
    for src in nodes:
        d, heap = {src: 0.0}, [(0.0, src)]
        while heap:
            x, u = heapq.heappop(heap)
            if x > d[u]:
                continue
            for v, w in graph[u].items():
                if x + w < d.get(v, float("inf")):
                    d[v] = x + w
                    heapq.heappush(heap, (x + w, v))
        n = {src: 1}
        for v in sorted(d, key=d.get)[1:]:
            n[v] = sum(n[u] for u, w in graph[v].items() if u in n and d[u] + w == d[v])
        for v in d:
            dist[src, v], count[src, v] = d[v], n[v]
    size = len(nodes)
    scale = 1 / ((size - 1) * (size - 2))
    return {
        m: scale
        * sum(
            count[a, m] * count[m, b] / count[a, b]
            for a in nodes
            for b in nodes
            if len({a, b, m}) == 3 and (a, b) in dist and (a, m) in dist and (m, b) in dist
            and dist[a, m] + dist[m, b] == dist[a, b]
        )
        for m in nodes
    }


@pytest.mark.parametrize("seed, p, per_core", [(1, 0.4, 10**7), (2, 0.2, 10**7), (5, 0.5, 9)])
def test_betweenness(spark, seed, p, per_core):
    """Against all paths, also in several batches of sources."""
    links = random_links(seed, 6, 4, p=p)
    adjacent = network.adjacency(edge_frame(spark, links), merge_shared_ids=True)
    got = dict(rows_of(betweenness(adjacent, state_rows_per_core=per_core)))
    assert got == pytest.approx(all_paths_betweenness(links))


def test_betweenness_over_several_parts(spark):
    """Paths that change parts many times, and blocks that do not divide the sources."""
    links = random_links(3, 8, 7, p=0.3)
    adjacent = network.adjacency(edge_frame(spark, links), merge_shared_ids=True)
    got = dict(rows_of(betweenness(adjacent, part_nodes=6, block_sources=4)))
    assert got == pytest.approx(all_paths_betweenness(links))


def test_betweenness_of_five_thousand_nodes_stores_no_rounds(spark, monkeypatch):
    """Chains of three through one hub: one part, without rounds; parts of 4,096 took rounds of stored rows before."""
    from loanlake.operators import betweenness as module

    monkeypatch.setattr(module, "_phase", lambda *a: pytest.fail("rounds over cells"))
    links = spark.range(5000).select(
        F.concat(F.lit("o"), "id").alias("originator_key"), F.lit("s").alias("sponsor_key"), F.lit(2.0).alias("weight")
    )
    got = betweenness(network.adjacency(links))
    assert got.count() == 5001
    assert {r["node"]: r["betweenness"] for r in got.filter("betweenness <> 0").collect()} == {"sponsor:s": pytest.approx(1.0)}


@pytest.mark.parametrize("block, per_core", [(4, 10**7), (3, 9)])
def test_betweenness_is_the_same_in_one_part_and_in_several(spark, block, per_core):
    links = random_links(11, 12, 7, p=0.3, weights=(1, 2, 5))
    adjacent = network.adjacency(edge_frame(spark, links), merge_shared_ids=True)
    one = dict(rows_of(betweenness(adjacent, block_sources=block)))
    assert one == pytest.approx(all_paths_betweenness(links))
    assert one == pytest.approx(dict(rows_of(betweenness(adjacent, part_nodes=5, block_sources=block, state_rows_per_core=per_core))))


@pytest.mark.parametrize("seed, sponsors, p, block", [(1, 3, 0.7, 128), (2, 4, 0.3, 1), (3, 5, 0.15, 2)])
def test_betweenness_from_the_sources_of_a_cover(spark, monkeypatch, seed, sponsors, p, block):
    """Two sides of unlike sizes: only nodes of the smaller one are sources, also where parts of the network do not meet."""
    from loanlake.operators import betweenness as module

    monkeypatch.setattr(module, "_in_one_part", lambda *a: pytest.fail("every node is a source"))
    links = [*random_links(seed, 30, sponsors, p=p), ("alone", "far", 2.0), ("beside", "far", 1.0)]
    adjacent = network.adjacency(edge_frame(spark, links), merge_shared_ids=True)
    monkeypatch.setattr(module, "SHARE_VALUES", 4)
    got = dict(rows_of(betweenness(adjacent, block_sources=block)))
    assert got == pytest.approx(all_paths_betweenness(links))


def test_betweenness_with_weights_that_are_not_whole_takes_every_source(spark, monkeypatch):
    """Sums of fractions depend on their order, so paths are followed from their own sources."""
    from loanlake.operators import betweenness as module

    monkeypatch.setattr(module, "_over_cover", lambda *a: pytest.fail("distances put together"))
    links = random_links(4, 20, 3, p=0.6, weights=(0.5, 1.0, 1.5))
    adjacent = network.adjacency(edge_frame(spark, links), merge_shared_ids=True)
    assert dict(rows_of(betweenness(adjacent))) == pytest.approx(all_paths_betweenness(links))


def test_betweenness_needs_positive_weights(spark):
    with pytest.raises(Exception, match="positive weights"):
        betweenness(network.adjacency(edge_frame(spark, [("a", "b", 0.0)]))).collect()


def test_network_tables(spark):
    rows = [
        (2020, 1, "A", 9, "S", 100), (2020, 2, "B", 9, "S", 100), (2020, 2, "B", 9, "S", 100),
        (2020, 2, "B", 8, "T", 100), (2020, 9, "S as lender", 8, "T", 100),
    ]
    out = network_tables(loans(spark, rows))
    assert sorted(out) == [
        "edges", "originator_centrality", "originator_projection", "sponsor_centrality", "sponsor_projection", "summary",
    ]
    originators = rows_of(out["originator_centrality"])
    assert [r[:6] for r in originators] == [
        ("2", "B", 2, 2, 3.0, 1.0), ("1", "A", 1, 1, 1.0, 0.5), ("9", "S as lender", 9, 1, 1.0, 0.5),
    ]
    # chain 1 - 9 - 2 - 8 - 9(lender): the middle node lies on 4 of 6 pairs
    assert originators[0][6] == pytest.approx(4 / 6)
    assert rows_of(out["sponsor_projection"]) == [("8", "9", 1.5)]
    summary = out["summary"].first()
    assert (summary["edge_count"], summary["originator_nodes"], summary["sponsor_nodes"]) == (4, 3, 2)
    assert summary["density"] == pytest.approx(0.4)


def test_merged_ids_share_a_node(spark):
    edges = edge_frame(spark, [("1", "1", 2.0), ("1", "2", 3.0), ("2", "1", 4.0)])
    got = {r["node"]: (r["degree"], r["weighted_degree"]) for r in network.degrees(network.adjacency(edges, merge_shared_ids=True)).collect()}
    assert got == {"1": (3, 9.0), "2": (1, 7.0)}
    apart = {r["node"]: r["degree"] for r in network.degrees(network.adjacency(edges)).collect()}
    assert apart == {"originator:1": 2, "originator:2": 1, "sponsor:1": 2, "sponsor:2": 1}
