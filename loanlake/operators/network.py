"""Originator-sponsor network."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import MEDIAN, median_of, order_statistics, ratio, sum0
from ..schemas import AMOUNT, ORIG, ORIG_NO, SPONSOR, SPONSOR_NO, YEAR
from ..sources.checkpoints import cut_lineage, drop

ORIGINATOR, SPONSOR_SIDE = "originator", "sponsor"
EDGE_KEYS = ["originator_key", ORIG, ORIG_NO, "sponsor_key", SPONSOR, SPONSOR_NO]
PAIR_BLOCK = 1024
SQUARE = 32  # blocks that a task holds twice at most
HUB_GROUP = 1024
#: Pairs over hubs, as a share of all pairs of nodes, from which blocks of nodes are compared.
DENSE = 1 / 8
PAIR_ROWS = 100_000  # of a batch
BANDS = 160  # of whole weights, eight for every halving


def edges(
    df: DataFrame, *, start_year: int | None = None, end_year: int | None = None, min_loans: int = 1
) -> DataFrame:
    """Loan counts, amounts and years of every originator-sponsor relation."""
    if start_year is not None:
        df = df.filter(F.col(YEAR) >= start_year)
    if end_year is not None:
        df = df.filter(F.col(YEAR) <= end_year)
    named = df.filter(F.col(SPONSOR).isNotNull() & F.col(ORIG).isNotNull())
    parties = [ORIG, ORIG_NO, SPONSOR, SPONSOR_NO]
    hist = named.groupBy(*parties, F.col(AMOUNT).alias("v")).agg(
        F.count("*").alias("n"), F.min(YEAR).alias("first_year"), F.max(YEAR).alias("last_year")
    )
    years = {"first_year": (F.min, F.col("first_year")), "last_year": (F.max, F.col("last_year"))}
    found = order_statistics(hist, parties, MEDIAN, {"volume": (F.sum, F.col("v") * F.col("n")), **years})
    table = found.select(
        *[F.col(f"`{c}`") for c in parties],
        F.col("rows").alias("loan_count"),
        F.coalesce("volume", F.lit(0)).alias("total_volume"),
        F.col("mean").alias("avg_loan_amount"),
        median_of().alias("median_loan_amount"),
        "first_year",
        "last_year",
    ).filter(F.col("loan_count") >= min_loans)
    # Institutions without a number are known by their name.
    keys = {
        "originator_key": F.coalesce(F.col(ORIG_NO).cast("string"), F.concat(F.lit("originator:"), ORIG)),
        "sponsor_key": F.coalesce(F.col(SPONSOR_NO).cast("string"), F.concat(F.lit("sponsor:"), SPONSOR)),
    }
    return table.withColumns(keys).select(
        *EDGE_KEYS, *[c for c in table.columns if c not in parties]
    )


def ranked_edges(edge_table: DataFrame) -> DataFrame:
    """Largest relations first."""
    return edge_table.orderBy(
        F.desc_nulls_first("loan_count"), F.desc_nulls_first("total_volume"), *EDGE_KEYS
    )


# --- graph ----------------------------------------------------------------------------


def graph_edges(edge_table: DataFrame, *, weight_col: str = "loan_count", edge_merge: str = "sum") -> DataFrame:
    """One edge per key pair.

    A pair can have several rows when an institution changed its name.  ``sum`` adds
    them up; ``last`` keeps the smallest row only.
    """
    pair = ["originator_key", "sponsor_key"]
    size = F.struct("loan_count", "total_volume", ORIG, SPONSOR)
    if edge_merge == "last":
        kept = ["loan_count", "total_volume", "avg_loan_amount", "median_loan_amount", "first_year", "last_year"]
        row = F.min_by(F.struct(*kept), size).alias("row")
        merged = edge_table.groupBy(*pair).agg(row).select(*pair, "row.*")
    elif edge_merge == "sum":
        merged = (
            edge_table.groupBy(*pair)
            .agg(
                F.sum("loan_count").alias("loan_count"),
                F.sum("total_volume").alias("total_volume"),
                F.max_by("median_loan_amount", size).alias("median_loan_amount"),
                F.min("first_year").alias("first_year"),
                F.max("last_year").alias("last_year"),
            )
            .withColumn("avg_loan_amount", ratio("total_volume", "loan_count"))
        )
    else:
        raise ValueError("edge_merge must be 'sum' or 'last'")
    return merged.withColumn("weight", F.col(weight_col).cast("double"))


def vertices(edge_table: DataFrame) -> DataFrame:
    """``side, key, label, entity_id``; the label is the one with the most loans."""
    ends = F.explode(
        F.array(
            F.struct(
                F.lit(ORIGINATOR).alias("side"),
                F.col("originator_key").alias("key"),
                F.col(ORIG).alias("label"),
                F.col(ORIG_NO).cast("bigint").alias("entity_id"),
            ),
            F.struct(
                F.lit(SPONSOR_SIDE).alias("side"),
                F.col("sponsor_key").alias("key"),
                F.col(SPONSOR).alias("label"),
                F.col(SPONSOR_NO).cast("bigint").alias("entity_id"),
            ),
        )
    ).alias("end")
    return (
        edge_table.select("loan_count", ends)
        .groupBy(F.col("end.side").alias("side"), F.col("end.key").alias("key"), F.col("end.label").alias("label"))
        .agg(F.max("end.entity_id").alias("entity_id"), F.sum("loan_count").alias("n"))
        .groupBy("side", "key")
        .agg(
            F.min_by("label", F.struct(-F.col("n"), "label")).alias("label"),
            F.max("entity_id").alias("entity_id"),
        )
    )


def bipartite_graph(
    edge_table: DataFrame, *, weight_col: str = "loan_count", edge_merge: str = "sum"
) -> tuple[DataFrame, DataFrame]:
    """``(vertices, edges)`` of the network; the edge table is written once and read by both."""
    edge_table = cut_lineage(edge_table)
    return vertices(edge_table), graph_edges(edge_table, weight_col=weight_col, edge_merge=edge_merge)


def node_id(side: Column, key: Column, merge_shared_ids: bool) -> Column:
    """Originator and sponsor numbers overlap, so nodes carry their side unless merged."""
    return key if merge_shared_ids else F.concat(side, F.lit(":"), key)


def adjacency(edge_list: DataFrame, *, merge_shared_ids: bool = False) -> DataFrame:
    """``node, neighbour, weight`` in both directions."""
    o = node_id(F.lit(ORIGINATOR), F.col("originator_key"), merge_shared_ids)
    s = node_id(F.lit(SPONSOR_SIDE), F.col("sponsor_key"), merge_shared_ids)
    ends = F.array(
        F.struct(o.alias("node"), s.alias("neighbour")), F.struct(s.alias("node"), o.alias("neighbour"))
    )
    # A self-loop gives the same end twice and must count once.
    directed = edge_list.select("weight", F.explode(F.array_distinct(ends)).alias("e")).select("e.*", "weight")
    if merge_shared_ids:  # the same two institutions may be linked both ways
        return directed.groupBy("node", "neighbour").agg(F.sum("weight").alias("weight"))
    return directed


def degrees(adjacent: DataFrame) -> DataFrame:
    """Neighbours (a self-loop counts twice) and total weight per node."""
    return adjacent.groupBy("node").agg(
        (F.count("*") + F.count(F.when(F.col("node") == F.col("neighbour"), 1))).alias("degree"),
        F.sum("weight").alias("weighted_degree"),
    )


def degree_centrality(
    vertex_table: DataFrame, edge_list: DataFrame, *, merge_shared_ids: bool = False
) -> DataFrame:
    """Degree, weighted degree and degree over the size of the other side."""
    nodes = vertex_table.withColumn("node", node_id(F.col("side"), F.col("key"), merge_shared_ids))
    all_nodes = vertex_table.agg(
        F.count_distinct("key") if merge_shared_ids else F.count("*")
    ).scalar()
    same_side = F.when(F.col("side") == ORIGINATOR, _side_size(vertex_table, ORIGINATOR)).otherwise(
        _side_size(vertex_table, SPONSOR_SIDE)
    )
    return nodes.join(degrees(adjacency(edge_list, merge_shared_ids=merge_shared_ids)), "node", "left").withColumn(
        "degree_centrality", ratio("degree", all_nodes - same_side)
    )


def _side_size(vertex_table: DataFrame, side: str) -> Column:
    return vertex_table.filter(F.col("side") == side).agg(F.count("*")).scalar()


def centrality(
    vertex_table: DataFrame,
    edge_list: DataFrame,
    *,
    merge_shared_ids: bool = False,
    with_betweenness: bool = True,
) -> dict[str, DataFrame]:
    """Centrality tables of both sides, best connected first."""
    from .betweenness import betweenness

    table = degree_centrality(vertex_table, edge_list, merge_shared_ids=merge_shared_ids)
    if with_betweenness:
        scores = betweenness(adjacency(edge_list, merge_shared_ids=merge_shared_ids))
        table = table.join(scores, "node", "left").fillna(0.0, ["betweenness"])
    out = {}
    for side in (ORIGINATOR, SPONSOR_SIDE):
        columns = [
            F.col("key").alias("node"),
            F.col("label").alias(f"{side}_name"),
            F.col("entity_id").alias(f"{side}_id"),
            "degree",
            "weighted_degree",
            "degree_centrality",
        ] + (["betweenness"] if with_betweenness else [])
        out[f"{side}_centrality"] = (
            table.filter(F.col("side") == side)
            .select(*columns)
            .orderBy(F.desc_nulls_first("weighted_degree"), F.desc_nulls_first("degree"), "node")
        )
    return out


# --- projections -----------------------------------------------------------------------


def projection(edge_list: DataFrame, side: str = ORIGINATOR, *, block: int = PAIR_BLOCK) -> DataFrame:
    """Pairs of one side that share a neighbour, weight sum((w_u + w_v) / 2).

    The result has every such pair, so all of them must be formed.  Where many nodes share a
    hub, blocks of about ``block`` nodes meet: a task multiplies the links of two blocks and returns
    each pair once, so pairs are shuffled only if there are several groups of hubs to add up.  In a
    sparse network the members of a hub are hashed into blocks of that size and each pair of blocks
    is a join key of its own, so that no task forms all pairs of one hub.
    """
    node, hub = _sides(side)
    links = edge_list.select(F.col(hub).alias("hub"), F.col(node).alias("u"), F.col("weight").cast("double").alias("w"))
    links = cut_lineage(links.dropna(subset=["hub", "u"]))
    nodes = links.agg(F.count_distinct("u").alias("n")).first()["n"]
    hubs = links.groupBy("hub").agg(F.count("*").cast("double").alias("n"))
    row = hubs.agg(F.count("*").alias("n"), F.sum(F.col("n") * F.col("n")).alias("shared")).first()
    if (row["shared"] or 0) >= nodes * nodes * DENSE:
        return _pairs_of_blocks(links, -(-nodes // block), -(-row["n"] // HUB_GROUP))
    return _pairs_of_hubs(links, block)


def _pairs_of_blocks(links: DataFrame, blocks: int, groups: int) -> DataFrame:
    """The pairs of a dense network: every block of nodes meets every other one, by groups of hubs."""
    blocks, groups = max(1, blocks), max(1, groups)
    dealt = links.select(
        F.pmod(F.xxhash64("u"), F.lit(blocks)).cast("int").alias("b"), F.pmod(F.xxhash64("hub"), F.lit(groups)).cast("int").alias("g"),
        "u", "hub", "w",
    )
    packed = dealt.groupBy("b", "g").agg(F.collect_list(F.struct("u", "hub", F.col("w").isNotNull().alias("known"), F.coalesce("w", F.lit(0.0)).alias("w"))).alias("e"))
    # Blocks meet in squares of ``side`` times ``side``, so a block is copied once per row of squares, not once per block.
    cores = links.sparkSession.sparkContext.defaultParallelism
    side = max(1, min(SQUARE, int(blocks / math.sqrt(16 * cores / groups))))
    rows = -(-blocks // side)
    squares = rows * (rows + 1) // 2 * groups
    tasks = min(squares, max(8 * cores, squares // 64))
    of_block = F.floor(F.col("b") / side).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("o")
    copies = packed.select("b", "g", of_block.alias("own"), other, "e").select(
        F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "b", "g", *[F.col(f"e.{c}").alias(c) for c in _LINK]
    )
    # Squares are numbered along the triangle, so that every task gets as many.
    i, j = F.col("i").cast("bigint"), F.col("j").cast("bigint")
    square = (j * (j + 1) / 2).cast("bigint") * groups + i * groups + F.col("g")
    met = copies.withColumn("square", square).repartitionById(tasks, F.pmod(F.col("square"), F.lit(tasks)).cast("int"))
    met = met.select("square", "i", "j", "b", *_LINK).sortWithinPartitions("square")
    pairs = met.mapInArrow(_meet(side), "source string, target string, weight double")
    return pairs if groups == 1 else pairs.groupBy("source", "target").agg(F.sum("weight").alias("weight"))


_LINK = ("u", "hub", "known", "w")


def _meet(side: int):
    """Rows ordered by square, the links of one block each, to the pairs of every two blocks that meet there."""

    def pairs(i: int, j: int, blocks: dict[int, list[pa.Array]]) -> Iterator[pa.RecordBatch]:
        for b in (b for b in blocks if b // side == i):
            for c in (c for c in blocks if c // side == j):
                if b <= c:
                    yield from _cell_pairs(blocks[b], blocks[c], b == c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blocks = None, {}
        for batch in batches:
            plain = [batch.column(c).to_pylist() for c in ("square", "i", "j", "b")]
            lists = [batch.column(c) for c in _LINK]
            for k, (square, i, j, b) in enumerate(zip(*plain, strict=True)):
                if at is not None and square != at[0]:
                    yield from pairs(*at[1:], blocks)
                    blocks = {}
                at = (square, i, j)
                blocks[b] = [x[k].values for x in lists]
        if at is not None:
            yield from pairs(*at[1:], blocks)

    return run


def _cell_pairs(left: list[pa.Array], right: list[pa.Array], same: bool) -> Iterator[pa.RecordBatch]:
    """The pairs of two blocks, or of one with itself, that share a hub."""
    hubs = pc.unique(pa.concat_arrays([left[1], right[1]]))
    matrices, names = [], []
    for u, hub, known, w in (left, right):
        found = u.dictionary_encode()
        place = (found.indices.to_numpy(), pc.index_in(hub, hubs).to_numpy())
        shape = (len(found.dictionary), len(hubs))
        ones = (np.ones(len(u)), known.to_numpy(zero_copy_only=False).astype(float), w.to_numpy())
        matrices.append([np.zeros(shape) for _ in ones])
        for matrix, values in zip(matrices[-1], ones, strict=True):
            np.add.at(matrix, place, values)
        names.append(found.dictionary)
    (any_u, known_u, w_u), (any_v, known_v, w_v) = matrices
    there = any_u @ any_v.T > 0
    weight = (w_u @ known_v.T + known_u @ w_v.T) / 2
    missing = known_u @ known_v.T == 0
    # Text is ordered bytewise, as Spark does.
    everyone = pa.concat_arrays(names)
    order = pc.sort_indices(everyone).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    first, second = rank[: len(names[0])], rank[len(names[0]) :]
    if same:
        there &= first[:, None] < first[None, :]
        second = first
    ordered = everyone.take(pa.array(order))
    a, b = np.nonzero(there)
    for k in range(0, len(a), PAIR_ROWS):
        u, v = a[k : k + PAIR_ROWS], b[k : k + PAIR_ROWS]
        ends = [ordered.take(pa.array(f(first[u], second[v]))) for f in (np.minimum, np.maximum)]
        yield pa.RecordBatch.from_arrays([*ends, pa.array(weight[u, v], mask=missing[u, v])], ["source", "target", "weight"])


def _pairs_of_hubs(links: DataFrame, block: int) -> DataFrame:
    """The pairs of a sparse network, hub by hub."""
    sizes = links.groupBy("hub").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    member = links.join(sizes, "hub").withColumn("b", F.pmod(F.xxhash64("u"), "blocks").cast("int"))
    left = member.select(
        "hub", F.col("b").alias("i"), F.explode(F.sequence("b", F.col("blocks") - 1)).alias("j"), "u", "w"
    )
    right = member.select(
        "hub",
        F.explode(F.sequence(F.lit(0), F.col("b"))).alias("i"),
        F.col("b").alias("j"),
        F.col("u").alias("v"),
        F.col("w").alias("x"),
    )
    return (
        left.join(right, ["hub", "i", "j"])
        .filter((F.col("i") < F.col("j")) | (F.col("u") < F.col("v")))
        .groupBy(F.least("u", "v").alias("source"), F.greatest("u", "v").alias("target"))
        .agg(F.sum((F.col("w") + F.col("x")) / 2).alias("weight"))
    )


def _sides(side: str) -> tuple[str, str]:
    """Columns of the nodes of a side and of their hubs."""
    if side not in (ORIGINATOR, SPONSOR_SIDE):
        raise ValueError("side must be 'originator' or 'sponsor'")
    return ("originator_key", "sponsor_key") if side == ORIGINATOR else ("sponsor_key", "originator_key")


def heaviest_pairs(
    edge_list: DataFrame, k: int, side: str = ORIGINATOR, *, seeds: int = 256, block: int = PAIR_BLOCK
) -> DataFrame:
    """The ``k`` heaviest pairs of :func:`projection`, ties by name, without forming all pairs.

    A pair weighs at most half the sum of its nodes' whole weights.  The pairs among the
    ``seeds`` heaviest nodes come first: the k-th of them is a weight that the result has to
    reach.  Members of a hub are put into bands of whole weight, and only those blocks meet
    whose bands can reach it.  With fewer than ``k`` pairs among the seeds all blocks meet.
    Edges with a weight of less than 0 are refused, as the bound needs weights of 0 or more.
    """
    node, hub = _sides(side)
    links = edge_list.select(F.col(hub).alias("hub"), F.col(node).alias("u"), F.col("weight").cast("double").alias("w"))
    links = links.withColumn("w", F.when(F.col("w") < 0, F.raise_error(F.lit("negative weight"))).otherwise(F.col("w")))
    # The edges are made once; sums, seeds and members are read from the stored table.
    once = cut_lineage(links)
    links = cut_lineage(once.join(once.groupBy("u").agg(F.sum("w").alias("whole")), "u"))
    drop(once)
    heavy = links.select("u", "whole").distinct().orderBy(F.desc("whole"), "u").limit(seeds).select("u")
    first = links.join(heavy, "u", "left_semi")
    first = first.select(F.col("hub").alias(hub), F.col("u").alias(node), F.col("w").alias("weight"))
    first = projection(first, side, block=block).select("weight").orderBy(F.desc("weight")).limit(k)
    row = first.agg(F.count("*").alias("n"), F.min("weight").alias("least")).first()
    # Sums in another order may differ in the last places.
    least = row["least"] * (1 - 1e-9) if row["n"] == k else 0.0
    top_whole = links.agg(F.max("whole").alias("m")).first()["m"] or 1.0
    if least > 0:
        links = links.filter(F.col("whole") + top_whole >= 2 * least)
    # Band b holds whole weights of at most top / 2**(b / 8).
    band = F.when(F.col("whole") > 0, F.least(F.floor(-8 * F.log2(F.col("whole") / top_whole) + 1e-9), F.lit(BANDS))).otherwise(BANDS)
    reach = lambda b: top_whole * F.pow(F.lit(2.0), -b / 8) * (1 + 1e-9)
    links = links.withColumn("band", F.greatest(band, F.lit(0)).cast("int"))
    sizes = links.groupBy("hub", "band").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    member = links.join(sizes, ["hub", "band"]).withColumn(
        "at", F.struct("band", F.pmod(F.xxhash64("u"), "parts").cast("int").alias("part"))
    )
    # One row per hub and block: a block per band and a thousand members.
    blocks = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "band")
    blocks = blocks.select("hub", F.struct("band", "part").alias("at"))
    other = blocks.withColumnRenamed("at", "to")
    meet = blocks.join(other, "hub").filter(
        (F.col("at") <= F.col("to")) & (reach(F.col("at.band")) + reach(F.col("to.band")) >= 2 * least)
    )
    left = member.select("hub", "at", "u", "w", "whole").join(meet, ["hub", "at"])
    right = meet.join(
        member.select("hub", F.col("at").alias("to"), F.col("u").alias("v"), F.col("w").alias("x"), F.col("whole").alias("other")),
        ["hub", "to"],
    )
    return (
        left.join(right, ["hub", "at", "to"])
        .filter((F.col("at") < F.col("to")) | (F.col("u") < F.col("v")))
        .filter(F.col("whole") + F.col("other") >= 2 * least)
        .groupBy(F.least("u", "v").alias("source"), F.greatest("u", "v").alias("target"))
        .agg(F.sum((F.col("w") + F.col("x")) / 2).alias("weight"))
        .orderBy(F.desc("weight"), "source", "target")
        .limit(k)
    )


def projections(edge_list: DataFrame, *, ordered: bool = True) -> dict[str, DataFrame]:
    """Both one-mode projections, heaviest pairs first; ``ordered=False`` for callers that need all pairs but in no order.

    An order makes every pair twice, once to find ranges, and shuffles all of them.
    """
    tables = {f"{side}_projection": projection(edge_list, side) for side in (ORIGINATOR, SPONSOR_SIDE)}
    if not ordered:
        return tables
    return {name: table.orderBy(F.desc("weight"), "source", "target") for name, table in tables.items()}


def top(df: DataFrame, k: int, *order) -> DataFrame:
    """First ``k`` rows in the given total order."""
    return df.orderBy(*order).limit(k)


# --- whole-network numbers ---------------------------------------------------------------


def edge_totals(edge_table: DataFrame) -> DataFrame:
    """One row: edges, nodes of both sides, volume, loans and density E / (N (N-1) / 2)."""
    return (
        edge_table.agg(
            F.count("*").alias("edge_count"),
            F.count_distinct("originator_key", "sponsor_key").alias("pair_count"),
            F.count_distinct("originator_key").alias("originator_nodes"),
            F.count_distinct("sponsor_key").alias("sponsor_nodes"),
            sum0("loan_count").alias("total_loans"),
            sum0("total_volume").alias("total_volume"),
        )
        .withColumn("nodes", F.col("originator_nodes") + F.col("sponsor_nodes"))
        .withColumn("density", ratio(F.col("pair_count") * 2, F.col("nodes") * (F.col("nodes") - 1)))
        .drop("nodes")
    )
