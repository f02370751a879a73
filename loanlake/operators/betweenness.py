"""Betweenness centrality on weighted shortest paths, in blocks of nodes and sources.

Nodes are dealt into parts of bounded size and sources into blocks; a cell is what one part knows
about one block, a vector over the block's sources for every node.  Three phases run over the cells:
shortest distances, numbers of shortest paths, and the dependencies that flow back along them.  In
each phase a cell works on the edges inside its part until nothing changes and then sends, for the
ends of its edges in other parts, one vector per node; only cells that get something run again.
Distances are improved by minima, paths and dependencies by sums of increments, so every round only
adds rows to what is stored and no state is written twice.

No task holds more than a part's edges to another part and its vectors over one block.  A network of
parts needs as many rounds as its paths change parts.

A network of at most ``WHOLE_NODES`` nodes and ``WHOLE_LINKS`` directed links is one part.  Nothing travels then:
blocks of sources are dealt to tasks, a task has the links once and takes its blocks one after
another through all three phases, and only the sums per node leave it.

Where few nodes touch every link (a cover, such as the smaller side of a two-sided network) and all
weights are whole, only those are sources.  Any other node has all its neighbours in the cover, so its
distances are minima over its neighbours' and its paths begin as one of theirs.  Each task takes some
targets, finds there which neighbours lead to them on shortest paths from every other node, and adds up
the shares; they are the demand that the neighbours' own dependencies carry on.  Which neighbours are taken
depends on a node's links and on how their weights differ, so nodes that agree in both are one class.
A network of up to ``COVER_LINKS`` directed links with such a cover is one part, however many nodes it has.
"""

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.checkpoints import cut_lineage, drop

PART_NODES, BLOCK_SOURCES = 4096, 128
#: A network up to this size is one part.
WHOLE_NODES, WHOLE_LINKS = 1 << 18, 1 << 22
#: Values of a vector over a block in a network of one part, and nodes whose links are one row.
BLOCK_VALUES, ROW_NODES = 4_000_000, 4096
#: Values of distances between a cover and all nodes, and nodes of the network for one of its cover.
COVER_VALUES, COVER_SHARE = 20_000_000, 4
#: Directed links of a network of one part that has a cover.
COVER_LINKS = 1 << 23
#: Sums of whole numbers up to here are exact, in any order.
WHOLE_SUM = 1 << 53
STATE_ROWS_PER_CORE = 20_000_000
#: Values that a step over edges holds at once.
STEP_VALUES = 2_000_000
SHARE_VALUES = 250_000
BLOCKS_PER_PART = 1000
EDGES, DISTANCES, PATHS, ARRIVALS, TOTALS = range(5)
ROW = "p int, b int, kind int, node int, origin int, one binary, two binary, total double"
_NAMES = [c.split()[0] for c in ROW.split(", ")]
_ARROW = [pa.int32()] * 5 + [pa.binary()] * 2 + [pa.float64()]


class _Edges:
    """Edges from a part's nodes ``i`` to the nodes ``j`` of one part, in steps of bounded size."""

    def __init__(self, i: np.ndarray, j: np.ndarray, w: np.ndarray):
        self.i, self.j, self.w = i, j, w
        self.orders: dict[int, np.ndarray] = {}

    def steps(self, chosen: np.ndarray, by: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
        """``i, j, w, starts`` of the chosen edges, ordered by one of their ends; a start for every run of that end."""
        order = self.orders.get(id(by))
        if order is None:
            order = self.orders[id(by)] = np.argsort(by, kind="stable")
        rows = order[chosen[order]]
        size = max(1, STEP_VALUES // max(width, 1))
        for k in range(0, len(rows), size):
            part = rows[k : k + size]
            ends = by[part]
            starts = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
            yield self.i[part], self.j[part], self.w[part, None], starts


def _on_path(near: np.ndarray, w: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Where an edge is the last one of a shortest path to its far end."""
    return (near + w == far) & (near < far)


class _Shape(NamedTuple):
    """Nodes of every part, and sources of a block."""

    sizes: dict[int, int]
    block: int

    def place(self, p: int, i: int) -> tuple[int, int, int]:
        """Block of a source, its place there and the number of sources in the block."""
        first = i // self.block * self.block
        return p * BLOCKS_PER_PART + i // self.block, i - first, min(self.block, self.sizes[p] - first)


class _Cell:
    """What a part knows about a block of sources."""

    def __init__(self, p: int, b: int, shape: _Shape):
        self.p, self.b, self.sizes = p, b, shape.sizes
        self.home, first = b // BLOCKS_PER_PART, b % BLOCKS_PER_PART * shape.block
        self._prepare(first, min(shape.block, self.sizes[self.home] - first))

    @classmethod
    def of_one_part(cls, first: int, width: int, n: int, edges: _Edges) -> "_Cell":
        """The cell of ``width`` sources in a network of one part."""
        cell = cls.__new__(cls)
        cell.p = cell.b = cell.home = 0
        cell.sizes = {0: n}
        cell._prepare(first, width)
        cell.edges[0] = edges
        return cell

    def _prepare(self, first: int, width: int) -> None:
        p, self.width = self.p, width
        self.sources = np.arange(first, first + self.width)
        self.edges: dict[int, _Edges] = {}
        self.dist = np.full((self.sizes[p], self.width), np.inf)
        self.paths = np.zeros((self.sizes[p], self.width))
        self.arrived: list[tuple[int, int, np.ndarray, np.ndarray | None]] = []
        self.out: list[tuple] = []

    def take(self, row: dict) -> None:
        kind, node = row["kind"], row["node"]
        if kind == EDGES:
            self.edges[node] = _Edges(*row["edges"])
            return
        one = None if row["one"] is None else np.frombuffer(row["one"])
        if kind == DISTANCES:
            np.minimum(self.dist[node], one, out=self.dist[node])
        elif kind == PATHS:
            self.paths[node] += one
        else:
            two = None if row["two"] is None else np.frombuffer(row["two"])
            self.arrived.append((row["origin"], node, one, two))

    def say(self, p: int, kind: int, node: int, one=None, two=None, total=None) -> None:
        raw = [None if x is None else np.ascontiguousarray(x, np.float64).tobytes() for x in (one, two)]
        self.out.append((p, self.b, kind, int(node), self.p, *raw, total))

    @property
    def inside(self) -> _Edges:
        none = np.zeros(0, np.int32)
        return self.edges.get(self.p, _Edges(none, none, np.zeros(0)))

    def others(self):
        return ((q, e) for q, e in self.edges.items() if q != self.p)

    def _spread(self, changed: np.ndarray) -> np.ndarray:
        """Carry improved distances along the edges inside; the nodes that got any."""
        improved, edges = changed.copy(), self.inside
        while changed.any():
            after = np.zeros_like(changed)
            for i, j, w, starts in edges.steps(changed[edges.i], edges.j, self.width):
                ends = j[starts]
                reach = np.minimum.reduceat(self.dist[i] + w, starts)
                better = (reach < self.dist[ends]).any(1)
                self.dist[ends[better]] = np.minimum(self.dist[ends[better]], reach[better])
                after[ends[better]] = True
            changed = after
            improved |= changed
        return improved

    def _push(self, fresh: np.ndarray) -> np.ndarray:
        """Carry new paths along the edges inside; all that moved."""
        pushed, edges = np.zeros_like(fresh), self.inside
        while (moving := fresh.any(1)).any():
            pushed += fresh
            after = np.zeros_like(fresh)
            for i, j, w, starts in edges.steps(moving[edges.i], edges.j, self.width):
                flow = np.where(_on_path(self.dist[i], w, self.dist[j]), fresh[i], 0.0)
                after[j[starts]] += np.add.reduceat(flow, starts)
            fresh = after
        return pushed

    def _gather(self, fresh: np.ndarray, per_path: np.ndarray) -> np.ndarray:
        """Carry new dependencies back along the edges inside; all that moved."""
        gathered, edges = np.zeros_like(fresh), self.inside
        while (moving := fresh.any(1)).any():
            gathered += fresh
            share, after = fresh * per_path, np.zeros_like(fresh)
            for i, j, w, starts in edges.steps(moving[edges.j], edges.i, self.width):
                flow = np.where(_on_path(self.dist[i], w, self.dist[j]), share[j], 0.0)
                ends = i[starts]
                after[ends] += self.paths[ends] * np.add.reduceat(flow, starts)
            fresh = after
        return gathered

    def _per_path(self) -> np.ndarray:
        return np.divide(1.0, self.paths, out=np.zeros_like(self.paths), where=self.paths > 0)

    @property
    def _own(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the sources in a table of nodes and sources."""
        return self.sources, np.arange(self.width)

    def find_paths(self) -> None:
        """Distances and numbers of paths where there is one part."""
        self.dist[self._own] = 0.0
        changed = np.zeros(len(self.dist), bool)
        changed[self.sources] = True
        self._spread(changed)
        begin = np.zeros_like(self.dist)
        begin[self._own] = 1.0
        self.paths = self._push(begin)

    def depend(self, through: np.ndarray | None = None) -> np.ndarray:
        """The dependency of every node on the sources' paths.

        ``through`` is what comes to the sources from other nodes on its way to every target.
        """
        demand = np.isfinite(self.dist).astype(float)
        if through is not None:
            demand += np.where(demand > 0, through, 0.0)
        demand[self._own] = 0.0
        gathered = self._gather(demand, self._per_path()) - demand
        gathered[self._own] = 0.0
        if through is not None:
            passing = np.where(np.isfinite(self.dist), through, 0.0)
            passing[self._own] = 0.0
            gathered[self._own] = passing.sum(0)
        return gathered.sum(1)

    def distances(self) -> None:
        changed = np.zeros(len(self.dist), bool)
        for _, node, one, _ in self.arrived:
            if (one < self.dist[node]).any():
                np.minimum(self.dist[node], one, out=self.dist[node])
                changed[node] = True
        improved = self._spread(changed)
        for node in np.flatnonzero(improved):
            self.say(self.p, DISTANCES, node, self.dist[node])
        for q, edges in self.others():
            for i, j, w, starts in edges.steps(improved[edges.i], edges.j, self.width):
                for node, reach in zip(j[starts], np.minimum.reduceat(self.dist[i] + w, starts), strict=True):
                    self.say(q, ARRIVALS, node, reach)

    def counts(self) -> None:
        fresh = np.zeros_like(self.dist)
        for _, node, reach, amount in self.arrived:
            fresh[node] += np.where(reach == self.dist[node], amount, 0.0)
        pushed = self._push(fresh)
        sent = pushed.any(1)
        for node in np.flatnonzero(sent):
            self.say(self.p, PATHS, node, pushed[node])
        for q, edges in self.others():
            for i, j, w, starts in edges.steps(sent[edges.i], edges.j, self.width):
                reach = self.dist[i] + w
                least = np.minimum.reduceat(reach, starts)
                lengths = np.diff([*starts, len(i)])
                flow = np.where(reach == np.repeat(least, lengths, 0), pushed[i], 0.0)
                for node, one, two in zip(j[starts], least, np.add.reduceat(flow, starts), strict=True):
                    if two.any():
                        self.say(q, ARRIVALS, node, one, two)

    def dependencies(self) -> None:
        fresh = np.zeros_like(self.dist)
        by_origin: dict[int, list] = {}
        started = False
        for origin, node, one, two in self.arrived:
            if node < 0:
                started = True
            else:
                by_origin.setdefault(origin, []).append((node, one, two))
        if started:
            fresh[np.isfinite(self.dist)] = 1.0
            if self.p == self.home:
                fresh[self.sources, np.arange(self.width)] = 0.0
        ones = fresh.copy()
        for origin, rows in by_origin.items():
            place = np.full(self.sizes[origin], -1)
            nodes = np.array([r[0] for r in rows])
            place[nodes] = np.arange(len(nodes))
            far, share = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            edges = self.edges[origin]
            for i, j, w, starts in edges.steps(place[edges.j] >= 0, edges.i, self.width):
                at = place[j]
                flow = np.where(_on_path(self.dist[i], w, far[at]), share[at], 0.0)
                ends = i[starts]
                fresh[ends] += self.paths[ends] * np.add.reduceat(flow, starts)
        per_path = self._per_path()
        gathered = self._gather(fresh, per_path)
        share, sent = gathered * per_path, gathered.any(1)
        for q, edges in self.others():
            for node in np.unique(edges.i[sent[edges.i]]):
                self.say(q, ARRIVALS, node, self.dist[node], share[node])
        gathered -= ones
        if self.p == self.home:
            gathered[self.sources, np.arange(self.width)] = 0.0
        for node, total in enumerate(gathered.sum(1)):
            if total:
                self.say(self.p, TOTALS, node, total=float(total))


def _run(work: str, shape: _Shape):
    """Rows sorted by cell to what the cells say; a task holds one cell at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: _Cell | None = None

        def said(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(rows), 2000):
                columns = zip(*rows[k : k + 2000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _ARROW, strict=True)], _NAMES)

        for batch in batches:
            plain = [batch.column(c).to_pylist() for c in _NAMES]
            lists = [batch.column(c) for c in "ijw"]
            for k, values in enumerate(zip(*plain, strict=True)):
                row = dict(zip(_NAMES, values, strict=True))
                if cell is None or (cell.p, cell.b) != (row["p"], row["b"]):
                    if cell is not None:
                        getattr(cell, work)()
                        yield from said(cell.out)
                    cell = _Cell(row["p"], row["b"], shape)
                if row["kind"] == EDGES:
                    row["edges"] = [x[k].values.to_numpy() for x in lists]
                cell.take(row)
        if cell is not None:
            getattr(cell, work)()
            yield from said(cell.out)

    return run


def _rows(tables: list[DataFrame]) -> DataFrame:
    """Stored tables as one scan."""
    return tables[0].sparkSession.read.schema(ROW).parquet(*(t._stored_at for t in tables))


def _of_kind(tables: list[DataFrame], kind: int) -> DataFrame:
    return _rows(tables).filter(F.col("kind") == kind)


def _phase(
    work: str, shape: _Shape, edges: DataFrame, known: list[DataFrame], arrivals: DataFrame, own: bool
) -> list[DataFrame]:
    """Rounds until nothing arrives any more; ``own`` rows of a phase are known to its later rounds."""
    tables: list[DataFrame] = []
    none = [F.lit(None).cast(t).alias(c) for c, t in (("i", "array<int>"), ("j", "array<int>"), ("w", "array<double>"))]
    while True:
        # A row for every cell that runs: few, and without the lineage of what arrives.
        cells = cut_lineage(arrivals.select("p", "b").distinct())
        facts = [*known, *([_rows(tables).filter(F.col("kind") != ARRIVALS)] if own and tables else []), arrivals]
        rows = [t.join(cells, ["p", "b"], "left_semi").select(*_NAMES, *none) for t in facts]
        rows.append(edges.join(cells, "p").select(*_NAMES, "i", "j", "w"))
        met = reduce(DataFrame.unionByName, rows).repartition("p", "b").sortWithinPartitions("p", "b", "kind")
        tables.append(cut_lineage(met.mapInArrow(_run(work, shape), ROW)))
        drop(cells)
        arrivals = tables[-1].filter(F.col("kind") == ARRIVALS)
        if arrivals.isEmpty():
            return tables


def _batch(shape: _Shape, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``p, node, total``: dependencies of all nodes on the shortest paths from the sources of ``seeds``."""
    zeros = seeds.withColumn("two", F.lit(None).cast("binary"))
    found = _phase("distances", shape, edges, [], zeros, True)
    # Improvements of several rounds are folded by minima when they are read.
    known = _of_kind(found, DISTANCES)
    counted = _phase("counts", shape, edges, [known], seeds, False)
    begin = known.select("p", "b").distinct()
    begin = begin.select("p", "b", F.lit(ARRIVALS).alias("kind"), F.lit(-1).alias("node"), *[
        F.lit(None).cast(t).alias(c) for c, t in (("origin", "int"), ("one", "binary"), ("two", "binary"), ("total", "double"))
    ])
    back = _phase("dependencies", shape, edges, [known, _of_kind(counted, PATHS)], begin, False)
    total = cut_lineage(_of_kind(back, TOTALS).groupBy("p", "node").agg(F.sum("total").alias("total")))
    drop(*found, *counted, *back)
    return total


def _seeds(batches: Iterator[pa.RecordBatch], shape: _Shape) -> Iterator[pa.RecordBatch]:
    """The arrival of every source at itself: distance 0, one path."""
    for batch in batches:
        rows = []
        for p, i in zip(batch.column("p").to_pylist(), batch.column("i").to_pylist(), strict=True):
            b, at, width = shape.place(p, i)
            one, two = np.full(width, np.inf), np.zeros(width)
            one[at], two[at] = 0.0, 1.0
            rows.append((p, b, ARRIVALS, i, p, one.tobytes(), two.tobytes(), None))
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _ARROW, strict=True)], _NAMES)


def _links_of(rows: list[list[np.ndarray]]) -> _Edges:
    none = [np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0)]
    return _Edges(*(np.concatenate(parts) for parts in zip(none, *rows, strict=True)))


def _read(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[_Edges, tuple | None]]:
    """The links of a task with the values of each further row; links come first, and None after the last row."""
    links: list[list[np.ndarray]] = []
    edges = None
    for batch in batches:
        lists = [batch.column(c) for c in "ijw"]
        for k, values in enumerate(zip(*[batch.column(c).to_pylist() for c in columns], strict=True)):
            if values[0] < 0:
                links.append([x[k].values.to_numpy() for x in lists])
                continue
            if edges is None:
                edges = _links_of(links)
            yield edges, values
    yield edges or _links_of(links), None


def _whole(n: int, block: int):
    """Rows of a task, links before blocks of sources, to the sums that the task found per node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for edges, values in _read(batches, "first"):
            if values is not None:
                cell = _Cell.of_one_part(values[0], min(block, n - values[0]), n, edges)
                cell.find_paths()
                total += cell.depend()
        yield _sums(total)

    return run


def _sums(total: np.ndarray) -> pa.RecordBatch:
    found = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["i", "total"])


def _packed(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``i, j, w``: links as lists, a row for some thousand nodes."""
    far = nodes.select(F.col("node").alias("neighbour"), F.col("i").alias("j"))
    met = links.join(nodes, "node").join(far, "neighbour").select("i", "j", "w")
    packed = met.groupBy(F.floor(F.col("i") / ROW_NODES).alias("row")).agg(F.collect_list(F.struct("i", "j", "w")).alias("e"))
    return packed.select(*[F.col(f"e.{c}").alias(c) for c in "ijw"])


def _to_tasks(packed: DataFrame, rows: DataFrame, tasks: int) -> DataFrame:
    """Rows with their ``task``, and before them the links, which every task gets."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task")
    first = next(c for c in rows.columns if c != "task")
    met = packed.select(copies, F.lit(-1).alias(first), "i", "j", "w").unionByName(rows, allowMissingColumns=True)
    return met.repartitionById(tasks, F.col("task")).sortWithinPartitions(first)


def _in_one_part(links: DataFrame, nodes: DataFrame, n: int, block: int) -> DataFrame:
    """``p, node, total`` of a network of one part."""
    block = max(1, min(block, BLOCK_VALUES // max(n, 1)))
    tasks = max(1, min(-(-n // block), 4 * links.sparkSession.sparkContext.defaultParallelism))
    dealt = _to_tasks(_packed(links, nodes), _blocks(links, n, block, tasks), tasks)
    return dealt.mapInArrow(_whole(n, block), "i int, total double").select(F.lit(0).alias("p"), F.col("i").alias("node"), "total")


def _blocks(links: DataFrame, sources: int, block: int, tasks: int) -> DataFrame:
    """``task, first``: blocks of sources dealt to tasks."""
    at = (F.col("id") / block).cast("int")
    return links.sparkSession.range(0, sources, block).select((at % tasks).alias("task"), F.col("id").cast("int").alias("first"))


def _cover_paths(n: int, k: int, block: int, width: int):
    """Blocks of the cover's nodes to their distances and numbers of paths, by ranges of ``width`` targets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for edges, values in _read(batches, "first"):
            if values is None:
                continue
            cell = _Cell.of_one_part(values[0], min(block, k - values[0]), n, edges)
            cell.find_paths()
            for at, h in enumerate(cell.sources):
                ranges = range(0, n, width)
                parts = [[np.ascontiguousarray(x[v : v + width, at]).tobytes() for v in ranges] for x in (cell.dist, cell.paths)]
                columns = [pa.array([h] * len(ranges), pa.int32()), pa.array(range(len(ranges)), pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.binary()) for x in parts)], ["h", "c", "dist", "paths"])

    return run


def _classes(edges: _Edges, k: int) -> tuple[_Edges, np.ndarray, np.ndarray]:
    """Links of one node of every class to the cover, nodes of every class, and the class of every node from ``k`` on.

    Nodes of a class have the same neighbours, and weights that differ from one link to the next by the same amounts.
    """
    own = edges.i >= k
    i, h, w = edges.i[own], edges.j[own], edges.w[own]
    order = np.lexsort((h, i))
    i, h, w = i[order], h[order], w[order]
    starts = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.zeros(0, int)
    degree = np.diff([*starts, len(i)])
    w = w - np.repeat(np.minimum.reduceat(w, starts), degree) if len(i) else w
    number = np.full(int(i.max()) + 1 - k if len(i) else 0, -1)
    links, counts, classes = [], [], 0
    for d in np.unique(degree):
        heads = starts[degree == d]
        at = heads[:, None] + np.arange(d)
        rows = [*h[at].T, *w[at].T]
        by = np.lexsort(rows)
        other = np.concatenate([[True], np.any([x[by][1:] != x[by][:-1] for x in rows], axis=0)])
        same = np.cumsum(other) - 1
        number[i[heads[by]] - k] = classes + same
        one = at[by[other]].ravel()
        links.append([np.repeat(np.arange(classes, classes + same[-1] + 1), d), h[one], w[one]])
        counts.append(np.bincount(same))
        classes += same[-1] + 1
    return _links_of(links), np.concatenate([np.zeros(0), *counts]), number


def _shares(edges: _Edges, dist: np.ndarray, paths: np.ndarray, first: int) -> np.ndarray:
    """What comes to every node of the cover on its way to targets ``first`` and on, one unit from every other node to each."""
    k, width = dist.shape
    classes, counts, number = _classes(edges, k)
    i, h, w = classes.i, classes.j, classes.w
    # Targets of a class are reached by the same ways; those without a class stand alone.
    targets = np.arange(first, first + width) - k
    inside = (targets >= 0) & (targets < len(number))
    number = np.where(inside, number[np.where(inside, targets, 0)] if len(number) else -1, -1)
    _, one, alike = np.unique(np.where(number < 0, -1 - np.arange(width), number), return_index=True, return_inverse=True)
    dist, paths, number, width = dist[:, one], paths[:, one], number[one], len(one)
    flow = np.zeros((k, width))
    ends = np.flatnonzero(np.concatenate([i[1:] != i[:-1], [True]])) + 1 if len(i) else np.zeros(0, int)
    step, a = max(1, SHARE_VALUES // max(width, 1)), 0
    while a < len(i):
        # All links of a class are in one step.
        b = int(ends[max(np.searchsorted(ends, a + step, "right") - 1, np.searchsorted(ends, a, "right"))])
        to = h[a:b]
        starts = np.flatnonzero(np.concatenate([[True], i[a + 1 : b] != i[a : b - 1]]))
        lengths = np.diff([*starts, b - a])
        reach = dist[to] + w[a:b, None]
        least = np.minimum.reduceat(reach, starts)
        amount = np.where(reach == np.repeat(least, lengths, 0), paths[to], 0.0)
        all_paths = np.add.reduceat(amount, starts)
        per_path = np.divide(1.0, all_paths, out=np.zeros_like(all_paths), where=np.isfinite(least) & (all_paths > 0))
        here = i[a:b][starts]
        per_path *= counts[here][:, None]
        own = np.flatnonzero((number >= here[0]) & (number <= here[-1]))
        size = counts[number[own]]
        per_path[number[own] - here[0], own] *= (size - 1) / size  # no paths to itself
        amount *= np.repeat(per_path, lengths, 0)
        by = np.argsort(to, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], to[by][1:] != to[by][:-1]]))
        flow[to[by][heads]] += np.add.reduceat(amount[by], heads)
        a = b
    return flow[:, alike]


def _cover_shares(k: int, width: int):
    """Distances and paths of the cover to a task's range of targets to what passes its nodes on the way there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, edges, c = {}, None, 0
        for found, values in _read(batches, "h", "c", "dist", "paths"):
            edges = found
            if values is not None:
                h, c, *raw = values
                known[h] = [np.frombuffer(x) for x in raw]
        if len(known) == k:
            dist, paths = (np.stack([known[h][x] for h in range(k)]) for x in (0, 1))
            flow = _shares(edges, dist, paths, c * width)
            columns = [pa.array(range(k), pa.int32()), pa.array([c] * k, pa.int32()), pa.array([x.tobytes() for x in flow], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["h", "c", "flow"])

    return run


def _cover_sums(n: int, k: int, block: int):
    """Rows ordered by node of the cover and range of targets to the sums that a task found per node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        at, known = None, {}

        def add(edges: _Edges) -> None:
            if at is None:
                return
            width = min(block, k - at * block)
            cell = _Cell.of_one_part(at * block, width, n, edges)
            columns = [known[int(h)] for h in cell.sources]
            cell.dist, cell.paths, through = (np.stack([np.concatenate([p[x] for p in parts]) for parts in columns], 1) for x in range(3))
            total[:] += cell.depend(through)

        for edges, values in _read(batches, "h", "dist", "paths", "flow"):
            if values is None or values[0] // block != at:
                add(edges)
                at, known = (None if values is None else values[0] // block), {}
            if values is not None:
                known.setdefault(values[0], []).append([np.frombuffer(x) for x in values[1:]])
        yield _sums(total)

    return run


def _over_cover(links: DataFrame, nodes: DataFrame, n: int, k: int, block: int) -> DataFrame:
    """``p, node, total`` of a network of one part whose first ``k`` nodes are a cover."""
    cores = links.sparkSession.sparkContext.defaultParallelism
    block = max(1, min(block, BLOCK_VALUES // n, -(-k // cores)))
    width = -(-n // (4 * cores))
    ranges, tasks = -(-n // width), min(-(-k // block), 4 * cores)
    packed = cut_lineage(_packed(links, nodes))
    dealt = _to_tasks(packed, _blocks(links, k, block, tasks), tasks)
    paths = cut_lineage(dealt.mapInArrow(_cover_paths(n, k, block, width), "h int, c int, dist binary, paths binary"))
    dealt = _to_tasks(packed, paths.select(F.col("c").alias("task"), "h", "c", "dist", "paths"), ranges)
    flows = cut_lineage(dealt.mapInArrow(_cover_shares(k, width), "h int, c int, flow binary"))
    task = (F.floor(F.col("h") / block) % tasks).cast("int").alias("task")
    rows = paths.join(flows, ["h", "c"]).select(task, "h", "c", "dist", "paths", "flow")
    dealt = _to_tasks(packed, rows, tasks).sortWithinPartitions("h", "c")
    sums = cut_lineage(dealt.mapInArrow(_cover_sums(n, k, block), "i int, total double"))
    drop(packed, paths, flows)
    return sums.select(F.lit(0).alias("p"), F.col("i").alias("node"), "total")


def _cover(links: DataFrame) -> DataFrame:
    """``node``: the end with more links of every link."""
    size = links.groupBy("node").agg(F.count("*").alias("n"))
    ends = links.join(size, "node").join(size.select(F.col("node").alias("neighbour"), F.col("n").alias("m")), "neighbour")
    larger = F.greatest(F.struct("n", "node"), F.struct(F.col("m").alias("n"), F.col("neighbour").alias("node")))
    return ends.select(larger["node"].alias("node")).distinct()


def _in_parts(links: DataFrame, nodes: DataFrame, n: int, state_rows_per_core: int, block_sources: int) -> DataFrame:
    """``p, node, total`` of a network of several parts."""
    # One number per part, and as many parts as nodes over the size of a part.
    sizes = {r["p"]: r["n"] for r in nodes.groupBy("p").agg(F.count("*").alias("n")).collect()}
    shape = _Shape(sizes, block_sources)
    far = nodes.select(F.col("node").alias("neighbour"), F.col("p").alias("q"), F.col("i").alias("j"))
    packed = links.join(nodes, "node").join(far, "neighbour").groupBy("p", "q").agg(
        F.collect_list(F.struct("i", "j", "w")).alias("e")
    )
    edges = cut_lineage(packed.select(
        "p", F.lit(EDGES).alias("kind"), F.col("q").alias("node"), F.lit(None).cast("int").alias("origin"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("one", "binary"), ("two", "binary"), ("total", "double"))],
        *[F.col(f"e.{c}").alias(c) for c in "ijw"],
    ))
    room = state_rows_per_core * links.sparkSession.sparkContext.defaultParallelism
    batches = max(1, math.ceil(n * n / room))
    seeds = nodes.select("p", "i").mapInArrow(lambda rows: _seeds(rows, shape), ROW)
    totals = []
    for batch in range(batches):
        totals.append(_batch(shape, edges, seeds.filter(F.pmod(F.xxhash64("b"), F.lit(batches)) == batch)))
    return reduce(DataFrame.unionByName, totals)


def _exact(links: DataFrame) -> bool:
    """Whether distances are the same in whatever order weights are added."""
    row = links.agg(F.every(F.col("w") == F.floor("w")).alias("whole"), F.sum("w").alias("sum")).first()
    return bool(row["whole"]) and row["sum"] < WHOLE_SUM


def betweenness(
    adjacent: DataFrame,
    *,
    normalized: bool = True,
    state_rows_per_core: int = STATE_ROWS_PER_CORE,
    part_nodes: int | None = None,
    block_sources: int = BLOCK_SOURCES,
) -> DataFrame:
    """``node, betweenness`` of every node; weights are distances and must be positive.

    Sources are handled in as many batches as keep their (source, node) values below
    ``state_rows_per_core`` on every core; ``part_nodes`` and ``block_sources`` are the sizes of
    parts and blocks.  Without ``part_nodes`` a network of a size that one task can hold is one part.
    """
    links = cut_lineage(
        adjacent.filter(F.col("node") != F.col("neighbour")).select(
            "node",
            "neighbour",
            F.when(F.col("weight") > 0, F.col("weight").cast("double"))
            .otherwise(F.raise_error(F.lit("betweenness needs positive weights")))
            .alias("w"),
        )
    )
    n, size = links.select("node").distinct().count(), links.count()
    any_size = part_nodes is None
    if any_size:
        part_nodes = WHOLE_NODES if n <= WHOLE_NODES and size <= WHOLE_LINKS else PART_NODES
    parts, over_cover, first = max(1, -(-n // part_nodes)), False, []
    if parts == 1 or any_size and size <= COVER_LINKS:
        cover = cut_lineage(_cover(links))
        covering = cover.count()
        over_cover = 0 < covering <= n // COVER_SHARE and covering * n <= COVER_VALUES and _exact(links)
    if over_cover:
        parts = 1
    nodes = links.select("node", F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int").alias("p")).distinct()
    if parts == 1:
        nodes = nodes.join(cover.withColumn("first", F.lit(True)), "node", "left")
        first = [F.col("first").asc_nulls_last()]
    if over_cover:
        # Nodes of a class stand together.
        least = links.groupBy("node").agg(F.min("w").alias("least"))
        alike = F.bit_xor(F.xxhash64("neighbour", F.col("w") - F.col("least"))).alias("alike")
        nodes = nodes.join(links.join(least, "node").groupBy("node").agg(alike), "node")
        first.append(F.col("alike"))
    place = F.row_number().over(Window.partitionBy("p").orderBy(*first, "node")) - 1
    nodes = cut_lineage(nodes.withColumn("i", place).select("node", "p", "i"))
    if over_cover:
        total = _over_cover(links, nodes, n, covering, block_sources)
    elif parts == 1:
        total = _in_one_part(links, nodes, n, block_sources)
    else:
        total = _in_parts(links, nodes, n, state_rows_per_core, block_sources)
    total = total.groupBy("p", F.col("node").alias("i")).agg(F.sum("total").alias("total"))
    # Every unordered pair is seen from both ends.
    scale = (1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0) if normalized else 0.5
    score = F.coalesce(F.col("total"), F.lit(0.0)) * scale
    return nodes.join(total, ["p", "i"], "left").select("node", score.alias("betweenness"))
