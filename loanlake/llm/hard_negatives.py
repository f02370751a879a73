"""Hard negatives by slot-decomposed selection.

Vectors become integer codes ``floor(scale * x)``; a score is the integer inner product with an
anchor, higher scores first, ties by the smaller id.  An anchor's positives are its first other
rows of the same label.  For every positive the first rows of another label are wanted whose score
lies in a window below the positive's: ``low * positive <= 100 * score <= 100 * positive``.

The windows of one anchor overlap.  Their upper limits, at most one per positive, cut the scores
into disjoint slots; a row falls into the slot of the smallest limit that it does not exceed.  Every
task keeps the first rows of each slot only, and so does every step that brings tasks together.  A
window is everything from its slot downwards: merging the slots from the last one to the first
gives, slot by slot, the first rows below each limit, and the lower limit cuts a tail off.

Anchors meet the rows in cells: anchors are dealt into blocks, rows into blocks, and a task holds
one block of anchors while the rows of a block stream past it.  For the positives cells are made
within a label; a label with a third of the rows has more blocks, not larger ones.  The work is
anchors times rows, as exact answers need; no pair is stored.

Rows with a null id, label or vector, or with a null or non-finite component, take no part; nor do
vectors whose codes have a squared length of 2^55 or more, as their scores would not fit a long.
Vectors of different length never meet.  Rows that share an id are one row, the smallest by label
and codes.  An anchor without a positive, and a window without a row, give nothing.  Columns other
than the three named ones are not read.  An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, small_batches, tidy

ANCHORS, ROWS = 1024, 4096  # in a block
LEAST_BLOCKS = 64
CELLS = 1_000_000  # scores in memory at once
LARGEST = float(1 << 55)
TOP = (1 << 63) - 1


def usable_rows(table: DataFrame, vector: str, vec_id: str, label: str, scale: int) -> DataFrame:
    """``id, label, codes, size``: one row per id whose vector can be scored."""
    rows = table.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(~bad).select("id", "label", F.transform("vector", lambda x: F.floor(x * scale)).alias("codes"))
    length = F.aggregate("codes", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double"))
    rows = rows.filter(length < LARGEST)
    one = rows.groupBy("id").agg(F.min(F.struct("label", "codes")).alias("row"))
    return one.select("id", "row.label", "row.codes", F.size("row.codes").alias("size"))


def _cells(anchors: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Anchors (with ``limits``) and rows in the cells of their blocks; anchors come first in a cell.

    Both sides carry ``above`` and ``beside``: the numbers of blocks of anchors and of rows.
    """
    block = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    rest = ["id", "label", "codes"]
    keys = list(dict.fromkeys(keys))
    left = anchors.select(*keys, block(1, "above").alias("one"), every("beside").alias("two"), *(c for c in rest if c not in keys), "limits")
    right = rows.select(*keys, every("above").alias("one"), block(2, "beside").alias("two"), *(c for c in rest if c not in keys))
    none = F.lit(None).cast("array<bigint>")
    both = left.withColumn("kind", F.lit(0)).unionByName(right.withColumns({"limits": none, "kind": F.lit(1)}))
    cell = [*keys, "one", "two"]
    return both.repartition(*cell).sortWithinPartitions(*cell, "kind")


class _Cell:
    """A block of anchors, and the first rows of each of their slots so far."""

    def __init__(self, ids: np.ndarray, labels: list[str], codes: np.ndarray, limits: list[list[int]], low: int, same: bool, keep: int):
        self.ids, self.codes, self.same, self.keep = ids, codes, same, keep
        self.number = {x: k for k, x in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.number[x] for x in labels])
        widest = max(map(len, limits))
        # Lists shorter than the widest repeat their last limit downwards, where no slot counts.
        self.slots = np.array([len(x) for x in limits])
        self.limits = np.array([x + [-TOP] * (widest - len(x)) for x in limits], np.int64)
        self.floor = np.array([-TOP if same else -((-low * x[-1]) // 100) for x in limits], np.int64)
        self.found: list[tuple[np.ndarray, ...]] = []
        self.count = 0
        self.length = float(np.abs(codes.astype(np.float64)).max(initial=0)) ** 2 * max(codes.shape[1], 1)

    def meet(self, ids: np.ndarray, labels: list[str], codes: np.ndarray) -> None:
        own = np.array([self.number.get(x, -1) for x in labels])
        length = float(np.abs(codes.astype(np.float64)).max(initial=0)) ** 2 * max(codes.shape[1], 1)
        exact = (self.length * length) ** 0.5 < 1 << 53
        there = codes.astype(np.float64) if exact else codes
        step = max(1, CELLS // max(len(ids), 1))
        for start in range(0, len(self.ids), step):
            part = slice(start, start + step)
            here = self.codes[part].astype(np.float64) if exact else self.codes[part]
            scores = here @ there.T
            wanted = (scores <= self.limits[part, :1]) & (scores >= self.floor[part, None])
            wanted &= (self.ids[part, None] != ids) if self.same else (self.labels[part, None] != own)
            i, j = np.nonzero(wanted)
            score = scores[i, j].astype(np.int64)
            i += start
            slot = (self.limits[i] >= score[:, None]).sum(1) - 1
            self.found.append((i, slot, score, ids[j]))
            self.count += len(i)
            if self.count > CELLS // 4:
                self.cut()

    def cut(self) -> None:
        """Keep the first rows of every slot."""
        i, slot, score, other = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.lexsort((other, -score, slot, i))
        i, slot, score, other = i[order], slot[order], score[order], other[order]
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] != i[:-1]) | (slot[1:] != slot[:-1])
        starts = np.flatnonzero(new)
        rank = np.arange(len(i)) - np.repeat(starts, np.diff([*starts, len(i)]))
        first = rank < self.keep
        self.found = [(i[first], slot[first], score[first], other[first])]
        self.count = int(first.sum())

    def rows(self) -> pa.RecordBatch | None:
        if not self.count:
            return None
        self.cut()
        i, slot, score, other = self.found[0]
        columns = [self.ids[i], slot.astype(np.int32), score, other]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["anchor", "slot", "score", "other"])


def _first_of_slots(keys: list[str], low: int, same: bool, keep: int):
    """Stream the rows of every cell past its anchors; a task holds one block of anchors at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keys, "one", "two"]
        current, cell, held = None, None, []

        def numbers(batch: pa.RecordBatch) -> np.ndarray:
            flat = batch.column("codes").flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(batch.num_rows, len(flat) // batch.num_rows)

        def opened() -> _Cell:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = table.column("id").to_numpy(zero_copy_only=False)
            return _Cell(ids, table.column("label").to_pylist(), numbers(table), table.column("limits").to_pylist(), low, same, keep)

        for batch in batches:
            key = list(zip(*(batch.column(c).to_pylist() for c in names), strict=True))
            kind = batch.column("kind").to_pylist()
            start = 0
            for k in range(1, len(key) + 1):
                if k < len(key) and key[k] == key[start] and kind[k] == kind[start]:
                    continue
                if key[start] != current:
                    if cell is not None and (out := cell.rows()) is not None:
                        yield out
                    current, cell, held = key[start], None, []
                part = batch.slice(start, k - start)
                if kind[start] == 0:
                    held.append(part)
                elif held or cell is not None:
                    if cell is None:
                        cell, held = opened(), []
                    ids = part.column("id").to_numpy(zero_copy_only=False)
                    cell.meet(ids, part.column("label").to_pylist(), numbers(part))
                start = k
        if cell is not None and (out := cell.rows()) is not None:
            yield out

    return run


def _selected(cells: DataFrame, keys: list[str], low: int, same: bool, keep: int) -> DataFrame:
    """The first rows of every slot of every anchor over all cells."""
    found = cells.mapInArrow(tidy(_first_of_slots(keys, low, same, keep)), "anchor long, slot int, score long, other long")
    ranked = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "other")
    return found.withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= keep).drop("n")


def hard_negatives(
    spark: SparkSession,
    table: DataFrame,
    anchors: Column,
    *,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on the id, written on a column named ``id``.  ``low`` is the lower limit of
    a window in per cent of the positive's score; the positive's score itself is the upper limit.
    """
    small_batches(spark)
    scratch = Scratch(spark, "negatives")
    rows = scratch.store(usable_rows(table, vector, vec_id, label, scale).withColumn("asks", F.coalesce(anchors, F.lit(False))))

    # Positives: cells within a label.
    group = ["label", "size"]
    sizes = rows.groupBy(*group).agg(F.count("*").alias("n"), F.count_if("asks").alias("m")).filter("m > 0")
    sizes = sizes.select(
        *group, F.ceil(F.col("m") / ANCHORS).cast("int").alias("above"), F.ceil(F.col("n") / ROWS).cast("int").alias("beside")
    )
    within = rows.join(sizes, group)
    ask = within.filter("asks").withColumn("limits", F.array(F.lit(TOP)))
    best = _selected(_cells(ask, within, group), group, low, True, positives)
    best = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), F.col("other").alias("id")))).alias("positives"))
    limits = F.transform(F.array_sort(F.array_distinct(F.transform("positives", lambda p: p["less"]))), lambda x: -x)
    best = scratch.store(best.select("anchor", "positives", limits.alias("limits")))

    # Negatives: cells over all labels.
    counts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("m")).first()
    blocks = {
        "above": F.lit(max(1, -(-counts["m"] // ANCHORS))),
        "beside": F.lit(max(LEAST_BLOCKS, -(-counts["n"] // ROWS))),
    }
    ask = rows.filter("asks").join(best.select(F.col("anchor").alias("id"), "limits"), "id").withColumns(blocks)
    found = _selected(_cells(ask, rows.withColumns(blocks), ["size"]), ["size"], low, False, negatives)
    item = F.struct((-F.col("score")).alias("less"), F.col("other").alias("id"))
    slots = found.groupBy("anchor").agg(F.collect_list(F.struct("slot", item.alias("row"))).alias("rows"))
    joined = best.join(slots, "anchor")

    # From the last slot to the first: what a slot holds, merged with what lies below it.
    empty = F.array().cast("array<struct<less:bigint,id:bigint>>")

    def downwards(done: Column, slot: Column) -> Column:
        own = F.transform(F.filter("rows", lambda x: x["slot"] == slot), lambda x: x["row"])
        below = F.coalesce(F.try_element_at(done, F.lit(-1)), empty)
        return F.concat(done, F.array(F.slice(F.array_sort(F.concat(own, below)), 1, negatives)))

    none = F.array().cast("array<array<struct<less:bigint,id:bigint>>>")
    order = F.sequence(F.size("limits") - 1, F.lit(0), F.lit(-1))
    merged = joined.select("anchor", "positives", "limits", F.aggregate(order, none, downwards).alias("merged"))

    def window(p: Column) -> Column:
        place = F.size("limits") + 1 - F.array_position("limits", -p["less"]).cast("int")
        inside = F.filter(F.element_at("merged", place), lambda x: x["less"] * 100 <= p["less"] * low)
        return F.struct(p["id"].alias("id"), (-p["less"]).alias("score"), inside.alias("rows"))

    each = merged.select("anchor", F.explode(F.transform("positives", window)).alias("p"))
    listed = each.select("anchor", "p.id", "p.score", F.posexplode("p.rows").alias("rank", "row"))
    return listed.select(
        F.col("anchor").alias("anchor_id"),
        F.col("id").alias("positive_id"),
        (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("row.id").alias("negative_id"),
        F.col("score").alias("positive_score"),
        (-F.col("row.less")).alias("negative_score"),
    )
