"""Mixing sources to target weights by a splitting tree over blocks.

Every source's documents are dealt by hash into blocks.  The mix takes whole passes over
a source and then permuted blocks until its target of words is met; the last block is
taken document by document in permuted order, the last document in part.  The numbers
of blocks per source are then split down a binary tree of output shards: at every node a
multivariate hypergeometric draw (tickets without replacement) gives one half its exact
quotas.  Every shard gets disjoint blocks of each source's permutation and is shuffled
by itself.

What is ordered in one task is bounded by parameters: the list of sources, at most
``2 * blocks`` block passes plus one per source, or the documents of one block.

Null texts have size 0; documents of size 0 are never taken.  A null source is a source of
its own.  Repeated rows are separate documents.  An empty table gives an empty mix.  The
choice depends only on the seed and the rows, so reruns agree.  Input columns with the
name of an output column are replaced.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, word_count

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_REPEATS = 2
BLOCKS = 4096
LEVELS = 3
SLICES = 1024


def _key(source: str) -> Column:
    """A key that is never null and tells a null source from any text."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def source_targets(sized: DataFrame) -> DataFrame:
    """``__key, source_size, target`` from rows with ``__key`` and ``__size``.

    Targets share ``TOTAL_SHARE`` of all words by weight; a target stops at
    ``MOST_REPEATS`` times its source and the excess is shared again by weight.  That is
    one level for all open sources: sorted by capacity per weight, it is the first level
    that the next source can hold.
    """
    totals = sized.groupBy("__key").agg(F.sum("__size").alias("source_size"))
    in_order = Window.orderBy(F.col("__key") == "n", "__key")
    everything = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    cap = (MOST_REPEATS * F.col("source_size")).cast("double")
    rows = totals.withColumns({"__weight": weight, "__cap": cap})
    by_ratio = Window.orderBy(F.col("__cap") / F.col("__weight"), "__key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    closed = F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    closed_weight = F.coalesce(F.sum("__weight").over(before), F.lit(0.0))
    to_share = TOTAL_SHARE * F.sum("source_size").over(everything) - closed
    rows = rows.withColumn("__level", to_share / (F.sum("__weight").over(everything) - closed_weight))
    holds = F.col("__level") * F.col("__weight") <= F.col("__cap")
    rows = rows.withColumns({"__level": F.first(F.when(holds, F.col("__level")), ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    target = F.least("__cap", F.coalesce(F.col("__level") * F.col("__weight"), F.col("__cap")))
    return rows.select("__key", "source_size", target.alias("target"))


def block_passes(blocks: DataFrame, seed: int) -> DataFrame:
    """``__key, __block, epoch, words, part, rank`` of the blocks that the mix takes.

    ``blocks`` has a row per block with its size and its source's target.  Passes over
    a source follow each other, each in a permutation of its own; ``words`` is what the
    mix takes of a block, ``part`` says that this is less than all of it, and ``rank``
    is the block's place in the source's permutation.
    """
    passes = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))))
    order = Window.partitionBy("__key").orderBy("epoch", F.xxhash64(F.lit(seed), "__key", "epoch", "__block"), "__block")
    before = F.coalesce(F.sum("__block_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.round("target").cast("bigint") - before
    taken = F.greatest(F.least(left, F.col("__block_size")), F.lit(0)).cast("bigint")
    passes = passes.withColumns({"words": taken, "rank": F.row_number().over(order)}).filter("words > 0")
    return passes.select("__key", "__block", "epoch", "words", (F.col("words") < F.col("__block_size")).alias("part"), "rank")


def split_quotas(passes: DataFrame, levels: int, seed: int) -> DataFrame:
    """``__key, rank, shard``: every block pass in one of ``2 ** levels`` shards.

    A node of the tree holds a quota of blocks per source.  Its tickets, one per block,
    are put in random order and the first half goes left, which draws the left quotas
    from the multivariate hypergeometric distribution.
    """
    quotas = passes.groupBy("__key").agg(F.count("*").alias("n")).withColumn("node", F.lit(0).cast("bigint"))
    for level in range(levels):
        tickets = quotas.select("node", "__key", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("ticket"))
        draw = Window.partitionBy("node").orderBy(F.xxhash64(F.lit(seed), F.lit(level), "node", "__key", "ticket"), "__key", "ticket")
        half = (F.count("*").over(Window.partitionBy("node")) + F.pmod(F.col("node"), F.lit(2))) / 2
        side = F.when(F.row_number().over(draw) <= F.floor(half), 0).otherwise(1)
        quotas = (
            tickets.withColumn("child", 2 * F.col("node") + side)
            .groupBy(F.col("child").alias("node"), "__key")
            .agg(F.count("*").alias("n"))
        )
    by_shard = Window.partitionBy("__key").orderBy("node")
    last = F.sum("n").over(by_shard.rowsBetween(Window.unboundedPreceding, 0))
    ranges = quotas.withColumn("last", last)
    ranks = F.explode(F.sequence(F.col("last") - F.col("n") + 1, F.col("last"))).alias("rank")
    return ranges.select("__key", ranks, F.col("node").cast("int").alias("shard"))


def allocate(
    spark: SparkSession,
    docs: DataFrame,
    *,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    blocks: int = BLOCKS,
    levels: int = LEVELS,
    seed: int = 17,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken`` and ``passes``.

    ``passes`` lists ``(epoch, shard, words)`` for every time the mix takes the document.
    Sizes are counted once; the table of blocks, bounded by ``blocks`` and the number of
    sources, is stored and joined to the documents where they lie.
    """
    scratch = Scratch(spark, "mix")
    outputs = ("size", "source_size", "target", "taken", "passes")
    kept = [c for c in docs.columns if c.lower() not in outputs]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept], _key(source).alias("__key"), word_count(F.col(f"`{text}`")).alias("__size")
    )
    draw = F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"))
    light = scratch.store(rows.select("__key", draw.alias("__draw"), "__size").groupBy("__key", "__draw").agg(F.sum("__size").alias("__size")))
    targets = scratch.store(source_targets(light))
    total = F.greatest(F.sum("source_size").over(Window.partitionBy(F.lit(0))), F.lit(1))
    parts = F.greatest(F.ceil(F.lit(blocks) * F.col("source_size") / total), F.lit(1)).cast("bigint")
    sources = scratch.store(targets.withColumn("__parts", parts))
    block_of = F.pmod(F.col("__draw"), F.col("__parts")).alias("__block")
    block_sizes = (
        light.join(sources, "__key")
        .groupBy("__key", block_of, "target")
        .agg(F.sum("__size").alias("__block_size"))
    )
    passes = scratch.store(block_passes(block_sizes, seed))
    ranked = passes.withColumn("rank", F.row_number().over(Window.partitionBy("__key").orderBy("rank")))
    sharded = ranked.join(split_quotas(passes, levels, seed), ["__key", "rank"])
    whole = F.collect_list(F.when(~F.col("part"), F.struct("epoch", "shard")))
    partial = F.max(F.when(F.col("part"), F.struct("epoch", "shard", "words")))
    taken_blocks = scratch.store(
        sharded.groupBy("__key", "__block").agg(F.array_sort(whole).alias("__whole"), partial.alias("__partial"))
    )
    placed = rows.join(sources, "__key").withColumn("__draw", draw)
    placed = placed.withColumn("__block", F.pmod("__draw", "__parts")).join(taken_blocks, ["__key", "__block"], "left")
    # Only the documents of a block that is taken in part are put in order.
    order = Window.partitionBy("__key", "__block").orderBy("__draw", *_tie_breakers(kept, doc_id))
    before = F.coalesce(F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    some = F.greatest(F.least(F.col("__partial.words") - before, F.col("__size")), F.lit(0)).cast("bigint")
    result = (
        placed.filter("__partial IS NULL").withColumn("__some", F.lit(0).cast("bigint"))
        .unionByName(placed.filter("__partial IS NOT NULL").withColumn("__some", some))
    )
    entry = lambda e, words: F.struct(e["epoch"].alias("epoch"), e["shard"].alias("shard"), words.alias("words"))
    full = F.when(F.col("__size") > 0, F.transform("__whole", lambda e: entry(e, F.col("__size"))))
    last = F.when(F.col("__some") > 0, F.array(entry(F.col("__partial"), F.col("__some"))))
    nothing = F.array().cast("array<struct<epoch:int,shard:int,words:bigint>>")
    listed = F.concat(F.coalesce(full, nothing), F.coalesce(last, nothing))
    result = result.withColumn("passes", listed)
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda total, e: total + e["words"])
    return result.select(
        *[F.col(f"`{c}`") for c in kept], F.col("__size").alias("size"), "source_size", "target", taken.alias("taken"), "passes"
    )


def _tie_breakers(columns: list[str], doc_id: str) -> list[Column]:
    """They make the order of rows that share an id the same in every run."""
    return [F.col(f"`{doc_id}`"), F.xxhash64(*[F.col(f"`{c}`") for c in columns])]


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, as often as they are taken, shuffled by shard.

    Documents stay whole: one that is taken in part is in the mix if at least half of
    its words are taken.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    text, source, doc_id = (options.pop(k, k) for k in ("text", "source", "doc_id"))
    rows = docs.select(row, *[F.col(f"`{c}`").alias(f"__{n}") for c, n in ((text, "text"), (source, "source"), (doc_id, "doc_id"))])
    mixed = allocate(spark, rows, text="__text", source="__source", doc_id="__doc_id", **options)
    copies = F.filter("passes", lambda e: 2 * e["words"] >= F.col("size"))
    copies = mixed.select("__row", "__doc_id", F.explode(copies).alias("__pass"))
    local = F.xxhash64(F.lit(options.get("seed", 17)), "__pass.shard", "__pass.epoch", "__doc_id")
    # As many tasks as the session shuffles to: a shard is cut into slices of its own order.
    dealt = copies.withColumn("__local", local).repartition("__pass.shard", F.pmod("__local", F.lit(SLICES)))
    return dealt.sortWithinPartitions("__pass.shard", "__local").select("__row.*")
