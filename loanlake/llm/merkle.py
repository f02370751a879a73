"""Merkle manifest of a dataset by a nested-struct rollup.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a tree (a source) ascend by an id;
every sixteen consecutive nodes become one node, the digest of their digests, until one is left.
The roots of the trees, ordered by name, make the tree above them in the same way.

A leaf's rank is written in digits of base sixteen, and the leaves are dealt into blocks of three
digits.  Inside a block the digits are grouped away one after another: a group collects its child
structs, which hold their own children, and its digest.  All three steps need one exchange.  What
is left of a block is one row of at most 4,096 leaves, whatever the size of the tree, and the roots
of the blocks are the nodes of the next, 4,096 times smaller, rollup.  Downwards a transform takes
the digests of every run from the nested structs and explodes its children, which yields the proof
of each leaf without a join; only a block, once, is joined to the proof of its own root.

Ranks need no tree in one task: leaves are dealt out by ranges of tree and id, counted per range,
and numbered inside their range behind the counts of the ranges before.

Nulls in fields, trees and ids are values of their own: a null field is encoded as ``-``, the null
tree is a tree and comes first, leaves without an id come first.  Rows that share an id are ordered
by their digest; repeated rows are leaves of their own (a row repeated very often lies in one range).
An empty text is ``0:``.  Columns that are not named are not read.  An empty table has no rows.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

FAN, DIGITS = 16, 3
BLOCK = FAN**DIGITS
PATH = "array<struct<run:array<string>,position:int>>"


def encoded(field: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value as text."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def run_digest(run: Column) -> Column:
    """The node above a run of digests."""
    return F.sha2(F.array_join(run, ""), 256)


def _digests(kids: Column) -> Column:
    return F.transform(kids, lambda kid: kid["hash"])


def _ranked(scratch: Scratch, nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes(tree, ...)`` with ``rank``, from 0 by ``order`` within a tree, and ``m``, the tree's size."""
    count = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.repartitionByRange(count, "tree", *order).withColumn("part", F.spark_partition_id())
    stored = scratch.store(dealt)
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy("tree", "part").agg(F.count("*").alias("n"))
    counts = counts.select(
        F.col("tree").alias("own"),
        F.col("part").alias("range"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("tree")).alias("m"),
    )
    inside = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*order))
    joined = stored.join(counts, (F.col("part") == F.col("range")) & F.col("tree").eqNullSafe(F.col("own")))
    return joined.withColumn("rank", F.col("before") + inside - 1).drop("own", "range", "before", "part")


def _blocks(nodes: DataFrame) -> DataFrame:
    """``nodes(tree, m, rank, hash, item)`` rolled up to ``tree, m, block, hash, kids``, one row per block."""
    digit = lambda k: (F.floor(F.col("rank") / FAN**k) % FAN).cast("int")
    dealt = nodes.withColumns({"block": F.floor(F.col("rank") / BLOCK)} | {f"d{k}": digit(k) for k in range(DIGITS)})
    rolled = dealt.repartition("tree", "block")
    child = ["hash", "item"]
    for k in range(DIGITS):
        keys = ["tree", "m", "block", *(f"d{j}" for j in range(DIGITS - 1, k, -1))]
        one = F.struct(F.col(f"d{k}").alias("digit"), *child)
        rolled = rolled.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("kids"))
        # A tree that has come down to one node keeps it.
        above = F.when(F.col("m") > FAN**k, run_digest(_digests(F.col("kids")))).otherwise(F.col("kids")[0]["hash"])
        rolled = rolled.withColumn("hash", above)
        child = ["hash", "kids"]
    return rolled


def _exploded(blocks: DataFrame) -> DataFrame:
    """``item, path, subroot, root`` of every leaf; ``blocks`` also has the path of the block's own root."""
    rest = ["m", "path", "subroot", "root"]
    steps = blocks
    for k in range(DIGITS - 1, -1, -1):
        kids = "kids" if k == DIGITS - 1 else f"kid{k + 1}.kids"
        steps = steps.select(*rest, _digests(F.col(kids)).alias(f"run{k}"), F.explode(kids).alias(f"kid{k}"))
        if k:
            rest = [*rest, f"run{k}", f"kid{k}"]
    none = F.array().cast(PATH)
    levels = [
        F.when(
            F.col("m") > FAN**k,
            F.array(F.struct(F.col(f"run{k}").alias("run"), F.col(f"kid{k}.digit").alias("position"))),
        ).otherwise(none)
        for k in range(DIGITS)
    ]
    return steps.select("kid0.item", F.concat(*levels, "path").alias("path"), "subroot", "root")


def _proofs(scratch: Scratch, nodes: DataFrame, top: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``item, path, subroot, root`` of ``nodes(tree, m, rank, hash, item)``.

    ``top`` takes the roots ``tree, hash`` of all trees to ``tree, path, root``.
    """
    blocks = scratch.store(_blocks(nodes))
    parents = blocks.select(
        "tree", F.ceil(F.col("m") / BLOCK).alias("m"), F.col("block").alias("rank"), "hash", F.struct("tree", "block").alias("item")
    )
    if (parents.agg(F.max("m")).first()[0] or 0) > 1:
        above = _proofs(scratch, parents, top)
    else:
        roots = parents.select("tree", "hash")
        known = top(roots).select(F.col("tree").alias("own"), "path", "root")
        above = parents.join(known, F.col("tree").eqNullSafe(F.col("own")))
        above = above.select("item", "path", F.col("hash").alias("subroot"), "root")
    above = above.select(F.col("item.tree").alias("of"), F.col("item.block").alias("number"), "path", "subroot", "root")
    joined = blocks.join(above, F.col("tree").eqNullSafe(F.col("of")) & (F.col("block") == F.col("number")))
    return _exploded(joined)


def _whole(scratch: Scratch, roots: DataFrame) -> DataFrame:
    """The tree above the trees: ``tree, path, root`` for ``roots(tree, hash)``."""
    nodes = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash", F.struct("tree").alias("item"))
    ranked = _ranked(scratch, nodes, ["name"]).select("tree", "m", "rank", "hash", "item")
    alone = lambda last: last.select("tree", F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))
    return _proofs(scratch, ranked, alone).select("item.tree", "path", "root")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level and left to right."""
    others = F.transform(path, lambda level: F.filter(level["run"], lambda _, k: k != level["position"]))
    return F.sha2(F.array_join(F.flatten(others), ""), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that follows from a leaf and its siblings."""

    def up(node: Column, level: Column) -> Column:
        return run_digest(F.transform(level["run"], lambda x, k: F.when(k == level["position"], node).otherwise(x)))

    return F.aggregate(path, leaf, up)


def manifest(
    spark: SparkSession,
    table: DataFrame,
    *,
    fields: Sequence[str],
    by: str,
    order: str,
    claims: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``order, by, leaf, subroot, root, path, proof_sha256, folded_root, verified`` for every row.

    ``path`` lists the runs from the leaf to the root: all digests of the run and the position of the own
    one.  ``claims`` replaces fields by what somebody claims them to be; such a row is verified if its
    claimed leaf and the true siblings lead to the true root.
    """
    scratch = Scratch(spark, "manifest")
    claims = claims or {}
    values = {c: F.col(f"`{c}`") for c in fields}
    changed = F.lit(False)
    for name, claim in claims.items():
        changed = changed | ~claim.eqNullSafe(values[name])
    claimed = F.when(changed, leaf_digest([claims.get(c, v) for c, v in values.items()]))
    leaves = table.select(
        F.col(f"`{by}`").cast("string").alias("tree"),
        F.col(f"`{order}`").alias("id"),
        leaf_digest(list(values.values())).alias("hash"),
        claimed.alias("claim"),
    )
    ranked = _ranked(scratch, leaves, ["id", "hash", "claim"])
    nodes = ranked.select("tree", "m", "rank", "hash", F.struct("id", "tree", F.col("hash").alias("leaf"), "claim").alias("item"))
    proofs = _proofs(scratch, nodes, lambda roots: _whole(scratch, roots))
    root = folded(F.col("path"), F.coalesce("item.claim", "item.leaf"))
    found = proofs.select(
        F.col("item.id").alias(order),
        F.col("item.tree").alias(by),
        F.col("item.leaf").alias("leaf"),
        "subroot",
        "root",
        "path",
        proof_digest(F.col("path")).alias("proof_sha256"),
        root.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
