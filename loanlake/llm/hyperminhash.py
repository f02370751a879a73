"""Near-duplicate documents by HyperMinHash.

A document is its set of five-word shingles.  Shingle hashes are dealt into registers;
a register keeps its smallest hash in compressed form, the number of leading zeros and
ten mantissa bits.  Compressed registers are banded, a star of candidate pairs is drawn
per band bucket, the collision-corrected estimate of the Jaccard similarity drops pairs
that are far below the threshold (six standard deviations), and what is left is compared
on the full sets.

Documents with equal sets are one class before any banding.  In a bucket every member first meets
one leader; pairs inside one component need no comparison after that.  Buckets that still hold
members of different components are dealt into blocks of bounded size; a task compares two
blocks on the smallest ``LOW`` shingle hashes of their members, which is the full set of a
shorter document and a sample of a longer one.  It returns a spanning forest of the links it
found, never the pairs, and of pairs of longer documents those of different components whose
estimate leaves a doubt; they are compared on the full sets.

With 32 bands of five registers a pair at exactly the threshold of 0.85 is missed with a
probability of 7e-9.  Documents without words (null texts too) have an empty set and link
with nothing.  Rows that share an id are one document; a row without an id is a document of
its own and links with nothing.  An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, components, slices, small_batches, tidy

SHINGLE = 5
REGISTERS, BANDS, ROWS = 160, 32, 5
MANTISSA_BITS = 10
DEVIATIONS = 6.0
LOW, BLOCK = 512, 512
COLUMNS = 8192
# Odd multipliers of the shingle hash and of the mixing steps.
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
# Fixed value: share of registers that agree by chance alone, times 2 ** mantissa bits, for sets of one size.
CHANCE = 0.169919487159739


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits look independent."""
    x = (x ^ (x >> np.uint64(33))) * MIX[0]
    x = (x ^ (x >> np.uint64(33))) * MIX[1]
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; A-Z are lower-cased, words end at ASCII white space."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * MULTIPLIERS[k]
    return np.unique(mix(total))


def registers(shingles: np.ndarray) -> np.ndarray:
    """Compressed minimum of every register: ``(leading zeros + 1) << 10 | mantissa``, 0 where it is empty."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, (shingles % np.uint64(REGISTERS)).astype(np.int64), mix(shingles ^ MULTIPLIERS[0]))
    empty = least == np.iinfo(np.uint64).max
    zeros = 53 - np.frexp((least >> np.uint64(11)).astype(np.float64))[1].astype(np.int64)
    mantissa = (least << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    packed = ((zeros + 1) << MANTISSA_BITS) | mantissa.astype(np.int64)
    return np.where(empty, 0, packed).astype(np.uint16)


_FILL = np.stack([np.random.default_rng(k).permutation(REGISTERS) for k in range(REGISTERS)])


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One key per band; an empty register borrows the first filled one of its own fixed order."""
    filled = sketch > 0
    if not filled.all():
        gaps = np.flatnonzero(~filled)
        order = _FILL[gaps]
        sketch = sketch.copy()
        sketch[gaps] = sketch[order[np.arange(len(gaps)), filled[order].argmax(1)]]
    rows = sketch[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * MULTIPLIERS[1] + rows[:, k])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of sketches and the number of registers they rest on.

    The registers that are expected to agree by chance are taken off those that agree.
    """
    used = ((a > 0) | (b > 0)).sum(1)
    equal = ((a == b) & (a > 0)).sum(1)
    ratio = n_a / n_b
    chance = CHANCE / 2**MANTISSA_BITS * 4 * ratio / (1 + ratio) ** 2 * used
    return (equal - chance) / np.maximum(used, 1), used


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        n, one, two, sketches = [], [], [], []
        for text in batch.column("text"):
            shingles = shingle_hashes(text.as_py())
            n.append(len(shingles))
            one.append(int(shingles.sum(dtype=np.uint64).view(np.int64)))
            two.append(int(mix(shingles ^ MULTIPLIERS[2]).sum(dtype=np.uint64).view(np.int64)))
            sketches.append(registers(shingles).tobytes() if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sketches, pa.binary())],
            ["id", "n", "s1", "s2", "sketch"],
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [band_keys(np.frombuffer(s.as_buffer(), np.uint16)) for s in batch.column("sketch")]
        if keys:
            nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(nodes)], ["key", "node"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = [shingle_hashes(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["node", "shingles"])


def _likely(threshold: float):
    """Keep pairs whose estimate is not clearly below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b"))
            found, used = estimate(a, b, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
            least = threshold - DEVIATIONS * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
            keep = pa.array(found >= least)
            yield batch.select(["a", "b"]).filter(keep)

    return run


def _verified(percent: int):
    """Compare full sets: links have ``100 * intersection >= percent * union``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def common_counts(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``one`` with every set of ``two``."""
    counts = np.zeros((len(one), len(two)), np.float32)
    if len(one) * len(two) <= 16:
        for i, p in enumerate(one):
            for j, q in enumerate(two):
                counts[i, j] = len(p) if p is q else len(np.intersect1d(p, q, assume_unique=True))
        return counts
    rows = [np.repeat(np.arange(len(side)), [len(p) for p in side]) for side in (one, two)]
    values = [np.concatenate(side) for side in (one, two)]
    # Hashes that both sides hold are the columns of two 0/1 matrices, a slice of them at a time.
    shared = np.intersect1d(*values)
    for start in range(0, len(shared), COLUMNS):
        part = shared[start : start + COLUMNS]
        sides = []
        for at, value, size in zip(rows, values, (len(one), len(two)), strict=True):
            column = np.minimum(np.searchsorted(part, value), len(part) - 1)
            held = part[column] == value
            matrix = np.zeros((size, len(part)), np.float32)
            matrix[at[held], column[held]] = 1
            sides.append(matrix)
        counts += sides[0] @ sides[1].T
    return counts


def _root(parent: list[int], k: int) -> int:
    while parent[k] != k:
        parent[k] = parent[parent[k]]
        k = parent[k]
    return k


def _compare_blocks(nodes, groups, sizes, blocks, sets, first, second, percent) -> list[tuple[int, int, bool]]:
    """Forest of sure links and the doubtful pairs between two blocks of a bucket."""
    here = [k for k, block in enumerate(blocks) if block == first]
    there = here if first == second else [k for k, block in enumerate(blocks) if block == second]
    if not here or not there or len(set(groups)) < 2:
        return []
    both = common_counts([sets[k] for k in here], [sets[k] for k in there])
    last = np.iinfo(np.uint64).max
    # A longer document is known up to its largest low hash; a pair up to the smaller of both ends.
    ends = np.array([s[-1] if n > len(s) else last for s, n in zip(sets, sizes, strict=True)], np.uint64)
    end = np.minimum(ends[here][:, None], ends[there][None, :])
    seen_a = np.stack([np.searchsorted(sets[k], row, "right") for k, row in zip(here, end, strict=True)])
    seen_b = np.stack([np.searchsorted(sets[k], row, "right") for k, row in zip(there, end.T, strict=True)]).T
    union = seen_a + seen_b - both
    exact = end == last
    sure = exact & (100 * both >= percent * union)
    share = percent / 100
    slack = DEVIATIONS * np.sqrt(share * (1 - share) / np.maximum(union, 1))
    doubt = ~exact & (both >= (share - slack) * union)
    if first == second:
        upper = np.triu(np.ones(both.shape, bool), 1)
        sure, doubt = sure & upper, doubt & upper
    numbers = {g: k for k, g in enumerate(dict.fromkeys(groups))}
    parent, found = list(range(len(numbers))), []
    for i, j in zip(*np.nonzero(sure), strict=True):
        a, b = here[i], there[j]
        x, y = _root(parent, numbers[groups[a]]), _root(parent, numbers[groups[b]])
        if x != y:
            parent[y] = x
            found.append((nodes[a], nodes[b], True))
    for i, j in zip(*np.nonzero(doubt), strict=True):
        a, b = here[i], there[j]
        if _root(parent, numbers[groups[a]]) != _root(parent, numbers[groups[b]]):
            found.append((min(nodes[a], nodes[b]), max(nodes[a], nodes[b]), False))
    return found


def _blocks_compared(percent: int):
    """Cut sorted rows into pairs of blocks and compare each; a task holds one pair at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current, found = None, []

        def finish() -> None:
            nodes, groups, sizes, blocks, lows = zip(*held, strict=True)
            sets = [np.frombuffer(low, np.uint64) for low in lows]
            found.extend(_compare_blocks(nodes, groups, sizes, blocks, sets, current[1], current[2], percent))

        def emit() -> pa.RecordBatch:
            a, b, sure = zip(*found, strict=True)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure, pa.bool_())], ["a", "b", "sure"])

        names = ("key", "one", "two", "node", "component", "n", "block", "low")
        for batch in batches:
            for key, one, two, *row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if (key, one, two) != current:
                    if held:
                        finish()
                    held, current = [], (key, one, two)
                held.append(tuple(row))
            if len(found) > 10_000:
                yield emit()
        if held:
            finish()
        if found:
            yield emit()

    return run


def _likely_pairs(scratch: Scratch, pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that neither sizes nor estimates rule out."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    close = (100 * F.least("n_a", "n_b")) >= (percent * F.greatest("n_a", "n_b"))
    sketched = pairs.join(side("a"), "a").join(side("b"), "b").filter(close)
    return scratch.store(sketched.mapInArrow(tidy(_likely(percent / 100)), "a long, b long"))


def _links(scratch: Scratch, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link by their full sets."""
    whole = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"
    )
    checked = whole.select("a", "b", "x", "y").mapInArrow(tidy(_verified(percent)), "a long, b long, linked boolean")
    return scratch.store(checked.filter("linked").select("a", "b"))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", percent: int = 85
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` with one row per row of ``docs``."""
    small_batches(spark)
    scratch = Scratch(spark, "near")
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    sketched = scratch.store(rows.mapInArrow(tidy(_sketches), "id long, n long, s1 long, s2 long, sketch binary"))
    classes = scratch.store(
        sketched.filter("n > 0 AND id IS NOT NULL")
        .groupBy("n", "s1", "s2")
        .agg(F.min("id").alias("node"), F.first("sketch").alias("sketch"))
    )
    bands = classes.select("node", "sketch").mapInArrow(tidy(_bands), "key long, node long")
    buckets = bands.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("leader")).filter("size > 1")
    members = scratch.store(bands.join(buckets.drop("size"), "key"))
    candidates = scratch.store(members.select("node").distinct())
    nodes = scratch.store(classes.join(candidates, "node", "left_semi").select("node", "n", "sketch"))
    sets = scratch.store(
        rows.join(candidates, F.col("id") == F.col("node"), "left_semi")
        .mapInArrow(tidy(_shingle_sets), "node long, shingles binary")
        .groupBy("node")
        .agg(F.first("shingles").alias("shingles"))
        if _repeated(rows)
        else rows.join(candidates, F.col("id") == F.col("node"), "left_semi").mapInArrow(tidy(_shingle_sets), "node long, shingles binary")
    )
    stars = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = _links(scratch, _likely_pairs(scratch, stars, nodes, percent), sets, percent)
    found = components(scratch, links)
    # Buckets that still hold members of different components.
    placed = members.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    open_keys = placed.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members")
    )
    open_keys = open_keys.filter("lo < hi").select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    dealt = placed.join(open_keys, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"one": F.least("block", "with"), "two": F.greatest("block", "with")})
    low = sets.select("node", F.substring("shingles", 1, 8 * LOW).alias("low"))
    dealt = dealt.join(nodes.select("node", "n").join(low, "node"), "node")
    dealt = dealt.select("key", "one", "two", "node", "component", "n", "block", "low")
    ordered = dealt.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    compared = scratch.store(ordered.mapInArrow(tidy(_blocks_compared(percent)), "a long, b long, sure boolean"))
    doubtful = compared.filter("NOT sure").select("a", "b").distinct()
    more = compared.filter("sure").select("a", "b").unionByName(_links(scratch, doubtful, sets, percent))
    found = components(scratch, links.unionByName(more))
    grouped = classes.join(found, "node", "left").select("n", "s1", "s2", F.coalesce("component", "node").alias("component_id"))
    grouped = scratch.store(grouped)
    scratch.drop(members, candidates, nodes, sets, links, compared)
    joined = sketched.drop("sketch").join(grouped, ["n", "s1", "s2"], "left")
    own = F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    result = joined.select("id", F.col("n").alias("n_shingles"), own.alias("component_id"))
    result = result.withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
    return result.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def _repeated(rows: DataFrame) -> bool:
    """Whether ids repeat; then one of their rows stands for the id."""
    return not rows.groupBy("id").count().filter("id IS NOT NULL AND count > 1").isEmpty()


def keep_one_of_each(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row of every group of near duplicates, with the columns of ``docs``."""
    doc_id = options.get("doc_id", "doc_id")
    scratch = Scratch(spark, "kept")
    judged = near_duplicates(spark, docs, **options)
    removed = scratch.store(judged.filter("NOT kept").select(F.col("id").alias("__id")).distinct())
    left = docs.join(removed, F.col(f"`{doc_id}`") == F.col("__id"), "left_anti")
    ids = docs.select(F.col(f"`{doc_id}`").alias("id"))
    if not _repeated(ids):
        return left
    again = ids.groupBy("id").count().filter("id IS NOT NULL AND count > 1").select(F.col("id").alias("__id"))
    same = F.col(f"`{doc_id}`") == F.col("__id")
    first = Window.partitionBy(f"`{doc_id}`").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    one = left.join(again, same, "left_semi").withColumn("__rank", F.row_number().over(first)).filter("__rank = 1")
    return left.join(again, same, "left_anti").unionByName(one.drop("__rank"))
