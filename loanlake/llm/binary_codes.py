"""Near-duplicate vectors by randomised-rotation binary codes.

Unit vectors are rotated by fixed random rotations; the signs of the coordinates are the
codes, and the inner product of a rotated vector with its own code is stored as its
correction factor.  Keys of twenty signs find candidates: vectors of one label that agree in
one of the 48 keys share a bucket (a pair at cosine 0.98 agrees in none with a probability of
4e-7).  Inside a bucket the code and its factor give an unbiased estimate of every inner
product with a confidence bound of six standard deviations; only pairs whose bound reaches the
threshold are computed exactly, in double precision, and only those link.

Equal vectors of a label are one class first.  A bucket is dealt into blocks of bounded size
and every task compares two blocks, so no task holds a whole bucket.  A pair found under
several keys is counted under the first.  Tasks return numbers of links per vector and a
spanning forest of the links they found, never the pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and vectors without a
label, link with nothing.  Vectors of different length never link.  Rows that share an id are one
vector (their links count once per row of the others); rows without an id link with nothing and
are kept.  An empty table gives an empty result.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, small_batches, tidy

KEYS, KEY_BITS = 48, 20
BLOCK = 1024
DEVIATIONS = 6.0
SEED = 5


@lru_cache(maxsize=4)
def rotations(size: int, bits: int) -> np.ndarray:
    """Random rotations side by side, ``size`` columns each, until there are ``bits`` columns."""
    rng = np.random.default_rng([SEED, size])
    parts = []
    for _ in range(-(-bits // size)):
        q, r = np.linalg.qr(rng.standard_normal((size, size)))
        parts.append(q * np.sign(np.diag(r)))
    return np.concatenate(parts, axis=1)


def unit(vector) -> np.ndarray | None:
    """The vector in double precision at length 1, or None if it has no direction."""
    if vector is None or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    peak = np.abs(v).max()
    if peak == 0:
        return None
    v = v / peak
    return v / np.sqrt(v @ v)


def keys_of(units: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """One number per key: the signs of its rotated coordinates."""
    signs = (units @ turned)[:, : KEYS * KEY_BITS] > 0
    powers = 1 << np.arange(KEY_BITS, dtype=np.int64)
    return signs.reshape(len(units), KEYS, KEY_BITS) @ powers


def code_and_factor(units: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the first rotation as +-1 / sqrt(size), and their inner product with the rotated vector."""
    size = units.shape[1]
    rotated = units @ turned[:, :size]
    code = np.where(rotated > 0, 1.0, -1.0) / np.sqrt(size)
    return code, (code * rotated).sum(1)


def estimates(code: np.ndarray, factor: np.ndarray, rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of inner products of coded vectors with full ones, and their deviation per unit of distance.

    The error of an estimate is the part of the full vector that is orthogonal to the coded
    one, seen through the code: its deviation is ``sqrt(1 - f * f) / f / sqrt(size - 1)`` times
    that part's length.
    """
    size = max(code.shape[1] - 1, 1)
    deviation = np.sqrt(np.clip(1 - factor * factor, 0, None)) / factor / np.sqrt(size)
    return (code @ rotated.T) / factor[:, None], deviation


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of doubles."""
    for batch in batches:
        found = [unit(v) for v in batch.column("vector").to_pylist()]
        ok = np.array([u is not None for u in found], bool)
        raw = pa.array([u.tobytes() for u in found if u is not None], pa.binary())
        kept = batch.select(["id", "label"]).filter(pa.array(ok))
        yield pa.RecordBatch.from_arrays([*kept.columns, raw], ["id", "label", "unit"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column("unit").to_pylist()
        nodes, labels = batch.column("node").to_numpy(), batch.column("label").to_pylist()
        by_size: dict[int, list[int]] = {}
        for k, r in enumerate(raw):
            by_size.setdefault(len(r) // 8, []).append(k)
        for size, rows in by_size.items():
            units = np.frombuffer(b"".join(raw[k] for k in rows)).reshape(-1, size)
            keys = keys_of(units, rotations(size, KEYS * KEY_BITS))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(nodes[rows], KEYS)),
                    pa.array(np.repeat(np.array([labels[k] for k in rows], object), KEYS).tolist(), batch.schema.field("label").type),
                    pa.array(np.tile(np.arange(KEYS, dtype=np.int32), len(rows))),
                    pa.array(keys.ravel()),
                    pa.array(np.full(len(rows) * KEYS, size, np.int32)),
                ],
                ["node", "label", "band", "key", "size"],
            )


def _compare(rows: list[tuple], first: int, second: int, band: int, size: int, threshold: float) -> list[tuple[int, int, int]]:
    """Links between two blocks of a bucket (one if both are the same): node, its links, a root of its forest."""
    rows = list({row[0]: row for row in rows}.values())
    nodes, blocks, raw, copies = (np.array(x) if k != 2 else x for k, x in enumerate(zip(*rows, strict=True)))
    here = np.flatnonzero(blocks == first)
    there = here if first == second else np.flatnonzero(blocks == second)
    if not len(here) or not len(there) or (first == second and len(here) < 2):
        return []
    turned = rotations(size, KEYS * KEY_BITS)
    units = np.frombuffer(b"".join(raw)).reshape(-1, size)
    code, factor = code_and_factor(units[here], turned)
    estimate, deviation = estimates(code, factor, units[there] @ turned[:, :size])
    # At the threshold the orthogonal part has this length; it is shorter above.
    slack = DEVIATIONS * deviation * np.sqrt(1 - threshold * threshold)
    i, j = np.nonzero(estimate >= (threshold - slack)[:, None])
    i, j = here[i], there[j]
    if first == second:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return []
    keys = keys_of(units, turned) if band else None
    links = np.zeros(len(nodes), np.int64)
    parent = np.arange(len(nodes))
    for start in range(0, len(i), 200_000):
        a, b = i[start : start + 200_000], j[start : start + 200_000]
        if band:  # a pair that shares an earlier key was counted there
            again = (keys[a, :band] == keys[b, :band]).any(1)
            a, b = a[~again], b[~again]
        exact = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
        a, b = a[exact], b[exact]
        links += np.bincount(a, copies[b], len(nodes)).astype(np.int64)
        links += np.bincount(b, copies[a], len(nodes)).astype(np.int64)
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = _root(parent, x), _root(parent, y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [(int(nodes[k]), int(links[k]), int(nodes[_root(parent, k)])) for k in np.flatnonzero(links)]


def _blocks_compared(threshold: float):
    """Cut sorted rows into pairs of blocks and compare each; a task holds one pair at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current, found = None, []

        def emit() -> pa.RecordBatch:
            columns = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["node", "links", "other"])

        group = ("label", "band", "key", "size", "one", "two")
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in group), strict=True)
            rows = zip(*(batch.column(c).to_pylist() for c in ("node", "block", "unit", "copies")), strict=True)
            for key, row in zip(keys, rows, strict=True):
                if key != current:
                    if len(held) > 1:
                        found.extend(_compare(held, current[4], current[5], current[1], current[3], threshold))
                    held, current = [], key
                held.append(row)
            if len(found) > 10_000:
                yield emit()
        if len(held) > 1:
            found.extend(_compare(held, current[4], current[5], current[1], current[3], threshold))
        if found:
            yield emit()

    return run


def _root(parent, k: int) -> int:
    while parent[k] != k:
        parent[k] = parent[parent[k]]
        k = parent[k]
    return k


def near_vectors(
    spark: SparkSession,
    table: DataFrame,
    *,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    threshold: float = 0.98,
) -> DataFrame:
    """``id, n_links, component_id, kept`` with one row per row of ``table``."""
    small_batches(spark)
    scratch = Scratch(spark, "codes")
    rows = table.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("id"),
        F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    kind = rows.schema["label"].dataType.simpleString()
    usable = rows.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    units = scratch.store(usable.mapInArrow(tidy(_units), f"id long, label {kind}, unit binary"))
    classes = scratch.store(
        units.groupBy("label", "unit").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    )
    marks = scratch.store(
        classes.select("node", "label", "unit").mapInArrow(
            tidy(_keys), f"node long, label {kind}, band int, key long, size int"
        )
    )
    bucket = ["label", "band", "key", "size"]
    full = marks.groupBy(*bucket).agg(F.count("*").alias("members")).filter("members > 1")
    dealt = marks.join(full, bucket).withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A member meets every block of its bucket once: those before its own as the second, the others as the first.
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"one": F.least("block", "with"), "two": F.greatest("block", "with")})
    members = dealt.join(classes.select("node", F.col("label").alias("own_label"), "unit", "copies"), "node")
    members = members.filter(F.col("label") == F.col("own_label"))
    group = [*bucket, "one", "two"]
    ordered = members.select(*group, "block", "node", "unit", "copies").repartition(*group).sortWithinPartitions(*group)
    found = scratch.store(ordered.mapInArrow(tidy(_blocks_compared(threshold)), "node long, links long, other long"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(scratch, found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    judged = classes.join(counts, "node", "left").join(linked, "node", "left")
    judged = judged.select(
        "label",
        "unit",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    own = units.join(judged, ["label", "unit"]).groupBy("id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    own = scratch.store(own)
    scratch.drop(marks, found, units, classes)
    result = rows.select("id").join(own, "id", "left")
    component = F.coalesce("component_id", "id")
    return result.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
