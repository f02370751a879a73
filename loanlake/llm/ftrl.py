"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are the hashes of its words, of their leading letters, of neighbouring
words and of words one and two apart, each counted once per text.  Only labelled rows
outside the held-out fold train, at most ``max_rows`` of them (those with the smallest
hash of their id), so that one task can make ``epochs`` passes of FTRL-proximal, with a
learning rate per coordinate and L1 sparsity.  The weight vector has ``2 ** bits`` entries,
few of them not zero; its size is bounded whatever the corpus, and it is broadcast for
scoring all texts.

Null and empty texts have no features and get the score of the bias.  Labels that are null
do not train; several labels of an id count as toxic if one of them is.  Rows are scored one
by one, so ties and repeated rows score alike.  Without a usable label all scores are 0.5,
so nothing can be said.  A column named ``score`` is replaced.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, crc_remainder, give_back, slices, small_batches, tidy

BITS = 20
FOLDS = 5
MAX_ROWS = 8_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 1.0
STEMS = (4, 5, 6)
# Fixed value: letters stay, ASCII capitals become small, other ASCII characters separate words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def features(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Distinct feature numbers of a text: words, stems, neighbours and skips."""
    words = text.translate(_TABLE).split() if text else []
    if not words:
        return np.empty(0, np.int32)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    parts = [h * _ODD[0]]
    distinct = set(words)
    for length in STEMS:
        stems = {w[:length] for w in distinct if len(w) > length}
        s = np.fromiter(map(xxhash.xxh3_64_intdigest, stems), np.uint64, len(stems))
        parts.append((s ^ np.uint64(length)) * _ODD[3])
    for gap in (1, 2, 3):
        if len(h) > gap:
            parts.append((h[:-gap] * _ODD[1] + h[gap:] * _ODD[2] + np.uint64(gap)) * _ODD[0])
    return np.unique(np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int32)


class Learner:
    """FTRL-proximal with a rate per coordinate; the last coordinate is the bias."""

    def __init__(self, bits: int):
        self.z = np.zeros(2**bits + 1)
        self.n = np.zeros(2**bits + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, L1)
        w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, label: float) -> None:
        at = np.append(at, np.int32(len(self.z) - 1))
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def _train(bits: int, epochs: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        learner = Learner(bits)
        rows = rows.sort_values("draw", kind="stable")
        texts, labels = rows.pop("text").tolist(), rows["label"].tolist()
        seen = []
        while texts:  # a text goes once its features are known
            seen.append((features(texts.pop(), bits), float(labels.pop())))
        for epoch in range(epochs):
            for k in np.random.default_rng(epoch).permutation(len(seen)):
                learner.learn(*seen[k])
        w = learner.weights(np.arange(2**bits + 1))
        del seen
        give_back()
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at, "weight": w[at]})

    return run


def fit(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    bits: int = BITS,
    max_rows: int = MAX_ROWS,
    epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights of the features and, last, of the bias; at most ``max_rows`` labelled rows train."""
    usable = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    usable = usable.filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    draw = F.xxhash64(F.lit(29), "id")
    train = usable.filter(crc_remainder(F.col("id"), FOLDS) != 0).withColumn("draw", draw)
    small_batches(spark)
    scratch = Scratch(spark, "ftrl")
    chosen = scratch.store(train.orderBy("draw", "id").limit(max_rows))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    sample = texts.join(F.broadcast(chosen), "id")  # at most max_rows rows of three numbers
    found = sample.withColumn("task", F.lit(0)).groupBy("task").applyInPandas(_train(bits, epochs), "at long, weight double").toPandas()
    scratch.drop(chosen)
    weights = np.zeros(2**bits + 1)
    weights[found["at"].to_numpy(np.int64)] = found["weight"].to_numpy()
    return weights


def _score(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        bits = (len(w) - 1).bit_length() - 1
        for batch in slices(batches, "__text"):
            odds = np.array([w[-1] + w[features(t.as_py(), bits)].sum() for t in batch.column("__text")])
            scores = pa.array(1 / (1 + np.exp(-np.clip(odds, -35, 35))) if len(odds) else [], pa.float64())
            kept = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), scores], [*kept, "score"])

    return run


def score(spark: SparkSession, docs: DataFrame, weights: np.ndarray, *, text: str = "text") -> DataFrame:
    """``docs`` with a ``score`` from 0 to 1 by its text alone; a column of that name is replaced."""
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "score"]
    rows = docs.select(*kept, F.col(f"`{text}`").cast("binary").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "__text")
    return rows.mapInArrow(tidy(_score(shared)), f"{schema}, score double")


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, their columns unchanged."""
    weights = fit(spark, docs, labels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    return score(spark, rows, weights).filter(F.col("score") < limit).select("row.*")
