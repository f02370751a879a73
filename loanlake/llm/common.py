"""Helpers shared by the text operators: words, stored intermediate tables, components of links."""

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.checkpoints import ensure_checkpoint_dir

# The characters that separate words (space and \x09 to \x0D).
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null and for texts without one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; an id that is null counts as remainder 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus, F.lit(0))


BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of 500 rows where the session has Spark's 10,000.

    A batch exists in the executor and in its worker at once, so its size counts twice per core.
    """
    if spark.conf.get(BATCH_KEY) == "10000":
        spark.conf.set(BATCH_KEY, BATCH_ROWS)


def give_back() -> None:
    """Return freed memory to the system; Python workers stay while other stages run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function over the batches of a task that gives its memory back at the end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a column of texts holds about ``limit`` bytes, and never less than a row."""
    for batch in batches:
        start = total = 0
        for k, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if total and total + size > limit:
                yield batch.slice(start, k - start)
                start, total = k, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


class Scratch:
    """Tables written once under the shared checkpoint folder and read back.

    A stored table cuts the lineage, survives the loss of executors, and tells the
    planner its size.  ``drop`` removes tables that nothing needs any more.
    """

    def __init__(self, spark: SparkSession, name: str, compression: str = "snappy"):
        self.spark, self.compression = spark, compression
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def store(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.option("compression", self.compression).parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._scratch_path = path
        return stored

    def tidy(self) -> None:
        """Let Spark delete the shuffle files of stored tables' jobs now.

        It does so when the driver collects its garbage, which on a large driver may be long after.
        """
        gc.collect()
        self.spark._jvm.System.gc()

    def close(self) -> None:
        """Delete all tables, once the results that rest on them are written."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """Smallest node of every connected component: ``links(a, b)`` to ``(node, component)``.

    Nodes are longs; nodes without a link are absent.  Large-star and small-star steps
    alternate until no edge changes, so chains halve each round; a node of high degree
    only meets a minimum per group, which is combined before the shuffle.
    """
    edges = scratch.store(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: every larger neighbour points to the smallest one.
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: smaller neighbours and the node itself point to the smallest one.
        down = large.filter("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        after = scratch.store(small.filter("u <> v").distinct())
        changed = after.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(
            after, ["u", "v"], "left_anti"
        ).isEmpty()
        scratch.drop(edges)
        edges = after
        if changed:
            break
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)

