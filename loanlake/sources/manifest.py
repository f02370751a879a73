"""Manifest of snapshot files: checksum, path and time of the raw and processed file of a month."""

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .file_names import normalize_kind, snapshot_period, unit_path
from .snapshots import list_files

COMPONENT = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)
MANIFEST = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("snapshot_type", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("raw", COMPONENT),
        T.StructField("processed", COMPONENT),
    ]
)
SIDES = ("raw", "processed")
WHOLE_FILE = 1 << 28  # bytes of a file that is not read as one value
BLOCK_BYTES = 1 << 22


def manifest_key(kind: Column, year: Column, month: Column) -> Column:
    return F.format_string("%s:%04d-%02d", kind, year, month)


def key_text(kind: str, year: int, month: int) -> str:
    return f"{normalize_kind(kind)}:{year:04d}-{month:02d}"


def list_snapshots(spark: SparkSession, path: str, expected_kind: str | None = None) -> DataFrame:
    """``key, path`` of the snapshots below ``path`` with a usable name; an absent folder has none."""
    try:
        files = list_files(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string")
    units = files.select(unit_path(F.col("path")).alias("path")).distinct()
    found = units.withColumn("p", snapshot_period(F.col("path"), expected_kind)).filter(F.col("p.problem").isNull())
    return found.select(manifest_key(F.col("p.kind"), F.col("p.year"), F.col("p.month")).alias("key"), "path")


def _open(path: str) -> BinaryIO:
    """A file for reading block by block, by the path that Spark lists (its name is not escaped)."""
    scheme, store, name = re.fullmatch(r"([a-zA-Z0-9+.-]+):(?://([^/]*))?(/.*)", path, re.DOTALL).groups()
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + name.lstrip("/"))
    files, root = fs.FileSystem.from_uri(f"{scheme}://{store or ''}/")
    return files.open_input_stream(root.rstrip("/") + name)


def _streamed(open_file: Callable[[str], BinaryIO]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                digest = hashlib.sha256()
                with open_file(path) as stream:
                    while block := stream.read(BLOCK_BYTES):
                        digest.update(block)
                yield pa.RecordBatch.from_pydict({"path": [path], "checksum": [digest.hexdigest()]})

    return run


def _checksums(
    spark: SparkSession, path: str | list[str], glob: str | None, whole_file: int, open_file: Callable[[str], BinaryIO]
) -> DataFrame:
    """``path, checksum`` of files: small ones as one value, others block by block; all by the executors."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    # The length is checked before a file is opened.
    whole = files.filter(F.col("length") < whole_file).select("path", F.sha2("content", 256).alias("checksum"))
    large = files.filter(F.col("length") >= whole_file).select("path")
    # Files of this size are dealt out one by one; a lost executor costs the files it had.
    large = large.repartition(F.xxhash64("path")).mapInArrow(_streamed(open_file), "path string, checksum string")
    return whole.unionByName(large)


def fingerprint(
    spark: SparkSession,
    path: str | list[str],
    side: str,
    expected_kind: str | None = None,
    glob: str | None = None,
    *,
    whole_file: int = WHOLE_FILE,
    open_file: Callable[[str], BinaryIO] = _open,
) -> DataFrame:
    """Manifest rows of the snapshots below ``path``, checksummed.

    Files of ``whole_file`` bytes or more are streamed in the tasks by ``open_file``; the one
    given opens what Arrow's file systems know, another can be passed for other stores.

    A snapshot in several part files gets the checksum of their checksums.  Files
    whose name gives no usable period are left out; see :func:`unusable_files`.
    """
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}")
    info = snapshot_period(F.col("path"), expected_kind)
    sums = F.array_sort(F.collect_list(F.struct("path", "checksum")))
    whole = F.sha2(F.array_join(F.transform("sums", lambda x: x["checksum"]), ""), 256)
    component = F.struct(
        F.col("path"),
        F.when(F.size("sums") == 1, F.col("sums")[0]["checksum"]).otherwise(whole).alias("checksum"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
    )
    empty = F.lit(None).cast(COMPONENT)
    return (
        _checksums(spark, path, glob, whole_file, open_file)
        .groupBy(unit_path(F.col("path")).alias("path"))
        .agg(sums.alias("sums"))
        .withColumn("p", info)
        .filter(F.col("p.problem").isNull())
        .select(
            manifest_key(F.col("p.kind"), F.col("p.year"), F.col("p.month")).alias("key"),
            F.col("p.kind").alias("snapshot_type"),
            F.col("p.year").alias("year"),
            F.col("p.month").alias("month"),
            *[(component if s == side else empty).alias(s) for s in SIDES],
        )
    )


def unusable_files(files: DataFrame, expected_kind: str | None = None) -> DataFrame:
    """``path, problem`` of files that cannot be recorded."""
    info = snapshot_period(F.col("path"), expected_kind)
    return files.select("path", info["problem"].alias("problem")).filter("problem IS NOT NULL")


def merge(*tables: DataFrame) -> DataFrame:
    """Upsert by key: of each side the component with the latest time, the later table on a tie."""
    union = None
    for order, table in enumerate(tables):
        part = table.withColumn("_order", F.lit(order))
        union = part if union is None else union.unionByName(part)

    def latest(side: str) -> Column:
        recency = F.when(
            F.col(side).isNotNull(), F.struct(F.col(f"{side}.timestamp"), F.col("_order"), F.col(f"{side}.path"))
        )
        return F.max_by(side, recency).alias(side)

    return union.groupBy("key", "snapshot_type", "year", "month").agg(*[latest(s) for s in SIDES])


def statuses(manifest: DataFrame) -> DataFrame:
    """Manifest rows with ``is_downloaded`` and ``is_processed``."""
    return manifest.withColumns(
        {"is_downloaded": F.col("raw").isNotNull(), "is_processed": F.col("processed").isNotNull()}
    ).orderBy("key")


def status_of(manifest: DataFrame, kind: str, year: int, month: int) -> DataFrame:
    """The row of one month, or none."""
    return statuses(manifest).filter(F.col("key") == f"{normalize_kind(kind)}:{year:04d}-{month:02d}")


def load(spark: SparkSession, path: str) -> DataFrame:
    """The manifest; of what was appended to it, the latest component of each side.  An absent one is empty."""
    try:
        return merge(spark.read.schema(MANIFEST).json(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def save(manifest: DataFrame, path: str) -> None:
    """Write as JSON lines.  To update a manifest in place, use :func:`append`, or write to a new path."""
    manifest.write.mode("overwrite").json(path)


def append(manifest: DataFrame, path: str) -> None:
    """Add rows to a manifest; :func:`load` merges them with what is there."""
    manifest.write.mode("append").json(path)
