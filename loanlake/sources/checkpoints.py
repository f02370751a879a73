"""Intermediate tables in the folder that all executors share."""

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_STORED: set[str] = set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and continue from there.

    Later steps read only the columns and row groups they need, the planner knows the
    size, and lost executors take nothing with them.  :func:`drop` removes a table that
    is not needed any more, :func:`drop_all` all that the session still has.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    _STORED.add(path)
    return stored


def drop(*tables: DataFrame) -> None:
    """Delete stored tables; frames that were not stored are left alone."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if path in _STORED:
            remove(table.sparkSession, path)
            _STORED.discard(path)


def drop_all(spark: SparkSession) -> None:
    """Delete every stored table, once the results that rest on them are written."""
    for path in list(_STORED):
        remove(spark, path)
        _STORED.discard(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
