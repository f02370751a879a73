"""Incremental ingest of bronze months as a file stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.import_snapshots import append_months
from ..schemas import SINGLE_FAMILY_KIND, bronze_schema

MONTH_COLUMNS = [
    T.StructField("snapshot_year", T.IntegerType()),
    T.StructField("snapshot_month", T.IntegerType()),
]


def bronze_stream(spark: SparkSession, bronze_path: str, kind: str = SINGLE_FAMILY_KIND) -> DataFrame:
    """New files of the bronze folder, months taken from the partition folders."""
    return spark.readStream.schema(T.StructType(bronze_schema(kind).fields + MONTH_COLUMNS)).parquet(bronze_path)


def ingest_new_months(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint_path: str,
    kind: str = SINGLE_FAMILY_KIND,
    *,
    corrections: bool = False,
    **export,
) -> StreamingQuery:
    """Clean and store every bronze file once, then stop.

    All waiting files form one batch, so the files of a month are stored together.
    The stream's checkpoint remembers which files were taken.  A batch that is
    replayed after a failure writes the months again that were not complete.  Files that
    come for a month stored already are late: their rows are kept apart, or, with
    ``corrections``, replace the month.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        append_months(batch.sparkSession, batch, silver_path, kind, corrections=corrections, **export)

    return (
        bronze_stream(spark, bronze_path, kind)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
