"""Writers."""

import os

from pyspark.sql import DataFrame

PARQUET_SUFFIXES = (".parquet", ".pq")


def _suffix(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def write_tabular(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write CSV or Parquet, by the suffix of ``path``."""
    suffix = _suffix(path)
    if suffix == ".csv":
        df.write.mode(mode).option("header", True).csv(path)
    elif suffix in PARQUET_SUFFIXES:
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"Unsupported file extension for {path}")


def result_path(output_path: str, default_name: str) -> str:
    """``output_path`` if it names a file, else ``default_name`` below it."""
    return output_path if _suffix(output_path) else os.path.join(output_path, default_name)


def write_result(df: DataFrame, output_path: str | None, default_name: str) -> DataFrame:
    """Write a result table if a path is given.

    Returns the frame itself, or the written table so that it is not computed again.
    """
    if output_path is None:
        return df
    target = result_path(str(output_path), default_name)
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
