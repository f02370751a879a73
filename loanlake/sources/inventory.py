"""Inventory of data files."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .file_names import base_name
from .sinks import write_tabular
from .snapshots import list_files, with_empty_files

SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")


def plain_folder(path: str) -> str:
    """A folder without scheme, as ``/a/b``."""
    return re.sub("^[a-zA-Z0-9]+:/+(?=.)", "/", path)


def plain_path(path: Column) -> Column:
    """Path without scheme, as ``/a/b``."""
    return F.regexp_replace(path, "^[a-zA-Z0-9]+:/+(?=.)", "/")


def relative_to(path: Column, base: str) -> Column:
    """Path below ``base``; the path itself if it lies elsewhere."""
    prefix = base.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).when(
        path == base.rstrip("/"), "."
    ).otherwise(path)


def readable_size(length: Column) -> Column:
    """``0 B``, ``12 B``, ``1.50 MB`` and so on."""
    out = None
    for power, unit in enumerate(SIZE_UNITS):
        text = (
            F.concat(length.cast("string"), F.lit(" B"))
            if power == 0
            else F.format_string(f"%.2f {unit}", length / F.lit(float(1024**power)))
        )
        last = power == len(SIZE_UNITS) - 1
        fits = F.lit(True) if last else length < F.lit(1024 ** (power + 1))
        out = F.when(fits, text) if out is None else out.when(fits, text)
    return out


def category(path: Column, *, raw_dir: str, clean_dir: str, data_dir: str) -> Column:
    def below(base: str) -> Column:
        return path.startswith(base.rstrip("/") + "/")

    return (
        F.when(below(raw_dir), "raw")
        .when(below(clean_dir), "clean")
        .when(below(data_dir), "data")
        .otherwise("outside-data")
    )


def describe_files(
    files: DataFrame, *, project_dir: str, data_dir: str, raw_dir: str, clean_dir: str
) -> DataFrame:
    """Inventory rows of listed files (``path, length, modificationTime``)."""
    project_dir, data_dir, raw_dir, clean_dir = map(plain_folder, (project_dir, data_dir, raw_dir, clean_dir))
    path = plain_path(F.col("path"))
    parent = F.regexp_replace(path, "/[^/]*$", "")
    name = base_name(path)
    return files.select(
        category(path, raw_dir=raw_dir, clean_dir=clean_dir, data_dir=data_dir).alias("category"),
        name.alias("file_name"),
        relative_to(path, project_dir).alias("relative_to_project"),
        relative_to(path, data_dir).alias("relative_to_data"),
        relative_to(parent, data_dir).alias("parent_directory"),
        F.regexp_extract(name, r"(?<=.)\.([^.]+)$", 1).alias("suffix"),
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / F.lit(float(1024**2)), 4).alias("size_mb"),
        readable_size(F.col("length")).alias("size_readable"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("modified_utc"),
    ).orderBy("category", "relative_to_data")


def inventory(
    spark: SparkSession, data_dir: str, *, project_dir: str, raw_dir: str, clean_dir: str
) -> DataFrame:
    """Every file below ``data_dir``; times are those of the session's time zone."""
    return describe_files(
        with_empty_files(list_files(spark, data_dir)),
        project_dir=project_dir,
        data_dir=data_dir,
        raw_dir=raw_dir,
        clean_dir=clean_dir,
    )


def write_inventory(table: DataFrame, path: str) -> None:
    write_tabular(table, path)
