"""Raw, bronze and silver tables of the monthly snapshots."""

import os
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import HECM_KIND, MONTH, SINGLE_FAMILY_KIND, YEAR, bronze_schema, silver_schema
from . import commits
from .file_names import bronze_period, is_snapshot, snapshot_period, unit_path

# Words that mark a data sheet, per program.
SHEET_WORDS = {
    SINGLE_FAMILY_KIND: ("Data", "Purchase", "Refinance"),
    HECM_KIND: ("Data", "Purchase", "Refinance", "data"),
}


def read_tabular(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header or Parquet, by suffix."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if suffix == ".csv":
        return reader.option("header", True).csv(path)
    if suffix in (".parquet", ".pq"):
        return reader.parquet(path)
    raise ValueError(f"Unsupported file extension for {path}")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``path``; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def with_empty_files(files: DataFrame) -> DataFrame:
    """Add the files of no length, which Spark lists but does not read; their time is null."""
    names = [(unquote(name),) for name in files.inputFiles()]
    listed = files.sparkSession.createDataFrame(names, "listed string")
    # Listed names may write the scheme as file:/// where read ones have file:/.
    same = F.regexp_replace("listed", ":/+", ":/") == F.regexp_replace("path", ":/+", ":/")
    empty = listed.join(files.select("path"), same, "left_anti")
    return files.unionByName(
        empty.select(F.col("listed").alias("path"), F.lit(0).cast("bigint").alias("length")),
        allowMissingColumns=True,
    )


# --- silver -----------------------------------------------------------------------------


def read_silver(spark: SparkSession, path: str, kind: str = SINGLE_FAMILY_KIND) -> DataFrame:
    """The table of months; the schema is given, so partition keys keep their type.

    Of every month the version that the table's log makes visible, see :mod:`.commits`; a
    table without a log is read as it lies.
    """
    entries = commits.load(spark, path)
    if entries is None:
        return spark.read.schema(silver_schema(kind)).parquet(path)
    return commits.read(spark, path, silver_schema(kind), commits.visible(entries)).drop(commits.VERSION)


def read_month(
    spark: SparkSession, path: str, year: int, month: int, kind: str = SINGLE_FAMILY_KIND
) -> DataFrame:
    """One month; only its partition is listed and read."""
    chosen = (F.col(YEAR) == year) & (F.col(MONTH) == month)
    entries = commits.load(spark, path)
    if entries is None:
        return read_silver(spark, path, kind).filter(chosen)
    own = [e for e in commits.visible(entries) if e.of == (year, month)]
    return commits.read(spark, path, silver_schema(kind), own).drop(commits.VERSION).filter(chosen)


def read_held_apart(spark: SparkSession, path: str, kind: str = SINGLE_FAMILY_KIND) -> DataFrame:
    """Rows that other snapshots have for months with a snapshot of their own, and rows that came late.

    ``source_year`` and ``source_month`` name the snapshot they came with.
    """
    entries = commits.held_apart(commits.load(spark, path) or [])
    rows = commits.read(spark, path, silver_schema(kind), entries)
    part = lambda k: F.regexp_extract(commits.VERSION, r"-from-(\d+)-(\d+)$", k).cast("int")
    return rows.withColumns({"source_year": part(1), "source_month": part(2)}).drop(commits.VERSION)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def partition_months(spark: SparkSession, path: str, year_key: str = YEAR, month_key: str = MONTH) -> DataFrame:
    """Distinct ``year, month`` of a partitioned table, read off the folders that its files lie in.

    Only the listing is used; an absent table has no months.
    """
    folder = rf"/{year_key}=(\d+)/{month_key}=(\d+)/[^/]+$"
    try:
        files = list_files(spark, path, "*.parquet")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "year int, month int")
    found = {
        name: F.nullif(F.regexp_extract("path", folder, i + 1), F.lit("")).cast("int").alias(name)
        for i, name in enumerate(("year", "month"))
    }
    return files.select(*found.values()).dropna().distinct()


def existing_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Months of the silver table that have rows."""
    entries = commits.load(spark, path)
    if entries is None:
        months = partition_months(spark, path)
    else:
        months = spark.createDataFrame(sorted({e.of for e in commits.visible(entries)}), "year int, month int")
    return months.select(F.col("year").alias(YEAR), F.col("month").alias(MONTH))


# --- bronze -----------------------------------------------------------------------------


def in_years(year: str, min_year: int | None, max_year: int | None) -> Column:
    """Whether a year lies within the bounds that are given."""
    inside = F.lit(True)
    if min_year is not None:
        inside = inside & (F.col(year) >= min_year)
    if max_year is not None:
        inside = inside & (F.col(year) <= max_year)
    return inside


def read_bronze(
    spark: SparkSession,
    path: str,
    kind: str | None = None,
    *,
    min_year: int | None = None,
    max_year: int | None = None,
) -> DataFrame:
    """Bronze rows, all or of a range of years, with ``snapshot_year`` and ``snapshot_month``.

    The months are partition folders, or part of the file names where the files lie
    side by side; either way rows of files outside the range are not read.  With a
    ``kind`` the columns are those of its program and no footer is opened to find them;
    without one the footers of all files are read to merge theirs.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if kind is None:
        reader = reader.option("mergeSchema", True)
    else:
        reader = reader.schema(bronze_schema(kind))
    files = reader.parquet(path)
    if "snapshot_year" not in files.columns:
        period = bronze_period(F.col("_metadata.file_path"))
        files = files.withColumns({"snapshot_year": period["year"], "snapshot_month": period["month"]})
    return files.filter(in_years("snapshot_year", min_year, max_year))


def bronze_months(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``year, month`` of a bronze folder, from its listing."""
    folders = partition_months(spark, path, "snapshot_year", "snapshot_month")
    try:
        names = list_files(spark, path, "*.parquet")
    except AnalysisException:
        return folders
    period = bronze_period(F.col("path"))
    named = names.select(period["year"].alias("year"), period["month"].alias("month"))
    return folders.unionByName(named).dropna().distinct()


def bronze_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``year, month, checksum`` of a bronze folder, from its listing: names, sizes and times of a month's files."""
    schema = "year int, month int, checksum string"
    try:
        files = list_files(spark, path, "*.parquet")
    except AnalysisException as error:
        if not commits.missing(error):
            raise
        return spark.createDataFrame([], schema)
    folder = [
        F.nullif(F.regexp_extract("path", r"/snapshot_year=(\d+)/snapshot_month=(\d+)/", k), F.lit("")).cast("int")
        for k in (1, 2)
    ]
    period = bronze_period(F.col("path"))
    year, month = F.coalesce(folder[0], period["year"]), F.coalesce(folder[1], period["month"])
    mark = F.xxhash64(F.substring_index("path", "/", -1), "length", "modificationTime")
    marked = files.select(year.alias("year"), month.alias("month"), mark.alias("mark")).dropna()
    # Order does not matter, and a month of any number of files is two numbers per task.
    text = F.format_string("%d:%016x", F.count("*"), F.bit_xor("mark"))
    return marked.groupBy("year", "month").agg(text.alias("checksum"))


# --- raw sheets -------------------------------------------------------------------------


def is_data_sheet(kind: str, sheet: str = "sheet_name") -> Column:
    words = SHEET_WORDS[kind]
    return F.col(sheet).rlike("|".join(words))


def pending_files(
    files: DataFrame, kind: str, processed: DataFrame | None = None, *, overwrite: bool = False
) -> DataFrame:
    """First snapshot of every month, without the months that are processed already.

    ``files`` has ``path``; ``processed`` has ``year, month``.  A snapshot is a file, or
    the folder of its part files.
    """
    units = files.select(unit_path(F.col("path")).alias("path")).distinct()
    info = snapshot_period(F.col("path"), kind)
    named = units.filter(is_snapshot(F.col("path"))).select("path", info.alias("p")).filter(F.col("p.problem").isNull())
    first = F.row_number().over(Window.partitionBy("p.year", "p.month").orderBy("path"))
    chosen = named.withColumn("rank", first).filter("rank = 1").select("path", "p.year", "p.month")
    if processed is None or overwrite:
        return chosen
    return chosen.join(processed.select("year", "month"), ["year", "month"], "left_anti").select(
        "path", "year", "month"
    )


def files_by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """CSV snapshots grouped by their header line; ``paths`` has a file or folder per month."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = tuple(spark.read.option("header", True).csv(path).columns)
        groups.setdefault(header, []).append(path)
    return list(groups.values())


def _place(column: str) -> Column:
    """The number of a sheet or row; a place that is no number fails the job."""
    number = F.expr(f"try_cast(`{column}` AS bigint)")
    return F.coalesce(number, F.raise_error(F.lit(f"{column} must be a number in every row")).cast("bigint"))


def with_period(rows: DataFrame, kind: str) -> DataFrame:
    """Rows of files with ``_p``, what :func:`snapshot_period` finds in the path of their file.

    The rules are applied once per file, of which there are few for every month, and not once per row.
    """
    placed = rows.withColumn("_file", F.col("_metadata.file_path"))
    files = placed.select("_file").distinct().withColumn("_p", snapshot_period(F.col("_file"), kind))
    known = rows.sparkSession.createDataFrame(files.collect(), files.schema)
    # Rows stay where they were read: without statistics the planner would deal them by file.
    return placed.join(F.broadcast(known), "_file", "left").drop("_file")


def read_raw_rows(
    spark: SparkSession, paths: str | list[str], kind: str, file_format: str = "parquet"
) -> DataFrame:
    """Rows of exported sheets with the kind, year and month of their file.

    Every row carries ``sheet_name``, ``sheet_ord`` and ``row_ord``, its place in the
    workbook; both numbers must be there.  Columns go by their names: CSV files are read
    with the header of their own.  Sheets without data are left out.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)

    def read(some: list[str]) -> DataFrame:
        reader = spark.read.format(file_format)
        if file_format == "csv":
            reader = reader.option("header", True).option("enforceSchema", False)
        elif file_format == "parquet":
            reader = reader.option("mergeSchema", True)
        return with_period(reader.load(some), kind)

    rows = None
    for some in files_by_header(spark, listed) if file_format == "csv" else [listed]:
        part = read(some)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    usable = F.col("_p.problem").isNull() & is_data_sheet(kind)
    place = {f"snapshot_{part}": F.col(f"_p.{part}") for part in ("kind", "year", "month")}
    place |= {column: _place(column) for column in ("sheet_ord", "row_ord")}
    return rows.filter(usable).withColumns(place).drop("_p")
