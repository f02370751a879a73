"""Versions of a table of months, and the log that makes them visible.

A write puts its rows into folders of its own, ``Year=/Month=/version=``, and then adds one file to
the log ``_commits``.  Until then no reader sees anything of it, afterwards all of it; a write that
broke off leaves folders that the log never names.

The log is keyed by source snapshot.  A snapshot (the files of one month) is complete once the log
has its entry, however many rows it had and whatever months its rows name.  Rows that name another
month than their snapshot's are stray rows.  They have folders of their own.  Of a month readers see

* the rows of its own snapshot, in the newest version,
* or, until that snapshot has come, the stray rows of other snapshots,
* or the files of a table that was there before the log.

Stray rows of a month with a snapshot of its own are held apart: they can be read and counted, and
never replace or join the month's rows.
"""

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MONTH, YEAR

LOG = "_commits"
VERSION = "version"
#: Parts of a month: rows of its own snapshot, rows of another snapshot, rows that came for a snapshot
#: that was complete already, and files from before the log.
OWN, STRAY, LATE, BEFORE = "own", "stray", "late", "before"
ENTRIES = (
    "number bigint, version string, part string, year int, month int, source_year int, source_month int, "
    "rows bigint, checksum string, name string"
)
Month = tuple[int, int]


class Entry(NamedTuple):
    """Rows of ``year, month`` that a commit took from the snapshot ``source_year, source_month``."""

    number: int
    version: str
    part: str
    year: int
    month: int
    source_year: int
    source_month: int
    rows: int | None
    checksum: str | None
    name: str | None = None  # of the folder, where it is not the version's

    @property
    def of(self) -> Month:
        return self.year, self.month

    @property
    def source(self) -> Month:
        return self.source_year, self.source_month

    @property
    def folder(self) -> str:
        place = f"{YEAR}={self.year}/{MONTH}={self.month}"
        return f"{place}/*.parquet" if self.part == BEFORE else f"{place}/{VERSION}={self.name or self.version}"


def missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def load(spark: SparkSession, path: str) -> list[Entry] | None:
    """All entries of a table's log; None if it has no log.

    A snapshot per month of the calendar, and one for every correction of it: a short list.
    """
    try:
        rows = spark.read.schema(ENTRIES).json(f"{path}/{LOG}").collect()
    except AnalysisException as error:
        if not missing(error):
            raise
        return None
    return [Entry(*row) for row in rows]


def newest(entries: Iterable[Entry]) -> dict[Month, Entry]:
    """The newest own entry of every complete snapshot."""
    found: dict[Month, Entry] = {}
    for entry in entries:
        if entry.part in (OWN, BEFORE):
            known = found.get(entry.of)
            if known is None or (entry.number, entry.version) > (known.number, known.version):
                found[entry.of] = entry
    return found


def strays(entries: Iterable[Entry]) -> list[Entry]:
    """Entries of stray and late rows; those of a snapshot's replaced versions are gone."""
    entries = list(entries)
    complete = newest(entries)
    return [
        e
        for e in entries
        if e.part == LATE or (e.part == STRAY and e.source in complete and complete[e.source].version == e.version)
    ]


def visible(entries: Iterable[Entry]) -> list[Entry]:
    """Entries whose folders make up the table."""
    entries = list(entries)
    complete = newest(entries)
    own = [e for e in complete.values() if e.part == BEFORE or e.rows]
    return own + [e for e in strays(entries) if e.of not in complete]


def held_apart(entries: Iterable[Entry]) -> list[Entry]:
    """Entries of stray rows for months that have a snapshot of their own."""
    entries = list(entries)
    complete = newest(entries)
    return [e for e in strays(entries) if e.of in complete]


def new_version(entries: Iterable[Entry]) -> tuple[int, str]:
    """Number and name of the next version; the name is new even if a write with this number broke off."""
    number = max((e.number for e in entries), default=0) + 1
    return number, f"{number:06d}-{uuid4().hex[:8]}"


def stray_name(version: Column, year: Column, month: Column) -> Column:
    """Column with the folder name of rows that a snapshot has for other months."""
    return F.format_string("%s-from-%04d-%02d", version, year.cast("int"), month.cast("int"))


def add(spark: SparkSession, path: str, entries: list[Entry]) -> None:
    """Make a version visible; the entries become one file, so all are seen at once."""
    rows = [tuple(e) for e in entries]
    spark.createDataFrame(rows, ENTRIES).coalesce(1).write.mode("append").json(f"{path}/{LOG}")


def folder_counts(spark: SparkSession, path: str, version: str) -> list[tuple[Month, Month | None, str, int]]:
    """``month, source, folder name, rows`` of what a version wrote; the files' footers are enough.

    The source is None for rows of a month's own snapshot.
    """
    reader = spark.read.option("basePath", path).schema(f"`{YEAR}` int, `{MONTH}` int, {VERSION} string")
    try:
        files = reader.parquet(f"{path}/{YEAR}=*/{MONTH}=*/{VERSION}={version}*")
    except AnalysisException as error:
        if not missing(error):
            raise
        return []
    out = []
    for row in files.groupBy(YEAR, MONTH, VERSION).count().collect():
        tail = row[VERSION].removeprefix(version)
        source = tuple(map(int, tail.split("-")[-2:])) if tail else None
        out.append(((row[YEAR], row[MONTH]), source, row[VERSION], row["count"]))
    return out


def read(spark: SparkSession, path: str, schema: T.StructType, entries: Iterable[Entry]) -> DataFrame:
    """The rows of entries, with their ``version`` (null for files from before the log)."""
    entries = list(entries)
    versioned = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    parts = []
    for before in (False, True):
        folders = sorted({f"{path}/{e.folder}" for e in entries if (e.part == BEFORE) == before})
        if folders:
            part = spark.read.option("basePath", path).schema(schema if before else versioned).parquet(*folders)
            part = part.withColumn(VERSION, F.lit(None).cast("string")) if before else part
            parts.append(part.select(*(F.col(f"`{c}`") for c in versioned.names)))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], versioned)
