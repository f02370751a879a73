"""Checks from counts that are stored per month, so that a run scans only months it has not seen.

Of every month two tables are kept below the state's folder: the party counts with their amount
ranges (``parties``), which answer all checks but one, and for key uniqueness the number of rows
and of different keys in blocks of the key space (``keys``).  Both add up over months.  A block
that only one month has needs no second look.  Keys of a block that several months share may be
equal across them, so those blocks, and only those, are counted again from the loans.

The counts of a month belong to the version of the month that they were made from.  A month
that is new, or changed since, is counted again; a month that is gone no longer counts.  The log
of :mod:`..sources.commits` makes both tables of a run visible at once.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import n_unique, sum0
from ..schemas import INDEX, MONTH, YEAR, silver_schema
from ..sources import commits
from ..sources.checkpoints import cut_lineage
from ..sources.commits import BEFORE, OWN, VERSION, Entry, Month
from ..sources.snapshots import list_files, partition_months
from . import validation

KEY = r"^(H?\d{6}01)_(\d{1,15})$"
BLOCK_KEYS = 1 << 16
OTHER_BLOCKS = 1 << 12  # of keys without the usual form, and of missing ones


def _slot() -> dict[str, Column]:
    """The part of the key space that a key lies in; equal keys lie in the same."""
    space = F.coalesce(F.regexp_extract(INDEX, KEY, 1), F.lit(""))
    number = F.regexp_extract(INDEX, KEY, 2).try_cast("bigint")
    other = F.pmod(F.xxhash64(INDEX), F.lit(OTHER_BLOCKS))
    return {"space": space, "block": F.when(space != "", F.floor(number / BLOCK_KEYS)).otherwise(other)}


def key_blocks(df: DataFrame) -> DataFrame:
    """``rows`` and different ``keys`` per month and block of the key space; a missing key is one key."""
    return (
        df.select(YEAR, MONTH, INDEX)
        .withColumns(_slot())
        .groupBy(YEAR, MONTH, "space", "block")
        .agg(F.count("*").alias("rows"), n_unique(INDEX).cast("bigint").alias("keys"))
    )


TABLES = {"parties": validation.check_base, "keys": key_blocks}


def _shown(spark: SparkSession, path: str) -> list[Entry]:
    """What makes up the silver table; months of a table without a log count as from before it."""
    entries = commits.load(spark, path)
    if entries is not None:
        return commits.visible(entries)
    months = partition_months(spark, path).collect()
    return [Entry(0, "", BEFORE, y, m, y, m, None, None) for y, m in months]


def _tags(spark: SparkSession, path: str, shown: list[Entry]) -> dict[Month, str]:
    """What tells the version of every month: its folders, and its files where folders have no version."""
    folders: dict[Month, list[str]] = {}
    for entry in shown:
        folders.setdefault(entry.of, []).append(entry.folder)
    tags = {month: ";".join(sorted(names)) for month, names in folders.items()}
    before = {e.of for e in shown if e.part == BEFORE}
    if before:
        place = rf"/{YEAR}=(\d+)/{MONTH}=(\d+)/[^/]+$"
        files = list_files(spark, path, "*.parquet").select(
            *[F.regexp_extract("path", place, k).try_cast("int").alias(c) for k, c in ((1, "year"), (2, "month"))],
            F.sha2(F.concat_ws("|", "path", "length", "modificationTime"), 256).alias("file"),
        )
        # A month has few files of the advisory size.
        sums = files.dropna().groupBy("year", "month").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("file")), ""), 256))
        for year, month, files_of in sums.collect():
            if (year, month) in before:
                tags[year, month] += f";{files_of}"
    return tags


def _schema(spark: SparkSession, name: str):
    return TABLES[name](spark.createDataFrame([], silver_schema())).schema


def _loans(spark: SparkSession, path: str, shown: list[Entry], months: Iterable[Month]) -> DataFrame:
    wanted = set(months)
    return commits.read(spark, path, silver_schema(), [e for e in shown if e.of in wanted]).drop(VERSION)


def _update(spark: SparkSession, silver_path: str, state_path: str) -> tuple[list[Month], list[Entry], list[Entry]]:
    """Months counted in this run, what the silver table shows, and the entries of its months' counts."""
    shown = _shown(spark, silver_path)
    tags = _tags(spark, silver_path, shown)
    entries = commits.load(spark, state_path) or []
    known = commits.newest(entries)
    due = sorted(m for m, tag in tags.items() if m not in known or known[m].checksum != tag)
    if due:
        number, version = commits.new_version(entries)
        rows = _loans(spark, silver_path, shown, due)
        for name, count in TABLES.items():
            table = count(rows).withColumn(VERSION, F.lit(version)).hint("rebalance", YEAR, MONTH)
            table.write.mode("append").partitionBy(YEAR, MONTH, VERSION).parquet(f"{state_path}/{name}")
        new = [Entry(number, version, OWN, *month, *month, 1, tags[month]) for month in due]
        stored = commits.read(spark, f"{state_path}/parties", _schema(spark, "parties"), new)
        counted = {(y, m): n for y, m, n in stored.groupBy(YEAR, MONTH).agg(F.sum("loans")).collect()}
        new = [e._replace(rows=counted.get(e.of, 0)) for e in new]
        commits.add(spark, state_path, new)
        known |= {e.of: e for e in new}
    return due, shown, [e for e in known.values() if e.of in tags and e.rows]


def update_checks(spark: SparkSession, silver_path: str, state_path: str) -> list[Month]:
    """Count the months of the silver table that are new or changed since the last run; returns them."""
    return _update(spark, silver_path, state_path)[0]


def _key_counts(spark: SparkSession, silver_path: str, shown: list[Entry], blocks: DataFrame) -> DataFrame:
    """One row: ``n`` rows and ``u`` different keys of the whole table."""
    slot = ["space", "block"]
    sums = blocks.groupBy(*slot).agg(
        F.count("*").alias("months"), F.sum("rows").alias("rows"), F.sum("keys").alias("keys")
    )
    shared = cut_lineage(blocks.join(sums.filter("months > 1").select(*slot), slot, "left_semi").select(YEAR, MONTH, *slot))
    # Months of the calendar, at most.
    months = [(y, m) for y, m in shared.select(YEAR, MONTH).distinct().collect()]
    alone = sums.select("rows", F.when(F.col("months") == 1, F.col("keys")).alias("keys"))
    if months:
        again = _loans(spark, silver_path, shown, months).select(INDEX).withColumns(_slot())
        again = again.join(shared.select(*slot).distinct(), slot, "left_semi").groupBy(*slot).agg(n_unique(INDEX).alias("keys"))
        alone = alone.unionByName(again.select(F.lit(0).cast("bigint").alias("rows"), F.col("keys").cast("bigint").alias("keys")))
    return alone.agg(sum0("rows").alias("n"), sum0("keys").alias("u"))


def run_stored_checks(
    spark: SparkSession,
    silver_path: str,
    state_path: str,
    names: Iterable[str] | None = None,
    *,
    threshold_pct: float = 5.0,
) -> DataFrame:
    """The results of :func:`.validation.run_checks` over the silver table, from the stored counts.

    Months that are new or changed are counted first; loans of other months are only read
    where blocks of keys are shared between months.
    """
    _, shown, entries = _update(spark, silver_path, state_path)
    names = list(validation.CHECKS) if names is None else list(names)
    parties, blocks = (
        commits.read(spark, f"{state_path}/{name}", _schema(spark, name), entries).drop(VERSION) for name in TABLES
    )
    keys = None
    if validation.UNIQUENESS in names:
        keys = _key_counts(spark, silver_path, shown, blocks)
    table = spark.createDataFrame([], silver_schema())
    return validation.run_checks(table, names, threshold_pct=threshold_pct, base=parties, key_counts=keys)
