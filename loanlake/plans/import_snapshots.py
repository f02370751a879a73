"""Raw sheets to bronze, bronze to silver."""

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import BLOCK, PLACE_COLUMNS, clean, export_rows, one_of_each, prepare_export
from ..operators.row_keys import with_row_keys
from ..schemas import MONTH, SINGLE_FAMILY_KIND, YEAR
from ..sources import commits, manifest, snapshots
from ..sources.checkpoints import remove


SNAPSHOT = ("snapshot_year", "snapshot_month")
BLOCK_ROWS = 1 << 18  # about as many rows of a month has a block


def bronze_rows(raw: DataFrame, kind: str) -> DataFrame:
    """Clean raw rows and number them per monthly file."""
    keep = ("snapshot_year", "snapshot_month")
    cleaned = with_row_keys(clean(raw, kind))
    return cleaned.drop(*[c for c in PLACE_COLUMNS if c not in keep])


def write_months(df: DataFrame, path: str, *keys: str) -> None:
    """Write partition folders, replacing only those that ``df`` has.

    Rows are rebalanced by month, so a month is one file of the advisory size if it
    is small and many files if it is large.  Rows with a ``BLOCK`` were dealt by month and
    block before and stay where they are.
    """
    placed = df.drop(BLOCK) if BLOCK in df.columns else df.hint("rebalance", *keys)
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def convert_snapshots(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    kind: str = SINGLE_FAMILY_KIND,
    *,
    overwrite: bool = False,
    file_format: str = "parquet",
    manifest_path: str | None = None,
) -> list[tuple[int, int]]:
    """Clean the raw months that bronze does not have yet; returns those months.

    With a ``manifest_path`` the raw and bronze files of every month are recorded there,
    also of months that were converted before and have no record yet.
    """
    files = snapshots.list_files(spark, raw_path)
    done = snapshots.bronze_months(spark, bronze_path)
    # At most one file per month of the calendar, so a short list.
    pending = snapshots.pending_files(files, kind, done, overwrite=overwrite).orderBy("year", "month").collect()
    months = [(row["year"], row["month"]) for row in pending]
    if pending:
        raw = snapshots.read_raw_rows(spark, [row["path"] for row in pending], kind, file_format)
        write_months(bronze_rows(raw, kind), bronze_path, "snapshot_year", "snapshot_month")
    if manifest_path is not None:
        record_files(spark, raw_path, bronze_path, manifest_path, kind, months)
    return months


def record_files(
    spark: SparkSession, raw_path: str, bronze_path: str, manifest_path: str, kind: str, months: list[tuple[int, int]]
) -> None:
    """Append the raw and bronze files of ``months``, and of months without a record, to a manifest."""
    known = manifest.load(spark, manifest_path)
    now = [manifest.key_text(kind, year, month) for year, month in months]
    for side, path in (("raw", raw_path), ("processed", bronze_path)):
        have = known.filter(F.col(side).isNotNull() & ~F.col("key").isin(now)).select("key")
        # A snapshot per month of the calendar at most, so a short list.
        new = [row["path"] for row in manifest.list_snapshots(spark, path, kind).join(have, "key", "left_anti").collect()]
        if new:
            manifest.append(manifest.fingerprint(spark, new, side, kind), manifest_path)


def silver_rows(
    bronze: DataFrame,
    kind: str = SINGLE_FAMILY_KIND,
    *,
    county_reference: DataFrame | None = None,
    add_date: bool = True,
    blank_as_null: bool = False,
) -> DataFrame:
    return prepare_export(
        bronze.drop("snapshot_year", "snapshot_month"),
        kind,
        county_reference=county_reference,
        add_date=add_date,
        blank_as_null=blank_as_null,
    )


def without_stored_months(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Leave out rows of months that are stored already, whatever file they are in."""
    return rows.join(stored.select(YEAR, MONTH), [YEAR, MONTH], "left_anti")


def _log(spark: SparkSession, silver_path: str) -> list[commits.Entry]:
    """Entries of the table's log; before the first one, those of the months that lie there."""
    entries = commits.load(spark, silver_path)
    if entries is not None:
        return entries
    # At most one folder per month of the calendar.
    months = sorted((r["year"], r["month"]) for r in snapshots.partition_months(spark, silver_path).collect())
    done = _complete_before(spark, silver_path)
    return [
        commits.Entry(0, "", commits.BEFORE, *m, *m, None, None) for m in months if done is None or m in done
    ]


def _complete_before(spark: SparkSession, silver_path: str) -> set[commits.Month] | None:
    """Months that a log of earlier versions of this library names; None without such a log."""
    try:
        rows = spark.read.schema(f"`{YEAR}` int, `{MONTH}` int").json(f"{silver_path}/_complete").collect()
    except AnalysisException as error:
        if not commits.missing(error):
            raise
        return None
    return {tuple(row) for row in rows}


def stored_months(spark: SparkSession, silver_path: str) -> DataFrame:
    """``Year, Month`` of the snapshots that were stored to their end, with or without rows."""
    complete = commits.newest(_log(spark, silver_path))
    return spark.createDataFrame(sorted(complete), f"`{YEAR}` int, `{MONTH}` int")


def month_versions(spark: SparkSession, silver_path: str) -> DataFrame:
    """The log: what every import took from every snapshot, and which of it makes up the table."""
    entries = commits.load(spark, silver_path) or []
    shown = set(commits.visible(entries))
    rows = [(*e, e in shown) for e in entries]
    return spark.createDataFrame(rows, f"{commits.ENTRIES}, visible boolean")


def late_rows(spark: SparkSession, silver_path: str) -> DataFrame:
    """``Year, Month, rows`` held apart: rows of other snapshots, or late ones, for months with a snapshot of their own."""
    counts: dict[commits.Month, int] = {}
    for entry in commits.held_apart(commits.load(spark, silver_path) or []):
        counts[entry.of] = counts.get(entry.of, 0) + entry.rows
    rows = [(*month, n) for month, n in sorted(counts.items())]
    return spark.createDataFrame(rows, f"`{YEAR}` int, `{MONTH}` int, rows bigint")


def snapshot_sizes(bronze: DataFrame) -> dict[commits.Month, int]:
    """Rows of every snapshot: months of the calendar, a short list by nature."""
    return {(y, m): n for y, m, n in bronze.groupBy(*SNAPSHOT).count().collect()}


def _blocks(sizes: Mapping[commits.Month, int]) -> Column:
    """Into how many blocks the rows of a snapshot are dealt."""
    large = {m: -(-n // BLOCK_ROWS) for m, n in sizes.items() if n > BLOCK_ROWS and None not in m}
    if not large:
        return F.lit(1)
    known = F.create_map(*[F.lit(x) for (y, m), n in large.items() for x in (y * 100 + m, n)])
    return F.coalesce(F.try_element_at(known, (F.col(SNAPSHOT[0]) * 100 + F.col(SNAPSHOT[1])).cast("int")), F.lit(1))


def store_months(
    spark: SparkSession,
    bronze: DataFrame,
    silver_path: str,
    kind: str,
    months: Iterable[commits.Month],
    checksums: Mapping[commits.Month, str] | None = None,
    sizes: Mapping[commits.Month, int] | None = None,
    **export,
) -> None:
    """Store the snapshots ``months`` of bronze rows as a new version, and all other rows as late ones.

    The rows are written once; the log then names the version, so readers see all of it or nothing.
    ``sizes`` has the rows of every snapshot and is made here if it is not given.
    """
    sizes = snapshot_sizes(bronze) if sizes is None else sizes
    entries = _log(spark, silver_path)
    number, version = commits.new_version(entries)
    if commits.load(spark, silver_path) is None:
        # From here on only what the log names is part of the table.
        commits.add(spark, silver_path, entries)
    rows = export_rows(bronze, kind, **export)
    own = (F.col("snapshot_year") == F.col(YEAR)) & (F.col("snapshot_month") == F.col(MONTH))
    taken = sorted(set(months))
    known = F.struct(F.col("snapshot_year").cast("int"), F.col("snapshot_month").cast("int")).isin(
        [F.struct(F.lit(y).cast("int"), F.lit(m).cast("int")) for y, m in taken]
    )
    elsewhere = commits.stray_name(F.lit(version), F.col("snapshot_year"), F.col("snapshot_month"))
    name = F.when(F.coalesce(own & (known if taken else F.lit(False)), F.lit(False)), version).otherwise(elsewhere)
    placed = one_of_each(rows.withColumn(commits.VERSION, name), SNAPSHOT, _blocks(sizes))
    write_months(placed.drop(*SNAPSHOT), silver_path, YEAR, MONTH, commits.VERSION)

    counts = commits.folder_counts(spark, silver_path, version)
    own_rows = {month: n for month, source, _, n in counts if source is None}
    checksums = checksums or {}
    added = [commits.Entry(number, version, commits.OWN, *m, *m, own_rows.get(m, 0), checksums.get(m)) for m in taken]
    for month, source, folder, n in counts:
        if source is not None:
            part = commits.STRAY if source in taken else commits.LATE
            added.append(commits.Entry(number, version, part, *month, *source, n, None, folder))
    commits.add(spark, silver_path, added)


def _checksums(spark: SparkSession, bronze_path: str) -> dict[commits.Month, str]:
    """Checksum of every bronze month; a month of the calendar each."""
    return {(r["year"], r["month"]): r["checksum"] for r in snapshots.bronze_checksums(spark, bronze_path).collect()}


def save_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    kind: str = SINGLE_FAMILY_KIND,
    *,
    min_year: int | None = None,
    max_year: int | None = None,
    **export,
) -> None:
    """Full export, of a range of years if bounds are given; nothing is written if it has no files."""
    bronze = snapshots.read_bronze(spark, bronze_path, kind, min_year=min_year, max_year=max_year)
    checksums = _checksums(spark, bronze_path)
    months = [m for m in checksums if _inside(m[0], min_year, max_year)]
    if months:
        store_months(spark, bronze, silver_path, kind, months, checksums, **export)


def _inside(year: int, min_year: int | None, max_year: int | None) -> bool:
    return (min_year is None or year >= min_year) and (max_year is None or year <= max_year)


def new_months(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    min_year: int | None = None,
    max_year: int | None = None,
    *,
    corrections: bool = False,
) -> DataFrame:
    """``year, month`` of bronze snapshots that silver does not have in full.

    With ``corrections`` also those whose files are others than when they were stored.
    """
    stored = [(*m, e.checksum) for m, e in commits.newest(_log(spark, silver_path)).items()]
    known = spark.createDataFrame(stored, "year int, month int, known string").withColumn("stored", F.lit(True))
    found = snapshots.bronze_checksums(spark, bronze_path).filter(snapshots.in_years("year", min_year, max_year))
    new = F.col("stored").isNull()
    if corrections:
        # A month from before the log has no checksum to compare with and stays.
        new = new | (F.col("known") != F.col("checksum"))
    return found.join(known, ["year", "month"], "left").filter(new).select("year", "month", "checksum")


def update_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    kind: str = SINGLE_FAMILY_KIND,
    *,
    min_year: int | None = None,
    max_year: int | None = None,
    corrections: bool = False,
    **export,
) -> list[tuple[int, int]]:
    """Append the snapshots silver does not have; returns their months.

    Bronze files of stored snapshots, and of years outside the bounds, are not opened.  A
    snapshot is stored once, whatever months its rows name, so a stray row neither closes the
    month it names nor changes it; a second run adds nothing.  With ``corrections`` a snapshot
    whose files have changed replaces its month.
    """
    # Months of the calendar, a short list by nature.
    rows = new_months(spark, bronze_path, silver_path, min_year, max_year, corrections=corrections).collect()
    checksums = {(r["year"], r["month"]): r["checksum"] for r in rows}
    months = sorted(checksums)
    if not months:
        return []
    chosen = F.lit(False)
    for year in sorted({y for y, _ in months}):
        of_year = [m for y, m in months if y == year]
        chosen = chosen | ((F.col("snapshot_year") == year) & F.col("snapshot_month").isin(of_year))
    bronze = snapshots.read_bronze(spark, bronze_path, kind, min_year=min_year, max_year=max_year).filter(chosen)
    store_months(spark, bronze, silver_path, kind, months, checksums, **export)
    return months


def append_months(
    spark: SparkSession, bronze: DataFrame, silver_path: str, kind: str, *, corrections: bool = False, **export
) -> None:
    """Add the snapshots of bronze rows that silver does not have.

    Rows of snapshots that it has are late: they are stored apart, or, with ``corrections``,
    replace their month.
    """
    there = snapshot_sizes(bronze)
    stored = commits.newest(_log(spark, silver_path))
    taken = {m for m in there if corrections or m not in stored}
    if there:
        store_months(spark, bronze, silver_path, kind, taken, sizes=there, **export)


def drop_replaced(spark: SparkSession, silver_path: str) -> list[str]:
    """Delete the folders of replaced versions and of writes that broke off; returns them.

    Readers that hold an older version lose it, so no import and no long read should run meanwhile.
    """
    entries = commits.load(spark, silver_path)
    if entries is None:
        return []
    kept = {e.folder for e in [*commits.visible(entries), *commits.strays(entries)]}
    files = snapshots.list_files(spark, silver_path, "*.parquet")
    folder = F.regexp_extract("path", rf"({YEAR}=\d+/{MONTH}=\d+/{commits.VERSION}=[^/]+)/", 1)
    # A folder per version of a month, a short list.
    gone = sorted({r[0] for r in files.select(folder).distinct().collect()} - kept - {""})
    for name in gone:
        remove(spark, f"{silver_path}/{name}")
    return gone


def run_import(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    silver_path: str,
    kind: str = SINGLE_FAMILY_KIND,
    *,
    overwrite: bool = False,
    file_format: str = "parquet",
    min_year: int | None = None,
    max_year: int | None = None,
    manifest_path: str | None = None,
    corrections: bool = False,
    **export,
) -> list[tuple[int, int]]:
    """Both steps for one program; returns the months added to silver."""
    convert_snapshots(
        spark, raw_path, bronze_path, kind, overwrite=overwrite, file_format=file_format, manifest_path=manifest_path
    )
    return update_silver(
        spark, bronze_path, silver_path, kind, min_year=min_year, max_year=max_year, corrections=corrections, **export
    )
