"""Named queries that write files and read them back: imports, exports, logs and reports.

Every query works in a folder of its own below the shared checkpoint folder; what its result
does not read is removed before it returns.
"""

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import activity, geography, monthly_checks, trends, validation
from ..schemas import (
    AMOUNT, COUNTY, DATE, DOWN, FIPS, HECM_KIND, INDEX, MONTH, ORIG, ORIG_NO, PRODUCT, PROPERTY, PURPOSE, RATE,
    SPONSOR, SPONSOR_NO, STATE, YEAR,
)
from ..sources import inventory, manifest, sinks, snapshots, star_raw
from ..sources.checkpoints import ensure_checkpoint_dir, remove
from ..sources.star_loans import loans, read_table
from ..streaming.ingest import ingest_new_months
from . import import_snapshots, reports

PARTIES = (YEAR, MONTH, ORIG_NO, ORIG, SPONSOR_NO, SPONSOR)


class Folders:
    """Raw, bronze and silver folders of one import."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/files-{uuid4().hex}"
        self.raw, self.bronze, self.silver = (f"{self.root}/{part}" for part in ("raw", "bronze", "silver"))

    def write_raw(self, sheets: DataFrame) -> None:
        import_snapshots.write_months(sheets.drop("snapshot_kind"), self.raw, "snapshot_year", "snapshot_month")

    def read_silver(self, kind: str = "single_family") -> DataFrame:
        """The silver table; the folders it was made from go."""
        remove(self.spark, self.raw)
        remove(self.spark, self.bronze)
        return snapshots.read_silver(self.spark, self.silver, kind)

    def run(self, **options) -> list[tuple[int, int]]:
        return import_snapshots.run_import(self.spark, self.raw, self.bronze, self.silver, **options)


def imported_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw months to bronze, then silver in two increments."""
    at, counties = Folders(spark), star_raw.county_reference(spark)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir))
    at.run(max_year=2016, county_reference=counties)
    at.run(county_reference=counties)
    return at.read_silver()


def imported_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months as CSV, every other one with its columns the other way round."""
    at = Folders(spark)
    sheets = star_raw.raw_sheets(spark, sf_dir).drop("snapshot_kind")
    for odd, columns in ((0, sheets.columns), (1, sheets.columns[::-1])):
        part = sheets.select(*[F.col(f"`{c}`") for c in columns]).filter(F.col("snapshot_month") % 2 == odd)
        writer = part.hint("rebalance", "snapshot_year", "snapshot_month").write.mode("append").option("header", True)
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.partitionBy("snapshot_year", "snapshot_month").csv(at.raw)
    at.run(file_format="csv", county_reference=star_raw.county_reference(spark))
    return at.read_silver()


def imported_all_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months long before and after the years of the other imports: rows per month."""
    at = Folders(spark)
    years = F.when(F.col("o_custkey") % 2 == 0, 9).otherwise(35)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir, years))
    at.run()
    return at.read_silver().groupBy(YEAR, MONTH).agg(F.count("*").alias("rows"))


def exported_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full export of a bronze folder."""
    at = Folders(spark)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir))
    import_snapshots.convert_snapshots(spark, at.raw, at.bronze)
    import_snapshots.save_silver(spark, at.bronze, at.silver, county_reference=star_raw.county_reference(spark))
    return at.read_silver()


def streamed_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze months through the file stream."""
    at = Folders(spark)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir))
    import_snapshots.convert_snapshots(spark, at.raw, at.bronze)
    counties = star_raw.county_reference(spark)
    ingest_new_months(spark, at.bronze, at.silver, f"{at.root}/state", county_reference=counties).awaitTermination()
    return at.read_silver()


def _import_with_strays(spark: SparkSession, sf_dir: str) -> Folders:
    """Two imports of files in which some rows name the month after."""
    at = Folders(spark)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir, stray=F.col("o_orderkey") % 29 == 0))
    at.run(max_year=2016)
    at.run()
    return at


def imported_with_stray_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the months that readers see, and rows held apart from them."""
    at = _import_with_strays(spark, sf_dir)
    columns = (INDEX, YEAR, MONTH, ORIG, AMOUNT)
    shown = at.read_silver().select(*columns, F.lit(False).alias("held_apart"))
    apart = snapshots.read_held_apart(spark, at.silver).select(*columns, F.lit(True).alias("held_apart"))
    return shown.unionByName(apart)


def month_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of both imports: what they took from which snapshot for which month."""
    at = _import_with_strays(spark, sf_dir)
    log = import_snapshots.month_versions(spark, at.silver)
    return log.select("number", "part", "year", "month", "source_year", "source_month", "rows", "visible")


def _corrected_bronze(spark: SparkSession, sf_dir: str, at: Folders) -> None:
    """Files of 2014 that lack the rows with odd keys."""
    sheets = star_raw.raw_sheets(spark, sf_dir).filter("snapshot_year = 2014 AND row_ord % 2 = 0")
    rows = import_snapshots.bronze_rows(sheets.filter(snapshots.is_data_sheet("single_family")), "single_family")
    import_snapshots.write_months(rows, at.bronze, "snapshot_year", "snapshot_month")


def imported_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of files that changed after their import."""
    at = Folders(spark)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir))
    at.run()
    _corrected_bronze(spark, sf_dir, at)
    at.run(corrections=True)
    return at.read_silver().select(INDEX, YEAR, MONTH, ORIG, AMOUNT)


def streamed_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the file stream, which sees the changed files as new ones."""
    at = Folders(spark)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir))
    import_snapshots.convert_snapshots(spark, at.raw, at.bronze)
    for _ in range(2):
        ingest_new_months(spark, at.bronze, at.silver, f"{at.root}/state", corrections=True).awaitTermination()
        _corrected_bronze(spark, sf_dir, at)
    return at.read_silver().select(INDEX, YEAR, MONTH, ORIG, AMOUNT)


def imported_hecm(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Folders(spark)
    at.write_raw(star_raw.raw_hecm_sheets(spark, sf_dir))
    at.run(kind=HECM_KIND)
    columns = (INDEX, STATE, ORIG, ORIG_NO, SPONSOR, "NMLS", "Standard/Saver", RATE, YEAR, MONTH, DATE)
    return at.read_silver(HECM_KIND).select(*columns)


def manifest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest after two imports that record their files."""
    at, path = Folders(spark), None
    at.write_raw(star_raw.raw_sheets(spark, sf_dir))
    path = f"{at.root}/manifest"
    at.run(max_year=2016)
    at.run(manifest_path=path)
    rows = manifest.statuses(manifest.load(spark, path))
    folder = lambda side: F.regexp_replace(f"{side}.path", f"^.*/{at.root.rsplit('/', 1)[-1]}/", "")
    checked = lambda side: F.col(f"{side}.checksum").rlike("^[0-9a-f]{64}$")
    return rows.select(
        "key", "snapshot_type", "year", "month", "is_downloaded", "is_processed",
        folder("raw").alias("raw_path"), folder("processed").alias("processed_path"),
        checked("raw").alias("raw_checked"), checked("processed").alias("processed_checked"),
    )


def manifest_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of text files, one per month, that count the orders of every day; the longer ones are streamed."""
    path = f"{Folders(spark).root}/daily"
    day = F.struct(F.dayofmonth("o_orderdate").alias("day"), F.col("n").cast("string").alias("n"))
    days = read_table(spark, sf_dir, "orders").groupBy("o_orderdate").agg(F.count("*").alias("n"))
    lines = days.groupBy(
        F.year("o_orderdate").alias("snapshot_year"), F.month("o_orderdate").alias("snapshot_month")
    ).agg(F.array_join(F.transform(F.array_sort(F.collect_list(day)), lambda x: F.concat(x["day"].cast("string"), F.lit(":"), x["n"])), ",").alias("value"))
    lines.write.partitionBy("snapshot_year", "snapshot_month").text(path)
    table = manifest.fingerprint(spark, path, "raw", "single_family", "part-*", whole_file=120)
    return table.select("key", F.col("raw.checksum").alias("checksum"))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data files of an import: what the inventory says of every folder, but for names and sizes that change."""
    at = Folders(spark)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir))
    at.run()
    table = inventory.inventory(spark, at.root, project_dir=at.root, raw_dir=at.raw, clean_dir=at.silver)
    data = table.filter((F.col("suffix") == "parquet") & (F.col("size_bytes") > 0))
    folder = F.regexp_replace("parent_directory", "version=[^/]+", "version=*")
    below = F.concat("parent_directory", F.lit("/"), "file_name")
    sizes = (F.col("size_mb") == F.round(F.col("size_bytes") / 1048576, 4)) & F.col("size_readable").rlike("^[0-9.]+ [KMGT]?B$")
    return data.groupBy("category", folder.alias("folder"), "suffix").agg(
        F.every((F.col("relative_to_project") == below) & (F.col("relative_to_data") == below)).alias("paths_agree"),
        F.every(sizes).alias("sizes_agree"),
        F.every(F.col("modified_utc").isNotNull()).alias("dated"),
    )


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as CSV and read with its schema."""
    table = geography.state_loan_counts(loans(spark, sf_dir, STATE))
    path = f"{Folders(spark).root}/state_counts.csv"
    sinks.write_tabular(table, path)
    return snapshots.read_tabular(spark, path, table.schema)


def stored_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result table under its default name."""
    table = geography.county_loan_counts(loans(spark, sf_dir, FIPS, STATE, COUNTY))
    return sinks.write_result(table, Folders(spark).root, "county_counts.parquet")


def validation_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported check results, read back."""
    results = validation.run_checks(loans(spark, sf_dir, INDEX, STATE, AMOUNT, *PARTIES))
    path = f"{Folders(spark).root}/validation.csv"
    reports.export_validation(results, path)
    table = snapshots.read_tabular(spark, path)
    return table.select("check_name", "status", F.col("is_warning").cast("boolean").alias("is_warning"))


def _silver_in_two_steps(at: Folders, table: Callable[[Column], DataFrame]) -> tuple[str, list[tuple[int, int]]]:
    """A table of months whose checks ran once before 1996 and ran again after; the months of the second run.

    One of the early months was written anew in between. ``table`` gives the loans of the months that a condition names.
    """
    early, state = F.col(YEAR) < 1996, f"{at.root}/checks"
    import_snapshots.write_months(table(early), at.silver, YEAR, MONTH)
    monthly_checks.update_checks(at.spark, at.silver, state)
    changed = (F.col(YEAR) == 1994) & (F.col(MONTH) == 5)
    import_snapshots.write_months(table(~early | changed), at.silver, YEAR, MONTH)
    return state, monthly_checks.update_checks(at.spark, at.silver, state)


def stored_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks over rows from the counts of two runs."""
    from .catalog import flat

    at = Folders(spark)
    state, _ = _silver_in_two_steps(at, lambda months: loans(spark, sf_dir, months=months))
    names = [n for n in validation.CHECKS if n != "check_required_columns"]
    return flat(monthly_checks.run_stored_checks(spark, at.silver, state, names))


def stored_checks_of_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key uniqueness where months share keys, some of them without the usual form, some missing."""
    from .catalog import flat

    at, key, last = Folders(spark), F.col(INDEX), F.right(INDEX, F.lit(1))
    repeated = (
        F.when(last == "7", F.concat(F.lit("19950101_"), F.substring(INDEX, 10, 20)))
        .when(last == "8", F.concat(F.lit("odd "), F.right(INDEX, F.lit(3))))
        .when(last == "9", F.lit(None))
        .otherwise(key)
    )
    state, _ = _silver_in_two_steps(at, lambda months: loans(spark, sf_dir, months=months).withColumn(INDEX, repeated))
    return flat(monthly_checks.run_stored_checks(spark, at.silver, state, [validation.UNIQUENESS]))


def months_checked_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months that a second run of the checks reads."""
    _, months = _silver_in_two_steps(Folders(spark), lambda months: loans(spark, sf_dir, months=months))
    return spark.createDataFrame(months, "year int, month int")


def report_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log among the files of the institution report."""
    paths = reports.institution_report(loans(spark, sf_dir, *PARTIES), Folders(spark).root)
    return snapshots.read_tabular(spark, paths["event_log"])


def month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Folders(spark)
    at.write_raw(star_raw.raw_sheets(spark, sf_dir))
    at.run(county_reference=star_raw.county_reference(spark))
    at.read_silver()
    return snapshots.read_month(spark, at.silver, 2016, 3)


def row_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of a sample of 250 rows, and whether its keys are distinct."""
    some = snapshots.sample_rows(loans(spark, sf_dir, INDEX), 250)
    return some.agg(F.count("*").alias("rows"), F.count_distinct(INDEX).alias("keys"))


def _rows(tables: dict[str, DataFrame]) -> DataFrame:
    """``name, row``: every row of a report's tables as text, columns in the order of their names.

    Numbers are written in ten-thousandths, so that their text is the same everywhere.
    """
    from .catalog import rounded

    def text(column: str) -> Column:
        plain = F.col(f"`{column}`").cast("string")
        number = plain.try_cast("double")
        scaled = F.floor(number * 10000 + 0.5).cast("string")
        return F.concat(F.lit(f"{column}="), F.coalesce(F.when(number.isNotNull(), scaled).otherwise(plain), F.lit("-")))

    parts = [
        rounded(table).select(F.lit(name).alias("name"), F.concat_ws("|", *map(text, sorted(table.columns))).alias("row"))
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def trend_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every trend table of the report."""
    columns = (YEAR, DATE, ORIG, AMOUNT, RATE, DOWN, PROPERTY, PRODUCT, PURPOSE)
    return _rows(trends.trend_tables(loans(spark, sf_dir, *columns)))


def network_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every table of the network report.

    The rows of all tables are one table without an order, so pairs need none.
    """
    df = loans(spark, sf_dir, YEAR, ORIG_NO, ORIG, SPONSOR_NO, SPONSOR, AMOUNT)
    return _rows(reports.network_tables(df, ordered_pairs=False))


def exploratory_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the activity tables of the exploratory report."""
    df = loans(spark, sf_dir, YEAR, ORIG, SPONSOR, AMOUNT)
    return _rows({**activity.lender_activity(df), **activity.sponsor_activity(df)})


QUERIES = {
    f.__name__: f
    for f in (
        imported_loans, imported_csv, imported_all_years, exported_loans, streamed_loans, imported_with_stray_rows,
        month_versions, imported_corrections, streamed_corrections, imported_hecm, manifest_status, manifest_checksums, file_inventory, csv_round_trip, stored_result, validation_export, report_event_log, month_scan, row_sample,
        trend_tables, network_tables, exploratory_tables, stored_checks, stored_checks_of_repeated_keys, months_checked_again,
    )
}
