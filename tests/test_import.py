import os

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from loanlake import schemas as s
from loanlake.plans import import_snapshots as imp
from loanlake.sources import manifest, snapshots
from loanlake.streaming.ingest import ingest_new_months

COLUMNS = (
    "sheet_name string, sheet_ord int, row_ord bigint, `Property_State` string, `Property_County` string, "
    "`Originating Mortgagee` string, `Orig Num` string, `Sponsor_Name` string, `Sponsor_Num` string, "
    "`Loan_Purpose` string, `Endorsement Year` string, `Endorsement Month` string, `Mortgage Amount` string"
)


def write_raw(spark, folder, name, year, month, n=4, sheets=("Data Purchase", "Data Refinance", "Notes")):
    rows = [
        (sheet, i, r, "CA", "Orange County", "Lender", "12.0", "Sponsor", "7",
         "Loan_Purpose" if r == 1 else "Purchase", str(year), str(month), "1000")
        for i, sheet in enumerate(sheets)
        for r in range(n)
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    if "hecm" in name:  # these workbooks have no underscores in their headers
        df = df.withColumnsRenamed({
            "Property_State": s.STATE, "Property_County": s.COUNTY, "Orig Num": s.ORIG_NO, "Sponsor_Name": s.SPONSOR,
            "Sponsor_Num": s.SPONSOR_NO,
        }).drop("Loan_Purpose")
    target = os.path.join(folder, name)
    df.toPandas().to_parquet(target, index=False)
    return target


@pytest.fixture
def folders(tmp_path):
    for part in ("raw", "bronze", "silver"):
        (tmp_path / part).mkdir()
    return {p: str(tmp_path / p) for p in ("raw", "bronze", "silver")}


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame([("CA", "Orange County", "06059")], "state string, county string, fips string")


def silver(spark, folders):
    return snapshots.read_silver(spark, folders["silver"])


def test_import_is_incremental_and_idempotent(spark, folders, reference):
    raw = folders["raw"]
    write_raw(spark, raw, "fha_sf_snapshot_20240101.parquet", 2024, 1)
    write_raw(spark, raw, "fha_sf_snapshot_20240101b.parquet", 2024, 1, n=50)  # second file of the month
    write_raw(spark, raw, "fha_sf_snapshot_20240201.parquet", 2024, 2)
    write_raw(spark, raw, "fha_hecm_snapshot_20240301.parquet", 2024, 3)  # other program

    def run(**options):
        return imp.run_import(spark, raw, folders["bronze"], folders["silver"], county_reference=reference, **options)

    assert run() == [(2024, 1), (2024, 2)]
    first = silver(spark, folders)
    # two data sheets of four rows, one repeated header each
    assert rows_of(first.groupBy(s.YEAR, s.MONTH).count().orderBy(s.MONTH)) == [(2024, 1, 6), (2024, 2, 6)]
    keys = sorted(r[0] for r in rows_of(first.filter("Month = 1").select(s.INDEX)))
    assert keys == [f"20240101_{i:07d}" for i in range(1, 7)]
    assert {tuple(r) for r in first.select(s.FIPS, s.COUNTY, s.ORIG_NO).distinct().collect()} == {("06059", "ORANGE", 12)}

    assert run() == []  # nothing new
    write_raw(spark, raw, "fha_sf_snapshot_20240401.parquet", 2024, 4)
    assert run() == [(2024, 4)]
    assert run(overwrite=True) == []
    assert silver(spark, folders).count() == 18


def test_stray_rows_do_not_touch_a_stored_month(spark, folders, reference):
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240101.parquet", 2024, 1)
    imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"])
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240201.parquet", 2024, 1)  # rows of January in February
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240301.parquet", 2024, 3)
    assert imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"]) == [(2024, 2), (2024, 3)]
    counts = rows_of(silver(spark, folders).groupBy(s.MONTH).count().orderBy(s.MONTH))
    assert counts == [(1, 6), (3, 6)]


def test_hecm_and_year_range(spark, folders):
    write_raw(spark, folders["raw"], "fha_hecm_snapshot_20240301.parquet", 2024, 3, sheets=("data", "Info"))
    write_raw(spark, folders["raw"], "fha_hecm_snapshot_20200301.parquet", 2020, 3, sheets=("data",))
    got = imp.run_import(
        spark, folders["raw"], folders["bronze"], folders["silver"], s.HECM_KIND, min_year=2021, max_year=2024
    )
    assert got == [(2024, 3)]
    rows = snapshots.read_silver(spark, folders["silver"], s.HECM_KIND)
    assert sorted(r[0] for r in rows_of(rows.select(s.INDEX))) == [f"H20240301_{i:07d}" for i in range(1, 5)]


def test_full_export_and_month_scan(spark, folders):
    for m in (1, 2, 3):
        write_raw(spark, folders["raw"], f"fha_sf_snapshot_2024{m:02d}01.parquet", 2024, m)
    imp.convert_snapshots(spark, folders["raw"], folders["bronze"])
    imp.save_silver(spark, folders["bronze"], folders["silver"])
    assert rows_of(snapshots.existing_partitions(spark, folders["silver"]).orderBy(s.MONTH)) == [
        (2024, 1), (2024, 2), (2024, 3),
    ]
    month = snapshots.read_month(spark, folders["silver"], 2024, 2)
    assert month.count() == 6
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan
    assert snapshots.sample_rows(month, 2).count() == 2


def test_bronze_files_side_by_side(spark, folders):
    """Bronze folders of canonically named files work as well."""
    frame = spark.createDataFrame([(2023, 5, "A", "S")], f"`{s.YEAR}` smallint, `{s.MONTH}` smallint, `{s.ORIG}` string, `{s.SPONSOR}` string")
    frame.toPandas().to_parquet(os.path.join(folders["bronze"], "fha_sf_snapshot_20230501.parquet"))
    frame.toPandas().to_parquet(os.path.join(folders["bronze"], "fha_sf_snapshot_20190501.parquet"))
    rows = snapshots.read_bronze(spark, folders["bronze"], min_year=2020)
    assert rows.count() == 1
    assert rows.select("snapshot_year", "snapshot_month").first() == (2023, 5)
    assert imp.update_silver(spark, folders["bronze"], folders["silver"], min_year=2020) == [(2023, 5)]
    assert imp.update_silver(spark, folders["bronze"], folders["silver"]) == [(2019, 5)]


def test_large_month_is_split_over_tasks(spark, folders):
    """All rows of one month: the writer still uses several files."""
    rows = spark.range(200_000).select(
        F.lit(2024).cast("smallint").alias(s.YEAR),
        F.lit(1).cast("smallint").alias(s.MONTH),
        F.sha2(F.col("id").cast("string"), 256).alias(s.ORIG),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        imp.write_months(rows, folders["silver"], s.YEAR, s.MONTH)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for _, _, names in os.walk(folders["silver"]) for f in names if f.endswith(".parquet")]
    assert len(files) > 3


def test_stream_stores_new_months_once(spark, folders, tmp_path):
    def ingest():
        query = ingest_new_months(spark, folders["bronze"], folders["silver"], str(tmp_path / "state"))
        query.awaitTermination()
        assert query.exception() is None

    for m in (1, 2):
        write_raw(spark, folders["raw"], f"fha_sf_snapshot_2024{m:02d}01.parquet", 2024, m)
    imp.convert_snapshots(spark, folders["raw"], folders["bronze"])
    ingest()
    ingest()
    assert silver(spark, folders).count() == 12
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240301.parquet", 2024, 3)
    imp.convert_snapshots(spark, folders["raw"], folders["bronze"])
    ingest()
    assert rows_of(silver(spark, folders).groupBy(s.MONTH).count().orderBy(s.MONTH)) == [(1, 6), (2, 6), (3, 6)]


def test_csv_goes_by_names_and_numbers(spark, folders):
    """Another column order in the second month; more than ten rows, listed out of order."""
    first = "sheet_name,sheet_ord,row_ord,Loan_Purpose,Year,Month,Originating Mortgagee,Property State,Property County,Mortgage Amount"
    second = "Mortgage Amount,Property County,Property State,sheet_name,row_ord,sheet_ord,Year,Endorsement Month,Loan_Purpose,Originating Mortgagee"
    with open(os.path.join(folders["raw"], "fha_sf_snapshot_20240101.csv"), "w") as out:
        rows = [f"{sheet},{o},{r},Purchase,2024,1,A,TX,Harris,{1000 * o + r}" for o, sheet in ((10, "Data"), (9, "Purchase"), (2, "Index")) for r in reversed(range(12))]
        out.write("\n".join([first, *rows]) + "\n")
    with open(os.path.join(folders["raw"], "fha_sf_snapshot_20240201.csv"), "w") as out:
        out.write("\n".join([second, *[f"{5000 + r},Harris,TX,Data,{r},0,2024,2,Purchase,B" for r in range(3)]]) + "\n")
    assert imp.convert_snapshots(spark, folders["raw"], folders["bronze"], file_format="csv") == [(2024, 1), (2024, 2)]
    rows = snapshots.read_bronze(spark, folders["bronze"])
    got = rows_of(rows.select(s.INDEX, s.AMOUNT, s.STATE, s.COUNTY, s.ORIG, s.YEAR, s.MONTH).orderBy(s.INDEX))
    amounts = [9000 + r for r in range(12)] + [10_000 + r for r in range(12)]
    expected = [(f"20240101_{k:07d}", a, "TX", "Harris", "A", 2024, 1) for k, a in enumerate(amounts, 1)]
    expected += [(f"20240201_{k:07d}", 4999 + k, "TX", "Harris", "B", 2024, 2) for k in range(1, 4)]
    assert got == expected


def test_rows_without_a_place_fail(spark, folders):
    with open(os.path.join(folders["raw"], "fha_sf_snapshot_20240101.csv"), "w") as out:
        out.write("sheet_name,sheet_ord,row_ord,Loan_Purpose,Year,Month\nData,0,,Purchase,2024,1\n")
    with pytest.raises(Exception, match="row_ord must be a number"):
        imp.convert_snapshots(spark, folders["raw"], folders["bronze"], file_format="csv")


def test_no_year_is_left_out(spark, folders):
    for year in (1998, 2009, 2025, 2026, 2099):
        write_raw(spark, folders["raw"], f"fha_sf_snapshot_{year}0101.parquet", year, 1)
    months = [(year, 1) for year in (1998, 2009, 2025, 2026, 2099)]
    assert imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"]) == months
    assert rows_of(silver(spark, folders).groupBy(s.YEAR, s.MONTH).count().orderBy(s.YEAR)) == [(y, m, 6) for y, m in months]
    assert imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"]) == []


def test_a_half_written_month_is_written_again(spark, folders, monkeypatch):
    for m in (1, 2):
        write_raw(spark, folders["raw"], f"fha_sf_snapshot_2024{m:02d}01.parquet", 2024, m)
    write = imp.write_months

    def breaks_off(df, path, *keys):
        if path == folders["silver"]:
            write(df.filter("Month = 1").limit(2), path, *keys)
            raise OSError("no space left")
        write(df, path, *keys)

    monkeypatch.setattr(imp, "write_months", breaks_off)
    with pytest.raises(OSError):
        imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"])
    monkeypatch.setattr(imp, "write_months", write)
    assert imp.stored_months(spark, folders["silver"]).count() == 0
    assert silver(spark, folders).count() == 0  # nobody sees half a month
    assert imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"]) == [(2024, 1), (2024, 2)]
    assert silver(spark, folders).count() == 12


def add_rows(spark, folders, name, months):
    """A raw file with one row for each ``(year, month)``."""
    rows = [("Data", 0, r, "CA", "Orange County", f"Lender {r}", "12", "Sponsor", "7", "Purchase", str(y), str(m), "1000") for r, (y, m) in enumerate(months)]
    spark.createDataFrame(rows, COLUMNS).toPandas().to_parquet(os.path.join(folders["raw"], name), index=False)


def months_of(df):
    return rows_of(df.groupBy(s.YEAR, s.MONTH).count().orderBy(s.YEAR, s.MONTH))


def test_a_stray_row_does_not_close_its_month(spark, folders):
    """A month is what its own file brings; until that comes, what others have of it."""

    def run(**options):
        return imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"], **options)

    add_rows(spark, folders, "fha_sf_snapshot_20240101.parquet", [(2024, 1)] * 6 + [(2024, 2), (2023, 12)])
    assert run() == [(2024, 1)]
    assert months_of(silver(spark, folders)) == [(2023, 12, 1), (2024, 1, 6), (2024, 2, 1)]
    assert imp.late_rows(spark, folders["silver"]).count() == 0
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240201.parquet", 2024, 2)
    assert run() == [(2024, 2)] and run() == []
    assert months_of(silver(spark, folders)) == [(2023, 12, 1), (2024, 1, 6), (2024, 2, 6)]
    assert rows_of(imp.late_rows(spark, folders["silver"])) == [(2024, 2, 1)]
    apart = snapshots.read_held_apart(spark, folders["silver"])
    assert rows_of(apart.select(s.ORIG, s.YEAR, s.MONTH, "source_year", "source_month")) == [("Lender 6", 2024, 2, 2024, 1)]
    assert snapshots.read_month(spark, folders["silver"], 2024, 2).count() == 6
    versions = imp.month_versions(spark, folders["silver"]).filter("year = 2024 AND month = 2").orderBy("number")
    assert rows_of(versions.select("part", "rows", "visible")) == [("stray", 1, False), ("own", 6, True)]
    assert imp.drop_replaced(spark, folders["silver"]) == []


def test_corrected_files_replace_their_month(spark, folders):
    """Only where that is asked for; stray rows of the replaced version go with it."""

    def run(**options):
        imp.convert_snapshots(spark, folders["raw"], folders["bronze"], overwrite=True)
        return imp.update_silver(spark, folders["bronze"], folders["silver"], **options)

    add_rows(spark, folders, "fha_sf_snapshot_20240101.parquet", [(2024, 1)] * 3 + [(2024, 2)])
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240301.parquet", 2024, 3)
    assert run() == [(2024, 1), (2024, 3)]
    before = silver(spark, folders)
    assert imp.update_silver(spark, folders["bronze"], folders["silver"], corrections=True) == []  # the same files
    add_rows(spark, folders, "fha_sf_snapshot_20240101.parquet", [(2024, 1)] * 5)
    assert run() == [] and months_of(silver(spark, folders)) == [(2024, 1, 3), (2024, 2, 1), (2024, 3, 6)]
    assert run(corrections=True) == [(2024, 1), (2024, 3)]
    assert months_of(silver(spark, folders)) == [(2024, 1, 5), (2024, 3, 6)]
    assert months_of(before) == [(2024, 1, 3), (2024, 2, 1), (2024, 3, 6)]  # a reader keeps the version it began with
    assert len(imp.drop_replaced(spark, folders["silver"])) == 3
    assert months_of(silver(spark, folders)) == [(2024, 1, 5), (2024, 3, 6)]


def test_tables_from_before_the_log(spark, folders):
    """Months that lie in the folder stay; half-written ones, by the earlier log, are written again."""
    row = spark.range(2).select(F.lit("old").alias(s.ORIG), *[F.lit(v).cast("smallint").alias(c) for c, v in ((s.YEAR, 2024), (s.MONTH, 1))])
    imp.write_months(row, folders["silver"], s.YEAR, s.MONTH)
    imp.write_months(row.withColumn(s.MONTH, F.lit(2).cast("smallint")), folders["silver"], s.YEAR, s.MONTH)
    spark.createDataFrame([(2024, 1)], "Year int, Month int").write.json(f"{folders['silver']}/_complete")
    assert silver(spark, folders).count() == 4
    for m in (1, 2, 3):
        write_raw(spark, folders["raw"], f"fha_sf_snapshot_2024{m:02d}01.parquet", 2024, m)
    add_rows(spark, folders, "fha_sf_snapshot_20240401.parquet", [(2024, 1), (2024, 4)])
    assert imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"]) == [(2024, 2), (2024, 3), (2024, 4)]
    assert months_of(silver(spark, folders)) == [(2024, 1, 2), (2024, 2, 6), (2024, 3, 6), (2024, 4, 1)]
    assert rows_of(imp.late_rows(spark, folders["silver"])) == [(2024, 1, 1)]
    assert rows_of(snapshots.existing_partitions(spark, folders["silver"]).orderBy(s.MONTH)) == [(2024, m) for m in (1, 2, 3, 4)]


def test_stream_keeps_late_files_apart_or_lets_them_correct(spark, folders, tmp_path):
    def ingest(**options):
        ingest_new_months(spark, folders["bronze"], folders["silver"], str(tmp_path / "state"), **options).awaitTermination()

    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240101.parquet", 2024, 1)
    imp.convert_snapshots(spark, folders["raw"], folders["bronze"])
    ingest()
    for n, options in ((3, {}), (2, {"corrections": True})):
        write_raw(spark, folders["raw"], "fha_sf_snapshot_20240101.parquet", 2024, 1, n=n, sheets=("Data",))
        imp.convert_snapshots(spark, folders["raw"], folders["bronze"], overwrite=True)
        ingest(**options)
        assert months_of(silver(spark, folders)) == [(2024, 1, 6 if n == 3 else 1)]
        assert rows_of(imp.late_rows(spark, folders["silver"])) == [(2024, 1, 2)]
    assert snapshots.read_held_apart(spark, folders["silver"]).count() == 2


def test_late_rows_are_counted(spark, folders):
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240101.parquet", 2024, 1)
    imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"])
    assert imp.late_rows(spark, folders["silver"]).count() == 0
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240201.parquet", 2024, 1)
    imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"])
    assert rows_of(imp.late_rows(spark, folders["silver"])) == [(2024, 1, 6)]


def test_import_records_its_files(spark, folders, tmp_path):
    """New months are recorded, and older ones without a record."""
    path = str(tmp_path / "manifest")
    write_raw(spark, folders["raw"], "fha_sf_snapshot_20240101.parquet", 2024, 1)
    imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"])
    for _ in range(2):
        write_raw(spark, folders["raw"], "fha_sf_snapshot_20240201.parquet", 2024, 2)
        write_raw(spark, folders["raw"], "fha_hecm_snapshot_20240201.parquet", 2024, 2)
        imp.run_import(spark, folders["raw"], folders["bronze"], folders["silver"], manifest_path=path)
    rows = manifest.statuses(manifest.load(spark, path)).collect()
    assert [(r["key"], r["is_downloaded"], r["is_processed"]) for r in rows] == [
        ("single_family:2024-01", True, True), ("single_family:2024-02", True, True),
    ]


def test_read_tabular_rejects_other_suffixes(spark):
    with pytest.raises(ValueError):
        snapshots.read_tabular(spark, "x.xlsx")


def test_periods_are_found_once_per_file(spark, tmp_path):
    """The rules for names work on a list of files; no expression over rows holds them."""
    from loanlake.sources import snapshots

    rows = [("Data Purchase", 0, k, "x") for k in range(5)] + [("Notes", 2, 9, "x")]
    table = spark.createDataFrame(rows, "sheet_name string, sheet_ord int, row_ord bigint, Loan_Purpose string")
    folders = [f"{tmp_path}/year={y}/month={m}" for y, m in ((2014, 5), (2015, 12))]
    for folder in folders:
        table.write.parquet(folder)
    raw = snapshots.read_raw_rows(spark, folders, "single_family")
    assert "regexp" not in raw._jdf.queryExecution().optimizedPlan().toString().lower()
    counts = {tuple(r) for r in raw.groupBy("snapshot_kind", "snapshot_year", "snapshot_month").count().collect()}
    assert counts == {("single_family", 2014, 5, 5), ("single_family", 2015, 12, 5)}
