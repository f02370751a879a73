import csv
import glob

import pytest
from pyspark.sql import functions as F

from conftest import loans_frame, rows_of
from loanlake import schemas as s
from loanlake.operators import validation as v
from loanlake.plans.reports import export_validation, institution_report


def one(df):
    row = df.collect()
    assert len(row) == 1
    return row[0]


def test_critical_checks_pass_on_the_sample(sample):
    results = v.run_critical(sample)
    assert [(r["check_name"], r["status"]) for r in results.collect()] == [
        ("Required Columns Present", "PASS"), ("FHA_Index Uniqueness", "PASS"),
        ("ID-Name Consistency Within Months", "PASS"),
    ]
    assert rows_of(v.verdict(results)) == [(3, 0, 0, True)]


def test_missing_columns_fail(sample):
    r = one(v.check_required_columns(sample.drop(s.AMOUNT, s.SPONSOR)))
    assert r["status"] == "FAIL" and r["details"]["missing_columns"] == "Sponsor Name, Mortgage Amount"


def test_duplicates(sample):
    r = one(v.check_fha_index_uniqueness(sample.unionByName(sample.limit(2))))
    assert r["status"] == "FAIL" and r["details"]["duplicates"] == "2"


def test_missing_ids_and_threshold(sample):
    two = sample.filter(F.col(s.STATE).isin("TX", "FL")).withColumn(
        s.ORIG_NO, F.when(F.col(s.STATE) == "TX", F.col(s.ORIG_NO))
    )
    r = one(v.check_missing_originator_ids(two))
    assert r["status"] == "WARNING" and r["details"]["percent_missing"] == "50.0"
    assert one(v.check_missing_originator_ids(two, threshold_pct=60.0))["status"] == "PASS"
    assert one(v.check_missing_originator_ids(two, threshold_pct=50.0))["status"] == "WARNING"  # strictly below
    assert one(v.check_orphaned_sponsors(two))["details"]["orphaned_count"] == "1"
    assert one(v.check_missing_originator_names(two))["status"] == "PASS"


def test_amounts(spark, sample):
    odd = sample.withColumn(
        s.AMOUNT, F.when(F.col(s.STATE) == "TX", 0).when(F.col(s.STATE) == "FL", 10_000_001).otherwise(F.col(s.AMOUNT))
    )
    r = one(v.check_mortgage_amounts(odd))
    assert r["status"] == "WARNING"
    assert r["details"]["non_positive_count"] == "1" and r["details"]["extremely_high_count"] == "1"
    assert r["details"]["min_amount"] == "0.00"


def test_date_coverage(spark):
    rows = [(2019, 1, 1, "A", 2, "S"), (2019, 1, 1, "A", 2, "S"), (2021, 5, 1, "A", 2, "S")]
    df = loans_frame(spark, rows).withColumn(s.AMOUNT, F.lit(1).cast("bigint"))
    d = one(v.check_date_coverage(df))["details"]
    assert (d["min_year"], d["max_year"], d["year_span"], d["unique_year_month_periods"]) == ("2019", "2021", "3", "2")
    assert d["expected_periods_if_complete"] == "36"


def test_identity_checks(spark):
    rows = [
        (2020, 1, 1, "A", 2, "S"), (2020, 1, 1, "B", 2, "S"), (2020, 2, 1, "B", 2, "S"), (2020, 3, 1, "A", 1, "T"),
        (2020, 1, 5, None, 2, "S"), (2020, 1, 5, "E", 2, "S"), (2020, 2, 6, "A", 2, "T"), (2020, 2, None, "A", 2, "T"),
    ]
    df = loans_frame(spark, rows)
    r = one(v.check_id_name_consistency_monthly(df))
    assert r["status"] == "FAIL" and r["details"]["inconsistent_periods"] == "2"
    assert r["details"]["sample"] == "[2020-01 1: A, B; 2020-01 5: E]"
    r = one(v.check_overlapping_id_spaces(df))
    assert r["status"] == "WARNING" and r["details"]["sample_overlapping_ids"] == "1"
    r = one(v.check_originator_sponsor_relationships(df))
    assert r["details"]["originators_with_multiple_ids"] == "1"
    assert r["details"]["sample"] == "[A: 3 ids, 2 sponsors, 4 loans]"
    r = one(v.check_name_oscillations(df))
    assert r["status"] == "WARNING" and r["details"]["sample"] == "[1: A / B]"


def test_subsets_and_own_checks(sample):
    names = ["check_mortgage_amounts", "check_fha_index_uniqueness", "check_sponsor_coverage"]
    assert v.run_checks(sample, names).count() == 3
    with pytest.raises(ValueError, match="Unknown checks"):
        v.run_checks(sample, ["nope"])

    def no_texas(df):
        return df.agg(F.count(F.when(F.col(s.STATE) == "TX", 1)).alias("n")).select(
            F.lit("No Texas").alias("check_name"), F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"),
            F.lit(False).alias("is_warning"), F.create_map(F.lit("rows"), F.col("n").cast("string")).alias("details"),
        )

    results = v.run_checks(sample, ["check_required_columns", "no_texas"], extra={"no_texas": no_texas})
    assert rows_of(v.verdict(results)) == [(1, 1, 0, False)]


def test_all_checks_and_export(sample, tmp_path):
    results = v.run_checks(sample)
    assert results.count() == len(v.CHECKS) == 12
    path = str(tmp_path / "checks.csv")
    export_validation(results, path)
    rows = [r for f in glob.glob(path + "/part-*") for r in csv.DictReader(open(f))]
    assert len(rows) == 12
    amounts = next(r for r in rows if r["check_name"] == "Reasonable Mortgage Amounts")
    assert amounts["max_amount"] == "425000.00" and amounts["status"] == "PASS"


def test_empty_table(sample):
    assert v.run_checks(sample.limit(0)).count() == 12


def test_institution_report(spark, sample, tmp_path):
    paths = institution_report(sample, str(tmp_path / "out"))
    assert sorted(paths) == ["crosswalk", "errors", "event_log", "summary"]
    summary = {(r[0], r[1]): r[2] for r in rows_of(spark.read.csv(paths["summary"], header=True))}
    assert summary["id_spaces", "unique_originator_ids"] == "3"
    assert summary["summary", "unique_institution_numbers"] == "6"
    assert spark.read.csv(paths["crosswalk"], header=True).count() == 6
    assert spark.read.parquet(paths["event_log"]).count() == 6
