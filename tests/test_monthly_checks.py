"""Checks from stored counts against the checks over all loans."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows_of
from loanlake import schemas as s
from loanlake.operators import monthly_checks, validation
from loanlake.plans import import_snapshots as imp
from loanlake.sources import commits, snapshots
from loanlake.sources.star_loans import loans

NAMES = [n for n in validation.CHECKS if n != "check_required_columns"]


def silver_rows(spark, months, keys=lambda y, m: [f"{y}{m:02d}01_{k:07d}" for k in range(1, 5)]):
    rows = [
        {s.YEAR: y, s.MONTH: m, s.INDEX: key, s.ORIG: "A" if k else "B", s.ORIG_NO: k or None, s.AMOUNT: 100 * k}
        for y, m in months
        for k, key in enumerate(keys(y, m))
    ]
    schema = s.silver_schema()
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def agree(spark, silver, state, names=NAMES):
    got = monthly_checks.run_stored_checks(spark, silver, state, names)
    expected = validation.run_checks(snapshots.read_silver(spark, silver), names)
    assert sorted(rows_of(got), key=str) == sorted(rows_of(expected), key=str)


def test_only_new_and_changed_months_are_counted(spark, tmp_path):
    silver, state = str(tmp_path / "silver"), str(tmp_path / "state")
    imp.write_months(silver_rows(spark, [(2020, 1), (2020, 2)]), silver, s.YEAR, s.MONTH)
    assert monthly_checks.update_checks(spark, silver, state) == [(2020, 1), (2020, 2)]
    assert monthly_checks.update_checks(spark, silver, state) == []
    again = silver_rows(spark, [(2020, 2), (2020, 3)], lambda y, m: [f"{y}{m:02d}01_{k:07d}" for k in range(9)])
    imp.write_months(again, silver, s.YEAR, s.MONTH)
    assert monthly_checks.update_checks(spark, silver, state) == [(2020, 2), (2020, 3)]
    agree(spark, silver, state)


def test_keys_that_months_share(spark, tmp_path):
    """The same key in two months, in no usual form, missing in both, and one that only looks alike."""
    silver, state = str(tmp_path / "silver"), str(tmp_path / "state")
    keys = ["20200101_0000001", "20200101_00000001", "x", None, None, "20200101_0000002", "H20200101_0000002"]
    imp.write_months(silver_rows(spark, [(2020, 1), (2020, 2)], lambda y, m: keys), silver, s.YEAR, s.MONTH)
    imp.write_months(silver_rows(spark, [(2020, 3)]), silver, s.YEAR, s.MONTH)
    got = monthly_checks.run_stored_checks(spark, silver, state, [validation.UNIQUENESS]).first()["details"]
    assert got == {"total_rows": "18", "unique_indexes": "10", "duplicates": "8"}
    agree(spark, silver, state)


def versions(spark, silver, rows, months):
    """A write of ``rows`` as a new version of ``months``."""
    entries = commits.load(spark, silver) or []
    number, version = commits.new_version(entries)
    part = rows.withColumn(commits.VERSION, F.lit(version))
    part.write.mode("append").partitionBy(s.YEAR, s.MONTH, commits.VERSION).parquet(silver)
    commits.add(spark, silver, [commits.Entry(number, version, commits.OWN, *m, *m, 1, None) for m in months])


def test_versions_of_a_table_with_a_log(spark, tmp_path):
    silver, state = str(tmp_path / "silver"), str(tmp_path / "state")
    versions(spark, silver, silver_rows(spark, [(2020, 1), (2020, 2)]), [(2020, 1), (2020, 2)])
    agree(spark, silver, state)
    versions(spark, silver, silver_rows(spark, [(2020, 1)], lambda y, m: ["20200201_0000003", "a"]), [(2020, 1)])
    assert monthly_checks.update_checks(spark, silver, state) == [(2020, 1)]
    agree(spark, silver, state)


def test_an_empty_table(spark, tmp_path):
    silver, state = str(tmp_path / "silver"), str(tmp_path / "state")
    assert monthly_checks.update_checks(spark, silver, state) == []
    got = monthly_checks.run_stored_checks(spark, silver, state, [validation.UNIQUENESS]).first()["details"]
    assert got["total_rows"] == "0"


def test_a_run_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    silver, state = str(tmp_path / "silver"), str(tmp_path / "state")
    imp.write_months(silver_rows(spark, [(2020, 1)]), silver, s.YEAR, s.MONTH)
    with monkeypatch.context() as broken:
        broken.setattr(commits, "add", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            monthly_checks.update_checks(spark, silver, state)
    assert monthly_checks.update_checks(spark, silver, state) == [(2020, 1)]
    agree(spark, silver, state)


def test_months_without_shared_keys_are_not_read_again(spark, tmp_path, monkeypatch):
    silver, state = str(tmp_path / "silver"), str(tmp_path / "state")
    imp.write_months(loans(spark, SMALL), silver, s.YEAR, s.MONTH)
    monthly_checks.update_checks(spark, silver, state)
    monkeypatch.setattr(monthly_checks, "_loans", lambda *_: pytest.fail("loans were read"))
    monthly_checks.run_stored_checks(spark, silver, state, NAMES)
