import pytest
from pyspark.sql import functions as F

from loanlake.sources import file_names as n


def value(spark, name, expr):
    return spark.createDataFrame([(name,)], "p string").select(expr(F.col("p")).alias("x")).first()[0]


@pytest.mark.parametrize(
    "name, kind, expected",
    [
        ("/a/FHA_SF_Snapshot_20240101.xlsx", None, ("single_family", 2024, 1, None)),
        ("fha_hecm_snapshot_20231201.parquet", "hecm", ("hecm", 2023, 12, None)),
        ("loans_202403.csv", "sf", ("single_family", 2024, 3, None)),
        ("a/fha_sf_snapshot_20240101.parquet/part-0001-20200101.parquet", None, ("single_family", 2024, 1, None)),
        ("a/snapshot_year=2023/snapshot_month=4/part-0.parquet", "hecm", ("hecm", 2023, 4, None)),
    ],
)
def test_snapshot_period(spark, name, kind, expected):
    assert tuple(value(spark, name, lambda p: n.snapshot_period(p, kind))) == expected


@pytest.mark.parametrize(
    "name, kind",
    [
        ("loans_202403.csv", None),
        ("loans.csv", "sf"),
        ("fha_sf_snapshot_20241301.csv", None),
        ("fha_sf_snapshot_20240101.csv", "hecm"),
    ],
)
def test_unusable_names(spark, name, kind):
    assert value(spark, name, lambda p: n.snapshot_period(p, kind))["problem"]


@pytest.mark.parametrize(
    "name, year, month, suffix",
    [
        ("FHA_SFSnapshot_Aug2023.xlsx", 2023, 8, "_202308"),
        ("snapshot_jly2015.xls", 2015, 7, "_201507"),
        ("fha_0113.zip", 2013, None, None),
        ("from2010to2011_mar.xls", None, 3, None),
        ("nothing.xls", None, None, None),
    ],
)
def test_loose_names(spark, name, year, month, suffix):
    assert value(spark, name, n.year_in_name) == year
    assert value(spark, name, n.month_in_name) == month
    assert value(spark, name, n.period_suffix) == suffix


@pytest.mark.parametrize(
    "name, kind, expected",
    [
        ("x/FHA_SFSnapshot_Aug2023.xlsx", "sf", "fha_sf_snapshot_20230801.xlsx"),
        ("fha_0113.zip", "hecm", "fha_hecm_snapshot_20130101.zip"),
        ("nothing.xls", "sf", "nothing.xls"),
        ("FHA_Aug2023.xlsx", None, "FHA_Aug2023.xlsx"),
        ("FHA_Aug2023.xlsx", "other", "FHA_Aug2023.xlsx"),
    ],
)
def test_standard_file_name(spark, name, kind, expected):
    assert value(spark, name, lambda p: n.standard_file_name(p, kind)) == expected


def test_fallback_period(spark):
    got = value(spark, "nothing.xls", lambda p: n.standard_file_name(p, "sf", F.lit("201203")))
    assert got == "fha_sf_snapshot_20120301.xls"


def test_kind_aliases():
    assert n.normalize_kind("SF") == "single_family" and n.normalize_kind("hecm") == "hecm"
    for bad in ("x", None):
        with pytest.raises(ValueError):
            n.normalize_kind(bad)
