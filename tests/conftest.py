import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from loanlake import schemas as s  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoint-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SAMPLE = [
    ("CA", "Los Angeles", "Los Angeles", 90001, "Lender A", 12345, "Sponsor X", 100, "Gift", "Standard", "Purchase", "Single Family", 3.5, 350000, "00001", 6037),
    ("TX", "Houston", "Harris", 77001, "Lender B", 23456, "Sponsor Y", 200, "Savings", "Standard", "Purchase", "Single Family", 3.75, 275000, "00002", 48201),
    ("NY", "New York", "New York", 10001, "Lender A", 12345, "Sponsor X", 100, "Gift", "Energy Efficient", "Refinance", "Condo", 3.25, 425000, "00003", 36061),
    ("FL", "Miami", "Miami-Dade", 33101, "Lender C", 34567, "Sponsor Z", 300, "Gift", "Standard", "Purchase", "Single Family", 3.6, 310000, "00004", 12086),
    ("CA", "San Diego", "San Diego", 92101, "Lender A", 12345, "Sponsor X", 100, "Savings", "Standard", "Purchase", "Condo", 3.55, 380000, "00005", 6073),
]


@pytest.fixture(scope="session")
def sample(spark):
    """Five loans of June 2025."""
    rows = [
        (st, ci, co, z, o, on, sp, sn, dp, None, pt, lp, pr, r, a, 2025, 6, f"20250601_{i}")
        for st, ci, co, z, o, on, sp, sn, dp, pt, lp, pr, r, a, i, _ in SAMPLE
    ]
    return spark.createDataFrame(rows, s.SINGLE_FAMILY)


@pytest.fixture(scope="session")
def sample_with_fips(spark, sample):
    codes = spark.createDataFrame([(f"20250601_{r[14]}", r[15]) for r in SAMPLE], f"{s.INDEX} string, FIPS int")
    return sample.join(codes, s.INDEX)


def loans_frame(spark, rows):
    """Loans from (year, month, originator number, originator, sponsor number, sponsor)."""
    schema = (
        f"`{s.YEAR}` smallint, `{s.MONTH}` smallint, `{s.ORIG_NO}` int, `{s.ORIG}` string, "
        f"`{s.SPONSOR_NO}` int, `{s.SPONSOR}` string"
    )
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return [tuple(r) for r in df.collect()]
