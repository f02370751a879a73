"""Estimated numbers of names against the exact ones."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, loans_frame, rows_of
from loanlake import schemas as s
from loanlake.operators import activity, sketches, trends
from loanlake.sources.star_loans import loans

PAIRS = [
    (activity.yearly_lenders, sketches.yearly_lenders),
    (activity.yearly_sponsors, sketches.yearly_sponsors),
    (trends.active_lenders, sketches.active_lenders),
]


@pytest.mark.parametrize("exact, estimated", PAIRS)
def test_few_names_are_counted_exactly(spark, exact, estimated):
    df = loans(spark, SMALL, s.YEAR, s.MONTH, s.DATE, s.ORIG, s.SPONSOR)
    got, expected = rows_of(estimated(sketches.month_sketches(df))), rows_of(exact(df))
    assert [tuple(r) for r in got] == [pytest.approx(tuple(r)) if isinstance(r[0], int) else tuple(r) for r in expected]


def test_many_names_are_within_the_bound(spark):
    names = spark.range(60_000).select(
        F.lit(2020).cast("smallint").alias(s.YEAR), (F.col("id") % 3 + 1).cast("smallint").alias(s.MONTH),
        F.concat(F.lit("n"), F.col("id") % 50_000).alias(s.ORIG), F.lit(None).cast("string").alias(s.SPONSOR),
    )
    stored = sketches.month_sketches(names)
    row = sketches.yearly_lenders(stored).first()
    assert abs(row["Active Lenders"] - 50_000) < 4 * 1.04 / 2 ** (sketches.PRECISION / 2) * 50_000
    assert row["Total Loans"] == 60_000
    assert sketches.yearly_sponsors(stored).count() == 0


def test_months_merge_and_missing_names_count_once(spark):
    rows = [(2020, m, 1, name, None, None) for m in (1, 2) for name in ("A", None, None)] + [(2021, 1, 1, "A", 2, "S")]
    first, second = (sketches.month_sketches(loans_frame(spark, rows).filter(c)) for c in ("Month = 1", "Month = 2"))
    both = first.unionByName(second)
    assert rows_of(sketches.yearly_lenders(both)) == [(2020, 2, 6, 3.0), (2021, 1, 1, 1.0)]
    assert rows_of(sketches.yearly_sponsors(both)) == [(2021, 1, 1)]
