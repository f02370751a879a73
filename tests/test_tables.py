"""Activity, trend, geography and concentration on hand-computed data."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from loanlake import schemas as s
from loanlake.operators import activity, concentration, geography, trends
from loanlake.plans.reports import exploratory_tables

JUNE = datetime.date(2025, 6, 1)


def test_lender_and_sponsor_activity(sample):
    tables = {**activity.lender_activity(sample), **activity.sponsor_activity(sample)}
    assert rows_of(tables["lender_volume"])[0] == ("Lender A", 3, 1155000, 385000.0)
    assert rows_of(tables["yearly_lenders"]) == [(2025, 3, 5, pytest.approx(5 / 3))]
    assert rows_of(tables["sponsor_volume"])[0] == ("Sponsor X", 3, 1155000, 385000.0)
    assert rows_of(tables["yearly_sponsors"]) == [(2025, 3, 5)]


def test_null_lender_counts_as_one(sample):
    df = sample.withColumn(s.ORIG, F.when(F.col(s.STATE) != "CA", F.col(s.ORIG)))
    assert rows_of(activity.yearly_lenders(df))[0][1] == 4
    assert activity.sponsor_volume(df.withColumn(s.SPONSOR, F.lit(None).cast("string"))).count() == 0


def test_panel(sample, tmp_path):
    rows = activity.lender_panel(sample, "Quarterly").collect()
    a = rows[0].asDict()
    assert (a["Quarter"], a["loan_count"], a["purchase_loan_count"], a["refinance_loan_count"]) == (2, 3, 2, 1)
    assert a["refinance_share"] == pytest.approx(1 / 3) and a["frequency"] == "quarterly"
    cleaned = sample.withColumn(s.PURPOSE, F.lit("Refi_FHA"))
    assert activity.lender_panel(cleaned).agg(F.sum("refinance_loan_count")).first()[0] == 5
    literal = activity.lender_panel(cleaned, literal_refinance=True)
    assert literal.agg(F.sum("refinance_loan_count")).first()[0] == 0
    stored = activity.lender_panel(sample, output_path=str(tmp_path / "panels"))
    assert (tmp_path / "panels" / "lender_panel_annual.parquet").exists() and stored.count() == 3
    with pytest.raises(ValueError):
        activity.lender_panel(sample, "weekly")


def test_loan_characteristics(sample):
    out = activity.loan_characteristics(sample)
    assert rows_of(out["loan_purpose"]) == [("Purchase", 4, 0.8), ("Refinance", 1, 0.2)]
    assert rows_of(out["down_payment"]) == [("Gift", 3, 0.6), ("Savings", 2, 0.4)]
    assert rows_of(out["yearly_loan_size"]) == [(2025, 348000.0, 350000.0, 1740000)]


def test_trends(sample):
    assert rows_of(trends.refinance_share(sample)) == [(JUNE, 4, 1, 0.2)]
    assert rows_of(trends.fixed_rate_share(sample)) == [(JUNE, 0, 0, None)]  # no such product: no share
    assert rows_of(trends.active_lenders(sample)) == [(JUNE, 3)]
    assert rows_of(trends.loan_size_trend(sample)) == [(JUNE, "mean", 348000.0), (JUNE, "median", 350000.0)]
    assert rows_of(trends.borrower_funded_share(sample)) == [(JUNE, 0.0)]
    by_property = rows_of(trends.averages_by_property(sample))
    assert [r[1] for r in by_property] == ["Non single family", "Single Family"]
    shares = trends.category_shares(sample)
    assert shares.groupBy("Date", "variable").agg(F.sum("Proportion").alias("p")).filter("abs(p - 1) > 1e-9").count() == 0


def test_top_lender_groups(sample):
    got = rows_of(trends.top_lender_groups(sample, 1))
    assert [r[1] for r in got] == ["Other Lenders", "Top 1 Lenders"]
    assert got[1][3] == 385000.0
    unnamed = sample.withColumn(s.ORIG, F.when(F.col(s.ORIG) != "Lender A", F.col(s.ORIG)))
    groups = {r[1]: r[3] for r in rows_of(trends.top_lender_groups(unnamed, 1))}
    # the unnamed lender ranks first but forms its own group
    assert groups == {None: 385000.0, "Other Lenders": 292500.0}


def test_exploratory_tables(sample):
    out = exploratory_tables(sample)
    assert len(out) == 14 and all(t.columns for t in out.values())


def test_state_and_county_counts(sample, sample_with_fips):
    states = dict(rows_of(geography.state_loan_counts(sample.withColumn(s.STATE, F.lower(s.STATE)))))
    assert states["CA"] == 2 and states["TX"] == 1
    counties = {r[0]: r[1] for r in rows_of(geography.county_loan_counts(sample_with_fips))}
    assert counties["06037"] == counties["06073"] == counties["48201"] == 1
    yearly = rows_of(geography.county_loan_counts(sample_with_fips, by_year=True))
    assert yearly[0] == (2025, "06037", 1, "CA", "Los Angeles")


def test_missing_columns(sample):
    with pytest.raises(ValueError, match="FIPS"):
        geography.county_metrics(sample)
    with pytest.raises(ValueError, match="CBSA Code"):
        geography.metro_metrics(sample.withColumn("FIPS", F.lit("1")))


def test_metro_join_keeps_unmatched_loans(spark, sample_with_fips):
    df = sample_with_fips.withColumn("FIPS", F.lpad(F.col("FIPS").cast("string"), 5, "0"))
    crosswalk = spark.createDataFrame(
        [("06037", "31080", "Los Angeles"), ("06037", "31080", "Los Angeles"), ("06073", "41740", "San Diego")],
        "FIPS string, `CBSA Code` string, `CBSA Title` string",
    )
    got = {r["CBSA Code"]: r["loan_count"] for r in geography.metro_metrics(df, cbsa_crosswalk=crosswalk).collect()}
    assert got == {None: 3, "31080": 1, "41740": 1}


def hhi_frame(spark, rows):
    return spark.createDataFrame(
        rows, f"`{s.YEAR}` smallint, `{s.MONTH}` smallint, `{s.STATE}` string, `{s.COUNTY}` string, `{s.SPONSOR_NO}` int, `{s.ORIG_NO}` int"
    )


def test_hhi_example(spark):
    df = hhi_frame(spark, [(2020, 1, " CA ", "X", 1, 9)] * 3 + [(2020, 5, "CA", "X", None, 2)])
    row = concentration.lender_hhi(df).first()
    assert row["state"] == "CA"
    assert (row["hhi_normalized"], row["hhi"], row["total_loans"], row["num_lenders"]) == (0.625, 6250.0, 4, 2)
    quarters = concentration.lender_hhi(df, "quarter", "county")
    assert [(r["quarter"], r["hhi"]) for r in quarters.collect()] == [(1, 10000.0), (2, 10000.0)]
    everything = concentration.lender_hhi(df, "all", "all", "originator").first()
    assert everything["hhi"] == 6250.0 and "scope" not in everything.asDict()
    assert concentration.lender_hhi(df.limit(0), "all", "all").count() == 0


def test_hhi_missing_values(spark):
    df = hhi_frame(spark, [(2020, 1, "CA", "X", 1, 9), (2020, 1, "", "X", 1, 9), (2020, 1, "CA", "X", None, None)])
    assert [r["total_loans"] for r in concentration.lender_hhi(df).collect()] == [1]
    kept = {r["state"]: (r["total_loans"], r["num_lenders"]) for r in concentration.lender_hhi(df, drop_missing=False).collect()}
    assert kept == {"": (1, 1), "CA": (2, 2)}


def test_hhi_of_text_ids(spark):
    rows = [(2020, 1, "CA", "X", " 1 ", "9"), (2020, 1, "CA", "X", "1", "9"), (2020, 1, "CA", "X", " ", "2\u00a0")]
    text = spark.createDataFrame(
        rows, f"`{s.YEAR}` int, `{s.MONTH}` int, `{s.STATE}` string, `{s.COUNTY}` string, `{s.SPONSOR_NO}` string, `{s.ORIG_NO}` string"
    )
    row = concentration.lender_hhi(text).first()
    assert (row["total_loans"], row["num_lenders"], row["hhi_normalized"]) == (3, 2, pytest.approx(5 / 9))
    mixed = text.withColumn(s.ORIG_NO, F.trim(F.translate(s.ORIG_NO, "\u00a0", "")).cast("int"))
    assert concentration.lender_hhi(mixed).first()["num_lenders"] == 2
    cells = concentration.hhi_cells(mixed).filter("time_level = 'all' AND geography_level = 'all' AND lender_type = 'sponsor'")
    assert cells.first()["num_lenders"] == 2


def test_hhi_arguments(spark):
    df = hhi_frame(spark, [])
    for args in (("week",), ("year", "city"), ("year", "state", "bank")):
        with pytest.raises(ValueError):
            concentration.lender_hhi(df, *args)


def test_hhi_bounds_and_cells(spark):
    df = hhi_frame(spark, [(2020 + i % 2, i % 12 + 1, "AB"[i % 2], "XYZ"[i % 3], i % 4 or None, i % 7) for i in range(200)])
    cells = concentration.hhi_cells(df)
    assert cells.filter("hhi <= 0 OR hhi > 10000.0001").count() == 0
    for t in concentration.TIME_LEVELS:
        for g in concentration.GEOGRAPHY_LEVELS:
            one = concentration.lender_hhi(df, t, g, "originator")
            part = cells.filter((F.col("time_level") == t) & (F.col("geography_level") == g) & (F.col("lender_type") == "originator"))
            assert sorted(rows_of(part.select(one.columns)), key=str) == sorted(rows_of(one), key=str)


def test_trend_tables_equal_the_single_tables(spark):
    from conftest import SMALL
    from loanlake.sources.star_loans import loans

    df = loans(spark, SMALL, s.DATE, s.ORIG, s.DOWN, s.PROPERTY, s.PRODUCT, s.PURPOSE, s.RATE, s.AMOUNT)
    tables = trends.trend_tables(df, 5)
    single = {
        "active_lenders": trends.active_lenders(df),
        "down_payment_source": trends.borrower_funded_share(df),
        "by_property_type": trends.averages_by_property(df),
        "top_lender_groups": trends.top_lender_groups(df, 5),
        "category_counts": trends.category_counts(df),
    }
    for name, table in single.items():
        for a, b in zip(rows_of(tables[name]), rows_of(table), strict=True):
            assert a == pytest.approx(b) if all(isinstance(x, float) for x in a) else str(a)[:20] == str(b)[:20]
            assert [x for x in a if isinstance(x, float)] == pytest.approx([x for x in b if isinstance(x, float)])


def test_counts_are_dealt_before_they_are_expanded(spark):
    """Only counts by lender and sums by cell are shuffled; twelve rows for every count were before."""
    counts = spark.createDataFrame(
        [(2020, 1, 1, "CA", "LA", "sponsor", "a", 2), (2020, 1, 2, "CA", None, "sponsor", "a", 1)],
        "year int, quarter int, month int, state string, county string, lender_type string, lender_id string, n bigint",
    )
    cells = concentration.cells_of(counts)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Generate explode") :]
    assert plan.count("Exchange hashpartitioning") == 2 and below.count("Exchange hashpartitioning") == 1
    got = {(r["time_level"], r["geography_level"]): r["total_loans"] for r in cells.filter("time_level = 'all'").collect()}
    assert got == {("all", "all"): 3, ("all", "state"): 3, ("all", "county"): 2}
