import datetime

from pyspark.sql import functions as F

from conftest import loans_frame, rows_of
from loanlake import schemas as s
from loanlake.operators import cleaning

HEADERS = [
    "Property State", "Property_County", "Property_Zip", " Orig_Num ", "Sponosr_Number", "Sponsor_Name",
    "Down_Payment_Source", "Loan_Purpose", "Endorsement  Year", "Endorsement Month", "Unnamed: 7",
    "Original Mortgage Amount", "Interest Rate",
]


def raw(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in HEADERS))


def row(purpose="Purchase", down="Borrower", county="ORANGE", sponsor="S", zip_="92101", number="12345.0"):
    return ("CA", county, zip_, number, "77", sponsor, down, purpose, "2024", "3", "x", "250000", "3.5")


def test_headers_types_and_bad_numbers(spark):
    df = cleaning.clean_single_family(raw(spark, row(zip_="abc")))
    got = df.collect()[0].asDict()
    assert "Unnamed: 7" not in got
    assert got["Property Zip"] is None
    assert got[s.ORIG_NO] == 12345 and got[s.SPONSOR_NO] == 77
    assert (got[s.YEAR], got[s.MONTH], got[s.AMOUNT], got[s.RATE]) == (2024, 3, 250000, 3.5)
    types = dict(df.dtypes)
    assert types[s.YEAR] == "smallint" and types[s.ORIG_NO] == "int" and types[s.AMOUNT] == "bigint"


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("nan", "NaN"), ("3.5", "7")], "`Interest Rate` string, `Property Zip` string")
    assert rows_of(cleaning.clean_single_family(df)) == [(None, None), (3.5, 7)]


def test_purpose_rules(spark):
    purposes = ["Loan_Purpose", None, "Fixed Rate", "Adjustable Rate", "Rehabilitation", "Single Family",
                "Refi_Conv-Curr", "a-b-c-d", "Refi_FHA"]
    df = cleaning.clean_single_family(raw(spark, *[row(purpose=p) for p in purposes]))
    assert sorted(r[s.PURPOSE] for r in df.collect()) == sorted(
        ["Purchase"] * 4 + ["Refi_Conv_Curr", "a_b_c-d", "Refi_FHA"]
    )


def test_down_payment_and_sentinels(spark):
    df = cleaning.clean_single_family(
        raw(spark, *[row(down=d) for d in ("NonProfit", " ", "nan", "Relative", None)],
            row(county="#NULL!"), row(sponsor="Not Available"))
    )
    got = df.collect()
    assert [r[s.DOWN] for r in got[:5]] == ["Non Profit", None, None, "Relative", None]
    assert got[5][s.COUNTY] is None and got[6][s.SPONSOR] is None


def test_header_variants_merge(spark):
    df = spark.createDataFrame([("2019", None), (None, "2020")], "`Endorsement_Year` string, `Endorsment_Year` string")
    assert [r[0] for r in rows_of(cleaning.clean_single_family(df))] == [2019, 2020]


def test_rejected_values(spark):
    counts = dict(rows_of(cleaning.rejected_values(raw(spark, row(), row(zip_="abc"), row(zip_=" "), row(number="x")))))
    assert counts["Property Zip"] == 1 and counts[s.ORIG_NO] == 1 and counts[s.AMOUNT] == 0


def test_clean_hecm(spark):
    df = spark.createDataFrame(
        [("CA", "Not Available", "12.0", "nan", "5", "2023"), ("TX", "x", "bad", "None", "Not Available", "2023")],
        "`Property State` string, `Originating Mortgagee Sponsor Or` string, `NMLS*` string, "
        "`Sponsored Originator` string, `Previous Servicer` string, `Endorsement Year` string",
    )
    out = cleaning.clean_hecm(df)
    assert out.columns == [s.STATE, s.ORIG, "NMLS", "Sponsor Originator", "Previous Servicer ID", s.YEAR]
    assert rows_of(out) == [("CA", None, 12, None, 5, 2023), ("TX", "x", None, None, None, 2023)]


def export_input(spark):
    rows = [
        (2014, 8, 1, "A", 9, "S"),
        (2014, 8, 1, "A", 9, "S"),
        (2014, 9, 1, None, 9, "nan"),
        (2014, 13, 1, "None", 9, "T"),
        (None, 1, 1, "B", 9, "T"),
    ]
    return loans_frame(spark, rows)


def test_prepare_export(spark):
    out = cleaning.prepare_export(export_input(spark)).select(s.YEAR, s.MONTH, s.ORIG, s.SPONSOR, s.DATE)
    assert sorted(rows_of(out)) == [
        (2014, 8, "A", "", datetime.date(2014, 8, 1)),
        (2014, 9, "", "", datetime.date(2014, 9, 1)),
        (2014, 13, "", "T", None),
    ]


def test_prepare_export_options(spark):
    hecm = cleaning.prepare_export(export_input(spark), s.HECM_KIND, blank_as_null=True)
    got = {r[s.MONTH]: (r[s.ORIG], r[s.SPONSOR]) for r in hecm.collect()}
    assert got == {8: ("A", "S"), 9: (None, None), 13: (None, "T")}
    assert s.DATE not in cleaning.prepare_export(export_input(spark), add_date=False).columns


def test_domain_violations(spark, sample):
    got = rows_of(cleaning.domain_violations(sample.filter(F.col(s.STATE) != "FL")))
    assert got == [
        (s.DOWN, "Gift", 2), (s.DOWN, "Savings", 2), (s.PURPOSE, "Refinance", 1),
        (s.PRODUCT, "Energy Efficient", 1), (s.PRODUCT, "Standard", 3),
    ]
