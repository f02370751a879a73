"""Untidy monthly sheets, county tables and file names over the star-schema tables.

``orders`` plays the raw workbooks: every order is a sheet row, with the header
variants, sentinels and bad values that the cleaning rules are about.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import COUNTY, FIPS, STATE
from .star_loans import read_table

STATES = ("CA", "AK", "IL", "MO", "LA", "MN", "PR", "MD", "TX", "DC", "ZZ")
COUNTIES = (
    "Orange County", "EL PASO", "DU PAGE", "STE GENEVIEVE", "ST JOHN THE BAPTIST", "ST LOUIS", "Bayam'n",
    "Baltimore", "#NULL!", "nan", "Washington", "DE KALB", "Los Angeles",
)
DOWN_PAYMENTS = ("NonProfit", " ", "nan", "Borrower", "Relative", None)
PURPOSES = (
    "Loan_Purpose", None, "Fixed Rate", "Rehabilitation", "Refi_Conv-Curr", "Refi_FHA", "Purchase", "a-b-c-d",
    "Single Family",
)
REFERENCE = (
    ("CA", "Los Angeles County", "06037"), ("CA", "Orange County", "6059"), ("IL", "DuPage County", "17043"),
    ("MO", "Ste. Genevieve County", "29186"), ("LA", "St. John the Baptist Parish", "22095"),
    ("MN", "St. Louis County", "27137"), ("PR", "Bayamón Municipio", "72021"), ("TX", "El Paso County", "48141"),
    ("MD", "Baltimore County", "24005"), ("MD", "Baltimore city", "24510"), ("IL", "DeKalb County", "17037"),
)


def _later(date: Column, years: Column | int = 19) -> Column:
    """Some years on; 19 put the orders into the years of the programs."""
    return F.add_months(date, 12 * years)


def _pick(values: tuple, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int"))


def county_reference(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REFERENCE), "state string, county string, fips string")


def stored_crosswalk(spark: SparkSession) -> DataFrame:
    rows = [("CA", "ORANGE", "6059"), ("ca", "Orange County", "99999"), ("IL", "DUPAGE", "17043")]
    return spark.createDataFrame(rows, f"`{STATE}` string, `{COUNTY}` string, `{FIPS}` string")


def stored_problems(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("PR", "BAYAMON"), ("QQ", "NOWHERE")], f"`{STATE}` string, `{COUNTY}` string")


def raw_sheets(spark: SparkSession, sf_dir: str, years: Column | int = 19, *, stray: Column | None = None) -> DataFrame:
    """Single family sheets as exported: text columns, untidy headers, place of every row.

    Rows with ``stray`` (a condition on the orders) name the month after that of their file.
    """
    key, cust, date = F.col("o_orderkey"), F.col("o_custkey"), _later(F.col("o_orderdate"), years)
    named = date if stray is None else F.when(stray, F.add_months(date, 1)).otherwise(date)
    year = F.year(named).cast("string")
    sheet = F.col("o_orderstatus")
    return read_table(spark, sf_dir, "orders").select(
        F.when(sheet == "O", "Data Purchase").when(sheet == "F", "Data Refinance").otherwise("Notes").alias("sheet_name"),
        F.when(sheet == "O", 0).when(sheet == "F", 1).otherwise(2).alias("sheet_ord"),
        key.alias("row_ord"),
        F.lit("single_family").alias("snapshot_kind"),
        F.year(date).alias("snapshot_year"),
        F.month(date).alias("snapshot_month"),
        _pick(STATES, cust).alias("Property_State"),
        F.lit("Springfield").alias("Property City"),
        _pick(COUNTIES, key).alias(" Property_County "),
        F.when(key % 97 == 0, "abc").otherwise((cust % 100000).cast("string")).alias("Property_Zip"),
        F.when(key % 43 == 0, "nan")
        .when(key % 41 != 0, F.concat(F.lit("Lender "), (cust % 37).cast("string")))
        .alias("Origination Mortgagee/Sponsor Originator"),
        F.concat((cust % 37 + 100).cast("string"), F.lit(".0")).alias("Orig_Num"),
        F.when(key % 13 == 0, "Not Available")
        .otherwise(F.concat(F.lit("Sponsor "), (key % 19).cast("string")))
        .alias("Sponsor_Name"),
        (key % 19).cast("string").alias("Sponosr_Number"),
        _pick(DOWN_PAYMENTS, key).alias("Down_Payment_Source"),
        F.when(key % 53 == 0, "9999999999999999999999").otherwise((key % 7).cast("string")).alias("Non Profit Number"),
        F.when(key % 2 == 0, "Fixed Rate").otherwise("Adjustable Rate").alias("Product_Type"),
        _pick(PURPOSES, key).alias("Loan_Purpose"),
        F.lit("Condo").alias("Property/Product Type"),
        F.when(key % 89 == 0, "n/a").otherwise((cust % 40 / 8 + 2).cast("string")).alias("Interest_Rate"),
        F.floor("o_totalprice").cast("string").alias("Original Mortgage Amount"),
        F.when(key % 2 == 0, year).alias("Endorsement_Year"),
        F.when(key % 2 == 1, year).alias("Endorsment Year"),
        F.month(named).cast("string").alias("Endorsement_Month"),
        F.lit("x").alias("Unnamed: 7"),
    )


def raw_hecm_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HECM sheets as exported."""
    key, cust, date = F.col("o_orderkey"), F.col("o_custkey"), _later(F.col("o_orderdate"))
    return read_table(spark, sf_dir, "orders").select(
        F.lit("data").alias("sheet_name"),
        F.lit(0).alias("sheet_ord"),
        key.alias("row_ord"),
        F.lit("hecm").alias("snapshot_kind"),
        F.year(date).alias("snapshot_year"),
        F.month(date).alias("snapshot_month"),
        _pick(STATES, cust).alias(STATE),
        F.when(key % 5 == 0, "Not Available").otherwise(F.concat(F.lit("Lender "), (cust % 37).cast("string"))).alias(
            "Originating Mortgagee Sponsor Or"
        ),
        (cust % 37).cast("string").alias("Originating Mortgagee Number"),
        F.when(key % 3 == 0, "None").otherwise("Sponsor").alias("Sponsor Name"),
        F.when(key % 7 == 0, "bad").otherwise((key % 1000).cast("string")).alias("NMLS*"),
        F.when(key % 2 == 0, "Saver").otherwise("nan").alias("Standard Saver"),
        F.lit("Purchase").alias("Purchase /Refinance"),
        (cust % 40 / 8 + 2).cast("string").alias("Interest Rate"),
        F.floor("o_totalprice").cast("string").alias("Maximum Claim Amount"),
        F.year(date).cast("string").alias("Endorsement Year"),
        F.month(date).cast("string").alias("Endorsement Month"),
        (key % 11).cast("string").alias("Previous Servicer"),
        F.lit("x").alias("Unnamed 1"),
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct file names in the styles of several years, one per month and style."""
    date = F.col("o_orderdate")
    month, year = F.date_format(date, "MM"), F.date_format(date, "yyyy")
    styles = (
        F.concat(F.lit("raw/FHA_SF_Snapshot_"), year, month, F.lit("01.xlsx")),
        F.concat(F.lit("fha_hecm_snapshot_"), year, month, F.lit("01.parquet")),
        F.concat(F.lit("FHA_SFSnapshot_"), F.date_format(date, "MMM"), F.lit("2023.xlsx")),
        F.concat(F.lit("snap_"), month, F.substring(year, 3, 2), F.lit(".zip")),
        F.concat(F.lit("loans_20"), F.lit("2"), F.substring(year, 4, 1), month, F.lit(".csv")),
        F.concat(F.lit("notes-"), F.col("o_orderstatus"), F.lit(".txt")),
    )
    return read_table(spark, sf_dir, "orders").select(F.explode(F.array(*styles)).alias("path")).distinct()
