"""Table schemas, column names and fixed value lists of the loan snapshots."""

from pyspark.sql import types as T

# --- column names shared by both programs -----------------------------------
YEAR, MONTH, DATE = "Year", "Month", "Date"
STATE, CITY, COUNTY, ZIP = "Property State", "Property City", "Property County", "Property Zip"
ORIG, ORIG_NO = "Originating Mortgagee", "Originating Mortgagee Number"
SPONSOR, SPONSOR_NO = "Sponsor Name", "Sponsor Number"
DOWN, NONPROFIT_NO = "Down Payment Source", "Non Profit Number"
PRODUCT, PURPOSE, PROPERTY = "Product Type", "Loan Purpose", "Property Type"
RATE, AMOUNT = "Interest Rate", "Mortgage Amount"
INDEX, FIPS = "FHA_Index", "FIPS"

SINGLE_FAMILY_KIND, HECM_KIND = "single_family", "hecm"


# Column order and types of the single family table.
SINGLE_FAMILY = T.StructType(
    [
        T.StructField(STATE, T.StringType()),
        T.StructField(CITY, T.StringType()),
        T.StructField(COUNTY, T.StringType()),
        T.StructField(ZIP, T.IntegerType()),
        T.StructField(ORIG, T.StringType()),
        T.StructField(ORIG_NO, T.IntegerType()),
        T.StructField(SPONSOR, T.StringType()),
        T.StructField(SPONSOR_NO, T.IntegerType()),
        T.StructField(DOWN, T.StringType()),
        T.StructField(NONPROFIT_NO, T.LongType()),
        T.StructField(PRODUCT, T.StringType()),
        T.StructField(PURPOSE, T.StringType()),
        T.StructField(PROPERTY, T.StringType()),
        T.StructField(RATE, T.DoubleType()),
        T.StructField(AMOUNT, T.LongType()),
        T.StructField(YEAR, T.ShortType()),
        T.StructField(MONTH, T.ShortType()),
        T.StructField(INDEX, T.StringType()),
    ]
)

# Column order and types of the HECM (reverse mortgage) table.
HECM = T.StructType(
    [
        T.StructField(STATE, T.StringType()),
        T.StructField(CITY, T.StringType()),
        T.StructField(COUNTY, T.StringType()),
        T.StructField(ZIP, T.IntegerType()),
        T.StructField(ORIG, T.StringType()),
        T.StructField(ORIG_NO, T.IntegerType()),
        T.StructField(SPONSOR, T.StringType()),
        T.StructField(SPONSOR_NO, T.IntegerType()),
        T.StructField("Sponsor Originator", T.StringType()),
        T.StructField("NMLS", T.LongType()),
        T.StructField("Standard/Saver", T.StringType()),
        T.StructField("Purchase/Refinance", T.StringType()),
        T.StructField("Rate Type", T.StringType()),
        T.StructField(RATE, T.DoubleType()),
        T.StructField("Initial Principal Limit", T.DoubleType()),
        T.StructField("Maximum Claim Amount", T.DoubleType()),
        T.StructField(YEAR, T.ShortType()),
        T.StructField(MONTH, T.ShortType()),
        T.StructField("HECM Type", T.StringType()),
        T.StructField("Current Servicer ID", T.LongType()),
        T.StructField("Previous Servicer ID", T.LongType()),
        T.StructField(INDEX, T.StringType()),
    ]
)

# Allowed categories of the single family table.
CATEGORY_DOMAINS = {
    PURPOSE: ("Purchase", "Refi_FHA", "Refi_Conv_Curr"),
    PROPERTY: ("Single Family", "Condo", "Rehabilitation", "H4H", "Other"),
    PRODUCT: ("Fixed Rate", "Adjustable Rate"),
    DOWN: ("Borrower", "Relative", "Gov Asst", "Non Profit", "Employer"),
}

# Header variants seen in single family workbooks
# (after trimming and turning underscores into spaces).
SINGLE_FAMILY_HEADERS = {
    "Endorsement Month": MONTH,
    "Original Mortgage Amount": AMOUNT,
    "Origination Mortgagee/Sponsor Originator": ORIG,
    "Origination Mortgagee Sponsor Or": ORIG,
    "Orig Num": ORIG_NO,
    "Property/Product Type": PROPERTY,
    "Property Type Final": PROPERTY,
    "Sponosr Number": SPONSOR_NO,
    "Sponsor Num": SPONSOR_NO,
    "Endorsement  Year": YEAR,
    "Endorsment Year": YEAR,
    "Endorsement Year": YEAR,
}

# Header variants seen in HECM workbooks.
HECM_HEADERS = {
    "NMLS*": "NMLS",
    "Sponosr Number": SPONSOR_NO,
    "Standard Saver": "Standard/Saver",
    "Purchase /Refinance": "Purchase/Refinance",
    "Purchase Refinance": "Purchase/Refinance",
    "Previous Servicer": "Previous Servicer ID",
    "Endorsement Year": YEAR,
    "Endorsement Month": MONTH,
    "Hecm Type": "HECM Type",
    "Originating Mortgagee/Sponsor Originator": ORIG,
    "Originating Mortgagee Sponsor Originator": ORIG,
    "Originating Mortgagee Sponsor Or": ORIG,
    "Sponsored Originator": "Sponsor Originator",
}

# Columns every loan table must have.
REQUIRED_COLUMNS = (YEAR, MONTH, INDEX, ORIG, ORIG_NO, SPONSOR, SPONSOR_NO, STATE, AMOUNT)


def bronze_schema(kind: str = SINGLE_FAMILY_KIND) -> T.StructType:
    """Schema of the cleaned monthly files."""
    return SINGLE_FAMILY if kind == SINGLE_FAMILY_KIND else HECM


def silver_schema(kind: str = SINGLE_FAMILY_KIND) -> T.StructType:
    """Schema of the exported table: program columns plus ``FIPS`` and ``Date``."""
    return T.StructType(
        bronze_schema(kind).fields + [T.StructField(FIPS, T.StringType()), T.StructField(DATE, T.DateType())]
    )


def require_columns(df, columns, purpose: str) -> None:
    """Raise ``ValueError`` naming the sorted missing columns."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Columns missing for {purpose}: {missing}")
