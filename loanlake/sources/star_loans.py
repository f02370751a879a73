"""Loan-shaped views over the star-schema test tables.

``lineitem`` is the fact; ``supplier``, ``orders``, ``customer``, ``nation`` and
``part`` supply attributes over their primary keys by left joins.  A left join on a
unique key neither drops nor repeats rows, so a dimension is joined only when one of
its columns is asked for.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.row_keys import row_key, running_numbers
from ..schemas import (
    AMOUNT,
    CITY,
    COUNTY,
    DATE,
    DOWN,
    FIPS,
    INDEX,
    MONTH,
    ORIG,
    ORIG_NO,
    PRODUCT,
    PROPERTY,
    PURPOSE,
    RATE,
    SPONSOR,
    SPONSOR_NO,
    STATE,
    YEAR,
    ZIP,
)

LOAN_COLUMNS = (
    INDEX, STATE, CITY, COUNTY, ZIP, ORIG, ORIG_NO, SPONSOR, SPONSOR_NO, DOWN,
    PRODUCT, PURPOSE, PROPERTY, RATE, AMOUNT, YEAR, MONTH, DATE, FIPS,
)

_FROM_SUPPLIER = {ORIG}
_FROM_ORDERS = {DOWN}
_FROM_CUSTOMER = {CITY, STATE, FIPS}
_FROM_NATION = {STATE}
_FROM_PART = {COUNTY, PROPERTY, FIPS}
_KEY_BLOCK = 1 << 16


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str, *columns: str, months: Column | None = None) -> DataFrame:
    """The loan view with the given columns (all of them by default).

    ``months``, a condition on year and month, leaves out whole months before rows are numbered and joined.
    """
    wanted = set(columns or LOAN_COLUMNS)
    unknown = wanted.difference(LOAN_COLUMNS)
    if unknown:
        raise ValueError(f"Unknown loan columns: {sorted(unknown)}")

    df = read_table(spark, sf_dir, "lineitem").withColumns(
        {
            YEAR: F.year("l_shipdate").cast("smallint"),
            MONTH: F.month("l_shipdate").cast("smallint"),
        }
    )
    if months is not None:
        df = df.filter(months)
    if INDEX in wanted:
        order = [
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
            "l_quantity", "l_discount", "l_tax", "l_shipdate",
        ]
        # Order keys come first in the order, so ranges of them are valid blocks.
        block = F.floor(F.col("l_orderkey") / _KEY_BLOCK)
        df = running_numbers(df, [YEAR, MONTH], block, order)
    if wanted & _FROM_SUPPLIER:
        supplier = read_table(spark, sf_dir, "supplier")
        df = df.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if wanted & _FROM_PART:
        part = read_table(spark, sf_dir, "part")
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    # Last, as orders bring the most text, which every later join would deal again.
    if wanted & (_FROM_ORDERS | _FROM_CUSTOMER):
        orders = read_table(spark, sf_dir, "orders")
        # Dimensions of the orders are joined to them first: there are fewer orders than loans.
        if wanted & _FROM_CUSTOMER:
            customer = read_table(spark, sf_dir, "customer")
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        if wanted & _FROM_NATION:
            nation = read_table(spark, sf_dir, "nation")
            orders = orders.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    unsponsored = F.col("l_linenumber") % 3 == 0
    sponsor = ((F.col("l_suppkey") + F.col("l_partkey") % 3) % 20).cast("int")
    renamed = (F.col("l_suppkey") % 10 == 3) & (F.col(YEAR) >= 2000)
    oscillates = (F.col("l_suppkey") % 10 == 5) & (F.col(YEAR) == 1998)
    expressions = {
        INDEX: lambda: row_key(F.lit("single_family"), F.col(YEAR), F.col(MONTH), F.col("row_num")),
        STATE: lambda: F.col("n_name"),
        CITY: lambda: F.col("c_mktsegment"),
        COUNTY: lambda: F.col("p_brand"),
        ZIP: lambda: (F.col("l_partkey") % 100000).cast("int"),
        ORIG: lambda: F.when(renamed, F.concat("s_name", F.lit(" LLC")))
        .when(oscillates, F.concat("s_name", F.lit(" CO")))
        .otherwise(F.col("s_name")),
        ORIG_NO: lambda: F.when(F.col("l_orderkey") % 7 != 0, F.col("l_suppkey").cast("int")),
        SPONSOR: lambda: F.when(~unsponsored, F.concat(F.lit("Sponsor#"), sponsor.cast("string"))),
        SPONSOR_NO: lambda: F.when(~unsponsored, sponsor),
        DOWN: lambda: F.when(F.col("o_orderpriority") == "1-URGENT", "Borrower")
        .when(F.col("o_orderpriority") == "2-HIGH", "Relative")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Gov Asst")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Non Profit")
        .otherwise("Employer"),
        PRODUCT: lambda: F.when(F.col("l_linestatus") == "O", "Fixed Rate").otherwise("Adjustable Rate"),
        PURPOSE: lambda: F.when(F.col("l_returnflag") == "A", "Purchase")
        .when(F.col("l_returnflag") == "N", "Refi_FHA")
        .otherwise("Refi_Conv_Curr"),
        PROPERTY: lambda: F.when(F.col("p_size") % 5 == 0, "Single Family")
        .when(F.col("p_size") % 5 == 1, "Condo")
        .when(F.col("p_size") % 5 == 2, "Rehabilitation")
        .when(F.col("p_size") % 5 == 3, "H4H")
        .otherwise("Other"),
        RATE: lambda: F.round(2.5 + F.col("l_discount") * 40, 3),
        AMOUNT: lambda: F.floor("l_extendedprice").cast("bigint"),
        YEAR: lambda: F.col(YEAR),
        MONTH: lambda: F.col(MONTH),
        DATE: lambda: F.trunc("l_shipdate", "month"),
        FIPS: lambda: F.lpad(
            (F.col("c_nationkey") * 1000 + F.substring("p_brand", 7, 10).cast("int")).cast("string"),
            5,
            "0",
        ),
    }
    return df.select(*[expressions[c]().alias(c) for c in LOAN_COLUMNS if c in wanted])


def reverse_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of the second program: parties and month of every loan."""
    number = (F.col("o_custkey") % 40).cast("int")
    sponsor = (F.col("o_orderkey") % 25).cast("int")
    return read_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 11 != 0, number).alias(ORIG_NO),
        F.concat(F.lit("Reverse#"), number.cast("string")).alias(ORIG),
        F.when(F.col("o_orderstatus") != "P", sponsor).alias(SPONSOR_NO),
        F.concat(F.lit("Sponsor#"), sponsor.cast("string")).alias(SPONSOR),
        F.trunc("o_orderdate", "month").alias(DATE),
    )


REVERSE_SQL = """
SELECT CASE WHEN o_orderkey % 11 <> 0 THEN cast(o_custkey % 40 AS int) END AS "Originating Mortgagee Number",
  'Reverse#' || cast(o_custkey % 40 AS varchar) AS "Originating Mortgagee",
  CASE WHEN o_orderstatus <> 'P' THEN cast(o_orderkey % 25 AS int) END AS "Sponsor Number",
  'Sponsor#' || cast(o_orderkey % 25 AS varchar) AS "Sponsor Name",
  cast(date_trunc('month', o_orderdate) AS date) AS "Date"
FROM orders
"""

# The same view in portable SQL, for independent checks.
LOANS_SQL = """
SELECT
  concat(lpad(cast(y AS varchar), 4, '0'), lpad(cast(m AS varchar), 2, '0'), '01_',
    lpad(cast(row_number() OVER (PARTITION BY y, m ORDER BY l_orderkey, l_linenumber, l_partkey,
      l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) AS varchar), 7, '0')) AS "FHA_Index",
  n_name AS "Property State", c_mktsegment AS "Property City", p_brand AS "Property County",
  cast(l_partkey % 100000 AS int) AS "Property Zip",
  CASE WHEN l_suppkey % 10 = 3 AND y >= 2000 THEN s_name || ' LLC'
       WHEN l_suppkey % 10 = 5 AND y = 1998 THEN s_name || ' CO' ELSE s_name END AS "Originating Mortgagee",
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE cast(l_suppkey AS int) END AS "Originating Mortgagee Number",
  CASE WHEN l_linenumber % 3 = 0 THEN NULL
       ELSE 'Sponsor#' || cast((l_suppkey + l_partkey % 3) % 20 AS varchar) END AS "Sponsor Name",
  CASE WHEN l_linenumber % 3 = 0 THEN NULL
       ELSE cast((l_suppkey + l_partkey % 3) % 20 AS int) END AS "Sponsor Number",
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Borrower' WHEN '2-HIGH' THEN 'Relative'
    WHEN '3-MEDIUM' THEN 'Gov Asst' WHEN '4-NOT SPECIFIED' THEN 'Non Profit' ELSE 'Employer' END
    AS "Down Payment Source",
  CASE l_linestatus WHEN 'O' THEN 'Fixed Rate' ELSE 'Adjustable Rate' END AS "Product Type",
  CASE l_returnflag WHEN 'A' THEN 'Purchase' WHEN 'N' THEN 'Refi_FHA' ELSE 'Refi_Conv_Curr' END AS "Loan Purpose",
  CASE p_size % 5 WHEN 0 THEN 'Single Family' WHEN 1 THEN 'Condo' WHEN 2 THEN 'Rehabilitation'
    WHEN 3 THEN 'H4H' ELSE 'Other' END AS "Property Type",
  round(2.5 + l_discount * 40, 3) AS "Interest Rate",
  cast(floor(l_extendedprice) AS bigint) AS "Mortgage Amount",
  cast(y AS smallint) AS "Year", cast(m AS smallint) AS "Month",
  cast(date_trunc('month', l_shipdate) AS date) AS "Date",
  lpad(cast(c_nationkey * 1000 + cast(substr(p_brand, 7) AS int) AS varchar), 5, '0') AS "FIPS"
FROM (SELECT *, year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem)
LEFT JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN part ON p_partkey = l_partkey
"""
