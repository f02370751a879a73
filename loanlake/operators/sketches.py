"""Numbers of active lenders and sponsors from sketches, where an estimate is enough.

A table of one row per month holds the loans and a HyperLogLog sketch of each kind of name.
Sketches of months merge into those of longer periods, so a new month only adds its row and no
name is shuffled again.  The standard error is about ``1.04 / sqrt(2**precision)``; few names (up
to an eighth of that many) are counted almost exactly.  Missing names count as one value for
lenders, as in the exact counts, and not at all for sponsors.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import month_date, ratio
from ..schemas import MONTH, ORIG, SPONSOR, YEAR

PRECISION = 14


def month_sketches(df: DataFrame, precision: int = PRECISION) -> DataFrame:
    """``Year, Month, lenders, sponsors, loans, unnamed, sponsored``, the first two as sketches."""
    return df.groupBy(YEAR, MONTH).agg(
        F.hll_sketch_agg(ORIG, precision).alias("lenders"),
        F.hll_sketch_agg(SPONSOR, precision).alias("sponsors"),
        F.count("*").alias("loans"),
        F.count(F.when(F.col(ORIG).isNull(), 1)).alias("unnamed"),
        F.count(SPONSOR).alias("sponsored"),
    )


def _estimate(sketch: str) -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def _lenders() -> Column:
    return (_estimate("lenders") + F.max((F.col("unnamed") > 0).cast("int"))).alias("Active Lenders")


def yearly_lenders(sketches: DataFrame) -> DataFrame:
    """As :func:`.activity.yearly_lenders`, with estimated lenders."""
    table = sketches.groupBy(YEAR).agg(_lenders(), F.sum("loans").alias("Total Loans"))
    return table.withColumn("Avg Loans per Lender", ratio("Total Loans", "Active Lenders")).orderBy(YEAR)


def yearly_sponsors(sketches: DataFrame) -> DataFrame:
    """As :func:`.activity.yearly_sponsors`, with estimated sponsors."""
    some = sketches.filter("sponsored > 0")
    return some.groupBy(YEAR).agg(
        _estimate("sponsors").alias("Active Sponsors"), F.sum("sponsored").alias("Sponsored Loans")
    ).orderBy(YEAR)


def active_lenders(sketches: DataFrame) -> DataFrame:
    """As :func:`.trends.active_lenders`, with estimated lenders."""
    return sketches.groupBy(month_date().alias("Date")).agg(_lenders()).orderBy("Date")
