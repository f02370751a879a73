"""Amount and rate summaries per group, in one scan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import MEDIAN, median_of, nearest, order_statistics
from ..schemas import AMOUNT, RATE


def amount_summary(df: DataFrame, keys: list[str], amount: str = AMOUNT) -> DataFrame:
    """``loan_count, avg_amount, median_amount, total_amount`` per group."""
    hist = df.groupBy(*keys, F.col(amount).alias("v")).agg(F.count("*").alias("n"))
    found = order_statistics(hist, keys, MEDIAN, {"volume": (F.sum, F.col("v") * F.col("n"))})
    return found.select(
        *[F.col(f"`{c}`") for c in keys],
        F.col("rows").alias("loan_count"),
        F.col("mean").alias("avg_amount"),
        median_of().alias("median_amount"),
        F.coalesce("volume", F.lit(0)).alias("total_amount"),
    )


def mortgage_summary(
    df: DataFrame, keys: list[str], amount: str = AMOUNT, rate: str = RATE
) -> DataFrame:
    """Counts, amount statistics and rate spread per group.

    Amount and rate are two rows of one long frame, so both histograms come from a
    single scan and a single exchange.
    """
    measures = F.explode(
        F.array(
            F.struct(F.lit("amount").alias("m"), F.col(amount).cast("double").alias("v")),
            F.struct(F.lit("rate").alias("m"), F.col(rate).cast("double").alias("v")),
        )
    ).alias("x")
    hist = (
        df.select(*keys, measures)
        .groupBy(*keys, F.col("x.m").alias("m"), F.col("x.v").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    volume = F.when(F.col("m") == "amount", F.col("v").cast("bigint") * F.col("n"))
    ranks = {**MEDIAN, "lower": nearest(0.25), "upper": nearest(0.75)}
    found = order_statistics(hist, [*keys, "m"], ranks, {"volume": (F.sum, volume)})

    def of(measure: str, value: Column) -> Column:
        return F.max(F.when(F.col("m") == measure, value))

    degrees = of("rate", F.col("total")) - 1
    return found.groupBy(*keys).agg(
        of("amount", F.col("rows")).alias("loan_count"),
        of("amount", median_of()).alias("median_mortgage_amount"),
        of("amount", F.col("mean")).alias("avg_mortgage_amount"),
        F.coalesce(of("amount", F.col("volume")), F.lit(0)).alias("total_mortgage_amount"),
        of("rate", F.col("mean")).alias("avg_interest_rate"),
        F.when(degrees > 0, F.sqrt(of("rate", F.col("squares")) / F.nullif(degrees, F.lit(0)))).alias("interest_rate_std"),
        of("rate", F.col("upper") - F.col("lower")).alias("interest_rate_iqr"),
    )
