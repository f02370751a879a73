"""Lender and sponsor activity, panels and descriptive tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import count_where, n_unique, quarter, ratio, sum0
from ..schemas import (
    AMOUNT,
    DOWN,
    MONTH,
    ORIG,
    ORIG_NO,
    PURPOSE,
    RATE,
    SPONSOR,
    STATE,
    YEAR,
)
from ..sources.sinks import write_result

TOP_N = 20


def normalize_frequency(frequency: str) -> str:
    """``annual`` or ``quarterly`` from any accepted spelling."""
    aliases = {
        "annual": "annual",
        "yearly": "annual",
        "year": "annual",
        "quarter": "quarterly",
        "quarterly": "quarterly",
    }
    try:
        return aliases[frequency.lower()]
    except KeyError:
        raise ValueError("frequency must be 'annual' or 'quarterly'") from None


def with_period_keys(df: DataFrame, frequency: str) -> tuple[DataFrame, list[str]]:
    """Add ``Quarter`` when asked for; return the frame and its period keys."""
    if normalize_frequency(frequency) == "quarterly":
        return df.withColumn("Quarter", quarter()), [YEAR, "Quarter"]
    return df, [YEAR]


def _volume_by(df: DataFrame, name_col: str, top_n: int | None) -> DataFrame:
    table = (
        df.groupBy(name_col)
        .agg(F.count("*").alias("Loan Count"), sum0(AMOUNT).alias("Total Volume"))
        .withColumn("Average Loan Size", ratio("Total Volume", "Loan Count"))
        .orderBy(F.desc("Loan Count"), F.asc_nulls_first(name_col))
    )
    return table if top_n is None else table.limit(top_n)


def lender_volume(df: DataFrame, top_n: int | None = TOP_N) -> DataFrame:
    """Largest lenders by number of loans.  Every row is a loan, so no key is asked for."""
    return _volume_by(df, ORIG, top_n)


def yearly_lenders(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(YEAR)
        .agg(n_unique(ORIG).alias("Active Lenders"), F.count("*").alias("Total Loans"))
        .withColumn("Avg Loans per Lender", ratio("Total Loans", "Active Lenders"))
        .orderBy(YEAR)
    )


def lender_activity(df: DataFrame) -> dict[str, DataFrame]:
    return {"lender_volume": lender_volume(df), "yearly_lenders": yearly_lenders(df)}


def sponsor_volume(df: DataFrame, top_n: int | None = TOP_N) -> DataFrame:
    """Largest sponsors by number of sponsored loans."""
    return _volume_by(df.filter(F.col(SPONSOR).isNotNull()), SPONSOR, top_n)


def yearly_sponsors(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col(SPONSOR).isNotNull())
        .groupBy(YEAR)
        .agg(
            F.count_distinct(SPONSOR).alias("Active Sponsors"),
            F.count("*").alias("Sponsored Loans"),
        )
        .orderBy(YEAR)
    )


def sponsor_activity(df: DataFrame) -> dict[str, DataFrame]:
    return {"sponsor_volume": sponsor_volume(df), "yearly_sponsors": yearly_sponsors(df)}


def lender_panel(
    df: DataFrame,
    frequency: str = "annual",
    output_path: str | None = None,
    *,
    literal_refinance: bool = False,
) -> DataFrame:
    """One row per period and lender.

    Cleaned purposes are ``Refi_*``, so a refinance is any purpose that starts with
    ``refi``; ``literal_refinance=True`` counts only the word ``refinance``.
    """
    freq = normalize_frequency(frequency)
    df, keys = with_period_keys(df, freq)
    keys = [*keys, ORIG_NO, ORIG]
    purpose = F.lower(F.coalesce(F.col(PURPOSE), F.lit("")))
    refinance = purpose == "refinance" if literal_refinance else purpose.startswith("refi")
    panel = (
        df.groupBy(*keys)
        .agg(
            F.count("*").alias("loan_count"),
            sum0(AMOUNT).alias("total_mortgage_amount"),
            F.avg(RATE).alias("avg_interest_rate"),
            count_where(purpose == "purchase").alias("purchase_loan_count"),
            count_where(refinance).alias("refinance_loan_count"),
        )
        .withColumns(
            {
                "avg_mortgage_amount": ratio("total_mortgage_amount", "loan_count"),
                "purchase_share": ratio("purchase_loan_count", "loan_count"),
                "refinance_share": ratio("refinance_loan_count", "loan_count"),
                "frequency": F.lit(freq),
            }
        )
        .orderBy(*[F.asc_nulls_first(k) for k in keys])
    )
    return write_result(panel, output_path, f"lender_panel_{freq}.parquet")


def _distribution(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("loan_count"))
    # One row per category reaches the window, never a loan row.
    share = ratio("loan_count", F.sum("loan_count").over(Window.partitionBy()))
    return counts.withColumn("share", share).orderBy(F.desc("loan_count"), F.asc_nulls_first(column))


def loan_characteristics(df: DataFrame) -> dict[str, DataFrame]:
    """Purpose and down-payment distributions and loan size per year."""
    return {
        "loan_purpose": _distribution(df, PURPOSE),
        "down_payment": _distribution(df, DOWN),
        "yearly_loan_size": yearly_loan_size(df),
    }


def yearly_loan_size(df: DataFrame) -> DataFrame:
    from .summaries import amount_summary

    return (
        amount_summary(df, [YEAR])
        .select(
            YEAR,
            F.col("avg_amount").alias("mean_loan_size"),
            F.col("median_amount").alias("median_loan_size"),
            F.col("total_amount").alias("total_volume"),
        )
        .orderBy(YEAR)
    )


def market_share(df: DataFrame) -> DataFrame:
    """Share of each lender in the loans of a year, largest first within the year.

    Totals are counted apart and joined, so the lenders of a year never meet in one task.
    """
    loans = df.groupBy(YEAR, ORIG).agg(F.count("*").alias("loans"))
    totals = df.groupBy(F.col(YEAR).alias("_year")).agg(F.count("*").alias("_total"))
    shares = loans.join(totals, F.col(YEAR).eqNullSafe(F.col("_year"))).withColumn("share", ratio("loans", "_total"))
    return shares.drop("_year", "_total").orderBy(F.asc(YEAR), F.desc("loans"), F.asc_nulls_first(ORIG))


def yearly_hhi(df: DataFrame) -> DataFrame:
    """Sum of squared lender-name shares per year, on the 0-1 scale."""
    n = F.col("loans").cast("double")
    return (
        df.groupBy(YEAR, ORIG)
        .agg(F.count("*").alias("loans"))
        .groupBy(YEAR)
        .agg(ratio(F.sum(n * n), F.pow(F.sum(n), F.lit(2.0))).alias("HHI"))
        .orderBy(YEAR)
    )


def state_statistics(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(STATE)
        .agg(
            F.count("*").alias("loan_count"),
            F.avg(AMOUNT).alias("avg_loan_size"),
            F.avg(RATE).alias("avg_rate"),
            n_unique(ORIG).alias("unique_lenders"),
        )
        .orderBy(F.desc("loan_count"), F.asc_nulls_first(STATE))
    )


def monthly_statistics(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(YEAR, MONTH)
        .agg(
            F.count("*").alias("loan_count"),
            F.avg(AMOUNT).alias("avg_amount"),
            F.avg(RATE).alias("avg_rate"),
        )
        .orderBy(YEAR, MONTH)
    )


def state_loans_in_year(df: DataFrame, year: int) -> DataFrame:
    """Loans per state in one year; on the stored table only that year is read."""
    return (
        df.filter(F.col(YEAR) == year)
        .groupBy(STATE)
        .agg(F.count("*").alias("loan_count"))
        .orderBy(F.asc_nulls_first(STATE))
    )


def lenders_in_state(df: DataFrame, state: str, since_year: int) -> DataFrame:
    """Loans per lender in one state from ``since_year`` on."""
    return (
        df.filter((F.col(YEAR) >= since_year) & (F.col(STATE) == state))
        .groupBy(ORIG)
        .agg(F.count("*").alias("loan_count"))
        .orderBy(F.desc("loan_count"), F.asc_nulls_first(ORIG))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_first(column))
    )
