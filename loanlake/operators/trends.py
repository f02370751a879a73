"""Monthly trend tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_date, ratio
from ..schemas import AMOUNT, DATE, DOWN, ORIG, PRODUCT, PROPERTY, PURPOSE, RATE
from ..sources.checkpoints import cut_lineage
from .summaries import amount_summary

CATEGORY_COLUMNS = (DOWN, PROPERTY, PRODUCT, PURPOSE)


def with_date(df: DataFrame) -> DataFrame:
    """Add the month's ``Date`` where the table does not carry it."""
    return df if DATE in df.columns else df.withColumn(DATE, month_date())


def tally(df: DataFrame, *keys) -> DataFrame:
    """Loan counts and the sums behind the means, per group.

    A tally can be tallied again by fewer keys, so a fine one serves many tables.
    """
    if "loans" not in df.columns:
        one = F.count("*")
        sums = {"rate_sum": F.sum(RATE), "rate_n": F.count(RATE), "amount_sum": F.sum(AMOUNT), "amount_n": F.count(AMOUNT)}
    else:
        one = F.sum("loans")
        sums = {c: F.sum(c) for c in ("rate_sum", "rate_n", "amount_sum", "amount_n")}
    present = {RATE: ("rate_sum", "rate_n"), AMOUNT: ("amount_sum", "amount_n")}
    # Without a rate or amount column there is nothing to sum.
    kept = [c for source, names in present.items() for c in names if source in df.columns or c in df.columns]
    return df.groupBy(*keys).agg(one.alias("loans"), *[sums[c].alias(c) for c in kept])


def _dated(df: DataFrame, *keys) -> DataFrame:
    return tally(with_date(df), DATE, *keys)


def _loans_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("loans"))), F.lit(0))


def _mean(measure: str, condition: Column | None = None) -> Column:
    total, n = F.col(f"{measure}_sum"), F.col(f"{measure}_n")
    if condition is not None:
        total, n = F.when(condition, total), F.when(condition, n)
    return ratio(F.sum(total), F.sum(n))


def _mentions(column: str, word: str) -> Column:
    return F.lower(F.coalesce(F.col(column), F.lit(""))).contains(word)


def refinance_share(df: DataFrame) -> DataFrame:
    return (
        _dated(df, PURPOSE)
        .groupBy(DATE)
        .agg(
            _loans_where(_mentions(PURPOSE, "purchase")).alias("purchase_loan_count"),
            _loans_where(_mentions(PURPOSE, "refi")).alias("refinance_loan_count"),
        )
        .withColumn(
            "refinance_share",
            ratio("refinance_loan_count", F.col("purchase_loan_count") + F.col("refinance_loan_count")),
        )
        .orderBy(DATE)
    )


def fixed_rate_share(df: DataFrame, *, averages: bool = False) -> DataFrame:
    """Fixed and adjustable counts; with ``averages`` also the mean rate of each."""
    fixed, adjustable = _mentions(PRODUCT, "fixed"), _mentions(PRODUCT, "adjustable")
    aggs = [
        _loans_where(fixed).alias("fixed_rate_count"),
        _loans_where(adjustable).alias("adjustable_rate_count"),
    ]
    if averages:
        aggs += [
            _mean("rate", fixed).alias("fixed_rate_average"),
            _mean("rate", adjustable).alias("adjustable_rate_average"),
        ]
    return (
        _dated(df, PRODUCT)
        .groupBy(DATE)
        .agg(*aggs)
        .withColumn(
            "adjustable_rate_share",
            ratio("adjustable_rate_count", F.col("adjustable_rate_count") + F.col("fixed_rate_count")),
        )
        .orderBy(DATE)
    )


def active_lenders(df: DataFrame) -> DataFrame:
    # One row per month and lender, null included, so rows count lenders.
    return _dated(df, ORIG).groupBy(DATE).agg(F.count("*").alias("Active Lenders")).orderBy(DATE)


def loan_size_trend(df: DataFrame) -> DataFrame:
    """Mean and median loan per month in long form."""
    return (
        amount_summary(with_date(df), [DATE])
        .select(DATE, F.col("avg_amount").alias("mean"), F.col("median_amount").alias("median"))
        .unpivot([DATE], ["mean", "median"], "Statistic", "Average Loan Amount")
        .orderBy(DATE, "Statistic")
    )


def purpose_trend(df: DataFrame) -> DataFrame:
    """Loans per month, purchase against everything else."""
    category = F.when(F.col(PURPOSE).contains("Purchase"), "Purchase").otherwise("Refinance")
    return (
        _dated(df, PURPOSE)
        .groupBy(DATE, category.alias("loan_category"))
        .agg(F.sum("loans").alias("loan_count"))
        .orderBy(DATE, "loan_category")
    )


def borrower_funded_share(df: DataFrame) -> DataFrame:
    """Share of loans with the borrower's own money; undated loans have none."""
    share = F.when(F.col(DATE).isNotNull(), ratio(_loans_where(F.col(DOWN) == "Borrower"), F.sum("loans")))
    return _dated(df, DOWN).groupBy(DATE).agg(share.alias("BorrowerFundedShare")).orderBy(DATE)


def _averages_by(df: DataFrame, column: str, bucket: Column | None = None) -> DataFrame:
    group = (F.col(column) if bucket is None else bucket).alias(column)
    return (
        _dated(df, column)
        .groupBy(DATE, group)
        .agg(_mean("rate").alias("AverageRate"), _mean("amount").alias("AverageSize"))
        .orderBy(DATE, F.asc_nulls_first(column))
    )


def averages_by_product(df: DataFrame) -> DataFrame:
    return _averages_by(df, PRODUCT)


def averages_by_property(df: DataFrame) -> DataFrame:
    """Property types folded to their own name if it says ``Single``, else one group."""
    bucket = F.when(~F.col(PROPERTY).contains("Single"), "Non single family").otherwise(F.col(PROPERTY))
    return _averages_by(df, PROPERTY, bucket)


def averages_by_purpose(df: DataFrame) -> DataFrame:
    return _averages_by(df, PURPOSE)


def top_lender_groups(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Mean rate and amount of each month's ``top_n`` lenders against the others.

    Loans are reduced to one row per month and lender before ranking, and the group
    means are rebuilt from those sums, so no loan row is joined back.  Loans without
    a lender name take part in the ranking but form a group of their own.
    """
    rank = F.row_number().over(
        Window.partitionBy(DATE).orderBy(F.desc("loans"), F.asc_nulls_first(ORIG))
    )
    group = F.when(
        F.col(ORIG).isNotNull(),
        F.when(rank <= top_n, F.lit(f"Top {top_n} Lenders")).otherwise("Other Lenders"),
    )
    return (
        _dated(df, ORIG)
        .withColumn("lender_group", group)
        .groupBy(DATE, "lender_group")
        .agg(_mean("rate").alias("avg_interest_rate"), _mean("amount").alias("avg_loan_size"))
        .orderBy(DATE, F.asc_nulls_first("lender_group"))
    )


def category_counts(df: DataFrame, columns=CATEGORY_COLUMNS) -> DataFrame:
    """Loans per month, variable and category; null categories are left out.

    The scan is reduced to one row per combination of categories first; only those
    few rows are turned to long form.
    """
    return (
        _dated(df, *columns)
        .unpivot([DATE, "loans"], list(columns), "variable", "category")
        .filter(F.col(DATE).isNotNull() & F.col("category").isNotNull())
        .groupBy(DATE, "variable", "category")
        .agg(F.sum("loans").alias("Count"))
        .orderBy(DATE, "variable", "category")
    )


def category_shares(df: DataFrame, columns=CATEGORY_COLUMNS) -> DataFrame:
    total = F.sum("Count").over(Window.partitionBy(DATE, "variable"))
    return (
        category_counts(df, columns)
        .withColumn("Proportion", ratio("Count", total))
        .drop("Count")
        .orderBy(DATE, "variable", "category")
    )


def trend_tables(df: DataFrame, top_n: int = 20) -> dict[str, DataFrame]:
    """Every trend table, keyed by name.

    Loans are read twice: for the tally behind all tables but one, which is stored,
    and for the medians.
    """
    base = cut_lineage(_dated(df, ORIG, *CATEGORY_COLUMNS))
    return {
        "active_lenders": active_lenders(base),
        "loan_size": loan_size_trend(df),
        "purchase_and_refinance": purpose_trend(base),
        "down_payment_source": borrower_funded_share(base),
        "by_product_type": averages_by_product(base),
        "by_property_type": averages_by_property(base),
        "by_loan_purpose": averages_by_purpose(base),
        "top_lender_groups": top_lender_groups(base, top_n),
        "category_counts": category_counts(base),
        "category_shares": category_shares(base),
    }
