"""County, metro and state tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import code5
from ..schemas import AMOUNT, COUNTY, FIPS, RATE, STATE, YEAR, require_columns
from ..sources.sinks import write_result
from .activity import normalize_frequency, with_period_keys
from .summaries import mortgage_summary


def county_metrics(
    df: DataFrame,
    frequency: str = "annual",
    *,
    fips_col: str = FIPS,
    state_col: str = STATE,
    county_col: str = COUNTY,
    output_path: str | None = None,
) -> DataFrame:
    """Loan counts, amounts and rate spread per period and county."""
    freq = normalize_frequency(frequency)
    require_columns(df, {fips_col, state_col, county_col, AMOUNT, RATE}, "county metrics")
    df, keys = with_period_keys(df, freq)
    keys = [*keys, state_col, county_col, fips_col]
    table = (
        mortgage_summary(df, keys)
        .withColumn("frequency", F.lit(freq))
        .orderBy(*[F.asc_nulls_first(k) for k in keys])
    )
    return write_result(table, output_path, f"county_metrics_{freq}.parquet")


def metro_metrics(
    df: DataFrame,
    frequency: str = "annual",
    *,
    county_fips_col: str = FIPS,
    cbsa_col: str = "CBSA Code",
    cbsa_name_col: str | None = "CBSA Title",
    cbsa_crosswalk: DataFrame | None = None,
    output_path: str | None = None,
) -> DataFrame:
    """As :func:`county_metrics`, per metro area; loans outside any metro keep a null key.

    A county that the crosswalk puts into several areas counts in each of them.
    """
    freq = normalize_frequency(frequency)
    if cbsa_crosswalk is not None:
        columns = [county_fips_col, cbsa_col] + ([cbsa_name_col] if cbsa_name_col else [])
        crosswalk = cbsa_crosswalk.select(*columns).distinct()
        df = df.join(crosswalk, county_fips_col, "left")
    require_columns(df, {county_fips_col, cbsa_col, AMOUNT, RATE}, "metro metrics")
    df, keys = with_period_keys(df, freq)
    keys = [*keys, cbsa_col]
    if cbsa_name_col is not None and cbsa_name_col in df.columns:
        keys.append(cbsa_name_col)
    table = (
        mortgage_summary(df, keys)
        .withColumn("frequency", F.lit(freq))
        .orderBy(*[F.asc_nulls_first(k) for k in keys])
    )
    return write_result(table, output_path, f"metro_metrics_{freq}.parquet")


def state_loan_counts(df: DataFrame, *, state_col: str = STATE, by_year: bool = False) -> DataFrame:
    require_columns(df, {state_col}, "state loan counts")
    year = [YEAR] if by_year else []
    return (
        df.groupBy(*year, state_col)
        .agg(F.count("*").alias("n"))
        # Upper case after counting: mixed spellings of a state are few.
        .groupBy(*year, F.upper(F.col(state_col)).alias("state"))
        .agg(F.sum("n").alias("loan_count"))
        .orderBy(*year, F.asc_nulls_first("state"))
    )


def county_loan_counts(
    df: DataFrame,
    *,
    fips_col: str = FIPS,
    state_col: str = STATE,
    county_col: str = COUNTY,
    by_year: bool = False,
) -> DataFrame:
    """Loans per five-digit county code with one state and county label each."""
    require_columns(df, {fips_col, state_col, county_col}, "county loan counts")
    year = [YEAR] if by_year else []
    return (
        df.groupBy(*year, fips_col)
        .agg(F.count("*").alias("n"), F.min(state_col).alias("state"), F.min(county_col).alias("county"))
        .groupBy(*year, code5(fips_col).alias("fips"))
        .agg(
            F.sum("n").alias("loan_count"),
            F.min("state").alias("state"),
            F.min("county").alias("county"),
        )
        .orderBy(*year, F.asc_nulls_first("fips"))
    )
