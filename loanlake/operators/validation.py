"""Data quality checks.

Every check returns one row ``check_name, status, is_warning, details``; ``details``
maps names to text.  Checks that only count rows share one pass over the table.
"""

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import count_where, n_unique, period, ratio
from ..schemas import AMOUNT, INDEX, MONTH, ORIG, ORIG_NO, REQUIRED_COLUMNS, SPONSOR, SPONSOR_NO, YEAR
from ..sources.checkpoints import cut_lineage
from .identity import (
    ORIGINATOR,
    PARTY_COLUMNS,
    _space_counts,
    _space_members,
    oscillations,
    overlap,
    party_months,
    smallest,
    stored_party_months,
)

RESULT_COLUMNS = ("check_name", "status", "is_warning", "details")
LARGE_AMOUNT = 10_000_000


def _percent(part, whole) -> Column:
    value = F.try_divide(F.col(part).cast("double") * 100, F.col(whole).cast("double"))
    return F.round(value, 2)


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(38,2)")


def _result(name: str, passed: Column, details: dict[str, Column], warning: bool = False) -> Column:
    pairs = [x for k, v in details.items() for x in (F.lit(k), F.coalesce(v.cast("string"), F.lit("")))]
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(passed, "PASS").otherwise("WARNING" if warning else "FAIL").alias("status"),
        F.lit(warning).alias("is_warning"),
        F.create_map(*pairs).alias("details"),
    )


def _row(df: DataFrame, result: Column) -> DataFrame:
    return df.select(result.alias("r")).select("r.*")


def _sample(df: DataFrame, text: Column, k: int, *order) -> Column:
    """Scalar subquery: the first ``k`` rows as one text."""
    first = df.select(text.alias("t"), F.struct(*order).alias("o")).orderBy("o").limit(k)
    items = F.transform(F.array_sort(F.collect_list(F.struct("o", "t"))), lambda x: x["t"])
    return first.agg(F.concat(F.lit("["), F.array_join(items, "; "), F.lit("]"))).scalar()


# --- checks over the column list and single counts ------------------------------------


def check_required_columns(df: DataFrame) -> DataFrame:
    """Needs no job: only the schema is looked at."""
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    details = {
        "missing_columns": F.lit(", ".join(missing)),
        "total_columns": F.lit(len(df.columns)),
    }
    one = df.sparkSession.range(1)
    return _row(one, _result("Required Columns Present", F.lit(not missing), details))


def check_fha_index_uniqueness(df: DataFrame) -> DataFrame:
    return _uniqueness(df.agg(F.count("*").alias("n"), n_unique(INDEX).alias("u")))


def _uniqueness(counts: DataFrame) -> DataFrame:
    details = {"total_rows": F.col("n"), "unique_indexes": F.col("u"), "duplicates": F.col("n") - F.col("u")}
    return _row(counts, _result("FHA_Index Uniqueness", F.col("n") == F.col("u"), details))


def _amount_ranges() -> list[Column]:
    amount = F.col(AMOUNT)
    return [
        F.min(amount).alias("low"),
        F.max(amount).alias("high"),
        F.sum(amount).alias("volume"),
        F.count(amount).alias("with_amount"),
        count_where(amount <= 0).alias("non_positive"),
        count_where(amount > LARGE_AMOUNT).alias("extreme"),
    ]


def check_base(df: DataFrame) -> DataFrame:
    """Party counts with their amount ranges.

    Small next to the loans, and enough for every check but key uniqueness.
    """
    return df.groupBy(*PARTY_COLUMNS).agg(F.count("*").alias("loans"), *_amount_ranges())


def _profile(df: DataFrame) -> DataFrame:
    """All simple counts as one row, from loans or from a :func:`check_base`."""
    missing = {
        "no_id": F.col(ORIG_NO).isNull(),
        "no_name": F.col(ORIG).isNull(),
        "orphaned": F.col(ORIG_NO).isNull() & F.col(SPONSOR_NO).isNotNull(),
        "sponsored": F.col(SPONSOR).isNotNull(),
    }
    flags = [c.alias(n) for n, c in missing.items()]
    if "with_amount" in df.columns:
        rows = df.select("*", *flags)
    else:
        rows = df.groupBy(YEAR, MONTH, *flags).agg(F.count("*").alias("loans"), *_amount_ranges())

    def loans_with(flag: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(flag), F.col("loans"))), F.lit(0)).alias(flag)

    return rows.agg(
        F.coalesce(F.sum("loans"), F.lit(0)).alias("n"),
        *[loans_with(flag) for flag in missing],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("non_positive", "extreme")],
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        ratio(F.sum("volume"), F.sum("with_amount")).alias("mean"),
        F.min(YEAR).alias("first_year"),
        F.max(YEAR).alias("last_year"),
        n_unique(period()).alias("periods"),
    )


def _missing(name: str, column: str, threshold_pct: float) -> Column:
    percent = F.try_divide(F.col(column).cast("double") * 100, F.col("n").cast("double"))
    details = {
        "missing_count": F.col(column),
        "total_count": F.col("n"),
        "percent_missing": _percent(column, "n"),
        "threshold_percent": F.lit(float(threshold_pct)),
    }
    return _result(name, percent < threshold_pct, details, warning=True)


def _profile_results(threshold_pct: float) -> dict[str, Column]:
    span = (F.col("last_year") - F.col("first_year") + 1).cast("int")
    return {
        "check_missing_originator_ids": _missing(
            "Missing Originator IDs Below Threshold", "no_id", threshold_pct
        ),
        "check_missing_originator_names": _missing(
            "Missing Originator Names Below Threshold", "no_name", threshold_pct
        ),
        "check_orphaned_sponsors": _result(
            "No Orphaned Sponsors",
            F.col("orphaned") == 0,
            {"orphaned_count": F.col("orphaned"), "percent_of_total": _percent("orphaned", "n")},
            warning=True,
        ),
        "check_sponsor_coverage": _result(
            "Sponsor Coverage (Informational)",
            F.lit(True),
            {
                "loans_with_sponsor": F.col("sponsored"),
                "total_loans": F.col("n"),
                "percent_with_sponsor": _percent("sponsored", "n"),
            },
        ),
        "check_date_coverage": _result(
            "Date Coverage (Informational)",
            F.lit(True),
            {
                "min_year": F.col("first_year"),
                "max_year": F.col("last_year"),
                "year_span": span,
                "unique_year_month_periods": F.col("periods"),
                "expected_periods_if_complete": span * 12,
            },
        ),
        "check_mortgage_amounts": _result(
            "Reasonable Mortgage Amounts",
            (F.col("non_positive") == 0) & (F.col("extreme") == 0),
            {
                "min_amount": _money("low"),
                "max_amount": _money("high"),
                "mean_amount": _money("mean"),
                "non_positive_count": F.col("non_positive"),
                "extremely_high_count": F.col("extreme"),
                "total": F.col("n"),
            },
            warning=True,
        ),
    }


def profile_checks(df: DataFrame, names: Iterable[str] | None = None, threshold_pct: float = 5.0) -> DataFrame:
    """Any number of the counting checks from a single scan."""
    results = _profile_results(threshold_pct)
    chosen = [results[n] for n in (results if names is None else names)]
    return _profile(df).select(F.explode(F.array(*chosen)).alias("r")).select("r.*")


def _profile_check(name: str) -> Callable[..., DataFrame]:
    def check(df: DataFrame, threshold_pct: float = 5.0) -> DataFrame:
        return profile_checks(df, [name], threshold_pct)

    check.__name__ = name
    return check


check_missing_originator_ids = _profile_check("check_missing_originator_ids")
check_missing_originator_names = _profile_check("check_missing_originator_names")
check_orphaned_sponsors = _profile_check("check_orphaned_sponsors")
check_sponsor_coverage = _profile_check("check_sponsor_coverage")
check_date_coverage = _profile_check("check_date_coverage")
check_mortgage_amounts = _profile_check("check_mortgage_amounts")


# --- identity checks ---------------------------------------------------------------------


def check_id_name_consistency_monthly(df: DataFrame) -> DataFrame:
    """One name per originator number and month."""
    # A missing name next to a real one is a second name.
    several = (
        stored_party_months(df)
        .filter(F.col(ORIG_NO).isNotNull())
        .select(F.col(ORIG_NO).alias("id"), YEAR, MONTH, F.col(ORIG).alias("name"))
        .distinct()
        .groupBy("id", YEAR, MONTH)
        .agg(F.count("*").alias("names"), F.array_sort(F.collect_set("name")).alias("list"))
        .filter("names > 1")
    )
    text = F.concat(
        F.concat_ws("-", F.col(YEAR).cast("string"), F.lpad(F.col(MONTH).cast("string"), 2, "0")),
        F.lit(" "),
        F.col("id").cast("string"),
        F.lit(": "),
        F.array_join("list", ", "),
    )
    details = {"inconsistent_periods": F.col("n"), "sample": _sample(several, text, 3, YEAR, MONTH, "id")}
    return _row(
        several.agg(F.count("*").alias("n")),
        _result("ID-Name Consistency Within Months", F.col("n") == 0, details),
    )


def check_overlapping_id_spaces(df: DataFrame) -> DataFrame:
    """No number is used by both originators and sponsors."""
    members = cut_lineage(_space_members(df))
    details = {
        "unique_originator_ids": F.col("unique_originator_ids"),
        "unique_sponsor_ids": F.col("unique_sponsor_ids"),
        "overlapping_ids": F.col("overlapping_ids"),
        "sample_overlapping_ids": F.array_join(
            smallest(overlap(members, "id"), "number", 10).cast("array<string>"), ", "
        ),
    }
    return _row(
        _space_counts(members),
        _result("Non-overlapping ID Spaces", F.col("overlapping_ids") == 0, details, warning=True),
    )


def check_name_oscillations(df: DataFrame, min_changes: int = 3) -> DataFrame:
    """No originator name leaves and comes back."""
    found = oscillations(stored_party_months(df), ORIGINATOR, min_changes)
    text = F.concat(
        F.col("id").cast("string"),
        F.lit(": "),
        F.col("oscillating_name"),
        F.lit(" / "),
        F.array_join("intermediate_names", ", "),
    )
    details = {
        "oscillating_ids_count": F.col("n"),
        "min_changes_threshold": F.lit(min_changes),
        "sample": _sample(found, text, 5, "id"),
    }
    return _row(
        found.agg(F.count("*").alias("n")),
        _result("Name Stability (No Oscillations)", F.col("n") == 0, details, warning=True),
    )


def originators_with_several_ids(df: DataFrame) -> DataFrame:
    """Originator names with more than one number (a missing number counts)."""
    return (
        party_months(df)
        .groupBy(ORIG, ORIG_NO, SPONSOR)
        .agg(F.sum("loans").alias("loans"))
        .groupBy(ORIG)
        .agg(
            n_unique(ORIG_NO).alias("unique_ids"),
            n_unique(SPONSOR).alias("unique_sponsors"),
            F.sum("loans").alias("loan_count"),
        )
        .filter("unique_ids > 1")
    )


def check_originator_sponsor_relationships(df: DataFrame) -> DataFrame:
    """Every originator name has one number."""
    found = originators_with_several_ids(stored_party_months(df))
    text = F.concat(
        F.coalesce(F.col(ORIG), F.lit("")),
        F.lit(": "),
        F.concat_ws(" ids, ", F.col("unique_ids").cast("string"), F.col("unique_sponsors").cast("string")),
        F.lit(" sponsors, "),
        F.col("loan_count").cast("string"),
        F.lit(" loans"),
    )
    largest = (-F.col("loan_count")).alias("largest")
    details = {
        "originators_with_multiple_ids": F.col("n"),
        "sample": _sample(found, text, 5, largest, ORIG),
    }
    return _row(
        found.agg(F.count("*").alias("n")),
        _result("Consistent Originator-ID Mappings", F.col("n") == 0, details, warning=True),
    )


CHECKS: dict[str, Callable[..., DataFrame]] = {
    "check_required_columns": check_required_columns,
    "check_fha_index_uniqueness": check_fha_index_uniqueness,
    "check_missing_originator_ids": check_missing_originator_ids,
    "check_missing_originator_names": check_missing_originator_names,
    "check_orphaned_sponsors": check_orphaned_sponsors,
    "check_sponsor_coverage": check_sponsor_coverage,
    "check_id_name_consistency_monthly": check_id_name_consistency_monthly,
    "check_overlapping_id_spaces": check_overlapping_id_spaces,
    "check_name_oscillations": check_name_oscillations,
    "check_originator_sponsor_relationships": check_originator_sponsor_relationships,
    "check_date_coverage": check_date_coverage,
    "check_mortgage_amounts": check_mortgage_amounts,
}
# Checks answered from the party counts.
_PARTIES = (
    "check_id_name_consistency_monthly",
    "check_overlapping_id_spaces",
    "check_name_oscillations",
    "check_originator_sponsor_relationships",
)
UNIQUENESS = "check_fha_index_uniqueness"
CRITICAL = ("check_required_columns", "check_fha_index_uniqueness", "check_id_name_consistency_monthly")
_COUNTING = (
    "check_missing_originator_ids",
    "check_missing_originator_names",
    "check_orphaned_sponsors",
    "check_sponsor_coverage",
    "check_date_coverage",
    "check_mortgage_amounts",
)


def run_checks(
    df: DataFrame,
    names: Iterable[str] | None = None,
    *,
    threshold_pct: float = 5.0,
    extra: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    base: DataFrame | None = None,
    key_counts: DataFrame | None = None,
) -> DataFrame:
    """Results of the named checks (all by default) as one table.

    Loans are scanned twice for all twelve checks: for key uniqueness, and for the
    stored :func:`check_base` that answers the others.  ``extra`` adds checks of the
    caller: any function from the table to one result row.  Who has the base or the
    counts of rows and keys (``n, u``) already gives them; loans are then not scanned
    for them.
    """
    checks = {**CHECKS, **(extra or {})}
    names = list(checks) if names is None else list(names)
    unknown = sorted(set(names) - set(checks))
    if unknown:
        raise ValueError(f"Unknown checks: {unknown}")
    counting = [n for n in names if n in _COUNTING]
    by_party = [n for n in names if n in _PARTIES]
    if base is not None:
        pass
    elif counting and by_party:
        base = cut_lineage(check_base(df))
    else:
        base = stored_party_months(df) if by_party else df
    if key_counts is not None:
        checks[UNIQUENESS] = lambda _: _uniqueness(key_counts)
    parts = [checks[n](base if n in _PARTIES else df) for n in names if n not in _COUNTING]
    if counting:
        parts.append(profile_checks(base, counting, threshold_pct))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_critical(df: DataFrame) -> DataFrame:
    return run_checks(df, CRITICAL)


def verdict(results: DataFrame) -> DataFrame:
    """One row: passed if no critical check failed, with tallies."""
    critical = ~F.col("is_warning")
    passed = F.col("status") == "PASS"
    return results.agg(
        count_where(critical & passed).alias("critical_passed"),
        count_where(critical & ~passed).alias("critical_failed"),
        count_where(~critical & ~passed).alias("warnings"),
    ).withColumn("passed", F.col("critical_failed") == 0)


def results_as_columns(results: DataFrame) -> DataFrame:
    """One row per check with a column per detail name, for export."""
    # At most one name list per check, so the names are few.
    names = sorted(r[0] for r in results.select(F.explode(F.map_keys("details"))).distinct().collect())
    return results.select(
        "check_name", "status", "is_warning", *[F.col("details")[n].alias(n) for n in names]
    )
