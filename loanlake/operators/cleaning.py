"""Cleaning of raw monthly sheets and the shared export steps.

Raw rows of many months can be cleaned together: header variants of one column are
merged into it, so a frame may hold several of them.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_date, trimmed
from ..schemas import (
    CATEGORY_DOMAINS,
    COUNTY,
    DATE,
    DOWN,
    HECM,
    HECM_HEADERS,
    HECM_KIND,
    MONTH,
    ORIG,
    PURPOSE,
    SINGLE_FAMILY,
    SINGLE_FAMILY_HEADERS,
    SINGLE_FAMILY_KIND,
    SPONSOR,
    YEAR,
)

# Fixed values of the cleaning rules.
HEADER_PURPOSE = "Loan_Purpose"
SHIFTED_PURPOSES = ("Fixed Rate", "Adjustable Rate", "Rehabilitation", "Single Family")
HECM_MISSING = ("Not Available", "nan", "None")
MISSING_NAMES = ("nan", "None")
BAD_SPONSOR_MONTH = "2014-08-01"

BLOCK = "_block"  # of rows that are dealt by month already

# Columns the raw reader adds: where a row stood and which file it came from.
PLACE_COLUMNS = (
    "sheet_name", "sheet_ord", "row_ord", "snapshot_kind", "snapshot_year", "snapshot_month",
)


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Trim headers and turn underscores into spaces; columns of the reader keep their name."""
    return df.toDF(*[c if c in PLACE_COLUMNS else c.strip().replace("_", " ") for c in df.columns])


def unify_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Apply header variants and drop ``unnamed`` columns.

    Variants that end up with the same name become one column: the first value
    that is not null, in column order.
    """
    ids = [f"_c{i}" for i in range(len(df.columns))]
    sources: dict[str, list[Column]] = {}
    for name, tag in zip(df.columns, ids):
        target = renames.get(name, name)
        if "unnamed" not in target.lower():
            sources.setdefault(target, []).append(F.col(tag))

    def merged(columns: list[Column]) -> Column:
        if len(columns) == 1:
            return columns[0]
        return F.coalesce(*[c.cast("string") for c in columns])

    return df.toDF(*ids).select(*[merged(cols).alias(name) for name, cols in sources.items()])


def typed(name: str, dtype: T.DataType) -> Column:
    """Column in ``dtype``; values that do not fit become null.

    Numbers go through double, as text such as ``12345.0`` is common; ``nan`` is missing.
    """
    if isinstance(dtype, T.StringType):
        return quoted(name).cast("string")
    number = quoted(name).try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if isinstance(dtype, T.DoubleType) else number.try_cast(dtype)


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns that ``schema`` names and keep the others as they are."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[typed(c, types[c]).alias(c) if c in types else quoted(c) for c in df.columns])


def rejected_values(df: DataFrame, kind: str = SINGLE_FAMILY_KIND) -> DataFrame:
    """``column, rejected``: filled-in values that the cast turns to null, in one pass."""
    if kind == SINGLE_FAMILY_KIND:
        df, schema = unify_columns(normalize_headers(df), SINGLE_FAMILY_HEADERS), SINGLE_FAMILY
    else:
        df, schema = unify_columns(df, HECM_HEADERS), HECM
    numeric = [
        f for f in schema.fields if f.name in df.columns and not isinstance(f.dataType, T.StringType)
    ]
    lost = [
        F.count(F.when((trimmed(quoted(f.name)) != "") & typed(f.name, f.dataType).isNull(), 1)).alias(f.name)
        for f in numeric
    ]
    return df.agg(*lost).unpivot([], [quoted(f.name) for f in numeric], "column", "rejected")


def _first_two_hyphens(c: Column) -> Column:
    """``-`` to ``_`` for the first hyphen, twice over."""
    once = F.regexp_replace(c, "^([^-]*)-", "$1_")
    return F.regexp_replace(once, "^([^-]*)-", "$1_")


def clean_purpose(c: Column) -> Column:
    return _first_two_hyphens(F.when(c.isin(*SHIFTED_PURPOSES), "Purchase").otherwise(c))


def clean_down_payment(c: Column) -> Column:
    return F.when(c == "NonProfit", "Non Profit").when((trimmed(c) != "") & (c != "nan"), c)


def clean_single_family(df: DataFrame) -> DataFrame:
    """Raw single family rows to the declared columns and types."""
    df = unify_columns(normalize_headers(df), SINGLE_FAMILY_HEADERS)
    if PURPOSE in df.columns:
        # Repeated header rows go, and so do rows without a purpose.
        df = df.filter(F.col(PURPOSE) != HEADER_PURPOSE)
    rules = {
        PURPOSE: lambda c: clean_purpose(c),
        DOWN: lambda c: clean_down_payment(c),
        COUNTY: lambda c: F.nullif(c, F.lit("#NULL!")),
        SPONSOR: lambda c: F.nullif(c, F.lit("Not Available")),
    }
    present = {c: rule(F.col(c).cast("string")) for c, rule in rules.items() if c in df.columns}
    return to_schema(df.withColumns(present) if present else df, SINGLE_FAMILY)


def clean_hecm(df: DataFrame) -> DataFrame:
    """Raw HECM rows to the declared columns and types."""
    df = unify_columns(df, HECM_HEADERS)
    df = df.select(
        *[
            F.when(~quoted(c).isin(*HECM_MISSING), quoted(c)).alias(c) if t == "string" else quoted(c)
            for c, t in df.dtypes
        ]
    )
    return to_schema(df, HECM)


def clean(df: DataFrame, kind: str) -> DataFrame:
    return clean_hecm(df) if kind == HECM_KIND else clean_single_family(df)


# --- export ------------------------------------------------------------------------


def blank_missing_names(df: DataFrame) -> DataFrame:
    """Institution names that are missing become empty text."""
    return df.withColumns(
        {
            c: F.when(F.col(c).isNull() | F.col(c).isin(*MISSING_NAMES), "").otherwise(F.col(c))
            for c in (ORIG, SPONSOR)
        }
    )


def blank_bad_sponsor_month(df: DataFrame) -> DataFrame:
    """One month's sponsor names are known to be wrong and are emptied."""
    bad = F.col(DATE) == F.lit(BAD_SPONSOR_MONTH).cast("date")
    return df.withColumn(SPONSOR, F.when(bad, "").otherwise(F.col(SPONSOR)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def prepare_export(
    df: DataFrame,
    kind: str = SINGLE_FAMILY_KIND,
    *,
    county_reference: DataFrame | None = None,
    add_date: bool = True,
    blank_as_null: bool = False,
) -> DataFrame:
    """Bronze rows to silver rows, see :func:`export_rows`; whole-row duplicates go."""
    rows = export_rows(
        df, kind, county_reference=county_reference, add_date=add_date, blank_as_null=blank_as_null
    )
    return rows.dropDuplicates()


def export_rows(
    df: DataFrame,
    kind: str = SINGLE_FAMILY_KIND,
    *,
    county_reference: DataFrame | None = None,
    add_date: bool = True,
    blank_as_null: bool = False,
) -> DataFrame:
    """Bronze rows to silver rows that may hold duplicates.

    County codes are added when a reference is given.  Rows without year or month go.
    Missing names are empty text by default; ``blank_as_null`` leaves them null, so that
    they do not look like a name.
    """
    from .counties import add_county_fips

    df = blank_missing_names(df)
    if county_reference is not None:
        df = add_county_fips(df, county_reference)
    if add_date:
        df = df.withColumn(DATE, month_date())
        if kind == SINGLE_FAMILY_KIND:
            df = blank_bad_sponsor_month(df)
    if blank_as_null:
        df = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in (ORIG, SPONSOR)})
    return df.dropna(subset=[YEAR, MONTH])


def one_of_each(df: DataFrame, dealt_by: Sequence[str], blocks: Column) -> DataFrame:
    """Whole-row duplicates go; the others stay dealt by some columns and ``BLOCK``.

    ``blocks`` is the number of blocks that rows with equal ``dealt_by`` fall into.  Rows
    are dealt once, before they are compared: hardly any are equal, so a table of those a
    task has read would only grow with its input.
    """
    # Equal rows have equal numbers; fractions are left out, as equal ones may have several forms.
    whole = [quoted(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.FractionalType)]
    return df.withColumn(BLOCK, F.pmod(F.xxhash64(*whole), blocks)).repartition(*dealt_by, BLOCK).dropDuplicates()


def domain_violations(df: DataFrame, domains: dict[str, tuple] = CATEGORY_DOMAINS) -> DataFrame:
    """``column, value, rows``: values outside the declared categories."""
    names = [c for c in domains if c in df.columns]
    combos = df.groupBy(*names).agg(F.count("*").alias("n"))
    allowed = reduce(
        lambda a, b: a | b,
        [(F.col("column") == c) & F.col("value").isin(*domains[c]) for c in names],
    )
    return (
        combos.unpivot(["n"], names, "column", "value")
        .filter(F.col("value").isNotNull() & ~allowed)
        .groupBy("column", "value")
        .agg(F.sum("n").alias("rows"))
        .orderBy("column", "value")
    )

