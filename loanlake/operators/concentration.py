"""Market concentration (Herfindahl-Hirschman index)."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_as_null, quarter, ratio, trimmed
from ..schemas import COUNTY, MONTH, ORIG_NO, SPONSOR_NO, STATE, YEAR
from ..sources.checkpoints import cut_lineage

# Group columns of each level.
TIME_LEVELS = {"month": ("year", "month"), "quarter": ("year", "quarter"), "year": ("year",), "all": ()}
GEOGRAPHY_LEVELS = {"state": ("state",), "county": ("state", "county"), "all": ()}
LENDER_TYPES = ("sponsor", "originator")


def lender_id(df: DataFrame, lender_type: str) -> Column:
    """The sponsor's ID where present, else the originator's; text is trimmed.

    Numbers are left as numbers, which group faster than their text.
    """
    types = dict(df.dtypes)

    def clean(column: str) -> Column:
        return trimmed(column) if types[column] == "string" else F.col(column)

    if lender_type == "originator":
        return clean(ORIG_NO)
    sponsor, originator = clean(SPONSOR_NO), clean(ORIG_NO)
    if types[SPONSOR_NO] == "string":
        return F.when(sponsor != "", sponsor).otherwise(originator.cast("string"))
    if types[ORIG_NO] == "string":
        sponsor = sponsor.cast("string")
    return F.coalesce(sponsor, originator)


def _dimensions() -> dict[str, Column]:
    return {
        "year": F.col(YEAR),
        "quarter": quarter(),
        "month": F.col(MONTH),
        "state": trimmed(STATE),
        "county": trimmed(COUNTY),
    }


def _check(value: str, allowed, name: str) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {sorted(allowed)}, got {value!r}")


def not_missing(df: DataFrame, columns) -> Column:
    """All ``columns`` are set; text must also be non-blank."""
    types = dict(df.dtypes)
    tests = [
        F.col(c).isNotNull() & (F.col(c) != "") if types[c] == "string" else F.col(c).isNotNull()
        for c in columns
    ]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _concentration() -> list[Column]:
    """Aggregates over one row per lender (column ``n``).

    The index is sum(n^2) / sum(n)^2: sums only, so even the single all-loans cell
    combines map-side and needs no window.
    """
    n = F.col("n").cast("double")
    index = ratio(F.sum(n * n), F.pow(F.sum(n), F.lit(2.0)))
    return [
        index.alias("hhi_normalized"),
        F.sum("n").alias("total_loans"),
        F.count("*").alias("num_lenders"),
        (index * 10_000).alias("hhi"),
    ]


def lender_hhi(
    df: DataFrame,
    time_level: str = "year",
    geography_level: str = "state",
    lender_type: str = "sponsor",
    drop_missing: bool = True,
) -> DataFrame:
    """Concentration of loans over lenders for every time and geography cell."""
    _check(time_level, TIME_LEVELS, "time_level")
    _check(geography_level, GEOGRAPHY_LEVELS, "geography_level")
    _check(lender_type, LENDER_TYPES, "lender_type")
    cell = [*TIME_LEVELS[time_level], *GEOGRAPHY_LEVELS[geography_level]]
    dims = _dimensions()
    loans = df.select(*[dims[c].alias(c) for c in cell], lender_id(df, lender_type).alias("lender_id"))
    if drop_missing:
        loans = loans.filter(not_missing(loans, [*cell, "lender_id"]))
    lenders = loans.groupBy(*cell, "lender_id").agg(F.count("*").alias("n"))
    cells = lenders.groupBy(*cell).agg(*_concentration())
    cells = cells.withColumn("lender_type", F.lit(lender_type))
    if not cell:  # an empty table has no cell, not one empty cell
        return cells.filter(F.col("total_loans").isNotNull())
    return cells.orderBy(*[F.asc_nulls_first(c) for c in cell])


def month_counts(df: DataFrame, lender_types=LENDER_TYPES) -> DataFrame:
    """Loans per ``year, quarter, month, state, county, lender_type, lender_id``: what all cells are made of.

    Counts of different months share no row, so a stored table of them grows by the counts of new
    months and :func:`cells_of` need not read loans again.  Missing lenders are left out; blank
    text and null both mean missing.
    """
    for t in lender_types:
        _check(t, LENDER_TYPES, "lender_type")
    dims = _dimensions()
    lender = F.explode(
        F.array(*[F.struct(F.lit(t).alias("t"), lender_id(df, t).cast("string").alias("i")) for t in lender_types])
    )
    loans = df.select(
        *[dims[c].alias(c) for c in ("year", "quarter", "month")],
        *[blank_as_null(dims[c].cast("string")).alias(c) for c in ("state", "county")],
        lender.alias("lender"),
    )
    loans = loans.withColumns({"lender_type": F.col("lender.t"), "lender_id": blank_as_null(F.col("lender.i"))})
    keys = ["year", "quarter", "month", "state", "county", "lender_type", "lender_id"]
    return loans.filter(F.col("lender_id").isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"))


def cells_of(counts: DataFrame) -> DataFrame:
    """Every time x geography x lender-type cell of :func:`month_counts`, missing values dropped.

    One exchange of the counts by lender, their expansion to all cell shapes behind it, and one exchange
    by cell for the index; a cell with a third of the loans is a partial sum per task, and a lender
    with a third of them a row per month and county.
    """
    shapes = [(t, g) for t in TIME_LEVELS for g in GEOGRAPHY_LEVELS]
    names = list(_dimensions())

    def shape(time: str, place: str) -> Column:
        used = (*TIME_LEVELS[time], *GEOGRAPHY_LEVELS[place])
        kept = [F.col(c).alias(c) if c in used else F.lit(None).cast(dict(counts.dtypes)[c]).alias(c) for c in names]
        cell = F.struct(F.lit(time).alias("time_level"), F.lit(place).alias("geography_level"), *kept)
        return F.when(not_missing(counts, used), cell)

    # Dealt by lender, the counts of a lender's cells add up where they are; what is shuffled is not expanded.
    counts = counts.repartition("lender_type", "lender_id")
    spread = counts.select("lender_type", "lender_id", "n", F.explode(F.array(*[shape(*s) for s in shapes])).alias("cell"))
    cell = ["cell.time_level", "cell.geography_level", *(f"cell.{c}" for c in names)]
    lenders = spread.filter(F.col("cell").isNotNull()).select(*cell, "lender_type", "lender_id", "n")
    keys = ["time_level", "geography_level", *names, "lender_type"]
    lenders = lenders.groupBy(*keys, "lender_id").agg(F.sum("n").alias("n"))
    cells = lenders.groupBy(*keys).agg(*_concentration())
    return cells.select("time_level", "geography_level", "lender_type", *names, *_MEASURES)


def hhi_cells(df: DataFrame, lender_types=LENDER_TYPES) -> DataFrame:
    """Every time x geography x lender-type cell, missing values dropped.

    Loans are counted once per month, county and lender; the counts are stored, and all cells are
    made from them.
    """
    return cells_of(cut_lineage(month_counts(df, lender_types)))


_MEASURES = ("hhi_normalized", "total_loans", "num_lenders", "hhi")
