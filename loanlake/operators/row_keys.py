"""Running row numbers and the row keys built from them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import zfill

BLOCK_ROWS = 1_000_000


def running_numbers(
    df: DataFrame, group: list[str], block: Column, order: list, out: str = "row_num"
) -> DataFrame:
    """1-based row number within ``group``, as one sort over the whole group would give.

    ``block`` must grow with ``order``.  Rows are sorted per (group, block) and the
    rows of earlier blocks are added as an offset, so a group of any size is spread
    over as many tasks as it has blocks.
    """
    # A struct compares its null fields as equal, so rows with a null group are kept.
    slot = F.struct(F.struct(*group).alias("group"), block.alias("block"))
    blocked = df.withColumn("_slot", slot)
    before = (
        Window.partitionBy("_slot.group")
        .orderBy("_slot.block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        blocked.groupBy("_slot")
        .agg(F.count("*").alias("_rows"))
        .select("_slot", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_slot").orderBy(*order))
    return (
        blocked.withColumn("_within", within)
        .join(offsets, "_slot", "left")  # every slot is there, and the join goes where no number is asked for
        .withColumn(out, F.col("_offset") + F.col("_within"))
        .drop("_slot", "_within", "_offset")
    )


def row_key(kind: Column, year: Column, month: Column, number: Column) -> Column:
    """``YYYYMM01_0000001``, with a leading ``H`` for HECM rows."""
    prefix = F.when(kind == "hecm", "H").otherwise("")
    return F.concat(
        prefix, zfill(year, 4), zfill(month, 2), F.lit("01_"), zfill(number, 7)
    )


def with_row_keys(
    df: DataFrame,
    *,
    kind_col: str = "snapshot_kind",
    year_col: str = "snapshot_year",
    month_col: str = "snapshot_month",
    sheet_col: str = "sheet_ord",
    row_col: str = "row_ord",
    out: str = "FHA_Index",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the rows of each monthly file over all its sheets and build their keys."""
    block = F.struct(F.col(sheet_col), F.floor(F.col(row_col) / block_rows))
    numbered = running_numbers(df, [kind_col, year_col, month_col], block, [sheet_col, row_col])
    key = row_key(F.col(kind_col), F.col(year_col), F.col(month_col), F.col("row_num"))
    return numbered.withColumn(out, key).drop("row_num")
