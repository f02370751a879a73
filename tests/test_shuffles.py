"""Rows stay where they were read, and months that are not asked for are left out before rows are dealt."""

import datetime

from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from loanlake.operators.row_keys import running_numbers
from loanlake.schemas import INDEX, MONTH, YEAR
from loanlake.sources import snapshots
from loanlake.sources.star_loans import loans


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_periods_of_files_do_not_deal_rows_by_file(spark, tmp_path):
    for month in (1, 2):
        spark.createDataFrame([(month, k) for k in range(3)], "m int, k int").write.parquet(f"{tmp_path}/snapshot_year=2020/snapshot_month={month}")
    read = spark.read.parquet(*(f"{tmp_path}/snapshot_year=2020/snapshot_month={m}" for m in (1, 2)))
    placed = snapshots.with_period(read, "single_family")
    assert "SortMergeJoin" not in plan_of(placed) and "hashpartitioning" not in plan_of(placed)
    assert sorted(rows_of(placed.select("m", "k", "_p.month"))) == [(m, k, m) for m in (1, 2) for k in range(3)]


def test_numbers_that_are_not_read_need_no_shuffle(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (None, 3, "c")], "g int, k int, v string")
    numbered = running_numbers(rows, ["g"], F.floor(F.col("k") / 2), ["k"])
    assert "hashpartitioning" not in plan_of(numbered.select("g", "v"))
    assert sorted(rows_of(numbered.select("v", "row_num"))) == [("a", 2), ("b", 1), ("c", 1)]


def test_months_are_left_out_before_loans_are_numbered(spark, tmp_path):
    rows = [(k, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", datetime.datetime(1994 + k % 3, 5, 1)) for k in (*range(9), 3, 70000)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    names += ", l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    early = F.col(YEAR) < 1996
    got = loans(spark, str(tmp_path), INDEX, YEAR, MONTH, months=early)
    assert sorted(rows_of(got)) == sorted(rows_of(loans(spark, str(tmp_path), INDEX, YEAR, MONTH).filter(early)))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("1996")


def test_orders_are_joined_last(spark):
    """They bring the most text to a loan, and no later join deals it again."""
    plan = loans(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line and "(l_" in line]
    assert [key in line for key, line in zip(("o_orderkey", "p_partkey", "s_suppkey"), joins)] == [True] * 3
