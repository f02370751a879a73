import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from loanlake import functions as f
from loanlake.operators.row_keys import running_numbers, with_row_keys
from loanlake.operators.summaries import amount_summary, mortgage_summary


def test_n_unique_counts_null_once(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", None), ("a", "x"), ("b", "y")], "k string, v string")
    assert sorted(rows_of(df.groupBy("k").agg(f.n_unique("v")))) == [("a", 2), ("b", 1)]


def test_sum0_and_ratio(spark):
    df = spark.createDataFrame([(None, 0), (None, 0)], "a int, b int")
    assert rows_of(df.agg(f.sum0("a"), f.ratio(F.sum("b"), F.sum("b")))) == [(0, None)]


def test_text_helpers(spark):
    df = spark.createDataFrame([(1, " \t ab \n", "7"), (12, "", "123456")], "m int, t string, c string")
    got = rows_of(df.select(f.zfill("m", 2), f.trimmed("t"), f.code5("c"), f.blank_as_null("t"), f.quarter("m")))
    assert got == [("01", "ab", "00007", " \t ab \n", 1), ("12", "", "123456", None, 4)]


def test_month_date_and_period(spark):
    df = spark.createDataFrame([(2014, 8), (2014, 13), (None, 3), (2014, None)], "y int, m int")
    got = rows_of(df.select(f.month_date("y", "m").cast("string"), f.period("y", "m")))
    assert got == [("2014-08-01", "2014-08"), (None, "2014-13"), (None, None), (None, None)]


def test_lenient_int(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("abc",), ("9999999999",), (None,)], "t string")
    assert [r[0] for r in rows_of(df.select(f.lenient_int("t", "int")))] == [12, 12, None, None, None]


def nearest(values, q):
    values = sorted(values)
    return values[int((len(values) - 1) * q + 0.5)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_summary_matches_plain_statistics(spark, seed):
    rnd = random.Random(seed)
    data = [
        (
            rnd.choice(["a", "b", None, "c"]),
            rnd.choice([None, *range(100, 130)]),
            rnd.choice([None, 2.5, 3.0, 3.125, 3.5, 4.75]),
        )
        for _ in range(200)
    ] + [("single", 7, 3.5), ("empty", None, None)]
    df = spark.createDataFrame(data, "k string, amount bigint, rate double")
    got = {r["k"]: r for r in mortgage_summary(df, ["k"], "amount", "rate").collect()}
    also = {r["k"]: r for r in amount_summary(df, ["k"], "amount").collect()}
    assert set(got) == {d[0] for d in data} == set(also)
    for key, row in got.items():
        amounts = [d[1] for d in data if d[0] == key and d[1] is not None]
        rates = [d[2] for d in data if d[0] == key and d[2] is not None]
        assert row["loan_count"] == sum(d[0] == key for d in data) == also[key]["loan_count"]
        assert row["total_mortgage_amount"] == sum(amounts) == also[key]["total_amount"]
        if not amounts:
            assert row["median_mortgage_amount"] is None and row["avg_interest_rate"] is None
            continue
        assert row["median_mortgage_amount"] == statistics.median(amounts) == also[key]["median_amount"]
        assert row["avg_mortgage_amount"] == pytest.approx(statistics.mean(amounts))
        assert row["avg_interest_rate"] == pytest.approx(statistics.mean(rates))
        if len(rates) > 1:
            assert row["interest_rate_std"] == pytest.approx(statistics.stdev(rates))
        else:
            assert row["interest_rate_std"] is None
        assert row["interest_rate_iqr"] == pytest.approx(nearest(rates, 0.75) - nearest(rates, 0.25))


@pytest.mark.parametrize("seed", [4, 5])
def test_order_statistics_over_many_buckets(spark, seed):
    """Negative, tiny, huge, equal and missing values; every rank against a sorted list."""
    rnd = random.Random(seed)
    draw = lambda: rnd.choice([rnd.uniform(-1e6, 1e6), rnd.gauss(0, 1), 0.0, -0.0, 7.5, 1e18 * rnd.random(), None])
    data = [(rnd.choice(["a", None]), draw()) for _ in range(400)] + [("none", None), ("one", -3.25)]
    hist = spark.createDataFrame(data, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    ranks = {f"q{int(100 * q)}": f.nearest(q) for q in (0, 0.1, 0.25, 0.5, 0.75, 0.99, 1)}
    got = {r["k"]: r for r in f.order_statistics(hist, ["k"], {**f.MEDIAN, **ranks}, {"most": (F.max, F.col("n"))}).collect()}
    for key in {d[0] for d in data}:
        values = [d[1] for d in data if d[0] == key and d[1] is not None]
        row = got[key]
        assert (row["rows"], row["total"]) == (sum(d[0] == key for d in data), len(values))
        if not values:
            assert [row[c] for c in ("mean", "squares", "low", "q50")] == [None] * 4
            continue
        assert (row["low"] + row["high"]) / 2 == statistics.median(values)
        assert all(row[f"q{int(100 * q)}"] == nearest(values, q) for q in (0, 0.1, 0.25, 0.5, 0.75, 0.99, 1))
        assert row["mean"] == pytest.approx(statistics.fmean(values))
        assert row["squares"] == pytest.approx(sum((v - statistics.fmean(values)) ** 2 for v in values))


def test_running_numbers_equal_one_long_sort(spark):
    rnd = random.Random(5)
    data = [(rnd.choice(["x", "y", None]), i) for i in rnd.sample(range(10_000), 500)]
    df = spark.createDataFrame(data, "g string, i int")
    got = rows_of(running_numbers(df, ["g"], F.floor(F.col("i") / 700), ["i"]))
    expected = {}
    for g in {d[0] for d in data}:
        for n, i in enumerate(sorted(d[1] for d in data if d[0] == g), 1):
            expected[g, i] = n
    assert {(g, i): n for g, i, n in got} == expected


def test_row_keys_run_over_sheets(spark):
    rows = [("single_family", 2024, 1, s, r) for s in (0, 1) for r in range(5)] + [("hecm", 2024, 2, 0, 3)]
    df = spark.createDataFrame(
        rows, "snapshot_kind string, snapshot_year int, snapshot_month int, sheet_ord int, row_ord int"
    )
    keys = [r["FHA_Index"] for r in with_row_keys(df, block_rows=2).orderBy("FHA_Index").collect()]
    assert keys == [f"20240101_{n:07d}" for n in range(1, 11)] + ["H20240201_0000001"]
