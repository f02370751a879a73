"""Shape of the plans: what is read, and what is never done."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from loanlake import schemas as s
from loanlake.operators import activity, concentration, geography, identity, network, trends
from loanlake.plans import import_snapshots as imp
from loanlake.plans import catalog, catalog_sql, import_snapshots
from loanlake.sources import snapshots
from loanlake.sources.star_loans import loans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    imp.write_months(loans(spark, SMALL), path, s.YEAR, s.MONTH)
    return snapshots.read_silver(spark, path)


def read_columns(text):
    return {c.split(":")[0] for part in re.findall(r"ReadSchema: struct<([^>]*)>", text) for c in part.split(",") if c}


def test_only_needed_columns_are_read(silver):
    assert read_columns(plan(activity.lender_volume(silver))) == {s.ORIG, s.AMOUNT}
    assert read_columns(plan(trends.refinance_share(silver))) == {s.PURPOSE, s.DATE}
    assert read_columns(plan(concentration.lender_hhi(silver))) == {s.SPONSOR_NO, s.ORIG_NO, s.STATE}


def test_year_filters_prune_partitions_and_state_filters_reach_the_files(silver):
    text = plan(activity.lenders_in_state(silver, "NATION_7", 1998))
    assert re.search(r"PartitionFilters: \[[^\]]*Year[^\]]*>= 1998", text)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(`?Property State", text)
    text = plan(network.edges(silver, start_year=1996, end_year=1997))
    assert re.search(r"PartitionFilters: \[[^\]]*Year[^\]]*<= 1997", text)


def test_counts_combine_before_the_first_shuffle(silver):
    """Hot keys shrink to one row per key and task before they are shuffled."""
    for df in (
        activity.lender_panel(silver),
        concentration.lender_hhi(silver),
        identity.party_months(silver),
        network.edges(silver),
        trends.top_lender_groups(silver),
    ):
        text = plan(df)
        scan = text.rindex("FileScan")
        last_exchange = text.rindex("Exchange hashpartitioning", 0, scan)
        assert "partial_" in text[last_exchange:scan]


def test_loan_view_skips_dimensions(spark):
    text = plan(loans(spark, SMALL, s.YEAR, s.SPONSOR_NO).groupBy(s.YEAR).count())
    assert text.count("FileScan") == 1 and "Join" not in text


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_joins(spark, name):
    text = plan(catalog.QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_bronze_files_out_of_range_are_not_read(spark, tmp_path):
    """Neither the scan nor an increment opens files of other months; a broken one does no harm."""
    frame = spark.createDataFrame([("A",)], f"`{s.ORIG}` string").toPandas()
    bronze = tmp_path / "bronze"
    bronze.mkdir()
    frame.to_parquet(bronze / "fha_sf_snapshot_20230501.parquet")
    (bronze / "fha_sf_snapshot_20190501.parquet").write_bytes(b"this is no parquet file")
    assert snapshots.read_bronze(spark, str(bronze), "single_family", min_year=2020).count() == 1
    folders = tmp_path / "folders"
    months = spark.createDataFrame([(2024, 1, "A"), (2024, 2, "B")], f"`{s.YEAR}` smallint, `{s.MONTH}` smallint, `{s.ORIG}` string")
    months = months.withColumns({"snapshot_year": F.col(s.YEAR).cast("int"), "snapshot_month": F.col(s.MONTH).cast("int")})
    import_snapshots.write_months(months, str(folders), "snapshot_year", "snapshot_month")
    broken = folders / "snapshot_year=2005" / "snapshot_month=3"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"this is no parquet file")
    silver = str(tmp_path / "silver")
    assert import_snapshots.update_silver(spark, str(folders), silver, min_year=2024) == [(2024, 1), (2024, 2)]
    assert snapshots.read_silver(spark, silver).count() == 2


def test_a_hot_institution_is_exact(spark):
    """A third of all rows under one key, in one month and county: same answers."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    df = spark.range(n).select(
        F.lit(2024).cast("smallint").alias(s.YEAR),
        F.when(hot, 1).otherwise(F.col("id") % 12 + 1).cast("smallint").alias(s.MONTH),
        F.when(hot, 7).otherwise(100 + F.col("id") % 500).cast("int").alias(s.ORIG_NO),
        F.when(hot, "Hot").otherwise(F.concat(F.lit("L"), (F.col("id") % 500).cast("string"))).alias(s.ORIG),
        F.lit(1).alias(s.SPONSOR_NO),
        F.lit("S").alias(s.SPONSOR),
        (F.col("id") % 1000).cast("bigint").alias(s.AMOUNT),
    )
    top = network.edges(df).orderBy(F.desc("loan_count")).first()
    hot_amounts = sorted(i % 1000 for i in range(0, n, 3))
    middle = (hot_amounts[len(hot_amounts) // 2 - 1] + hot_amounts[len(hot_amounts) // 2]) / 2
    assert (top["loan_count"], top["total_volume"], top["median_loan_amount"]) == (n // 3, sum(hot_amounts), middle)
    segment = identity.name_segments(df).filter("id = 7").first()
    assert segment["total_records"] == n // 3


def test_counts_are_expanded_not_loans(silver):
    """Loans are counted once and stored; the cell shapes are made from the counts by two exchanges."""
    text = plan(concentration.hhi_cells(silver))
    assert "n#" in text and s.AMOUNT not in text and s.SPONSOR not in text
    assert text.count("Exchange hashpartitioning") == 2


def test_no_group_is_ordered_for_its_median(silver):
    """Medians and quantiles select: no window over the values of a group, whatever its size."""
    for df in (geography.county_metrics(silver), trends.loan_size_trend(silver), network.edges(silver)):
        assert "Window" not in plan(df)


def test_a_task_sees_a_part_of_the_network(spark):
    """Betweenness deals nodes into parts and sources into blocks; no task meets the edges of all parts at once."""
    from loanlake.operators import betweenness

    links = [(f"n{k}", f"n{k + 1}", 1.0) for k in range(40)]
    both = [*links, *((b, a, w) for a, b, w in links)]
    adjacent = spark.createDataFrame(both, "node string, neighbour string, weight double")
    seen, run = [], betweenness.cut_lineage

    def kept(df):
        seen.append(run(df))
        return seen[-1]

    betweenness.cut_lineage = kept
    try:
        betweenness.betweenness(adjacent, part_nodes=10, block_sources=4)
    finally:
        betweenness.cut_lineage = run
    edges = next(t for t in seen if "w" in t.columns and "p" in t.columns)
    assert edges.select("p").distinct().count() == 5
    assert edges.selectExpr("max(size(w))").first()[0] <= 20


def test_no_query_is_without_sql():
    assert set(catalog.QUERIES) == set(catalog_sql.statements())


def test_repository_uses_no_local_checkpoints():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "loanlake")
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                assert "localCheckpoint" not in text and "crossJoin" not in text
