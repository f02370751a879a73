"""Rows of an import are dealt once between bronze and silver, and a large month falls into blocks."""

from conftest import rows_of
from pyspark.sql import functions as F

from loanlake import schemas as s
from loanlake.operators import cleaning
from loanlake.plans import import_snapshots as imp
from loanlake.sources import snapshots


def bronze(spark, n):
    """Every row twice, a third of them in January."""
    empty = spark.createDataFrame([], s.bronze_schema())
    given = {
        s.INDEX: F.col("id").cast("string"), s.ORIG: F.lit("Lender"), s.SPONSOR: F.lit("nan"),
        s.YEAR: F.lit(2024).cast("smallint"), s.MONTH: F.col("m").cast("smallint"),
        s.RATE: F.when(F.col("id") % 2 == 0, F.lit(float("nan"))),
    }
    rows = spark.range(n).withColumn("m", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 3 + 1))
    rows = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.schema.fields if f.name not in imp.SNAPSHOT]
    return rows.select(*columns, F.lit(2024).alias("snapshot_year"), F.col("m").cast("int").alias("snapshot_month"))


def test_rows_are_dealt_once_before_they_are_written(spark, tmp_path, monkeypatch):
    plans, write = [], imp.write_months

    def seen(df, path, *keys):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path, *keys)

    monkeypatch.setattr(imp, "write_months", seen)
    monkeypatch.setattr(imp, "BLOCK_ROWS", 50)
    bronze(spark, 300).write.parquet(f"{tmp_path}/bronze")
    rows = spark.read.parquet(f"{tmp_path}/bronze")
    silver = f"{tmp_path}/silver"
    imp.store_months(spark, rows, silver, "single_family", [(2024, m) for m in (1, 2, 3)])
    assert plans[0].count("Exchange hashpartitioning") == 1 and "RebalancePartitions" not in plans[0]
    assert plans[0].index("HashAggregate") < plans[0].rindex("HashAggregate") < plans[0].index("Exchange")
    got = snapshots.read_silver(spark, silver)
    # NaN and null are equal to themselves.
    assert sorted(rows_of(got.groupBy(s.MONTH).count())) == [(1, 100), (2, 100), (3, 100)]
    want = cleaning.prepare_export(rows.drop(*imp.SNAPSHOT))
    got = got.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_large_month_falls_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(imp, "BLOCK_ROWS", 50)
    rows = bronze(spark, 300)
    blocks = imp._blocks(imp.snapshot_sizes(rows))
    kept = cleaning.one_of_each(rows, imp.SNAPSHOT, blocks)
    found = kept.groupBy("snapshot_month").agg(F.count_distinct(cleaning.BLOCK), F.count("*"))
    assert sorted(rows_of(found)) == [(1, 4, 100), (2, 4, 100), (3, 4, 100)]
