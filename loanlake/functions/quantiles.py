"""Exact order statistics without collecting or ordering a group.

A group is first reduced to a histogram ``(keys, value) -> n`` with map-side combine, so a key that
holds a third of all rows is spread by its values and arrives as one row per distinct one.  The
values fall into buckets on a logarithmic scale, some thousands at most.  Counts per bucket tell which
bucket holds a wanted rank and how far into it; only rows of those buckets are looked at again, where
the value is found.  No task orders a group, and no array holds more than the distinct values of a
bucket.  Sums, means and deviations come from the buckets too.
"""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets for every doubling of a value.
STEPS = 256
Rank = Callable[[Column], Column]


def middle_low(total: Column) -> Column:
    """0-based rank of the lower of the two middle values."""
    return F.floor((total - 1) / 2)


def middle_high(total: Column) -> Column:
    return F.ceil((total - 1) / 2)


def nearest(q: float) -> Rank:
    """0-based rank nearest to ``q * (n - 1)``, halves rounding up."""
    return lambda total: F.round((total - 1) * F.lit(float(q))).cast("bigint")


#: The ranks of a median; the middle of both values is the median.
MEDIAN: dict[str, Rank] = {"low": middle_low, "high": middle_high}


def bucket_of(value: Column) -> Column:
    """A number that never falls when the value rises; what is infinite or no number comes last."""
    scaled = F.log2(F.abs(value.cast("double")) + 1) * STEPS
    step = F.floor(F.least(scaled, F.lit(1e9))).cast("int")
    return F.when(value < 0, -step - 1).when(value.isNotNull(), step)


def _center(bucket: Column) -> Column:
    """A value near those of a bucket, to measure deviations from."""
    step = F.when(bucket < 0, -bucket - 1).otherwise(bucket)
    size = F.pow(F.lit(2.0), (step + 0.5) / STEPS) - 1
    return F.when(bucket < 0, -size).otherwise(size)


def _found(buckets: Column, rank: Column) -> Column:
    """``bucket, rest``: the bucket that holds a rank, and the rank inside it."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("bigint").alias("rest")
    )

    def step(at: Column, x: Column) -> Column:
        hit = at["bucket"].isNull() & (rank < at["before"] + x["size"])
        return F.struct(
            (at["before"] + x["size"]).alias("before"),
            F.when(hit, x["bucket"]).otherwise(at["bucket"]).alias("bucket"),
            F.when(hit, rank - at["before"]).otherwise(at["rest"]).alias("rest"),
        )

    return F.aggregate(buckets, start, step)


def _value_at(values: Column, rank: Column, kind: str) -> Column:
    """The value at a rank of an ordered list of ``(v, n)``."""
    start = F.struct(F.lit(0).cast("bigint").alias("before"), F.lit(None).cast(kind).alias("v"))

    def step(at: Column, x: Column) -> Column:
        hit = at["v"].isNull() & (rank < at["before"] + x["n"])
        return F.struct((at["before"] + x["n"]).alias("before"), F.when(hit, x["v"]).otherwise(at["v"]).alias("v"))

    return F.aggregate(values, start, step)["v"]


def order_statistics(
    hist: DataFrame, by: Sequence[str], ranks: Mapping[str, Rank], more: Mapping[str, tuple[Callable, Column]] | None = None
) -> DataFrame:
    """One row per group of ``hist(*by, v, n, ...)``.

    ``rows`` (all), ``total`` (with a value), ``mean``, ``squares`` (sum of squared deviations) and, under
    their names, the values at the ``ranks``, which are functions of ``total``; null where there is no
    value.  ``more`` are sums, minima or maxima over the histogram, as ``(F.sum, column)``.
    """
    by, more = list(by), dict(more or {})
    kind = dict(hist.dtypes)["v"]
    marked = hist.withColumn("bucket", bucket_of(F.col("v"))).repartition(*by, "bucket")
    off = F.col("v").cast("double") - _center(F.col("bucket"))
    sizes = marked.groupBy(*by, "bucket").agg(
        F.sum("n").alias("size"),
        F.sum(off * F.col("n")).alias("first"),
        F.sum(off * off * F.col("n")).alias("second"),
        F.sum(F.col("v").cast("double") * F.col("n")).alias("sum"),
        *[f(c).alias(f"more_{name}") for name, (f, c) in more.items()],
    )
    some = F.when(F.col("bucket").isNotNull(), F.struct("bucket", "size", "first", "second"))
    groups = sizes.groupBy(*by).agg(
        F.sum("size").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.col("size"))), F.lit(0)).alias("total"),
        F.sum("sum").alias("sum"),
        F.array_sort(F.collect_list(some)).alias("buckets"),
        *[f(f"more_{name}").alias(f"more_{name}") for name, (f, _) in more.items()],
    )
    groups = groups.withColumn("mean", F.col("sum") / F.nullif(F.col("total"), F.lit(0)))

    def about_mean(total: Column, x: Column) -> Column:
        away = _center(x["bucket"]) - F.col("mean")
        return total + x["second"] + 2 * away * x["first"] + away * away * x["size"]

    # Of equal values nothing is left but rounding, which may be negative.
    squares = F.when(F.col("total") > 0, F.greatest(F.aggregate("buckets", F.lit(0.0), about_mean), F.lit(0.0)))
    known = ["rows", "total", "mean", "squares", *(f"more_{name}" for name in more)]
    groups = groups.withColumn("squares", squares)
    places = [F.struct(F.lit(k).alias("k"), _found(F.col("buckets"), r(F.col("total"))).alias("at")) for k, r in enumerate(ranks.values())]
    picks = groups.select(
        *[F.col(c).alias(f"__by_{k}") for k, c in enumerate(by)], F.struct(*known).alias("__known"), F.explode(F.array(*places)).alias("__p")
    )
    same = [F.col(f"__by_{k}").eqNullSafe(F.col(c)) for k, c in enumerate(by)]
    values = marked.select(*by, F.struct("v", "n").alias("__row"), F.col("bucket").alias("__bucket"))
    met = picks.join(values, reduce(Column.__and__, [*same, F.col("__p.at.bucket") == F.col("__bucket")]), "left")

    def value(k: int) -> Column:
        here = F.col("__p.k") == k
        rows = F.array_sort(F.collect_list(F.when(here & F.col("__bucket").isNotNull(), F.col("__row"))))
        return _value_at(rows, F.max(F.when(here, F.col("__p.at.rest"))), kind)

    found = met.groupBy(*[f"__by_{k}" for k in range(len(by))]).agg(
        F.any_value("__known").alias("__known"), *[value(k).alias(f"__at_{k}") for k in range(len(ranks))]
    )
    return found.select(
        *[F.col(f"__by_{k}").alias(c) for k, c in enumerate(by)],
        *[F.col(f"__known.{c}").alias(c) for c in known[:4]],
        *[F.col(f"__known.more_{name}").alias(name) for name in more],
        *[F.col(f"__at_{k}").alias(name) for k, name in enumerate(ranks)],
    )


def median_of(low: str = "low", high: str = "high") -> Column:
    """Mean of the two middle values, as :data:`MEDIAN` names them."""
    return (F.col(low) + F.col(high)) / 2
