from .aggregates import count_where, n_unique, ratio, sum0
from .columns import (
    blank_as_null,
    code5,
    lenient_int,
    month_date,
    period,
    quarter,
    trimmed,
    zfill,
)
from .quantiles import MEDIAN, median_of, nearest, order_statistics

__all__ = [
    "MEDIAN",
    "blank_as_null",
    "code5",
    "count_where",
    "lenient_int",
    "median_of",
    "month_date",
    "n_unique",
    "nearest",
    "order_statistics",
    "period",
    "quarter",
    "ratio",
    "sum0",
    "trimmed",
    "zfill",
]
