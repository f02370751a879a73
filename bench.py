"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES
(comma-separated names, default the list below).
"""

import json
import os
import time

from pyspark.sql import SparkSession

from loanlake.plans.catalog import QUERIES

HEADLINE = [
    "lender_volume", "yearly_lenders", "lender_panel_annual", "lender_panel_quarterly", "sponsor_volume",
    "market_share", "state_stats", "monthly_stats", "refinance_share", "loan_size_trend", "rates_by_product",
    "top_lender_groups", "category_share", "county_metrics", "county_metrics_quarterly", "metro_metrics",
    "county_counts", "hhi_year_state_sponsor", "hhi_month_county_sponsor", "hhi_all_all_sponsor", "hhi_cells",
    "institution_crosswalk", "lender_crosswalk", "mapping_errors", "event_log", "name_transitions", "oscillations",
    "edges", "degree_centrality", "projection_originators", "betweenness", "run_all_checks", "silver_loans",
    "fips_crosswalk", "row_keys",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in names[:3]:  # warm-up of the JVM, not counted
        run(name)
    seconds = {name: run(name) for name in names}
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").split("sf")[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
