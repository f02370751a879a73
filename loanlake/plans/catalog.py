"""Named queries over the star-schema tables, one per operator."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    activity,
    betweenness,
    cleaning,
    concentration,
    counties,
    geography,
    identity,
    network,
    sketches,
    trends,
    validation,
)
from ..schemas import (
    AMOUNT,
    COUNTY,
    DATE,
    DOWN,
    FIPS,
    INDEX,
    MONTH,
    ORIG,
    ORIG_NO,
    PRODUCT,
    PROPERTY,
    PURPOSE,
    RATE,
    SPONSOR,
    SPONSOR_NO,
    STATE,
    YEAR,
)
from ..sources import file_names, snapshots, star_raw
from ..sources.checkpoints import cut_lineage
from ..sources.star_loans import loans, read_table, reverse_loans
from . import file_queries, import_snapshots, reports

QUERIES = {}


# Result columns on a small scale keep ten decimals, amounts and dispersions six.
_FINE = ("avg_interest_rate", "avg_rate", "AverageRate", "HHI", "hhi_normalized", "Proportion")
_FINE_PARTS = ("share", "Share", "rate_average", "Loans per Lender")


def rounded(df: DataFrame) -> DataFrame:
    """Round the double columns so that the order of summation does not show."""

    def digits(name: str) -> int:
        return 10 if name in _FINE or any(p in name for p in _FINE_PARTS) else 6

    return df.select(
        *[F.round(f"`{c}`", digits(c)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def flat(df: DataFrame) -> DataFrame:
    """Lists and maps as text, so that plain values are compared."""

    def text(name: str, dtype: str):
        c = F.col(f"`{name}`")
        if dtype.startswith("array<"):
            return F.array_join(c.cast("array<string>"), "|").alias(name)
        if dtype.startswith("map<"):
            nested = dtype.endswith("array<string>>")
            entries = F.transform(
                F.array_sort(F.map_entries(c)),
                lambda e: F.concat(
                    e["key"], F.lit("="), F.array_join(e["value"], ",") if nested else e["value"]
                ),
            )
            return F.array_join(entries, ";").alias(name)
        return c

    return df.select(*[text(c, t) for c, t in df.dtypes])


def register(name: str, operator, *columns: str) -> None:
    """Register ``operator`` over the loan view reduced to ``columns``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(rounded(operator(loans(spark, sf_dir, *columns))))

    QUERIES[name] = run


def metro_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County code to metro area, from nation and the brands of part; a third has none."""
    counties = (
        read_table(spark, sf_dir, "part")
        .select(F.substring("p_brand", 7, 10).cast("int").alias("b"))
        .distinct()
        .filter(F.col("b") % 3 != 0)
        .withColumn("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(24))))
    )
    nation = read_table(spark, sf_dir, "nation")
    code = F.lpad((F.col("n_nationkey") * 1000 + F.col("b")).cast("string"), 5, "0")
    metro = F.col("n_nationkey") * 10 + F.col("b") % 3
    return counties.join(nation, "n_nationkey").select(
        code.alias(FIPS),
        F.lpad(metro.cast("string"), 5, "0").alias("CBSA Code"),
        F.concat("n_name", F.lit(" Metro "), (F.col("b") % 3).cast("string")).alias("CBSA Title"),
    )


def _metro(frequency: str):
    def run(spark, sf_dir):
        df = loans(spark, sf_dir, YEAR, MONTH, FIPS, AMOUNT, RATE)
        table = geography.metro_metrics(df, frequency, cbsa_crosswalk=metro_crosswalk(spark, sf_dir))
        return rounded(table)

    return run


# --- activity ----------------------------------------------------------------
def _estimates(df: DataFrame) -> DataFrame:
    """Exact numbers of names per year, and whether those from sketches are within four standard errors."""
    stored = cut_lineage(sketches.month_sketches(df))
    bound = 4 * 1.04 / 2 ** (sketches.PRECISION / 2)
    parts = []
    for column, exact, estimated in (
        ("Active Lenders", activity.yearly_lenders(df), sketches.yearly_lenders(stored)),
        ("Active Sponsors", activity.yearly_sponsors(df), sketches.yearly_sponsors(stored)),
    ):
        both = exact.select(YEAR, F.col(column).alias("n")).join(estimated.select(YEAR, F.col(column).alias("e")), YEAR, "full")
        near = F.coalesce(F.abs(F.col("e") - F.col("n")) <= bound * F.col("n"), F.lit(False))
        parts.append(both.select(YEAR, F.lit(column).alias("what"), F.col("n").alias("names"), near.alias("within_bound")))
    return parts[0].unionByName(parts[1])


register("estimated_names", _estimates, YEAR, MONTH, ORIG, SPONSOR)
register("lender_volume", activity.lender_volume, ORIG, AMOUNT)
register("yearly_lenders", activity.yearly_lenders, YEAR, ORIG)
_PANEL = (YEAR, MONTH, ORIG_NO, ORIG, AMOUNT, RATE, PURPOSE)
register("lender_panel_annual", lambda df: activity.lender_panel(df, "annual"), *_PANEL)
register("lender_panel_quarterly", lambda df: activity.lender_panel(df, "quarterly"), *_PANEL)
register("sponsor_volume", activity.sponsor_volume, SPONSOR, AMOUNT)
register("yearly_sponsors", activity.yearly_sponsors, YEAR, SPONSOR)
register("loan_purpose", lambda df: activity.loan_characteristics(df)["loan_purpose"], YEAR, PURPOSE, DOWN, AMOUNT)
register("down_payment", lambda df: activity.loan_characteristics(df)["down_payment"], YEAR, PURPOSE, DOWN, AMOUNT)
register("yearly_loan_size", activity.yearly_loan_size, YEAR, AMOUNT)
register("market_share", activity.market_share, YEAR, ORIG)
register("yearly_hhi", activity.yearly_hhi, YEAR, ORIG)
register("state_stats", activity.state_statistics, STATE, AMOUNT, RATE, ORIG)
register("monthly_stats", activity.monthly_statistics, YEAR, MONTH, AMOUNT, RATE)
register("state_year_counts", lambda df: activity.state_loans_in_year(df, 1998), YEAR, STATE)
register("state_lenders", lambda df: activity.lenders_in_state(df, "NATION_7", 1998), YEAR, STATE, ORIG)
register("value_counts", lambda df: activity.value_counts(df, PROPERTY), PROPERTY)

# --- trends ------------------------------------------------------------------
register("refinance_share", trends.refinance_share, DATE, PURPOSE)
register("fixed_rate_share", lambda df: trends.fixed_rate_share(df, averages=True), DATE, PRODUCT, RATE)
register("active_lenders", trends.active_lenders, DATE, ORIG)
register("loan_size_trend", trends.loan_size_trend, DATE, AMOUNT)
register("purpose_trend", trends.purpose_trend, DATE, PURPOSE)
register("down_payment_share", trends.borrower_funded_share, DATE, DOWN)
register("rates_by_product", trends.averages_by_product, DATE, PRODUCT, RATE, AMOUNT)
register("rates_by_property", trends.averages_by_property, DATE, PROPERTY, RATE, AMOUNT)
register("rates_by_purpose", trends.averages_by_purpose, DATE, PURPOSE, RATE, AMOUNT)
register("top_lender_groups", trends.top_lender_groups, DATE, ORIG, RATE, AMOUNT)
register("category_counts", trends.category_counts, DATE, DOWN, PROPERTY, PRODUCT, PURPOSE)
register("category_share", trends.category_shares, DATE, DOWN, PROPERTY, PRODUCT, PURPOSE)

# --- geography ---------------------------------------------------------------
_COUNTY = (YEAR, MONTH, STATE, COUNTY, FIPS, AMOUNT, RATE)
register("county_metrics", lambda df: geography.county_metrics(df, "annual"), *_COUNTY)
register("county_metrics_quarterly", lambda df: geography.county_metrics(df, "quarterly"), *_COUNTY)
QUERIES["metro_metrics"] = _metro("annual")
QUERIES["metro_metrics_quarterly"] = _metro("quarterly")
register("state_counts", geography.state_loan_counts, STATE)
register("county_counts", geography.county_loan_counts, FIPS, STATE, COUNTY)
register("state_counts_yearly", lambda df: geography.state_loan_counts(df, by_year=True), YEAR, STATE)
register(
    "county_counts_yearly",
    lambda df: geography.county_loan_counts(df, by_year=True),
    YEAR, FIPS, STATE, COUNTY,
)

# --- concentration -----------------------------------------------------------
_TIME_COLUMNS = {"month": (YEAR, MONTH), "quarter": (YEAR, MONTH), "year": (YEAR,), "all": ()}
_PLACE_COLUMNS = {"state": (STATE,), "county": (STATE, COUNTY), "all": ()}


def _hhi(time_level: str, geography_level: str, lender_type: str, drop_missing: bool = True):
    return lambda df: concentration.lender_hhi(df, time_level, geography_level, lender_type, drop_missing)


for _t, _time in _TIME_COLUMNS.items():
    for _g, _place in _PLACE_COLUMNS.items():
        for _l in concentration.LENDER_TYPES:
            register(f"hhi_{_t}_{_g}_{_l}", _hhi(_t, _g, _l), *_time, *_place, SPONSOR_NO, ORIG_NO)
register("hhi_keep_missing", _hhi("year", "state", "originator", False), YEAR, STATE, ORIG_NO)
register("hhi_cells", concentration.hhi_cells, YEAR, MONTH, STATE, COUNTY, SPONSOR_NO, ORIG_NO)

# --- identity ----------------------------------------------------------------
_PARTIES = (YEAR, MONTH, ORIG_NO, ORIG, SPONSOR_NO, SPONSOR)


def lender_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans as single family files and orders as HECM files."""
    single_family = loans(spark, sf_dir, ORIG_NO, ORIG, SPONSOR_NO, SPONSOR, DATE)
    hecm = reverse_loans(spark, sf_dir)
    return identity.lender_name_crosswalk(
        single_family, hecm, file_date_col=DATE, skip_single_family=("1998-08-01",)
    )


register("institution_crosswalk", identity.institution_crosswalk, *_PARTIES)
QUERIES["lender_crosswalk"] = lender_crosswalk
register("canonical_names", identity.canonical_names, *_PARTIES)
register("id_spaces", identity.id_spaces, ORIG_NO, ORIG, SPONSOR_NO, SPONSOR)
register("month_conflicts", identity.month_conflicts, *_PARTIES)
register("temporary_renames", identity.temporary_renames, *_PARTIES)
register("mapping_errors", identity.mapping_errors, *_PARTIES)
register("segments_originator", identity.name_segments, YEAR, MONTH, ORIG_NO, ORIG)
register(
    "segments_sponsor",
    lambda df: identity.name_segments(df, identity.SPONSOR_ROLE),
    YEAR, MONTH, SPONSOR_NO, SPONSOR,
)
register("name_events_originator", identity.name_events, YEAR, MONTH, ORIG_NO, ORIG)
register(
    "name_events_sponsor",
    lambda df: identity.name_events(df, identity.SPONSOR_ROLE),
    YEAR, MONTH, SPONSOR_NO, SPONSOR,
)
register("ownership_events", identity.ownership_events, *_PARTIES)
register("event_log", identity.event_log, *_PARTIES)
register("name_transitions", identity.name_transitions, YEAR, MONTH, ORIG_NO, ORIG)
register(
    "name_change_summary",
    lambda df: identity.name_change_summary(identity.name_transitions(df)),
    YEAR, MONTH, ORIG_NO, ORIG,
)
register("timeline", lambda df: identity.timeline(df, 5), YEAR, MONTH, ORIG_NO, ORIG)
register("oscillations", identity.oscillations, YEAR, MONTH, ORIG_NO, ORIG)
register(
    "oscillations_sponsor",
    lambda df: identity.oscillations(df, identity.SPONSOR_ROLE),
    YEAR, MONTH, SPONSOR_NO, SPONSOR,
)

# --- network -----------------------------------------------------------------
_EDGE_COLUMNS = (YEAR, ORIG_NO, ORIG, SPONSOR_NO, SPONSOR, AMOUNT)


def _on_graph(operator):
    """Apply ``operator(vertices, edges)`` to the network of the loans."""
    return lambda df: operator(*network.bipartite_graph(network.edges(df)))


register("edges", network.edges, *_EDGE_COLUMNS)
register(
    "edges_filtered",
    lambda df: network.edges(df, start_year=1996, end_year=1999, min_loans=3),
    *_EDGE_COLUMNS,
)
register("edge_totals", lambda df: network.edge_totals(network.edges(df)), *_EDGE_COLUMNS)
register("graph_vertices", _on_graph(lambda v, e: v), *_EDGE_COLUMNS)
register("graph_edges", _on_graph(lambda v, e: e), *_EDGE_COLUMNS)
register("degrees", _on_graph(lambda v, e: network.degrees(network.adjacency(e))), *_EDGE_COLUMNS)
register("degree_centrality", _on_graph(network.degree_centrality), *_EDGE_COLUMNS)
register(
    "centrality_originators",
    _on_graph(lambda v, e: network.centrality(v, e, with_betweenness=False)["originator_centrality"]),
    *_EDGE_COLUMNS,
)
register(
    "centrality_sponsors",
    _on_graph(lambda v, e: network.centrality(v, e, with_betweenness=False)["sponsor_centrality"]),
    *_EDGE_COLUMNS,
)
for _side in ("originator", "sponsor"):
    register(
        f"centrality_full_{_side}s",
        _on_graph(lambda v, e, side=_side: network.centrality(v, e)[f"{side}_centrality"]),
        *_EDGE_COLUMNS,
    )
register("betweenness", _on_graph(lambda v, e: betweenness.betweenness(network.adjacency(e))), *_EDGE_COLUMNS)
register("projection_originators", _on_graph(lambda v, e: network.projection(e, "originator")), *_EDGE_COLUMNS)
register("projection_sponsors", _on_graph(lambda v, e: network.projection(e, "sponsor")), *_EDGE_COLUMNS)
for _side in ("originator", "sponsor"):
    register(
        f"heaviest_pairs_{_side}s",
        _on_graph(lambda v, e, side=_side: network.heaviest_pairs(e, 25, side)),
        *_EDGE_COLUMNS,
    )
register(
    "top_relationships",
    lambda df: network.ranked_edges(network.edges(df)).limit(10),
    *_EDGE_COLUMNS,
)

# --- validation --------------------------------------------------------------
_CHECK_COLUMNS = {
    "check_required_columns": (INDEX, STATE, AMOUNT, *_PARTIES),
    "check_fha_index_uniqueness": (INDEX,),
    "check_id_name_consistency_monthly": (YEAR, MONTH, ORIG_NO, ORIG),
    "check_overlapping_id_spaces": (ORIG_NO, ORIG, SPONSOR_NO, SPONSOR),
    "check_name_oscillations": (YEAR, MONTH, ORIG_NO, ORIG),
    "check_originator_sponsor_relationships": (ORIG_NO, ORIG, SPONSOR),
}
for _c, _check in validation.CHECKS.items():
    register(_c, _check, *_CHECK_COLUMNS.get(_c, (*_PARTIES, AMOUNT)))
register("profile_checks", validation.profile_checks, *_PARTIES, AMOUNT)
register("run_all_checks", validation.run_checks, INDEX, STATE, AMOUNT, *_PARTIES)
register("run_critical_checks", validation.run_critical, INDEX, STATE, AMOUNT, *_PARTIES)
register(
    "validation_verdict",
    lambda df: validation.verdict(validation.run_checks(df)),
    INDEX, STATE, AMOUNT, *_PARTIES,
)

# --- names that change within a month ------------------------------------------
_NAMED = (YEAR, MONTH, ORIG_NO, ORIG, SPONSOR_NO, SPONSOR)


def mixed_names(df: DataFrame) -> DataFrame:
    """Loans in which some originators trade under a second name with some sponsors."""
    second = (F.col(ORIG_NO) % 4 == 1) & (F.col(MONTH) % 3 == F.col(SPONSOR_NO) % 3) & (F.col(YEAR) > 1996)
    return df.withColumn(ORIG, F.when(second, F.concat(ORIG, F.lit(" II"))).otherwise(F.col(ORIG)))


def register_mixed(name: str, operator) -> None:
    register(f"{name}_mixed", lambda df: operator(mixed_names(df)), *_NAMED)


register_mixed("month_conflicts", identity.month_conflicts)
register_mixed("temporary_renames", identity.temporary_renames)
register_mixed("segments_originator", identity.name_segments)
register_mixed("name_events_originator", identity.name_events)
register_mixed("name_transitions", identity.name_transitions)
register_mixed("name_change_summary", lambda df: identity.name_change_summary(identity.name_transitions(df)))
register_mixed("timeline", lambda df: identity.timeline(df, 5))
register_mixed("oscillations", identity.oscillations)
register_mixed("check_id_name_consistency_monthly", validation.check_id_name_consistency_monthly)
register_mixed("check_name_oscillations", validation.check_name_oscillations)
register_mixed("institution_summary", reports.institution_summary)


def traded_sponsors(df: DataFrame) -> DataFrame:
    """Loans in which some sponsors change their name every third year, and others in some months only."""
    number = F.col(SPONSOR_NO)
    yearly = (number % 3 == 1) & (F.col(YEAR) % 3 == 0)
    monthly = (number % 5 == 2) & (F.col(MONTH) % 4 == 1) & (F.col(ORIG_NO) % 2 == 0)
    name = F.when(yearly, F.concat(SPONSOR, F.lit(" & Co"))).when(monthly, F.concat(SPONSOR, F.lit(" Trust")))
    return df.withColumn(SPONSOR, name.otherwise(F.col(SPONSOR)))


for _name, _operator in {
    "oscillations_sponsor": identity.oscillations,
    "segments_sponsor": identity.name_segments,
    "name_events_sponsor": identity.name_events,
}.items():
    register(f"{_name}_mixed", lambda df, f=_operator: f(traded_sponsors(df), identity.SPONSOR_ROLE), *_NAMED)

# --- cleaning, counties and import ------------------------------------------------


def register_raw(name: str, operator, source=star_raw.raw_sheets) -> None:
    """Register ``operator(spark, raw rows)`` over the untidy sheets."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(operator(spark, source(spark, sf_dir)))

    QUERIES[name] = run


def _data_rows(raw: DataFrame, kind: str = "single_family") -> DataFrame:
    return raw.filter(snapshots.is_data_sheet(kind))


def _without_place(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in cleaning.PLACE_COLUMNS if c != "row_ord"])


def _bronze(raw: DataFrame, kind: str = "single_family") -> DataFrame:
    return import_snapshots.bronze_rows(_data_rows(raw, kind), kind)


def _silver(spark: SparkSession, raw: DataFrame, **options) -> DataFrame:
    reference = star_raw.county_reference(spark)
    return import_snapshots.silver_rows(_bronze(raw), county_reference=reference, **options)


def _pairs(raw: DataFrame) -> DataFrame:
    return cleaning.clean_single_family(_data_rows(raw)).select(STATE, COUNTY)


def _county_crosswalk(part: int):
    def run(spark: SparkSession, raw: DataFrame) -> DataFrame:
        return counties.build_county_crosswalk(
            [_pairs(raw)],
            star_raw.county_reference(spark),
            existing=star_raw.stored_crosswalk(spark),
            problematic=star_raw.stored_problems(spark),
        )[part]

    return run


register_raw("clean_loans", lambda spark, raw: _without_place(cleaning.clean_single_family(_data_rows(raw))))
register_raw(
    "clean_hecm",
    lambda spark, raw: _without_place(cleaning.clean_hecm(_data_rows(raw, "hecm"))),
    star_raw.raw_hecm_sheets,
)
register_raw("clean_rejects", lambda spark, raw: cleaning.rejected_values(_data_rows(raw)))
register_raw("row_keys", lambda spark, raw: _bronze(raw).select(INDEX, "snapshot_year", "snapshot_month", AMOUNT))
register_raw(
    "row_keys_hecm",
    lambda spark, raw: _bronze(raw, "hecm").select(INDEX, "snapshot_year", "snapshot_month", "NMLS"),
    star_raw.raw_hecm_sheets,
)
register_raw("silver_loans", _silver)
register_raw("silver_domain_violations", lambda spark, raw: cleaning.domain_violations(_silver(spark, raw)))
register_raw(
    "county_standardised",
    lambda spark, raw: counties.standardize_counties(_pairs(raw)).groupBy(STATE, COUNTY).count(),
)
register_raw(
    "county_fips",
    lambda spark, raw: counties.add_county_fips(_pairs(raw), star_raw.county_reference(spark))
    .groupBy(STATE, COUNTY, FIPS)
    .count(),
)
register_raw(
    "fips_new_pairs",
    lambda spark, raw: counties.new_county_pairs(
        counties.county_pairs([_pairs(raw)]), star_raw.stored_crosswalk(spark), [STATE, COUNTY]
    ),
)
register_raw("fips_crosswalk", _county_crosswalk(0))
register_raw("fips_problematic", _county_crosswalk(1))
register_raw(
    "incremental_rows",
    lambda spark, raw: import_snapshots.without_stored_months(
        _silver(spark, raw), _silver(spark, raw).filter(F.col(YEAR) < 2017).select(YEAR, MONTH).distinct()
    )
    .groupBy(YEAR, MONTH)
    .agg(F.count("*").alias("rows")),
)


def _file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    info = file_names.snapshot_period(path, "sf")
    return star_raw.file_names(spark, sf_dir).select(
        "path",
        info["kind"].alias("kind"),
        info["year"].alias("year"),
        info["month"].alias("month"),
        info["problem"].isNull().alias("usable"),
        file_names.year_in_name(file_names.base_name(path)).alias("year_in_name"),
        file_names.month_in_name(file_names.base_name(path)).alias("month_in_name"),
        file_names.period_suffix(path).alias("suffix"),
        file_names.standard_file_name(path, "sf", F.lit("201001")).alias("standard_name"),
    )


def _pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = star_raw.file_names(spark, sf_dir)
    names = files.select(F.regexp_replace("path", "_(19|20)(..)", "_20$2").alias("path"))
    processed = spark.createDataFrame([(2095, 1), (2096, 2)], "year int, month int")
    return snapshots.pending_files(names, "single_family", processed)


QUERIES["file_names"] = _file_names
QUERIES["pending_files"] = _pending_files
QUERIES |= file_queries.QUERIES
QUERIES["report_event_log"] = lambda spark, sf_dir: flat(rounded(file_queries.report_event_log(spark, sf_dir)))
