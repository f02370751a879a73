"""Reports that run several operators over one loan table."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import activity, identity, network, trends, validation
from ..sources.checkpoints import cut_lineage
from ..sources.sinks import write_tabular


def exploratory_tables(df: DataFrame, top_n: int = 20) -> dict[str, DataFrame]:
    """Activity and trend tables by name."""
    return {**activity.lender_activity(df), **activity.sponsor_activity(df), **trends.trend_tables(df, top_n)}


def network_tables(
    df: DataFrame,
    *,
    start_year: int | None = None,
    end_year: int | None = None,
    min_loans: int = 1,
    weight_col: str = "loan_count",
    edge_merge: str = "sum",
    merge_shared_ids: bool = False,
    ordered_pairs: bool = True,
) -> dict[str, DataFrame]:
    """Edges, centrality of both sides, both projections (heaviest pairs first, if ``ordered_pairs``) and a summary row."""
    table = cut_lineage(network.edges(df, start_year=start_year, end_year=end_year, min_loans=min_loans))
    vertex_table, edge_list = network.bipartite_graph(table, weight_col=weight_col, edge_merge=edge_merge)
    return {
        "edges": network.ranked_edges(table),
        **network.centrality(vertex_table, edge_list, merge_shared_ids=merge_shared_ids),
        **network.projections(edge_list, ordered=ordered_pairs),
        "summary": network.edge_totals(table),
    }


def institution_summary(
    df: DataFrame,
    pairs: DataFrame | None = None,
    sets: Mapping[str, DataFrame] | None = None,
    errors: DataFrame | None = None,
) -> DataFrame:
    """``section, metric, value`` of the institution report.

    Pairs, name sets and mapping errors are taken as they are where the caller has them stored.
    """
    df = identity.stored_party_months(df)
    pairs = cut_lineage(identity.institution_pairs(df)) if pairs is None else pairs
    sets = identity.stored_name_sets(df) if sets is None else sets
    errors = identity.mapping_errors(df, pairs) if errors is None else errors
    originators, sponsors = sets[identity.ORIGINATOR], sets[identity.SPONSOR_ROLE]
    spaces = identity.id_spaces(df).drop("sample_overlapping_names", "sample_overlapping_ids")
    counts = spaces.unpivot([], spaces.columns, "metric", "value").withColumn("section", F.lit("id_spaces"))

    def metric(section: str, name: str, table: DataFrame, value=F.count("*")) -> DataFrame:
        return table.agg(value.cast("bigint").alias("value")).select(
            F.lit(name).alias("metric"), "value", F.lit(section).alias("section")
        )

    parts = [
        counts,
        metric("summary", "unique_institution_numbers", pairs, F.count_distinct("institution_number")),
        metric("summary", "unique_institution_names", pairs, F.count_distinct("institution_name")),
        metric("summary", "ids_with_name_changes", identity.name_transitions(originators), F.count_distinct("id")),
        metric("summary", "mapping_errors", errors),
        metric("summary", "originator_oscillations", identity.oscillations(originators)),
        metric("summary", "sponsor_oscillations", identity.oscillations(sponsors, identity.SPONSOR_ROLE)),
    ]
    out = parts[0].select("section", "metric", "value")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def institution_report(df: DataFrame, output_dir: str) -> dict[str, str]:
    """Write crosswalk, mapping errors, summary and event log; returns their paths.

    All parts start from the same stored monthly counts, so loans are scanned once; pairs, name sets
    and errors, which several parts need, are made once.
    """
    parties = identity.stored_party_months(df)
    pairs = cut_lineage(identity.institution_pairs(parties))
    sets = identity.stored_name_sets(parties)
    errors = cut_lineage(identity.mapping_errors(parties, pairs))
    tables = {
        "crosswalk": (identity.institution_crosswalk(parties, pairs), "csv"),
        "errors": (errors, "csv"),
        "summary": (institution_summary(parties, pairs, sets, errors), "csv"),
        "event_log": (identity.event_log(parties, sets), "parquet"),
    }
    paths = {}
    for name, (table, suffix) in tables.items():
        paths[name] = f"{output_dir.rstrip('/')}/institution_{name}.{suffix}"
        write_tabular(table, paths[name])
    return paths


def export_validation(results: DataFrame, path: str) -> None:
    """Write check results with one column per detail."""
    write_tabular(validation.results_as_columns(results), path)

