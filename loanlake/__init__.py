"""Monthly mortgage snapshots on Spark: import, validation and analysis.

Every operator takes DataFrames and returns lazy DataFrames.
"""

from .operators.activity import (
    lender_activity,
    lender_panel,
    loan_characteristics,
    sponsor_activity,
)
from .operators.concentration import hhi_cells, lender_hhi
from .operators.counties import add_county_fips, build_county_crosswalk, standardize_counties
from .operators.geography import (
    county_loan_counts,
    county_metrics,
    metro_metrics,
    state_loan_counts,
)
from .operators.identity import (
    event_log,
    id_spaces,
    institution_crosswalk,
    lender_name_crosswalk,
    mapping_errors,
    name_transitions,
    oscillations,
    timeline,
)
from .operators.network import bipartite_graph, centrality, edges, projections
from .operators.trends import fixed_rate_share, refinance_share, trend_tables
from .operators.validation import run_checks, run_critical, verdict
from .plans.import_snapshots import convert_snapshots, run_import, save_silver, update_silver
from .plans.reports import exploratory_tables, institution_report, network_tables
from .sources.snapshots import read_bronze, read_silver

__all__ = [
    "add_county_fips",
    "bipartite_graph",
    "build_county_crosswalk",
    "centrality",
    "convert_snapshots",
    "county_loan_counts",
    "county_metrics",
    "edges",
    "event_log",
    "exploratory_tables",
    "fixed_rate_share",
    "hhi_cells",
    "id_spaces",
    "institution_crosswalk",
    "institution_report",
    "lender_activity",
    "lender_hhi",
    "lender_name_crosswalk",
    "lender_panel",
    "loan_characteristics",
    "mapping_errors",
    "metro_metrics",
    "name_transitions",
    "network_tables",
    "oscillations",
    "projections",
    "read_bronze",
    "read_silver",
    "refinance_share",
    "run_checks",
    "run_critical",
    "run_import",
    "save_silver",
    "sponsor_activity",
    "standardize_counties",
    "state_loan_counts",
    "timeline",
    "trend_tables",
    "update_silver",
    "verdict",
]
