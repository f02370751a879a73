"""The named queries in SQL, written independently of the Spark operators."""

from ..sources import star_raw
from ..sources.star_loans import LOANS_SQL, REVERSE_SQL

SQL = {}

_LOANS = f"WITH loans AS ({LOANS_SQL})"


def define(name: str, body: str) -> None:
    """``body`` may select from ``loans`` and may start with further CTEs."""
    body = body.strip()
    if body.startswith("WITH RECURSIVE "):
        SQL[name] = f"WITH RECURSIVE {_LOANS[5:]}, {body[15:]}"
    elif body.startswith("WITH "):
        SQL[name] = f"{_LOANS}, {body[5:]}"
    else:
        SQL[name] = f"{_LOANS} {body}"


def statements() -> dict[str, str]:
    return dict(SQL)


def _nearest(q: float) -> str:
    return (
        f'list_sort(list("Interest Rate"))'
        f'[cast(round((count("Interest Rate") - 1) * {q}) AS int) + 1]'
    )


# --- activity ----------------------------------------------------------------
for _name, _col in (("lender_volume", "Originating Mortgagee"), ("sponsor_volume", "Sponsor Name")):
    define(
        _name,
        f"""
        SELECT "{_col}", count("FHA_Index") AS "Loan Count",
               cast(sum("Mortgage Amount") AS bigint) AS "Total Volume",
               round(sum("Mortgage Amount") / count("FHA_Index"), 6) AS "Average Loan Size"
        FROM loans {'WHERE "Sponsor Name" IS NOT NULL' if _name == "sponsor_volume" else ""}
        GROUP BY 1 ORDER BY "Loan Count" DESC, 1 NULLS FIRST LIMIT 20""",
    )

define(
    "yearly_lenders",
    """
    SELECT "Year", count(DISTINCT coalesce("Originating Mortgagee", chr(1))) AS "Active Lenders",
           count("FHA_Index") AS "Total Loans",
           round(cast(count("FHA_Index") AS double)
                 / count(DISTINCT coalesce("Originating Mortgagee", chr(1))), 10) AS "Avg Loans per Lender"
    FROM loans GROUP BY 1""",
)
define(
    "yearly_sponsors",
    """
    SELECT "Year", count(DISTINCT "Sponsor Name") AS "Active Sponsors", count("FHA_Index") AS "Sponsored Loans"
    FROM loans WHERE "Sponsor Name" IS NOT NULL GROUP BY 1""",
)
define(
    "estimated_names",
    """
    SELECT "Year", 'Active Lenders' AS what, count(DISTINCT coalesce("Originating Mortgagee", chr(1))) AS names,
      true AS within_bound FROM loans GROUP BY 1
    UNION ALL SELECT "Year", 'Active Sponsors', count(DISTINCT "Sponsor Name"), true FROM loans
    WHERE "Sponsor Name" IS NOT NULL GROUP BY 1""",
)
for _freq in ("annual", "quarterly"):
    _q = ', cast(floor(("Month" - 1) / 3) + 1 AS tinyint) AS "Quarter"' if _freq == "quarterly" else ""
    define(
        f"lender_panel_{_freq}",
        f"""
        SELECT "Year"{_q}, "Originating Mortgagee Number", "Originating Mortgagee",
          count(*) AS loan_count, cast(sum("Mortgage Amount") AS bigint) AS total_mortgage_amount,
          round(avg("Interest Rate"), 10) AS avg_interest_rate,
          count(*) FILTER (lower("Loan Purpose") = 'purchase') AS purchase_loan_count,
          count(*) FILTER (lower("Loan Purpose") LIKE 'refi%') AS refinance_loan_count,
          round(sum("Mortgage Amount") / count(*), 6) AS avg_mortgage_amount,
          round(count(*) FILTER (lower("Loan Purpose") = 'purchase') / cast(count(*) AS double), 10) AS purchase_share,
          round(count(*) FILTER (lower("Loan Purpose") LIKE 'refi%') / cast(count(*) AS double), 10) AS refinance_share,
          '{_freq}' AS frequency
        FROM loans GROUP BY ALL""",
    )
for _name, _col in (("loan_purpose", "Loan Purpose"), ("down_payment", "Down Payment Source")):
    define(
        _name,
        f"""
        SELECT "{_col}", count(*) AS loan_count,
               round(count(*) / cast((SELECT count(*) FROM loans) AS double), 10) AS share
        FROM loans GROUP BY 1""",
    )
define(
    "yearly_loan_size",
    """
    SELECT "Year", round(avg("Mortgage Amount"), 6) AS mean_loan_size,
           round(median("Mortgage Amount"), 6) AS median_loan_size,
           cast(sum("Mortgage Amount") AS bigint) AS total_volume
    FROM loans GROUP BY 1""",
)
define(
    "market_share",
    """
    SELECT "Year", "Originating Mortgagee", count(*) AS loans,
           round(count(*) / cast(sum(count(*)) OVER (PARTITION BY "Year") AS double), 10) AS share
    FROM loans GROUP BY 1, 2""",
)
define(
    "yearly_hhi",
    """
    WITH counts AS (SELECT "Year", count(*) AS n FROM loans GROUP BY "Year", "Originating Mortgagee")
    SELECT "Year", round(sum(n * n) / (cast(sum(n) AS double) * sum(n)), 10) AS "HHI" FROM counts GROUP BY 1""",
)
define(
    "state_stats",
    """
    SELECT "Property State", count(*) AS loan_count, round(avg("Mortgage Amount"), 6) AS avg_loan_size,
           round(avg("Interest Rate"), 10) AS avg_rate,
           count(DISTINCT coalesce("Originating Mortgagee", chr(1))) AS unique_lenders
    FROM loans GROUP BY 1""",
)
define(
    "monthly_stats",
    """
    SELECT "Year", "Month", count(*) AS loan_count, round(avg("Mortgage Amount"), 6) AS avg_amount,
           round(avg("Interest Rate"), 10) AS avg_rate
    FROM loans GROUP BY 1, 2""",
)
define(
    "state_year_counts",
    """SELECT "Property State", count("FHA_Index") AS loan_count FROM loans WHERE "Year" = 1998 GROUP BY 1""",
)
define(
    "state_lenders",
    """
    SELECT "Originating Mortgagee", count(*) AS loan_count FROM loans
    WHERE "Year" >= 1998 AND "Property State" = 'NATION_7' GROUP BY 1""",
)
define("value_counts", """SELECT "Property Type", count(*) AS count FROM loans GROUP BY 1""")

# --- trends ------------------------------------------------------------------
define(
    "refinance_share",
    """
    SELECT "Date", count(*) FILTER (lower("Loan Purpose") LIKE '%purchase%') AS purchase_loan_count,
      count(*) FILTER (lower("Loan Purpose") LIKE '%refi%') AS refinance_loan_count,
      round(count(*) FILTER (lower("Loan Purpose") LIKE '%refi%') / cast(nullif(count(*) FILTER (
        lower("Loan Purpose") LIKE '%purchase%' OR lower("Loan Purpose") LIKE '%refi%'), 0) AS double), 10)
        AS refinance_share
    FROM loans GROUP BY 1""",
)
define(
    "fixed_rate_share",
    """
    SELECT "Date", count(*) FILTER (lower("Product Type") LIKE '%fixed%') AS fixed_rate_count,
      count(*) FILTER (lower("Product Type") LIKE '%adjustable%') AS adjustable_rate_count,
      round(avg("Interest Rate") FILTER (lower("Product Type") LIKE '%fixed%'), 10) AS fixed_rate_average,
      round(avg("Interest Rate") FILTER (lower("Product Type") LIKE '%adjustable%'), 10) AS adjustable_rate_average,
      round(count(*) FILTER (lower("Product Type") LIKE '%adjustable%') / cast(nullif(count(*) FILTER (
        lower("Product Type") LIKE '%fixed%' OR lower("Product Type") LIKE '%adjustable%'), 0) AS double), 10)
        AS adjustable_rate_share
    FROM loans GROUP BY 1""",
)
define(
    "active_lenders",
    """SELECT "Date", count(DISTINCT coalesce("Originating Mortgagee", chr(1))) AS "Active Lenders"
    FROM loans GROUP BY 1""",
)
define(
    "loan_size_trend",
    """
    WITH m AS (SELECT "Date", avg("Mortgage Amount") AS mean, median("Mortgage Amount") AS med
               FROM loans GROUP BY 1)
    SELECT "Date", 'mean' AS "Statistic", round(mean, 6) AS "Average Loan Amount" FROM m
    UNION ALL SELECT "Date", 'median', round(med, 6) FROM m""",
)
define(
    "purpose_trend",
    """
    SELECT "Date", CASE WHEN "Loan Purpose" LIKE '%Purchase%' THEN 'Purchase' ELSE 'Refinance' END AS loan_category,
           count(*) AS loan_count
    FROM loans GROUP BY 1, 2""",
)
define(
    "down_payment_share",
    """
    SELECT "Date", round(count(*) FILTER ("Down Payment Source" = 'Borrower') / cast(count("Date") AS double), 10)
             AS "BorrowerFundedShare"
    FROM loans GROUP BY 1""",
)
for _name, _expr, _out in (
    ("rates_by_product", '"Product Type"', "Product Type"),
    (
        "rates_by_property",
        """CASE WHEN "Property Type" NOT LIKE '%Single%' THEN 'Non single family' ELSE "Property Type" END""",
        "Property Type",
    ),
    ("rates_by_purpose", '"Loan Purpose"', "Loan Purpose"),
):
    define(
        _name,
        f"""
        WITH b AS (SELECT "Date", {_expr} AS bucket, "Interest Rate" AS r, "Mortgage Amount" AS a FROM loans)
        SELECT DISTINCT "Date", bucket AS "{_out}",
               round(avg(r) OVER (PARTITION BY "Date", bucket), 10) AS "AverageRate",
               round(avg(a) OVER (PARTITION BY "Date", bucket), 6) AS "AverageSize"
        FROM b""",
    )
define(
    "top_lender_groups",
    """
    WITH ranked AS (
      SELECT "Date" AS d, "Originating Mortgagee" AS o,
             row_number() OVER (PARTITION BY "Date" ORDER BY count(*) DESC, "Originating Mortgagee" NULLS FIRST) AS rk
      FROM loans GROUP BY 1, 2)
    SELECT "Date", CASE WHEN rk <= 20 THEN 'Top 20 Lenders' WHEN rk > 20 THEN 'Other Lenders' END AS lender_group,
           round(avg("Interest Rate"), 10) AS avg_interest_rate, round(avg("Mortgage Amount"), 6) AS avg_loan_size
    FROM loans LEFT JOIN ranked ON d = "Date" AND o = "Originating Mortgagee" GROUP BY 1, 2""",
)
_CATEGORIES = " UNION ALL ".join(
    f"""SELECT "Date", '{c}' AS variable, "{c}" AS category FROM loans"""
    for c in ("Down Payment Source", "Property Type", "Product Type", "Loan Purpose")
)
define(
    "category_counts",
    f"""
    WITH long AS ({_CATEGORIES})
    SELECT "Date", variable, category, count(*) AS "Count" FROM long
    WHERE "Date" IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2, 3""",
)
define(
    "category_share",
    f"""
    WITH long AS ({_CATEGORIES}),
    counts AS (SELECT "Date", variable, category, count(*) AS n FROM long
               WHERE "Date" IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2, 3),
    totals AS (SELECT "Date" AS d, variable AS v, sum(n) AS total FROM counts GROUP BY 1, 2)
    SELECT "Date", variable, category, round(n / cast(total AS double), 10) AS "Proportion"
    FROM counts JOIN totals ON d = "Date" AND v = variable""",
)

# --- geography ---------------------------------------------------------------
_SUMMARY = f"""count(*) AS loan_count, round(median("Mortgage Amount"), 6) AS median_mortgage_amount,
  round(avg("Mortgage Amount"), 6) AS avg_mortgage_amount,
  cast(coalesce(sum("Mortgage Amount"), 0) AS bigint) AS total_mortgage_amount,
  round(avg("Interest Rate"), 10) AS avg_interest_rate,
  round(stddev_samp("Interest Rate"), 6) AS interest_rate_std,
  round({_nearest(0.75)} - {_nearest(0.25)}, 6) AS interest_rate_iqr"""
_METROS = """
  SELECT lpad(cast(n_nationkey * 1000 + b AS varchar), 5, '0') AS county_code,
         lpad(cast(n_nationkey * 10 + b % 3 AS varchar), 5, '0') AS "CBSA Code",
         n_name || ' Metro ' || cast(b % 3 AS varchar) AS "CBSA Title"
  FROM (SELECT DISTINCT cast(substr(p_brand, 7) AS int) AS b FROM part) JOIN nation ON n_nationkey BETWEEN 0 AND 24
  WHERE b % 3 <> 0"""
for _freq, _suffix in (("annual", ""), ("quarterly", "_quarterly")):
    _q = ', cast(floor(("Month" - 1) / 3) + 1 AS tinyint) AS "Quarter"' if _suffix else ""
    define(
        f"county_metrics{_suffix}",
        f"""
        SELECT "Year"{_q}, "Property State", "Property County", "FIPS", {_SUMMARY}, '{_freq}' AS frequency
        FROM loans GROUP BY ALL""",
    )
    define(
        f"metro_metrics{_suffix}",
        f"""
        WITH metros AS ({_METROS})
        SELECT "Year"{_q}, "CBSA Code", "CBSA Title", {_SUMMARY}, '{_freq}' AS frequency
        FROM loans LEFT JOIN metros ON county_code = "FIPS" GROUP BY ALL""",
    )
for _y, _suffix in (("", ""), ('"Year", ', "_yearly")):
    define(
        f"state_counts{_suffix}",
        f"""SELECT {_y}upper("Property State") AS state, count(*) AS loan_count FROM loans GROUP BY ALL""",
    )
    define(
        f"county_counts{_suffix}",
        f"""
        SELECT {_y}lpad(trim("FIPS"), 5, '0') AS fips, count(*) AS loan_count,
               min("Property State") AS state, min("Property County") AS county
        FROM loans GROUP BY ALL""",
    )

# --- concentration -----------------------------------------------------------
_TIME = {
    "month": {"year": '"Year"', "month": '"Month"'},
    "quarter": {"year": '"Year"', "quarter": 'cast(floor(("Month" - 1) / 3) + 1 AS tinyint)'},
    "year": {"year": '"Year"'},
    "all": {},
}
_PLACE = {
    "state": {"state": 'trim("Property State")'},
    "county": {"state": 'trim("Property State")', "county": 'trim("Property County")'},
    "all": {},
}
_LENDER = {
    "sponsor": 'cast(coalesce("Sponsor Number", "Originating Mortgagee Number") AS varchar)',
    "originator": 'cast("Originating Mortgagee Number" AS varchar)',
}


def _hhi(time: str, place: str, lender: str, keep_missing: bool = False) -> str:
    cell = {**_TIME[time], **_PLACE[place]}
    select = "".join(f"{e} AS {c}, " for c, e in cell.items())
    names = "".join(f"{c}, " for c in cell)
    where = " AND ".join(
        [f"{e} IS NOT NULL" for e in cell.values()]
        + [f"{e} <> ''" for c, e in cell.items() if c in ("state", "county")]
        + [f"{_LENDER[lender]} IS NOT NULL"]
    )
    # Integer sums divided once: sum(share^2) without the noise of many divisions.
    index = "sum(n * n) / (cast(sum(n) AS double) * sum(n))"
    return f"""
    WITH counts AS (SELECT {select}{_LENDER[lender]} AS lender_id, count(*) AS n
                    FROM loans {"" if keep_missing else "WHERE " + where} GROUP BY ALL)
    SELECT {names}round({index}, 10) AS hhi_normalized, cast(sum(n) AS bigint) AS total_loans,
           count(*) AS num_lenders, round({index} * 10000, 6) AS hhi, '{lender}' AS lender_type
    FROM counts GROUP BY ALL"""


for _t in _TIME:
    for _g in _PLACE:
        for _l in _LENDER:
            define(f"hhi_{_t}_{_g}_{_l}", _hhi(_t, _g, _l))
define("hhi_keep_missing", _hhi("year", "state", "originator", keep_missing=True))


def _all_cells() -> str:
    ctes, selects = [], []
    for t in _TIME:
        for g in _PLACE:
            for lender in _LENDER:
                name = f"c_{t}_{g}_{lender}"
                body = _hhi(t, g, lender).strip()[5:]
                ctes.append(f"{name} AS (WITH {body})")
                cell = {**_TIME[t], **_PLACE[g]}
                dims = ", ".join(
                    f"{c if c in cell else 'NULL'} AS {c}" for c in ("year", "quarter", "month", "state", "county")
                )
                selects.append(
                    f"SELECT '{t}' AS time_level, '{g}' AS geography_level, lender_type, {dims}, "
                    f"hhi_normalized, total_loans, num_lenders, hhi FROM {name}"
                )
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(selects)}"


define("hhi_cells", _all_cells())

# --- identity ----------------------------------------------------------------
_O, _ON = '"Originating Mortgagee"', '"Originating Mortgagee Number"'
_S, _SN = '"Sponsor Name"', '"Sponsor Number"'
_PERIOD = """cast("Year" AS varchar) || '-' || lpad(cast("Month" AS varchar), 2, '0')"""
_PAIRS = f"""pairs AS (
  SELECT DISTINCT * FROM (
    SELECT trim(cast({_ON} AS varchar)) AS institution_number, trim({_O}) AS institution_name,
           'Originator' AS type, make_date("Year", "Month", 1) AS d FROM loans
    UNION ALL SELECT trim(cast({_SN} AS varchar)), trim({_S}), 'Sponsor', make_date("Year", "Month", 1) FROM loans)
  WHERE institution_number <> '' AND institution_name <> '')"""

define(
    "institution_crosswalk",
    f"""
    WITH {_PAIRS}
    SELECT institution_number, institution_name, type, min(d) AS first_date, max(d) AS last_date,
           count(DISTINCT d) AS num_months
    FROM pairs GROUP BY 1, 2, 3""",
)
define(
    "lender_crosswalk",
    f"""
    WITH reverse AS ({REVERSE_SQL}),
    files AS (SELECT {_ON} AS a, {_O} AS b, {_SN} AS c, {_S} AS e, "Date" AS d FROM loans
                WHERE "Date" <> DATE '1998-08-01'
              UNION ALL SELECT {_ON}, {_O}, {_SN}, {_S}, "Date" FROM reverse),
    seen AS (SELECT a AS n, b AS name, d FROM files UNION SELECT c, e, d FROM files),
    spans AS (SELECT cast(n AS bigint) AS "Institution_Number", name AS "Institution_Name",
                     min(d) AS "First_Observed", max(d) AS "Last_Observed"
              FROM seen WHERE n IS NOT NULL AND name IS NOT NULL AND d IS NOT NULL GROUP BY 1, 2),
    flags AS (SELECT "Institution_Number" AS k, count(DISTINCT "Institution_Name") AS names FROM spans GROUP BY 1)
    SELECT spans.*, strftime("First_Observed", '%Y-%m') AS "First_Observed_Period",
           strftime("Last_Observed", '%Y-%m') AS "Last_Observed_Period",
           names AS "Distinct_Name_Count", names > 1 AS "Has_Name_Conflict"
    FROM spans JOIN flags ON k = "Institution_Number" """,
)
_CANONICAL = f"""canonical AS (
  SELECT sponsor, name FROM (
    SELECT {_SN} AS sponsor, {_S} AS name, row_number() OVER (PARTITION BY {_SN} ORDER BY count(*) DESC, {_S}) AS rk
    FROM loans WHERE {_SN} IS NOT NULL AND {_S} IS NOT NULL GROUP BY 1, 2) WHERE rk = 1)"""
define(
    "canonical_names",
    f"""WITH {_CANONICAL} SELECT sponsor AS "Sponsor Number", name AS canonical_name FROM canonical""",
)
define(
    "id_spaces",
    f"""
    WITH shared_names AS (SELECT {_O} AS x FROM loans INTERSECT SELECT {_S} FROM loans WHERE {_S} IS NOT NULL),
    shared_ids AS (SELECT {_ON} AS x FROM loans INTERSECT SELECT {_SN} FROM loans WHERE {_SN} IS NOT NULL)
    SELECT count(DISTINCT {_O}) AS unique_originator_names, count(DISTINCT {_ON}) AS unique_originator_ids,
      count(DISTINCT {_S}) AS unique_sponsor_names, count(DISTINCT {_SN}) AS unique_sponsor_ids,
      (SELECT count(*) FROM shared_names) AS overlapping_names, (SELECT count(*) FROM shared_ids) AS overlapping_ids,
      (SELECT coalesce(string_agg(x, '|' ORDER BY x), '') FROM (SELECT x FROM shared_names ORDER BY x LIMIT 10))
        AS sample_overlapping_names,
      (SELECT coalesce(string_agg(cast(x AS varchar), '|' ORDER BY x), '')
       FROM (SELECT x FROM shared_ids ORDER BY x LIMIT 10)) AS sample_overlapping_ids
    FROM loans""",
)
_CONFLICTS = """
  SELECT institution_number, strftime(d, '%Y-%m') AS date,
         string_agg(DISTINCT institution_name, ',' ORDER BY institution_name) AS names,
         'Multiple names for same number in one month' AS issue
  FROM pairs GROUP BY institution_number, d HAVING count(DISTINCT institution_name) > 1"""
_RENAMES = """
  SELECT institution_number, strftime(d, '%Y-%m') AS date,
         prev || ' -> ' || institution_name || ' -> ' || prev AS names,
         'Temporary name change (oscillation)' AS issue
  FROM (SELECT *, row_number() OVER (PARTITION BY institution_number ORDER BY rn) AS k
        FROM ordered o
        WHERE prev <> institution_name AND EXISTS (
          SELECT 1 FROM ordered l WHERE l.institution_number = o.institution_number
            AND l.institution_name = o.prev AND l.rn > o.rn))
  WHERE k = 1"""
_ORDERED = """ordered AS (
  SELECT *, row_number() OVER w AS rn, lag(institution_name) OVER w AS prev FROM pairs
  WINDOW w AS (PARTITION BY institution_number ORDER BY d, institution_name, type))"""
define("month_conflicts", f"WITH {_PAIRS} {_CONFLICTS}")
define("temporary_renames", f"WITH {_PAIRS}, {_ORDERED} {_RENAMES}")
define("mapping_errors", f"WITH {_PAIRS}, {_ORDERED} {_CONFLICTS} UNION ALL {_RENAMES}")


def _runs(id_col: str, value_col: str, prefix: str = "") -> str:
    """CTEs ``{prefix}sets`` (id, period, value list) and ``{prefix}runs`` (one row per run)."""
    return f"""{prefix}sets AS (
      SELECT {id_col} AS id, {_PERIOD} AS period,
             coalesce(list_sort(list(DISTINCT {value_col}) FILTER ({value_col} IS NOT NULL)), []) AS value,
             count(*) AS records
      FROM loans WHERE {id_col} IS NOT NULL GROUP BY 1, 2),
    {prefix}marked AS (
      SELECT *, CASE WHEN lag(value) OVER (PARTITION BY id ORDER BY period) = value THEN 0 ELSE 1 END AS st
      FROM {prefix}sets),
    {prefix}numbered AS (
      SELECT *, cast(sum(st) OVER (PARTITION BY id ORDER BY period ROWS UNBOUNDED PRECEDING) AS int) AS segment
      FROM {prefix}marked),
    {prefix}runs AS (
      SELECT id, segment, any_value(value) AS value, min(period) AS start_period, max(period) AS end_period,
             cast(count(*) AS int) AS months, cast(sum(records) AS bigint) AS records,
             string_agg(period, ',' ORDER BY period) AS periods
      FROM {prefix}numbered GROUP BY 1, 2),
    {prefix}paired AS (
      SELECT *, lag(value) OVER w AS p_value, lag(start_period) OVER w AS p_start, lag(end_period) OVER w AS p_end,
             lag(months) OVER w AS p_months, lag(records) OVER w AS p_records, lag(periods) OVER w AS p_periods
      FROM {prefix}runs WINDOW w AS (PARTITION BY id ORDER BY segment))"""


for _name, _i, _n in (("originator", _ON, _O), ("sponsor", _SN, _S)):
    define(
        f"segments_{_name}",
        f"""
        WITH {_runs(_i, _n)}
        SELECT id, segment, array_to_string(value, '|') AS value, start_period, end_period,
               months AS duration_months, records AS total_records
        FROM runs""",
    )


def _name_events(entity: str, prefix: str) -> str:
    return f"""
    SELECT '{entity}' AS entity_type, CASE WHEN segment = 1 THEN 'appearance' ELSE 'rename' END AS event_type,
      cast(id AS varchar) AS institution_number, start_period AS effective_period,
      coalesce(array_to_string(p_value, '|'), '') AS previous_names, array_to_string(value, '|') AS new_names,
      p_start AS previous_start_period, p_end AS previous_end_period,
      start_period AS new_start_period, end_period AS new_end_period,
      coalesce(p_months, 0) AS previous_duration_months, months AS new_duration_months,
      coalesce(p_records, 0) AS previous_observation_count, records AS new_observation_count,
      CASE WHEN segment = 1 THEN 'segment_periods=' || periods
           ELSE 'new_segment_periods=' || periods || ';previous_segment_periods=' || p_periods END AS metadata
    FROM {prefix}paired
    UNION ALL
    SELECT '{entity}', 'ambiguous_identity', cast(id AS varchar), period, array_to_string(value, '|'),
      array_to_string(value, '|'), NULL, NULL, period, period, 0, 1, 0, records,
      'observed_names=' || array_to_string(value, ',')
    FROM {prefix}sets WHERE len(value) > 1"""


def _ownership_events(prefix: str) -> str:
    def names(value: str, sep: str) -> str:
        return (
            f"(SELECT coalesce(string_agg(name, '{sep}' ORDER BY sponsor), '') FROM canonical "
            f"WHERE list_contains({value}, sponsor))"
        )

    def numbers(value: str) -> str:
        return f"array_to_string({value}, ',')"

    return f"""
    SELECT 'Originator' AS entity_type, 'ownership_transition' AS event_type,
      cast(id AS varchar) AS institution_number, start_period AS effective_period,
      {names("p_value", "|")} AS previous_names, {names("value", "|")} AS new_names,
      p_start AS previous_start_period, p_end AS previous_end_period,
      start_period AS new_start_period, end_period AS new_end_period,
      p_months AS previous_duration_months, months AS new_duration_months,
      p_records AS previous_observation_count, records AS new_observation_count,
      'new_segment_periods=' || periods || ';new_sponsor_numbers=' || {numbers("value")}
        || ';previous_segment_periods=' || p_periods || ';previous_sponsor_numbers=' || {numbers("p_value")} AS metadata
    FROM {prefix}paired WHERE segment > 1
    UNION ALL
    SELECT 'Originator', 'multiple_sponsors_in_period', cast(id AS varchar), period, '', {names("value", "|")},
      NULL, NULL, period, period, 0, 1, 0, records,
      'observed_sponsor_names=' || {names("value", ",")} || ';sponsor_numbers=' || {numbers("value")}
    FROM {prefix}sets WHERE len(value) > 1"""


define("name_events_originator", f"WITH {_runs(_ON, _O)} {_name_events('Originator', '')}")
define("name_events_sponsor", f"WITH {_runs(_SN, _S)} {_name_events('Sponsor', '')}")
define("ownership_events", f"WITH {_CANONICAL}, {_runs(_ON, _SN)} {_ownership_events('')}")
define(
    "event_log",
    f"""WITH {_CANONICAL}, {_runs(_ON, _O, "o_")}, {_runs(_SN, _S, "s_")}, {_runs(_ON, _SN, "w_")}
    {_name_events("Originator", "o_")} UNION ALL {_name_events("Sponsor", "s_")}
    UNION ALL {_ownership_events("w_")}""",
)
define(
    "timeline",
    f"""
    WITH {_runs(_ON, _O)}
    SELECT period, array_to_string(value, '|') AS names, records AS loan_count FROM marked WHERE id = 5 AND st = 1""",
)


def _oscillations(i: str, n: str) -> str:
    return f"""{_runs(i, n)},
    long_runs AS (SELECT * FROM runs WHERE id IN (SELECT id FROM runs GROUP BY id HAVING max(segment) >= 3)),
    named AS (SELECT id, segment, start_period, unnest(value) AS name FROM long_runs),
    repeated AS (SELECT id, name, min(segment) AS fs, list_sort(list(start_period)) AS periods
                 FROM named GROUP BY 1, 2 HAVING count(*) >= 2),
    firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fs, name) AS k FROM repeated)
               WHERE k = 1),
    gaps AS (
      SELECT id, name, min(a) AS a, arg_min(b, a) AS b FROM (
        SELECT id, name, segment AS a, lead(segment) OVER (PARTITION BY id, name ORDER BY segment) AS b FROM named)
      WHERE b - a > 1 GROUP BY 1, 2),
    found AS (
      SELECT f.id, f.name AS oscillating_name, any_value(periods) AS periods,
             list_sort(list(DISTINCT m.name)) AS intermediate_names
      FROM firsts f JOIN gaps g ON g.id = f.id AND g.name = f.name
      JOIN named m ON m.id = f.id AND m.segment > a AND m.segment < b GROUP BY 1, 2)"""


for _name, _i, _n in (("oscillations", _ON, _O), ("oscillations_sponsor", _SN, _S)):
    define(
        _name,
        f"""
        WITH {_oscillations(_i, _n)}
        SELECT id, oscillating_name, array_to_string(periods, '|') AS periods,
               array_to_string(intermediate_names, '|') AS intermediate_names
        FROM found""",
    )

# The fold over an ID's months: position k looks at the names recorded so far.
_TRANSITIONS = f"""month_sets AS (
      SELECT {_ON} AS id, {_PERIOD} AS period,
             coalesce(list_sort(list(DISTINCT {_O}) FILTER ({_O} IS NOT NULL)), []) AS value
      FROM loans WHERE {_ON} IS NOT NULL GROUP BY 1, 2),
    steps AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY period) AS k FROM month_sets),
    fold AS (
      SELECT id, k, period, value, len(value) > 1 AS kept, cast([] AS varchar[]) AS seen_before,
             CASE WHEN len(value) > 1 THEN value ELSE [] END AS seen,
             CASE WHEN len(value) > 1 THEN value END AS last_value
      FROM steps WHERE k = 1
      UNION ALL
      SELECT s.id, s.k, s.period, s.value, q.keep, f.seen,
             CASE WHEN q.keep THEN list_concat(f.seen, s.value) ELSE f.seen END,
             CASE WHEN q.keep THEN s.value ELSE f.last_value END
      FROM fold f JOIN steps s ON s.id = f.id AND s.k = f.k + 1,
      LATERAL (SELECT (len(s.value) > 1 OR (f.last_value IS NOT NULL AND len(s.value) > 0
                       AND NOT list_contains(f.seen, s.value[1])))
                      AND f.last_value IS DISTINCT FROM s.value AS keep) q),
    recorded AS (SELECT id, period, value, row_number() OVER (PARTITION BY id ORDER BY k) AS change FROM fold WHERE kept)"""
define(
    "name_transitions",
    f"""WITH RECURSIVE {_TRANSITIONS}
    SELECT id, cast(change AS int) AS change, period, array_to_string(value, '|') AS names FROM recorded""",
)
define(
    "name_change_summary",
    f"""WITH RECURSIVE {_TRANSITIONS}
    SELECT id, count(DISTINCT change) AS changes, string_agg(DISTINCT name, '|' ORDER BY name) AS names
    FROM (SELECT id, change, unnest(value) AS name FROM recorded) GROUP BY 1""",
)

# --- network -----------------------------------------------------------------


def _edges(where: str = "", having: str = "") -> str:
    return f"""edges AS (
      SELECT coalesce(cast({_ON} AS varchar), 'originator:' || {_O}) AS originator_key, {_O}, {_ON},
             coalesce(cast({_SN} AS varchar), 'sponsor:' || {_S}) AS sponsor_key, {_S}, {_SN},
             count(*) AS loan_count, cast(sum("Mortgage Amount") AS bigint) AS total_volume,
             round(avg("Mortgage Amount"), 6) AS avg_loan_amount,
             round(median("Mortgage Amount"), 6) AS median_loan_amount,
             min("Year") AS first_year, max("Year") AS last_year
      FROM loans WHERE {_S} IS NOT NULL AND {_O} IS NOT NULL {where} GROUP BY 1, 2, 3, 4, 5, 6 {having})"""


_GRAPH = f"""{_edges()},
    links AS (SELECT originator_key AS o, sponsor_key AS s, cast(sum(loan_count) AS double) AS w,
                     sum(loan_count) AS n, sum(total_volume) AS volume, min(first_year) AS fy, max(last_year) AS ly,
                     arg_max(median_loan_amount, (loan_count, total_volume, {_O}, {_S})) AS med
              FROM edges GROUP BY 1, 2),
    ends AS (SELECT 'originator' AS side, originator_key AS key, {_O} AS label, {_ON} AS entity_id, loan_count FROM edges
             UNION ALL SELECT 'sponsor', sponsor_key, {_S}, {_SN}, loan_count FROM edges),
    vertices AS (
      SELECT side, key, label, max(entity_id) OVER (PARTITION BY side, key) AS entity_id, rk FROM (
        SELECT side, key, label, max(entity_id) AS entity_id,
               row_number() OVER (PARTITION BY side, key ORDER BY sum(loan_count) DESC, label) AS rk
        FROM ends GROUP BY 1, 2, 3) QUALIFY rk = 1),
    degrees AS (SELECT 'originator' AS side, o AS key, count(*) AS degree, sum(w) AS weighted_degree FROM links GROUP BY o
                UNION ALL SELECT 'sponsor', s, count(*), sum(w) FROM links GROUP BY s),
    ranked AS (
      SELECT *, round(degree / cast((SELECT count(*) FROM vertices x WHERE x.side <> v.side) AS double), 10) AS dc
      FROM vertices v JOIN degrees USING (side, key))"""
define("edges", f"WITH {_edges()} SELECT * FROM edges")
define(
    "edges_filtered",
    f"""WITH {_edges('AND "Year" BETWEEN 1996 AND 1999', "HAVING count(*) >= 3")} SELECT * FROM edges""",
)
define(
    "top_relationships",
    f"""WITH {_edges()} SELECT * FROM edges ORDER BY loan_count DESC, total_volume DESC, originator_key, 2, 3,
    sponsor_key, 5, 6 LIMIT 10""",
)
define(
    "edge_totals",
    f"""WITH {_GRAPH}, sizes AS (
      SELECT count(*) FILTER (side = 'originator') AS o, count(*) FILTER (side = 'sponsor') AS s FROM vertices)
    SELECT (SELECT count(*) FROM edges) AS edge_count, (SELECT count(*) FROM links) AS pair_count,
      (SELECT cast(sum(loan_count) AS bigint) FROM edges) AS total_loans,
      (SELECT cast(sum(total_volume) AS bigint) FROM edges) AS total_volume,
      o AS originator_nodes, s AS sponsor_nodes,
      round((SELECT count(*) FROM links) * 2 / cast((o + s) * (o + s - 1) AS double), 6) AS density
    FROM sizes""",
)
define("graph_vertices", f"WITH {_GRAPH} SELECT side, key, label, cast(entity_id AS bigint) AS entity_id FROM vertices")
define(
    "graph_edges",
    f"""WITH {_GRAPH}
    SELECT o AS originator_key, s AS sponsor_key, cast(n AS bigint) AS loan_count, cast(volume AS bigint) AS total_volume,
           round(volume / cast(n AS double), 6) AS avg_loan_amount, med AS median_loan_amount,
           fy AS first_year, ly AS last_year, w AS weight FROM links""",
)
define(
    "degrees",
    f"""WITH {_GRAPH} SELECT side || ':' || key AS node, degree, weighted_degree FROM degrees""",
)
define(
    "degree_centrality",
    f"""WITH {_GRAPH}
    SELECT side || ':' || key AS node, side, key, label, cast(entity_id AS bigint) AS entity_id, degree, weighted_degree,
           round(dc, 6) AS degree_centrality FROM ranked""",
)
for _side in ("originator", "sponsor"):
    define(
        f"centrality_{_side}s",
        f"""WITH {_GRAPH}
        SELECT key AS node, label AS {_side}_name, cast(entity_id AS bigint) AS {_side}_id, degree, weighted_degree,
               round(dc, 6) AS degree_centrality
        FROM ranked WHERE side = '{_side}'""",
    )
for _name, _u, _hub in (("originators", "o", "s"), ("sponsors", "s", "o")):
    define(
        f"projection_{_name}",
        f"""WITH {_GRAPH}
        SELECT a.{_u} AS source, b.{_u} AS target, sum((a.w + b.w) / 2) AS weight
        FROM links a JOIN links b ON a.{_hub} = b.{_hub} AND a.{_u} < b.{_u} GROUP BY 1, 2""",
    )

    define(
        f"heaviest_pairs_{_name}",
        f"""WITH {_GRAPH}
        SELECT a.{_u} AS source, b.{_u} AS target, sum((a.w + b.w) / 2) AS weight
        FROM links a JOIN links b ON a.{_hub} = b.{_hub} AND a.{_u} < b.{_u} GROUP BY 1, 2
        ORDER BY weight DESC, source, target LIMIT 25""",
    )

define(
    "betweenness",
    f"""WITH RECURSIVE {_GRAPH},
    adj AS (SELECT 'originator:' || o AS a, 'sponsor:' || s AS b, w FROM links
            UNION ALL SELECT 'sponsor:' || s, 'originator:' || o, w FROM links),
    nodes AS (SELECT DISTINCT a AS node FROM adj),
    dist(src, node, d) USING KEY (src, node) AS (
      SELECT node, node, cast(0 AS double) FROM nodes
      UNION
      SELECT n.src, n.b, n.d FROM (
        SELECT f.src, x.b, min(f.d + x.w) AS d FROM dist f JOIN adj x ON x.a = f.node GROUP BY ALL) n
      LEFT JOIN recurring.dist r ON r.src = n.src AND r.node = n.b WHERE r.d IS NULL OR n.d < r.d),
    on_path AS (
      SELECT p.src, x.a, x.b FROM adj x JOIN dist p ON p.node = x.a JOIN dist q ON q.node = x.b AND q.src = p.src
      WHERE p.d + x.w = q.d),
    forward AS (
      SELECT node AS src, node, cast(1 AS double) AS c FROM nodes
      UNION ALL
      SELECT f.src, e.b, sum(f.c) FROM forward f JOIN on_path e ON e.src = f.src AND e.a = f.node GROUP BY ALL),
    paths AS (SELECT src, node, sum(c) AS c FROM forward GROUP BY ALL),
    shares AS (
      SELECT e.src, e.a, e.b, p.c / q.c AS share FROM on_path e
      JOIN paths p ON p.src = e.src AND p.node = e.a JOIN paths q ON q.src = e.src AND q.node = e.b),
    backward AS (
      SELECT src, node, cast(1 AS double) AS v FROM paths WHERE src <> node
      UNION ALL
      SELECT f.src, e.a, sum(f.v * e.share) FROM backward f JOIN shares e ON e.src = f.src AND e.b = f.node GROUP BY ALL),
    depends AS (SELECT src, node, sum(v) - 1 AS v FROM backward WHERE src <> node GROUP BY ALL),
    size AS (SELECT count(*) AS n FROM nodes)
    SELECT nodes.node AS node, round(coalesce(sum(v), 0) / ((any_value(n) - 1) * (any_value(n) - 2)), 6) AS betweenness
    FROM nodes CROSS JOIN size LEFT JOIN depends ON depends.node = nodes.node GROUP BY ALL""",
)

for _side in ("originator", "sponsor"):
    SQL[f"centrality_full_{_side}s"] = f"""
      SELECT c.*, coalesce(b.betweenness, 0) AS betweenness FROM ({SQL[f"centrality_{_side}s"]}) c
      LEFT JOIN ({SQL["betweenness"]}) b ON b.node = '{_side}:' || c.node"""

# --- validation --------------------------------------------------------------


def _check(name: str, passed: str, details: dict[str, str], source: str, warning: bool = False) -> str:
    """SELECT of one result row; details are written as sorted ``key=value`` text."""
    text = " || ';' || ".join(
        f"'{k}=' || coalesce(cast({v} AS varchar), '')" for k, v in sorted(details.items())
    )
    return f"""SELECT '{name}' AS check_name,
      CASE WHEN {passed} THEN 'PASS' ELSE '{"WARNING" if warning else "FAIL"}' END AS status,
      {str(warning).lower()} AS is_warning, {text} AS details FROM ({source})"""


def _pct(part: str) -> str:
    return f"round(count(*) FILTER ({part}) * 100.0::double / count(*), 2)"


def _missing(label: str, column: str) -> str:
    return _check(
        label,
        "p < 5.0",
        {"missing_count": "m", "total_count": "n", "percent_missing": "p", "threshold_percent": "'5.0'"},
        f"SELECT count(*) FILTER ({column} IS NULL) AS m, count(*) AS n, {_pct(column + ' IS NULL')} AS p FROM loans",
        warning=True,
    )


_CONFLICT_SETS = f"""SELECT {_ON} AS id, "Year" AS y, "Month" AS m, list_sort(list(DISTINCT {_O})) AS names FROM loans
  WHERE {_ON} IS NOT NULL GROUP BY 1, 2, 3
  HAVING count(DISTINCT {_O}) + max(CASE WHEN {_O} IS NULL THEN 1 ELSE 0 END) > 1"""
_SEVERAL_IDS = f"""SELECT {_O} AS o, count(DISTINCT {_ON}) + max(CASE WHEN {_ON} IS NULL THEN 1 ELSE 0 END) AS ids,
    count(DISTINCT {_S}) + max(CASE WHEN {_S} IS NULL THEN 1 ELSE 0 END) AS sponsors, count(*) AS n
  FROM loans GROUP BY 1 HAVING ids > 1"""
_CHECKS = {
    "check_required_columns": _check(
        "Required Columns Present", "true", {"missing_columns": "''", "total_columns": "9"}, "SELECT 1"
    ),
    "check_fha_index_uniqueness": _check(
        "FHA_Index Uniqueness",
        "n = u",
        {"total_rows": "n", "unique_indexes": "u", "duplicates": "n - u"},
        'SELECT count(*) AS n, count(DISTINCT "FHA_Index") AS u FROM loans',
    ),
    "check_missing_originator_ids": _missing("Missing Originator IDs Below Threshold", _ON),
    "check_missing_originator_names": _missing("Missing Originator Names Below Threshold", _O),
    "check_orphaned_sponsors": _check(
        "No Orphaned Sponsors",
        "m = 0",
        {"orphaned_count": "m", "percent_of_total": "p"},
        f"""SELECT count(*) FILTER ({_ON} IS NULL AND {_SN} IS NOT NULL) AS m,
            {_pct(f"{_ON} IS NULL AND {_SN} IS NOT NULL")} AS p FROM loans""",
        warning=True,
    ),
    "check_sponsor_coverage": _check(
        "Sponsor Coverage (Informational)",
        "true",
        {"loans_with_sponsor": "m", "total_loans": "n", "percent_with_sponsor": "p"},
        f"SELECT count({_S}) AS m, count(*) AS n, {_pct(_S + ' IS NOT NULL')} AS p FROM loans",
    ),
    "check_id_name_consistency_monthly": _check(
        "ID-Name Consistency Within Months",
        "n = 0",
        {"inconsistent_periods": "n", "sample": "'[' || s || ']'"},
        f"""SELECT (SELECT count(*) FROM ({_CONFLICT_SETS})) AS n,
          (SELECT coalesce(string_agg(y || '-' || lpad(m::varchar, 2, '0') || ' ' || id || ': '
             || array_to_string(names, ', '), '; ' ORDER BY y, m, id), '')
           FROM (SELECT * FROM ({_CONFLICT_SETS}) ORDER BY y, m, id LIMIT 3)) AS s""",
    ),
    "check_overlapping_id_spaces": _check(
        "Non-overlapping ID Spaces",
        "b = 0",
        {"unique_originator_ids": "o", "unique_sponsor_ids": "s", "overlapping_ids": "b", "sample_overlapping_ids": "t"},
        f"""SELECT (SELECT count(DISTINCT {_ON}) FROM loans) AS o, (SELECT count(DISTINCT {_SN}) FROM loans) AS s,
          count(*) AS b, (SELECT string_agg(x::varchar, ', ' ORDER BY x) FROM (
            SELECT {_ON} AS x FROM loans INTERSECT SELECT {_SN} FROM loans WHERE {_SN} IS NOT NULL ORDER BY x LIMIT 10)) AS t
        FROM (SELECT {_ON} AS x FROM loans INTERSECT SELECT {_SN} FROM loans WHERE {_SN} IS NOT NULL)""",
        warning=True,
    ),
    "check_name_oscillations": _check(
        "Name Stability (No Oscillations)",
        "n = 0",
        {"oscillating_ids_count": "n", "min_changes_threshold": "3", "sample": "'[' || s || ']'"},
        """SELECT (SELECT count(*) FROM found) AS n,
          (SELECT coalesce(string_agg(id || ': ' || oscillating_name || ' / '
             || array_to_string(intermediate_names, ', '), '; ' ORDER BY id), '')
           FROM (SELECT * FROM found ORDER BY id LIMIT 5)) AS s""",
        warning=True,
    ),
    "check_originator_sponsor_relationships": _check(
        "Consistent Originator-ID Mappings",
        "n = 0",
        {"originators_with_multiple_ids": "n", "sample": "'[' || s || ']'"},
        f"""SELECT (SELECT count(*) FROM ({_SEVERAL_IDS})) AS n,
          (SELECT coalesce(string_agg(o || ': ' || ids || ' ids, ' || sponsors || ' sponsors, ' || n || ' loans', '; '
             ORDER BY n DESC, o), '')
           FROM (SELECT * FROM ({_SEVERAL_IDS}) ORDER BY n DESC, o LIMIT 5)) AS s""",
        warning=True,
    ),
    "check_date_coverage": _check(
        "Date Coverage (Informational)",
        "true",
        {
            "min_year": "a",
            "max_year": "b",
            "year_span": "b - a + 1",
            "unique_year_month_periods": "p",
            "expected_periods_if_complete": "(b - a + 1) * 12",
        },
        'SELECT min("Year")::int AS a, max("Year")::int AS b, count(DISTINCT ("Year", "Month")) AS p FROM loans',
    ),
    "check_mortgage_amounts": _check(
        "Reasonable Mortgage Amounts",
        "z = 0 AND x = 0",
        {
            "min_amount": "a::decimal(38, 2)",
            "max_amount": "b::decimal(38, 2)",
            "mean_amount": "c::decimal(38, 2)",
            "non_positive_count": "z",
            "extremely_high_count": "x",
            "total": "n",
        },
        """SELECT min("Mortgage Amount") AS a, max("Mortgage Amount") AS b, avg("Mortgage Amount") AS c,
          count(*) FILTER ("Mortgage Amount" <= 0) AS z, count(*) FILTER ("Mortgage Amount" > 10000000) AS x,
          count(*) AS n FROM loans""",
        warning=True,
    ),
}
_FOUND = _oscillations(_ON, _O)
for _name, _select in _CHECKS.items():
    define(_name, f"WITH {_FOUND} {_select}" if _name == "check_name_oscillations" else _select)
_COUNTING = (
    "check_missing_originator_ids",
    "check_missing_originator_names",
    "check_orphaned_sponsors",
    "check_sponsor_coverage",
    "check_date_coverage",
    "check_mortgage_amounts",
)
define("profile_checks", " UNION ALL ".join(_CHECKS[c] for c in _COUNTING))
define("run_all_checks", f"WITH {_FOUND} " + " UNION ALL ".join(_CHECKS.values()))
define(
    "run_critical_checks",
    " UNION ALL ".join(
        _CHECKS[c]
        for c in ("check_required_columns", "check_fha_index_uniqueness", "check_id_name_consistency_monthly")
    ),
)
define(
    "validation_verdict",
    f"""WITH {_FOUND}, results AS ({" UNION ALL ".join(_CHECKS.values())})
    SELECT count(*) FILTER (NOT is_warning AND status = 'PASS') AS critical_passed,
           count(*) FILTER (NOT is_warning AND status <> 'PASS') AS critical_failed,
           count(*) FILTER (is_warning AND status <> 'PASS') AS warnings,
           count(*) FILTER (NOT is_warning AND status <> 'PASS') = 0 AS passed FROM results""",
)

# --- names that change within a month ------------------------------------------
_MIXED = f"""mixed AS (
  SELECT * REPLACE (CASE WHEN {_ON} % 4 = 1 AND "Month" % 3 = {_SN} % 3 AND "Year" > 1996
                         THEN {_O} || ' II' ELSE {_O} END AS {_O}) FROM loans)"""
define(
    "institution_summary",
    f"""WITH RECURSIVE {_PAIRS}, {_ORDERED}, {_TRANSITIONS}, {_oscillations(_ON, _O)}
    SELECT 'id_spaces' AS section, u.metric AS metric, cast(u.value AS bigint) AS value FROM (
      UNPIVOT (SELECT count(DISTINCT {_O}) AS unique_originator_names, count(DISTINCT {_ON}) AS unique_originator_ids,
          count(DISTINCT {_S}) AS unique_sponsor_names, count(DISTINCT {_SN}) AS unique_sponsor_ids,
          (SELECT count(*) FROM (SELECT {_O} FROM loans INTERSECT SELECT {_S} FROM loans WHERE {_S} IS NOT NULL))
            AS overlapping_names,
          (SELECT count(*) FROM (SELECT {_ON} FROM loans INTERSECT SELECT {_SN} FROM loans WHERE {_SN} IS NOT NULL))
            AS overlapping_ids FROM loans) ON COLUMNS(*) INTO NAME metric VALUE value) u
    UNION ALL SELECT 'summary', 'unique_institution_numbers', count(DISTINCT institution_number) FROM pairs
    UNION ALL SELECT 'summary', 'unique_institution_names', count(DISTINCT institution_name) FROM pairs
    UNION ALL SELECT 'summary', 'ids_with_name_changes', count(DISTINCT id) FROM recorded
    UNION ALL SELECT 'summary', 'mapping_errors', count(*) FROM ({_CONFLICTS} UNION ALL {_RENAMES})
    UNION ALL SELECT 'summary', 'originator_oscillations', count(*) FROM found
    UNION ALL SELECT 'summary', 'sponsor_oscillations', 0""",
)
# The sponsors of the view have one name each, so none of them oscillates.

_TRADED = f"""traded AS (
  SELECT * REPLACE (CASE WHEN {_SN} % 3 = 1 AND "Year" % 3 = 0 THEN {_S} || ' & Co'
                         WHEN {_SN} % 5 = 2 AND "Month" % 4 = 1 AND {_ON} % 2 = 0 THEN {_S} || ' Trust' ELSE {_S} END AS {_S})
  FROM loans)"""
for _name in ("oscillations_sponsor", "segments_sponsor", "name_events_sponsor"):
    _rest = SQL[_name][len(_LOANS) :].replace("FROM loans", "FROM traded").strip()
    SQL[f"{_name}_mixed"] = f"{_LOANS}, {_TRADED}{', ' + _rest[1:] if _rest.startswith(',') else ' ' + _rest}"

for _name in (
    "month_conflicts",
    "temporary_renames",
    "segments_originator",
    "name_events_originator",
    "name_transitions",
    "name_change_summary",
    "timeline",
    "oscillations",
    "check_id_name_consistency_monthly",
    "check_name_oscillations",
    "institution_summary",
):
    _recursive = SQL[_name].startswith("WITH RECURSIVE")
    _head = len("WITH RECURSIVE " if _recursive else "") + (len(_LOANS) - 5 if _recursive else len(_LOANS))
    _rest = SQL[_name][_head:].replace("FROM loans", "FROM mixed").strip()
    _intro = "WITH RECURSIVE " + _LOANS[5:] if _recursive else _LOANS
    _join = ", " + _rest[1:] if _rest.startswith(",") else " " + _rest
    SQL[f"{_name}_mixed"] = f"{_intro}, {_MIXED}{_join}"
del SQL["institution_summary"]

# --- cleaning, counties and import ------------------------------------------------


def _list(values: tuple) -> str:
    texts = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return f"[{', '.join(texts)}]"


def _pick(values: tuple, index: str) -> str:
    return f"({_list(values)})[({index} % {len(values)}) + 1]"


def define_raw(name: str, body: str) -> None:
    """``body`` may select from ``cleaned`` (data rows) and may start with further CTEs."""
    SQL[name] = f"WITH {_CLEANED}, {body.strip()[5:]}" if body.strip().startswith("WITH ") else f"WITH {_CLEANED} {body}"


# What the cleaning rules make of the untidy sheets, derived from orders directly.
_PURPOSE = f"""CASE WHEN p IN ('Fixed Rate', 'Rehabilitation', 'Single Family') THEN 'Purchase'
  WHEN p = 'Refi_Conv-Curr' THEN 'Refi_Conv_Curr' WHEN p = 'a-b-c-d' THEN 'a_b_c-d' ELSE p END"""
_CLEANED = f"""picked AS (
  SELECT *, o_orderkey AS k, o_custkey AS c, {_pick(star_raw.PURPOSES, "o_orderkey")} AS p,
    {_pick(star_raw.COUNTIES, "o_orderkey")} AS county, {_pick(star_raw.STATES, "o_custkey")} AS state,
    {_pick(star_raw.DOWN_PAYMENTS, "o_orderkey")} AS down FROM orders),
cleaned AS (
  SELECT k AS row_ord, o_orderstatus, (year(o_orderdate) + 19) AS sy, month(o_orderdate) AS sm,
    state AS "Property State", 'Springfield' AS "Property City",
    CASE WHEN county <> '#NULL!' THEN county END AS "Property County",
    CASE WHEN k % 97 <> 0 THEN cast(c % 100000 AS int) END AS "Property Zip",
    CASE WHEN k % 43 = 0 THEN 'nan' WHEN k % 41 <> 0 THEN 'Lender ' || (c % 37) END AS "Originating Mortgagee",
    cast(c % 37 + 100 AS int) AS "Originating Mortgagee Number",
    CASE WHEN k % 13 <> 0 THEN 'Sponsor ' || (k % 19) END AS "Sponsor Name",
    cast(k % 19 AS int) AS "Sponsor Number",
    CASE down WHEN 'NonProfit' THEN 'Non Profit' WHEN ' ' THEN NULL WHEN 'nan' THEN NULL ELSE down END
      AS "Down Payment Source",
    CASE WHEN k % 53 <> 0 THEN cast(k % 7 AS bigint) END AS "Non Profit Number",
    CASE WHEN k % 2 = 0 THEN 'Fixed Rate' ELSE 'Adjustable Rate' END AS "Product Type",
    {_PURPOSE} AS "Loan Purpose", 'Condo' AS "Property Type",
    CASE WHEN k % 89 <> 0 THEN (c % 40) / 8.0::double + 2 END AS "Interest Rate",
    cast(floor(o_totalprice) AS bigint) AS "Mortgage Amount",
    cast((year(o_orderdate) + 19) AS smallint) AS "Year", cast(month(o_orderdate) AS smallint) AS "Month"
  FROM picked WHERE o_orderstatus IN ('O', 'F') AND p IS NOT NULL AND p <> 'Loan_Purpose'),
numbered AS (
  SELECT *, sy || lpad(sm::varchar, 2, '0') || '01_' || lpad(cast(row_number() OVER (
    PARTITION BY sy, sm ORDER BY o_orderstatus DESC, row_ord) AS varchar), 7, '0') AS "FHA_Index" FROM cleaned)"""
_FIX = """CASE WHEN state = 'IL' AND up = 'DU PAGE' THEN 'DUPAGE' WHEN state = 'IL' AND up = 'DE KALB' THEN 'DEKALB'
  WHEN state = 'MO' AND up = 'STE GENEVIEVE' THEN 'SAINTE GENEVIEVE'
  WHEN state = 'LA' AND up = 'ST JOHN THE BAPTIST' THEN 'ST. JOHN THE BAPTIST'
  WHEN state = 'PR' AND up = 'BAYAM''N' THEN 'BAYAMON' ELSE regexp_replace(up, ' COUNTY$', '') END"""


def _standard(source: str) -> str:
    """Rows of ``source`` with corrected ``Property State`` and ``Property County``."""
    return f"""(SELECT * REPLACE (state AS "Property State",
        CASE WHEN fixed LIKE 'ST %' THEN 'ST. ' || substr(fixed, 4) WHEN fixed LIKE 'STE %' THEN 'SAINTE ' || substr(fixed, 5)
             ELSE fixed END AS "Property County") FROM (
      SELECT *, {_FIX} AS fixed FROM (
        SELECT *, CASE WHEN "Property State" = 'AK' AND up = 'EL PASO' THEN 'TX' ELSE "Property State" END AS state FROM (
          SELECT *, CASE WHEN "Property County" IS NULL OR lower("Property County") IN ('nan', 'none') THEN ''
                         ELSE upper("Property County") END AS up FROM {source}))))"""


# Names under which the reference counties are found, written out.
_CODES = """codes(st, name, code) AS (VALUES ('CA', 'LOS ANGELES', '06037'), ('CA', 'ORANGE', '06059'),
  ('IL', 'DUPAGE', '17043'), ('MO', 'SAINTE GENEVIEVE', '29186'), ('LA', 'ST. JOHN THE BAPTIST', '22095'),
  ('MN', 'ST. LOUIS', '27137'), ('PR', 'BAYAMON', '72021'), ('TX', 'EL PASO', '48141'), ('MD', 'BALTIMORE', '24510'),
  ('IL', 'DEKALB', '17037'))"""
_SF_COLUMNS = ", ".join(
    f'"{c}"'
    for c in (
        "Property State", "Property City", "Property County", "Property Zip", "Originating Mortgagee",
        "Originating Mortgagee Number", "Sponsor Name", "Sponsor Number", "Down Payment Source", "Non Profit Number",
        "Product Type", "Loan Purpose", "Property Type", "Interest Rate", "Mortgage Amount", "Year", "Month",
    )
)
define_raw("clean_loans", f"SELECT row_ord, {_SF_COLUMNS} FROM cleaned")
define_raw(
    "row_keys",
    """SELECT "FHA_Index", cast(sy AS int) AS snapshot_year, cast(sm AS int) AS snapshot_month, "Mortgage Amount"
    FROM numbered""",
)
SQL["row_keys_hecm"] = """
  SELECT 'H' || (year(o_orderdate) + 19) || lpad(month(o_orderdate)::varchar, 2, '0') || '01_' || lpad(cast(row_number() OVER (
      PARTITION BY (year(o_orderdate) + 19), month(o_orderdate) ORDER BY o_orderkey) AS varchar), 7, '0') AS "FHA_Index",
    cast((year(o_orderdate) + 19) AS int) AS snapshot_year, cast(month(o_orderdate) AS int) AS snapshot_month,
    CASE WHEN o_orderkey % 7 <> 0 THEN cast(o_orderkey % 1000 AS bigint) END AS "NMLS" FROM orders"""
SQL["clean_hecm"] = f"""
  SELECT o_orderkey AS row_ord, {_pick(star_raw.STATES, "o_custkey")} AS "Property State",
    CASE WHEN o_orderkey % 5 <> 0 THEN 'Lender ' || (o_custkey % 37) END AS "Originating Mortgagee",
    cast(o_custkey % 37 AS int) AS "Originating Mortgagee Number",
    CASE WHEN o_orderkey % 3 <> 0 THEN 'Sponsor' END AS "Sponsor Name",
    CASE WHEN o_orderkey % 7 <> 0 THEN cast(o_orderkey % 1000 AS bigint) END AS "NMLS",
    CASE WHEN o_orderkey % 2 = 0 THEN 'Saver' END AS "Standard/Saver", 'Purchase' AS "Purchase/Refinance",
    (o_custkey % 40) / 8.0::double + 2 AS "Interest Rate", floor(o_totalprice) AS "Maximum Claim Amount",
    cast((year(o_orderdate) + 19) AS smallint) AS "Year", cast(month(o_orderdate) AS smallint) AS "Month",
    cast(o_orderkey % 11 AS bigint) AS "Previous Servicer ID"
  FROM orders"""
SQL["clean_rejects"] = """
  WITH data AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus IN ('O', 'F'))
  SELECT 'Property Zip' AS "column", count(*) FILTER (k % 97 = 0) AS rejected FROM data
  UNION ALL SELECT 'Non Profit Number', count(*) FILTER (k % 53 = 0) FROM data
  UNION ALL SELECT 'Interest Rate', count(*) FILTER (k % 89 = 0) FROM data
  UNION ALL SELECT unnest(['Originating Mortgagee Number', 'Sponsor Number', 'Mortgage Amount', 'Year', 'Month']), 0"""
_SILVER = f"""{_CODES}, silver AS (
  SELECT {_SF_COLUMNS.replace('"Originating Mortgagee",', """CASE WHEN "Originating Mortgagee" IS NULL
      OR "Originating Mortgagee" IN ('nan', 'None') THEN '' ELSE "Originating Mortgagee" END AS "Originating Mortgagee",""")
    .replace('"Sponsor Name",', """CASE WHEN "Year" = 2014 AND "Month" = 8 THEN '' ELSE coalesce("Sponsor Name", '') END AS "Sponsor Name",""")},
    "FHA_Index", code AS "FIPS", make_date("Year", "Month", 1) AS "Date"
  FROM {_standard("numbered")} LEFT JOIN codes ON st = "Property State" AND name = "Property County")"""
define_raw("silver_loans", f"WITH {_SILVER} SELECT * FROM silver")
define_raw("imported_loans", f"WITH {_SILVER} SELECT * FROM silver")
define_raw(
    "silver_domain_violations",
    f"""WITH {_SILVER}, long AS (
      SELECT 'Loan Purpose' AS "column", "Loan Purpose" AS value FROM silver
        WHERE "Loan Purpose" NOT IN ('Purchase', 'Refi_FHA', 'Refi_Conv_Curr')
      UNION ALL SELECT 'Down Payment Source', "Down Payment Source" FROM silver
        WHERE "Down Payment Source" NOT IN ('Borrower', 'Relative', 'Gov Asst', 'Non Profit', 'Employer'))
    SELECT "column", value, count(*) AS rows FROM long GROUP BY ALL""",
)
define_raw(
    "incremental_rows",
    f"""WITH {_SILVER} SELECT "Year", "Month", count(*) AS rows FROM silver WHERE "Year" >= 2017 GROUP BY ALL""",
)
define_raw(
    "county_standardised",
    f"""SELECT "Property State", "Property County", count(*) AS count FROM {_standard("cleaned")} GROUP BY ALL""",
)
define_raw(
    "county_fips",
    f"""WITH {_CODES}
    SELECT "Property State", "Property County", code AS "FIPS", count(*) AS count FROM {_standard("cleaned")}
    LEFT JOIN codes ON st = "Property State" AND name = "Property County" GROUP BY ALL""",
)
_PAIR_SQL = f"""pairs AS (SELECT DISTINCT upper("Property State") AS s, "Property County" AS n
    FROM {_standard("cleaned")} WHERE "Property State" <> '' AND "Property County" <> '')"""
define_raw(
    "fips_new_pairs",
    f"""WITH {_PAIR_SQL} SELECT s AS "Property State", n AS "Property County" FROM pairs
    WHERE (s, n) NOT IN (('CA', 'ORANGE'), ('IL', 'DUPAGE'))""",
)
_RESOLVED = f"""{_PAIR_SQL}, {_CODES}, resolved AS (
    SELECT s, n, CASE WHEN s = 'DC' AND n = 'WASHINGTON' THEN '11001' ELSE code END AS code
    FROM pairs LEFT JOIN codes ON st = s AND name = n WHERE (s, n) NOT IN (('CA', 'ORANGE'), ('IL', 'DUPAGE')))"""
define_raw(
    "fips_crosswalk",
    f"""WITH {_RESOLVED}
    SELECT s AS "Property State", n AS "Property County", code AS "FIPS" FROM resolved WHERE code IS NOT NULL
    UNION ALL VALUES ('CA', 'ORANGE', '06059'), ('IL', 'DUPAGE', '17043')""",
)
define_raw(
    "fips_problematic",
    f"""WITH {_RESOLVED}
    SELECT s AS "Property State", n AS "Property County" FROM resolved WHERE code IS NULL
    UNION SELECT 'QQ', 'NOWHERE'
    UNION SELECT 'PR', 'BAYAMON' WHERE NOT EXISTS (SELECT 1 FROM resolved WHERE s = 'PR' AND n = 'BAYAMON')""",
)
_NAMES = """names AS (
  SELECT DISTINCT * FROM (SELECT unnest([
    {'style': 1, 'path': 'raw/FHA_SF_Snapshot_' || y || m || '01.xlsx', 'y': y, 'm': m},
    {'style': 2, 'path': 'fha_hecm_snapshot_' || y || m || '01.parquet', 'y': y, 'm': m},
    {'style': 3, 'path': 'FHA_SFSnapshot_' || mon || '2023.xlsx', 'y': '2023', 'm': m},
    {'style': 4, 'path': 'snap_' || m || substr(y, 3, 2) || '.zip', 'y': '20' || substr(y, 3, 2), 'm': m},
    {'style': 5, 'path': 'loans_202' || substr(y, 4, 1) || m || '.csv', 'y': '202' || substr(y, 4, 1), 'm': m},
    {'style': 6, 'path': 'notes-' || o_orderstatus || '.txt', 'y': NULL, 'm': NULL}], recursive := true)
  FROM (SELECT *, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m, strftime(o_orderdate, '%b') AS mon
        FROM orders)))"""
SQL["pending_files"] = f"""
  WITH {_NAMES}, dated AS (SELECT path, cast(('20' || substr(y, 3, 2)) AS int) AS year, cast(m AS int) AS month
                           FROM names WHERE style = 1)
  SELECT regexp_replace(path, 'Snapshot_..', 'Snapshot_20') AS path, year, month FROM dated
  WHERE (year, month) NOT IN ((2095, 1), (2096, 2))"""
_MONTHS = "['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec']"
SQL["file_names"] = f"""
  WITH {_NAMES}, parts AS (
    SELECT *, replace(path, 'raw/', '') AS name,
      nullif(list_position(list_transform({_MONTHS}, lambda x: contains(lower(path), x)), true), 0) AS abbr,
      regexp_extract_all(replace(path, 'raw/', ''), '20[0-9][0-9]') AS years,
      regexp_extract(replace(path, 'raw/', ''), '(0[1-9]|1[0-2])([0-9][0-9])', 1) AS mm,
      regexp_extract(replace(path, 'raw/', ''), '(0[1-9]|1[0-2])([0-9][0-9])', 2) AS yy FROM names),
  loose AS (
    SELECT *, CASE WHEN len(years) = 1 THEN cast(years[1] AS int)
                   WHEN len(years) = 0 AND yy <> '' THEN cast(yy AS int) + 2000 END AS loose_year FROM parts)
  SELECT path, CASE WHEN style = 2 THEN 'hecm' ELSE 'single_family' END AS kind,
    CASE WHEN style IN (1, 2, 5) THEN cast(y AS int) END AS year,
    CASE WHEN style IN (1, 2, 5) THEN cast(m AS int) END AS month,
    style IN (1, 5) AS usable, loose_year AS year_in_name, cast(abbr AS int) AS month_in_name,
    '_' || loose_year || lpad(abbr::varchar, 2, '0') AS suffix,
    'fha_sf_snapshot_' || coalesce(loose_year || coalesce(lpad(abbr::varchar, 2, '0'), nullif(mm, '')), '201001') || '01'
      || regexp_extract(name, '[.][a-z]+$') AS standard_name
  FROM loose"""


# --- files ----------------------------------------------------------------------------

for _name in ("imported_csv", "exported_loans", "streamed_loans"):
    SQL[_name] = SQL["imported_loans"]
define_raw("month_scan", f"""WITH {_SILVER} SELECT * FROM silver WHERE "Year" = 2016 AND "Month" = 3""")
SQL["imported_all_years"] = f"""WITH {_CLEANED.replace("+ 19", "+ (CASE WHEN c % 2 = 0 THEN 9 ELSE 35 END)")}
  SELECT "Year", "Month", count(*) AS rows FROM cleaned GROUP BY ALL"""
SQL["imported_hecm"] = f"""WITH clean AS ({SQL["clean_hecm"]}), numbered AS (
    SELECT *, 'H' || "Year" || lpad("Month"::varchar, 2, '0') || '01_' || lpad(cast(row_number() OVER (
      PARTITION BY "Year", "Month" ORDER BY row_ord) AS varchar), 7, '0') AS "FHA_Index" FROM clean)
  SELECT "FHA_Index", "Property State", coalesce("Originating Mortgagee", '') AS "Originating Mortgagee",
    "Originating Mortgagee Number", coalesce("Sponsor Name", '') AS "Sponsor Name", "NMLS", "Standard/Saver", "Interest Rate",
    "Year", "Month", make_date("Year", "Month", 1) AS "Date" FROM numbered"""
_OWN_MONTH = """cast((year(o_orderdate) + 19) AS smallint) AS "Year", cast(month(o_orderdate) AS smallint) AS "Month\""""
_NAMED = "(o_orderdate + to_months(CASE WHEN k % 29 = 0 THEN 1 ELSE 0 END))"
assert _OWN_MONTH in _CLEANED
_STRAYS = f"""{_CLEANED.replace(_OWN_MONTH, _OWN_MONTH.replace("o_orderdate", _NAMED))},
  files AS (SELECT DISTINCT sy, sm FROM cleaned),
  placed AS (
    SELECT numbered.*, ("Year", "Month") = (sy, sm) AS own,
      ("Year", "Month") <> (sy, sm) AND ("Year", "Month") IN (SELECT (sy, sm) FROM files) AS held_apart FROM numbered)"""
_NO_NAME = """CASE WHEN "Originating Mortgagee" IS NULL OR "Originating Mortgagee" IN ('nan', 'None') THEN ''
  ELSE "Originating Mortgagee" END AS "Originating Mortgagee\""""
SQL["imported_with_stray_rows"] = f"""WITH {_STRAYS}
  SELECT "FHA_Index", "Year", "Month", {_NO_NAME}, "Mortgage Amount", held_apart FROM placed"""
SQL["month_versions"] = f"""WITH {_STRAYS}
  SELECT CASE WHEN sy <= 2016 THEN 1 ELSE 2 END AS number, 'stray' AS part, "Year" AS year, "Month" AS month,
    sy AS source_year, sm AS source_month, count(*) AS rows, NOT held_apart AS visible
  FROM placed WHERE NOT own GROUP BY ALL
  UNION ALL SELECT CASE WHEN sy <= 2016 THEN 1 ELSE 2 END, 'own', sy, sm, sy, sm, count(*) FILTER (own), count(*) FILTER (own) > 0
  FROM placed GROUP BY sy, sm"""
_CORRECTED = _CLEANED.replace("WHERE o_orderstatus IN", "WHERE (year(o_orderdate) + 19 <> 2014 OR k % 2 = 0) AND o_orderstatus IN")
SQL["imported_corrections"] = SQL["streamed_corrections"] = f"""WITH {_CORRECTED}
  SELECT "FHA_Index", "Year", "Month", {_NO_NAME}, "Mortgage Amount" FROM numbered"""
_FILE_MONTHS = f"""{_CLEANED}, months AS (
    SELECT cast(year(o_orderdate) + 19 AS int) AS year, cast(month(o_orderdate) AS int) AS month,
      EXISTS (SELECT 1 FROM cleaned WHERE sy = year(o_orderdate) + 19 AND sm = month(o_orderdate)) AS clean FROM orders
    GROUP BY ALL)"""
SQL["manifest_status"] = f"""WITH {_FILE_MONTHS}
  SELECT 'single_family:' || year || '-' || lpad(month::varchar, 2, '0') AS key, 'single_family' AS snapshot_type, year, month,
    true AS is_downloaded, clean AS is_processed, 'raw/snapshot_year=' || year || '/snapshot_month=' || month AS raw_path,
    CASE WHEN clean THEN 'bronze/snapshot_year=' || year || '/snapshot_month=' || month END AS processed_path,
    true AS raw_checked, CASE WHEN clean THEN true END AS processed_checked FROM months"""
SQL["manifest_checksums"] = """SELECT 'single_family:' || y || '-' || lpad(m::varchar, 2, '0') AS key,
    sha256(string_agg(d || ':' || n, ',' ORDER BY d) || chr(10)) AS checksum
  FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, count(*) AS n FROM orders GROUP BY ALL)
  GROUP BY y, m"""
SQL["file_inventory"] = f"""WITH {_FILE_MONTHS}, folders AS (
    SELECT 'raw' AS category, 'raw/snapshot_year=' || year || '/snapshot_month=' || month AS folder FROM months
    UNION ALL SELECT 'data', 'bronze/snapshot_year=' || year || '/snapshot_month=' || month FROM months WHERE clean
    UNION ALL SELECT 'clean', 'silver/Year=' || year || '/Month=' || month || '/version=*' FROM months WHERE clean)
  SELECT *, 'parquet' AS suffix, true AS paths_agree, true AS sizes_agree, true AS dated FROM folders"""
SQL["csv_round_trip"] = SQL["state_counts"]
SQL["stored_result"] = SQL["county_counts"]
SQL["validation_export"] = f"SELECT check_name, status, is_warning FROM ({SQL['run_all_checks']})"
define("stored_checks", f"WITH {_FOUND} " + " UNION ALL ".join(v for k, v in _CHECKS.items() if k != "check_required_columns"))
_REPEATED_KEY = """CASE right("FHA_Index", 1) WHEN '7' THEN '19950101_' || substr("FHA_Index", 10)
  WHEN '8' THEN 'odd ' || right("FHA_Index", 3) WHEN '9' THEN NULL ELSE "FHA_Index" END"""
define("stored_checks_of_repeated_keys", _check(
    "FHA_Index Uniqueness", "n = u", {"total_rows": "n", "unique_indexes": "u", "duplicates": "n - u"},
    f"""SELECT count(*) AS n, count(DISTINCT {_REPEATED_KEY}) + max(CASE WHEN {_REPEATED_KEY} IS NULL THEN 1 ELSE 0 END) AS u
        FROM loans""",
))
define("months_checked_again", """SELECT DISTINCT "Year"::int AS year, "Month"::int AS month FROM loans
  WHERE "Year" >= 1996 OR ("Year" = 1994 AND "Month" = 5)""")
SQL["report_event_log"] = SQL["event_log"]
SQL["row_sample"] = "SELECT least(250, count(*)) AS rows, least(250, count(*)) AS keys FROM lineitem"


def _rows_of(tables: dict[str, str]) -> str:
    """Every row of the named queries as text, numbers in ten-thousandths."""
    number = "try_cast(value AS DOUBLE)"
    text = f"coalesce(CASE WHEN {number} IS NOT NULL THEN cast(floor({number} * 10000 + 0.5) AS bigint)::varchar ELSE value END, '-')"
    parts = []
    for name, query in tables.items():
        rows = f"(SELECT row_number() OVER () AS row_no, COLUMNS(*)::varchar FROM ({SQL[query]}))"
        long = f"FROM {rows} UNPIVOT INCLUDE NULLS (value FOR name IN (COLUMNS(* EXCLUDE (row_no))))"
        parts.append(f"SELECT '{name}' AS name, string_agg(name || '=' || {text}, '|' ORDER BY name) AS row {long} GROUP BY row_no")
    return " UNION ALL ".join(parts)


SQL["trend_tables"] = _rows_of({
    "active_lenders": "active_lenders", "loan_size": "loan_size_trend", "purchase_and_refinance": "purpose_trend",
    "down_payment_source": "down_payment_share", "by_product_type": "rates_by_product", "by_property_type": "rates_by_property",
    "by_loan_purpose": "rates_by_purpose", "top_lender_groups": "top_lender_groups", "category_counts": "category_counts",
    "category_shares": "category_share",
})
SQL["network_tables"] = _rows_of({
    "edges": "edges", "originator_centrality": "centrality_full_originators", "sponsor_centrality": "centrality_full_sponsors",
    "originator_projection": "projection_originators", "sponsor_projection": "projection_sponsors", "summary": "edge_totals",
})
SQL["exploratory_tables"] = _rows_of({n: n for n in ("lender_volume", "yearly_lenders", "sponsor_volume", "yearly_sponsors")})
