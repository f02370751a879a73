"""Institution identity over time: crosswalks, renames, oscillations, ownership."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_date, period, trimmed
from ..schemas import MONTH, ORIG, ORIG_NO, SPONSOR, SPONSOR_NO, YEAR
from ..sources.checkpoints import cut_lineage

ORIGINATOR, SPONSOR_ROLE = "Originator", "Sponsor"
ROLE_COLUMNS = {ORIGINATOR: (ORIG_NO, ORIG), SPONSOR_ROLE: (SPONSOR_NO, SPONSOR)}

EVENT_TYPES = {
    "entity_type": "string",
    "event_type": "string",
    "institution_number": "string",
    "effective_period": "string",
    "previous_names": "array<string>",
    "new_names": "array<string>",
    "previous_start_period": "string",
    "previous_end_period": "string",
    "new_start_period": "string",
    "new_end_period": "string",
    "previous_duration_months": "int",
    "new_duration_months": "int",
    "previous_observation_count": "bigint",
    "new_observation_count": "bigint",
    "metadata": "map<string,array<string>>",
}


# --- observations --------------------------------------------------------------


PARTY_COLUMNS = (YEAR, MONTH, ORIG_NO, ORIG, SPONSOR_NO, SPONSOR)


def party_months(df: DataFrame) -> DataFrame:
    """Loans per month and combination of originator and sponsor.

    Every identity operator starts from these counts.  They combine map-side, so an
    institution with a third of all loans is a handful of rows per input partition
    before anything is shuffled.  Such a table is taken in place of loans by every
    operator of this module.
    """
    if "loans" in df.columns:
        return df
    return df.groupBy(*[c for c in PARTY_COLUMNS if c in df.columns]).agg(F.count("*").alias("loans"))


def stored_party_months(df: DataFrame) -> DataFrame:
    """Party counts written once, for operators that read them several times.

    Loans are then scanned once; Spark would not share the scan by itself, as every
    use pushes its own filters below the counts.
    """
    return df if "loans" in df.columns else cut_lineage(party_months(df))


def role_observations(df: DataFrame, role: str) -> DataFrame:
    """``id, name, period, loans`` for one side; rows without an ID are left out."""
    id_col, name_col = ROLE_COLUMNS[role]
    loans = F.sum("loans") if "loans" in df.columns else F.count("*")
    # The period text is made after counting, once per month.
    return (
        df.filter(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"), F.col(name_col).alias("name"), YEAR, MONTH)
        .agg(loans.alias("loans"))
        .select("id", "name", period().alias("period"), "loans")
    )


def name_sets(df: DataFrame, role: str) -> DataFrame:
    """``id, period, value (sorted names), records`` for one side.

    The names of an ID in a month are a set of institution names, however many loans
    it has.  Such sets are taken in place of loans, too.
    """
    if "records" in df.columns:
        return df
    return (
        role_observations(df, role)
        .groupBy("id", "period")
        .agg(F.array_sort(F.collect_set("name")).alias("value"), F.sum("loans").alias("records"))
    )


def institution_pairs(df: DataFrame) -> DataFrame:
    """Distinct ``institution_number, institution_name, type, Date`` of both sides."""
    parties = F.explode(
        F.array(
            *[
                F.struct(
                    trimmed(id_col).alias("number"),
                    trimmed(name_col).alias("name"),
                    F.lit(role).alias("type"),
                )
                for role, (id_col, name_col) in ROLE_COLUMNS.items()
            ]
        )
    ).alias("p")
    return (
        party_months(df)
        .select(parties, month_date().alias("Date"))
        .filter((F.col("p.number") != "") & (F.col("p.name") != ""))
        .select(
            F.col("p.number").alias("institution_number"),
            F.col("p.name").alias("institution_name"),
            F.col("p.type").alias("type"),
            "Date",
        )
        .distinct()
    )


def stored_name_sets(df: DataFrame) -> dict[str, DataFrame]:
    """Name sets of both sides, each written once for the operators that start from them."""
    return {role: cut_lineage(name_sets(df, role)) for role in ROLE_COLUMNS}


# --- crosswalks ------------------------------------------------------------------


def institution_crosswalk(df: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """First and last month and number of months of every number, name and type."""
    keys = ["institution_number", "institution_name", "type"]
    pairs = institution_pairs(df) if pairs is None else pairs
    return (
        pairs.groupBy(*keys)
        .agg(
            F.min("Date").alias("first_date"),
            F.max("Date").alias("last_date"),
            F.count("Date").alias("num_months"),
        )
        .orderBy("institution_number", "type", "first_date", "institution_name")
    )


def lender_name_crosswalk(
    single_family: DataFrame | None,
    hecm: DataFrame | None = None,
    *,
    file_date_col: str = "file_date",
    skip_single_family=("2014-08-01",),
) -> DataFrame:
    """Names of every institution number over both programs, with conflict flags.

    Inputs are bronze rows with the date of the file they came from.  The skipped
    month holds no usable sponsor names.
    """
    frames = []
    if single_family is not None:
        keep = F.col(file_date_col).isNull() | ~F.col(file_date_col).cast("string").isin(*skip_single_family)
        frames.append(single_family.filter(keep))
    if hecm is not None:
        frames.append(hecm)
    if not frames:
        raise ValueError("At least one program is needed for the lender crosswalk")
    sides = F.explode(
        F.array(
            *[
                F.struct(F.col(i).cast("bigint").alias("number"), F.col(n).alias("name"))
                for i, n in ROLE_COLUMNS.values()
            ]
        )
    ).alias("s")

    def observed(df: DataFrame) -> DataFrame:
        parties = df.select(ORIG_NO, ORIG, SPONSOR_NO, SPONSOR, F.col(file_date_col).cast("date").alias("d"))
        return parties.distinct().select("d", sides)

    union = observed(frames[0])
    for frame in frames[1:]:
        union = union.unionByName(observed(frame))
    names = Window.partitionBy("Institution_Number")
    return (
        union.select(
            F.col("s.number").alias("Institution_Number"), F.col("s.name").alias("Institution_Name"), "d"
        )
        .dropna()
        .groupBy("Institution_Number", "Institution_Name")
        .agg(F.min("d").alias("First_Observed"), F.max("d").alias("Last_Observed"))
        .withColumns(
            {
                "First_Observed_Period": F.date_format("First_Observed", "yyyy-MM"),
                "Last_Observed_Period": F.date_format("Last_Observed", "yyyy-MM"),
                # One row per name by now, so rows count distinct names.
                "Distinct_Name_Count": F.count("*").over(names),
            }
        )
        .withColumn("Has_Name_Conflict", F.col("Distinct_Name_Count") > 1)
        .orderBy("Institution_Number", "First_Observed", "Institution_Name")
    )


def canonical_names(df: DataFrame) -> DataFrame:
    """Most frequent name of every sponsor number, the smaller name on a tie."""
    return (
        party_months(df)
        .filter(F.col(SPONSOR_NO).isNotNull() & F.col(SPONSOR).isNotNull())
        .groupBy(SPONSOR_NO, SPONSOR)
        .agg(F.sum("loans").alias("n"))
        .groupBy(SPONSOR_NO)
        .agg(F.min_by(SPONSOR, F.struct(-F.col("n"), F.col(SPONSOR))).alias("canonical_name"))
    )


# --- ID and name spaces --------------------------------------------------------------


def _space_members(df: DataFrame) -> DataFrame:
    """One row per distinct ID and name value with the sides it occurs on."""
    parties = df.select(ORIG_NO, ORIG, SPONSOR_NO, SPONSOR).distinct()
    members = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(space).alias("space"),
                    F.lit(role).alias("role"),
                    (F.col(c).cast("bigint") if space == "id" else F.lit(None).cast("bigint")).alias("number"),
                    (F.col(c) if space == "name" else F.lit(None).cast("string")).alias("name"),
                )
                for role, (id_col, name_col) in ROLE_COLUMNS.items()
                for space, c in (("id", id_col), ("name", name_col))
            ]
        )
    ).alias("m")
    return (
        parties.select(members)
        .filter(F.col("m.number").isNotNull() | F.col("m.name").isNotNull())
        .groupBy(F.col("m.space").alias("space"), F.col("m.number").alias("number"), F.col("m.name").alias("name"))
        .agg(
            F.max(F.col("m.role") == ORIGINATOR).alias("is_originator"),
            F.max(F.col("m.role") == SPONSOR_ROLE).alias("is_sponsor"),
        )
    )


def _space_counts(members: DataFrame) -> DataFrame:
    both = F.col("is_originator") & F.col("is_sponsor")

    def n(space: str, condition: Column) -> Column:
        return F.count(F.when((F.col("space") == space) & condition, 1))

    return members.agg(
        n("name", F.col("is_originator")).alias("unique_originator_names"),
        n("id", F.col("is_originator")).alias("unique_originator_ids"),
        n("name", F.col("is_sponsor")).alias("unique_sponsor_names"),
        n("id", F.col("is_sponsor")).alias("unique_sponsor_ids"),
        n("name", both).alias("overlapping_names"),
        n("id", both).alias("overlapping_ids"),
    )


def id_spaces(df: DataFrame) -> DataFrame:
    """One row: distinct IDs and names per side, overlaps, and the first ten of each."""
    members = cut_lineage(_space_members(df))
    return _space_counts(members).withColumns(
        {
            "sample_overlapping_names": smallest(overlap(members, "name"), "name", 10),
            "sample_overlapping_ids": smallest(overlap(members, "id"), "number", 10),
        }
    )


def overlap(members: DataFrame, space: str) -> DataFrame:
    return members.filter((F.col("space") == space) & F.col("is_originator") & F.col("is_sponsor"))


def smallest(df: DataFrame, column: str, k: int) -> Column:
    """Scalar subquery: array of the ``k`` smallest values of ``column``."""
    first = df.select(F.col(column).alias("x")).orderBy("x").limit(k)
    return first.agg(F.array_sort(F.collect_list("x"))).scalar()


# --- mapping errors --------------------------------------------------------------------


def _errors(number: Column, date: Column, names: Column, issue: str) -> list[Column]:
    return [
        number.alias("institution_number"),
        date.alias("date"),
        names.alias("names"),
        F.lit(issue).alias("issue"),
    ]


def _dated_by_number(pairs: DataFrame) -> DataFrame:
    """Pairs with a date, dealt by number into as many tasks as shuffles have.

    Pairs are packed so tightly in a shuffle that tasks merged by size would sort millions of them.
    """
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.filter(F.col("Date").isNotNull()).repartition(tasks, "institution_number")


def month_conflicts(df: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Numbers with several names in one month."""
    pairs = institution_pairs(df) if pairs is None else pairs
    month = Window.partitionBy("institution_number", "Date")
    return (
        _dated_by_number(pairs)
        # Sets are made only where they have several names.
        .withColumn("several", F.min("institution_name").over(month) < F.max("institution_name").over(month))
        .filter("several")
        .groupBy("institution_number", "Date")
        .agg(F.array_sort(F.collect_set("institution_name")).alias("names"))
        .filter(F.size("names") > 1)
        .select(
            *_errors(
                F.col("institution_number"),
                F.date_format("Date", "yyyy-MM"),
                F.array_join("names", ","),
                "Multiple names for same number in one month",
            )
        )
    )


def temporary_renames(df: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """First month per number in which a name gives way and comes back later."""
    pairs = institution_pairs(df) if pairs is None else pairs
    by_name = Window.partitionBy("institution_number", "institution_name")
    order = ("Date", "institution_name", "type")
    in_time = Window.partitionBy("institution_number").orderBy(*order)
    name, place = F.col("institution_name"), F.struct("Date", "type")
    return (
        _dated_by_number(pairs)
        .withColumn("returns", F.max(place).over(by_name) > place)
        .withColumn("prev", F.lag(F.struct(name.alias("name"), "returns")).over(in_time))
        # A name that gives way to another one and returns at all does so after it.
        .filter((name != F.col("prev.name")) & F.col("prev.returns"))
        .groupBy("institution_number")
        .agg(F.min_by(F.struct("Date", F.col("prev.name").alias("a"), name.alias("b")), F.struct(*order)).alias("hit"))
        .select(
            *_errors(
                F.col("institution_number"),
                F.date_format("hit.Date", "yyyy-MM"),
                F.concat("hit.a", F.lit(" -> "), "hit.b", F.lit(" -> "), "hit.a"),
                "Temporary name change (oscillation)",
            )
        )
    )


def mapping_errors(df: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    pairs = institution_pairs(df) if pairs is None else pairs
    return month_conflicts(df, pairs).unionByName(temporary_renames(df, pairs))


# --- segments and events ----------------------------------------------------------------


def segments(sets: DataFrame) -> DataFrame:
    """Runs of consecutive observed periods of an ID with the same ``value``.

    Input is one row per ``id`` and ``period``.  Months without observations do not
    end a run.  ``observed`` lists the run's periods with their record counts.
    """
    in_time = Window.partitionBy("id").orderBy("period")
    starts = F.coalesce(F.col("value") != F.lag("value").over(in_time), F.lit(True))
    upto = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sets.withColumn("starts", starts.cast("int"))
        .withColumn("segment", F.sum("starts").over(upto))
        .groupBy("id", "segment")
        .agg(
            F.first("value").alias("value"),
            F.array_sort(F.collect_list(F.struct("period", "records"))).alias("observed"),
        )
        .select(
            "id",
            F.col("segment").cast("int").alias("segment"),
            "value",
            F.col("observed")[0]["period"].alias("start_period"),
            F.element_at("observed", -1)["period"].alias("end_period"),
            F.size("observed").alias("duration_months"),
            F.aggregate("observed", F.lit(0).cast("bigint"), lambda a, x: a + x["records"]).alias("total_records"),
            "observed",
        )
    )


def name_segments(df: DataFrame, role: str = ORIGINATOR) -> DataFrame:
    """Name runs of every ID: value, first and last period, months and loans."""
    return segments(name_sets(df, role)).drop("observed")


def _event(**fields) -> Column:
    return F.struct(*[fields.get(c, F.lit(None)).cast(t).alias(c) for c, t in EVENT_TYPES.items()])


def _texts(*items) -> Column:
    return F.array(*items).cast("array<string>")


def _segment_events(runs: DataFrame, entity_type: str, names, run_event, period_event) -> DataFrame:
    """Events of runs: one per run (or none) and one per period with several values.

    A period has several values exactly when its run's value has, so both kinds come
    out of the same row.
    """
    before = Window.partitionBy("id").orderBy("segment")
    previous = F.lag(
        F.struct("value", "start_period", "end_period", "duration_months", "total_records", "observed")
    ).over(before)
    runs = runs.withColumn("previous", previous)
    per_run = run_event(names)
    per_period = F.when(
        F.size("value") > 1, F.transform("observed", lambda o: period_event(names, o))
    ).otherwise(F.array().cast(f"array<{_event_type()}>"))
    events = F.explode(F.concat(per_run, per_period)).alias("e")
    return (
        runs.select("id", events)
        .select("e.*")
        .withColumn("entity_type", F.lit(entity_type))
        .select(*EVENT_TYPES)
    )


def _event_type() -> str:
    return "struct<" + ",".join(f"{c}:{t}" for c, t in EVENT_TYPES.items()) + ">"


def _periods(observed) -> Column:
    return F.transform(observed, lambda o: o["period"])


def _change(event_type: Column, names, metadata: Column) -> Column:
    first = F.col("previous").isNull()
    return _event(
        event_type=event_type,
        institution_number=F.col("id"),
        effective_period=F.col("start_period"),
        previous_names=F.when(first, _texts()).otherwise(names(F.col("previous.value"))),
        new_names=names(F.col("value")),
        previous_start_period=F.col("previous.start_period"),
        previous_end_period=F.col("previous.end_period"),
        new_start_period=F.col("start_period"),
        new_end_period=F.col("end_period"),
        previous_duration_months=F.coalesce("previous.duration_months", F.lit(0)),
        new_duration_months=F.col("duration_months"),
        previous_observation_count=F.coalesce("previous.total_records", F.lit(0)),
        new_observation_count=F.col("total_records"),
        metadata=metadata,
    )


def _in_period(event_type: str, o, previous_names: Column, new_names: Column, metadata: Column) -> Column:
    return _event(
        event_type=F.lit(event_type),
        institution_number=F.col("id"),
        effective_period=o["period"],
        previous_names=previous_names,
        new_names=new_names,
        new_start_period=o["period"],
        new_end_period=o["period"],
        previous_duration_months=F.lit(0),
        new_duration_months=F.lit(1),
        previous_observation_count=F.lit(0),
        new_observation_count=o["records"],
        metadata=metadata,
    )


def name_events(df: DataFrame, role: str = ORIGINATOR) -> DataFrame:
    """``appearance``, ``rename`` and ``ambiguous_identity`` events of one side."""

    def run_event(names):
        metadata = F.when(
            F.col("previous").isNull(), F.create_map(F.lit("segment_periods"), _periods("observed"))
        ).otherwise(
            F.create_map(
                F.lit("previous_segment_periods"),
                _periods("previous.observed"),
                F.lit("new_segment_periods"),
                _periods("observed"),
            )
        )
        kind = F.when(F.col("previous").isNull(), "appearance").otherwise("rename")
        return F.array(_change(kind, names, metadata))

    def period_event(names, o):
        value = names(F.col("value"))
        return _in_period(
            "ambiguous_identity", o, value, value, F.create_map(F.lit("observed_names"), value)
        )

    return _segment_events(segments(name_sets(df, role)), role, lambda v: v, run_event, period_event)


def sponsor_sets(parties: DataFrame) -> DataFrame:
    """Per originator and period: sorted sponsors as (number, canonical name), and loans."""
    by_sponsor = (
        parties.filter(F.col(ORIG_NO).isNotNull())
        .groupBy(F.col(ORIG_NO).alias("id"), YEAR, MONTH, SPONSOR_NO)
        .agg(F.sum("loans").alias("loans"))
        .select("id", period().alias("period"), SPONSOR_NO, "loans")
    )
    sponsor = F.when(
        F.col(SPONSOR_NO).isNotNull(),
        F.struct(F.col(SPONSOR_NO).alias("number"), F.col("canonical_name").alias("name")),
    )
    return (
        by_sponsor.join(canonical_names(parties), SPONSOR_NO, "left")
        .groupBy("id", "period")
        .agg(F.array_sort(F.collect_set(sponsor)).alias("value"), F.sum("loans").alias("records"))
    )


def ownership_events(df: DataFrame) -> DataFrame:
    """Changes of the sponsors behind an originator, and months with several sponsors."""
    parties = stored_party_months(df)

    def names(value):
        return F.transform(value, lambda s: s["name"])

    def numbers(value):
        return F.transform(value, lambda s: s["number"].cast("string"))

    def run_event(names):
        metadata = F.create_map(
            F.lit("previous_sponsor_numbers"),
            numbers("previous.value"),
            F.lit("new_sponsor_numbers"),
            numbers("value"),
            F.lit("previous_segment_periods"),
            _periods("previous.observed"),
            F.lit("new_segment_periods"),
            _periods("observed"),
        )
        change = F.array(_change(F.lit("ownership_transition"), names, metadata))
        return F.when(F.col("previous").isNotNull(), change).otherwise(
            F.array().cast(f"array<{_event_type()}>")
        )

    def period_event(names, o):
        value = names(F.col("value"))
        metadata = F.create_map(
            F.lit("sponsor_numbers"), numbers("value"), F.lit("observed_sponsor_names"), value
        )
        return _in_period("multiple_sponsors_in_period", o, _texts(), value, metadata)

    return _segment_events(segments(sponsor_sets(parties)), ORIGINATOR, names, run_event, period_event)


def event_log(df: DataFrame, sets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Name events of both sides and ownership events in one sorted table.

    ``sets`` has the name sets of both sides where they are stored already.
    """
    parties = stored_party_months(df)
    sets = sets or {role: parties for role in ROLE_COLUMNS}
    return (
        name_events(sets[ORIGINATOR], ORIGINATOR)
        .unionByName(name_events(sets[SPONSOR_ROLE], SPONSOR_ROLE))
        .unionByName(ownership_events(parties))
        .orderBy("institution_number", "effective_period", "event_type", "entity_type")
    )


# --- name changes and oscillations --------------------------------------------------------


def name_transitions(df: DataFrame, role: str = ORIGINATOR) -> DataFrame:
    """Recorded name changes of every ID, one row per recorded period.

    A period is recorded if it has several names, or if the ID has recorded periods
    and its name is in none of them; a set equal to the last recorded one is skipped.
    The fold runs over one ID's months, a list bounded by the calendar.
    """
    step = F.struct("period", F.col("value").alias("names"))
    history = F.array_sort(F.collect_list(step)).alias("history")
    empty = F.array().cast("array<struct<period:string,names:array<string>>>")

    def record(seen, x):
        known = F.flatten(F.transform(seen, lambda t: t["names"]))
        several = F.size(x["names"]) > 1
        new_name = (F.size(seen) > 0) & (F.size(x["names"]) > 0) & ~F.coalesce(
            F.array_contains(known, F.get(x["names"], 0)), F.lit(False)
        )
        differs = (F.size(seen) == 0) | (F.get(seen, F.size(seen) - 1)["names"] != x["names"])
        return F.when((several | new_name) & differs, F.concat(seen, F.array(x))).otherwise(seen)

    return (
        name_sets(df, role)
        .groupBy("id")
        .agg(history)
        .select("id", F.posexplode(F.aggregate("history", empty, record)).alias("pos", "t"))
        .select("id", (F.col("pos") + 1).alias("change"), F.col("t.period").alias("period"), F.col("t.names").alias("names"))
    )


def name_change_summary(transitions: DataFrame, top_n: int | None = None) -> DataFrame:
    """Recorded changes per ID, most first."""
    table = (
        transitions.groupBy("id")
        .agg(
            F.count("*").alias("changes"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"),
        )
        .orderBy(F.desc("changes"), "id")
    )
    return table if top_n is None else table.limit(top_n)


def timelines(df: DataFrame, ids, role: str = ORIGINATOR) -> DataFrame:
    """Periods at which the name set of the given IDs changes, with the loans of that period."""
    id_col, _ = ROLE_COLUMNS[role]
    sets = name_sets(df.filter(F.col(id_col).isin(*ids)), role)
    previous = F.lag("value").over(Window.partitionBy("id").orderBy("period"))
    return (
        sets.withColumn("changed", F.coalesce(F.col("value") != previous, F.lit(True)))
        .filter("changed")
        .select("id", "period", F.col("value").alias("names"), F.col("records").alias("loan_count"))
        .orderBy("id", "period")
    )


def timeline(df: DataFrame, institution_id: int, role: str = ORIGINATOR) -> DataFrame:
    """:func:`timelines` of one ID; an unknown ID has no rows."""
    return timelines(df, [institution_id], role).drop("id")


def oscillations(
    df: DataFrame, role: str = ORIGINATOR, min_changes: int = 3, *, all_names: bool = False
) -> DataFrame:
    """IDs whose name leaves and comes back.

    Of every ID with at least ``min_changes`` runs, the first name that occurs in
    several runs is looked at (every such name with ``all_names``).  It is reported
    if two neighbouring occurrences have a run between them, with the names found
    between the first such pair.
    """
    whole = Window.partitionBy("id")
    runs = (
        segments(name_sets(df, role))
        # All runs of the ID next to each of them: a list bounded by the months.
        .withColumn("all_runs", F.collect_list(F.struct("segment", "value")).over(whole))
        .filter(F.size("all_runs") >= min_changes)
        .select("id", "segment", "start_period", "all_runs", F.explode("value").alias("name"))
    )
    following = F.lead("segment").over(Window.partitionBy("id", "name").orderBy("segment"))
    hits = (
        runs.withColumn("next_segment", following)
        .groupBy("id", "name")
        .agg(
            F.min("segment").alias("first_segment"),
            F.min(
                F.when(F.col("next_segment") - F.col("segment") > 1, F.struct("segment", "next_segment"))
            ).alias("gap"),
            F.array_sort(F.collect_list("start_period")).alias("periods"),
            F.first("all_runs").alias("all_runs"),
        )
        .filter(F.size("periods") >= 2)
    )
    if not all_names:
        first = F.row_number().over(whole.orderBy("first_segment", "name"))
        hits = hits.withColumn("rank", first).filter("rank = 1")
    inside = F.filter(
        "all_runs",
        lambda r: (r["segment"] > F.col("gap.segment")) & (r["segment"] < F.col("gap.next_segment")),
    )
    between = F.array_sort(F.array_distinct(F.flatten(F.transform(inside, lambda r: r["value"]))))
    return (
        hits.filter(F.col("gap").isNotNull())
        .select("id", F.col("name").alias("oscillating_name"), "periods", between.alias("intermediate_names"))
        .filter(F.size("intermediate_names") > 0)
    )
