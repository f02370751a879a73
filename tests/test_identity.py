"""Identity operators against plain loops over small random histories."""

import datetime
import random
from itertools import groupby

import pytest

from conftest import loans_frame, rows_of
from loanlake.operators import identity
from loanlake.plans import reports


def history(spark, *months, number=1):
    """Loans of one originator: one list of names per month from 2020-01 on."""
    rows = [
        (2020 + i // 12, i % 12 + 1, number, name, 7, "S") for i, names in enumerate(months) for name in names
    ]
    return loans_frame(spark, rows)


def random_rows(seed, n=400):
    rnd = random.Random(seed)
    return [
        (
            rnd.choice([2020, 2021]),
            rnd.randint(1, 12),
            rnd.choice([None, 1, 2, 3, 4]),
            rnd.choice(["A", "B", "C", None]) if rnd.random() < 0.3 else "A",
            rnd.choice([None, 1, 2, 9]) if rnd.random() < 0.2 else 9,
            rnd.choice(["S", "T", None]) if rnd.random() < 0.1 else "S",
        )
        for _ in range(n)
    ]


def sparse_rows(seed):
    """Few loans per month, so that name sets vary."""
    rnd = random.Random(seed)
    return [
        (2020 + m // 12, m % 12 + 1, i, rnd.choice("AAB"), rnd.choice([1, 2]), rnd.choice("ST"))
        for i in (1, 2, 3, 4, 5, 6)
        for m in range(16)
        if rnd.random() < 0.8
        for _ in range(rnd.choice([1, 1, 2]))
    ]


def period(row):
    return f"{row[0]}-{row[1]:02d}"


def sets_by_id(rows, id_at, value_at):
    out = {}
    for r in rows:
        if r[id_at] is not None:
            entry = out.setdefault(r[id_at], {}).setdefault(period(r), [set(), 0])
            if r[value_at] is not None:
                entry[0].add(r[value_at])
            entry[1] += 1
    return {i: [(p, sorted(v), n) for p, (v, n) in sorted(d.items())] for i, d in out.items()}


def runs_of(months):
    return [
        (value, [p for p, _, _ in group], sum(n for _, _, n in group))
        for value, group in ((k, list(g)) for k, g in groupby(months, key=lambda x: x[1]))
    ]


@pytest.mark.parametrize("rows", [random_rows(1), random_rows(2), sparse_rows(3), sparse_rows(4)])
def test_segments_partition_the_months(spark, rows):
    got = {}
    for r in identity.name_segments(loans_frame(spark, rows)).orderBy("id", "segment").collect():
        got.setdefault(r["id"], []).append(
            (r["value"], r["start_period"], r["end_period"], r["duration_months"], r["total_records"])
        )
    expected = {
        i: [(v, ps[0], ps[-1], len(ps), n) for v, ps, n in runs_of(months)]
        for i, months in sets_by_id(rows, 2, 3).items()
    }
    assert got == expected


@pytest.mark.parametrize("rows", [random_rows(1), sparse_rows(3), sparse_rows(4), sparse_rows(8)])
def test_name_events(spark, rows):
    df = loans_frame(spark, rows)
    got = sorted(
        (r["event_type"], r["institution_number"], r["effective_period"], r["previous_names"], r["new_names"],
         r["previous_end_period"], r["new_end_period"], r["previous_duration_months"], r["new_duration_months"],
         r["previous_observation_count"], r["new_observation_count"], sorted(r["metadata"].items()))
        for r in identity.name_events(df).collect()
    )
    expected = []
    for i, months in sets_by_id(rows, 2, 3).items():
        before = None
        for value, ps, n in runs_of(months):
            if before is None:
                expected.append(("appearance", str(i), ps[0], [], value, None, ps[-1], 0, len(ps), 0, n,
                                 [("segment_periods", ps)]))
            else:
                expected.append(("rename", str(i), ps[0], before[0], value, before[1][-1], ps[-1], len(before[1]),
                                 len(ps), before[2], n,
                                 [("new_segment_periods", ps), ("previous_segment_periods", before[1])]))
            before = (value, ps, n)
        for p, value, n in months:
            if len(value) > 1:
                expected.append(("ambiguous_identity", str(i), p, value, value, None, p, 0, 1, 0, n,
                                 [("observed_names", value)]))
    assert got == sorted(expected)


@pytest.mark.parametrize("rows", [random_rows(1), random_rows(5), sparse_rows(3)])
def test_ownership_events(spark, rows):
    names = {}
    for r in rows:
        if r[4] is not None and r[5] is not None:
            names.setdefault(r[4], []).append(r[5])
    canonical = {k: min(set(v), key=lambda x: (-v.count(x), x)) for k, v in names.items()}
    df = loans_frame(spark, rows)
    assert dict(rows_of(identity.canonical_names(df))) == canonical
    expected = []
    for i, months in sets_by_id(rows, 2, 4).items():
        runs = runs_of(months)
        for (v, ps, n), (w, qs, m) in zip(runs, runs[1:]):
            expected.append(("ownership_transition", str(i), qs[0], [canonical[x] for x in v],
                             [canonical[x] for x in w], [str(x) for x in v], [str(x) for x in w], n, m))
        for p, v, n in months:
            if len(v) > 1:
                expected.append(("multiple_sponsors_in_period", str(i), p, [], [canonical[x] for x in v],
                                 None, [str(x) for x in v], 0, n))
    got = [
        (r["event_type"], r["institution_number"], r["effective_period"], r["previous_names"], r["new_names"],
         r["metadata"].get("previous_sponsor_numbers"),
         r["metadata"].get("new_sponsor_numbers", r["metadata"].get("sponsor_numbers")),
         r["previous_observation_count"], r["new_observation_count"])
        for r in identity.ownership_events(df).collect()
    ]
    key = str
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_event_log_is_the_sorted_union(spark):
    df = loans_frame(spark, sparse_rows(3))
    log = identity.event_log(df)
    assert log.columns == list(identity.EVENT_TYPES)
    assert dict(log.dtypes) == identity.EVENT_TYPES
    parts = [identity.name_events(df), identity.name_events(df, "Sponsor"), identity.ownership_events(df)]
    rows = log.collect()
    assert len(rows) == sum(p.count() for p in parts)
    order = [(r["institution_number"], r["effective_period"], r["event_type"]) for r in rows]
    assert order == sorted(order)
    empty = identity.event_log(df.limit(0))
    assert empty.count() == 0 and empty.columns == log.columns


def recorded_changes(months):
    out = []
    for p, value, _ in months:
        known = {n for _, names in out for n in names}
        if len(value) > 1 or (out and value and value[0] not in known):
            if not out or out[-1][1] != value:
                out.append((p, value))
    return out


@pytest.mark.parametrize("rows", [random_rows(1), sparse_rows(3), sparse_rows(4), sparse_rows(9)])
def test_name_transitions(spark, rows):
    got = {}
    for r in identity.name_transitions(loans_frame(spark, rows)).orderBy("id", "change").collect():
        got.setdefault(r["id"], []).append((r["period"], r["names"]))
    expected = {i: recorded_changes(m) for i, m in sets_by_id(rows, 2, 3).items()}
    assert got == {i: c for i, c in expected.items() if c}


def oscillation_of(months, min_changes=3):
    runs = runs_of(months)
    if len(runs) < min_changes:
        return None
    seen = {}
    for k, (value, ps, _) in enumerate(runs):
        for name in value:
            seen.setdefault(name, []).append((k, ps[0]))
    for name, at in seen.items():
        if len(at) >= 2:
            for (a, _), (b, _) in zip(at, at[1:]):
                between = sorted({n for value, _, _ in runs[a + 1 : b] for n in value})
                if between:
                    return name, [p for _, p in at], between
            return None
    return None


@pytest.mark.parametrize("seed", range(6))
def test_oscillations(spark, seed):
    rows = sparse_rows(seed + 20)
    got = {
        r["id"]: (r["oscillating_name"], r["periods"], r["intermediate_names"])
        for r in identity.oscillations(loans_frame(spark, rows)).collect()
    }
    expected = {i: oscillation_of(m) for i, m in sets_by_id(rows, 2, 3).items()}
    assert got == {i: o for i, o in expected.items() if o}


def test_oscillation_thresholds(spark):
    assert identity.oscillations(history(spark, ["A"], ["B"])).count() == 0
    three = history(spark, ["A"], ["B"], ["A"])
    assert rows_of(identity.oscillations(three)) == [(1, "A", ["2020-01", "2020-03"], ["B"])]
    assert identity.oscillations(three, min_changes=4).count() == 0
    # A is first but never leaves; B does, and is only seen when all names are looked at.
    two = history(spark, ["A", "B"], ["A"], ["A", "B"], ["A"])
    assert identity.oscillations(two).count() == 0
    assert rows_of(identity.oscillations(two, all_names=True)) == [(1, "B", ["2020-01", "2020-03"], ["A"])]


def test_calendar_gap_does_not_split(spark):
    rows = [(2020, 1, 1, "A", 7, "S"), (2020, 5, 1, "A", 7, "S")]
    got = identity.name_segments(loans_frame(spark, rows)).collect()
    assert [(r["start_period"], r["end_period"], r["duration_months"]) for r in got] == [("2020-01", "2020-05", 2)]


def test_temporary_rename_and_month_conflict(spark):
    errors = rows_of(identity.mapping_errors(history(spark, ["A"], ["B"], ["A"], ["C", "A"])))
    assert sorted(errors) == [
        ("1", "2020-02", "A -> B -> A", "Temporary name change (oscillation)"),
        ("1", "2020-04", "A,C", "Multiple names for same number in one month"),
    ]


@pytest.mark.parametrize("seed", range(4))
def test_temporary_renames(spark, seed):
    rows = sparse_rows(seed + 40)
    pairs = sorted(
        {(str(r[2]), period(r), r[3], "Originator") for r in rows} | {(str(r[4]), period(r), r[5], "Sponsor") for r in rows}
    )
    expected = {}
    for number, group in groupby(pairs, key=lambda x: x[0]):
        seq = list(group)
        for a, b, rest in zip(seq, seq[1:], (seq[k + 2 :] for k in range(len(seq)))):
            if a[2] != b[2] and a[2] in [x[2] for x in rest]:
                expected[number] = (b[1], f"{a[2]} -> {b[2]} -> {a[2]}")
                break
    got = {r[0]: (r[1], r[2]) for r in rows_of(identity.temporary_renames(loans_frame(spark, rows)))}
    assert got == expected


def test_sample_is_clean(sample):
    assert identity.mapping_errors(sample).count() == 0
    crosswalk = identity.institution_crosswalk(sample)
    assert crosswalk.columns == [
        "institution_number", "institution_name", "type", "first_date", "last_date", "num_months",
    ]
    assert crosswalk.count() == 6


def test_id_spaces(spark):
    rows = [(2020, 1, 1, "A", 2, "A"), (2020, 1, 2, "B", None, None), (2020, 1, None, "C", 3, "S")]
    r = identity.id_spaces(loans_frame(spark, rows)).first()
    assert tuple(r) == (3, 2, 2, 2, 1, 1, ["A"], [2])


def test_timeline(spark):
    df = history(spark, ["A"], ["A"], ["A", "B"], ["B"], ["B"])
    assert rows_of(identity.timeline(df, 1)) == [
        ("2020-01", ["A"], 1), ("2020-03", ["A", "B"], 2), ("2020-04", ["B"], 1),
    ]
    assert identity.timeline(df, 99).count() == 0


def test_party_months_stand_for_loans(spark):
    df = loans_frame(spark, random_rows(11))
    parties = identity.party_months(df)
    for operator in (identity.name_segments, identity.event_log, identity.oscillations, identity.name_transitions):
        assert sorted(rows_of(operator(parties)), key=str) == sorted(rows_of(operator(df)), key=str)


def test_renames_and_conflicts_sort_as_many_parts_as_shuffles_have(spark):
    """Parts merged by their packed size would each hold millions of pairs."""
    df = history(spark, ["A"], ["B"], ["A"], ["C", "A"])
    for table in (identity.temporary_renames(df), identity.month_conflicts(df)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan


def test_temporary_renames_with_repeated_pairs(spark):
    day = lambda m: datetime.date(2020, m, 1)
    rows = [("1", "A", "Originator", day(1)), ("1", "A", "Originator", day(1)), ("1", "B", "Originator", day(2))]
    rows += [("2", "A", "Originator", day(1)), ("2", "B", "Sponsor", day(1)), ("2", "A", "Sponsor", day(1)), ("2", "A", "Sponsor", day(3))]
    pairs = spark.createDataFrame(rows, "institution_number string, institution_name string, type string, Date date")
    got = [(r[0], r[1], r[2]) for r in rows_of(identity.temporary_renames(None, pairs))]
    assert got == [("2", "2020-01", "A -> B -> A")]


def test_parts_of_the_report_start_from_pairs_and_sets_made_once(spark, tmp_path, monkeypatch):
    made = []
    for name in ("institution_pairs", "name_sets", "mapping_errors"):
        real = getattr(identity, name)

        def counted(df, *rest, _real=real, _name=name):
            made.extend([] if "records" in df.columns else [_name])
            return _real(df, *rest)

        monkeypatch.setattr(identity, name, counted)
    reports.institution_report(history(spark, ["A"], ["B"], ["A"], ["C", "A"]), str(tmp_path))
    assert sorted(made) == ["institution_pairs", "mapping_errors", "name_sets", "name_sets"]
    lines = (row["value"] for row in spark.read.option("header", True).csv(f"{tmp_path}/institution_summary.csv").filter("metric = 'mapping_errors'").collect())
    assert list(lines) == ["2"]
