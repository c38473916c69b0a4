"""Cohort operators on a few rows worked by hand, and properties that must hold on any."""

import random
import time
from datetime import date, timedelta
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given as given_by
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.functions import days, matching, order, spans as overlaps
from cohortloom.operators import cohort, compare, outcomes, summaries
from cohortloom.sources import tables

D = date.fromisoformat


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def index(spark, *pairs):
    return spark.createDataFrame([(p, D(d)) for p, d in pairs], "patid long, index_date date")


def spans(spark, *triples, names=("enr_start", "enr_end")):
    return spark.createDataFrame([(p, D(a), D(b)) for p, a, b in triples], f"patid long, {names[0]} date, {names[1]} date")


def records(spark, *triples):
    return spark.createDataFrame([(p, D(d), c) for p, d, c in triples], "patid long, adate date, code string")


def fills(spark, *quads):
    return spark.createDataFrame([(p, c, D(d), s) for p, c, d, s in quads], "patid long, code string, rxdate date, rxsup int")


def test_age(spark):
    df = spark.createDataFrame([(D("1980-02-29"), D("2001-02-28")), (D("1980-02-29"), D("2001-03-01")), (D("1980-05-05"), D("2000-05-05"))], "b date, d date")
    assert [r[0] for r in df.select(days.age("b", "d")).collect()] == [20, 21, 20]


def test_bridge_spans(spark):
    e = spans(spark, (1, "2000-01-01", "2000-01-31"), (1, "2000-01-05", "2000-01-10"), (1, "2000-02-05", "2000-02-10"), (1, "2000-02-16", "2000-02-20"), (2, "2000-01-01", "2000-01-01"))
    assert rows(cohort.bridge_spans(e, 4), "patid", "span_start", "span_end") == [(1, D("2000-01-01"), D("2000-02-10")), (1, D("2000-02-16"), D("2000-02-20")), (2, D("2000-01-01"), D("2000-01-01"))]
    assert len(rows(cohort.bridge_spans(e, 5), "patid")) == 2
    assert cohort.bridge_spans(e.limit(0), 5).count() == 0


def test_bridged_spans_cover_the_same_days(spark):
    rng = random.Random(1)
    given = [(p, D("2000-01-01") + timedelta(a), D("2000-01-01") + timedelta(a + rng.randrange(20))) for p in range(20) for a in (rng.randrange(200) for _ in range(8))]
    df = spark.createDataFrame(given, "patid long, enr_start date, enr_end date")
    got = rows(cohort.bridge_spans(df, 0), "patid", "span_start", "span_end")

    def covered(triples):
        return {(p, a + timedelta(k)) for p, a, b in triples for k in range((b - a).days + 1)}

    assert covered(got) == covered(given)
    assert all(x[0] != y[0] or (y[1] - x[2]).days > 1 for x, y in zip(got, got[1:]))


def test_enrollment_edges(spark):
    s = spans(spark, (1, "2000-01-01", "2000-12-31"), names=("span_start", "span_end"))
    ix = index(spark, (1, "2000-01-31"), (1, "2000-01-30"), (1, "2000-12-31"), (1, "2001-01-01"))
    assert rows(cohort.require_enrollment(ix, s, 30), "index_date") == [(D("2000-01-31"),), (D("2000-12-31"),)]
    other = spans(spark, (1, "2000-12-31", "2001-02-01"), names=("span_start", "span_end"))
    assert rows(cohort.intersect_spans(s, other), "span_start", "span_end") == [(D("2000-12-31"), D("2000-12-31"))]
    assert rows(cohort.clip_spans(s, "2000-06-01", "2001-06-01"), "span_start", "span_end") == [(D("2000-06-01"), D("2000-12-31"))]


def test_washout_edges(spark):
    f = fills(spark, (1, "a", "2000-01-01", 5), (1, "a", "2000-01-11", 5), (1, "a", "2000-01-22", 5), (1, "a", "2000-01-22", 9), (1, "b", "2000-01-12", 1))
    assert rows(cohort.incident(f, 10), "code", "index_date") == [("a", D("2000-01-01")), ("a", D("2000-01-22")), ("b", D("2000-01-12"))]
    assert rows(cohort.incident(f, None), "code", "index_date") == [("a", D("2000-01-01")), ("b", D("2000-01-12"))]
    b = index(spark, (1, "2000-01-12"), (1, "2000-02-01"), (1, "2000-02-02"))
    assert rows(cohort.incident_vs(b, f.where("code = 'a'"), 10), "index_date") == [(D("2000-02-02"),)]


def test_stockpile_equals_a_loop(spark):
    rng = random.Random(2)
    given = sorted({(p, "a", D("2000-01-01") + timedelta(rng.randrange(120))) for p in range(30) for _ in range(12)})
    given = [(*g, rng.randrange(1, 25)) for g in given]
    df = spark.createDataFrame(given, "patid long, code string, rxdate date, rxsup int")
    expected, last = [], {}
    for p, _, d, s in given:
        start = max(d, last[p] + timedelta(1)) if p in last else d
        last[p] = start + timedelta(s - 1)
        expected.append((p, d, start, last[p]))
    for n in (1, 50):
        assert rows(cohort.stockpile(df.repartition(n)), "patid", "rxdate", "start_date", "end_date") == expected


def test_collapse_and_episodes(spark):
    f = fills(spark, (1, "a", "2000-01-01", 10), (1, "a", "2000-01-01", 30), (1, "a", "2000-02-05", 10), (1, "a", "2000-06-01", 2))
    one = cohort.collapse_fills(f)
    assert rows(one, "rxdate", "rxsup") == [(D("2000-01-01"), 30), (D("2000-02-05"), 10), (D("2000-06-01"), 2)]
    s = cohort.stockpile(one)
    assert rows(cohort.treatment_episodes(s, 5), "start_date", "end_date", "n_fills") == [(D("2000-01-01"), D("2000-02-14"), 2), (D("2000-06-01"), D("2000-06-02"), 1)]
    assert len(rows(cohort.treatment_episodes(s, 4), "patid")) == 3
    assert rows(cohort.treatment_episodes(s, 4, 10, 5, 20), "start_date", "end_date") == [(D("2000-01-01"), D("2000-01-20")), (D("2000-02-05"), D("2000-02-24")), (D("2000-06-01"), D("2000-06-12"))]


def test_windows(spark):
    ix = index(spark, (1, "2000-02-01"), (2, "2000-02-01"), (3, "2000-02-01"))
    r = records(spark, (1, "2000-01-02", "x"), (1, "2000-01-02", "x"), (2, "2000-01-02", "x"), (2, "2000-02-01", "x"), (3, "2000-01-01", "x"))
    rule = {"group": "x", "low": -30, "high": 0}
    assert rows(cohort.apply_windows(ix, r, [rule]), "patid") == [(1,), (2,)]
    assert rows(cohort.apply_windows(ix, r, [rule | {"include": False}]), "patid") == [(3,)]
    assert rows(cohort.apply_windows(ix, r, [rule | {"n": 2}]), "patid") == [(2,)]
    assert rows(cohort.apply_windows(ix, r, [rule | {"n": 2, "include": False}]), "patid") == [(1,), (3,)]


def test_entries_and_attrition(spark):
    ix = index(spark, (1, "2000-01-01"), (1, "2000-01-11"), (1, "2000-01-12"), (1, "2000-01-22"), (2, "2000-03-01"))
    assert rows(cohort.entry_first(ix), "patid", "index_date") == [(1, D("2000-01-01")), (2, D("2000-03-01"))]
    assert rows(cohort.entry_nonoverlap(ix, 10), "patid", "index_date") == [(1, D("2000-01-01")), (1, D("2000-01-12")), (2, D("2000-03-01"))]
    steps = [("late", F.col("index_date") > F.lit("2000-01-11").cast("date")), ("one", F.col("patid") == 1)]
    got = rows(cohort.attrition(ix, steps), "step", "name", "n_rows", "n_patients")
    assert got == [(0, "all", 5, 2), (1, "late", 3, 2), (2, "one", 2, 1)]
    assert rows(cohort.attrition(index(spark, (None, "2000-03-01"), (1, "2000-03-01")), steps), "step", "n_rows", "n_patients") == [(0, 2, 1), (1, 2, 1), (2, 1, 1)]
    assert rows(cohort.attrition(ix.limit(0), steps), "step", "n_rows", "n_patients") == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]


def test_codes(spark):
    codes = tables.code_list(spark, [("g", "a%", "like"), ("g", "ab", "exact"), ("h", "b", "exact", "F", None)])
    r = spark.createDataFrame([(1, "ab", "F", "P"), (2, "b", "O", "P"), (3, "b", "F", "S"), (4, None, "F", "P")], "patid long, code string, enctype string, pdx string")
    assert rows(cohort.match_codes(r, codes), "patid", "grp") == [(1, "g"), (3, "h")]
    assert rows(cohort.match_codes(r.drop("enctype", "pdx"), codes), "patid", "grp") == [(1, "g"), (2, "h"), (3, "h")]
    assert rows(cohort.care_setting(r, "F", "P"), "patid") == [(1,), (4,)]
    with pytest.raises(ValueError):
        tables.code_list(spark, [("g", "a", "regex")])


def test_truncation_and_overlap(spark):
    e = spark.createDataFrame([(1, "a", D("2000-01-01"), D("2000-01-31")), (1, "b", D("2000-01-10"), D("2000-02-10")), (1, "b", D("2000-01-01"), D("2000-01-02"))], "patid long, code string, start_date date, end_date date")
    a, b = e.where("code = 'a'"), e.where("code = 'b'")
    assert rows(cohort.truncate_at(a, b), "end_date", "truncated") == [(D("2000-01-09"), True)]
    assert rows(outcomes.concomitant(a, b, 3), "start_date", "end_date") == [(D("2000-01-10"), D("2000-01-31"))]
    assert rows(outcomes.switching(e), "code_from", "code_to", "n") == [("a", "b", 1)]


def test_follow_up_ties(spark):
    df = spark.createDataFrame([(1, D("2000-01-01"), D("2000-02-01"), D("2000-02-01")), (2, D("2000-01-01"), None, None), (3, D("2000-01-01"), None, D("2000-01-05"))], "patid long, index_date date, outcome_date date, death_date date")
    assert rows(outcomes.follow_up(df, "2000-12-31", 60), "patid", "reason", "days") == [(1, "outcome", 31), (2, "cap", 60), (3, "death", 4)]
    assert rows(outcomes.follow_up(df.select("patid", "index_date"), "2000-01-31"), "reason") == [("data end",)] * 3


def test_outcomes(spark):
    ix = index(spark, (1, "2000-01-01"), (2, "2000-01-01"))
    r = records(spark, (1, "2000-01-01", "x"), (1, "2000-01-02", "x"), (1, "2000-01-12", "x"), (1, "2000-01-13", "x"), (2, "2001-01-02", "x"))
    assert rows(outcomes.first_outcome(ix, r, 1, 365), "patid", "outcome_date") == sorted([(1, D("2000-01-02")), (2, None)])
    assert rows(outcomes.count_outcomes(ix, r, 1, 365, 10), "patid", "n_outcomes") == [(1, 2), (2, 0)]
    both = outcomes.combine_events(r.where("adate = '2000-01-02'"), r.where("adate >= '2000-01-12'"), 10)
    assert rows(both, "event_date") == [(D("2000-01-12"),)]
    got = outcomes.self_controlled(ix, r, (1, 10), (11, 20)).first()
    assert (got.n_risk, got.n_control, got.rate_ratio) == (1, 2, 0.5)
    assert rows(outcomes.event_sequences(r, 2), "path", "n") == [("x>x", 3)]
    last = summaries.latest_value(index(spark, (1, "2000-01-12"), (2, "2000-01-01")), r, "code")
    assert rows(last, "patid", "value") == [(1, "x"), (2, None)]


def test_latest_value_odd(spark):
    day = D("2000-01-05")
    r = spark.createDataFrame([(1, day, "a"), (1, day, "b"), (1, day, None), (1, None, "z"), (None, day, "n"), (3, day, None)], "patid long, adate date, code string")
    ix = spark.createDataFrame([(1, day, "one"), (1, day, "one"), (1, None, "no day"), (None, day, "nobody"), (3, day, "null value")], "patid long, index_date date, code string")
    got = [(x.code, x.value_date, x.value) for x in summaries.latest_value(ix, r, "code").collect()]
    assert sorted(got, key=str) == [("no day", None, None), ("nobody", None, None), ("null value", day, None), ("one", day, "b"), ("one", day, "b")]
    assert summaries.latest_value(ix.limit(0), r, "code").count() == 0


def test_person_time_sums_to_the_spans(spark):
    s = spans(spark, (1, "1999-12-31", "2001-01-01"), (2, "2000-02-29", "2000-02-29"), names=("span_start", "span_end"))
    got = rows(outcomes.person_time(s), "period", "days", "n_patients")
    assert got == [(D("1999-01-01"), 1, 1), (D("2000-01-01"), 367, 2), (D("2001-01-01"), 1, 1)]
    assert sum(r.days for r in outcomes.person_time(s, "month").collect()) == 369


def test_adherence(spark):
    s = cohort.stockpile(fills(spark, (1, "a", "2000-01-01", 10), (1, "a", "2000-01-05", 10)))
    got = outcomes.adherence(s, index(spark, (1, "2000-01-01"), (2, "2000-01-01")), 40)
    assert rows(got, "patid", "covered", "pdc") == [(1, 20, 0.5), (2, 0, 0.0)]


def test_pregnancy(spark):
    ends = spark.createDataFrame([(1, "t", D("2000-12-31")), (1, "s", D("2000-01-31"))], "patid long, kind string, end_date date")
    lengths = spark.createDataFrame([("t", 280), ("s", 30)], "kind string, duration int")
    used = spark.createDataFrame([(1, D("2000-12-31"), D("2001-02-01"))], "patid long, start_date date, end_date date")
    got = rows(outcomes.pregnancy_episodes(ends, lengths, used), "preg_start", "trimester", "exposed")
    assert got == [(D("2000-01-01"), 1, False), (D("2000-03-26"), 1, False), (D("2000-03-26"), 2, False), (D("2000-03-26"), 3, True)]


def test_survival_and_tests(spark):
    df = spark.createDataFrame([(1, 1, 5, 1), (2, 1, 8, 0), (3, 0, 5, 1), (4, 0, 9, 1)], "patid long, treat int, days long, event int")
    km = rows(summaries.kaplan_meier(df, []), "time", "n_risk", "n_events", "survival")
    assert [x[:3] for x in km] == [(5, 4, 2), (8, 2, 0), (9, 1, 1)] and [x[3] for x in km] == pytest.approx([0.5, 0.5, 0.0])
    lr = compare.log_rank(df).first()
    assert (lr.observed, lr.expected) == (1, 1.0) and lr.variance == pytest.approx(2 * 0.25 * 2 / 3)
    mh = compare.mantel_haenszel(df, []).first()
    assert mh.risk_ratio == 0.5 and mh.risk_difference == -0.5
    rate = summaries.incidence_rate(df, []).first()
    assert rate.rate == pytest.approx(3 * 365250 / 27) and rate.low < rate.rate < rate.high


def test_tables_of_results(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 12), (3, "b", 0)], "patid long, g string, n int")
    assert rows(summaries.suppress_small(df, ["n"], 11), "patid", "suppressed") == [(1, True), (2, False), (3, False)]
    assert rows(summaries.histogram_by(df, "n", [1, 10], []), "band", "n") == [("1-9", 1), ("<1", 1), (">=10", 1)]
    assert summaries.combine_sites([df, df], ["g"], ["n"]).where("g = 'a'").first().n == 30
    d = summaries.describe_by(df, "n", []).first()
    assert (d.n, d.mean, d.median, d.most) == (3, 5, 3, 12)
    assert summaries.counts_by(df, [["g"], []]).count() == 3


def test_scores_and_weights(spark):
    df = spark.createDataFrame([(1, 1, 0.8), (2, 0, 0.2), (3, 1, 0.5), (4, 0, 0.5)], "patid long, treat int, ps double")
    assert rows(compare.ps_weights(df), "patid", "weight") == [(1, 1.25), (2, 1.25), (3, 2.0), (4, 2.0)]
    assert rows(compare.ps_weights(df, "att"), "patid", "weight") == [(1, 1.0), (2, 0.25), (3, 1.0), (4, 1.0)]
    balance = summaries.balance_table(df, "treat", ["ps"]).first()
    assert balance.mean_1 == pytest.approx(0.65) and balance.mean_0 == pytest.approx(0.35)
    assert rows(compare.ps_strata(df, 2, trim=False), "patid", "stratum") == [(1, 2), (2, 1), (3, 1), (4, 1)]
    cells = df.withColumn("g", F.lit(1))
    assert rows(compare.match_in_cells(cells, ["g"]), "treated", "control") == [(1, 2), (3, 4)]


def greedy(given, caliper):
    """Nearest pairs first, ties by ids; distances are exact."""
    pairs = sorted((abs(Fraction(s) - Fraction(c)), t, u) for t, a, s in given if a == 1 and s is not None for u, b, c in given if b == 0 and c is not None and abs(s - c) <= caliper)
    treated, controls, found = set(), set(), []
    for _, t, c in pairs:
        if t not in treated and c not in controls:
            treated.add(t)
            controls.add(c)
            found.append((t, c))
    return sorted(found)


def matched(spark, given, caliper, **more):
    df = spark.createDataFrame(given, "patid long, treat int, ps double").repartition(3)
    return rows(compare.match_caliper(df, caliper, **more), "treated", "control")


@pytest.mark.parametrize("segments", [1, 40])
@pytest.mark.parametrize("scores", ["spread", "dense", "few", "near ties", "chain"])
def test_caliper_matching_equals_greedy(spark, scores, segments):
    """Scores far apart and close, tied, at equal distances, and ever nearer to the next: whatever the segments are."""
    rng = random.Random(scores)
    make = {
        "spread": lambda i: rng.random(), "dense": lambda i: rng.random() / 20, "few": lambda i: rng.choice([0, 2, 4, 9, 11, 30]) / 64,
        "near ties": lambda i: rng.randrange(40) / 64, "chain": lambda i: 1 - 0.97**i,
    }[scores]
    given = [(i, i % 2 if scores == "chain" else rng.randrange(2), make(i)) for i in range(160)]
    given += [(500, 1, None), (501, None, 0.5), (502, 3, 0.5)]
    caliper = {"spread": 0.02, "dense": 0.01}.get(scores, 3 / 64)
    assert matched(spark, given, caliper, segments=segments) == greedy(given, caliper)


def test_caliper_matching_odd(spark):
    assert matched(spark, [(1, 1, 0.5), (2, 1, 0.6)], 0.2) == [] and matched(spark, [], 0.2) == []
    assert matched(spark, [(i, int(i < 300), 0.5 if i < 300 else 0.51) for i in range(310)], 0.05) == [(i, 300 + i) for i in range(10)]


def test_caliper_matching_takes_as_many_jobs_for_any_number_of_matches(spark):
    def jobs(n):
        group = f"caliper-{n}"
        spark.sparkContext.setJobGroup(group, "")
        given = [(i, int(i < n), 0.5 if i < n else 0.51) for i in range(2 * n)]
        assert len(matched(spark, given, 0.05)) == n
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert 0 < jobs(1000) <= jobs(8) + 8


@settings(max_examples=150, deadline=None)
@given_by(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30)), max_size=24), st.integers(1, 12), st.integers(0, 24), st.integers(0, 24))
def test_segments_match_only_what_is_certain(points, caliper, cut_a, cut_b):
    """What a segment settles is what the greedy order over all points settles."""
    given = sorted((float(s), i, arm) for i, (arm, s) in enumerate(points))
    low, high = sorted((cut_a, cut_b))
    inside, left, right = given[low:high], given[:low], given[high:]
    near = lambda rows, arm, pick: pick([s for s, _, a in rows if a == arm], default=None)
    outside = (near(left, 0, max), near(left, 1, max), near(right, 0, min), near(right, 1, min))
    counts = {k: sum(a == k for *_, a in given) for k in (0, 1)}
    got, t_left, c_left = matching.match([(s, i) for s, i, a in inside if a], [(s, i) for s, i, a in inside if not a], outside, float(caliper), counts)
    expected = greedy([(i, a, s) for s, i, a in given], caliper)
    assert {(t, c) for t, c, _ in got} <= set(expected)
    settled = {i for _, i, _ in inside} - {i for _, i in t_left} - {i for _, i in c_left}
    assert {p for p in expected if p[0] in settled or p[1] in settled} == {(t, c) for t, c, _ in got}


def test_propensity_is_calibrated(spark):
    rng = random.Random(4)
    given = [(i, x := rng.random(), int(rng.random() < 0.2 + 0.6 * x)) for i in range(3000)]
    got = compare.propensity(spark.createDataFrame(given, "patid long, x double, treat int"), "treat", ["x"])
    low, high = (got.where(c).agg(F.avg("ps"), F.avg("treat")).first() for c in ("x < 0.3", "x > 0.7"))
    assert abs(low[0] - low[1]) < 0.05 and abs(high[0] - high[1]) < 0.05


@pytest.mark.parametrize("regularisation", [0.0, 0.1])
def test_propensity_equals_the_library_fit(spark, regularisation):
    """Against pyspark.ml over patients, with a covariate that others imply and one that does not vary."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rng = random.Random(6)
    given = [(i, a := rng.randrange(3), b := rng.randrange(2), a + b, 1, int(rng.random() < 0.2 + 0.2 * a)) for i in range(600)]
    df = spark.createDataFrame(given, "patid long, a int, b int, c int, d int, treat int")
    names = ["a", "b", "c", "d"]
    x = VectorAssembler(inputCols=names, outputCol="x").transform(df)
    model = LogisticRegression(featuresCol="x", labelCol="treat", regParam=regularisation, tol=1e-12, maxIter=500).fit(x)
    expected = dict(rows(model.transform(x).withColumn("p", vector_to_array("probability")[1]), "patid", "p"))
    got = compare.propensity(df, "treat", names, regularisation)
    assert dict(rows(got, "patid", "ps")) == pytest.approx(expected, abs=1e-5)
    assert got.select("a", "b", "ps").distinct().count() == 6


def test_propensity_odd(spark):
    df = spark.createDataFrame([(1, 0.0, 1), (2, 1.0, 0), (3, None, 1), (4, 1.0, None), (5, 0.0, 0)], "patid long, x double, treat int")
    got = {r.patid: r.ps for r in compare.propensity(df, "treat", ["x"]).collect()}
    assert got[3] is None and got[1] == got[5] == pytest.approx(0.5) and got[2] == got[4] < 1e-6
    assert compare.propensity(df.limit(0), "treat", ["x"]).collect() == []
    assert all(r.ps > 1 - 1e-6 for r in compare.propensity(df.where("treat = 1 and x is not null"), "treat", ["x"]).collect())


def test_tree(spark):
    counts = spark.createDataFrame([("a1", 2), ("a2", 3), ("b", 5)], "code string, n long")
    tree = spark.createDataFrame([("a", "a1"), ("a", "a2"), ("root", "a"), ("root", "b")], "parent string, child string")
    assert rows(compare.tree_counts(counts, tree, ["n"]), "node", "n") == [("a", 5), ("a1", 2), ("a2", 3), ("b", 5), ("root", 10)]
    loop = tree.unionByName(spark.createDataFrame([("a1", "root"), (None, "b"), ("b", None)], "parent string, child string"))
    assert rows(compare.tree_counts(counts, loop, ["n"]), "node", "n") == [("a", 10), ("a1", 10), ("a2", 3), ("b", 5), ("root", 10)]
    assert rows(compare.tree_counts(counts, tree.limit(0), ["n"]), "node", "n") == [("a1", 2), ("a2", 3), ("b", 5)]


def test_deep_tree_and_shared_children(spark):
    """A chain 200 deep; a ladder of 30 rungs, where a code has 2^30 ways up, counts once a node."""
    chain = [(f"c{k}", f"c{k + 1}") for k in range(200)]
    ladder = [(f"{side}{k}", f"{other}{k + 1}") for k in range(30) for side in "xy" for other in "xy"]
    tree = spark.createDataFrame(chain + ladder, "parent string, child string")
    counts = spark.createDataFrame([("c200", 1), ("c100", 2), ("x30", 5), ("y30", 7), (None, 9)], "code string, n long")
    got = dict(rows(compare.tree_counts(counts.where("code is not null"), tree, ["n"]), "node", "n"))
    assert got == {f"c{k}": 3 if k <= 100 else 1 for k in range(201)} | {f"{s}{k}": 12 for k in range(30) for s in "xy"} | {"x30": 5, "y30": 7}


def test_comorbidity_and_use(spark):
    ix = index(spark, (1, "2000-02-01"), (2, "2000-02-01"))
    r = records(spark, (1, "2000-01-01", "x"), (1, "2000-01-02", "x"), (1, "2000-01-03", "y"), (1, "2000-02-01", "z"))
    weights = spark.createDataFrame([("x", 2), ("y", -1), ("z", 9)], "condition string, weight long")
    assert rows(summaries.comorbidity_score(ix, r, weights, 60), "patid", "score") == [(1, 1), (2, 0)]
    matrix = compare.covariate_matrix(ix, r, ["x", "z"], -60, -1)
    assert rows(matrix, "patid", "x", "z") == [(1, 1, 0), (2, 0, 0)]


def test_quantiles_equal_sorting(spark):
    rng = random.Random(8)
    given = [(rng.choice(["a", "b", None]), rng.choice([None, float("-inf"), rng.randrange(9), rng.random() * 9])) for _ in range(900)] + [("c", 4.0), ("d", None)]
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in given], "g string, v double").repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.quantiles for r in order.quantiles(df.where("v is null or v > -1"), "v", ["g"], shares).collect()}
    for g in ("a", "b", None, "c"):
        assert got[g] == pytest.approx(np.quantile([v for h, v in given if h == g and v is not None and v > -1], shares).tolist())
    assert set(got) == {"a", "b", None, "c", "d"} and got["d"] == [None] * 6
    described = {r.g: r for r in summaries.describe_by(df, "v", ["g"]).collect()}
    assert described["d"].n == 0 and described["d"].median is None and described["c"].q1 == 4.0 and described["c"].sd is None
    own = [v for h, v in given if h is None and v is not None and v > -1]
    spread = {r.g: r for r in summaries.describe_by(df.where("v > -1"), "v", ["g"]).collect()}[None]
    assert [spread.n, spread.mean, spread.sd, spread.least, spread.most] == pytest.approx([len(own), np.mean(own), np.std(own, ddof=1), min(own), max(own)])
    assert summaries.describe_by(df.where("v > -1"), "v", []).first().median == pytest.approx(np.median([v for _, v in given if v is not None and v > -1]))
    assert order.quantiles(df.limit(0), "v", [], [0.5]).collect()[0].quantiles == [None] and order.quantiles(df.limit(0), "v", ["g"], [0.5]).count() == 0


def test_quantiles_of_a_group_do_not_meet_in_one_task(spark):
    """One group of many values: its rows are sorted in several tasks, and no percentile buffers them."""
    df = spark.range(0, 20_000, 1, 6).select(F.lit("one").alias("g"), F.pmod(F.col("id") * 7919, F.lit(20_011)).cast("double").alias("v"))
    placed = order.running(df, ["g"], ["v"], F.lit(1))
    per_task = placed.groupBy(F.floor(F.col("_before") / 20_000 * 4)).count().collect()
    assert len(per_task) == 4 and placed.where("_total = 20000").count() == 20_000
    assert "percentile" not in order.quantiles(df, "v", ["g"], [0.5])._jdf.queryExecution().toString()
    values = sorted(r.v for r in df.collect())
    assert order.quantiles(df, "v", ["g"], [0.5]).first().quantiles == [(values[9999] + values[10_000]) / 2]


def naive_apart(dates, blackout):
    taken = []
    for d in sorted(set(dates)):
        if not taken or (d - taken[-1]).days > blackout:
            taken.append(d)
    return taken


@pytest.mark.parametrize("blackout", [-5, 0, 1, 30, 400])
def test_entry_nonoverlap_equals_a_loop(spark, blackout):
    rng = random.Random(blackout)
    day = lambda k: date(2000, 1, 1) + timedelta(k)
    given = [(rng.choice([None, 1, 2, 3]), day(rng.randrange(-900, 900))) for _ in range(400)] + [(4, None), (4, day(3)), (5, None)]
    df = spark.createDataFrame(given, "patid long, index_date date").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # patients go on over batches
    try:
        got = [tuple(r) for r in cohort.entry_nonoverlap(df, blackout).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    expected = [(p, d) for p in {p for p, _ in given} for d in naive_apart([d for q, d in given if q == p and d], blackout)]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_entry_nonoverlap_of_a_million_dates(spark):
    df = spark.range(1_000_000).select(F.lit(7).cast("long").alias("patid"), F.date_from_unix_date(F.col("id").cast("int")).alias("index_date"))
    began = time.time()
    assert cohort.entry_nonoverlap(df, 1).count() == 500_000 and time.time() - began < 60


def overlapping_naive(a, b):
    return sorted((p, max(s, t), min(e, f)) for p, s, e in a for q, t, f in b if p == q and s <= f and t <= e and s <= e and t <= f)


def test_overlaps_equal_all_pairs(spark):
    """Short and very long spans, spans of one day, spans that end before they start, open ends."""
    rng = random.Random(12)
    base = date(1, 1, 1).toordinal()

    def some(n):
        out = []
        for _ in range(n):
            start = rng.choice([date(1999, 1, 1), date(1965, 1, 1), date(1400, 5, 5)]).toordinal() + rng.randrange(400)
            end = min(start + rng.choice([-1, 0, 1, 63, 64, 1000, 20_000, 300_000]), date(9999, 12, 31).toordinal())
            out.append((rng.randrange(2), date.fromordinal(start), date.fromordinal(max(base, end))))
        return out + [(1, date(2000, 1, 1), date(9999, 12, 31))]

    a, b = some(60), some(60)
    names = "patid long, span_start date, span_end date"
    got = cohort.intersect_spans(spark.createDataFrame([*a, (1, None, None), (None, a[0][1], a[0][2])], names), spark.createDataFrame([*b, (None, b[0][1], b[0][2])], names))
    assert rows(got, "patid", "span_start", "span_end") == overlapping_naive(a, b)


def test_overlaps_of_one_long_history(spark):
    """Two times 50,000 spans of one patient, which make 2.5 thousand million pairs: those of a bucket meet, no others."""
    day = F.date_from_unix_date((F.col("id") * 3).cast("int"))
    a = spark.range(50_000).select(F.lit(1).cast("long").alias("patid"), day.alias("span_start"), F.date_add(day, 1).alias("span_end"))
    b = a.select("patid", F.date_add("span_start", 1).alias("span_start"), F.date_add("span_end", 1).alias("span_end"))
    assert cohort.intersect_spans(a, b).count() == 50_000
    index = a.select("patid", F.col("span_start").alias("index_date"))
    assert cohort.require_enrollment(index, a, 0).count() == 50_000 and cohort.require_enrollment(index, b, 0).count() == 0


def test_enrollment_of_odd_rows(spark):
    covered = spans(spark, (1, "2000-01-01", "2000-12-31"), (1, "2002-01-01", "2002-12-31"), names=("span_start", "span_end"))
    ix = index(spark, (1, "2000-01-01"), (1, "2000-12-31"), (1, "2001-01-01"), (1, "2002-07-01"), (1, "2002-07-01"), (2, "2000-05-05")).withColumn("span_start", F.lit("x"))
    got = cohort.require_enrollment(ix.drop("span_start").withColumn("note", F.lit("n")), covered, 0)
    assert got.columns == ["patid", "index_date", "note", "enr_end"]
    assert [(str(d), str(e)) for d, e in rows(got, "index_date", "enr_end")] == [("2000-01-01", "2000-12-31"), ("2000-12-31", "2000-12-31"), ("2002-07-01", "2002-12-31"), ("2002-07-01", "2002-12-31")]


def test_repeated_index_rows_stay(spark):
    ix = index(spark, (1, "2000-01-01"), (1, "2000-01-01"), (2, "2000-01-01"), (None, "2000-01-01"))
    r = records(spark, (1, "2000-01-05", "x"), (1, "2000-01-06", "x"))
    assert [d for d in sorted(str(x.outcome_date) for x in outcomes.first_outcome(ix, r, 0, 30).collect())] == ["2000-01-05", "2000-01-05", "None", "None"]
    assert sorted(x.x for x in compare.covariate_matrix(ix, r, ["x"], 0, 30).collect()) == [0, 0, 1, 1]


def test_counts_by_sets_of_strata(spark):
    """Null patients and strata; patients in several cells; the plan expands nothing."""
    given = [(1, "a", 1), (1, "a", 1), (1, "a", 2), (1, "b", None), (2, "a", 1), (2, None, 1), (None, "a", 1), (None, "a", 2)]
    df = spark.createDataFrame(given, "patid long, g string, k int")
    sets = [["g", "k"], ["k"], ["g"], []]
    got = {(r.grouping, r.g, r.k): (r.n_rows, r.n_patients) for r in summaries.counts_by(df, sets).collect()}
    expected = {}
    for grouping, s in enumerate(sets):
        for cell in {tuple(r[1 + i] if c in s else None for i, c in enumerate(("g", "k"))) for r in given}:
            own = [r for r in given if all(r[1 + i] == cell[i] for i, c in enumerate(("g", "k")) if c in s)]
            expected[{0: 0, 1: 2, 2: 1, 3: 3}[grouping], *cell] = len(own), len({r[0] for r in own} - {None})
    assert got == expected
    assert "Expand" not in summaries.counts_by(df, sets)._jdf.queryExecution().executedPlan().toString()
    assert summaries.counts_by(df.limit(0), sets).count() == 0


def test_truncate_at_keeps_equal_rows_apart_and_cuts_without_a_code(spark):
    given = [(1, None, D("2000-01-01"), D("2000-01-31")), (1, "a", D("2000-01-01"), D("2000-01-31")), (1, "a", D("2000-01-01"), D("2000-01-31")), (None, "a", D("2000-01-01"), D("2000-01-31")), (1, "c", D("2000-01-10"), D("2000-01-12"))]
    e = spark.createDataFrame(given, "patid long, code string, start_date date, end_date date")
    other = spark.createDataFrame([(1, D("2000-01-20")), (1, D("2000-01-10")), (1, D("2000-01-01")), (None, D("2000-01-10"))], "patid long, start_date date")
    got = sorted(map(str, (tuple(r) for r in cohort.truncate_at(e, other).select("patid", "code", F.col("end_date").cast("string"), "truncated").collect())))
    cut = "'2000-01-09', True"
    assert got == sorted([f"(1, None, {cut})", f"(1, 'a', {cut})", f"(1, 'a', {cut})", "(None, 'a', '2000-01-31', False)", "(1, 'c', '2000-01-12', False)"])


def test_overlaps_place_rows_on_levels_that_the_other_side_has(spark):
    """Short intervals meet short ones in one or two buckets each; a long one brings back its level."""
    short = spark.createDataFrame([(1, D("2000-01-01") + timedelta(k), D("2000-01-10") + timedelta(k)) for k in range(100)], "patid long, s date, e date")
    for end, most in ((D("2000-02-01"), 200), (D("2010-01-01"), 310), (D("9999-12-31"), 310)):
        a = spark.createDataFrame([(1, D("2000-01-05"), end)], "patid long, start_date date, end_date date")
        met = overlaps._levelled(a, "start_date", "end_date", "_level_a").agg(F.collect_set("_level_a").alias("_met"))
        assert overlaps._spread(overlaps._levelled(short, "s", "e", "_level_b"), "s", "e", "_level_b", met).count() <= most
        assert overlaps.overlapping(a, short, ("start_date", "end_date"), ("s", "e")).count() == short.where((F.col("s") <= F.lit(end)) & (F.col("e") >= F.lit(D("2000-01-05")))).count()
    assert overlaps.overlapping(a.limit(0), short, ("start_date", "end_date"), ("s", "e")).count() == 0
