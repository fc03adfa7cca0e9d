"""Hand-computed fixtures of the temporal operators."""

import pytest
from helpers import HOUR, MINUTE, at, clock, rows
from pyspark.sql import functions as F

from icuqm.functions.time import DAY
from icuqm.operators.asof import asof_contained, asof_join
from icuqm.operators.episodes import bookend_sessions, episodes, first_event, next_event, persists, runs, transitions
from icuqm.operators.grid import hourly_scaffold, stitch_stays
from icuqm.operators.intervals import (
    carry_forward,
    count_before,
    lead_intervals,
    off_gaps,
    qualify_holds,
    split_by_day,
    step_segments,
    union_intervals,
)
from icuqm.operators.overlap import (
    attribute_events,
    intersect_intervals,
    not_in_any,
    overlap_flag,
    overlap_minutes,
    points_in_intervals,
)
from icuqm.operators.steps import normalise_dose, ratio_around_gap, sample_steps, sum_steps

# small buckets make the fixtures cross bucket borders
WIDTHS = [DAY, HOUR]


@pytest.mark.parametrize("width", WIDTHS)
def test_carry_forward_window_is_inclusive(spark, width):
    df = spark.createDataFrame(
        [("a", at("0:00"), 10.0), ("a", at("1:00"), None), ("a", at("2:00"), None), ("a", at("2:01"), None), ("b", at("2:01"), None)],
        "k string, t long, v double",
    )
    out = carry_forward(df, ["k"], "t", {"c": (F.col("v"), 2 * HOUR)}, width=width)
    got = {(r.k, clock(r.t)): r.c for r in out.collect()}
    assert got == {("a", "0d00:00"): 10, ("a", "0d01:00"): 10, ("a", "0d02:00"): 10, ("a", "0d02:01"): None, ("b", "0d02:01"): None}


def test_carry_forward_with_interval_in_one_pass(spark):
    df = spark.createDataFrame([("a", at("22:00"), 1.0), ("a", at("23:30"), None)], "k string, t long, v double")
    out = carry_forward(df, ["k"], "t", {"c": (F.col("v"), 2 * HOUR)}, lead=(DAY, HOUR))
    assert sorted((clock(r.start), clock(r.end), r.c) for r in out.collect()) == [("0d22:00", "0d23:30", 1.0), ("0d23:30", "1d00:30", 1.0)]


@pytest.mark.parametrize("width", WIDTHS)
def test_lead_intervals(spark, width):
    df = spark.createDataFrame([("a", at("22:00")), ("a", at("23:30")), ("a", at("23:31", 1))], "k string, t long")
    out = lead_intervals(df, ["k"], "t", width=width)
    assert [(clock(s), clock(e)) for s, e in rows(out, "start", "end")] == [
        ("0d22:00", "0d23:30"),
        ("0d23:30", "1d00:30"),
        ("1d23:31", "2d00:31"),
    ]


def test_lead_intervals_of_duplicate_times_are_empty_then_dropped_by_the_split(spark):
    df = spark.createDataFrame([("a", at("8:00"), 1), ("a", at("8:00"), 2), ("a", at("9:00"), 3)], "k string, t long, id int")
    out = lead_intervals(df, ["k"], "t", tiebreak=["id"])
    assert rows(split_by_day(out), "id") == [(2,), (3,)]


def test_split_by_day(spark):
    df = spark.createDataFrame([(at("23:30"), at("0:30", 1))], "start long, end long")
    assert [(str(d), m) for d, m in rows(split_by_day(df), "day", "minutes")] == [("2024-01-10", 30.0), ("2024-01-11", 30.0)]


@pytest.mark.parametrize(("day", "minutes"), [("2024-03-10", 1380.0), ("2024-11-03", 1500.0), ("2024-06-01", 1440.0)])
def test_split_by_day_counts_elapsed_minutes_around_clock_changes(spark, day, minutes):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    df = spark.sql(
        f"select unix_micros(timestamp'{day} 00:00:00') - 1800000000 as start, unix_micros(cast(date_add(date'{day}', 1) as timestamp)) + 60000000 as end"
    )
    got = {str(d): m for d, m in rows(split_by_day(df), "day", "minutes")}
    assert got[day] == minutes
    assert sum(got.values()) == minutes + 31


def test_two_piece_split_gives_the_rest_to_the_next_day(spark):
    df = spark.createDataFrame([(at("23:30"), at("0:30", 2))], "start long, end long")
    assert [m for _, m in rows(split_by_day(df, two_piece=True), "day", "minutes")] == [30.0, 1470.0]
    assert [m for _, m in rows(split_by_day(df), "day", "minutes")] == [30.0, 1440.0, 30.0]


@pytest.mark.parametrize("width", WIDTHS)
def test_step_segments_cap_only_the_last_row(spark, width):
    df = spark.createDataFrame([("a", at("8:00"), 5.0), ("a", at("10:00"), 0.0)], "k string, t long, dose double")
    out = step_segments(df, ["k"], "t", active=F.col("dose") > 0, width=width)
    assert [(clock(s), clock(e), a) for s, e, a in rows(out, "start", "end", "active")] == [("0d08:00", "0d10:00", True), ("0d10:00", "1d10:00", False)]


@pytest.mark.parametrize("width", WIDTHS)
def test_union_merges_overlap_and_touch(spark, width):
    spans = [("1:00", "3:00"), ("3:00", "5:00"), ("7:00", "9:00"), ("8:00", "10:00")]
    df = spark.createDataFrame([("a", at(s), at(e)) for s, e in spans], "k string, start long, end long")
    out = union_intervals(df, ["k"], width=width)
    assert [(clock(s), clock(e)) for s, e in rows(out, "start", "end")] == [("0d01:00", "0d05:00"), ("0d07:00", "0d10:00")]
    assert rows(union_intervals(out, ["k"], width=width), "start", "end") == rows(out, "start", "end")


@pytest.mark.parametrize("width", WIDTHS)
def test_off_gaps_and_holds(spark, width):
    active = spark.createDataFrame([("a", at("8:00"), at("10:00")), ("a", at("11:00"), at("12:00"))], "k string, s long, e long")
    windows = spark.createDataFrame([("a", 1, at("6:00"), at("14:00")), ("a", 2, at("15:00"), at("16:00"))], "k string, d int, lo long, hi long")
    gaps = off_gaps(active, windows, ["k"], ["d"], ("s", "e"), ("lo", "hi"), width)
    assert [(clock(s), clock(e), r) for s, e, r in rows(gaps, "gap_start", "gap_end", "resumed")] == [
        ("0d10:00", "0d11:00", True),
        ("0d12:00", "0d14:00", False),
    ]
    held = qualify_holds(gaps, ["k", "d"], 30 * MINUTE).collect()
    assert [(h.n_holds, h.longest_off_min, h.resumed, clock(h.first_hold)) for h in held] == [(2, 120.0, True, "0d10:00")]


@pytest.mark.parametrize("width", WIDTHS)
def test_asof_tolerance(spark, width):
    left = spark.createDataFrame([("a", at("10:00")), ("b", at("10:00")), ("c", at("10:00"))], "k string, t long")
    right = spark.createDataFrame([("a", at("6:00"), 1), ("a", at("5:59"), 2), ("b", at("5:59"), 3)], "k string, r long, v int")
    out = asof_join(left, right, ["k"], "t", "r", tolerance=4 * HOUR, width=width)
    assert rows(out.fillna(-1), "k", "v") == [("a", 1), ("b", -1), ("c", -1)]
    free = asof_join(left, right, ["k"], "t", "r", width=width)
    assert rows(free.fillna(-1), "k", "v") == [("a", 1), ("b", 3), ("c", -1)]


def test_asof_strict_and_ties(spark):
    left = spark.createDataFrame([("a", at("10:00"))], "k string, t long")
    right = spark.createDataFrame([("a", at("10:00"), 1), ("a", at("10:00"), 2), ("a", at("9:00"), 3)], "k string, r long, v int")
    assert rows(asof_join(left, right, ["k"], "t", "r", tiebreak=["v"]), "v") == [(2,)]
    assert rows(asof_join(left, right, ["k"], "t", "r", tiebreak=["v"], strict=True), "v") == [(3,)]


def test_asof_contained_tests_only_the_latest_started_stay(spark):
    stays = spark.createDataFrame([("a", at("1:00"), at("10:00")), ("a", at("5:00"), at("6:00")), ("b", at("1:00"), None)], "k string, i long, o long")
    left = spark.createDataFrame([("a", at("8:00")), ("a", at("4:00")), ("b", at("8:00"))], "k string, t long")
    out = asof_contained(left, stays, ["k"], "t", "i", "o", "inside")
    assert [(k, clock(t), i) for k, t, i in rows(out, "k", "t", "inside")] == [("a", "0d04:00", True), ("a", "0d08:00", False), ("b", "0d08:00", False)]


@pytest.mark.parametrize("width", WIDTHS)
def test_interval_joins(spark, width):
    a = spark.createDataFrame([("k", 1, at("8:00"), at("20:00", 1))], "k string, id int, s long, e long")
    b = spark.createDataFrame([("k", at("6:00"), at("9:00")), ("k", at("19:00", 1), at("23:00", 1)), ("k", at("20:00", 1), at("21:00", 1))], "k string, x long, y long")
    out = intersect_intervals(a, b, ["k"], ("s", "e"), ("x", "y"), width)
    assert [(clock(s), clock(e)) for s, e in rows(out, "start", "end")] == [("0d08:00", "0d09:00"), ("1d19:00", "1d20:00")]
    assert rows(overlap_minutes(a, b, ["k"], ["id"], ("s", "e"), ("x", "y"), "m", width), "m") == [(120.0,)]
    none = spark.createDataFrame([("k", 2, at("2:00"), at("3:00"))], "k string, id int, s long, e long")
    assert rows(overlap_flag(none, b, ["k"], ["id"], ("s", "e"), ("x", "y"), "f", width), "f") == [(False,)]
    assert rows(overlap_minutes(none, b, ["k"], ["id"], ("s", "e"), ("x", "y"), "m", width), "m") == [(0.0,)]


def test_points_in_intervals_borders(spark):
    spans = spark.createDataFrame([("k", "first", at("1:00"), at("5:00")), ("k", "second", at("5:00"), at("9:00"))], "k string, n string, i long, o long")
    pts = spark.createDataFrame([("k", at("5:00")), ("k", at("9:00"))], "k string, t long")
    assert rows(points_in_intervals(pts, spans, ["k"], "t", ("i", "o")), "n") == [("second",)]
    both = points_in_intervals(pts, spans, ["k"], "t", ("i", "o"), closed="both", keep="earliest")
    assert [(clock(t), n) for t, n in rows(both, "t", "n")] == [("0d05:00", "first"), ("0d09:00", "second")]


def test_not_in_any(spark):
    spans = spark.createDataFrame([("on", at("20:00"), at("2:00", 1)), ("off", at("20:00"), at("23:00"))], "k string, s long, e long")
    pts = spark.createDataFrame([("on", 1, at("0:00", 1)), ("off", 1, at("0:00", 1))], "k string, d int, t long")
    assert rows(not_in_any(pts, spans, ["k"], ["d"], "t", ("s", "e"), "free"), "k", "free") == [("off", True), ("on", False)]


@pytest.mark.parametrize("width", WIDTHS)
def test_count_before_is_strict(spark, width):
    days = spark.createDataFrame([("a", 1, at("8:00")), ("a", 2, at("9:00")), ("b", 1, at("9:00"))], "k string, d int, t long")
    ev = spark.createDataFrame([("a", at("7:00")), ("a", at("8:00"))], "k string, r long")
    assert rows(count_before(days, ev, ["k"], "t", "r", "n", width), "k", "d", "n") == [("a", 1, 1), ("a", 2, 2), ("b", 1, 0)]


def test_attribute_events_fills_days_without_events(spark):
    days = spark.createDataFrame([("a", 1, at("8:00"), at("10:00")), ("a", 2, at("10:00"), at("12:00"))], "k string, d int, lo long, hi long")
    ev = spark.createDataFrame([("a", at("8:00"), "ps"), ("a", at("9:00"), "cpap")], "k string, t long, arm string")
    aggs = {"n": (F.count(F.lit(1)), 0), "arms": (F.array_join(F.array_sort(F.collect_set("arm")), ","), "")}
    out = attribute_events(days, ev, ["k"], ["d"], ("lo", "hi"), "t", aggs)
    assert rows(out, "d", "n", "arms") == [(1, 2, "cpap,ps"), (2, 0, "")]


@pytest.mark.parametrize("width", WIDTHS)
def test_runs_break_on_flag_and_step(spark, width):
    seq = [("8:00", True), ("9:00", True), ("10:00", False), ("11:00", True), ("14:00", True)]
    df = spark.createDataFrame([("a", at(c), f) for c, f in seq], "k string, t long, f boolean")
    out = runs(df, ["k"], "t", "f", 90 * MINUTE, width=width)
    got = [(clock(s), f, n) for s, f, n in rows(out, "run_start", "f", "run_size")]
    assert got == [("0d08:00", True, 2), ("0d10:00", False, 1), ("0d11:00", True, 1), ("0d14:00", True, 1)]


@pytest.mark.parametrize("width", WIDTHS)
def test_episodes_and_transitions(spark, width):
    seq = [("8:00", "ctrl"), ("9:00", "ctrl"), ("10:00", "ps"), ("10:01", "ps"), ("10:03", "ctrl"), ("12:00", "ctrl")]
    df = spark.createDataFrame([("a", at(c), s) for c, s in seq], "k string, t long, cls string")
    eps = episodes(df, ["k"], "t", "cls", width=width)
    got = [(clock(s), clock(e), c, p, x) for s, e, c, p, x in rows(eps, "start", "end", "cls", "prev_cls", "closed")]
    assert got == [
        ("0d08:00", "0d10:00", "ctrl", None, True),
        ("0d10:00", "0d10:03", "ps", "ctrl", True),
        ("0d10:03", "0d13:00", "ctrl", "ps", False),
    ]
    assert rows(transitions(eps, "cls", ["ps"], ["ctrl"]), "minutes") == [(3.0,)]


def test_episode_of_a_single_row(spark):
    df = spark.createDataFrame([("a", at("8:00"), "ps")], "k string, t long, cls string")
    assert [(clock(s), clock(e)) for s, e in rows(episodes(df, ["k"], "t", "cls"), "start", "end")] == [("0d08:00", "0d09:00")]


@pytest.mark.parametrize("width", WIDTHS)
def test_bookend_sessions(spark, width):
    seq = [("1:00", "prone"), ("5:00", "prone"), ("18:00", "not_prone"), ("20:00", "prone"), ("23:00", "prone")]
    df = spark.createDataFrame([("a", at(c), s) for c, s in seq], "k string, t long, pos string")
    out = bookend_sessions(df, ["k"], "t", "pos", "prone", "not_prone", width=width)
    assert rows(out, "duration_hours", "ended_by") == [(3.0, "end_of_record"), (17.0, "not_prone")]


def test_persistence(spark):
    ev = spark.createDataFrame(
        [("ok", at("0:00"), True), ("ok", at("12:00"), True), ("out", at("0:00"), True), ("out", at("12:00"), True), ("weak", at("0:00"), True), ("never", at("0:00"), False)],
        "k string, t long, meets boolean",
    )
    st = spark.createDataFrame([("ok", at("0:00"), True), ("ok", at("13:00"), True), ("out", at("6:00"), True)], "k string, t long, off boolean")
    out = persists(ev, st, ["k"], "t", "meets", 12 * HOUR, "off")
    got = {r.k: (r.met_again, r.broken, r.persistent, r.n_in_window) for r in out.collect()}
    assert got == {"ok": (True, False, True, 2), "out": (True, True, False, 2), "weak": (False, False, False, 1), "never": (False, False, False, 0)}


@pytest.mark.parametrize("width", WIDTHS)
def test_sum_and_sample_of_steps(spark, width):
    seg = [("A", "8:00", "10:00", 0.1), ("B", "9:00", "20:00", 0.05), ("A", "10:00", "11:00", 0.0)]
    df = spark.createDataFrame([("k", d, at(s), at(e), v) for d, s, e, v in seg], "k string, drug string, start long, end long, v double")
    out = sum_steps(df, ["k"], "drug", ["A", "B"], "v", width=width)
    assert [(clock(t), round(v, 6)) for t, v in rows(out, "t", "total")] == [("0d08:00", 0.1), ("0d09:00", 0.15), ("0d10:00", 0.05)]
    closed = sum_steps(df, ["k"], "drug", ["A", "B"], "v", close_at_cap=True, width=width)
    assert [(clock(t), round(v, 6)) for t, v in rows(closed, "t", "total")][-1] == ("0d20:00", 0.0)
    grid = spark.createDataFrame([("k", at("7:00")), ("k", at("9:30")), ("k", at("23:00"))], "k string, g long")
    got = sample_steps(grid, out, ["k"], "g", "t", {"total": 0.0, "assessable": True}, width=width)
    assert [(clock(g), round(v, 6)) for g, v in rows(got, "g", "total")] == [("0d07:00", 0.0), ("0d09:30", 0.15), ("0d23:00", 0.05)]


def test_unassessable_drug_counts_zero_but_marks_the_sum(spark):
    df = spark.createDataFrame([("k", "A", at("8:00"), at("10:00"), None, False), ("k", "B", at("9:00"), at("20:00"), 0.05, True)], "k string, drug string, start long, end long, v double, ok boolean")
    out = sum_steps(df, ["k"], "drug", ["A", "B"], "v", "ok")
    assert [(clock(t), v, a) for t, v, a in rows(out, "t", "total", "assessable")] == [("0d08:00", 0.0, False), ("0d09:00", 0.05, False)]


def test_normalise_dose(spark):
    doses = spark.createDataFrame(
        [("a", at("8:00"), "norepinephrine", 8.0, "mcg/min", "start"), ("a", at("9:00"), "norepinephrine", 8.0, "mcg/min", "stop"), ("a", at("8:00"), "vasopressin", 0.04, "u/min", None), ("b", at("8:00"), "norepinephrine", 8.0, "mcg/min", None), ("b", at("9:00"), "norepinephrine", 0.2, "mcg/kg/min", None)],
        "k string, t long, drug string, dose double, unit string, act string",
    )
    weights = spark.createDataFrame([("a", at("7:00"), 80.0)], "k string, w long, weight_kg double")
    scale = {"mcg/min": (1.0, False), "mcg/kg/min": (1.0, True), "u/min": (1.0, False)}
    out = normalise_dose(doses, weights, ["k"], "t", "w", "drug", "dose", "unit", F.col("act") == "stop", {"norepinephrine": 1.0, "vasopressin": 2.5}, scale, ["vasopressin"])
    got = {(r.k, clock(r.t), r.drug): (None if r.equivalent is None else round(r.equivalent, 6), r.assessable) for r in out.collect()}
    assert got == {
        ("a", "0d08:00", "norepinephrine"): (0.1, True),
        ("a", "0d09:00", "norepinephrine"): (0.0, True),
        ("a", "0d08:00", "vasopressin"): (0.1, True),
        ("b", "0d08:00", "norepinephrine"): (None, False),
        ("b", "0d09:00", "norepinephrine"): (0.2, True),
    }


def test_ratio_around_gap(spark):
    segs = spark.createDataFrame([("a", "p", at("8:00"), 10.0), ("a", "p", at("9:00"), 20.0), ("a", "p", at("12:00"), 5.0), ("a", "p", at("13:00"), 9.0), ("a", "q", at("8:00"), 1.0)], "k string, drug string, start long, dose double")
    gaps = spark.createDataFrame([("a", 1, at("10:00"), at("12:00"), at("14:00"))], "k string, d int, gap_start long, gap_end long, hi long")
    out = ratio_around_gap(gaps, segs, ["k"], ["d"], "drug", ["p", "q"], "dose", "hi")
    assert rows(out, "drug", "pre_rate", "post_rate", "ratio") == [("p", 20.0, 5.0, 0.25)]


@pytest.mark.parametrize("width", WIDTHS)
def test_hourly_scaffold(spark, width):
    df = spark.createDataFrame([("a", at("8:10"), 5.0), ("a", at("10:20"), None)], "k string, t long, v double")
    out = hourly_scaffold(df, ["k"], "t", ["v"], width=width)
    assert [(clock(t), s, v) for t, s, v in rows(out, "at", "is_scaffold", "v")] == [
        ("0d08:10", False, 5.0),
        ("0d08:59", True, 5.0),
        ("0d09:59", True, 5.0),
        ("0d10:20", False, 5.0),
        ("0d10:59", True, 5.0),
    ]


def test_stitching(spark):
    df = spark.createDataFrame([("p", "1", at("0:00"), at("5:00")), ("p", "2", at("11:00"), at("12:00")), ("p", "3", at("19:00"), at("20:00")), ("q", "4", at("0:00"), None)], "p string, h string, i long, o long")
    out = stitch_stays(df, "p", "h", "i", "o")
    assert rows(out, "h", "encounter_block") == [("1", "1"), ("2", "1"), ("3", "3"), ("4", "4")]


def test_next_and_first_event(spark):
    df = spark.createDataFrame([("a", at("8:00"), "x"), ("a", at("9:00"), "y"), ("a", at("10:00"), "x")], "k string, t long, e string")
    nxt = next_event(df, ["k"], "t", F.col("e") == "y", "n", width=HOUR)
    assert [(clock(t), n and clock(n)) for t, n in rows(nxt, "t", "n")] == [("0d08:00", "0d09:00"), ("0d09:00", "0d09:00"), ("0d10:00", None)]
    assert [clock(t) for (t,) in rows(first_event(df, ["k"], "t", F.col("e") == "x"), "t")] == ["0d08:00"]
