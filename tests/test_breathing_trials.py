"""What the breathing trials' shared stages move, and that rows are ordered alike whole and in buckets."""

import time

import pytest
from helpers import DAY0, HOUR, rows
from pyspark.sql import functions as F

from icuqm.catalog.base import Tables
from icuqm.catalog.roles import stored
from icuqm.config import BreathingTrial
from icuqm.operators.attribution import longest_piece_nested
from icuqm.operators.episodes import episodes
from icuqm.operators.grid import hour_spans, hourly_scaffold, stitch_stays
from icuqm.operators.intervals import step_segments
from icuqm.operators.ordered import (
    Crowd,
    along,
    crowd_of,
    following,
    following_at,
    last_seen,
    next_seen,
    previous,
    previous_at,
    running_max_before,
    running_min,
    running_sum,
)
from icuqm.operators.overlap import intersect_intervals, overlap_minutes
from icuqm.operators.slices import distinct_cube
from icuqm.plans import common, sbt
from icuqm.sources.stages import StageGraph

DAY = 24 * HOUR
CFG = BreathingTrial()
NONE, SOME = Crowd("id"), Crowd("id", ("a",))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def line(spark):
    """Two keys over five days, with ties in time, rows without a value and a row without a time."""
    data = [(k, DAY0 + d * DAY + h * HOUR, None if (d + h) % 3 else float(d * h + len(k)), "xyyx"[(d * 3 + h) % 4]) for k in ("a", "bb") for d in (0, 1, 4) for h in (0, 5, 5, 20)]
    return spark.createDataFrame([*data, ("a", None, 1.0, "x")], "id string, at bigint, v double, s string")


def test_keys_with_many_rows_are_found(line):
    assert crowd_of(line.where("id = 'a' or v is not null"), "id", many=10) == SOME
    assert crowd_of(line, "id") == NONE and crowd_of(line, "id", F.lit(100_000)).values


def test_whole_and_split_keys_are_ordered_alike(line):
    v = F.col("v")
    kinds = {
        "was": previous(v, nullable=True), "next": following(v), "then": previous_at(), "until": following_at(), "seen": last_seen(v),
        "will": next_seen(v), "sum": running_sum(v), "top": running_max_before(v), "low": running_min(v),
    }
    got = [sorted(map(repr, along(line, ["id"], "at", kinds, ["v", "s"], crowd=c).collect())) for c in (None, NONE, SOME, Crowd("id", ("a", "bb")))]
    assert len(got[0]) == 24 and got[0] == got[1] == got[2] == got[3]
    whole = along(line, ["id"], "at", kinds, ["v", "s"], crowd=NONE)
    assert "Join" not in plan(whole) and exchanges(whole) == 1


def test_episodes_of_whole_keys_are_exchanged_once(line):
    got = [sorted(map(repr, episodes(line, ["id"], "at", "s", tiebreak=["s"], crowd=c).collect())) for c in (None, NONE, SOME)]
    assert len(got[0]) > 8 and got[0] == got[1] == got[2]
    assert exchanges(episodes(line, ["id"], "at", "s", tiebreak=["s"], crowd=NONE)) == 1


@pytest.mark.parametrize("crowd", [None, Crowd("k"), Crowd("k", ("b1",))])
def test_scaffold_of_known_spans(spark, crowd):
    data = [("s1", "b1", DAY0 + HOUR // 4, 1.0), ("s1", "b1", DAY0 + 3 * DAY + 7 * HOUR, None), ("s2", "b1", DAY0 + DAY, None), ("s3", "b2", DAY0, 5.0)]
    df = spark.createDataFrame([*data, ("s3", "b2", None, 7.0)], "id string, k string, t bigint, v double")
    spans = hour_spans(df, ["id", "k"], "t")
    assert rows(spans, "id", "n") == [("s1", 2 + 80), ("s2", 2), ("s3", 2)]
    cols = ["id", "k", "at", "is_scaffold", "v"]
    out = hourly_scaffold(df, ["id", "k"], "t", ["v"], spans=spans, crowd=crowd, within=["k"])
    assert sorted(map(repr, out.select(cols).collect())) == sorted(map(repr, hourly_scaffold(df, ["id", "k"], "t", ["v"]).select(cols).collect()))
    assert out.columns == hourly_scaffold(df, ["id", "k"], "t", ["v"]).columns


@pytest.fixture
def tables(spark, tmp_path):
    """Two stays of a block whose records overlap, with equal times, and one of another block."""
    rs = [("s1", h * HOUR // 2, dev, mode) for h, (dev, mode) in enumerate([("imv", "simv"), ("imv", "pressure support/cpap"), (None, None), ("cpap", None), ("imv", "simv")] * 3)]
    rs += [("s2", h * HOUR // 2, dev, mode) for h, dev, mode in [(4, "imv", "pressure support/cpap"), (6, None, "simv"), (6, "cpap", "a"), (90, "imv", None)]]
    rs += [("s3", 5 * HOUR, "imv", "pressure support/cpap"), ("s3", 6 * HOUR - 1_000_000, None, "simv")]
    stays = [("s1", "s1"), ("s2", "s1"), ("s3", "s3")]
    df = spark.createDataFrame([(s, DAY0 + at, d, m) for s, at, d, m in rs], "hospitalization_id string, at bigint, device_category string, mode_category string")
    rest = {c: F.lit(None).cast("double") for c in ("peep_set", "fio2_set", "pressure_support_set")} | {"tracheostomy": F.lit(None).cast("boolean")}
    adt = spark.createDataFrame([(s, "icu", DAY0, DAY0 + DAY) for s in ("s1", "s3")], "hospitalization_id string, location_category string, i bigint, o bigint")
    out = {
        "respiratory_support": df.withColumn("recorded_dttm", F.timestamp_micros("at")).drop("at").withColumns(rest),
        "adt": adt.select("*", F.timestamp_micros("i").alias("in_dttm"), F.timestamp_micros("o").alias("out_dttm"), F.lit("u").alias("location_type"), F.lit("n").alias("location_name")),
    }
    return out, spark.createDataFrame(stays, "hospitalization_id string, encounter_block string")


@pytest.mark.parametrize("crowd", [Crowd("encounter_block"), Crowd("encounter_block", ("s1",))])
def test_the_timeline_knows_its_next_rows_and_mode_steps(spark, tables, monkeypatch, crowd):
    monkeypatch.setattr(common, "crowd_of", lambda *_: crowd)
    filled = common.unit_timeline(*tables)
    by = ["encounter_block"]
    plain = common.filled_timeline(tables[0]["respiratory_support"], tables[1])
    assert sorted(map(repr, filled.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    found = common.device_segments(filled)
    segs = step_segments(plain, by, "at", DAY, tiebreak=["is_scaffold", "device_category"]).where("device_category = 'imv'")
    assert rows(found, *by, "start", "end") == rows(segs, *by, "start", "end") and found.count() > 20
    assert exchanges(found) == 0
    days = spark.createDataFrame([("s1", 1, DAY0 + HOUR, DAY0 + 5 * HOUR), ("s1", 2, DAY0 + 5 * HOUR, DAY0 + 3 * DAY), ("s3", 1, DAY0, DAY0 + DAY)], "encounter_block string, d int, i bigint, o bigint")

    def spent(df):
        modes = step_segments(df, by, "at", HOUR, tiebreak=["is_scaffold", "mode_category"]).where(sbt.is_support(CFG))
        return rows(overlap_minutes(days, modes.select(*by, F.col("start").alias("s"), F.col("end").alias("e")), by, ["d"], ("i", "o"), ("s", "e"), "m"), *by, "d", "m")

    steps = filled.where("mode_step")
    assert spent(steps.select(*by, "at", "is_scaffold", "mode_category")) == spent(plain) and spent(plain)[0][2] > 0
    assert steps.count() < filled.count() / 2


def test_only_hours_of_patient_days_are_carried_to(spark):
    filled = spark.createDataFrame([("b", DAY0 + h * HOUR, 0.4, 5.0, True) for h in range(30)], "encounter_block string, at bigint, fio2_set double, peep_set double, is_scaffold boolean")
    days = spark.createDataFrame([("b", 1, DAY0 + 2 * HOUR, DAY0 + 6 * HOUR)], "encounter_block string, day int, day_in bigint, day_out bigint")
    spo2 = spark.createDataFrame([("b", DAY0 + 3 * HOUR, 95.0), ("b", DAY0 + 4 * HOUR, 95.0)], "encounter_block string, at bigint, spo2 double")
    ne = spark.createDataFrame([("b", DAY0, 0.1, True)], "encounter_block string, t bigint, total double, assessable boolean")
    out = sbt.stability(days, filled, spo2, ne, Crowd, CFG)
    assert [tuple(r) for r in out.collect()] == [("b", 1, True, True, True, 3, 4, 3)]
    lines = plan(out).splitlines()
    carried = next(i for i, text in enumerate(lines) if "Union" in text)
    assert not any("_level" in text and "Join" in text for text in lines[:carried])
    # what the settings say is told before hours are exchanged
    met = next(i for i, text in enumerate(lines) if "_level" in text and "Join" in text)
    assert not any("fio2_set" in text for text in lines[:met])


def test_coverage_counts_blocks_before_days_are_asked(spark):
    filled = spark.createDataFrame([("b", m, s) for m, s in [("pressure support/cpap", False), ("pressure support/cpap", True), ("simv", False)] * 2] + [("c", "pressure support/cpap", True)], "encounter_block string, mode_category string, is_scaffold boolean")
    days = spark.createDataFrame([("b", 1), ("b", 2)], "encounter_block string, day int")
    out = sbt.coverage(filled, days, CFG)
    assert [tuple(r) for r in out.collect()] == [(4, 2, 50.0)]
    assert [tuple(r) for r in sbt.coverage(filled, days.where("day > 2"), CFG).collect()] == [(0, 0, None)]
    lines = plan(out).splitlines()
    met = next(i for i, text in enumerate(lines) if "LeftSemi" in text)
    assert "Aggregate" in lines[met + 1]


def test_people_are_told_apart_before_slices_are_listed(spark):
    df = spark.createDataFrame([("p", "u", "n", "2024-01", "w1"), ("p", "u", "m", "2024-01", "w2"), ("q", "u", "n", "2024-01", "w1"), (None, "u", "n", "2024-01", "w1")], "person string, unit string, unit_name string, month string, week string")
    cube = distinct_cube(df, "person", {"n": F.lit(True)})
    assert rows(cube.where("granularity = 'all'"), "unit", "n") == [("__ALL__", 2), ("m", 1), ("n", 2), ("u", 2)]
    lines = plan(cube).splitlines()
    listed = next(i for i, text in enumerate(lines) if "Generate explode" in text)
    assert any("RepartitionByExpression [person" in text for text in lines[listed:])
    assert not any("Exchange hashpartitioning(unit" in text and "person" in text for text in cube._jdf.queryExecution().executedPlan().toString().splitlines() if "unit_name" not in text)


def test_summary_repeats_no_day_to_tell_people_apart(spark):
    cols = {"eligible": True, "on_spontaneous": True, "nb_t": True, "sbt_delivered": False, "sbt_delivered_any": True, "eligibility_status": "eligible", "notelig_reason": ""}
    obs = spark.createDataFrame([("p",), ("p",), ("q",), (None,)], "patient_id string").withColumns({n: F.lit(v) for n, v in cols.items()})
    out = sbt.summary(obs)
    got = {r["metric"]: (r["numerator"], r["denominator"]) for r in out.collect()}
    assert got["vent_icu_days"] == (4, 4) and got["patients_cohort"] == (2, 2) and got["patients_ever_sbt"] == (0, 2) and got["sbt_any_all"] == (4, 4)
    assert "Expand" not in plan(out)
    assert {r["numerator"] for r in sbt.summary(obs.where("patient_id = 'x'")).collect()} == {0}


def test_stays_of_a_person_are_stitched_in_one_exchange(spark):
    df = spark.createDataFrame([("p", "s1", 0, 2), ("p", "s2", 5, 9), ("p", "s3", 40, 50), ("q", "s4", 1, 3)], "person string, stay string, i bigint, o bigint")
    out = stitch_stays(df.withColumns({c: F.col(c) * HOUR + DAY0 for c in "io"}), "person", "stay", "i", "o")
    assert rows(out, "stay", "encounter_block") == [("s1", "s1"), ("s2", "s1"), ("s3", "s3"), ("s4", "s4")]
    assert "Join" not in plan(out) and exchanges(out) == 1


def test_intervals_too_short_to_be_asked_are_not_listed(spark):
    short = spark.range(300).select(F.lit("k").alias("k"), (F.col("id") * HOUR).alias("s"), ((F.col("id") + 1) * HOUR).alias("e"))
    long = spark.createDataFrame([("k", HOUR // 2, 40 * HOUR), ("k", 100 * HOUR, 101 * HOUR)], "k string, i bigint, o bigint")
    for a, b, spans in ((short, long, (("s", "e"), ("i", "o"))), (long, short, (("i", "o"), ("s", "e")))):
        out = intersect_intervals(a, b, ["k"], *spans)
        assert rows(out, "start", "end") == [(HOUR // 2, HOUR), *[(h * HOUR, (h + 1) * HOUR) for h in range(1, 40)], (100 * HOUR, 101 * HOUR)]
        assert plan(out).count("_least") >= 2
    assert intersect_intervals(short, long.where("i < 0"), ["k"], ("s", "e"), ("i", "o")).count() == 0


def test_a_built_stage_leaves_no_shuffle_files(spark, tmp_path):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager

    def shuffled():
        found = files().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    graph, before = StageGraph(spark, str(tmp_path / "stages")), shuffled()
    out = graph.keep("spread", lambda: spark.range(50_000).repartition(7, "id"))
    until = time.time() + 3
    while shuffled() - before and time.time() < until:
        time.sleep(0.5)
    assert not shuffled() - before
    assert out.count() == 50_000


def test_stages_of_the_derived_tables_do_not_depend_on_crowds(spark, monkeypatch):
    """All keys split into buckets give the rows that whole keys give."""
    folder = "/root/testdata/sf0.001"
    got = []
    for many in (200_000, 5):
        monkeypatch.setattr(common, "crowd_of", lambda df, key, n=None, many=many: crowd_of(df, key, n, many))
        monkeypatch.setattr(sbt, "crowd_of", lambda df, key, n=None, many=many: crowd_of(df, key, n, many))
        tables, graph = stored(Tables(spark, folder), ("stay_events",))
        got.append(sorted(map(repr, sbt.stages(tables, CFG, graph.keep)["observation"].collect())))
        assert "sbt_observation" in graph.built
    assert len(got[0]) > 100 and got[0] == got[1]


def test_units_of_a_day_are_told_in_two_exchanges(spark):
    pieces = spark.createDataFrame([("b", 1, "u", "n", 0, 50), ("b", 1, "v", "m", 50, 80), ("b", 1, "v", "k", 80, 120), ("c", 1, None, None, 0, 9)], "b string, d int, unit string, name string, start bigint, end bigint")
    out = longest_piece_nested(pieces, ["b", "d"], "unit", "name")
    assert rows(out, "b", "unit", "name", "day_in", "day_out") == [("b", "u", "n", 0, 120), ("c", "unknown", "unknown", 0, 9)]
    assert exchanges(out) == 2


def test_wide_patient_days_are_joined_once_for_each_thing_found(spark):
    elig = spark.createDataFrame([("b", 1, DAY0, DAY0 + DAY, "w")], "encounter_block string, day int, day_in bigint, day_out bigint, wide string")
    eps = spark.createDataFrame(
        [("b", DAY0 + HOUR, 180.0, True, True, "ps"), ("b", DAY0 + 2 * HOUR, 1.0, True, True, "cpap"), ("b", DAY0 + 2 * DAY, 1.0, True, False, "")],
        "encounter_block string, ep_start bigint, dur_min double, is_transition boolean, peep_ok boolean, arm string",
    )
    filled = spark.createDataFrame([("b", DAY0 + HOUR, False, "pressure support/cpap", True), ("b", DAY0 + 3 * HOUR, False, "simv", True)], "encounter_block string, at bigint, is_scaffold boolean, mode_category string, mode_step boolean")
    out = sbt.observation(elig, filled, eps, Crowd, CFG)
    assert rows(out, "wide", "nb_t", "nb_tdp", "n_transitions", "n_transitions_strict", "longest_support_min", "sbt_arm", "spont_minutes") == [("w", True, True, 2, 1, 180.0, "both", 120.0)]
    for arm in ("ps", "cpap"):
        one = sbt.observation(elig, filled, eps.where(F.col("arm") == arm), Crowd, CFG)
        assert rows(one, "sbt_arm") == [(arm,)]
    assert rows(sbt.observation(elig, filled, eps.where("arm = ''"), Crowd, CFG), "sbt_arm", "nb_t", "longest_support_min") == [("", False, 0.0)]
    assert plan(out).count("Join LeftOuter") == 3
