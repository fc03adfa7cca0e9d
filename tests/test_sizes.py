"""What decides the size of summaries, broadcasts and tasks."""

import pytest
from helpers import DAY0, HOUR, rows
from pyspark.sql import functions as F

from icuqm.catalog.base import QUERIES, Tables
from icuqm.catalog.roles import stored
from icuqm.config import SETTING_RANGES, Config
from icuqm.operators.grid import LISTING, hourly_scaffold, time_grid
from icuqm.operators.intervals import carry_forward
from icuqm.operators.ordered import along, last_seen, next_seen, running_sum
from icuqm.plans.lpv import interval_pieces
from icuqm.plans.sat import over_midnight
from icuqm.session import SIZES

DAY = 24 * HOUR


@pytest.fixture
def line(spark):
    """Known values three days apart, and days without one, before, between and after them."""
    data = [("a", DAY0 + day * DAY + hour * HOUR, {(1, 2): 5.0, (4, 1): 7.0}.get((day, hour))) for day in range(6) for hour in range(3)]
    return spark.createDataFrame(data, "id string, at bigint, v double")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_latest_values_are_summarised_from_rows_that_have_one(line):
    out = along(line, ["id"], "at", {"was": last_seen(F.col("v")), "will": next_seen(F.col("v")), "n": running_sum(F.lit(1))})
    got = [(was, will) for _, was, will in rows(out, "at", "was", "will")]
    assert got == [(None, 5.0)] * 5 + [(5.0, 5.0)] + [(5.0, 7.0)] * 7 + [(7.0, 7.0)] + [(7.0, None)] * 4
    assert [n for _, n in rows(out, "at", "n")] == list(range(1, 19))
    assert "isnotnull(v#" in plan(out)


def test_a_value_without_limit_is_carried_alone(line):
    free = carry_forward(line, ["id"], "at", {"held": (F.col("v"), None)})
    assert [v for _, v in rows(free, "at", "held")] == [None] * 5 + [5.0] * 8 + [7.0] * 5
    assert "struct" not in plan(free)
    aged = carry_forward(line, ["id"], "at", {"held": (F.col("v"), HOUR)})
    assert [v for _, v in rows(aged, "at", "held") if v is not None] == [5.0, 7.0, 7.0]


def test_sizes_follow_the_rows_unless_the_session_says_otherwise(spark, tmp_path):
    own = {name: spark.conf.get(name, None) for name in SIZES}
    try:
        for name in SIZES:
            spark.conf.unset(name)
        Tables(spark, str(tmp_path))
        assert {name: spark.conf.get(name) for name in SIZES} == SIZES
        spark.range(100_000).write.parquet(str(tmp_path / "t.parquet"))
        stored = sum(f.stat().st_size for f in (tmp_path / "t.parquet").glob("*.parquet"))
        believed = spark.read.parquet(str(tmp_path / "t.parquet"))._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        assert int(str(believed)) >= 5 * stored
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        Tables(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "1m"
    finally:
        for name, value in own.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("width", [DAY, 5 * HOUR, HOUR // 2])
def test_the_scaffold_is_exchanged_by_bucket_and_listed_afterwards(spark, width):
    first, last = DAY0 + HOUR // 4, DAY0 + 3 * DAY + 7 * HOUR
    out = hourly_scaffold(spark.createDataFrame([("a", first, 1.0), ("a", last, None)], "id string, t bigint, v double"), ["id"], "t", ["v"], width=width)
    hours = [DAY0 + h * HOUR + HOUR - 1_000_000 for h in range(3 * 24 + 8)]
    assert rows(out, "at", "is_scaffold", "v") == sorted([(first, False, 1.0), (last, False, 1.0), *[(h, True, 1.0) for h in hours]])
    lines = plan(out).splitlines()
    moved = next(i for i, line in enumerate(lines) if "RepartitionByExpression" in line)
    assert any("explode(sequence(at" in line for line in lines[:moved])


def test_only_intervals_over_a_midnight_are_asked_at_days_ends(spark):
    spans = [("before", -HOUR, 0), ("until", -HOUR, 1), ("from", 0, 1), ("day", 1, DAY), ("days", 1, DAY + 1)]
    df = spark.createDataFrame([(n, DAY0 + s, DAY0 + e) for n, s, e in spans], "n string, start bigint, end bigint")
    assert rows(over_midnight(df), "n") == [("days",), ("from",), ("until",)]


def test_derived_tables_start_from_spread_events(spark):
    tables, graph = stored(Tables(spark, "/root/testdata/sf0.001"))
    assert graph.edges["respiratory_support"] == ("stay_events",) and graph.edges["stay_events"] == ("events",)
    assert not [f for f in tables["respiratory_support"].inputFiles() if "/stay_events/" not in f]


def test_a_table_of_some_megabytes_is_not_sent_to_every_task(spark, tmp_path):
    own = {name: spark.conf.get(name, None) for name in SIZES}
    try:
        for name in SIZES:
            spark.conf.unset(name)
        Tables(spark, str(tmp_path))
        for name in "ab":
            spark.range(200_000).write.parquet(str(tmp_path / f"{name}.parquet"))
        a, b = (spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in "ab")
        assert "Broadcast" not in a.join(b, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in own.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_pieces_are_not_joined_after_they_are_split(spark):
    rs = spark.createDataFrame([("a", "imv", DAY0)], "hospitalization_id string, device_category string, us bigint").withColumn("recorded_dttm", F.timestamp_micros("us"))
    nothing = {c: F.lit(None).cast("double") for c in SETTING_RANGES} | {"mode_category": F.lit("simv")}
    days = spark.createDataFrame([("a", None), ("a", 60.0), ("b", 70.0)], "hospitalization_id string, pbw_kg double")
    out = interval_pieces({"respiratory_support": rs.withColumns(nothing)}, days, Config().lpv)
    assert rows(out, "hospitalization_id", "pbw_kg", "mode", "is_imv") == [("a", 60.0, "simv", True)]
    lines = plan(out).splitlines()
    listed = next(i for i, line in enumerate(lines) if "explode(sequence(" in line)
    assert not any("Join" in line for line in lines[:listed])


def test_grid_times_are_listed_by_many_tasks(spark):
    spans = spark.createDataFrame([(i, DAY0, DAY0 + DAY) for i in range(2000)], "id int, lo bigint, hi bigint").groupBy("id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    grid = time_grid(spans, ["id"], "lo", "hi", 6 * HOUR)
    assert rows(grid.where("id = 7"), "id", "at") == [(7, DAY0 + k * 6 * HOUR) for k in range(5)]
    held = [r["n"] for r in grid.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(held) == 10_000 and len(held) == LISTING and max(held) < 500
    lines = plan(QUERIES["sampled_steps"](spark, "/root/testdata/sf0.001")).splitlines()
    listed = next(i for i, line in enumerate(lines) if "explode(sequence(lo" in line)
    assert any("RepartitionByExpression" in line and f", {LISTING}" in line for line in lines[listed:])
