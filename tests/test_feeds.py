"""Feeds: build, validate, write, read back, fall back and pool."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from icuqm.config import Site
from icuqm.operators.slices import attach_periods, slice_cube
from icuqm.sources import feeds

DATA = [
    ("2023-10-18", "medical_icu", "N1", True),
    ("2023-10-19", "medical_icu", "N2", False),
    ("2023-11-20", "surgical_icu", "N3", True),
    ("2023-11-21", "unknown", "unknown", True),
]


@pytest.fixture(scope="module")
def feed(spark):
    days = attach_periods(spark.createDataFrame(DATA, "day string, unit string, unit_name string, ok boolean"))
    cube = slice_cube(days, {"n": F.count(F.lit(1)), "k": F.count_if("ok")})
    cell = {"num": F.col("k"), "den": F.col("n")}
    return feeds.build_feed(
        cube,
        Site("here", timezone="UTC", unit_labels=(("N1", "North"),)),
        metric_id="demo",
        title="Demo",
        subtitle=F.lit("sub"),
        icon="lpv",
        goal=0.9,
        note=F.lit(None).cast("string"),
        labels=("good", "of days", "days"),
        headline=cell | {"n": F.col("n")},
        segments=[("seg", "Segment", None, cell)],
        generated="2024-01-01T00:00",
        definition_version="demo-v1",
    ).cache()


def test_feed_document(feed):
    doc = json.loads(feed.first().feed)
    assert doc["schema_version"] == 1
    assert doc["goal"] == 0.9
    assert doc["note"] is None
    assert doc["grain"] == {"units": ["__ALL__", "medical_icu", "surgical_icu"], "periods": ["all", "month", "week"]}
    assert doc["headline"]["cells"]["__ALL__"]["all"] == {"num": 3, "den": 4, "n": 4}
    assert doc["headline"]["cells"]["N1"]["2023-W42"] == {"num": 1, "den": 1, "n": 1}
    assert "unknown" not in doc["headline"]["cells"]
    assert doc["segments"][0]["cells"]["medical_icu"]["2023-10"] == {"num": 1, "den": 2}
    assert doc["dims"]["name"] == ["N1", "N2", "N3"]
    assert doc["dims"]["parent"]["N3"] == "surgical_icu"
    assert doc["dims"]["labels"]["N1"] == "North"
    assert doc["ui"]["months"] == ["2023-10", "2023-11"]


def test_round_trip_and_validation(spark, feed, tmp_path):
    feeds.write_feed(feed, str(tmp_path / "feed"))
    good = feeds.read_feeds(spark, [str(tmp_path / "feed")])
    assert good.select("problems").first()[0] == []
    cells = feeds.feed_cells(feeds.valid_feeds(good))
    assert rows(cells.where("unit = '__ALL__' and period = 'all'"), "part", "num", "den") == [("headline", 3, 4), ("seg", 3, 4)]
    bad = spark.createDataFrame([("{not json",), ('{"schema_version": 2, "metric_id": "X y"}',), ('{"schema_version": 1, "title": "patient_id"}',)], "feed string")
    found = [set(r.problems) for r in feeds.parse_feeds(bad).collect()]
    assert "unreadable" in found[0]
    assert {"schema_version", "metric_id", "title", "grain", "headline"} <= found[1]
    assert "identifiers" in found[2]
    assert feeds.valid_feeds(feeds.parse_feeds(bad.limit(2))).count() == 0
    with pytest.raises(Exception, match="identifier"):
        feeds.valid_feeds(feeds.parse_feeds(bad)).count()


def test_writing_a_leaking_feed_fails(spark, tmp_path):
    leak = spark.createDataFrame([("m", '{"hospitalization_id": 1}')], "metric_id string, feed string")
    with pytest.raises(Exception, match="identifier"):
        feeds.write_feed(leak, str(tmp_path / "leak"))


def test_fallback_and_pooling(spark):
    data = [("m", "s1", "v1", "headline", "__ALL__", "all", 3, 4), ("m", "s1", "v1", "headline", "__ALL__", "2023-10", 1, 2), ("m", "s2", "v2", "headline", "__ALL__", "all", 1, 6)]
    cells = spark.createDataFrame([(*r, None, None) for r in data], "metric_id string, site_id string, definition_version string, part string, unit string, period string, num long, den long, n long, hrs double")
    grains = spark.createDataFrame([("m", ["all", "month"])], "metric_id string, kinds array<string>")
    picks = spark.createDataFrame([("medical_icu", "week", "2023-W42"), ("__ALL__", "all", "all")], "unit string, kind string, period string")
    one = cells.where("site_id = 's1'")
    out = feeds.resolve_selection(one, grains, picks)
    assert rows(out, "asked_unit", "unit", "period", "badge", "num") == [
        ("__ALL__", "__ALL__", "all", "", 3),
        ("medical_icu", "__ALL__", "2023-10", " · site-wide · Oct 2023 · month", 1),
    ]
    weekly = feeds.resolve_selection(one, spark.createDataFrame([("m", ["all"])], grains.schema), picks.limit(1))
    assert rows(weekly, "period", "badge") == [("all", " · site-wide · all-time")]
    pooled = feeds.pool_sites(cells)
    assert rows(pooled, "definition_version", "period", "num", "den", "drift") == [("v1", "2023-10", 1, 2, True), ("v1", "all", 3, 4, True), ("v2", "all", 1, 6, True)]
    assert rows(feeds.derive_selectors(cells), "kind", "key", "label") == [("month", "2023-10", "Oct 2023")]
