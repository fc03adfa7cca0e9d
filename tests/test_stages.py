"""Stored stages: what is reused, what is built again, and a site's run from tables to feeds."""

import json

import pytest
from helpers import rows

from icuqm.catalog.base import Tables
from icuqm.catalog.roles import icu_tables
from icuqm.config import Config, Proning, Sedation, Site
from icuqm.plans import site
from icuqm.plans.site import run_site, stage_site
from icuqm.sources import stages
from icuqm.sources.stages import StageGraph

SITE = Site("here", timezone="UTC")


@pytest.fixture
def graph(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3).write.parquet(str(tmp_path / f"{name}.parquet"))

    def make(refresh=(), settings=1):
        g = StageGraph(spark, str(tmp_path / "stages"), refresh)
        for name in ("a", "b"):
            g.source(name, str(tmp_path / f"{name}.parquet"))
        read = lambda name: spark.read.parquet(str(tmp_path / f"{name}.parquet"))
        one = g.keep("one", lambda: read("a"), ("a",))
        two = g.keep("two", lambda: read("b"), ("b",), settings)
        g.keep("three", lambda: one.join(two, "id"), ("one", "two"))
        return g

    return make


def test_only_what_depends_on_a_change_is_built_again(spark, tmp_path, graph):
    assert graph().built == ["one", "two", "three"]
    assert graph().built == []
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "b.parquet"))
    assert graph().built == ["two", "three"]
    assert graph(settings=2).built == ["two", "three"]
    # the earlier settings' stages still lie under their keys
    assert graph().built == []
    assert graph(refresh=["one"]).built == ["one", "three"]
    assert graph().built == []
    assert graph().depend_on("b") == {"two", "three"}


def test_other_code_builds_again(graph, monkeypatch):
    graph()
    monkeypatch.setattr(stages, "code_version", lambda: "other")
    assert graph().built == ["one", "two", "three"]


def test_a_stage_without_manifest_is_not_there(spark, tmp_path, graph):
    g = graph()
    folder = next((tmp_path / "stages" / "two").iterdir())
    manifest = json.loads(next(folder.glob("manifest-*.json")).read_text())
    assert manifest["of"] == {"b": g.keys["b"]} and manifest["generation"] == 0
    for name in folder.glob("manifest-*.json"):
        name.unlink()
    assert graph().built == ["two"]
    with pytest.raises(ValueError, match="two different"):
        g.source("a", str(tmp_path / "b.parquet"))


def test_of_two_runs_the_first_to_publish_stands(spark, tmp_path, graph):
    g = graph()
    folder = str(next((tmp_path / "stages" / "one").iterdir()))
    before = g._manifest(folder)
    g._publish(folder, before | {"data": "data-late"})
    assert g._manifest(folder) == before
    assert not list((tmp_path / "stages").rglob("draft-*"))


def test_a_site_from_tables_to_feeds(spark, tmp_path):
    folder, root, out = (str(tmp_path / n) for n in ("site", "stages", "out"))
    for name, df in icu_tables(Tables(spark, "/root/testdata/sf0.001")).items():
        df.write.parquet(f"{folder}/{name}.parquet")
    # few people are that ill in so small a table
    easy = Config(proning=Proning(onset_pf_max=1000.0, onset_fio2_min=0.2, onset_peep_min=0.0, pf_max=1000.0, fio2_min=0.2, peep_min=0.0, sustained=60_000_000))
    built = run_site(spark, folder, root, out, SITE, "2024-02-01T00:00", easy)
    assert {"blocks", "unit_timeline", "sat_observation", "sbt_observation", "proning_placed", "lpv_status"} <= set(built)
    assert run_site(spark, folder, root, out, SITE, "2024-02-01T00:00", easy, ["sat"]) == []
    for name in site.MEASURES:
        feed = json.loads("".join(r[0] for r in spark.read.text(f"{out}/{name}_feed").collect()))
        assert feed["metric_id"] == name and feed["provenance"]["site_id"] == "here"
        faults = spark.read.option("header", True).csv(f"{out}/{name}_faults")
        assert {r["n_violations"] for r in faults.collect()} == {"0"} and faults.columns[0] == "site"
        assert spark.read.option("header", True).csv(f"{out}/{name}_slices").count() > 0
    # new positions change the proning measure alone, and only behind the positions
    spark.read.parquet(f"{folder}/position.parquet").limit(5).write.parquet(f"{folder}/new.parquet")
    spark.read.parquet(f"{folder}/new.parquet").write.mode("append").parquet(f"{folder}/position.parquet")
    tables, graph = stage_site(spark, folder, root)
    assert graph.depend_on("position") == set()
    assert run_site(spark, folder, root, out, SITE, "2024-02-01T00:00", easy, ["proning"]) == ["proning_positions", "proning_patients", "proning_placed", "proning_cube"]
    longer = Config(sat=Sedation(hold=60 * 60_000_000))
    changed = run_site(spark, folder, root, out, SITE, "2024-02-01T00:00", longer, ["sat"])
    assert "blocks" not in changed and "unit_timeline" not in changed and "sat_holds" in changed
    assert rows(spark.read.text(f"{out}/sat_feed"), "value")
