"""A site's run from its tables to stages, slices, summary, feed and checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from icuqm.config import Config, Site
from icuqm.operators import checks
from icuqm.plans import lpv, proning, sat, sbt
from icuqm.sources.feeds import write_feed
from icuqm.sources.stages import StageGraph
from icuqm.sources.tables import load_site, resolve_table, write_csv

MEASURES = ("lpv", "sat", "sbt", "proning")


@dataclass(frozen=True)
class Outcome:
    """What a measure gives: its stages, the slice cube, tidy rows, the feed and every broken rule."""

    stages: dict[str, DataFrame]
    slices: DataFrame
    summary: DataFrame
    feed: DataFrame
    faults: DataFrame


def stage_site(spark: SparkSession, folder: str, root: str, fmt: str = "parquet", refresh: Sequence[str] = ()) -> tuple[dict[str, DataFrame], StageGraph]:
    """The site's tables and the graph of its stages; a table's node follows its files."""
    tables, graph = load_site(spark, folder, fmt), StageGraph(spark, root, refresh)
    for name in tables:
        graph.source(name, resolve_table(spark, folder, name, fmt))
    return tables, graph


def _lpv(t: dict, cfg: Config, site: Site, graph: StageGraph, generated: str) -> Outcome:
    own = lpv.stages(t, cfg.lpv, cfg.severity, graph.keep)
    cube = graph.keep("lpv_cube", lambda: lpv.feed_cube(own["status"], own["severity"]), ("lpv_status", "lpv_severity"))
    rows = lpv.summaries(own["status"], own["severity"])
    faults = checks.violations(own["status"], lpv.integrity_rules())
    return Outcome(own, cube, rows, lpv.feed(cube, site, cfg.lpv, generated), faults)


def _sat(t: dict, cfg: Config, site: Site, graph: StageGraph, generated: str) -> Outcome:
    own = sat.stages(t, cfg.sat, graph.keep)
    cube = graph.keep("sat_cube", lambda: sat.slices(own["observation"], cfg.sat), ("sat_observation",), cfg.sat)
    return Outcome(own, cube, sat.summary(own["observation"]), sat.feed(cube, site, cfg.sat, generated), _unbalanced(cube, sat.COUNTS))


def _sbt(t: dict, cfg: Config, site: Site, graph: StageGraph, generated: str) -> Outcome:
    own = sbt.stages(t, cfg.sbt, graph.keep)
    cube = graph.keep("sbt_cube", lambda: sbt.slices(own["observation"]), ("sbt_observation",), cfg.sbt)
    nested = checks.violations(own["observation"], sbt.nesting_rules())
    return Outcome(own, cube, sbt.summary(own["observation"]), sbt.feed(cube, site, cfg.sbt, generated), nested.unionByName(_unbalanced(cube, list(sbt.counts()))))


def _proning(t: dict, cfg: Config, site: Site, graph: StageGraph, generated: str) -> Outcome:
    own = proning.stages(t, cfg.proning, graph.keep)
    cube = graph.keep("proning_cube", lambda: proning.slices(own["placed"], cfg.proning), ("proning_placed",), cfg.proning)
    rows = proning.summary(own["patients"], own["people"], cfg.proning)
    counted = ("n_eligible", "n_ever_proned", "n_adherent", "n_documented")
    return Outcome(own, cube, rows, proning.feed(cube, site, cfg.proning, generated), _unbalanced(cube, counted))


def _unbalanced(cube: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Roll-up edges of the cube whose sums differ, as rules with their number of faults (I4)."""
    return checks.conservation(cube, columns)


_RUNS: dict[str, Callable[..., Outcome]] = {"lpv": _lpv, "sat": _sat, "sbt": _sbt, "proning": _proning}


def run_measure(tables: dict[str, DataFrame], graph: StageGraph, measure: str, cfg: Config, site: Site, generated: str) -> Outcome:
    """One measure from stored stages; what is stored and unchanged is not built again."""
    return _RUNS[measure](tables, cfg, site, graph, generated)


def run_site(
    spark: SparkSession, folder: str, root: str, out: str, site: Site, generated: str, cfg: Config | None = None, measures: Sequence[str] = MEASURES, refresh: Sequence[str] = ()
) -> list[str]:
    """All measures of a site: csv reports and feeds under ``out``, stages under ``root``. Returns the stages that were built."""
    tables, graph = stage_site(spark, folder, root, refresh=refresh)
    for name in measures:
        found = run_measure(tables, graph, name, cfg or Config(), site, generated)
        for part in ("slices", "summary", "faults"):
            write_csv(getattr(found, part), f"{out}/{name}_{part}", site.name, generated)
        write_feed(found.feed, f"{out}/{name}_feed")
    return graph.built
