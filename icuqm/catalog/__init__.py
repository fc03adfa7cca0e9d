"""Queries over the star tables that exercise every operator."""

from icuqm.catalog import aggregates, measures, overlaps, reports, rowrules, states, timeline  # noqa: F401
from icuqm.catalog.base import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
