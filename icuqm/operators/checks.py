"""Integrity checks as data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, in one pass; a NULL outcome is not a violation."""
    row = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_violations")) for n in rules])
    return row.select(F.explode(pairs).alias("_r")).select("_r.*")


def chain(columns: Sequence[str], slack: float = 0.0) -> Column:
    """Each column is at most the next one."""
    steps = [F.col(a) <= F.col(b) + F.lit(slack) for a, b in zip(columns, columns[1:], strict=False)]
    return reduce(lambda a, b: a & b, steps)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys whose values differ between two aggregates, absent counted as 0."""
    right = b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns])
    both = a.select(*keys, *columns).join(right, list(keys), "full_outer")
    differs = reduce(
        lambda x, y: x | y, [F.coalesce(F.col(c), F.lit(0)) != F.coalesce(F.col(f"_b_{c}"), F.lit(0)) for c in columns]
    )
    return both.where(differs).withColumnsRenamed({f"_b_{c}": f"other_{c}" for c in columns})


def not_nested(days: DataFrame, name: str, parent: str) -> DataFrame:
    """Names that map to more than one parent."""
    return (
        days.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.min(parent).alias("lowest"), F.max(parent).alias("highest"))
        .where("lowest <> highest")
    )


def leaks(feeds: DataFrame, column: str, words: Sequence[str]) -> DataFrame:
    """Feeds whose text contains a forbidden word (I8)."""
    hit = reduce(lambda a, b: a | b, [F.contains(F.col(column), F.lit(w)) for w in words])
    return feeds.where(hit)


def conservation(cube: DataFrame, columns: Sequence[str], grains: Sequence[str] = ("month", "week")) -> DataFrame:
    """Per roll-up edge the number of groups whose parts do not add up to their total, in one pass.

    Each row of the cube takes part in some edges, on the side of the total or of a part. Units must add up
    to all units, the periods of a grain to all time, for every unit and name, and names to their unit.
    """
    faulty = reduce(lambda x, y: x | y, [F.col(c) != F.col(f"other_{c}") for c in columns])
    edges = balance(cube, columns, grains)
    return edges.groupBy(F.col("edge").alias("rule")).agg(F.count_if(faulty).alias("n_violations"))


def balance(cube: DataFrame, columns: Sequence[str], grains: Sequence[str] = ("month", "week")) -> DataFrame:
    """Per roll-up edge and group, told by ``head`` and ``place``, the sums of the parts and, as ``other_*``, of their total."""
    typed, whole, all_time = F.col("dim") == "type", F.col("unit") == "__ALL__", F.col("granularity") == "all"
    place = F.concat_ws("|", "granularity", "period")

    def enters(edge: str, head: Column, at: Column, part: Column, total: Column) -> Column:
        inside = F.struct(F.lit(edge).alias("edge"), head.alias("head"), at.alias("place"), part.alias("part"))
        return F.when(part | total, inside)

    taken = [enters("units", F.lit("__ALL__"), place, typed & ~whole, typed & whole)]
    taken += [enters(f"periods_{g}", F.col("unit"), F.col("dim"), F.col("granularity") == g, all_time) for g in grains]
    under = F.when(typed, F.col("unit")).otherwise(F.col("parent"))
    taken.append(enters("names", under, place, ~typed & under.isNotNull(), typed & ~whole))
    rows = cube.select(*columns, F.explode(F.array_compact(F.array(*taken))).alias("_e"))
    sides = []
    for c in columns:
        value = F.coalesce(F.col(c), F.lit(0))
        sides += [F.sum(F.when(F.col("_e.part"), value).otherwise(0)).alias(c), F.sum(F.when(~F.col("_e.part"), value).otherwise(0)).alias(f"other_{c}")]
    return rows.groupBy("_e.edge", "_e.head", "_e.place").agg(*sides)


def slice_integrity(cube: DataFrame, columns: Sequence[str], grains: Sequence[str] = ("month", "week")) -> DataFrame:
    """Units, periods and nested names must add up to their totals; mismatching groups are returned (I4).

    Units and names are compared over all time, periods over all units; ``conservation`` covers every slice.
    """
    edges = balance(cube, columns, grains)
    at_all = F.col("place") == "all|all"
    label = F.when((F.col("edge") == "units") & at_all, F.lit("units")).when((F.col("edge") == "names") & at_all, F.col("head"))
    label = label.when(F.startswith("edge", F.lit("periods_")) & (F.col("head") == "__ALL__"), F.col("edge"))
    faulty = reduce(lambda x, y: x | y, [F.col(c) != F.col(f"other_{c}") for c in columns])
    others = [f"other_{c}" for c in columns]
    return edges.where(faulty & label.isNotNull()).select(label.alias("group"), *columns, *others)
