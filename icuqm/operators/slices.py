"""The unit-by-period slice cube and summaries built on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.functions.time import month_key, week_key

ALL = "__ALL__"
SLICE = ("unit", "dim", "granularity", "period")


def attach_periods(days: DataFrame, day: str = "day") -> DataFrame:
    """Month, ISO-week and year keys of a calendar day."""
    d = F.col(day).cast("date")
    return days.withColumns({"month": month_key(d), "week": week_key(d), "year": F.date_format(d, "yyyy")})


def _slices(grains: Sequence[str], unit: str, name: str | None) -> Column:
    """Every slice a row belongs to: (ALL, type) and name, each over all time and every grain."""
    periods = [(F.lit("all"), F.lit("all")), *[(F.lit(g), F.col(g)) for g in grains]]
    heads = [(F.lit(ALL), F.lit("type")), (F.col(unit), F.lit("type"))]
    if name:
        heads.append((F.col(name), F.lit("name")))
    return F.array(
        *[
            F.struct(u.alias("unit"), d.alias("dim"), g.alias("granularity"), p.alias("period"))
            for u, d in heads
            for g, p in periods
        ]
    )


def parents(fine: DataFrame, unit: str, name: str) -> DataFrame:
    """The most frequent unit of each name, ties alphabetical (A38), from finest slices with their ``_rows``."""
    counted = fine.groupBy(name, unit).agg(F.sum("_rows").alias("_n"))
    return counted.groupBy(F.col(name).alias("unit")).agg(F.min(F.struct(-F.col("_n"), F.col(unit).alias("u"))).alias("_p")).select(
        "unit", F.lit("name").alias("dim"), F.col("_p.u").alias("parent")
    )


def slice_cube(
    days: DataFrame,
    counts: Mapping[str, Column],
    grains: Sequence[str] = ("month", "week"),
    unit: str = "unit",
    name: str | None = "unit_name",
    by: Sequence[str] = (),
) -> DataFrame:
    """Additive measures per slice.

    ``counts`` are sums or counts. They are first taken per (unit, name, periods), the finest slice, so
    that only those few rows are repeated for the coarser ones and shuffled.
    """
    finest = [unit, *([name] if name else []), *grains, *by]
    rows = [F.count(F.lit(1)).alias("_rows")] if name else []
    fine = days.groupBy(*finest).agg(*[c.alias(n) for n, c in counts.items()], *rows)
    listed = fine.select(*by, *counts, F.explode(_slices(grains, unit, name)).alias("_s")).select(*by, "_s.*", *counts)
    cube = listed.groupBy(*SLICE, *by).agg(*[F.sum(n).alias(n) for n in counts])
    if not name:
        return cube
    return cube.join(parents(fine, unit, name), ["unit", "dim"], "left").select("unit", "dim", "parent", "granularity", "period", *by, *counts)


def distinct_cube(
    days: DataFrame,
    entity: str,
    masks: Mapping[str, Column],
    grains: Sequence[str] = ("month", "week"),
    unit: str = "unit",
    name: str | None = "unit_name",
) -> DataFrame:
    """Distinct entities per slice and mask (A7); these overlap between slices and never add up.

    Days first collapse to one row per (finest slice, entity) with its masks. These lie together by entity before
    they are repeated for the coarser slices, so each (slice, entity) is made one row where it is listed. A slice with
    most of the entities is still counted by partial sums.
    """
    finest = [unit, *([name] if name else []), *grains, entity]
    fine = days.where(F.col(entity).isNotNull()).groupBy(*finest).agg(*[F.max(m.cast("int")).alias(n) for n, m in masks.items()])
    listed = fine.repartition(entity).select(entity, *masks, F.explode(_slices(grains, unit, name)).alias("_s")).select(entity, "_s.*", *masks)
    once = listed.groupBy(*SLICE, entity).agg(*[F.max(n).alias(n) for n in masks])
    return once.groupBy(*SLICE).agg(*[F.sum(n).cast("bigint").alias(n) for n in masks])


def with_rates(cube: DataFrame, rates: Mapping[str, tuple[str, str]], small: tuple[str, int] | None = None) -> DataFrame:
    """Rates over the given denominators (A25) and the small-denominator flag."""
    out = {n: F.when(F.col(den) > 0, F.col(num) / F.col(den)) for n, (num, den) in rates.items()}
    if small:
        out["small_cell"] = F.col(small[0]) < F.lit(small[1])
    return cube.withColumns(out)


def summary_rows(totals: DataFrame, rows: Sequence[tuple[str, str, str | None, str | None]], by: Sequence[str] = ()) -> DataFrame:
    """Tidy rows metric, label, numerator, denominator, rate from one row of totals."""
    lines = []
    for metric, label, num, den in rows:
        top = F.col(num).cast("bigint") if num else F.lit(None).cast("bigint")
        bottom = F.col(den).cast("bigint") if den else F.lit(None).cast("bigint")
        lines.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.lit(label).alias("label"),
                top.alias("numerator"),
                bottom.alias("denominator"),
                F.when(bottom > 0, top / bottom).alias("rate"),
            )
        )
    return totals.select(*by, F.explode(F.array(*lines)).alias("_r")).select(*by, "_r.*")


def cumulative_incidence(entities: DataFrame, hours: str, horizons: Sequence[int]) -> DataFrame:
    """Entities with the event by each horizon, over all entities."""
    totals = entities.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(hours) <= F.lit(float(h))).alias(f"h{h}") for h in horizons]
    )
    rows = F.array(*[F.struct(F.lit(h).alias("horizon_h"), F.col(f"h{h}").alias("num"), F.col("n").alias("den")) for h in horizons])
    return totals.select(F.explode(rows).alias("_r")).select(
        "_r.*", F.when(F.col("_r.den") > 0, F.col("_r.num") / F.col("_r.den")).alias("rate")
    )


def flow_counts(steps: Sequence[tuple[str, DataFrame]], entities: Sequence[str]) -> DataFrame:
    """Rows and distinct entities after each step."""
    out = None
    for i, (label, df) in enumerate(steps, 1):
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_distinct(e).alias(f"n_{e}") for e in entities])
        row = row.select(F.lit(i).alias("step"), F.lit(label).alias("label"), "*")
        out = row if out is None else out.unionByName(row)
    return out
