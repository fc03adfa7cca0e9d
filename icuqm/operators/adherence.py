"""Own-denominator adherence: masked sums, classification, rates and cutoff sweep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.functions.time import MINUTE

STATUSES = ("adherent", "non_adherent", "not_assessable")


@dataclass(frozen=True)
class Measure:
    """A measure counts time where ``present`` holds and credits it where ``passing`` holds too."""

    present: Column
    passing: Column


def masked_time(
    pieces: DataFrame, by: Sequence[str], measures: Mapping[str, Measure], totals: Mapping[str, Column] | None = None, span: tuple[str, str] = ("start", "end")
) -> DataFrame:
    """Microseconds per key, for every measure's denominator and numerator, in one pass (A1)."""
    length = F.col(span[1]) - F.col(span[0])

    def total(mask: Column) -> Column:
        return F.sum(F.when(mask, length).otherwise(F.lit(0)).cast("bigint"))

    sums = [total(mask).alias(f"{name}_us") for name, mask in (totals or {}).items()]
    for name, m in measures.items():
        sums.append(total(m.present).alias(f"{name}_assessable_us"))
        sums.append(total(m.present & m.passing).alias(f"{name}_in_us"))
    return pieces.groupBy(*by).agg(*sums)


def at_least(part: Column, whole: Column, fraction: float) -> Column:
    """``part / whole >= fraction`` on whole microseconds, without a rounded quotient."""
    percent = round(fraction * 100)
    return part * F.lit(100) >= whole * F.lit(percent)


def status_of(assessable: Column, inside: Column, floor: int = 60 * MINUTE, fraction: float = 0.80) -> Column:
    return (
        F.when(F.coalesce(assessable, F.lit(0)) < F.lit(floor), F.lit("not_assessable"))
        .when(at_least(inside, assessable, fraction), F.lit("adherent"))
        .otherwise(F.lit("non_adherent"))
    )


def classify(days: DataFrame, measures: Sequence[str], floor: int = 60 * MINUTE, fraction: float = 0.80) -> DataFrame:
    """Adds fraction, status and minutes per measure to a table with ``<m>_assessable_us`` and ``<m>_in_us`` (A2)."""
    out = {}
    for m in measures:
        whole = F.coalesce(F.col(f"{m}_assessable_us"), F.lit(0))
        part = F.coalesce(F.col(f"{m}_in_us"), F.lit(0))
        out[f"{m}_assessable_min"] = whole / F.lit(float(MINUTE))
        out[f"{m}_in_min"] = part / F.lit(float(MINUTE))
        out[f"{m}_fraction"] = F.when(whole > 0, part / whole)
        out[f"{m}_status"] = status_of(whole, part, floor, fraction)
    return days.withColumns(out)


def both_rates(adherent: str = "n_adherent", assessable: Column | None = None, total: str = "n_total") -> dict[str, Column]:
    """Rates over assessable and over all; NULL where the denominator is 0 (A4)."""
    whole = assessable if assessable is not None else F.col("n_adherent") + F.col("n_non_adherent")
    return {
        "assessable_rate": F.when(whole > 0, F.col(adherent) / whole),
        "crude_rate": F.when(F.col(total) > 0, F.col(adherent) / F.col(total)),
    }


def status_counts(days: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Counts per status in long form, absent statuses as 0 (A3)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{m}_status").alias("status")) for m in measures])
    long = days.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p.*")
    counted = long.groupBy(*by, "measure").agg(
        F.count(F.lit(1)).alias("n_total"), *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUSES]
    )
    return counted.withColumns(both_rates())


def cutoff_sweep(
    pieces: DataFrame,
    by: Sequence[str],
    value: str,
    cutoffs: Sequence[float],
    extras: Mapping[str, Measure],
    span: tuple[str, str] = ("start", "end"),
    spine: DataFrame | None = None,
) -> DataFrame:
    """Time at or under each cutoff per key and measure, all cutoffs in one pass.

    ``extras`` maps a measure to its presence mask and the fixed part of its passing rule. The result is
    long: ``measure``, ``cutoff``, ``assessable_us``, ``in_us``. With a ``spine`` every spine row appears,
    with 0 where it has no pieces.
    """
    length = F.col(span[1]) - F.col(span[0])
    sums, rows = [], []
    for m, rule in extras.items():
        sums.append(F.sum(F.when(rule.present, length).otherwise(0).cast("bigint")).alias(f"_{m}_all"))
        for i, cut in enumerate(cutoffs):
            good = rule.present & rule.passing & (F.col(value) <= F.lit(float(cut)))
            sums.append(F.sum(F.when(good, length).otherwise(0).cast("bigint")).alias(f"_{m}_{i}"))
            rows.append(
                F.struct(
                    F.lit(m).alias("measure"),
                    F.lit(float(cut)).alias("cutoff"),
                    F.coalesce(F.col(f"_{m}_all"), F.lit(0)).alias("assessable_us"),
                    F.coalesce(F.col(f"_{m}_{i}"), F.lit(0)).alias("in_us"),
                )
            )
    wide = pieces.groupBy(*by).agg(*sums)
    if spine is not None:
        wide = spine.join(wide, list(by), "left")
    keep = list(by) if spine is None else spine.columns
    return wide.select(*keep, F.explode(F.array(*rows)).alias("_r")).select(*keep, "_r.*")


def sweep_counts(swept: DataFrame, by: Sequence[str], floor: int = 60 * MINUTE, fraction: float = 0.80) -> DataFrame:
    """Days, assessable days and adherent days per slice, measure and cutoff."""
    able = F.col("assessable_us") >= F.lit(floor)
    good = able & at_least(F.col("in_us"), F.col("assessable_us"), fraction)
    counted = swept.groupBy(*by, "measure", "cutoff").agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(able).alias("n_assessable"), F.count_if(good).alias("n_adherent")
    )
    return counted.withColumns(both_rates(assessable=F.col("n_assessable")))
