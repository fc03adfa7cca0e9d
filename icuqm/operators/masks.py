"""Criterion masks: histogram, ad-hoc rates and the exclusion waterfall."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.operators.slices import slice_cube


def mask_of(bits: Sequence[str]) -> Column:
    """Bit i is the i-th flag; NULL flags count as unset."""
    parts = [F.when(F.coalesce(F.col(b), F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, b in enumerate(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts).cast("bigint")


def mask_histogram(
    days: DataFrame, bits: Sequence[str], grains: Sequence[str] = ("month", "week"), unit: str = "unit", name: str | None = "unit_name"
) -> DataFrame:
    """Days per criterion mask in every slice (A10)."""
    return slice_cube(days.withColumn("mask", mask_of(bits)), {"count": F.count(F.lit(1))}, grains, unit, name, by=["mask"])


def bit(bits: Sequence[str], flag: str, mask: str = "mask") -> Column:
    return F.getbit(F.col(mask), F.lit(bits.index(flag))) == F.lit(1)


def passes(bits: Sequence[str], require: Sequence[str] = (), forbid: Sequence[str] = (), forbid_unless: Sequence[tuple[str, str]] = ()) -> Column:
    """Denominator rule; ``forbid_unless`` drops days with the first flag but not the second."""
    ok = F.lit(True)
    for flag in require:
        ok = ok & bit(bits, flag)
    for flag in forbid:
        ok = ok & ~bit(bits, flag)
    for flag, other in forbid_unless:
        ok = ok & ~(bit(bits, flag) & ~bit(bits, other))
    return ok


def mask_rate(hist: DataFrame, by: Sequence[str], den: Column, num: Column) -> DataFrame:
    """Days, denominator, numerator and rate of a set of toggles, from the histogram alone."""
    out = hist.groupBy(*by).agg(
        F.sum("count").alias("n_days"),
        F.sum(F.when(den, F.col("count")).otherwise(0)).alias("den"),
        F.sum(F.when(den & num, F.col("count")).otherwise(0)).alias("num"),
    )
    return out.withColumn("rate", F.when(F.col("den") > 0, F.col("num") / F.col("den")))


def mask_waterfall(hist: DataFrame, by: Sequence[str], steps: Mapping[str, Column]) -> DataFrame:
    """Days left and removed after each predicate in turn."""
    left, ok = [F.sum("count").alias("_0")], F.lit(True)
    for i, rule in enumerate(steps.values(), 1):
        ok = ok & rule
        left.append(F.sum(F.when(ok, F.col("count")).otherwise(0)).alias(f"_{i}"))
    labels = ["all", *steps]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(label).alias("label"),
                F.col(f"_{i}").alias("n"),
                (F.lit(0).cast("bigint") if i == 0 else F.col(f"_{i - 1}") - F.col(f"_{i}")).alias("removed"),
            )
            for i, label in enumerate(labels)
        ]
    )
    return hist.groupBy(*by).agg(*left).select(*by, F.explode(rows).alias("_r")).select(*by, "_r.*")
