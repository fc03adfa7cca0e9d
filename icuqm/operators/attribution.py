"""Which unit a day belongs to.

Every step is an aggregate with partial results, so no group is collected into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def majority_nested(rows: DataFrame, by: Sequence[str], outer: str, inner: str) -> DataFrame:
    """Unit with most rows per key, ties alphabetical; then the name with most rows inside that unit."""
    named = rows.groupBy(*by, outer, inner).agg(F.count(F.lit(1)).alias("_n"))
    per_unit = named.groupBy(*by, outer).agg(F.sum("_n").alias("_u"), F.min(F.struct(-F.col("_n"), F.col(inner))).alias("_best"))
    pick = F.min(F.struct(-F.col("_u"), F.col(outer), F.col(f"_best.{inner}"))).alias("_pick")
    return per_unit.groupBy(*by).agg(pick, F.sum("_u").alias("n_rows")).select(
        *by, F.col(f"_pick.{outer}").alias(outer), F.col(f"_pick.{inner}").alias(inner), "n_rows"
    )


def longest_piece_nested(pieces: DataFrame, by: Sequence[str], outer: str, inner: str, span: tuple[str, str] = ("start", "end"), unknown: str = "unknown") -> DataFrame:
    """Unit of the longest single piece, then the name with most time inside it, with the day window.

    Pieces without a unit are skipped for the choice but count in the totals. Once there is a row per key, unit and
    name, a key's rows are brought together, so that units and keys are told without a further exchange.
    """
    length = F.col(span[1]) - F.col(span[0])
    named = pieces.groupBy(*by, outer, inner).agg(
        F.max(length).alias("_top"), F.sum(length).alias("_sum"), F.min(span[0]).alias("_in"), F.max(span[1]).alias("_out")
    ).repartition(*by)
    per_unit = named.groupBy(*by, outer).agg(
        F.max("_top").alias("_top"),
        F.min(F.when(F.col(inner).isNotNull(), F.struct(-F.col("_sum"), F.col(inner)))).alias("_best"),
        F.sum("_sum").alias("_sum"),
        F.min("_in").alias("_in"),
        F.max("_out").alias("_out"),
    )
    choice = F.when(F.col(outer).isNotNull(), F.struct(-F.col("_top"), F.col(outer), F.col(f"_best.{inner}").alias(inner)))
    blank = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit(unknown))
    return per_unit.groupBy(*by).agg(
        F.min(choice).alias("_pick"), (F.sum("_sum") / F.lit(60_000_000.0)).alias("minutes"), F.min("_in").alias("day_in"), F.max("_out").alias("day_out")
    ).select(
        *by,
        blank(F.col(f"_pick.{outer}")).alias(outer),
        blank(F.col(f"_pick.{inner}")).alias(inner),
        "minutes",
        "day_in",
        "day_out",
    )


def primary_unit(days: DataFrame, by: Sequence[str], unit: str) -> DataFrame:
    """Unit with most days per entity, ties alphabetical."""
    counted = days.groupBy(*by, unit).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*by).agg(F.min(F.struct(-F.col("_n"), F.col(unit))).alias("_pick")).select(
        *by, F.col(f"_pick.{unit}").alias(unit)
    )
