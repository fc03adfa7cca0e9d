"""As-of joins: the latest right row at or before each left row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuqm.functions.time import DAY, micros
from icuqm.operators.ordered import Crowd, along, last_seen


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    tolerance: int | None = None,
    tiebreak: Sequence[str] = (),
    strict: bool = False,
    width: int = DAY,
    crowd: Crowd | None = None,
) -> DataFrame:
    """Left rows with the columns of the latest right row of the same key.

    ``tolerance`` (microseconds, inclusive) blanks an older match. ``strict`` asks for an
    earlier time instead of an equal one. Of right rows at one time the last by ``tiebreak``
    wins. A left row without a key or a time matches nothing and stays.
    """
    by = list(by)
    extra = [c for c in right.columns if c not in by]
    clash = set(extra) & set(left.columns)
    if clash:
        raise ValueError(f"rename right columns that also exist on the left: {sorted(clash)}")
    order = [F.col(c) for c in tiebreak] or [F.lit(0)]
    match = F.struct(micros(right, right_on).alias("at"), *[F.col(c) for c in extra])
    points = right.where(F.col(right_on).isNotNull()).select(
        *by,
        micros(right, right_on).alias("_t"),
        F.lit(2 if strict else 0).alias("_side"),
        F.struct(*order).alias("_order"),
        match.alias("_right"),
    )
    placed = F.col(left_on).isNotNull()
    for key in by:
        placed = placed & F.col(key).isNotNull()
    lost = left.where(~placed).select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in extra])
    asked = left.where(placed).select(
        *by,
        micros(left, left_on).alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*[c for c in left.columns if c not in by]).alias("_left"),
    )
    both = asked.unionByName(points, allowMissingColumns=True)
    found = along(both, by, "_t", {"_match": last_seen(F.col("_right"))}, ["_side", "_order"], width, crowd=crowd).where("_side = 1")
    keep = F.col("_match")
    if tolerance is not None:
        keep = F.when(F.col("_t") - F.col("_match.at") <= F.lit(tolerance), keep)
    found = found.withColumn("_match", keep)
    own = [F.col(c) if c in by else F.col(f"_left.{c}").alias(c) for c in left.columns]
    return found.select(*own, *[F.col(f"_match.{c}").alias(c) for c in extra]).unionByName(lost)


def asof_contained(
    left: DataFrame,
    stays: DataFrame,
    by: Sequence[str],
    on: str,
    start: str,
    end: str,
    name: str = "contained",
    tiebreak: Sequence[str] = (),
    width: int = DAY,
) -> DataFrame:
    """As-of join to the latest-started stay, and whether that stay still runs.

    Only that stay is tested: an earlier, longer stay does not count, nor does one without end.
    """
    joined = asof_join(left, stays, by, on, start, tiebreak=tiebreak, width=width)
    still = micros(joined, on) < micros(joined, end)
    return joined.withColumn(name, F.coalesce(still, F.lit(False)))
