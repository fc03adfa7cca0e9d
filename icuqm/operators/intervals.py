"""Intervals from time-stamped rows, day split, union and gaps (T-CF, T-LI, T-SEG, T-DS, T-UN, T-GAP)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuqm.functions.time import DAY, HOUR, local_day, micros, midnight, minutes
from icuqm.operators.ordered import BUCKET, Crowd, along, following_at, last_seen, previous_at, running_sum
from icuqm.operators.overlap import Span, list_buckets, points_in_intervals


def carry_forward(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    carries: dict[str, tuple[Column, int | None]],
    tiebreak: Sequence[str] = (),
    width: int = DAY,
    lead: tuple[int, int] | None = None,
    placed: bool = False,
    crowd: Crowd | None = None,
) -> DataFrame:
    """Latest non-NULL value per entry, blanked once older than its window (T-CF, T-CO).

    ``carries`` maps a new column to (value, window in microseconds or None for no limit). To carry a
    value seen together with another one, pass it masked: ``F.when(other.isNotNull(), value)``.
    ``lead=(max_gap, trail)`` also builds the row's interval, in the same pass (T-LI). ``placed`` and
    ``crowd`` are those of ``along``.
    """
    with_at = df.withColumn("_cf_at", micros(df, on))
    # only a value that ages needs its time
    stamped = {
        name: last_seen(value if window is None else F.when(value.isNotNull(), F.struct(value.alias("v"), F.col("_cf_at").alias("at"))))
        for name, (value, window) in carries.items()
    }
    if lead:
        stamped["_next"] = following_at()
    seen = along(with_at, by, on, stamped, tiebreak, width, placed, crowd)
    out = {}
    for name, (_, window) in carries.items():
        if window is not None:
            out[name] = F.when(F.col("_cf_at") - F.col(f"{name}.at") <= F.lit(window), F.col(f"{name}.v"))
    if lead:
        out["start"] = F.col("_cf_at")
        out["end"] = _lead_end(F.col("_cf_at"), *lead)
    return seen.withColumns(out).drop("_cf_at", "_next")


def _lead_end(start: Column, max_gap: int, trail: int) -> Column:
    held = F.when(F.col("_next") - start <= F.lit(max_gap), F.col("_next"))
    return F.coalesce(held, start + F.lit(trail))


def lead_intervals(
    df: DataFrame, by: Sequence[str], on: str, max_gap: int = DAY, trail: int = HOUR, tiebreak: Sequence[str] = (), width: int = DAY
) -> DataFrame:
    """``[t, next)`` per row; the last row and rows before a longer gap hold for ``trail`` (T-LI)."""
    stamped = df.withColumn("start", micros(df, on))
    ahead = along(stamped, by, on, {"_next": following_at()}, tiebreak, width)
    return ahead.withColumn("end", _lead_end(F.col("start"), max_gap, trail)).drop("_next")


def step_segments(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    cap: int = DAY,
    active: Column | None = None,
    tiebreak: Sequence[str] = (),
    width: int = DAY,
    crowd: Crowd | None = None,
    found: str | None = None,
) -> DataFrame:
    """Step function: a row holds until the next one, only the last row ends at ``cap`` (T-SEG, T-ACT).

    ``found`` names the column with the time of the next row, by the same order, where an earlier pass along
    the rows has found it; rows without a key or a time are then gone already.
    """
    stamped = df.withColumn("start", micros(df, on))
    if found:
        ahead = stamped.withColumnRenamed(found, "_next")
    else:
        ahead = along(stamped, by, on, {"_next": following_at()}, tiebreak, width, crowd=crowd)
    out = ahead.withColumn("end", F.coalesce(F.col("_next"), F.col("start") + F.lit(cap))).drop("_next")
    if active is not None:
        out = out.withColumn("active", F.coalesce(active, F.lit(False)))
    return out.where(F.col("end") > F.col("start"))


def split_by_day(df: DataFrame, span: Span = ("start", "end"), two_piece: bool = False) -> DataFrame:
    """One row per local day an interval touches, clipped to the day (T-DSN).

    ``two_piece`` gives everything after the first midnight to the next day (T-DS2); it differs only
    for intervals that touch three days. Adds ``day`` and ``minutes`` and replaces the span.
    """
    start, end = F.col(span[0]), F.col(span[1])
    first, last = local_day(start), local_day(end - 1)
    if two_piece:
        last = F.least(last, F.date_add(first, 1))
    rows = df.where(end > start).withColumn("_first", first).withColumn("day", F.explode(F.sequence(first, last)))
    day_start, day_end = midnight(F.col("day")), midnight(F.date_add(F.col("day"), 1))
    piece_end = F.least(end, day_end)
    if two_piece:
        piece_end = F.when(F.col("day") > F.col("_first"), end).otherwise(piece_end)
    return (
        rows.withColumns({"_s": F.greatest(start, day_start), "_e": piece_end})
        .drop(*span, "_first")
        .withColumnsRenamed({"_s": span[0], "_e": span[1]})
        .where(F.col(span[1]) > F.col(span[0]))
        .withColumn("minutes", minutes(F.col(span[1]) - F.col(span[0])))
    )


def union_intervals(df: DataFrame, by: Sequence[str], span: Span = ("start", "end"), width: int = DAY) -> DataFrame:
    """Merged intervals per key; overlapping or touching ones become one (T-UN).

    Intervals are cut at bucket borders and merged inside each bucket. Only blocks that touch a
    border can go on in the next bucket: at most two per bucket, joined up per key afterwards.
    """
    by = list(by)
    lo, hi = F.col(BUCKET) * F.lit(width), (F.col(BUCKET) + 1) * F.lit(width)
    cut = list_buckets(df.select(*by, *span), span, width).select(
        *by, BUCKET, F.greatest(F.col(span[0]), lo).alias("start"), F.least(F.col(span[1]), hi).alias("end")
    )
    local = Window.partitionBy(*by, BUCKET).orderBy("start", "end")
    reach = F.max("end").over(local.rowsBetween(Window.unboundedPreceding, -1))
    blocks = (
        cut.withColumn("_new", (reach.isNull() | (F.col("start") > reach)).cast("int"))
        .withColumn("_island", F.sum("_new").over(local.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*by, BUCKET, "_island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    at_border = (F.col("start") == lo) | (F.col("end") == hi)
    inner = blocks.where(~at_border).select(*by, "start", "end")
    key = Window.partitionBy(*by).orderBy("start")
    chained = (
        blocks.where(at_border)
        .withColumn("_new", F.coalesce((F.col("start") > F.lag("end").over(key)).cast("int"), F.lit(1)))
        .withColumn("_chain", F.sum("_new").over(key.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*by, "_chain")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select(*by, "start", "end")
    )
    return inner.unionByName(chained)


def off_gaps(
    active: DataFrame, windows: DataFrame, by: Sequence[str], key: Sequence[str], span: Span, window: Span, width: int = DAY
) -> DataFrame:
    """Gaps in the active time of each window, after its first active moment (T-GAP).

    A gap between two active blocks has ``resumed = true``; the rest of the window after the last
    block has ``resumed = false``. The active intervals may overlap: they are merged per key first, and the
    windows are joined to the merged blocks' ends, so no window is ordered in one task.
    """
    keys = [*by, *key]
    blocks = union_intervals(active.select(*by, F.col(span[0]).alias("start"), F.col(span[1]).alias("end")), by, width=width)
    ahead = along(blocks, by, "start", {"_next": following_at()}, width=width)
    ends = ahead.select(*by, F.col("end").alias("gap_start"), F.col("_next"))
    # a block that ends inside a window was active in it, so its end starts a gap there
    held = points_in_intervals(ends, windows.select(*keys, *window), by, "gap_start", window, closed="none", width=width)
    resumed = F.coalesce(F.col("_next") < F.col(window[1]), F.lit(False))
    return held.select(*keys, "gap_start", F.least(F.col("_next"), F.col(window[1])).alias("gap_end"), resumed.alias("resumed"))


def qualify_holds(gaps: DataFrame, keys: Sequence[str], floor: int) -> DataFrame:
    """Per window: gaps of at least ``floor``, the longest, the first, and whether any resumed (T-HOLD)."""
    length = F.col("gap_end") - F.col("gap_start")
    return (
        gaps.where(length >= F.lit(floor))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_holds"),
            minutes(F.max(length)).alias("longest_off_min"),
            F.min("gap_start").alias("first_hold"),
            F.bool_or("resumed").alias("resumed"),
        )
    )


def count_before(
    days: DataFrame, events: DataFrame, by: Sequence[str], at: str, on: str, name: str, width: int = DAY, crowd: Crowd | None = None
) -> DataFrame:
    """Events of the key strictly before each row's time, by a running count."""
    by = list(by)
    asked = days.where(F.col(at).isNotNull()).select(
        *by, micros(days, at).alias("_t"), F.lit(0).alias("_hit"), F.struct(*[c for c in days.columns if c not in by]).alias("_row")
    )
    seen = events.select(*by, micros(events, on).alias("_t"), F.lit(1).alias("_hit"))
    both = asked.unionByName(seen, allowMissingColumns=True)
    counted = along(both, by, "_t", {name: running_sum(F.col("_hit"))}, ["_hit"], width, crowd=crowd)
    return counted.where("_hit = 0").select(
        *[F.col(c) if c in by else F.col(f"_row.{c}").alias(c) for c in days.columns], F.col(name).cast("bigint").alias(name)
    )


def cadence(df: DataFrame, by: Sequence[str], on: str, tiebreak: Sequence[str] = (), width: int = DAY) -> DataFrame:
    """Hours since the key's previous reading (T-CNT)."""
    stamped = df.withColumn("_now", micros(df, on))
    back = along(stamped, by, on, {"_prev": previous_at()}, tiebreak, width)
    return back.withColumn("gap_h", (F.col("_now") - F.col("_prev")) / F.lit(float(HOUR))).drop("_now", "_prev")
