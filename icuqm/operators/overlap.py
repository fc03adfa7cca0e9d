"""Interval joins per key: overlap, containment, flags and sums.

Intervals are half-open ``[start, end)`` in microseconds. An interval is listed at the level at which a
bucket is about as wide as it is long: buckets double from level to level, so it touches two or three of
them however long it is, and one that ends in the year 9999 is no matter. A point probes one bucket of each
level that occurs. A key with very many rows spreads over the buckets of its calendar.

Whether and how long intervals overlap a window needs no pairs at all: counts and sums of the starts and
ends before its borders tell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.functions.time import DAY
from icuqm.operators.ordered import BUCKET, Crowd, along, bucket_of, running_sum

Span = tuple[str, str]
LEVEL = "_level"
#: Levels above that of one bucket; 2^40 days are beyond any calendar.
TOP = 40


def list_buckets(df: DataFrame, span: Span, width: int = DAY, closed: bool = False) -> DataFrame:
    """Rows repeated for each bucket of one width that they touch, for rows that are cut there."""
    start, end = F.col(span[0]), F.col(span[1])
    last = end if closed else end - 1
    usable = (end >= start) if closed else (end > start)
    return df.where(usable).withColumn(
        BUCKET, F.explode(F.sequence(bucket_of(start, width), bucket_of(last, width)))
    )


def level_of(span: Span, width: int) -> Column:
    """The lowest level whose buckets are at least as wide as the interval is long."""
    buckets = (F.col(span[1]) - F.col(span[0])) / F.lit(float(width))
    return F.least(F.greatest(F.ceil(F.log2(F.greatest(buckets, F.lit(1.0)))), F.lit(0)), F.lit(TOP)).cast("int")


def _bucket(us: Column, width: int, level: Column) -> Column:
    return F.floor(us / (F.lit(float(width)) * F.pow(F.lit(2.0), level))).cast("bigint")


def _touched(span: Span, width: int, closed: bool = False) -> Column:
    """The buckets of an interval at ``_level``. A border is compared in floating point, so one bucket more may be named."""
    last = F.col(span[1]) if closed else F.col(span[1]) - 1
    return F.sequence(_bucket(F.col(span[0]), width, F.col(LEVEL)), _bucket(last, width, F.col(LEVEL)))


def list_levels(df: DataFrame, span: Span, width: int = DAY, closed: bool = False) -> DataFrame:
    """Rows repeated for the two or three buckets that they touch at their own level."""
    usable = (F.col(span[1]) >= F.col(span[0])) if closed else (F.col(span[1]) > F.col(span[0]))
    return df.where(usable).withColumn(LEVEL, level_of(span, width)).withColumn(BUCKET, F.explode(_touched(span, width, closed)))


def _levels_in(df: DataFrame, span: Span, width: int, name: str) -> DataFrame:
    """The levels that occur: at most ``TOP`` + 1 rows."""
    return F.broadcast(df.where(F.col(span[1]) >= F.col(span[0])).select(level_of(span, width).alias(name)).distinct())


def intersect_intervals(
    a: DataFrame, b: DataFrame, by: Sequence[str], a_span: Span, b_span: Span, width: int = DAY
) -> DataFrame:
    """Every overlapping pair with the shared part as ``start``, ``end`` (J8, T-INT).

    The shorter side of a pair looks the other one up at that one's level, and the pair is kept in the bucket
    where its overlap starts. Intervals that are too short for any of the other side to be shorter are not listed.
    """
    by = list(by)
    start = F.greatest(F.col(a_span[0]), F.col(b_span[0]))
    end = F.least(F.col(a_span[1]), F.col(b_span[1]))

    def side(probe: DataFrame, probe_span: Span, held: DataFrame, held_span: Span, equal: bool) -> DataFrame:
        levels = _levels_in(held, held_span, width, LEVEL)
        own = level_of(probe_span, width)
        usable = probe.where(F.col(probe_span[1]) > F.col(probe_span[0]))
        asked = usable.join(levels, (own <= F.col(LEVEL)) if equal else (own < F.col(LEVEL)))
        asked = asked.withColumn(BUCKET, F.explode(_touched(probe_span, width)))
        least = F.broadcast(usable.agg(F.min(own).alias("_least")))
        level = level_of(held_span, width)
        met = held.join(least, (level >= F.col("_least")) if equal else (level > F.col("_least"))).drop("_least")
        return asked.join(list_levels(met, held_span, width), [*by, LEVEL, BUCKET])

    kept = [*by, *[c for c in a.columns if c not in by], *[c for c in b.columns if c not in by], LEVEL, BUCKET]
    both = side(a, a_span, b, b_span, True).select(kept).unionAll(side(b, b_span, a, a_span, False).select(kept))
    return (
        both.where((F.col(a_span[0]) < F.col(b_span[1])) & (F.col(a_span[1]) > F.col(b_span[0])))
        .where(_bucket(start, width, F.col(LEVEL)) == F.col(BUCKET))
        .withColumns({"start": start, "end": end})
        .drop(LEVEL, BUCKET)
    )


def points_in_intervals(
    points: DataFrame,
    spans: DataFrame,
    by: Sequence[str],
    on: str,
    span: Span,
    closed: str = "left",
    keep: str = "all",
    width: int = DAY,
) -> DataFrame:
    """Points with the intervals that hold them.

    ``closed='left'`` is ``[start, end)``, ``closed='both'`` is ``[start, end]``, ``closed='none'`` is
    ``(start, end)``. ``keep='earliest'`` keeps, per distinct point row, the interval that started first.
    """
    by = list(by)
    both = closed == "both"
    at = F.col(on)
    inside = ((at > F.col(span[0])) if closed == "none" else (at >= F.col(span[0]))) & ((at <= F.col(span[1])) if both else (at < F.col(span[1])))
    listed = list_levels(spans, span, width, closed=both)
    asked = points.crossJoin(_levels_in(spans, span, width, LEVEL)).withColumn(BUCKET, _bucket(at, width, F.col(LEVEL)))
    joined = asked.join(listed, [*by, LEVEL, BUCKET]).where(inside).drop(LEVEL, BUCKET)
    if keep == "all":
        return joined
    extra = [c for c in spans.columns if c not in by]
    order = F.struct(F.col(span[0]), *[F.col(c) for c in extra if c != span[0]])
    return (
        joined.groupBy(*points.columns)
        .agg(F.min_by(F.struct(*extra), order).alias("_span"))
        .select(*points.columns, *[F.col(f"_span.{c}").alias(c) for c in extra])
    )


def _left_join_filled(days: DataFrame, hits: DataFrame, keys: Sequence[str], fill: dict) -> DataFrame:
    joined = days.join(hits, list(keys), "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in fill.items()})


def overlap_aggregate(
    days: DataFrame,
    spans: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    window: Span,
    span: Span,
    aggs: dict[str, tuple[Column, object]],
    width: int = DAY,
) -> DataFrame:
    """Aggregates over the intervals that overlap each row's window, whose shared part is ``start, end``.

    ``by`` + ``key`` identify a row; ``aggs`` maps a name to (aggregate, value for rows without overlap).
    """
    keys = [*by, *key]
    pairs = intersect_intervals(days.select(*keys, *window), spans, by, window, span, width)
    found = pairs.groupBy(*keys).agg(*[c.alias(n) for n, (c, _) in aggs.items()])
    return _left_join_filled(days, found, keys, {n: v for n, (_, v) in aggs.items()})


# order of rows at one time: what counts at or before it, the question, what counts from it on
_BEFORE, _ASKED, _AFTER = 0, 1, 2


def _counted(asked: DataFrame, spans: DataFrame, by: Sequence[str], span: Span, starts_at: int, sums: bool, width: int, crowd: Crowd | None = None) -> DataFrame:
    """``asked`` (by, ``_t``, ``_row``) with counts, and sums of times, of the starts and ends before each time.

    An end counts from its own time on. A start does with ``starts_at`` ``_BEFORE``, else only after it.
    """
    by = list(by)
    start, end = F.col(span[0]), F.col(span[1])
    real = spans.where(end > start)
    far = lambda at, a, e: [at.alias("_t"), F.lit(a).alias("_s"), F.lit(1 - a).alias("_e"), F.lit(e).alias("_side")]
    marks = real.select(*by, *far(start, 1, starts_at)).unionAll(real.select(*by, *far(end, 0, _BEFORE)))
    rows = marks.unionByName(asked.withColumns({"_s": F.lit(0), "_e": F.lit(0), "_side": F.lit(_ASKED)}), allowMissingColumns=True)
    line = {"_starts": running_sum(F.col("_s").cast("bigint")), "_ends": running_sum(F.col("_e").cast("bigint"))}
    if sums:
        # sums of times outgrow 64 bits
        line["_start_sum"] = running_sum((F.col("_s") * F.col("_t")).cast("decimal(38,0)"))
        line["_end_sum"] = running_sum((F.col("_e") * F.col("_t")).cast("decimal(38,0)"))
    return along(rows, by, "_t", line, ["_side"], width, crowd=crowd).where(F.col("_side") == _ASKED)


def overlap_flag(
    days: DataFrame, spans: DataFrame, by: Sequence[str], key: Sequence[str], window: Span, span: Span, name: str, width: int = DAY,
    crowd: Crowd | None = None,
) -> DataFrame:
    """Whether any interval overlaps the row's window (J11): more start before its end than end by its start."""
    keys = [*by, *key]
    real = days.where(F.col(window[1]) > F.col(window[0]))
    ask = lambda c, last: real.select(*by, F.col(c).alias("_t"), F.struct(*key, F.lit(last).alias("_last")).alias("_row"))
    seen = _counted(ask(window[0], False).unionAll(ask(window[1], True)), spans, by, span, _AFTER, False, width, crowd)
    last = F.col("_row._last")
    found = seen.groupBy(*by, *[F.col(f"_row.{c}").alias(c) for c in key]).agg(
        (F.max(F.when(last, F.col("_starts"))) > F.max(F.when(~last, F.col("_ends")))).alias(name)
    )
    return _left_join_filled(days, found, keys, {name: False})


def overlap_minutes(
    days: DataFrame, spans: DataFrame, by: Sequence[str], key: Sequence[str], window: Span, span: Span, name: str, width: int = DAY,
    crowd: Crowd | None = None,
) -> DataFrame:
    """Minutes of all intervals inside the row's window.

    The time spent in intervals up to ``t`` is ``t`` times the open intervals, less the starts' and plus the
    ends' times; the window's share is the difference between its borders.
    """
    keys = [*by, *key]
    real = days.where(F.col(window[1]) > F.col(window[0]))
    ask = lambda c, last: real.select(*by, F.col(c).alias("_t"), F.struct(*key, F.lit(last).alias("_last")).alias("_row"))
    seen = _counted(ask(window[0], False).unionAll(ask(window[1], True)), spans, by, span, _AFTER, True, width, crowd)
    spent = F.col("_t").cast("decimal(19,0)") * (F.col("_starts") - F.col("_ends")).cast("decimal(18,0)") - F.col("_start_sum") + F.col("_end_sum")
    signed = F.when(F.col("_row._last"), spent).otherwise(-spent)
    found = seen.groupBy(*by, *[F.col(f"_row.{c}").alias(c) for c in key]).agg((F.sum(signed).cast("bigint") / F.lit(60_000_000.0)).alias(name))
    return _left_join_filled(days, found, keys, {name: 0.0})


def not_in_any(
    points: DataFrame, spans: DataFrame, by: Sequence[str], key: Sequence[str], on: str, span: Span, name: str, width: int = DAY
) -> DataFrame:
    """Whether the point lies in no interval of its key (J14): as many have ended by it as have started."""
    keys = [*by, *key]
    asked = points.select(*by, F.col(on).alias("_t"), F.struct(*key).alias("_row"))
    seen = _counted(asked, spans, by, span, _BEFORE, False, width)
    found = seen.groupBy(*by, *[F.col(f"_row.{c}").alias(c) for c in key]).agg(F.bool_and(F.col("_starts") == F.col("_ends")).alias(name))
    return _left_join_filled(points, found, keys, {name: True})


def attribute_events(
    days: DataFrame,
    events: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    window: Span,
    on: str,
    aggs: dict[str, tuple[Column, object]],
    width: int = DAY,
) -> DataFrame:
    """Aggregates of the events inside each row's window.

    ``aggs`` maps a name to (aggregate, value for rows without events).
    """
    keys = [*by, *key]
    extra = [c for c in events.columns if c not in by]
    clash = set(extra) & {*key, *window}
    if clash:
        raise ValueError(f"event columns clash with the day columns: {sorted(clash)}")
    held = points_in_intervals(events, days.select(*keys, *window), by, on, window, width=width)
    found = held.groupBy(*keys).agg(*[c.alias(n) for n, (c, _) in aggs.items()])
    return _left_join_filled(days, found, keys, {n: v for n, (_, v) in aggs.items() if v is not None})
