"""Ordered computation along an entity's timeline, split into time buckets.

A plain window over one entity puts all of the entity's rows into one task, which fails when
one key holds a large part of the table. Here rows are windowed per (entity, time bucket),
each bucket is summarised to one row, the summaries (at most one per bucket of the calendar,
whatever the row count) are scanned per entity, and the carried value joins back to the rows
by (entity, bucket). The rows are shuffled once, as for a plain window. Latest and earliest known
values are summarised from the rows that have one: filled grids and as-of questions are mostly without.

Where it is known which keys have many rows (``Crowd``), only those are split into buckets. All others are
ordered whole, so their rows need no summary and no join, and later steps by the same key no exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuqm.functions.time import DAY, micros

BUCKET = "_bucket"
_AT = "_at"
#: Rows of one key that one task orders whole.
MANY = 200_000


@dataclass(frozen=True)
class Crowd:
    """The values of one key column that have more than ``MANY`` rows: at most one for as many rows of the input."""

    key: str
    values: tuple = ()

    def holds(self) -> Column:
        return F.col(self.key).isin(*self.values) if self.values else F.lit(False)


def crowd_of(df: DataFrame, key: str, n: Column | None = None, many: int = MANY) -> Crowd:
    """Counts the rows of every key, or adds up ``n``; runs a job."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg((F.count(F.lit(1)) if n is None else F.sum(n)).alias("_n"))
    return Crowd(key, tuple(r[0] for r in counted.where(F.col("_n") > F.lit(many)).select(key).collect()))


def place(rows: DataFrame, bucket: Column, crowd: Crowd | None) -> tuple[DataFrame, list[str]]:
    """Rows with their bucket, and its name; without one where every key is ordered whole. Of no crowd nothing is known."""
    if crowd is None:
        return rows.withColumn(BUCKET, bucket), [BUCKET]
    if not crowd.values:
        return rows, []
    return rows.withColumn(BUCKET, F.when(crowd.holds(), bucket).otherwise(F.lit(0))), [BUCKET]


@dataclass(frozen=True)
class Along:
    """One value computed along the timeline."""

    kind: str
    value: Column
    nullable: bool = False


def previous(value: Column, nullable: bool = False) -> Along:
    """Value on the previous row. With ``nullable`` it comes as ``struct<v>``, NULL on the first row."""
    return Along("previous", value, nullable)


def following(value: Column, nullable: bool = False) -> Along:
    return Along("following", value, nullable)


def previous_at() -> Along:
    """Time of the previous row."""
    return Along("previous_at", F.col(_AT))


def following_at() -> Along:
    """Time of the next row. The bucket summary is a plain minimum, which hash-aggregates."""
    return Along("following_at", F.col(_AT))


def last_seen(value: Column) -> Along:
    """Latest non-NULL value up to and including the row."""
    return Along("last_seen", value)


def next_seen(value: Column) -> Along:
    """Earliest non-NULL value from the row on."""
    return Along("next_seen", value)


def running_sum(value: Column) -> Along:
    return Along("running_sum", value)


def running_max_before(value: Column) -> Along:
    """Largest value on strictly earlier rows."""
    return Along("running_max_before", value)


def running_min(value: Column) -> Along:
    return Along("running_min", value)


def bucket_of(us: Column, width: int = DAY) -> Column:
    return F.floor(us / F.lit(width)).cast("bigint")


def along(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    values: dict[str, Along],
    tiebreak: Sequence[str] = (),
    width: int = DAY,
    placed: bool = False,
    crowd: Crowd | None = None,
) -> DataFrame:
    """Add one column per entry of ``values``, ordered by ``on`` (then ``tiebreak``) inside ``by``.

    Rows without a key or a time have no place on a timeline and are dropped. Rows that are ``placed`` come with
    their bucket of this ``width``, so that an exchange by it before the call serves here, too. The key of a
    ``crowd`` is one of ``by``.
    """
    by = list(by)
    present = F.col(on).isNotNull()
    for key in by:
        present = present & F.col(key).isNotNull()
    rows = df.where(present).withColumn(_AT, micros(df, on))
    if placed:
        split = [BUCKET] if crowd is None or crowd.values else []
    else:
        rows, split = place(rows, bucket_of(F.col(_AT), width), crowd)
    order = [F.col(_AT), *[F.col(c) for c in tiebreak]]
    rank = F.struct(*order) if tiebreak else F.col(_AT)

    local = Window.partitionBy(*by, *split).orderBy(*order)
    local_back = Window.partitionBy(*by, *split).orderBy(*[c.desc() for c in order])
    entity = Window.partitionBy(*by).orderBy(BUCKET)
    entity_back = Window.partitionBy(*by).orderBy(F.col(BUCKET).desc())
    upto, before = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)

    inside: dict[str, Column] = {}
    summary: dict[str, Column] = {}
    known: dict[str, Column] = {}
    carried: dict[str, Column] = {}
    final: dict[str, Column] = {}
    for name, item in values.items():
        mine, total, carry = f"_l_{name}", f"_s_{name}", f"_c_{name}"
        value = F.struct(item.value.alias("v")) if item.nullable else item.value
        seen = F.when(item.value.isNotNull(), rank)
        if item.kind in ("last_seen", "next_seen"):
            known[total] = item.value.isNotNull()
        total_col = F.col(total)
        final[name] = F.coalesce(F.col(mine), F.col(carry))
        match item.kind:
            case "previous":
                inside[mine] = F.lag(value).over(local)
                summary[total] = F.max_by(value, rank)
                carried[carry] = F.lag(total_col).over(entity)
            case "following":
                inside[mine] = F.lead(value).over(local)
                summary[total] = F.min_by(value, rank)
                carried[carry] = F.lead(total_col).over(entity)
            case "previous_at":
                inside[mine] = F.lag(value).over(local)
                summary[total] = F.max(value)
                carried[carry] = F.lag(total_col).over(entity)
            case "following_at":
                inside[mine] = F.lead(value).over(local)
                summary[total] = F.min(value)
                carried[carry] = F.lead(total_col).over(entity)
            case "last_seen":
                inside[mine] = F.last(value, ignorenulls=True).over(local.rowsBetween(*upto))
                summary[total] = F.max_by(value, seen)
                carried[carry] = F.last(total_col, ignorenulls=True).over(entity.rowsBetween(*before))
            case "next_seen":
                inside[mine] = F.last(value, ignorenulls=True).over(local_back.rowsBetween(*upto))
                summary[total] = F.min_by(value, seen)
                carried[carry] = F.last(total_col, ignorenulls=True).over(entity_back.rowsBetween(*before))
            case "running_sum":
                inside[mine] = F.sum(value).over(local.rowsBetween(*upto))
                summary[total] = F.sum(value)
                carried[carry] = F.sum(total_col).over(entity.rowsBetween(*before))
                final[name] = F.coalesce(F.col(mine), F.lit(0)) + F.coalesce(F.col(carry), F.lit(0))
            case "running_max_before":
                inside[mine] = F.max(value).over(local.rowsBetween(*before))
                summary[total] = F.max(value)
                carried[carry] = F.max(total_col).over(entity.rowsBetween(*before))
                final[name] = F.greatest(F.col(mine), F.col(carry))
            case "running_min":
                inside[mine] = F.min(value).over(local.rowsBetween(*upto))
                summary[total] = F.min(value)
                carried[carry] = F.min(total_col).over(entity.rowsBetween(*before))
                final[name] = F.least(F.col(mine), F.col(carry))
            case other:
                raise ValueError(other)

    if not split:
        return rows.withColumns(inside).withColumns({n: F.lit(None) for n in carried}).withColumns(final).drop(_AT, *inside, *carried)
    summed = rows if crowd is None else rows.where(crowd.holds())
    # what every row adds to hash-aggregates; the latest value is sorted for, so only rows that have one go there
    whole = [c.alias(n) for n, c in summary.items() if n not in known]
    per_bucket = summed.groupBy(*by, BUCKET).agg(*whole) if whole else summed.select(*by, BUCKET).distinct()
    if known:
        having = summed.where(reduce(lambda a, b: a | b, known.values()))
        found = having.groupBy(*by, BUCKET).agg(*[summary[n].alias(n) for n in known])
        per_bucket = per_bucket.join(found, [*by, BUCKET], "left")
    carries = per_bucket.select(*by, BUCKET, *[c.alias(n) for n, c in carried.items()])
    joined = rows.withColumns(inside).join(carries, [*by, BUCKET], "inner" if crowd is None else "left")
    return joined.withColumns(final).drop(_AT, BUCKET, *inside, *carried)


RUN = "_run"


def mark_runs(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    value: str,
    breaks: Callable[[Column, Column], Column],
    tiebreak: Sequence[str] = (),
    width: int = DAY,
    crowd: Crowd | None = None,
) -> DataFrame:
    """Add ``_run``: the order columns of the first row of the row's run.

    ``breaks(before, now)`` tells from two neighbours, as structs ``at, v``, whether a run starts at the
    second. Rows are exchanged once. A bucket's summary holds its first and last row and its last run
    start after the first row; of two buckets' summaries the summary of both follows, so one scan over the
    buckets closes the runs that cross their borders.
    """
    by = list(by)
    present = F.col(on).isNotNull()
    for key in by:
        present = present & F.col(key).isNotNull()
    rows, split = place(df.where(present).withColumn(_AT, micros(df, on)), bucket_of(micros(df, on), width), crowd)
    order = [F.col(_AT), *[F.col(c) for c in tiebreak]]
    spot = F.struct(*order)
    here = F.struct(F.col(_AT).alias("at"), F.col(value).alias("v"))
    local = Window.partitionBy(*by, *split).orderBy(*order)
    upto = Window.unboundedPreceding, 0
    inside = rows.withColumn("_before", F.lag(here).over(local))
    first = F.col("_before").isNull()
    # the first row of a key that is ordered whole starts a run, that of a bucket may go on with one
    whole = F.lit(False) if crowd is None else ~crowd.holds()
    starts = F.when((first & whole) | (~first & breaks(F.col("_before"), here)), spot)
    inside = inside.withColumn("_own", F.last(starts, ignorenulls=True).over(local.rowsBetween(*upto)))
    if not split:
        return inside.withColumnRenamed("_own", RUN).drop("_before")
    summed = inside if crowd is None else inside.where(crowd.holds())
    summary = summed.groupBy(*by, BUCKET).agg(
        F.min_by(here, spot).alias("_first"), F.min(spot).alias("_head"), F.max_by(here, spot).alias("_last"), F.max("_own").alias("_tail")
    )
    entity = Window.partitionBy(*by).orderBy(BUCKET)
    summary = summary.withColumn("_was", F.lag("_last").over(entity))
    head = F.when(F.col("_was").isNull() | breaks(F.col("_was"), F.col("_first")), F.col("_head"))
    summary = summary.withColumn("_head", head)
    carried = F.last(F.coalesce("_tail", "_head"), ignorenulls=True).over(entity.rowsBetween(Window.unboundedPreceding, -1))
    summary = summary.select(*by, BUCKET, F.coalesce("_head", carried).alias("_open"))
    joined = inside.join(summary, [*by, BUCKET], "inner" if crowd is None else "left")
    return joined.withColumn(RUN, F.coalesce("_own", "_open")).drop("_before", "_own", "_open", BUCKET)
