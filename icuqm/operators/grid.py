"""Grid times, hourly scaffold and stay stitching (T-SCF, T-STI)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuqm.functions.time import DAY, HOUR, instant, micros
from icuqm.operators.intervals import carry_forward
from icuqm.operators.ordered import BUCKET, Crowd, along, bucket_of, crowd_of, last_seen, running_max_before

#: Tasks that list grid times. The number is set, as spans are a few bytes each: merged by their size, those of a
#: million entities would be listed by one task.
LISTING = 96


def spread(spans: DataFrame, by: Sequence[str]) -> DataFrame:
    """One span per entity, dealt to ``LISTING`` tasks."""
    return spans.repartition(LISTING, *by)


def time_grid(spans: DataFrame, by: Sequence[str], lo: str, hi: str, step: int, name: str = "at") -> DataFrame:
    """One row per entity and ``step`` from ``lo`` up to ``hi``, both microseconds."""
    return spread(spans, by).select(*by, F.explode(F.sequence(lo, hi, F.lit(step))).alias(name))


#: Rows of the scaffold and of the record that one task orders, where the record's spans are known.
ORDERED = 250_000


def hour_spans(df: DataFrame, by: Sequence[str], on: str) -> DataFrame:
    """Per entity the first and last hour of its record, ``lo`` and ``hi``, and the rows of its scaffold and its record, ``n``."""
    at = df.select(*by, micros(df, on).alias("at")).where(F.col("at").isNotNull())
    hour = F.unix_micros(F.date_trunc("hour", instant(F.col("at"))))
    ends = at.groupBy(*by).agg(F.min(hour).alias("lo"), F.max(hour).alias("hi"), F.count(F.lit(1)).alias("n"))
    return ends.withColumn("n", F.col("n") + F.floor((F.col("hi") - F.col("lo")) / F.lit(HOUR)) + 1)


def hourly_scaffold(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    carry: Sequence[str],
    tiebreak: Sequence[str] = (),
    width: int = DAY,
    spans: DataFrame | None = None,
    crowd: Crowd | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Native rows plus one row at hh:59:59 of every hour of the entity's record (T-SCF).

    ``carry`` columns are filled forward without limit and never backward. The result has ``at``
    (microseconds) and ``is_scaffold``.

    The scaffold is exchanged as one row per bucket, with its first and last time there, or as one per entity that
    is ordered whole; the hours are listed after the exchange, by the task that orders them. ``spans`` are the stored
    ``hour_spans`` of the same rows; the number of tasks then follows their sum. ``crowd`` is that of ``along``, and
    ``within`` names those columns of ``by`` by which the rows lie together afterwards.
    """
    by = list(by)
    native = df.select(*by, micros(df, on).alias("at"), *[c for c in df.columns if c not in (*by, on)]).withColumn(
        "is_scaffold", F.lit(False)
    )
    last_second = F.lit(HOUR - 1_000_000)
    ends = (hour_spans(native, by, "at") if spans is None else spans).select(*by, "lo", "hi")
    lo, hi = F.col("lo") + last_second, F.col("hi") + last_second
    split = F.lit(True) if crowd is None else crowd.holds()
    # an entity that is ordered whole has one bucket
    touched = F.when(split, F.sequence(bucket_of(lo, width), bucket_of(hi, width))).otherwise(F.array(F.lit(0).cast("bigint")))
    buckets = spread(ends, by).withColumn(BUCKET, F.explode(touched))
    # the first scaffold row from the bucket's border on
    ahead = F.when(split, F.greatest(F.col(BUCKET) * F.lit(width) - lo, F.lit(0))).otherwise(F.lit(0))
    until = F.when(split, F.least(hi, (F.col(BUCKET) + 1) * F.lit(width) - 1)).otherwise(hi)
    grid = buckets.select(
        *by, BUCKET, (lo + ahead + F.pmod(-ahead, F.lit(HOUR))).alias("at"), until.alias("_until"), F.lit(True).alias("is_scaffold")
    ).where(F.col("at") <= F.col("_until"))
    both = native.withColumn(BUCKET, F.when(split, bucket_of(F.col("at"), width)).otherwise(F.lit(0))).unionByName(grid, allowMissingColumns=True)
    keys = [*(within or by), *([BUCKET] if crowd is None or crowd.values else [])]
    if spans is None:
        both = both.repartition(*keys)
    else:
        both = both.repartition(max(1, -(-(spans.agg(F.sum("n")).first()[0] or 0) // ORDERED)), *keys)
    listed = both.withColumn("at", F.explode(F.sequence(F.col("at"), F.coalesce("_until", "at"), F.lit(HOUR)))).drop("_until")
    filled = carry_forward(listed, by, "at", {f"_f_{c}": (F.col(c), None) for c in carry}, ["is_scaffold", *tiebreak], width, placed=True, crowd=crowd)
    return filled.withColumns({c: F.col(f"_f_{c}") for c in carry}).drop(BUCKET, *[f"_f_{c}" for c in carry])


def stitch_stays(
    df: DataFrame, person: str, stay: str, start: str, end: str, within: int = 6 * HOUR, width: int = 30 * DAY
) -> DataFrame:
    """Link a person's stays that are at most ``within`` apart into one block (T-STI).

    Adds ``block_start`` and ``encounter_block``, named after the block's first stay.
    """
    stamped = df.withColumns({"_in": micros(df, start), "_out": micros(df, end)})
    crowd = crowd_of(df, person)
    reach = along(stamped, [person], "_in", {"_reach": running_max_before(F.coalesce("_out", "_in"))}, [stay], width, crowd=crowd)
    opens = F.col("_reach").isNull() | (F.col("_in") - F.col("_reach") > F.lit(within))
    head = F.when(opens, F.struct(F.col("_in").alias("at"), F.col(stay).alias("id")))
    linked = along(reach, [person], "_in", {"_head": last_seen(head)}, [stay], width, crowd=crowd)
    return linked.withColumns(
        {"block_start": F.col("_head.at"), "encounter_block": F.col("_head.id").cast("string")}
    ).drop("_in", "_out", "_reach", "_head")
