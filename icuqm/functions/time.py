"""Elapsed microseconds, local days and reporting periods.

Durations, caps and gaps are elapsed time, so they are computed on BIGINT microseconds;
Spark's timestamp arithmetic is wall-clock and would be an hour off around a clock change.
Local days follow the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE = 60_000_000
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(df: DataFrame, name: str) -> Column:
    """Column ``name`` as epoch microseconds, whatever time type it is stored in."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("long", "bigint", "integer"):
        return F.col(name).cast("bigint")
    return F.unix_micros(F.col(name).cast("timestamp"))


def instant(us: Column) -> Column:
    return F.timestamp_micros(us)


def local_day(us: Column) -> Column:
    """Local calendar day that contains the instant."""
    return F.to_date(F.timestamp_micros(us))


def midnight(day: Column) -> Column:
    """Epoch microseconds of the local midnight that starts ``day``."""
    return F.unix_micros(day.cast("timestamp"))


def minutes(us: Column) -> Column:
    return us / F.lit(float(MINUTE))


def hours(us: Column) -> Column:
    return us / F.lit(float(HOUR))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def week_key(day: Column) -> Column:
    """ISO week, ``YYYY-Www``; the year is the ISO year, not the calendar year."""
    iso_year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(F.lpad(iso_year, 4, "0"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def week_start(week: Column) -> Column:
    """Monday of an ISO week key. 4 January always lies in week 1."""
    january4 = F.to_date(F.concat(F.substring(week, 1, 4), F.lit("-01-04")))
    first_monday = F.date_trunc("week", january4).cast("date")
    return F.date_add(first_monday, (F.substring(week, 7, 2).cast("int") - 1) * 7)


def month_of_week(week: Column) -> Column:
    """Calendar month that holds the week's Thursday."""
    return month_key(F.date_add(week_start(week), 3))


def month_label(month: Column) -> Column:
    return F.date_format(F.to_date(F.concat(month, F.lit("-01"))), "MMM yyyy")


def week_label(week: Column) -> Column:
    number = F.substring(week, 7, 2).cast("int").cast("string")
    return F.concat(F.lit("Week "), number, F.lit(" · "), F.date_format(week_start(week), "MMM yyyy"))


def localise(ntz: Column) -> Column:
    """Zone-less local time to an instant.

    A time that occurs twice (clock set back) becomes NULL; a time that never occurs (clock
    set forward) moves to the first valid instant. Clock changes start on a full hour.
    """
    at = ntz.cast("timestamp")
    shown = at.cast("timestamp_ntz")

    def shows_again(after: int) -> Column:
        return F.timestamp_micros(F.unix_micros(at) + F.lit(after)).cast("timestamp_ntz") == ntz

    ambiguous = shows_again(HOUR) | shows_again(HOUR // 2)
    into_hour = F.unix_micros(at) - F.unix_micros(F.date_trunc("hour", at))
    first_valid = F.timestamp_micros(F.unix_micros(at) - into_hour)
    return (
        F.when(ambiguous, F.lit(None).cast("timestamp"))
        .when(shown != ntz, first_valid)
        .otherwise(at)
    )
