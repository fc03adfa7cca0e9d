"""Runs, state episodes, transitions and sessions (T-RUN, T-EPI, T-TRN, T-SES), first events (T-ON, T-PER)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.functions.time import DAY, HOUR, micros, minutes
from icuqm.operators.ordered import _AT, RUN, Crowd, along, following_at, mark_runs, next_seen, previous, running_min


def runs(
    df: DataFrame, by: Sequence[str], on: str, flag: str, max_step: int, tiebreak: Sequence[str] = (), width: int = DAY
) -> DataFrame:
    """Maximal runs of one flag value without a step above ``max_step`` (T-RUN)."""
    near = lambda was, now: ~was["v"].eqNullSafe(now["v"]) | (now["at"] - was["at"] > F.lit(max_step))
    marked = mark_runs(df, by, on, flag, near, tiebreak, width)
    return marked.groupBy(*by, F.col(f"{RUN}.{_AT}").alias("run_start"), flag).agg(F.max(_AT).alias("run_end"), F.count(F.lit(1)).alias("run_size"))


def episodes(
    df: DataFrame, by: Sequence[str], on: str, state: str, trail: int = HOUR, tiebreak: Sequence[str] = (), width: int = DAY, crowd: Crowd | None = None
) -> DataFrame:
    """Consecutive rows of one state as ``[start, end)`` with the state before (T-EPI).

    An episode ends where the next one starts; the entity's last episode ends ``trail`` after its
    last row and has ``closed = false``.
    """
    by = list(by)
    slim = df.select(*by, on, *[c for c in tiebreak if c not in (on, state)], state)
    marked = mark_runs(slim, by, on, state, lambda was, now: ~was["v"].eqNullSafe(now["v"]), tiebreak, width, crowd)
    # a run's state is that of any of its rows; the struct keeps a state of NULL
    eps = marked.groupBy(*by, RUN).agg(F.first(F.struct(state)).alias("_state"), F.max(_AT).alias("_last"))
    order = F.col(RUN).getField(_AT)
    eps = eps.select(*by, order.alias("start"), RUN, "_state", "_last")
    near = along(eps, by, "start", {"_was": previous(F.col("_state")), "_next": following_at()}, [RUN], width, crowd=crowd)
    return near.select(
        *by,
        F.col(f"_state.{state}").alias(state),
        F.col(f"_was.{state}").alias(f"prev_{state}"),
        "start",
        F.coalesce(F.col("_next"), F.col("_last") + F.lit(trail)).alias("end"),
        F.col("_next").isNotNull().alias("closed"),
    )


def transitions(eps: DataFrame, state: str, to: Iterable[str], from_: Iterable[str]) -> DataFrame:
    """Episodes of one class that directly follow another class (T-TRN)."""
    return eps.where(F.col(state).isin(*to) & F.col(f"prev_{state}").isin(*from_)).withColumn(
        "minutes", minutes(F.col("end") - F.col("start"))
    )


def bookend_sessions(
    df: DataFrame, by: Sequence[str], on: str, state: str, open_value: str, close_value: str, tiebreak: Sequence[str] = (), width: int = DAY
) -> DataFrame:
    """Sessions from the first ``open_value`` row to the next ``close_value`` row (T-SES).

    Without a closing row the session ends at the entity's last open row and says so.
    """
    named = df.where(F.col(state).isin(open_value, close_value))
    eps = episodes(named, by, on, state, trail=0, tiebreak=tiebreak, width=width)
    return eps.where(F.col(state) == open_value).select(
        *by,
        "start",
        "end",
        ((F.col("end") - F.col("start")) / F.lit(float(HOUR))).alias("duration_hours"),
        F.when(F.col("closed"), F.lit(close_value)).otherwise(F.lit("end_of_record")).alias("ended_by"),
    )


def next_event(
    df: DataFrame, by: Sequence[str], on: str, where: Column, name: str, tiebreak: Sequence[str] = (), width: int = DAY
) -> DataFrame:
    """Time of the first row at or after this one that satisfies ``where``."""
    stamped = df.withColumn("_now", micros(df, on))
    return along(stamped, by, on, {name: next_seen(F.when(where, F.col("_now")))}, tiebreak, width).drop("_now")


def first_event(df: DataFrame, by: Sequence[str], on: str, where: Column, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The earliest qualifying row per key (T-ON); partial results combine before the shuffle."""
    rest = [c for c in df.columns if c not in by]
    rank = F.struct(on, *tiebreak)
    return (
        df.where(where)
        .groupBy(*by)
        .agg(F.min_by(F.struct(*rest), rank).alias("_row"))
        .select(*by, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def persists(
    events: DataFrame,
    states: DataFrame,
    by: Sequence[str],
    on: str,
    meets: str,
    after: int,
    breaks: str,
    width: int = DAY,
) -> DataFrame:
    """Whether a condition first met at ``t`` is met again at or after ``t + after`` (T-PER).

    Any row of ``states`` with ``breaks`` true in ``(t, t + after]`` spoils it. One row per key that
    has events: ``n_events``, ``first_met``, ``met_again``, ``broken``, ``n_in_window``, ``persistent``.
    """
    by = list(by)
    seen = events.select(
        *by, micros(events, on).alias("_t"), F.lit(True).alias("_event"), F.coalesce(F.col(meets), F.lit(False)).alias("_meets"), F.lit(False).alias("_breaks")
    )
    held = states.select(
        *by, micros(states, on).alias("_t"), F.lit(False).alias("_event"), F.lit(False).alias("_meets"), F.coalesce(F.col(breaks), F.lit(False)).alias("_breaks")
    ).where("_breaks")
    first = running_min(F.when(F.col("_meets"), F.col("_t")))
    line = along(seen.unionByName(held), by, "_t", {"_first": first}, ["_breaks"], width)
    target = F.col("_first") + F.lit(after)
    out = line.groupBy(*by).agg(
        F.count_if("_event").alias("n_events"),
        F.min("_first").alias("first_met"),
        F.coalesce(F.bool_or(F.col("_meets") & (F.col("_t") >= target)), F.lit(False)).alias("met_again"),
        F.coalesce(
            F.bool_or(F.col("_breaks") & (F.col("_t") > F.col("_first")) & (F.col("_t") <= target)), F.lit(False)
        ).alias("broken"),
        F.count_if(F.col("_meets") & (F.col("_t") <= target)).alias("n_in_window"),
    )
    return out.where("n_events > 0").withColumn(
        "persistent", F.col("first_met").isNotNull() & F.col("met_again") & ~F.col("broken")
    )
