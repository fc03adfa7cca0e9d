"""Descriptive profiles: value counts, missingness, sizing, trends and Table 1."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuqm.operators.distribution import exact_quantiles, p_value


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc("value")).limit(k)


def missingness(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of non-NULL values per column and of rows with any / all of them."""
    here = {c: F.col(c).isNotNull() for c in columns}
    some, every = reduce(lambda a, b: a | b, here.values()), reduce(lambda a, b: a & b, here.values())
    shares = [F.avg(m.cast("double")).alias(f"{c}_present") for c, m in here.items()]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *shares, F.avg(some.cast("double")).alias("any_present"), F.avg(every.cast("double")).alias("all_present")
    )


def sign_profile(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """NULL, zero and positive counts."""
    v = F.col(value)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v.isNull()).alias("n_null"), F.count_if(v == 0).alias("n_zero"), F.count_if(v > 0).alias("n_positive")
    )


def entity_days(df: DataFrame, entity: str, day: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct (entity, day) pairs."""
    return df.select(*by, entity, day).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n_entity_days"))


def count_matrix(df: DataFrame, row: str, column: str) -> DataFrame:
    """Two-way counts in long form, a row per cell that occurs, with the total of its row."""
    cells = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    # the window sees cells, not rows
    return cells.withColumn("total", F.sum("n").over(Window.partitionBy(row)))


def monthly_series(days: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """Rows per group and month with the empty months inside a group's span as 0, and the change to the month before."""
    by = list(by)
    month = F.trunc(F.col(day), "month")
    counted = days.groupBy(*by, month.alias("month")).agg(F.count(F.lit(1)).alias("n"))
    span = counted.groupBy(*by).agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    calendar = span.select(*by, F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month"))
    filled = calendar.join(counted, [*by, "month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # one row per calendar month of a group's span, so each ordered window is small
    before = F.lag("n").over(Window.partitionBy(*by).orderBy("month"))
    return filled.withColumn("before", before).select(
        *by, F.date_format("month", "yyyy-MM").alias("month"), "n", F.when(F.col("before") > 0, (F.col("n") - F.col("before")) / F.col("before")).alias("change")
    )


def top_swings(series: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    return series.where("change is not null").orderBy(F.desc(F.abs("change")), F.asc("month"), *by).limit(k)


def long_tail(days: DataFrame, entity: str, thresholds: Sequence[int]) -> DataFrame:
    """Entities with more rows than each threshold and their share of all rows."""
    per = days.groupBy(entity).agg(F.count(F.lit(1)).alias("d"))
    totals = per.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("d").alias("all"),
        *[F.count_if(F.col("d") > t).alias(f"n{t}") for t in thresholds],
        *[F.sum(F.when(F.col("d") > t, F.col("d")).otherwise(0)).alias(f"d{t}") for t in thresholds],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"),
                F.col(f"n{t}").alias("n_entities"),
                F.col(f"d{t}").alias("n_days"),
                (F.col(f"n{t}") / F.col("n")).alias("entity_share"),
                (F.col(f"d{t}") / F.col("all")).alias("day_share"),
            )
            for t in thresholds
        ]
    )
    return totals.select(F.explode(rows).alias("_r")).select("_r.*")


def day_span(days: DataFrame, by: Sequence[str], day: str, limit: int = 200) -> DataFrame:
    """Calendar span per entity and the long-span flag."""
    return days.groupBy(*by).agg((F.datediff(F.max(day), F.min(day)) + 1).alias("span_days")).withColumn(
        "long_span", F.col("span_days") > F.lit(limit)
    )


def null_causes(df: DataFrame, by: Sequence[str], value: str, causes: Mapping[str, Column]) -> DataFrame:
    """Why a derived value is NULL, the first cause that holds."""
    cause = F.when(F.col(value).isNotNull(), F.lit("present"))
    for label, rule in causes.items():
        cause = cause.when(rule, F.lit(label))
    return df.groupBy(*by, cause.otherwise(F.lit("other")).alias("cause")).agg(F.count(F.lit(1)).alias("n"))


def table_one(entities: DataFrame, group: str, continuous: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Descriptive table in long form, overall and by a BOOLEAN group.

    Rows: ``variable, level, grp`` with ``n, median, q1, q3`` for continuous and ``n, pct`` for
    categorical variables.
    """
    tags = F.array(F.lit("overall"), F.when(F.col(group), F.lit("yes")).otherwise(F.lit("no")))
    long = entities.withColumn("grp", F.explode(tags))
    sizes = long.groupBy("grp").agg(F.count(F.lit(1)).alias("_size"))
    out = None
    if continuous:
        pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("v")) for c in continuous])
        stacked = long.select("grp", F.explode(pairs).alias("_p")).select("grp", "_p.*")
        q = exact_quantiles(stacked, ["variable", "grp"], "v", {"q1": 0.25, "median": 0.5, "q3": 0.75})
        out = q.select("variable", F.lit("").alias("level"), "grp", "n", F.lit(None).cast("double").alias("pct"), "median", "q1", "q3")
    if categorical:
        level = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("Unknown"))
        pairs = F.array(*[F.struct(F.lit(c).alias("variable"), level(c).alias("level")) for c in categorical])
        counts = long.select("grp", F.explode(pairs).alias("_p")).select("grp", "_p.*").groupBy("variable", "level", "grp").agg(F.count(F.lit(1)).alias("n"))
        none = F.lit(None).cast("double")
        cats = counts.join(F.broadcast(sizes), "grp").select(
            "variable", "level", "grp", "n", (F.col("n") * 100.0 / F.col("_size")).alias("pct"), none.alias("median"), none.alias("q1"), none.alias("q3")
        )
        out = cats if out is None else out.unionByName(cats)
    return out


def contingency_test(df: DataFrame, group: str, column: str) -> DataFrame:
    """Chi-square test of a BOOLEAN group against a categorical column.

    A 2 x 2 table gets the continuity correction.
    """
    level = F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit("Unknown"))
    cells = df.groupBy(level.alias("level")).agg(F.count_if(F.col(group)).alias("a"), F.count_if(~F.col(group)).alias("b"))
    totals = cells.agg(F.sum("a").cast("double").alias("ta"), F.sum("b").cast("double").alias("tb"), F.count(F.lit(1)).alias("levels"))
    joined = cells.crossJoin(F.broadcast(totals))
    t = F.col("ta") + F.col("tb")
    row = (F.col("a") + F.col("b")).cast("double")

    def part(seen: str, column_total: str) -> Column:
        expect = row * F.col(column_total) / t
        gap = F.abs(F.col(seen) - expect)
        shrunk = F.when(F.col("levels") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return shrunk * shrunk / expect

    stat = joined.agg(
        F.sum(part("a", "ta") + part("b", "tb")).alias("chi2"), F.first("levels").alias("levels"), F.first("ta").alias("ta"), F.first("tb").alias("tb")
    )
    usable = (F.col("levels") > 1) & (F.col("ta") > 0) & (F.col("tb") > 0)
    dof = F.col("levels") - 1
    tested = stat.select(F.when(usable, F.col("chi2")).alias("chi2"), dof.alias("dof"))
    return tested.withColumn("p", p_value(F.col("chi2"), F.col("dof")))
