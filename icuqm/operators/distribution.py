"""Histograms, buckets, exact quantiles and ranks.

Exact quantiles are selected by refinement. Equal values are counted first. While a group has more
distinct values than one task should order, they are cut into ranges by an approximate sketch, which only
decides where to cut, the ranges are counted, and only those that hold a wanted rank are kept. What remains
is ordered. Nothing is approximated and no great group is ordered in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuqm.session import cut_lineage

#: Distinct values that one task orders, and ranges of one cut.
ORDERED = 200_000
MOST_RANGES = 1000


def _counted(df: DataFrame, keys: Sequence[str], value: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct values per group with their count ``n``."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in (extra or {}).items()])


def _ranges(counted: DataFrame, keys: Sequence[str], ordered: int) -> int:
    """Ranges that the largest group needs, so that one holds some ``ordered`` distinct values."""
    most = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("d")).agg(F.max("d")).first()[0] or 0
    return min(MOST_RANGES, -(-most // ordered))


def _cut(counted: DataFrame, keys: Sequence[str], value: str, ranges: int) -> DataFrame:
    """``counted`` with the number ``_range`` of the range that holds the value."""
    probs = [i / ranges for i in range(1, ranges)]
    cuts = counted.groupBy(*keys).agg(F.percentile_approx(value, probs, max(1000, 4 * ranges)).alias("_cuts"))
    passed = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    return counted.join(cuts, list(keys)).withColumn("_range", passed).drop("_cuts")


def _range_sums(ranged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group and range: rows in it, below it and in the group."""
    span = Window.partitionBy(*keys).orderBy("_range")
    return ranged.groupBy(*keys, "_range").agg(F.sum("n").alias("_in")).select(
        *keys,
        "_range",
        "_in",
        F.coalesce(F.sum("_in").over(span.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_in").over(Window.partitionBy(*keys)).alias("total"),
    )


def _below(keys: Sequence[str], value: str) -> Column:
    inner = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(inner), F.lit(0))


def value_ranks(df: DataFrame, by: Sequence[str], value: str, extra: Mapping[str, Column] | None = None, ordered: int | None = None) -> DataFrame:
    """Distinct values per group with count ``n``, rows below ``below`` and group size ``total``.

    ``extra`` adds further aggregates per (group, value).
    """
    keys = list(by) or ["_all"]
    counted = cut_lineage(_counted(df if by else df.withColumn("_all", F.lit(0)), keys, value, extra))
    ranges = _ranges(counted, keys, ordered or ORDERED)
    if ranges <= 1:
        return counted.withColumns({"below": _below(keys, value), "total": F.sum("n").over(Window.partitionBy(*keys))})
    ranged = _cut(counted, keys, value, ranges)
    sums = _range_sums(ranged, keys).drop("_in")
    placed = ranged.withColumn("_inner", _below([*keys, "_range"], value)).join(sums, [*keys, "_range"])
    return placed.withColumn("below", F.col("_before") + F.col("_inner")).drop("_range", "_inner", "_before")


def _at_rank(rank: Column, value: str) -> Column:
    """The value that holds the 0-based rank within its group."""
    return F.max(F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col("n")), F.col(value)))


def select_ranks(df: DataFrame, by: Sequence[str], value: str, ranks: Mapping[str, Callable[[Column], Column]], ordered: int | None = None) -> DataFrame:
    """Per group its size ``n`` and the values at some 0-based ranks, which are functions of the size."""
    keys, ordered = list(by) or ["_all"], ordered or ORDERED
    counted = cut_lineage(_counted(df if by else df.withColumn("_all", F.lit(0)), keys, value))
    ranges = _ranges(counted, keys, ordered)
    if ranges <= 1:
        total = F.col("total")
        placed = counted.withColumns({"below": _below(keys, value), "total": F.sum("n").over(Window.partitionBy(*keys))})
        return placed.groupBy(*keys).agg(F.max("total").alias("n"), *[_at_rank(rank(total), value).alias(name) for name, rank in ranks.items()]).select(*by, "n", *ranks)

    sizes = cut_lineage(counted.groupBy(*keys).agg(F.sum("n").alias("total")))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("total")).cast("bigint").alias("rank")) for name, rank in ranks.items()])
    targets = sizes.select(*keys, F.lit("").alias("_part"), F.inline(wanted))
    rows = counted.withColumn("_part", F.lit(""))
    parts = [*keys, "_part"]
    while ranges > 1:
        ranged = _cut(rows, parts, value, ranges)
        sums = _range_sums(ranged, parts).drop("total")
        deeper = F.concat("_part", F.lit("."), F.col("_range").cast("string"))
        hit = targets.join(sums, parts).where((F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_before") + F.col("_in")))
        targets = cut_lineage(hit.select(*keys, deeper.alias("_part"), "name", (F.col("rank") - F.col("_before")).alias("rank")))
        rows = ranged.withColumn("_part", deeper).join(targets.select(*parts).distinct(), parts, "left_semi")
        before, rows = ranges, cut_lineage(rows.drop("_range"))
        ranges = _ranges(rows, parts, ordered)
        if ranges >= before:
            # a sketch that cuts nothing off any more: order what is left
            break
    placed = rows.withColumn("below", _below(parts, value)).join(targets, parts)
    found = placed.groupBy(*keys).agg(*[F.max(F.when((F.col("name") == name) & (F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("n")), F.col(value))).alias(name) for name in ranks])
    return found.join(sizes, keys).select(*by, F.col("total").alias("n"), *ranks)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, quantiles: Mapping[str, float], ordered: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles per group, with the group size ``n``."""
    ranks = {}
    for name, q in quantiles.items():
        ranks[f"_lo_{name}"] = lambda total, q=q: F.floor(F.lit(float(q)) * (total - 1))
        ranks[f"_hi_{name}"] = lambda total, q=q: F.ceil(F.lit(float(q)) * (total - 1))
    found = select_ranks(df, by, value, ranks, ordered)
    out = []
    for name, q in quantiles.items():
        pos = F.lit(float(q)) * (F.col("n") - 1)
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        out.append((low + (high - low) * (pos - F.floor(pos))).alias(name))
    return found.select(*by, "n", *out)


def nearest_rank(df: DataFrame, by: Sequence[str], value: str, quantiles: Mapping[str, float], ordered: int | None = None) -> DataFrame:
    """Value at rank ``round(q * (n - 1))`` with halves rounded up."""
    ranks = {name: lambda total, q=q: F.floor(F.lit(float(q)) * (total - 1) + F.lit(0.5)) for name, q in quantiles.items()}
    return select_ranks(df, by, value, ranks, ordered)


def nested_median(df: DataFrame, inner: Sequence[str], outer: Sequence[str], value: str) -> DataFrame:
    """Median of the per-inner medians for each outer key."""
    per_inner = exact_quantiles(df, [*outer, *inner], value, {"_m": 0.5})
    return exact_quantiles(per_inner, outer, "_m", {"median": 0.5})


def bin_of(value: Column, lo: float, step: float) -> Column:
    """Index of the bin with edges ``lo + i * step``; a value on an edge belongs to the upper bin."""
    guess = F.floor((value - F.lit(lo)) / F.lit(step))
    low = F.lit(lo) + guess * F.lit(step)
    high = F.lit(lo) + (guess + 1) * F.lit(step)
    return (guess + F.when(value < low, F.lit(-1)).when(value >= high, F.lit(1)).otherwise(F.lit(0))).cast("int")


def weighted_hist(df: DataFrame, by: Sequence[str], value: str, weight: Column, lo: float, hi: float, step: float) -> DataFrame:
    """Weight per bin of ``[lo, hi)``; values outside are dropped, not clipped."""
    inside = (F.col(value) >= F.lit(lo)) & (F.col(value) < F.lit(hi))
    return df.where(inside).groupBy(*by, bin_of(F.col(value), lo, step).alias("bin")).agg(F.sum(weight).alias("weight"))


def clipped_hist(df: DataFrame, by: Sequence[str], value: str, bins: int, step: float) -> DataFrame:
    """Counts per bin from 0; larger values fall into the last bin."""
    index = F.greatest(F.lit(0), F.least(bin_of(F.col(value), 0.0, step), F.lit(bins - 1)))
    return df.where(F.col(value).isNotNull()).groupBy(*by, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def bucketed(df: DataFrame, by: Sequence[str], value: str, edges: Sequence[float]) -> DataFrame:
    """Counts between fixed ascending edges; the last bucket is open."""
    index = F.lit(len(edges) - 1)
    for i in range(len(edges) - 2, -1, -1):
        index = F.when(F.col(value) < F.lit(float(edges[i + 1])), F.lit(i)).otherwise(index)
    return df.where(F.col(value).isNotNull()).groupBy(*by, index.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def kruskal(df: DataFrame, value: str, group: str) -> DataFrame:
    """Tie-corrected Kruskal-Wallis statistic of two groups and its p-value.

    ``group`` is BOOLEAN. One row: ``h``, ``p``, ``n_true``, ``n_false``.
    """
    ranked = value_ranks(
        df.where(F.col(group).isNotNull()), [], value, {"n_true": F.count_if(F.col(group)), "n_false": F.count_if(~F.col(group))}
    )
    mid = (F.col("below") * 2 + F.col("n") + 1) / F.lit(2.0)
    sums = ranked.agg(
        F.sum(F.col("n_true") * mid).alias("r1"),
        F.sum(F.col("n_false") * mid).alias("r2"),
        F.sum("n_true").alias("n_true"),
        F.sum("n_false").alias("n_false"),
        F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("ties"),
        F.max("total").cast("double").alias("t"),
    )
    raw = F.lit(12.0) / (F.col("t") * (F.col("t") + 1)) * (
        F.col("r1") * F.col("r1") / F.col("n_true") + F.col("r2") * F.col("r2") / F.col("n_false")
    ) - F.lit(3.0) * (F.col("t") + 1)
    correction = F.lit(1.0) - F.col("ties") / (F.pow(F.col("t"), 3) - F.col("t"))
    usable = (F.col("n_true") > 0) & (F.col("n_false") > 0) & (correction > 0)
    out = sums.select(F.when(usable, raw / correction).alias("h"), "n_true", "n_false")
    return out.withColumn("p", p_value(F.col("h"), F.lit(1)))


def _sum_of_terms(first: Column, count: Column, ratio: Callable[[Column], Column]) -> Column:
    """``first`` and the ``count`` terms after it, each ``ratio(k)`` times the one before, added up."""
    steps = F.when(count >= 1, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    start = F.struct(first.cast("double").alias("term"), first.cast("double").alias("total"))

    def add(own: Column, k: Column) -> Column:
        term = own["term"] * ratio(k)
        return F.struct(term.alias("term"), (own["total"] + term).alias("total"))

    return F.aggregate(steps, start, add, lambda own: own["total"])


def erfc(z: Column) -> Column:
    """Complementary error function of a value from 0 on: a series below 2, a continued fraction from 2 on."""
    square = z * z
    series = _sum_of_terms(z, F.lit(60), lambda k: square * 2 / (k * 2 + 1)) * F.lit(2 / math.sqrt(math.pi)) * F.exp(-square)
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1)), z, lambda t, k: z + k / F.lit(2.0) / t)
    return F.when(z < 2, F.lit(1.0) - series).otherwise(F.exp(-square) / F.lit(math.sqrt(math.pi)) / fraction)


def p_value(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom: a finite sum, and ``erfc`` where they are odd."""
    x, k = F.greatest(statistic.cast("double"), F.lit(0.0)), dof.cast("int")
    half, decay = x / 2, F.exp(-x / 2)
    even = decay * _sum_of_terms(F.lit(1.0), k / 2 - 1, lambda j: half / j)
    first = F.sqrt(half) * F.lit(2 / math.sqrt(math.pi))
    odd = erfc(F.sqrt(half)) + F.when(k >= 3, decay * _sum_of_terms(first, (k - 3) / 2, lambda j: half / (j + F.lit(0.5)))).otherwise(F.lit(0.0))
    return F.when(statistic.isNotNull() & (k > 0), F.when(k % 2 == 0, even).otherwise(odd))
