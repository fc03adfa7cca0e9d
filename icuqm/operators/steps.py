"""Step functions: sums over series, sampling, dose units and dose ratios (T-SUM, T-SMP, T-UC, T-DOS)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.functions.time import DAY
from icuqm.operators.asof import asof_join
from icuqm.operators.ordered import Crowd, along, last_seen, next_seen


def sum_steps(
    segments: DataFrame,
    by: Sequence[str],
    series: str,
    values: Sequence[str],
    value: str,
    assessable: str | None = None,
    close_at_cap: bool = False,
    width: int = DAY,
    crowd: Crowd | None = None,
) -> DataFrame:
    """Sum, over the named series, of the value in force at each change time (T-SUM).

    ``segments`` has ``start`` and ``end``. A value counts while ``t < end``. ``close_at_cap`` also
    emits a row where a segment ends, so that the sum falls back when nothing follows.
    """
    by = list(by)
    known = F.lit(True) if assessable is None else F.coalesce(F.col(assessable), F.lit(True))
    state = F.struct(F.col("end"), F.coalesce(F.col(value), F.lit(0.0)).alias("v"), known.alias("ok"))
    own = [F.max(F.when(F.col(series) == name, state)).alias(f"_v{i}") for i, name in enumerate(values)]
    named = segments.where(F.col(series).isin(*values))
    wide = named.groupBy(*by, "start").agg(*own)
    if close_at_cap:
        ends = named.select(*by, F.col("end").alias("start")).distinct().join(wide.select(*by, "start"), [*by, "start"], "left_anti")
        wide = wide.unionByName(ends, allowMissingColumns=True)
    held = along(wide, by, "start", {f"_h{i}": last_seen(F.col(f"_v{i}")) for i in range(len(values))}, width=width, crowd=crowd)
    running = [F.col("start") < F.col(f"_h{i}.end") for i in range(len(values))]
    parts = [F.when(run, F.col(f"_h{i}.v")).otherwise(F.lit(0.0)) for i, run in enumerate(running)]
    fine = [~(F.coalesce(run, F.lit(False)) & ~F.col(f"_h{i}.ok")) for i, run in enumerate(running)]
    fine = [F.coalesce(ok, F.lit(True)) for ok in fine]
    return held.select(
        *by,
        F.col("start").alias("t"),
        reduce(lambda a, b: a + b, parts).alias("total"),
        reduce(lambda a, b: a & b, fine).alias("assessable"),
    )


def sample_steps(
    grid: DataFrame, steps: DataFrame, by: Sequence[str], grid_on: str, steps_on: str, defaults: Mapping[str, object], width: int = DAY
) -> DataFrame:
    """Value of a step function at each grid time; before its first step the default (T-SMP)."""
    found = asof_join(grid, steps, by, grid_on, steps_on, width=width)
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def normalise_dose(
    doses: DataFrame,
    weights: DataFrame,
    by: Sequence[str],
    on: str,
    weight_on: str,
    drug: str,
    dose: str,
    unit: str,
    stopped: Column,
    factors: Mapping[str, float],
    unit_scale: Mapping[str, tuple[float, bool]],
    not_per_kg: Sequence[str] = (),
    weight: str = "weight_kg",
    width: int = DAY,
    crowd: Crowd | None = None,
) -> DataFrame:
    """Equivalent dose per kg and whether it can be known (T-UC).

    ``unit_scale`` maps a charted unit to (factor to the base unit per minute, already per kg).
    Stopped or non-positive doses count 0. A running per-kg drug without a weight is un-assessable.
    """
    scale = F.create_map(*[x for k, (f, _) in unit_scale.items() for x in (F.lit(k), F.lit(float(f)))])
    per_kg = F.col(unit).isin(*[k for k, (_, flag) in unit_scale.items() if flag])
    factor = F.coalesce(F.create_map(*[x for k, v in factors.items() for x in (F.lit(k), F.lit(float(v)))])[F.col(drug)], F.lit(0.0))
    joined = asof_join(doses, weights.select(*by, F.col(weight_on).alias("_w_at"), weight), by, on, "_w_at", tiebreak=[weight], width=width, crowd=crowd)
    base = F.col(dose) * scale[F.col(unit)]
    whole = F.col(drug).isin(*not_per_kg) if not_per_kg else F.lit(False)
    direct = whole | per_kg
    stop = F.coalesce(stopped, F.lit(False))
    running = (F.coalesce(base, F.lit(0.0)) > 0) & ~stop
    amount = F.when(direct, base).otherwise(base / F.col(weight))
    return joined.withColumns(
        {
            "equivalent": F.when(running, factor * amount).otherwise(F.lit(0.0)),
            "assessable": ~(running & (factor > 0) & ~direct & F.col(weight).isNull()),
        }
    ).drop("_w_at")


def ratio_around_gap(
    gaps: DataFrame,
    segments: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    series: str,
    names: Sequence[str],
    value: str,
    window_end: str,
    width: int = DAY,
) -> DataFrame:
    """Value before a gap against the first value after it, per series (T-DOS).

    Before: the latest segment that started strictly before ``gap_start``. After: the first that
    started in ``[gap_end, window_end]``. ``segments`` holds active segments with ``start``.
    """
    by = list(by)
    tagged = F.struct(F.col("start").alias("at"), F.col(value).alias("v"))
    rows = segments.where(F.col(series).isin(*names)).select(
        *by, F.col("start").alias("_t"), F.lit(1).alias("_side"), F.col(series).alias("_series"), tagged.alias("_seg")
    )
    probe = gaps.select(*by, *key, window_end, F.explode(F.array("gap_start", "gap_end")).alias("_t"), "gap_start")
    probe = probe.withColumns({"_side": F.lit(0), "_pre": F.col("_t") == F.col("gap_start")})
    line = {}
    for i, name in enumerate(names):
        mine = F.when(F.col("_series") == name, F.col("_seg"))
        line[f"_b{i}"] = last_seen(mine)
        line[f"_a{i}"] = next_seen(mine)
    both = probe.unionByName(rows, allowMissingColumns=True)
    seen = along(both, by, "_t", line, ["_side", "_series", "_seg"], width).where("_side = 0")
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias(series),
                F.when(F.col("_pre"), F.col(f"_b{i}.v")).alias("pre"),
                F.when(~F.col("_pre") & (F.col(f"_a{i}.at") <= F.col(window_end)), F.col(f"_a{i}.v")).alias("post"),
            )
            for i, name in enumerate(names)
        ]
    )
    return (
        seen.select(*by, *key, F.explode(pairs).alias("_p"))
        .groupBy(*by, *key, F.col(f"_p.{series}").alias(series))
        .agg(F.max("_p.pre").alias("pre_rate"), F.max("_p.post").alias("post_rate"))
        .where("pre_rate > 0 and post_rate is not null")
        .withColumn("ratio", F.col("post_rate") / F.col("pre_rate"))
    )
