"""Severe respiratory failure per patient-day (M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuqm.config import SETTING_RANGES, Severity
from icuqm.functions.clinical import null_outside, within
from icuqm.functions.time import local_day, micros
from icuqm.operators.intervals import carry_forward
from icuqm.plans.common import Tables

KEY = ("hospitalization_id", "day")


def oxygen_events(t: Tables, cfg: Severity) -> DataFrame:
    """Arterial oxygen at its result time and saturation up to the cap."""
    labs, vit = t["labs"], t["vitals"]
    gas = labs.where(F.col("lab_category") == "po2_arterial").select(
        "hospitalization_id", micros(labs, "lab_result_dttm").alias("at"), F.col("lab_value_numeric").alias("value"), F.lit("pao2").alias("source")
    )
    sat = vit.where(F.col("vital_category") == "spo2").select(
        "hospitalization_id", micros(vit, "recorded_dttm").alias("at"), F.col("vital_value").alias("value"), F.lit("spo2").alias("source")
    )
    gas = gas.where(within(F.col("value"), cfg.pao2_range))
    sat = sat.where(within(F.col("value"), cfg.spo2_range) & (F.col("value") <= F.lit(cfg.spo2_max)))
    return gas.unionByName(sat).where("at is not null")


def classify_days(t: Tables, days: DataFrame, cfg: Severity) -> DataFrame:
    """``severe``, ``not_severe`` or ``unknown`` with the worst ratios and their source.

    Oxygen fraction and pressure are carried to the events for at most the lookback, both in one pass
    along the stay.
    """
    who = days.select("hospitalization_id").distinct()
    rs = t["respiratory_support"]
    settings = rs.select(
        "hospitalization_id",
        micros(rs, "recorded_dttm").alias("at"),
        null_outside(F.col("fio2_set"), SETTING_RANGES["fio2_set"]).alias("fio2"),
        F.coalesce(
            null_outside(F.col("peep_obs"), SETTING_RANGES["peep_obs"]), null_outside(F.col("peep_set"), SETTING_RANGES["peep_set"])
        ).alias("peep"),
        F.lit(0).alias("side"),
    ).where("fio2 is not null or peep is not null")
    events = oxygen_events(t, cfg).withColumn("side", F.lit(1))
    line = settings.unionByName(events, allowMissingColumns=True).join(who, "hospitalization_id", "left_semi")
    carries = {"fio2_near": (F.col("fio2"), cfg.lookback), "peep_near": (F.col("peep"), cfg.lookback)}
    paired = carry_forward(line, ["hospitalization_id"], "at", carries, ["side", "fio2", "peep", "source", "value"]).where(
        "side = 1 and fio2_near is not null and peep_near is not null"
    )
    ratio = F.col("value") / F.col("fio2_near")
    is_gas = F.col("source") == "pao2"
    bad = F.when(is_gas, ratio < F.lit(cfg.pf_below)).otherwise(ratio < F.lit(cfg.sf_below)) & (F.col("peep_near") > F.lit(cfg.peep_above))
    per_day = paired.groupBy("hospitalization_id", local_day(F.col("at")).alias("day")).agg(
        F.bool_or(bad).alias("severe"),
        F.min(F.when(is_gas, ratio)).alias("worst_pf"),
        F.min(F.when(~is_gas, ratio)).alias("worst_sf"),
        F.bool_or(is_gas).alias("has_gas"),
    )
    out = days.select(*KEY).join(per_day, list(KEY), "left")
    return out.select(
        *KEY,
        F.when(F.col("severe"), F.lit("severe")).when(F.col("severe").isNotNull(), F.lit("not_severe")).otherwise(F.lit("unknown")).alias("severity"),
        "worst_pf",
        "worst_sf",
        F.when(F.col("has_gas"), F.lit("pao2")).when(F.col("has_gas").isNotNull(), F.lit("spo2")).otherwise(F.lit("none")).alias("class_source"),
    )
