"""Intensive-care tables derived from the star tables, in Spark and in SQL.

Every event becomes charted rows: ventilator settings, vitals, gases, infusions, positions and unit
stays, by rules on its type and value. Users are patients; a user's events of a third of a month form
one hospital stay. The measures run on these tables as they would on a site's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuqm.catalog.base import HOUR, Tables
from icuqm.functions.time import MINUTE, instant
from icuqm.session import shared_root
from icuqm.sources.stages import StageGraph

# 11 and 21 January 2024, midnight UTC
FIRST, SECOND = 1_704_931_200_000_000, 1_705_795_200_000_000
OFFSETS = (0, 50, 100, 240)
#: The tables that are derived from events alone.
ON_EVENTS = ("adt", "respiratory_support", "vitals", "labs", "medication_admin_continuous", "position")


def stored(t: Tables, refresh: tuple[str, ...] = ()) -> tuple[dict[str, DataFrame], StageGraph]:
    """The derived tables and the graph that stores what the measures build from them."""
    graph = StageGraph(t.spark, f"{shared_root(t.spark).rstrip('/')}/stages", refresh)
    for name in ("events", "customer"):
        graph.source(name, f"{t.folder}/{name}.parquet")
    # a row group is read by one task, whatever its size, and an event becomes several rows of several tables there
    spread = graph.keep("stay_events", lambda: stay_events(t).drop("event_id").repartition("hid"), ("events",))
    tables = icu_tables(t, spread)
    for name in tables:
        graph.derived(name, ("stay_events",) if name in ON_EVENTS else ("stay_events", "customer"))
    return tables, graph


def stay_events(t: Tables) -> DataFrame:
    part = F.when(F.col("us") < F.lit(FIRST), "a").when(F.col("us") < F.lit(SECOND), "b").otherwise("c")
    return t.line.withColumn("hid", F.concat(F.col("user_id").cast("string"), F.lit("-"), part))


def icu_tables(t: Tables, events: DataFrame | None = None) -> dict[str, DataFrame]:
    ev = stay_events(t) if events is None else events
    kind, v = F.col("event_type"), F.col("value")
    hid = F.col("hid").alias("hospitalization_id")
    none = F.lit(None).cast("double")
    # users without a customer row are dropped, as people without a record would be
    seg = t.customer.select(F.col("c_custkey").alias("user_id"), "c_acctbal", "c_mktsegment")
    ends = ev.groupBy("user_id", "hid").agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
    last = ends.groupBy("user_id").agg(F.max("hi").alias("last"))
    segment = F.col("c_mktsegment")
    sex = F.when(segment.isin("BUILDING", "AUTOMOBILE"), "male").when(segment != "HOUSEHOLD", "female")
    patient = seg.join(last, "user_id").select(
        F.col("user_id").cast("string").alias("patient_id"),
        F.date_sub(F.lit("2007-01-01").cast("date"), F.floor("c_acctbal").cast("int")).cast("timestamp").alias("birth_date"),
        sex.alias("sex_category"),
        F.lower(segment).alias("race_category"),
        F.lit(None).cast("string").alias("ethnicity_category"),
        F.when(segment == "MACHINERY", instant(F.col("last") + F.lit(30 * MINUTE))).alias("death_dttm"),
    )
    hospitalization = ends.join(seg, "user_id").select(
        hid,
        F.col("user_id").cast("string").alias("patient_id"),
        instant(F.col("lo") - F.lit(HOUR)).alias("admission_dttm"),
        instant(F.col("hi") + F.lit(HOUR)).alias("discharge_dttm"),
        (F.lit(15.0) + (F.col("c_acctbal") + 1000) / 200).alias("age_at_admission"),
        F.lower(segment).alias("admission_type_category"),
        F.when(segment == "MACHINERY", "expired").otherwise("home").alias("discharge_category"),
    )
    unit = F.when(v < 15, "medical_icu").when(v < 35, "surgical_icu").when(v < 50, "general_icu")
    name = F.when(v < 7, "M1").when(v < 15, "M2").when(v < 25, "S1").when(v < 35, "S2").when(v < 50, "G1")
    moved = ev.where(kind == "signup").select(
        hid,
        F.when(v < 60, "icu").otherwise("ward").alias("location_category"),
        unit.alias("location_type"),
        name.alias("location_name"),
        instant(F.col("us")).alias("in_dttm"),
        F.when(v <= 55, instant(F.col("us") + F.lit(30 * HOUR))).alias("out_dttm"),
    )
    first = ends.select(
        hid,
        F.lit("icu").alias("location_category"),
        F.lit("burn_icu").alias("location_type"),
        F.lit("B1").alias("location_name"),
        instant(F.col("lo") - F.lit(HOUR)).alias("in_dttm"),
        instant(F.col("lo") + F.lit(40 * HOUR)).alias("out_dttm"),
    )
    charted = ev.where(kind.isin("view", "click", "purchase")).withColumn("off", F.explode(F.array(*[F.lit(o) for o in OFFSETS])))
    off = F.col("off").cast("bigint")
    full = off.isin(0, 100)
    respiratory = charted.select(
        hid,
        instant(F.col("us") + off * F.lit(MINUTE)).alias("recorded_dttm"),
        F.when(v < 90, "imv").when(v < 120, "cpap").otherwise("nasal cannula").alias("device_category"),
        F.when(full & (kind == "purchase"), "assist control-volume control").when(full & (kind == "view"), "pressure support/cpap").alias("mode_category"),
        (v > 160).alias("tracheostomy"),
        F.when(off == 100, v * 4 + 280).alias("tidal_volume_obs"),
        F.when(off == 0, v * 4 + 300).alias("tidal_volume_set"),
        F.when(off == 50, v / 3 + 10).alias("plateau_pressure_obs"),
        F.when(off == 50, v / 9).alias("peep_obs"),
        F.when(off == 0, v / 8).alias("peep_set"),
        F.when(off == 0, v / 300 + 0.3).alias("fio2_set"),
        F.when(full & (kind == "view") & (v < 30), F.lit(8.0)).otherwise(none).alias("pressure_support_set"),
    )
    at = lambda minutes: instant(F.col("us") + F.lit(minutes * MINUTE))
    vital = lambda rows, code, minutes, value: rows.select(
        hid, F.lit(code).alias("vital_category"), at(minutes).alias("recorded_dttm"), value.alias("vital_value")
    )
    vitals = (
        vital(ev.where(kind == "error"), "spo2", 20, v / 10 + 85)
        .unionByName(vital(ev.where(kind == "purchase"), "spo2", 55, v / 10 + 88))
        .unionByName(vital(ev.where(kind == "signup"), "height_cm", 0, v / 4 + 150))
        .unionByName(vital(ev.where(kind == "signup"), "weight_kg", 0, v / 2 + 50))
    )
    labs = ev.where(kind == "view").select(
        hid,
        F.lit("po2_arterial").alias("lab_category"),
        at(10).alias("lab_collect_dttm"),
        at(40).alias("lab_result_dttm"),
        (v * 1.5 + 40).alias("lab_value_numeric"),
    )
    # a second gas at the same time, with another value
    labs = labs.unionByName(labs.where("lab_value_numeric < 100").withColumn("lab_value_numeric", F.col("lab_value_numeric") + 30))
    drug = (
        F.when(kind == "view", "propofol")
        .when(kind == "click", "fentanyl")
        .when(kind == "purchase", "norepinephrine")
        .when(kind == "signup", "dexmedetomidine")
        .when((v > 60) | v.between(7, 8), "cisatracurium")
        .otherwise("midazolam")
    )
    meds = ev.select(
        hid,
        at(0).alias("admin_dttm"),
        drug.alias("med_category"),
        F.when(v < 5, 0.0).otherwise(v / 10).alias("med_dose"),
        F.when(kind == "view", "mcg/kg/min").otherwise("mcg/min").alias("med_dose_unit"),
        F.when(v.between(5, 7), "stop").when(~v.between(7, 9), "start").alias("mar_action_category"),
    )
    position = ev.where(kind == "click").select(
        hid, at(0).alias("recorded_dttm"), F.when(v < 20, "prone").when(v < 60, "not_prone").otherwise("chair").alias("position_category")
    )
    return {
        "patient": patient,
        "hospitalization": hospitalization,
        "adt": moved.unionByName(first),
        "respiratory_support": respiratory,
        "vitals": vitals,
        "labs": labs,
        "medication_admin_continuous": meds,
        "position": position,
    }


SQL = f"""
ev AS (SELECT event_id, user_id, user_id::VARCHAR || '-' || CASE WHEN us < {FIRST} THEN 'a' WHEN us < {SECOND} THEN 'b' ELSE 'c' END AS hid, us, event_type, value
   FROM (SELECT *, epoch_us(ts) AS us FROM events)),
ends AS (SELECT user_id, hid, min(us) AS lo, max(us) AS hi FROM ev GROUP BY user_id, hid),
pat AS (SELECT user_id::VARCHAR AS pid, epoch_us((DATE '2007-01-01' - CAST(floor(c_acctbal) AS INT))::TIMESTAMP) AS birth_us,
   CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'male' WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'female' END AS sex,
   CASE WHEN c_mktsegment = 'MACHINERY' THEN last + {30 * MINUTE} END AS death_us
   FROM customer JOIN (SELECT user_id, max(hi) AS last FROM ends GROUP BY user_id) ON user_id = c_custkey),
hosp AS (SELECT hid, user_id::VARCHAR AS pid, lo - {HOUR} AS adm, hi + {HOUR} AS dis, 15.0 + (c_acctbal + 1000) / 200 AS age,
   CASE WHEN c_mktsegment = 'MACHINERY' THEN 'expired' ELSE 'home' END AS discharge FROM ends JOIN customer ON user_id = c_custkey),
adt AS (SELECT hid, CASE WHEN value < 60 THEN 'icu' ELSE 'ward' END AS cat,
   CASE WHEN value < 15 THEN 'medical_icu' WHEN value < 35 THEN 'surgical_icu' WHEN value < 50 THEN 'general_icu' END AS unit,
   CASE WHEN value < 7 THEN 'M1' WHEN value < 15 THEN 'M2' WHEN value < 25 THEN 'S1' WHEN value < 35 THEN 'S2' WHEN value < 50 THEN 'G1' END AS unit_name,
   us AS i, CASE WHEN value <= 55 THEN us + {30 * HOUR} END AS o FROM ev WHERE event_type = 'signup'
   UNION ALL SELECT hid, 'icu', 'burn_icu', 'B1', lo - {HOUR}, lo + {40 * HOUR} FROM ends),
rs AS (SELECT hid, us + f::BIGINT * {MINUTE} AS t, CASE WHEN value < 90 THEN 'imv' WHEN value < 120 THEN 'cpap' ELSE 'nasal cannula' END AS dev,
   CASE WHEN f IN (0, 100) AND event_type = 'purchase' THEN 'assist control-volume control' WHEN f IN (0, 100) AND event_type = 'view' THEN 'pressure support/cpap' END AS mode,
   value > 160 AS trach, CASE WHEN f = 100 THEN value * 4 + 280 END AS vt_obs, CASE WHEN f = 0 THEN value * 4 + 300 END AS vt_set,
   CASE WHEN f = 50 THEN value / 3 + 10 END AS plat, CASE WHEN f = 50 THEN value / 9 END AS peep_obs, CASE WHEN f = 0 THEN value / 8 END AS peep_set,
   CASE WHEN f = 0 THEN value / 300 + 0.3::DOUBLE END AS fio2, CASE WHEN f IN (0, 100) AND event_type = 'view' AND value < 30 THEN 8.0::DOUBLE END AS ps
   FROM ev, (SELECT unnest([{", ".join(map(str, OFFSETS))}]) AS f) WHERE event_type IN ('view', 'click', 'purchase')),
vit AS (SELECT hid, 'spo2' AS cat, us + {20 * MINUTE} AS t, value / 10 + 85 AS v FROM ev WHERE event_type = 'error'
   UNION ALL SELECT hid, 'spo2', us + {55 * MINUTE}, value / 10 + 88 FROM ev WHERE event_type = 'purchase'
   UNION ALL SELECT hid, 'height_cm', us, value / 4 + 150 FROM ev WHERE event_type = 'signup'
   UNION ALL SELECT hid, 'weight_kg', us, value / 2 + 50 FROM ev WHERE event_type = 'signup'),
lab0 AS (SELECT hid, us + {10 * MINUTE} AS col_t, us + {40 * MINUTE} AS res_t, value * 1.5 + 40 AS v FROM ev WHERE event_type = 'view'),
lab AS (SELECT * FROM lab0 UNION ALL SELECT hid, col_t, res_t, v + 30 FROM lab0 WHERE v < 100),
med AS (SELECT hid, us AS t, CASE event_type WHEN 'view' THEN 'propofol' WHEN 'click' THEN 'fentanyl' WHEN 'purchase' THEN 'norepinephrine' WHEN 'signup' THEN 'dexmedetomidine'
   ELSE CASE WHEN value > 60 OR value BETWEEN 7 AND 8 THEN 'cisatracurium' ELSE 'midazolam' END END AS drug, CASE WHEN value < 5 THEN 0 ELSE value / 10 END AS dose,
   CASE WHEN event_type = 'view' THEN 'mcg/kg/min' ELSE 'mcg/min' END AS unit,
   CASE WHEN value BETWEEN 5 AND 7 THEN 'stop' WHEN value NOT BETWEEN 7 AND 9 THEN 'start' END AS act FROM ev),
pos AS (SELECT hid, us AS t, CASE WHEN value < 20 THEN 'prone' WHEN value < 60 THEN 'not_prone' ELSE 'chair' END AS p FROM ev WHERE event_type = 'click')
"""
