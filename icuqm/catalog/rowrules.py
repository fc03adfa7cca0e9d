"""Queries for the row-level rules: conforming, cleaning, classes and derived values."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuqm.config import UNIT_ORDER
from icuqm.catalog.base import Tables, query
from icuqm.functions import clinical
from icuqm.operators.distribution import exact_quantiles
from icuqm.sources.feeds import unit_rank
from icuqm.sources.tables import Field, conform


@query(
    "conformed_customers",
    """SELECT c_custkey::VARCHAR AS id, nullif(lower(trim(c_mktsegment)), '') AS segment, try_cast(replace(c_name, 'Customer#', '') AS DOUBLE) AS name_number, CAST(NULL AS DOUBLE) AS absent FROM customer""",
)
def conformed(t: Tables):
    rows = t.customer.withColumn("digits", F.replace("c_name", F.lit("Customer#"), F.lit("")))
    fields = [Field("id", "id", ("customer_id", "c_custkey")), Field("segment", "category", ("c_mktsegment",)), Field("name_number", "number", ("digits",)), Field("absent", "number", required=False)]
    return conform(rows, fields)


@query(
    "row_rules",
    """WITH r AS (SELECT event_id, event_type, value, CASE WHEN value BETWEEN 5 AND 200 THEN value END AS clean, 140 + value / 4 AS h FROM events)
SELECT event_id, clean, coalesce(clean, value / 2) AS first_known, coalesce(clean <= 30, false) AS passes, clean IS NOT NULL AS present,
  CASE WHEN clean IS NULL THEN 'unknown' WHEN clean < 20 THEN 'low' WHEN clean < 60 THEN 'mid' ELSE 'high' END AS band,
  round(CASE WHEN (CASE event_type WHEN 'view' THEN 50 WHEN 'click' THEN 45.5 END) + 2.3 * (h / 2.54 - 60) >= 55 THEN (CASE event_type WHEN 'view' THEN 50 WHEN 'click' THEN 45.5 END) + 2.3 * (h / 2.54 - 60) END, 6) AS weight,
  coalesce(event_type = 'error', false) AS died, CASE event_type WHEN 'view' THEN 'Viewed' ELSE event_type END AS shown FROM r""",
)
def row_rules(t: Tables):
    v, kind = F.col("value"), F.col("event_type")
    clean = clinical.null_outside(v, (5, 200))
    sex = F.when(kind == "view", "male").when(kind == "click", "female")
    c = F.col("clean")
    band = clinical.first_true({"unknown": c.isNull(), "low": c < 20, "mid": c < 60}, "high")
    rows = t.events.select("event_id", "event_type", "value", clean.alias("clean"))
    return rows.select(
        "event_id",
        "clean",
        F.coalesce("clean", v / 2).alias("first_known"),
        clinical.at_most(c, 30).alias("passes"),
        c.isNotNull().alias("present"),
        band.alias("band"),
        F.round(clinical.predicted_body_weight(v / 4 + 140, sex, 55.0), 6).alias("weight"),
        clinical.died(F.when(kind == "error", "Expired").otherwise(kind)).alias("died"),
        clinical.mapped(kind, {"view": "Viewed"}).alias("shown"),
    )


@query(
    "percent_detection",
    """WITH p AS (SELECT quantile_cont(l_discount * 100, 0.95) AS p95 FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(sum(CASE WHEN p95 > 1.5 THEN l_discount * 100 / 100 ELSE l_discount * 100 END), 4) AS total FROM lineitem, p GROUP BY l_returnflag""",
)
def percent(t: Tables):
    rows = t.lineitem.select("l_returnflag", (F.col("l_discount") * 100).alias("x"))
    p95 = exact_quantiles(rows.select("x"), [], "x", {"p95": 0.95}).select("p95")
    joined = rows.join(F.broadcast(p95), how="left")
    scaled = F.when(F.col("p95") > 1.5, F.col("x") / 100).otherwise(F.col("x"))
    return joined.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(scaled), 4).alias("total"))


@query(
    "keyword_buckets",
    """WITH drug AS (SELECT CASE p_partkey % 7 WHEN 0 THEN 'Rocuronium inj' WHEN 1 THEN 'PRECEDEX drip' WHEN 2 THEN 'propofol 1%' WHEN 3 THEN 'Fentanyl/morphine'
   WHEN 4 THEN 'cisatracurium+midazolam' WHEN 5 THEN NULL ELSE 'saline' END AS txt FROM part)
SELECT CASE WHEN txt ILIKE '%curonium%' OR txt ILIKE '%atracurium%' THEN 'paralytic' WHEN txt ILIKE '%precedex%' THEN 'dexmedetomidine'
   WHEN txt ILIKE '%propofol%' OR txt ILIKE '%fentanyl%' OR txt ILIKE '%midazolam%' THEN 'sat_relevant' ELSE 'other' END AS bucket, count(*) AS n FROM drug GROUP BY 1""",
)
def keywords(t: Tables):
    texts = ["Rocuronium inj", "PRECEDEX drip", "propofol 1%", "Fentanyl/morphine", "cisatracurium+midazolam", None, "saline"]
    text = F.get(F.array(*[F.lit(x) for x in texts]), (F.col("p_partkey") % 7).cast("int"))
    return t.part.groupBy(clinical.drug_bucket(text).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "canonical_order",
    """WITH u AS (SELECT CASE c_custkey % 7 WHEN 0 THEN 'burn_icu' WHEN 1 THEN 'general_icu' WHEN 2 THEN 'medical_icu' WHEN 3 THEN 'mixed_cardiothoracic_icu'
   WHEN 4 THEN 'mixed_neuro_icu' WHEN 5 THEN 'surgical_icu' ELSE c_mktsegment END AS unit FROM customer)
SELECT unit, CASE unit WHEN 'medical_icu' THEN 0 WHEN 'mixed_cardiothoracic_icu' THEN 1 WHEN 'surgical_icu' THEN 2 WHEN 'mixed_neuro_icu' THEN 3
   WHEN 'general_icu' THEN 4 WHEN 'burn_icu' THEN 5 ELSE 99 END AS rank, count(*) AS n FROM u GROUP BY unit""",
)
def ordered_units(t: Tables):
    slugs = F.array(*[F.lit(u) for u in sorted(UNIT_ORDER)])
    unit = F.coalesce(F.get(slugs, (F.col("c_custkey") % 7).cast("int")), "c_mktsegment")
    out = t.customer.groupBy(unit.alias("unit")).agg(F.count(F.lit(1)).alias("n")).withColumn("rank", unit_rank(F.col("unit")))
    return out.orderBy("rank", F.desc("n"), "unit").select("unit", "rank", "n")
