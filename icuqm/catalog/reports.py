"""Summaries, durations and toggles of the measures, with independent SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuqm.catalog.base import HOUR, Tables, query
from icuqm.catalog.measures import (
    _PRONE_SQL,
    _SAT_SQL,
    _SBT_SQL,
    _SESSIONS,
    _SLICES,
    _SUP,
    CFG,
    PRONE,
    proning_stages,
    sat_stages,
    sbt_stages,
)
from icuqm.operators import checks, masks
from icuqm.plans import proning, sat, sbt
from icuqm.session import cut_lineage

SLICE = ["unit", "dim", "granularity", "period"]


def _rows(pairs: list[tuple[str, str, str]]) -> str:
    """Summary rows from a one-row table ``tot``: metric, numerator, denominator."""
    lines = [f"SELECT '{m}' AS metric, {n}::BIGINT AS numerator, {d}::BIGINT AS denominator, round(CASE WHEN {d} > 0 THEN {n} / {d} END, 6) AS rate FROM tot" for m, n, d in pairs]
    return " UNION ALL ".join(lines)


def _plain(summary):
    return summary.select("metric", "numerator", "denominator", F.round("rate", 6).alias("rate"))


@query(
    "sat_summary",
    _SAT_SQL
    + """, tot AS (SELECT count(*) AS v, count(*) FILTER (WHERE eligible) AS e, count(*) FILTER (WHERE eligible AND performed) AS s,
   count(*) FILTER (WHERE eligible AND performed AND resumed) AS r, count(*) FILTER (WHERE eligible AND performed AND NOT resumed) AS nr, count(*) FILTER (WHERE eligible AND performed AND extubated) AS x,
   count(DISTINCT CASE WHEN eligible THEN pid END) AS pe, count(DISTINCT CASE WHEN eligible AND performed THEN pid END) AS ps FROM ob JOIN pid1 USING (b)) """
    + _rows([
        ("vent_icu_days", "v", "v"), ("eligible_days", "e", "v"), ("sat_performed", "s", "e"), ("sat_of_vent", "s", "v"), ("sat_resumed", "r", "e"),
        ("sat_outcome_resumed", "r", "s"), ("sat_outcome_notresumed", "nr", "s"), ("sat_outcome_extubated", "x", "s"), ("patients_eligible", "pe", "pe"), ("patients_ever_sat", "ps", "pe"),
    ]),
)
def sat_summary(t: Tables):
    return _plain(sat.summary(sat_stages(t)["observation"]))


@query(
    "sat_durations",
    _SAT_SQL + "SELECT unit, month, week, round((g1 - g0) / 60000000.0, 6) AS off_min, hq.resumed FROM hq JOIN ob USING (b, d)",
)
def sat_durations(t: Tables):
    own = sat_stages(t)
    return sat.durations(own["days"], own["holds"]).withColumn("off_min", F.round("off_min", 6))


@query(
    "sbt_summary",
    _SBT_SQL
    + """, fx AS (SELECT *, status = 'eligible' AS el FROM ob), tot AS (SELECT count(*) AS v, count(*) FILTER (WHERE status <> 'excluded_trach') AS nt, count(*) FILTER (WHERE el) AS e,
   count(*) FILTER (WHERE el AND NOT (spont AND NOT nb_t)) AS tx, count(*) FILTER (WHERE status = 'not_assessable') AS na, count(*) FILTER (WHERE reason = 'lt12h_controlled') AS r1,
   count(*) FILTER (WHERE reason = 'failed_vasopressor') AS r2, count(*) FILTER (WHERE reason = 'failed_oxy_peep') AS r3, count(*) FILTER (WHERE status = 'excluded_paralytic') AS pa,
   count(*) FILTER (WHERE el AND nb_tdp) AS s, count(*) FILTER (WHERE nb_tdp) AS sa, count(*) FILTER (WHERE nb_tp) AS aa, count(*) FILTER (WHERE el AND nb_tp) AS ae,
   count(*) FILTER (WHERE spont) AS oa, count(*) FILTER (WHERE el AND spont) AS oe, count(DISTINCT pid) AS p, count(DISTINCT CASE WHEN el THEN pid END) AS pe,
   count(DISTINCT CASE WHEN el AND nb_tdp THEN pid END) AS ps, count(DISTINCT CASE WHEN nb_tp THEN pid END) AS pany, count(DISTINCT CASE WHEN spont THEN pid END) AS po FROM fx) """
    + _rows([
        ("vent_icu_days", "v", "v"), ("nontrach_days", "nt", "v"), ("eligible_days", "e", "nt"), ("eligible_txcand_days", "tx", "nt"), ("not_assessable_days", "na", "nt"),
        ("notelig_lt12h_days", "r1", "nt"), ("notelig_vaso_days", "r2", "nt"), ("notelig_oxypeep_days", "r3", "nt"), ("excluded_paralytic_days", "pa", "nt"), ("sbt_delivered", "s", "tx"),
        ("sbt_delivered_legacy", "s", "e"), ("sbt_strict_all", "sa", "v"), ("sbt_any_all", "aa", "v"), ("sbt_any_elig", "ae", "e"), ("on_spont_all", "oa", "v"), ("on_spont_elig", "oe", "e"),
        ("patients_cohort", "p", "p"), ("patients_eligible", "pe", "p"), ("patients_ever_sbt", "ps", "pe"), ("patients_ever_sbt_any", "pany", "p"), ("patients_ever_spont", "po", "p"),
    ]),
)
def sbt_summary(t: Tables):
    return _plain(sbt.summary(sbt_stages(t)["observation"]))


@query(
    "sbt_toggles",
    _SBT_SQL
    + ", "
    + _SLICES
    + """SELECT 'all' AS rules, unit, dim, granularity, period, count(*) AS n_days, count(*) FILTER (WHERE NOT trach AND NOT par AND prior >= 12 AND stable AND NOT (spont AND NOT nb_t)) AS den,
   count(*) FILTER (WHERE NOT trach AND NOT par AND prior >= 12 AND stable AND NOT (spont AND NOT nb_t) AND nb_tdp) AS num FROM sl GROUP BY unit, dim, granularity, period
UNION ALL SELECT 'oxygen and length', unit, dim, granularity, period, count(*), count(*) FILTER (WHERE NOT trach AND prior >= 12 AND oxy), count(*) FILTER (WHERE NOT trach AND prior >= 12 AND oxy AND nb_d) FROM sl GROUP BY unit, dim, granularity, period""",
)
def sbt_toggles(t: Tables):
    hist = cut_lineage(sbt.mask_table(sbt_stages(t)["observation"]))
    full = sbt.toggle_rates(hist, SLICE).withColumn("rules", F.lit("all"))
    part = sbt.toggle_rates(hist, SLICE, no_paralytic=False, vaso=False, transition=False, low_peep=False).withColumn("rules", F.lit("oxygen and length"))
    return full.unionByName(part).drop("rate")


@query(
    "sbt_waterfall",
    _SBT_SQL
    + ", "
    + _SLICES
    + """, w AS (SELECT unit, dim, granularity, period, [count(*), count(*) FILTER (WHERE NOT trach), count(*) FILTER (WHERE NOT trach AND NOT par), count(*) FILTER (WHERE NOT trach AND NOT par AND prior >= 12),
   count(*) FILTER (WHERE NOT trach AND NOT par AND prior >= 12 AND stable), count(*) FILTER (WHERE NOT trach AND NOT par AND prior >= 12 AND stable AND NOT (spont AND NOT nb_t))] AS n FROM sl GROUP BY unit, dim, granularity, period),
k AS (SELECT unnest([0, 1, 2, 3, 4, 5]) AS step)
SELECT unit, dim, granularity, period, step, n[step + 1] AS n, CASE WHEN step = 0 THEN 0 ELSE n[step] - n[step + 1] END AS removed FROM w, k""",
)
def sbt_waterfall(t: Tables):
    hist = cut_lineage(sbt.mask_table(sbt_stages(t)["observation"]))
    return masks.mask_waterfall(hist, SLICE, sbt.toggle_steps()).drop("label")


@query(
    "sbt_durations",
    _SBT_SQL
    + """SELECT ob.unit, ob.month, ob.week, round(se.dur, 6) AS dur_min, se.c AS arm FROM se JOIN dd ON dd.b = se.b AND se.s >= dd.lo AND se.s < dd.hi
   JOIN ob ON ob.b = dd.b AND ob.d = dd.d WHERE tr AND lp""",
)
def sbt_durations(t: Tables):
    own = sbt_stages(t)
    return sbt.durations(own["days"], own["episodes"]).withColumn("dur_min", F.round("dur_min", 6))


@query(
    "sbt_coverage",
    _SBT_SQL
    + f"""SELECT count(*) AS n_support_rows, count(*) FILTER (WHERE NOT sc) AS n_support_rows_native, round(avg((NOT sc)::INT) * 100, 6) AS pct_native_support_rows
   FROM fs WHERE mode = {_SUP} AND b IN (SELECT b FROM dd)""",
)
def sbt_coverage(t: Tables):
    own = sbt_stages(t)
    return sbt.coverage(own["timeline"], own["days"], CFG.sbt).withColumn("pct_native_support_rows", F.round("pct_native_support_rows", 6))


@query(
    "sbt_integrity",
    _SBT_SQL
    + """, bad AS (SELECT count(*) FILTER (WHERE nb_tdp AND NOT nb_tp) AS a, count(*) FILTER (WHERE nb_tp AND NOT spont) AS b,
   count(*) FILTER (WHERE nb_t AND NOT spont) AS n1, count(*) FILTER (WHERE nb_d AND NOT spont) AS n2, count(*) FILTER (WHERE nb_p AND NOT spont) AS n3, count(*) FILTER (WHERE nb_td AND NOT spont) AS n4,
   count(*) FILTER (WHERE nb_tp AND NOT spont) AS n5, count(*) FILTER (WHERE nb_dp AND NOT spont) AS n6, count(*) FILTER (WHERE nb_tdp AND NOT spont) AS n7, count(*) FILTER (WHERE nb_tdp) AS d FROM ob)
SELECT 'strict_in_any' AS rule, a AS n_violations, d AS n_damaged FROM bad UNION ALL SELECT 'any_in_support', b, 0 FROM bad UNION ALL SELECT 'nb_t_in_support', n1, n1 FROM bad
UNION ALL SELECT 'nb_d_in_support', n2, n2 FROM bad UNION ALL SELECT 'nb_p_in_support', n3, n3 FROM bad UNION ALL SELECT 'nb_td_in_support', n4, n4 FROM bad
UNION ALL SELECT 'nb_tp_in_support', n5, n5 FROM bad UNION ALL SELECT 'nb_dp_in_support', n6, n6 FROM bad UNION ALL SELECT 'nb_tdp_in_support', n7, n7 FROM bad""",
)
def sbt_integrity(t: Tables):
    """Nesting of the numerators, and the same with the looser numerator deliberately cleared."""
    obs = sbt_stages(t)["observation"]
    fine = checks.violations(obs, sbt.nesting_rules())
    broken = checks.violations(obs.withColumn("sbt_delivered_any", F.lit(False)), sbt.nesting_rules())
    return fine.join(broken.withColumnRenamed("n_violations", "n_damaged"), "rule")


@query(
    "proning_summary",
    _PRONE_SQL
    + ", "
    + _SESSIONS.strip()
    + f""", pv AS (SELECT pe.b, any_value(pe.tf) + {12 * HOUR} AS te, bool_or(pk2.hid IS NOT NULL) AS seen, count(ses.s) > 0 AS prone, coalesce(bool_or(h >= 16), false) AS good, min(ses.s) AS fp
   FROM pe JOIN blk ON blk.b = pe.b LEFT JOIN (SELECT DISTINCT hid FROM pk) pk2 ON pk2.hid = blk.hid LEFT JOIN ses ON ses.hid = blk.hid WHERE eligible GROUP BY pe.b),
hh AS (SELECT *, (fp - te) / 3600000000.0 AS ttp FROM pv),
tot AS (SELECT (SELECT count(*) FROM pe) AS a, count(*) AS e, count(*) FILTER (WHERE prone) AS p, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE seen) AS s,
   count(*) FILTER (WHERE ttp <= 24) AS h24, count(*) FILTER (WHERE ttp <= 48) AS h48, count(*) FILTER (WHERE ttp <= 72) AS h72, count(*) FILTER (WHERE ttp <= 168) AS h168 FROM hh) """
    + _rows([
        ("ards_cohort", "a", "a"), ("proseva_eligible", "e", "a"), ("ever_proned", "p", "e"), ("adherent_all_eligible", "g", "e"), ("position_data_present", "s", "e"), ("adherent_documented", "g", "s"),
        *[(f"cumulative_proned_by_{h}h", f"h{h}", "e") for h in (24, 48, 72, 168)],
    ])
    + """ UNION ALL SELECT 'time_to_prone_median_h', NULL, NULL, round(median(ttp), 6) FROM hh UNION ALL SELECT 'time_to_prone_q1_h', NULL, NULL, round(quantile_cont(ttp, 0.25), 6) FROM hh
   UNION ALL SELECT 'time_to_prone_q3_h', NULL, NULL, round(quantile_cont(ttp, 0.75), 6) FROM hh""",
)
def proning_summary(t: Tables):
    own = proning_stages(t)
    return _plain(proning.summary(own["patients"], own["people"], PRONE))


@query(
    "sat_conservation",
    _SAT_SQL
    + """, mu AS (SELECT DISTINCT unit, month FROM ob)
SELECT 'units' AS rule, 0::BIGINT AS n_violations, (SELECT count(DISTINCT month) FROM mu) AS n_damaged UNION ALL SELECT 'periods_month', 0, (SELECT count(DISTINCT unit) FROM mu)
UNION ALL SELECT 'periods_week', 0, 0 UNION ALL SELECT 'names', 0, (SELECT count(*) FROM mu)""",
)
def sat_conservation(t: Tables):
    """Faults of the cube's roll-up edges, and of the cube with one day more in every month of every unit."""
    cube = cut_lineage(sat.slices(sat_stages(t)["observation"], CFG.sat))
    monthly = (F.col("dim") == "type") & (F.col("unit") != "__ALL__") & (F.col("granularity") == "month")
    damaged = cube.withColumn("n_vent_days", F.col("n_vent_days") + F.when(monthly, 1).otherwise(0))
    fine = checks.conservation(cube, sat.COUNTS)
    return fine.join(checks.conservation(damaged, sat.COUNTS).withColumnRenamed("n_violations", "n_damaged"), "rule")
