"""The measures on the derived intensive-care tables, with independent SQL counterparts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from icuqm.catalog.base import DAY, HOUR, Tables, query
from icuqm.catalog.roles import SQL, icu_tables, stored
from icuqm.config import Config, Site
from icuqm.operators import checks
from icuqm.plans import common, lpv, proning, sat, sbt, severity
from icuqm.session import cut_lineage
from icuqm.sources import feeds

CFG = Config()
SITE = Site("unknown", timezone="UTC")
MIN = 60_000_000


def text_day(df):
    return df.withColumn("day", F.col("day").cast("string"))


# ---------------------------------------------------------------- lung-protective ventilation

_COHORT = f"""
WITH {SQL.strip()},
adult AS (SELECT hid, pid, sex, floor((adm - birth_us) / {DAY}) / 365.25 AS age_at_admit FROM hosp JOIN pat USING (pid) WHERE floor((adm - birth_us) / {DAY}) / 365.25 >= 18),
icu AS (SELECT hid, i, o, coalesce(unit, '__unknown_icu_type__') AS u, coalesce(unit_name, '__unknown_unit__') AS un FROM adt WHERE cat = 'icu'),
vent AS (SELECT rs.hid, t FROM rs JOIN adult USING (hid) WHERE dev = 'imv'),
att AS (SELECT vent.hid, t, t // {DAY} AS d, u, un, coalesce(t < o, false) AS in_icu FROM vent ASOF LEFT JOIN icu ON vent.hid = icu.hid AND t >= i),
inn AS (SELECT * FROM att WHERE in_icu),
du AS (SELECT hid, d, u, count(*) AS n FROM inn GROUP BY ALL),
tu AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hid, d ORDER BY n DESC, u) AS rn FROM du) WHERE rn = 1),
dn AS (SELECT inn.hid, inn.d, inn.un, count(*) AS n FROM inn JOIN tu ON inn.hid = tu.hid AND inn.d = tu.d AND inn.u = tu.u GROUP BY ALL),
tn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hid, d ORDER BY n DESC, un) AS rn FROM dn) WHERE rn = 1),
tot AS (SELECT hid, d, count(*) AS n_imv_rows FROM inn GROUP BY hid, d),
hts AS (SELECT hid, CASE WHEN v BETWEEN 100 AND 230 THEN v END AS h FROM vit WHERE cat = 'height_cm' AND hid IN (SELECT hid FROM tot)),
hh AS (SELECT hid, median(h) AS own FROM hts GROUP BY hid),
hp AS (SELECT pid, median(own) AS usual FROM hh JOIN adult USING (hid) GROUP BY pid),
days0 AS (SELECT tot.hid, tot.d, adult.pid, tu.u, tn.un, sex, age_at_admit, coalesce(hh.own, hp.usual) AS height_cm, n_imv_rows
   FROM tot JOIN tu ON tot.hid = tu.hid AND tot.d = tu.d JOIN tn ON tot.hid = tn.hid AND tot.d = tn.d JOIN adult ON adult.hid = tot.hid
   LEFT JOIN hh ON hh.hid = tot.hid LEFT JOIN hp ON hp.pid = adult.pid),
days1 AS (SELECT *, CASE sex WHEN 'male' THEN 50 + 2.3 * (height_cm / 2.54 - 60) WHEN 'female' THEN 45.5 + 2.3 * (height_cm / 2.54 - 60) END AS w FROM days0),
days AS (SELECT *, CASE WHEN w >= 25 THEN w END AS pbw_kg FROM days1)
"""
_DAY = "strftime(make_timestamp(d * 86400000000), '%Y-%m-%d') AS day"


@query(
    "lpv_cohort_days",
    _COHORT + f"SELECT hid AS hospitalization_id, pid AS patient_id, {_DAY}, u AS assigned_unit, un AS assigned_unit_name, round(height_cm, 6) AS height_cm, round(pbw_kg, 6) AS pbw_kg, n_imv_rows FROM days",
)
def lpv_cohort(t: Tables):
    days = lpv.cohort_days(icu_tables(t), CFG.lpv)
    cols = ["hospitalization_id", "patient_id", "day", "assigned_unit", "assigned_unit_name", "height_cm", "pbw_kg", "n_imv_rows"]
    return text_day(days).withColumns({c: F.round(c, 6) for c in ("height_cm", "pbw_kg")}).select(*cols)


@query(
    "lpv_excluded_stays",
    _COHORT + "SELECT DISTINCT hid AS hospitalization_id FROM vent WHERE hid NOT IN (SELECT hid FROM days)",
)
def lpv_excluded(t: Tables):
    rows = lpv.attributed_rows(icu_tables(t), CFG.lpv)
    return rows.groupBy("hospitalization_id").agg(F.bool_or("in_icu").alias("ok")).where("not ok").select("hospitalization_id")


_LPV = _COHORT + f""",
rsc AS (SELECT hid, t, dev, mode, CASE WHEN vt_obs BETWEEN 100 AND 3000 THEN vt_obs END AS vt_obs, CASE WHEN vt_set BETWEEN 100 AND 3000 THEN vt_set END AS vt_set,
   CASE WHEN plat BETWEEN 0 AND 100 THEN plat END AS plat, CASE WHEN peep_obs BETWEEN 0 AND 50 THEN peep_obs END AS peep_obs, CASE WHEN peep_set BETWEEN 0 AND 30 THEN peep_set END AS peep_set,
   CASE WHEN fio2 BETWEEN 0.21::DOUBLE AND 1 THEN fio2 END AS fio2 FROM rs WHERE hid IN (SELECT hid FROM days)),
rsp AS (SELECT *, CASE WHEN plat IS NOT NULL THEN coalesce(peep_obs, peep_set) END AS pp FROM rsc),
cf AS (SELECT *, lead(t) OVER w AS nx,
   last_value(vt_obs IGNORE NULLS) OVER w AS a1, last_value(CASE WHEN vt_obs IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t1,
   last_value(vt_set IGNORE NULLS) OVER w AS a2, last_value(CASE WHEN vt_set IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t2,
   last_value(peep_obs IGNORE NULLS) OVER w AS a3, last_value(CASE WHEN peep_obs IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t3,
   last_value(peep_set IGNORE NULLS) OVER w AS a4, last_value(CASE WHEN peep_set IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t4,
   last_value(fio2 IGNORE NULLS) OVER w AS a5, last_value(CASE WHEN fio2 IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t5,
   last_value(plat IGNORE NULLS) OVER w AS a6, last_value(CASE WHEN plat IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t6,
   last_value(mode IGNORE NULLS) OVER w AS a7, last_value(CASE WHEN mode IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t7,
   last_value(pp IGNORE NULLS) OVER w AS a8, last_value(CASE WHEN pp IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t8
   FROM rsp WINDOW w AS (PARTITION BY hid ORDER BY t)),
eff AS (SELECT hid, dev, t AS s, CASE WHEN nx - t <= {DAY} THEN nx ELSE t + {HOUR} END AS e,
   coalesce(CASE WHEN t - t1 <= {2 * HOUR} THEN a1 END, CASE WHEN t - t2 <= {2 * HOUR} THEN a2 END) AS tv,
   coalesce(CASE WHEN t - t3 <= {2 * HOUR} THEN a3 END, CASE WHEN t - t4 <= {2 * HOUR} THEN a4 END) AS peep,
   CASE WHEN t - t5 <= {2 * HOUR} THEN a5 END AS fio2, CASE WHEN t - t6 <= {6 * HOUR} THEN a6 END AS plat, CASE WHEN t - t7 <= {6 * HOUR} THEN a7 END AS mode,
   CASE WHEN t - t8 <= {6 * HOUR} THEN a8 END AS pdp FROM cf),
pc AS (SELECT *, s // {DAY} AS d, least(e, (s // {DAY} + 1) * {DAY}) - s AS us FROM eff
   UNION ALL SELECT *, s // {DAY} + 1, e - (s // {DAY} + 1) * {DAY} FROM eff WHERE e > (s // {DAY} + 1) * {DAY}),
pb AS (SELECT hid, max(pbw_kg) AS pbw FROM days GROUP BY hid),
p1 AS (SELECT pc.hid, pc.d, pc.us, dev = 'imv' AS imv, coalesce(mode IN ('assist control-volume control', 'pressure-regulated volume control', 'simv', 'pressure control'), false) AS ok,
   tv / pbw AS vt, CASE WHEN plat < coalesce(pdp, peep) THEN NULL ELSE plat END AS plat, pdp, peep, fio2 FROM pc JOIN pb USING (hid) WHERE pc.us > 0),
p2 AS (SELECT *, CASE WHEN plat - pdp >= 0 THEN plat - pdp END AS dp, imv AND ok AS el FROM p1),
roll AS (SELECT hid, d, sum(CASE WHEN imv THEN us ELSE 0 END) AS total_us, sum(CASE WHEN el THEN us ELSE 0 END) AS elig_us,
   sum(CASE WHEN el AND vt IS NOT NULL THEN us ELSE 0 END) AS vt_a, sum(CASE WHEN el AND vt <= 6 THEN us ELSE 0 END) AS vt_i,
   sum(CASE WHEN el AND vt <= 8 THEN us ELSE 0 END) AS vt8_i,
   sum(CASE WHEN el AND plat IS NOT NULL THEN us ELSE 0 END) AS pl_a, sum(CASE WHEN el AND plat <= 30 THEN us ELSE 0 END) AS pl_i,
   sum(CASE WHEN el AND dp IS NOT NULL THEN us ELSE 0 END) AS dp_a, sum(CASE WHEN el AND dp <= 15 THEN us ELSE 0 END) AS dp_i,
   sum(CASE WHEN el AND vt IS NOT NULL AND dp IS NOT NULL THEN us ELSE 0 END) AS co_a, sum(CASE WHEN el AND vt <= 6 AND dp <= 15 AND plat <= 30 THEN us ELSE 0 END) AS co_i
   FROM p2 GROUP BY hid, d),
sp AS (SELECT hid, max(d) - min(d) + 1 AS span FROM days GROUP BY hid),
st0 AS (SELECT days.hid, days.d, days.pid, days.u, days.un, span, coalesce(total_us, 0) AS total_us, coalesce(elig_us, 0) AS elig_us, coalesce(vt_a, 0) AS vt_a, coalesce(vt_i, 0) AS vt_i, coalesce(vt8_i, 0) AS vt8_i,
   coalesce(pl_a, 0) AS pl_a, coalesce(pl_i, 0) AS pl_i, coalesce(dp_a, 0) AS dp_a, coalesce(dp_i, 0) AS dp_i, coalesce(co_a, 0) AS co_a, coalesce(co_i, 0) AS co_i
   FROM days LEFT JOIN roll USING (hid, d) JOIN sp ON sp.hid = days.hid),
st AS (SELECT *, CASE WHEN vt_a < {HOUR} THEN 'not_assessable' WHEN vt_i * 5 >= vt_a * 4 THEN 'adherent' ELSE 'non_adherent' END AS vt_status,
   CASE WHEN vt_a < {HOUR} THEN 'not_assessable' WHEN vt8_i * 5 >= vt_a * 4 THEN 'adherent' ELSE 'non_adherent' END AS vt8_status,
   CASE WHEN pl_a < {HOUR} THEN 'not_assessable' WHEN pl_i * 5 >= pl_a * 4 THEN 'adherent' ELSE 'non_adherent' END AS plat_status,
   CASE WHEN dp_a < {HOUR} THEN 'not_assessable' WHEN dp_i * 5 >= dp_a * 4 THEN 'adherent' ELSE 'non_adherent' END AS dp_status,
   CASE WHEN co_a < {HOUR} THEN 'not_assessable' WHEN co_i * 5 >= co_a * 4 THEN 'adherent' ELSE 'non_adherent' END AS comp_status FROM st0),
oxy AS (SELECT hid, res_t AS t, v, 'pao2' AS src FROM lab WHERE v BETWEEN 30 AND 700 UNION ALL SELECT hid, t, v, 'spo2' FROM vit WHERE cat = 'spo2' AND v BETWEEN 50 AND 100 AND v <= 97),
fo AS (SELECT hid, t AS ft, fio2 FROM rsc WHERE fio2 IS NOT NULL), po AS (SELECT hid, t AS pt, coalesce(peep_obs, peep_set) AS peep FROM rsc WHERE coalesce(peep_obs, peep_set) IS NOT NULL),
o1 AS (SELECT oxy.*, CASE WHEN oxy.t - ft <= {4 * HOUR} THEN fio2 END AS fio2 FROM oxy ASOF LEFT JOIN fo ON oxy.hid = fo.hid AND oxy.t >= ft WHERE oxy.hid IN (SELECT hid FROM days)),
o2 AS (SELECT o1.*, CASE WHEN o1.t - pt <= {4 * HOUR} THEN peep END AS peep FROM o1 ASOF LEFT JOIN po ON o1.hid = po.hid AND o1.t >= pt),
o3 AS (SELECT *, v / fio2 AS ratio, t // {DAY} AS d FROM o2 WHERE fio2 IS NOT NULL AND peep IS NOT NULL),
od AS (SELECT hid, d, bool_or(((src = 'pao2' AND ratio < 300) OR (src = 'spo2' AND ratio < 315)) AND peep > 5) AS severe, min(CASE WHEN src = 'pao2' THEN ratio END) AS worst_pf,
   min(CASE WHEN src = 'spo2' THEN ratio END) AS worst_sf, bool_or(src = 'pao2') AS gas FROM o3 GROUP BY hid, d),
sev AS (SELECT days.hid, days.d, CASE WHEN severe THEN 'severe' WHEN severe IS NOT NULL THEN 'not_severe' ELSE 'unknown' END AS severity, worst_pf, worst_sf,
   CASE WHEN gas THEN 'pao2' WHEN gas IS NOT NULL THEN 'spo2' ELSE 'none' END AS class_source FROM days LEFT JOIN od USING (hid, d)),
ss AS (SELECT st.*, sev.severity, strftime(make_timestamp(d * {DAY}), '%Y-%m-%d') AS day, strftime(make_timestamp(d * {DAY}), '%Y-%m') AS month, strftime(make_timestamp(d * {DAY}), '%G-W%V') AS week
   FROM st JOIN sev USING (hid, d))
"""


def lpv_status(t: Tables):
    """The stored stages of the measure: days, pieces, status and severity."""
    tables, graph = stored(t)
    return tuple(lpv.stages(tables, CFG.lpv, CFG.severity, graph.keep).values())


@query(
    "lpv_day_status",
    _LPV
    + """SELECT hid AS hospitalization_id, day, span::INT AS span_days, total_us::BIGINT AS total_imv_us, elig_us::BIGINT AS mode_eligible_us, vt_a::BIGINT AS vt_assessable_us, vt_i::BIGINT AS vt_in_us,
   pl_a::BIGINT AS plat_assessable_us, pl_i::BIGINT AS plat_in_us, dp_a::BIGINT AS dp_assessable_us, dp_i::BIGINT AS dp_in_us, co_a::BIGINT AS comp_assessable_us, co_i::BIGINT AS comp_in_us,
   vt_status, vt8_status, plat_status, dp_status, comp_status FROM ss""",
)
def lpv_day_status(t: Tables):
    status = lpv_status(t)[2]
    cols = ["hospitalization_id", "day", "span_days", "total_imv_us", "mode_eligible_us"]
    cols += [f"{m}_{s}" for m in lpv.MEASURES for s in ("assessable_us", "in_us", "status")] + ["vt8_status"]
    return text_day(status).select(*cols)


@query(
    "lpv_interval_table",
    _LPV
    + f"""SELECT p2.hid AS hospitalization_id, strftime(make_timestamp(p2.d * {DAY}), '%Y-%m-%d') AS day, count(*) AS n, round(sum(p2.us) / 60000000.0, 6) AS minutes, round(coalesce(sum(vt), 0), 6) AS vt, round(coalesce(sum(p2.plat), 0), 6) AS plateau,
   round(coalesce(sum(dp), 0), 6) AS dp, round(coalesce(sum(peep), 0), 6) AS peep, round(coalesce(sum(fio2), 0), 6) AS fio2 FROM p2 JOIN days ON p2.hid = days.hid AND p2.d = days.d WHERE el GROUP BY p2.hid, p2.d""",
)
def lpv_intervals(t: Tables):
    days, pieces, _, _ = lpv_status(t)
    table = lpv.interval_table(pieces, days)
    total = lambda c: F.round(F.coalesce(F.sum(c), F.lit(0.0)), 6)
    return text_day(table).groupBy("hospitalization_id", "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("end") - F.col("start")) / F.lit(60000000.0), 6).alias("minutes"),
        total("vt_per_pbw").alias("vt"),
        total("plateau").alias("plateau"),
        total("driving_pressure").alias("dp"),
        total("peep").alias("peep"),
        total("fio2").alias("fio2"),
    )


@query(
    "lpv_severity",
    _LPV + f"SELECT hid AS hospitalization_id, {_DAY}, severity, round(worst_pf, 4) AS worst_pf, round(worst_sf, 4) AS worst_sf, class_source FROM sev",
)
def lpv_severity(t: Tables):
    return text_day(lpv_status(t)[3]).withColumns({c: F.round(c, 4) for c in ("worst_pf", "worst_sf")})


_BUCKETS = """
bk AS (SELECT *, 'day' AS granularity, day AS period, 'all' AS stratum FROM {src} UNION ALL SELECT *, 'week', week, 'all' FROM {src} UNION ALL SELECT *, 'month', month, severity FROM {src}),
hd AS (SELECT *, '__ALL__' AS unit, 'type' AS dim FROM bk UNION ALL SELECT *, u, 'type' FROM bk UNION ALL SELECT *, un, 'name' FROM bk)
"""


@query(
    "lpv_summaries",
    _LPV
    + ", "
    + _BUCKETS.format(src="ss").strip()
    + """, lg AS (SELECT granularity, period, unit, dim, stratum, unnest(['vt', 'plat', 'dp', 'comp']) AS measure, unnest([vt_status, plat_status, dp_status, comp_status]) AS status FROM hd)
SELECT granularity, period, unit, dim, stratum, measure, count(*) AS n_total, count(*) FILTER (WHERE status = 'adherent') AS n_adherent, count(*) FILTER (WHERE status = 'non_adherent') AS n_non_adherent,
  count(*) FILTER (WHERE status = 'not_assessable') AS n_not_assessable FROM lg GROUP BY ALL""",
)
def lpv_summaries(t: Tables):
    _, _, status, sev = lpv_status(t)
    return lpv.summaries(status, sev).drop("assessable_rate", "crude_rate")


@query(
    "lpv_cutoff_grids",
    _LPV
    + f""", cuts AS (SELECT unnest([{", ".join(str(c) + "::DOUBLE" for c in CFG.lpv.cutoffs)}]) AS cutoff),
iv AS (SELECT p2.* FROM p2 JOIN days USING (hid, d) WHERE el),
dc AS (SELECT hid, d, cutoff, sum(CASE WHEN vt IS NOT NULL THEN us ELSE 0 END) AS a1, sum(CASE WHEN vt <= cutoff THEN us ELSE 0 END) AS i1,
   sum(CASE WHEN vt IS NOT NULL AND plat IS NOT NULL AND dp IS NOT NULL THEN us ELSE 0 END) AS a2, sum(CASE WHEN vt <= cutoff AND plat <= 30 AND dp <= 15 THEN us ELSE 0 END) AS i2 FROM iv, cuts GROUP BY hid, d, cutoff),
sw AS (SELECT ss.hid, ss.d, ss.u, ss.un, ss.day, ss.week, ss.month, ss.severity, cuts.cutoff, coalesce(a1, 0) AS a1, coalesce(i1, 0) AS i1, coalesce(a2, 0) AS a2, coalesce(i2, 0) AS i2
   FROM ss CROSS JOIN cuts LEFT JOIN dc ON dc.hid = ss.hid AND dc.d = ss.d AND dc.cutoff = cuts.cutoff),
"""
    + _BUCKETS.format(src="sw").strip()
    + f""", lg AS (SELECT granularity, period, unit, dim, stratum, cutoff, unnest(['vt', 'comp']) AS measure, unnest([a1, a2]) AS a, unnest([i1, i2]) AS i FROM hd WHERE granularity <> 'day' OR unit = '__ALL__')
SELECT granularity, period, unit, dim, stratum, measure, cutoff, count(*) AS n_total, count(*) FILTER (WHERE a >= {HOUR}) AS n_assessable, count(*) FILTER (WHERE a >= {HOUR} AND i * 5 >= a * 4) AS n_adherent FROM lg GROUP BY ALL""",
)
def lpv_grids(t: Tables):
    days, pieces, status, sev = lpv_status(t)
    return lpv.cutoff_grids(lpv.interval_table(pieces, days), status, sev, CFG.lpv).drop("assessable_rate", "crude_rate")


@query(
    "lpv_histograms",
    _LPV
    + """, x AS (SELECT ss.month, ss.severity, p2.us, unnest(['vt_per_pbw', 'plateau', 'driving_pressure', 'peep', 'fio2']) AS component, unnest([vt, p2.plat, dp, peep, fio2]) AS v, unnest([0, 0, 0, 0, 0.2]::DOUBLE[]) AS lo,
   unnest([15, 60, 50, 30, 1]::DOUBLE[]) AS hi, unnest([0.25, 1, 1, 1, 0.05]::DOUBLE[]) AS step FROM p2 JOIN ss USING (hid, d) WHERE el),
y AS (SELECT *, floor((v - lo) / step) AS g FROM x WHERE v >= lo AND v < hi),
z AS (SELECT *, CAST(g + CASE WHEN v < lo + g * step THEN -1 WHEN v >= lo + (g + 1) * step THEN 1 ELSE 0 END AS INT) AS bin FROM y)
SELECT component, month, severity, bin, round(sum(us) / 60000000.0, 4) AS minutes FROM z GROUP BY ALL""",
)
def lpv_hist(t: Tables):
    days, pieces, _, sev = lpv_status(t)
    out = lpv.histograms(lpv.interval_table(pieces, days), sev)
    return out.withColumn("minutes", F.round("minutes", 4))


@query(
    "lpv_feed_cube",
    _LPV
    + """, gr AS (SELECT *, 'all' AS granularity, 'all' AS period FROM ss UNION ALL SELECT *, 'month', month FROM ss UNION ALL SELECT *, 'week', week FROM ss),
hd AS (SELECT *, '__ALL__' AS unit, 'type' AS dim, CAST(NULL AS VARCHAR) AS parent FROM gr UNION ALL SELECT *, u, 'type', NULL FROM gr UNION ALL SELECT *, un, 'name', u FROM gr)
SELECT unit, dim, parent, granularity, period, count(*) AS n, sum(total_us)::BIGINT AS imv_us, count(*) FILTER (WHERE vt8_status = 'adherent') AS vt8_num, count(*) FILTER (WHERE vt8_status <> 'not_assessable') AS vt8_den,
  count(*) FILTER (WHERE plat_status = 'adherent') AS plat_num, count(*) FILTER (WHERE plat_status <> 'not_assessable') AS plat_den, count(*) FILTER (WHERE dp_status = 'adherent') AS dp_num, count(*) FILTER (WHERE dp_status <> 'not_assessable') AS dp_den,
  count(*) FILTER (WHERE severity = 'severe' AND vt8_status = 'adherent') AS vt8sev_num, count(*) FILTER (WHERE severity = 'severe' AND vt8_status <> 'not_assessable') AS vt8sev_den FROM hd GROUP BY ALL""",
)
def lpv_cube(t: Tables):
    _, _, status, sev = lpv_status(t)
    return lpv.feed_cube(status, sev)


_T1 = """, wd AS (SELECT ss.*, days.age_at_admit, days.sex, days.height_cm, days.pbw_kg FROM ss JOIN days USING (hid, d)),
sl AS (SELECT 'all' AS stratum, 'all' AS granularity, 'all' AS period, * FROM wd UNION ALL SELECT severity, 'all', 'all', * FROM wd UNION ALL SELECT 'all', 'month', month, * FROM wd UNION ALL SELECT severity, 'month', month, * FROM wd
   UNION ALL SELECT 'all', 'year', month[1:4], * FROM wd UNION ALL SELECT severity, 'year', month[1:4], * FROM wd UNION ALL SELECT 'all', 'week', week, * FROM wd),
uc AS (SELECT stratum, granularity, period, hid, u, count(*) AS n FROM sl GROUP BY ALL),
pu AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stratum, granularity, period, hid ORDER BY n DESC, u) AS rn FROM uc) WHERE rn = 1),
ho AS (SELECT stratum, granularity, period, hid, max(age_at_admit) AS age, max(sex) AS sex, max(height_cm) AS height, max(pbw_kg) AS pbw, count(*)::DOUBLE AS n_days FROM sl GROUP BY ALL),
nm AS (SELECT stratum, granularity, period, unnest(['age_at_admit', 'height_cm', 'pbw_kg', 'n_days']) AS variable, unnest([age, height, pbw, n_days]) AS v FROM ho),
ct AS (SELECT stratum, granularity, period, 'sex_category' AS variable, coalesce(sex, 'unknown') AS level FROM ho UNION ALL SELECT stratum, granularity, period, 'primary_unit', u FROM pu),
sz AS (SELECT stratum, granularity, period, count(*) AS size FROM ho GROUP BY ALL)
SELECT stratum, granularity, period, variable, '' AS level, count(*) AS n, CAST(NULL AS DOUBLE) AS pct, round(median(v), 4) AS median, round(quantile_cont(v, 0.25), 4) AS q1, round(quantile_cont(v, 0.75), 4) AS q3 FROM nm WHERE v IS NOT NULL GROUP BY ALL
UNION ALL SELECT ct.stratum, ct.granularity, ct.period, variable, level, count(*), round(count(*) * 100.0 / any_value(size), 4), NULL, NULL, NULL FROM ct JOIN sz ON ct.stratum = sz.stratum AND ct.granularity = sz.granularity AND ct.period = sz.period
GROUP BY ct.stratum, ct.granularity, ct.period, variable, level"""


@query("lpv_table_one", _LPV + _T1)
def lpv_table1(t: Tables):
    _, _, status, sev = lpv_status(t)
    out = lpv.table_one(status, sev)
    return out.withColumns({c: F.round(c, 4) for c in ("pct", "median", "q1", "q3")})


@query(
    "lpv_integrity",
    _LPV
    + """, r AS (SELECT unnest(['vt_in_le_assessable', 'plat_in_le_assessable', 'dp_in_le_assessable', 'comp_in_le_assessable', 'vt_assessable_le_eligible', 'plat_assessable_le_eligible', 'dp_assessable_le_eligible', 'comp_assessable_le_eligible',
   'vt_fraction', 'plat_fraction', 'dp_fraction', 'comp_fraction', 'eligible_le_total', 'comp_le_vt', 'comp_le_dp', 'day_le_25h']) AS rule,
   unnest([vt_i > vt_a, pl_i > pl_a, dp_i > dp_a, co_i > co_a, vt_a > elig_us, pl_a > elig_us, dp_a > elig_us, co_a > elig_us, vt_i > vt_a, pl_i > pl_a, dp_i > dp_a, co_i > co_a, elig_us > total_us, co_a > vt_a, co_a > dp_a, total_us > 90000000000]) AS bad FROM ss)
SELECT rule, count(*) FILTER (WHERE bad) AS n_violations FROM r GROUP BY rule""",
)
def lpv_checks(t: Tables):
    return checks.violations(lpv_status(t)[2], lpv.integrity_rules())


# ---------------------------------------------------------------- block-level cohort in SQL

_FILLED = f"""
WITH {SQL.strip()},
ho AS (SELECT hid, pid, adm, dis, age, discharge, max(dis) OVER (PARTITION BY pid ORDER BY adm, hid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM hosp),
hg AS (SELECT *, sum(CASE WHEN reach IS NULL OR adm - reach > {6 * HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY pid ORDER BY adm, hid) AS g FROM ho),
blk AS (SELECT *, first_value(hid) OVER (PARTITION BY pid, g ORDER BY adm, hid) AS b FROM hg),
icu AS (SELECT b, i, o, unit, coalesce(unit_name, 'unknown') AS un FROM adt JOIN blk USING (hid) WHERE cat = 'icu' AND o > i),
hr AS (SELECT hid, min(t) // {HOUR} * {HOUR} AS lo, max(t) // {HOUR} * {HOUR} AS hi FROM rs GROUP BY hid),
al AS (SELECT hid, t, false AS sc, dev, mode, trach, peep_set, fio2, ps FROM rs
   UNION ALL SELECT hid, unnest(generate_series(lo, hi, {HOUR})) + {HOUR - 1_000_000}, true, NULL, NULL, NULL, NULL, NULL, NULL FROM hr),
fl AS (SELECT b, al.hid, t, sc, last_value(dev IGNORE NULLS) OVER w AS dev, last_value(mode IGNORE NULLS) OVER w AS mode, last_value(trach IGNORE NULLS) OVER w AS trach,
   last_value(peep_set IGNORE NULLS) OVER w AS peep, last_value(fio2 IGNORE NULLS) OVER w AS fio2, last_value(ps IGNORE NULLS) OVER w AS ps
   FROM al JOIN blk USING (hid) WINDOW w AS (PARTITION BY al.hid ORDER BY t, sc ROWS UNBOUNDED PRECEDING))
"""
_VDAYS = f"""
sg AS (SELECT *, coalesce(lead(t) OVER (PARTITION BY b ORDER BY t, sc, dev NULLS FIRST), t + {DAY}) AS e FROM fs),
im AS (SELECT b, t AS s, e FROM sg WHERE dev = 'imv' AND e > t),
vi AS (SELECT im.b, greatest(s, i) AS s, least(e, o) AS e, unit, un FROM im JOIN icu ON im.b = icu.b AND s < o AND e > i),
vd AS (SELECT b, d, unit, un, greatest(s, d * {DAY}) AS s, least(e, (d + 1) * {DAY}) AS e FROM (SELECT *, unnest(generate_series(s // {DAY}, (e - 1) // {DAY})) AS d FROM vi WHERE e > s)),
vu AS (SELECT * FROM (SELECT b, d, unit, row_number() OVER (PARTITION BY b, d ORDER BY e - s DESC, unit) AS rn FROM vd WHERE unit IS NOT NULL) WHERE rn = 1),
vn0 AS (SELECT vd.b, vd.d, un, sum(e - s) AS us FROM vd JOIN vu ON vd.b = vu.b AND vd.d = vu.d AND vd.unit = vu.unit GROUP BY ALL),
vn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY b, d ORDER BY us DESC, un) AS rn FROM vn0) WHERE rn = 1),
vw AS (SELECT b, d, sum(e - s)::DOUBLE / 60000000 AS minutes, min(s) AS lo, max(e) AS hi FROM vd GROUP BY b, d),
dd AS (SELECT vw.*, coalesce(vu.unit, 'unknown') AS unit, coalesce(vn.un, 'unknown') AS unit_name FROM vw LEFT JOIN vu ON vu.b = vw.b AND vu.d = vw.d LEFT JOIN vn ON vn.b = vw.b AND vn.d = vw.d)
"""
_SAT_SQL = _FILLED + f""",
mb AS (SELECT b, t, drug, dose, act, CASE WHEN drug IN ('propofol', 'midazolam', 'fentanyl') THEN 'sedative' WHEN drug = 'cisatracurium' THEN 'paralytic' WHEN drug = 'dexmedetomidine' THEN 'dex' END AS kind FROM med JOIN blk USING (hid)),
fs AS (SELECT * FROM fl WHERE b IN (SELECT b FROM icu) AND b IN (SELECT b FROM mb WHERE kind = 'sedative')),
{_VDAYS.strip()},
ds AS (SELECT *, coalesce(lead(t) OVER (PARTITION BY b, drug ORDER BY t), t + {DAY}) AS e FROM mb WHERE kind IS NOT NULL),
da AS (SELECT b, drug, kind, dose, t AS s, e FROM ds WHERE e > t AND dose > 0 AND act <> 'stop'),
fg AS (SELECT dd.b, dd.d, coalesce(bool_or(kind = 'sedative'), false) AS sed, coalesce(bool_or(kind = 'paralytic'), false) AS par, coalesce(bool_or(kind = 'dex'), false) AS dex
   FROM dd LEFT JOIN da ON da.b = dd.b AND da.s < dd.hi AND da.e > dd.lo GROUP BY dd.b, dd.d),
el AS (SELECT dd.*, sed, par, dex, sed AND NOT par AS eligible FROM dd JOIN fg USING (b, d)),
c0 AS (SELECT el.b, el.d, el.hi, greatest(s, lo) AS s, least(e, el.hi) AS e FROM el JOIN da ON da.b = el.b AND da.kind = 'sedative' AND s < el.hi AND e > lo WHERE eligible),
c1 AS (SELECT *, max(e) OVER (PARTITION BY b, d ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS reach, lead(s) OVER (PARTITION BY b, d ORDER BY s, e) AS ns FROM c0),
gp AS (SELECT b, d, reach AS g0, coalesce(ns, hi) AS g1, ns IS NOT NULL AS resumed FROM c1 WHERE coalesce(ns, hi) > reach),
hq AS (SELECT * FROM gp WHERE g1 - g0 >= 1800000000),
hd AS (SELECT b, d, count(*) AS n, max(g1 - g0) / 60000000.0 AS longest, bool_or(resumed) AS resumed FROM hq GROUP BY b, d),
pid1 AS (SELECT b, any_value(pid) AS pid FROM blk GROUP BY b),
off AS (SELECT dd.b, dd.d, NOT bool_or(coalesce(im.s <= (dd.d + 1) * {DAY} AND (dd.d + 1) * {DAY} < im.e, false)) AS off_dev FROM dd LEFT JOIN im ON im.b = dd.b GROUP BY dd.b, dd.d),
ob AS (SELECT el.*, hd.n IS NOT NULL AS performed, coalesce(hd.n, 0) AS n_holds, coalesce(longest, 0) AS longest, coalesce(resumed, false) AS resumed,
   off_dev AND (death_us IS NULL OR death_us > (el.d + 1) * {DAY}) AS extubated, strftime(make_timestamp(el.d * {DAY}), '%Y-%m-%d') AS day, strftime(make_timestamp(el.d * {DAY}), '%Y-%m') AS month, strftime(make_timestamp(el.d * {DAY}), '%G-W%V') AS week
   FROM el LEFT JOIN hd USING (b, d) JOIN off USING (b, d) JOIN pid1 USING (b) JOIN pat USING (pid))
"""
# every patient-day under each of its slices
_SLICES = """gr AS (SELECT *, 'all' AS granularity, 'all' AS period FROM ob UNION ALL SELECT *, 'month', month FROM ob UNION ALL SELECT *, 'week', week FROM ob),
sl AS (SELECT * REPLACE ('__ALL__' AS unit), 'type' AS dim FROM gr UNION ALL SELECT *, 'type' FROM gr UNION ALL SELECT * REPLACE (unit_name AS unit), 'name' FROM gr)
"""

# ---------------------------------------------------------------- sedation interruption

def sat_stages(t: Tables):
    tables, graph = stored(t)
    return sat.stages(tables, CFG.sat, graph.keep)


@query(
    "sat_observation",
    _SAT_SQL
    + """SELECT b AS encounter_block, day, unit, unit_name, round(minutes, 6) AS vented_icu_minutes, lo AS day_in, hi AS day_out, sed AS on_sat_sedation, par AS on_paralytic, dex AS on_dex, eligible,
   performed AS sat_performed, n_holds, round(longest, 6) AS longest_off_min, resumed AS sat_resumed, extubated AS extubated_eod FROM ob""",
)
def sat_observation(t: Tables):
    cols = ["encounter_block", "day", "unit", "unit_name", "vented_icu_minutes", "day_in", "day_out", "on_sat_sedation", "on_paralytic", "on_dex", "eligible"]
    cols += ["sat_performed", "n_holds", "longest_off_min", "sat_resumed", "extubated_eod"]
    out = text_day(sat_stages(t)["observation"]).select(*cols)
    return out.withColumns({c: F.round(c, 6) for c in ("vented_icu_minutes", "longest_off_min")})


@query(
    "sat_slices",
    _SAT_SQL
    + ", "
    + _SLICES
    + """SELECT unit, dim, granularity, period, count(*) AS n_vent_days, count(*) FILTER (WHERE eligible) AS n_eligible, count(*) FILTER (WHERE eligible AND performed) AS n_sat,
   count(*) FILTER (WHERE eligible AND performed AND resumed) AS n_resumed, count(*) FILTER (WHERE eligible AND performed AND NOT resumed) AS n_notresumed, count(*) FILTER (WHERE eligible AND performed AND extubated) AS n_extubated FROM sl GROUP BY ALL""",
)
def sat_slices(t: Tables):
    cube = sat.slices(sat_stages(t)["observation"], CFG.sat)
    return cube.select("unit", "dim", "granularity", "period", *sat.COUNTS)


@query(
    "sat_dose_resumption",
    _SAT_SQL
    + """, f1 AS (SELECT b, d, min(g0) AS g0, min_by(g1, g0) AS g1 FROM hq WHERE resumed GROUP BY b, d),
x AS (SELECT f1.*, dd.hi, da.drug, da.s, da.dose FROM f1 JOIN dd USING (b, d) JOIN da ON da.b = f1.b AND da.kind = 'sedative'),
pr AS (SELECT b, d, drug, max_by(dose, s) FILTER (WHERE s < g0) AS pre, min_by(dose, s) FILTER (WHERE s >= g1 AND s <= hi) AS post FROM x GROUP BY b, d, drug),
ra AS (SELECT drug, post / pre AS r FROM pr WHERE pre > 0 AND post IS NOT NULL), rb AS (SELECT * FROM ra UNION ALL SELECT '__ALL__', r FROM ra)
SELECT drug, count(*) AS n_resumptions, round(quantile_cont(r, 0.25), 6) AS q1_ratio, round(median(r), 6) AS median_ratio, round(quantile_cont(r, 0.75), 6) AS q3_ratio,
  round(100.0 * count(*) FILTER (WHERE r <= 0.5) / count(*), 6) AS pct_at_or_below_half FROM rb GROUP BY drug""",
)
def sat_resumption(t: Tables):
    out = sat.resumption_summary(sat_stages(t)["ratios"], CFG.sat)
    return out.withColumns({c: F.round(c, 6) for c in ("q1_ratio", "median_ratio", "q3_ratio", "pct_at_or_below_half")})


# ---------------------------------------------------------------- breathing trials

_CTRL = "('assist control-volume control', 'pressure control', 'pressure-regulated volume control', 'simv')"
_SUP = "'pressure support/cpap'"


def _run(flag: str) -> str:
    """Rows of the hour table with the position inside the current run of one flag."""
    return f"""r_{flag} AS (SELECT b, d, {flag}, row_number() OVER (PARTITION BY b, d, g ORDER BY t) AS k FROM (SELECT *, sum(brk) OVER (PARTITION BY b, d ORDER BY t) AS g FROM
   (SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > {90 * MIN} OR lag({flag}) OVER w <> {flag} THEN 1 ELSE 0 END AS brk FROM hf WINDOW w AS (PARTITION BY b, d ORDER BY t)))),
a_{flag} AS (SELECT b, d, bool_or({flag} AND k >= 2) AS long_{flag} FROM r_{flag} GROUP BY b, d)"""


_SBT_SQL = _FILLED + f""",
fs AS (SELECT * FROM fl WHERE b IN (SELECT b FROM icu)),
{_VDAYS.strip()},
pc AS (SELECT dd.b, dd.d, count(c.t) AS prior FROM dd LEFT JOIN (SELECT b, t FROM fs WHERE sc AND dev = 'imv' AND mode IN {_CTRL}) c ON c.b = dd.b AND c.t < dd.lo GROUP BY dd.b, dd.d),
sn AS (SELECT dd.b, dd.d, coalesce(bool_or(f.trach), false) AS trach, coalesce(bool_or(f.mode = {_SUP}), false) AS spont FROM dd LEFT JOIN fs f ON f.b = dd.b AND f.t >= dd.lo AND f.t < dd.hi GROUP BY dd.b, dd.d),
wt AS (SELECT hid, t AS wt_t, v AS w FROM vit WHERE cat = 'weight_kg'),
vp AS (SELECT med.hid, t, dose, act FROM med WHERE drug = 'norepinephrine' AND hid IN (SELECT hid FROM blk WHERE b IN (SELECT b FROM icu))),
vw2 AS (SELECT vp.*, w FROM vp ASOF LEFT JOIN wt ON vp.hid = wt.hid AND vp.t >= wt_t),
ne AS (SELECT b, t AS nt, coalesce(CASE WHEN dose > 0 AND coalesce(act <> 'stop', true) THEN dose / w ELSE 0 END, 0) AS ne, NOT (dose > 0 AND coalesce(act <> 'stop', true) AND w IS NULL) AS ok FROM vw2 JOIN blk USING (hid)),
sp2 AS (SELECT b, t AS st, v AS spo2 FROM vit JOIN blk USING (hid) WHERE cat = 'spo2' AND v BETWEEN 50 AND 100),
g1 AS (SELECT f.b, f.t, f.fio2, f.peep, CASE WHEN f.t - st <= {HOUR} THEN spo2 END AS spo2 FROM (SELECT * FROM fs WHERE sc) f ASOF LEFT JOIN sp2 ON sp2.b = f.b AND f.t >= st),
g2 AS (SELECT g1.*, coalesce(ne, 0) AS ne, coalesce(ok, true) AS ok FROM g1 ASOF LEFT JOIN ne ON ne.b = g1.b AND g1.t >= nt),
hf AS (SELECT dd.b, dd.d, t, coalesce(fio2 <= 0.5 AND peep <= 8 AND spo2 >= 88, false) AS oxy, ne <= 0.2 AS vaso, coalesce(fio2 <= 0.5 AND peep <= 8 AND spo2 >= 88, false) AND ne <= 0.2 AS bothf,
   fio2 IS NOT NULL AND peep IS NOT NULL AND spo2 IS NOT NULL AND ok AS known FROM g2 JOIN dd ON dd.b = g2.b AND t >= lo AND t < hi),
{_run("oxy")}, {_run("vaso")}, {_run("bothf")},
hc AS (SELECT b, d, count(*) FILTER (WHERE bothf) AS n_stable, count(*) AS n_sc, count(*) FILTER (WHERE known) AS n_known FROM hf GROUP BY b, d),
ps1 AS (SELECT b, t, dose, act, coalesce(lead(t) OVER (PARTITION BY b ORDER BY t), t + {DAY}) AS e FROM med JOIN blk USING (hid) WHERE drug = 'cisatracurium'),
pl AS (SELECT dd.b, dd.d, count(ps1.t) > 0 AS par FROM dd LEFT JOIN ps1 ON ps1.b = dd.b AND dose > 0 AND act <> 'stop' AND ps1.t < dd.hi AND ps1.e > dd.lo AND ps1.e > ps1.t GROUP BY dd.b, dd.d),
nr AS (SELECT b, t, CASE WHEN dev = 'imv' AND mode IN {_CTRL} THEN 'controlled' WHEN mode = {_SUP} AND (dev = 'cpap' OR ps IS NULL OR ps = 0) AND peep <= 5 THEN 'cpap'
   WHEN mode = {_SUP} AND NOT coalesce(dev = 'cpap' OR ps IS NULL OR ps = 0, false) AND peep <= 8 THEN 'ps' WHEN mode = {_SUP} THEN 'weak' ELSE 'other' END AS c FROM fs WHERE NOT sc),
n1 AS (SELECT *, coalesce(lead(t) OVER w, t + {HOUR}) AS e, CASE WHEN lag(c) OVER w IS NULL OR lag(c) OVER w <> c THEN 1 ELSE 0 END AS chg FROM nr WINDOW w AS (PARTITION BY b ORDER BY t, c)),
n2 AS (SELECT *, sum(chg) OVER (PARTITION BY b ORDER BY t, c) AS ep FROM n1),
n3 AS (SELECT b, ep, min(c) AS c, min(t) AS s, max(e) AS e FROM n2 GROUP BY b, ep),
n4 AS (SELECT *, coalesce(lag(c) OVER (PARTITION BY b ORDER BY ep) = 'controlled', false) AS tr, (e - s) / 60000000.0 AS dur, c IN ('ps', 'cpap') AS lp FROM n3),
se AS (SELECT * FROM n4 WHERE c IN ('ps', 'cpap', 'weak')),
nb AS (SELECT dd.b, dd.d, coalesce(bool_or(tr), false) AS nb_t, coalesce(bool_or(dur >= 2), false) AS nb_d, coalesce(bool_or(lp), false) AS nb_p, coalesce(bool_or(tr AND dur >= 2), false) AS nb_td,
   coalesce(bool_or(tr AND lp), false) AS nb_tp, coalesce(bool_or(dur >= 2 AND lp), false) AS nb_dp, coalesce(bool_or(tr AND dur >= 2 AND lp), false) AS nb_tdp,
   count(*) FILTER (WHERE tr AND lp) AS n_tr, count(*) FILTER (WHERE tr AND lp AND dur >= 2) AS n_trs, coalesce(max(CASE WHEN tr AND lp THEN dur END), 0) AS longest,
   coalesce(string_agg(DISTINCT CASE WHEN tr AND lp THEN c END, ',' ORDER BY CASE WHEN tr AND lp THEN c END), '') AS arms FROM dd LEFT JOIN se ON se.b = dd.b AND se.s >= dd.lo AND se.s < dd.hi GROUP BY dd.b, dd.d),
ms AS (SELECT b, t AS s, mode, coalesce(lead(t) OVER (PARTITION BY b ORDER BY t, sc, mode NULLS FIRST), t + {HOUR}) AS e FROM fs),
sm AS (SELECT dd.b, dd.d, coalesce(sum(CASE WHEN ms.s IS NOT NULL THEN least(ms.e, dd.hi) - greatest(ms.s, dd.lo) END), 0)::DOUBLE / 60000000 AS spent FROM dd LEFT JOIN ms ON ms.b = dd.b AND mode = {_SUP} AND ms.s < dd.hi AND ms.e > dd.lo GROUP BY dd.b, dd.d),
o1 AS (SELECT dd.b, dd.d, unit, unit_name, prior, trach, spont, par, coalesce(long_oxy, false) AS oxy, coalesce(long_vaso, false) AS vaso, coalesce(long_bothf, false) AS stable, coalesce(n_stable, 0) AS n_stable, coalesce(n_sc, 0) AS n_sc,
   coalesce(n_known, 0) AS n_known, nb.* EXCLUDE (b, d), spent FROM dd JOIN pc USING (b, d) JOIN sn USING (b, d) JOIN pl USING (b, d) JOIN nb USING (b, d) JOIN sm USING (b, d)
   LEFT JOIN a_oxy USING (b, d) LEFT JOIN a_vaso USING (b, d) LEFT JOIN a_bothf USING (b, d) LEFT JOIN hc USING (b, d)),
o2 AS (SELECT *, CASE WHEN trach THEN 'excluded_trach' WHEN par THEN 'excluded_paralytic' WHEN prior >= 12 AND stable THEN 'eligible' WHEN prior >= 12 AND n_known = 0 THEN 'not_assessable' ELSE 'not_eligible' END AS status FROM o1),
ob AS (SELECT *, CASE WHEN status <> 'not_eligible' THEN '' WHEN prior < 12 THEN 'lt12h_controlled' WHEN oxy THEN 'failed_vasopressor' ELSE 'failed_oxy_peep' END AS reason,
   strftime(make_timestamp(d * {DAY}), '%Y-%m-%d') AS day, strftime(make_timestamp(d * {DAY}), '%Y-%m') AS month, strftime(make_timestamp(d * {DAY}), '%G-W%V') AS week,
   trach::INT + 2 * par::INT + 4 * (prior >= 12)::INT + 8 * oxy::INT + 16 * vaso::INT + 32 * stable::INT + 64 * spont::INT + 128 * nb_t::INT + 256 * nb_d::INT + 512 * nb_p::INT + 1024 * nb_td::INT + 2048 * nb_tp::INT + 4096 * nb_dp::INT + 8192 * nb_tdp::INT AS mask,
   (SELECT any_value(pid) FROM blk WHERE blk.b = o2.b) AS pid FROM o2)
"""

def sbt_stages(t: Tables):
    tables, graph = stored(t)
    return sbt.stages(tables, CFG.sbt, graph.keep)


@query(
    "sbt_observation",
    _SBT_SQL
    + """SELECT b AS encounter_block, day, unit, prior AS prior_controlled_h, n_stable AS n_stable_hours, n_sc AS n_scaffold_hours, n_known AS n_assessable_hours, status AS eligibility_status, reason AS notelig_reason,
   trach AS db_trach, par AS db_paralytic, prior >= 12 AS db_accrued12, oxy AS db_stable_oxy, vaso AS db_stable_vaso, stable AS db_stable_both, spont AS on_spontaneous, nb_t, nb_d, nb_p, nb_td, nb_tp, nb_dp, nb_tdp,
   n_tr AS n_transitions, n_trs AS n_transitions_strict, round(longest, 6) AS longest_support_min, CASE WHEN arms = 'cpap,ps' THEN 'both' ELSE arms END AS sbt_arm, round(spent, 6) AS spont_minutes FROM ob""",
)
def sbt_observation(t: Tables):
    out = sbt_stages(t)["observation"]
    cols = ["encounter_block", "day", "unit", "prior_controlled_h", "n_stable_hours", "n_scaffold_hours", "n_assessable_hours", "eligibility_status", "notelig_reason"]
    cols += [*sbt.MASK_BITS, "n_transitions", "n_transitions_strict", "longest_support_min", "sbt_arm", "spont_minutes"]
    return text_day(out).select(*cols).withColumns({c: F.round(c, 6) for c in ("longest_support_min", "spont_minutes")})


@query(
    "sbt_slices",
    _SBT_SQL
    + ", "
    + _SLICES
    + """SELECT unit, dim, granularity, period, count(*) AS n_vent_days, count(*) FILTER (WHERE status <> 'excluded_trach') AS n_nontrach, count(*) FILTER (WHERE status = 'eligible') AS n_eligible,
   count(*) FILTER (WHERE status = 'eligible' AND NOT (spont AND NOT nb_t)) AS n_eligible_txcand, count(*) FILTER (WHERE status = 'not_assessable') AS n_not_assessable, count(*) FILTER (WHERE reason = 'lt12h_controlled') AS n_notelig_lt12h,
   count(*) FILTER (WHERE status = 'eligible' AND nb_tdp) AS n_sbt, count(*) FILTER (WHERE nb_tp) AS n_sbtany_all, count(*) FILTER (WHERE status = 'eligible' AND spont) AS n_spont_elig,
   count(DISTINCT pid) AS n_pts, count(DISTINCT CASE WHEN status = 'eligible' THEN pid END) AS n_pts_elig, count(DISTINCT CASE WHEN nb_tdp THEN pid END) AS n_pts_strict_all, count(DISTINCT CASE WHEN spont THEN pid END) AS n_pts_spont_all FROM sl GROUP BY ALL""",
)
def sbt_slices(t: Tables):
    cube = sbt.slices(sbt_stages(t)["observation"])
    shown = ["n_vent_days", "n_nontrach", "n_eligible", "n_eligible_txcand", "n_not_assessable", "n_notelig_lt12h", "n_sbt", "n_sbtany_all", "n_spont_elig"]
    return cube.select("unit", "dim", "granularity", "period", *shown, "n_pts", "n_pts_elig", "n_pts_strict_all", "n_pts_spont_all")


@query(
    "sbt_masks",
    _SBT_SQL + ", " + _SLICES + "SELECT unit, dim, granularity, period, mask::BIGINT AS mask, count(*) AS count FROM sl GROUP BY ALL",
)
def sbt_masks(t: Tables):
    return sbt.mask_table(sbt_stages(t)["observation"]).drop("parent")


# ---------------------------------------------------------------- proning

# milder limits than the measure's own, so that the derived tables reach every outcome
PRONE = replace(CFG.proning, onset_peep_min=1.0, onset_fio2_min=0.32, pf_max=250.0, fio2_min=0.32, peep_min=1.0)

_PRONE_SQL = _FILLED + f""",
f0 AS (SELECT b, hid, t, sc, dev, fio2, peep FROM fl WHERE hid IN (SELECT hid FROM lab)),
sc0 AS (SELECT CASE WHEN quantile_cont(fio2, 0.95) > 1.5 THEN 100.0 ELSE 1.0 END AS k FROM f0),
f1 AS (SELECT b, t AS ft, sc, dev, CASE WHEN fio2 / k BETWEEN 0.15::DOUBLE AND 1 THEN fio2 / k END AS fio2, CASE WHEN peep BETWEEN 0 AND 40 THEN peep END AS peep FROM f0, sc0),
ga AS (SELECT b, lab.hid, col_t AS t, v FROM lab JOIN blk USING (hid) WHERE v > 0),
gb AS (SELECT ga.*, dev, fio2, peep, v / fio2 AS pf FROM ga ASOF LEFT JOIN f1 ON f1.b = ga.b AND ga.t >= ft WHERE ga.t - ft <= {6 * HOUR} AND fio2 IS NOT NULL),
gc AS (SELECT gb.*, i FROM gb JOIN icu ON icu.b = gb.b AND t BETWEEN i AND o WHERE pf BETWEEN 10 AND 1000),
gd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY b, t ORDER BY i, hid, v) AS rn FROM gc) WHERE rn = 1),
t0b AS (SELECT * FROM (SELECT gd.*, pid, row_number() OVER (PARTITION BY gd.b ORDER BY t, gd.hid) AS r2 FROM gd JOIN blk ON blk.hid = gd.hid WHERE dev = 'imv' AND peep >= 1 AND fio2 >= 0.32::DOUBLE AND pf <= 300 AND age >= 18) WHERE r2 = 1),
t0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY t, b) AS r3 FROM t0b) WHERE r3 = 1),
me AS (SELECT gd.b, gd.t, gd.dev = 'imv' AND gd.peep >= 1 AND gd.fio2 >= 0.32::DOUBLE AND gd.pf <= 250 AS m FROM gd JOIN t0 ON t0.b = gd.b AND gd.t >= t0.t),
tf AS (SELECT b, min(t) AS tf FROM me WHERE m GROUP BY b),
ag AS (SELECT t0.b, max(me.t) FILTER (WHERE m) >= any_value(tf) + {12 * HOUR} AS again, count(*) FILTER (WHERE m AND me.t <= tf + {12 * HOUR}) AS n FROM t0 JOIN tf USING (b) JOIN me USING (b) GROUP BY t0.b),
br AS (SELECT DISTINCT tf.b FROM tf JOIN f1 ON f1.b = tf.b AND ft > tf AND ft <= tf + {12 * HOUR} AND dev <> 'imv'),
pe AS (SELECT t0.pid, t0.b, t0.hid, t0.t AS t0, pf, coalesce(again AND br.b IS NULL, false) AS eligible, tf, n,
   CASE WHEN tf IS NULL THEN 'no ABG meets PROSEVA-strict thresholds' WHEN NOT again THEN 'qualifying ABG at T_first but no qualifying ABG ≥12h later (weaned, extubated, or no ABG coverage)'
   WHEN br.b IS NOT NULL THEN 'extubation event during 12h stabilization window' END AS reason FROM t0 LEFT JOIN tf ON tf.b = t0.b LEFT JOIN ag ON ag.b = t0.b LEFT JOIN br ON br.b = t0.b)
"""
_SESSIONS = """
pk AS (SELECT * FROM pos WHERE p <> 'chair'),
pr AS (SELECT *, lag(p) OVER (PARTITION BY hid ORDER BY t) AS was FROM pk),
po AS (SELECT hid, t FROM pr WHERE p = 'prone' AND (was IS NULL OR was <> 'prone')), pcl AS (SELECT hid, t FROM pr WHERE p = 'not_prone' AND was = 'prone'),
pla AS (SELECT hid, max(t) AS t FROM pk WHERE p = 'prone' GROUP BY hid),
pj AS (SELECT po.hid, po.t AS s, min(pcl.t) AS e FROM po LEFT JOIN pcl ON pcl.hid = po.hid AND pcl.t >= po.t GROUP BY po.hid, po.t),
ses AS (SELECT pj.hid, s, (coalesce(e, pla.t) - s) / 3600000000.0 AS h FROM pj JOIN pla USING (hid))
"""

def proning_stages(t: Tables):
    tables, graph = stored(t)
    return proning.stages(tables, PRONE, graph.keep)


@query(
    "proning_eligibility",
    _PRONE_SQL
    + f"""SELECT pid AS patient_id, b AS encounter_block, t0, round(pf, 6) AS pf_at_t0, eligible, CASE WHEN eligible THEN tf END AS t_first, CASE WHEN eligible THEN tf + {12 * HOUR} END AS t_eligible,
   CASE WHEN eligible THEN n ELSE 0 END AS n_qualifying, reason AS ineligibility_reason FROM pe""",
)
def proning_eligibility(t: Tables):
    elig = proning_stages(t)["eligibility"]
    cols = ["patient_id", "encounter_block", "t0", "pf_at_t0", "eligible", "t_first", "t_eligible", "n_qualifying", "ineligibility_reason"]
    return elig.select(*cols).withColumn("pf_at_t0", F.round("pf_at_t0", 6))


@query(
    "prone_sessions",
    f"""WITH {SQL.strip()}, k AS (SELECT * FROM pos WHERE p <> 'chair'),
r AS (SELECT *, lag(p) OVER (PARTITION BY hid ORDER BY t) AS was FROM k),
o AS (SELECT hid, t FROM r WHERE p = 'prone' AND (was IS NULL OR was <> 'prone')), c AS (SELECT hid, t FROM r WHERE p = 'not_prone' AND was = 'prone'),
l AS (SELECT hid, max(t) AS t FROM k WHERE p = 'prone' GROUP BY hid),
j AS (SELECT o.hid, o.t AS s, min(c.t) AS e FROM o LEFT JOIN c ON c.hid = o.hid AND c.t >= o.t GROUP BY o.hid, o.t)
SELECT j.hid AS hospitalization_id, s AS "start", coalesce(e, l.t) AS "end", (coalesce(e, l.t) - s) / 3600000000.0 AS duration_hours,
  CASE WHEN e IS NULL THEN 'end_of_record' ELSE 'not_prone' END AS ended_by FROM j JOIN l USING (hid)""",
)
def prone_sessions(t: Tables):
    pos = icu_tables(t)["position"]
    rows = pos.where(F.col("position_category").isin("prone", "not_prone")).select(
        "hospitalization_id", F.unix_micros("recorded_dttm").alias("at"), "position_category"
    )
    return proning.sessions(rows)


@query(
    "proning_slices",
    _PRONE_SQL
    + ", "
    + _SESSIONS.strip()
    + f""", pv AS (SELECT pe.b, any_value(pe.tf) + {12 * HOUR} AS te, bool_or(pk2.hid IS NOT NULL) AS seen, count(ses.s) > 0 AS prone, coalesce(bool_or(h >= 16), false) AS good, min(ses.s) AS fp
   FROM pe JOIN blk ON blk.b = pe.b LEFT JOIN (SELECT DISTINCT hid FROM pk) pk2 ON pk2.hid = blk.hid LEFT JOIN ses ON ses.hid = blk.hid WHERE eligible GROUP BY pe.b),
pu AS (SELECT * FROM (SELECT pv.*, icu.unit, icu.un, row_number() OVER (PARTITION BY pv.b ORDER BY i) AS rn FROM pv LEFT JOIN icu ON icu.b = pv.b AND te BETWEEN i AND o) WHERE rn = 1),
ob AS (SELECT b, seen, prone, good, (fp - te) / 3600000000.0 AS ttp, coalesce(unit, 'unknown') AS unit, coalesce(un, 'unknown') AS unit_name, strftime(make_timestamp(te), '%Y') AS year, strftime(make_timestamp(te), '%Y-%m') AS month, strftime(make_timestamp(te), '%G-W%V') AS week FROM pu),
"""
    + _SLICES.replace("FROM ob),", "FROM ob UNION ALL SELECT *, 'year', year FROM ob),")
    + """SELECT unit, dim, granularity, period, count(*) AS n_eligible, count(*) FILTER (WHERE prone) AS n_ever_proned, count(*) FILTER (WHERE good) AS n_adherent, count(*) FILTER (WHERE seen) AS n_documented,
   round(quantile_cont(ttp, 0.25), 6) AS ttp_q1_h, round(median(ttp), 6) AS ttp_median_h, round(quantile_cont(ttp, 0.75), 6) AS ttp_q3_h FROM sl GROUP BY ALL""",
)
def proning_slices(t: Tables):
    cube = proning.slices(proning_stages(t)["placed"], PRONE)
    times = ["ttp_q1_h", "ttp_median_h", "ttp_q3_h"]
    cols = ["unit", "dim", "granularity", "period", "n_eligible", "n_ever_proned", "n_adherent", "n_documented"]
    return cube.select(*cols, *[F.round(c, 6).alias(c) for c in times])


# ---------------------------------------------------------------- feeds

def parsed_lpv_feed(t: Tables):
    """The ventilation feed as JSON text, parsed and validated again as the combiner would."""
    text = lpv.feed(cut_lineage(lpv_cube(t)), SITE, CFG.lpv, "2024-02-01T00:00")
    return feeds.valid_feeds(feeds.parse_feeds(cut_lineage(text)))


_FEED = (
    _LPV
    + """, gr AS (SELECT *, 'all' AS granularity, 'all' AS period FROM ss UNION ALL SELECT *, 'month', month FROM ss UNION ALL SELECT *, 'week', week FROM ss),
hd AS (SELECT *, '__ALL__' AS unit FROM gr UNION ALL SELECT *, u FROM gr WHERE u IN ('medical_icu', 'mixed_cardiothoracic_icu', 'surgical_icu', 'mixed_neuro_icu', 'general_icu', 'burn_icu') UNION ALL SELECT *, un FROM gr WHERE un <> 'unknown'),
cb AS (SELECT unit, period, count(*) AS n, CAST(round_even(sum(total_us) / 3600000000.0, 0) AS DOUBLE) AS hrs, count(*) FILTER (WHERE vt8_status = 'adherent') AS n1, count(*) FILTER (WHERE vt8_status <> 'not_assessable') AS d1,
   count(*) FILTER (WHERE plat_status = 'adherent') AS n2, count(*) FILTER (WHERE plat_status <> 'not_assessable') AS d2, count(*) FILTER (WHERE dp_status = 'adherent') AS n3, count(*) FILTER (WHERE dp_status <> 'not_assessable') AS d3,
   count(*) FILTER (WHERE severity = 'severe' AND vt8_status = 'adherent') AS n4, count(*) FILTER (WHERE severity = 'severe' AND vt8_status <> 'not_assessable') AS d4 FROM hd GROUP BY unit, period),
cells AS (SELECT 'lpv' AS metric_id, 'headline' AS part, unit, period, n1 AS num, d1 AS den, n, hrs FROM cb UNION ALL SELECT 'lpv', 'plat', unit, period, n2, d2, NULL, NULL FROM cb
   UNION ALL SELECT 'lpv', 'dp', unit, period, n3, d3, NULL, NULL FROM cb UNION ALL SELECT 'lpv', 'vt8sev', unit, period, n4, d4, NULL, NULL FROM cb)
"""
)


@query("lpv_feed_cells", _FEED + "SELECT * FROM cells")
def lpv_feed_cells(t: Tables):
    return feeds.feed_cells(parsed_lpv_feed(t)).select("metric_id", "part", "unit", "period", "num", "den", "n", "hrs")


@query(
    "pooled_feed",
    _FEED
    + "SELECT metric_id, 'lpv-v1' AS definition_version, part, period, 1::BIGINT AS n_sites, num, den, false AS drift, round(CASE WHEN den > 0 THEN num / den END, 6) AS rate FROM cells WHERE unit = '__ALL__'",
)
def pooled_feed(t: Tables):
    pooled = feeds.pool_sites(feeds.feed_cells(parsed_lpv_feed(t)))
    return pooled.withColumn("rate", F.round("rate", 6))
