"""Queries for runs, episodes, sessions, step sums, scaffold and stitching."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuqm.catalog.base import DAY, HOUR, LINE, Tables, query
from icuqm.catalog.timeline import _GAPS, _SEG, _UNION, _WINDOWS, active_ab, day_windows, drug_segments
from icuqm.functions.time import local_day, micros
from icuqm.operators.episodes import bookend_sessions, episodes, first_event, next_event, persists, runs, transitions
from icuqm.operators.grid import hourly_scaffold, stitch_stays, time_grid
from icuqm.operators.intervals import off_gaps
from icuqm.operators.steps import normalise_dose, ratio_around_gap, sample_steps, sum_steps

_CLS = f"""
WITH {LINE},
k AS (SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 'support' WHEN event_type = 'purchase' THEN 'controlled' ELSE 'other' END AS cls FROM line),
r AS (SELECT *, lag(cls) OVER w AS was, lag(us) OVER w AS was_us, lead(us) OVER w AS nx FROM k WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
ids AS (SELECT *, sum(CASE WHEN was IS NULL OR was <> cls THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id) AS ep FROM r),
eps0 AS (SELECT user_id, ep, min(cls) AS cls, min(us) AS s, max(coalesce(nx, us + {HOUR})) AS e FROM ids GROUP BY user_id, ep),
eps AS (SELECT *, lag(cls) OVER (PARTITION BY user_id ORDER BY s, ep) AS prev_cls FROM eps0)
"""


def classed(t: Tables):
    kind = F.col("event_type")
    cls = F.when(kind.isin("view", "click"), "support").when(kind == "purchase", "controlled").otherwise("other")
    return t.line.withColumn("cls", cls)


@query("state_episodes", _CLS + 'SELECT user_id, cls, prev_cls, s AS "start", e AS "end" FROM eps')
def eps(t: Tables):
    return episodes(classed(t), ["user_id"], "us", "cls", tiebreak=["event_id"]).drop("closed")


@query(
    "state_transitions",
    _CLS + "SELECT user_id, s AS \"start\", (e - s) / 60000000.0 AS minutes FROM eps WHERE cls = 'support' AND prev_cls = 'controlled'",
)
def trans(t: Tables):
    found = transitions(episodes(classed(t), ["user_id"], "us", "cls", tiebreak=["event_id"]), "cls", ["support"], ["controlled"])
    return found.select("user_id", "start", "minutes")


@query(
    "flag_runs",
    f"""WITH {LINE},
k AS (SELECT *, value <= 40 AS low FROM line),
r AS (SELECT *, lag(low) OVER w AS was, lag(us) OVER w AS was_us FROM k WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
ids AS (SELECT *, sum(CASE WHEN was IS NULL OR was <> low OR us - was_us > {12 * HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id) AS run FROM r)
SELECT user_id, min(us) AS run_start, max(us) AS run_end, bool_or(low) AS low, count(*) AS run_size FROM ids GROUP BY user_id, run""",
)
def flag_runs(t: Tables):
    rows = t.line.withColumn("low", F.col("value") <= 40)
    return runs(rows, ["user_id"], "us", "low", 12 * HOUR, ["event_id"])


@query(
    "bookend_sessions",
    f"""WITH {LINE},
k AS (SELECT * FROM line WHERE event_type IN ('signup', 'error')),
r AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY us, event_id) AS was FROM k),
o AS (SELECT user_id, us FROM r WHERE event_type = 'signup' AND (was IS NULL OR was = 'error')),
c AS (SELECT user_id, us FROM r WHERE event_type = 'error' AND was = 'signup'),
l AS (SELECT user_id, max(us) AS us FROM k WHERE event_type = 'signup' GROUP BY user_id),
j AS (SELECT o.user_id, o.us AS s, min(c.us) AS e FROM o LEFT JOIN c ON c.user_id = o.user_id AND c.us >= o.us GROUP BY o.user_id, o.us)
SELECT j.user_id, j.s AS "start", coalesce(j.e, l.us) AS "end", (coalesce(j.e, l.us) - j.s) / 3600000000.0 AS duration_hours,
  CASE WHEN j.e IS NULL THEN 'end_of_record' ELSE 'error' END AS ended_by FROM j JOIN l USING (user_id)""",
)
def sessions(t: Tables):
    return bookend_sessions(t.line, ["user_id"], "us", "event_type", "signup", "error", ["event_id"])


@query(
    "next_error",
    f"""WITH {LINE},
e AS (SELECT user_id, us FROM line WHERE event_type = 'error'),
p AS (SELECT * FROM line WHERE event_type <> 'error')
SELECT p.event_id, p.user_id, e.us AS next_error FROM p ASOF LEFT JOIN e ON p.user_id = e.user_id AND p.us <= e.us""",
)
def error_after(t: Tables):
    out = next_event(t.line, ["user_id"], "us", F.col("event_type") == "error", "next_error", ["event_id"])
    return out.where("event_type <> 'error'").select("event_id", "user_id", "next_error")


@query(
    "first_large_event",
    f"""WITH {LINE}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS rn FROM line WHERE value > 100 AND event_type <> 'error')
SELECT user_id, event_id, us, event_type, value FROM r WHERE rn = 1""",
)
def onset(t: Tables):
    return first_event(t.line, ["user_id"], "us", (F.col("value") > 100) & (F.col("event_type") != "error"), ["event_id"]).select(
        "user_id", "event_id", "us", "event_type", "value"
    )


@query(
    "persistence",
    f"""WITH {LINE},
e AS (SELECT *, value >= 60 AS meets FROM line WHERE event_type <> 'error'),
f AS (SELECT user_id, min(us) AS t0 FROM e WHERE meets GROUP BY user_id),
c AS (SELECT e.user_id, count(*) AS n_events, any_value(f.t0) AS first_met, coalesce(bool_or(e.meets AND e.us >= f.t0 + {12 * HOUR}), false) AS met_again,
   count(CASE WHEN e.meets AND e.us <= f.t0 + {12 * HOUR} THEN 1 END) AS n_in_window
   FROM e LEFT JOIN f USING (user_id) GROUP BY e.user_id),
b AS (SELECT DISTINCT f.user_id FROM f JOIN line l ON l.user_id = f.user_id AND l.event_type = 'error' AND l.us > f.t0 AND l.us <= f.t0 + {12 * HOUR})
SELECT c.user_id, n_events, first_met, met_again, b.user_id IS NOT NULL AS broken, n_in_window,
  first_met IS NOT NULL AND met_again AND b.user_id IS NULL AS persistent
FROM c LEFT JOIN b ON b.user_id = c.user_id""",
)
def persistence(t: Tables):
    ev = t.line.where("event_type <> 'error'").withColumn("meets", F.col("value") >= 60)
    st = t.line.withColumn("off", F.col("event_type") == "error")
    return persists(ev, st, ["user_id"], "us", "meets", 12 * HOUR, "off")


_SUM = """
h AS (SELECT DISTINCT user_id, s AS t FROM seg),
tot AS (SELECT h.user_id, h.t, coalesce(sum(CASE WHEN g.s <= h.t AND h.t < g.e THEN g.value END), 0) AS total,
   coalesce(bool_and(CASE WHEN g.s <= h.t AND h.t < g.e THEN g.value >= 1 END), true) AS assessable
   FROM h LEFT JOIN seg g ON g.user_id = h.user_id GROUP BY h.user_id, h.t)
"""


@query("sum_of_steps", _SEG + "," + _SUM + "SELECT user_id, t, round(total, 6) AS total, assessable FROM tot")
def step_sum(t: Tables):
    segs = drug_segments(t).withColumn("known", F.col("value") >= 1)
    return sum_steps(segs, ["user_id"], "drug", ["a", "b", "c"], "value", "known").withColumn("total", F.round("total", 6))


@query(
    "sampled_steps",
    _SEG
    + ","
    + _SUM
    + f""",g AS (SELECT user_id, unnest(generate_series(min(us) // {DAY} * {DAY}, max(us) // {DAY} * {DAY}, {6 * HOUR})) AS at_us FROM line GROUP BY user_id)
SELECT g.user_id, g.at_us, round(coalesce(tot.total, 0), 6) AS total, coalesce(tot.assessable, true) AS assessable
FROM g ASOF LEFT JOIN tot ON g.user_id = tot.user_id AND g.at_us >= tot.t""",
)
def step_samples(t: Tables):
    segs = drug_segments(t).withColumn("known", F.col("value") >= 1)
    steps = sum_steps(segs, ["user_id"], "drug", ["a", "b", "c"], "value", "known")
    day = F.unix_micros(F.date_trunc("day", F.timestamp_micros("us")))
    ends = t.line.groupBy("user_id").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    grid = time_grid(ends, ["user_id"], "lo", "hi", 6 * HOUR)
    out = sample_steps(grid, steps, ["user_id"], "at", "t", {"total": 0.0, "assessable": True})
    return out.select("user_id", F.col("at").alias("at_us"), F.round("total", 6).alias("total"), "assessable")


@query(
    "normalised_dose",
    f"""WITH {LINE},
d AS (SELECT *, CASE event_type WHEN 'view' THEN 'norepinephrine' WHEN 'click' THEN 'phenylephrine' WHEN 'signup' THEN 'vasopressin' ELSE 'milrinone' END AS drug,
   CASE event_type WHEN 'view' THEN 'mcg/min' WHEN 'click' THEN 'mg/hr' WHEN 'signup' THEN 'u/hr' ELSE 'mcg/kg/min' END AS unit FROM line WHERE event_type <> 'purchase'),
w AS (SELECT user_id, us AS w_us, 40 + value AS weight_kg FROM line WHERE event_type = 'purchase'),
j AS (SELECT d.*, w.weight_kg FROM d ASOF LEFT JOIN w ON d.user_id = w.user_id AND d.us >= w.w_us),
b AS (SELECT *, value * CASE unit WHEN 'mcg/min' THEN 1.0 WHEN 'mg/hr' THEN 1000.0 / 60 WHEN 'u/hr' THEN 1.0 / 60 ELSE 1.0 END AS base,
   CASE drug WHEN 'norepinephrine' THEN 1.0 WHEN 'phenylephrine' THEN 0.1 WHEN 'vasopressin' THEN 2.5 ELSE 0.0 END AS factor,
   unit = 'mcg/kg/min' OR drug = 'vasopressin' AS direct, value < 3 AS stop FROM j)
SELECT event_id, user_id, drug, round(CASE WHEN base > 0 AND NOT stop THEN factor * CASE WHEN direct THEN base ELSE base / weight_kg END ELSE 0 END, 6) AS equivalent,
  NOT (base > 0 AND NOT stop AND factor > 0 AND NOT direct AND weight_kg IS NULL) AS assessable FROM b""",
)
def doses(t: Tables):
    kind = F.col("event_type")
    drug = F.when(kind == "view", "norepinephrine").when(kind == "click", "phenylephrine").when(kind == "signup", "vasopressin").otherwise("milrinone")
    unit = F.when(kind == "view", "mcg/min").when(kind == "click", "mg/hr").when(kind == "signup", "u/hr").otherwise("mcg/kg/min")
    rows = t.line.where("event_type <> 'purchase'").withColumns({"drug": drug, "unit": unit})
    weights = t.line.where("event_type = 'purchase'").select("user_id", F.col("us").alias("w_us"), (F.col("value") + 40).alias("weight_kg"))
    out = normalise_dose(
        rows,
        weights,
        ["user_id"],
        "us",
        "w_us",
        "drug",
        "value",
        "unit",
        F.col("value") < 3,
        {"norepinephrine": 1.0, "phenylephrine": 0.1, "vasopressin": 2.5, "milrinone": 0.0},
        {"mcg/min": (1.0, False), "mg/hr": (1000.0 / 60, False), "u/hr": (1.0 / 60, False), "mcg/kg/min": (1.0, True)},
        ["vasopressin"],
    )
    return out.select("event_id", "user_id", "drug", F.round("equivalent", 6).alias("equivalent"), "assessable")


@query(
    "dose_ratio_around_gap",
    _SEG
    + ","
    + _UNION
    + ","
    + _WINDOWS
    + ","
    + _GAPS
    + """,fg AS (SELECT user_id, d, min(gap_start) AS gap_start, min_by(gap_end, gap_start) AS gap_end FROM gaps WHERE resumed AND gap_end - gap_start >= 1800000000 GROUP BY user_id, d),
x AS (SELECT f.*, w.hi, g.drug, g.s, g.value FROM fg f JOIN wn w USING (user_id, d) JOIN seg g ON g.user_id = f.user_id AND g.active AND g.drug IN ('a', 'b')),
pr AS (SELECT user_id, d, drug, max_by(value, s) FILTER (WHERE s < gap_start) AS pre_rate, min_by(value, s) FILTER (WHERE s >= gap_end AND s <= hi) AS post_rate FROM x GROUP BY user_id, d, drug)
SELECT user_id, strftime(make_timestamp(d), '%Y-%m-%d') AS day, drug, pre_rate, post_rate, round(post_rate / pre_rate, 6) AS ratio FROM pr WHERE pre_rate > 0 AND post_rate IS NOT NULL""",
)
def dose_ratio(t: Tables):
    wins = day_windows(t)
    found = off_gaps(active_ab(t), wins, ["user_id"], ["day"], ("start", "end"), ("lo", "hi"))
    first = (
        found.where("resumed and gap_end - gap_start >= 1800000000")
        .groupBy("user_id", "day")
        .agg(F.min("gap_start").alias("gap_start"), F.min_by("gap_end", "gap_start").alias("gap_end"))
        .join(wins.select("user_id", "day", "hi"), ["user_id", "day"])
    )
    segs = drug_segments(t).where("active").select("user_id", "drug", "start", "value")
    out = ratio_around_gap(first, segs, ["user_id"], ["day"], "drug", ["a", "b"], "value", "hi")
    return out.select("user_id", F.col("day").cast("string").alias("day"), "drug", "pre_rate", "post_rate", F.round("ratio", 6).alias("ratio"))


@query(
    "hourly_scaffold",
    f"""WITH {LINE},
n AS (SELECT user_id, us AS t_us, CASE WHEN event_type = 'view' THEN value END AS setting, false AS sc FROM line),
e AS (SELECT user_id, min(t_us) // {HOUR} * {HOUR} AS lo, max(t_us) // {HOUR} * {HOUR} AS hi FROM n GROUP BY user_id),
g AS (SELECT user_id, unnest(generate_series(lo, hi, {HOUR})) + {HOUR - 1_000_000} AS t_us, CAST(NULL AS DOUBLE) AS setting, true AS sc FROM e),
f AS (SELECT user_id, t_us, sc, last_value(setting IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t_us, sc ROWS UNBOUNDED PRECEDING) AS setting
   FROM (SELECT * FROM n UNION ALL SELECT * FROM g))
SELECT user_id, strftime(make_timestamp(t_us), '%Y-%m-%d') AS day, sum(CASE WHEN sc THEN 1 ELSE 0 END)::BIGINT AS n_scaffold,
  sum(CASE WHEN sc THEN 0 ELSE 1 END)::BIGINT AS n_native, count(setting) AS n_filled, round(coalesce(sum(setting), 0), 6) AS total FROM f GROUP BY 1, 2""",
)
def scaffold(t: Tables):
    rows = t.line.select("user_id", "us", F.when(F.col("event_type") == "view", F.col("value")).alias("setting"))
    grid = hourly_scaffold(rows, ["user_id"], "us", ["setting"])
    return grid.groupBy("user_id", local_day(F.col("at")).cast("string").alias("day")).agg(
        F.count_if("is_scaffold").alias("n_scaffold"),
        F.count_if(~F.col("is_scaffold")).alias("n_native"),
        F.count("setting").alias("n_filled"),
        F.round(F.coalesce(F.sum("setting"), F.lit(0.0)), 6).alias("total"),
    )


@query(
    "stitched_stays",
    f"""WITH o AS (SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS s, epoch_us(o_orderdate) + CAST(o_totalprice / 5000 AS BIGINT) * {DAY} AS e FROM orders),
r AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o),
b AS (SELECT *, sum(CASE WHEN reach IS NULL OR s - reach > {30 * DAY} THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY s, o_orderkey) AS g FROM r)
SELECT o_custkey, o_orderkey, first_value(o_orderkey) OVER (PARTITION BY o_custkey, g ORDER BY s, o_orderkey)::VARCHAR AS encounter_block FROM b""",
)
def stitched(t: Tables):
    o = t.orders
    rows = o.select("o_custkey", "o_orderkey", micros(o, "o_orderdate").alias("s"), "o_totalprice").withColumn(
        "e", F.col("s") + F.bround(F.col("o_totalprice") / 5000).cast("bigint") * F.lit(DAY)
    )
    return stitch_stays(rows, "o_custkey", "o_orderkey", "s", "e", 30 * DAY, 365 * DAY).select("o_custkey", "o_orderkey", "encounter_block")
