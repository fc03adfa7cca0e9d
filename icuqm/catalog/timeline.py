"""Queries for the as-of, carry-forward, interval and day-split operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuqm.catalog.base import DAY, HOUR, LINE, Tables, query
from icuqm.functions.time import local_day
from icuqm.operators.asof import asof_contained, asof_join
from icuqm.operators.intervals import (
    cadence,
    carry_forward,
    count_before,
    lead_intervals,
    off_gaps,
    qualify_holds,
    split_by_day,
    step_segments,
    union_intervals,
)


def of_type(t: Tables, kind: str, prefix: str):
    rows = t.line.where(F.col("event_type") == kind)
    return rows.select("user_id", F.col("us").alias(f"{prefix}_us"), F.col("event_id").alias(f"{prefix}_id"), F.col("value").alias(f"{prefix}_value"))


_ASOF = f"""
WITH {LINE},
p AS (SELECT * FROM line WHERE event_type = 'purchase'),
v AS (SELECT * FROM line WHERE event_type = 'view'),
j AS (SELECT p.event_id AS p_id, p.user_id, p.us AS p_us, v.event_id AS v_id, v.us AS v_us, v.value AS v_value
      FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.us >= v.us)
"""


@query("asof_latest_view", _ASOF + "SELECT user_id, p_id, p_us, v_us, v_id, v_value FROM j")
def asof_latest_view(t: Tables):
    out = asof_join(of_type(t, "purchase", "p"), of_type(t, "view", "v"), ["user_id"], "p_us", "v_us", tiebreak=["v_id"])
    return out.select("user_id", "p_id", "p_us", "v_us", "v_id", "v_value")


@query(
    "asof_view_within_4h",
    _ASOF
    + f"""SELECT user_id, p_id, p_us, CASE WHEN p_us - v_us <= {4 * HOUR} THEN v_us END AS v_us,
    CASE WHEN p_us - v_us <= {4 * HOUR} THEN v_id END AS v_id,
    CASE WHEN p_us - v_us <= {4 * HOUR} THEN v_value END AS v_value FROM j""",
)
def asof_view_within_4h(t: Tables):
    out = asof_join(
        of_type(t, "purchase", "p"), of_type(t, "view", "v"), ["user_id"], "p_us", "v_us", tolerance=4 * HOUR, tiebreak=["v_id"]
    )
    return out.select("user_id", "p_id", "p_us", "v_us", "v_id", "v_value")


@query(
    "asof_contained_stay",
    f"""
WITH {LINE},
s AS (SELECT user_id, event_id AS stay_id, us AS s_us, us + CAST(value * 3600000000 AS BIGINT) AS e_us
      FROM line WHERE event_type = 'signup'),
p AS (SELECT * FROM line WHERE event_type <> 'signup')
SELECT p.user_id, p.event_id, s.stay_id, coalesce(p.us < s.e_us, false) AS in_stay
FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.us >= s.s_us""",
)
def asof_contained_stay(t: Tables):
    stays = t.line.where("event_type = 'signup'").select(
        "user_id",
        F.col("event_id").alias("stay_id"),
        F.col("us").alias("s_us"),
        (F.col("us") + F.round(F.col("value") * F.lit(3600000000)).cast("bigint")).alias("e_us"),
    )
    points = t.line.where("event_type <> 'signup'").select("user_id", "event_id", "us")
    out = asof_contained(points, stays, ["user_id"], "us", "s_us", "e_us", "in_stay", ["stay_id"])
    return out.select("user_id", "event_id", "stay_id", "in_stay")


_CARRY = f"""
WITH {LINE},
m AS (SELECT *, CASE WHEN event_type = 'click' THEN value END AS c, CASE WHEN event_type = 'click' THEN us END AS c_us,
             CASE WHEN event_type IN ('click', 'view') THEN value END AS w
      FROM line),
s AS (SELECT *,
   last_value(c IGNORE NULLS) OVER w0 AS c_last, last_value(c_us IGNORE NULLS) OVER w0 AS c_at
   FROM m WINDOW w0 AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING))
"""


@query(
    "carry_forward_2h",
    _CARRY + f"SELECT event_id, user_id, CASE WHEN us - c_at <= {2 * HOUR} THEN c_last END AS carried, c_last AS unlimited FROM s",
)
def carry_forward_2h(t: Tables):
    click = F.when(F.col("event_type") == "click", F.col("value"))
    out = carry_forward(t.line, ["user_id"], "us", {"carried": (click, 2 * HOUR), "unlimited": (click, None)}, ["event_id"])
    return out.select("event_id", "user_id", "carried", "unlimited")


@query(
    "carry_concurrent_6h",
    f"""
WITH {LINE},
m AS (SELECT *, CASE WHEN event_type = 'purchase' THEN value END AS plat,
   CASE WHEN event_type IN ('purchase', 'view') THEN value / 2 END AS peep FROM line),
k AS (SELECT *, CASE WHEN plat IS NOT NULL AND peep IS NOT NULL THEN us END AS plat_us,
   CASE WHEN plat IS NOT NULL THEN peep END AS peep_at FROM m),
s AS (SELECT *, last_value(peep_at IGNORE NULLS) OVER w AS v, last_value(plat_us IGNORE NULLS) OVER w AS v_at FROM k
   WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, user_id, CASE WHEN us - v_at <= {6 * HOUR} THEN v END AS peep_with_plateau FROM s""",
)
def carry_concurrent_6h(t: Tables):
    peep = F.when(F.col("event_type").isin("purchase", "view"), F.col("value") / 2)
    plateau = F.when(F.col("event_type") == "purchase", F.col("value"))
    out = carry_forward(
        t.line, ["user_id"], "us", {"peep_with_plateau": (F.when(plateau.isNotNull(), peep), 6 * HOUR)}, ["event_id"]
    )
    return out.select("event_id", "user_id", "peep_with_plateau")


_LEAD = f"""
WITH {LINE},
n AS (SELECT *, lead(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS nx FROM line),
iv AS (SELECT event_id, user_id, event_type, value, us AS s,
   CASE WHEN nx - us <= {DAY} THEN nx ELSE us + {HOUR} END AS e FROM n)
"""


@query("lead_intervals", _LEAD + 'SELECT event_id, user_id, s AS "start", e AS "end" FROM iv')
def lead(t: Tables):
    return lead_intervals(t.line, ["user_id"], "us", tiebreak=["event_id"]).select("event_id", "user_id", "start", "end")


# days touched by [s, e), as microseconds of the day's midnight
_DAYS = f"""
pieces AS (SELECT event_id, user_id, event_type, value, d,
   greatest(s, d) AS ps, least(e, d + {DAY}) AS pe
   FROM (SELECT *, unnest(generate_series(s // {DAY} * {DAY}, (e - 1) // {DAY} * {DAY}, {DAY})) AS d FROM iv WHERE e > s))
"""


@query(
    "split_by_day",
    _LEAD
    + ", "
    + _DAYS
    + """SELECT event_id, user_id, strftime(make_timestamp(d), '%Y-%m-%d') AS day, ps AS "start", pe AS "end",
   (pe - ps) / 60000000.0 AS minutes FROM pieces""",
)
def split(t: Tables):
    iv = lead_intervals(t.line, ["user_id"], "us", tiebreak=["event_id"]).select("event_id", "user_id", "start", "end")
    return split_by_day(iv).select("event_id", "user_id", F.col("day").cast("string").alias("day"), "start", "end", "minutes")


_SEG = f"""
WITH {LINE},
named AS (SELECT *, CASE WHEN event_type = 'error' THEN 'stop' ELSE 'go' END AS action,
   CASE WHEN event_type IN ('view', 'error') THEN 'a' WHEN event_type = 'purchase' THEN 'b' ELSE 'c' END AS drug FROM line),
n AS (SELECT *, lead(us) OVER (PARTITION BY user_id, drug ORDER BY us, event_id) AS nx FROM named),
seg AS (SELECT event_id, user_id, drug, value, us AS s, coalesce(nx, us + {DAY}) AS e, value > 20 AND action <> 'stop' AS active
   FROM n WHERE coalesce(nx, us + {DAY}) > us)
"""
_UNION = """
act AS (SELECT user_id, s, e FROM seg WHERE active AND drug IN ('a', 'b')),
mk AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
   THEN 0 ELSE 1 END AS brk FROM act),
isl AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM mk),
un AS (SELECT user_id, min(s) AS s, max(e) AS e FROM isl GROUP BY user_id, g)
"""
_WINDOWS = f"""
win AS (SELECT user_id, us // {DAY} * {DAY} AS d, min(us) AS lo, min(us) + 12 * {HOUR} AS hi FROM line GROUP BY 1, 2),
wn AS (SELECT user_id, d, lo, least(hi, d + {DAY}) AS hi FROM win WHERE least(hi, d + {DAY}) > lo)
"""
_GAPS = """
cl AS (SELECT w.user_id, w.d, w.lo, w.hi, greatest(u.s, w.lo) AS s, least(u.e, w.hi) AS e
   FROM wn w JOIN un u ON u.user_id = w.user_id AND u.s < w.hi AND u.e > w.lo),
nx AS (SELECT *, lead(s) OVER (PARTITION BY user_id, d ORDER BY s) AS ns FROM cl),
gaps AS (SELECT user_id, d, e AS gap_start, coalesce(ns, hi) AS gap_end, ns IS NOT NULL AS resumed FROM nx WHERE coalesce(ns, hi) > e)
"""


def drug_segments(t: Tables):
    """Three drugs per user; an error stops drug ``a``."""
    kind = F.col("event_type")
    drug = F.when(kind.isin("view", "error"), "a").when(kind == "purchase", "b").otherwise("c")
    rows = t.line.withColumn("drug", drug)
    active = (F.col("value") > 20) & (F.col("event_type") != "error")
    return step_segments(rows, ["user_id", "drug"], "us", active=active, tiebreak=["event_id"])


def day_windows(t: Tables):
    """Per user and day, twelve hours from the first event, inside the day."""
    rows = t.line.withColumn("day", local_day(F.col("us")))
    midnight = F.unix_micros(F.col("day").cast("timestamp"))
    per = rows.groupBy("user_id", "day").agg(F.min("us").alias("lo"))
    return per.withColumn("hi", F.least(F.col("lo") + F.lit(12 * HOUR), midnight + F.lit(DAY))).where("hi > lo")


def active_ab(t: Tables):
    return drug_segments(t).where("active and drug in ('a', 'b')").select("user_id", "start", "end")


@query("step_segments", _SEG + 'SELECT event_id, user_id, drug, s AS "start", e AS "end", active FROM seg')
def segments(t: Tables):
    return drug_segments(t).select("event_id", "user_id", "drug", "start", "end", "active")


@query("union_intervals", _SEG + "," + _UNION + 'SELECT user_id, s AS "start", e AS "end" FROM un')
def union(t: Tables):
    return union_intervals(active_ab(t), ["user_id"])


@query("off_gaps", _SEG + "," + _UNION + "," + _WINDOWS + "," + _GAPS + "SELECT user_id, strftime(make_timestamp(d), '%Y-%m-%d') AS day, gap_start, gap_end, resumed FROM gaps")
def gaps(t: Tables):
    found = off_gaps(active_ab(t), day_windows(t), ["user_id"], ["day"], ("start", "end"), ("lo", "hi"))
    return found.withColumn("day", F.col("day").cast("string"))


@query(
    "qualifying_holds",
    _SEG
    + ","
    + _UNION
    + ","
    + _WINDOWS
    + ","
    + _GAPS
    + """SELECT user_id, strftime(make_timestamp(d), '%Y-%m-%d') AS day, count(*) AS n_holds, max(gap_end - gap_start) / 60000000.0 AS longest_off_min,
   min(gap_start) AS first_hold, bool_or(resumed) AS resumed FROM gaps WHERE gap_end - gap_start >= 1800000000 GROUP BY user_id, d""",
)
def holds(t: Tables):
    found = off_gaps(active_ab(t), day_windows(t), ["user_id"], ["day"], ("start", "end"), ("lo", "hi"))
    return qualify_holds(found, ["user_id", "day"], 1_800_000_000).withColumn("day", F.col("day").cast("string"))


@query(
    "count_before_day",
    f"""
WITH {LINE}, {_WINDOWS.strip()},
v AS (SELECT user_id, us FROM line WHERE event_type = 'view')
SELECT w.user_id, strftime(make_timestamp(w.d), '%Y-%m-%d') AS day, count(v.us) AS prior_views
FROM wn w LEFT JOIN v ON v.user_id = w.user_id AND v.us < w.lo GROUP BY w.user_id, w.d""",
)
def prior(t: Tables):
    views = t.line.where("event_type = 'view'").select("user_id", "us")
    out = count_before(day_windows(t), views, ["user_id"], "lo", "us", "prior_views")
    return out.select("user_id", F.col("day").cast("string").alias("day"), "prior_views")


@query(
    "reading_cadence",
    f"""
WITH {LINE},
g AS (SELECT user_id, us, lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS p FROM line WHERE event_type = 'click'),
h AS (SELECT (us - p) / 3600000000.0 AS gap_h FROM g WHERE p IS NOT NULL)
SELECT count(*) AS n, round(quantile_cont(gap_h, 0.5), 6) AS p50, round(quantile_cont(gap_h, 0.9), 6) AS p90,
  round(avg(CASE WHEN gap_h <= 24 THEN 1.0 ELSE 0.0 END), 6) AS share_24h FROM h""",
)
def cadence_profile(t: Tables):
    from icuqm.operators.distribution import exact_quantiles

    clicks = t.line.where("event_type = 'click'")
    gaps_h = cadence(clicks, ["user_id"], "us", ["event_id"]).where("gap_h is not null").select("gap_h")
    q = exact_quantiles(gaps_h, [], "gap_h", {"p50": 0.5, "p90": 0.9})
    share = gaps_h.agg(F.avg((F.col("gap_h") <= 24).cast("double")).alias("share_24h"))
    both = q.crossJoin(F.broadcast(share))
    return both.select("n", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"), F.round("share_24h", 6).alias("share_24h"))
