"""Queries for the interval joins and the plain joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuqm.catalog.base import DAY, HOUR, LINE, UNITS, Tables, query
from icuqm.catalog.timeline import _SEG, _UNION, _WINDOWS, active_ab, day_windows, drug_segments
from icuqm.functions.time import midnight
from icuqm.operators.intervals import union_intervals
from icuqm.operators.overlap import (
    attribute_events,
    intersect_intervals,
    not_in_any,
    overlap_flag,
    overlap_minutes,
    points_in_intervals,
)

_STAYS = f"""stays AS (SELECT user_id, event_id AS stay_id, us AS s_us, us + 36 * {HOUR} AS e_us FROM line WHERE event_type = 'signup')"""


def stays(t: Tables):
    """A stay of 36 hours from every signup; a user's stays may overlap."""
    rows = t.line.where("event_type = 'signup'")
    return rows.select(
        "user_id", F.col("event_id").alias("stay_id"), F.col("us").alias("s_us"), (F.col("us") + F.lit(36 * HOUR)).alias("e_us")
    )


@query(
    "intersect_intervals",
    _SEG
    + ","
    + _STAYS
    + """SELECT g.user_id, g.event_id, k.stay_id, greatest(g.s, k.s_us) AS "start", least(g.e, k.e_us) AS "end"
   FROM seg g JOIN stays k ON g.user_id = k.user_id AND g.s < k.e_us AND g.e > k.s_us WHERE g.active""",
)
def intersect(t: Tables):
    segs = drug_segments(t).where("active").select("user_id", "event_id", F.col("start").alias("s"), F.col("end").alias("e"))
    out = intersect_intervals(segs, stays(t), ["user_id"], ("s", "e"), ("s_us", "e_us"))
    return out.select("user_id", "event_id", "stay_id", "start", "end")


@query(
    "points_in_stays",
    f"""WITH {LINE}, {_STAYS}
SELECT l.user_id, l.event_id, k.stay_id FROM line l JOIN stays k ON l.user_id = k.user_id AND l.us >= k.s_us AND l.us < k.e_us
WHERE l.event_type = 'purchase'""",
)
def points(t: Tables):
    p = t.line.where("event_type = 'purchase'").select("user_id", "event_id", "us")
    return points_in_intervals(p, stays(t), ["user_id"], "us", ("s_us", "e_us")).select("user_id", "event_id", "stay_id")


@query(
    "points_in_earliest_closed_stay",
    f"""WITH {LINE}, {_STAYS},
j AS (SELECT l.user_id, l.event_id, k.stay_id, row_number() OVER (PARTITION BY l.event_id ORDER BY k.s_us, k.stay_id) AS rn
  FROM line l JOIN stays k ON l.user_id = k.user_id AND l.us BETWEEN k.s_us AND k.e_us)
SELECT user_id, event_id, stay_id FROM j WHERE rn = 1""",
)
def points_earliest(t: Tables):
    p = t.line.select("user_id", "event_id", "us")
    out = points_in_intervals(p, stays(t), ["user_id"], "us", ("s_us", "e_us"), closed="both", keep="earliest")
    return out.select("user_id", "event_id", "stay_id")


@query(
    "overlap_flag_day",
    _SEG
    + ","
    + _UNION
    + ","
    + _WINDOWS
    + """SELECT w.user_id, strftime(make_timestamp(w.d), '%Y-%m-%d') AS day, count(u.s) > 0 AS on_drug
   FROM wn w LEFT JOIN un u ON u.user_id = w.user_id AND u.s < w.hi AND u.e > w.lo GROUP BY w.user_id, w.d""",
)
def flag(t: Tables):
    spans = union_intervals(active_ab(t), ["user_id"])
    out = overlap_flag(day_windows(t), spans, ["user_id"], ["day"], ("lo", "hi"), ("start", "end"), "on_drug")
    return out.select("user_id", F.col("day").cast("string").alias("day"), "on_drug")


@query(
    "overlap_minutes_day",
    _SEG
    + ","
    + _WINDOWS
    + """SELECT w.user_id, strftime(make_timestamp(w.d), '%Y-%m-%d') AS day,
   coalesce(CAST(sum(CASE WHEN g.s IS NOT NULL THEN least(g.e, w.hi) - greatest(g.s, w.lo) END) AS DOUBLE), 0) / 60000000.0 AS drug_minutes
   FROM wn w LEFT JOIN (SELECT * FROM seg WHERE active AND drug = 'b') g ON g.user_id = w.user_id AND g.s < w.hi AND g.e > w.lo
   GROUP BY w.user_id, w.d""",
)
def minutes_day(t: Tables):
    segs = drug_segments(t).where("active and drug = 'b'").select("user_id", "start", "end")
    spans = segs.withColumnsRenamed({"start": "s", "end": "e"})
    out = overlap_minutes(day_windows(t), spans, ["user_id"], ["day"], ("lo", "hi"), ("s", "e"), "drug_minutes")
    return out.select("user_id", F.col("day").cast("string").alias("day"), "drug_minutes")


@query(
    "off_at_next_midnight",
    _SEG
    + ","
    + _WINDOWS
    + f"""SELECT w.user_id, strftime(make_timestamp(w.d), '%Y-%m-%d') AS day, NOT bool_or(coalesce(g.s <= w.d + {DAY} AND w.d + {DAY} < g.e, false)) AS off_drug
   FROM wn w LEFT JOIN (SELECT * FROM seg WHERE active AND drug = 'b') g ON g.user_id = w.user_id GROUP BY w.user_id, w.d""",
)
def off_midnight(t: Tables):
    segs = drug_segments(t).where("active and drug = 'b'").select("user_id", "start", "end")
    probes = day_windows(t).select("user_id", "day", midnight(F.date_add("day", 1)).alias("at"))
    out = not_in_any(probes, segs, ["user_id"], ["day"], "at", ("start", "end"), "off_drug")
    return out.select("user_id", F.col("day").cast("string").alias("day"), "off_drug")


@query(
    "attribute_events_day",
    f"""WITH {LINE}, {_WINDOWS.strip()}
SELECT w.user_id, strftime(make_timestamp(w.d), '%Y-%m-%d') AS day, count(e.us) AS n_events,
  coalesce(sum(CASE WHEN e.value >= 50 THEN 1 ELSE 0 END), 0)::BIGINT AS n_strict, coalesce(max(e.value), 0) AS longest,
  coalesce(string_agg(DISTINCT e.event_type, ',' ORDER BY e.event_type), '') AS arms
FROM wn w LEFT JOIN (SELECT * FROM line WHERE event_type IN ('view', 'click')) e ON e.user_id = w.user_id AND e.us >= w.lo AND e.us < w.hi
GROUP BY w.user_id, w.d""",
)
def attribute(t: Tables):
    ev = t.line.where(F.col("event_type").isin("view", "click")).select("user_id", "us", "value", "event_type")
    aggs = {
        "n_events": (F.count(F.lit(1)), 0),
        "n_strict": (F.count_if(F.col("value") >= 50), 0),
        "longest": (F.max("value"), 0.0),
        "arms": (F.array_join(F.array_sort(F.collect_set("event_type")), ","), ""),
    }
    out = attribute_events(day_windows(t), ev, ["user_id"], ["day"], ("lo", "hi"), "us", aggs)
    return out.select("user_id", F.col("day").cast("string").alias("day"), *aggs)


@query(
    "skeleton_join",
    """SELECT c_custkey, count(o_orderkey) AS n_orders, coalesce(max(o_orderpriority), 'unknown') AS top_priority,
   coalesce(bool_or(o_totalprice > 200000), false) AS any_large
   FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
)
def skeleton(t: Tables):
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderpriority").alias("top_priority"), F.bool_or(F.col("o_totalprice") > 200000).alias("any_large")
    )
    out = t.customer.select("c_custkey").join(per, "c_custkey", "left")
    return out.fillna({"n_orders": 0, "top_priority": "unknown", "any_large": False})


@query(
    "dimension_join",
    f"WITH {LINE}, {UNITS} SELECT unit, unit_name, count(*) AS n, round(sum(value), 4) AS total FROM line JOIN units USING (user_id) GROUP BY unit, unit_name",
)
def dimension(t: Tables):
    # only the sums meet the dimension tables
    per = t.line.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    return per.join(t.units, "user_id").groupBy("unit", "unit_name").agg(F.sum("n").alias("n"), F.round(F.sum("v"), 4).alias("total"))


@query(
    "cohort_semi_join",
    """SELECT event_type, count(*) AS n FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) GROUP BY event_type""",
)
def semi(t: Tables):
    cohort = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("user_id"))
    return t.events.join(cohort, "user_id", "left_semi").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("excluded_anti_join", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def anti(t: Tables):
    big = t.orders.where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(big, "c_custkey", "left_anti")


@query(
    "key_set_operations",
    """WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 150),
b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value > 150)
SELECT 'both' AS op, user_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT 'only_a', user_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'any', user_id FROM (SELECT * FROM a UNION SELECT * FROM b)""",
)
def sets(t: Tables):
    # one pass instead of three set operations over the same table
    high = t.events.where("value > 150").groupBy("user_id").agg(
        F.bool_or(F.col("event_type") == "purchase").alias("a"), F.bool_or(F.col("event_type") == "error").alias("b")
    )
    ops = F.array(
        F.when(F.col("a") & F.col("b"), F.lit("both")), F.when(F.col("a") & ~F.col("b"), F.lit("only_a")), F.when(F.col("a") | F.col("b"), F.lit("any"))
    )
    return high.select(F.explode(F.array_compact(ops)).alias("op"), "user_id")


@query(
    "union_all_sources",
    """SELECT source, count(*) AS n, round(avg(amount), 4) AS mean FROM (
   SELECT 'orders' AS source, o_totalprice AS amount FROM orders UNION ALL SELECT 'events', value FROM events UNION ALL SELECT 'items', l_extendedprice FROM lineitem)
   GROUP BY source""",
)
def union_all(t: Tables):
    parts = [("orders", t.orders, "o_totalprice"), ("events", t.events, "value"), ("items", t.lineitem, "l_extendedprice")]
    frames = [df.select(F.lit(s).alias("source"), F.col(c).alias("amount")) for s, df, c in parts]
    both = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("amount"), 4).alias("mean"))
