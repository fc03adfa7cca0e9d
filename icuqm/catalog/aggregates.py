"""Queries for adherence, attribution, slices, masks, distributions and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuqm.catalog.base import DAY, HOUR, LINE, UNITS, Tables, query
from icuqm.catalog.timeline import _DAYS, _LEAD
from icuqm.functions.time import local_day, month_key, week_key
from icuqm.operators import adherence as ad
from icuqm.operators import attribution, checks, distribution, masks, profile, slices
from icuqm.operators.intervals import lead_intervals, split_by_day
from icuqm.operators.slices import slice_cube

CUTOFFS = [20.0, 30.0, 40.0, 50.0, 75.0, 100.0]

# ---------------------------------------------------------------- user-days and the flagship cube

_USER_DAYS = f"""
{_LEAD.strip()}, {_DAYS.strip()}, {UNITS},
roll AS (SELECT user_id, d, sum(pe - ps) AS total_us,
   sum(CASE WHEN event_type <> 'error' THEN pe - ps ELSE 0 END) AS low_assessable_us,
   sum(CASE WHEN event_type <> 'error' AND value <= 50 THEN pe - ps ELSE 0 END) AS low_in_us,
   sum(CASE WHEN event_type IN ('view', 'click') THEN pe - ps ELSE 0 END) AS mid_assessable_us,
   sum(CASE WHEN event_type IN ('view', 'click') AND value <= 30 THEN pe - ps ELSE 0 END) AS mid_in_us
   FROM pieces GROUP BY user_id, d),
st AS (SELECT roll.user_id, make_timestamp(d) AS day, total_us, low_assessable_us, low_in_us, mid_assessable_us, mid_in_us, unit, unit_name,
   CASE WHEN low_assessable_us < {HOUR} THEN 'not_assessable' WHEN low_in_us * 5 >= low_assessable_us * 4 THEN 'adherent' ELSE 'non_adherent' END AS low_status,
   CASE WHEN mid_assessable_us < {HOUR} THEN 'not_assessable' WHEN mid_in_us * 5 >= mid_assessable_us * 4 THEN 'adherent' ELSE 'non_adherent' END AS mid_status
   FROM roll JOIN units USING (user_id)),
sd AS (SELECT *, strftime(day, '%Y-%m') AS month, strftime(day, '%G-W%V') AS week FROM st)
"""
_CUBE_SETS = """
SELECT {cols}, 'all' AS granularity, 'all' AS period, {aggs} FROM sd GROUP BY ALL
UNION ALL SELECT {cols}, 'month', month, {aggs} FROM sd GROUP BY ALL
UNION ALL SELECT {cols}, 'week', week, {aggs} FROM sd GROUP BY ALL"""


def cube_sql(aggs: str, extra: str = "") -> str:
    heads = [
        f"'__ALL__' AS unit, 'type' AS dim, CAST(NULL AS VARCHAR) AS parent{extra}",
        f"unit, 'type' AS dim, CAST(NULL AS VARCHAR) AS parent{extra}",
        f"unit_name AS unit, 'name' AS dim, unit AS parent{extra}",
    ]
    return " UNION ALL ".join(f"({_CUBE_SETS.format(cols=h, aggs=aggs)})" for h in heads)


def pieces(t: Tables):
    iv = lead_intervals(t.line, ["user_id"], "us", tiebreak=["event_id"]).select("event_id", "user_id", "event_type", "value", "start", "end")
    return split_by_day(iv)


def low_and_mid():
    kind, value = F.col("event_type"), F.col("value")
    return {
        "low": ad.Measure(kind != "error", value <= 50),
        "mid": ad.Measure(kind.isin("view", "click"), value <= 30),
    }


def user_days(t: Tables):
    roll = ad.masked_time(pieces(t), ["user_id", "day"], low_and_mid(), {"total": F.lit(True)})
    days = ad.classify(roll, ["low", "mid"]).join(t.units, "user_id")
    return slices.attach_periods(days)


def status_cols():
    status = F.col("low_status")
    return {"n_total": F.count(F.lit(1)), **{f"n_{x}": F.count_if(status == x) for x in ad.STATUSES}}


_STATUS_AGGS = """count(*) AS n_total, count(*) FILTER (WHERE low_status = 'adherent') AS n_adherent,
count(*) FILTER (WHERE low_status = 'non_adherent') AS n_non_adherent, count(*) FILTER (WHERE low_status = 'not_assessable') AS n_not_assessable"""


@query(
    "adherence_cube",
    f"WITH {_USER_DAYS.strip()[4:]}, c AS ({cube_sql(_STATUS_AGGS)})"
    + """SELECT *, round(CASE WHEN n_adherent + n_non_adherent > 0 THEN n_adherent / (n_adherent + n_non_adherent) END, 6) AS assessable_rate,
   round(n_adherent / n_total, 6) AS crude_rate, n_adherent + n_non_adherent < 10 AS small_cell FROM c""",
)
def adherence_cube(t: Tables):
    cube = slice_cube(user_days(t), status_cols())
    rated = cube.withColumns(ad.both_rates())
    return rated.withColumns(
        {
            "assessable_rate": F.round("assessable_rate", 6),
            "crude_rate": F.round("crude_rate", 6),
            "small_cell": F.col("n_adherent") + F.col("n_non_adherent") < 10,
        }
    )


@query(
    "user_day_status",
    f"WITH {_USER_DAYS.strip()[4:]} SELECT user_id, strftime(day, '%Y-%m-%d') AS day, total_us::BIGINT AS total_us, low_assessable_us::BIGINT AS low_assessable_us, low_in_us::BIGINT AS low_in_us, low_status, mid_status, month, week FROM sd",
)
def day_status(t: Tables):
    return user_days(t).select(
        "user_id", F.col("day").cast("string").alias("day"), "total_us", "low_assessable_us", "low_in_us", "low_status", "mid_status", "month", "week"
    )


@query(
    "status_counts_by_day",
    f"""WITH {_USER_DAYS.strip()[4:]},
l AS (SELECT day, unit, 'low' AS measure, low_status AS status FROM sd UNION ALL SELECT day, unit, 'mid', mid_status FROM sd)
SELECT strftime(day, '%Y-%m-%d') AS day, unit, measure, count(*) AS n_total, count(*) FILTER (WHERE status = 'adherent') AS n_adherent,
  count(*) FILTER (WHERE status = 'non_adherent') AS n_non_adherent, count(*) FILTER (WHERE status = 'not_assessable') AS n_not_assessable,
  round(CASE WHEN count(*) FILTER (WHERE status <> 'not_assessable') > 0 THEN count(*) FILTER (WHERE status = 'adherent') / count(*) FILTER (WHERE status <> 'not_assessable') END, 6) AS assessable_rate,
  round(count(*) FILTER (WHERE status = 'adherent') / count(*), 6) AS crude_rate FROM l GROUP BY day, unit, measure""",
)
def status_by_day(t: Tables):
    out = ad.status_counts(user_days(t), ["day", "unit"], ["low", "mid"])
    return out.withColumns(
        {"day": F.col("day").cast("string"), "assessable_rate": F.round("assessable_rate", 6), "crude_rate": F.round("crude_rate", 6)}
    )


@query(
    "distinct_users_cube",
    f"WITH {_USER_DAYS.strip()[4:]}, c AS ("
    + cube_sql("count(DISTINCT user_id) AS n_users, count(DISTINCT CASE WHEN low_status = 'adherent' THEN user_id END) AS n_users_adherent")
    + ") SELECT unit, dim, granularity, period, n_users, n_users_adherent FROM c",
)
def distinct_users(t: Tables):
    masks_ = {"n_users": F.lit(True), "n_users_adherent": F.col("low_status") == "adherent"}
    return slices.distinct_cube(user_days(t), "user_id", masks_)


_SWEEP = (
    f"WITH {_USER_DAYS.strip()[4:]}, cuts AS (SELECT unnest([{', '.join(map(str, CUTOFFS))}]) AS cutoff),"
    + """
sw AS (SELECT p.user_id, p.d, c.cutoff, sum(CASE WHEN event_type <> 'error' THEN pe - ps ELSE 0 END) AS a,
   sum(CASE WHEN event_type <> 'error' AND value <= c.cutoff THEN pe - ps ELSE 0 END) AS i,
   sum(CASE WHEN event_type IN ('view', 'click') THEN pe - ps ELSE 0 END) AS a2,
   sum(CASE WHEN event_type IN ('view', 'click') AND value <= c.cutoff THEN pe - ps ELSE 0 END) AS i2
   FROM pieces p CROSS JOIN cuts c GROUP BY ALL),
lg AS (SELECT user_id, d, cutoff, 'any' AS measure, a, i FROM sw UNION ALL SELECT user_id, d, cutoff, 'support', a2, i2 FROM sw),
cnt AS (SELECT strftime(make_timestamp(d), '%Y-%m') AS month, unit, measure, CAST(cutoff AS DOUBLE) AS cutoff, count(*) AS n_total, count(*) FILTER (WHERE a >= 3600000000) AS n_assessable,
   count(*) FILTER (WHERE a >= 3600000000 AND i * 5 >= a * 4) AS n_adherent FROM lg JOIN units USING (user_id) GROUP BY ALL)
"""
)


@query(
    "cutoff_sweep",
    _SWEEP
    + "SELECT *, round(CASE WHEN n_assessable > 0 THEN n_adherent / n_assessable END, 6) AS assessable_rate, round(n_adherent / n_total, 6) AS crude_rate FROM cnt",
)
def sweep(t: Tables):
    kind = F.col("event_type")
    extras = {"any": ad.Measure(kind != "error", F.lit(True)), "support": ad.Measure(kind.isin("view", "click"), F.lit(True))}
    swept = ad.cutoff_sweep(pieces(t), ["user_id", "day"], "value", CUTOFFS, extras)
    out = ad.sweep_counts(swept.join(t.units, "user_id").withColumn("month", month_key(F.col("day"))), ["month", "unit"])
    return out.withColumns({"assessable_rate": F.round("assessable_rate", 6), "crude_rate": F.round("crude_rate", 6)})


@query(
    "cutoff_comparison_by_unit",
    _SWEEP
    + """SELECT unit, measure, sum(CASE WHEN cutoff = 50 THEN n_adherent END)::BIGINT AS adherent_50, sum(CASE WHEN cutoff = 75 THEN n_adherent END)::BIGINT AS adherent_75,
   sum(CASE WHEN cutoff = 75 THEN n_adherent ELSE 0 END - CASE WHEN cutoff = 50 THEN n_adherent ELSE 0 END)::BIGINT AS gain FROM cnt GROUP BY unit, measure""",
)
def sweep_pair(t: Tables):
    kind = F.col("event_type")
    extras = {"any": ad.Measure(kind != "error", F.lit(True)), "support": ad.Measure(kind.isin("view", "click"), F.lit(True))}
    swept = ad.cutoff_sweep(pieces(t), ["user_id", "day"], "value", [50.0, 75.0], extras)
    out = ad.sweep_counts(swept.join(t.units, "user_id"), ["unit"])
    at = {c: F.sum(F.when(F.col("cutoff") == c, F.col("n_adherent"))) for c in (50.0, 75.0)}
    return out.groupBy("unit", "measure").agg(at[50.0].alias("adherent_50"), at[75.0].alias("adherent_75"), (at[75.0] - at[50.0]).alias("gain"))


# ---------------------------------------------------------------- attribution

@query(
    "majority_unit_nested",
    f"""WITH {LINE}, {UNITS},
e AS (SELECT event_type, us // {DAY} * {DAY} AS d, unit, unit_name FROM line JOIN units USING (user_id)),
u AS (SELECT event_type, d, unit, count(*) AS n FROM e GROUP BY ALL),
tu AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type, d ORDER BY n DESC, unit) AS rn FROM u) WHERE rn = 1),
nn AS (SELECT e.event_type, e.d, e.unit, unit_name, count(*) AS n FROM e JOIN tu ON e.event_type = tu.event_type AND e.d = tu.d AND e.unit = tu.unit GROUP BY ALL),
tn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type, d ORDER BY n DESC, unit_name) AS rn FROM nn) WHERE rn = 1),
tot AS (SELECT event_type, d, count(*) AS n_rows FROM e GROUP BY ALL)
SELECT tn.event_type, strftime(make_timestamp(tn.d), '%Y-%m-%d') AS day, tn.unit, tn.unit_name, n_rows FROM tn JOIN tot ON tn.event_type = tot.event_type AND tn.d = tot.d""",
)
def majority(t: Tables):
    rows = t.line.join(t.units, "user_id").withColumn("day", local_day(F.col("us")).cast("string"))
    return attribution.majority_nested(rows, ["event_type", "day"], "unit", "unit_name")


@query(
    "longest_piece_nested",
    f"""WITH {_LEAD.strip()[4:]}, {_DAYS.strip()},
x AS (SELECT user_id, d, event_type AS unit, CASE WHEN value > 50 THEN event_type || '_hi' ELSE event_type || '_lo' END AS unit_name, ps, pe FROM pieces),
p AS (SELECT user_id, d, unit, max(pe - ps) AS top FROM x GROUP BY ALL),
cu AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, d ORDER BY top DESC, unit) AS rn FROM p) WHERE rn = 1),
nm AS (SELECT x.user_id, x.d, x.unit_name, sum(pe - ps) AS s FROM x JOIN cu ON x.user_id = cu.user_id AND x.d = cu.d AND x.unit = cu.unit GROUP BY ALL),
cn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, d ORDER BY s DESC, unit_name) AS rn FROM nm) WHERE rn = 1),
tot AS (SELECT user_id, d, sum(pe - ps) AS us, min(ps) AS day_in, max(pe) AS day_out FROM x GROUP BY ALL)
SELECT tot.user_id, strftime(make_timestamp(tot.d), '%Y-%m-%d') AS day, cu.unit, cn.unit_name, CAST(tot.us AS DOUBLE) / 60000000.0 AS minutes, day_in, day_out
FROM tot JOIN cu ON tot.user_id = cu.user_id AND tot.d = cu.d JOIN cn ON tot.user_id = cn.user_id AND tot.d = cn.d""",
)
def longest(t: Tables):
    label = F.concat("event_type", F.when(F.col("value") > 50, F.lit("_hi")).otherwise(F.lit("_lo")))
    rows = pieces(t).select("user_id", F.col("day").cast("string").alias("day"), F.col("event_type").alias("unit"), label.alias("unit_name"), "start", "end")
    return attribution.longest_piece_nested(rows, ["user_id", "day"], "unit", "unit_name")


@query(
    "primary_unit",
    """WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS rn FROM c) WHERE rn = 1""",
)
def primary(t: Tables):
    return attribution.primary_unit(t.orders, ["o_custkey"], "o_orderpriority")


@query(
    "worst_of_day",
    f"""WITH {LINE}, e AS (SELECT user_id, us // {DAY} * {DAY} AS d, event_type, value / 2 AS ratio FROM line WHERE event_type IN ('view', 'click'))
SELECT user_id, strftime(make_timestamp(d), '%Y-%m-%d') AS day, bool_or(ratio < 10) AS severe, min(CASE WHEN event_type = 'view' THEN ratio END) AS worst_view,
  min(CASE WHEN event_type = 'click' THEN ratio END) AS worst_click, CASE WHEN bool_or(event_type = 'view') THEN 'view' ELSE 'click' END AS source FROM e GROUP BY user_id, d""",
)
def worst(t: Tables):
    rows = t.line.where(F.col("event_type").isin("view", "click")).withColumns({"ratio": F.col("value") / 2, "day": local_day(F.col("us")).cast("string")})
    is_view = F.col("event_type") == "view"
    return rows.groupBy("user_id", "day").agg(
        F.bool_or(F.col("ratio") < 10).alias("severe"),
        F.min(F.when(is_view, F.col("ratio"))).alias("worst_view"),
        F.min(F.when(~is_view, F.col("ratio"))).alias("worst_click"),
        F.when(F.bool_or(is_view), F.lit("view")).otherwise(F.lit("click")).alias("source"),
    )


# ---------------------------------------------------------------- masks

BITS = ["returned", "open", "deep_discount", "bulk", "taxed", "late"]
_MASK = """
i AS (SELECT n.n_name AS unit_name, r.r_name AS unit, strftime(l_shipdate, '%Y-%m') AS month, strftime(l_shipdate, '%G-W%V') AS week,
  (l_returnflag = 'R')::INT + 2 * (l_linestatus = 'O')::INT + 4 * (l_discount >= 0.05)::INT + 8 * (l_quantity > 30)::INT + 16 * (l_tax > 0.04)::INT
  + 32 * (l_shipdate >= TIMESTAMP '1998-01-01')::INT AS mask
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation n ON s_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey)
"""


def item_days(t: Tables):
    n, r = t.nation, t.region
    supp = t.supplier.join(n, F.col("s_nationkey") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    supp = supp.select("s_suppkey", F.col("n_name").alias("unit_name"), F.col("r_name").alias("unit"))
    flags = {
        "returned": F.col("l_returnflag") == "R",
        "open": F.col("l_linestatus") == "O",
        "deep_discount": F.col("l_discount") >= 0.05,
        "bulk": F.col("l_quantity") > 30,
        "taxed": F.col("l_tax") > 0.04,
        "late": F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"),
    }
    items = t.lineitem.join(supp, F.col("l_suppkey") == F.col("s_suppkey")).withColumns(flags)
    d = F.col("l_shipdate").cast("date")
    return items.withColumns({"month": month_key(d), "week": week_key(d)}).select("unit", "unit_name", "month", "week", *BITS)


@query(
    "mask_histogram",
    f"WITH {_MASK.strip()}, sd AS (SELECT * FROM i), c AS ("
    + cube_sql("count(*) AS count", ", mask")
    + ") SELECT unit, dim, parent, granularity, period, mask::BIGINT AS mask, count FROM c",
)
def mask_hist(t: Tables):
    return masks.mask_histogram(item_days(t), BITS)


def _hist_all(t: Tables):
    return masks.mask_histogram(item_days(t), BITS, grains=("month",), name=None).where("granularity = 'all'")


@query(
    "mask_rate",
    f"""WITH {_MASK.strip()}, a AS (SELECT '__ALL__' AS unit, mask FROM i UNION ALL SELECT unit, mask FROM i)
SELECT unit, count(*) AS n_days, count(*) FILTER (WHERE den) AS den, count(*) FILTER (WHERE den AND mask & 16 > 0) AS num,
  round(count(*) FILTER (WHERE den AND mask & 16 > 0) / count(*) FILTER (WHERE den), 6) AS rate
FROM (SELECT *, mask & 1 = 0 AND mask & 4 > 0 AND NOT (mask & 8 > 0 AND mask & 2 = 0) AS den FROM a) GROUP BY unit""",
)
def mask_rates(t: Tables):
    den = masks.passes(BITS, require=["deep_discount"], forbid=["returned"], forbid_unless=[("bulk", "open")])
    out = masks.mask_rate(_hist_all(t), ["unit"], den, masks.bit(BITS, "taxed"))
    return out.withColumn("rate", F.round("rate", 6))


@query(
    "mask_waterfall",
    f"""WITH {_MASK.strip()}, a AS (SELECT '__ALL__' AS unit, mask FROM i UNION ALL SELECT unit, mask FROM i),
s AS (SELECT unit, count(*) AS n0, count(*) FILTER (WHERE mask & 1 = 0) AS n1, count(*) FILTER (WHERE mask & 1 = 0 AND mask & 4 > 0) AS n2 FROM a GROUP BY unit)
SELECT unit, 0 AS step, 'all' AS label, n0 AS n, 0::BIGINT AS removed FROM s UNION ALL SELECT unit, 1, 'not returned', n1, n0 - n1 FROM s
UNION ALL SELECT unit, 2, 'deep discount', n2, n1 - n2 FROM s""",
)
def waterfall(t: Tables):
    steps = {"not returned": ~masks.bit(BITS, "returned"), "deep discount": masks.bit(BITS, "deep_discount")}
    return masks.mask_waterfall(_hist_all(t), ["unit"], steps)


# ---------------------------------------------------------------- distributions

@query(
    "weighted_histogram",
    f"""WITH {_LEAD.strip()[4:]}, {_DAYS.strip()}
SELECT strftime(make_timestamp(d), '%G-W%V') AS week, event_type, CAST(floor(value / 2.5) AS INT) AS bin, round(sum(pe - ps) / 60000000.0, 4) AS minutes
FROM pieces WHERE value >= 0 AND value < 100 GROUP BY ALL""",
)
def whist(t: Tables):
    rows = pieces(t).withColumn("week", week_key(F.col("day")))
    out = distribution.weighted_hist(rows, ["week", "event_type"], "value", F.col("end") - F.col("start"), 0.0, 100.0, 2.5)
    return out.select("week", "event_type", "bin", F.round(F.col("weight") / 60000000.0, 4).alias("minutes"))


@query(
    "clipped_histogram",
    "SELECT event_type, CAST(least(floor(value / 12.5), 19) AS INT) AS bin, count(*) AS n FROM events GROUP BY ALL",
)
def chist(t: Tables):
    return distribution.clipped_hist(t.events, ["event_type"], "value", 20, 12.5)


@query(
    "duration_buckets",
    f"""WITH {_LEAD.strip()[4:]}, m AS (SELECT event_type, (e - s) / 60000000.0 AS v FROM iv)
SELECT event_type, CASE WHEN v < 5 THEN 0 WHEN v < 15 THEN 1 WHEN v < 30 THEN 2 WHEN v < 60 THEN 3 WHEN v < 120 THEN 4 WHEN v < 240 THEN 5 WHEN v < 480 THEN 6 ELSE 7 END AS bucket, count(*) AS n
FROM m GROUP BY ALL""",
)
def buckets(t: Tables):
    iv = lead_intervals(t.line, ["user_id"], "us", tiebreak=["event_id"])
    rows = iv.select("event_type", ((F.col("end") - F.col("start")) / F.lit(60000000.0)).alias("v"))
    return distribution.bucketed(rows, ["event_type"], "v", [0, 5, 15, 30, 60, 120, 240, 480])


@query(
    "nearest_rank_percentiles",
    """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, any_value(n) AS n, max(CASE WHEN k = floor(0.1 * (n - 1) + 0.5) THEN value END) AS p10, max(CASE WHEN k = floor(0.5 * (n - 1) + 0.5) THEN value END) AS p50,
  max(CASE WHEN k = floor(0.9 * (n - 1) + 0.5) THEN value END) AS p90 FROM r GROUP BY event_type""",
)
def nearest(t: Tables):
    return distribution.nearest_rank(t.events, ["event_type"], "value", {"p10": 0.1, "p50": 0.5, "p90": 0.9})


@query(
    "exact_quantiles",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(quantile_cont(l_extendedprice, 0.01), 4) AS p01, round(quantile_cont(l_extendedprice, 0.25), 4) AS q1,
  round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def quantiles(t: Tables):
    q = {"p01": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    out = distribution.exact_quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", q)
    return out.select("l_returnflag", "l_linestatus", "n", *[F.round(c, 4).alias(c) for c in q])


@query(
    "nested_median",
    """WITH m AS (SELECT o_custkey, l_orderkey, median(l_quantity) AS m FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT o_custkey, count(*) AS n, round(median(m), 6) AS median FROM m GROUP BY o_custkey""",
)
def nested(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_quantity").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return distribution.nested_median(rows, ["l_orderkey"], ["o_custkey"], "l_quantity").withColumn("median", F.round("median", 6))


# upper tail of the chi-square distribution by the series of the lower incomplete gamma function
_TAIL = """round(1 - exp({a} * ln({x}) - {x} - lgamma({a} + 1)) * list_sum([exp(k * ln({x}) + lgamma({a} + 1) - lgamma({a} + k + 1)) FOR k IN range(400)]), 6) AS p"""


@query(
    "rank_test",
    """WITH c AS (SELECT c_acctbal AS v, c_mktsegment = 'BUILDING' AS g FROM customer),
r AS (SELECT *, (rank() OVER (ORDER BY v) + (rank() OVER (ORDER BY v) + count(*) OVER (PARTITION BY v) - 1)) / 2.0 AS mid FROM c),
tie AS (SELECT sum(n * n * n - n) AS ties FROM (SELECT count(*)::DOUBLE AS n FROM c GROUP BY v)),
s AS (SELECT sum(CASE WHEN g THEN mid END) AS r1, sum(CASE WHEN NOT g THEN mid END) AS r2, count(*) FILTER (WHERE g) AS n_true, count(*) FILTER (WHERE NOT g) AS n_false, count(*)::DOUBLE AS n FROM r),
h AS (SELECT (12 / (n * (n + 1)) * (r1 * r1 / n_true + r2 * r2 / n_false) - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h, n_true, n_false FROM s, tie)
SELECT round(h, 4) AS h, n_true, n_false, """
    + _TAIL.format(a="0.5", x="h / 2")
    + " FROM h",
)
def rank_test(t: Tables):
    rows = t.customer.select("c_acctbal", (F.col("c_mktsegment") == "BUILDING").alias("g"))
    return distribution.kruskal(rows, "c_acctbal", "g").select(F.round("h", 4).alias("h"), "n_true", "n_false", F.round("p", 6).alias("p"))


@query(
    "contingency_test",
    """WITH c AS (SELECT o_orderpriority AS l, count(*) FILTER (WHERE o_orderstatus = 'F')::DOUBLE AS a, count(*) FILTER (WHERE o_orderstatus <> 'F')::DOUBLE AS b FROM orders GROUP BY 1),
t AS (SELECT sum(a) AS ta, sum(b) AS tb, count(*) AS k FROM c),
x AS (SELECT sum((a - (a + b) * ta / (ta + tb)) ** 2 / ((a + b) * ta / (ta + tb)) + (b - (a + b) * tb / (ta + tb)) ** 2 / ((a + b) * tb / (ta + tb))) AS chi2, any_value(k) - 1 AS dof FROM c, t)
SELECT round(chi2, 4) AS chi2, dof, """
    + _TAIL.format(a="(dof / 2.0)", x="chi2 / 2")
    + " FROM x",
)
def chi_square(t: Tables):
    rows = t.orders.select("o_orderpriority", (F.col("o_orderstatus") == "F").alias("g"))
    return profile.contingency_test(rows, "g", "o_orderpriority").select(F.round("chi2", 4).alias("chi2"), "dof", F.round("p", 6).alias("p"))


# ---------------------------------------------------------------- profiles

@query("top_values", "SELECT p_type AS value, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, value LIMIT 5")
def top(t: Tables):
    return profile.top_values(t.part, "p_type", 5)


@query(
    "missingness",
    """WITH m AS (SELECT event_type, CASE WHEN value > 10 THEN value END AS a, CASE WHEN value < 80 THEN value END AS b FROM events)
SELECT event_type, count(*) AS n, round(count(a) / count(*), 6) AS a_present, round(count(b) / count(*), 6) AS b_present,
  round(count(*) FILTER (WHERE a IS NOT NULL OR b IS NOT NULL) / count(*), 6) AS any_present, round(count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) / count(*), 6) AS all_present
FROM m GROUP BY event_type""",
)
def missing(t: Tables):
    rows = t.events.select("event_type", F.when(F.col("value") > 10, F.col("value")).alias("a"), F.when(F.col("value") < 80, F.col("value")).alias("b"))
    out = profile.missingness(rows, ["a", "b"], ["event_type"])
    return out.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("a_present", "b_present", "any_present", "all_present")])


@query(
    "charting_convention",
    """WITH m AS (SELECT event_type, CASE WHEN value < 200 THEN CASE WHEN value < 5 THEN 0 ELSE value END END AS dose FROM events)
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE dose IS NULL) AS n_null, count(*) FILTER (WHERE dose = 0) AS n_zero, count(*) FILTER (WHERE dose > 0) AS n_positive FROM m GROUP BY event_type""",
)
def signs(t: Tables):
    dose = F.when(F.col("value") < 200, F.when(F.col("value") < 5, 0.0).otherwise(F.col("value")))
    return profile.sign_profile(t.events.select("event_type", dose.alias("dose")), ["event_type"], "dose")


@query("entity_days", "SELECT event_type, count(DISTINCT (user_id, CAST(ts AS DATE))) AS n_entity_days FROM events GROUP BY event_type")
def sizing(t: Tables):
    rows = t.line.select("event_type", "user_id", local_day(F.col("us")).alias("day"))
    return profile.entity_days(rows, "user_id", "day", ["event_type"])


@query(
    "unit_year_matrix",
    """SELECT o_orderpriority, y, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS total
FROM (SELECT *, year(o_orderdate) AS y FROM orders) GROUP BY o_orderpriority, y""",
)
def matrix(t: Tables):
    return profile.count_matrix(t.orders.withColumn("y", F.year("o_orderdate")), "o_orderpriority", "y")


_MONTHLY = """WITH c AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS m, count(*) AS n FROM orders GROUP BY 1, 2),
span AS (SELECT o_custkey, min(m) AS lo, max(m) AS hi FROM c GROUP BY 1),
cal AS (SELECT o_custkey, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM span),
f AS (SELECT cal.o_custkey, cal.m, coalesce(c.n, 0) AS n FROM cal LEFT JOIN c ON c.m = cal.m AND c.o_custkey = cal.o_custkey),
l AS (SELECT *, lag(n) OVER (PARTITION BY o_custkey ORDER BY m) AS b FROM f),
s AS (SELECT o_custkey, strftime(m, '%Y-%m') AS month, n, CASE WHEN b > 0 THEN (n - b) / b END AS change FROM l)
"""


@query("monthly_series", _MONTHLY + "SELECT o_custkey, month, n, round(change, 6) AS change FROM s")
def monthly(t: Tables):
    days = t.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    return profile.monthly_series(days, ["o_custkey"], "day").withColumn("change", F.round("change", 6))


@query("monthly_swings", _MONTHLY + "SELECT o_custkey, month, n, round(change, 6) AS change FROM s WHERE change IS NOT NULL ORDER BY abs(change) DESC, month, o_custkey LIMIT 5")
def swings(t: Tables):
    days = t.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    return profile.top_swings(profile.monthly_series(days, ["o_custkey"], "day"), ["o_custkey"], 5).withColumn("change", F.round("change", 6))


@query(
    "long_tail",
    """WITH p AS (SELECT o_custkey, count(*) AS d FROM orders GROUP BY 1), th AS (SELECT unnest([5, 10, 15]) AS threshold)
SELECT threshold, count(*) FILTER (WHERE d > threshold) AS n_entities, coalesce(sum(d) FILTER (WHERE d > threshold), 0)::BIGINT AS n_days,
  round(count(*) FILTER (WHERE d > threshold) / count(*), 6) AS entity_share, round(coalesce(sum(d) FILTER (WHERE d > threshold), 0)::DOUBLE / sum(d)::DOUBLE, 6) AS day_share FROM p, th GROUP BY threshold""",
)
def tail(t: Tables):
    out = profile.long_tail(t.orders, "o_custkey", [5, 10, 15])
    return out.withColumns({c: F.round(c, 6) for c in ("entity_share", "day_share")})


@query(
    "day_span",
    "SELECT o_custkey, CAST(date_diff('day', min(o_orderdate)::DATE, max(o_orderdate)::DATE) + 1 AS INT) AS span_days, date_diff('day', min(o_orderdate)::DATE, max(o_orderdate)::DATE) + 1 > 1500 AS long_span FROM orders GROUP BY o_custkey",
)
def span(t: Tables):
    return profile.day_span(t.orders.withColumn("day", F.col("o_orderdate").cast("date")), ["o_custkey"], "day", 1500)


@query(
    "null_causes",
    """SELECT c_mktsegment, CASE WHEN c_acctbal >= 0 AND c_nationkey < 20 THEN 'present' WHEN c_nationkey >= 20 THEN 'no_region' WHEN c_acctbal < -500 THEN 'rejected' ELSE 'other' END AS cause, count(*) AS n FROM customer GROUP BY ALL""",
)
def causes(t: Tables):
    rows = t.customer.withColumn("v", F.when((F.col("c_acctbal") >= 0) & (F.col("c_nationkey") < 20), F.col("c_acctbal")))
    return profile.null_causes(rows, ["c_mktsegment"], "v", {"no_region": F.col("c_nationkey") >= 20, "rejected": F.col("c_acctbal") < -500})


@query(
    "table_one",
    """WITH b AS (SELECT o_custkey, bool_or(o_totalprice > 450000) AS ever, count(*) AS n_orders FROM orders GROUP BY 1),
e AS (SELECT c_acctbal, n_orders::DOUBLE AS n_orders, c_mktsegment, ever FROM customer JOIN b ON c_custkey = o_custkey),
g AS (SELECT *, 'overall' AS grp FROM e UNION ALL SELECT *, CASE WHEN ever THEN 'yes' ELSE 'no' END FROM e),
z AS (SELECT grp, count(*) AS size FROM g GROUP BY grp)
SELECT 'c_acctbal' AS variable, '' AS level, grp, count(*) AS n, CAST(NULL AS DOUBLE) AS pct, round(median(c_acctbal), 4) AS median, round(quantile_cont(c_acctbal, 0.25), 4) AS q1, round(quantile_cont(c_acctbal, 0.75), 4) AS q3 FROM g GROUP BY grp
UNION ALL SELECT 'n_orders', '', grp, count(*), NULL, round(median(n_orders), 4), round(quantile_cont(n_orders, 0.25), 4), round(quantile_cont(n_orders, 0.75), 4) FROM g GROUP BY grp
UNION ALL SELECT 'c_mktsegment', c_mktsegment, g.grp, count(*), round(count(*) * 100.0 / any_value(size), 4), NULL, NULL, NULL FROM g JOIN z ON g.grp = z.grp GROUP BY c_mktsegment, g.grp""",
)
def table1(t: Tables):
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_totalprice") > 450000).alias("ever"), F.count(F.lit(1)).alias("n_orders"))
    out = profile.table_one(t.customer.join(per, "c_custkey"), "ever", ["c_acctbal", "n_orders"], ["c_mktsegment"])
    return out.withColumns({c: F.round(c, 4) for c in ("pct", "median", "q1", "q3")})


# ---------------------------------------------------------------- rates and summaries

_TTE = f"""WITH {LINE}, a AS (SELECT user_id, min(us) AS t0 FROM line GROUP BY user_id), p AS (SELECT user_id, min(us) AS t1 FROM line WHERE event_type = 'purchase' AND value > 120 GROUP BY user_id),
e AS (SELECT a.user_id, (p.t1 - a.t0) / 3600000000.0 AS h FROM a LEFT JOIN p USING (user_id)) """


def time_to_event(t: Tables):
    hit = (F.col("event_type") == "purchase") & (F.col("value") > 120)
    per = t.line.groupBy("user_id").agg(F.min("us").alias("t0"), F.min(F.when(hit, F.col("us"))).alias("t1"))
    return per.withColumn("h", (F.col("t1") - F.col("t0")) / F.lit(3600000000.0))


@query("event_hours", _TTE + "SELECT user_id, round(h, 6) AS hours FROM e")
def event_hours(t: Tables):
    return time_to_event(t).select("user_id", F.round("h", 6).alias("hours"))


@query(
    "cumulative_incidence",
    _TTE + ", hz AS (SELECT unnest([24, 48, 72, 168]) AS horizon_h) SELECT horizon_h, count(*) FILTER (WHERE h <= horizon_h) AS num, count(*) AS den, round(count(*) FILTER (WHERE h <= horizon_h) / count(*), 6) AS rate FROM e, hz GROUP BY horizon_h",
)
def incidence(t: Tables):
    return slices.cumulative_incidence(time_to_event(t), "h", [24, 48, 72, 168]).withColumn("rate", F.round("rate", 6))


_BOUND = """count(*) AS n_all, count(*) FILTER (WHERE documented) AS n_documented, count(*) FILTER (WHERE documented AND good) AS n_good"""
_BOUND_DAYS = f"""WITH {LINE}, {UNITS}, sd AS (SELECT user_id, unit, unit_name, strftime(make_timestamp(us // {DAY} * {DAY}), '%Y-%m') AS month, strftime(make_timestamp(us // {DAY} * {DAY}), '%G-W%V') AS week,
   bool_or(event_type = 'purchase') AS documented, bool_or(event_type = 'purchase' AND value > 50) AS good FROM line JOIN units USING (user_id) GROUP BY user_id, unit, unit_name, us // {DAY})"""


@query(
    "bounded_rates",
    _BOUND_DAYS
    + f", c AS ({cube_sql(_BOUND)}) SELECT *, round(n_good / n_all, 6) AS rate_lower, round(CASE WHEN n_documented > 0 THEN n_good / n_documented END, 6) AS rate_upper, n_all < 10 AS small_cell FROM c",
)
def bounded(t: Tables):
    buy = F.col("event_type") == "purchase"
    days = t.line.groupBy("user_id", local_day(F.col("us")).alias("day")).agg(
        F.bool_or(buy).alias("documented"), F.bool_or(buy & (F.col("value") > 50)).alias("good")
    )
    days = slices.attach_periods(days.join(t.units, "user_id"))
    cube = slice_cube(
        days,
        {
            "n_all": F.count(F.lit(1)),
            "n_documented": F.count_if("documented"),
            "n_good": F.count_if(F.col("documented") & F.col("good")),
        },
    )
    out = slices.with_rates(cube, {"rate_lower": ("n_good", "n_all"), "rate_upper": ("n_good", "n_documented")}, ("n_all", 10))
    return out.withColumns({c: F.round(c, 6) for c in ("rate_lower", "rate_upper")})


@query(
    "summary_rows",
    f"""WITH {_USER_DAYS.strip()[4:]}, t AS (SELECT count(*) AS d, count(*) FILTER (WHERE low_status <> 'not_assessable') AS a, count(*) FILTER (WHERE low_status = 'adherent') AS n FROM sd)
SELECT 'days' AS metric, 'User-days' AS label, d AS numerator, d AS denominator, 1.0 AS rate FROM t
UNION ALL SELECT 'assessable', 'Assessable days', a, d, round(a / d, 6) FROM t UNION ALL SELECT 'adherent', 'Adherent of assessable', n, a, round(n / a, 6) FROM t""",
)
def summary(t: Tables):
    totals = user_days(t).agg(
        F.count(F.lit(1)).alias("d"), F.count_if(F.col("low_status") != "not_assessable").alias("a"), F.count_if(F.col("low_status") == "adherent").alias("n")
    )
    rows = [("days", "User-days", "d", "d"), ("assessable", "Assessable days", "a", "d"), ("adherent", "Adherent of assessable", "n", "a")]
    return slices.summary_rows(totals, rows).withColumn("rate", F.round("rate", 6))


@query(
    "cohort_flow",
    """SELECT 1 AS step, 'all events' AS label, count(*) AS n_rows, count(DISTINCT user_id) AS n_user_id FROM events
UNION ALL SELECT 2, 'purchases', count(*), count(DISTINCT user_id) FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 3, 'large purchases', count(*), count(DISTINCT user_id) FROM events WHERE event_type = 'purchase' AND value > 100""",
)
def flow(t: Tables):
    e = t.events.select("user_id", "event_type", "value")
    buys = e.where("event_type = 'purchase'")
    return slices.flow_counts([("all events", e), ("purchases", buys), ("large purchases", buys.where("value > 100"))], ["user_id"])


@query(
    "order_rollup_to_customer",
    """WITH s AS (SELECT l_orderkey, count(*) AS k, sum(l_quantity) AS h, max(l_quantity) AS m, min(l_shipdate) AS f FROM lineitem GROUP BY 1)
SELECT o_custkey, bool_or(k IS NOT NULL) AS present, coalesce(bool_or(m >= 45), false) AS any_long, coalesce(sum(k), 0)::BIGINT AS n_sessions, coalesce(sum(h), 0) AS total_hours,
  coalesce(max(m), 0) AS longest, strftime(min(f), '%Y-%m-%d') AS first_day FROM orders LEFT JOIN s ON l_orderkey = o_orderkey GROUP BY o_custkey""",
)
def rollup(t: Tables):
    per = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("k"), F.sum("l_quantity").alias("h"), F.max("l_quantity").alias("m"), F.min("l_shipdate").alias("f")
    )
    keyed = t.orders.select("o_custkey", F.col("o_orderkey").alias("l_orderkey")).join(per, "l_orderkey", "left")
    return keyed.groupBy("o_custkey").agg(
        F.bool_or(F.col("k").isNotNull()).alias("present"),
        F.coalesce(F.bool_or(F.col("m") >= 45), F.lit(False)).alias("any_long"),
        F.coalesce(F.sum("k"), F.lit(0)).alias("n_sessions"),
        F.coalesce(F.sum("h"), F.lit(0.0)).alias("total_hours"),
        F.coalesce(F.max("m"), F.lit(0.0)).alias("longest"),
        F.date_format(F.min("f"), "yyyy-MM-dd").alias("first_day"),
    )


@query(
    "grouped_mode",
    """SELECT o_orderpriority, o_orderstatus AS usual_status FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus) AS rn
FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)) WHERE rn = 1""",
)
def modes(t: Tables):
    out = attribution.primary_unit(t.orders, ["o_orderpriority"], "o_orderstatus")
    return out.withColumnRenamed("o_orderstatus", "usual_status")


@query(
    "first_order_and_ids",
    """SELECT o_custkey, min_by(o_totalprice, (o_orderdate, o_orderkey)) AS first_price, list_sort(list(o_orderkey))::VARCHAR AS ids, count(*) AS n FROM orders GROUP BY o_custkey""",
)
def first_and_list(t: Tables):
    out = t.orders.groupBy("o_custkey").agg(
        F.min_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("first_price"), F.array_sort(F.collect_list("o_orderkey")).alias("ids"), F.count(F.lit(1)).alias("n")
    )
    return out.withColumn("ids", F.concat(F.lit("["), F.array_join(F.col("ids").cast("array<string>"), ", "), F.lit("]")))


# ---------------------------------------------------------------- checks

@query(
    "minute_chain_violations",
    f"""WITH {_USER_DAYS.strip()[4:]} SELECT 'in_le_assessable' AS rule, count(*) FILTER (WHERE low_in_us > low_assessable_us) AS n_violations FROM sd
UNION ALL SELECT 'assessable_le_total', count(*) FILTER (WHERE low_assessable_us > total_us) FROM sd
UNION ALL SELECT 'mid_le_low', count(*) FILTER (WHERE mid_assessable_us > low_assessable_us) FROM sd
UNION ALL SELECT 'half_day', count(*) FILTER (WHERE total_us > {DAY // 2}) FROM sd""",
)
def violations(t: Tables):
    rules = {
        "in_le_assessable": checks.chain(["low_in_us", "low_assessable_us"]),
        "assessable_le_total": checks.chain(["low_assessable_us", "total_us"]),
        "mid_le_low": checks.chain(["mid_assessable_us", "low_assessable_us"]),
        "half_day": F.col("total_us") <= F.lit(DAY // 2),
    }
    return checks.violations(user_days(t), rules)


_TOTALS = f"""WITH {_USER_DAYS.strip()[4:]},
u AS (SELECT unit, count(*) AS n FROM sd GROUP BY unit), a AS (SELECT count(*) AS n FROM sd),
g AS (SELECT 'units' AS part, sum(n) AS n FROM u UNION ALL SELECT 'month', sum(n) FROM (SELECT count(*) AS n FROM sd GROUP BY month)
      UNION ALL SELECT 'week', sum(n) FROM (SELECT count(*) AS n FROM sd GROUP BY week)),
nm AS (SELECT unit, sum(n) AS n FROM (SELECT unit, unit_name, count(*) AS n FROM sd GROUP BY unit, unit_name) GROUP BY unit)
"""


@query(
    "cube_reconciles",
    _TOTALS
    + """SELECT (SELECT count(*) FROM g, a WHERE g.n <> a.n) + (SELECT count(*) FROM u JOIN nm USING (unit) WHERE u.n <> nm.n) AS n_mismatching_groups, (SELECT n FROM a) AS n_days""",
)
def integrity(t: Tables):
    days = user_days(t)
    bad = checks.slice_integrity(slice_cube(days, status_cols()), list(status_cols()))
    return bad.agg(F.count(F.lit(1)).alias("n_mismatching_groups")).crossJoin(F.broadcast(days.agg(F.count(F.lit(1)).alias("n_days"))))


@query(
    "damaged_cube_is_reported",
    _TOTALS
    + """, w AS (SELECT min(unit) AS unit FROM u),
d AS (SELECT u.unit, u.n + CASE WHEN u.unit = w.unit THEN 1 ELSE 0 END AS n FROM u, w)
SELECT 'units' AS "group", (SELECT n FROM a) AS n_total, CAST((SELECT sum(n) FROM d) AS BIGINT) AS n_found
UNION ALL SELECT d.unit, d.n, CAST(nm.n AS BIGINT) FROM d JOIN nm USING (unit) WHERE d.n <> nm.n""",
)
def damaged(t: Tables):
    """A cube with one day too many in its first unit: the units' sum and that unit's names must be reported."""
    cube = slice_cube(user_days(t), {"n": F.count(F.lit(1))})
    unit_rows = (F.col("dim") == "type") & (F.col("granularity") == "all") & (F.col("unit") != "__ALL__")
    first = cube.where(unit_rows).agg(F.min("unit").alias("first"))
    cube = cube.join(F.broadcast(first)).withColumn("n", F.col("n") + F.when(unit_rows & (F.col("unit") == F.col("first")), 1).otherwise(0)).drop("first")
    bad = checks.slice_integrity(cube, ["n"])
    total = F.when(F.col("group") == "units", F.col("other_n")).otherwise(F.col("other_n"))
    found = F.col("n")
    return bad.select("group", total.alias("n_total"), found.alias("n_found"))


@query(
    "names_that_do_not_nest",
    "SELECT p_brand, min(p_type) AS lowest, max(p_type) AS highest FROM part GROUP BY p_brand HAVING min(p_type) <> max(p_type)",
)
def nesting(t: Tables):
    return checks.not_nested(t.part, "p_brand", "p_type")
