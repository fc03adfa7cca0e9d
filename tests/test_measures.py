"""Fixtures of adherence, attribution, slices, masks, distributions and row rules."""

import math

import pytest
from helpers import HOUR, MINUTE, at, rows
from pyspark.sql import functions as F

from icuqm.functions import clinical
from icuqm.functions.time import localise, month_key, month_of_week, week_key, week_label
from icuqm.operators import adherence, attribution, checks, distribution, masks, profile, slices


@pytest.mark.parametrize(
    ("assessable", "inside", "status"),
    [(59, 59, "not_assessable"), (60, 48, "adherent"), (60, 47, "non_adherent"), (0, 0, "not_assessable")],
)
def test_classification(spark, assessable, inside, status):
    df = spark.createDataFrame([(assessable * MINUTE, inside * MINUTE)], "m_assessable_us long, m_in_us long")
    assert rows(adherence.classify(df, ["m"]), "m_status") == [(status,)]


def test_masked_time_uses_each_measures_own_denominator(spark):
    df = spark.createDataFrame([("a", 0, HOUR, 5.0), ("a", HOUR, 3 * HOUR, None), ("a", 3 * HOUR, 4 * HOUR, 9.0)], "k string, start long, end long, v double")
    rule = adherence.Measure(F.col("v").isNotNull(), clinical.at_most(F.col("v"), 6))
    out = adherence.masked_time(df, ["k"], {"m": rule}, {"all": F.lit(True)})
    assert rows(out, "all_us", "m_assessable_us", "m_in_us") == [(4 * HOUR, 2 * HOUR, HOUR)]


def test_cutoff_sweep_keeps_spine_days_without_pieces(spark):
    pieces = spark.createDataFrame([("a", 0, 2 * HOUR, 5.0), ("a", 2 * HOUR, 3 * HOUR, 7.0)], "k string, start long, end long, v double")
    spine = spark.createDataFrame([("a", "u"), ("b", "u")], "k string, unit string")
    swept = adherence.cutoff_sweep(pieces, ["k"], "v", [4, 6, 8], {"m": adherence.Measure(F.lit(True), F.lit(True))}, spine=spine)
    out = adherence.sweep_counts(swept, ["unit"])
    assert rows(out, "cutoff", "n_total", "n_assessable", "n_adherent") == [(4.0, 2, 1, 0), (6.0, 2, 1, 0), (8.0, 2, 1, 1)]


def test_majority_ties_are_alphabetical_and_names_nest(spark):
    df = spark.createDataFrame([("d", "b", "b1"), ("d", "b", "b1"), ("d", "a", "a2"), ("d", "a", "a1")], "day string, unit string, name string")
    assert rows(attribution.majority_nested(df, ["day"], "unit", "name"), "unit", "name", "n_rows") == [("a", "a1", 4)]


def test_longest_piece_beats_the_larger_sum(spark):
    data = [("d", "a", "a1", 0, 50), ("d", "b", "b1", 50, 90), ("d", "b", "b2", 90, 130), ("d", None, "x", 200, 900)]
    df = spark.createDataFrame([(d, u, n, s * MINUTE, e * MINUTE) for d, u, n, s, e in data], "day string, unit string, name string, start long, end long")
    out = attribution.longest_piece_nested(df, ["day"], "unit", "name")
    assert rows(out, "unit", "name", "minutes", "day_in", "day_out") == [("a", "a1", 830.0, 0, 900 * MINUTE)]


def test_slice_cube_adds_up(spark):
    data = [("2023-10-31", "m", "n1", True), ("2023-11-01", "m", "n2", False), ("2023-11-20", "s", "n3", True)]
    df = slices.attach_periods(spark.createDataFrame(data, "day string, unit string, unit_name string, ok boolean"))
    cube = slices.slice_cube(df, {"n": F.count(F.lit(1)), "k": F.count_if("ok")})
    got = {(r.unit, r.granularity, r.period): (r.n, r.k, r.parent) for r in cube.collect()}
    assert got["__ALL__", "all", "all"] == (3, 2, None)
    assert got["m", "week", "2023-W44"] == (2, 1, None)
    assert got["n2", "month", "2023-11"] == (1, 0, "m")
    assert checks.slice_integrity(cube, ["n", "k"]).count() == 0
    assert checks.slice_integrity(cube.where("unit <> 's'"), ["n"]).count() > 0


def test_distinct_cube_is_not_additive(spark):
    data = [("2023-10-31", "m", "n1", "p"), ("2023-11-01", "m", "n1", "p"), ("2023-11-02", "s", "n3", "p")]
    df = slices.attach_periods(spark.createDataFrame(data, "day string, unit string, unit_name string, person string"))
    got = {(r.unit, r.granularity, r.period): r.n for r in slices.distinct_cube(df, "person", {"n": F.lit(True)}).collect()}
    assert (got["__ALL__", "all", "all"], got["m", "all", "all"], got["s", "all", "all"], got["__ALL__", "month", "2023-11"]) == (1, 1, 1, 1)


def test_masks(spark):
    data = [(True, True)] * 2 + [(True, False)]
    df = slices.attach_periods(spark.createDataFrame([("2023-10-31", "u", "n", a, b) for a, b in data], "day string, unit string, unit_name string, a boolean, b boolean"))
    hist = masks.mask_histogram(df, ["a", "b"]).where("unit = '__ALL__' and granularity = 'all'")
    assert rows(hist, "mask", "count") == [(1, 1), (3, 2)]
    assert rows(masks.mask_rate(hist, ["unit"], masks.bit(["a", "b"], "b"), masks.bit(["a", "b"], "a")), "n_days", "den", "num") == [(3, 2, 2)]
    assert rows(masks.mask_rate(hist, ["unit"], F.lit(True), F.lit(True)), "den") == [(3,)]
    steps = masks.mask_waterfall(hist, ["unit"], {"need b": masks.bit(["a", "b"], "b")})
    assert rows(steps, "step", "n", "removed") == [(0, 3, 0), (1, 2, 1)]


def test_quantiles(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4)] + [("h", 7.0)], "g string, v double")
    out = distribution.exact_quantiles(df, ["g"], "v", {"q1": 0.25, "median": 0.5})
    assert rows(out, "g", "n", "q1", "median") == [("g", 4, 1.75, 2.5), ("h", 1, 7.0, 7.0)]
    assert rows(distribution.nearest_rank(df.where("g = 'g'"), ["g"], "v", {"m": 0.5}), "m") == [(3.0,)]


def test_quantiles_with_many_ties_and_values(spark):
    import pandas as pd

    values = [float((i * 7919) % 1000) for i in range(5000)] + [3.0] * 2000
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = distribution.exact_quantiles(df, [], "v", {"a": 0.01, "b": 0.37, "c": 0.99}).first()
    want = pd.Series(values).quantile([0.01, 0.37, 0.99]).tolist()
    assert [out.a, out.b, out.c] == pytest.approx(want)


@pytest.mark.parametrize("ordered", [1, 3, 40, 10_000])
def test_quantiles_by_refinement_are_exact(spark, ordered):
    import pandas as pd

    data = [(g, float((i * 7919 * (k + 1)) % (50 * 10**k))) for k, g in enumerate("abc") for i in range(800)] + [("b", 1.0)] * 500 + [("d", 5.0), ("e", None)]
    df = spark.createDataFrame(data, "g string, v double")
    want = {g: pd.Series([v for h, v in data if h == g]) for g in "abcd"}
    out = distribution.exact_quantiles(df, ["g"], "v", {"lo": 0.0, "a": 0.013, "m": 0.5, "b": 0.98, "hi": 1.0}, ordered)
    got = {r.g: (r.n, r.lo, r.a, r.m, r.b, r.hi) for r in out.collect()}
    assert got == {g: (len(s), *[pytest.approx(s.quantile(q)) for q in (0, 0.013, 0.5, 0.98, 1)]) for g, s in want.items()}
    near = distribution.nearest_rank(df, ["g"], "v", {"m": 0.3}, ordered)
    assert {r.g: r.m for r in near.collect()} == {g: sorted(s)[math.floor(0.3 * (len(s) - 1) + 0.5)] for g, s in want.items()}
    ranks = distribution.value_ranks(df, ["g"], "v", ordered=ordered).where("g = 'c'").orderBy("v").collect()
    below = 0
    for r in ranks:
        assert (r.below, r.total) == (below, 800)
        below += r.n


def test_histograms(spark):
    df = spark.createDataFrame([(0.2, 1.0), (0.35, 1.0), (0.999, 2.0), (1.0, 5.0)], "v double, w double")
    assert rows(distribution.weighted_hist(df, [], "v", F.col("w"), 0.2, 1.0, 0.05), "bin", "weight") == [(0, 1.0), (2, 1.0), (15, 2.0)]
    clip = distribution.clipped_hist(spark.createDataFrame([(0.05,), (1.95,), (9.0,)], "v double"), [], "v", 20, 0.1)
    assert rows(clip, "bin", "n") == [(0, 1), (19, 2)]
    wide = distribution.bucketed(spark.createDataFrame([(4.9,), (5.0,), (9999.0,)], "v double"), [], "v", [0, 5, 15, 30])
    assert rows(wide, "bucket", "n") == [(0, 1), (1, 1), (3, 1)]


def test_rank_and_chi_square_tests(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (2.0, False), (4.0, False), (5.0, False)], "v double, g boolean")
    out = distribution.kruskal(df, "v", "g").first()
    # ranks 1, 2.5 | 2.5, 4, 5; tie factor 1 - 6/120
    want = (12 / 30 * (3.5**2 / 2 + 11.5**2 / 3) - 18) / (1 - 6 / 120)
    assert out.h == pytest.approx(want)
    assert out.p == pytest.approx(math.erfc(math.sqrt(want / 2)))
    cat = spark.createDataFrame([("x", True)] * 8 + [("y", True)] * 2 + [("x", False)] * 3 + [("y", False)] * 7, "c string, g boolean")
    got = profile.contingency_test(cat, "g", "c").first()
    n, a, b, c, d = 20, 8, 2, 3, 7
    yates = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert (got.chi2, got.dof) == (pytest.approx(yates), 1)


@pytest.mark.parametrize(("x", "dof", "p"), [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (18.307038053275146, 10, 0.05), (24.99579013972863, 15, 0.05)])
def test_chi_square_tail(spark, x, dof, p):
    got = spark.createDataFrame([(x, dof)], "x double, k int").select(distribution.p_value(F.col("x"), F.col("k"))).first()[0]
    assert got == pytest.approx(p, abs=1e-9)


def test_p_values_without_python_over_all_sizes(spark):
    def tail(x, dof):
        half = x / 2
        if dof % 2 == 0:
            return math.exp(-half) * sum(half**j / math.factorial(j) for j in range(dof // 2))
        return math.erfc(math.sqrt(half)) + math.exp(-half) * sum(half ** (j - 0.5) / math.gamma(j + 0.5) for j in range(1, (dof - 1) // 2 + 1))

    data = [(x, k) for x in (0.0, 1e-9, 0.3, 1.0, 3.99, 7.9, 8.1, 20.0, 90.0, 400.0) for k in (1, 2, 3, 4, 7, 8, 25, 30)]
    df = spark.createDataFrame([*data, (None, 3), (2.0, None), (2.0, 0)], "x double, k int").withColumn("p", distribution.p_value(F.col("x"), F.col("k")))
    for r in df.collect():
        if (r["x"], r["k"]) in data:
            assert r["p"] == pytest.approx(tail(r["x"], r["k"]), rel=1e-9, abs=1e-14)
        else:
            assert r["p"] is None
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_cumulative_incidence_counts_negative_times_and_never_events(spark):
    df = spark.createDataFrame([(-1.0,), (30.0,), (None,), (None,)], "h double")
    assert rows(slices.cumulative_incidence(df, "h", [24, 48]), "horizon_h", "num", "den") == [(24, 1, 4), (48, 2, 4)]


def test_body_weight(spark):
    df = spark.createDataFrame([(180.0, "male"), (100.0, "female"), (170.0, None)], "h double, s string")
    got = [r[0] for r in df.select(clinical.predicted_body_weight(F.col("h"), F.col("s"))).collect()]
    assert got[0] == pytest.approx(75.0, abs=0.1)
    assert got[1:] == [None, None]


def test_iso_periods(spark):
    df = spark.sql("select date'2021-01-01' as d")
    assert df.select(week_key("d"), month_key("d"), month_of_week(F.lit("2023-W42")), month_of_week(F.lit("2020-W53")), week_label(F.lit("2023-W05"))).first()[:] == (
        "2020-W53", "2021-01", "2023-10", "2020-12", "Week 5 · Jan 2023",
    )


def test_local_times_around_clock_changes(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    df = spark.createDataFrame([("2024-11-03 01:30:00",), ("2024-03-10 02:30:00",), ("2024-06-01 12:00:00",)], "s string")
    out = df.select(localise(F.col("s").cast("timestamp_ntz")).cast("string").alias("t"))
    assert [r.t for r in out.collect()] == [None, "2024-03-10 03:00:00", "2024-06-01 12:00:00"]


def test_categories(spark):
    df = spark.createDataFrame([(" IMV ", "Precedex drip"), ("", "Propofol 10"), (None, "Cisatracurium"), ("x", None)], "a string, b string")
    out = df.select(clinical.category(F.col("a")).alias("a"), clinical.drug_bucket(F.col("b")).alias("b"))
    assert [tuple(r) for r in out.collect()] == [("imv", "dexmedetomidine"), (None, "sat_relevant"), (None, "paralytic"), ("x", "other")]


def test_reconcile_and_violations(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n long")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 0)], "k string, n long")
    assert rows(checks.reconcile(a, b, ["k"], ["n"]), "k", "n", "other_n") == [("y", 2, 3)]
    assert rows(checks.violations(b, {"pos": F.col("n") > 0}), "rule", "n_violations") == [("pos", 1)]
    assert checks.not_nested(spark.createDataFrame([("n", "a"), ("n", "b"), ("m", "a")], "c string, p string"), "c", "p").count() == 1


def test_table_one(spark):
    df = spark.createDataFrame([(1.0, "f", True), (3.0, "m", False), (5.0, None, True)], "age double, sex string, ever boolean")
    out = profile.table_one(df, "ever", ["age"], ["sex"])
    got = {(r.variable, r.level, r.grp): (r.n, r.median) for r in out.collect()}
    assert got["age", "", "overall"] == (3, 3.0)
    assert got["age", "", "yes"] == (2, 3.0)
    assert got["sex", "Unknown", "yes"] == (1, None)


def test_null_causes_and_span(spark):
    df = spark.createDataFrame([(None, None), (1.0, 2.0), (None, 1.0)], "v double, h double")
    out = profile.null_causes(df, [], "v", {"no height": F.col("h").isNull()})
    assert rows(out, "cause", "n") == [("no height", 1), ("other", 1), ("present", 1)]
    days = spark.sql("select 'a' k, date'2024-01-01' d union all select 'a', date'2024-12-31'")
    assert rows(profile.day_span(days, ["k"], "d"), "span_days", "long_span") == [(366, True)]


def test_monthly_series_fills_empty_months(spark):
    days = spark.sql("select 'a' k, date'2024-01-05' d union all select 'a', date'2024-03-05' union all select 'a', date'2024-03-06'")
    assert rows(profile.monthly_series(days, ["k"], "d").fillna(-9, ["change"]), "month", "n", "change") == [("2024-01", 1, -9.0), ("2024-02", 0, -1.0), ("2024-03", 2, -9.0)]


_ = at
