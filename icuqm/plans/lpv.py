"""Lung-protective ventilation: cohort, day status, sweep, summaries, histograms, feed (M1-M3, M5-M8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuqm.config import SETTING_RANGES, LungProtection, Severity, Site
from icuqm.functions.clinical import at_most, null_outside, predicted_body_weight, years_between
from icuqm.functions.time import local_day, micros, minutes
from icuqm.operators import adherence as ad
from icuqm.operators.asof import asof_contained
from icuqm.operators.attribution import majority_nested
from icuqm.operators.distribution import exact_quantiles, weighted_hist
from icuqm.operators.intervals import carry_forward, split_by_day
from icuqm.operators.profile import day_span
from icuqm.operators.slices import ALL, attach_periods, slice_cube
from icuqm.plans import severity
from icuqm.plans.common import ICU, IMV, Tables
from icuqm.session import cut_lineage
from icuqm.sources.feeds import build_feed
from icuqm.sources.stages import Keep, cut

KEY = ("hospitalization_id", "day")
MEASURES = ("vt", "plat", "dp", "comp")


def adults(t: Tables, cfg: LungProtection) -> DataFrame:
    """Stays of adults with sex and age (F1)."""
    people = t["patient"].select("patient_id", "birth_date", "sex_category")
    stays = t["hospitalization"].select("hospitalization_id", "patient_id", "admission_dttm").join(people, "patient_id", "left")
    aged = stays.withColumn("age_at_admit", years_between(F.col("birth_date"), F.col("admission_dttm")))
    return aged.where(F.col("age_at_admit") >= F.lit(cfg.adult_years)).select("hospitalization_id", "patient_id", "sex_category", "age_at_admit")


def attributed_rows(t: Tables, cfg: LungProtection) -> DataFrame:
    """Ventilator rows of adults with the unit stay that had started last, and whether it still ran."""
    who = adults(t, cfg).select("hospitalization_id")
    rs = t["respiratory_support"]
    vent = rs.where(F.col("device_category") == IMV).select("hospitalization_id", micros(rs, "recorded_dttm").alias("at"))
    adt = t["adt"].where(F.col("location_category") == ICU)
    stays = adt.select(
        "hospitalization_id",
        micros(adt, "in_dttm").alias("icu_in"),
        micros(adt, "out_dttm").alias("icu_out"),
        F.coalesce("location_type", F.lit("__unknown_icu_type__")).alias("assigned_unit"),
        F.coalesce("location_name", F.lit("__unknown_unit__")).alias("assigned_unit_name"),
    )
    rows = vent.join(who, "hospitalization_id", "left_semi")
    near = asof_contained(
        rows, stays, ["hospitalization_id"], "at", "icu_in", "icu_out", "in_icu", ["icu_out", "assigned_unit", "assigned_unit_name"]
    )
    return near.withColumn("day", local_day(F.col("at")))


def heights(t: Tables, days: DataFrame, who: DataFrame, cfg: LungProtection) -> DataFrame:
    """Median height per stay, else the person's median of those medians."""
    tall = t["vitals"].where(F.col("vital_category") == "height_cm").select("hospitalization_id", F.col("vital_value").alias("h"))
    tall = tall.join(days.select("hospitalization_id").distinct(), "hospitalization_id", "left_semi")
    tall = tall.withColumn("h", null_outside(F.col("h"), cfg.height_range))
    per_stay = exact_quantiles(tall, ["hospitalization_id"], "h", {"own": 0.5}).select("hospitalization_id", "own")
    linked = per_stay.join(who.select("hospitalization_id", "patient_id"), "hospitalization_id")
    per_person = exact_quantiles(linked, ["patient_id"], "own", {"usual": 0.5}).select("patient_id", "usual")
    both = who.select("hospitalization_id", "patient_id").join(per_stay, "hospitalization_id", "left").join(per_person, "patient_id", "left")
    return both.select("hospitalization_id", F.coalesce("own", "usual").alias("height_cm"))


def attributed_days(t: Tables, cfg: LungProtection) -> DataFrame:
    """Days with ventilator rows in a unit, and the unit that most of them lie in."""
    inside = attributed_rows(t, cfg).where("in_icu")
    return majority_nested(inside, list(KEY), "assigned_unit", "assigned_unit_name").withColumnRenamed("n_rows", "n_imv_rows")


def cohort_days(t: Tables, cfg: LungProtection, attributed: DataFrame | None = None) -> DataFrame:
    """Patient-days on a ventilator in a unit (M1)."""
    who = adults(t, cfg)
    days = cut_lineage(attributed_days(t, cfg)) if attributed is None else attributed
    out = days.join(who, "hospitalization_id", "left").join(heights(t, days, who, cfg), "hospitalization_id", "left")
    return out.withColumn("pbw_kg", predicted_body_weight(F.col("height_cm"), F.col("sex_category"), cfg.min_pbw))


def stages(t: Tables, cfg: LungProtection, grades: Severity, keep: Keep = cut) -> dict[str, DataFrame]:
    """All stages of the measure, each from the stored ones before it (M1-M6)."""
    people = ("patient", "hospitalization", "vitals")
    attributed = keep("lpv_attributed", lambda: attributed_days(t, cfg), ("patient", "hospitalization", "respiratory_support", "adt"), cfg)
    days = keep("lpv_days", lambda: cohort_days(t, cfg, attributed), ("lpv_attributed", *people), cfg)
    pieces = keep("lpv_pieces", lambda: interval_pieces(t, days, cfg), ("lpv_days", "respiratory_support"), cfg)
    status = keep("lpv_status", lambda: day_status(days, pieces, cfg), ("lpv_days", "lpv_pieces"), cfg)
    grade = keep("lpv_severity", lambda: severity.classify_days(t, days, grades), ("lpv_days", "respiratory_support", "labs", "vitals"), grades)
    return {"days": days, "pieces": pieces, "status": status, "severity": grade}


def interval_pieces(t: Tables, days: DataFrame, cfg: LungProtection) -> DataFrame:
    """Settings in force per interval and local day, with nullable components (T-CF, T-LI, T-DS2, F8-F11)."""
    rs = t["respiratory_support"]
    # one row per stay; rows get their weight here, as the pieces are more and wider
    weights = days.groupBy("hospitalization_id").agg(F.max("pbw_kg").alias("pbw_kg"))
    scoped = rs.join(weights, "hospitalization_id")
    clean = scoped.withColumns({c: null_outside(F.col(c), r) for c, r in SETTING_RANGES.items()})
    peep_here = F.coalesce("peep_obs", "peep_set")
    carries = {
        "vt_obs_eff": (F.col("tidal_volume_obs"), cfg.fast_carry),
        "vt_set_eff": (F.col("tidal_volume_set"), cfg.fast_carry),
        "peep_obs_eff": (F.col("peep_obs"), cfg.fast_carry),
        "peep_set_eff": (F.col("peep_set"), cfg.fast_carry),
        "fio2": (F.col("fio2_set"), cfg.fast_carry),
        "plateau": (F.col("plateau_pressure_obs"), cfg.slow_carry),
        "mode": (F.col("mode_category"), cfg.slow_carry),
        "peep_with_plateau": (F.when(F.col("plateau_pressure_obs").isNotNull(), peep_here), cfg.slow_carry),
    }
    order = ["device_category", "mode_category", "tidal_volume_obs", "tidal_volume_set", "plateau_pressure_obs", "peep_obs", "peep_set", "fio2_set"]
    held = carry_forward(clean, ["hospitalization_id"], "recorded_dttm", carries, order, lead=(cfg.max_gap, cfg.trail))
    slim = held.select(
        "hospitalization_id",
        "pbw_kg",
        "device_category",
        "mode",
        F.coalesce("vt_obs_eff", "vt_set_eff").alias("vt"),
        F.coalesce("peep_obs_eff", "peep_set_eff").alias("peep"),
        "peep_with_plateau",
        "plateau",
        "fio2",
        "start",
        "end",
    )
    pieces = split_by_day(slim, two_piece=True)
    bound = F.coalesce("peep_with_plateau", "peep")
    pieces = pieces.withColumns(
        {
            "is_imv": F.coalesce(F.col("device_category") == IMV, F.lit(False)),
            "mode_ok": F.coalesce(F.col("mode").isin(*cfg.modes), F.lit(False)),
            "vt_per_pbw": F.col("vt") / F.col("pbw_kg"),
            # a plateau below the pressure it was measured against is impossible
            "plateau": F.when(~F.coalesce(F.col("plateau") < bound, F.lit(False)), F.col("plateau")),
        }
    )
    pressure = F.col("plateau") - F.col("peep_with_plateau")
    return pieces.withColumn("driving_pressure", F.when(pressure >= 0, pressure))


def measures(cfg: LungProtection, vt_max: float) -> dict[str, ad.Measure]:
    """Each measure's own denominator and threshold."""
    usable = F.col("is_imv") & F.col("mode_ok")
    vt_seen = usable & F.col("vt_per_pbw").isNotNull()
    plat_seen = usable & F.col("plateau").isNotNull()
    dp_seen = usable & F.col("driving_pressure").isNotNull()
    vt_ok, plat_ok = at_most(F.col("vt_per_pbw"), vt_max), at_most(F.col("plateau"), cfg.plateau_max)
    dp_ok = at_most(F.col("driving_pressure"), cfg.dp_max)
    return {
        "vt": ad.Measure(vt_seen, vt_ok),
        "plat": ad.Measure(plat_seen, plat_ok),
        "dp": ad.Measure(dp_seen, dp_ok),
        "comp": ad.Measure(vt_seen & dp_seen, vt_ok & plat_ok & dp_ok),
    }


def day_status(days: DataFrame, pieces: DataFrame, cfg: LungProtection) -> DataFrame:
    """Status of all four measures per patient-day (M2), with the feed's wider volume cutoff (``vt8``)."""
    rules = measures(cfg, cfg.vt_max)
    rules["vt8"] = measures(cfg, cfg.feed_cutoff)["vt"]
    totals = {"total_imv": F.col("is_imv"), "mode_eligible": F.col("is_imv") & F.col("mode_ok")}
    roll = ad.masked_time(pieces, list(KEY), rules, totals)
    spans = day_span(days, ["hospitalization_id"], "day", cfg.long_span_days)
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in roll.columns if c.endswith("_us")}
    out = days.join(roll, list(KEY), "left").withColumns(filled).join(spans, "hospitalization_id", "left")
    out = ad.classify(out, [*MEASURES, "vt8"], cfg.floor, cfg.adherence_fraction)
    return attach_periods(
        out.withColumns({"total_imv_minutes": minutes(F.col("total_imv_us")), "mode_eligible_minutes": minutes(F.col("mode_eligible_us"))})
    )


def interval_table(pieces: DataFrame, days: DataFrame) -> DataFrame:
    """Eligible pieces of cohort days with their components and unit (M3)."""
    units = days.select(*KEY, "assigned_unit", "assigned_unit_name")
    cols = [*KEY, "start", "end", "minutes", "vt_per_pbw", "plateau", "driving_pressure", "peep", "fio2"]
    return pieces.where("is_imv and mode_ok").select(*cols).join(units, list(KEY))


def _bucket_heads(df: DataFrame, pooled: bool, split: bool) -> DataFrame:
    """Repeat rows for the pooled unit, the unit and the specific unit they belong to."""
    heads = []
    if pooled:
        heads.append(F.struct(F.lit(ALL).alias("unit"), F.lit("type").alias("dim")))
    if split:
        heads.append(F.struct(F.col("assigned_unit").alias("unit"), F.lit("type").alias("dim")))
        heads.append(F.struct(F.col("assigned_unit_name").alias("unit"), F.lit("name").alias("dim")))
    return df.withColumn("_h", F.explode(F.array(*heads))).select("*", "_h.unit", "_h.dim").drop("_h").where("unit is not null")


def summaries(status: DataFrame, severity: DataFrame) -> DataFrame:
    """Status counts per day, week and month; months also by severity (M5)."""
    known = status.join(severity.select(*KEY, "severity"), list(KEY), "left").withColumn("severity", F.coalesce("severity", F.lit("unknown")))
    finest = ["day", "week", "month", "assigned_unit", "assigned_unit_name", "severity"]
    fine = ad.status_counts(known, finest, MEASURES).drop("assessable_rate", "crude_rate")
    buckets = F.array(
        *[
            F.struct(F.lit(g).alias("granularity"), c.cast("string").alias("period"), s.alias("stratum"))
            for g, c, s in [
                ("day", F.col("day"), F.lit("all")),
                ("week", F.col("week"), F.lit("all")),
                ("month", F.col("month"), F.col("severity")),
            ]
        ]
    )
    counts = ["n_total", "n_adherent", "n_non_adherent", "n_not_assessable"]
    listed = _bucket_heads(fine, True, True).withColumn("_b", F.explode(buckets)).select("_b.*", "unit", "dim", "measure", *counts)
    out = listed.groupBy("granularity", "period", "unit", "dim", "stratum", "measure").agg(*[F.sum(c).alias(c) for c in counts])
    return out.withColumns(ad.both_rates())


def cutoff_grids(intervals: DataFrame, status: DataFrame, severity: DataFrame, cfg: LungProtection) -> DataFrame:
    """Adherent days at every volume cutoff: months by severity, weeks, and days pooled (M6)."""
    spine = status.join(severity.select(*KEY, "severity"), list(KEY), "left").select(
        *KEY, "week", "month", "assigned_unit", "assigned_unit_name", F.coalesce("severity", F.lit("unknown")).alias("severity")
    )
    vt_seen = F.col("vt_per_pbw").isNotNull()
    comp_seen = vt_seen & F.col("plateau").isNotNull() & F.col("driving_pressure").isNotNull()
    fixed = at_most(F.col("plateau"), cfg.plateau_max) & at_most(F.col("driving_pressure"), cfg.dp_max)
    extras = {"vt": ad.Measure(vt_seen, F.lit(True)), "comp": ad.Measure(comp_seen, fixed)}
    slim = intervals.drop("assigned_unit", "assigned_unit_name")
    swept = ad.cutoff_sweep(slim, list(KEY), "vt_per_pbw", cfg.cutoffs, extras, spine=spine)
    fine = ad.sweep_counts(swept, ["day", "week", "month", "assigned_unit", "assigned_unit_name", "severity"], cfg.floor, cfg.adherence_fraction)
    counts = ["n_total", "n_assessable", "n_adherent"]
    fine = fine.select("day", "week", "month", "assigned_unit", "assigned_unit_name", "severity", "measure", "cutoff", *counts)
    b = lambda g, c, s: F.struct(F.lit(g).alias("granularity"), c.cast("string").alias("period"), s.alias("stratum"))
    buckets = F.array(b("week", F.col("week"), F.lit("all")), b("month", F.col("month"), F.col("severity")))
    split = _bucket_heads(fine, True, True).withColumn("_b", F.explode(buckets))
    pooled = _bucket_heads(fine, True, False).withColumn("_b", b("day", F.col("day"), F.lit("all")))
    listed = split.select("_b.*", "unit", "dim", "measure", "cutoff", *counts).unionByName(pooled.select("_b.*", "unit", "dim", "measure", "cutoff", *counts))
    out = listed.groupBy("granularity", "period", "unit", "dim", "stratum", "measure", "cutoff").agg(*[F.sum(c).alias(c) for c in counts])
    return out.withColumns(ad.both_rates(assessable=F.col("n_assessable")))


# Histogram ranges and steps of the interval components.
HISTOGRAMS = {
    "vt_per_pbw": (0.0, 15.0, 0.25),
    "plateau": (0.0, 60.0, 1.0),
    "driving_pressure": (0.0, 50.0, 1.0),
    "peep": (0.0, 30.0, 1.0),
    "fio2": (0.2, 1.0, 0.05),
}


def histograms(intervals: DataFrame, severity: DataFrame, by_week: bool = False) -> DataFrame:
    """Minutes per bin of every component by month and severity, or by week."""
    rows = attach_periods(intervals.join(severity.select(*KEY, "severity"), list(KEY), "left"))
    keys = ["week"] if by_week else ["month", "severity"]
    out = None
    for column, (lo, hi, step) in HISTOGRAMS.items():
        part = weighted_hist(rows, keys, column, F.col("end") - F.col("start"), lo, hi, step).select(
            F.lit(column).alias("component"), *keys, "bin", minutes(F.col("weight")).alias("minutes")
        )
        out = part if out is None else out.unionByName(part)
    return out


def table_one(status: DataFrame, severity: DataFrame) -> DataFrame:
    """Stay-level description per severity stratum and period.

    Long rows: ``stratum, granularity, period, variable, level`` with ``n``, quartiles or percent.
    """
    known = status.join(severity.select(*KEY, "severity"), list(KEY), "left").withColumn("severity", F.coalesce("severity", F.lit("unknown")))
    s = lambda stratum, g, p: F.struct(stratum.alias("stratum"), F.lit(g).alias("granularity"), p.alias("period"))
    grains = [("all", F.lit("all")), ("year", F.col("year")), ("month", F.col("month"))]
    wanted = [s(x, g, p) for x in (F.lit("all"), F.col("severity")) for g, p in grains] + [s(F.lit("all"), "week", F.col("week"))]
    cell = ["stratum", "granularity", "period"]
    rows = known.withColumn("_s", F.explode(F.array(*wanted))).select("_s.*", *KEY, "age_at_admit", "sex_category", "height_cm", "pbw_kg", "assigned_unit")
    per_unit = rows.groupBy(*cell, "hospitalization_id", "assigned_unit").agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in ("age_at_admit", "sex_category", "height_cm", "pbw_kg")]
    )
    stays = per_unit.groupBy(*cell, "hospitalization_id").agg(
        F.sum("_n").cast("double").alias("n_days"),
        F.min(F.struct(-F.col("_n"), F.col("assigned_unit"))).alias("_u"),
        *[F.max(c).alias(c) for c in ("age_at_admit", "sex_category", "height_cm", "pbw_kg")],
    )
    numbers = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("v")) for c in ("age_at_admit", "height_cm", "pbw_kg", "n_days")])
    stacked = stays.select(*cell, F.explode(numbers).alias("_p")).select(*cell, "_p.*")
    quart = exact_quantiles(stacked, [*cell, "variable"], "v", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    none = F.lit(None).cast("double")
    cont = quart.select(*cell, "variable", F.lit("").alias("level"), "n", none.alias("pct"), "median", "q1", "q3")
    levels = F.array(
        F.struct(F.lit("sex_category").alias("variable"), F.coalesce("sex_category", F.lit("unknown")).alias("level")),
        F.struct(F.lit("primary_unit").alias("variable"), F.col("_u.assigned_unit").alias("level")),
    )
    sizes = stays.groupBy(*cell).agg(F.count(F.lit(1)).alias("_size"))
    cats = stays.select(*cell, F.explode(levels).alias("_p")).select(*cell, "_p.*").groupBy(*cell, "variable", "level").agg(F.count(F.lit(1)).alias("n"))
    cats = cats.join(sizes, cell).select(*cell, "variable", "level", "n", (F.col("n") * 100.0 / F.col("_size")).alias("pct"), none.alias("median"), none.alias("q1"), none.alias("q3"))
    return cont.unionByName(cats)


def feed_cube(status: DataFrame, severity: DataFrame) -> DataFrame:
    """Numerators and denominators of the feed per slice (M7)."""
    known = status.join(severity.select(*KEY, "severity"), list(KEY), "left").withColumnsRenamed(
        {"assigned_unit": "unit", "assigned_unit_name": "unit_name"}
    )
    severe = F.coalesce(F.col("severity") == "severe", F.lit(False))
    able = lambda m: F.col(f"{m}_status") != "not_assessable"
    good = lambda m: F.col(f"{m}_status") == "adherent"
    counts = {"n": F.count(F.lit(1)), "imv_us": F.sum("total_imv_us")}
    for m in ("vt8", "plat", "dp"):
        counts |= {f"{m}_num": F.count_if(good(m)), f"{m}_den": F.count_if(able(m))}
    counts |= {"vt8sev_num": F.count_if(severe & good("vt8")), "vt8sev_den": F.count_if(severe & able("vt8"))}
    return slice_cube(known, counts)


def feed(cube: DataFrame, site: Site, cfg: LungProtection, generated: str) -> DataFrame:
    cut = f"{cfg.feed_cutoff:g}"
    cell = lambda m: {"num": F.col(f"{m}_num"), "den": F.col(f"{m}_den")}
    hours = F.bround(F.col("imv_us") / F.lit(3_600_000_000.0)).cast("bigint")
    return build_feed(
        cube,
        site,
        metric_id="lpv",
        title="LPV Adherence",
        subtitle=F.lit(f"Tidal volume ≤ {cut} mL/kg PBW"),
        icon="lpv",
        goal=cfg.goal,
        note=F.lit(None).cast("string"),
        labels=("adherent", "of assessable", "patient-days"),
        headline=cell("vt8") | {"n": F.col("n"), "hrs": hours},
        segments=[
            ("plat", "Plateau ≤ 30", None, cell("plat")),
            ("dp", "∆P ≤ 15", None, cell("dp")),
            ("vt8sev", f"Vt ≤ {cut} · severe", None, cell("vt8sev")),
        ],
        generated=generated,
        definition_version=cfg.definition_version,
    )


def integrity_rules() -> dict:
    """Row rules of the day status."""
    rules = {}
    for m in MEASURES:
        rules[f"{m}_in_le_assessable"] = F.col(f"{m}_in_us") <= F.col(f"{m}_assessable_us")
        rules[f"{m}_assessable_le_eligible"] = F.col(f"{m}_assessable_us") <= F.col("mode_eligible_us")
        rules[f"{m}_fraction"] = F.coalesce(F.col(f"{m}_fraction").between(0, 1), F.lit(True))
    rules["eligible_le_total"] = F.col("mode_eligible_us") <= F.col("total_imv_us")
    rules["comp_le_vt"] = F.col("comp_assessable_us") <= F.col("vt_assessable_us")
    rules["comp_le_dp"] = F.col("comp_assessable_us") <= F.col("dp_assessable_us")
    rules["day_le_25h"] = F.col("total_imv_minutes") <= 1500
    return rules


__all__: Sequence[str] = ["cohort_days", "interval_pieces", "day_status", "interval_table", "summaries", "cutoff_grids", "feed"]
