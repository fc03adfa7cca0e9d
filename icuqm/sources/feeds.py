"""Count-only feeds: build, write, read, validate, align and pool."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icuqm.config import FORBIDDEN_IN_FEEDS, UNIT_ORDER, Site
from icuqm.functions.clinical import mapped
from icuqm.functions.time import month_label, month_of_week, week_label

ALL = "__ALL__"
REQUIRED = ("schema_version", "metric_id", "title", "grain", "headline")
_CELL = "struct<num: bigint, den: bigint, n: bigint, hrs: double>"
_CELLS = f"map<string, map<string, {_CELL}>>"
FEED_SCHEMA = (
    "schema_version int, metric_id string, title string, subtitle string, icon string, detail_href string, goal double, note string, "
    "generated string, grain struct<units: array<string>, periods: array<string>>, "
    f"headline struct<label: string, den_label: string, n_unit: string, cells: {_CELLS}>, "
    f"segments array<struct<key: string, label: string, color: string, cells: {_CELLS}>>, "
    "dims struct<type: array<string>, name: array<string>, parent: map<string, string>, labels: map<string, string>>, "
    "ui struct<weeks: array<string>, week_label: map<string, string>, months: array<string>, month_label: map<string, string>, units: array<string>>, "
    "provenance struct<site_id: string, code_version: string, data_version: string, definition_version: string, generated: string>, "
    "_corrupt_record string"
)


def unit_rank(unit: Column) -> Column:
    """Position in the canonical unit order, others last (L3)."""
    out = F.lit(99)
    for i in range(len(UNIT_ORDER) - 1, -1, -1):
        out = F.when(unit == UNIT_ORDER[i], F.lit(i)).otherwise(out)
    return out


def _sorted_names(rank: Column, name: Column, keep: Column) -> Column:
    pairs = F.array_sort(F.collect_set(F.when(keep, F.struct(rank.alias("r"), name.alias("n")))))
    return F.transform(pairs, lambda p: p["n"])


def build_feed(
    cube: DataFrame,
    site: Site,
    *,
    metric_id: str,
    title: str,
    subtitle: Column,
    icon: str,
    goal: float | None,
    note: Column,
    labels: tuple[str, str, str],
    headline: Mapping[str, Column],
    segments: Sequence[tuple[str, str, str | None, Mapping[str, Column]]],
    generated: str,
    definition_version: str,
    grains: Sequence[str] = ("month", "week"),
) -> DataFrame:
    """One-row table ``metric_id, feed`` with the JSON text, from a slice cube.

    The cube has one row per unit and period, so its size follows the site's units and calendar and
    never the patient data. ``note`` and ``subtitle`` may use the cube's totals.
    """
    typed = F.col("dim") == "type"
    known = F.col("unit").isin(ALL, *UNIT_ORDER)
    name_ok = (F.col("dim") == "name") & (F.col("unit") != "unknown")
    used = cube.where(F.col("granularity").isin("all", *grains)).where((typed & known) | name_ok)

    # segments are one array, so a field that one of them has is null in the others
    fields = list(dict.fromkeys(f for _, _, _, cell in segments for f in cell))
    even = {key: {f: cell.get(f, F.lit(None).cast("double" if f == "hrs" else "bigint")) for f in fields} for key, _, _, cell in segments}
    parts = {"headline": headline, **even}
    per_unit = used.groupBy("unit").agg(
        *[
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct(F.col("period"), F.struct(*[c.alias(k) for k, c in cell.items()]).alias("v"))))
            ).alias(p)
            for p, cell in parts.items()
        ]
    )
    cells = per_unit.agg(*[F.map_from_entries(F.collect_list(F.struct("unit", F.col(p).alias("v")))).alias(p) for p in parts])
    names = F.map_from_entries
    friendly = dict(site.unit_labels)
    is_unit = typed & (F.col("unit") != ALL)
    unit_label = mapped(F.col("unit"), friendly)
    labelled = name_ok | (is_unit & F.col("unit").isin(*friendly) if friendly else F.lit(False))
    dims = used.agg(
        _sorted_names(unit_rank(F.col("unit")), F.col("unit"), is_unit).alias("type"),
        _sorted_names(unit_rank(F.col("parent")), F.col("unit"), name_ok).alias("name"),
        names(F.array_sort(F.collect_set(F.when(name_ok, F.struct("unit", "parent"))))).alias("parent"),
        names(F.array_sort(F.collect_set(F.when(labelled, F.struct(F.col("unit").alias("k"), unit_label.alias("v")))))).alias("labels"),
        F.array_sort(F.collect_set(F.when(F.col("granularity") == "week", F.col("period")))).alias("weeks"),
        F.array_sort(F.collect_set(F.when(F.col("granularity") == "month", F.col("period")))).alias("months"),
    )
    totals = used.where((F.col("unit") == ALL) & (F.col("granularity") == "all")).select(subtitle.alias("_subtitle"), note.alias("_note"))
    row = cells.crossJoin(F.broadcast(dims)).crossJoin(F.broadcast(totals))
    units = F.concat(F.array(F.lit(ALL)), F.col("type"))
    text = lambda v: F.lit(v).cast("string")
    label, den_label, n_unit = labels
    shown = []
    for key, name, color, _ in segments:
        fields = [text(key).alias("key"), text(name).alias("label")]
        if color:
            fields.append(text(color).alias("color"))
        shown.append(F.struct(*fields, F.col(key).alias("cells")))
    feed = F.struct(
        F.lit(1).alias("schema_version"),
        text(metric_id).alias("metric_id"),
        text(title).alias("title"),
        F.col("_subtitle").alias("subtitle"),
        text(icon).alias("icon"),
        text(f"{metric_id}_dashboard.html").alias("detail_href"),
        F.lit(goal).cast("double").alias("goal"),
        F.col("_note").alias("note"),
        text(generated).alias("generated"),
        F.struct(units.alias("units"), F.array(F.lit("all"), *[F.lit(g) for g in grains]).alias("periods")).alias("grain"),
        F.struct(F.col("type"), F.col("name"), F.col("parent"), F.col("labels")).alias("dims"),
        F.struct(text(label).alias("label"), text(den_label).alias("den_label"), text(n_unit).alias("n_unit"), F.col("headline").alias("cells")).alias("headline"),
        F.array(*shown).alias("segments"),
        F.struct(
            F.col("weeks"),
            names(F.transform("weeks", lambda w: F.struct(w, week_label(w)))).alias("week_label"),
            F.col("months"),
            names(F.transform("months", lambda m: F.struct(m, month_label(m)))).alias("month_label"),
            units.alias("units"),
        ).alias("ui"),
        F.struct(
            text(site.name).alias("site_id"),
            text(site.code_version).alias("code_version"),
            text(site.data_version).alias("data_version"),
            text(definition_version).alias("definition_version"),
            text(generated).alias("generated"),
        ).alias("provenance"),
    )
    return row.select(text(metric_id).alias("metric_id"), F.to_json(feed, {"ignoreNullFields": "false"}).alias("feed"))


def write_feed(feed: DataFrame, path: str) -> None:
    """The feed's JSON as text, refused if it contains an identifier column name (I8)."""
    hit = reduce(lambda a, b: a | b, [F.contains(F.col("feed"), F.lit(w)) for w in FORBIDDEN_IN_FEEDS])
    checked = feed.select(F.when(hit, F.raise_error(F.lit("the feed names an identifier column"))).otherwise(F.col("feed")).alias("value"))
    checked.coalesce(1).write.mode("overwrite").text(path)


def feed_problems(text: Column, feed: Column) -> Column:
    """Every broken rule of a parsed feed as an array of short codes; empty when valid."""
    cells = F.flatten(F.transform(F.map_values(feed["headline"]["cells"]), F.map_values))
    negative = F.exists(cells, lambda c: c["num"].isNull() | c["den"].isNull() | (c["num"] < 0) | (c["den"] < 0))
    rules = {
        "unreadable": feed.isNull() | feed["_corrupt_record"].isNotNull(),
        "schema_version": ~feed["schema_version"].eqNullSafe(F.lit(1)),
        "metric_id": ~F.coalesce(feed["metric_id"].rlike("^[a-z0-9_]+$"), F.lit(False)),
        "title": feed["title"].isNull(),
        "grain": F.coalesce(F.size(feed["grain"]["units"]) < 1, F.lit(True)) | F.coalesce(F.size(feed["grain"]["periods"]) < 1, F.lit(True)),
        "periods": F.exists(F.coalesce(feed["grain"]["periods"], F.array()), lambda p: ~p.isin("all", "month", "week")),
        "headline": feed["headline"]["cells"].isNull(),
        "counts": F.coalesce(negative, F.lit(False)),
        "goal": F.coalesce((feed["goal"] < 0) | (feed["goal"] > 1), F.lit(False)),
        "segments": F.coalesce(F.size(feed["segments"]) > 3, F.lit(False)),
        "identifiers": reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in FORBIDDEN_IN_FEEDS]),
    }
    return F.array_compact(F.array(*[F.when(rule, F.lit(n)) for n, rule in rules.items()]))


def parse_feeds(texts: DataFrame, column: str = "feed") -> DataFrame:
    """Feed texts with the parsed ``doc`` and its ``problems``."""
    doc = F.from_json(F.col(column), FEED_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = texts.withColumn("doc", doc)
    return parsed.withColumn("problems", feed_problems(F.col(column), F.col("doc")))


def read_feeds(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Feeds from files, one JSON document each, with their problems."""
    texts = spark.read.option("wholetext", True).text(list(paths)).select(F.input_file_name().alias("path"), F.col("value").alias("feed"))
    return parse_feeds(texts)


def valid_feeds(parsed: DataFrame) -> DataFrame:
    """Feeds fit for use. An identifier aborts; any other problem only skips the feed."""
    leak = F.array_contains("problems", "identifiers")
    guarded = F.when(leak, F.raise_error(F.lit("a feed names an identifier column")).cast("int")).otherwise(F.size("problems"))
    return parsed.where(guarded == 0)


def feed_cells(feeds: DataFrame) -> DataFrame:
    """Counts in long form: metric_id, site_id, definition_version, part, unit, period, num, den, n, hrs."""
    head = F.struct(F.lit("headline").alias("part"), F.col("doc.headline.cells").alias("cells"))
    rest = F.transform(F.coalesce(F.col("doc.segments"), F.array().cast(f"array<struct<key: string, label: string, color: string, cells: {_CELLS}>>")), lambda s: F.struct(s["key"].alias("part"), s["cells"].alias("cells")))
    base = feeds.select(
        F.col("doc.metric_id").alias("metric_id"),
        F.col("doc.provenance.site_id").alias("site_id"),
        F.col("doc.provenance.definition_version").alias("definition_version"),
        F.explode(F.concat(F.array(head), rest)).alias("p"),
    )
    units = base.select("metric_id", "site_id", "definition_version", "p.part", F.explode("p.cells").alias("unit", "periods"))
    out = units.select("metric_id", "site_id", "definition_version", "part", "unit", F.explode("periods").alias("period", "cell"))
    return out.select("metric_id", "site_id", "definition_version", "part", "unit", "period", "cell.num", "cell.den", "cell.n", "cell.hrs")


def derive_selectors(cells: DataFrame) -> DataFrame:
    """Every period and unit that any feed offers, with labels (U4)."""
    week, month = F.col("period").rlike(r"^\d{4}-W\d{2}$"), F.col("period").rlike(r"^\d{4}-\d{2}$")
    head = cells.where("part = 'headline'")
    periods = head.where(week | month).select(
        F.when(week, F.lit("week")).otherwise(F.lit("month")).alias("kind"), F.col("period").alias("key")
    )
    units = head.where(F.col("unit").isin(*UNIT_ORDER)).select(F.lit("unit").alias("kind"), F.col("unit").alias("key"))
    both = periods.unionByName(units).distinct()
    text = F.when(F.col("kind") == "week", week_label(F.col("key"))).when(F.col("kind") == "month", month_label(F.col("key")))
    return both.select("kind", "key", F.coalesce(text, F.col("key")).alias("label"))


def resolve_selection(cells: DataFrame, grains: DataFrame, picks: DataFrame) -> DataFrame:
    """The cell each metric can answer a pick with, and a badge that says so.

    ``picks`` has ``unit, kind, period``; ``grains`` has ``metric_id, kinds`` (offered period kinds). An
    absent unit falls back to all units of its site; an absent week to the month of its Thursday, else to all time.
    """
    # picks are a user's selections; grains has one row per metric, and a metric one per site that reports it
    asked = picks.crossJoin(F.broadcast(grains)).join(cells.select("metric_id", "site_id").distinct(), "metric_id")
    offered = cells.where("part = 'headline'").select("metric_id", "site_id", "unit").distinct().withColumn("_has", F.lit(True))
    asked = asked.join(offered, ["metric_id", "site_id", "unit"], "left")
    site_wide = (F.col("unit") != ALL) & F.col("_has").isNull()
    unit = F.when(site_wide, F.lit(ALL)).otherwise(F.col("unit"))
    exact = F.array_contains("kinds", F.col("kind"))
    week_to_month = (F.col("kind") == "week") & F.array_contains("kinds", F.lit("month"))
    month = month_of_week(F.when(F.col("kind") == "week", F.col("period")))
    period = F.when(exact, F.col("period")).when(week_to_month, month).otherwise(F.lit("all"))
    badge = F.concat(
        F.when(site_wide, F.lit(" · site-wide")).otherwise(F.lit("")),
        F.when(exact, F.lit("")).when(week_to_month, F.concat(F.lit(" · "), month_label(month), F.lit(" · month"))).when(F.col("kind") != "all", F.lit(" · all-time")).otherwise(F.lit("")),
    )
    out = asked.select(
        "metric_id", "site_id", F.col("unit").alias("asked_unit"), F.col("period").alias("asked_period"), unit.alias("unit"), period.alias("period"), badge.alias("badge")
    )
    return out.join(cells.drop("definition_version"), ["metric_id", "site_id", "unit", "period"], "left")


def pool_sites(cells: DataFrame) -> DataFrame:
    """Sums over sites of the all-unit cells, per definition; ``drift`` marks metrics with several definitions."""
    site = cells.where(F.col("unit") == ALL)
    pooled = site.groupBy("metric_id", "definition_version", "part", "period").agg(
        F.count_distinct("site_id").alias("n_sites"), F.sum("num").alias("num"), F.sum("den").alias("den")
    )
    versions = site.groupBy("metric_id").agg((F.count_distinct("definition_version") > 1).alias("drift"))
    return pooled.join(versions, "metric_id").withColumn("rate", F.when(F.col("den") > 0, F.col("num") / F.col("den")))
