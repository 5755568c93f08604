"""Scoring surfaces: date ranges, single days and what-if scenarios, always as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dayrisk.constants import STORM_LEVEL
from dayrisk.plans.panel import PanelConfig, daily_features
from dayrisk.session import settled
from dayrisk.sources.bundle import Bundle
from dayrisk.sources.hourly_text import read_hourly_table

#: Tasks for each core when scenarios are scored.
SPREAD = 4


def needed_days(hourly: DataFrame, dates: DataFrame, config: PanelConfig = PanelConfig()) -> DataFrame:
    """``(keys, date, wanted)``: the days whose hours the features of the wanted dates look at, the wanted ones among them.

    Only the times of the hours are read, as counts by day. By rows a date looks back over so many rows, however many days they take; by time over so
    many steps. A date without an hour is not wanted by its series.
    """
    keys, reach = list(config.keys), max([*config.lags, *config.rolls, 1])
    on = [*[k for k in keys if k in dates.columns], "date"]
    counts = hourly.groupBy(*keys, F.to_date(config.ts).alias("date")).agg(F.count(F.lit(1)).alias("_n"))
    asked = dates.select(*on).distinct().withColumnsRenamed({c: f"_of_{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    marked = counts.join(asked, match, "left").withColumn("wanted", F.col("_of_date").isNotNull())
    days = Window.partitionBy(*keys).orderBy("date")
    placed = marked.withColumn("_upto", F.sum("_n").over(days))
    later = days.rowsBetween(0, Window.unboundedFollowing)
    next_wanted = F.first(F.when(F.col("wanted"), F.struct((F.col("_upto") - F.col("_n")).alias("before"), "date")), ignorenulls=True).over(later)
    ahead = placed.withColumn("_next", next_wanted)
    if config.gap_mode == "rows":
        near = F.col("_next.before") - F.col("_upto") < reach
    else:
        near = F.date_diff(F.col("_next.date"), F.col("date")) <= -(-reach * config.step_seconds // 86_400)
    return ahead.where(near).select(*keys, "date", "wanted")


def rows_for_dates(hourly: DataFrame, dates: DataFrame, config: PanelConfig = PanelConfig()) -> DataFrame:
    """Unscaled feature rows of the given ``date`` values; a date without hours gives no row.

    ``dates`` may name series keys too; without them every series has a row for each date. Only hours of the days that these dates look
    at go into the windows.
    """
    keys = list(config.keys)
    days = settled(needed_days(hourly, dates, config))
    hours = _of_days(hourly, days, keys, F.to_date(config.ts))
    return _of_days(daily_features(hours, config), days.where("wanted"), keys, F.col("date"))


def _of_days(rows: DataFrame, days: DataFrame, keys: list[str], date: Column) -> DataFrame:
    """The rows of the given days; a null key is a series of its own."""
    named = days.select(*[F.col(c).alias(f"_of_{c}") for c in [*keys, "date"]])
    match = date == F.col("_of_date")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return rows.join(named, match, "left_semi")


def stored_rows_for_dates(spark: SparkSession, path: str, dates: DataFrame, config: PanelConfig = PanelConfig()) -> DataFrame:
    """:func:`rows_for_dates` from hours stored by year (``write_hourly_table``): files of years that no date looks at are not opened.

    The years are found from the times alone.
    """
    years = needed_days(read_hourly_table(spark, path), dates, config).select(F.year("date").alias("year")).distinct()
    found = sorted(r["year"] for r in years.collect())  # as many as the calendar has
    return rows_for_dates(read_hourly_table(spark, path, found), dates, config)


def score_dates(hourly: DataFrame, dates: DataFrame, bundle: Bundle, config: PanelConfig | None = None) -> DataFrame:
    """Probability and decision for every wanted date; no labels needed, the last date included.

    The features are built as the bundle says; another ``config`` than the bundle's is an error.
    """
    if config is not None and bundle.config is not None and config != bundle.config:
        raise ValueError("the bundle was fitted on features of another configuration")
    config = config or bundle.config or PanelConfig()
    return bundle.score(rows_for_dates(hourly, dates, config), [*config.keys, "date"])


def scenario_rows(scenarios: DataFrame, features: Sequence[str], keep: Sequence[str] = ("scenario_id",), doy: str = "doy") -> DataFrame:
    """Feature rows from assumed daily driver values.

    Lags and rolling means of a given driver take its value; its deviations and all other drivers stay
    null, for the fitted medians to fill. The phase follows from Dst and is never recovery.
    """
    drivers = [c for c in scenarios.columns if c not in {*keep, doy}]
    level = F.coalesce(F.col("Dst").cast("double"), F.lit(0.0)) if "Dst" in drivers else F.lit(0.0)
    angle = F.lit(2.0) * F.pi() * F.col(doy) / F.lit(366.0)
    fixed = {
        "phase_quiet": (level > STORM_LEVEL).cast("double"),
        "phase_main": (level <= STORM_LEVEL).cast("double"),
        "phase_recovery": F.lit(0.0),
        "doy_sin": F.sin(angle),
        "doy_cos": F.cos(angle),
    }
    columns = []
    for f in features:
        source = next((d for d in drivers if f.startswith((f"{d}_lag", f"{d}_rmean"))), None)
        value = F.col(source).cast("double") if source else fixed.get(f, F.lit(None).cast("double"))
        columns.append(value.alias(f))
    return scenarios.select(*keep, *columns)


def score_scenarios(scenarios: DataFrame, bundle: Bundle, keep: Sequence[str] = ("scenario_id",)) -> DataFrame:
    """Probability and decision for every scenario.

    An ensemble takes far longer over a row than reading it does, so the narrow rows are dealt evenly over the cores, however few files
    or row groups hold them.
    """
    spread = scenarios.repartition(SPREAD * scenarios.sparkSession.sparkContext.defaultParallelism)
    return bundle.score(scenario_rows(spread, bundle.panel.features, keep), keep)
