"""Hour-to-day collapse and gap-free calendars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayrisk.functions.scalars import interval_label


def to_daily(
    hourly: DataFrame,
    statistics: Mapping[str, Column],
    keys: Sequence[str] = (),
    ts: str = "ts",
    also_by: Sequence[str] = (),
    fill: bool = True,
) -> DataFrame:
    """One row per day with the given aggregates; days without hours are added as nulls.

    ``also_by`` names columns that depend on the day alone (a time block), so that rows already
    partitioned by them need no second shuffle.
    """
    daily = (
        hourly.groupBy(*keys, *also_by, F.to_date(ts).alias("date"))
        .agg(*[c.alias(n) for n, c in statistics.items()])
        .drop(*also_by)
    )
    return fill_calendar(daily, keys) if fill else daily


def fill_calendar(
    daily: DataFrame,
    keys: Sequence[str] = (),
    date: str = "date",
    fills: Mapping[str, object] | None = None,
) -> DataFrame:
    """Add the missing days between the first and last day of each series.

    Each row brings forth itself and the days up to its successor, so the table is read once and
    no calendar is joined. Added days hold ``fills`` (default null). The ordered window sees
    daily rows only: its partitions are bounded by the calendar, not by the data.
    """
    fills = dict(fills or {})
    successor = F.lead(date).over(Window.partitionBy(*keys).orderBy(date))
    spread = daily.withColumn("_next", successor).withColumn(
        "_day", F.explode(F.sequence(date, F.coalesce(F.date_sub("_next", 1), F.col(date))))
    )
    columns = []
    for c in daily.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c == date:
            columns.append(F.col("_day").alias(c))
        elif c in fills:
            columns.append(F.when(F.col("_day") == F.col(date), F.col(c)).otherwise(F.lit(fills[c])).alias(c))
        else:
            columns.append(F.expr(f"CASE WHEN _day = `{date}` THEN `{c}` END AS `{c}`"))
    return spread.select(*columns)


def dominant_phase(quiet: Column, main: Column, recovery: Column) -> Column:
    """Name of the largest daily flag, first in the order quiet, main, recovery on ties.

    A day with any quiet hour is therefore quiet; null if the day has no hours.
    """
    return (
        F.when(quiet == 1, F.lit("phase_quiet"))
        .when(main == 1, F.lit("phase_main"))
        .when(recovery == 1, F.lit("phase_recovery"))
    )


def binned_rate(
    df: DataFrame, value: str, outcome: str, intervals: Sequence[tuple[float, float, str]]
) -> DataFrame:
    """Mean and count of a 0/1 outcome per value interval; empty intervals are left out."""
    return (
        df.select(interval_label(F.col(value), intervals).alias("bin"), F.col(outcome).cast("double").alias("_y"))
        .where("bin IS NOT NULL")
        .groupBy("bin")
        .agg(F.avg("_y").alias("mean"), F.count(F.lit(1)).alias("size"))
    )
